from strata.session import CLUSTER_CONF, DEFAULT_CONF, checkpoint_root, scratch_path


def test_cluster_settings_are_known_sql_settings(spark):
    """Every key of the cluster profile is a real, runtime-settable SQL setting (no silent typos)."""
    for key, value in CLUSTER_CONF.items():
        before = spark.conf.get(key, None)
        spark.conf.set(key, value)
        try:
            assert spark.conf.get(key) == value, key
            assert spark.conf.isModifiable(key), key
        finally:
            if before is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, before)
    assert DEFAULT_CONF["spark.ui.enabled"] == "false"


def test_scratch_paths_live_under_the_checkpoint_root(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root) and b.startswith(root) and a != b


def test_get_spark_reuses_the_session_and_applies_defaults(spark):
    from strata import get_spark

    s = get_spark(shuffle_partitions=8)
    assert s is spark or s.sparkContext is spark.sparkContext
    assert s.conf.get("spark.sql.adaptive.enabled") == "true"
    assert s.conf.get("spark.sql.session.timeZone") == "UTC"
    assert s.conf.get("spark.sql.shuffle.partitions") == "8"
