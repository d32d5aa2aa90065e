"""End-to-end domain runs: raw -> bronze -> silver -> gold tables, quality gate, views.

Every layer boundary is a written Parquet table: it cuts the lineage (a lost
executor recomputes from the last table, not from raw text) and is the
hand-off to the next stage.  With ``years`` given, bronze and silver replace
only those year partitions (dynamic overwrite) and read only those partitions
(partition pruning); gold tables are recomputed whole because their windows
(running totals, previous year) span all years.

The gate runs after gold is written, as in the source pipeline: a failure
raises ``QualityCheckFailed`` and the views are not published.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators.quality import (
    Check,
    assert_details,
    count_rows,
    count_where,
    evaluate,
    evaluate_observation,
    load_named_checks,
    observe_checks,
    run_sql_checks,
    run_suite,
)
from strata.plans import cross, deforestation, spending, tax
from strata.plans.common import CORRUPT, typed_int
from strata.sources.harmonise import tag_deforestation, tag_tax
from strata.sources.ranges import CANDIDATES, RANGE_BYTES, list_files, read_columns
from strata.sources.tables import read_table, write_table
from strata.sources.versions import is_versioned, publish_views, read_version, write_version
from strata.streaming.incremental import changed_files, digests, file_state, new_files


# --- Fixed values: lake layout and view names users already query ---------
# Bronze/silver folders per domain; views "gold_<table>"; cross-domain tables
# under gold/cross_domain.
DOMAIN_DIRS = {"deforestation": "prodes", "tax": "irpf", "spending": "spending"}
VIEW_PREFIX = "gold_"
CROSS_DOMAIN_TABLES = ("fiscal_balance", "deforestation_vs_spending")
GOLD_TABLES = ("deforestation_by_biome", "deforestation_by_state", "spending_by_function", "tax_by_bracket",
               *CROSS_DOMAIN_TABLES)
# ---------------------------------------------------------------------------


# Gold tables whose partition columns are text that may look like numbers.
GOLD_SCHEMAS = {
    "deforestation_by_biome": "year int, area_km2 double, cumulative_km2 double, prev_year_km2 double, yoy_change_pct double, "
                              "_computed_at timestamp, biome string",
    "spending_by_function": "year int, executed_brl double, budgeted_brl double, pct_of_total double, yoy_nominal_growth_pct double, "
                            "_computed_at timestamp, functional_category string",
    "tax_by_bracket": "income_bracket string, total_declarations bigint, total_taxable_income double, total_tax_due double, "
                      "effective_rate_pct double, pct_of_total_tax double, yoy_growth_pct double, _computed_at timestamp, year int",
}


@dataclass(frozen=True)
class Layout:
    """Folders of a lake; with ``atomic`` its tables are versioned (see ``sources.versions``)."""

    root: str
    atomic: bool = False

    def write(self, df: DataFrame, path: str, partition_by=None, overwrite: str = "all", **options) -> None:
        if self.atomic:
            write_version(df, path, partition_by, overwrite, **options)
        else:
            write_table(df, path, partition_by, overwrite, **options)

    def read(self, spark: SparkSession, path: str, schema=None) -> DataFrame:
        if self.atomic or is_versioned(spark, path):
            return read_version(spark, path)
        return read_table(spark, path, schema=schema)

    def bronze(self, domain: str) -> str:
        return os.path.join(self.root, "bronze", DOMAIN_DIRS.get(domain, domain))

    def silver(self, domain: str) -> str:
        return os.path.join(self.root, "silver", DOMAIN_DIRS.get(domain, domain))

    def gold(self, table: str) -> str:
        if table in CROSS_DOMAIN_TABLES:
            return os.path.join(self.root, "gold", "cross_domain", table)
        return os.path.join(self.root, "gold", table)

    def rejected(self, domain: str) -> str:
        return os.path.join(self.root, "quarantine", DOMAIN_DIRS.get(domain, domain))


def _years_filter(df: DataFrame, years) -> DataFrame:
    """``years``: a tuple is a range with both its ends, a set is just its years, None is all."""
    if years is None:
        return df
    return df.where(F.col("year").isin(sorted(years)) if isinstance(years, (set, frozenset)) else F.col("year").between(*years))


# Raw columns of each domain, and how its drops of other layouts are brought to them (spending's come as API items).
RAW_COLUMNS = {"deforestation": deforestation.RAW_COLUMNS, "spending": spending.RAW_COLUMNS, "tax": tax.RAW_COLUMNS}
HARMONISE = {"deforestation": tag_deforestation, "tax": tag_tax}


def load_raw(spark: SparkSession, domain: str, raw, sep: str = ",", encoding: str = "UTF-8", mixed: bool = False, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Raw rows of a domain with lineage, from a path, paths or a frame of files (``ranges.list_files``).

    Standard drops have the domain's columns in any order, as text.  With ``mixed``, every file has a
    delimiter and headers of its own; columns are found by their aliases and numbers read by the source's
    rules, and what cannot be read carries a ``_reject_reason``.  Files are read in ranges of
    ``range_bytes``, quoted line breaks or not.
    """
    if isinstance(raw, DataFrame) and "file_path" not in raw.columns:
        return raw  # rows already
    if mixed and domain in HARMONISE:
        return HARMONISE[domain](read_columns(spark, raw, HARMONISE[domain].columns, CANDIDATES, encoding, range_bytes, CORRUPT, as_map=True))
    columns = RAW_COLUMNS[domain]
    return read_columns(spark, raw, columns, CANDIDATES if mixed else (sep,), encoding, range_bytes, CORRUPT, required=columns)


class RejectedRowsError(ValueError):
    """Raised by ``fail_fast`` runs when raw rows could not be typed."""


def _bronze_and_silver(
    spark, layout, domain, raw_df, bronze_fn, silver_fn, years, audit, silver_kwargs, fail_fast=False,
    silver_checks=(), rebalance_bronze=True, run_id=None,
):
    """Write bronze and silver; return (bronze table, silver table, observed gate results or None).

    On a full run the silver checks are observed while silver is written and
    the bronze row count comes from the rejected-rows observation, so neither
    table is scanned again for the gate.  A backfill (``years``) returns None:
    its gate must cover the whole tables, not only the rewritten years.

    Rejected rows are kept per run: each run writes the partition ``run_id`` of
    the quarantine table and touches no other, so a batch that is repeated
    replaces its own rejects only.
    """
    run_id = run_id or uuid.uuid4().hex

    def quarantine():
        write_table(bad.withColumn("run_id", F.lit(run_id)), layout.rejected(domain), ["run_id"], overwrite="partitions")

    overwrite = "all" if years is None else "partitions"
    counts = Observation(f"bronze_{domain}")
    good, bad = bronze_fn(raw_df, audit=audit, observation=counts)
    if fail_fast and bad.limit(1).count() > 0:
        # Reject the whole drop before bronze is touched (the scan stops at the first bad row).
        quarantine()
        raise RejectedRowsError(f"raw {domain} rows could not be typed; see {layout.rejected(domain)}")
    # One REBALANCE shuffle on the year keeps the number of files near the size of the data; without
    # it every task writes a file per year it holds (fine for drops that arrive per year).
    layout.write(_years_filter(good, years), layout.bronze(domain), ["year"], overwrite, rebalance=rebalance_bronze)
    if counts.get.get("rejected", 0) > 0:  # second pass over raw only when rows were rejected
        quarantine()
    # Read back with the known schema: an empty partitioned write leaves no file to infer it from.
    bronze = _years_filter(layout.read(spark, layout.bronze(domain), good.schema), years)
    silver = silver_fn(bronze, audit=audit, **(silver_kwargs or {}))
    observed = None
    if years is None and silver_checks:
        silver, observed = observe_checks(silver, silver_checks, name=f"silver_{domain}")
    layout.write(silver, layout.silver(domain), ["year"], overwrite)
    bronze_all = layout.read(spark, layout.bronze(domain), good.schema)
    silver_all = layout.read(spark, layout.silver(domain), silver.schema)
    details = None
    if observed is not None:
        rows = counts.get.get("rows", 0) - counts.get.get("rejected", 0)
        details = [_detail(f"bronze.{domain}", "row_count", rows, "gt", 0)]
        details += [
            _detail(f"silver.{domain}", v["name"], v["value"], v["op"], v["threshold"], v["passed"])
            for v in evaluate_observation(observed, silver_checks)
        ]
    return bronze_all, silver_all, details


def _detail(table, name, value, op, threshold, passed=None) -> dict:
    return {"table_name": table, "check_name": name, "value": value, "op": op, "threshold": threshold,
            "passed": evaluate(value, op, threshold) if passed is None else passed}


def _write_gold(spark, layout: Layout, df: DataFrame, path: str, partition_by=None, sort_by=None, single_file=False) -> DataFrame:
    layout.write(df, path, partition_by, sort_by=sort_by, single_file=single_file)
    return layout.read(spark, path, df.schema)


def run_deforestation(
    spark: SparkSession,
    raw,
    root: str,
    years: tuple[int, int] | None = None,
    mode: str = "prefer_rollup",
    gate: bool = True,
    audit: bool = True,
    sep: str = ",",
    silver_kwargs: dict | None = None,
    fail_fast: bool = False,
    rebalance_bronze: bool = True,
    encoding: str = "UTF-8",
    run_id: str | None = None,
    mixed: bool = False,
    atomic: bool = False,
    checks: str | Sequence[dict] | None = None,
) -> dict:
    """Deforestation domain: raw CSV paths (or a raw frame) to both gold tables.

    Rows that cannot be typed go to quarantine; with ``fail_fast`` one such
    row rejects the whole drop before bronze is written (the source's behaviour).
    """
    L = Layout(root, atomic)
    raw_df = load_raw(spark, "deforestation", raw, sep, encoding, mixed)
    silver_checks = [
        Check("row_count", count_rows()),
        Check("null_years", count_where(F.col("year").isNull()), "eq", 0),
        Check("negative_areas", count_where(F.col("area_km2") < 0), "eq", 0),
    ]
    bronze, silver, observed = _bronze_and_silver(
        spark, L, "deforestation", raw_df, deforestation.bronze, deforestation.silver, years, audit, silver_kwargs,
        fail_fast, silver_checks, rebalance_bronze, run_id,
    )
    biome = _write_gold(spark, L, deforestation.gold_by_biome(silver, mode=mode, audit=audit),
                        L.gold("deforestation_by_biome"), ["biome"], sort_by=deforestation.BIOME_ORDER)
    state = _write_gold(spark, L, deforestation.gold_by_state(silver, audit=audit), L.gold("deforestation_by_state"),
                        sort_by=deforestation.state_order())
    suite = [("gold.deforestation_by_biome", biome, [Check("row_count", count_rows())])]
    if observed is None:
        suite = [("bronze.deforestation", bronze, [Check("row_count", count_rows())]),
                 ("silver.deforestation", silver, silver_checks)] + suite
    return _finish(spark, L, suite, gate, {"deforestation_by_biome": biome, "deforestation_by_state": state},
                   observed, checks, {"bronze": bronze, "silver": silver})


def run_spending(
    spark: SparkSession,
    raw,
    root: str,
    years: tuple[int, int] | None = None,
    gate: bool = True,
    audit: bool = True,
    sep: str = ",",
    silver_kwargs: dict | None = None,
    fail_fast: bool = False,
    rebalance_bronze: bool = True,
    encoding: str = "UTF-8",
    run_id: str | None = None,
    mixed: bool = False,
    atomic: bool = False,
    checks: str | Sequence[dict] | None = None,
) -> dict:
    """Spending domain: raw CSV paths (or a raw frame, e.g. from API items) to gold by function."""
    L = Layout(root, atomic)
    raw_df = load_raw(spark, "spending", raw, sep, encoding, mixed)
    silver_checks = [
        Check("row_count", count_rows()),
        Check("negative_executed", count_where(F.col("executed_brl") < 0), "eq", 0),
    ]
    bronze, silver, observed = _bronze_and_silver(
        spark, L, "spending", raw_df, spending.bronze, spending.silver, years, audit, silver_kwargs, fail_fast,
        silver_checks, rebalance_bronze, run_id,
    )
    gold = _write_gold(spark, L, spending.gold_by_function(silver, audit=audit), L.gold("spending_by_function"),
                       ["functional_category"], sort_by=spending.function_order())
    suite = [("gold.spending_by_function", gold, [Check("row_count", count_rows())])]
    if observed is None:
        suite = [("bronze.spending", bronze, [Check("row_count", count_rows())]),
                 ("silver.spending", silver, silver_checks)] + suite
    return _finish(spark, L, suite, gate, {"spending_by_function": gold}, observed, checks, {"bronze": bronze, "silver": silver})


def run_tax(
    spark: SparkSession,
    raw,
    root: str,
    years: tuple[int, int] | None = None,
    gate: bool = True,
    audit: bool = True,
    sep: str = ",",
    silver_kwargs: dict | None = None,
    fail_fast: bool = False,
    rebalance_bronze: bool = True,
    encoding: str = "UTF-8",
    run_id: str | None = None,
    mixed: bool = False,
    atomic: bool = False,
    checks: str | Sequence[dict] | None = None,
) -> dict:
    """Tax domain: raw CSV paths (or a raw frame) to gold by bracket."""
    L = Layout(root, atomic)
    raw_df = load_raw(spark, "tax", raw, sep, encoding, mixed)
    silver_checks = [
        Check("row_count", count_rows()),
        Check("negative_tax", count_where(F.col("tax_due_brl") < 0), "eq", 0),
    ]
    bronze, silver, observed = _bronze_and_silver(
        spark, L, "tax", raw_df, tax.bronze, tax.silver, years, audit, silver_kwargs, fail_fast, silver_checks,
        rebalance_bronze, run_id,
    )
    gold = _write_gold(spark, L, tax.gold_by_bracket(silver, audit=audit), L.gold("tax_by_bracket"), ["year"],
                       sort_by=tax.BRACKET_ORDER)
    suite = [("gold.tax_by_bracket", gold, [Check("row_count", count_rows())])]
    if observed is None:
        suite = [("bronze.tax", bronze, [Check("row_count", count_rows())]),
                 ("silver.tax", silver, silver_checks)] + suite
    return _finish(spark, L, suite, gate, {"tax_by_bracket": gold}, observed, checks, {"bronze": bronze, "silver": silver})


def run_cross_domain(spark: SparkSession, root: str, category: str = "Environment", audit: bool = True, atomic: bool = False) -> dict:
    """Cross-domain gold (year grained, one file each) and views over all gold tables present, published for later sessions too."""
    L = Layout(root, atomic)
    plain = Layout(root)  # the domains' tables may be versioned or not
    gold = lambda t: plain.read(spark, plain.gold(t), GOLD_SCHEMAS.get(t))  # a category '02' stays text
    balance = cross.fiscal_balance(gold("tax_by_bracket"), gold("spending_by_function"), audit=audit)
    outcome = cross.outcome_vs_spend(gold("deforestation_by_biome"), gold("spending_by_function"), category, audit=audit)
    for name, df in (("fiscal_balance", balance), ("deforestation_vs_spending", outcome)):
        L.write(df, L.gold(name), sort_by=["year"], single_file=True)
    return {"views": publish_views(spark, root, {f"{VIEW_PREFIX}{n}": (L.gold(n), gold(n)) for n in GOLD_TABLES})}


def _finish(spark, layout: Layout, suite, gate, gold: dict[str, DataFrame], observed: list[dict] | None = None, checks=None, layers=None) -> dict:
    """Gate (observed results, the scanned suite, the run's own named checks), then publish views over the gold tables, for this session and later ones."""
    details = list(observed or []) + [r.asDict() for r in run_suite(suite).collect()]
    if checks:  # a file's, or given; their SQL names the run's tables as {bronze}, {silver} and by their gold names
        named = load_named_checks(checks) if isinstance(checks, str) else checks
        details += run_sql_checks(spark, named, frames={**(layers or {}), **gold})
    summary = assert_details(details) if gate else {"details": details}
    summary["views"] = publish_views(spark, layout.root, {f"{VIEW_PREFIX}{t}": (layout.gold(t), df) for t, df in gold.items()})
    return summary


DOMAINS = {
    "deforestation": (run_deforestation, deforestation.RAW_COLUMNS),
    "spending": (run_spending, spending.RAW_COLUMNS),
    "tax": (run_tax, tax.RAW_COLUMNS),
}


BRONZE = {"deforestation": deforestation.bronze, "spending": spending.bronze, "tax": tax.bronze}


def run_if_changed(spark: SparkSession, domain: str, landing: str, root: str, sep: str = ",", **run_kwargs) -> dict | None:
    """Run a domain over all of ``landing`` if any file was added, changed under its name, or removed.

    The files' state (path, length, modification time, content hash) is a table under the lake root,
    compared by a join and replaced only after the run has succeeded.  Use this where a source
    publishes under fixed names; ``run_incremental`` sees new names only.
    """
    base = os.path.join(root, "_state", f"landing_{domain}")
    name = uuid.uuid4().hex
    file_state(spark, landing).write.parquet(f"{base}/{name}")
    try:  # the log has a line "number state" per finished run
        split = F.split("value", " ")
        number, known = spark.read.text(f"{base}/log").select(F.max(F.struct(split[0].cast("int").alias("n"), split[1].alias("s"))).alias("m")).first()["m"]
    except AnalysisException:
        number, known = 0, None
    before = spark.read.parquet(f"{base}/{known}") if known else None
    changes = changed_files(spark.read.parquet(f"{base}/{name}"), before).groupBy("change").count().collect()  # three rows at most
    if not changes:
        return None
    summary = DOMAINS[domain][0](spark, landing, root, sep=sep, **run_kwargs)
    spark.createDataFrame([(f"{number + 1} {name}",)], "value string").coalesce(1).write.mode("append").text(f"{base}/log")
    summary["changes"] = {r["change"]: r["count"] for r in changes}
    return summary


LANDING_INDEX = "batch int, path string, length long, file_path string, digest string, year int, rows long"


def landing_index(spark: SparkSession, root: str, domain: str) -> DataFrame:
    """Which file holds how many rows of which year (null: none that can be read), as of the batches so far."""
    try:
        return read_table(spark, _index_path(root, domain), schema=LANDING_INDEX)
    except AnalysisException:  # no batch yet
        return spark.createDataFrame([], LANDING_INDEX)


def _index_path(root: str, domain: str) -> str:
    return os.path.join(root, "_state", f"landing_index_{domain}")


def run_incremental(
    spark: SparkSession,
    domain: str,
    landing: str,
    root: str,
    checkpoint: str | None = None,
    sep: str = ",",
    max_files_per_batch: int | None = None,
    encoding: str = "UTF-8",
    mixed: bool = False,
    **run_kwargs,
) -> list[dict]:
    """Run a domain only for files that arrived since the last run ("only if the source changed").

    An AvailableNow stream over ``landing`` says which files are new; it lists them and reads nothing.  A
    batch reads its new files once to index them: a row per file and year, with the file's content hash,
    in the batch's partition of the landing index.  The years found there are dirty.  They are rebuilt (dynamic
    overwrite) from all files that the index knows to hold any of them and that are still there, and from
    no others; years between them are left alone.  So a year may lie in any number of files, arrive over any number of runs, and
    ``max_files_per_batch`` changes how often the run works, never what it leaves.  Gold is recomputed.
    With no new file nothing runs.  The stream checkpoint commits after the batch has been written, so a
    failed batch is repeated next time; its index rows and its rejects (quarantine partition ``batch-<id>``:
    those of all the years it rebuilt) are replaced, not doubled.

    Each summary says how many files and bytes the batch opened (``files_opened``, ``bytes_opened``).
    """
    run_fn, _ = DOMAINS[domain]
    ckpt = checkpoint or os.path.join(root, "_checkpoints", f"landing_{domain}")
    results: list[dict] = []

    def batch(files: DataFrame, batch_id: int) -> None:
        state = os.path.join(root, "_state", f"new_{domain}")
        write_table(digests(files), state)
        new = read_table(spark, state)
        rows = load_raw(spark, domain, new, sep, encoding, mixed)
        per_year = rows.groupBy(F.col("_source_file").alias("file_path"), typed_int("year").alias("year")).agg(F.count(F.lit(1)).alias("rows"))
        index = new.join(per_year, "file_path", "left").select(F.lit(batch_id).alias("batch"), "path", "length", "file_path", "digest", "year", "rows")
        write_table(index, _index_path(root, domain), ["batch"], overwrite="partitions")

        known = landing_index(spark, root, domain)
        mine = known.where(F.col("batch") == batch_id)
        dirty = frozenset(r.year for r in mine.where("year IS NOT NULL").select("year").distinct().collect())
        run_id = run_kwargs.get("run_id", f"batch-{batch_id}")
        if not dirty:  # rejected with this batch, not lost
            bad = BRONZE[domain](rows, audit=False)[1].withColumn("run_id", F.lit(run_id))
            write_table(bad, Layout(root).rejected(domain), ["run_id"], overwrite="partitions")
            return
        holding = known.where(F.col("year").isin(sorted(dirty)) | (F.col("batch") == batch_id)).select("path", "length", "file_path").distinct()
        holding = holding.join(list_files(spark, landing).select("path"), "path", "left_semi")  # files that are still there
        files_path = os.path.join(root, "_state", f"opened_{domain}")
        write_table(holding, files_path)
        opened = read_table(spark, files_path)
        # Rows without a year are rejected with the batch that brings them.
        raw = load_raw(spark, domain, opened, sep, encoding, mixed).withColumn("_year", typed_int("year"))
        fresh = mine.select(F.col("file_path").alias("_source_file")).distinct().withColumn("_fresh", F.lit(True))
        raw = raw.join(fresh, "_source_file", "left").where(F.col("_year").isin(sorted(dirty)) | (F.col("_year").isNull() & F.col("_fresh")))
        summary = run_fn(spark, raw.drop("_year", "_fresh"), root, years=dirty, **({"run_id": run_id} | run_kwargs))
        size = opened.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("b")).first()
        results.append(summary | {"batch_id": batch_id, "years": sorted(dirty), "files_opened": size.n, "bytes_opened": size.b})

    new_files(spark, landing, ckpt, batch, max_files_per_batch)
    return results
