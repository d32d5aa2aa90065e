"""Scale experiment: the same queries on a k-times larger copy of a scale factor.

    python scripts/scale_check.py [sf_dir] [k]

Writes a copy of the tables under the shared scratch root where lineitem and
orders are replicated k times with shifted order keys (customers, suppliers,
parts and the dimensions are kept), so every join still finds its partners.
Prints the path; run ``BENCH_SF_DIR=<path> python bench.py`` on it and compare
per-query times with the original scale factor.
"""

from __future__ import annotations

import json
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def main():
    src = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    k = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from strata.session import scratch_path

    spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    dst = scratch_path(spark, f"scaled-x{k}")
    max_order = spark.read.parquet(f"{src}/orders.parquet").agg(F.max("o_orderkey")).first()[0] + 1
    for t in TABLES:
        df = spark.read.parquet(f"{src}/{t}.parquet")
        if t in ("orders", "lineitem"):
            key = "o_orderkey" if t == "orders" else "l_orderkey"
            cols = df.columns
            # Each row is repeated k times by a generator (no join).
            df = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
            df = df.withColumn(key, F.col(key) + F.col("_copy").cast("bigint") * F.lit(max_order)).select(*cols)
        df.write.mode("overwrite").parquet(f"{dst}/{t}.parquet")
    rows = spark.read.parquet(f"{dst}/lineitem.parquet").count()
    spark.stop()
    print(json.dumps({"scaled_copy": dst, "factor": k, "lineitem_rows": rows}))


if __name__ == "__main__":
    main()
