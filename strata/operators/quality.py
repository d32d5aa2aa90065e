"""Data-quality gates.

A check is an aggregate expression over one table plus a comparator.  All
checks of one table run in a **single** aggregate pass; the per-check rows
are produced with ``inline`` on the one-row result, so the report is a small
DataFrame whose size is the number of checks, not the data.

Comparators (fixed semantics): ``gt gte lt lte eq between not_null``.
``not_null`` means "not NULL and greater than 0".  A NULL value fails every
comparator.  An unknown comparator is an error when the check is built.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Comparator name -> test of a value against the low and high threshold.  The tests are built from
# operators that Columns and plain numbers share, so there is one definition for both.
COMPARATORS = {
    "gt": lambda v, lo, hi: v > lo,
    "gte": lambda v, lo, hi: v >= lo,
    "lt": lambda v, lo, hi: v < lo,
    "lte": lambda v, lo, hi: v <= lo,
    "eq": lambda v, lo, hi: v == lo,
    "between": lambda v, lo, hi: (v >= lo) & (v <= hi),
    "not_null": lambda v, lo, hi: v > 0,
}
OPS = tuple(COMPARATORS)


class QualityCheckFailed(Exception):
    """Raised with every failed check listed."""


@dataclass(frozen=True)
class Check:
    name: str
    expr: Column = field(compare=False)
    op: str = "gt"
    threshold: float | tuple[float, float] = 0

    def __post_init__(self):
        if self.op not in OPS:
            raise ValueError(f"Unknown operator: {self.op}")
        if self.op == "between":
            if not (isinstance(self.threshold, (tuple, list)) and len(self.threshold) == 2):
                raise ValueError("between needs a (low, high) threshold")

    @property
    def bounds(self) -> tuple[float | None, float | None]:
        if self.op == "between":
            lo, hi = self.threshold
            return float(lo), float(hi)
        if self.op == "not_null":
            return None, None
        return float(self.threshold), None


def count_rows() -> Column:
    """Row count of the checked table."""
    return F.count(F.lit(1))


def count_where(pred: Column) -> Column:
    """Rows where ``pred`` holds (NULL counts as false)."""
    return F.count_if(F.coalesce(pred, F.lit(False)))


def null_rate(c: str) -> Column:
    """Share of rows where ``c`` is NULL (0.0 to 1.0)."""
    return F.avg(F.col(c).isNull().cast("double"))


def passes(value: Column, op: str, lo: Column, hi: Column) -> Column:
    """Comparator as a Column predicate; a NULL value or threshold gives FALSE."""
    return F.coalesce(COMPARATORS[op](value, lo, hi), F.lit(False))


def evaluate(value, op: str, threshold) -> bool:
    """The same comparator on a plain number (or None)."""
    lo, hi = Check("value", F.lit(0), op, threshold).bounds
    return value is not None and bool(COMPARATORS[op](value, lo, hi))


def run_checks(df: DataFrame, checks: Sequence[Check], table: str | None = None) -> DataFrame:
    """One scan of ``df`` for all ``checks`` -> rows (table, name, value, op, lo, hi, passed)."""
    if not checks:
        raise ValueError("no checks given")
    values = df.agg(*[c.expr.cast("double").alias(f"_v{i}") for i, c in enumerate(checks)])
    rows = []
    for i, c in enumerate(checks):
        lo, hi = c.bounds
        lo_c = F.lit(lo).cast("double")
        hi_c = F.lit(hi).cast("double")
        v = F.col(f"_v{i}")
        rows.append(
            F.struct(
                F.lit(table).cast("string").alias("table_name"),
                F.lit(c.name).alias("check_name"),
                v.alias("value"),
                F.lit(c.op).alias("op"),
                lo_c.alias("threshold_lo"),
                hi_c.alias("threshold_hi"),
                passes(v, c.op, lo_c, hi_c).alias("passed"),
            )
        )
    return values.select(F.inline(F.array(*rows)))


def run_suite(suite: Sequence[tuple[str, DataFrame, Sequence[Check]]]) -> DataFrame:
    """Checks over several tables; one scan per table, results unioned."""
    out = None
    for table, df, checks in suite:
        part = run_checks(df, checks, table)
        out = part if out is None else out.unionByName(part)
    return out


def load_named_checks(path: str, op: str = "gt", threshold=0) -> list[dict]:
    """Checks from a SQL file; see ``parse_named_checks``."""
    with open(path, encoding="utf-8") as f:
        return parse_named_checks(f.read(), op, threshold)


def parse_named_checks(text: str, op: str = "gt", threshold=0) -> list[dict]:
    """Checks from SQL text whose statements follow ``-- name: <check>`` lines.

    A line ``-- expect: <comparator> <number>`` after the name says what the value is held against
    (``-- expect: eq 0``); without one, ``op`` and ``threshold`` do.  Other comment lines are dropped;
    each statement keeps its text up to the next marker (a trailing ``;`` is removed).
    """
    checks: list[dict] = []
    for raw in text.splitlines():
        line = raw.strip()
        if line.lower().startswith("-- name:"):
            checks.append({"name": line.split(":", 1)[1].strip(), "sql": "", "op": op, "threshold": threshold})
        elif not checks:
            continue
        elif line.lower().startswith("-- expect:"):
            wanted, number = line.split(":", 1)[1].split()
            checks[-1] |= {"op": wanted, "threshold": float(number) if "." in number else int(number)}
        elif not line.startswith("--"):
            checks[-1]["sql"] += raw + "\n"
    return [c | {"sql": c["sql"].strip().rstrip(";").strip()} for c in checks]


@dataclass
class Outcome:
    """What became of one check; ``error`` is set when its query could not run."""

    check_name: str
    value: object = None
    op: str | None = None
    threshold: object = None
    passed: bool = False
    error: str | None = None

    def record(self) -> dict:
        return {k: v for k, v in asdict(self).items() if v is not None or k == "value"}


def run_sql_checks(spark, checks: Sequence[dict], args: dict | None = None, frames: dict | None = None) -> list[dict]:
    """Checks given as scalar SQL queries: ``{"name", "sql", "op"="gt", "threshold"=0}``.

    Each query must return one row (a global aggregate), so fetching its first
    cell is bounded.  ``args`` binds named parameters (``:silver``,
    ``IDENTIFIER(:table)``) in every query; ``frames`` are DataFrames that queries name as ``{silver}``.  A
    query that fails counts as a
    failed check with its error text; the remaining checks still run.
    """

    def outcome(name, sql, op="gt", threshold=0) -> Outcome:
        bound = {k: v for k, v in (args or {}).items() if f":{k}" in sql}
        tables = {k: v for k, v in (frames or {}).items() if f"{{{k}}}" in sql}
        try:
            first = spark.sql(sql, args=bound, **tables).first()
        except PySparkException as exc:
            return Outcome(name, error=str(exc))
        value = first[0] if first else None
        return Outcome(name, value, op, threshold, evaluate(value, op, threshold))

    return [outcome(**check).record() for check in checks]


def describe_failure(detail: dict) -> str:
    if "error" in detail:
        return f"{detail['check_name']} (not run: {detail['error']})"
    threshold = detail.get("threshold", detail.get("threshold_lo"))
    return f"{detail['check_name']} (value {detail.get('value')}, wanted {detail.get('op')} {threshold})"


def assert_details(details: Sequence[dict]) -> dict:
    """Raise ``QualityCheckFailed`` naming every failed check, else return the counts and the details."""
    failures = [describe_failure(d) for d in details if not d["passed"]]
    if failures:
        raise QualityCheckFailed(f"{len(failures)} of {len(details)} checks failed: {'; '.join(failures)}")
    return {"passed": len(details), "failed": 0, "details": list(details)}


def assert_checks(report: DataFrame) -> dict:
    """Raise ``QualityCheckFailed`` listing every failed check, else return a summary.

    The report has one row per check, so collecting it is bounded by the
    number of checks.
    """
    return assert_details([r.asDict() for r in report.collect()])


def observe_checks(df: DataFrame, checks: Sequence[Check], name: str = "quality"):
    """Attach the check aggregates to ``df`` as an ``Observation``.

    The metrics are computed while ``df`` is written (no extra pass).  After
    the action, ``evaluate_observation(obs, checks)`` gives the verdicts.
    """
    obs = Observation(name)
    observed = df.observe(obs, *[c.expr.cast("double").alias(f"_v{i}") for i, c in enumerate(checks)])
    return observed, obs


def evaluate_observation(obs: Observation, checks: Sequence[Check]) -> list[dict]:
    """Python-side verdicts for observed metrics (a handful of numbers)."""
    metrics = obs.get
    out = []
    for i, c in enumerate(checks):
        value = metrics.get(f"_v{i}")
        out.append({"name": c.name, "value": value, "op": c.op, "threshold": c.threshold,
                    "passed": evaluate(value, c.op, c.threshold)})
    return out
