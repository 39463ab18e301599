"""Declarative data-quality checks.

Every metric of one table except ``duplicate_count`` is one aggregate expression, and
all of them are fused into a single ``agg`` - one scan per table.  ``duplicate_count``
is a ``groupBy`` whose partial aggregation collapses hot values before the shuffle.
Results are small (one row per metric / check), so the gate may collect them.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VALUE_TYPE = "decimal(38,4)"
METRICS = ("row_count", "missing_count", "duplicate_count", "min", "max", "max_length")
# The comparators the check language accepts.
COMPARATORS = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le,
               "=": operator.eq, "!=": operator.ne}

PASS, FAIL, NOT_EVALUATED = "pass", "fail", "not_evaluated"


@dataclass(frozen=True)
class Check:
    table: str
    metric: str
    column: str | None
    op: str
    threshold: float
    name: str

    @property
    def label(self) -> str:
        return self.metric if self.column is None else f"{self.metric}({self.column})"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _s(text) -> str:
    return "NULL" if text is None else "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _metric_sql(metric: str, column: str | None) -> str:
    if metric == "row_count":
        return "count(1)"
    c = _q(column)
    return {"missing_count": f"count_if({c} IS NULL)", "min": f"min({c})", "max": f"max({c})",
            "max_length": f"max(length({c}))"}[metric]


def _short(text):
    """A long value stands for itself by its SHA-256, so that no long text is shuffled."""
    return F.when(F.length(text) > 64, F.concat(F.lit("h"), F.sha2(text, 256))).otherwise(F.concat(F.lit("v"), text))


def _duplicate_counts(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """``duplicate_count`` of several columns in one pass: the number of distinct
    non-null values that occur more than once, per column.

    Rows become ``(column, value)`` pairs, grouped with partial aggregation (a hot value
    is collapsed before the shuffle), kept when seen more than once, then counted per
    column - one scan and one shuffle for all columns.  Values are compared as text,
    with floats normalised first (``-0.0`` and ``0.0`` are one value, as in SQL).
    """
    types = dict(df.dtypes)
    as_text = lambda c: (F.col(c) + F.lit(0.0)) if types[c] in ("float", "double") else F.col(c)
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), _short(as_text(c).cast("string")).alias("v")) for c in columns])))
    dup = (pairs.where(F.col("v").isNotNull())
                .groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("_n"))
                .where(F.col("_n") > 1)
                .groupBy("column_name").agg(F.count(F.lit(1)).alias("_d")))
    # one value per column (0 when a column has no duplicate group), from a global
    # aggregate over the tiny per-column result - no join
    wide = dup.selectExpr(*[f"coalesce(max(CASE WHEN column_name = {_s(c)} THEN _d END), 0) AS _d{i}"
                            for i, c in enumerate(columns)])
    body = ", ".join(f"{_s(table)}, 'duplicate_count', CAST({_s(c)} AS STRING), CAST(_d{i} AS {VALUE_TYPE})"
                     for i, c in enumerate(columns))
    return wide.selectExpr(f"stack({len(columns)}, {body}) AS (table_name, metric, column_name, value)")


def compute_metrics(df: DataFrame, table: str, metrics) -> DataFrame:
    """Metrics ``[(metric, column), ...]`` of one table as rows
    ``(table_name, metric, column_name, value DECIMAL(38,4))``: one fused aggregate (a
    single scan) unpivoted with ``stack``, plus one aggregation for all duplicate
    metrics.
    Expressions are SQL text, so building the plan costs a few calls, not one per
    literal."""
    metrics = [(m, c) for m, c in metrics]
    for m, _ in metrics:
        if m not in METRICS:
            raise ValueError(f"unknown metric {m!r}")
    cols = "table_name, metric, column_name, value"
    label = lambda m, c: f"{_s(table)}, {_s(m)}, CAST({_s(c)} AS STRING)"
    fused = [(i, m, c) for i, (m, c) in enumerate(metrics) if m != "duplicate_count"]
    parts = []
    if fused:
        agg = df.selectExpr(*[f"{_metric_sql(m, c)} AS _m{i}" for i, m, c in fused])
        body = ", ".join(f"{label(m, c)}, CAST(_m{i} AS {VALUE_TYPE})" for i, m, c in fused)
        parts.append(agg.selectExpr(f"stack({len(fused)}, {body}) AS ({cols})"))
    dup_cols = list(dict.fromkeys(c for m, c in metrics if m == "duplicate_count"))
    if dup_cols:
        parts.append(_duplicate_counts(df, table, dup_cols))
    return reduce(DataFrame.unionByName, parts)


# ---- metrics by unit: a table's are merged from those of its parts -----------------------
UNIT_METRICS = "metric string, column_name string, value decimal(38,4)"
_MERGED = {"row_count": "sum", "missing_count": "sum", "duplicate_count": "sum", "min": "min", "max": "max", "max_length": "max"}


def unit_metrics(df: DataFrame, unit: str, metrics) -> DataFrame:
    """Metrics of every value of the column ``unit`` as rows ``(unit, metric, column_name, value)``: one fused
    aggregate over a single scan, and one more for each duplicate metric, which counts the values that
    repeat inside a unit."""
    metrics = list(metrics)
    fused = [(i, m, c) for i, (m, c) in enumerate(metrics) if m != "duplicate_count"]
    parts = []
    if fused:
        agg = df.groupBy(unit).agg(*[F.expr(f"{_metric_sql(m, c)} AS _m{i}") for i, m, c in fused])
        body = ", ".join(f"{_s(m)}, CAST({_s(c)} AS STRING), CAST(_m{i} AS {VALUE_TYPE})" for i, m, c in fused)
        parts.append(agg.selectExpr(_q(unit), f"stack({len(fused)}, {body}) AS (metric, column_name, value)"))
    for m, c in metrics:
        if m == "duplicate_count":
            seen = df.groupBy(unit, c).agg(F.count(c).alias("_n"))
            parts.append(seen.groupBy(unit).agg(F.count_if(F.col("_n") > 1).alias("_d")).selectExpr(
                _q(unit), "'duplicate_count' AS metric", f"{_s(c)} AS column_name", f"CAST(_d AS {VALUE_TYPE}) AS value"))
    return reduce(DataFrame.unionByName, parts)


def merge_metrics(units: DataFrame, table: str, metrics) -> DataFrame:
    """The rows of :func:`compute_metrics` for a table from those of :func:`unit_metrics` (no unit: counts
    are 0, all else NULL).  A duplicate metric merges only if equal values share a unit."""
    metrics = list(metrics)
    aggs = []
    for i, (m, c) in enumerate(metrics):
        own = f"{_MERGED[m]}(CASE WHEN metric = {_s(m)} AND column_name <=> {_s(c)} THEN value END)"
        aggs.append(f"{f'coalesce({own}, 0)' if _MERGED[m] == 'sum' else own} AS _m{i}")
    body = ", ".join(f"{_s(table)}, {_s(m)}, CAST({_s(c)} AS STRING), CAST(_m{i} AS {VALUE_TYPE})" for i, (m, c) in enumerate(metrics))
    return units.selectExpr(*aggs).selectExpr(f"stack({len(metrics)}, {body}) AS (table_name, metric, column_name, value)")


_COMPARE_SQL = " OR ".join(f"(comparator = '{op}' AND value {sql} threshold)" for op, sql in
                           [(">", ">"), (">=", ">="), ("<", "<"), ("<=", "<="), ("=", "="), ("!=", "<>")])
OUTCOME_SQL = (f"CASE WHEN value IS NULL THEN '{NOT_EVALUATED}' WHEN {_COMPARE_SQL} THEN '{PASS}' "
               f"ELSE '{FAIL}' END")


def run_checks(tables: dict[str, DataFrame], checks, metrics=None) -> DataFrame:
    """Evaluate ``checks`` against ``tables`` (name -> DataFrame); ``metrics(table, list)`` may give a table's
    metric rows in place of :func:`compute_metrics` (``tables`` then only names them).

    Output rows: table_name, check_name, metric, column_name, value DECIMAL(38,4),
    comparator, threshold, outcome (pass / fail / not_evaluated).  A metric over an
    empty table that yields NULL (min, max) is ``not_evaluated``.
    """
    checks = list(checks)
    missing = {c.table for c in checks} - set(tables)
    if missing:
        raise KeyError(f"no DataFrame for tables {sorted(missing)}")
    for c in checks:
        if c.op not in COMPARATORS:
            raise ValueError(f"unknown comparator {c.op!r}")
    results = []
    for table in dict.fromkeys(c.table for c in checks):
        mine = [c for c in checks if c.table == table]
        unique = list(dict.fromkeys((c.metric, c.column) for c in mine))
        values = metrics(table, unique) if metrics else compute_metrics(tables[table], table, unique)
        # Attach the check definitions (a literal array, no join) to the metric rows.
        spec = ", ".join(
            f"named_struct('s_metric', {_s(c.metric)}, 's_column', CAST({_s(c.column)} AS STRING), "
            f"'check_name', {_s(c.name)}, 'comparator', {_s(c.op)}, "
            f"'threshold', CAST({c.threshold!r} AS {VALUE_TYPE}))" for c in mine)
        joined = (values.selectExpr("*", f"inline(array({spec}))")
                        .where("metric = s_metric AND column_name <=> s_column"))
        results.append(joined.selectExpr("table_name", "check_name", "metric", "column_name", "value",
                                         "comparator", "threshold", f"{OUTCOME_SQL} AS outcome"))
    return reduce(DataFrame.unionByName, results)


class QualityGateError(RuntimeError):
    pass


def gate(results: DataFrame) -> DataFrame:
    """Raise when any check did not pass; return ``results`` otherwise.

    ``results`` has one row per check (bounded by the check list), so collecting the
    failures is safe.
    """
    bad = results.where(F.col("outcome") != PASS).collect()
    if bad:
        lines = [f"{r.table_name}: {r.check_name} [{r.metric}={r.value} {r.comparator} {r.threshold}] -> {r.outcome}"
                 for r in bad]
        raise QualityGateError("quality checks failed:\n" + "\n".join(lines))
    return results


def checks_for(table: str, checks) -> list[Check]:
    """The ad-hoc subset of a check list that targets one table."""
    return [c for c in checks if c.table == table]


# The default check set (table, metric, column, comparator, threshold).
_DEFAULT = [
    ("staging", "row_count", None, ">", 0),
    ("staging", "missing_count", "video_id", "=", 0),
    ("staging", "missing_count", "title", "=", 0),
    ("staging", "missing_count", "published_at", "=", 0),
    ("staging", "missing_count", "extraction_date", "=", 0),
    ("staging", "min", "view_count", ">=", 0),
    ("staging", "min", "like_count", ">=", 0),
    ("staging", "min", "comment_count", ">=", 0),
    ("core", "row_count", None, ">", 0),
    ("core", "missing_count", "video_id", "=", 0),
    ("core", "duplicate_count", "video_id", "=", 0),
    ("core", "missing_count", "title", "=", 0),
    ("core", "min", "duration_seconds", ">=", 0),
    ("core", "max", "duration_seconds", "<=", 90000),
    ("core", "missing_count", "published_at", "=", 0),
    ("core", "min", "view_count", ">=", 0),
    ("core", "min", "like_count", ">=", 0),
    ("core", "min", "comment_count", ">=", 0),
    ("core", "min", "engagement_ratio", ">=", 0),
    ("core", "max", "engagement_ratio", "<=", 1),
    ("core", "max_length", "title", "<=", 200),
    ("history", "row_count", None, ">", 0),
    ("history", "missing_count", "video_id", "=", 0),
    ("history", "min", "view_count", ">=", 0),
    ("history", "min", "like_count", ">=", 0),
    ("history", "min", "comment_count", ">=", 0),
]


def check_name(table, metric, column, op, threshold) -> str:
    target = metric if column is None else f"{metric}({column})"
    return f"{table}: {target} {op} {threshold:g}"


DEFAULT_CHECKS = [Check(t, m, c, op, float(th), check_name(t, m, c, op, th)) for t, m, c, op, th in _DEFAULT]
