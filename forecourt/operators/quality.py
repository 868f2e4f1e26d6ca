"""Q1-Q9: data-quality checks as DataFrames of results.

A check never collects rows: each returns a small DataFrame with one row
per check (``check_name, table_name, column_name, failing_rows, passed``),
computed in one aggregation pass per table (not-null / accepted values /
expressions) or one shuffle per key (unique).  Results from many tables are
``unionByName``-ed into one report.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REPORT_COLUMNS = ["check_name", "table_name", "column_name", "failing_rows", "passed"]


def _report(df: DataFrame) -> DataFrame:
    return df.withColumn("failing_rows", F.col("failing_rows").cast("bigint")) \
             .withColumn("passed", F.col("failing_rows") == 0).select(*REPORT_COLUMNS)


def _one_pass(df: DataFrame, table: str, check: str, failing: dict[str, Column]) -> DataFrame:
    """Count failing rows for several columns in ONE aggregation, then unpivot."""
    agg = df.agg(*[F.count_if(c).alias(name) for name, c in failing.items()])
    long = agg.unpivot([], list(failing), "column_name", "failing_rows")
    return _report(long.select(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
                               "column_name", "failing_rows"))


def not_null(df: DataFrame, table: str, cols: list[str]) -> DataFrame:
    """Q1/Q6: NULL count for every listed column, one scan."""
    return _one_pass(df, table, "not_null", {c: F.col(c).isNull() for c in cols})


def accepted_values(df: DataFrame, table: str, col: str, values: list[str]) -> DataFrame:
    """Q3: values outside the list fail; NULL does not."""
    return _one_pass(df, table, "accepted_values", {col: ~F.col(col).isin(*values)})


def expressions_hold(df: DataFrame, table: str, exprs: dict[str, Column]) -> DataFrame:
    """Q4: rows where the expression is false fail; NULL results do not."""
    return _one_pass(df, table, "expression_is_true", {name: ~e for name, e in exprs.items()})


def unique(df: DataFrame, table: str, col: str) -> DataFrame:
    """Q2: number of non-NULL key values occurring more than once.

    One shuffle on the key with partial aggregation, so a hot key is
    pre-counted on each map task.
    """
    dup = (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
           .where(F.col("n") > 1))
    return _report(dup.agg(F.count(F.lit(1)).alias("failing_rows"))
                   .select(F.lit("unique").alias("check_name"), F.lit(table).alias("table_name"),
                           F.lit(col).alias("column_name"), "failing_rows"))


def union_reports(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def freshness(df: DataFrame, source: str, loaded_at: str, reference_ts: str,
              warn_hours: float, error_hours: float) -> DataFrame:
    """Q7: age of the newest load vs warn / error thresholds -> ok|warn|error."""
    mx = df.agg(F.max(F.col(loaded_at).try_cast("timestamp_ntz")).alias("max_loaded_at"))
    age = (F.unix_seconds(F.lit(reference_ts).cast("timestamp")) -
           F.unix_seconds(F.col("max_loaded_at").cast("timestamp"))) / F.lit(3600.0)
    return mx.select(F.lit(source).alias("source"), "max_loaded_at", age.alias("age_hours")).withColumn(
        "status", F.when(F.col("age_hours").isNull(), F.lit("error"))
        .when(F.col("age_hours") > error_hours, F.lit("error"))
        .when(F.col("age_hours") > warn_hours, F.lit("warn")).otherwise(F.lit("ok")))


def range_issues(rates: DataFrame, keys: list[str], valid_from: str, valid_to: str) -> DataFrame:
    """Q9: overlaps and gaps between consecutive validity ranges per key.

    A window over the (small, per-key) rate history; rows returned are the
    offending range with the next range's start and the issue name.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(valid_from), F.col(valid_to))
    nxt = rates.withColumn("next_valid_from", F.lead(valid_from).over(w))
    issue = (F.when(F.col("next_valid_from") <= F.col(valid_to), F.lit("overlap"))
             .when(F.col("next_valid_from") > F.date_add(F.col(valid_to), 1), F.lit("gap")))
    return nxt.withColumn("issue", issue).where(F.col("issue").isNotNull())


class DataQualityError(RuntimeError):
    """Raised when a check fails: the pipeline's contract is to fail loudly."""


def raise_on_failures(report: DataFrame, allow: set[str] | None = None) -> None:
    """Raise if any check in ``report`` failed.  The report holds one row per
    check (a few dozen rows), so only the failing check names reach the driver."""
    failing = [f"{r.check_name}:{r.table_name}.{r.column_name}={r.failing_rows}"
               for r in report.where(~F.col("passed")).select(*REPORT_COLUMNS[:4]).collect()
               if f"{r.table_name}.{r.column_name}" not in (allow or set())]
    if failing:
        raise DataQualityError("failed checks: " + ", ".join(sorted(failing)))
