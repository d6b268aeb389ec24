"""Count what a run did. Every result is an aggregate; nothing is collected."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.derive import moment
from skyledger.operators.quality import REASON


def reason_counts(checked: DataFrame) -> DataFrame:
    """Rows per reason; clean rows are under the null reason."""
    return checked.groupBy(REASON).agg(F.count("*").alias("row_count"))


def audit_row(checked: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """One row: run_time, total_rows, valid_rows, quarantine_rows."""
    return checked.agg(
        F.count("*").alias("total_rows"),
        F.expr(f"count_if({REASON} IS NULL) AS valid_rows"),
        F.expr(f"count_if({REASON} IS NOT NULL) AS quarantine_rows"),
    ).selectExpr(f"{moment(as_of)} AS run_time", "*")


def observed(checked: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame, counting its rows on their way to whatever writes them, and the counts.

    No row is read for them: :func:`observed_row` has them once the write is done. A task
    that fails and runs again counts once. For that nothing may be shuffled between here
    and the write: a shuffle's own tasks may run again after they counted.
    """
    counts = Observation()
    passed = f"count_if({REASON} IS NULL) AS valid_rows", f"count_if({REASON} IS NOT NULL) AS quarantine_rows"
    return checked.observe(counts, F.expr("count(*) AS total_rows"), *map(F.expr, passed)), counts


def observed_row(spark: SparkSession, counts: Observation, as_of: datetime | str | None = None) -> DataFrame:
    """The row of :func:`audit_row`, from the counts of a write that is done."""
    found = ", ".join(f"{counts.get[name]}L AS {name}" for name in ("total_rows", "valid_rows", "quarantine_rows"))
    return spark.sql(f"SELECT {moment(as_of)} AS run_time, {found}")


# JSON object of reason to count over rows of reason_counts, as bounded as the
# rules are. Null cannot be a map key: clean rows are left out.
_BREAKDOWN = f"""to_json(map_from_entries(sort_array(
    collect_list(struct({REASON}, row_count)) FILTER (WHERE {REASON} IS NOT NULL)
))) AS quarantine_breakdown"""


def breakdown_json(checked: DataFrame) -> DataFrame:
    """One row with the object of reason to count, reasons in order."""
    return reason_counts(checked).agg(F.expr(_BREAKDOWN))


def run_summary(checked: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """One row: run_timestamp, three counts and the breakdown, in one pass."""
    return reason_counts(checked).agg(
        F.expr("coalesce(sum(row_count), 0L) AS total_rows_read"),
        F.expr(f"coalesce(sum(row_count) FILTER (WHERE {REASON} IS NULL), 0L) AS valid_rows"),
        F.expr(f"coalesce(sum(row_count) FILTER (WHERE {REASON} IS NOT NULL), 0L) AS quarantined_rows"),
        F.expr(_BREAKDOWN),
    ).selectExpr(f"{moment(as_of)} AS run_timestamp", "*")
