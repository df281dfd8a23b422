"""Status breakdown of text log lines ``YYYY-MM-DD HH:MM:SS status=NNN path=/x``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlark.functions import half_even

# The log format above and the codes that count as errors.
ERRORS = ("404", "500")


def parsed(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.selectExpr(
        "*",
        f"""CASE WHEN {column} RLIKE 'status=[0-9]{{3}}(?![0-9])'
                 THEN regexp_extract({column}, 'status=([0-9]{{3}})(?![0-9])', 1)
                 WHEN {column} RLIKE 'status=[0-9]' THEN 'other' ELSE '' END AS status""",
        f"try_to_timestamp(split_part({column}, ' status=', 1), 'yyyy-MM-dd HH:mm:ss') AS happened",
    )


def status_counts(lines: DataFrame) -> DataFrame:
    return parsed(lines).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def log_summary(lines: DataFrame, position: str) -> DataFrame:
    """One row: requests, error rate, the first line's time, and all of it as JSON.

    Lines fold to one row per status before the breakdown is put together: a thousand
    three-digit codes at most, ``other`` for longer or shorter ones, and an empty name for
    lines without a status.
    """
    by_status = parsed(lines).groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"min_by(struct({position} AS p, happened), {position})").alias("f")
    )
    errors = ", ".join(f"'{code}'" for code in ERRORS)
    totals = by_status.agg(
        F.sum("n").alias("total_requests"),
        F.expr(f"sum(IF(status IN ({errors}), n, 0))").alias("errors"),
        F.expr("array_sort(collect_list(struct(status, n)))").alias("breakdown"),
        F.expr("min_by(f.happened, f.p)").alias("first_event"),
    ).withColumn("error_rate", half_even(F.try_divide("errors", "total_requests"), 2))
    return totals.select(
        "total_requests",
        "error_rate",
        F.date_format("first_event", "MMMM dd, yyyy 'at' HH:mm:ss").alias("first_event"),
        F.expr(
            "to_json(struct(total_requests, map_from_entries(breakdown) AS status_breakdown, error_rate))"
        ).alias("summary"),
    )
