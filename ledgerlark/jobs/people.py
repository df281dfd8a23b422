"""Cleaning and validating rows about people that arrive as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlark.functions import title_case

# The reasons.  The name rule is tested before the age is parsed.
NAME_MISSING = "validation error"
AGE_NOT_A_NUMBER = "parsing error"


def normalise_contacts(rows: DataFrame) -> DataFrame:
    """``raw_name`` as "Last, First" and ``raw_email`` to tidy columns.

    Runs of letters are capitalised one by one; an e-mail is valid if it has an ``@``.
    """
    parts = rows.selectExpr(
        "*",
        "trim(get(split(trim(raw_name), ','), 0)) AS _last",
        "trim(get(split(trim(raw_name), ','), 1)) AS _first",
        "lower(trim(raw_email)) AS email",
    )
    return parts.select(
        *[c for c in rows.columns if c not in ("raw_name", "raw_email")],
        title_case("_last").alias("last"),
        title_case("_first").alias("first"),
        "email",
        F.contains("email", F.lit("@")).alias("is_valid"),
    )


def validated(rows: DataFrame) -> DataFrame:
    """``name``, ``age`` (text) and ``email`` with a parsed age and the reason to refuse."""
    return rows.withColumns(
        {
            "age_years": F.expr(
                r"IF(age RLIKE '^\\s*[+-]?[0-9]+\\s*$', try_cast(trim(age) AS bigint), NULL)"
            ),
        }
    ).withColumn(
        "reason",
        F.expr(
            f"CASE WHEN coalesce(name, '') = '' THEN '{NAME_MISSING}' "
            f"WHEN age_years IS NULL THEN '{AGE_NOT_A_NUMBER}' END"
        ),
    )


def accepted(rows: DataFrame) -> DataFrame:
    return validated(rows).filter("reason IS NULL").drop("age", "reason").withColumnRenamed(
        "age_years", "age"
    )


def quarantined(rows: DataFrame) -> DataFrame:
    """Refused rows as they came, with the reason."""
    return validated(rows).filter("reason IS NOT NULL").drop("age_years")


def load_summary(rows: DataFrame) -> DataFrame:
    return validated(rows).selectExpr(
        "count_if(reason IS NULL) AS succeeded", "count_if(reason IS NOT NULL) AS failed"
    )


def write_validated(rows: DataFrame, good_path: str, bad_path: str) -> None:
    """Write accepted rows and the quarantine as two Parquet tables."""
    accepted(rows).write.mode("overwrite").parquet(good_path)
    quarantined(rows).write.mode("overwrite").parquet(bad_path)


def with_email_reason(rows: DataFrame) -> DataFrame:
    return rows.withColumn(
        "reason",
        F.expr(
            "CASE WHEN email IS NULL THEN 'MissingFieldError' "
            "WHEN NOT contains(email, '@') THEN 'InvalidFormatError' END"
        ),
    )
