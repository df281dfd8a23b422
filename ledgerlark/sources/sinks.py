"""Writers.  Each table is one Spark write job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from ledgerlark.functions import plain_number
from ledgerlark.sources.sets import write_set


def _csv_text(frame: DataFrame) -> DataFrame:
    """Doubles as plain decimal text: large amounts carry no exponent in the file."""
    return frame.select(
        *[
            plain_number(f.name).alias(f.name) if isinstance(f.dataType, DoubleType) else f.name
            for f in frame.schema.fields
        ]
    )


# Leading and trailing blanks are data and are kept; a quote inside quotes is doubled.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
}


def write_csv(
    frame: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None
) -> None:
    """CSV with a header."""
    _csv_text(frame).write.mode(mode).options(**CSV_OPTIONS).csv(path, compression=compression)


def write_summaries(
    tables: Mapping[str, tuple[DataFrame, Sequence[str]]], directory: str
) -> None:
    """Write summary tables, one folder with one CSV file each, in the given order.

    Each table comes with ascending sort expressions.  Only for results of bounded size
    (top-n lists, months, countries, thresholds): each is brought to one partition, and
    sorted there, before it is written.

    All tables become visible to ``read_set`` at once.
    """
    write_set(
        {
            name: table.coalesce(1).sortWithinPartitions(*[F.expr(e) for e in order])
            for name, (table, order) in tables.items()
        },
        directory, "csv", _csv_text, **CSV_OPTIONS,
    )


def write_chart_frames(frames: Mapping[str, DataFrame], directory: str) -> None:
    """Write the frame behind each chart as Parquet; large ones stay partitioned.

    All frames become visible to ``read_set`` at once.
    """
    write_set(frames, directory, "parquet")


def append_lines(frame: DataFrame, path: str, column: str = "value") -> None:
    frame.select(F.col(column).cast("string").alias("value")).write.mode("append").text(path)


def write_json(frame: DataFrame, path: str, mode: str = "overwrite") -> None:
    frame.write.mode(mode).json(path)
