"""Readers.  They declare the schema and change no value beyond its type."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlark.operators.settle import settle
from ledgerlark.sources.schema import SALES_LINES

READABLE_FORMATS = ("csv", "parquet", "orc", "json")
PACKED_SUFFIXES = (".gz", ".bz2", ".zst", ".lz4", ".deflate")
CORRUPT = "_corrupt_record"
# The reason of a line that does not fit its columns, as in other validated loads.
NOT_PARSED = "parsing error"


def load_raw(
    spark: SparkSession,
    path: str,
    date_format: str | None = None,
    file_format: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Read sales lines as stored, with the declared types.

    The format follows from the suffix, in any case and before that of a compressed file
    (``.csv.gz``); ``file_format`` names it for folders without one, and ``"table"`` says that
    ``path`` is a table of the catalog.  ``date_format`` is the pattern of invoice dates in a
    CSV file that are not ISO.  ``multi_line`` is for CSV files with line breaks inside
    quotes; such a file is read by one task.

    A path or table that does not exist raises ``FileNotFoundError`` and an unknown suffix
    or format ``ValueError``.  Both are found before any row is read; a line that does not
    fit its columns fails the job that reads it, see :func:`load_with_quarantine`.  NaN
    prices become null and customer numbers become whole numbers.
    """
    kind = _format_of(spark, path, file_format)
    try:
        if kind == "table":
            return as_sales_lines(spark.read.table(path))
        reader = spark.read.schema(SALES_LINES)
        if kind in ("csv", "json"):
            reader = reader.options(mode="FAILFAST", **_text_options(date_format, multi_line))
        return as_sales_lines(reader.format(kind).load(str(path)))
    except AnalysisException as error:
        raise _as_missing(error, path) from error


def load_with_quarantine(
    spark: SparkSession,
    path: str,
    date_format: str | None = None,
    file_format: str | None = None,
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """:func:`load_raw` of a CSV or JSON source without its corrupt lines, and those lines.

    The second frame is the quarantine: ``record``, the line as it came, and ``reason``.
    The source is parsed once, into a settled copy that both frames read.
    """
    kind = _format_of(spark, path, file_format)
    if kind not in ("csv", "json"):
        raise ValueError(f"Only CSV and JSON sources have lines to refuse, not '{kind}'.")
    declared = StructType([*SALES_LINES.fields, StructField(CORRUPT, StringType(), True)])
    reader = spark.read.schema(declared).options(
        mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, **_text_options(date_format, multi_line)
    )
    try:
        parsed = settle(reader.format(kind).load(str(path)))
    except AnalysisException as error:
        raise _as_missing(error, path) from error
    refused = parsed.filter(F.col(CORRUPT).isNotNull()).select(
        F.col(CORRUPT).alias("record"), F.lit(NOT_PARSED).alias("reason")
    )
    return as_sales_lines(parsed.filter(F.col(CORRUPT).isNull())), refused


def _text_options(date_format: str | None, multi_line: bool) -> dict[str, str | bool]:
    given = {} if date_format is None else {"timestampNTZFormat": date_format}
    return {"header": True, "escape": '"', "multiLine": multi_line, **given}


def _format_of(spark: SparkSession, path: str, file_format: str | None) -> str:
    if file_format is not None:
        if file_format not in (*READABLE_FORMATS, "table"):
            raise ValueError(f"Unsupported format '{file_format}'. Use one of {', '.join(READABLE_FORMATS)}, table.")
        return file_format
    suffixes = [s.lower() for s in PurePosixPath(str(path)).suffixes]
    if suffixes and suffixes[-1] in PACKED_SUFFIXES:
        suffixes.pop()
    kind = suffixes[-1].removeprefix(".") if suffixes else ""
    if kind not in READABLE_FORMATS:
        _require_path(spark, path)
        named = ", ".join(f".{f}" for f in READABLE_FORMATS)
        raise ValueError(f"Unsupported file type '{suffixes[-1] if suffixes else ''}'. Use one of {named}.")
    return kind


def as_sales_lines(lines: DataFrame) -> DataFrame:
    """Settle the types used inside: NaN is null, CustomerID is a whole number."""
    return lines.selectExpr(
        "string(InvoiceNo) AS InvoiceNo",
        "string(StockCode) AS StockCode",
        "string(Description) AS Description",
        "int(Quantity) AS Quantity",
        "CAST(InvoiceDate AS timestamp_ntz) AS InvoiceDate",
        "IF(isnan(double(UnitPrice)), NULL, double(UnitPrice)) AS UnitPrice",
        "IF(isnan(double(CustomerID)), NULL, bigint(CustomerID)) AS CustomerID",
        "string(Country) AS Country",
    )


def read_text_rows(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Read a CSV with a header, every value as text (cast later with ``try_cast``)."""
    schema = StructType([StructField(name, StringType(), True) for name in columns])
    try:
        return spark.read.schema(schema).options(header=True, escape='"').csv(str(path))
    except AnalysisException as error:
        raise _as_missing(error, path) from error


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Read text files, one row per line without its line break."""
    try:
        return spark.read.text(str(path))
    except AnalysisException as error:
        raise _as_missing(error, path) from error


def _require_path(spark: SparkSession, path: str) -> None:
    try:
        spark.read.format("binaryFile").load(str(path)).schema
    except AnalysisException as error:
        raise _as_missing(error, path) from error


def _as_missing(error: AnalysisException, path: str) -> Exception:
    if error.getCondition() == "PATH_NOT_FOUND":
        return FileNotFoundError(f"Data file not found: {path}")
    if error.getCondition() == "TABLE_OR_VIEW_NOT_FOUND":
        return FileNotFoundError(f"Table not found: {path}")
    return error
