"""Several tables written and read as one: readers see all of them or none.

Each table is written as new files in its own folder.  A manifest beside the directory,
written last and in one file, names the files, columns and row counts of every table.
Readers go by the newest manifest, so a run that fails half-way changes nothing for them.
Files that no longer belong to the set are removed after the manifest is there.

One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

MANIFEST = "version bigint, name string, format string, columns string, n_rows bigint, files array<string>"


def write_set(
    tables: Mapping[str, DataFrame],
    directory: str,
    file_format: str,
    stored_as: Callable[[DataFrame], DataFrame] = lambda frame: frame,
    **options: str | bool,
) -> int:
    """Write all tables in one of Spark's file formats and return the version they are.

    ``stored_as`` gives the text form of a table where the format needs one; readers get
    the types the table had before.
    """
    spark = next(iter(tables.values())).sparkSession
    version = 1 + max((r.version for r in _newest(spark, directory)), default=0)
    rows = []
    for name, frame in tables.items():
        folder = f"{directory}/{name}.{file_format}"
        there = set(_files(spark, folder))
        seen = Observation()
        stored = stored_as(frame).observe(seen, F.count(F.lit(1)).alias("n"))
        stored.write.mode("append").options(**options).format(file_format).save(folder)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)
        rows.append((version, name, file_format, columns, seen.get.get("n", 0), sorted(set(_files(spark, folder)) - there)))
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").json(_manifest(directory))
    for _, name, _, _, _, files in rows:
        _remove_others(spark, f"{directory}/{name}.{file_format}", set(files))
    return version


def read_set(spark: SparkSession, directory: str, **options: str | bool) -> dict[str, DataFrame]:
    """The tables of the newest version by name.  No version: ``FileNotFoundError``."""
    newest = _newest(spark, directory)
    if not newest:
        raise FileNotFoundError(f"No complete set of tables in {directory}")
    return {
        r.name: spark.read.schema(r.columns).options(**options).format(r.format).load(
            [f"{directory}/{r.name}.{r.format}/{f}" for f in r.files]
        )
        if r.files
        else spark.createDataFrame([], r.columns)
        for r in newest
    }


def set_counts(spark: SparkSession, directory: str) -> dict[str, int]:
    """The rows of each table of the newest version, as counted while they were written."""
    return {r.name: r.n_rows for r in _newest(spark, directory)}


def _manifest(directory: str) -> str:
    return f"{directory.rstrip('/')}.manifest"


def _newest(spark: SparkSession, directory: str) -> list:
    """The rows of the newest manifest: one per table of the set."""
    if not _files(spark, _manifest(directory)):
        return []
    told = spark.read.schema(MANIFEST).json(_manifest(directory))
    return told.filter(F.col("version") == told.agg(F.max("version")).scalar()).orderBy("name").collect()


def _open(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _files(spark: SparkSession, folder: str) -> list[str]:
    """Names of the data files in a folder; none if there is no folder."""
    path, system = _open(spark, folder)
    if not system.exists(path):
        return []
    names = [status.getPath().getName() for status in system.listStatus(path) if status.isFile()]
    return [name for name in names if not name.startswith(("_", "."))]


def _remove_others(spark: SparkSession, folder: str, files: set[str]) -> None:
    path, system = _open(spark, folder)
    for name in set(_files(spark, folder)) - files:
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(path, name), False)
