"""Daily-partitioned parquet tables, by path or catalog name: pruned scans, idempotent writes."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pulsetrail.functions.dates import COMPACT, DASHED, day


def _in_catalog(name: str) -> bool:
    """A table is named by its path, or by its catalog name when there is no slash in it."""
    return "/" not in name


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting that holds for one action."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _table(spark: SparkSession, name: str) -> DataFrame:
    if _in_catalog(name):
        return spark.table(name)
    # the day is a string such as 2024-01-30 or 20240130, never a date or a number
    with _setting(spark, "spark.sql.sources.partitionColumnTypeInference.enabled", "false"):
        return spark.read.parquet(name)


def _descriptor(name: str) -> str:
    """The path of a table's descriptor: an empty parquet table with its columns, beside the table."""
    return f"{name.rstrip('/')}.columns"


def described(spark: SparkSession, name: str) -> StructType | None:
    """The columns of a table by its descriptor, or None when it has none (or is in the catalog)."""
    if _in_catalog(name):
        return None
    try:
        return spark.read.parquet(_descriptor(name)).schema
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def describe(spark: SparkSession, name: str, schema: StructType | None = None) -> None:
    """Write the descriptor of a table, from its files unless ``schema`` is given.

    The writers below do so themselves. Tables that others write need it once, and again when they get
    another column: scans read the described columns only.
    """
    schema = schema or _table(spark, name).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(_descriptor(name))


def _with_columns(spark: SparkSession, df: DataFrame, name: str, by: Sequence[str]) -> StructType | None:
    """The columns of a table once ``df`` is in it, or None when its descriptor has them already.

    New columns come after the known ones, the partition last; a known one may not change its type.
    """
    before = described(spark, name)
    known = {f.name: f.dataType for f in before} if before else {}
    for field in df.schema:
        if field.name in by or known.setdefault(field.name, field.dataType) == field.dataType:
            continue
        kinds = f"{known[field.name].simpleString()}, not {field.dataType.simpleString()}"
        raise ValueError(f"column {field.name} of {name} is {kinds}")
    for column in by:
        known.pop(column, None)
        known[column] = StringType()
    after = StructType([StructField(*item) for item in known.items()])
    return None if before == after else after


def _days(
    spark: SparkSession, name: str, days: Sequence[str], schema: str | StructType | None
) -> DataFrame:
    """Some days of a table. With the schema of its columns (``dt`` included), given or from the table's
    descriptor, only the folders of these days are listed, and none of their files is opened for it."""
    schema = schema or described(spark, name)
    if schema is None or _in_catalog(name):
        return _table(spark, name).where(F.col("dt").isin(list(days)))
    reader = spark.read.schema(schema).option("basePath", name)
    pattern = "{" + ",".join(f"dt={_escaped(d)}" for d in days) + "}"
    try:
        return reader.parquet(f"{name}/{pattern}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)  # none of the days is there


def scan_day(spark: SparkSession, path: str, dt: str, schema: str | None = None) -> DataFrame:
    """One day of a table; an absent day has no rows."""
    return _days(spark, path, [dt], schema)


def scan_days(
    spark: SparkSession, path: str, dt: str, offsets: Sequence[int], schema: str | None = None
) -> DataFrame:
    """The days at the given offsets from ``dt``."""
    return _days(spark, path, [day(dt, n) for n in offsets], schema)


def scan_range(
    spark: SparkSession, path: str, first: str, last: str, schema: str | None = None
) -> DataFrame:
    """The days from ``first`` to ``last``, both included."""
    schema = schema or described(spark, path)
    days = _range(first, last)
    if schema is None or days is None or _in_catalog(path):
        return _table(spark, path).where(F.col("dt").between(first, last))
    return _days(spark, path, days, schema)


def _range(first: str, last: str) -> list[str] | None:
    """The days from ``first`` to ``last``; None where the two are no days of one format, or in no order."""
    out = DASHED if "-" in first else COMPACT
    try:
        if first > last or day(first, 0, out) != first or day(last, 0, out) != last:
            return None
    except ValueError:
        return None
    days = [first]
    while days[-1] < last:
        days.append(day(days[-1], 1, out))
    return days


def scan_all(spark: SparkSession, path: str) -> DataFrame:
    """All days of a table."""
    return _table(spark, path)


def project_to(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Exactly the columns of a sink, in its order and with its types."""
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in schema.items()])


def write_partition(df: DataFrame, path: str, **partition: str) -> None:
    """Replace one partition, given as ``dt=...`` or ``dt=..., dtype=...``; all others stay.

    Without rows the partition is empty afterwards, whatever it held before.
    """
    spark = df.sparkSession
    rows = df.drop(*partition)
    if not _in_catalog(path):
        folder = "/".join(f"{name}={_escaped(value)}" for name, value in partition.items())
        columns = _with_columns(spark, rows, path, [*partition])
        rows.write.mode("overwrite").parquet(f"{path}/{folder}")
        if columns is not None:
            describe(spark, path, columns)
    elif spark.catalog.tableExists(path):
        columns = [c for c in spark.table(path).columns if c not in partition]
        spec = ", ".join(f"`{name}` = {_quoted(value)}" for name, value in partition.items())
        with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "static"):
            spark.sql(
                f"insert overwrite table {path} partition ({spec}) select * from {{rows}}",
                rows=rows.select(*columns),
            )
    else:
        fixed = rows.withColumns({name: F.lit(value) for name, value in partition.items()})
        fixed.write.format("parquet").partitionBy(*partition).saveAsTable(path)


def _escaped(value: str) -> str:
    """A partition value as part of a path, in the way Spark reads it back."""
    return "".join(c if c.isalnum() or c in "-_. " else f"%{ord(c):02X}" for c in value)


def _quoted(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def write_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace the partitions that occur in ``df``.

    The rebalance hint gathers each partition's rows into few files and splits the large ones.
    """
    _overwrite(df.hint("rebalance", *by), path, list(by))


def _overwrite(df: DataFrame, name: str, by: list[str]) -> None:
    spark = df.sparkSession
    with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        if not _in_catalog(name):
            columns = _with_columns(spark, df, name, by)
            df.write.mode("overwrite").partitionBy(*by).parquet(name)
            if columns is not None:
                describe(spark, name, columns)
        elif spark.catalog.tableExists(name):
            df.select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
        else:
            df.write.format("parquet").partitionBy(*by).saveAsTable(name)
