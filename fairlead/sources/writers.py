"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> str:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a table's partition folders, in any order; no row is read."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    names = [f.getPath().getName() for f in found if f.isDirectory()]
    return [n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}=")]


def accumulate(spark: SparkSession, current: DataFrame, target: str, period: str, column: str = "period") -> str:
    """Add a period to the accumulation at ``target``, as the partition ``column=period``.

    Only that partition is written, and written anew if the period is run again; the
    history is neither read nor copied. ``current`` must have the columns of the history;
    an unreadable history raises.
    """
    if not period or any(c in period for c in "/= "):
        raise ValueError("a period is a plain name such as 2024-01")
    if exists(spark, target):
        have = set(spark.read.parquet(target).columns) - {column}
        if have != set(current.columns):
            raise ValueError(f"columns differ from the accumulation: {sorted(have ^ set(current.columns))}")
    current.write.mode("overwrite").parquet(f"{target.rstrip('/')}/{column}={period}")
    return target


def accumulated(spark: SparkSession, target: str, column: str = "period") -> DataFrame:
    """All periods so far; ``column`` names the period of a row, as text."""
    whole = spark.read.parquet(target)
    return whole.withColumn(column, whole[column].cast("string"))


def write_cells(cells: DataFrame, path: str) -> DataFrame:
    """Store a derived cell list once and read it back, for reuse by several jobs."""
    return cells.sparkSession.read.parquet(write_parquet(cells, path))
