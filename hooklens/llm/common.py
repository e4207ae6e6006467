"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once per row, however often the body uses it.

    Lambda bodies are evaluated per element, and a column used inside one is evaluated with
    it; bound to a lambda variable it is a plain look-up.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """The table written to the shared folder and read back: later jobs neither repeat its work nor
    depend on the executors that did it. `compression` is the session's, if not given."""
    from hooklens.session import fresh_dir

    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def forget(table: DataFrame) -> None:
    """Delete the files of a table that `written` returned, once nothing reads it or what derives from it any more."""
    spark = table.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.written_to)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Without the columns of these names in any letter case, so that new ones cannot clash."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])
