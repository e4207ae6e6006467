"""Session set-up and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_LOCAL_DIRS: dict[str, str] = {}


def build_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hooklens")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_DIRS:
        _LOCAL_DIRS[application] = tempfile.mkdtemp(prefix="hooklens-")
    return _LOCAL_DIRS[application]


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new sub-folder name in the shared folder (never reused, nothing is overwritten)."""
    return f"{shared_dir(spark)}/hooklens/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """The table written to the shared folder and read back: runs the plan once, and later readers
    neither repeat its work nor depend on the executors that did it. `compression` is the session's, if not given."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def forget(*tables: DataFrame) -> None:
    """Delete the files of tables that `written` returned, once nothing reads them or what derives from them any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        release(spark)


def release(spark: SparkSession) -> None:
    """Let shuffle files of ended jobs go: they do with the driver's next collection of garbage, so it is asked for one."""
    spark.sparkContext._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
