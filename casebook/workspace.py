"""Written tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
LEAST_TASKS = "spark.sql.files.minPartitionNum"

# Tasks for each core in passes over a table that many passes read, and most rows of its files. Spark
# packs files into about one task for each core; one task more than cores is a second round for all.
TASKS_PER_CORE = 4
ROWS_PER_FILE = 250_000
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder named by the session. Only a local session may fall back to this machine's disk."""
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {SETTING} to a folder that every executor can reach")
    application = spark.conf.get("spark.app.id", "local")
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="casebook-")
    return _local_folders[application]


def run_folder(spark: SparkSession) -> str:
    """The folder of this application's tables."""
    return f"{shared_folder(spark)}/casebook/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the run's folder that nothing else uses."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` once and read it back.

    The copy survives lost executors, ends the lineage, and has a size that Catalyst knows, so
    joins against it are broadcast only when it is below ``spark.sql.autoBroadcastJoinThreshold``.
    ``rows_per_file``: cut files of more rows, for tables that many passes read.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("maxRecordsPerFile", rows_per_file).partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_many_tasks(step: Callable) -> Callable:
    """A step on a table whose passes over files are cut into several tasks for each core.

    Only while the step runs, and only where the session does not say how finely files are cut.
    """

    @wraps(step)
    def run(df: DataFrame, *args, **kwargs):
        spark = df.sparkSession
        if spark.conf.get(LEAST_TASKS, None):
            return step(df, *args, **kwargs)
        spark.conf.set(LEAST_TASKS, str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
        try:
            return step(df, *args, **kwargs)
        finally:
            spark.conf.unset(LEAST_TASKS)

    return run


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once, with its partitions and their order as they are, in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def clear(spark: SparkSession) -> None:
    """Delete all tables that this application has written; results that read them must be stored by then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
