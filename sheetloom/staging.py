"""Written intermediate tables that outlive the loss of an executor.

Where an operator needs a result fixed before it goes on (row positions, a
landed sheet), the rows are written as parquet below the shared folder named by
``spark.checkpoint.dir`` and read back. Reading them again prunes columns and
skips row groups, which a checkpointed RDD cannot.
"""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder for staged tables, from the session; a temporary one only in local mode."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _local_folders:
        made = tempfile.mkdtemp(prefix="sheetloom-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        _local_folders[sc.applicationId] = made
    return _local_folders[sc.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/sheetloom/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return it as read from there."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Delete everything this application has staged."""
    path = spark._jvm.org.apache.hadoop.fs.Path(
        f"{shared_folder(spark)}/sheetloom/{spark.sparkContext.applicationId}"
    )
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
