"""Session settings and the shared folder for written intermediate tables."""

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Small record batches keep the memory of the Python workers flat: one record is a
# whole XML document.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


def local_session(cores="*", shuffle_partitions=8, memory="8g"):
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("foliosift")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@functools.cache
def _local_folder(application):
    return tempfile.mkdtemp(prefix="foliosift-")


def scratch_folder(spark):
    """Folder for what this session stores between steps.

    It lies in the shared folder that ``spark.checkpoint.dir`` names. A machine-local folder
    serves only a local session that names none; the session's own settings stay as they are.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = _local_folder(context.applicationId)
    return f"{shared.rstrip('/')}/foliosift-{context.applicationId}"


def scratch_path(spark, label):
    """A new path in the folder of this session."""
    return f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove_scratch(spark):
    """Delete everything that this session has stored between steps.

    For the end of a run whose results are written: tables that have not been read yet may
    still need it.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spread(df, key):
    """``df`` over all cores when its files are fewer than the cores.

    For work that costs far more than reading, such as parsing. An input of more splits
    than cores, the usual case, stays as it is and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def written(df, label):
    """Write ``df`` once to the shared folder and return the stored table.

    Later branches read it by column instead of computing ``df`` again, and a lost
    executor costs no recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
