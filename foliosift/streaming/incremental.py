"""Process what is new, once."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from foliosift.session import written
from foliosift.sources.applications import append_batch


def pending(apps, done, key="application_number"):
    """Applications that have no row in ``done`` yet.

    Finished keys are reduced to one row each and stored, so repeated keys cost nothing
    in the join and AQE can split a key that many applications share.
    """
    finished = written(done.select(F.col(key).alias("_done")).distinct(), "done")
    return apps.join(finished, F.col(key) == F.col("_done"), "left_anti")


def latest(rows, key="application_number"):
    """Rows of the last batch that has any for their key; ``rows`` has ``batch_id``.

    An application that was pending has rows of several batches; the last ones hold.
    """
    last = rows.groupBy(F.col(key).alias("_key")).agg(F.max("batch_id").alias("_last"))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("batch_id") == F.col("_last"))
    return rows.join(written(last, "last"), same, "left_semi")


def process_pending(apps, transform, done, out, batch_id):
    """Run ``transform`` on what is not done yet and store it as batch ``batch_id``.

    ``done`` tells which stored rows count as finished. Applications and payloads may arrive
    in any order: what waits for a payload is tried again with each batch. A batch that runs
    again leaves out its own former output, so it replaces it with the same rows.
    """
    spark = apps.sparkSession
    earlier = stored_batches(spark, out)
    if earlier is not None:
        apps = pending(apps, done(latest(earlier.filter(F.col("batch_id") < batch_id))))
    append_batch(transform(apps), out, batch_id)


def stored_batches(spark, out):
    """All stored rows with their ``batch_id``; none before the first batch."""
    try:
        return spark.read.option("basePath", out).parquet(f"{out}/batch_id=*")
    except AnalysisException as reason:
        if reason.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def arriving(spark, path, schema, files_per_batch=None, pattern=None):
    """Stream of the Parquet files that land in a folder."""
    stream = spark.readStream.schema(schema)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        stream = stream.option("pathGlobFilter", pattern)
    return stream.parquet(path)


def process_available(stream, transform, out, checkpoint):
    """Run ``transform`` on everything that has arrived since the last run, then stop.

    Each micro-batch owns one folder of ``out`` and replaces it, so a batch that runs
    again after a failure leaves the same rows. The stream checkpoint keeps the position.
    """

    def write(batch, batch_id):
        append_batch(transform(batch), out, batch_id)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def processed(spark, out, schema=None):
    """All rows written by the batches so far."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(out).drop("batch_id")
