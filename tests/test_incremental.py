from pyspark.sql import functions as F

from foliosift.streaming.incremental import arriving, pending, process_available, processed

SCHEMA = "application_number string, title string"


def land(spark, path, *numbers):
    rows = [(str(n), f"title {n}") for n in numbers]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def numbers(df):
    return sorted(int(row.application_number) for row in df.collect())


def test_only_new_arrivals_are_processed(spark, tmp_path):
    landing, out, position = (str(tmp_path / name) for name in ("landing", "out", "position"))
    seen = []

    def transform(batch):
        seen.extend(numbers(batch))
        return batch.withColumn("title", F.upper("title"))

    def run():
        process_available(arriving(spark, landing, SCHEMA, files_per_batch=1), transform, out, position)
        return numbers(processed(spark, out))

    land(spark, landing, 1, 2)
    land(spark, landing, 3)
    assert run() == [1, 2, 3] and sorted(seen) == [1, 2, 3]
    assert run() == [1, 2, 3] and len(seen) == 3
    land(spark, landing, 4)
    assert run() == [1, 2, 3, 4] and len(seen) == 4
    assert processed(spark, out).filter("title = 'TITLE 4'").count() == 1


def test_failed_batch_runs_again_without_repeats(spark, tmp_path):
    landing, out, position = (str(tmp_path / name) for name in ("landing", "out", "position"))
    land(spark, landing, 1, 2)
    land(spark, landing, 3)
    calls = []

    def fails_after_writing(batch):
        calls.append(1)
        if len(calls) == 2:
            # The output of this batch is written, but the run ends before it counts.
            batch.write.mode("overwrite").parquet(f"{out}/batch_id=1")
            raise RuntimeError("lost")
        return batch

    try:
        process_available(arriving(spark, landing, SCHEMA, files_per_batch=1), fails_after_writing, out, position)
        raise AssertionError("the run should have failed")
    except Exception as failure:
        assert "lost" in str(failure)
    process_available(arriving(spark, landing, SCHEMA, files_per_batch=1), lambda b: b, out, position)
    assert numbers(processed(spark, out)) == [1, 2, 3]


def test_pending(spark):
    apps = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "c"), (None, "d")], SCHEMA)
    done = spark.createDataFrame([("2", "x"), ("2", "y"), ("9", "z")], SCHEMA)
    assert sorted(row.title for row in pending(apps, done).collect()) == ["a", "d"]
