import os

import pytest
from oracle import DATA
from pyspark.sql import functions as F

from lexispark.streaming import events

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def run(spark, df, mode="append"):
    q = df.writeStream.outputMode(mode).format("memory").queryName("out").trigger(availableNow=True).start()
    q.processAllAvailable()
    q.stop()
    return spark.sql("SELECT * FROM out").collect()


def test_stream_equals_batch_and_repeats_are_dropped(spark, tmp_path):
    batch = spark.read.parquet(f"{DATA}/events.parquet")
    batch.repartitionByRange(3, "ts").write.parquet(str(tmp_path / "in"))
    batch.limit(50).write.mode("append").parquet(str(tmp_path / "in"))
    stream = events.event_stream(spark, str(tmp_path / "in"), batch.schema)
    got = run(spark, events.windowed_counts(stream, "1 day", late="60 days"), "complete")
    assert sum(r.n for r in got) == batch.count() + 50
    assert len(run(spark, events.distinct_events(events.event_stream(spark, str(tmp_path / "in"), batch.schema), "60 days"))) == batch.count()


def test_postings_by_batch(spark, tmp_path):
    spark.createDataFrame([(1, "navio rio"), (2, "rio")], "id int, t string").write.parquet(str(tmp_path / "in"))
    q = events.index_batches(spark.readStream.schema("id int, t string").parquet(str(tmp_path / "in")), "id", ["t"], str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("term").agg(F.count("*").alias("n")).where("term = 'rio'").first().n == 2
