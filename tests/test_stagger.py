"""Stagger windows of sensors that share a row of state."""

from pyspark.sql import functions as F

from lanepulse.streaming import queries, stagger


def test_sensors_of_a_bucket_keep_windows_of_their_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stagger, "BUCKETS", 2)
    rows = [(s, 10 * s + k, t + s) for s in range(1, 7) for k, t in enumerate((0, 50, 100, 205))]
    schema = "uniqueId int, speed int, bezettingsgraad int, recordTimestamp timestamp"
    for n, part in enumerate((rows[::2], rows[1::2], [(99, 0, 1000)])):
        spark.createDataFrame(part, "s int, v int, t long").select(
            F.col("s").alias("uniqueId"), F.col("v").alias("speed"), F.lit(1).alias("bezettingsgraad"),
            F.timestamp_seconds("t").alias("recordTimestamp")).coalesce(1).write.parquet(str(tmp_path / f"in-{n}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in-*"))
    seen = []
    query = queries.start(
        stagger.stagger_windows(stream, 100, "300 seconds"),
        lambda b, i: seen.extend((r.uniqueId, r.windowStart.timestamp(), r.avgSpeed, r.readings) for r in b.collect()),
        str(tmp_path / "c"), trigger=None, partitions=2)
    query.awaitTermination()
    expected = [w for s in range(1, 7) for w in (
        (s, s, 10 * s, 2), (s, 100 + s, 10 * s + 2, 1), (s, 205 + s, 10 * s + 3, 1))]
    assert sorted(seen) == sorted(expected)
