"""A worker that embeds holds the contents of one batch of the encoder, not those of a whole batch of Spark's."""

from pyspark.sql import functions as F

from speclake.operators import learning


def test_contents_are_held_by_batch(spark):
    def traced(contents):
        """Bytes that Python's values take beyond those of the third call, when all modules are there; the row 'last' ends the tracing."""
        import tracemalloc

        if not tracemalloc.is_tracing():
            tracemalloc.start()
            tracemalloc.calls, tracemalloc.base = 0, 0
        tracemalloc.calls += 1
        now = tracemalloc.get_traced_memory()[0]
        if tracemalloc.calls == 3:
            tracemalloc.base = now
        more = now - tracemalloc.base if tracemalloc.base else 0
        if b"last" in contents:
            tracemalloc.stop()
        return [[more]] * len(contents)

    n = 15_000  # more than the 10,000 rows that Spark hands over at once
    k = F.col("id")
    t = spark.range(0, n, 1, 1).select(F.when(k > 0, k).alias("record_id"), F.when(k == n - 1, "last").otherwise(F.repeat(F.lpad(k.cast("string"), 8, "0"), 256)).alias("text"))
    got = learning.embed(t, traced, "text").collect()
    # The second batch, 5,000 rows of 2,048 bytes, is there once as Arrow's buffer, and not again as Python's values.
    assert len(got) == n and max(r["embedding"][0] for r in got) < 1.5 * 5_000 * 2_048
    assert [r["record_id"] for r in got if r["record_id"] in (None, "None", "1")] == [None, "1"]
