"""Streams and files bound to the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from speclake.operators import sampling
from speclake.plans.register import read, registry
from speclake.sources import shared, tables
from speclake.streaming import landing

QUERIES, SQL, query = registry()


@query("SELECT DISTINCT event_id, user_id FROM events")
def st1_first_seen(spark, d):
    return landing.first_seen(landing.landed(spark, f"{d}/events.parquet*").select("event_id", "user_id"), ["event_id"], shared.shared_folder(spark))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def st2_running_counts(spark, d):
    return landing.running_counts(landing.landed(spark, f"{d}/events.parquet*"), ["event_type"], shared.shared_folder(spark))


@query("SELECT doc_id, CASE WHEN n_chars >= 500 THEN 'accept' ELSE 'review' END AS decision FROM documents")
def st3_decisions(spark, d):
    decide = lambda t: t.select("doc_id", F.when(F.col("n_chars") >= 500, "accept").otherwise("review").alias("decision"))
    return landing.decided(landing.landed(spark, f"{d}/documents.parquet*"), decide, shared.shared_folder(spark))


@query("SELECT DISTINCT user_id, event_type FROM events")
def st4_first_within(spark, d):
    """The table lands in four batches by time; keys forgotten after a day come again, so each is counted once at the end."""
    t, out = read(spark, d, "events").select("user_id", "event_type", "ts"), shared.shared_folder(spark)
    ends = t.select(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), [0.25, 0.5, 0.75], 100)).first()[0]
    part = sum((F.unix_micros(F.col("ts").cast("timestamp")) > e).cast("int") for e in ends)
    for k in range(4):
        t.filter(part == k).coalesce(1).write.mode("append").parquet(f"{out}/in")
    found = landing.first_within(landing.landed(spark, f"{out}/in", 1), ["user_id", "event_type"], "ts", "1 day", out)
    return found.select("user_id", "event_type").distinct()


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, '' AS sex FROM customer")
def s1_k1_manifest_file(spark, d):
    """An older version is there first; the last whole write is read."""
    out, rows = shared.shared_folder(spark), read(spark, d, "customer")
    tables.write_manifest(rows.filter("c_custkey % 2 = 0"), out, ["c_custkey"])
    return tables.write_manifest(rows, out, ["c_custkey", "c_name", "sex"])


@query("SELECT decision, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM (SELECT n_chars, CASE WHEN n_chars >= 500 THEN 'accepted' ELSE 'quarantine' END AS decision FROM documents) GROUP BY decision")
def k2_accepted_quarantine(spark, d):
    rows = read(spark, d, "documents").select("doc_id", "n_chars", F.when(F.col("n_chars") >= 500, "accepted").otherwise("quarantine").alias("decision"))
    return tables.write_partitioned(rows, shared.shared_folder(spark), "decision").groupBy("decision").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("""WITH RECURSIVE g AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey), h AS (SELECT n, count(*) AS c, row_number() OVER (ORDER BY n DESC) AS step FROM g GROUP BY n),
  shards AS (SELECT CAST(ceil(sum(n) / 1000.0) AS BIGINT) AS k FROM g),
  o AS (SELECT n, row_number() OVER (ORDER BY n DESC) AS place FROM g),
  steps AS (SELECT CAST(0 AS BIGINT) AS place, [CAST(0 AS BIGINT) FOR x IN range(k)] AS loads FROM shards UNION ALL
    SELECT o.place, [CASE WHEN i = list_position(loads, list_min(loads)) THEN x + o.n ELSE x END FOR x, i IN loads] FROM steps JOIN o ON o.place = steps.place + 1)
  SELECT CAST(i - 1 AS INTEGER) AS shard_id, loads[i] AS rows, 0 AS split_groups FROM (SELECT loads, unnest(range(1, len(loads) + 1)) AS i FROM steps ORDER BY place DESC LIMIT (SELECT k FROM shards))""")
def k3_shard_sink(spark, d):
    """The rows of each shard as written: as many as the emptiest shard took group by group."""
    rows = sampling.assign_shards(read(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", 1000)
    written = tables.write_partitioned(rows, shared.shared_folder(spark), "shard_id")
    index = sampling.shard_index(written, "o_custkey", "shard_id", "o_orderkey")
    whole = written.groupBy("o_custkey").agg(F.count_distinct("shard_id").alias("n")).filter("n > 1").agg(F.count("*").cast("int").alias("split_groups"))
    return index.join(F.broadcast(whole)).select("shard_id", "rows", "split_groups")  # one row
