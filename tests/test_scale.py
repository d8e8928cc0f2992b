"""Hot strata, many classes, packing, components, resumed runs and dialects against plain versions."""

import gzip
import heapq
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from speclake.functions import documents
from speclake.functions import scalars as S
from speclake.operators import components, evaluation, learning, manifest, records, references, sampling, vectors
from speclake.sources import tables
from speclake.streaming import landing


def scored(spark, df, identity, seed):
    return {r[0]: r[1] for r in df.select(identity, S.score(F.col(identity).cast("string"), seed)).collect()}


@pytest.mark.parametrize("limit", [0, 1, 5, 1500, 2400, 9999])
def test_lowest_of_a_hot_stratum(spark, limit):
    """One stratum holds nearly all rows; the budget may end at a range's border, inside of it, or beyond all rows."""
    rows = [(f"r{i}", "hot" if i % 10 else None if i % 20 else f"s{i % 3}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id string, s string")
    score, strata = scored(spark, df, "id", 3), defaultdict(list)
    for i, s in rows:
        strata[s].append(i)
    want = {i for ids in strata.values() for i in sorted(ids, key=lambda x: (score[x], x))[:limit]}
    for given in (df.withColumn("k", F.lit(limit)), df):
        for digits in (1, 4):
            got = [r["id"] for r in sampling.lowest(given, ["s"], "k" if "k" in given.columns else limit, 3, "id", digits=digits).collect()]
            assert len(got) == len(set(got)) and set(got) == want


def test_lowest_without_a_limit_or_rows(spark):
    df = spark.createDataFrame([("a", "x", None), ("b", "y", 1), ("c", "y", 1)], "id string, s string, k long")
    assert {r.s for r in sampling.lowest(df, ["s"], "k", 1, "id").collect()} == {"y"}
    assert sampling.lowest(df.limit(0), ["s"], "k", 1, "id").count() == 0


@pytest.mark.parametrize("minimum", [40, 1200])
def test_topup_takes_present_rows_first(spark, minimum):
    rows = [(f"p{i}", "F" if i % 20 else "G") for i in range(2000)]
    df = spark.createDataFrame(rows, "id string, family string")
    base = df.filter("int(substring(id, 2)) % 3 = 0").select("id")
    score, there = scored(spark, df, "id", 5), {r.id for r in base.collect()}
    want = set()
    for f in "FG":
        want |= set(sorted((i for i, g in rows if g == f), key=lambda x: (x not in there, score[x], x))[:minimum])
    got = records.topup(df, base, "family", "id", minimum, 5).collect()
    assert {r.id for r in got} == want and all(r.in_base == (r.id in there) for r in got)


def greedy(sizes, shards):
    heap = [(0, i) for i in range(shards)]
    loads = [0] * shards
    for size in sorted(sizes, reverse=True):
        load, i = heapq.heappop(heap)
        loads[i] = load + size
        heapq.heappush(heap, (loads[i], i))
    return loads


def test_packing_balances_like_one_group_at_a_time():
    rng = random.Random(7)
    for _ in range(300):
        sizes = [rng.choice([1, 1, 1, 2, 3, rng.randint(1, 40), 100]) for _ in range(rng.randint(1, 200))]
        shards = rng.randint(1, min(len(sizes), 17))
        counts = sorted(Counter(sizes).items(), reverse=True)
        dealt = sampling.packed(counts, shards)
        loads = [0] * shards
        for (size, count), part in zip(counts, dealt, strict=True):
            assert sum(n for _, n in part) == count
            for i, n in part:
                loads[i] += size * n
        assert loads == greedy(sizes, shards)
    (ones,) = sampling.packed([(1, 10**9)], 1000)  # a thousand million groups take no longer
    assert {n for _, n in ones} == {10**6}


def test_shards_and_their_index(spark):
    rows = [(f"r{i}", None if i % 50 == 0 else f"g{i * i % 97}") for i in range(700)]
    df = spark.createDataFrame(rows, "record_id string, g string")
    for width in (1, 64):
        got = sampling.assign_shards(df, "g", 60, width)
        by = defaultdict(set)
        for r in got.collect():
            by[r.g].add(r.shard_id)
        assert got.count() == 700 and all(len(x) == 1 for x in by.values())
        index = {r.shard_id: r for r in sampling.shard_index(got, "g").collect()}
        sizes = Counter(g for _, g in rows)
        assert sorted(r["rows"] for r in index.values()) == sorted(greedy(sizes.values(), 12)) and sum(r["groups"] for r in index.values()) == len(sizes)
    assert sampling.assign_shards(df.limit(0), "g", 10).count() == 0


def test_components_equal_brute_force(spark):
    rng = random.Random(2)
    links = [(f"n{rng.randint(0, 150)}", f"n{rng.randint(0, 150)}") for _ in range(110)] + [(f"c{i}", f"c{i + 1}") for i in range(60)] + [("hub", f"x{i}") for i in range(500)] + [(None, "n1"), ("own", "own")]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in links:
        if a is not None:
            lo, hi = sorted((find(a), find(b)))
            root[hi] = lo
    got = components.components(spark.createDataFrame(links, "a string, b string"))
    assert {r.node: r.root for r in got.collect()} == {x: find(x) for x in root}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_component_mode_does_not_leak(spark):
    """Specimens linked by copies: the default mode parts them, the component mode keeps them in one split."""
    rows = [(f"r{i}", "m", f"sp{i // 2}", f"dup{i // 3}" if i % 3 else "", "Aus bus", "CC0") for i in range(300)]
    t = spark.createDataFrame(rows, "source_record_id string, source string, specimen_group_id string, duplicate_group_id string, species string, image_license string")
    leaks = lambda m: sum(evaluation.leaks(m.filter(F.col(g) != ""), g).count() for g in ("specimen_group_id", "duplicate_group_id"))
    assert leaks(manifest.build_master(t)) > 0
    whole = manifest.build_master(t, group_mode="component")
    assert leaks(whole) == 0 and whole.count() == 300
    assert {r.split for r in whole.select("split").collect()} <= {"train", "val", "test"}
    with pytest.raises(ValueError):
        manifest.build_master(t, group_mode="other")


def test_heads_are_at_the_optimum():
    """The gradient of the stated objective vanishes, for random labels and for classes of one row."""
    rng = np.random.default_rng(4)
    for n, dim, classes in ((500, 64, 10), (60, 3, 2), (40, 5, 40)):
        x = rng.normal(size=(n, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y = np.arange(n) % classes if classes == n else rng.integers(0, classes, n)
        weights = learning.balanced(y, y % 3)
        w, b = learning.fit_softmax(x, y, weights, classes)
        share, ridge = weights / weights.sum(), (2 if classes == 2 else 1) / (2.0 * weights.sum())
        _, g = learning.softmax_loss(np.hstack([w, b[:, None]]), np.hstack([x, np.ones((n, 1))]), y, share, ridge)
        assert np.abs(g).max() < 1e-6
        # The same by the losses themselves: a step in any direction costs.
        loss = lambda v: learning.softmax_loss(v, np.hstack([x, np.ones((n, 1))]), y, share, ridge)[0]
        at = np.hstack([w, b[:, None]])
        assert all(loss(at + 1e-2 * rng.normal(size=at.shape)) > loss(at) for _ in range(20))


def test_two_classes_are_one_logistic_curve():
    """Coefficients' difference minimises C times the weighted losses plus half its square."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(80, 2))
    y = (x[:, 0] + rng.normal(size=80) > 0).astype(int)
    w, b = learning.fit_softmax(x, y, np.ones(80), 2)
    v, c = w[1] - w[0], b[1] - b[0]
    p = 1 / (1 + np.exp(-(x @ v + c)))
    assert np.abs(v + 2.0 * ((p - y) @ x)).max() < 1e-4 and abs((p - y).sum()) < 1e-4


def test_weights():
    got = learning.balanced(np.array([0, 0, 0, 1]), np.array([0, 0, 0, 1]))
    assert got[3] > got[0] and got.min() >= 0.1 and got.max() <= 10
    assert learning.balanced(np.array([0] * 10_000 + [1]), np.array([0] * 10_000 + [1])).max() == 10


@pytest.fixture(scope="module")
def taxa(spark):
    rng = np.random.default_rng(8)
    mids = rng.normal(size=(12, 6))
    rows = []
    for i in range(360):
        k = i % 12
        v = mids[k] + 0.4 * rng.normal(size=6)
        rows.append((str(i), f"s{i % 3}", f"F{k % 3}", f"G{k % 6}", f"Aus s{k}", "AB"[i % 2], ("train", "train", "val", "test")[i // 12 % 4], "", [float(x) for x in v]))
    return spark.createDataFrame(rows, "record_id string, source string, family string, genus string, species string, label_quality string, split string, source_split string, embedding array<double>")


def test_heads_in_groups_and_over_all_executors_agree(taxa):
    small = {(r.rank, r.parent, r.taxon): r for r in learning.train_heads(taxa).collect()}
    large = {(r.rank, r.parent, r.taxon): r for r in learning.train_heads(taxa, cells=0).collect()}
    assert set(small) == set(large) and len(small) == 3 + 6 + 12
    for key, r in small.items():
        assert np.abs(np.array(r.coefficients) - large[key].coefficients).max() < 1e-3 and abs(r.threshold - large[key].threshold) < 1e-9


def test_heads_need_two_classes_below_a_known_one(spark, taxa):
    lone = taxa.filter("family <> 'F2' OR genus = 'G2'")  # F2 keeps one genus, so it has no head, nor have its species
    found = learning.train_heads(lone).select("rank", "parent").distinct().collect()
    assert not any(r.parent.startswith("F2") for r in found)


def test_predictions_by_routing_equal_those_by_broadcast(taxa):
    heads = learning.train_heads(taxa)
    one = sorted(map(str, learning.predict_hierarchical(taxa, heads).collect()))
    assert sorted(map(str, learning.predict_hierarchical(taxa, heads, bound=0).collect())) == one
    best = learning.accepted(learning.predict_hierarchical(taxa, heads, bound=0)).join(taxa.select("record_id", "family"), "record_id")
    hits = best.filter(F.get("candidates", 0)["taxon"] == F.col("family")).count()
    assert hits > 200


def test_blocks_of_classes_and_copies_of_heads_change_nothing(spark):
    rng = np.random.default_rng(3)
    heads = spark.createDataFrame([(p, f"t{i:03}", [float(x) for x in rng.normal(size=4)], 0.1 * i, [1.0, 0.0, 0.0, 0.0], -1.0 if i % 2 else 0.9) for p in ("", "hot") for i in range(40)], "parent string, taxon string, coefficients array<double>, intercept double, centroid array<double>, threshold double")
    rows = spark.createDataFrame([(i, "hot" if i % 10 else "" if i % 20 else "none", [float(x) for x in rng.normal(size=4)]) for i in range(300)], "row long, parent string, v array<double>")
    want = sorted(map(str, learning.ask_heads(rows, heads, 5).collect()))
    assert sorted(map(str, learning.ask_heads(rows, heads, 5, block=7, spread=50).collect())) == want and len(want) == 285


def test_evaluation(taxa):
    heads = learning.train_heads(taxa.filter("split = 'train'"))
    got = evaluation.evaluate(taxa, heads)
    metrics = {(r["rank"], r["parent"], r["dimension"], r["value"]): r for r in got.metrics.collect()}
    assert metrics["family", "", "all", ""]["n"] == 168 and metrics["family", "", "split", "test"]["n"] == 84 and not any(k[2] == "source_split" for k in metrics)
    assert sum(r["n"] for k, r in metrics.items() if k[0] == "genus" and k[2] == "all") == 168
    means = {(r["rank"], r["dimension"], r["value"]): r for r in got.means.collect()}
    genus = [r for k, r in metrics.items() if k[0] == "genus" and k[2:] == ("split", "test")]
    assert means["genus", "split", "test"]["rate1"] == pytest.approx(sum(r["top1"] for r in genus) / sum(r["n"] for r in genus), abs=1e-6)
    wrong = got.confusions.collect()
    assert sum(r["n"] for r in wrong if r["rank"] == "family") == 168 - metrics["family", "", "all", ""]["top1"] and all(r["truth"] != r["predicted"] for r in wrong)
    assert evaluation.evaluate(taxa.repartition(3), heads).digest == got.digest != evaluation.evaluate(taxa.limit(50), heads).digest


def test_search_of_many_queries(spark):
    rows = [(i, [float(i % 7), float(i % 5), 1.0]) for i in range(50)] + [(7, [9.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0]), (60, None)]
    index = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = index.unionAll(index.filter("vec_id = 3"))
    want = sorted(vectors.nearest(asked, index, 3).collect())
    assert {r.query_id for r in want} == set(range(50)) and len(want) == 150 and all(r.id is not None for r in want)
    for cell in (7, 1000):
        assert sorted(vectors.nearest(asked, index, 3, bound=0, cell=cell).collect()) == want
    assert vectors.nearest(asked.limit(0), index, 3).count() == vectors.nearest(asked, index.limit(0), 3, bound=0).count() == 0


def test_stores_match_their_metadata(spark):
    v = spark.createDataFrame([("a", [1.0]), ("b", [2.0])], "k string, embedding array<double>")
    about = spark.createDataFrame([("a", "F"), ("b", "G")], "k string, family string")
    assert vectors.with_metadata(v, about, "k").count() == 2
    for bad in (about.limit(1), about.unionAll(about)):
        with pytest.raises(ValueError, match="alone|repeated"):
            vectors.with_metadata(v, bad, "k")
    a, b = about.join(v, "k"), about.join(v, "k").filter("k = 'b'")
    fused, digest = vectors.fuse_cohorts(a, b, "k")
    assert [r.k for r in fused.collect()] == ["b"] and digest == vectors.fuse_cohorts(b, a, "k")[1]
    with pytest.raises(ValueError, match="differs:family"):
        vectors.fuse_cohorts(a, b.withColumn("family", F.lit("H")), "k")


def test_embedding_goes_on_where_it_ended(spark, tmp_path):
    asked = str(tmp_path / "asked")

    def encoder(contents):
        with open(asked, "a") as f:
            f.write("x" * len(contents))
        if any(c == b"bad" for c in contents):
            raise ValueError("bad")
        return np.array([[len(c)] for c in contents], float)

    calls = lambda: len(open(asked).read()) if (tmp_path / "asked").exists() else 0
    t = spark.createDataFrame([(f"r{i}", f"text {i}", i % 3) for i in range(30)], "record_id string, text string, shard int")
    go = lambda df, settings="one", **more: learning.embed_shards(df, "shard", encoder, "text", {"model": settings}, str(tmp_path / "out"), **more)
    assert go(t).count() == 30 and calls() == 30
    assert go(t).count() == 30 and calls() == 30  # nothing is left to do
    changed = t.withColumn("text", F.when(F.col("record_id") == "r1", "other").otherwise(F.col("text")))
    assert {r.record_id: r.embedding for r in go(changed).collect()}["r1"] == [5.0] and calls() == 40  # one shard anew
    with pytest.raises(ValueError, match="other settings"):
        go(t, "two")
    assert go(t, "two", force=True).count() == 30 and calls() == 70
    broken = t.withColumn("text", F.when(F.col("shard") == 2, "bad").otherwise(F.col("text")))
    assert go(broken, "two").filter("embedding IS NULL").count() == 10
    state = {r.shard: r.complete for r in learning.shard_runs(spark, str(tmp_path / "out")).collect()}
    assert state == {"0": True, "1": True, "2": False}
    assert go(t, "two").filter("embedding IS NULL").count() == 0


def test_dialect_is_told_from_the_header(spark, tmp_path):
    with gzip.open(tmp_path / "obs.csv.gz", "wt") as f:
        f.write('observation_uuid\ttaxon_id\nu1\t"47\n')
    (tmp_path / "semi.txt").write_text('id,name\n1,"a, b"\n')
    (tmp_path / "one.csv").write_text("id\n1\n")
    (tmp_path / "empty.csv").write_text("")
    assert [tuple(r) for r in tables.read_table(spark, str(tmp_path / "obs.csv.gz")).collect()] == [("u1", '"47')]
    assert [tuple(r) for r in tables.read_table(spark, str(tmp_path / "semi.txt")).collect()] == [("1", "a, b")]
    assert tables.read_table(spark, str(tmp_path / "one.csv")).columns == ["id"]
    assert tables.read_table(spark, str(tmp_path / "empty.csv")).count() == 0


def test_values_in_the_row(spark):
    t = spark.createDataFrame([(1, ["b", "A", " ", "a", "B", "c"]), (2, []), (3, None), (4, [" "]), (5, ["x"] * 20_000 + ["y"])], "id int, v array<string>")
    assert {r.id: r.v for r in records.first_seen_values(t, "id", "v").collect()} == {1: ["b", "A", "c"], 5: ["x", "y"]}
    said = spark.createDataFrame([("abca",), ("",), (None,), ("é𝄞",)], "text string").select(documents.character_spread("text").alias("s")).select("s.*").collect()
    assert [(r.n, r.entropy and round(r.entropy, 6)) for r in said] == [(4, 1.5), (0, None), (0, None), (2, 1.0)]


def test_entries_for_all_questions(spark):
    entries = [(f"e{i:02}", [], [], None, f"u{i}") for i in range(30)] + [("own", ["Ausidae"], [], None, "o"), ("by genus", [], ["Aus"], None, "g")]
    catalog = spark.createDataFrame(entries, "title string, families array<string>, genera array<string>, doi string, url string")
    asked = spark.createDataFrame([("1", "Ausidae", ["Aus"]), ("2", "Other", [])], "record_id string, family string, genera array<string>")
    got = defaultdict(list)
    for r in references.recommend(asked, catalog).orderBy("record_id", "nth").collect():
        got[r.record_id].append(r.title)
    assert got["1"] == ["by genus", *[f"e{i:02}" for i in range(11)]] and got["2"] == ["by genus", *[f"e{i:02}" for i in range(11)]]
    assert references.matches(asked, catalog, "record_id", "title").count() == 2 * 31 + 1
    found = spark.createDataFrame([("2", "", f"u{i}", f"z{i}", 100.0) for i in (0, 1, 5)] + [("1", "", "u3", "z3", 101.0)], "record_id string, doi string, url string, title string, score double")
    got = defaultdict(list)
    for r in references.recommend(asked, catalog, found).orderBy("record_id", "nth").collect():
        got[r.record_id].append(r.title)
    assert got["2"] == ["by genus", *[f"e{i:02}" for i in range(30) if i not in (0, 1, 5)][:11]]
    assert got["1"] == ["by genus", "z3", *[f"e{i:02}" for i in range(11) if i != 3]]


def test_first_seen_knows_null_keys(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in ([(None, "a"), (1, "b")], [(None, "c"), (2, "d")]):
        spark.createDataFrame(part, "id int, x string").coalesce(1).write.mode("append").parquet(folder)
        got = landing.first_seen(landing.landed(spark, folder), ["id"], out)
    assert sorted((r.id or 0, r.x) for r in got.collect()) == [(0, "a"), (1, "b"), (2, "d")]


def test_state_is_forgotten_and_late_rows_are_dropped(spark, tmp_path):
    """Four batches: a key comes again within the horizon, then after it; a row comes too late."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    batches = [[("a", 1), ("b", 1)], [("a", 2), ("c", 9)], [("d", 20)], [("a", 21), ("e", 2), ("d", 21)]]
    for part in batches:
        spark.createDataFrame(part, "k string, day int").select("k", F.timestamp_seconds(F.col("day") * 86400).alias("ts")).coalesce(1).write.mode("append").parquet(folder)
        got = landing.first_within(landing.landed(spark, folder, 1), ["k"], "ts", "3 days", out)
    assert sorted(r.k for r in got.collect()) == ["a", "a", "b", "c", "d"]  # a anew on day 21; e is too late
    told = landing.progress(spark, out)
    assert told.agg(F.sum("rows"), F.sum("late")).first()[:] == (8, 1)
    assert told.agg(F.max("held")).first()[0] <= 4 and told.orderBy(F.desc("batch")).first()["held"] <= 2
