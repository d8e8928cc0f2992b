"""Language-model scoring with a weighted backoff automaton."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from speclake.sources.shared import shared_base, shuffles_freed

#: The end token; no word holds white space.
END = b"\n"


def tokens(text: bytes | None) -> list[bytes]:
    """Words of a text in UTF-8, A-Z lower-cased, and one end; bytes methods know ASCII only."""
    words = (text or b"").lower().split()
    words.append(END)
    return words


def held_out(doc_id: str = "doc_id", parts: int = 7, part: int = 2):
    """True where crc32 of the id as text leaves ``part``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % parts == part


def stored(df: DataFrame, folder: str = "") -> DataFrame:
    """``df`` as a table of compressed columns in the shared checkpoint folder, or ``folder`` there; a checkpoint holds rows as they are. The shuffle files that it took are freed."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_base(df.sparkSession))
    path = f"{context.getCheckpointDir()}/{folder}/{uuid.uuid4().hex}" if folder else f"{context.getCheckpointDir()}/{uuid.uuid4().hex}"
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, folder: str) -> None:
    """Deletes the tables that were ``stored`` in ``folder``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{spark.sparkContext.getCheckpointDir()}/{folder}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Tokens:
    """Tokens of some texts, one after another, as codes of their distinct words.

    ``codes`` index ``words`` (Arrow strings; the end is the empty one), ``at`` is each token's text,
    ``last`` is true for ends, ``count`` is the number of texts. The same words as ``tokens`` gives.
    """

    def __init__(self, texts: pa.Array):
        lowered = pc.binary_join_element_wise(pc.ascii_lower(texts.view(pa.string())), "", " ")
        listed = pc.ascii_split_whitespace(pc.ascii_ltrim_whitespace(lowered))  # the blank before the end makes an empty last word
        coded = listed.flatten().dictionary_encode()
        self.words, self.codes = coded.dictionary, coded.indices.to_numpy()
        offsets = listed.offsets.to_numpy()
        self.count = len(texts)
        self.at = np.repeat(np.arange(self.count), np.diff(offsets))
        self.last = np.zeros(len(self.codes), bool)
        self.last[offsets[1:] - 1] = True

    def named(self, codes: np.ndarray | None = None) -> pa.Array:
        """The words of ``codes``, or all, in binary."""
        words = (self.words if codes is None else self.words.take(pa.array(codes))).view(pa.binary())
        return pc.if_else(pc.equal(pc.binary_length(words), 0), END, words)

    def among(self, frequent: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Each token's id, its place in ``frequent`` or -1, and the state before it: the id of the token before, or the start."""
        ids = pc.index_in(self.words, value_set=frequent).fill_null(-1).to_numpy().astype(np.int64)[self.codes]
        before = np.empty_like(ids)
        before[1:] = np.where(self.last[:-1], len(frequent), ids[:-1])
        before[:1] = len(frequent)
        return ids, before


def encoded(batches: Iterator[pa.RecordBatch], column: int = 0, rows: int = 1024, most: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, Tokens]]:
    """Slices of up to ``rows`` rows, and of up to ``most`` bytes if that is more than one text, with the tokens of their texts."""
    for batch in batches:
        texts = batch.column(column).cast(pa.binary())
        ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(), dtype=np.int64)
        start = 0
        while start < len(texts):
            fits = int(np.searchsorted(ends, most + (ends[start - 1] if start else 0), "right"))
            stop = min(start + rows, max(start + 1, fits))
            yield batch.slice(start, stop - start), Tokens(texts[start:stop].fill_null(b""))
            pa.default_memory_pool().release_unused()
            start = stop


def token_counts(docs: DataFrame, flush: int = 250_000) -> DataFrame:
    """(word binary, c): how often each token occurs. Tasks sum up before the shuffle, in tables of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        summed = lambda: pa.concat_tables(waiting).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"}).select(["word", "n"])
        for _, found in encoded(batches):
            n = np.bincount(found.codes, minlength=len(found.words))
            waiting.append(pa.table([found.named(), pa.array(n.astype(np.int64))], ["word", "n"]))
            if sum(map(len, waiting)) > 2 * flush:
                waiting = [summed()]
                if len(waiting[0]) > flush:
                    yield from waiting.pop().to_batches()
        if waiting:
            yield from summed().to_batches()

    return docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


class Automaton:
    """States and arcs of a bigram backoff model over word ids.

    A state is a word, or the start; its arcs hold log10 probabilities of the pairs that the model
    has, by absolute discounting; its failure arc leads to the empty state, whose arcs are the add-one
    unigrams, and weighs what keeps the sum at 1. Only frequent words and the most frequent arcs are
    held here, so all arrays are bounded; ``sums`` (first, n, k, mass) of all arcs weigh the failure arcs.
    """

    def __init__(self, counts: list[int], n: int, v: int, starts: int, arcs: pa.Table, sums: pa.Table, discount: float):
        self.size, self.discount = len(counts) + 1, discount
        self.uni = np.log10((np.array(counts, float) + 1) / (n + v + 1))
        seen = np.array([*counts, starts], float)
        self.seen = np.log10(np.maximum(seen, 1))
        first, total, k, mass = (sums.column(x).to_numpy() for x in ("first", "n", "k", "mass"))
        self.fail = np.zeros(self.size)
        self.fail[first] = np.log10((seen[first] - total + discount * k) / seen[first]) - np.log10((n + v + 1 - mass) / (n + v + 1))
        keys, c = (arcs.column(x).to_numpy() for x in ("pair", "n"))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.gains = self.gain(self.keys, c[order])

    def probability(self, keys: np.ndarray, c: np.ndarray) -> np.ndarray:
        """log10 of the probability of arcs that occur ``c`` times."""
        return np.log10(c - self.discount) - self.seen[keys // self.size]

    def gain(self, keys: np.ndarray, c: np.ndarray) -> np.ndarray:
        """What arcs weigh more than the failure arc and the unigram that they stand for."""
        return self.probability(keys, c) - self.fail[keys // self.size] - self.uni[keys % self.size]

    def score(self, found: Tokens, ids: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
        """For each text sums of log10 of the unigrams and of the automaton's weights, and (text, pair, how often) of the pairs of ids that have no arc here; a word without an id (-1) adds its failure arc only.

        The state after a word is that word; one sweep over (state, word) pairs follows the arc where there is one, else the failure arc.
        """
        uni, fail = np.append(self.uni, 0.0)[ids], np.append(self.fail, 0.0)[before]  # -1 takes the zero at the end
        known = (before >= 0) & (ids >= 0)
        pairs, n = np.unique((before * self.size + ids)[known] * found.count + found.at[known], return_counts=True)
        at, pairs = pairs % found.count, pairs // found.count
        weight = np.bincount(found.at, uni + fail, found.count)
        here = np.zeros(len(pairs), bool)
        if len(self.keys):
            arc = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
            here = self.keys[arc] == pairs
            weight += np.bincount(at[here], n[here] * self.gains[arc[here]], found.count)
        return np.bincount(found.at, uni, found.count), weight, (at[~here], pairs[~here], n[~here])


def pair_counts(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """(pair, n): how often each pair of frequent words occurs, the start as a first word; pair = first * (words + 1) + second."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in encoded(batches):
            ids, before = found.among(shared.value)
            pairs, n = np.unique((before * (len(shared.value) + 1) + ids)[(before >= 0) & (ids >= 0)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n.astype(np.int64))], ["pair", "n"])

    return docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


#: Stands in ``near`` for the start before a text's first word.
START = -(2**31)


def beside(found: Tokens, ids: np.ndarray, before: np.ndarray, frequent: int, apart: bool) -> tuple[tuple, tuple]:
    """The words without an id and the pairs that they stand in, each under one word, so that a pair's occurrences meet.

    First (text, code, how often, near) of each such word; ``near`` lists, for each occurrence, -1 - id of
    a word (or start) before it and the id of a word behind it. Second (text, code, next code, how often)
    of pairs of two such words. Texts are kept ``apart``, or else all count as one.
    """
    own, size = np.flatnonzero(ids < 0), len(found.words)
    state, inside = before[own], ~found.last[own]
    behind = ids[np.minimum(own + 1, len(ids) - 1)]
    at = found.at[own] if apart else np.zeros(len(own), np.int64)
    word = at * size + found.codes[own]
    ahead, follows, linked = state != -1, inside & (behind >= 0), inside & (behind < 0)
    under = np.concatenate([word[ahead], word[follows]])
    near = np.concatenate([np.where(state == frequent, START, -1 - state)[ahead], behind[follows]]).astype(np.int32)
    order = np.argsort(under, kind="stable")
    words, n = np.unique(word, return_counts=True)
    offsets = np.append(np.searchsorted(under[order], words), len(under)).astype(np.int32)
    links, m = np.unique(word[linked] * size + found.codes[own[linked] + 1], return_counts=True)
    return (words // size, words % size, n, pa.ListArray.from_arrays(pa.array(offsets), pa.array(near[order]))), (links // size // size, links // size % size, links % size, m)


def rare_pairs(docs: DataFrame, shared: Broadcast, least: int) -> DataFrame:
    """(word binary, next binary, near int, n): pairs that occur at least ``least`` times and hold a word without an id, as ``beside`` puts them; next: the second word if neither has one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in encoded(batches):
            (_, word, _, near), (_, first, second, m) = beside(found, *found.among(shared.value), len(shared.value), False)
            zeros = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(m)).astype(np.int32)), pa.array(np.zeros(m.sum(), np.int32)))
            yield pa.RecordBatch.from_arrays([found.named(word), pa.nulls(len(word), pa.binary()), near], ["word", "next", "near"])
            yield pa.RecordBatch.from_arrays([found.named(first), found.named(second), zeros], ["word", "next", "near"])

    found = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "word binary, next binary, near array<int>")
    one = found.repartition("word").select("word", "next", F.explode("near").alias("near"))
    return one.groupBy("word", "next", "near").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _key(word: Column | str) -> Column:
    """A number below 0 under which a word is joined; pairs of ids and whole texts are above. Words of one key are told apart by themselves."""
    return F.hash(word).cast("long").bitwiseOR(F.lit(-(2**63)))


def score_texts(docs: DataFrame, training=None, word_share: float = 2.0**-20, held: int = 2**20, least: int = 2, discount: float = 0.5) -> DataFrame:
    """Scores every text with a backoff model learned from the rows where ``training`` (a boolean column) holds; by default those not ``held_out``.

    ``docs``: doc_id, text. Counts cover all training rows. Every pair that occurs at least ``least``
    times in them is an arc, whatever the size of the corpus. Words with at least ``least`` and
    ``word_share`` of all tokens (at most 1/word_share can be) and the ``held`` most frequent arcs
    between them are broadcast; all other words and arcs take their exact counts by a join, so neither bound changes a score.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Null texts are empty
    and have one token, the end; null ids are hashed as ''; repeated rows are scored each; without
    training rows every probability is 1/1 as the formula has it; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    training = ~held_out() if training is None else training
    learned = docs.filter(training)
    folder = uuid.uuid4().hex
    counts = stored(token_counts(learned), folder)
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    starts = (counts.filter(F.col("word") == F.lit(END)).first() or {"c": 0})["c"]
    often = (F.col("c") >= least) & (F.col("c") >= n * word_share)
    frequent = counts.filter(often).orderBy(F.desc("c"), "word").collect()
    words, c = [bytes(r["word"]) for r in frequent], [r["c"] for r in frequent]
    size = len(words) + 1
    shared = context.broadcast(pa.array([b"" if w == END else w for w in words], pa.binary()).view(pa.string()))
    ids = spark.createDataFrame(pa.table({"id": pa.array(range(size), pa.int64()), "c2": pa.array([*c, starts], pa.int64())}))
    repeated = counts.filter(F.col("c") >= least)

    # Arcs: between frequent words, and those of other words with the counts of both.
    arcs = stored(pair_counts(learned, shared).filter(F.col("n") >= least), folder)
    rare = stored(rare_pairs(learned, shared, least).join(repeated, "word"), folder)
    alone = rare.filter(F.col("next").isNotNull()).drop("near").join(repeated.select(F.col("word").alias("next"), F.col("c").alias("c2")), "next")
    behind = rare.filter(F.col("next").isNull() & (F.col("near") >= 0)).join(F.broadcast(ids), F.col("near") == F.col("id")).drop("id")
    ahead = rare.filter(F.col("near") < 0).withColumn("first", F.when(F.col("near") == START, size - 1).otherwise(-1 - F.col("near")).cast("long"))

    # Failure arcs: what a state's arcs hold, in whole numbers.
    held_by = [F.sum("n").alias("n"), F.count("*").alias("k"), F.sum(F.col("c2") + 1).alias("mass")]
    between = arcs.join(F.broadcast(ids), F.col("pair") % size == F.col("id")).select(F.expr(f"pair div {size}").alias("first"), "n", "c2")
    sums = between.union(ahead.select("first", "n", F.col("c").alias("c2"))).groupBy("first").agg(*held_by).toArrow()
    most = arcs.groupBy("n").agg(F.count("*").alias("k")).toArrow().sort_by([("n", "descending")])  # a row a count
    fits = int((np.cumsum(most.column("k").to_numpy()) <= held).sum())
    bound = most.column("n")[fits - 1].as_py() if fits else n + 1
    automaton = Automaton(c, n, v, starts, arcs.filter(F.col("n") >= bound).toArrow(), sums, discount)
    model = context.broadcast(automaton)

    # The other arcs' gains over failure arc and unigram, by the key under which a text asks for them.
    def gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, m = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.value.gain(pairs, m))], ["of", "gain"])

    uni = lambda count: F.log10((count + 1) / F.lit(float(n + v + 1)))
    heads = spark.createDataFrame(pa.table({"first": pa.array(range(size), pa.int64()), "own": pa.array(automaton.seen + automaton.fail)}))
    ahead = ahead.join(F.broadcast(heads), "first").select("word", "c", "near", (F.log10(F.col("n") - discount) - F.col("own") - uni(F.col("c"))).alias("gain"))
    # A word without an id has its count, its failure arc, the arcs to and from words with one, and those to others like it, which are asked for as two words.
    follow = alone.select("word", "c", "n", "c2", "next").unionByName(behind.select("word", "c", "n", "c2", "near"), allowMissingColumns=True)
    own = follow.unionByName(ahead, allowMissingColumns=True).unionByName(counts.filter(~often), allowMissingColumns=True)
    arc = F.when(F.col("near").isNotNull() | F.col("next").isNotNull(), F.struct("near", "next", "n", "c2", "gain"))
    own = own.groupBy("word").agg(F.max("c").alias("c"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("n").alias("k"), F.coalesce(F.sum(F.col("c2") + 1), F.lit(0)).alias("mass"), F.collect_list(arc).alias("arcs"))
    fail = F.log10((F.col("c") - F.col("n") + discount * F.col("k")) / F.col("c")) - F.log10((n + v + 1 - F.col("mass")) / F.lit(float(n + v + 1)))
    own = own.select("word", "c", fail.alias("fail"), "arcs")
    gained = F.transform("arcs", lambda x: F.struct(x["near"].alias("near"), x["next"].alias("next"), F.coalesce(x["gain"], F.log10(x["n"] - discount) - F.log10("c") - F.col("fail") - uni(x["c2"])).alias("gain")))
    own = own.select("word", "c", "fail", gained.alias("arcs"))
    linked = lambda x: x["next"].isNotNull()
    beginning = F.struct(F.col("word").alias("name"), "c", "fail", F.map_from_entries(F.transform(F.filter("arcs", lambda x: ~linked(x)), lambda x: F.struct(x["near"], x["gain"]))).alias("arcs"), F.lit(None).cast("double").alias("gain"))
    links = F.transform(F.filter("arcs", linked), lambda x: F.struct(F.concat("word", F.lit(b" "), x["next"]).alias("name"), F.lit(None).cast("long").alias("c"), F.lit(None).cast("double").alias("fail"), F.lit(None).cast("map<int,double>").alias("arcs"), x["gain"].alias("gain")))
    asked = own.select(F.inline(F.concat(F.array(beginning), links))).withColumn("of", _key("name"))
    asked = stored(asked.unionByName(arcs.filter(F.col("n") < bound).mapInArrow(gains, "of long, gain double"), allowMissingColumns=True))
    dropped(spark, folder)  # all that they give is in the model or asked for; the disk is for the texts' shuffle

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, frequent = model.value, shared.value
        kind = pa.schema([("row", pa.int64()), ("key", pa.int64()), ("word", pa.binary()), ("n", pa.int64()), ("near", pa.list_(pa.int32())), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("base", pa.float64()), ("weight", pa.float64())])

        def made(**columns) -> pa.RecordBatch:
            count = len(columns["row"])
            return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(count, f.type) for f in kind], schema=kind)

        for batch, found in encoded(batches, 3):
            rows = batch.column(0).to_numpy()
            ids, before = found.among(frequent)
            base, weight, (at, pairs, m) = automaton.score(found, ids, before)
            sizes, known = np.bincount(found.at, minlength=found.count), np.bincount(found.at, ids >= 0, found.count).astype(np.int64)
            yield made(row=rows, key=rows + 2**62, n=known, doc_id=batch.column(1), held_out=batch.column(2), n_tokens=sizes, base=base, weight=weight)
            yield made(row=rows[at], key=pairs, n=m)
            (at, word, m, near), (first, one, two, k) = beside(found, ids, before, len(frequent), True)
            yield made(row=rows[at], word=found.named(word), n=m, near=near)
            yield made(row=rows[first], word=pc.binary_join_element_wise(found.named(one), found.named(two), b" "), n=k)

    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), (~training).alias("held_out"), F.col("text").cast("binary").alias("text"))
    parts = source.mapInArrow(run, "row long, key long, word binary, n long, near array<int>, doc_id long, held_out boolean, n_tokens long, base double, weight double")
    parts = parts.withColumn("key", F.coalesce("key", _key("word")))
    joined = parts.join(asked, (F.col("key") == F.col("of")) & (F.col("name").isNull() | (F.col("name") == F.col("word"))), "left")
    whole, word = F.col("n_tokens").isNotNull(), F.col("near").isNotNull()
    joined = joined.filter(whole | word | F.col("gain").isNotNull())
    plain = F.when(word, F.col("n") * uni(F.coalesce("c", F.lit(0))))
    gain = F.when(F.col("arcs").isNotNull(), F.aggregate("near", F.lit(0.0), lambda s, x: s + F.coalesce(F.try_element_at("arcs", x), F.lit(0.0)))).otherwise(0.0)
    scored = F.when(whole, F.col("weight")).when(word, plain + F.col("n") * F.coalesce("fail", F.lit(0.0)) + gain).otherwise(F.col("n") * F.col("gain"))
    known = F.when(whole | (word & F.col("c").isNotNull()), F.col("n")).otherwise(0)
    joined = joined.select("row", "doc_id", "held_out", "n_tokens", known.alias("known"), F.coalesce(plain, "base").alias("base"), scored.alias("score"))
    return joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum("known").alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        F.sum("base").alias("base_score"),
        F.sum("score").alias("score"),
    ).drop("row")
