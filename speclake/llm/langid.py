"""Language identification by segmentation-marginalised unigrams."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from speclake.llm.common import cut, sized

#: Words of more characters are scored by logarithms, as their probabilities may be too small for a double.
LONG = 32
#: Runs of letters and numerals other than digits; the numerals are taken out below.
RUNS = re.compile(r"[^\W\d_]+")
MARK = "▁"
TOKENIZERS = "/opt/tokenizers"


def vocabulary(tokenizers: str = TOKENIZERS, name: str = "piece_bpe_32k.model") -> list[str]:
    """The fixed pieces: those of a public vocabulary that are lower-case letters, a mark for the begin of a word in front of some."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=f"{tokenizers}/{name}")
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return sorted({p for p in pieces if (q := p.removeprefix(MARK)).isalpha() and q == q.lower()})


def stretches(text: str) -> Counter:
    """How often each lower-cased run of letters occurs in a text, however long."""
    found = Counter(RUNS.findall(text.lower()))
    for mixed in [w for w in found if not w.isalpha()]:
        n = found.pop(mixed)
        for word in "".join(c if c.isalpha() else " " for c in mixed).split():
            found[word] += n
    return found


class Segmentations:
    """Forward and backward sums over all segmentations of words, for all languages at once.

    Row 0 of ``p`` is zero (no piece), row 1 the floor for a character that is no piece.
    """

    def __init__(self, pieces: list[str], p: np.ndarray, floor: float = 1e-7):
        self.index = dict.fromkeys((w[:k] for w in pieces for k in range(1, len(w))), 0) | {w: i + 2 for i, w in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        self.p = np.vstack([np.zeros((1, p.shape[1])), np.full((1, p.shape[1]), floor), p])

    def lattice(self, words: list[str]) -> np.ndarray:
        """For words of one length: the piece that begins at a place and has a length, as [word, place, length - 1]."""
        n, get = len(words[0]), self.index.get
        wide = min(n, self.longest)
        flat, at = [0] * (len(words) * n * wide), 0
        for w in words:
            for a in range(n):
                for k in range(min(wide, n - a)):
                    piece = get(w[a : a + k + 1])
                    if piece is None:  # no piece begins like that
                        break
                    flat[at + k] = piece
                at += wide
        grid = np.array(flat, np.int32).reshape(len(words), n, wide)
        grid[:, :, 0][grid[:, :, 0] == 0] = 1
        return grid

    def forward(self, grid: np.ndarray) -> np.ndarray:
        """[place, word, language]: the summed probability of all segmentations up to a place."""
        m, n, wide = grid.shape
        total = np.zeros((n + 1, m, self.p.shape[1]))
        total[0] = 1
        for j in range(1, n + 1):
            for k in range(1, min(j, wide) + 1):
                total[j] += total[j - k] * self.p[grid[:, j - k, k - 1]]
        return total

    def logs(self, grid: np.ndarray, back: bool = False) -> np.ndarray:
        """[place, language]: log of the summed probability of all segmentations of one word up to a place, or from it on."""
        pieces, (n, wide) = np.log(np.maximum(self.p, 1e-300)), grid[0].shape
        pieces[0] = -np.inf
        total = np.zeros((n + 1, self.p.shape[1]))
        for step in range(1, n + 1):
            k = np.arange(1, min(step, wide) + 1)
            far, ids = (n - step + k, grid[0, n - step, k - 1]) if back else (step - k, grid[0, step - k, k - 1])
            x = total[far] + pieces[ids]
            most = x.max(axis=0)
            total[n - step if back else step] = most + np.log(np.exp(x - most).sum(axis=0))
        return total

    def by_length(self, words: list[str], block: int = 2000) -> Iterator[list[str]]:
        """Words of one length at a time, those of more than ``LONG`` characters one by one."""
        for n, same in groupby(sorted(words, key=len), len):
            part = list(same)
            size = 1 if n > LONG else block
            yield from (part[k : k + size] for k in range(0, len(part), size))

    def log_scores(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        out, names = [np.zeros((0, self.p.shape[1]))], []
        for part in self.by_length([MARK + w for w in words]):
            grid = self.lattice(part)
            out.append(self.logs(grid)[-1:] if len(part[0]) > LONG else np.log(self.forward(grid)[-1]))
            names += [w[1:] for w in part]
        return names, np.concatenate(out)

    def expected(self, words: list[str], counts: dict[str, np.ndarray]) -> np.ndarray:
        """Expected occurrences of each piece (rows of ``p``) over all segmentations of the words, each counted as often as the languages hold it."""
        total = np.zeros_like(self.p)
        for part in self.by_length(words):
            grid = self.lattice(part)
            m, n, wide = grid.shape
            if n > LONG:
                ahead, behind = self.logs(grid), self.logs(grid, back=True)
                for k in range(1, wide + 1):
                    ids = grid[0, : n - k + 1, k - 1]
                    np.add.at(total, ids, counts[part[0]] * self.p[ids] * np.exp(ahead[: n - k + 1] + behind[k:] - ahead[n]))
                continue
            ahead = self.forward(grid)
            behind = np.zeros_like(ahead)
            behind[n] = np.array([counts[w] for w in part]) / ahead[n]
            for j in range(n - 1, -1, -1):
                for k in range(1, min(n - j, wide) + 1):
                    ids = grid[:, j, k - 1]
                    behind[j] += self.p[ids] * behind[j + k]
                    np.add.at(total, ids, ahead[j] * self.p[ids] * behind[j + k])
        return total


def training_words(docs: DataFrame, per_language: int) -> DataFrame:
    """(lang, word, n): words of the first ``per_language`` distinct texts of each language by text hash; texts without a letter don't count.

    Each language's distinct texts are counted first, so that only those whose hash is among about the
    first four times as many are sorted: what meets in a task is bounded at any size of corpus and any
    number of copies, and a language with a usable text always has a sample.
    """
    rank, digest = F.pmod(F.xxhash64("text"), F.lit(1 << 30)), F.unhex(F.md5("text"))
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text")
    keys = cut(usable.select("lang", rank.alias("rank"), digest.alias("digest")).distinct())
    counts = sized(cut(keys.groupBy("lang").agg((F.lit(4.0 * per_language) / F.count("*")).alias("share"))))
    chosen = keys.join(counts, "lang").filter(F.col("rank") < F.col("share") * (1 << 30))
    first = Window.partitionBy("lang").orderBy("rank", "digest")
    picked = sized(cut(chosen.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= per_language).drop("share")))
    sample = usable.withColumn("rank", rank).join(picked, ["lang", "rank"]).filter(digest == F.col("digest"))
    sample = sample.groupBy("lang", "nth").agg(F.first("text").alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lang, texts in frame.groupby("lang")["text"]:
                seen: Counter = Counter()
                for text in texts:
                    seen.update(stretches(text))
                yield pd.DataFrame({"lang": lang, "word": list(seen), "n": list(seen.values())}).astype({"word": str, "n": "int64"})

    return sample.repartition("lang", F.col("nth") % 16).mapInPandas(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, pieces: list[str], per_language: int = 1000, rounds: int = 2, smooth: float = 0.01) -> tuple[list[str], np.ndarray]:
    """Languages and their piece probabilities, by expectation maximisation from a uniform start.

    ``docs``: text, lang. The sample is bounded: at most ``per_language`` distinct texts a language. Each
    round sums expected piece counts in tasks and collects them: languages times pieces at most.
    """
    words = cut(training_words(docs, per_language))
    languages = [r[0] for r in words.select("lang").distinct().orderBy("lang").collect()]
    p = np.full((len(pieces), max(1, len(languages))), 1 / max(1, len(pieces)))
    if not languages:
        return [], p
    packed = words.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
    packed = cut(packed.select("word", F.array(*[F.coalesce(F.try_element_at("by", F.lit(x)), F.lit(0)) for x in languages]).alias("by")))
    for _ in range(rounds):
        model = docs.sparkSession.sparkContext.broadcast(Segmentations(pieces, p))

        def run(frames: Iterator[pd.DataFrame], model=model) -> Iterator[pd.DataFrame]:
            segmentations = model.value
            total = np.zeros_like(segmentations.p)
            for frame in frames:
                by = {MARK + w: np.asarray(n, float) for w, n in zip(frame["word"], frame["by"], strict=True)}
                total += segmentations.expected(list(by), by)
            at = np.nonzero(total.any(axis=1))[0]
            yield pd.DataFrame({"piece": at, "by": list(total[at])})

        sums = packed.mapInPandas(run, "piece long, by array<double>").groupBy("piece").agg(*[F.sum(F.get("by", F.lit(i))) for i in range(len(languages))])
        seen = np.zeros((len(pieces) + 2, len(languages)))
        for row in sums.collect():
            seen[row[0]] = row[1:]
        p = (seen[2:] + smooth) / (seen.sum(axis=0) + smooth * len(pieces))
    return languages, p


class Scores:
    """Words scored so far in a worker."""

    def __init__(self, model: Segmentations):
        self.model, self.index, self.table = model, {}, np.zeros((0, model.p.shape[1]))

    def add(self, words: set[str]) -> None:
        names, new = self.model.log_scores(list(words - self.index.keys()))
        self.index.update(zip(names, range(len(self.table), len(self.table) + len(names)), strict=True))
        self.table = np.concatenate([self.table, new])


#: Of the last model used in a worker, by a key that the driver gives each.
_SCORES: dict[str, Scores] = {}


def identify(docs: DataFrame, languages: list[str], p: np.ndarray, pieces: list[str], bound: int = 300_000) -> DataFrame:
    """The language of every whole text: ``docs`` (doc_id, text) to (doc_id, lang_pred, score).

    A text's score in a language is the sum over its words of the log of the word's probability,
    summed over all segmentations. ``score`` is the best language's share by Bayes with even priors.
    'und' with score 0: null texts, texts without a letter, no learned language. Ties go to the first
    language by name. Repeated rows stay; an empty table gives an empty result.
    """
    model, key = docs.sparkSession.sparkContext.broadcast(Segmentations(pieces, p)), uuid.uuid4().hex

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if key not in _SCORES:
            _SCORES.clear()
            _SCORES[key] = Scores(model.value)
        for whole in frames:
            for k in range(0, len(whole), 500):
                frame = whole.iloc[k : k + 500]
                found = [stretches(x) if isinstance(x, str) else Counter() for x in frame["text"]]
                if len(_SCORES[key].index) > bound:
                    _SCORES[key] = Scores(_SCORES[key].model)
                scores = _SCORES[key]
                if languages:
                    scores.add(set().union(*found))
                lang, score = [], []
                for words in found:
                    if not words or not languages:
                        lang.append("und")
                        score.append(0.0)
                        continue
                    total = np.fromiter(words.values(), float, len(words)) @ scores.table[[scores.index[w] for w in words]]
                    best = int(total.argmax())
                    lang.append(languages[best])
                    score.append(round(float(1 / np.exp(total - total[best]).sum()), 6))
                yield pd.DataFrame({"doc_id": frame["doc_id"], "lang_pred": lang, "score": score})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInPandas(run, "doc_id long, lang_pred string, score double")
