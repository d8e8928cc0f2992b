"""Token counts by trie-shared dynamic programming."""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speclake.llm.langid import MARK, TOKENIZERS


def pieces(tokenizers: str = TOKENIZERS, name: str = "piece_bpe_32k.model") -> list[str]:
    """The pieces of a public vocabulary that may stand in a text."""
    model = _model(f"{tokenizers}/{name}")
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


def _model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def piece_scores(docs: DataFrame, tokenizers: str = TOKENIZERS, name: str = "piece_bpe_32k.model", flush: int = 200_000) -> dict[str, float]:
    """Unigram log-probabilities of a public vocabulary's pieces, by add-one counts over the pre-tokens of all texts as its own merges cut them.

    Tasks cut each distinct pre-token of about ``flush`` once and hand on one count a piece, so as many rows as
    there are pieces come to the driver. The vocabulary itself is not trained.
    """
    path = f"{tokenizers}/{name}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, words, found = _model(path), Counter(), Counter()

        def note() -> None:
            for cut_, n in zip(model.encode(list(words), out_type=int, num_threads=1), words.values(), strict=True):
                for piece in cut_:
                    found[piece] += n
            words.clear()

        for batch in batches:
            for text in batch.column(0).to_pylist():
                words.update((text or "").split())
                if len(words) > flush:
                    note()
        note()
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], ["piece", "n"])

    model, known = _model(path), pieces(tokenizers, name)
    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    counts = {model.id_to_piece(r["piece"]): r["n"] for r in counted}
    total = sum(counts.get(p, 0) for p in known) + len(known)
    return {p: math.log((counts.get(p, 0) + 1) / total) for p in known}


#: Stands for what no piece ends like.
END = object()


class Trie:
    """Distinct pre-tokens by shared prefixes; each node keeps the best segmentation up to it.

    A node's score and number of tokens are computed once, when the first pre-token that passes it is
    inserted, from the states on its path; a pre-token's last node holds its token count. Characters
    that are no piece cost ``byte_cost`` and a token for each of their UTF-8 bytes. Of equal scores
    the fewer tokens win.
    """

    def __init__(self, scores: dict[str, float], byte_cost: float = -20.0):
        # Ends of pieces that are none have no score, so that a walk back from a place goes on as long as a piece may begin.
        self.scores = dict.fromkeys((p[k:] for p in scores for k in range(1, len(p)))) | scores
        self.byte_cost = byte_cost
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.best: list[float] = [0.0]
        self.size: list[int] = [0]
        self.counts: dict[str, tuple[int, float]] = {}

    def count(self, word: str) -> tuple[int, float]:
        """(tokens, score) of a pre-token, which is inserted."""
        node, path, child, scores, best_of, size_of = 0, [0], self.child, self.scores, self.best, self.size
        for d, ch in enumerate(word, 1):
            nxt = child.get((node, ch))
            if nxt is None:
                nxt = child[node, ch] = len(best_of)
                best, size = -math.inf, 0
                if scores.get(ch) is None:
                    n = len(ch.encode("utf-8", "surrogatepass"))
                    best, size = best_of[node] + n * self.byte_cost, size_of[node] + n
                for a in range(d - 1, -1, -1):
                    s = scores.get(word[a:d], END)
                    if s is None:
                        continue
                    if s is END:
                        break
                    at = path[a]
                    total = best_of[at] + s
                    if total > best or total == best and size_of[at] < size - 1:
                        best, size = total, size_of[at] + 1
                best_of.append(best)
                size_of.append(size)
            node = nxt
            path.append(node)
        return size_of[node], best_of[node]


#: Of the last scores used in a worker, by a key that the driver gives each.
_TRIES: dict[str, Trie] = {}


def count_tokens(docs: DataFrame, tokenizers: str = TOKENIZERS, name: str = "piece_bpe_32k.model", bound: int = 2_000_000, scores: dict[str, float] | None = None) -> DataFrame:
    """Tokens of every whole text: ``docs`` (doc_id, text) to (doc_id, n_chars, n_pretokens, n_tokens, score).

    Pre-tokens are runs of other than white space, each with a mark in front; a text's tokens are
    those of the best unigram segmentation of each, by ``scores`` or else ``piece_scores`` of the
    texts. The trie lives in a worker across batches and is dropped when it holds over ``bound`` nodes, within a
    text too; that changes no result. Null and empty texts have no tokens and score 0;
    repeated rows stay; an empty table gives an empty result.
    """
    shared, key = docs.sparkSession.sparkContext.broadcast(scores or piece_scores(docs, tokenizers, name)), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _TRIES:
            _TRIES.clear()
            _TRIES[key] = Trie(shared.value)
        trie = _TRIES[key]
        known = trie.counts
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                words, n_tokens, score = Counter((text or "").split()), 0, 0.0
                for w, n in words.items():
                    found = known.get(w)
                    if found is None:
                        if len(trie.best) > bound:
                            trie.clear()
                            known = trie.counts
                        found = known[w] = trie.count(MARK + w)
                    n_tokens += n * found[0]
                    score += n * found[1]
                out.append((len(text or ""), words.total(), n_tokens, round(score, 3)))
            columns = [list(x) for x in zip(*out, strict=True)] if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, pa.int64()) for x in columns[:3]], pa.array(columns[3], pa.float64())], ["doc_id", "n_chars", "n_pretokens", "n_tokens", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_chars long, n_pretokens long, n_tokens long, score double")
