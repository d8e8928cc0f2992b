"""Every repeated pair is an arc, whatever share of the tokens it has and wherever its words and arcs are held."""

import math
import random
import zlib
from collections import Counter

import pytest

from speclake.llm import langmodel


def plain_scores(texts: dict[int, str]) -> dict[int, float]:
    words = {i: langmodel.tokens(t.encode()) for i, t in texts.items()}
    learned = [ws for i, ws in words.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(w for ws in learned for w in ws)
    total = c.total() + len(c) + 1
    arcs = {p: k for p, k in Counter(p for ws in learned for p in zip([None, *ws[:-1]], ws)).items() if k >= 2}
    seen = lambda s: c[langmodel.END] if s is None else c[s]
    kept, mass = Counter(), Counter()
    for (s, w), k in arcs.items():
        kept[s] += (k - 0.5) / seen(s)
        mass[s] += (c[w] + 1) / total
    one = lambda s, w: (arcs[s, w] - 0.5) / seen(s) if (s, w) in arcs else (1 - kept[s]) / (1 - mass[s]) * (c[w] + 1) / total
    return {i: sum(math.log10(one(s, w)) for s, w in zip([None, *ws[:-1]], ws)) for i, ws in words.items()}


@pytest.mark.parametrize("bounds", [{}, {"word_share": 0.004}, {"word_share": 0.004, "held": 20}, {"word_share": 0.03, "held": 0}, {"word_share": 1.0}])
def test_no_repeated_pair_is_lost(spark, bounds):
    draw = random.Random(4)
    vocabulary = [f"w{k}" for k in range(300)] + ["é", "Ünder", "ÄB"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    texts = {i: " ".join(draw.choices(vocabulary, weights, k=draw.randrange(60))) for i in range(150)}
    texts |= {200 + i: f"rare{i % 4} pair{i % 4} {'w0 ' * i}only{i}" for i in range(12)} | {300: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in langmodel.score_texts(docs, **bounds).collect()}
    assert got == pytest.approx(plain_scores(texts))
