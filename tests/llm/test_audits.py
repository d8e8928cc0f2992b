"""License scans, fill-in-middle and the source divergence audit against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from random import Random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import DATA
from speclake.llm import decontaminate, divergence, infill, langid, langmodel, licenses, lines, media, mixing, pages, queries, secrets, simhash, tokencount
from test_llm import CLASHES, ROWS

LOWER = {i: i + 32 for i in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    more = [(7, "a\n\nb", "", "", 0, 7), (8, "\n" * 5, "xx", "only", 0, 8), (9, "has <S> inside\nit", "en", "a", 0, 9), (10, "MIT License, mit  license; gnu General-Public LICENSE", "en", "b", 0, 10)]
    return spark.createDataFrame(ROWS + more, "doc_id long, text string, lang string, source string, size long, row long")


def clashing(df):
    return df.select("*", *[df["row"].alias(c) for c in CLASHES if c not in df.columns])


# --- licenses


def plain_base(text):
    """Places of the base phrases, by looking at each word."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    found = []
    for label, phrase in licenses.BASE:
        want = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(want)] == want]
    return len(words), sorted(found)


def test_license_query_has_the_base_of_brute_force(spark, docs):
    got = {r.doc_id: r for r in queries.op11_license_scan(spark, DATA).collect()}
    assert len(got) == docs.count()
    hits = 0  # a few, as the table is small
    for r in docs.collect():
        n, found = plain_base(r.text)
        g = got[r.doc_id]
        labels = sorted({x for _, x in found})
        assert (g.n_words, g.n_base, g.base_labels) == (n, len(found), ",".join(labels))
        assert (g.first_word, g.last_word) == ((found[0][0], found[-1][0]) if found else (None, None))
        assert set(labels) <= set(g.labels.split(",")) and 0 <= g.score <= 1
        hits += bool(found)
    assert hits > 1


def test_license_odd_rows(odd):
    got = licenses.scan_licenses(clashing(odd)).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_base) for r in got) == sorted((r.doc_id if r.doc_id is not None else -1, len(plain_base(r.text)[1])) for r in odd.collect())
    ten = next(r for r in got if r.doc_id == 10)
    assert (ten.n_base, ten.first_word, ten.last_word, ten.base_labels) == (3, 0, 4, "gpl,mit")
    assert licenses.scan_licenses(odd.limit(0)).count() == 0


@pytest.mark.parametrize("text, labels", [
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
    ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0"),
    ("Released under the MIT License.", "mit"),
    ("SPDX-License-Identifier: LGPL-2.1-or-later", "lgpl-2.1"),
    ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
    ("https://creativecommons.org/licenses/by-sa/4.0/", "cc-by-sa-4.0"),
    ("under Creative Commons Attribution-ShareAlike 3.0", "cc-by-sa-3.0"),
    ("GPLv2 or later", "gpl-2.0"),
    ("Apache 2.4 is a server of the Apache people", ""),
    ("take artistic license with a driver's license", ""),
    ("Mozilla Public License 2.0 and MPL 1.1", "mpl-1.1,mpl-2.0"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("Copyright (c) 2019, 2020 someone. All rights reserved.", "copyright"),
    ("it is not licensed under the GPL", ""),
    ("admit license fees, permits", ""),
    ("", ""),
])
def test_license_labels(text, labels):
    scanner = licenses.Scanner(licenses.rules())
    assert licenses._told(scanner.scan(text.encode())[1])[4] == labels


def example(parsed, random):
    """A text that a parsed pattern matches, its branches taken at random."""
    said = ""
    for op, arg in parsed:
        match str(op):
            case "LITERAL":
                said += chr(arg)
            case "IN":
                choices = [example([x], random) for x in arg if str(x[0]) in ("LITERAL", "CATEGORY", "RANGE")]
                said += random.choice(choices)
            case "CATEGORY":
                said += {"CATEGORY_DIGIT": "7"}.get(str(arg), "x")
            case "RANGE":
                said += chr(random.randint(*arg))
            case "BRANCH":
                said += example(random.choice(arg[1]), random)
            case "SUBPATTERN":
                said += example(arg[3], random)
            case "MAX_REPEAT" | "MIN_REPEAT":
                said += "".join(example(arg[2], random) for _ in range(random.randint(arg[0], min(arg[1], arg[0] + 2))))
            case "ASSERT" | "ASSERT_NOT":
                pass
            case _:
                raise ValueError(op)
    return said


def test_every_text_that_a_rule_matches_holds_its_keyword():
    found, random = licenses.rules(), Random(5)
    assert len(found) > 300
    asked = matched = 0
    for r in found:
        parsed, whole = re._parser.parse(r.pattern), re.compile(r.pattern)
        for _ in range(60):
            said = example(parsed, random)
            asked += 1
            if whole.fullmatch(said):
                matched += 1
                assert r.keyword in said, (r, said)
    assert matched > 0.7 * asked


def test_containment_equals_all_pairs():
    """The sweep keeps what a comparison of all pairs keeps."""
    random = np.random.default_rng(1)
    ordered = tuple(licenses.Rule("x", "x", "x", int(random.integers(0, 6)), bool(random.random() < 0.1)) for _ in range(20))
    scanner = licenses.Scanner(ordered)
    for _ in range(200):
        found = list({(int(a), int(a + n), int(i)) for a, n, i in zip(random.integers(0, 30, 40), random.integers(1, 12, 40), random.integers(0, 20, 40), strict=True)})
        rank = lambda x: (ordered[x[2]].priority, x[2])
        inside = lambda x, y: y[0] <= x[0] and y[1] >= x[1] and (rank(y) < rank(x) if y[:2] == x[:2] else ordered[y[2]].priority <= ordered[x[2]].priority)
        want = [x for x in found if ordered[x[2]].base or not any(y != x and inside(x, y) for y in found)]
        assert sorted(scanner.resolve(found)) == sorted(want)


# --- fill-in-middle


def plain_infill(doc_id, text):
    text = text or ""
    units = text.splitlines(keepends=True) if not re.search("[^\\S\n]", text) else re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 50 else "psm"
    return doc_id, n, form, len(p), len(m), sha(f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"), sha(text)


def test_infill_query_equals_brute_force(spark, docs):
    got = queries.op12_fill_in_middle(spark, DATA)
    assert {tuple(r) for r in got.collect()} == {plain_infill(r.doc_id, r.text) for r in docs.collect()}


def test_infill_odd_rows(odd):
    made = infill.fill_in_middle(clashing(odd))
    rows = made.withColumn("restored", infill.restored(F.col("output"), F.col("form"))).collect()
    got = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, sha(r.output), sha(r.restored)) for r in rows)
    assert got == Counter(plain_infill(r.doc_id, r.text) for r in odd.collect())
    assert infill.fill_in_middle(odd.limit(0)).count() == 0


def test_infill_restores_texts_that_end_like_marks(spark):
    import regex

    units, made = regex.compile(infill.LINES), []
    for text in ("<\nP>\n<P\n", "<S\n>\n<", "<<\n<S\n", "P>\nM>", "\n", "é𝄞\n𝄞" * 9, "a" * 200_000, "\n" * 100_000, "x\r\ny z\n"):
        for drawn in ([0, 1, 0, 0], [1, 2, 0, 99], [3, 1, 0, 60], [7, 7, 0, 10], [0, 0, 99, 0]):
            n, form, output, a, m = infill.infill(text, drawn, units, 100, 50)
            assert n == len(re.findall(r"[^\n]*\n|[^\n]+", text)) and form != "plain"
            made.append((text, form, output))
    rows = spark.createDataFrame(made, "text string, form string, output string")
    assert rows.filter(infill.restored(F.col("output"), F.col("form")) != F.col("text")).count() == 0 and rows.count() == 45
    assert infill.infill("text", [0, 0, 50, 0], units, 50, 50)[1] == "plain"


# --- source divergence


def plain_audit(rows, least=3, top=200):
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for r in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r.text or "").translate(LOWER))
        groups[r.lang or "", r.source or ""].update(words)
        docs[r.lang or ""].update(set(words))
    found = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= least]
        v = len(kept)
        own = {s: {t: c[t] for t in kept} for (g, s), c in groups.items() if g == lang}
        whole = {t: sum(c[t] for c in own.values()) for t in kept}
        p = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + v) for t in kept}
        shares, q = {s: p(c) for s, c in own.items()}, p(whole)
        for s, a in shares.items():
            pairs = [(sum((a[t] - b[t]) ** 2 // b[t] for t in kept), o) for o, b in shares.items() if o != s]
            terms = [((a[t] - q[t]) ** 2 // q[t], t) for t in kept if own[s][t] and a[t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                ordered = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:limit]
                found += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(ordered, 1)]
    return sorted(found)


def test_audit_query_equals_brute_force(spark, docs):
    want = plain_audit(docs.collect())
    assert sorted(map(tuple, queries.op13_source_divergence(spark, DATA).collect())) == want
    assert any(x[2] == "term" and x[5] == 200 for x in want)
    parts = divergence.audit_sources(docs, part_terms=50)
    assert sorted(map(tuple, parts.collect())) == want


def test_audit_odd_rows(spark, odd):
    assert sorted(map(tuple, divergence.audit_sources(clashing(odd)).collect())) == plain_audit(odd.collect())
    assert divergence.audit_sources(odd.limit(0)).count() == 0


def test_pair_sums_over_many_levels_equal_all_terms():
    random = np.random.default_rng(3)
    counts = np.minimum(random.zipf(1.3, (5, 3000)), 10**10) * (random.random((5, 3000)) < 0.6)
    n, v = [int(x) for x in counts.sum(axis=1)], 3000
    p = [[1 + 10**9 * (int(c) + 1) // (n[g] + v) for c in row] for g, row in enumerate(counts)]
    want = [[sum((a - b) ** 2 // b for a, b in zip(p[g], p[h], strict=True)) if g != h else 0 for h in range(5)] for g in range(5)]
    assert divergence.pair_sums(counts, n, v).tolist() == want


# --- tables of a row or two, without repeated words, without training rows

SMALL = {
    "one": [(1, "a single document of seven words", "en", "s", 0, 1)],
    "two": [(1, "first text here", "en", "s", 0, 1), (2, "another body there", "de", "t", 0, 2)],
    "distinct": [(i, " ".join(f"w{i}x{k}" for k in range(4)), "en", "s", 0, i) for i in range(3, 12)],
    "held out": [(i, f"alpha beta w{i}", "en", "s", 0, i) for i in range(400) if zlib.crc32(str(i).encode()) % 7 == 2],
}


@pytest.mark.parametrize("kind", SMALL)
def test_small_tables(spark, kind):
    rows = SMALL[kind]
    small = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size long, row long").coalesce(1)
    bench = spark.createDataFrame([(1, "another body there")], "item_id long, text string")
    learned = [t for i, t, *_ in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(w for t in learned for w in [*t.split(), ""])
    n, v = c.total(), len(c)
    for r in langmodel.score_texts(small).collect():
        words = [*next(t for i, t, *_ in rows if i == r.doc_id).split(), ""]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(c[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words)) and r.score <= 1e-12
    found = [mixing.mix_sources(small), decontaminate.find_contamination(small, bench), secrets.scan_secrets(small), tokencount.count_tokens(small), langmodel.score_texts(small)]
    found += [simhash.near_duplicates(small), media.store_media(small), lines.drop_boilerplate(small), licenses.scan_licenses(small), infill.fill_in_middle(small)]
    pieces = langid.vocabulary()
    found.append(langid.identify(small, *langid.train(small, pieces), pieces))
    assert [x.count() for x in found] == [len(rows)] * len(found)
    assert sorted(map(tuple, divergence.audit_sources(small).collect())) == plain_audit(small.collect())
    html = small.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit("<p>"), "text").alias("html"))
    assert pages.extract_text(html).count() == len(rows)
