"""The registered queries of the training-data operators: each applies its operator to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speclake.llm import decontaminate, divergence, infill, langid, langmodel, licenses, lines, media, mixing, pages, secrets, simhash, tokencount
from speclake.llm.common import table


def _digest(parts) -> F.Column:
    return F.sha2(F.array_join(parts, ","), 256)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", _digest("items").alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langmodel.held_out(parts=3, part=1)
    pieces = langid.vocabulary()
    languages, p = langid.train(docs.filter(~out), pieces)
    found = langid.identify(docs, languages, p, pieces)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("found", lambda x: x["base"] & (x["kind"] == kind))).cast("long").alias(f"n_{kind}")
    said = lambda spans: F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    base = F.filter("found", lambda x: x["base"])
    return found.select("doc_id", n("assign"), n("access"), n("hex"), _digest(said(base)).alias("base_sha256"), F.array_join(said("found"), ",").alias("spans"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langmodel.score_texts(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_extract_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.store_media(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", "text")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("found")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.fill_in_middle(table(spark, sf_dir, "documents"))
    return made.withColumns({"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(infill.restored(F.col("output"), F.col("form")), 256)}).drop("output")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    found = (pipeline, op1_mix_sources, op2_decontaminate, op3_language_id, op4_secrets, op5_token_counts, op6_lm_score, op7_simhash, op8_extract_html, op9_media, op10_line_dedup, op11_license_scan, op12_fill_in_middle, op13_source_divergence)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    found = {"op2_decontaminate": OP2, "op10_line_dedup": OP10, "op12_fill_in_middle": OP12, "op13_source_divergence": OP13}
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})


OP2 = r"""
WITH words AS (
  SELECT 'd' AS side, rowid AS r, CAST(NULL AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT row_number() OVER () AS rowid, * FROM documents)
  UNION ALL
  SELECT 'b', row_number() OVER (), CAST(item_id AS VARCHAR), regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
  FROM benchmark),
wins AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS win
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM words WHERE side = 'b' AND len(w) > 0)),
spots AS (
  SELECT r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, (SELECT DISTINCT n FROM wins) WHERE side = 'd')),
hits AS (SELECT s.r, s.i, s.n, w.item FROM spots s JOIN wins w ON s.win = w.win AND s.n = w.n),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS said FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r)
SELECT d.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(x.n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(x.said, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM (SELECT row_number() OVER () AS rowid, doc_id FROM documents) d JOIN words w ON w.side = 'd' AND w.r = d.rowid
LEFT JOIN covered c ON c.r = d.rowid LEFT JOIN items x ON x.r = d.rowid
"""

OP10 = r"""
WITH pages AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, text, string_split(text, chr(10)) AS lines FROM documents),
counts AS (SELECT host, line, count(DISTINCT r) AS n FROM (SELECT r, host, unnest(lines) AS line FROM pages) WHERE trim(line, ' ') <> '' GROUP BY host, line),
totals AS (SELECT host, count(*) AS n FROM pages GROUP BY host),
bad AS (SELECT c.host, list(c.line) AS lines FROM counts c JOIN totals t ON c.host = t.host WHERE c.n >= 5 AND c.n > t.n * 0.02 GROUP BY c.host),
kept AS (SELECT p.doc_id, p.text, p.lines, list_filter(p.lines, lambda x: NOT list_contains(coalesce(b.lines, []), x)) AS kept FROM pages p LEFT JOIN bad b ON p.host = b.host)
SELECT doc_id, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(lines) - len(kept), 0) AS BIGINT) AS n_dropped,
  CASE WHEN text IS NULL THEN NULL ELSE array_to_string(kept, chr(10)) END AS text
FROM kept
"""

OP12 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
drawn AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 100 THEN 'plain'
      WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
cuts AS (
  SELECT *, array_to_string(list_slice(u, 1, least(a, b)), '') AS p, array_to_string(list_slice(u, least(a, b) + 1, greatest(a, b)), '') AS m, array_to_string(list_slice(u, greatest(a, b) + 1, n), '') AS s
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM cuts
"""

OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
spots AS (SELECT r, lang, source, unnest(w) AS item FROM d),
kept AS (SELECT lang, item, count(*) AS n FROM spots GROUP BY lang, item HAVING count(DISTINCT r) >= 3),
langs AS (SELECT g.lang, coalesce(sum(k.n), 0) AS whole, count(k.item) AS v FROM (SELECT DISTINCT lang FROM d) g LEFT JOIN kept k ON k.lang = g.lang GROUP BY g.lang),
cells AS (SELECT s.lang, s.source, s.item, count(*) AS n FROM spots s JOIN kept k ON k.lang = s.lang AND k.item = s.item GROUP BY s.lang, s.source, s.item),
groups AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source),
shares AS (
  SELECT g.lang, g.source, k.item, coalesce(c.n, 0) AS n, 1 + 1000000000 * (CAST(coalesce(c.n, 0) AS HUGEINT) + 1) // CAST(g.total + l.v AS HUGEINT) AS p,
    1 + 1000000000 * (CAST(k.n AS HUGEINT) + 1) // CAST(l.whole + l.v AS HUGEINT) AS q
  FROM groups g JOIN langs l ON l.lang = g.lang JOIN kept k ON k.lang = g.lang LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.item = k.item),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.item = b.item AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
