"""Registered queries of the training-data problems and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.llm import boilerplate, canonical, garbled, leakage, names, neardup, split, survivor, tokenize
from graphloom.runtime import read


def _typed(spark, d):
    rel = read(spark, d, "relationships").select(
        F.lit("relationships").alias("table_name"), F.col("rel_id").alias("row_id"), F.lit("relationship_type").alias("list_name"), F.col("relationship_type").alias("value")
    )
    ev = read(spark, d, "event_records").select(
        F.lit("event_records").alias("table_name"), F.col("rec_id").alias("row_id"), F.lit("event_type").alias("list_name"), F.col("type").alias("value")
    )
    return rel.unionByName(ev)


def p1_found(spark, d):
    return canonical.assign(_typed(spark, d), read(spark, d, "canonical_values"), ["table_name", "row_id"])


def p1_unmatched(spark, d):
    """Report of the values that mean no entry, with their frequency."""
    out = canonical.assign(_typed(spark, d), read(spark, d, "canonical_values"), ["table_name", "row_id", "value"])
    return out.where(F.col("entry") == canonical.UNMATCHED).groupBy("table_name", "value").agg(F.count("*").alias("n"))


def _near(spark, d):
    return neardup.near_duplicates(read(spark, d, "sample_data"), "rec_id", ("title", "description"), "description")


def p2_found(spark, d):
    return neardup.expand(*_near(spark, d))


def p2_classes(spark, d):
    return neardup.class_report(*_near(spark, d))


def p3_found(spark, d):
    return boilerplate.judge(read(spark, d, "chunks")).where("furniture").select("chunk_id", "line_no")


def p3_articles(spark, d):
    return boilerplate.articles(read(spark, d, "chunks"))


def p4_pieces(spark, d):
    return split.pieces(read(spark, d, "chunks"))


def p4_found(spark, d):
    return p4_pieces(spark, d).where("piece_no = 1").select("chunk_id")


_P5 = ("actors", "concepts", "event_records")


def p5_survivors(spark, d):
    return survivor.survivors({t: read(spark, d, t) for t in _P5})


def p5_found(spark, d):
    return p5_survivors(spark, d).where("bundle = 'account'").select("table_name", "id", "rec_id")


def p7_entities(spark, d):
    return names.entities(read(spark, d, "actors"))


def p7_found(spark, d):
    return names.variant_pairs(p7_entities(spark, d))


def p8_ids(spark, d):
    return tokenize.token_ids(read(spark, d, "documents"))


def p8_counts(spark, d):
    return tokenize.corpus_counts(p8_ids(spark, d))


def p9_found(spark, d):
    return leakage.leaks(read(spark, d, "documents"), read(spark, d, "eval_items"))


def p9_report(spark, d):
    return leakage.leak_report(p9_found(spark, d), read(spark, d, "eval_items"))


def p10_restored(spark, d):
    return garbled.diagnose(read(spark, d, "documents"))


def p10_found(spark, d):
    return p10_restored(spark, d).select("doc_id")


QUERIES = {
    "p1_found": p1_found,
    "p1_unmatched": p1_unmatched,
    "p2_found": p2_found,
    "p2_classes": p2_classes,
    "p3_found": p3_found,
    "p3_articles": p3_articles,
    "p4_found": p4_found,
    "p4_pieces": p4_pieces,
    "p5_found": p5_found,
    "p5_survivors": p5_survivors,
    "p7_found": p7_found,
    "p7_entities": p7_entities,
    "p8_ids": p8_ids,
    "p8_counts": p8_counts,
    "p9_found": p9_found,
    "p9_report": p9_report,
    "p10_found": p10_found,
    "p10_restored": p10_restored,
}

_WS = r"[\t\n\x0b\x0c\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_P5_PART = r"""
SELECT '{t}' AS table_name, id, rec_id, reviewed, revised_at, {c} AS txt, count(*) OVER (PARTITION BY id) AS n FROM {t} WHERE id IS NOT NULL"""
_fillers = ", ".join(f"'{x}'" for x in survivor.FILLERS)

SQL = {
    "p2_found": r"""
WITH w AS (SELECT rec_id, list_sort(list_distinct(list_transform(regexp_extract_all(coalesce(title, '') || ' ' || description, '[\p{L}\p{N}]+'), lambda x: lower(x)))) AS s
  FROM sample_data WHERE trim(regexp_replace(description, '\s', '', 'g')) <> ''),
t AS (SELECT rec_id, unnest(s) AS x, len(s) AS n FROM w),
c AS (SELECT a.rec_id AS rec_a, b.rec_id AS rec_b, a.n AS na, b.n AS nb, count(*) AS k
  FROM t a JOIN t b ON a.x = b.x AND a.rec_id < b.rec_id AND b.n >= 0.7 * a.n AND a.n >= 0.7 * b.n GROUP BY ALL)
SELECT rec_a, rec_b FROM c WHERE k >= 0.7 * (na + nb - k) - 1e-9""",
    "p2_classes": r"""
WITH w AS (SELECT rec_id, list_sort(list_distinct(list_transform(regexp_extract_all(coalesce(title, '') || ' ' || description, '[\p{L}\p{N}]+'), lambda x: lower(x)))) AS s
  FROM sample_data WHERE trim(regexp_replace(description, '\s', '', 'g')) <> ''),
g AS (SELECT s, min(rec_id) AS rep, count(*) AS n_copies FROM w WHERE len(s) > 0 GROUP BY s),
t AS (SELECT rep, unnest(s) AS x, len(s) AS n FROM g),
c AS (SELECT a.rep AS ra, b.rep AS rb, a.n AS na, b.n AS nb, count(*) AS k FROM t a JOIN t b ON a.x = b.x AND a.rep < b.rep AND b.n >= 0.7 * a.n AND a.n >= 0.7 * b.n GROUP BY ALL),
p AS (SELECT ra, rb FROM c WHERE k >= 0.7 * (na + nb - k) - 1e-9),
l AS (SELECT r, count(*) AS n FROM (SELECT ra AS r FROM p UNION ALL SELECT rb FROM p) q GROUP BY r)
SELECT w.rec_id, g.rep AS class_id, g.n_copies, coalesce(l.n, 0) AS n_links FROM w JOIN g ON g.s = w.s LEFT JOIN l ON l.r = g.rep""",
    "p9_report": r"""
WITH i AS (SELECT item_id, list_transform(regexp_extract_all(text, '[\p{L}\p{N}]+'), lambda x: lower(x)) AS w FROM eval_items),
d AS (SELECT doc_id, list_transform(regexp_extract_all(text, '[\p{L}\p{N}]+'), lambda x: lower(x)) AS w FROM documents WHERE text IS NOT NULL),
ig AS (SELECT DISTINCT item_id, array_to_string(w[k : k + 11], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS k FROM i) q),
dg AS (SELECT DISTINCT doc_id, array_to_string(w[k : k + 11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS k FROM d) q),
f AS (SELECT item_id, count(DISTINCT doc_id) AS n FROM dg JOIN ig USING (g) GROUP BY 1)
SELECT e.item_id, suite, coalesce(n, 0) AS n_docs FROM eval_items e LEFT JOIN f ON f.item_id = e.item_id""",
    "p9_found": r"""
WITH i AS (SELECT item_id, list_transform(regexp_extract_all(text, '[\p{L}\p{N}]+'), lambda x: lower(x)) AS w FROM eval_items),
d AS (SELECT doc_id, list_transform(regexp_extract_all(text, '[\p{L}\p{N}]+'), lambda x: lower(x)) AS w FROM documents WHERE text IS NOT NULL),
ig AS (SELECT DISTINCT item_id, array_to_string(w[k : k + 11], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS k FROM i) q),
dg AS (SELECT DISTINCT doc_id, array_to_string(w[k : k + 11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS k FROM d) q)
SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)""",
    "p4_found": rf"""
SELECT chunk_id FROM chunks
WHERE length(text) > 10000 OR len(list_filter(regexp_split_to_array(text, '{_WS}'), lambda w: w <> '')) > 1000""",
    "p5_found": rf"""
WITH r AS ({" UNION ALL ".join(_P5_PART.format(t=t, c="definition" if t == "concepts" else "description") for t in _P5)}),
p AS (SELECT *, trim(regexp_replace(lower(txt), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS plain, lower(txt) AS low FROM r WHERE n > 1),
u AS (SELECT * FROM p WHERE plain <> '' AND plain NOT IN ({_fillers})
  AND NOT regexp_matches(plain, '{survivor.FILLER_SHAPE}')
  AND NOT regexp_matches(low, '{survivor.STUB_SHAPE}')
  AND NOT regexp_matches(low, '(\.\.+|…|\[\.\.\.\]|\(truncated\))\s*$')
  AND regexp_matches(txt, '[.!?]\s*$'))
SELECT table_name, id, rec_id FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name, id ORDER BY coalesce(reviewed, false) DESC, revised_at DESC NULLS LAST, rec_id) AS k FROM u) x
WHERE k = 1""",
}
