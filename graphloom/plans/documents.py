"""Queries over documents and chunks: scans, sections, chunks, statistics, mentions, phrases."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions import text as X
from graphloom.operators import heuristics as H
from graphloom.operators import structure as S
from graphloom.runtime import read
from graphloom.sources.sinks import csv_projection

SIZE, OVERLAP = 120, 20
STOP = ("the", "and", "of", "to", "in", "an", "for", "by", "with", "from", "on", "as", "that", "was", "were")


def _docs(spark, d):
    return read(spark, d, "documents")


def _chunks(spark, d):
    return read(spark, d, "chunks")


def source_kind(spark, d):
    src = F.col("metadata.source")
    return _chunks(spark, d).select("chunk_id", S.source_kind(src).alias("reader"), S.is_known_extension(src).alias("known"), X.url_part(src, "HOST").alias("host"))


def text_scan(spark, d):
    return _docs(spark, d).where("text IS NOT NULL").select("doc_id", F.sha2(S.normalize_newlines("text"), 256).alias("digest"))


def _page(text):
    return F.concat(
        F.lit("<!DOCTYPE html><html><head><title>"), F.coalesce("doc_type", F.lit("none")), F.lit("</title><script>var x = '<b>';</script><style>p {}</style></head><body><!-- <p>hidden</p> --><p>"),
        F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("\n\n"), F.lit("</p><p>")), F.lit("</p><p title=\"a>b\" class='x>y'>caf&eacute; it&#8217;s &#x41;&amp;&#233</p></body></html>"),
    )


def html_text(spark, d):
    pages = _docs(spark, d).where("text IS NOT NULL").select("doc_id", _page(F.col("text")).alias("html"))
    return pages.select("doc_id", S.html_title("html").alias("title"), F.md5(S.html_text("html").cast("binary")).alias("digest"), F.char_length(S.html_text("html")).cast("bigint").alias("n"))


def section_split_upper(spark, d):
    out = S.sections(_docs(spark, d), S.upper_header)
    return out.select("doc_id", F.col("section_no").cast("bigint").alias("section_no"), "title", F.md5(F.col("content").cast("binary")).alias("digest"))


def section_split_colon(spark, d):
    out = S.sections(_docs(spark, d), S.colon_header)
    return out.select("doc_id", F.col("section_no").cast("bigint").alias("section_no"), "title", F.md5(F.col("content").cast("binary")).alias("digest"))


def chunk_documents(spark, d):
    out = S.chunk_documents(_docs(spark, d), SIZE, OVERLAP)
    return out.select("doc_id", F.col("chunk_ix").cast("bigint").alias("chunk_ix"), F.md5(F.col("text").cast("binary")).alias("digest"), X.word_count("text").cast("bigint").alias("n_words"))


def chunk_stats(spark, d):
    """Scan, sections by their headers, ordered fold into chunks, statistics per section title."""
    docs = S.with_sections(_docs(spark, d).select("doc_id", "text"), S.colon_header).withColumn("text", F.lit(None).cast("string"))
    out = S.chunk_documents(docs, SIZE, OVERLAP).withColumn("n", X.word_count("text"))
    return out.groupBy("section_title").agg(
        F.count("*").alias("n_chunks"), F.sum("n").cast("bigint").alias("total_words"), F.round(F.avg("n"), 6).alias("mean_words")
    )


def doc_metadata(spark, d):
    docs = _docs(spark, d)
    out = S.document_metadata(docs, S.sections(docs, S.upper_header), carry=("source", "lang"))
    return out.select("doc_id", "source", "lang", *(F.col(c).cast("bigint").alias(c) for c in ("text_length", "word_count", "section_count")), "sections")


def chunk_frame(spark, d):
    out = S.chunk_frame(_chunks(spark, d))
    return out.withColumns({"text_length": F.col("text_length").cast("bigint")}).drop("page").select("chunk_id", "text_length", "section", "text_preview")


def token_stats(spark, d):
    return S.token_stats(_chunks(spark, d)).withColumn("mean_words", F.round("mean_words", 6))


def char_stats(spark, d):
    out = S.char_stats(_chunks(spark, d))
    return out.select("n_chunks", "total_chars", F.round("mean_chars", 6).alias("mean_chars"), F.col("min_chars").cast("bigint").alias("min_chars"), F.col("max_chars").cast("bigint").alias("max_chars"))


def section_counts(spark, d):
    return S.section_counts(_chunks(spark, d))


def length_histogram(spark, d):
    return S.length_histogram(_chunks(spark, d)).select(F.col("bin").cast("bigint").alias("bin"), F.round("low", 6).alias("low"), "n")


def chunk_selection(spark, d):
    """The inclusive index range 1-2 of every page's chunks, original indices kept."""
    return S.select_chunks(_chunks(spark, d), between=(1, 2)).select("chunk_id", "chunk_ix")


def chunk_by_index(spark, d):
    return S.select_chunks(_chunks(spark, d), index=1).select("chunk_id", "chunk_ix")


def first_chunks(spark, d):
    """The first seven chunks by id (the feature is a limit)."""
    return S.select_chunks(_chunks(spark, d), first=7, ix="chunk_id").select("chunk_id", "chunk_ix")


def markdown_export(spark, d):
    docs = _docs(spark, d).select(
        "doc_id", F.concat(F.lit("Document "), F.col("doc_id").cast("string")).alias("title"), F.create_map(F.lit("lang"), F.coalesce("lang", F.lit("")), F.lit("source"), F.coalesce("source", F.lit(""))).alias("metadata"), "text"
    )
    return S.markdown(docs).select("doc_id", F.md5(F.col("markdown").cast("binary")).alias("digest"))


def mention_counts(spark, d):
    return H.mention_counts(_docs(spark, d), at_least=2, key="doc_id")


def year_events(spark, d):
    out = H.year_events(_docs(spark, d), key="doc_id")
    return out.select("doc_id", F.col("hit").cast("bigint").alias("hit"), "year", "title", F.md5(F.col("context").cast("binary")).alias("context"))


def keyword_context(spark, d):
    out = H.organisation_hits(_docs(spark, d), key="doc_id", indicators=(*H.ORGANISATION_WORDS, "council", "ministry", "network", "report"))
    return out.select("doc_id", "indicator", "name", F.md5(F.col("context").cast("binary")).alias("context"))


def first_entities(spark, d):
    hits = H.year_events(_docs(spark, d), key="doc_id")
    return H.first_entities(hits.select("title", "year", "doc_id", "hit"), ["title", "year"], ["doc_id", "hit"]).select("title", "year", "doc_id", F.col("hit").cast("bigint").alias("hit"))


def example_hits(spark, d):
    """The first ten organisation hits in document order (a top-k report)."""
    hits = H.organisation_hits(_docs(spark, d), key="doc_id", indicators=("council", "ministry"))
    return H.examples(hits.select("doc_id", "indicator"), ["doc_id", "indicator"], 10)


def tfidf_phrases(spark, d):
    return H.key_phrases(_docs(spark, d), 20, STOP).select("term", F.round("weight", 8).alias("weight"))


def value_counts(spark, d):
    return _docs(spark, d).groupBy(F.coalesce("doc_type", F.lit("Unknown")).alias("doc_type")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "doc_type")


def typed_csv(spark, d):
    ev = read(spark, d, "event_records").select("title", "year", "type", "significance", "description", F.lit(None).cast("string").alias("supporting_text"), "rec_id")
    out = csv_projection(ev, "event")
    return out.select(*(X.csv_quote(c).alias(c.lower()) for c in out.columns))


QUERIES = {
    f.__name__: f
    for f in (
        source_kind, text_scan, html_text, section_split_upper, section_split_colon, chunk_documents, chunk_stats, doc_metadata, chunk_frame, token_stats, char_stats, section_counts,
        length_histogram, chunk_selection, chunk_by_index, first_chunks, markdown_export, mention_counts, year_events, keyword_context, first_entities, example_hits, tfidf_phrases, value_counts, typed_csv,
    )
}

WS = r"[\t\n\x0b\x0c\r\x1c-\x20\x{85}\p{Z}]"


def _words(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '{WS}+'), lambda w: w <> '')"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def _sections(header: str) -> str:
    return rf"""
l AS (SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) AS pos FROM (SELECT doc_id, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS s FROM documents WHERE text IS NOT NULL) q),
m AS (SELECT *, {_strip("line")} AS st FROM l),
h AS (SELECT *, {header} AS head FROM m),
g AS (SELECT *, sum(head::int) OVER (PARTITION BY doc_id ORDER BY pos) AS grp FROM h),
sec0 AS (SELECT doc_id, grp, coalesce(max(CASE WHEN head THEN st END), 'Introduction') AS title,
  coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT head), '') || chr(10) AS content FROM g GROUP BY doc_id, grp),
sec AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY grp) AS section_no, title, content FROM sec0 WHERE {_strip("content")} <> '')"""


_UPPER = "(st <> '' AND length(st) < 100 AND upper(st) = st AND lower(st) <> st)"
_COLON = "(st <> '' AND st LIKE '%:')"


def _fold(source: str) -> str:
    """Paragraph index and fold over (k, content); emits (k, i, text)."""
    return rf"""
q AS (SELECT k, unnest(s) AS para, generate_subscripts(s, 1) AS p FROM (SELECT k, string_split(content, chr(10) || chr(10)) AS s FROM {source}) z),
pp AS (SELECT k, para, len({_words("para")}) AS n, row_number() OVER (PARTITION BY k ORDER BY p) AS i FROM q WHERE {_strip("para")} <> ''),
f AS (
  SELECT k, i, NULL::varchar AS done, para AS cur, n AS tok FROM pp WHERE i = 1
  UNION ALL
  SELECT f.k, pp.i, CASE WHEN tok + n > {SIZE} THEN cur END,
    CASE WHEN tok + n > {SIZE} THEN array_to_string({_words("cur")}[greatest(len({_words("cur")}) - least(tok, {OVERLAP}) + 1, 1):], ' ') || chr(10) || chr(10) || para ELSE cur || chr(10) || chr(10) || para END,
    CASE WHEN tok + n > {SIZE} THEN least(tok, {OVERLAP}) + n ELSE tok + n END
  FROM f JOIN pp ON pp.k = f.k AND pp.i = f.i + 1),
c AS (SELECT k, i - 1 AS i, {_strip("done")} AS text FROM f WHERE done IS NOT NULL
  UNION ALL SELECT k, i, {_strip("cur")} FROM (SELECT *, max(i) OVER (PARTITION BY k) AS last FROM f) y WHERE i = last)"""


_YEARS = r"""
y0 AS (SELECT doc_id, lower(text) AS t, unnest(regexp_extract_all(lower(text), '\b(?:19|20)\d{2}\b')) AS yr,
  generate_subscripts(regexp_extract_all(lower(text), '\b(?:19|20)\d{2}\b'), 1) AS h FROM documents WHERE text IS NOT NULL),
y1 AS (SELECT *, string_split_regex(t, '\b(?:19|20)\d{2}\b') AS parts FROM y0),
y2 AS (SELECT doc_id, h - 1 AS hit, yr::int AS year, t, length(array_to_string(parts[1:h], '0000')) + 1 AS p0 FROM y1),
y AS (SELECT doc_id, hit, year, substring(t, greatest(p0 - 50, 1), p0 + 100 - greatest(p0 - 50, 1)) AS context FROM y2),
yt AS (SELECT *, CASE WHEN contains(context, 'conference') THEN 'Conference' WHEN contains(context, 'publication') THEN 'Publication'
  WHEN contains(context, 'established') OR contains(context, 'founded') THEN 'Organization Founding' WHEN contains(context, 'report') THEN 'Report' ELSE 'Unknown Event' END AS title FROM y)"""

_ORG = r"""
SELECT doc_id, ind AS indicator, substring(text, greatest(p0 - 50, 1), p0 + 100 - greatest(p0 - 50, 1)) AS ctx
FROM (SELECT doc_id, text, ind, strpos(lower(text), ind) AS p0 FROM documents, (SELECT unnest([{}]) AS ind) i WHERE text IS NOT NULL) o WHERE p0 > 0"""


def _mention(kind: str) -> str:
    p, g = H.MENTION_PATTERNS[kind]
    p = p.replace("'", "''").replace(r"\s", r"[\t\n\x0b\x0c\r ]")
    return f"SELECT '{kind}' AS kind, unnest(regexp_extract_all(text, '{p}', {g})) AS mention FROM documents"


_SRC = "metadata.source"
SQL = {
    "source_kind": rf"""
SELECT chunk_id, CASE WHEN starts_with({_SRC}, 'http://') OR starts_with({_SRC}, 'https://') THEN 'url' WHEN e = '.pdf' THEN 'pdf' WHEN e IN ('.docx', '.doc') THEN 'docx' ELSE 'text' END AS reader,
  e IN ('.pdf', '.docx', '.doc', '.txt', '.md', '.rst') AS known, nullif(regexp_extract({_SRC}, '^[a-z]+://([^/?#]+)', 1), '') AS host
FROM (SELECT chunk_id, metadata, lower(regexp_extract({_SRC}, '(\.[^./\\]*)$', 1)) AS e FROM chunks) q""",
    "text_scan": r"SELECT doc_id, sha256(regexp_replace(text, '\r\n?', chr(10), 'g')) AS digest FROM documents WHERE text IS NOT NULL",
    "html_text": r"""
WITH p AS (SELECT doc_id, coalesce(doc_type, 'none') AS ty, string_split(replace(text, chr(10) || chr(10), '</p><p>'), '</p><p>') AS parts, text FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, ty, array_to_string(list_filter(list_prepend(ty, list_transform(string_split(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), chr(10) || chr(10), '</p><p>'), '</p><p>'),
  lambda x: replace(replace(x, '&lt;', '<'), '&amp;', '&'))).list_append('café it’s A&é'), lambda x: x <> ''), chr(10) || chr(10)) AS body FROM p)
SELECT doc_id, ty AS title, md5(body) AS digest, length(body) AS n FROM t""",
    "section_split_upper": f"WITH {_sections(_UPPER)} SELECT doc_id, section_no, title, md5(content) AS digest FROM sec",
    "section_split_colon": f"WITH {_sections(_COLON)} SELECT doc_id, section_no, title, md5(content) AS digest FROM sec",
    "chunk_documents": f"WITH RECURSIVE src AS (SELECT doc_id AS k, text AS content FROM documents WHERE text IS NOT NULL), {_fold('src')}"
    f" SELECT k AS doc_id, row_number() OVER (PARTITION BY k ORDER BY i) - 1 AS chunk_ix, md5(text) AS digest, len({_words('text')}) AS n_words FROM c WHERE text <> ''",
    "chunk_stats": f"WITH RECURSIVE {_sections(_COLON)}, src AS (SELECT doc_id || '/' || section_no AS k, title, content FROM sec), {_fold('src')}"
    f" SELECT title AS section_title, count(*) AS n_chunks, sum(w)::bigint AS total_words, round(avg(w), 6) AS mean_words FROM (SELECT title, len({_words('c.text')}) AS w FROM c JOIN src USING (k) WHERE text <> '') x GROUP BY 1",
    "doc_metadata": f"WITH {_sections(_UPPER)}, a AS (SELECT doc_id, string_agg(title, ' | ' ORDER BY section_no) AS sections, count(*) AS section_count FROM sec GROUP BY 1)"
    f" SELECT d.doc_id, source, lang, length(text) AS text_length, len({_words('text')}) AS word_count, section_count, sections FROM documents d LEFT JOIN a ON a.doc_id = d.doc_id",
    "chunk_frame": "SELECT chunk_id, length(text) AS text_length, coalesce(metadata.section_title, 'Unknown') AS section, CASE WHEN length(text) > 100 THEN left(text, 100) || '...' ELSE text END AS text_preview FROM chunks",
    "token_stats": f"SELECT count(*) AS n_chunks, coalesce(sum(len({_words('text')})), 0)::bigint AS total_words, round(coalesce(avg(len({_words('text')})), 0), 6) AS mean_words FROM chunks",
    "char_stats": "SELECT count(*) AS n_chunks, coalesce(sum(length(text)), 0)::bigint AS total_chars, round(coalesce(avg(length(text)), 0), 6) AS mean_chars, coalesce(min(length(text)), 0) AS min_chars, coalesce(max(length(text)), 0) AS max_chars FROM chunks",
    "section_counts": "SELECT coalesce(metadata.section_title, 'Unknown') AS section, count(*) AS n_chunks FROM chunks GROUP BY 1",
    "length_histogram": "WITH n AS (SELECT length(text) AS n FROM chunks WHERE text IS NOT NULL), s AS (SELECT min(n) AS lo, greatest((max(n) - min(n)) / 20.0::double, 1e-9::double) AS w FROM n),"
    " b AS (SELECT least(floor((n - lo) / w), 19)::bigint AS bin, lo, w FROM n, s) SELECT bin, round(min(lo + w * bin), 6) AS low, count(*) AS n FROM b GROUP BY bin",
    "chunk_selection": "SELECT chunk_id, chunk_ix FROM chunks WHERE chunk_ix BETWEEN 1 AND 2",
    "chunk_by_index": "SELECT chunk_id, chunk_ix FROM chunks WHERE chunk_ix = 1",
    "first_chunks": "SELECT chunk_id, chunk_ix FROM chunks ORDER BY chunk_id LIMIT 7",
    "markdown_export": "SELECT doc_id, md5('# Document ' || doc_id || chr(10) || chr(10) || '## Metadata' || chr(10) || chr(10) || '- **lang**: ' || coalesce(lang, '') || chr(10) || '- **source**: ' || coalesce(source, '')"
    " || chr(10) || chr(10) || '## Content' || chr(10) || chr(10) || coalesce(text, '')) AS digest FROM documents",
    "mention_counts": f"SELECT kind, mention, count(*) AS n FROM ({' UNION ALL '.join(_mention(k) for k in H.MENTION_PATTERNS)}) m GROUP BY 1, 2 HAVING count(*) >= 2",
    "year_events": f"WITH {_YEARS} SELECT doc_id, hit, year, title, md5(context) AS context FROM yt",
    "keyword_context": r"SELECT doc_id, indicator, coalesce(nullif(regexp_extract(ctx, '((?:[A-Z][\p{L}]*\s+){1,4}(?:University|Institute|Organization|Association|Society|Foundation))', 1), ''), 'Unknown Organization') AS name, md5(ctx) AS context FROM ("
    + _ORG.format(", ".join(f"'{x}'" for x in (*H.ORGANISATION_WORDS, "council", "ministry", "network", "report"))) + ") z",
    "first_entities": f"WITH {_YEARS} SELECT title, year, doc_id, hit FROM (SELECT *, row_number() OVER (PARTITION BY title, year ORDER BY doc_id, hit) AS r FROM yt) z WHERE r = 1",
    "example_hits": "SELECT doc_id, indicator FROM (" + _ORG.format("'council', 'ministry'") + ") z ORDER BY doc_id, indicator LIMIT 10",
    "tfidf_phrases": rf"""
WITH t AS (SELECT doc_id AS d, list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}'), lambda w: w NOT IN ({", ".join(f"'{s}'" for s in STOP)})) AS t FROM documents WHERE text IS NOT NULL),
g AS (SELECT d, unnest(t) AS term FROM t
  UNION ALL SELECT d, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM t
  UNION ALL SELECT d, unnest(list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])) FROM t),
tf AS (SELECT d, term, count(*) AS tf FROM g GROUP BY 1, 2),
n AS (SELECT count(*) AS n FROM documents),
v AS (SELECT term, ln((1 + n) / (1.0::double + df)) + 1 AS idf FROM (SELECT term, count(*) AS df, sum(tf) AS freq FROM tf GROUP BY 1) x, n WHERE df >= 2 AND df <= 0.7 * n ORDER BY freq DESC, term LIMIT 1000),
w AS (SELECT d, term, tf * idf AS w FROM tf JOIN v USING (term)),
m AS (SELECT d, sqrt(sum(w * w)) AS norm FROM w GROUP BY 1)
SELECT term, round(s, 8) AS weight FROM (SELECT term, sum(w / norm) / (SELECT n FROM n) AS s FROM w JOIN m USING (d) GROUP BY 1) z ORDER BY round(s, 12) DESC, term LIMIT 20""",
    "value_counts": "SELECT coalesce(doc_type, 'Unknown') AS doc_type, count(*) AS n FROM documents GROUP BY 1",
    "typed_csv": """
SELECT '"' || replace(coalesce(title, ''), '"', '""') || '"' AS title, '"' || coalesce(year::varchar, '') || '"' AS year, '"' || replace(coalesce(type, ''), '"', '""') || '"' AS type,
  '"' || coalesce(significance::varchar, '') || '"' AS significance, '"' || replace(coalesce(CASE WHEN length(description) > 200 THEN left(description, 200) || '...' ELSE description END, ''), '"', '""') || '"' AS description,
  '""' AS supporting_text FROM event_records""",
}
