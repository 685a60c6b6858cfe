"""Sources to sections and chunks: dispatch, HTML text, section rules, greedy chunker, metadata and statistics."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from graphloom.functions.text import WS, col, strip, truncate, word_count, words

FIRST_SECTION = "Introduction"


def source_kind(c) -> Column:
    """'url' for http(s) addresses, else the reader of the file's extension: pdf, docx or text."""
    c = col(c)
    ext = F.lower(F.regexp_extract(c, r"(\.[^./\\]*)$", 1))
    return (
        F.when(c.startswith("http://") | c.startswith("https://"), "url")
        .when(ext == ".pdf", "pdf")
        .when(ext.isin(".docx", ".doc"), "docx")
        .otherwise("text")
    )


def is_known_extension(c) -> Column:
    return F.lower(F.regexp_extract(col(c), r"(\.[^./\\]*)$", 1)).isin(".pdf", ".docx", ".doc", ".txt", ".md", ".rst")


@F.pandas_udf(StringType())
def unescape_html(c: pd.Series) -> pd.Series:
    """All named and numeric character references, as web readers take them; text without '&' passes untouched."""
    return c.map(lambda s: html.unescape(s) if s is not None and "&" in s else s)


#: a tag whose quoted attribute values may hold '>'
TAG = r"""<[a-zA-Z/?](?:"[^"]*+"|'[^']*+'|[^'">])*+>"""


def html_text(page) -> Column:
    """All text nodes of a page joined by blank lines; scripts, styles, comments and declarations hold no text."""
    s = F.regexp_replace(col(page), r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", "")
    s = F.regexp_replace(s, r"(?s)<!--.*?-->", "")
    s = F.regexp_replace(s, r"(?is)<!doctype[^>]*>", "")
    # blank lines stand between nodes, so no reference reaches over a node's end
    return unescape_html(F.array_join(F.filter(F.split(s, TAG), lambda x: x != ""), "\n\n"))


def html_title(page) -> Column:
    """Content of the first title element, else null."""
    t = F.regexp_extract(col(page), r"(?is)<title[^>]*>(.*?)</title>", 1)
    return unescape_html(F.when(t != "", t))


def normalize_newlines(c) -> Column:
    return F.regexp_replace(col(c), r"\r\n?", "\n")


def upper_header(line) -> Column:
    """A short line whose letters are all upper case."""
    s = strip(line)
    return (s != "") & (F.char_length(s) < 100) & (F.upper(s) == s) & (F.lower(s) != s)


def colon_header(line) -> Column:
    s = strip(line)
    return (s != "") & s.endswith(":")


def style_header(style) -> Column:
    """A paragraph whose style name begins with 'Heading'."""
    return F.coalesce(col(style).startswith("Heading"), F.lit(False))


def with_sections(docs: DataFrame, header, text: str = "text", into: str = "sections") -> DataFrame:
    """Documents with their sections as an array of (title, content), cut at header lines.

    Text before the first header belongs to 'Introduction'. Sections with a blank
    body are dropped, so a header followed by another header leaves no trace. Null
    texts have null. The lines of a section are a slice of its document's lines, so
    the cost is linear in the text and nothing is shuffled.
    """
    lines, heads = F.col("_lines"), F.col("_heads")
    cut = docs.withColumn("_lines", F.split(normalize_newlines(text), "\n"))
    # 1-based places of the header lines; 0 opens the part before the first one
    places = F.filter(F.transform(lines, lambda line, i: F.when(header(line), i + 1)), lambda x: x.isNotNull())
    cut = cut.withColumn("_heads", F.concat(F.array(F.lit(0)), places, F.array(F.size(lines) + 1)))

    def section(at: Column, k: Column) -> Column:
        body = F.slice(lines, at + 1, F.get(heads, k + 1) - at - 1)
        return F.struct(
            F.when(at == 0, F.lit(FIRST_SECTION)).otherwise(strip(F.get(lines, at - 1))).alias("title"),
            F.concat(F.array_join(body, "\n"), F.lit("\n")).alias("content"),
        )

    every = F.transform(F.slice(heads, F.lit(1), F.size(heads) - 1), section)
    return cut.withColumn(into, F.filter(every, lambda x: strip(x["content"]) != "")).drop("_lines", "_heads")


def sections(docs: DataFrame, header, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, section_no, title, content): the sections of :func:`with_sections` as rows, numbered from 1."""
    rows = with_sections(docs.select(key, F.col(text).alias("_t")), header, "_t", "_s").select(key, F.posexplode_outer("_s").alias("n", "s"))
    return rows.where("s IS NOT NULL").select(key, (F.col("n") + 1).alias("section_no"), "s.title", "s.content")


def styled_sections(paragraphs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Sections of (key, pos, style, text) paragraphs; a heading style opens one, bodies are joined by single newlines."""
    w = Window.partitionBy(key).orderBy("pos")
    marked = paragraphs.withColumn("head", style_header("style")).withColumn("grp", F.sum(F.col("head").cast("int")).over(w))
    lines = F.array_sort(F.collect_list(F.when(~F.col("head") & (strip("text") != ""), F.struct("pos", "text"))))
    out = marked.groupBy(key, "grp").agg(
        F.max(F.when(F.col("head"), F.col("text"))).alias("title"), F.array_join(F.transform(lines, lambda x: x["text"]), "\n").alias("content")
    )
    return out.where(strip("content") != "").select(
        key, F.row_number().over(Window.partitionBy(key).orderBy("grp")).alias("section_no"), F.coalesce("title", F.lit(FIRST_SECTION)).alias("title"), "content"
    )


def chunk_text(c, size: int = 1000, overlap: int = 100, paragraph_sep: str = "\n\n", compat: bool = False) -> Column:
    """Array of chunks: paragraphs packed greedily up to ``size`` words; a paragraph is never split.

    A new chunk begins with the last ``overlap`` words of the one before. Blank
    paragraphs are skipped. ``compat`` keeps the whole previous chunk when the
    overlap is 0. A fold over the paragraphs of one row: no shuffle.
    """
    # the words of a paragraph are counted once
    paras = F.transform(F.filter(F.split(col(c), _literal(paragraph_sep)), lambda p: strip(p) != ""), lambda p: F.struct(p.alias("p"), word_count(p).alias("n")))
    state = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"), F.lit(0).alias("tok"))

    def step(acc: Column, para: Column) -> Column:
        p, n = para["p"], para["n"]
        flush = (acc["tok"] + n > size) & (acc["cur"] != "")
        prev = words(acc["cur"])
        if overlap == 0 and not compat:
            joined, k = p, F.lit(0)
        else:
            k = F.least(acc["tok"], F.lit(overlap))
            tail = prev if overlap == 0 else F.when(k < 1, F.array().cast("array<string>")).otherwise(F.reverse(F.slice(F.reverse(prev), F.lit(1), k)))
            joined = F.array_join(F.filter(F.array(F.array_join(tail, " "), p), lambda x: x != ""), paragraph_sep)
        return F.struct(
            F.when(flush, F.concat(acc["done"], F.array(strip(acc["cur"])))).otherwise(acc["done"]).alias("done"),
            F.when(flush, joined).when(acc["cur"] == "", p).otherwise(F.concat(acc["cur"], F.lit(paragraph_sep), p)).alias("cur"),
            F.when(flush, k + n).otherwise(acc["tok"] + n).alias("tok"),
        )

    return F.aggregate(paras, state, step, lambda acc: F.when(strip(acc["cur"]) != "", F.concat(acc["done"], F.array(strip(acc["cur"])))).otherwise(acc["done"]))


def _literal(s: str) -> str:
    return "\\Q" + s + "\\E"


def chunk_documents(docs: DataFrame, size: int = 1000, overlap: int = 100, paragraph_sep: str = "\n\n", key: str = "doc_id") -> DataFrame:
    """(key, section_no, section_title, chunk_ix, text) of documents with ``sections`` (array of title, content) or else ``text``.

    chunk_ix counts from 0 over the document. Null documents give no chunk.
    """
    whole = F.array(F.struct(F.lit(None).cast("string").alias("title"), F.col("text").alias("content")))
    parts = F.when(F.size("sections") > 0, F.col("sections")).otherwise(whole) if "sections" in docs.columns else whole

    def chunks_of(s: Column, no: Column) -> Column:
        texts = F.coalesce(chunk_text(s["content"], size, overlap, paragraph_sep), F.array().cast("array<string>"))
        return F.transform(texts, lambda t: F.struct(no.alias("section_no"), s["title"].alias("section_title"), t.alias("text")))

    # outer, as the filter that is inferred for a plain explode would make the chunks twice
    rows = docs.select(key, F.posexplode_outer(F.flatten(F.transform(parts, chunks_of))).alias("chunk_ix", "c"))
    return rows.where("c IS NOT NULL").select(key, "c.section_no", "c.section_title", "chunk_ix", "c.text")


def document_metadata(docs: DataFrame, sections_of: DataFrame | None = None, key: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """Length and word count of each text, with the section titles and their number when the document has sections."""
    base = docs.select(key, *carry, F.char_length("text").alias("text_length"), word_count("text").alias("word_count"))
    if sections_of is None:
        return base
    titles = sections_of.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section_no", "title"))), lambda x: x["title"]), " | ").alias("sections"),
        F.count("*").alias("section_count"),
    )
    return base.join(titles, key, "left")


def chunk_frame(chunks: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Tabular view of chunks: length, section ('Unknown' by default), page (never known) and a preview."""
    return chunks.select(
        key,
        F.char_length("text").alias("text_length"),
        F.coalesce(F.col("metadata.section_title"), F.lit("Unknown")).alias("section"),
        F.lit(None).cast("int").alias("page"),
        truncate("text", 100).alias("text_preview"),
    )


def token_stats(chunks: DataFrame) -> DataFrame:
    """One row: chunks, words in all, mean words per chunk (0 for none)."""
    n = word_count("text")
    return chunks.agg(
        F.count("*").alias("n_chunks"),
        F.coalesce(F.sum(F.when(F.col("text").isNotNull(), n)), F.lit(0)).cast("bigint").alias("total_words"),
        F.coalesce(F.avg(F.when(F.col("text").isNotNull(), n)), F.lit(0.0)).alias("mean_words"),
    )


def section_counts(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy(F.coalesce(F.col("metadata.section_title"), F.lit("Unknown")).alias("section")).agg(F.count("*").alias("n_chunks"))


def char_stats(chunks: DataFrame) -> DataFrame:
    """One row: chunks, characters in all, mean, least and most (0 for none)."""
    n = F.char_length("text")
    zero = F.lit(0)
    return chunks.agg(
        F.count("*").alias("n_chunks"),
        F.coalesce(F.sum(n), zero).cast("bigint").alias("total_chars"),
        F.coalesce(F.avg(n), F.lit(0.0)).alias("mean_chars"),
        F.coalesce(F.min(n), zero).alias("min_chars"),
        F.coalesce(F.max(n), zero).alias("max_chars"),
    )


def length_histogram(chunks: DataFrame, bins: int = 20) -> DataFrame:
    """(bin, low, n) of text lengths in equally wide bins; empty bins are absent. The range is a one-row aggregate."""
    rows = chunks.select(F.char_length("text").alias("n")).where(F.col("n").isNotNull())
    span = rows.agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    width = F.greatest((F.col("hi") - F.col("lo")) / F.lit(float(bins)), F.lit(1e-9))
    # span is a single row
    return (
        rows.join(F.broadcast(span))
        .select(F.least(F.floor((F.col("n") - F.col("lo")) / width), F.lit(bins - 1)).cast("int").alias("bin"), (F.col("lo") + width * F.least(F.floor((F.col("n") - F.col("lo")) / width), F.lit(bins - 1))).alias("low"))
        .groupBy("bin")
        .agg(F.min("low").alias("low"), F.count("*").alias("n"))
    )


def select_chunks(chunks: DataFrame, index: int | None = None, between: tuple[int, int] | None = None, first: int | None = None, ix: str = "chunk_ix") -> DataFrame:
    """One chunk by index, else an inclusive range, else the first n; original indices are kept.

    An index or range outside the data is an error, as nothing could be processed.
    """
    if index is not None or between is not None:
        lo, hi = (index, index) if index is not None else between
        out = chunks.where(F.col(ix).between(lo, hi))
        if lo > hi or out.isEmpty():
            raise ValueError(f"no chunk in {lo}-{hi}")
        return out
    return chunks.orderBy(ix).limit(first) if first is not None else chunks


def markdown(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, markdown): title, bullets of the other metadata (a map, in key order) and the text."""
    meta = F.array_join(
        F.transform(F.array_sort(F.map_entries("metadata")), lambda e: F.concat(F.lit("- **"), e["key"], F.lit("**: "), e["value"])), "\n"
    )
    return docs.select(
        key,
        F.concat(F.lit("# "), F.coalesce("title", F.lit("Untitled")), F.lit("\n\n## Metadata\n\n"), meta, F.lit("\n\n## Content\n\n"), F.coalesce("text", F.lit(""))).alias("markdown"),
    )
