"""Pattern-based mentions, keyword context, mention counts and TF-IDF phrases."""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import context_window, keyword_ladder
from graphloom.runtime import cut_lineage, spread

#: fixed values: mention patterns and the group that holds the mention
MENTION_PATTERNS = {
    "event": (r"(?:in|at|during|the)\s+([A-Z][a-zA-Z]*(?:\s+[A-Z][a-zA-Z]*){1,5}(?:\s+of\s+\d{4})?)", 1),
    "actor": (r"(?:[A-Z][a-zA-Z]*\s+){1,2}(?:University|Organization|Association|Foundation|Institute|Agency)", 0),
    "person": (r"(?:[A-Z][a-zA-Z]*\s+){1,2}(?:[A-Z][a-zA-Z]*)", 0),
    "concept": (r"(?:concept of|framework of|theory of|approach to)\s+([a-zA-Z]*(?:\s+[a-zA-Z]*){1,3})", 1),
    "publication": (r'(?:titled|entitled|publication|book|article|report)\s+"([^"]*)"', 1),
    "location": (r"(?:in|at|from)\s+([A-Z][a-zA-Z]*(?:,\s+[A-Z][a-zA-Z]*)?)", 1),
}
#: fixed values: organisation indicators and the ladder of event titles
ORGANISATION_WORDS = ("university", "institute", "organization", "association", "society", "foundation")
EVENT_TITLES = [
    (("conference",), "Conference"),
    (("publication",), "Publication"),
    (("established", "founded"), "Organization Founding"),
    (("report",), "Report"),
]
YEAR = r"\b(19|20)\d{2}\b"


def mentions(chunks: DataFrame, kinds: tuple[str, ...] = tuple(MENTION_PATTERNS), key: str = "chunk_id", text: str = "text") -> DataFrame:
    """(key, kind, mention), one row per match of the patterns asked for; null texts have none."""
    parts = F.array(
        *(F.struct(F.lit(k).alias("kind"), F.regexp_extract_all(F.col(text), F.lit(MENTION_PATTERNS[k][0]), F.lit(MENTION_PATTERNS[k][1])).alias("found")) for k in kinds)
    )
    return chunks.select(key, F.explode(parts).alias("p")).select(key, "p.kind", F.explode("p.found").alias("mention"))


def mention_counts(chunks: DataFrame, kinds: tuple[str, ...] = tuple(MENTION_PATTERNS), at_least: int = 2, key: str = "chunk_id", text: str = "text") -> DataFrame:
    """(kind, mention, n) of mentions found at least so often."""
    return mentions(chunks, kinds, key, text).groupBy("kind", "mention").agg(F.count("*").alias("n")).where(F.col("n") >= at_least)


def year_events(chunks: DataFrame, key: str = "chunk_id", text: str = "text", pattern: str = YEAR, compat: bool = False) -> DataFrame:
    """(key, hit, year, title, context): one row per year found.

    The year is the whole match and the context stands at its own position.
    ``compat`` takes the pattern's first group and gives every hit of a chunk the
    place of that group's first occurrence.
    """
    t = F.lower(F.col(text))
    if compat:
        hits = chunks.select(key, t.alias("t"), F.posexplode(F.regexp_extract_all(t, F.lit(pattern), F.lit(1))).alias("hit", "year"))
        rows = hits.withColumn("at", F.expr("locate(year, t)"))
    else:
        # the text before the n-th match gives its position
        hits = chunks.select(key, t.alias("t"), F.posexplode(F.regexp_extract_all(t, F.lit(pattern), F.lit(0))).alias("hit", "year"))
        before = F.expr(rf"array_join(slice(split(t, '{pattern.replace(chr(92), chr(92) * 2)}', hit + 2), 1, hit + 1), '0000')")
        rows = hits.withColumn("at", F.char_length(before) + 1)
    ctx = context_window("t", F.col("at"))
    return rows.select(key, "hit", F.col("year").try_cast("int").alias("year"), keyword_ladder(ctx, EVENT_TITLES, "Unknown Event").alias("title"), ctx.alias("context"))


def organisation_hits(chunks: DataFrame, key: str = "chunk_id", text: str = "text", indicators: tuple[str, ...] = ORGANISATION_WORDS, compat: bool = False) -> DataFrame:
    """(key, indicator, name, context): the first occurrence of each indicator word in a chunk.

    The name is the capitalised words up to the indicator; ``compat`` never finds
    one, since it looks in lower-cased text.
    """
    rows = chunks.select(key, F.col(text).alias("raw"), F.lower(F.col(text)).alias("t"), F.explode(F.array(*(F.lit(i) for i in indicators))).alias("indicator"))
    rows = rows.withColumn("at", F.expr("locate(indicator, t)")).where("at > 0")
    ctx = context_window("raw", F.col("at"))
    found = F.regexp_extract(ctx, r"((?:[A-Z][\p{L}]*\s+){1,4}(?:University|Institute|Organization|Association|Society|Foundation))", 1)
    name = F.lit("Unknown Organization") if compat else F.when(found != "", found).otherwise("Unknown Organization")
    return rows.select(key, "indicator", name.alias("name"), ctx.alias("context"))


def first_entities(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of every key in the given order; a hash aggregate, so large groups are combined before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    pick = F.min_by(F.struct(*rest), F.struct(*order)) if rest else None
    out = rows.groupBy(*keys).agg(pick.alias("r"))
    return out.select(*keys, "r.*")


def examples(rows: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """The first n rows in order (a top-k report)."""
    return rows.orderBy(*order).limit(n)


#: hash buckets of a vocabulary that is looked up inside a row
LOOKUP_BUCKETS = 64


def _looked_up(values: list[tuple[str, float, int]], term) -> Column:
    """The value of a term of (term, value, bucket), else null; in buckets, as a constant map is searched in order."""
    parts: list[list] = [[] for _ in range(LOOKUP_BUCKETS)]
    for t, v, at in values:
        parts[at] += [F.lit(t), F.lit(v)]
    table = F.array(*(F.create_map(*p) if p else F.create_map().cast("map<string,double>") for p in parts))
    return F.try_element_at(F.get(table, F.pmod(F.xxhash64(term), F.lit(LOOKUP_BUCKETS)).cast("int")), term)


def key_phrases(docs: DataFrame, n: int = 20, stop_words: tuple[str, ...] = (), max_words: int = 3, min_df: int = 2, max_df: float = 0.7, vocabulary: int = 1000, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(term, weight): top phrases of 1 to 3 words by mean L2-normalised smooth TF-IDF.

    Tokens are lower-case word characters of length two or more without stop
    words. Terms outside [min_df, max_df x documents] are left out; of the rest
    the ``vocabulary`` most frequent count (ties by term). Null texts count as
    documents without terms.

    A phrase is at most as frequent as each of its words, so only phrases of words
    that reach the last place of the single words are counted; the counts are
    combined map-side. Term counts and norms of a document stay in its row. The
    driver holds the vocabulary, which is bounded by its parameter.
    """
    spark = docs.sparkSession
    token = F.filter(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0)), lambda w: ~w.isin(*stop_words) if stop_words else F.lit(True))
    toks = spread(docs.select(text)).select(F.coalesce(token, F.array().cast("array<string>")).alias("t"))
    n_docs = docs.count()
    none = F.array().cast("array<string>")

    def at(k: int) -> Column:
        """0-based places of the phrases of k words."""
        return F.when(F.size("t") >= k, F.sequence(F.lit(0), F.size("t") - k)).otherwise(F.array().cast("array<int>"))

    def grams(k: int, places: Column | None = None) -> Column:
        return F.col("t") if k == 1 and places is None else F.transform(at(k) if places is None else places, lambda i: F.concat_ws(" ", *(F.get("t", i + j) for j in range(k))))

    def counted(terms: DataFrame) -> DataFrame:
        """(term, freq, df) of rows with an array ``g``."""
        tag = lambda c, f, d: F.transform(c, lambda x: F.struct(x.alias("term"), F.lit(f).alias("f"), F.lit(d).alias("d")))
        # outer, as the filter that is inferred for a plain explode would copy the making of ``g`` into each of its uses
        rows = terms.select(F.explode_outer(F.concat(tag(F.col("g"), 1, 0), tag(F.array_distinct("g"), 0, 1))).alias("x"))
        return rows.where("x.term IS NOT NULL").groupBy("x.term").agg(F.sum("x.f").alias("freq"), F.sum("x.d").alias("df"))

    def kept(counts: DataFrame) -> DataFrame:
        return counts.where((F.col("df") >= min_df) & (F.col("df") <= max_df * n_docs)).orderBy(F.desc("freq"), "term").limit(vocabulary)

    singles = cut_lineage(counted(toks.select(F.col("t").alias("g"))))
    best = kept(singles)
    last = best.agg(F.min("freq"), F.count("*")).first()
    least = last[0] if last[1] == vocabulary else min_df
    # words that a phrase of the vocabulary may hold
    able = singles.where(F.col("freq") >= least).select("term")
    found = [r[0] for r in able.limit(5 * vocabulary + 1).collect()]
    # when no word stands out, all phrases are counted
    ok = F.transform("t", lambda w: w.isin(*found)) if 0 < len(found) <= 5 * vocabulary else F.transform("t", lambda w: F.lit(True))
    marked = toks.withColumn("ok", ok)

    def able_grams(k: int) -> Column:
        return grams(k, F.filter(at(k), lambda i: functools.reduce(lambda a, b: a & b, [F.get("ok", i + j) for j in range(k)])))

    phrases = F.concat(*(able_grams(k) for k in range(2, max_words + 1))) if max_words > 1 else none
    counts = best if max_words < 2 else best.unionByName(kept(counted(marked.select(phrases.alias("g")))))
    vocab = kept(counts).select("term", "df", F.pmod(F.xxhash64("term"), F.lit(LOOKUP_BUCKETS)).alias("at")).collect()
    idf = [(r[0], math.log((1 + n_docs) / (1 + r[1])) + 1, r[2]) for r in vocab]
    known = [x[0] for x in idf] or [""]
    terms = F.array_sort(F.filter(F.concat(*(grams(k) for k in range(1, max_words + 1))), lambda g: g.isin(*known)))
    # equal terms stand together: a run's length is the term's count
    runs = toks.select(terms.alias("v"))
    first = F.filter(F.when(F.size("v") > 0, F.sequence(F.lit(0), F.size("v") - 1)).otherwise(F.array().cast("array<int>")), lambda i: (i == 0) | (F.get("v", i) != F.get("v", i - 1)))
    runs = runs.select("v", F.concat(first, F.array(F.size("v"))).alias("at"))
    tf = F.transform(F.slice("at", F.lit(1), F.size("at") - 1), lambda p, k: F.struct(F.get("v", p).alias("term"), ((F.get("at", k + 1) - p) * _looked_up(idf, F.get("v", p))).alias("w")))
    rows = runs.select(tf.alias("x")).withColumn("norm", F.sqrt(F.aggregate("x", F.lit(0.0), lambda acc, y: acc + y["w"] * y["w"])))
    score = rows.select(F.explode_outer("x").alias("x"), "norm").where("x.term IS NOT NULL").groupBy("x.term").agg(F.sum(F.col("x.w") / F.col("norm")).alias("s"))
    return score.select("term", (F.col("s") / F.lit(n_docs)).alias("weight")).orderBy(F.desc(F.round("weight", 12)), "term").limit(n)
