"""Scalar column functions: normalisation, similarity, word counts, windows, ladders, formats."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: white space of text handling, as a character class
WS = r"[\t\n\x0b\x0c\r\x1c-\x20\x{85}\p{Z}]"

#: fixed values: short forms spelled out by name normalisation, in order of application
ABBREVIATIONS = (("ron", "rights of nature"), ("us", "united states"), ("uk", "united kingdom"))
#: fixed values: words whose agreement raises name similarity
SIMILARITY_KEYWORDS = ("rights", "nature", "environmental", "indigenous", "constitutional", "treaty", "development")
CONTAINMENT_SCORE, KEYWORD_BONUS, MATCH_THRESHOLD = 0.8, 0.2, 0.6
#: fixed values: quality level -> effect on a task's priority
QUALITY_BONUS = {"poor": 3, "fair": 1, "good": 0, "excellent": -1}


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """The string without white space at both ends."""
    return F.regexp_replace(col(c), f"^{WS}+|{WS}+$", "")


def words(c) -> Column:
    """White-space words, empty ones left out."""
    return F.filter(F.split(col(c), f"{WS}+"), lambda w: w != "")


def word_count(c) -> Column:
    return F.size(words(c))


def truncate(c, n: int) -> Column:
    """At most n characters followed by '...' when something was cut off."""
    return F.when(F.char_length(col(c)) > n, F.concat(F.left(col(c), F.lit(n)), F.lit("..."))).otherwise(col(c))


def context_window(text, position: Column, before: int = 50, after: int = 100) -> Column:
    """Characters around a 1-based position: ``before`` in front of it and ``after`` from it on."""
    start = F.greatest(position - before, F.lit(1))
    return F.substring(col(text), start, position + after - start)


def keyword_ladder(c, rules: list[tuple[tuple[str, ...], str]], default: str) -> Column:
    """The label of the first rule one of whose words the text holds."""
    t = F.lower(col(c))
    out = F.lit(default)
    for keys, label in reversed(rules):
        out = F.when(reduce(lambda a, b: a | b, [t.contains(k) for k in keys]), F.lit(label)).otherwise(out)
    return out


def year_in(c) -> Column:
    """The first four-digit year of the 20th or 21st century in the text, else null."""
    return F.when(col(c).rlike(r"\b(19|20)\d{2}\b"), F.regexp_extract(col(c), r"\b(19|20)\d{2}\b", 0).try_cast("int"))


def normalize_name(c) -> Column:
    """Lower-cased name without bracketed parts, leading article, trailing genre word and punctuation; short forms spelled out."""
    s = F.lower(col(c))
    s = F.regexp_replace(s, r"\([^)]*\)", "")
    s = strip(s)
    s = F.regexp_replace(s, f"^(the|a|an){WS}+", "")
    s = F.regexp_replace(s, f"{WS}+(movements?|laws?|concepts?|theory|theories|models?)$", "")
    for short, full in ABBREVIATIONS:
        s = F.regexp_replace(s, rf"(?<![\p{{L}}\p{{N}}_]){short}(?![\p{{L}}\p{{N}}_])", full)
    s = F.regexp_replace(s, r"[^\p{L}\p{N}_\s\p{Z}]", "")
    return strip(F.regexp_replace(s, f"{WS}+", " "))


def name_similarity(a, b, by_word: bool = False) -> Column:
    """Similarity of two normalised names: 0 empty, 1 equal, 0.8 contained, else token Jaccard plus a bonus when a keyword is shared, at most 1.

    ``by_word`` asks containment to fall on word boundaries.
    """
    a, b = col(a), col(b)
    ta, tb = F.array_distinct(words(a)), F.array_distinct(words(b))
    shared = F.array_intersect(ta, tb)
    jaccard = F.try_divide(F.size(shared).cast("double"), F.size(F.array_union(ta, tb)).cast("double"))
    bonus = F.when(F.arrays_overlap(shared, F.array(*(F.lit(k) for k in SIMILARITY_KEYWORDS))), KEYWORD_BONUS).otherwise(0.0)
    if by_word:
        pa, pb = F.concat(F.lit(" "), a, F.lit(" ")), F.concat(F.lit(" "), b, F.lit(" "))
        inside = pa.contains(pb) | pb.contains(pa)
    else:
        inside = a.contains(b) | b.contains(a)
    return (
        F.when((F.coalesce(a, F.lit("")) == "") | (F.coalesce(b, F.lit("")) == ""), F.lit(0.0))
        .when(a == b, F.lit(1.0))
        .when(inside, F.lit(CONTAINMENT_SCORE))
        .otherwise(F.least(F.lit(1.0), F.coalesce(jaccard, F.lit(0.0)) + bonus))
    )


def singular(key) -> Column:
    """A plural key without its last letter."""
    k = col(key)
    return F.when(k.endswith("s"), F.left(k, F.char_length(k) - 1)).otherwise(k)


def base_name(path) -> Column:
    """File name without folders and extension."""
    return F.regexp_replace(F.regexp_replace(col(path), r"^.*[/\\]", ""), r"\.[^.]*$", "")


def stable_id(*cols) -> Column:
    """Deterministic identifier of the given values, safe under task retries."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(col(c).cast("string"), F.lit("")) for c in cols)), 256)


def capitalize(c) -> Column:
    c = col(c)
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substring(c, 2, 1_000_000_000)))


def percent(numerator, denominator, digits: int = 1) -> Column:
    """A ratio as text such as '12.5%', ties to the even digit; null when the denominator is 0."""
    share = F.try_divide(col(numerator).cast("double"), col(denominator).cast("double")) * 100
    return F.when(share.isNotNull(), F.format_string(f"%.{digits}f%%", F.bround(share, digits)))


def csv_quote(c) -> Column:
    return F.concat(F.lit('"'), F.replace(F.coalesce(col(c).cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))


def url_part(c, part: str) -> Column:
    """HOST, PATH, QUERY, ... of an address; null when it is none."""
    return F.try_parse_url(col(c), F.lit(part))


def high_severity(issues, floor: int = 4) -> Column:
    """Number of issues of at least the given severity; a missing severity is 1."""
    return F.size(F.filter(F.coalesce(col(issues), F.array()), lambda x: F.coalesce(x["severity"], F.lit(1)) >= floor))


def priority_score(confidence, quality, n_high) -> Column:
    """Priority 1..10 of a review task from confidence (1 when missing), quality level and grave issues."""
    q = F.coalesce(col(quality), F.lit("poor"))
    bonus = F.lit(0)
    for level, x in QUALITY_BONUS.items():
        bonus = F.when(q == level, x).otherwise(bonus)
    raw = 6 - F.coalesce(col(confidence).cast("double"), F.lit(1.0)) + bonus + col(n_high)
    return F.greatest(F.lit(1), F.least(F.lit(10), raw.cast("int")))


def utf8_text(c) -> Column:
    """Bytes read as UTF-8 without what is no UTF-8; replacement characters of broken bytes' neighbours go as well."""
    s = col(c).cast("string")
    return F.when(F.is_valid_utf8(s), s).otherwise(F.replace(F.make_valid_utf8(s), F.lit("\ufffd"), F.lit("")))
