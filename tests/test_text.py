import random

import pytest
from pyspark.sql import functions as F

from graphloom.functions import text as X
from graphloom.operators import structure as S


def values(spark, items, expr, ddl="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {ddl}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_normalize_name(spark):
    cases = {
        "The Rights of Nature Movement": "rights of nature", "RoN (Ecuador)": "rights of nature", "US Clean Air Laws": "united states clean air", "The US": "united states",
        "U.S.": "us", "(The) Gaia Theory": "gaia", "Santé Publique!": "santé publique", "Models": "models", "the models": "models", "a  b-c": "bc", "": "", None: None,
    }
    assert values(spark, list(cases), X.normalize_name("v")) == list(cases.values())


@pytest.mark.parametrize(
    ("a", "b", "score"),
    [
        ("RoN", "The Rights of Nature Movement", 1.0), ("One Health", "One Health Initiative", 0.8), ("environmental treaty law", "treaty on environmental rights", 0.7),
        ("Earth Summit Rio", "Rio Earth Conference", 0.5), ("Art", "Earth", 0.8), ("Paris Agreement", "Kyoto Protocol", 0.0), ("", "x", 0.0), (None, "x", 0.0),
    ],
)
def test_similarity(spark, a, b, score):
    df = spark.createDataFrame([(a, b)], "a string, b string").select(X.normalize_name("a").alias("a"), X.normalize_name("b").alias("b"))
    got = df.select(X.name_similarity("a", "b")).first()[0]
    assert got == pytest.approx(score)


def test_similarity_by_word(spark):
    df = spark.createDataFrame([("art", "earth"), ("one health", "one health initiative")], "a string, b string")
    assert [r[0] for r in df.select(X.name_similarity("a", "b", True)).collect()] == [0.0, 0.8]


def test_priority(spark):
    rows = [(1.0, "poor", 1, 9), (5.0, "excellent", 0, 1), (3.5, "fair", 0, 3), (2.0, "good", 2, 6), (1.0, "poor", 9, 10), (None, None, 0, 8)]
    df = spark.createDataFrame(rows, "c double, q string, n int, want int")
    assert all(r[0] == r[1] for r in df.select(X.priority_score("c", "q", "n"), "want").collect())


def test_percent_ties_to_even_and_zero(spark):
    df = spark.createDataFrame([(5, 16), (0, 0)], "a int, b int")
    assert [r[0] for r in df.select(X.percent("a", "b")).collect()] == ["31.2%", None]


def brute_chunks(text, size, overlap, sep="\n\n", compat=False):
    out, cur, tok = [], "", 0
    for p in text.split(sep):
        if not p.strip():
            continue
        n = len(p.split())
        if tok + n > size and cur:
            out.append(cur.strip())
            w = cur.split()
            k = min(tok, overlap)
            tail = " ".join(w[-k:]) if k else (" ".join(w) if compat else "")
            cur, tok = (tail + sep + p if tail else p), k + n
        else:
            cur, tok = (cur + sep + p if cur else p), tok + n
    if cur.strip():
        out.append(cur.strip())
    return out


def test_chunker_golden(spark):
    t = "a b c\n\nd e\n\nf g"
    cases = [(t, 4, 2, False, ["a b c", "b c\n\nd e", "d e\n\nf g"]), (t, 4, 0, True, ["a b c", "a b c\n\nd e\n\nf g"]), ("a b c d e f\n\ng", 3, 1, False, ["a b c d e f", "f\n\ng"]), ("\n\n", 4, 2, False, [])]
    for text, size, overlap, compat, want in cases:
        got = values(spark, [text], S.chunk_text("v", size, overlap, compat=compat))[0]
        assert got == want, (text, size, overlap)


def test_chunker_random(spark):
    rng = random.Random(7)
    texts = ["\n\n".join(" ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 12))) for _ in range(60)] + [""]
    for size, overlap in ((5, 2), (8, 0), (3, 3), (1, 1)):
        assert values(spark, texts, S.chunk_text("v", size, overlap)) == [brute_chunks(t, size, overlap) for t in texts]


def test_sections(spark):
    docs = spark.createDataFrame([(1, "x\nA:\nB:\ny"), (2, None), (3, ""), (4, "HEAD\nbody\r\nmore")], "doc_id int, text string")
    colon = [(r.doc_id, r.title, r.content) for r in S.sections(docs, S.colon_header).orderBy("doc_id", "section_no").collect()]
    assert colon[:2] == [(1, "Introduction", "x\n"), (1, "B:", "y\n")] and {c[0] for c in colon} == {1, 4}
    upper = [(r.title, r.content) for r in S.sections(docs.where("doc_id = 4"), S.upper_header).collect()]
    assert upper == [("HEAD", "body\nmore\n")]


def test_html_and_dispatch(spark):
    html = "<!DOCTYPE html><html><head><title>T &amp; U</title><script>x<b></script></head><body><!-- no --><p>a &lt; b</p><p></p><p>c</p></body></html>"
    assert values(spark, [html, None], S.html_text("v")) == ["T & U\n\na < b\n\nc", None]
    assert values(spark, [html, "<p>x</p>"], S.html_title("v")) == ["T & U", None]
    assert values(spark, ["https://a/b.pdf", "x.PDF", "y.doc", "z.md", "noext"], S.source_kind("v")) == ["url", "pdf", "docx", "text", "text"]


def test_select_chunks(spark):
    df = spark.range(5).select(F.col("id").cast("int").alias("chunk_ix"))
    assert [r[0] for r in S.select_chunks(df, between=(1, 2)).orderBy("chunk_ix").collect()] == [1, 2]
    assert S.select_chunks(df, index=3, between=(0, 1)).first()[0] == 3
    assert S.select_chunks(df, first=2).count() == 2
    with pytest.raises(ValueError):
        S.select_chunks(df, index=9)


def test_statistics_of_nothing(spark):
    empty = spark.createDataFrame([], "chunk_id int, text string, metadata struct<section_title:string>")
    assert tuple(S.token_stats(empty).first()) == (0, 0, 0.0)
    assert tuple(S.char_stats(empty).first()) == (0, 0, 0.0, 0, 0)
    assert S.length_histogram(empty).count() == 0
