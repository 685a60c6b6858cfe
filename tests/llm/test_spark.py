"""Tests of the operators as plans: brute force on small fixtures, nulls, ties, repeated rows, empty tables, extra columns."""

import random
import re

import pytest
from pyspark.sql import functions as F

from graphloom.llm import boilerplate, canonical, garbled, leakage, names, neardup, split, survivor, tokenize


def test_assign(spark):
    can = spark.createDataFrame([("l", "Funds", "m", ["pays for"]), ("l", "Other", "m", None), ("l", None, "m", None)], "list_name string, entry string, meaning string, also_called array<string>")
    rows = [(1, "l", "funds"), (1, "l", "funds"), (2, "l", "Funds"), (3, "l", None), (4, "l", "  "), (5, "nolist", "Funds"), (6, None, "Funds"), (7, "l", "zebra crossing")]
    v = spark.createDataFrame(rows, "id int, list_name string, value string").withColumn("entry", F.lit("clash"))
    got = sorted((r.id, r.entry) for r in canonical.assign(v, can, ["id"]).collect())
    assert got == [(1, "Funds"), (1, "Funds"), (5, "UNMATCHED"), (6, "UNMATCHED"), (7, "UNMATCHED")]
    assert [r.entry for r in canonical.assign(v, can.limit(0), ["id"]).where("id = 2").collect()] == ["UNMATCHED"]
    assert canonical.assign(v.limit(0), can, ["id"]).count() == 0


def brute_pairs(rows, t=0.7):
    sets = {k: {w for w in re.findall(r"[^\W_]+", f"{a or ''} {b}".lower())} for k, a, b in rows if b and b.strip()}
    ks = sorted(sets)
    return {(a, b) for i, a in enumerate(ks) for b in ks[i + 1 :] if sets[a] | sets[b] and len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-12}


@pytest.mark.parametrize("block, cost, depth, sent", [(2000, 5000, 4, 1000), (3, 2, 4, 0), (3, 3, 2, 1000), (2000, 1, 6, 1000)])
def test_near_duplicates_against_brute_force(spark, block, cost, depth, sent, monkeypatch):
    for k, v in {"BLOCK": block, "COST": cost, "DEPTH": depth, "SENT": sent, "PAIRS": 500, "POSTINGS": 50, "RUN": 4}.items():
        monkeypatch.setattr(neardup, k, v)
    monkeypatch.setattr(neardup, "FREQUENT", 0.01)
    rng = random.Random(4)
    vocab = [f"t{i}" for i in range(60)] + ["the", "of", "a"] * 8
    rows = []
    for i in range(160):
        if rows and rng.random() < 0.5:
            ws = rng.choice(rows)[2].split()
            for _ in range(rng.randint(0, 4)):
                ws[rng.randrange(len(ws))] = rng.choice(vocab)
            rng.shuffle(ws)
        else:
            ws = [rng.choice(vocab) for _ in range(rng.randint(1, 30))]
        rows.append((i, rng.choice([None, "t1", "Of"]), " ".join(ws)))
    rows += [(500, "x", None), (501, "x", "   "), (502, None, "..."), (503, None, "..."), (504, None, "one"), (505, None, "ONE")]
    df = spark.createDataFrame(rows, "rec_id bigint, title string, description string").withColumn("rep", F.lit(1))
    members, pairs = neardup.near_duplicates(df, "rec_id", ("title", "description"), "description")
    got = {(r.rec_a, r.rec_b) for r in neardup.expand(members, pairs).collect()}
    assert got == brute_pairs(rows) and len(got) > 30
    report = {r.rec_id: r.class_id for r in neardup.class_report(members, pairs).collect()}
    assert report[504] == report[505] == 504 and 500 not in report and 502 not in report


def test_large_group_of_copies_stays_linear(spark):
    rows = [(i, None, "same words here") for i in range(50)] + [(100, "extra", "same words here"), (101, None, "same words here there")]
    df = spark.createDataFrame(rows, "rec_id bigint, title string, description string")
    members, pairs = neardup.near_duplicates(df, "rec_id", ("title", "description"), "description")
    got = {(r.rec_a, r.rec_b) for r in neardup.expand(members, pairs, full=10).collect()}
    assert got == {(0, i) for i in range(1, 50)} | {(0, 100), (0, 101)}
    assert {(r.rec_a, r.rec_b) for r in neardup.expand(members, pairs).collect()} == brute_pairs(rows)


def test_near_duplicates_of_nothing(spark):
    df = spark.createDataFrame([], "rec_id bigint, title string, description string")
    members, pairs = neardup.near_duplicates(df, "rec_id", ("title", "description"), "description")
    assert members.count() == 0 and neardup.expand(members, pairs).count() == 0


def _page(host, i, body, title):
    return (f"https://www.{host}-x.example/p/{i}", title, "\n".join(["Skip to content", f"{host.title()} Watch", "Home | News | Contact", f"Home > {title}", title, *body, "Read more", "Privacy policy", f"© 20{i:02d} {host.title()} Watch. All rights reserved."]))


def test_boilerplate(spark):
    rng = random.Random(1)
    w = lambda n: " ".join("".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(n))
    rows, want = [], set()
    cid = 0
    for h in range(4):
        for i in range(12):
            title = f"How {w(2)} changed {w(3)} in {w(1).title()}"
            body = [f"{w(9).capitalize()}.", f"Part {w(1)}", f"- {i} {w(2)}", f"{w(12).capitalize()}. {w(6).capitalize()}."]
            src, t, text = _page(f"site{chr(97 + h)}", i, body, title)
            cid += 1
            rows.append((cid, 0, text, (None, src, t, "web")))
            n = len(text.split("\n"))
            want |= {(cid, k) for k in (1, 2, 3, 4, n - 2, n - 1, n)}
    extra = [(900, 0, None, (None, "https://a.example/x", "t", "web")), (901, 0, "", (None, None, None, "web")), (902, 0, " \n\n", (None, "odd", "", "web")), (903, 0, "text", (None, None, None, "pdf")), (904, 0, "Alone here.", None)]
    df = spark.createDataFrame(rows + extra, "chunk_id bigint, chunk_ix int, text string, metadata struct<section_title:string,source:string,title:string,type:string>").withColumn("page", F.lit(1))
    got = {(r.chunk_id, r.line_no) for r in boilerplate.judge(df).where("furniture").collect()}
    assert len(got ^ want) <= 0.02 * len(want), sorted(got ^ want)[:20]
    arts = {r.chunk_id: r.article for r in boilerplate.articles(df).collect()}
    assert arts[901] == "" and 900 not in arts and "Privacy" not in arts[1] and arts[1].startswith("How ")
    assert boilerplate.judge(df.limit(0)).count() == 0


def test_pieces(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (4, "w " * 3000), (4, "w " * 3000)], "chunk_id bigint, text string").withColumn("start", F.lit(7))
    got = split.pieces(df).collect()
    assert {r.chunk_id for r in got} == {4} and len(got) == 2 * got[0].n_pieces
    one = sorted((r for r in got), key=lambda r: r.piece_no)[:: 2]
    assert "".join(r.text[r.body - r.start :] for r in one) == "w " * 3000


def test_survivors(spark):
    ts = "2020-01-0"
    rows = [
        (1, "a", "Good text here.", True, ts + "1", "City", None), (2, "a", "Better text here.", True, ts + "3", None, "r"), (3, "a", "Newest but unreviewed.", False, ts + "9", None, None),
        (4, "b", "N/A", True, ts + "1", None, None), (5, "b", "Cut off at the", True, ts + "1", None, None), (6, "b", "Auto-created actor from relationship: x.", True, ts + "1", None, None), (7, "b", "No description available.", True, ts + "1", None, None),
        (8, "c", "Alone with a text.", True, ts + "1", None, None), (9, "d", "Tie text.", None, None, None, None), (10, "d", "Tie text.", None, None, None, None), (11, None, "Null id.", True, ts + "1", None, None), (12, None, "Null id.", True, ts + "1", None, None),
        (13, "e", "Ends with dots...", True, ts + "5", None, None), (14, "e", "It ends well.”", False, ts + "1", None, None), (15, "e", None, True, ts + "1", None, None), (16, "e", "More to come. And then (truncated)", True, ts + "1", None, None),
    ]
    df = spark.createDataFrame(rows, "rec_id bigint, id string, description string, reviewed boolean, at string, type string, role string")
    df = df.select("*", F.to_timestamp_ntz("at").alias("revised_at"), *(F.lit(None).cast("string").alias(c) for c in ("name", "country", "supporting_text")), F.lit(1).cast("bigint").alias("source_chunk"), *(F.lit(None).cast("array<string>").alias(c) for c in ("expertise", "affiliations")), F.lit(0).alias("bundle"))
    got = {(r.id, r.bundle): r.rec_id for r in survivor.choose(df, "actors").collect()}
    assert {k[0]: v for k, v in got.items() if k[1] == "account"} == {"a": 2, "d": 9, "e": 14}
    built = {r.id: r for r in survivor.build(df, "actors").collect()}
    assert built["a"].description == "Better text here." and built["a"].type == "City"
    assert survivor.choose(df.limit(0), "actors").count() == 0


def test_names(spark):
    rows = [
        ("Tomasz Piganujasky", ["Ocean Science Netw. Jesususheholm", None, ""]), ("T.L. Piganujasky", None), ("PIGANUJASKY, TOMASZ", []), ("Lucia Piganujasky", ["Jesususheholm Network for Ocean Science", "OSN (Jesususheholm)"]),
        (None, None), ("", None), ("  ", None), ("Tomasz Piganujasky", None), ("Other Namevikilund", ["Jesususheholm Trust for Ocean Science"]),
    ]
    df = spark.createDataFrame(rows, "name string, affiliations array<string>").withColumn("form", F.lit("x"))
    found = names.entities(df)
    got = {(r.name_a, r.name_b) for r in names.variant_pairs(found).collect()}
    people = sorted(["Tomasz Piganujasky", "T.L. Piganujasky", "PIGANUJASKY, TOMASZ"])
    bodies = sorted(["Ocean Science Netw. Jesususheholm", "Jesususheholm Network for Ocean Science", "OSN (Jesususheholm)"])
    assert got == {(g[i], g[j]) for g in (people, bodies) for i in range(3) for j in range(i + 1, 3)}
    assert names.entities(df.limit(0)).count() == 0


def test_star_clusters(spark):
    edges = spark.createDataFrame([(1, 2, 0.9), (1, 3, 0.9), (3, 4, 0.95), (4, 5, 0.9), (8, 9, 0.9)], "a bigint, b bigint, score double")
    weight = spark.createDataFrame([(i, 0) for i in range(1, 10)], "fid bigint, weight int")
    got = {r.fid: r.center for r in names.star_clusters(edges, weight).collect()}
    assert got[1] == got[2] and got[8] == got[9] and set(got) >= {1, 2, 3, 4, 8, 9}
    assert names.star_clusters(edges.limit(0), weight).count() == 0


def test_token_ids(spark):
    df = spark.createDataFrame([(1, "Hello world"), (2, None), (3, ""), (1, "Hello world")], "doc_id bigint, text string").withColumn("ids", F.lit(0))
    got = [(r.doc_id, list(r.ids)) for r in tokenize.token_ids(df).collect()]
    assert sorted(got) == sorted([(1, [15496, 995])] * 2 + [(2, []), (3, [])])
    assert tuple(tokenize.corpus_counts(tokenize.token_ids(df.limit(0))).first()) == (0, 0, 0, 0)


def test_leaks(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    docs = spark.createDataFrame([(1, "x " + item.upper().replace(" ", "--") + " y"), (2, "one two three four five six seven eight nine ten eleven"), (3, None), (4, ""), (1, item)], "doc_id bigint, text string").withColumn("item_id", F.lit(0))
    items = spark.createDataFrame([(7, "s", item), (8, "s", "too short"), (9, "s", None)], "item_id bigint, suite string, text string")
    got = sorted((r.doc_id, r.item_id) for r in leakage.leaks(docs, items).collect())
    assert got == [(1, 7), (1, 7)]
    assert leakage.leaks(docs, items.limit(0)).count() == 0
    assert {r.item_id: r.n_docs for r in leakage.leak_report(leakage.leaks(docs, items), items).collect()} == {7: 1, 8: 0, 9: 0}


def test_garbled(spark):
    rng = random.Random(9)
    fr = ["la santé publique près de la forêt", "été très chaud à l'école où nous étions", "les élèves ont mangé à côté du café", "une énergie différente après l'été"]
    ru = ["вода в озере стала главной темой", "учёные сравнили здоровье жителей", "весной жара снова привлекла внимание"]
    rows, bad = [], set()
    for i in range(400):
        t = " ".join(rng.choice(fr if i % 3 else ru) for _ in range(3))
        k = rng.random()
        if k < 0.03:
            t = t.encode().decode("cp1252", "replace") if False else t.encode().decode("latin_1")
            bad.add(i)
        elif k < 0.05 and i % 3 == 0:
            t = t.encode("cp1251").decode("koi8_r")
            bad.add(i)
        rows.append((i, t, rng.choice(["a", "b", None])))
    rows += [(900, None, "a"), (901, "", "a"), (902, "plain ascii", None), (903, "lost � mark", "a"), (904, "AÇÃO À SÃO", "a"), (905, "x² ≤ ∑ αβ 🌍", "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("bucket", F.lit(1))
    got = {r.doc_id: r for r in garbled.diagnose(df).collect()}
    assert set(got) == bad | {903}
    clean = {r[0]: r[1] for r in rows}
    assert all(got[i].complete and "Ã" not in got[i].restored and got[i].restored != clean[i] for i in bad) and not got[903].complete
    assert garbled.diagnose(df.limit(0)).count() == 0


def test_registered_queries_name_their_sql():
    from graphloom.llm import queries

    assert set(queries.SQL) <= set(queries.QUERIES)
    assert {f"p{n}_found" for n in (1, 2, 3, 4, 5, 7, 9, 10)} | {"p8_ids"} <= set(queries.QUERIES)
