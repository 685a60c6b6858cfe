"""Tests that operators do the whole job: cases that shortcuts by form, size or share would lose."""

import random

from graphloom.llm import boilerplate, garbled, names, neardup


def test_garbled_characters_written_as_references(spark):
    rng = random.Random(3)
    fr = ["la santé publique près de la forêt", "été très chaud à l'école où nous étions", "les élèves ont mangé à côté du café"]
    refs = lambda s: "".join(c if ord(c) < 128 else f"&#{ord(c)};" for c in s)
    rows, bad = [], {}
    for i in range(300):
        t = clean = " ".join(rng.choice(fr) for _ in range(3))
        if i % 30 == 0:
            t = refs(t.encode().decode("cp1252", "replace") if "à" not in t else t.encode().decode("latin_1"))
            bad[i] = clean
        elif i % 30 == 1:
            t = refs(t)  # rightly decoded
        rows.append((i, t, "a"))
    assert all(rows[i][1].isascii() for i in bad)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.doc_id: r for r in garbled.diagnose(df).collect()}
    assert set(got) == set(bad)
    assert all(got[i].restored == t and got[i].complete and got[i].chain.endswith(">escaped") for i, t in bad.items())


def test_large_classes_give_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 50)
    rng = random.Random(5)
    words = "one two three four five six seven".split()
    rows = []
    for i in range(230):
        ws = list(words)
        rng.shuffle(ws)
        at = rng.randint(0, 3)
        rows.append((i, " ".join(ws[:at]), " ".join(ws[at:])))
    rows += [(500, None, "One two three four five six seven eight"), (501, "Eight", "seven six five four three two one")]
    df = spark.createDataFrame(rows, "rec_id bigint, title string, description string")
    found = neardup.near_duplicates(df, "rec_id", ("title", "description"), "description")
    got = [(r.rec_a, r.rec_b) for r in neardup.expand(*found).collect()]
    keys = [r[0] for r in rows]
    want = {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :]}
    assert len(got) == len(want) and set(got) == want


def test_a_star_holds_copies_of_one_text_only(spark):
    rows = [(i, None, "same words here") for i in range(30)] + [(40 + i, "Here", "words; same") for i in range(3)] + [(60, "", "here words same")]
    df = spark.createDataFrame(rows, "rec_id bigint, title string, description string")
    found = neardup.near_duplicates(df, "rec_id", ("title", "description"), "description")
    got = [(r.rec_a, r.rec_b) for r in neardup.expand(*found, full=10).collect()]
    texts = [0, 40, 41, 42, 60]
    want = {(0, i) for i in range(1, 30)} | {(a, b) for i, a in enumerate(texts) for b in texts[i + 1 :]}
    assert len(got) == len(want) and set(got) == want


def test_common_name_parts_still_meet(spark, monkeypatch):
    people = ["Katarina Smithers", "K. Smithers", "Smithers, K.L.", "Kate Smithers", "Catarina Smithers", "Katarina Smihters", "Alex Smithers", "Alexander Smithers", "Victoria Smithers", "Vicky Smithers", "Jan Smithers", "Jon Smithers", "Ursula Jonesberg"]
    bodies = ["Ocean Science Network Jesususheholm", "Ocean Scienec Netw. Jesususheholn", "OSN (Jesususheholm)", "OSN (Jesusushehlom)", "Air Health Trust Jesususheholm", "Forest Water Union Jesususheholm"]
    df = spark.createDataFrame([(n, None) for n in people + bodies], "name string, affiliations array<string>")
    parsed = names.forms(names.spellings(df))
    every = {r.fid: (r.form, list(r.parts)) for r in parsed.collect()}
    fids = sorted(every)
    want = {(a, b) for i, a in enumerate(fids) for b in fids[i + 1 :] if names.verify(*every[a], *every[b]) >= names.THRESHOLD}
    assert len(want) > 15
    for common in (2, 0):
        monkeypatch.setattr(names, "COMMON", common)
        assert {(r.a, r.b) for r in names.links(parsed).collect()} == want


def test_a_given_name_is_no_mistyped_family_name():
    pair = lambda a, b: names.verify(*names.parse(a), *names.parse(b))
    assert pair("B. Rozeruta", "Roberta Barusadidal") == 0
    assert pair("B. Rozeruta", "Benjamin Rozertua") > names.THRESHOLD


def test_copies_of_a_page_do_not_make_its_article_furniture(spark):
    rng = random.Random(2)
    w = lambda n: " ".join("".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(n))
    rows = []
    for i in range(40):
        title = f"How {w(2)} changed {w(3)}"
        body = [f"{w(9).capitalize()}.", f"{w(12).capitalize()}. {w(6).capitalize()}."]
        for k in range(30 if i == 0 else 1):
            rows.append((len(rows), 0, "\n".join(["Skip to content", title, *body, "Privacy policy"]), (None, f"https://www.site-x.example/{i}/{k}", title, "web")))
    df = spark.createDataFrame(rows, "chunk_id bigint, chunk_ix int, text string, metadata struct<section_title:string,source:string,title:string,type:string>")
    got = {(r.chunk_id, r.line_no) for r in boilerplate.judge(df).where("furniture").collect()}
    assert got == {(i, k) for i in range(len(rows)) for k in (1, 5)}
