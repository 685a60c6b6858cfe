"""Recall of name links on invented names, by kind of variant; every part is common, so no part alone tells names apart."""

import random
from collections import Counter

import pytest

from graphloom.llm import names
from graphloom.llm.canonical import osa


def invented(rng, n, syllables):
    out = set()
    while len(out) < n:
        out.add("".join(rng.choice("bdfgklmnprstv") + rng.choice("aeiou") for _ in range(syllables)).capitalize() + rng.choice(["", "n", "s", "r"]))
    return sorted(out)


def typo(rng, w):
    i, r = rng.randrange(1, len(w) - 2), rng.random()
    if r < 0.4 and w[i] != w[i + 1]:
        return w[:i] + w[i + 1] + w[i] + w[i + 2 :]
    return w[:i] + w[i + 1 :] if r < 0.7 else w[:i] + rng.choice("xqzw") + w[i + 1 :]


@pytest.mark.parametrize("common", [8, 1000])
def test_recall_among_common_parts(spark, common, monkeypatch):
    monkeypatch.setattr(names, "COMMON", common)
    rng = random.Random(1)
    given, family = invented(rng, 25, 3), invented(rng, 25, 4)
    base = [(g, f) for g in given for f in family]
    planted = []
    for kind, n in (("typo", 40), ("initial", 40), ("both", 20), ("reordered", 20)):
        for g, f in rng.sample(base, n):
            a = {"typo": f"{g} {typo(rng, f)}", "initial": f"{g[0]}. {f}", "both": f"{typo(rng, f)}, {g[0]}.", "reordered": f"{f.upper()}, {g}"}[kind]
            planted.append((kind, f"{g} {f}", a))
    for short, full in (("Bill", "William"), ("Mike", "Michael"), ("Ted", "Edward"), ("Dick", "Richard"), ("Sasha", "Alexander")):
        planted += [("nickname", f"{full} {f}", f"{short} {f}") for f in rng.sample(family, 6)]
    planted += [("short", a, b) for a, b in (("Anna Lee", "A. Lee"), ("Jin Wu", "J. Wu"), ("William Li", "Bill Li"), ("Jack Ma", "J. Ma"), ("Ma, Jack", "Jack Ma"))]
    rows = sorted({f"{g} {f}" for g, f in base} | {x for p in planted for x in p[1:]})
    parsed = names.forms(names.spellings(spark.createDataFrame([(r, None) for r in rows], "name string, affiliations array<string>"))).cache()
    fid = {r.name: r.fid for r in parsed.collect()}
    got = {(r.a, r.b) for r in names.links(parsed).collect()}
    hit, total = Counter(), Counter()
    for kind, a, b in planted:
        x, y = sorted((fid[a], fid[b]))
        total[kind] += 1
        hit[kind] += x == y or (x, y) in got
    assert all(hit[k] >= 0.9 * n for k, n in total.items()), (hit, total)
    assert sum(hit.values()) >= 0.97 * sum(total.values())
    # of the full names only those are linked that are at most two typing errors apart
    name = {v: k for k, v in fid.items()}
    full = {f"{g} {f}" for g, f in base}
    for a, b in ((name[x], name[y]) for x, y in got):
        if a in full and b in full:
            assert sum(osa(x.lower(), y.lower(), 2) for x, y in zip(a.split(), b.split())) <= 2, (a, b)


def test_two_people_with_short_names_stay_apart():
    for a, b in (("Ann Li", "Jan Li"), ("Ann Li", "Ann Lu"), ("Jack Ma", "Jack Mo"), ("Anna Lee", "B. Lee")):
        assert names.verify(*names.parse(a), *names.parse(b)) < names.THRESHOLD, (a, b)


def test_pairs_of_a_large_entity(spark, monkeypatch):
    monkeypatch.setattr(names, "BLOCK", 7)
    rows = [(f"n{i:02}", 1) for i in range(40)] + [("x", 2), ("y", 3), ("z", 3)]
    got = sorted((r.name_a, r.name_b) for r in names.variant_pairs(spark.createDataFrame(rows, "name string, entity bigint")).collect())
    assert got == sorted([(f"n{i:02}", f"n{j:02}") for i in range(40) for j in range(i + 1, 40)] + [("y", "z")])
