"""Problem 7: variant spellings of persons and organisations.

Method: MinHash banding over padded q-grams of the distinguishing name parts,
with the number of bands taken from the collision curve; candidates are verified
by a symmetric Monge-Elkan similarity that knows initials, short forms and
acronyms; verified links are clustered by star clustering.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.canonical import osa
from graphloom.runtime import cut_lineage, spread

Q, ROWS = 2, 4
#: similarity of q-gram sets that must meet, and with which probability
MEET, RECALL = 0.5, 0.98
#: forms that hold a part of more canonical forms than this meet on it together with a second trait of the name
COMMON = 64
#: spellings of one entity in a block of the pair list
BLOCK = 1000
#: least Monge-Elkan similarity, and most typing errors between two writings of one name
THRESHOLD, MAX_EDITS = 0.8, 2

#: fixed values: titles and degrees; DEGREES may also be names and are titles only beside two other parts
DEGREES = frozenset("ma ba ing jr sr hon".split())
TITLES = frozenset("dr prof professor mr mrs ms mx sir dame phd md msc bsc ma ba mba dphil rev hon ing dipl jr sr".split())
#: fixed values: words of organisation names without meaning of their own
LINK_WORDS = frozenset("the of for and de der die das und fur et la le du des y".split())
#: fixed values: additions to organisation names
ADDITIONS = frozenset("secretariat office ev eV gmbh inc ltd llc plc ngo headquarters hq".lower().split())
#: fixed values: kinds of organisation and their shortened writings
KINDS = {
    "agency": ("agcy", "agy", "agc"), "alliance": ("all", "allnc"), "association": ("assoc", "assn", "ass"), "centre": ("ctr", "cent", "center", "cntr"),
    "coalition": ("coal", "coaln"), "council": ("cncl", "coun", "cl"), "foundation": ("fdn", "found", "fndn"), "institute": ("inst", "instit"),
    "ministry": ("min", "minist"), "network": ("netw", "net", "ntwk"), "trust": ("tr", "trst"), "university": ("univ", "uni"),
    "organisation": ("org", "organization"), "society": ("soc",), "department": ("dept", "dep"), "committee": ("cttee", "comm"), "college": ("coll",),
    "academy": ("acad",), "union": (), "commission": ("commn",), "hospital": ("hosp",), "laboratory": ("lab",), "federation": ("fed",), "group": ("grp",),
}
#: fixed values: short forms of given names that are no prefix of them (a parameter of :func:`entities`)
NICKNAMES = {
    "jack": ("john",), "johnny": ("john",), "jim": ("james",), "jimmy": ("james",), "jamie": ("james",), "mike": ("michael",), "mick": ("michael",), "mickey": ("michael",), "dick": ("richard",), "rick": ("richard",),
    "ricky": ("richard",), "ted": ("edward", "theodore"), "teddy": ("theodore", "edward"), "ned": ("edward",), "eddie": ("edward",), "chuck": ("charles",), "charlie": ("charles",), "hal": ("henry",), "rob": ("robert",), "bobby": ("robert",),
    "billy": ("william",), "willie": ("william",), "liam": ("william",), "tony": ("anthony", "antonio"), "andy": ("andrew",), "drew": ("andrew",), "joe": ("joseph",), "joey": ("joseph",), "jerry": ("gerald", "jeremy"), "larry": ("lawrence",),
    "pat": ("patrick", "patricia"), "paddy": ("patrick",), "steve": ("stephen", "steven"), "dave": ("david",), "matt": ("matthew",), "greg": ("gregory",), "jeff": ("jeffrey", "geoffrey"), "ron": ("ronald",), "ken": ("kenneth",),
    "maggie": ("margaret",), "madge": ("margaret",), "daisy": ("margaret",), "molly": ("mary",), "polly": ("mary",), "mamie": ("mary",), "sally": ("sarah",), "sadie": ("sarah",), "nancy": ("anne", "ann"), "annie": ("anne", "anna"),
    "nan": ("anne",), "jenny": ("jennifer", "jane"), "katie": ("katherine", "catherine"), "kathy": ("katherine", "catherine"), "kitty": ("katherine", "catherine"), "susie": ("susan",), "sue": ("susan",), "debbie": ("deborah",), "becky": ("rebecca",), "trudy": ("gertrude",),
    "nell": ("helen", "eleanor"), "nora": ("eleanor", "honora"), "sandy": ("alexander", "sandra"), "abby": ("abigail",), "mandy": ("amanda",), "cindy": ("cynthia",), "fred": ("frederick", "alfred"), "pepe": ("jose",), "paca": ("francisca",), "misha": ("mikhail",),
    "vanya": ("ivan",), "kolya": ("nikolai",), "seppi": ("josef",), "fritz": ("friedrich",), "hans": ("johannes",), "gigi": ("luigi",), "beppe": ("giuseppe",), "nacho": ("ignacio",), "lupe": ("guadalupe",), "quique": ("enrique",),
    "bobbie": ("roberta", "robert"), "bob": ("robert",), "bill": ("william",), "paco": ("francisco",), "pancho": ("francisco",), "kiko": ("francisco",),
    "nastya": ("anastasia",), "stacy": ("anastasia",), "asya": ("anastasia",), "greta": ("margareta",), "rita": ("margareta", "margaret"), "meg": ("margareta", "margaret"), "peggy": ("margareta", "margaret"), "gretel": ("margareta",),
    "bella": ("isabella",), "izzy": ("isabella",), "dot": ("dorothea",), "dolly": ("dorothea",), "dottie": ("dorothea",), "thea": ("dorothea", "theodora"), "dora": ("theodora", "dorothea"),
    "lis": ("elisabeth",), "liz": ("elisabeth", "elizabeth"), "lisa": ("elisabeth", "elizabeth"), "beth": ("elisabeth", "elizabeth"), "betty": ("elisabeth", "elizabeth"), "elsa": ("elisabeth",), "vicky": ("victoria",), "tori": ("victoria",),
    "kit": ("christopher",), "kate": ("katarina", "katherine", "catherine"), "katya": ("katarina",), "kasia": ("katarina",), "katja": ("katarina",), "sasha": ("alexander",), "xander": ("alexander",), "alec": ("alexander",), "lex": ("alexander",),
    "niko": ("nikolas",), "nick": ("nikolas", "nicholas"), "klaus": ("nikolas",), "nico": ("nikolas",), "tomek": ("tomasz",), "tom": ("tomasz", "thomas"), "pasha": ("pavel",), "pepa": ("josefina",), "fina": ("josefina",), "josie": ("josefina",), "pepita": ("josefina",),
    "lucy": ("lucia",), "lulu": ("lucia",), "hank": ("henrik", "henry"), "harry": ("henrik", "henry", "harold"), "rik": ("henrik",), "heiner": ("henrik",), "uschi": ("ursula",), "ulla": ("ursula",), "gaby": ("gabriela",), "ella": ("gabriela", "isabella"), "inge": ("ingrid",),
    "max": ("maximilian",), "maks": ("maximilian",), "danny": ("daniel",), "benny": ("benjamin",), "sammy": ("samuel",), "jas": ("jasper",), "kaspar": ("jasper",), "len": ("leonardo",), "lenny": ("leonardo",), "mimi": ("mirela",), "fi": ("fiona",), "quin": ("quentin",),
}

Table = dict[str, tuple[str, ...]]


@functools.cache
def _given_names(pairs: tuple) -> frozenset[str]:
    return frozenset(x for short, full in pairs for x in (short, *full))


_KIND_OF = {s: k for k, ss in KINDS.items() for s in (k, *ss)}
_KIND_LETTERS = tuple((k, frozenset(k)) for k in KINDS)
_WORD = re.compile(r"[^\W_]+")


def fold(s: str) -> str:
    """Letters without accents, in lower case."""
    s = unicodedata.normalize("NFKD", s.replace("ß", "ss").replace("ø", "o").replace("ł", "l").replace("ı", "i"))
    return "".join(c for c in s if not unicodedata.combining(c)).lower()


@functools.lru_cache(100_000)
def _kind(token: str) -> str | None:
    """The kind of organisation a token writes, with at most one typing error in six letters."""
    if token in _KIND_OF:
        return _KIND_OF[token]
    if len(token) >= 5:
        letters = frozenset(token)
        for k, own in _KIND_LETTERS:
            # an edit changes at most two of the letters that the words hold
            if abs(len(k) - len(token)) <= 2 and len(letters ^ own) <= 4 and osa(token, k, 2) <= (2 if len(k) >= 7 else 1):
                return k
    return None


def parse(name: str) -> tuple[str, tuple[str, ...]]:
    """(form, parts): form 'person', 'org', 'acronym' or ''; parts folded, expanded and sorted, initials last in their order."""
    raw = re.sub(r"[​-‏⁠﻿]", "", name).replace("&", " and ")
    raw = re.sub(r"\be\.\s?V\.?", " ", raw)
    # a country or other code set off at the end is no part of the name
    bare = re.sub(r"[\s\xa0]*(\((?-i:[A-Z]{2})\)|,[\s\xa0]*(?-i:[A-Z]{2}))[\s\xa0]*$", "", raw)
    words = _WORD.findall(bare)
    folded = [fold(w) for w in words]
    kinds = [k for w in folded if (k := _kind(w))]
    # a lone "Min" or "All" beside two plain words may still be a name part; shortened kinds count with a link word, dot or third word
    is_org = bool(kinds) and len([w for w in folded if w not in TITLES and len(w) > 1]) >= 3
    if not is_org:
        short = [w for w in words if len(w) in (2, 3, 4) and w.isupper() and w.isalpha() and fold(w) not in TITLES]
        others = [w for w in words if w not in short and len(w) > 3]
        if len(short) == 1 and len(others) == 1 and not others[0].isupper() and "." not in bare:
            return "acronym", (fold(short[0]), fold(others[0]))
        # "Jack Ma" has no degree: what may be a name stays beside fewer than two other parts
        titles = TITLES if len([w for w in folded if w not in TITLES]) > 1 else TITLES - DEGREES
        parts = [w for w in folded if w not in titles]
        long = [w for w in parts if len(w) > 1]
        if not long:
            return ("", ())
        # "KA Smith" writes two initials
        out = []
        for w, o in zip(folded, words):
            if w in titles:
                continue
            out += list(w) if len(w) == 2 and o.isupper() and len(long) > 1 else [w]
        return "person", (*sorted(w for w in out if len(w) > 1), *(w for w in out if len(w) == 1))
    parts = []
    for w in folded:
        if w in LINK_WORDS or w in ADDITIONS or len(w) == 1:
            continue
        if len(w) <= 4 and w not in _KIND_OF and any(osa(w, x, 1) <= 1 for x in ("the", "of", "for", "and")) and w not in ("air", "sea", "art", "fox", "far", "fur", "or"):
            continue  # a mistyped link word
        if w == "or" or w == "fur":
            continue
        parts.append(_kind(w) or w)
    return "org", tuple(sorted(parts))


def _similar(a: str, b: str) -> float:
    if a == b:
        return 1.0
    m = max(len(a), len(b))
    lim = max(1, int(0.34 * m))
    d = osa(a, b, lim)
    return 1 - d / m if d <= lim else 0.0


def _given(a: str, b: str, table: Table = NICKNAMES) -> float:
    """Similarity of two given names: short forms and prefixes count as nearly equal."""
    s = _similar(a, b)
    if s >= 0.7:
        return s
    for x, y in ((a, b), (b, a)):
        for full in table.get(x, ()):
            if _similar(full, y) >= 0.75:
                return 0.9
        if len(x) >= 3 and y.startswith(x):
            return 0.9
    return s


def _initials_of(token: str, table: Table = NICKNAMES) -> set[str]:
    return {token[0], *(f[0] for f in table.get(token, ()))}


def monge_elkan(a: list[str], b: list[str]) -> float:
    """Symmetric Monge-Elkan similarity of two token lists."""
    if not a or not b:
        return 0.0
    one = sum(max(_similar(x, y) for y in b) for x in a) / len(a)
    two = sum(max(_similar(x, y) for x in a) for y in b) / len(b)
    return min(one, two)


def verify(fa: str, pa: list[str], fb: str, pb: list[str], table: Table = NICKNAMES) -> float:
    """Similarity of two parsed names, 0 when they cannot be the same."""
    if fa == "person" and fb == "person":
        return _verify_person(list(pa), list(pb), table)
    if fa == fb == "org":
        return _verify_org(list(pa), list(pb))
    if fa == fb == "acronym":
        return monge_elkan([pa[1]], [pb[1]]) * (pa[0] == pb[0]) * (osa(pa[1], pb[1], MAX_EDITS) <= MAX_EDITS)
    if {fa, fb} == {"org", "acronym"}:
        (short, place), parts = (pa, list(pb)) if fa == "acronym" else (pb, list(pa))
        best = max(parts, key=lambda t: _similar(place, t), default="")
        s = _similar(place, best)
        rest = list(parts)
        if osa(place, best, MAX_EDITS) > MAX_EDITS or s < 0.75:
            return 0.0
        rest.remove(best)
        return 0.9 * s if sorted(t[0] for t in rest) == sorted(short) else 0.0
    return 0.0


def _verify_org(a: list[str], b: list[str]) -> float:
    if len(a) != len(b):
        return 0.0
    ka, kb = {t for t in a if t in KINDS}, {t for t in b if t in KINDS}
    if ka and kb and not ka & kb:
        return 0.0
    left = list(b)
    total, edits = 0.0, 0
    for x in sorted(a, key=len, reverse=True):
        y = max(left, key=lambda t: _similar(x, t))
        s = _similar(x, y)
        if s < 0.6:
            return 0.0
        edits += osa(x, y, MAX_EDITS)
        left.remove(y)
        total += s
    return total / len(a) if edits <= MAX_EDITS else 0.0


def _verify_person(a: list[str], b: list[str], table: Table = NICKNAMES) -> float:
    la, lb = [t for t in a if len(t) > 1], [t for t in b if len(t) > 1]
    ia, ib = [t for t in a if len(t) == 1], [t for t in b if len(t) == 1]
    # the family name: the pair of long parts that agrees best, longer parts first; a pair that agrees enough before others
    fits = lambda p: p[0] >= (0.74 if p[1] >= 8 else 1.0)
    pairs = [(_similar(x, y), len(x) + len(y), i, j) for i, x in enumerate(la) for j, y in enumerate(lb)]
    pairs.sort(key=lambda p: (fits(p), round(p[0], 2) * (p[1] >= 10), p[1]), reverse=True)
    # a short family name must be equal
    if not pairs or not fits(pairs[0]):
        return 0.0
    s, _, i, j = pairs[0]
    edits = osa(la[i], lb[j], MAX_EDITS)
    ra, rb = la[:i] + la[i + 1 :], lb[:j] + lb[j + 1 :]
    given = _given_names(tuple(table.items()))
    # beside initials alone, a given name is no mistyped family name
    if not (ra and rb) and la[i] != lb[j] and (la[i] in given) != (lb[j] in given):
        return 0.0
    total, n = s, 1
    # given names written out on both sides must agree
    while ra and rb:
        g, x, y = max((_given(x, y, table), x, y) for x in ra for y in rb)
        if g < 0.65:
            return 0.0
        edits += 0 if g == 0.9 else osa(x, y, MAX_EDITS)
        ra.remove(x)
        rb.remove(y)
        total, n = total + g, n + 1
    # what is written out on one side must stand as the next initial on the other
    for names, initials in ((ra, ib), (rb, ia)):
        for x in sorted(names, key=lambda t: not initials or initials[0] not in _initials_of(t, table)):
            if not initials or initials[0] not in _initials_of(x, table):
                return 0.0
            initials.pop(0)
            total, n = total + 0.9, n + 1
    # the initials left agree one by one; one side may have fewer
    for x, y in zip(ia, ib):
        if x != y:
            return 0.0
        total, n = total + 1.0, n + 1
    if n == 1 or edits > MAX_EDITS:
        return 0.0  # a family name alone, or too many errors
    return total / n


def bands_for(similarity: float = MEET, recall: float = RECALL, rows: int = ROWS) -> int:
    """Bands of ``rows`` hashes for which the collision curve 1 - (1 - s^r)^b reaches ``recall`` at ``similarity``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows)))


def grams(part: str, q: int = Q) -> list[str]:
    """Padded q-grams of a name part."""
    s = "\x01" * (q - 1) + part + "\x02" * (q - 1)
    return [s[i : i + q] for i in range(len(s) - q + 1)]


def _bands(parts: DataFrame, bands: int, rows: int) -> DataFrame:
    """(band, bucket, part) of distinct parts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        rng = np.random.default_rng(20240229)
        p = np.uint64((1 << 61) - 1)
        a = rng.integers(1, 1 << 61, bands * rows, dtype=np.uint64)
        b = rng.integers(0, 1 << 61, bands * rows, dtype=np.uint64)
        for pdf in batches:
            out_p, out_b, out_h = [], [], []
            for part in pdf["part"]:
                h = np.array([xxhash.xxh32_intdigest(g) for g in set(grams(part))], np.uint64)
                sig = ((h[:, None] * a[None, :] + b[None, :]) % p).min(0).reshape(bands, rows)
                key = (sig * np.array([1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9][:rows], np.uint64)).sum(1, dtype=np.uint64)
                out_p += [part] * bands
                out_b += range(bands)
                out_h += key.view(np.int64).tolist()
            yield pd.DataFrame({"band": out_b, "bucket": out_h, "part": out_p})

    return spread(parts).mapInPandas(run, "band int, bucket bigint, part string")


def spellings(actors: DataFrame) -> DataFrame:
    """Distinct non-empty spellings of actors.name and the elements of actors.affiliations."""
    names = actors.select(F.col("name").alias("name")).unionByName(actors.select(F.explode("affiliations").alias("name")))
    return names.where(F.col("name").isNotNull() & (F.col("name") != "")).distinct()


def forms(names: DataFrame) -> DataFrame:
    """(name, form, parts, fid): the parsed form of each spelling and its key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [parse(n) for n in pdf["name"]]
            yield pd.DataFrame({"name": pdf["name"], "form": [g[0] for g in got], "parts": [list(g[1]) for g in got]})

    # parsing costs more than moving a name
    spark = names.sparkSession
    parts = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    parsed = names.repartition(parts).mapInPandas(run, "name string, form string, parts array<string>")
    return parsed.where("form <> ''").withColumn("fid", F.xxhash64("form", F.array_join("parts", " ")))


def cuts(parts: tuple[str, ...], most: int = MAX_EDITS) -> set[tuple[str, ...]]:
    """The sorted parts with up to ``most`` letters left out altogether; names so many edits apart share one."""
    out = last = {tuple(sorted(parts))}
    for _ in range(most):
        last = {tuple(sorted((*ps[:i], p[:k] + p[k + 1 :], *ps[i + 1 :]))) for ps in last for i, p in enumerate(ps) for k in range(len(p))}
        out = out | last
    return out


def _within(x: DataFrame, y: DataFrame) -> DataFrame:
    """(x, y) of the distinct parts of ``x`` and ``y`` that may count as one part with typing errors, equal ones included; exact."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            # below four letters only one error is allowed
            rows = [(p, c[0]) for p in pdf["part"] for c in cuts((p,), MAX_EDITS if len(p) > 3 else 1)]
            yield pd.DataFrame(rows, columns=["part", "cut"])

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[[osa(a, b, MAX_EDITS) <= MAX_EDITS and _similar(a, b) > 0 for a, b in zip(pdf["x"], pdf["y"])]]

    cx, cy = (spread(d.select("part")).mapInPandas(cut, "part string, cut string") for d in (x, y))
    met = cx.withColumnRenamed("part", "x").join(cy.withColumnRenamed("part", "y"), "cut").select("x", "y").distinct()
    return met.mapInPandas(check, "x string, y string")


def traits(form: str, parts: list[str], hot: set[str], table: Table = NICKNAMES) -> list[tuple[str, str, bool, bool]]:
    """(part, trait, asks, answers): what a form that holds the common parts ``hot`` is met by.

    Any pair that :func:`verify` accepts has a trait that one side asks for and the
    other answers, on parts that are equal but for typing errors. Persons: an
    initial against an initial or a name it may stand for, the start of another
    name, another name or what it is short for ('~', again with typing errors).
    Acronyms: their letters. Organisations: all parts with up to two letters left out.
    """
    out = set()
    if form == "person":
        initials = {t for t in parts if len(t) == 1}
        for p in hot:
            names = [t for t in parts if len(t) > 1]
            names.remove(p)
            out |= {(p, f"={c}", True, True) for c in initials}
            for g in names:
                out |= {(p, f"={c}", True, False) for c in _initials_of(g, table) - initials}
                out |= {(p, f"^{g[:3]}", True, True)} if len(g) > 2 else set()
                out |= {(p, f"~{x}", True, True) for x in (g, *table.get(g, ()))}
    elif form == "acronym":
        if parts[1] in hot:
            out.add((parts[1], "@" + "".join(sorted(parts[0])), True, True))
    else:
        for p in hot:
            rest = list(parts)
            rest.remove(p)
            out.add((p, "@" + "".join(sorted(t[0] for t in rest)), False, True))
        # a long part without a common neighbour meets its like as a key of its own
        if all(p in hot or len(p) < 6 for p in parts):
            out |= {("", "#" + " ".join(c), True, True) for c in cuts(tuple(parts))}
    return sorted(out)


def _refined(distinct: DataFrame, common: DataFrame, table: Table = NICKNAMES) -> DataFrame:
    """Candidates (a, b), a < b, among forms with parts that equal a common one but for typing errors."""
    held = distinct.select("fid", "form", "parts", F.explode(F.array_distinct("parts")).alias("part"))
    near = _within(common, held.where(F.char_length("part") > 1).select("part").distinct())
    near = cut_lineage(near.unionByName(near.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    hot = near.select(F.col("x").alias("part")).distinct().withColumn("hot", F.col("part"))
    owners = held.join(hot, "part", "left").groupBy("fid").agg(F.first("form").alias("form"), F.first("parts").alias("parts"), F.collect_set("hot").alias("hot"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                piece = pdf.iloc[at : at + 500]
                rows = [(i, *t) for i, f, ps, hs in zip(piece["fid"], piece["form"], piece["parts"], piece["hot"]) for t in traits(f, list(ps), set(hs), table)]
                yield pd.DataFrame(rows, columns=["fid", "part", "trait", "asks", "answers"])

    met = cut_lineage(spread(owners).mapInPandas(run, "fid bigint, part string, trait string, asks boolean, answers boolean"))
    asks, answers = met.where("asks").drop("asks", "answers"), met.where("answers").select(F.col("fid").alias("b"), "part", "trait")
    named = F.col("trait").startswith("~")
    names = asks.where(named).select(F.expr("substring(trait, 2)").alias("part")).distinct()
    like = _within(names, names).select(F.concat(F.lit("~"), "x").alias("trait"), F.concat(F.lit("~"), "y").alias("like"))
    asks = asks.where(~named).unionByName(asks.where(named).join(like, "trait").select("fid", "part", F.col("like").alias("trait")))
    whole = asks.where("part = ''").unionByName(
        asks.where("part <> ''").join(near, asks["part"] == near["x"]).select("fid", F.col("y").alias("part"), "trait")
    )
    pairs = whole.withColumnRenamed("fid", "a").join(answers, ["part", "trait"]).where("a <> b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def links(parsed: DataFrame, threshold: float = THRESHOLD, table: Table = NICKNAMES) -> DataFrame:
    """(a, b, score): verified links a < b between parsed forms."""
    distinct = parsed.groupBy("fid").agg(F.first("form").alias("form"), F.first("parts").alias("parts"))
    distinct = cut_lineage(distinct)
    held = distinct.select("fid", F.explode(F.array_distinct("parts")).alias("part")).where(F.char_length("part") > 1)
    df = held.groupBy("part").count()
    # parts that tell names apart are keys; common ones are refined, and a form without a key is also compared by all its parts together
    keys = held.join(df.where(F.col("count") <= COMMON).select("part"), "part")
    whole = (
        distinct.join(keys.select("fid").distinct(), "fid", "left_anti")
        .select("fid", F.array_join("parts", " ").alias("part"))
    )
    keys = cut_lineage(keys.select("fid", "part").unionByName(whole))
    bands = cut_lineage(_bands(keys.select("part").distinct(), bands_for(), ROWS))
    x, y = bands.select("band", "bucket", F.col("part").alias("x")), bands.select("band", "bucket", F.col("part").alias("y"))
    near = cut_lineage(
        x.join(y, ["band", "bucket"])
        .where(F.col("x") < F.col("y"))
        # at most three plain edits, that is a transposition and one more, and a third of the letters
        .where(F.levenshtein("x", "y", 3).between(0, 3) & (F.levenshtein("x", "y", 3) <= 0.34 * F.greatest(F.char_length("x"), F.char_length("y"))))
        .select("x", "y")
        .distinct()
    )
    same = keys.select(F.col("part").alias("x"), F.col("part").alias("y")).distinct()
    ka, kb = keys.select(F.col("part").alias("x"), F.col("fid").alias("a")), keys.select(F.col("part").alias("y"), F.col("fid").alias("b"))
    pairs = (
        near.unionByName(same)
        .join(ka, "x")
        .join(kb, "y")
        .where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    pairs = pairs.unionByName(_refined(distinct, df.where(F.col("count") > COMMON).select("part"), table)).distinct()
    both = pairs.join(distinct.select(F.col("fid").alias("a"), F.col("form").alias("fa"), F.col("parts").alias("pa")), "a").join(
        distinct.select(F.col("fid").alias("b"), F.col("form").alias("fb"), F.col("parts").alias("pb")), "b"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            score = [verify(*r, table) for r in zip(pdf["fa"], pdf["pa"], pdf["fb"], pdf["pb"])]
            out = pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "score": score})
            yield out[out["score"] >= threshold]

    # verified once, read by every round of the clustering
    return cut_lineage(spread(both).mapInPandas(run, "a bigint, b bigint, score double"))


def star_clusters(edges: DataFrame, weight: DataFrame) -> DataFrame:
    """(fid, center) of every form with a link.

    Rounds of star clustering: among free forms those that outrank all free
    neighbours (by degree, then by how much of the name is written out, then key)
    become centers, and each free neighbour joins its most similar center. Every
    round settles at least the highest-ranked free form of each component and its
    neighbours; the rounds end when no link between free forms is left.
    """
    both = edges.select("a", "b", "score").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))
    degree = both.groupBy("a").agg(F.count("*").alias("degree"))
    rank = degree.join(weight.withColumnRenamed("fid", "a"), "a", "left").select("a", F.struct("degree", F.coalesce("weight", F.lit(0)).alias("weight"), "a").alias("rank"))
    graph = cut_lineage(
        both.join(rank, "a").join(rank.select(F.col("a").alias("b"), F.col("rank").alias("rank_b")), "b").select("a", "b", "score", "rank", "rank_b")
    )
    done = None
    while True:
        top = graph.groupBy("a").agg(F.max("rank_b").alias("best"), F.first("rank").alias("rank"))
        centers = top.where(F.col("rank") > F.col("best")).select(F.col("a").alias("fid"))
        reached = (
            graph.join(centers.select(F.col("fid").alias("b")), "b")
            .groupBy("a")
            .agg(F.max(F.struct("score", "rank_b", "b")).alias("m"))
            .select(F.col("a").alias("fid"), F.col("m.b").alias("center"))
        )
        new = cut_lineage(reached.unionByName(centers.select("fid", F.col("fid").alias("center"))).groupBy("fid").agg(F.min("center").alias("center")))
        done = new if done is None else done.unionByName(new)
        graph = cut_lineage(
            graph.join(new.select(F.col("fid").alias("a")), "a", "left_anti").join(new.select(F.col("fid").alias("b")), "b", "left_anti")
        )
        # a form whose neighbours are all settled has no edge left and stays alone
        if graph.isEmpty():
            return done


def entities(actors: DataFrame, threshold: float = THRESHOLD, nicknames: Table = NICKNAMES) -> DataFrame:
    """(name, entity) of every spelling that holds a word; entity is the key of the star's center.

    Null names, null lists and null or empty elements are left out, spellings
    without letters or numbers get no row, equal spellings are one. Extra columns
    are ignored and empty tables give no row.
    """
    parsed = cut_lineage(forms(spellings(actors)))
    weight = parsed.groupBy("fid").agg(F.max(F.aggregate("parts", F.lit(0), lambda acc, x: acc + F.when(F.char_length(x) > 1, F.char_length(x)).otherwise(0))).alias("weight"))
    stars = star_clusters(links(parsed, threshold, nicknames), weight)
    return parsed.join(stars, "fid", "left").select("name", F.coalesce("center", "fid").alias("entity"))


def variant_pairs(found: DataFrame) -> DataFrame:
    """(name_a, name_b), name_a < name_b by code points: the spellings of one entity, once per pair."""
    size = found.groupBy("entity").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("n"))
    m = found.join(size.where("n > 1"), "entity")
    # the spellings of a large entity are dealt over blocks; each stands once as the second name and in all blocks as the first
    first = m.select("entity", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("name").alias("name_a"))
    second = m.select("entity", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int").alias("block"), F.col("name").alias("name_b"))
    return first.join(second, ["entity", "block"]).where(F.col("name_a") < F.col("name_b")).select("name_a", "name_b")
