"""Tests of the operators' inner workings that need no session."""

import random

import pytest

from graphloom.llm import canonical as C
from graphloom.llm import garbled as G
from graphloom.llm import leakage as L
from graphloom.llm import names as N
from graphloom.llm import split as S
from graphloom.llm import survivor as V
from graphloom.llm.tokenize import encoder

ROWS = [
    ("relationship_type", "Influences", ["has influence on", "shapes"]), ("relationship_type", "IsInfluencedBy", ["influenced by", "shaped by"]),
    ("relationship_type", "IsLocatedIn", ["located in", "takes place at", "based in"]), ("relationship_type", "Funds", ["finances", "pays for"]), ("relationship_type", "Other", ["misc", "miscellaneous"]),
    ("event_type", "Conference", ["congress", "summit"]), ("event_type", "Other", ["misc"]),
]


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("influences", "Influences"), ("was-nifluenced-by", "IsInfluencedBy"), ("IsInfluecedBy", "IsInfluencedBy"), ("does influence", "Influences"), ("Takes  Place  At", "IsLocatedIn"), ("LOCATION_IS", "IsLocatedIn"),
        ("giles granty to", "Funds"), ("Othre", "Other"), ("married to", "UNMATCHED"), ("12", "UNMATCHED"), ("plays the violin for", "UNMATCHED"), ("?", "UNMATCHED"), ("x" * 5000, "UNMATCHED"), ("rains on", "UNMATCHED"),
    ],
)
def test_canonical(value, want):
    assert C.build_matchers(ROWS)["relationship_type"].resolve(value) == want


def test_canonical_short_forms_and_empty_list():
    assert C.build_matchers(ROWS)["event_type"].resolve("conf.") == "Conference"
    assert C.build_matchers([]) == {}


def brute_osa(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_osa_against_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 7))) for _ in range(2))
        assert C.osa(a, b, 3) == min(4, brute_osa(a, b))


@pytest.mark.parametrize(
    "text",
    [
        "", "a b", "x" * 25_001, " ".join(["a"] * 1001), "é" * 10_001, " ".join(["ab" * 3000] * 7), "a b " * 2000 + "y" * 30_000 + " z" * 3000, "　".join(["字"] * 2500), "中文。" * 9000, " " * 10_001,
        ("w" * 120 + " ") * 500, "\n\n".join("Sentence one is here. And two! " * 9 for _ in range(60)), "👩🏽‍🔬" * 4000, "\x1c".join(["q"] * 3000),
    ],
)
def test_pieces_keep_limits_and_text(text):
    word = S._patterns()[0]
    cuts = S.cut(text)
    big = len(text) > S.MAX_CHARS or len(word.findall(text)) > S.MAX_WORDS
    assert (len(cuts) > 1) == big
    at = 0
    for i, (a, b, e) in enumerate(cuts):
        assert a <= b == at and (b < e or not text)
        assert not big or (e - a <= S.MAX_CHARS and len(word.findall(text[a:e])) <= S.MAX_WORDS)
        assert i == 0 or (len(word.findall(text[a:b])) <= S.OVERLAP_WORDS and a >= cuts[i - 1][0])
        at = e
    assert at == len(text)


def test_pieces_end_at_paragraphs():
    text = "\n\n".join(" ".join(["word"] * 50) + "." for _ in range(50))
    assert all(text[:e].endswith(".\n\n") for _, _, e in S.cut(text)[:-1])


def test_encoder_equals_library():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    rng = random.Random(5)
    texts = ["<|endoftext|> hi", "a" * 500, "  \n\n\t x", "naïve café 東京 👩🏽‍🔬", "don't I'll", "".join(rng.choice("abcdefgh ,.é1") for _ in range(20_000))]
    texts += ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(160, 0x2FFF), rng.randint(0x4E00, 0x9FFF)])) for _ in range(60)) for _ in range(50)]
    assert encoder().encode(texts) == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert encoder().encode(["", None]) == [[], []]


def brute_leak(text, item, run):
    a, b = L.words(text), L.words(item)
    grams = {tuple(b[i : i + run]) for i in range(len(b) - run + 1)}
    return any(tuple(a[i : i + run]) in grams for i in range(len(a) - run + 1))


def test_leaks_against_brute_force():
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(3, 30)))) for i in range(60)] + [(99, "")]
    index = L.ItemIndex(items, run=4, block=3)
    hits = 0
    for _ in range(150):
        words = [rng.choice(vocab + ["zz"]) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            src = rng.choice(items[:60])[1].split()
            at = rng.randint(0, len(words))
            words[at:at] = src[: rng.randint(3, 6)]
        text = ", ".join(words).upper()
        want = {i for i, t in items if brute_leak(text, t, 4)}
        assert index.leaks(text, passage=rng.choice([4, 9, 64])) == want
        hits += len(want)
    assert hits > 30


def test_name_forms():
    same = [
        ("Katarina Nogifuvumont", "K.A. Nogifuvumont"), ("Bobbie Tipakivolund", "Roberta Tipakivolund"), ("Gudogonadal, Jasper", "Jasper Gudogonadal"), ("Prof. Dr. Theodora Nedomabo", "T.M. Nedomabo"),
        ("OSA Vojososistad", "Vojososistad Alliance for Ocean Science"), ("Disaster Relief Tr. Latafusuford", "trust for disaster relief of latafusuford"), ("Food & Nutrition Agcy Pahebiroford", "AGENCY FOR FOOD AND NUTRITION OF PAHEBIROFORD"),
        ("Victoria Bibebawiton", "Victoria Bibebawto"), ("Gabriela Lugegumi", "Gabriela Lugegümi"), ("Agency for Food & Nutrition of Pahebiroford, ZA", "Agency for Food and Nutrition of Pahebiroford"),
    ]
    other = [
        ("Lucia Dewemililund", "Leonardo Dewemililund"), ("T.L. Piganujasky", "T.M. Piganujasky"), ("Zebikusahaven Association for Ocean Science", "Foundation for Seeds and Crops of Zebikusahaven"),
        ("Urban Air Council of Mafidugimouth", "Urban Air Ministry of Mafidugimouth"), ("DRA Jinenabistad", "Jinenabistad Foundation for Animal Health"), ("Ingrid Vizatiketon", "Ingrid Kefatijesky"),
    ]
    score = lambda a, b: N.verify(*N.parse(a), *N.parse(b))
    assert [p for p in same if score(*p) < N.THRESHOLD] == []
    assert [p for p in other if score(*p) >= N.THRESHOLD] == []
    assert N.parse("") == N.parse("  ") == N.parse("...") == ("", ())


def test_collision_curve():
    b = N.bands_for(0.5, 0.98, 4)
    assert 1 - (1 - 0.5**4) ** b >= 0.98 > 1 - (1 - 0.5**4) ** (b - 1)


@pytest.mark.parametrize("chain", ["utf8>cp1252", "utf8>cp1252*2", "utf8>mac_roman", "utf8>cp1251", "cp1251>koi8_r", "cp1252>mac_roman"])
def test_chains_round_trip(chain):
    text = {"cp1251>koi8_r": "вода"}.get(chain, "café")
    true, read = chain.split(">")
    read, _, n = read.partition("*")
    bad = text
    for _ in range(int(n or 1)):
        bad = bad.encode("utf-8" if true == "utf8" else true).decode(read)
    assert G.repair_token(bad, chain) == text


def brute_choice(options, allowed):
    best, arg = -1.0, None

    def go(i, chosen, total):
        nonlocal best, arg
        if i == len(options):
            if total > best + 1e-9:
                best, arg = total, list(chosen)
            return
        for o in [*options[i], None]:
            if o is None or all(c is None or allowed(j, c[1], i, o[1]) for j, c in enumerate(chosen)):
                go(i + 1, [*chosen, o], total + (o[0] if o else 0))

    go(0, [], 0.0)
    return best


def test_branch_and_bound_is_optimal():
    rng = random.Random(2)
    for _ in range(200):
        options = [sorted(((rng.randint(1, 9) + rng.random(), rng.choice("abc"), k) for k in range(rng.randint(0, 3))), reverse=True) for _ in range(3)]
        ok = {(j, a, i, b) for j in range(3) for i in range(3) for a in "abc" for b in "abc" if rng.random() < 0.6}
        allowed = lambda j, a, i, b: (j, a, i, b) in ok  # noqa: E731, B023
        got = V.branch_and_bound(options, allowed)
        assert abs(sum(g[0] for g in got if g) - brute_choice(options, allowed)) < 1e-6
