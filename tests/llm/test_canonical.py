"""Canonical mapping to a list of 50,000 invented entries, and without a table of paraphrases."""

import random
import time

from graphloom.llm import canonical as C


def word(rng, n):
    return "".join(rng.choice("bcdfgklmnprstvz") + rng.choice("aeiou") for _ in range(n))


def test_large_list():
    rng = random.Random(2)
    words = sorted({word(rng, rng.randint(2, 4)) for _ in range(4000)})
    entries = sorted({" ".join(rng.sample(words, rng.randint(2, 3))).title() for _ in range(50_000)})
    m = C.build_matchers([("city", e, None) for e in entries], {})["city"]
    begin, right, n = time.time(), 0, 150
    for e in rng.sample(entries, n):
        i = rng.randrange(1, len(e) - 2)
        v = rng.choice([e.upper(), f"the {e.lower()}", e[:i] + e[i + 1 :], e[:i] + "x" + e[i:], " ".join(reversed(e.split())).lower()])
        right += m.resolve(v) == e
    assert right >= 0.93 * n, right
    assert time.time() - begin < 60
    assert m.resolve("qqq xxx yyy") == C.UNMATCHED


def test_inflections_without_a_table():
    rows = [("l", "Funds", ["finances"]), ("l", "IsFundedBy", ["financed by"]), ("l", "Plans", None), ("l", "Carries", None)]
    m = C.build_matchers(rows, {})["l"]
    want = {"funding": "Funds", "is financing": "Funds", "was funded by": "IsFundedBy", "financing": "Funds", "planning": "Plans", "carrying": "Carries", "rains": "UNMATCHED"}
    assert {v: m.resolve(v) for v in want} == want
