"""Tests of near duplicates in tables whose words are nearly all frequent."""

import random

import pytest
from pyspark.sql import functions as F

from graphloom.llm import neardup


def _rows(n, vocab, size, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.4:
            ws = list(rng.choice(rows)[1])
            for _ in range(rng.randint(0, len(ws) // 5)):
                ws[rng.randrange(len(ws))] = rng.choice([f"t{rng.randrange(vocab)}", f"r{i}"])
        else:
            ws = [f"t{int(vocab * rng.random() ** 1.5)}" for _ in range(rng.randint(*size))] + [f"r{i}x{k}" for k in range(rng.choice((0, 0, 1, 3)))]
        rows.append((i, sorted(set(ws))))
    return rows


def _found(spark, rows, **how):
    sets = spark.createDataFrame(rows, "rep bigint, words array<string>").select("rep", F.transform("words", lambda w: F.xxhash64(w)).alias("tokens")).dropDuplicates(["tokens"]).localCheckpoint()
    kept = {r.rep for r in sets.select("rep").collect()}
    got = [(r.a, r.b) for r in neardup.similar_sets(sets, **how).select("a", "b").collect()]
    known = [(k, set(ws)) for k, ws in rows if k in kept]
    want = {(a, b) for i, (a, x) in enumerate(known) for b, y in known[i + 1 :] if len(x & y) >= 0.7 * len(x | y) - 1e-12}
    return got, want


@pytest.mark.parametrize("cost, run, level, step, vocab, size", [(2, 200, 16, 1.3, 60, (1, 40)), (5, 3, 2, 1.5, 40, (5, 60)), (1, 3, 1, 1.1, 300, (20, 120)), (40, 10, 4, 2.0, 80, (3, 30))])
def test_parts_of_frequent_words_against_brute_force(spark, cost, run, level, step, vocab, size, monkeypatch):
    for k, v in {"RUN": run, "LEVEL": level, "STEP": step, "PAIRS": 300, "POSTINGS": 60, "MADE": 500, "TILE": (5, 7), "SAMPLE": 1}.items():
        monkeypatch.setattr(neardup, k, v)
    got, want = _found(spark, _rows(350, vocab, size, cost), cost=cost, parts=True)
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 60


def test_frequent_words_do_not_multiply_postings(spark, monkeypatch):
    """Keys of several frequent words were hundreds for each record, which took 35 GB of disk and more for 0.8 GB."""
    posted = []

    def counted(of):
        def run(*args):
            out = of(*args)
            posted.append((out if of.__name__ == "_parts" else args[0]).count())
            return out

        return run

    for name in ("_candidates", "_parts"):
        if hasattr(neardup, name):
            monkeypatch.setattr(neardup, name, counted(getattr(neardup, name)))
    rows = _rows(800, 150, (50, 70), 3)
    got, want = _found(spark, rows, cost=4)
    assert set(got) == want and len(want) > 100
    # the parts are made twice, once to find the frequent ones
    assert sum(posted) < 2 * 90 * len(rows)
