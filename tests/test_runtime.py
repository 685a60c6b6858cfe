"""Lookups with hot and null keys against a plain join; files that hold no list."""

import pytest
from pyspark.sql import functions as F

from graphloom import runtime
from graphloom.sources import readers


@pytest.mark.parametrize("rows", [0, 100_000])
def test_lookup_against_a_plain_join(spark, rows, monkeypatch):
    monkeypatch.setattr(runtime, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(runtime, "HOT_SHARE", 0.2)
    left = spark.range(5000).select("id", F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 7 > 0, (F.col("id") % 50).cast("string")).alias("k"), F.lit("x").alias("name_of_left"))
    left = left.unionByName(left.where("id < 3"))
    table = spark.createDataFrame([("hot", "H"), *((str(i), f"n{i}") for i in range(0, 50, 3)), (None, "never"), ("unused", None)], "k string, name string")
    for how in ("left", "inner"):
        got = sorted(map(str, runtime.lookup(left, table, ["k"], how).select("id", "k", "name").collect()))
        assert got == sorted(map(str, left.join(table, "k", how).select("id", "k", "name").collect()))
    assert runtime.lookup(left.limit(0), table, ["k"]).count() == 0
    assert runtime.lookup(left, table.limit(0), ["k"]).where("name IS NOT NULL").count() == 0


def test_small_is_measured_in_bytes(spark, monkeypatch):
    df = spark.createDataFrame([("a" * 1000,), (None,)], "t string")
    assert runtime.small(df)
    monkeypatch.setattr(runtime, "BROADCAST_BYTES", 900)
    assert not runtime.small(df) and runtime.small(df.limit(0))


def test_unreadable_files(spark, tmp_path):
    for name, text in (("list", "[{}]"), ("good", '{"chunks": []}'), ("other", '{"tasks": []}'), ("broken", '{"chunks": [')):
        (tmp_path / f"{name}.json").write_text(text)
    got = {r.path.rsplit("/", 1)[-1]: r.error for r in readers.unreadable(spark, str(tmp_path)).collect()}
    assert got == {"other.json": "no list of chunks", "broken.json": "no JSON"}
