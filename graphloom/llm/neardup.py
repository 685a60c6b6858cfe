"""Problem 2: records that share most of their words.

Method: adaptive multi-match prefixes. Words are ordered from rare to frequent.
Two sets that must have at least ``o`` words in common share their i-th common
word within prefixes of length n - o + i, for every i. So two similar sets always
meet on their first common word; where the estimated candidate cost of a key, the
number of records that post it, is high, the key is replaced by longer ones: the
same words and one more shared word of a prefix one longer. The cost is counted
over all records before any posting is written, and both records of a pair see
the same key, so a longer prefix loses no pair. Postings hold a key, an id, two
lengths and a bit map of 128 bits; everything after the ordering stays in the JVM.

In large tables nearly all words of a prefix are frequent and each record would have
hundreds of longer keys. Where that is more than the following writes, only words of
at most COST records are keys. Two similar sets that share none of those differ in all
they hold of them, which leaves few differences, E, among the frequent words. These are
dealt over more than E parts, so at least one part is alike in both sets and is the key.
The pairs are cut into levels by E, a level has one part more than the E below its end.

Sets alike in every word form one class and only its representative is joined.
A key that is still frequent at the greatest depth, or a frequent part, is dealt over
salted blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.runtime import blank, cut_lineage, spread

THRESHOLD = 0.70
#: words held by a larger share of the classes are ordered by their count, the rest come before them in the order of their hash; bounds what the driver holds
FREQUENT = 0.0005
#: a key posted by more records gets one more shared word
COST = 16_384
#: most shared words in a key; the number of keys of a record grows with the depth
DEPTH = 4
#: postings of one key at the greatest depth, and members of one class, in a salted block
BLOCK = 2000
#: pairs of a step of the filter, and postings held before whole groups are joined; memory bounds
PAIRS, POSTINGS = 200_000, 20_000
#: a set with more partners is compared with them in a step of its own
RUN = 200
#: parts of the first level of pairs without a rare word in common, and how many times more each next one has
LEVEL, STEP = 16, 1.3
#: units of a word in which the slack of a set is counted, postings of parts made at a time, and sets of which one is asked for frequent parts
UNIT, MADE, SAMPLE = 1024, 500_000, 64
#: sets and partners compared at once
TILE = (64, 2048)
#: keys of costly words sent to every executor; more are joined by a shuffle. 16 bytes each
SENT = 1_000_000


def word_set(*cols: str):
    """Sorted distinct lower-case words of several columns; a null column counts as empty."""
    text = F.concat_ws(" ", *(F.coalesce(F.col(c), F.lit("")) for c in cols))
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), F.lower)))


def classes(records: DataFrame, key: str, cols: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(membership: key, rep, first; sets: rep, tokens). Sets without a word belong to no class.

    A class is all records of one word set, whatever their texts; ``first`` is the
    least key of the records of the class whose columns are equal, null as empty.
    Words are hashed to 64 bits, sets and texts are told apart by 128 bits.
    """
    twice = lambda *c: F.struct(F.xxhash64(*c).alias("x"), F.xxhash64(F.lit(1), *c).alias("y"))
    texts = [F.coalesce(F.col(c), F.lit("")) for c in cols]
    rows = records.select(F.col(key).alias("key"), word_set(*cols).alias("words"), twice(*texts).alias("text")).where(F.size("words") > 0)
    rows = rows.withColumn("sig", twice("words"))
    sets = rows.groupBy("sig").agg(F.min("key").alias("rep"), F.first(F.transform("words", lambda w: F.xxhash64(w))).alias("tokens")).select("rep", "tokens")
    keyed = cut_lineage(rows.groupBy("key", "sig").agg(F.min("text").alias("text")))
    reps = keyed.groupBy("sig").agg(F.min("key").alias("rep"))
    copies = keyed.groupBy("sig", "text").agg(F.min("key").alias("first"))
    members = keyed.join(copies, ["sig", "text"]).join(reps, "sig").select("key", "rep", "first")
    return members, sets


def _ordered(sets: DataFrame, frequent: dict[int, int], threshold: float, cost: int) -> DataFrame:
    """(rep, n, slip, tight, rare, slack, tokens, w0, w1): hashed words from rare to frequent and a parity map of them.

    ``slip`` is how many words of the set may be missing from any similar set,
    ``tight`` from one that is not smaller. ``rare`` words are held by ``cost`` sets
    at most. Similar sets without a common rare word differ in as many frequent ones
    as the sum of their ``slack`` says, in units, at most.
    """
    keys = np.array(sorted(frequent), np.int64)
    values = np.array([frequent[k] for k in keys.tolist()], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column("tokens")
            n = np.diff(col.offsets.to_numpy())
            h = col.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(n)), n)
            df = np.zeros(len(h), np.int64)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                df = np.where(keys[at] == h, values[at], 0)
            rare = np.bincount(row[df <= cost], minlength=len(n))
            h = h[np.lexsort((h, df, row))]
            # one bit a word by its hash; equal words of two sets cancel out
            u = h.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            bit = np.uint64(1) << ((u >> np.uint64(40)) & np.uint64(63))
            low = (u >> np.uint64(50)) & np.uint64(1) == 0
            starts = np.r_[0, np.cumsum(n)[:-1]].astype(np.int64)
            maps = [np.bitwise_xor.reduceat(np.where(m, bit, np.uint64(0)), starts).view(np.int64) if len(h) else np.zeros(0, np.int64) for m in (low, ~low)]
            slip = n - np.ceil(threshold * n - 1e-9).astype(np.int64)
            tight = n - np.ceil(2 * threshold / (1 + threshold) * n - 1e-9).astype(np.int64)
            slack = np.ceil((1 - threshold) / (1 + threshold) * n * UNIT + 1e-3).astype(np.int64) - rare * UNIT
            tokens = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(h))
            cols = [batch.column("rep"), *(pa.array(x.astype(np.int32)) for x in (n, slip, tight, rare)), pa.array(slack), tokens, *map(pa.array, maps)]
            yield pa.RecordBatch.from_arrays(cols, ["rep", "n", "slip", "tight", "rare", "slack", "tokens", "w0", "w1"])

    return spread(sets.select("rep", "tokens")).mapInArrow(run, "rep bigint, n int, slip int, tight int, rare int, slack bigint, tokens array<bigint>, w0 bigint, w1 bigint")


def _sent(df: DataFrame) -> DataFrame:
    """``df`` to be broadcast when it was counted to be small, else as it is."""
    return F.broadcast(df) if df.count() <= SENT else df


def _postings(tokens: DataFrame, costly: DataFrame, cost: int, depth: int) -> tuple[DataFrame, bool]:
    """((rep, n, tight, w0, w1, key, depth, skips) of all records, whether the greatest depth is reached).

    ``costly`` holds the keys of words of many records.

    ``skips`` is the number of words before the last one of the key that are no part of it.
    """
    level = tokens.select("*", F.posexplode(F.slice("tokens", F.lit(1), F.col("slip") + 1)).alias("pos", "key")).withColumn("depth", F.lit(1))
    deepest = depth == 1
    for d in range(1, depth):
        here = level.where(F.col("depth") == d)
        # words that few records hold at all need no count of their postings
        here = here.join(_sent(costly), "key", "left_semi") if d == 1 else here
        costly = cut_lineage(here.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > cost).select("key"))
        if costly.isEmpty():
            break
        deepest = d + 1 == depth
        mark = _sent(costly.select("key", F.lit(d).alias("depth"), F.lit(True).alias("costly")))
        # a further shared word stands at most slip + d words from the start; a set that may be similar by d words alone also stays
        last = F.least(F.col("slip") + d, F.col("n") - 1)
        more = F.when(F.col("pos") < last, F.sequence(F.col("pos") + 1, last)).otherwise(F.array().cast("array<int>"))
        stays = F.when(F.col("n") - F.col("slip") <= d, F.array(F.lit(-1))).otherwise(F.array().cast("array<int>"))
        level = (
            level.join(mark, ["key", "depth"], "left")
            .withColumn("next", F.explode(F.when(F.col("costly"), F.concat(stays, more)).otherwise(F.array(F.lit(-1)))))
            .withColumns(
                {
                    "key": F.when(F.col("next") < 0, F.col("key")).otherwise(F.xxhash64("key", F.get("tokens", F.col("next")))),
                    "depth": F.when(F.col("next") < 0, F.col("depth")).otherwise(F.lit(d + 1)),
                    "pos": F.when(F.col("next") < 0, F.col("pos")).otherwise(F.col("next")),
                }
            )
            .drop("costly", "next")
        )
    return level.select("rep", "n", "tight", "w0", "w1", "key", "depth", (F.col("pos") - F.col("depth") + 1).alias("skips")), deepest


def _candidates(posts: DataFrame, threshold: float, block: int, deepest: int | None) -> DataFrame:
    """(a, b) of representatives that meet on a key and may be similar by their lengths, skipped words and bit maps.

    The postings of a key stand together, smaller sets first, so the partners of a
    set are a run of those after it. A key holds at most COST postings, or ``block``
    in a part of a salted one, so what a worker holds is bounded.
    """
    info = F.col("n").cast("bigint") * 65536 + F.least("skips", F.lit(32767)) * 2 + (F.col("skips") <= F.col("tight")).cast("int")
    packed = posts.select("key", "depth", "rep", info.alias("info"), "w0", "w1")
    dealt = packed.withColumns({"part": F.lit(0), "asks": F.lit(True)})
    hot = None
    if deepest:
        hot = posts.where(F.col("depth") == deepest).groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > block)
        hot = cut_lineage(hot.select("key", F.ceil(F.col("c") / block).cast("int").alias("parts")))
    if hot is not None and not hot.isEmpty():
        # a set asks in the part of its own and answers in all parts
        mine = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
        dealt = (
            packed.join(_sent(hot), "key", "left")
            .withColumns({"parts": F.coalesce("parts", F.lit(1)), "mine": F.coalesce(mine, F.lit(0))})
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("asks", F.col("part") == F.col("mine"))
        )
    dealt = dealt.select("key", "part", F.when(F.col("asks"), F.col("info")).otherwise(F.col("info").bitwiseAND(F.lit(~1))).alias("info"), "rep", "w0", "w1")

    def pairs(v: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs within the groups of (key, part), whose rows stand together ordered by info."""
        n, skips, tight = v["info"] >> 16, (v["info"] >> 1) & 32767, v["info"] & 1
        gid = np.cumsum(np.r_[False, (v["key"][1:] != v["key"][:-1]) | (v["part"][1:] != v["part"][:-1])])
        place = gid * (1 << 40) + n
        end = np.searchsorted(place, gid * (1 << 40) + np.floor(n / threshold + 1e-6).astype(np.int64), "right")
        asks = np.flatnonzero(tight == 1)
        reach = end[asks] - asks - 1
        asks, reach = asks[reach > 0], reach[reach > 0]
        w0, w1 = v["w0"].view(np.uint64), v["w1"].view(np.uint64)
        both = np.arange(2 * int(n.max()) + 1)
        # words that only one of two similar sets may hold, by the sum of their sizes; the two maps differ in at most so many bits
        apart = (both - 2 * np.ceil(threshold / (1 + threshold) * both - 1e-9)).astype(np.int64)
        many = reach > RUN
        for i, to in zip(asks[many].tolist(), end[asks[many]].tolist()):
            most = apart[n[i] + n[i + 1 : to]]
            y = np.flatnonzero(np.bitwise_count(w0[i + 1 : to] ^ w0[i]) <= most)
            y, most = y + (i + 1), most[y]
            y = y[(np.bitwise_count(w0[y] ^ w0[i]) + np.bitwise_count(w1[y] ^ w1[i]) <= most) & (skips[y] + skips[i] <= most)]
            if len(y):
                yield np.full(len(y), v["rep"][i]), v["rep"][y]
        for x, y in _steps(asks[~many], asks[~many] + 1, reach[~many]):
            most = apart[n[x] + n[y]]
            ok = (np.bitwise_count(w0[x] ^ w0[y]) + np.bitwise_count(w1[x] ^ w1[y]) <= most) & (skips[x] + skips[y] <= most)
            yield v["rep"][x[ok]], v["rep"][y[ok]]

    return _met(dealt, F.shiftright("info", 16), pairs)


def _steps(x: np.ndarray, first: np.ndarray, reach: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows x beside each of the ``reach`` rows from ``first`` on, about PAIRS at a time."""
    total, at = np.cumsum(reach), 0
    while at < len(x):
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + PAIRS, "right")))
        r = reach[at:to]
        yield np.repeat(x[at:to], r), np.repeat(first[at:to] - np.cumsum(r) + r, r) + np.arange(int(r.sum()))
        at = to


def _met(dealt: DataFrame, order, pairs) -> DataFrame:
    """(a, b), a < b, that ``pairs`` gives for the rows of whole groups of (key, part) in their order; a pair of several groups comes as often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            v = {c: np.concatenate([h[c] for h in held]) for c in held[0]}
            end = len(v["key"])
            if not last:
                # the last group may go on in the next batch
                other = np.flatnonzero((v["key"] != v["key"][-1]) | (v["part"] != v["part"][-1]))
                end = int(other[-1]) + 1 if len(other) else 0
                held = [{c: x[end:] for c, x in v.items()}]
            if not end:
                return
            out, size = [], 0
            # a group may give far more pairs than it has rows, so they leave in steps
            for ab in pairs({c: x[:end] for c, x in v.items()}):
                out.append(ab)
                size += len(ab[0])
                if size >= PAIRS:
                    yield batch_of(out)
                    out, size = [], 0
            if size:
                yield batch_of(out)

        def batch_of(out: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            a, b = (np.concatenate(x) for x in zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        wait = POSTINGS
        for batch in batches:
            if batch.num_rows:
                held.append({c: batch.column(c).to_numpy() for c in batch.schema.names})
                if sum(len(h["key"]) for h in held) >= wait:
                    yield from flush(False)
                    # a group that goes on is not put together anew for every batch
                    wait = max(POSTINGS, 2 * len(held[0]["key"]))
        if held and sum(len(h["key"]) for h in held):
            yield from flush(True)

    return dealt.repartition("key", "part").sortWithinPartitions("key", "part", order, "rep").mapInArrow(run, "a bigint, b bigint")


def _levels(spans: dict[int, tuple[int, int, int, int]], threshold: float) -> tuple[list[tuple[int, int]], dict[int, tuple[int, int]], int]:
    """(levels from E to below E; for sizes of sets, the least and the greatest slack among those of similar size; postings at most).

    ``spans`` has the sets, their least and greatest slack and the count of their longer keys by size.
    """
    sizes = np.array(sorted(spans))
    near, top = {}, -1
    for n in sizes.tolist():
        like = sizes[(sizes >= threshold * n - 1e-6) & (sizes <= n / threshold + 1e-6)].tolist()
        near[n] = min(spans[k][1] for k in like), max(spans[k][2] for k in like)
        top = max(top, spans[n][2] + near[n][1])
    levels = []
    while top >= UNIT * (levels[-1][1] if levels else 0):
        levels.append((levels[-1][1], math.ceil(levels[-1][1] * STEP)) if levels else (0, LEVEL))
    posts = sum(spans[n][0] * hi for n in near for lo, hi in levels if spans[n][2] + near[n][1] >= lo * UNIT and spans[n][1] + near[n][0] < hi * UNIT)
    return levels, near, posts


def _parts(tokens: DataFrame, common: list[int], levels: list[tuple[int, int]], near: dict[int, tuple[int, int]]) -> DataFrame:
    """(key, part, info, rep, w0, w1): the parts of the ``common`` words, from frequent to rare, of each set at each level at which it may have a partner.

    ``part`` holds the level, ``info`` the slack and a bit that asks for partners, ``w0`` and ``w1`` a parity map of the common words.
    """
    place = np.argsort(np.array(common, np.int64))
    keys = np.array(common, np.int64)[place]
    sizes = np.array(sorted(near), np.int64)
    least, most = (np.array([near[n][k] for n in sizes.tolist()], np.int64) for k in (0, 1))

    def mixed(x: np.ndarray) -> np.ndarray:
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
        return x ^ (x >> np.uint64(31))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = []
        for _, m in levels:
            # back and forth, so all parts have words as frequent as the others
            turn, at = np.divmod(place, m)
            of.append(np.where(turn % 2, m - 1 - at, at))
        for batch in batches:
            col = batch.column("tokens")
            n = np.diff(col.offsets.to_numpy())
            h = col.flatten().to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
            is_common = keys[at] == h if len(keys) else np.zeros(len(h), bool)
            row, at = np.repeat(np.arange(len(n)), n)[is_common], at[is_common]
            u = mixed(h[is_common].view(np.uint64))
            c = np.bincount(row, minlength=len(n))
            bit = np.uint64(1) << ((u >> np.uint64(40)) & np.uint64(63))
            low = (u >> np.uint64(50)) & np.uint64(1) == 0
            starts = (np.cumsum(c) - c)[c > 0]
            maps = []
            for m in (low, ~low):
                w = np.zeros(len(n), np.uint64)
                w[c > 0] = np.bitwise_xor.reduceat(np.where(m, bit, np.uint64(0)), starts) if len(starts) else 0
                maps.append(w.view(np.int64))
            rep, slack = batch.column("rep").to_numpy(), batch.column("slack").to_numpy()
            size = np.searchsorted(sizes, n)
            for level, (lo, hi) in enumerate(levels):
                takes = np.flatnonzero((slack + most[size] >= lo * UNIT) & (slack + least[size] < hi * UNIT))
                step = max(1, MADE // hi)
                for k in range(0, len(takes), step):
                    some = takes[k : k + step]
                    index = np.full(len(n), -1)
                    index[some] = np.arange(len(some))
                    mine = index[row] >= 0
                    sums = np.zeros(len(some) * hi, np.uint64)
                    # a set of words is the sum of their hashes
                    np.add.at(sums, index[row[mine]] * hi + of[level][at[mine]], u[mine])
                    part = np.tile(np.arange(1, hi + 1, dtype=np.uint64), len(some))
                    key = mixed(sums + part * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
                    cols = [key, np.full(len(key), level << 20, np.int32), *(np.repeat(x[some], hi) for x in (slack * 2 + 1, rep, *maps))]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["key", "part", "info", "rep", "w0", "w1"])

    return tokens.select("rep", "slack", "tokens").mapInArrow(run, "key bigint, part int, info bigint, rep bigint, w0 bigint, w1 bigint")


def _alike(tokens: DataFrame, common: list[int], levels: list[tuple[int, int]], near: dict[int, tuple[int, int]], sample: int, block: int) -> DataFrame:
    """(a, b) of representatives that are alike in a part of their common words and may be similar if they share no rare word."""
    posts = _parts(tokens, common, levels, near)
    hot = _parts(tokens.where(F.pmod(F.xxhash64("rep"), F.lit(sample)) == 0), common, levels, near)
    hot = hot.groupBy("key", "part").agg((F.count("*") * sample).alias("c")).where(F.col("c") > 2 * block)
    hot = cut_lineage(hot.select("key", "part", F.least(F.lit(1 << 19), F.ceil(F.col("c") / block)).cast("int").alias("parts")))
    dealt = posts
    if not hot.isEmpty():
        # a set asks in the block of its own and answers in all blocks
        mine = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("parts")).cast("int")
        dealt = (
            posts.join(_sent(hot), ["key", "part"], "left")
            .withColumns({"parts": F.coalesce("parts", F.lit(1)), "mine": F.coalesce(mine, F.lit(0))})
            .withColumn("in", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumns({"part": F.col("part") + F.col("in"), "info": F.when(F.col("in") == F.col("mine"), F.col("info")).otherwise(F.col("info").bitwiseAND(F.lit(~1)))})
            .select("key", "part", "info", "rep", "w0", "w1")
        )
    lows, highs = (np.array([x[k] for x in levels], np.int64) * UNIT for k in (0, 1))

    def pairs(v: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of the level within the groups, whose rows stand together ordered by slack."""
        slack, level, rep = v["info"] >> 1, v["part"] >> 20, v["rep"]
        gid = np.cumsum(np.r_[False, (v["key"][1:] != v["key"][:-1]) | (v["part"][1:] != v["part"][:-1])])
        base = gid * (1 << 40) + (1 << 39)
        row = np.flatnonzero(v["info"] & 1)
        first = np.maximum(np.searchsorted(base + slack, base[row] + lows[level[row]] - slack[row]), row + 1)
        end = np.searchsorted(base + slack, base[row] + highs[level[row]] - slack[row])
        row, first, end = (x[end > first] for x in (row, first, end))
        w0, w1 = v["w0"].view(np.uint64), v["w1"].view(np.uint64)
        apart = lambda x, y: np.bitwise_count(w0[x] ^ w0[y]) + np.bitwise_count(w1[x] ^ w1[y])
        many = end - first > RUN
        for x, y in _steps(row[~many], first[~many], (end - first)[~many]):
            ok = apart(x, y) <= (slack[x] + slack[y]) // UNIT
            yield rep[x[ok]], rep[y[ok]]
        row, first, end = row[many], first[many], end[many]
        edges = np.flatnonzero(np.diff(gid[row], prepend=-1, append=-1)) if len(row) else []
        for i, j in zip(edges[:-1], edges[1:]):
            for k in range(i, j, TILE[0]):
                r = row[k : min(j, k + TILE[0])]
                f, e = first[k : k + len(r)], end[k : k + len(r)]
                to = int(e.max())
                for at in range(int(f.min()), to, TILE[1]):
                    y = slice(at, min(to, at + TILE[1]))
                    bits = np.bitwise_count(w0[r][:, None] ^ w0[y]) + np.bitwise_count(w1[r][:, None] ^ w1[y])
                    # the last of either has the greatest slack
                    x, z = np.nonzero(bits <= (slack[r[-1]] + slack[y.stop - 1]) // UNIT)
                    if len(x):
                        most = (slack[r[x]] + slack[z + at]) // UNIT
                        ok = (bits[x, z] <= most) & (z + at >= f[x]) & (z + at < e[x])
                        yield rep[r[x[ok]]], rep[z[ok] + at]

    # by slack alone, so that two sets stand in the same order in all blocks
    return _met(dealt, F.shiftright("info", 1), pairs)


def similar_sets(sets: DataFrame, threshold: float = THRESHOLD, cost: int | None = None, depth: int | None = None, parts: bool | None = None) -> DataFrame:
    """(a, b, similarity) of all pairs a < b of distinct word sets with Jaccard similarity of ``threshold`` or more; exact.

    ``sets`` must not be computed anew for every use; it is read several times.
    ``parts`` tells whether sets without a rare word in common meet on parts of their frequent words instead of on longer keys;
    by itself it is what makes fewer postings.
    """
    cost, depth = cost or COST, depth or DEPTH
    counts = sets.select(F.explode("tokens").alias("key")).groupBy("key").agg(F.count("*").alias("c"))
    counts = cut_lineage(counts.where(F.col("c") > min(cost, 8)))
    # at most mean set size / FREQUENT words, or the mean set size times the sets / cost
    number = sets.count()
    frequent = {r[0]: r[1] for r in counts.where(F.col("c") > min(cost, max(8.0, FREQUENT * number))).collect()}
    tokens = cut_lineage(_ordered(sets, frequent, threshold, cost))
    # keys of two words that a record has if all its words that are not rare are costly
    open_words = F.greatest(F.lit(0), F.col("slip") + 1 - F.col("rare")).cast("bigint")
    spans = tokens.groupBy("n").agg(F.count("*"), F.min("slack"), F.max("slack"), F.sum(open_words * (open_words + 1) / 2))
    spans = {r[0]: tuple(r[1:]) for r in spans.collect()}
    levels, near, made = _levels(spans, threshold)
    if made < sum(x[3] for x in spans.values()) if parts is None else parts:
        rare = tokens.select("*", F.posexplode(F.slice("tokens", F.lit(1), F.least(F.col("slip") + 1, F.col("rare")))).alias("skips", "key"))
        pairs = _candidates(rare.withColumn("depth", F.lit(1)), threshold, BLOCK, None)
        if levels:
            common = sorted((k for k, c in frequent.items() if c > cost), key=lambda k: (-frequent[k], k))
            pairs = pairs.unionByName(_alike(tokens, common, levels, near, max(1, min(SAMPLE, number // 20_000)), cost))
    else:
        posts, deepest = _postings(tokens, counts.where(F.col("c") > cost).select("key"), cost, depth)
        pairs = _candidates(posts, threshold, BLOCK, depth if deepest else None)
    pairs = pairs.distinct()
    a = tokens.select(F.col("rep").alias("a"), F.col("tokens").alias("ta"))
    b = tokens.select(F.col("rep").alias("b"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    sim = both / (F.size("ta") + F.size("tb") - both)
    return pairs.join(a, "a").join(b, "b").select("a", "b", sim.alias("similarity")).where(F.col("similarity") >= threshold - 1e-12)


def near_duplicates(records: DataFrame, key: str, cols: tuple[str, ...], required: str, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(membership: key, rep, first; pairs of representatives: a, b, similarity).

    Records whose ``required`` column is null or blank take no part; a null value
    of another column counts as empty; records without a single word are similar
    to none. Repeated rows fall into one class. Extra columns are ignored, empty
    tables give empty results.
    """
    members, sets = classes(records.where(~blank(F.col(required))), key, cols)
    sets = cut_lineage(sets)
    return members, similar_sets(sets, threshold)


def expand(members: DataFrame, pairs: DataFrame, full: int | None = None) -> DataFrame:
    """Pairs of keys (rec_a < rec_b): across similar classes and within a class.

    All pairs are listed, so a group of n copies gives n (n - 1) / 2 rows; its
    members are dealt over salted blocks. With ``full`` set, the rows of one text
    that more than ``full`` records hold letter by letter shrink to a star: each
    copy is paired with the first, which alone stands for the text in the other
    pairs. Differing texts are never put together.
    """
    size = members.groupBy("rep").agg(F.count("*").alias("n"))
    sized = members.join(size, "rep").withColumn("parts", F.ceil(F.col("n") / BLOCK).cast("int"))
    star = None
    if full is not None:
        copies = members.groupBy("rep", "first").agg(F.count("*").alias("copies"))
        sized = sized.join(copies, ["rep", "first"])
        many = (F.col("copies") > full) & (F.col("key") != F.col("first"))
        star = sized.where(many).select(F.col("first").alias("ka"), F.col("key").alias("kb"))
        sized = sized.where(~many)
    # one side lies in one block each, the other side's rows go to all blocks
    salt = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    ma = sized.select(F.col("rep").alias("a"), F.col("key").alias("ka"), salt.alias("sa"))
    mb = sized.select(F.col("rep").alias("b"), F.col("key").alias("kb"), salt.alias("sb"))
    blocks = size.select("rep", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / BLOCK).cast("int") - 1)).alias("salt"))
    ba, bb = blocks.select(F.col("rep").alias("a"), F.col("salt").alias("sa")), blocks.select(F.col("rep").alias("b"), F.col("salt").alias("sb"))
    across = pairs.select("a", "b").join(ba, "a").join(bb, "b").join(ma, ["a", "sa"]).join(mb, ["b", "sb"]).where("ka <> kb").select("ka", "kb")
    m = sized.where("n > 1").select("rep", "key", "parts", salt.alias("salt"))
    all_blocks = m.select("rep", F.col("key").alias("ka"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"))
    within = all_blocks.join(m.select("rep", "salt", F.col("key").alias("kb")), ["rep", "salt"]).where("ka < kb").select("ka", "kb")
    out = across.unionByName(within)
    out = out if star is None else out.unionByName(star)
    return out.select(F.least("ka", "kb").alias("rec_a"), F.greatest("ka", "kb").alias("rec_b"))


def class_report(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per record: rec_id, class_id (its representative), copies in the class, links to other classes."""
    links = pairs.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links"))
    size = members.groupBy("rep").agg(F.count("*").alias("n_copies"))
    return (
        members.join(size, "rep")
        .join(links, "rep", "left")
        .select(F.col("key").alias("rec_id"), F.col("rep").alias("class_id"), "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
