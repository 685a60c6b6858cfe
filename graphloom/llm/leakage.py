"""Problem 9: evaluation texts inside the training text.

Method: the test items form a BM25 inverted index with block maxima; every
passage of the corpus is a query, and block-max WAND retrieves all items whose
score reaches the item's threshold. The threshold of an item is the least score
that any of its runs of ``run`` consecutive words can have, so no true case
falls below it; a retrieved item is then verified word by word.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.runtime import spread

#: consecutive words that make a leak
RUN = 12
#: words of a passage; neighbours overlap by run - 1 words
PASSAGE = 64
#: postings in a block of the index
BLOCK = 16
#: items in one index; more items are worked in several indexes, one scan each
MAX_ITEMS = 20_000
K1, B = 1.2, 0.75

_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """Longest runs of letters and numbers, in lower case."""
    if text.isascii():
        return _WORD.findall(text.lower())
    return [w.lower() for w in _WORD.findall(text)]


class ItemIndex:
    """BM25 inverted index of the items with block maxima."""

    def __init__(self, items: list[tuple[int, str]], run: int = RUN, block: int = BLOCK):
        self.run = run
        texts = [(i, words(t)) for i, t in items if t]
        texts = sorted((x for x in texts if len(x[1]) >= run), key=lambda x: x[0])
        self.ids = [i for i, _ in texts]
        n = max(1, len(texts))
        mean = sum(len(w) for _, w in texts) / n or 1.0
        df = Counter(t for _, w in texts for t in set(w))
        idf = {t: math.log(1 + (n - c + 0.5) / (c + 0.5)) for t, c in df.items()}
        self.term: dict[str, int] = {t: k for k, t in enumerate(sorted(df))}
        #: per term: item numbers, weights, and per block its last item and greatest weight
        self.posts: list[tuple[list[int], list[float]]] = [([], []) for _ in self.term]
        self.threshold: list[float] = []
        self.grams: list[set[tuple[int, ...]]] = []
        for d, (_, w) in enumerate(texts):
            tf = Counter(w)
            norm = K1 * (1 - B + B * len(w) / mean)
            weight = {t: idf[t] * c * (K1 + 1) / (c + norm) for t, c in tf.items()}
            for t, x in weight.items():
                p = self.posts[self.term[t]]
                p[0].append(d)
                p[1].append(x)
            ids = [self.term[t] for t in w]
            by_id = {self.term[t]: x for t, x in weight.items()}
            runs = {tuple(ids[i : i + run]) for i in range(len(ids) - run + 1)}
            self.grams.append(runs)
            self.threshold.append(min(sum(by_id[t] for t in set(g)) for g in runs) - 1e-9)
        self.blocks = [
            [(ds[min(i + block, len(ds)) - 1], max(ws[i : i + block])) for i in range(0, len(ds), block)] for ds, ws in self.posts
        ]
        self.top = [max(ws) for _, ws in self.posts]
        self.least = min(self.threshold, default=math.inf)
        self.span = block

    def retrieve(self, terms: set[int]) -> list[int]:
        """Items whose score for the query reaches their threshold, by block-max WAND."""
        if sum(self.top[t] for t in terms) < self.least:
            return []
        out: list[int] = []
        cur = {t: 0 for t in terms}
        live = sorted(terms, key=lambda t: self.posts[t][0][0])
        while live:
            live.sort(key=lambda t: self.posts[t][0][cur[t]])
            bound, pivot = 0.0, -1
            for k, t in enumerate(live):
                bound += self.top[t]
                if bound >= self.least:
                    pivot = k
                    break
            if pivot < 0:
                break
            d = self.posts[live[pivot]][0][cur[live[pivot]]]
            while pivot + 1 < len(live) and self.posts[live[pivot + 1]][0][cur[live[pivot + 1]]] == d:
                pivot += 1
            # block maxima of the lists up to the pivot
            tight, next_d = 0.0, math.inf
            for t in live[: pivot + 1]:
                last, top = self._block(t, cur[t], d)
                tight += top
                next_d = min(next_d, last + 1)
            if pivot + 1 < len(live):
                next_d = min(next_d, self.posts[live[pivot + 1]][0][cur[live[pivot + 1]]])
            if tight < self.least:
                # no item of these blocks can reach a threshold
                target = max(d + 1, next_d)
                move = live[: pivot + 1]
            else:
                if self.posts[live[0]][0][cur[live[0]]] == d:
                    score = 0.0
                    for t in live[: pivot + 1]:
                        score += self.posts[t][1][cur[t]]
                    if score >= self.threshold[d]:
                        out.append(d)
                    target = d + 1
                else:
                    target = d
                move = [t for t in live[: pivot + 1] if self.posts[t][0][cur[t]] < target]
            for t in move:
                ds = self.posts[t][0]
                k = cur[t]
                while k < len(ds) and ds[k] < target:
                    k += 1
                cur[t] = k
            live = [t for t in live if cur[t] < len(self.posts[t][0])]
        return out

    def _block(self, t: int, k: int, d: int) -> tuple[float, float]:
        """Last item and greatest weight of the block of term t that may hold item d, from position k on."""
        bs = self.blocks[t]
        b = k // self.span
        while b < len(bs) and bs[b][0] < d:
            b += 1
        return bs[b] if b < len(bs) else (math.inf, 0.0)

    def leaks(self, text: str, passage: int = PASSAGE) -> set[int]:
        """Ids of the items of which the text holds a run of words."""
        run, term = self.run, self.term
        toks = [term.get(w, -1) for w in words(text)]
        found: set[int] = set()
        n, i = len(toks), 0
        while i < n:
            if toks[i] < 0:
                i += 1
                continue
            j = i
            while j < n and toks[j] >= 0:
                j += 1
            # a run of item words lies within one stretch of known words
            if j - i >= run:
                at = i
                while True:
                    end = min(at + passage, j)
                    window = toks[at:end]
                    for d in self.retrieve(set(window)):
                        if self.ids[d] in found:
                            continue
                        g = self.grams[d]
                        if any(tuple(window[k : k + run]) in g for k in range(len(window) - run + 1)):
                            found.add(self.ids[d])
                    if end == j:
                        break
                    at = end - run + 1
            i = j
        return found


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", run: int = RUN) -> DataFrame:
    """(key, item_key) for each document that holds ``run`` consecutive words of an item, once per pair of keys and row.

    Case, punctuation and spacing do not matter. Items with fewer words than a run
    cannot leak. Null and empty texts hold nothing; repeated documents are
    reported each; other columns, also of the same name, are ignored. Items are a
    fixed test collection: they are read in blocks of MAX_ITEMS, one index and one
    scan of the corpus each, so what is sent to the workers is bounded.
    """
    its = items.select(F.col(item_key).alias("i"), F.col(item_text).alias("t")).where(F.col("t").isNotNull())
    total = its.count()
    parts = max(1, math.ceil(total / MAX_ITEMS))
    kind = docs.schema[key].dataType.simpleString()
    item_kind = items.schema[item_key].dataType.simpleString()
    base = spread(docs.select(key, text).where(F.char_length(text) >= 2 * run - 1))
    out = None
    for p in range(parts):
        rows = [tuple(r) for r in its.where(F.pmod(F.xxhash64("i"), F.lit(parts)) == p).collect()]

        def search(batches: Iterator[pd.DataFrame], rows=rows) -> Iterator[pd.DataFrame]:
            index = ItemIndex(rows, run)
            for pdf in batches:
                hits = [(k, i) for k, t in zip(pdf[key].tolist(), pdf[text].tolist()) for i in sorted(index.leaks(t))]
                yield pd.DataFrame(hits, columns=[key, item_key])

        part = base.mapInPandas(search, f"{key} {kind}, {item_key} {item_kind}")
        out = part if out is None else out.unionByName(part)
    return out


def leak_report(found: DataFrame, items: DataFrame) -> DataFrame:
    """Per item: suite and the number of documents that hold a passage of it, zero included."""
    n = found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_docs"))
    return items.select("item_id", "suite").join(n, "item_id", "left").select("item_id", "suite", F.coalesce("n_docs", F.lit(0)).alias("n_docs"))
