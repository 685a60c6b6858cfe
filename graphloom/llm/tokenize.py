"""Problem 8: token ids of a whole corpus with a public byte-level BPE vocabulary.

Method: pair occurrence index. All distinct words of a batch stand in one linked
list of symbols; an index maps every mergeable pair to all its positions; active
ranks are applied in ascending order, each to all its positions at once, and only
the neighbouring entries are updated. A merge creates symbols whose own merges
were learned later, so no rank below the current one can appear.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.runtime import spread

#: folder of the vocabulary files; a parameter of every entry point
TOKENIZER_DIR = "/opt/tokenizers"
#: words kept in a Python worker's memo before it starts afresh (memory bound, not a cap on input)
MEMO_WORDS = 200_000


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file: visible Latin-1 keeps itself, the rest follow from 256."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return {chr(b if b in visible else next(spare)): b for b in range(256)}


class PairIndexEncoder:
    """Encoder of one vocabulary file (tokenizers JSON with ``vocab`` and ``merges``)."""

    def __init__(self, file: str, pattern: str):
        import regex

        with open(file, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        self.byte_id = [0] * 256
        for ch, b in _byte_alphabet().items():
            self.byte_id[b] = vocab[ch]
        self.rank: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for r, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.rank[vocab[a], vocab[b]] = r
            self.merged.append(vocab[a + b])
        self.words = regex.compile(pattern).findall
        self.memo: dict[str, list[int]] = {}

    def learn(self, words: list[str]) -> None:
        """Put the ids of words that the memo lacks into it, all words merged together."""
        sym: list[int] = []
        starts = []
        for w in words:
            starts.append(len(sym))
            sym.extend(map(self.byte_id.__getitem__, w.encode("utf-8", "surrogatepass")))
            sym.append(-1)  # a wall between words
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, merged = self.rank, self.merged
        where: dict[int, list[int]] = {}
        for i in range(n - 1):
            r = rank.get((sym[i], sym[i + 1]))
            if r is not None:
                where.setdefault(r, []).append(i)
        active = list(where)
        heapq.heapify(active)
        pair_of = self.pair_of
        while active:
            r = heapq.heappop(active)
            a, b = pair_of(r)
            new = merged[r]
            positions = where.pop(r)
            positions.sort()
            for i in positions:
                j = nxt[i]
                if sym[i] != a or j >= n or sym[j] != b:
                    continue  # overwritten by an earlier merge
                k = nxt[j]
                sym[i], sym[j] = new, -2
                nxt[i] = k
                if k < n:
                    prv[k] = i
                    q = rank.get((new, sym[k]))
                    if q is not None:
                        if q in where:
                            where[q].append(i)
                        else:
                            where[q] = [i]
                            heapq.heappush(active, q)
                h = prv[i]
                if h >= 0:
                    q = rank.get((sym[h], new))
                    if q is not None:
                        if q in where:
                            where[q].append(h)
                        else:
                            where[q] = [h]
                            heapq.heappush(active, q)
        for w, i in zip(words, starts):
            out = []
            while sym[i] != -1:
                out.append(sym[i])
                i = nxt[i]
            self.memo[w] = out

    _pairs: list[tuple[int, int]] | None = None

    def pair_of(self, r: int) -> tuple[int, int]:
        if self._pairs is None:
            self._pairs = list(self.rank)
        return self._pairs[r]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text; null and empty texts give an empty list."""
        split = [self.words(t) if t else () for t in texts]
        if len(self.memo) > MEMO_WORDS:
            self.memo = {}
        memo = self.memo
        new = {w for ws in split for w in ws if w not in memo}
        if new:
            self.learn(sorted(new))
        return [[i for w in ws for i in memo[w]] for ws in split]


def _pattern(folder: str) -> str:
    """The word pattern published beside the vocabularies."""
    import importlib.util
    import os

    spec = importlib.util.spec_from_file_location("_public_tokenizers", os.path.join(folder, "__init__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module.PATTERN


_loaded: dict[tuple[str, str], PairIndexEncoder] = {}


def encoder(folder: str = TOKENIZER_DIR, vocabulary: str = "byte_bpe_50k") -> PairIndexEncoder:
    """The encoder of this process; a Python worker reads the vocabulary once."""
    key = (folder, vocabulary)
    if key not in _loaded:
        _loaded[key] = PairIndexEncoder(f"{folder}/{vocabulary}.json", _pattern(folder))
    return _loaded[key]


def token_ids(docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str = TOKENIZER_DIR, vocabulary: str = "byte_bpe_50k", batch_chars: int = 4_000_000) -> DataFrame:
    """(key, ids array<int>) of every row, without special tokens.

    Strings that look like special tokens are ordinary text. Null and empty texts
    give an empty list; repeated rows are encoded each; other columns are dropped.
    No shuffle: the work is a map over the scan. Very long texts are worked in
    slices of ``batch_chars`` per Arrow batch only to bound memory; a text is
    never cut.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(folder, vocabulary)
        for pdf in batches:
            keys, texts = pdf[key].tolist(), pdf[text].tolist()
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size < batch_chars):
                    size += len(texts[end] or "")
                    end += 1
                yield pd.DataFrame({key: keys[at:end], "ids": enc.encode(texts[at:end])})
                at = end

    kind = docs.schema[key].dataType.simpleString()
    return spread(docs.select(key, text)).mapInPandas(run, f"{key} {kind}, ids array<int>")


def corpus_counts(encoded: DataFrame) -> DataFrame:
    """One row: documents, documents without tokens, tokens, longest document."""
    n = F.size("ids")
    return encoded.agg(
        F.count("*").alias("n_docs"),
        F.count_if(n == 0).alias("n_empty"),
        F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("n_tokens"),
        F.coalesce(F.max(n), F.lit(0)).alias("longest"),
    )
