"""Problem 4: cutting oversized texts at natural boundaries.

Method: balanced targets. The least piece count that the limits allow gives equal
targets; each target snaps to the strongest boundary near it (paragraph, line,
sentence, clause, word, code point); when a piece breaks a limit the count is
raised by one and the targets are placed again.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.runtime import spread

MAX_WORDS, MAX_CHARS, OVERLAP_WORDS = 1000, 10_000, 100

_compiled = None


def _patterns():
    """Word pattern and boundary patterns by strength, the strongest first."""
    global _compiled
    if _compiled is None:
        import regex

        _compiled = (
            regex.compile(r"\P{White_Space}+"),
            [
                regex.compile(r"\n[^\S\n]*\n\s*"),  # paragraph
                regex.compile(r"\n\s*"),  # line
                regex.compile(r"[.!?。！？؟।…][\"'’”»)\]]*(?:\s+|(?<=[。！？][\"'’”»)\]]*))"),  # sentence
                regex.compile(r"[;:,—–،、；：，]\s+|[、；：，]"),  # clause
                regex.compile(r"\s+"),  # word
            ],
            regex.compile(r"\X"),
        )
    return _compiled


def _words_between(starts: list[int], a: int, b: int) -> int:
    """White-space words that begin in [a, b)."""
    return bisect.bisect_left(starts, b) - bisect.bisect_left(starts, a)


def cut(text: str, max_words: int = MAX_WORDS, max_chars: int = MAX_CHARS, overlap: int = OVERLAP_WORDS) -> list[tuple[int, int, int]]:
    """Pieces (start, body, end): text[start:end] is the piece, text[start:body] repeats the end of the one before.

    The bodies partition the text. A text within both limits is one piece. The
    overlap is the last ``overlap`` words of the piece before, fewer where the
    limits leave no room (it takes half of a piece at most).
    """
    word_re, levels, cluster = _patterns()
    n = len(text)
    spans = [m.span() for m in word_re.finditer(text)]
    starts = [a for a, _ in spans]
    if n <= max_chars and len(spans) <= max_words:
        return [(0, 0, n)]
    marks = [sorted({m.end() for m in p.finditer(text) if 0 < m.end() < n}) for p in levels]

    def size_ok(a: int, b: int) -> bool:
        # a cut inside a word begins a new word in the piece
        lead = int(bool(spans) and (i := bisect.bisect_right(starts, a) - 1) >= 0 and starts[i] < a < spans[i][1])
        return b - a <= max_chars and _words_between(starts, a, b) + lead <= max_words

    def repeat_from(body: int, prev_start: int) -> int:
        """Where a piece begins whose new part begins at ``body``."""
        i = bisect.bisect_left(starts, body)
        i0 = max(i - min(overlap, max_words // 2), bisect.bisect_left(starts, prev_start), 0)
        while i0 < i and body - starts[i0] > max_chars // 2:
            i0 += 1
        return starts[i0] if i0 < i else body

    room_words = max(1, max_words - min(overlap, max_words // 2))
    mean_word = n / max(1, len(spans))
    room_chars = max(1, max_chars - int(min(max_chars // 2, overlap * mean_word)))
    pieces = max(2, math.ceil(n / max_chars), math.ceil(len(spans) / max_words))
    while True:
        step = n / pieces
        out: list[tuple[int, int, int]] = []
        start = body = 0
        fits = True
        for k in range(1, pieces + 1):
            if k == pieces:
                end = n
            else:
                target = round(k * step)
                end = _snap(target, body, step, marks, text, cluster)
                if not size_ok(start, end):
                    # a boundary at or before the target keeps the balance when the later one breaks a limit
                    end = _snap(target, body, step, marks, text, cluster, early=True)
            if end <= body:
                continue
            if not size_ok(start, end):
                fits = False
                break
            out.append((start, body, end))
            start, body = repeat_from(end, start), end
        if fits and body == n:
            return out
        if pieces > 4 * (math.ceil(n / room_chars) + math.ceil(len(spans) / room_words)) + 8:
            return _greedy(text, spans, starts, marks, size_ok, repeat_from, cluster)
        pieces += 1


def _snap(target: int, low: int, step: float, marks, text: str, cluster, early: bool = False) -> int:
    """The strongest boundary near the target; weaker levels are searched closer to it."""
    reach = step * 0.35
    for level, at in enumerate(marks):
        r = reach * (1.0, 0.8, 0.7, 0.4, 0.25)[level]
        lo, hi = max(low + 1, target - r), target if early else target + r
        i = bisect.bisect_left(at, lo)
        near = []
        while i < len(at) and at[i] <= hi:
            near.append(at[i])
            i += 1
        if near:
            return min(near, key=lambda p: (abs(p - target), p))
    # no boundary at all: between two user-perceived characters
    a = max(low, target - 64)
    best = target
    for m in cluster.finditer(text, a, min(len(text), target + 64)):
        if m.end() <= target and m.end() > low:
            best = m.end()
    return best


def _greedy(text, spans, starts, marks, size_ok, repeat_from, cluster) -> list[tuple[int, int, int]]:
    """Last resort for texts whose density varies too much for equal targets: the farthest boundary that fits."""
    n, out, start, body = len(text), [], 0, 0
    while body < n:
        lo, hi = body, n  # farthest end that keeps the limits
        if not size_ok(start, n):
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (mid, hi) if size_ok(start, mid) else (lo, mid)
            end = lo
            for at in marks:
                i = bisect.bisect_right(at, lo) - 1
                if i >= 0 and at[i] > body + (lo - body) // 2:
                    end = at[i]
                    break
            if end <= body:
                start, end = body, max(lo, body + 1)
        else:
            end = n
        out.append((start, body, end))
        start, body = repeat_from(end, start), end
    return out


def pieces(chunks: DataFrame, key: str = "chunk_id", text: str = "text", max_words: int = MAX_WORDS, max_chars: int = MAX_CHARS, overlap: int = OVERLAP_WORDS) -> DataFrame:
    """Pieces of every text beyond a limit: key, piece_no (from 1), n_pieces, start, body, end, text.

    ``start``, ``body`` and ``end`` are code point offsets; bodies partition the
    text and text[start:body] repeats the end of the piece before. Null, blank and
    small texts give no row. Repeated keys are cut each; other columns are dropped.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, t in zip(pdf[key].tolist(), pdf[text].tolist()):
                cuts = cut(t, max_words, max_chars, overlap)
                if len(cuts) > 1:
                    rows += [(k, i, len(cuts), a, b, e, t[a:e]) for i, (a, b, e) in enumerate(cuts, 1)]
            yield pd.DataFrame(rows, columns=[key, "piece_no", "n_pieces", "start", "body", "end", "text"])

    kind = chunks.schema[key].dataType.simpleString()
    # w words need 2 w - 1 characters, so most texts never reach Python
    big = chunks.select(F.col(key), F.col(text).alias("text")).where(F.char_length("text") > min(2 * max_words, max_chars))
    return spread(big).withColumnRenamed("text", text).mapInPandas(
        run, f"{key} {kind}, piece_no int, n_pieces int, start int, body int, end int, text string"
    )
