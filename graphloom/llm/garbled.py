"""Problem 10: text decoded with a wrong character encoding.

Method: expectation-maximization with latent encoding chains. Each record has a
latent chain (how its bytes were misread, or none). A chain is invertible token
by token, so the likelihood of a token under it is the likelihood of the repaired
token in a character model of the corpus. The prior of each chain is pooled per
source; both the character model and the priors are re-estimated from the
posteriors, and each record is repaired by its posterior.

Misread characters may have been written as character references afterwards
(``&#195;&#169;``), so a text may be garbled and yet pure ASCII. References to
non-ASCII characters are undone before a token is judged; the step is certain
and takes no part in the priors. A rightly decoded text with references is as
clean as the same text without them.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from html.entities import html5
from itertools import pairwise

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.runtime import spread

#: sources are pooled in this many hash buckets, so the priors have a bounded size
SOURCE_BUCKETS = 1024
ITERATIONS = 2
#: share of tokens of a garbled record that are expected to be garbled
PART = 0.5
PRIOR_CLEAN = 0.96
#: weight of the corpus-wide prior, in records
POOL = 20.0
CLEAN = "clean"

#: codecs under which UTF-8 bytes are commonly misread
UTF8_READ_AS = ("cp1252", "latin_1", "cp1250", "cp1251", "iso8859_2", "iso8859_9", "iso8859_15", "mac_roman", "cp437", "cp850", "koi8_r", "cp866")
#: (true, read as) single-byte mistakes
SINGLE_BYTE = (
    ("cp1251", "cp1252"), ("koi8_r", "cp1252"), ("cp866", "cp1252"), ("iso8859_5", "cp1252"), ("cp1251", "koi8_r"), ("koi8_r", "cp1251"),
    ("cp866", "cp1251"), ("cp1251", "cp866"), ("iso8859_5", "cp1251"), ("cp1251", "mac_roman"), ("koi8_r", "mac_roman"),
    ("cp1252", "mac_roman"), ("mac_roman", "cp1252"), ("cp1252", "cp437"), ("cp1252", "cp850"), ("cp437", "cp1252"), ("cp850", "cp1252"),
    ("cp1250", "cp1252"), ("iso8859_2", "cp1252"), ("cp1254", "cp1252"), ("cp1252", "cp1250"), ("cp1252", "cp1251"), ("cp1250", "cp1251"),
    ("cp1254", "cp1251"), ("cp1250", "mac_roman"), ("cp1254", "mac_roman"), ("cp1250", "cp850"), ("cp1252", "iso8859_2"), ("cp1253", "cp1252"),
)

_TOKEN = re.compile(r"[^ \t\n\r]+")
_RUN = re.compile(r"[^\x00-\x7f]+")
#: replacement characters and C1 controls are left only by wrong decoding
_HARD = re.compile("[�\u0080-\u0084\u0086-\u009f]")
#: lead bytes of the blocks whose second byte is often a C1 control, at a token's end and not in an upper-case word
_LEAD_END = re.compile("(?<![A-ZÀ-Þ])[ÂÃÄÅÐÑâ]$")
#: a character reference, its ampersand possibly escaped again
_REF = re.compile(r"&(?:amp;)*(?:#(\d{2,7})|#[xX]([0-9a-fA-F]{2,6})|([A-Za-z][A-Za-z0-9]{1,31};))(?:(?<=;)|;)")
#: what a lone lead byte costs as a reading, in nats: the lost character has some probability
_LOST = 3.0


def unescape(s: str, literal: bool = False) -> str:
    """``s`` without references to non-ASCII characters; those to ASCII characters stay.

    Numbers 128 to 159 mean bytes of cp1252, as in web readers, or with
    ``literal`` the C1 controls themselves.
    """
    if "&" not in s:
        return s

    def char(m: re.Match) -> str:
        dec, hexa, name = m.groups()
        if name:
            c = html5.get(name, "")
        else:
            n = int(dec) if dec else int(hexa, 16)
            if n > 0x10FFFF or 0xD800 <= n <= 0xDFFF:
                return m.group()
            c = chr(n)
            if 0x80 <= n <= 0x9F and not literal:
                try:
                    c = bytes([n]).decode("cp1252")
                except UnicodeDecodeError:
                    pass
        return c if c and not any(ord(x) < 128 for x in c) else m.group()

    return _REF.sub(char, s)


def _encode(s: str, codec: str) -> bytes | None:
    """Bytes of ``s``; codecs with holes let the C1 control of an undefined byte through, as web readers do."""
    try:
        return s.encode(codec)
    except UnicodeEncodeError:
        out = bytearray()
        for c in s:
            try:
                out += c.encode(codec)
            except UnicodeEncodeError:
                if 0x80 <= ord(c) <= 0x9F and codec.startswith("cp12"):
                    out.append(ord(c))
                else:
                    return None
        return bytes(out)


def _utf8_from(codec: str, times: int):
    def fix(run: str) -> str | None:
        for _ in range(times):
            b = _encode(run, codec)
            if b is None:
                return None
            try:
                run = b.decode("utf-8")
            except UnicodeDecodeError:
                return None
        return run

    return fix


def _single(true: str, read: str):
    def fix(run: str) -> str | None:
        b = _encode(run, read)
        if b is None:
            return None
        try:
            return b.decode(true)
        except UnicodeDecodeError:
            return None

    return fix


CHAINS: dict[str, object] = {f"utf8>{c}": _utf8_from(c, 1) for c in UTF8_READ_AS}
CHAINS |= {f"utf8>{c}*{n}": _utf8_from(c, n) for c in ("cp1252", "latin_1") for n in (2, 3)}
UTF8_CHAINS = frozenset(CHAINS)
CHAINS |= {f"{t}>{r}": _single(t, r) for t, r in SINGLE_BYTE}
BLANKED = "utf8>latin_1>blanked"
#: bytes that could not be decoded were replaced or left as C1 controls: what they were is lost
LOSSY = "lossy"
NAMES = [CLEAN, *CHAINS, BLANKED, LOSSY]
#: added to the chain of a record whose garbled characters stood as references
ESCAPED = ">escaped"


def repair_token(token: str, chain: str) -> str | None:
    """The token with every non-ASCII run read again under the chain; null when the chain cannot have made it."""
    if chain == LOSSY:
        return _HARD.sub("", token) if _HARD.search(token) else None
    if chain == BLANKED:
        # C1 controls were turned into blanks: a lead byte stands alone before a blank
        base = _LEAD_END.sub("", token)
        if base == token:
            return repair_token(token, "utf8>latin_1") if _RUN.search(token) else None
        return base if not _RUN.search(base) else (repair_token(base, "utf8>latin_1") or base)
    fix = CHAINS[chain]
    out, at = [], 0
    for m in _RUN.finditer(token):
        if m.group().strip("\xa0") == "":
            continue  # no-break spaces between words are no evidence
        r = fix(m.group())
        if r is None:
            return None
        out += [token[at : m.start()], r]
        at = m.end()
    out.append(token[at:])
    fixed = "".join(out)
    return None if fixed == token or _HARD.search(fixed) else fixed


def symbol(c: str) -> str:
    """A character's class in the model: ASCII letters by case, rare blocks by block, the rest itself."""
    o = ord(c)
    if c == "\xa0":
        return " "
    if o < 128:
        return "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c if c in "-'\"" else "."
    if o < 0x530 or 0x2000 <= o < 0x2600:
        return c
    return f"b{o >> 8:x}"


def bigrams(token: str) -> list[str]:
    """Bigrams of the padded token's classes, as 'x|y'."""
    s = [" ", *map(symbol, token), " "]
    return [f"{a}|{b}" for a, b in pairwise(s)]


class CharModel:
    """Bigram model of the tokens with non-ASCII characters, smoothed with unigrams."""

    def __init__(self, counts: dict[str, float]):
        self.terms: dict[str, float] = {}
        self.pair = counts
        self.left: dict[str, float] = defaultdict(float)
        self.right: dict[str, float] = defaultdict(float)
        for k, n in counts.items():
            a, b = k.split("|", 1) if not k.startswith("||") else ("|", k[2:])
            self.left[a] += n
            self.right[b] += n
        self.total = sum(counts.values()) + 1.0
        self.size = len(self.right) + 2000.0

    def token(self, token: str) -> float:
        """Log-likelihood of the bigrams of a token that hold a non-ASCII character."""
        s = [" ", *map(symbol, token), " "]
        raw = f" {token} "
        out = 0.0
        for i in range(len(s) - 1):
            if ord(raw[i]) < 128 and ord(raw[i + 1]) < 128:
                continue
            k = f"{s[i]}|{s[i + 1]}"
            v = self.terms.get(k)
            if v is None:
                u = (self.right.get(s[i + 1], 0.0) + 0.3) / (self.total + 0.3 * self.size)
                v = self.terms[k] = math.log((self.pair.get(k, 0.0) + 2.0 * u) / (self.left.get(s[i], 0.0) + 2.0))
            out += v
        return out


class Reader:
    """E-step of one worker: posteriors of records under a character model and the priors."""

    def __init__(self, counts: dict[str, float], priors: dict[int, dict[str, float]]):
        self.model = CharModel(counts)
        self.totals = {b: sum(p.values()) for b, p in priors.items()}
        self.priors = priors
        pooled: dict[str, float] = defaultdict(float)
        for p in priors.values():
            for c, n in p.items():
                pooled[c] += n
        n = sum(pooled.values())
        k = len(NAMES) - 1
        base = {c: (PRIOR_CLEAN if c == CLEAN else (1 - PRIOR_CLEAN) / k) for c in NAMES}
        self.pooled = {c: (pooled.get(c, 0.0) + 50.0 * base[c]) / (n + 50.0) for c in NAMES}
        self.memo: dict[str, list[tuple[str, float, str, float]]] = {}

    def prior(self, bucket: int, chain: str) -> float:
        own = self.priors.get(bucket, {}).get(chain, 0.0)
        return (own + POOL * self.pooled[chain]) / (self.totals.get(bucket, 0.0) + POOL)

    def readings(self, token: str) -> list[tuple[str, float, str, float]]:
        """[(chain, log evidence for it, repaired token, responsibility)]."""
        got = self.memo.get(token)
        if got is None:
            lp = self.model.token
            plain, literal = unescape(token), unescape(token, True)
            lone = bool(_LEAD_END.search(plain))
            alts = []
            # UTF-8 makes two or more characters of one, so a run of one character has no such reading
            single = literal == plain and any(len(m) == 1 and m != "\xa0" for m in _RUN.findall(plain))
            known: dict[str, float] = {}
            for c in NAMES[1:]:
                if single and c in UTF8_CHAINS:
                    continue
                r = repair_token(plain, c)
                if r is None and literal != plain:
                    r = repair_token(literal, c)
                if r is not None:
                    if r not in known:
                        known[r] = lp(r)
                    alts.append((c, known[r] - _LOST * ((lone and c == BLANKED) or c == LOSSY), r))
            # what a token says for each chain, and how sure its repair is, once and for all records
            l0, got = lp(plain), []
            for c, l1, r in alts:
                e = PART * math.exp(min(max(l1 - l0, -50.0), 50.0))
                got.append((c, math.log(1 - PART + e), r, e / (1 - PART + e)))
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[token] = got
        return got

    def posterior(self, tokens: Counter, bucket: int) -> dict[str, float]:
        """Posterior of each chain of a record."""
        gain: dict[str, float] = {}
        for t, n in tokens.items():
            for c, g, _, _ in self.readings(t):
                gain[c] = gain.get(c, 0.0) + n * g
        logs = {CLEAN: math.log(self.prior(bucket, CLEAN))}
        for c, g in gain.items():
            logs[c] = math.log(self.prior(bucket, c)) + g
        top = max(logs.values())
        total = sum(math.exp(v - top) for v in logs.values())
        return {c: math.exp(v - top) / total for c, v in logs.items()}

    def fixes(self, tokens: Counter, chain: str) -> dict[str, tuple[str, float]]:
        """Repaired form and responsibility of the tokens that a chain changes."""
        return {t: (r, w) for t in tokens for c, _, r, w in self.readings(t) if c == chain}


def odd_tokens(text: str) -> Counter:
    """The tokens of a text that hold non-ASCII characters or references to them, with their counts."""
    if text.isascii() and "&" not in text:
        return Counter()
    parts = text.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ")
    return Counter(t for t in parts if t and (not t.isascii() or ("&" in t and not unescape(t).isascii())))


def _pass(docs: DataFrame, reader_args, text: str) -> DataFrame:
    """Expected counts of one E-step: kind ('pair' or 'chain'), key, bucket, n."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(*reader_args) if reader_args else None
        pairs: dict[str, float] = defaultdict(float)
        chains: dict[tuple[int, str], float] = defaultdict(float)
        # tokens are counted first and cut into bigrams once each
        weights: dict[str, float] = {}

        def spend() -> None:
            for t, w in weights.items():
                for k in bigrams(t):
                    pairs[k] += w
            weights.clear()

        def add(token: str, w: float) -> None:
            weights[token] = weights.get(token, 0.0) + w
            if len(weights) > 50_000:
                spend()

        for pdf in batches:
            for t, bucket in zip(pdf[text], pdf["bucket"]):
                toks = odd_tokens(t) if t else None
                if not toks:
                    chains[bucket, CLEAN] += 1.0
                    continue
                if reader is None:
                    for k, n in toks.items():
                        add(unescape(k), n)
                    continue
                post = reader.posterior(toks, bucket)
                for c, p in post.items():
                    if p > 1e-6:
                        chains[bucket, c] += p
                c = max(post, key=post.get)
                fixes = reader.fixes(toks, c) if c != CLEAN else {}
                for k, n in toks.items():
                    r, w = fixes.get(k, (None, 0.0))
                    plain = unescape(k)
                    if not _HARD.search(plain):
                        add(plain, n * (1 - post[c] * w) if r else n)
                    if r and c != LOSSY:
                        add(r, n * post[c] * w)
        spend()
        rows = [("pair", k, 0, n) for k, n in pairs.items()] + [("chain", c, b, n) for (b, c), n in chains.items()]
        yield pd.DataFrame(rows, columns=["kind", "key", "bucket", "n"])

    return docs.mapInPandas(run, "kind string, key string, bucket int, n double").groupBy("kind", "key", "bucket").agg(F.sum("n").alias("n"))


def _prepare(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    return docs.select(key, text, F.pmod(F.xxhash64(F.coalesce(F.col(source), F.lit(""))), F.lit(SOURCE_BUCKETS)).cast("int").alias("bucket"))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", iterations: int = ITERATIONS):
    """Character counts and chain priors after EM over all records.

    What reaches the driver is bounded by the alphabet classes squared and by
    SOURCE_BUCKETS x chains, whatever the number of records.
    """
    df = _prepare(docs, key, text, source)
    args = None
    for i in range(iterations + 1):
        counts: dict[str, float] = {}
        priors: dict[int, dict[str, float]] = defaultdict(dict)
        for kind, k, b, n in _pass(df, args, text).collect():
            if kind == "pair":
                counts[k] = n
            elif i:
                priors[b][k] = n
        args = (counts, dict(priors))
    return args


def diagnose(docs: DataFrame, model=None, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Garbled records: key, chain, posterior, restored, complete.

    A record is garbled when the posterior of having a chain is above one half;
    replacement characters and C1 controls, as such or as references, are evidence
    of the chain ``lossy``, which restores nothing. ``restored`` repairs each token by its
    responsibility; ``complete`` tells whether no mark of loss remains (replacement
    characters, lone lead bytes). Null and empty texts and ASCII texts without
    references to other characters are never garbled; repeated rows come out
    each; a null source is a source of its own; extra columns are ignored.
    """
    args = model or fit(docs, key, text, source)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(*args)
        for pdf in batches:
            rows = []
            for k, t, bucket in zip(pdf[key], pdf[text], pdf["bucket"]):
                toks = odd_tokens(t) if t else None
                if not toks:
                    continue
                post = reader.posterior(toks, bucket)
                bad = 1.0 - post[CLEAN]
                if bad <= 0.5:
                    continue
                # a chain that repairs something goes before the one that only knows of a loss
                c = max((x for x in post if x not in (CLEAN, LOSSY) and post[x] > post[CLEAN]), key=post.get, default=LOSSY)
                fixed, lost = t, c == LOSSY
                if c != LOSSY:
                    by = reader.fixes(toks, c)
                    fixed = _TOKEN.sub(lambda m: by[m.group()][0] if m.group() in by and by[m.group()][1] > 0.5 else m.group(), t)
                    lost = c == BLANKED
                    if any(w > 0.5 and unescape(x) != x for x, (_, w) in by.items()):
                        c += ESCAPED
                rows.append((k, c, bad, fixed, not lost and not _HARD.search(unescape(fixed))))
            yield pd.DataFrame(rows, columns=[key, "chain", "posterior", "restored", "complete"])

    kind = docs.schema[key].dataType.simpleString()
    return spread(_prepare(docs, key, text, source)).mapInPandas(run, f"{key} {kind}, chain string, posterior double, restored string, complete boolean")
