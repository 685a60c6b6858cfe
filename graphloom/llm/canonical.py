"""Problem 1: free-typed values mapped to the entries of a reference list.

Method: a multi-pattern automaton over the entries' names and aliases finds
embedded mentions, the longest non-overlapping ones win; values that it does not
settle go to token-set similarity, where tokens may differ by typing errors.
"""

from __future__ import annotations

import bisect
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.runtime import blank, spread

UNMATCHED = "UNMATCHED"
#: entries of all lists that travel to the workers, about half a kilobyte each
MAX_ENTRIES = 200_000
#: least token-set similarity
THRESHOLD = 0.66

#: further ways to say an entry, beside the list's own aliases: a table argument of :func:`assign`, here plain English paraphrases for
#: the two lists of the data model. Another list needs its own table or none; names, aliases and their inflections work without.
LEXICON: dict[str, dict[str, tuple[str, ...]]] = {
    "relationship_type": {
        "Influences": ("influence", "influencing", "does influence", "influence on", "influences on", "has an influence on", "affects", "impacts", "has an effect on", "inspires", "shape", "shaping"),
        "IsInfluencedBy": ("was influenced by", "influence from", "is affected by", "affected by", "inspired by", "is shaped by", "was shaped by", "under the influence of"),
        "Precedes": ("precede", "preceding", "happened before", "happens before", "is before", "came before", "earlier than", "predate", "predecessor of", "prior to", "precursor of", "leads up to"),
        "Follows": ("follow", "following", "happened after", "happens after", "is after", "came after", "later than", "succeed", "successor of", "succeeding", "subsequent to"),
        "References": ("reference", "referencing", "reference to", "cite", "citing", "quotes", "quotes from", "mentions", "refer to", "referring to", "makes reference to", "citation of"),
        "IsReferencedBy": ("was referenced by", "is cited by", "was cited by", "quoted by", "mentioned by", "is mentioned by", "referred to by", "reference from"),
        "Participates": ("participate", "participating", "participating in", "participate in", "participation", "participation in", "participant in", "participant of", "take part in", "taking part in", "took part in", "attends", "attended", "attends meeting", "joins", "is involved in", "member of"),
        "Develops": ("develop", "developing", "development of", "developer of", "work out", "devises", "creates", "designs"),
        "IsLocatedIn": ("location is", "is located at", "located at", "is based in", "was located in", "takes place in", "held at", "is held at", "is held in", "held in", "lies in", "situated in", "is situated in", "take place at", "taking place at", "location in", "is in"),
        "Contains": ("contain", "containing", "contains part", "has part", "has as part", "include", "including", "comprise", "comprising", "consists of", "is made up of", "encompasses"),
        "Publishes": ("publish", "publishing", "publisher of", "publication of", "issue", "issuing", "releases", "bring out", "prints", "is publisher of"),
        "IsPublishedBy": ("was published by", "is issued by", "was issued by", "released by", "brought out by", "publication by", "published through"),
        "Advocates": ("advocate", "advocating", "advocacy for", "advocate of", "advocate for", "advocating for", "speak for", "speaks in favour of", "campaigns for", "promotes", "champions", "argues for", "supports the cause of"),
        "Criticizes": ("criticize", "criticise", "criticizing", "criticising", "critic of", "critical of", "is critical of", "criticism of", "critique of", "object to", "objecting to", "speaks against", "opposes", "argues against", "denounces"),
        "Collaborates": ("collaborate", "collaborating", "collaboration", "collaboration with", "in collaboration with", "collaborating with", "collaborate with", "collaborator of", "partner with", "partner of", "partnering with", "partnership with", "in partnership with", "cooperates with", "cooperation with", "work with", "working with", "works jointly with", "works together with", "teams up with"),
        "Funds": ("fund", "funding", "funder of", "funding for", "finance", "financing", "pay for", "paying for", "gives grants to", "gives money to", "grants money to", "sponsors", "sponsor of", "provides funding for", "bankrolls"),
        "IsFundedBy": ("was funded by", "is financed by", "was financed by", "paid for by", "is paid for by", "sponsored by", "is sponsored by", "gets grants from", "receives grants from", "gets money from", "funding from", "funds from", "grants from"),
        "Implements": ("implement", "implementing", "implementation of", "implementer of", "carry out", "carrying out", "put into practice", "putting into practice", "executes", "enacts", "realises"),
        "IsImplementedBy": ("was implemented by", "is carried out by", "was carried out by", "put into practice by", "is put into practice by", "executed by", "implementation by"),
        "Builds": ("build", "building", "builder of", "construct", "constructing", "construction of", "set up", "setting up", "erects"),
        "IsBuiltOn": ("was built on", "built upon", "is built upon", "is based on", "based on", "builds on", "builds upon", "rest on", "resting on", "is founded on", "founded on", "relies on", "draws on"),
        "Extends": ("extend", "extending", "extension of", "widen", "widening", "expand", "expanding", "expansion of", "broadens", "enlarges", "expands on"),
        "IsExtendedBy": ("was extended by", "is expanded by", "expanded by", "was expanded by", "is widened by", "was widened by", "broadened by", "enlarged by", "extension by"),
        "Other": ("others", "other link", "other relation", "other relationship", "other type"),
    },
    "event_type": {
        "Publication": ("publications", "publish", "publishing", "published", "paper released", "release of a paper", "release of a book", "report released", "report release", "book release", "book released", "book published", "paper published", "report published", "launch of a book", "paper", "report", "book"),
        "Conference": ("conferences", "conference meeting", "meeting", "assembly", "convention", "forum", "workshop", "gathering", "seminar", "conference of parties"),
        "Policy": ("policies", "policy decision", "decision", "policy change", "new law", "law passed", "treaty", "rule", "act", "decree", "directive"),
        "Research": ("researches", "research study", "research project", "trial", "experiment", "studies", "clinical trial", "scientific research", "survey", "investigation"),
        "Movement": ("movements", "social movement", "mass movement", "protest movement", "march", "demonstration", "strike", "rally", "uprising"),
        "Organization": ("organizations", "organisations", "organization founded", "organisation founded", "founding", "founding of an organization", "foundation of an organisation", "founding of a body", "organization change", "body founded", "establishment of an organisation", "new organisation", "organizational change"),
        "Other": ("others", "other event", "other events", "other type"),
    },
}

#: words that may stand around a mention without changing it
FUNCTION_WORDS = frozenset(
    "a an the is are was were be been being has have had do does did will would to of on in at with from by for into and as its it that this which event events type kind relation relationship link target source entity".split()
)


def tokens(value: str) -> list[str]:
    """Lower-case tokens; camel case, underscores, hyphens and punctuation separate them."""
    s = unicodedata.normalize("NFKD", value)
    s = "".join(c for c in s if not unicodedata.combining(c))
    if not s.isupper():
        # only a lower-case letter before an upper-case one that begins a longer word is a camel hump
        s = re.sub(r"(?<=[a-z])(?=[A-Z][a-z])", " ", s)
        s = re.sub(r"(?<=[A-Z])(?=[A-Z][a-z]{2})", " ", s)
    return re.findall(r"[^\W_]+", s.lower())


_AUXILIARY = frozenset("is are was were be been being has have had do does did".split())


def stem(token: str) -> str:
    """An English verb or noun without its inflection, by its ending alone."""
    for end, least in (("ying", 2), ("ies", 2), ("ied", 2), ("ing", 3), ("ed", 3), ("es", 3), ("s", 3), ("e", 3), ("y", 3)):
        if token.endswith(end) and len(token) - len(end) >= least and not token.endswith("ss"):
            out = token[: -len(end)]
            # a doubled consonant before the ending: planning, stopped
            return out[:-1] if len(out) > 3 and out[-1] == out[-2] and out[-1] not in "aeiouls" and end in ("ing", "ed") else out
    return token


def stems(toks: list[str]) -> str:
    """Key under which inflections of a phrase meet: stems without auxiliary verbs."""
    return " ".join(stem(t) for t in toks if t not in _AUXILIARY)


def osa(a: str, b: str, limit: int) -> int:
    """Edits with transpositions between two strings, limit + 1 when more than ``limit``."""
    la, lb = len(a), len(b)
    if abs(la - lb) > limit:
        return limit + 1
    before: list[int] = []
    prev = list(range(lb + 1))
    for i in range(1, la + 1):
        cur = [i] + [0] * lb
        ca = a[i - 1]
        least = i
        for j in range(1, lb + 1):
            cb = b[j - 1]
            v = prev[j - 1] + (ca != cb)
            if prev[j] + 1 < v:
                v = prev[j] + 1
            if cur[j - 1] + 1 < v:
                v = cur[j - 1] + 1
            if i > 1 and j > 1 and ca == b[j - 2] and a[i - 2] == cb and before[j - 2] + 1 < v:
                v = before[j - 2] + 1
            cur[j] = v
            if v < least:
                least = v
        # a transposition reaches back two rows
        if least > limit and min(prev) > limit:
            return limit + 1
        before, prev = prev, cur
    return min(prev[lb], limit + 1)


def _bag(s: str) -> np.ndarray:
    v = np.zeros(37, np.int16)
    for c in s:
        o = ord(c)
        v[o - 97 if 97 <= o < 123 else 26 + o - 48 if 48 <= o < 58 else 36] += 1
    return v


@dataclass
class Matcher:
    """The automaton and similarity tables of one list."""

    entries: list[str]
    names: list[str]  # squeezed phrases
    parts: list[list[str]]  # their tokens
    owner: list[int]  # phrase -> entry
    strict: frozenset[int]  # entries meant only by writings of their own names

    def __post_init__(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        by: dict[str, int] = {}
        for i, p in enumerate(self.parts):
            by.setdefault(" " + " ".join(p) + " ", i)
        for text, i in by.items():
            self.automaton.add_word(text, (i, len(text)))
        if by:
            self.automaton.make_automaton()
        self.exact: dict[str, int] = {}
        for i, n in enumerate(self.names):
            self.exact.setdefault(n, self.owner[i])
        self.bags = np.array([_bag(n) for n in self.names]) if self.names else np.zeros((0, 37), np.int16)
        # phrases by token: a value is compared with those that hold enough tokens like its own
        self.holders: dict[str, list[int]] = {}
        for i, p in enumerate(self.parts):
            for t in set(p):
                self.holders.setdefault(t, []).append(i)
        self.vocab = list(self.holders)
        self.token_bags = np.array([_bag(t) for t in self.vocab]) if self.vocab else np.zeros((0, 37), np.int16)
        self.token_size = self.token_bags.sum(1)
        self.near_memo: dict[str, list[str]] = {}
        self.stemmed: dict[str, int] = {}
        for i, p in enumerate(self.parts):
            if self.owner[i] not in self.strict and (k := stems(p)):
                # a stem of two entries settles nothing
                self.stemmed[k] = self.owner[i] if self.stemmed.get(k, self.owner[i]) == self.owner[i] else -1
        self.whole = sorted(("".join(tokens(e)), i) for i, e in enumerate(self.entries))
        self.memo: dict[str, str] = {}

    def mention(self, toks: list[str]) -> int | None:
        """Entry of the longest non-overlapping mentions when they agree and only function words remain."""
        if not self.names:
            return None
        text = " " + " ".join(toks) + " "
        # phrases share their outer blank with the next word, so a match is [start, end)
        hits = [(end - size + 1, end, i) for end, (i, size) in self.automaton.iter(text)]
        hits.sort(key=lambda h: (h[0] - h[1], h[0]))
        taken: list[tuple[int, int, int]] = []
        for a, b, i in hits:
            if all(b <= x or a >= y for x, y, _ in taken):
                taken.append((a, b, i))
        if not taken:
            return None
        owners = {self.owner[i] for _, _, i in taken}
        if len(owners) > 1:
            return None
        rest = list(text)
        for a, b, _ in taken:
            rest[a + 1 : b] = " " * (b - a - 1)
        left = "".join(rest).split()
        # "by" turns the direction and is no free word beside an active phrase
        if any(w not in FUNCTION_WORDS or w == "by" for w in left):
            return None
        return owners.pop()

    def token_set(self, toks: list[str], phrase: int) -> float:
        """Soft Dice coefficient of two token sets; tokens meet at a similarity of 0.7 or more."""
        a, b = list(dict.fromkeys(toks)), list(dict.fromkeys(self.parts[phrase]))
        total = 0.0
        free = set(range(len(b)))
        for x in a:
            best, arg = 0.0, -1
            for j in free:
                y = b[j]
                m = max(len(x), len(y))
                lim = int(0.3 * m)
                s = 1.0 if x == y else (1 - d / m if (d := osa(x, y, lim)) <= lim else 0.0)
                if s > best:
                    best, arg = s, j
            if arg >= 0:
                free.discard(arg)
                total += best
        return 2 * total / (len(a) + len(b))

    def near(self, token: str) -> list[str]:
        """Tokens of the list that may meet a token in :meth:`token_set`."""
        got = self.near_memo.get(token)
        if got is None:
            diff = self.token_bags - _bag(token)
            bound = np.maximum(np.maximum(diff, 0).sum(1), np.maximum(-diff, 0).sum(1))
            some = np.flatnonzero(bound <= (0.3 * np.maximum(self.token_size, len(token))).astype(int))
            got = []
            for i in some:
                t = self.vocab[i]
                lim = int(0.3 * max(len(t), len(token)))
                if t == token or osa(token, t, lim) <= lim:
                    got.append(t)
            if len(self.near_memo) > 100_000:
                self.near_memo.clear()
            self.near_memo[token] = got
        return got

    def like(self, toks: list[str], least: float) -> list[int]:
        """Phrases of two or more tokens whose token-set similarity with the value can reach ``least``."""
        held: dict[int, int] = {}
        mine = list(dict.fromkeys(toks))
        for x in mine:
            for i in {i for t in self.near(x) for i in self.holders[t]}:
                held[i] = held.get(i, 0) + 1
        return sorted(i for i, n in held.items() if len(self.parts[i]) > 1 and 2 * n >= least * (len(mine) + len(set(self.parts[i]))) - 1e-9)

    def similar(self, toks: list[str]) -> int | None:
        """Entry of the most similar phrase at or above the threshold; a tie between entries stays unmatched."""
        s = "".join(toks)
        if len(s) < 3 or not self.names:
            return None
        diff = self.bags - _bag(s)
        bound = np.maximum(np.maximum(diff, 0).sum(1), np.maximum(-diff, 0).sum(1))
        size = np.maximum(self.bags.sum(1), len(s))
        limit = np.maximum(1, ((1 - THRESHOLD) * size).astype(int))
        scores: dict[int, float] = {}
        for i in np.flatnonzero(bound <= limit):
            name = self.names[i]
            m = max(len(name), len(s))
            lim = int(limit[i])
            d = osa(s, name, lim)
            score = 0.0
            if d <= lim:
                # one edit in a word of three or four letters is already much
                score = 1 - d / m
                if self.owner[i] in self.strict and d > 2:
                    score = 0.0
                elif len(toks) > 1 and len(self.parts[i]) > 1:
                    score = max(score, self.token_set(toks, i))
            if score >= THRESHOLD:
                o = self.owner[i]
                scores[o] = max(scores.get(o, 0.0), score)
        if len(toks) > 1:
            for i in self.like(toks, 0.8):
                if self.owner[i] not in self.strict and (sc := self.token_set(toks, i)) >= 0.8:
                    o = self.owner[i]
                    scores[o] = max(scores.get(o, 0.0), sc)
        if not scores:
            return None
        ranked = sorted(scores.items(), key=lambda x: (-x[1], x[0]))
        if len(ranked) > 1 and ranked[0][1] - ranked[1][1] < 1e-9:
            return None
        return ranked[0][0]

    def shortened(self, value: str, toks: list[str]) -> int | None:
        """Entry whose name alone a single token shortens, such as ``conf.``; such a token counts as equal to the name."""
        if len(toks) != 1 or len(toks[0]) < (3 if value.rstrip().endswith(".") else 4):
            return None
        lo = bisect.bisect_left(self.whole, (toks[0],))
        hit = [i for name, i in self.whole[lo : lo + 2] if name.startswith(toks[0])]
        return hit[0] if len(hit) == 1 else None

    def resolve(self, value: str) -> str:
        got = self.memo.get(value)
        if got is None:
            toks = tokens(value)
            o = self.exact.get("".join(toks))
            if o is None:
                o = self.mention(toks)
            if o is None:
                o = self.shortened(value, toks)
            if o is None:
                o = self.similar(toks)
            if o is None:
                o = self.stemmed.get(stems(toks))
                o = None if o == -1 else o
            got = UNMATCHED if o is None else self.entries[o]
            if len(self.memo) > 100_000:
                self.memo.clear()
            self.memo[value] = got
        return got


def build_matchers(rows: list[tuple[str, str, list[str] | None]], lexicon=LEXICON) -> dict[str, Matcher]:
    """Matchers by list name from (list_name, entry, also_called) rows."""
    lists: dict[str, dict[str, list[str]]] = {}
    for name, entry, also in rows:
        if name is None or entry is None:
            continue
        phrases = lists.setdefault(name, {}).setdefault(entry, [])
        phrases += [entry, *(a for a in (also if also is not None else []) if a), *lexicon.get(name, {}).get(entry, ())]
    out = {}
    for name, by in lists.items():
        entries = list(by)
        parts, owner = [], []
        for i, e in enumerate(entries):
            for t in dict.fromkeys(tuple(tokens(p)) for p in by[e]):
                if t:
                    parts.append(list(t))
                    owner.append(i)
        strict = frozenset(i for i, e in enumerate(entries) if e.lower() == "other")
        out[name] = Matcher(entries, ["".join(p) for p in parts], parts, owner, strict)
    return out


def assign(values: DataFrame, canonical: DataFrame, keys: list[str], list_name: str = "list_name", value: str = "value", lexicon=LEXICON) -> DataFrame:
    """(keys, entry) for every row whose value is neither null nor blank nor an entry of its list character by character.

    ``entry`` is the entry meant or ``UNMATCHED``; a value of an unknown or empty
    list is unmatched, and so is a tie between two entries. Repeated rows come out
    each. The reference list is read to the driver after its size is checked
    against MAX_ENTRIES; values are never shuffled: a worker resolves each distinct
    value once and keeps it in a bounded memo.
    """
    head = canonical.select("list_name", "entry", "also_called").limit(MAX_ENTRIES + 1).collect()
    if len(head) > MAX_ENTRIES:
        raise ValueError(f"reference lists of more than {MAX_ENTRIES} entries in all must be assigned list by list")
    rows = [(r[0], r[1], r[2]) for r in head]
    known = {}
    for n, e, _ in rows:
        if n is not None and e is not None:
            known.setdefault(n, set()).add(e)
    # an entry written exactly is no case: decided in the scan, before Python
    is_entry = F.lit(False)
    for n, es in known.items():
        is_entry = is_entry | ((F.col(list_name) == n) & F.col(value).isin(*es))
    todo = values.where(~blank(F.col(value)) & ~F.coalesce(is_entry, F.lit(False)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matchers = build_matchers(rows, lexicon)
        for pdf in batches:
            out = pdf[keys].copy()
            out["entry"] = [m.resolve(v) if (m := matchers.get(n)) else UNMATCHED for n, v in zip(pdf[list_name], pdf[value])]
            yield out

    types = dict(values.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", entry string"
    return todo.select(*dict.fromkeys([*keys, list_name, value])).mapInPandas(run, schema)
