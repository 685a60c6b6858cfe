"""Problem 3: the article of a web page without its furniture.

Method: site style tree. The pages of a host are merged into one tree. Its
presentation nodes are the zone of the page (above the headline or below), the
branches below it (runs of lines between sentences and list sentences, which are
boxes where a site draws them), and the style of a line (path, tags, list item, row,
title-like, sentence); its leaves are the content nodes, the parts of a line.

A content node that n of the host's m pages hold has the entropy log_m n over them
and the importance 1 - log_m n; beyond WIDE pages the share of the pages alone
counts, so a large site is judged alike at any size. A branch holds what its site
repeats in its least important line, the head or foot of a box, and a title-like
line, which names a page, is as important as its branch at most. A style that presents
links (path, tags, row, title) has the importance of its content: the share of its
content nodes that no other page holds, by which that of its lines is multiplied. A label before a
colon, the parts of a path and each tag are nodes of their own; the page's own
headline in a path says nothing new. Lines of low importance are removed.

A short line between two removed lines, or above headlines of other pages or
tags, heads or belongs to a box and needs a higher importance to stay.

Pages of a host with equal text, whatever their addresses, count once in n and m.

Hosts with few pages are merged into one tree, and the importance of a node is
averaged over the hosts that hold it, so a page of a small site is judged by
what the node is elsewhere.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.runtime import cut_lineage, spread

#: hosts with fewer pages are merged into one tree
MIN_PAGES = 8
#: a word is kept in a node's name when at least this share of the chunks, and MIN_CHUNKS, hold it; else it is a slot
FREQUENT, MIN_CHUNKS = 0.0005, 5
#: least mean importance of a short line, and of sentences and list items
SHORT, LONG = 0.42, 0.28
#: the same for sentences beside furniture, and for lines that name the site
BESIDE, NAMED = 0.36, 0.6
#: least mean importance of a short line that stands among furniture
BOXED = 0.75
#: a title-like line of so many words that is not the page's own headline names another page
TITLE_WORDS = 5

#: pages from which on the importance of a node depends on its share of the pages alone
WIDE = 2400
#: styles by which pages present links and lists of words; their lines weigh by the style's importance too
PRESENTED = ("path", "tags", "row", "title")
#: most words of a label before a colon
LABEL_WORDS = 3

_WORD = re.compile(r"[^\W_]+")
_MARK = re.compile(r"([-*•◦▪‣+]|\d{1,3}[.)])\s+")
_SENTENCE = re.compile(r"(?<=[.!?…。！？])[\"'’”»)]*\s+")
_PARTS = re.compile(r"\s+[|·•›»>/–—-]\s+|\s{2,}|\t+")
_END = re.compile(r"[.!?…:;。！？][\"'’”»)\]]*$")
_PATH = re.compile(r"\s(?:[|·•›»>/→]|-|–)\s")


def host_of(source: str | None) -> tuple[str, str]:
    """(host, name of the site within the host) of a page's address; ('', '') when it has none."""
    m = re.match(r"^[a-z][a-z0-9+.-]*://([^/?#]+)", source or "", re.I)
    if not m:
        return "", ""
    host = m.group(1).lower().rsplit("@", 1)[-1].split(":")[0]
    labels = host.split(".")
    return host, re.split(r"[-_]", labels[-2] if len(labels) > 1 else labels[0])[0]


def node_name(part: str, site: str, frequent: frozenset[str]) -> str:
    """Name of a content node: words as they are, numbers, the site's name and rare words as slots.

    A part of as many rare words as others says too little by its slots and keeps its words.
    """
    rare = known = 0

    def slot(m: re.Match) -> str:
        nonlocal rare, known
        w = m.group().lower()
        if w.isdigit():
            return "#"
        if w == site or w in frequent:
            known += 1
            return "<s>" if w == site else w
        rare += 1
        return "<x>"

    out = _WORD.sub(slot, part.strip())
    return out if rare < known or not rare else part.strip().lower()


def style(line: str, title: str | None) -> str:
    """Presentation node of a line."""
    s = line.strip()
    t = (title or "").strip()
    if t and s == t:
        return "headline"
    if t and t in s and _PATH.search(s):
        return "path"
    words = s.split()
    if all(w.startswith("#") and len(w) > 1 for w in words):
        return "tags"
    if m := _MARK.match(s):
        # a link in a list is a short line whatever its mark
        return "item" if _END.search(s) or len(s[m.end() :].split()) >= TITLE_WORDS else "link"
    if _END.search(s):
        return "sentence"
    if len(_PARTS.split(s)) > 1:
        return "row"
    return "title" if len(words) >= TITLE_WORDS else "short"


def parts_of(line: str, kind: str, title: str | None = None) -> list[str]:
    """Content nodes of a line: sentences, members of a row, path or tag list, a title's label, or the line itself."""
    s = _MARK.sub("", line.strip(), count=1) if kind in ("item", "link") else line.strip()
    if kind == "tags":
        return s.split()
    if kind == "title":
        label, colon, rest = s.partition(": ")
        return [label + ":"] if colon and rest.strip() and len(label.split()) <= LABEL_WORDS else [s]
    out = []
    for seg in _PARTS.split(s) if kind in ("row", "path", "short", "sentence") else [s]:
        out += [p for p in _SENTENCE.split(seg) if p.strip()]
    if kind == "path":
        own = (title or "").strip()
        out = [p for p in out if p.strip() not in own and own not in p] or out
    return out or [s]


def _lines(web: DataFrame, frequent: frozenset[str]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # what a site repeats is named once
        memo: dict[tuple[str, str], str] = {}

        def name(part: str, site: str) -> str:
            got = memo.get((part, site))
            if got is None:
                if len(memo) > 100_000:
                    memo.clear()
                got = memo[part, site] = node_name(part, site, frequent)
            return got

        for pdf in batches:
            rows = []
            for cid, ix, src, title, text in zip(pdf["chunk_id"], pdf["chunk_ix"], pdf["source"], pdf["title"], pdf["text"]):
                host, site = host_of(src)
                lines = text.split("\n")
                at = next((i for i, ln in enumerate(lines, 1) if title and ln.strip() == title.strip()), 0)
                for i, ln in enumerate(lines, 1):
                    if not ln.strip():
                        continue
                    kind = style(ln, title)
                    names = [name(p, site) for p in parts_of(ln, kind, title)]
                    rows.append((cid, i, ix, host, src or f"chunk {cid}", kind, at, names))
            yield pd.DataFrame(rows, columns=["chunk_id", "line_no", "chunk_ix", "host", "page", "kind", "headline_at", "nodes"])

    return spread(web).mapInPandas(
        run, "chunk_id bigint, line_no int, chunk_ix int, host string, page string, kind string, headline_at int, nodes array<string>"
    )


def distinct_pages(web: DataFrame) -> DataFrame:
    """(page): one address, the least, of every text that pages of a host hold, so that copies weigh once.

    A page's text is folded as the set of its chunks' texts and places; titles may differ.
    """
    no_address = F.coalesce(F.col("source"), F.lit("")) == ""
    page = F.when(no_address, F.concat(F.lit("chunk "), F.col("chunk_id").cast("string"))).otherwise(F.col("source"))
    host = F.when(no_address, "").otherwise(F.lower(F.regexp_extract("source", "(?i)^[a-z][a-z0-9+.-]*://([^/?#]+)", 1)))
    host = F.substring_index(F.substring_index(host, "@", -1), ":", 1)
    place = F.coalesce(F.col("chunk_ix"), F.lit(0))
    rows = web.select(host.alias("host"), page.alias("page"), F.xxhash64("text", place).alias("h"), F.xxhash64(place, "text").alias("g")).distinct()
    folded = rows.groupBy("host", "page").agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(20,0)")).alias("h"), F.sum(F.col("g").cast("decimal(20,0)")).alias("g"))
    return folded.groupBy("host", "n", "h", "g").agg(F.min("page").alias("page")).select("page")


def importance(lines: DataFrame) -> DataFrame:
    """(node, importance) of content nodes held by two or more pages of some tree.

    Aggregated in steps (node, host, page) -> (node, host) -> node, so a node or
    host that holds a third of all rows is combined before it is shuffled.
    """
    pages = lines.groupBy("host", "page").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("m"))
    tree = pages.withColumn("tree", F.when(F.col("m") >= MIN_PAGES, F.col("host")).otherwise("(small)"))
    size = tree.groupBy("tree").agg(F.sum("m").alias("m"))
    held = lines.select("host", "page", F.explode("nodes").alias("node")).distinct().groupBy("node", "host").agg(F.count("*").alias("n"))
    per_tree = (
        held.join(tree.select("host", "tree"), "host").groupBy("node", "tree").agg(F.sum("n").alias("n")).join(size, "tree").where("m >= 4")
    )
    imp = F.least(F.lit(1.0), F.log(F.col("m") / F.col("n")) / F.log(F.least("m", F.lit(WIDE))))
    return (
        per_tree.groupBy("node")
        .agg((F.sum(F.col("m") * imp) / F.sum("m")).alias("importance"), F.max("n").alias("most"))
        .where("most >= 2")
        .select("node", "importance")
    )


def judge(chunks: DataFrame) -> DataFrame:
    """Each non-blank line of chunks of type web: chunk_id, line_no, kind, importance, furniture.

    Lines are numbered from 1, blank ones included. Null and blank texts have no
    line. A page without an address is a page of its own; a page without a title
    has no headline, and nothing of it is dropped for standing above one. Repeated
    rows are judged each. Extra columns are ignored.
    """
    web = chunks.where((F.col("metadata.type") == "web") & F.col("text").isNotNull()).select(
        "chunk_id", "chunk_ix", F.col("metadata.source").alias("source"), F.col("metadata.title").alias("title"), "text"
    )
    n = web.count()
    words = web.select(F.explode(F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), F.lower))).alias("w"))
    # at most (mean distinct words of a chunk) / FREQUENT words
    frequent = frozenset(r[0] for r in words.groupBy("w").count().where(F.col("count") >= max(MIN_CHUNKS, FREQUENT * n)).select("w").collect())
    # the pages are read once
    lines = cut_lineage(_lines(web, frequent))
    nodes = importance(lines.join(distinct_pages(web), "page", "left_semi"))
    top = lines.where("headline_at > 0").groupBy("page").agg(F.min("chunk_ix").alias("headline_ix"))
    scored = (
        lines.select("chunk_id", "line_no", "chunk_ix", "page", "kind", "headline_at", F.exists("nodes", lambda x: x.contains("<s>")).alias("named"), F.explode("nodes").alias("node"))
        .join(nodes, "node", "left")
        .groupBy("chunk_id", "line_no", "chunk_ix", "page", "kind", "headline_at", "named")
        .agg(F.avg(F.coalesce("importance", F.lit(1.0))).alias("importance"), F.count("*").alias("n"), F.count_if(F.col("importance").isNull()).alias("alone"))
        .join(top, "page", "left")
    )
    scored = cut_lineage(scored)
    # a style is as important as the share of its content nodes that one page alone holds; one row a style
    styles = {r[0]: r[1] for r in scored.groupBy("kind").agg(F.sum("alone") / F.sum("n")).collect()}
    weight = F.lit(1.0)
    for k in PRESENTED:
        weight = F.when(F.col("kind") == k, F.lit(float(styles.get(k, 1.0)))).otherwise(weight)
    # neighbours within the chunk, which is bounded
    w = Window.partitionBy("chunk_id").orderBy("line_no")
    core = F.col("kind").isin("sentence", "item", "headline")
    scored = scored.withColumn("branch", F.sum(core.cast("int")).over(w))
    in_branch = Window.partitionBy("chunk_id", "branch")
    # a title-like line by itself is no list of links
    alone = (F.col("kind") == "title") & (F.count_if(~core).over(in_branch) == 1)
    scored = scored.withColumn("importance", F.col("importance") * F.when(alone, 1.0).otherwise(weight))
    above = F.coalesce(
        (F.col("chunk_ix") < F.col("headline_ix"))
        | ((F.col("chunk_ix") == F.col("headline_ix")) & (F.col("line_no") < F.col("headline_at"))),
        F.lit(False),
    )
    least = F.when(F.col("named"), NAMED).when(F.col("kind").isin("sentence", "item"), LONG).otherwise(SHORT)
    low = F.col("importance") < least
    placed = scored.select("chunk_id", "line_no", "kind", "importance", above.alias("above"), low.alias("low"), "branch")
    box = F.max(F.col("low") & ~core).over(in_branch)
    furniture = F.when(F.col("kind") == "headline", False).otherwise(F.col("above") | F.col("low") | ((F.col("kind") == "title") & box))
    first = placed.select("chunk_id", "line_no", "kind", "importance", furniture.alias("furniture"))
    before, after, next_kind = F.lag("furniture").over(w), F.lead("furniture").over(w), F.lead("kind").over(w)
    among = (F.coalesce(before, after) & F.coalesce(after, before)) | next_kind.isin("title", "tags")
    boxed = F.col("kind").isin("short", "link") & (F.col("importance") < BOXED) & F.coalesce(F.col("among"), F.lit(False))
    beside = F.col("kind").isin("sentence", "item") & (F.col("importance") < BESIDE) & F.coalesce(before | after, before, after, F.lit(False))
    return first.withColumns({"among": among, "beside": beside}).select(
        "chunk_id", "line_no", "kind", "importance", (F.col("furniture") | boxed | F.col("beside")).alias("furniture")
    )


def articles(chunks: DataFrame) -> DataFrame:
    """(chunk_id, article): the text of each web chunk without furniture lines; blank lines between kept lines become one."""
    kept = judge(chunks).where("NOT furniture").select("chunk_id", "line_no")
    web = chunks.where((F.col("metadata.type") == "web") & F.col("text").isNotNull()).select("chunk_id", "text")
    nos = kept.groupBy("chunk_id").agg(F.array_sort(F.collect_set("line_no")).alias("nos"))
    line = F.split("text", "\n", -1)
    return web.join(nos, "chunk_id", "left").select(
        "chunk_id", F.coalesce(F.array_join(F.transform("nos", lambda i: F.trim(F.element_at(line, i))), "\n"), F.lit("")).alias("article")
    )
