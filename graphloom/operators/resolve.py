"""Entity resolution: grouping and ordered merge, name matching, relationship resolution, deduplication."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import KEYWORD_BONUS, MATCH_THRESHOLD, name_similarity, normalize_name, stable_id, strip, words, year_in
from graphloom.runtime import cut_lineage, lookup



def entity_key(kind: Column, name: Column, title: Column, year: Column) -> Column:
    """Resolution key: lower-cased title with the year for events, title or name for publications, name otherwise."""
    t = F.lower(F.coalesce(title, name))
    event = F.when(F.coalesce(year, F.lit(0)) != 0, F.concat(t, F.lit("_"), year.cast("string"))).otherwise(t)
    return F.when(kind == "event", event).when(kind == "publication", t).otherwise(F.lower(F.coalesce(name, F.lit(""))))


def _first_filled(c: str, order: Column, compat: bool, dtype: str) -> Column:
    x = F.col(c)
    if dtype.startswith("array"):
        filled = F.size(x) > 0
    elif dtype == "string":
        filled = x != ""
    elif compat:
        filled = (x != 0) if dtype != "boolean" else x
    else:
        filled = x.isNotNull()
    return F.min_by(F.when(filled, x), F.when(filled, order)).alias(c)


def resolve_entities(entities: DataFrame, keys: list[str], order: str, joined: dict[str, str] | None = None, largest: tuple[str, ...] = (), unions: tuple[str, ...] = (), compat: bool = False) -> DataFrame:
    """One row per key, merged in the order of ``order`` (which must be unique within a key).

    ``joined`` columns are the distinct non-empty texts joined by the given
    separator in order of appearance; ``largest`` columns the greatest value;
    ``unions`` the distinct elements of all lists in order of appearance; every
    other column the first value that is filled. Zero counts as filled unless
    ``compat``. Rows with an empty or null key are dropped.
    """
    joined = joined or {}
    rows = entities
    for k in keys:
        rows = rows.where(F.col(k).isNotNull() & (F.col(k).cast("string") != ""))
    o = F.col(order)
    aggs = [F.count("*").alias("n_merged"), F.min(o).alias("first_" + order)]
    for c, t in rows.dtypes:
        if c in keys or c == order:
            continue
        if c in joined:
            seq = F.transform(F.array_sort(F.collect_list(F.when(F.col(c) != "", F.struct(o.alias("o"), F.col(c).alias("v"))))), lambda x: x["v"])
            aggs.append(_fold_join(seq, joined[c]).alias(c))
        elif c in largest:
            aggs.append(F.max(c).alias(c))
        elif c in unions:
            seq = F.array_sort(F.collect_list(F.when(F.size(c) > 0, F.struct(o.alias("o"), F.col(c).alias("v")))))
            aggs.append(F.array_distinct(F.flatten(F.transform(seq, lambda x: x["v"]))).alias(c))
        else:
            aggs.append(_first_filled(c, o, compat, t))
    return rows.groupBy(*keys).agg(*aggs)


def _fold_join(seq: Column, sep: str) -> Column:
    """Texts appended one after another, each only when it differs from what has been joined so far.

    The parts are joined once at the end; what has been joined is only compared with
    a text of the same length.
    """
    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(-len(sep)).alias("size"))

    def step(acc: Column, v: Column) -> Column:
        n = F.char_length(v)
        same = (acc["size"] == n) & (F.array_join(acc["parts"], sep) == v)
        return F.when(same, acc).otherwise(F.struct(F.array_append(acc["parts"], v).alias("parts"), (acc["size"] + len(sep) + n).alias("size")))

    return F.aggregate(seq, start, step, lambda acc: F.when(F.size(acc["parts"]) > 0, F.array_join(acc["parts"], sep)))


def dedup_edges(edges: DataFrame, order: str, keys: tuple[str, ...] = ("source_id", "target_id", "relationship_type")) -> DataFrame:
    """The first edge of every (source, target, type); missing parts count as ''. Combined map-side, no window over a hot key."""
    rest = [c for c in edges.columns if c not in keys]
    filled = edges.withColumns({k: F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys})
    return filled.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("r")).select(*keys, "r.*")


def name_keys(entities: DataFrame, kind: str, ident: str, name: str, order: str) -> DataFrame:
    """(kind, name_key, id): lower-cased and normalised names; the latest entity holds a key."""
    keys = F.array_distinct(F.array(F.lower(F.col(name)), normalize_name(name)))
    return (
        entities.where(F.col(name).isNotNull())
        .select(F.col(kind).alias("kind"), F.explode(keys).alias("name_key"), F.col(ident).alias("id"), F.col(order).alias("ord"))
        .where("name_key <> ''")
        .groupBy("kind", "name_key")
        .agg(F.max_by("id", "ord").alias("id"))
    )


def exact_lookup(mentions: DataFrame, keys: DataFrame, kind: str = "kind", name: str = "mention") -> DataFrame:
    """Mentions with the id found under their lower-cased or else their normalised name, null when neither is known."""
    k = cut_lineage(keys)
    low = k.select(F.col("kind").alias(kind), F.col("name_key").alias("_low"), F.col("id").alias("_id_low"))
    norm = k.select(F.col("kind").alias(kind), F.col("name_key").alias("_norm"), F.col("id").alias("_id_norm"))
    m = mentions.withColumn("_low", F.lower(F.col(name))).withColumn("_norm", normalize_name(name))
    out = lookup(lookup(m, low, [kind, "_low"]), norm, [kind, "_norm"])
    return out.select(*mentions.columns, F.coalesce("_id_low", "_id_norm").alias("entity_id"))


def fuzzy_best_match(mentions: DataFrame, entities: DataFrame, kind: str = "kind", name: str = "mention", threshold: float = MATCH_THRESHOLD, by_word: bool = False) -> DataFrame:
    """(kind, name, entity_id, score): the most similar entity of each distinct mention above the threshold.

    ``entities`` are (kind, entity_name, id, ord); ties go to the smaller ord. No
    nested loop: a pair can only pass when

    * one name contains the other, so the longer holds every trigram of the
      shorter: each name probes with its single rarest trigram against the trigrams
      of all names (names of one or two letters with themselves), or
    * enough words are shared, so one of the rarest words of each is shared (prefix
      filter at the threshold less the keyword bonus).

    Names of both sides stand in one table, whose keys are spread and counted once.
    """
    m = mentions.select(F.col(kind).alias("kind"), F.col(name).alias("m")).distinct().withColumn("n", normalize_name("m")).where("n <> ''")
    e = entities.select("kind", "entity_name", "id", "ord").withColumn("n", normalize_name("entity_name")).where("n <> ''")
    first = e.groupBy("kind", "n").agg(F.min(F.struct("ord", "id")).alias("first"))
    m, first = cut_lineage(m), cut_lineage(first)
    # one table of distinct normalised names with the sides they occur on
    sides = m.select("kind", "n", F.lit(True).alias("m"), F.lit(False).alias("e")).unionByName(first.select("kind", "n", F.lit(False).alias("m"), F.lit(True).alias("e")))
    names = cut_lineage(sides.groupBy("kind", "n").agg(F.max("m").alias("m"), F.max("e").alias("e")))

    def grams(k: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.char_length("n") - (k - 1)), lambda i: F.substring(F.col("n"), i, F.lit(k)))

    def keyed(keys: Column, df: DataFrame = names) -> DataFrame:
        """(kind, g, n, m, e, f): names by key with the number of names that hold the key."""
        rows = df.select("kind", "n", "m", "e", F.explode(F.array_distinct(keys)).alias("g"))
        return rows.join(rows.groupBy("kind", "g").agg(F.count("*").alias("f")), ["kind", "g"])

    def meet(x: DataFrame, y: DataFrame, inside: bool) -> DataFrame:
        """(kind, mn, en) of mentions and entities that share a key; only where x is part of y, or with enough words ``ws`` in common."""
        ws = [] if inside else ["ws"]
        a = x.select("kind", "g", F.col("n").alias("xn"), F.col("m").alias("xm"), F.col("e").alias("xe"), *(F.col(c).alias("xw") for c in ws))
        b = y.select("kind", "g", F.col("n").alias("yn"), F.col("m").alias("ym"), F.col("e").alias("ye"), *(F.col(c).alias("yw") for c in ws))
        got = a.join(b, ["kind", "g"]).where((F.col("xm") & F.col("ye")) | (F.col("xe") & F.col("ym")))
        if inside:
            got = got.where(F.col("yn").contains(F.col("xn")))
        else:
            # judged on the words at hand before a pair is kept
            both = F.size(F.array_intersect("xw", "yw"))
            got = got.where(both > F.lit(max(threshold - KEYWORD_BONUS, 0.0)) * (F.size("xw") + F.size("yw") - both) - 1e-9)
        pair = lambda p, q: F.struct(F.col(p).alias("mn"), F.col(q).alias("en"))
        both = F.array(F.when(F.col("xm") & F.col("ye"), pair("xn", "yn")), F.when(F.col("xe") & F.col("ym"), pair("yn", "xn")))
        return got.select("kind", F.explode(F.array_compact(both)).alias("p")).select("kind", "p.mn", "p.en")

    tri = keyed(grams(3), names.where(F.char_length("n") > 2))
    rare = tri.groupBy("kind", "n", "m", "e").agg(F.min(F.struct("f", "g")).alias("x")).select("kind", "n", "m", "e", "x.g")
    found = meet(rare, tri, True)
    # names of one or two letters: only the grams that are such names are kept
    short = cut_lineage(names.where(F.char_length("n") < 3).withColumn("g", F.col("n")))
    if not short.isEmpty():
        one = F.when(F.char_length("n") > 1, F.concat(grams(1), grams(2))).otherwise(F.array("n"))
        held = names.select("kind", "n", "m", "e", F.explode(F.array_distinct(one)).alias("g")).join(short.select("kind", "g").distinct(), ["kind", "g"], "left_semi")
        found = found.unionByName(meet(short, held, True))
    least = max(threshold - KEYWORD_BONUS, 0.0)
    # more than ``least`` of the larger set must be shared
    need = F.floor(F.lit(least) * F.size("gs") + 1e-9) + 1
    prefix = F.greatest(F.size("gs") - need + 1, F.lit(1)).cast("int")
    ranked = keyed(words("n")).groupBy("kind", "n", "m", "e").agg(F.array_sort(F.collect_list(F.struct("f", "g"))).alias("gs"))
    ws = F.transform("gs", lambda x: x["g"]).alias("ws")
    lead = cut_lineage(ranked.select("kind", "n", "m", "e", ws, F.explode(F.slice("gs", F.lit(1), prefix)).alias("x")).select("kind", "n", "m", "e", "ws", "x.g"))
    pairs = found.unionByName(meet(lead, lead, False)).distinct()
    scored = pairs.withColumn("score", name_similarity("mn", "en", by_word)).where(F.col("score") > threshold)
    best = scored.join(first.withColumnRenamed("n", "en"), ["kind", "en"]).groupBy("kind", "mn").agg(F.min(F.struct((-F.col("score")).alias("neg"), "first.ord", "first.id")).alias("b"))
    return m.withColumnRenamed("n", "mn").join(best, ["kind", "mn"]).select("kind", F.col("m").alias(name), F.col("b.id").alias("entity_id"), (-F.col("b.neg")).alias("score"))


def missing_entities(rest: DataFrame) -> DataFrame:
    """Entities made from endpoints that match nothing: one per (kind, lower-cased name), with defaults by kind.

    ``rest`` has (kind, name, role, other_name, description, ord).
    """
    first = rest.where(strip("name") != "").withColumn("name_key", F.lower("name")).groupBy("kind", "name_key").agg(
        F.min_by(F.struct("name", "role", "other_name", "description"), "ord").alias("r")
    )
    k = F.col("kind")
    about = F.concat(F.lit("Auto-created "), k, F.lit(" from relationship: "), F.coalesce("r.description", F.lit("")))
    return first.select(
        stable_id("kind", "name_key").alias("id"),
        "kind",
        "name_key",
        F.col("r.name").alias("name"),
        F.lit(True).alias("auto_created_from_relationship"),
        F.when(k != "concept", F.lit("Other")).alias("type"),
        F.when(k == "actor", F.lit("Extracted from relationship")).alias("role"),
        F.when(k.isin("event", "concept"), F.lit(3)).alias("significance"),
        F.when(k.isin("event", "publication"), year_in(F.col("r.name"))).alias("year"),
        F.when(k == "concept", F.concat(F.lit("Concept related to "), F.coalesce("r.other_name", F.lit("")))).alias("definition"),
        F.when(k != "concept", about).alias("description"),
    )


def required_endpoints(rels: DataFrame) -> DataFrame:
    """Relationships with all four endpoint fields filled; endpoint types in lower case."""
    ok = None
    for c in ("source", "source_type", "target", "target_type"):
        x = F.coalesce(F.col(c), F.lit("")) != ""
        ok = x if ok is None else ok & x
    return rels.where(ok).withColumns({"source_type": F.lower("source_type"), "target_type": F.lower("target_type")})


def resolve_relationships(rels: DataFrame, entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(resolved edges, created entities) in the scalable mode: exact lookup, then best match, then creation.

    ``rels``: ord, source, source_type, target, target_type, relationship_type,
    description; ``entities``: kind, entity_name, id, ord. An endpoint that matches
    nothing gets one new entity per (kind, lower-cased name).
    """
    rels = required_endpoints(rels)
    ends = rels.select(F.col("source_type").alias("kind"), F.col("source").alias("mention")).unionByName(
        rels.select(F.col("target_type").alias("kind"), F.col("target").alias("mention"))
    ).distinct()
    exact = exact_lookup(ends, name_keys(entities, "kind", "id", "entity_name", "ord"))
    open_ends = exact.where("entity_id IS NULL").select("kind", "mention")
    fuzzy = fuzzy_best_match(open_ends, entities)
    known = exact.where("entity_id IS NOT NULL").unionByName(fuzzy.select("kind", "mention", "entity_id"))
    left = open_ends.join(fuzzy.select("kind", "mention"), ["kind", "mention"], "left_anti")
    side = lambda a, b, role: rels.select(
        F.col(f"{a}_type").alias("kind"), F.col(a).alias("name"), F.lit(role).alias("role"), F.col(b).alias("other_name"), "description", "ord"
    )
    made = missing_entities(
        side("source", "target", "source").unionByName(side("target", "source", "target")).join(left.withColumnRenamed("mention", "name"), ["kind", "name"])
    )
    fresh = left.withColumn("name_key", F.lower("mention")).join(made.select("kind", "name_key", F.col("id").alias("entity_id")), ["kind", "name_key"]).drop("name_key")
    ids = known.unionByName(fresh)
    s = ids.select(F.col("kind").alias("source_type"), F.col("mention").alias("source"), F.col("entity_id").alias("source_id"))
    t = ids.select(F.col("kind").alias("target_type"), F.col("mention").alias("target"), F.col("entity_id").alias("target_id"))
    edges = rels.join(s, ["source_type", "source"]).join(t, ["target_type", "target"])
    out = edges.select(
        stable_id("source_id", "target_id", "relationship_type", "ord").alias("id"), "ord", "source_id", "source_type", "target_id", "target_type", "relationship_type", "description"
    )
    return out, made


def resolve_exact_mode(rels: DataFrame, entities: DataFrame) -> DataFrame:
    """(ord, side, kind, entity_id, created): sequential resolution, where an entity made for one relationship can match the next.

    Endpoints of one kind never affect another kind, so each kind is one ordered
    fold in a grouped map. It reproduces that a relationship whose two open
    endpoints have the same name and kind makes two entities. For small inputs:
    use :func:`resolve_relationships` at scale.
    """
    rels = required_endpoints(rels)
    ends = rels.select(F.col("source_type").alias("kind"), "ord", F.lit(0).alias("side"), F.col("source").alias("mention")).unionByName(
        rels.select(F.col("target_type").alias("kind"), "ord", F.lit(1).alias("side"), F.col("target").alias("mention"))
    )
    known = entities.select("kind", F.col("ord"), F.lit(-1).alias("side"), F.col("entity_name").alias("mention"), "id")
    both = ends.withColumn("id", F.lit(None).cast("string")).unionByName(known.withColumn("id", F.col("id").cast("string")))
    both = both.withColumn("norm", normalize_name("mention")).withColumn("low", F.lower("mention"))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        base = pdf[pdf.side < 0].sort_values("ord")
        index: dict[str, str] = {}
        names: list[tuple[str, str]] = []
        for r in base.itertuples():
            if r.low:
                index[r.low] = r.id
                if r.norm:
                    index[r.norm] = r.id
                names.append((r.norm, r.id))
        out = []
        todo = pdf[pdf.side >= 0].sort_values(["ord", "side"])
        for o, g in todo.groupby("ord", sort=True):
            made = []
            for r in g.itertuples():
                hit = index.get(r.low) or index.get(r.norm)
                if hit is None:
                    hit = _best(r.norm, names)
                if hit is None:
                    hit = f"new:{r.kind}:{o}:{r.side}"
                    made.append((r.low, r.norm, hit))
                    out.append((o, r.side, r.kind, hit, True))
                else:
                    out.append((o, r.side, r.kind, hit, False))
            for low, norm, ident in made:
                index[low] = ident
                if norm:
                    index[norm] = ident
                names.append((norm, ident))
        return pd.DataFrame(out, columns=["ord", "side", "kind", "entity_id", "created"])

    return both.groupBy("kind").applyInPandas(fold, "ord bigint, side int, kind string, entity_id string, created boolean")


def _best(norm: str, names: list[tuple[str, str]]) -> str | None:
    """Id of the most similar name above the threshold, the first of equals."""
    from graphloom.functions.text import CONTAINMENT_SCORE, KEYWORD_BONUS, SIMILARITY_KEYWORDS

    best, ident = MATCH_THRESHOLD, None
    a = set(norm.split())
    for other, i in names:
        if not norm or not other:
            continue
        if norm == other:
            s = 1.0
        elif norm in other or other in norm:
            s = CONTAINMENT_SCORE
        else:
            b = set(other.split())
            both = a & b
            s = min(1.0, len(both) / len(a | b) + KEYWORD_BONUS * bool(both & set(SIMILARITY_KEYWORDS)))
        if s > best:
            best, ident = s, i
    return ident


def filter_by_confidence(rels: DataFrame, least: float = 0.5, column: str = "confidence") -> DataFrame:
    """Relationships of at least the given confidence; an unknown confidence is 1."""
    return rels.where(F.coalesce(F.col(column), F.lit(1.0)) >= least)


def enrich_edges(edges: DataFrame, entities: DataFrame) -> DataFrame:
    """Edges with name and description of both ends, null where an end is unknown. ``entities``: id (unique), name, description."""
    e = cut_lineage(entities.select("id", "name", "description"))
    s = e.select(F.col("id").alias("source_id"), F.col("name").alias("source_name"), F.col("description").alias("source_description"))
    t = e.select(F.col("id").alias("target_id"), F.col("name").alias("target_name"), F.col("description").alias("target_description"))
    return lookup(lookup(edges, s, ["source_id"]), t, ["target_id"])

