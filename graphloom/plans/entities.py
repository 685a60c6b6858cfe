"""Queries over entities and relationships: names, matching, resolution, merge, graph patterns and paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions import text as X
from graphloom.operators import graph as G
from graphloom.operators import resolve as R
from graphloom.runtime import read


def _concepts(spark, d):
    """Distinct concepts: the row with the smallest rec_id of each id."""
    c = read(spark, d, "concepts").where("id IS NOT NULL")
    one = c.groupBy("id").agg(F.min("rec_id").alias("ord"), F.min_by("name", "rec_id").alias("entity_name"))
    return one.where("entity_name IS NOT NULL").select(F.lit("concept").alias("kind"), "entity_name", "id", "ord")


def _mentions(spark, d):
    """Alternative names of concepts, and names written with an article and a remark, as mentions."""
    c = read(spark, d, "concepts")
    alt = c.select(F.explode("alternative_names").alias("mention"))
    wrapped = c.where("name IS NOT NULL").select(F.concat(F.lit("The "), F.upper("name"), F.lit(" (draft) theory")).alias("mention"))
    return alt.unionByName(wrapped).where("mention IS NOT NULL").distinct().select(F.lit("concept").alias("kind"), "mention")


def normalize_name(spark, d):
    return _mentions(spark, d).select("mention", X.normalize_name("mention").alias("normalized"))


def name_similarity(spark, d):
    c = read(spark, d, "concepts").select("rec_id", X.normalize_name("name").alias("a"), F.explode("alternative_names").alias("alt"))
    return c.select("rec_id", "alt", F.round(X.name_similarity("a", X.normalize_name("alt")), 9).alias("score")).where("alt IS NOT NULL")


def exact_lookup(spark, d):
    keys = R.name_keys(_concepts(spark, d), "kind", "id", "entity_name", "ord")
    return R.exact_lookup(_mentions(spark, d), keys).select("mention", "entity_id")


def fuzzy_best_match(spark, d):
    out = R.fuzzy_best_match(_mentions(spark, d), _concepts(spark, d))
    return out.select("mention", "entity_id", F.round("score", 9).alias("score"))


def resolve_entities(spark, d):
    rows = read(spark, d, "actors").select(
        F.lower("name").alias("name_key"), "rec_id", "name", "type", "description", "supporting_text", "role", "country", "expertise", "affiliations", F.col("source_chunk").alias("source_chunk")
    )
    out = R.resolve_entities(
        rows, ["name_key"], "rec_id", joined={"description": " ", "supporting_text": " | "}, unions=("expertise", "affiliations")
    )
    return out.select(
        "name_key", "n_merged", F.col("first_rec_id").alias("first_rec_id"), "name", "type", "role", "country", "source_chunk",
        F.md5(F.coalesce("description", F.lit("")).cast("binary")).alias("description"), F.md5(F.coalesce("supporting_text", F.lit("")).cast("binary")).alias("supporting_text"), F.array_join(F.array_sort("expertise"), "|").alias("expertise"),
    )


def resolve_events(spark, d):
    ev = read(spark, d, "event_records")
    key = R.entity_key(F.lit("event"), F.lit(None).cast("string"), F.col("title"), F.col("year"))
    rows = ev.select(key.alias("event_key"), "rec_id", "title", "year", "significance", "type")
    return R.resolve_entities(rows, ["event_key"], "rec_id", largest=("significance",)).select("event_key", "n_merged", "title", "year", "significance", "type")


def dedup_edges(spark, d):
    e = read(spark, d, "relationships").select("rel_id", F.col("source").alias("source_id"), F.col("target").alias("target_id"), "relationship_type")
    return R.dedup_edges(e, "rel_id")


def required_endpoints(spark, d):
    return R.required_endpoints(read(spark, d, "relationships")).select("rel_id", "source_type", "target_type")


def confidence_filter(spark, d):
    return R.filter_by_confidence(read(spark, d, "relationships"), 0.5).select("rel_id", "confidence")


def _rels(spark, d):
    """Name-based relationships: consecutive parts of a concept's alternative names around the concept's name."""
    c = read(spark, d, "concepts")
    return c.where(F.size("alternative_names") > 0).select(
        F.col("rec_id").alias("ord"), F.col("name").alias("source"), F.lit("Concept").alias("source_type"), F.element_at("alternative_names", F.lit(1)).alias("target"), F.lit("Concept").alias("target_type"),
        F.lit("Extends").alias("relationship_type"), F.col("definition").alias("description"),
    )


def _known(spark, d):
    """All concepts under their names; alternative names may match nothing."""
    c = read(spark, d, "concepts")
    return c.where("name IS NOT NULL").select(F.lit("concept").alias("kind"), F.col("name").alias("entity_name"), F.col("id"), F.col("rec_id").alias("ord"))


def resolve_relationships(spark, d):
    edges, _ = R.resolve_relationships(_rels(spark, d), _known(spark, d))
    return edges.select("ord", "source_id", "target_id")


def auto_entities(spark, d):
    _, made = R.resolve_relationships(_rels(spark, d), _known(spark, d))
    return made.select("id", "name_key", "auto_created_from_relationship", "significance", "definition")


def _vertices(spark, d):
    """One vertex per id over the five record tables."""
    spec = {"actors": ("Actor", "name", "description"), "event_records": ("Event", "title", "description"), "concepts": ("Concept", "name", "definition"), "publications": ("Publication", "title", "abstract"), "locations": ("Location", "name", "description")}
    out = None
    for t, (label, name, text) in spec.items():
        df = read(spark, d, t)
        year = F.min_by("year", "rec_id") if "year" in df.columns else F.lit(None).cast("int")
        part = df.where("id IS NOT NULL").groupBy("id").agg(F.lit(label).alias("label"), F.min_by(name, "rec_id").alias("name"), F.min_by(text, "rec_id").alias("description"), year.alias("year"))
        out = part if out is None else out.unionByName(part)
    return out


def _edges(spark, d):
    e = read(spark, d, "relationships")
    return e.select("rel_id", F.col("source").alias("source_id"), F.col("target").alias("target_id"), "relationship_type")


def enrich_edges(spark, d):
    out = R.enrich_edges(_edges(spark, d), _vertices(spark, d).select("id", "name", "description"))
    return out.select("rel_id", "source_name", F.md5(F.coalesce("source_description", F.lit("")).cast("binary")).alias("source_description"), "target_name", F.md5(F.coalesce("target_description", F.lit("")).cast("binary")).alias("target_description"))


def pattern_hop(spark, d):
    v = _vertices(spark, d)
    out = G.pattern_hop(v, _edges(spark, d), v, F.col("label") == "Actor", ("Participates", "Advocates"), F.col("label") == "Event")
    return out


def path_trails(spark, d):
    e = read(spark, d, "relationships").where("source IS NOT NULL AND target IS NOT NULL").select(F.col("rel_id").alias("edge_id"), F.col("source").alias("source_id"), F.col("target").alias("target_id"), "relationship_type")
    start = _vertices(spark, d).where(F.col("label") == "Event").select("id")
    out = G.trails(e, start, ("Precedes", "Follows", "Influences"), 3)
    return out.select("start", "end", "hops", "path")


def earliest_follow(spark, d):
    e = read(spark, d, "relationships").where("source IS NOT NULL AND target IS NOT NULL").select(F.col("rel_id").alias("edge_id"), F.col("source").alias("source_id"), F.col("target").alias("target_id"), "relationship_type")
    src = e.where("relationship_type IN ('Precedes', 'Influences')").select(F.col("source_id").alias("id")).distinct().withColumn("has", F.lit(True))
    v = _vertices(spark, d).join(src, "id", "left")
    return G.earliest_then_follow(v, e, (F.col("label") == "Event") & F.col("has") & F.col("year").isNotNull(), ("Precedes", "Influences"), ("References", "IsLocatedIn", "Influences"), 10, 3)


def theta_pairs(spark, d):
    """Nations of a region before one another by name, and regions with their nations under an inequality."""
    n = read(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    m = n.toDF("m_nationkey", "m_name", "m_regionkey")
    out = G.theta_pairs(n, m, (F.col("n_name") < F.col("m_name")), [F.col("n_regionkey") == F.col("m_regionkey")])
    return out.select("n_name", "m_name")


def theta_below(spark, d):
    """Nations and the regions of a higher key: a join by inequality alone, whose right side is small."""
    n = read(spark, d, "nation").select("n_name", "n_regionkey")
    return G.theta_pairs(n, read(spark, d, "region").select("r_regionkey", "r_name"), F.col("n_regionkey") < F.col("r_regionkey")).select("n_name", "r_name")


def title_years(spark, d):
    return read(spark, d, "publications").select("rec_id", X.year_in("title").alias("in_title"), X.year_in("abstract").alias("in_abstract"))


def extraction_stats(spark, d):
    return _vertices(spark, d).groupBy(F.lower("label").alias("kind")).agg(F.count("*").alias("n"))


def type_filter(spark, d):
    return _vertices(spark, d).where(F.col("label").isin("Actor", "Concept")).select("id", "label")


QUERIES = {
    f.__name__: f
    for f in (
        normalize_name, name_similarity, exact_lookup, fuzzy_best_match, resolve_entities, resolve_events, dedup_edges, required_endpoints, confidence_filter, resolve_relationships, auto_entities,
        enrich_edges, pattern_hop, path_trails, earliest_follow, theta_pairs, theta_below, title_years, extraction_stats, type_filter,
    )
}


def _norm(c: str) -> str:
    ws = r"[\t\n\x0b\x0c\r\x1c-\x20\x{85}\p{Z}]"
    strip = lambda x: f"regexp_replace({x}, '^{ws}+|{ws}+$', '', 'g')"
    s = strip(rf"regexp_replace(lower({c}), '\([^)]*\)', '', 'g')")
    s = f"regexp_replace({s}, '^(the|a|an){ws}+', '')"
    s = f"regexp_replace({s}, '{ws}+(movements?|laws?|concepts?|theory|theories|models?)$', '')"
    for short, full in X.ABBREVIATIONS:
        s = rf"regexp_replace({s}, '\b{short}\b', '{full}', 'g')"
    s = rf"regexp_replace({s}, '[^\p{{L}}\p{{N}}_\s\p{{Z}}]', '', 'g')"
    return strip(rf"regexp_replace({s}, '{ws}+', ' ', 'g')")


def _sim(a: str, b: str) -> str:
    w = lambda x: f"list_distinct(list_filter(string_split({x}, ' '), lambda v: v <> ''))"
    kw = ", ".join(f"'{k}'" for k in X.SIMILARITY_KEYWORDS)
    return (
        f"CASE WHEN coalesce({a}, '') = '' OR coalesce({b}, '') = '' THEN 0.0::double WHEN {a} = {b} THEN 1.0::double WHEN contains({a}, {b}) OR contains({b}, {a}) THEN 0.8::double"
        f" ELSE least(1.0::double, len(list_intersect({w(a)}, {w(b)})) / len(list_distinct(list_concat({w(a)}, {w(b)})))::double + CASE WHEN len(list_intersect(list_intersect({w(a)}, {w(b)}), [{kw}])) > 0 THEN 0.2::double ELSE 0.0::double END) END"
    )


_M = "SELECT DISTINCT mention FROM (SELECT unnest(alternative_names) AS mention FROM concepts UNION ALL SELECT 'The ' || upper(name) || ' (draft) theory' FROM concepts WHERE name IS NOT NULL) x WHERE mention IS NOT NULL"
_C = "SELECT id, min(rec_id) AS ord, arg_min(name, rec_id) AS nm FROM concepts WHERE id IS NOT NULL AND name IS NOT NULL GROUP BY id"
_KEYS = f"SELECT key, arg_max(id, ord) AS id FROM (SELECT lower(nm) AS key, id, ord FROM ({_C}) c UNION SELECT {_norm('nm')}, id, ord FROM ({_C}) c) k WHERE key <> '' GROUP BY key"
_V = (
    "SELECT id, 'Actor' AS label, arg_min(name, rec_id) AS name, arg_min(description, rec_id) AS description, NULL::int AS year FROM actors GROUP BY id"
    " UNION ALL SELECT id, 'Event', arg_min_null(title, rec_id), arg_min_null(description, rec_id), arg_min_null(year, rec_id) FROM event_records GROUP BY id"
    " UNION ALL SELECT id, 'Concept', arg_min_null(name, rec_id), arg_min_null(definition, rec_id), NULL FROM concepts GROUP BY id"
    " UNION ALL SELECT id, 'Publication', arg_min_null(title, rec_id), arg_min_null(abstract, rec_id), arg_min_null(year, rec_id) FROM publications GROUP BY id"
    " UNION ALL SELECT id, 'Location', arg_min_null(name, rec_id), arg_min_null(description, rec_id), NULL FROM locations GROUP BY id"
).replace("arg_min(name", "arg_min_null(name").replace("arg_min(description", "arg_min_null(description")
_RELS = "SELECT rec_id AS ord, name AS s, alternative_names[1] AS t, definition FROM concepts WHERE len(alternative_names) > 0 AND coalesce(name, '') <> '' AND coalesce(alternative_names[1], '') <> ''"
_KNOWN = "SELECT name AS nm, id, rec_id AS ord FROM concepts WHERE name IS NOT NULL"
_RESOLVED = rf"""
rels AS ({_RELS}), known AS ({_KNOWN}),
keys AS (SELECT key, arg_max(id, ord) AS id FROM (SELECT lower(nm) AS key, id, ord FROM known UNION SELECT {_norm("nm")}, id, ord FROM known) k WHERE key <> '' GROUP BY key),
ends AS (SELECT s AS m FROM rels UNION SELECT t FROM rels),
ex AS (SELECT m, coalesce(a.id, b.id) AS id FROM ends LEFT JOIN keys a ON a.key = lower(m) LEFT JOIN keys b ON b.key = {_norm("m")}),
mn AS (SELECT m, {_norm("m")} AS mm FROM ex WHERE id IS NULL),
en AS (SELECT {_norm("nm")} AS e, min(struct_pack(ord := ord, id := id)) AS f FROM known GROUP BY 1),
sc AS (SELECT m, f, {_sim("mm", "e")} AS score FROM mn, en WHERE mm <> '' AND e <> ''),
fz AS (SELECT m, f.id AS id FROM (SELECT *, row_number() OVER (PARTITION BY m ORDER BY score DESC, f.ord) AS r FROM sc WHERE score > 0.6) z WHERE r = 1),
nu AS (SELECT m, sha256('concept|' || lower(m)) AS id FROM ex WHERE id IS NULL AND m NOT IN (SELECT m FROM fz)),
ids AS (SELECT * FROM ex WHERE id IS NOT NULL UNION ALL SELECT * FROM fz UNION ALL SELECT * FROM nu)"""

SQL = {
    "normalize_name": f"SELECT mention, {_norm('mention')} AS normalized FROM ({_M}) m",
    "name_similarity": f"SELECT rec_id, alt, round({_sim('a', 'b')}, 9) AS score FROM (SELECT rec_id, alt, {_norm('name')} AS a, {_norm('alt')} AS b FROM (SELECT rec_id, name, unnest(alternative_names) AS alt FROM concepts) x) y WHERE alt IS NOT NULL",
    "exact_lookup": f"WITH k AS ({_KEYS}) SELECT mention, coalesce(a.id, b.id) AS entity_id FROM ({_M}) m LEFT JOIN k a ON a.key = lower(mention) LEFT JOIN k b ON b.key = {_norm('mention')}",
    "fuzzy_best_match": f"WITH m AS (SELECT mention, {_norm('mention')} AS mm FROM ({_M}) q), e AS (SELECT {_norm('nm')} AS e, min(struct_pack(ord := ord, id := id)) AS f FROM ({_C}) c GROUP BY 1),"
    f" s AS (SELECT mention, f, {_sim('mm', 'e')} AS score FROM m, e WHERE mm <> '' AND e <> '')"
    " SELECT mention, f.id AS entity_id, round(score, 9) AS score FROM (SELECT *, row_number() OVER (PARTITION BY mention ORDER BY score DESC, f.ord) AS r FROM s WHERE score > 0.6) z WHERE r = 1",
    "resolve_entities": """
WITH RECURSIVE a AS (SELECT *, lower(name) AS k FROM actors WHERE coalesce(name, '') <> ''),
dj AS (SELECT k, rec_id, description AS v, row_number() OVER (PARTITION BY k ORDER BY rec_id) AS i FROM a WHERE coalesce(description, '') <> ''),
df AS (SELECT k, i, v AS acc FROM dj WHERE i = 1 UNION ALL SELECT df.k, dj.i, CASE WHEN acc = v THEN acc ELSE acc || ' ' || v END FROM df JOIN dj ON dj.k = df.k AND dj.i = df.i + 1),
sj AS (SELECT k, rec_id, supporting_text AS v, row_number() OVER (PARTITION BY k ORDER BY rec_id) AS i FROM a WHERE coalesce(supporting_text, '') <> ''),
sf AS (SELECT k, i, v AS acc FROM sj WHERE i = 1 UNION ALL SELECT sf.k, sj.i, CASE WHEN acc = v THEN acc ELSE acc || ' | ' || v END FROM sf JOIN sj ON sj.k = sf.k AND sj.i = sf.i + 1),
ex AS (SELECT k, array_to_string(list_sort(list_distinct(list(x))), '|') AS expertise FROM (SELECT k, unnest(expertise) AS x FROM a) q GROUP BY k)
SELECT a.k AS name_key, count(*) AS n_merged, min(rec_id) AS first_rec_id, arg_min(nullif(name, ''), rec_id) AS name, arg_min(nullif(type, ''), rec_id) AS type, arg_min(nullif(role, ''), rec_id) AS role,
  arg_min(nullif(country, ''), rec_id) AS country, arg_min(source_chunk, rec_id) AS source_chunk, md5(coalesce((SELECT arg_max(acc, i) FROM df WHERE df.k = a.k), '')) AS description,
  md5(coalesce((SELECT arg_max(acc, i) FROM sf WHERE sf.k = a.k), '')) AS supporting_text, coalesce((SELECT expertise FROM ex WHERE ex.k = a.k), '') AS expertise FROM a GROUP BY a.k""",
    "resolve_events": """
SELECT event_key, count(*) AS n_merged, arg_min(nullif(title, ''), rec_id) AS title, arg_min(year, rec_id) AS year, max(significance) AS significance, arg_min(nullif(type, ''), rec_id) AS type
FROM (SELECT *, CASE WHEN coalesce(year, 0) <> 0 THEN lower(title) || '_' || year ELSE lower(title) END AS event_key FROM event_records) e WHERE coalesce(event_key, '') <> '' GROUP BY 1""",
    "dedup_edges": "SELECT source_id, target_id, relationship_type, min(rel_id) AS rel_id FROM (SELECT rel_id, coalesce(source, '') AS source_id, coalesce(target, '') AS target_id, coalesce(relationship_type, '') AS relationship_type FROM relationships) r GROUP BY 1, 2, 3",
    "required_endpoints": "SELECT rel_id, lower(source_type) AS source_type, lower(target_type) AS target_type FROM relationships WHERE coalesce(source, '') <> '' AND coalesce(target, '') <> '' AND coalesce(source_type, '') <> '' AND coalesce(target_type, '') <> ''",
    "confidence_filter": "SELECT rel_id, confidence FROM relationships WHERE coalesce(confidence, 1.0) >= 0.5",
    "resolve_relationships": f"WITH {_RESOLVED} SELECT ord, a.id AS source_id, b.id AS target_id FROM rels JOIN ids a ON a.m = s JOIN ids b ON b.m = t",
    "auto_entities": f"WITH {_RESOLVED}, x AS (SELECT ord, s AS m, t AS o FROM rels UNION ALL SELECT ord, t, s FROM rels),"
    " y AS (SELECT lower(m) AS name_key, o, row_number() OVER (PARTITION BY lower(m) ORDER BY ord) AS r FROM x WHERE m IN (SELECT m FROM nu))"
    " SELECT sha256('concept|' || name_key) AS id, name_key, true AS auto_created_from_relationship, 3 AS significance, 'Concept related to ' || o AS definition FROM y WHERE r = 1",
    "enrich_edges": f"WITH v AS ({_V}) SELECT rel_id, a.name AS source_name, md5(coalesce(a.description, '')) AS source_description, b.name AS target_name, md5(coalesce(b.description, '')) AS target_description FROM relationships r LEFT JOIN v a ON a.id = r.source LEFT JOIN v b ON b.id = r.target",
    "pattern_hop": f"WITH v AS ({_V}) SELECT a.id AS source_id, a.name AS source_name, relationship_type, b.id AS target_id, b.name AS target_name FROM relationships r JOIN v a ON a.id = r.source JOIN v b ON b.id = r.target"
    " WHERE a.label = 'Actor' AND b.label = 'Event' AND relationship_type IN ('Participates', 'Advocates')",
    "path_trails": f"""
WITH RECURSIVE v AS ({_V}), e AS (SELECT rel_id, source, target FROM relationships WHERE source IS NOT NULL AND target IS NOT NULL AND relationship_type IN ('Precedes', 'Follows', 'Influences')),
w AS (SELECT id AS start, id AS at_node, [-1::bigint] AS used, id AS path, 0 AS hops FROM v WHERE label = 'Event'
  UNION ALL SELECT start, target, list_append(used, rel_id), path || '>' || target, hops + 1 FROM w JOIN e ON e.source = at_node WHERE hops < 3 AND NOT list_contains(used, rel_id))
SELECT start, at_node AS "end", hops, path FROM w WHERE hops > 0""",
    "earliest_follow": f"""
WITH RECURSIVE v AS ({_V}), e AS (SELECT rel_id, source, target, relationship_type AS ty FROM relationships WHERE source IS NOT NULL AND target IS NOT NULL),
s AS (SELECT id FROM v WHERE label = 'Event' AND year IS NOT NULL AND id IN (SELECT source FROM e WHERE ty IN ('Precedes', 'Influences')) ORDER BY year, id LIMIT 1),
w AS (SELECT id AS start, id AS at_node, [-1::bigint] AS used, id AS path, 0 AS hops FROM s
  UNION ALL SELECT start, target, list_append(used, rel_id), path || '>' || target, hops + 1 FROM w JOIN e ON e.source = at_node WHERE ty IN ('Precedes', 'Influences') AND hops < 3 AND NOT list_contains(used, rel_id))
SELECT start, at_node AS "end", hops, path, target AS reached FROM w JOIN e ON e.source = at_node WHERE hops > 0 AND ty IN ('References', 'IsLocatedIn', 'Influences') ORDER BY path, reached LIMIT 10""",
    "theta_pairs": "SELECT a.n_name, b.n_name AS m_name FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_name < b.n_name",
    "theta_below": "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey < r_regionkey",
    "title_years": r"SELECT rec_id, try_cast(nullif(regexp_extract(title, '\b(19|20)\d{2}\b', 0), '') AS int) AS in_title, try_cast(nullif(regexp_extract(abstract, '\b(19|20)\d{2}\b', 0), '') AS int) AS in_abstract FROM publications",
    "extraction_stats": f"SELECT lower(label) AS kind, count(*) AS n FROM ({_V}) v GROUP BY 1",
    "type_filter": f"SELECT id, label FROM ({_V}) v WHERE label IN ('Actor', 'Concept')",
}
