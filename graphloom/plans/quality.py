"""Queries over evaluations, review tasks, validation rules and model responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions import text as X
from graphloom.operators import extraction as E
from graphloom.operators import quality as Q
from graphloom.operators import review as V
from graphloom.operators import validate as W
from graphloom.plans.entities import _V, _vertices
from graphloom.runtime import read



def _level():
    return F.element_at(F.array(*(F.lit(x) for x in ("poor", "fair", "good", "excellent"))), (F.pmod(F.col("rec_id"), F.lit(4)) + 1).cast("int"))


def evaluations(spark, d):
    """Evaluations of actors, concepts, events and relationships, derived from their own fields (there is no model here)."""
    out = None
    for t, kind in (("actors", "actor"), ("concepts", "concept"), ("event_records", "event")):
        df = read(spark, d, t)
        sev = F.pmod(F.col("rec_id"), F.lit(6)).cast("int")
        part = df.select(
            F.lit("entity").alias("item_kind"), F.lit(kind).alias("entity_type"), F.col("rec_id").cast("string").alias("item_id"), F.col("rec_id").alias("ord"),
            F.when(F.col("source_chunk").isNotNull(), F.pmod(F.col("source_chunk"), F.lit(5)).cast("double") + 1).alias("overall_confidence"),
            F.when(F.col("reviewed").isNotNull(), _level()).alias("extraction_quality"),
            F.array(F.struct(F.lit("x").alias("issue_type"), F.lit("").alias("description"), sev.alias("severity"), F.lit("").alias("suggested_correction"))).alias("issues_identified"),
            (~F.coalesce("reviewed", F.lit(False))).alias("human_review_recommended"),
        )
        out = part if out is None else out.unionByName(part)
    rel = read(spark, d, "relationships").select(
        F.lit("relationship").alias("item_kind"), F.lit(None).cast("string").alias("entity_type"), F.col("rel_id").cast("string").alias("item_id"), F.col("rel_id").alias("ord"),
        F.col("strength").cast("double").alias("overall_confidence"),
        F.when(F.col("confidence") >= 0.75, "excellent").when(F.col("confidence") >= 0.5, "good").when(F.col("confidence") >= 0.25, "fair").when(F.col("confidence").isNotNull(), "poor").alias("extraction_quality"),
        F.lit(None).cast(Q.ISSUES).alias("issues_identified"), (F.col("confidence") < 0.25).alias("human_review_recommended"),
    )
    return out.unionByName(rel)


def quality_stats(spark, d):
    return Q.statistics(evaluations(spark, d))


def quality_assessment(spark, d):
    return Q.assessment(evaluations(spark, d)).withColumn("mean_confidence", F.round("mean_confidence", 6))


def recommendations(spark, d):
    return Q.recommendations(Q.assessment(evaluations(spark, d)))


def quality_summary(spark, d):
    return Q.summary(evaluations(spark, d))


def priority_tasks(spark, d):
    return Q.review_tasks(evaluations(spark, d)).select("task_id", "task_type", "entity_type", "item_id", "priority", "confidence", "quality")


def high_priority(spark, d):
    return Q.high_priority_count(Q.review_tasks(evaluations(spark, d)))


def edge_context(spark, d):
    ents = _vertices(spark, d).select("id", "name")
    e = read(spark, d, "relationships").select("rel_id", F.col("source").alias("source_id"), F.col("target").alias("target_id"))
    return Q.edge_context(e, ents).select("rel_id", "source_name", "target_name")


def supporting_chunk(spark, d):
    # every other chunk has an index, which goes before the id
    ix = F.when(F.pmod("chunk_id", F.lit(2)) == 0, F.col("chunk_id") + 1)
    ch = read(spark, d, "chunks").select(ix.alias("chunk_ix"), "chunk_id", "text")
    out = Q.supporting_chunk(read(spark, d, "event_records").select("rec_id", "source_chunk"), ch)
    return out.select("rec_id", F.md5(F.coalesce("chunk_text", F.lit("")).cast("binary")).alias("digest"))


def fallback_evaluation(spark, d):
    ev = F.struct(F.lit(4.0).alias("overall_confidence"), F.lit("good").alias("extraction_quality"), F.lit(None).cast(Q.ISSUES).alias("issues_identified"), F.lit(False).alias("human_review_recommended"))
    rows = read(spark, d, "concepts").select("rec_id", F.when(F.col("definition").isNotNull(), ev).alias("evaluation"))
    out = Q.fallback_evaluation(rows)
    return out.select("rec_id", "overall_confidence", "extraction_quality", "human_review_recommended", "failed", X.high_severity("issues_identified").cast("bigint").alias("n_grave"))


def without_auto_created(spark, d):
    rows = read(spark, d, "event_records").select("rec_id", F.when(F.col("description").isNotNull(), F.col("description").startswith("Auto-created")).alias("auto_created_from_relationship"))
    return Q.without_auto_created(rows).select("rec_id")


def _tasks(spark, d):
    e = read(spark, d, "event_records")
    return e.select(
        F.concat(F.lit("t"), F.col("rec_id").cast("string")).alias("task_id"), F.col("rec_id").alias("ord"), F.when(F.col("significance") >= 4, "high").when(F.col("significance") >= 3, "medium").when(F.col("significance") >= 2, "low").alias("priority"),
        F.when(F.col("reviewed"), "reviewed").alias("status"), F.lit("entity_review").alias("task_type"), F.col("title").alias("extracted"), F.lit(None).cast("string").alias("corrected"), F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.coalesce("type", F.lit(""))).alias("note"),
    )


def task_defaults(spark, d):
    return V.with_defaults(_tasks(spark, d)).select("task_id", "priority", "status")


def pending_tasks(spark, d):
    return V.pending(V.with_defaults(_tasks(spark, d))).select("task_id", "priority", "ord")


def find_task(spark, d):
    return V.find(_tasks(spark, d), "t7").select("task_id", "extracted")


def _updates(spark, d):
    p = read(spark, d, "event_records").where("revised_at IS NOT NULL AND type IS NOT NULL")
    return p.select(F.concat(F.lit("t"), F.col("source_chunk").cast("string")).alias("task_id"), F.col("type").alias("corrected"), F.lit("checked").alias("notes"), F.col("revised_at").alias("reviewed_at")).where("task_id IS NOT NULL")


def review_upsert(spark, d):
    return V.update(V.with_defaults(_tasks(spark, d)), _updates(spark, d)).select("task_id", "status", "corrected", "notes", "reviewed_at")


def unknown_updates(spark, d):
    """Updates of tasks that there are not: those of a task table without its events of low significance."""
    return V.unknown_updates(V.with_defaults(_tasks(spark, d)).where("priority <> 'medium'"), _updates(spark, d)).select("task_id", "corrected")


def corrections(spark, d):
    return V.corrections(V.update(V.with_defaults(_tasks(spark, d)), _updates(spark, d)))


def export_corrected(spark, d):
    t = V.with_defaults(_tasks(spark, d)).withColumn("items", F.array(F.struct(F.lit("event").alias("kind"), F.col("extracted").alias("item")), F.struct(F.lit("unheard").alias("kind"), F.col("note").alias("item"))))
    return V.export_corrected(t).groupBy("kind", "item").agg(F.count("*").alias("n"))


def task_cards(spark, d):
    return V.card(_tasks(spark, d))


_COLLECTIONS = {"events": ("event_records", {}), "actors": ("actors", {}), "locations": ("locations", {}), "concepts": ("concepts", {}), "publications": ("publications", {})}


def _relationship_records(spark, d):
    """Relationships under the field names of their rules."""
    r = read(spark, d, "relationships")
    return r.select(F.col("rel_id").alias("rec_id"), F.col("rel_id").cast("string").alias("id"), F.col("source").alias("source_id"), "source_type", F.col("target").alias("target_id"), "target_type", "relationship_type", "strength", "confidence")


def schema_rules(spark, d):
    out = None
    for name, (t, _) in _COLLECTIONS.items():
        part = W.errors(read(spark, d, t), name[:-1], key="rec_id").select(F.lit(name[:-1]).alias("kind"), "rec_id", "field", "rule")
        out = part if out is None else out.unionByName(part)
    rel = W.errors(_relationship_records(spark, d), "relationship", key="rec_id")
    return out.unionByName(rel.select(F.lit("relationship").alias("kind"), "rec_id", "field", "rule"))


def dataset_counts(spark, d):
    tables = {name: (read(spark, d, t), "rec_id") for name, (t, _) in _COLLECTIONS.items()}
    return W.dataset_counts({**tables, "relationships": (_relationship_records(spark, d), "rec_id")})


def uniqueness(spark, d):
    p = read(spark, d, "publications")
    return W.uniqueness(p, "id").select(F.lit("id").alias("field"), "value", "n").unionByName(W.uniqueness(p, "doi").select(F.lit("doi").alias("field"), "value", "n"))


def not_null(spark, d):
    return W.not_null(read(spark, d, "event_records"), ("id", "year", "title", "description", "type"))


def unknown_keys(spark, d):
    e = read(spark, d, "events").select("event_id", "props")
    return W.unknown_keys(e, "props", ("x", "y"), "event_id")


def unknown_kinds(spark, d):
    return W.unknown_kinds(read(spark, d, "relationships"), "source_type").select("rel_id", "source_type")


def ref_integrity(spark, d):
    """Endpoints that are filled and name no record (exact keys and singular types, as in a strict data set)."""
    rel = read(spark, d, "relationships")
    side = lambda s: rel.select("rel_id", F.lit(s).alias("side"), F.lower(f"{s}_type").alias("kind"), F.col(s).alias("id"))
    ends = side("source").unionByName(side("target")).where("id IS NOT NULL")
    ids = None
    for name, (t, _) in _COLLECTIONS.items():
        part = read(spark, d, t).select(F.lit(name[:-1]).alias("kind"), "id").distinct()
        ids = part if ids is None else ids.unionByName(part)
    return ends.join(ids, ["kind", "id"], "left_anti").select("rel_id", "side", "kind")


_PROMPTS = {"event": "List events in: {text}", "actor": "List actors in: {text}"}


def prompt_fanout(spark, d):
    out = E.prompt_rows(read(spark, d, "chunks"), _PROMPTS)
    return out.select("chunk_id", "entity_type", F.md5(F.col("prompt").cast("binary")).alias("digest"))


def _responses(spark, d):
    """Responses of every form: fenced, bare with talk around it, broken but naming its list, and none."""
    e = read(spark, d, "event_records").select("rec_id", "year", F.translate(F.coalesce("title", F.lit("")), '"\\', "  ").alias("t"))
    body = F.concat(F.lit('{"events": [{"title": "'), F.col("t"), F.lit('", "year": '), F.coalesce(F.col("year").cast("string"), F.lit("null")), F.lit("}]}"))
    k = F.pmod(F.col("rec_id"), F.lit(4))
    resp = (
        F.when(k == 0, F.concat(F.lit("Here it is:\n```json\n"), body, F.lit("\n```\ndone")))
        .when(k == 1, F.concat(F.lit("x "), body, F.lit(" y")))
        .when(k == 2, F.lit('not json "events"'))
        .otherwise(F.lit("nothing"))
    )
    return e.select("rec_id", resp.alias("response"))


def parse_llm_json(spark, d):
    r = _responses(spark, d).withColumn("p", E.parse_response("response", "events array<struct<title:string,year:int>>"))
    return r.select(
        "rec_id", F.get("p.events", F.lit(0))["title"].alias("title"), F.get("p.events", F.lit(0))["year"].alias("year"), F.get(E.degraded_keys("response"), F.lit(0)).alias("named"), E.error_text("response", 10).alias("head")
    )


def supporting_text(spark, d):
    a = read(spark, d, "event_records").select("rec_id", "title", "year", "source_chunk")
    c = read(spark, d, "chunks").where("text IS NOT NULL").select(F.col("chunk_id").alias("source_chunk"), "text")
    return a.join(c, "source_chunk").select("rec_id", F.md5(E.supporting_text("title", "year", "text", F.lit("event")).cast("binary")).alias("digest"))


def model_call(spark, d):
    """The model operator with an offline client: every prompt is answered by its length."""

    def client():
        return lambda prompt: f'{{"n": {len(prompt)}}}'

    rows = E.call_model(E.prompt_rows(read(spark, d, "chunks"), _PROMPTS), client)
    return rows.select("chunk_id", "entity_type", E.parse_response("response", "n int")["n"].cast("bigint").alias("n"), F.col("error").isNull().alias("ok"))


QUERIES = {
    f.__name__: f
    for f in (
        quality_stats, quality_assessment, recommendations, quality_summary, priority_tasks, high_priority, edge_context, supporting_chunk, fallback_evaluation, without_auto_created, task_defaults,
        pending_tasks, find_task, review_upsert, unknown_updates, corrections, export_corrected, task_cards, schema_rules, dataset_counts, uniqueness, not_null, unknown_keys, unknown_kinds, ref_integrity,
        prompt_fanout, parse_llm_json, supporting_text, model_call,
    )
}

_LV = "['poor', 'fair', 'good', 'excellent'][(rec_id % 4 + 1)::int]"
_EV = "\nUNION ALL ".join(
    f"SELECT 'entity' AS item_kind, '{k}' AS entity_type, rec_id::varchar AS item_id, rec_id AS ord, (source_chunk % 5)::double + 1 AS c0, CASE WHEN reviewed IS NOT NULL THEN {_LV} END AS q0, (rec_id % 6)::int AS sev, NOT coalesce(reviewed, false) AS flag FROM {t}"
    for t, k in (("actors", "actor"), ("concepts", "concept"), ("event_records", "event"))
) + """
UNION ALL SELECT 'relationship', NULL, rel_id::varchar, rel_id, strength::double, CASE WHEN confidence >= 0.75 THEN 'excellent' WHEN confidence >= 0.5 THEN 'good' WHEN confidence >= 0.25 THEN 'fair' WHEN confidence IS NOT NULL THEN 'poor' END, NULL, confidence < 0.25 FROM relationships"""
_AS = f"""ev AS ({_EV}), r AS (SELECT item_kind, coalesce(entity_type, 'relationship') AS entity_type, coalesce(c0, 1.0) AS c, coalesce(q0, 'poor') AS q FROM ev),
a AS (SELECT item_kind, entity_type, count(*) AS n, avg(c) AS mean_confidence, count(*) FILTER (q = 'excellent') AS excellent, count(*) FILTER (q = 'good') AS good, count(*) FILTER (q = 'fair') AS fair, count(*) FILTER (q = 'poor') AS poor
  FROM r GROUP BY GROUPING SETS ((item_kind, entity_type), ()))"""
_PRI = "greatest(1, least(10, trunc(6 - coalesce(c0, 1.0) + CASE coalesce(q0, 'poor') WHEN 'poor' THEN 3 WHEN 'fair' THEN 1 WHEN 'excellent' THEN -1 ELSE 0 END + CASE WHEN coalesce(sev, 0) >= 4 THEN 1 ELSE 0 END)::int))"
_TK = f"tk AS (SELECT *, {_PRI} AS priority FROM ({_EV}) e WHERE coalesce(flag, false))"
_T = """tasks AS (SELECT 't' || rec_id AS task_id, rec_id AS ord, coalesce(CASE WHEN significance >= 4 THEN 'high' WHEN significance >= 3 THEN 'medium' WHEN significance >= 2 THEN 'low' END, 'medium') AS priority,
  CASE WHEN reviewed THEN 'reviewed' ELSE 'pending_review' END AS status, title AS extracted, coalesce(title, '') || chr(10) || coalesce(type, '') AS note FROM event_records)"""
_U = """u AS (SELECT task_id, arg_max(corrected, k) AS corrected, max(reviewed_at) AS reviewed_at FROM (SELECT 't' || source_chunk AS task_id, type AS corrected, revised_at AS reviewed_at, struct_pack(a := revised_at, b := type) AS k
  FROM event_records WHERE revised_at IS NOT NULL AND type IS NOT NULL AND source_chunk IS NOT NULL) x GROUP BY 1)"""


def _rule_sql(kind: str, table: str, columns: dict[str, str]) -> str:
    parts = []
    q = lambda xs: ", ".join("'" + x.replace("'", "''") + "'" for x in xs)
    for r in W.RULES[kind]:
        f = r.field
        if f not in columns:
            if r.kind == "required":
                parts.append(f"SELECT '{kind}' AS kind, rec_id, '{f}' AS field, 'required' AS rule FROM {table}")
            continue
        if r.kind == "required":
            c = f"{f} IS NULL"
        elif r.kind == "enum":
            c = f"{f} NOT IN ({q(r.arg)})"
        elif r.kind == "items_enum":
            c = f"len(list_filter({f}, lambda x: x NOT IN ({q(r.arg)}))) > 0"
        elif r.kind == "range":
            lo, hi = r.arg
            c = " OR ".join([f"{f} < {lo}"] * (lo is not None) + [f"{f} > {hi}"] * (hi is not None))
        elif r.kind == "max_length":
            c = f"length({f}) > {r.arg}"
        elif r.kind == "pattern":
            c = f"NOT regexp_matches({f}, '{r.arg}')"
        elif r.kind == "format":
            c = f"NOT regexp_matches({f}, '{W.FORMATS[r.arg]}')" + (f" OR try_cast({f} AS date) IS NULL" if r.arg == "date" else "")
        else:
            c = f"len({f}) NOT BETWEEN {r.arg[0]} AND {r.arg[1]}"
        guard = "" if r.kind == "required" else f"{f} IS NOT NULL AND "
        parts.append(f"SELECT '{kind}' AS kind, rec_id, '{f}' AS field, '{r.kind}' AS rule FROM {table} WHERE {guard}({c})")
    return "\nUNION ALL ".join(parts)


#: columns of the driver tables that the rules name
_COLS = {
    "event": dict.fromkeys(("id", "year", "title", "description", "significance", "type", "start_date", "end_date"), ""),
    "actor": dict.fromkeys(("id", "name", "type", "country"), ""),
    "location": dict.fromkeys(("id", "name", "type", "country", "population", "coordinates"), ""),
    "concept": dict.fromkeys(("id", "name", "definition", "domain", "significance"), ""),
    "publication": dict.fromkeys(("id", "title", "year", "type"), ""),
}
_REL = "(SELECT rel_id AS rec_id, rel_id::varchar AS id, source AS source_id, source_type, target AS target_id, target_type, relationship_type, strength, confidence FROM relationships) r"
_ERR = "\nUNION ALL ".join(
    [_rule_sql(n[:-1], t, _COLS[n[:-1]]) for n, (t, _) in _COLLECTIONS.items()]
    + [_rule_sql("relationship", _REL, dict.fromkeys(("id", "source_id", "source_type", "target_id", "target_type", "relationship_type", "strength", "confidence"), ""))]
)
_CNT = "\nUNION ALL ".join(
    f"SELECT '{n[:-1]}' AS kind, count(*) AS total, count(*) FILTER (b.rec_id IS NULL) AS valid, count(*) FILTER (b.rec_id IS NOT NULL) AS invalid FROM {t} x LEFT JOIN (SELECT DISTINCT rec_id FROM err WHERE kind = '{n[:-1]}') b ON b.rec_id = x.rec_id"
    for n, (t, _) in [*_COLLECTIONS.items(), ("relationships", (_REL[: -len(" r")], None))]
)
_RESP = """resp AS (SELECT rec_id, CASE WHEN rec_id % 4 IN (0, 1) THEN translate(coalesce(title, ''), '"\\', '  ') END AS t, CASE WHEN rec_id % 4 IN (0, 1) THEN year END AS y, rec_id % 4 AS k FROM event_records)"""

SQL = {
    "quality_stats": f"SELECT item_kind, count(*) AS total, count(*) FILTER (coalesce(flag, false)) AS flagged, count(*) FILTER (q0 = 'excellent') AS excellent FROM ({_EV}) e GROUP BY 1",
    "quality_assessment": f"WITH {_AS} SELECT item_kind, entity_type, n, round(mean_confidence, 6) AS mean_confidence, excellent, good, fair, poor FROM a WHERE n > 0",
    "recommendations": f"""WITH {_AS}, f AS (
SELECT 1 AS rank, 'Overall extraction quality is low: refine the prompts or the model' AS recommendation FROM a WHERE item_kind IS NULL AND mean_confidence < 3
UNION ALL SELECT 2, 'Relationship quality is low: review the relationship prompt' FROM a WHERE item_kind = 'relationship' AND mean_confidence < 2.5
UNION ALL SELECT 3, upper(left(entity_type, 1)) || lower(substring(entity_type, 2)) || ' extraction quality is low' FROM a WHERE item_kind = 'entity' AND mean_confidence < 2.5
UNION ALL SELECT 4, printf('%.1f%%', 100.0 * poor / n) || ' of ' || entity_type || ' items are poor' FROM a WHERE item_kind = 'entity' AND poor / n::double > 0.3)
SELECT * FROM f UNION ALL SELECT 9, 'Extraction quality is acceptable' WHERE NOT EXISTS (SELECT 1 FROM f)""",
    "quality_summary": f"SELECT count(*) AS total, count(*) FILTER (q0 = 'excellent') AS excellent, count(*) FILTER (coalesce(flag, false)) AS flagged, printf('%.1f%%', 100.0 * count(*) FILTER (q0 = 'excellent') / count(*)) AS excellent_rate,"
    f" printf('%.1f%%', 100.0 * count(*) FILTER (coalesce(flag, false)) / count(*)) AS review_rate FROM ({_EV}) e",
    "priority_tasks": f"WITH {_TK} SELECT sha256(item_kind || '|' || item_id) AS task_id, item_kind || '_review' AS task_type, entity_type, item_id, priority, c0 AS confidence, q0 AS quality FROM tk",
    "high_priority": f"WITH {_TK} SELECT count(*) FILTER (priority >= 7) AS n_high FROM tk",
    "edge_context": f"WITH a AS ({_V}) SELECT rel_id, x.name AS source_name, y.name AS target_name FROM relationships r LEFT JOIN a x ON x.id = r.source LEFT JOIN a y ON y.id = r.target",
    "supporting_chunk": "SELECT rec_id, md5(coalesce(i.text, c.text, '')) AS digest FROM event_records e LEFT JOIN chunks i ON i.chunk_id % 2 = 0 AND i.chunk_id + 1 = e.source_chunk LEFT JOIN chunks c ON c.chunk_id = e.source_chunk",
    "fallback_evaluation": "SELECT rec_id, CASE WHEN definition IS NULL THEN 1.0::double ELSE 4.0::double END AS overall_confidence, CASE WHEN definition IS NULL THEN 'poor' ELSE 'good' END AS extraction_quality, definition IS NULL AS human_review_recommended, definition IS NULL AS failed, CASE WHEN definition IS NULL THEN 1::bigint ELSE 0::bigint END AS n_grave FROM concepts",
    "without_auto_created": "SELECT rec_id FROM event_records WHERE NOT coalesce(starts_with(description, 'Auto-created'), false)",
    "task_defaults": f"WITH {_T} SELECT task_id, priority, status FROM tasks",
    "pending_tasks": f"WITH {_T} SELECT task_id, priority, ord FROM tasks WHERE status = 'pending_review'",
    "find_task": f"WITH {_T} SELECT task_id, extracted FROM tasks WHERE task_id = 't7' LIMIT 1",
    "review_upsert": f"WITH {_T}, {_U} SELECT t.task_id, CASE WHEN u.task_id IS NOT NULL THEN 'reviewed' ELSE status END AS status, u.corrected, CASE WHEN u.task_id IS NOT NULL THEN 'checked' END AS notes, u.reviewed_at FROM tasks t LEFT JOIN u ON u.task_id = t.task_id",
    "unknown_updates": f"WITH {_T}, {_U} SELECT u.task_id, u.corrected FROM u WHERE NOT EXISTS (SELECT 1 FROM tasks t WHERE t.task_id = u.task_id AND t.priority <> 'medium')",
    "corrections": f"WITH {_T}, {_U} SELECT t.task_id, extracted AS original, coalesce(u.corrected, extracted) AS corrected FROM tasks t LEFT JOIN u ON u.task_id = t.task_id WHERE u.task_id IS NOT NULL OR status = 'reviewed'",
    "export_corrected": f"WITH {_T} SELECT 'event' AS kind, extracted AS item, count(*) AS n FROM tasks WHERE status = 'reviewed' GROUP BY extracted",
    "task_cards": f"WITH {_T} SELECT left(task_id, 8) AS short_id, 'Entity Review' AS type, replace(note, chr(10), '<br>') AS note FROM tasks",
    "schema_rules": _ERR,
    "dataset_counts": f"WITH err AS ({_ERR}), c AS ({_CNT}) SELECT * FROM c UNION ALL SELECT '(all)', sum(total)::bigint, sum(valid)::bigint, sum(invalid)::bigint FROM c",
    "uniqueness": "SELECT 'id' AS field, id AS value, count(*) AS n FROM publications WHERE id IS NOT NULL GROUP BY 2 HAVING count(*) > 1 UNION ALL SELECT 'doi', doi, count(*) FROM publications WHERE doi IS NOT NULL GROUP BY 2 HAVING count(*) > 1",
    "not_null": "\nUNION ALL ".join(f"SELECT '{c}' AS field, count(*) FILTER ({c} IS NULL) AS n FROM event_records" for c in ("id", "year", "title", "description", "type")),
    "unknown_keys": "SELECT event_id, k AS extra FROM (SELECT event_id, unnest(json_keys(props)) AS k FROM events) x WHERE k NOT IN ('x', 'y')",
    "unknown_kinds": "SELECT rel_id, source_type FROM relationships WHERE regexp_replace(lower(source_type), 's$', '') NOT IN ('event', 'actor', 'location', 'concept', 'publication', 'relationship')",
    "ref_integrity": """WITH ids AS (SELECT 'actor' AS kind, id FROM actors UNION SELECT 'event', id FROM event_records UNION SELECT 'concept', id FROM concepts UNION SELECT 'publication', id FROM publications UNION SELECT 'location', id FROM locations),
e AS (SELECT rel_id, 'source' AS side, lower(source_type) AS kind, source AS id FROM relationships WHERE source IS NOT NULL
  UNION ALL SELECT rel_id, 'target', lower(target_type), target FROM relationships WHERE target IS NOT NULL)
SELECT rel_id, side, kind FROM e WHERE NOT EXISTS (SELECT 1 FROM ids WHERE ids.kind = e.kind AND ids.id = e.id)""",
    "prompt_fanout": "SELECT chunk_id, 'event' AS entity_type, md5('List events in: ' || coalesce(text, '')) AS digest FROM chunks UNION ALL SELECT chunk_id, 'actor', md5('List actors in: ' || coalesce(text, '')) FROM chunks",
    "parse_llm_json": f"WITH {_RESP} SELECT rec_id, t AS title, y AS year, CASE WHEN k <> 3 THEN 'events' END AS named, CASE k WHEN 0 THEN 'Here it is' WHEN 1 THEN 'x ' || '" + '{"events' + "' WHEN 2 THEN 'not json \"' ELSE 'nothing' END AS head FROM resp",
    "supporting_text": r"""
WITH j AS (SELECT rec_id, lower(coalesce(title, '')) AS nm, year::varchar AS y, text, string_split(text, '. ') AS s FROM event_records e JOIN chunks c ON c.chunk_id = e.source_chunk WHERE text IS NOT NULL),
w AS (SELECT *, list_filter(regexp_split_to_array(nm, '[\t\n\x0b\x0c\r\x1c-\x20\x{85}\p{Z}]+'), lambda x: x <> '') AS ws FROM j),
g AS (SELECT rec_id, text, list_filter(s, lambda q: CASE WHEN len(ws) > 1 THEN len(list_filter(ws, lambda x: length(x) > 3 AND contains(lower(q), x))) >= 2 OR coalesce(contains(q, y), false)
  ELSE nm <> '' AND contains(lower(q), nm) AND coalesce(contains(q, y), false) END)[1:2] AS got FROM w)
SELECT rec_id, md5(CASE WHEN len(got) > 0 THEN array_to_string(got, '. ') WHEN length(text) > 200 THEN left(text, 200) || '...' ELSE text END) AS digest FROM g""",
    "model_call": "SELECT chunk_id, 'event' AS entity_type, length('List events in: ' || coalesce(text, '')) AS n, true AS ok FROM chunks UNION ALL SELECT chunk_id, 'actor', length('List actors in: ' || coalesce(text, '')), true FROM chunks",
}
