"""Queries of the model-backed drivers with offline clients, of JSON rules and of broken bytes, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions import text as X
from graphloom.operators import pipeline as P
from graphloom.operators import validate as W
from graphloom.runtime import read


def _extractor():
    """An offline model: answers depend on the length of the text between the marks; some are no JSON."""

    def ask(prompt: str) -> str:
        n = (len(prompt.split("<<<", 1)[1]) - 3) % 97
        if prompt.startswith("List the relationships"):
            source = f"Unheard {n}" if n % 10 == 9 else f"Group {n}"
            confidence = "0.9" if n % 2 else "0.2"
            return (
                f'{{"relationships": [{{"source": "{source}", "source_type": "Actor", "target": "Meeting {n}", "target_type": "Event", "relationship_type": "Participates",'
                f' "description": "", "confidence": {confidence}}}]}}'
            )
        if n % 10 == 9 and prompt.startswith("List every actor"):
            return 'no JSON but "actors"'
        if prompt.startswith("List every actor"):
            return f'Here: ```json\n{{"actors": [{{"name": "Group {n}", "type": "NGO"}}, "no object"]}}\n```'
        return f'{{"events": [{{"title": "Meeting {n}", "year": {1900 + n}}}]}}'

    return ask


def _graph(spark, d):
    chunks = read(spark, d, "chunks").select("chunk_id", "text")
    return P.extract_graph(chunks, _extractor, ("event", "actor"), least_confidence=0.5)


def extraction_driver(spark, d):
    """Nodes and edges of the three phases, by name."""
    g = _graph(spark, d)
    nodes = g["nodes"].select(F.lit("node").alias("part"), F.col("kind").alias("a"), F.col("name").alias("b"), F.col("year").cast("string").alias("c"), F.col("n_merged").alias("n"))
    name = g["nodes"].select("id", "name")
    e = g["edges"].join(name.toDF("source_id", "s"), "source_id").join(name.toDF("target_id", "t"), "target_id")
    edges = e.select(F.lit("edge").alias("part"), F.col("s").alias("a"), F.col("t").alias("b"), F.col("relationship_type").alias("c"), F.col("source_chunk").alias("n"))
    failures = g["failures"].groupBy("kind", "named").agg(F.count("*").alias("n")).select(F.lit("failure").alias("part"), F.col("kind").alias("a"), F.col("named").alias("b"), F.lit(None).cast("string").alias("c"), "n")
    return nodes.unionByName(edges).unionByName(failures)


def _critic():
    """An offline critic: scores by the length of the name in the judged item, else of its type; some answers are no JSON."""

    def ask(prompt: str) -> str:
        import json

        item = json.loads(prompt.split("\nItem: ", 1)[1].split("\n<<<", 1)[0])
        n = len(item.get("name") or item.get("relationship_type") or "") % 5
        if n == 4:
            return "cannot say"
        level = ("poor", "fair", "good", "excellent")[n]
        flag = "true" if n == 0 else "false"
        seen = prompt.split("\n<<<", 1)[1] not in ("(no text)>>>", ">>>")
        return f'```json\n{{"overall_confidence": {n + 1}.0, "extraction_quality": "{level}", "human_review_recommended": {flag}, "issues_identified": [{{"issue_type": "t", "severity": {4 if seen else 1}}}]}}\n```'

    return ask


def _evaluated(spark, d):
    a = read(spark, d, "actors").where("id IS NOT NULL")
    entities = a.groupBy("id").agg(F.min_by(F.struct("name", "type", "source_chunk", F.col("rec_id").alias("ord")), "rec_id").alias("r")).select(
        "id", F.lit("actor").alias("kind"), "r.*", F.lit(False).alias("auto_created_from_relationship")
    )
    r = read(spark, d, "relationships")
    edges = r.select(F.col("rel_id").alias("edge_id"), F.col("source").alias("source_id"), F.col("target").alias("target_id"), "relationship_type", "source_chunk", F.col("rel_id").alias("ord"))
    chunks = read(spark, d, "chunks").select(F.lit(None).cast("int").alias("chunk_ix"), "chunk_id", "text")
    return P.critique(entities, edges, chunks, _critic)


def critic_driver(spark, d):
    out = _evaluated(spark, d)
    return out.select("item_kind", "entity_type", "item_id", "overall_confidence", "extraction_quality", "human_review_recommended", F.get("issues_identified", F.lit(0))["severity"].alias("severity"), "failed")


def critic_tasks(spark, d):
    return P.critic_report(_evaluated(spark, d))["tasks"].groupBy("item_kind", "priority", "quality").agg(F.count("*").alias("n"))


#: rules of the JSON records of json_rules; each record of the query breaks one of them
_JSON_RULES = (
    W.Rule("title", "required"), W.Rule("year", "type", "integer"), W.Rule("", "keys", ("title", "year", "tags", "related", "place", "contact", "created_at", "score")),
    W.Rule("tags", "type", "array"), W.Rule("related", "items_required", ("event_id", "relationship_type")), W.Rule("place", "nested_required", ("type", "coordinates")),
    W.Rule("place.coordinates", "items", (2, 2)), W.Rule("contact.email", "format", "email"), W.Rule("contact.site", "format", "uri"), W.Rule("created_at", "format", "date-time"), W.Rule("score", "range", (0, 1)),
    W.Rule("place", "keys", ("type", "coordinates")),
)
_RECORDS = (
    ('{"title": "a", "year": 1999, "tags": ["x"], "related": [{"event_id": "1", "relationship_type": "y"}], "place": {"type": "Point", "coordinates": [1, 2.5]}, "contact": {"email": "a@b.org", "site": "https://b.org"}, "created_at": "2024-01-02T03:04:05Z", "score": 0.5}', ()),
    ('{"year": 1999}', (("title", "required"),)),
    ('{"title": "a", "year": "1999"}', (("year", "type"),)),
    ('{"title": "a", "colour": 1}', (("", "keys"),)),
    ('{"title": "a", "tags": "x"}', (("tags", "type"),)),
    ('{"title": "a", "related": [{"event_id": "1", "relationship_type": "y"}, {"event_id": "2"}]}', (("related", "items_required"),)),
    ('{"title": "a", "place": {"type": "Point"}}', (("place", "nested_required"),)),
    ('{"title": "a", "place": {"type": "Point", "coordinates": [1]}}', (("place.coordinates", "items"),)),
    ('{"title": "a", "contact": {"email": "nobody", "site": "no site"}}', (("contact.email", "format"), ("contact.site", "format"))),
    ('{"title": "a", "created_at": "2024-01-02"}', (("created_at", "format"),)),
    ('{"title": "a", "score": 1.5, "year": 2.0}', (("score", "range"),)),
    ('{"title": "a", "place": {"type": "Point", "coordinates": [1, 2], "datum": 3}, "year": 2.5}', (("place", "keys"), ("year", "type"))),
    ('[1, 2]', (("", "type"),)),
    ('{"title": ', (("", "type"),)),
)


def json_rules(spark, d):
    record = F.lit(None).cast("string")
    for k, (text, _) in enumerate(_RECORDS):
        record = F.when(F.pmod(F.col("rec_id"), F.lit(len(_RECORDS))) == k, F.lit(text)).otherwise(record)
    return W.json_errors(read(spark, d, "event_records").select("rec_id", record.alias("record")), _JSON_RULES, key="rec_id")


def form_rules(spark, d):
    return W.errors(read(spark, d, "event_records"), "event", W.FORM_RULES, key="rec_id")


def utf8_text(spark, d):
    """Texts with a broken byte at the end."""
    t = read(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("C3"))).alias("b"))
    return t.select("doc_id", F.md5(X.utf8_text("b").cast("binary")).alias("digest"))


def base_names(spark, d):
    src = F.concat(F.coalesce("metadata.source", F.lit("C:\\\\docs\\\\a.b.txt")), F.lit("/page.v2.html"))
    return read(spark, d, "chunks").select("chunk_id", X.base_name(src).alias("base"))


QUERIES = {f.__name__: f for f in (extraction_driver, critic_driver, critic_tasks, json_rules, form_rules, utf8_text, base_names)}

_C = "SELECT chunk_id, length(text) % 97 AS n FROM chunks WHERE text IS NOT NULL"
_EVALS = """
x AS (SELECT 'entity' AS item_kind, 'actor' AS entity_type, id AS item_id, length(coalesce(arg_min_null(name, rec_id), '')) % 5 AS n, arg_min_null(source_chunk, rec_id) AS sc, min(rec_id) AS ord FROM actors WHERE id IS NOT NULL GROUP BY id
  UNION ALL SELECT 'relationship', NULL, rel_id::varchar, length(coalesce(relationship_type, '')) % 5, source_chunk, rel_id FROM relationships),
e AS (SELECT x.*, CASE WHEN coalesce(length(text), 0) > 0 THEN 4 ELSE 1 END AS sev0 FROM x LEFT JOIN chunks c ON c.chunk_id = x.sc),
v AS (SELECT item_kind, entity_type, item_id, CASE WHEN n = 4 THEN 1.0::double ELSE n + 1.0::double END AS overall_confidence, ['poor', 'fair', 'good', 'excellent', 'poor'][n + 1] AS extraction_quality,
  n IN (0, 4) AS human_review_recommended, CASE WHEN n = 4 THEN 5 ELSE sev0 END AS severity, n = 4 AS failed FROM e)"""
_BROKEN = " UNION ALL ".join(f"SELECT {k} AS k, '{f}' AS field, '{r}' AS rule" for k, (_, bad) in enumerate(_RECORDS) for f, r in bad)

SQL = {
    "extraction_driver": f"""
WITH c AS ({_C}), r AS (SELECT chunk_id, n, CASE WHEN n % 10 = 9 THEN 'Unheard ' ELSE 'Group ' END || n AS s FROM c WHERE n % 2 = 1)
SELECT 'node' AS part, 'actor' AS a, 'Group ' || n AS b, NULL AS c, count(*) AS n FROM c WHERE n % 10 <> 9 GROUP BY c.n
UNION ALL SELECT 'node', 'event', 'Meeting ' || n, (1900 + n)::varchar, count(*) FROM c GROUP BY c.n
UNION ALL SELECT DISTINCT 'node', 'actor', s, NULL, 0 FROM r WHERE s LIKE 'Unheard%'
UNION ALL SELECT 'edge', s, 'Meeting ' || n, 'Participates', min(chunk_id) FROM r GROUP BY r.n, s
UNION ALL SELECT 'failure', 'actor', 'actors', NULL, count(*) FROM c WHERE n % 10 = 9 HAVING count(*) > 0""",
    "critic_driver": f"WITH {_EVALS} SELECT * FROM v",
    "critic_tasks": f"""
WITH {_EVALS}, t AS (SELECT item_kind, extraction_quality AS quality, greatest(1, least(10, trunc(6 - overall_confidence + CASE extraction_quality WHEN 'poor' THEN 3 WHEN 'fair' THEN 1 WHEN 'excellent' THEN -1 ELSE 0 END
  + CASE WHEN severity >= 4 THEN 1 ELSE 0 END)::int)) AS priority FROM v WHERE human_review_recommended)
SELECT item_kind, priority, quality, count(*) AS n FROM t GROUP BY ALL""",
    "json_rules": f"SELECT rec_id, field, rule FROM event_records JOIN ({_BROKEN}) b ON b.k = rec_id % {len(_RECORDS)}",
    "form_rules": " UNION ALL ".join(f"SELECT rec_id, '{f}' AS field, 'required' AS rule FROM event_records WHERE {f} IS NULL" for f in ("title", "year", "type", "description")),
    "utf8_text": "SELECT doc_id, md5(replace(text, chr(65533), '')) AS digest FROM documents WHERE text IS NOT NULL",
    "base_names": "SELECT chunk_id, 'page.v2' AS base FROM chunks",
}
