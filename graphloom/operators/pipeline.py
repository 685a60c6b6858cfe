"""Model-backed drivers: chunks to entities to relationships to a resolved graph, and the critic over a graph.

Both are plans around one operator, the model call. Its answers are materialised,
so every later step reads the same answers and no call is repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import truncate
from graphloom.operators import extraction as E
from graphloom.operators import quality as Q
from graphloom.operators import resolve as R
from graphloom.runtime import cut_lineage, lookup

#: fields asked for by kind; the first one names the entity
ENTITY_FIELDS = {
    "event": "title string, year int, type string, description string, significance int, locations array<string>, tags array<string>",
    "actor": "name string, type string, role string, country string, description string, expertise array<string>, affiliations array<string>",
    "concept": "name string, definition string, alternative_names array<string>, domain array<string>, significance int",
    "publication": "title string, type string, year int, publisher string, doi string, abstract string",
    "location": "name string, type string, country string, description string",
}
RELATIONSHIP_FIELDS = "source string, source_type string, target string, target_type string, relationship_type string, description string, strength int, confidence double, supporting_text string"
ENTITY_ANSWER = "overall_confidence double, extraction_quality string, issues_identified array<struct<issue_type:string,description:string,severity:int,suggested_correction:string>>, human_review_recommended boolean"
#: what an entity of a kind is judged by
CRITERIA = {
    "event": "The title is specific, the year stands in the text, type and significance fit the description.",
    "actor": "The name is the full one, type and role fit, country and affiliations stand in the text.",
    "concept": "The definition says what the concept is in this text, alternative names mean the same.",
    "publication": "Title, year and publisher stand in the text and the type fits.",
    "location": "The name is a place, its type fits and the country is right.",
}
EDGE_CRITERIA = ("evidence in the text", "right entities", "right type", "right direction", "fitting strength", "relevance", "both entities exist")
#: characters of the chunk that a critic sees
CRITIC_TEXT = 1000


def _names(ddl: str) -> str:
    return ", ".join(f.strip().split(" ")[0] for f in ddl.split(", "))


def entity_prompts(kinds: tuple[str, ...] = tuple(ENTITY_FIELDS)) -> dict[str, str]:
    """One template per kind; '{text}' stands for the chunk."""
    return {
        k: f"List every {k} that the text names. Answer with a JSON object {{\"{k}s\": [...]}}, whose items have the fields {_names(ENTITY_FIELDS[k])}. Leave out what the text does not say.\n<<<{{text}}>>>"
        for k in kinds
    }


RELATIONSHIP_PROMPT = (
    "List the relationships between the entities of the text. Answer with a JSON object {\"relationships\": [...]}, whose items have the fields "
    + _names(RELATIONSHIP_FIELDS) + ". Prefer these known entities: {known}\n<<<{text}>>>"
)


def extract_entities(chunks: DataFrame, client, kinds: tuple[str, ...] = tuple(ENTITY_FIELDS), key: str = "chunk_id", text: str = "text", calls_per_second: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(entities, failures) of all chunks and kinds.

    entities: kind, entity_name, year, source_chunk, ord, supporting_text, item (JSON of
    the answer's object). An answer that is no JSON gives no entity but a failure row
    (key, kind, named lists, beginning of the answer). Null texts are not asked about.
    """
    rows = E.prompt_rows(chunks.where(F.col(text).isNotNull()), entity_prompts(kinds), key, text)
    answers = cut_lineage(E.call_model(rows, client, calls_per_second=calls_per_second))
    parsed = answers.withColumn("p", E.parse_response("response", ", ".join(f"{k}s array<string>" for k in kinds)))
    failed = parsed.where("p IS NULL").select(
        F.col(key), F.col("entity_type").alias("kind"), F.array_join(E.degraded_keys("response"), ",").alias("named"), F.coalesce("error", E.error_text("response", 200)).alias("answer")
    )
    lists = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"p.{k}s").alias("items")) for k in kinds))
    items = parsed.where("p IS NOT NULL").select(key, "entity_type", F.explode(lists).alias("l")).where("l.kind = entity_type")
    items = items.select(F.col(key).alias("source_chunk"), F.col("l.kind").alias("kind"), F.posexplode("l.items").alias("item_no", "item")).where("item IS NOT NULL AND left(item, 1) = '{'")
    name = F.coalesce(F.get_json_object("item", "$.name"), F.get_json_object("item", "$.title"))
    found = items.select("kind", name.alias("entity_name"), F.get_json_object("item", "$.year").try_cast("int").alias("year"), "source_chunk", "item_no", "item")
    texts = chunks.select(F.col(key).alias("source_chunk"), F.col(text).alias("_text"))
    found = found.join(texts, "source_chunk").withColumn("supporting_text", E.supporting_text("entity_name", "year", "_text", F.col("kind"))).drop("_text")
    order = F.struct("source_chunk", "kind", "item_no")
    return found.withColumn("ord", order).drop("item_no"), failed


def extract_relationships(chunks: DataFrame, entities: DataFrame, client, key: str = "chunk_id", text: str = "text", known: int = 50, calls_per_second: float | None = None) -> DataFrame:
    """Relationships named by the model: source_chunk, item_no and RELATIONSHIP_FIELDS.

    The prompt names the entities found in the chunk, the first ``known`` by name (a
    bound of the prompt's length, not of the result).
    """
    per_chunk = entities.where("entity_name IS NOT NULL").groupBy("source_chunk").agg(F.array_join(F.slice(F.array_sort(F.collect_set("entity_name")), 1, known), "; ").alias("known"))
    rows = chunks.where(F.col(text).isNotNull()).select(F.col(key).alias("source_chunk"), F.col(text).alias("_t")).join(per_chunk, "source_chunk", "left")
    prompt = F.replace(F.replace(F.lit(RELATIONSHIP_PROMPT), F.lit("{known}"), F.coalesce("known", F.lit(""))), F.lit("{text}"), F.col("_t"))
    answers = cut_lineage(E.call_model(rows.select("source_chunk", prompt.alias("prompt")), client, calls_per_second=calls_per_second))
    parsed = answers.select("source_chunk", E.parse_response("response", f"relationships array<struct<{RELATIONSHIP_FIELDS.replace(' ', ':').replace(',:', ',')}>>").alias("p"))
    return parsed.select("source_chunk", F.posexplode("p.relationships").alias("item_no", "r")).where("r IS NOT NULL").select("source_chunk", "item_no", "r.*")


def extract_graph(chunks: DataFrame, client, kinds: tuple[str, ...] = tuple(ENTITY_FIELDS), least_confidence: float = 0.0, key: str = "chunk_id", text: str = "text", calls_per_second: float | None = None) -> dict[str, DataFrame]:
    """The three phases: entities of all chunks, relationships of all chunks, resolution.

    Returns nodes (id, kind, name, year, n_merged, created), edges (source_id,
    target_id, relationship_type, description, source_chunk), failures and stats
    (kind, n). Entities with one resolution key are one node, whose values are the
    first in order; endpoints that match nothing become nodes of their own.
    """
    entities, failures = extract_entities(chunks, client, kinds, key, text, calls_per_second)
    entities = cut_lineage(entities)
    rels = extract_relationships(chunks, entities, client, key, text, calls_per_second=calls_per_second)
    rels = cut_lineage(R.filter_by_confidence(rels, least_confidence))
    keyed = entities.withColumn("entity_key", R.entity_key(F.col("kind"), F.col("entity_name"), F.col("entity_name"), F.col("year"))).where("entity_key <> ''")
    nodes = keyed.groupBy("kind", "entity_key").agg(
        F.min_by("entity_name", "ord").alias("name"), F.min_by("year", "ord").alias("year"), F.min_by("supporting_text", "ord").alias("supporting_text"), F.min("ord").alias("ord"), F.count("*").alias("n_merged")
    )
    nodes = cut_lineage(nodes.withColumn("id", F.sha2(F.concat_ws("|", "kind", "entity_key"), 256)))
    named = rels.withColumn("ord", F.struct("source_chunk", "item_no"))
    edges, made = R.resolve_relationships(
        named.select("ord", "source", "source_type", "target", "target_type", "relationship_type", "description"),
        nodes.select("kind", F.col("name").alias("entity_name"), "id", "ord"),
    )
    edges = R.dedup_edges(edges.drop("id"), "ord").withColumn("source_chunk", F.col("ord.source_chunk"))
    all_nodes = nodes.select("id", "kind", "name", "year", "n_merged", F.lit(False).alias("created")).unionByName(
        made.select("id", "kind", "name", "year", F.lit(0).cast("bigint").alias("n_merged"), F.lit(True).alias("created"))
    )
    edges = cut_lineage(edges)
    stats = all_nodes.groupBy("kind").agg(F.count("*").alias("n")).unionByName(edges.agg(F.lit("relationship").alias("kind"), F.count("*").alias("n")))
    return {"nodes": all_nodes, "edges": edges, "failures": failures, "stats": stats}


def critic_prompts(items: DataFrame) -> DataFrame:
    """Items (item_kind, entity_type, item_id, item as JSON, context as JSON, chunk_text) with their prompt."""
    rules = F.create_map(*(F.lit(x) for kv in CRITERIA.items() for x in kv))
    entity = F.concat(F.lit("Judge this extracted "), F.col("entity_type"), F.lit(". "), F.coalesce(F.try_element_at(rules, F.col("entity_type")), F.lit("")))
    edge = F.concat(F.lit("Judge this extracted relationship by: " + "; ".join(EDGE_CRITERIA) + ". Its entities: "), F.coalesce("context", F.lit("unknown")))
    ask = F.lit(f"\nScore from 1 to 5. Answer with a JSON object with the fields {_names(ENTITY_ANSWER.split(' array<')[0])}, issues_identified, human_review_recommended.\nItem: ")
    about = F.coalesce(truncate("chunk_text", CRITIC_TEXT), F.lit("(no text)"))
    return items.withColumn("prompt", F.concat(F.when(F.col("item_kind") == "entity", entity).otherwise(edge), ask, F.col("item"), F.lit("\n<<<"), about, F.lit(">>>")))


def critique(entities: DataFrame, edges: DataFrame, chunks: DataFrame, client, calls_per_second: float | None = None) -> DataFrame:
    """Evaluations of all entities and edges: item_kind, entity_type, item_id, ord, scores, issues, review flag, failed.

    ``entities``: id (unique), kind, name, source_chunk, ord, auto_created_from_relationship
    and any other columns; auto-created ones are not judged. ``edges``: edge_id,
    source_id, target_id, source_chunk, ord and others. ``chunks``: chunk_ix, chunk_id,
    text. An answer that is no JSON becomes the lowest evaluation with a review flag.
    """
    base = Q.without_auto_created(entities)
    ents = base.select(
        F.lit("entity").alias("item_kind"), F.col("kind").alias("entity_type"), F.col("id").alias("item_id"), "ord", F.to_json(F.struct(*(c for c in base.columns if c != "ord"))).alias("item"),
        F.lit(None).cast("string").alias("context"), "source_chunk",
    )
    known = cut_lineage(entities.select("id", F.to_json(F.struct("id", "kind", "name")).alias("j")))
    both = lookup(lookup(edges, known.toDF("source_id", "_s"), ["source_id"]), known.toDF("target_id", "_t"), ["target_id"])
    rels = both.select(
        F.lit("relationship").alias("item_kind"), F.lit(None).cast("string").alias("entity_type"), F.col("edge_id").cast("string").alias("item_id"), "ord",
        F.to_json(F.struct(*(c for c in edges.columns if c != "ord"))).alias("item"), F.concat_ws(" -> ", F.coalesce("_s", F.lit("unknown")), F.coalesce("_t", F.lit("unknown"))).alias("context"), "source_chunk",
    )
    items = Q.supporting_chunk(ents.unionByName(rels), chunks)
    answers = cut_lineage(E.call_model(critic_prompts(items).select("item_kind", "entity_type", "item_id", "ord", "prompt"), client, calls_per_second=calls_per_second))
    return Q.fallback_evaluation(answers.withColumn("evaluation", E.parse_response("response", ENTITY_ANSWER)).drop("prompt", "response", "error"))


def critic_report(evals: DataFrame) -> dict[str, DataFrame]:
    """Statistics, assessment, recommendations, summary and review tasks of evaluations."""
    evals = cut_lineage(evals)
    assessed = Q.assessment(evals)
    return {"statistics": Q.statistics(evals), "assessment": assessed, "recommendations": Q.recommendations(assessed), "summary": Q.summary(evals), "tasks": Q.review_tasks(evals)}
