"""Quality evaluations: context joins, statistics, assessment, recommendations and review tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import capitalize, high_severity, percent, priority_score, stable_id
from graphloom.runtime import cut_lineage, lookup

#: fixed values: quality levels and score columns
LEVELS = ("excellent", "good", "fair", "poor")
ENTITY_SCORES = ("evidence", "accuracy", "completeness", "relevance", "supporting_text", "consistency")
EDGE_SCORES = ("evidence", "entity_accuracy", "relationship_type", "direction", "strength", "relevance", "entity_existence")
ISSUES = "array<struct<issue_type:string,description:string,severity:int,suggested_correction:string>>"


def without_auto_created(entities: DataFrame, flag: str = "auto_created_from_relationship") -> DataFrame:
    return entities.where(~F.coalesce(F.col(flag), F.lit(False)))


def edge_context(edges: DataFrame, entities: DataFrame) -> DataFrame:
    """Edges with both ends' names (left join on id), as evaluation context."""
    e = cut_lineage(entities.select("id", "name"))
    s = e.select(F.col("id").alias("source_id"), F.col("name").alias("source_name"))
    t = e.select(F.col("id").alias("target_id"), F.col("name").alias("target_name"))
    return lookup(lookup(edges, s, ["source_id"]), t, ["target_id"])


def supporting_chunk(items: DataFrame, chunks: DataFrame, ref: str = "source_chunk") -> DataFrame:
    """Items with the text of the chunk at their index, else of the chunk with that id, else null.

    ``chunks``: chunk_ix (unique, may be null), chunk_id, text.
    """
    by_ix = chunks.where("chunk_ix IS NOT NULL").select(F.col("chunk_ix").cast("bigint").alias(ref), F.col("text").alias("_ix"))
    by_id = chunks.select(F.col("chunk_id").alias(ref), F.col("text").alias("_id"))
    out = items.withColumn(ref, F.col(ref).cast("bigint")).join(by_ix, ref, "left").join(by_id, ref, "left")
    return out.withColumn("chunk_text", F.coalesce("_ix", "_id")).drop("_ix", "_id")


def fallback_evaluation(rows: DataFrame, evaluation: str = "evaluation", reason: str = "Evaluation failed") -> DataFrame:
    """Failed evaluations (null) replaced by the lowest scores, level poor, a grave system issue and a review flag."""
    issue = F.array(
        F.struct(F.lit("system").alias("issue_type"), F.lit(reason).alias("description"), F.lit(5).alias("severity"), F.lit("Review by hand").alias("suggested_correction"))
    ).cast(ISSUES)
    return rows.select(
        *[c for c in rows.columns if c != evaluation],
        F.coalesce(F.col(evaluation)["overall_confidence"], F.when(F.col(evaluation).isNull(), F.lit(1.0))).alias("overall_confidence"),
        F.coalesce(F.col(evaluation)["extraction_quality"], F.when(F.col(evaluation).isNull(), F.lit("poor"))).alias("extraction_quality"),
        F.coalesce(F.col(evaluation)["issues_identified"].cast(ISSUES), F.when(F.col(evaluation).isNull(), issue)).alias("issues_identified"),
        F.coalesce(F.col(evaluation)["human_review_recommended"], F.col(evaluation).isNull()).alias("human_review_recommended"),
        F.col(evaluation).isNull().alias("failed"),
    )


def statistics(evals: DataFrame) -> DataFrame:
    """Totals per item kind ('entity' or 'relationship'): evaluated, flagged, excellent."""
    return evals.groupBy("item_kind").agg(
        F.count("*").alias("total"),
        F.count_if(F.coalesce("human_review_recommended", F.lit(False))).alias("flagged"),
        F.count_if(F.col("extraction_quality") == "excellent").alias("excellent"),
    )


def assessment(evals: DataFrame) -> DataFrame:
    """Count, mean confidence and quality histogram per (item_kind, entity_type), with a grand row (both null) weighted by item.

    A missing confidence is 1, a missing level poor; unknown levels fall in no
    bucket. One aggregation with two grouping sets.
    """
    q = F.coalesce("extraction_quality", F.lit("poor"))
    rows = evals.select("item_kind", F.coalesce("entity_type", F.lit("relationship")).alias("entity_type"), F.coalesce(F.col("overall_confidence").cast("double"), F.lit(1.0)).alias("c"), q.alias("q"))
    return (
        rows.groupingSets([[F.col("item_kind"), F.col("entity_type")], []], F.col("item_kind"), F.col("entity_type"))
        .agg(F.count("*").alias("n"), F.avg("c").alias("mean_confidence"), *(F.count_if(F.col("q") == level).alias(level) for level in LEVELS))
        .where("n > 0")
    )


def recommendations(assessed: DataFrame, compat: bool = False) -> DataFrame:
    """(rank, recommendation) from an assessment.

    Rules: overall mean below 3; relationship mean below 2.5 (with ``compat`` also
    without relationships); mean of a type below 2.5; share of poor items above
    30 %; else one line that all is well. The input has a row per entity type, so
    the result is small by nature.
    """
    a = assessed
    overall = a.where("item_kind IS NULL").select(
        F.lit(1).alias("rank"), F.lit("").alias("k"), F.when(F.col("mean_confidence") < 3, F.lit("Overall extraction quality is low: refine the prompts or the model")).alias("recommendation")
    )
    rel = a.where("item_kind = 'relationship'")
    low_rel = rel.select(
        F.lit(2).alias("rank"), F.lit("").alias("k"), F.when(F.col("mean_confidence") < 2.5, F.lit("Relationship quality is low: review the relationship prompt")).alias("recommendation")
    )
    if compat:
        none = rel.agg(F.count("*").alias("c")).where("c = 0").select(
            F.lit(2).alias("rank"), F.lit("").alias("k"), F.lit("Relationship quality is low: review the relationship prompt").alias("recommendation")
        )
        low_rel = low_rel.unionByName(none)
    ent = a.where("item_kind = 'entity'")
    types = ent.select(
        F.lit(3).alias("rank"), F.col("entity_type").alias("k"), F.when(F.col("mean_confidence") < 2.5, F.concat(capitalize("entity_type"), F.lit(" extraction quality is low"))).alias("recommendation")
    )
    poor = ent.where(F.col("poor") / F.col("n") > 0.3).select(
        F.lit(4).alias("rank"), F.col("entity_type").alias("k"), F.concat(percent("poor", "n"), F.lit(" of "), F.col("entity_type"), F.lit(" items are poor")).alias("recommendation")
    )
    found = overall.unionByName(low_rel).unionByName(types).unionByName(poor).where("recommendation IS NOT NULL")
    fine = found.agg(F.count("*").alias("c")).where("c = 0").select(F.lit(9).alias("rank"), F.lit("").alias("k"), F.lit("Extraction quality is acceptable").alias("recommendation"))
    return found.unionByName(fine).orderBy("rank", "k").select("rank", "recommendation")


def summary(evals: DataFrame) -> DataFrame:
    """One row of ratios; they are null on empty input."""
    r = evals.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("extraction_quality") == "excellent").alias("excellent"),
        F.count_if(F.coalesce("human_review_recommended", F.lit(False))).alias("flagged"),
    )
    return r.select("total", "excellent", "flagged", percent("excellent", "total").alias("excellent_rate"), percent("flagged", "total").alias("review_rate"))


def review_tasks(evals: DataFrame) -> DataFrame:
    """Tasks for flagged evaluations, by falling priority, then entities before relationships, then ``ord``."""
    n = high_severity("issues_identified")
    rows = evals.where(F.coalesce("human_review_recommended", F.lit(False)))
    return rows.select(
        stable_id("item_kind", "item_id").alias("task_id"),
        F.concat("item_kind", F.lit("_review")).alias("task_type"),
        "item_kind",
        "entity_type",
        "item_id",
        priority_score("overall_confidence", "extraction_quality", n).alias("priority"),
        F.col("overall_confidence").alias("confidence"),
        F.col("extraction_quality").alias("quality"),
        "ord",
    ).orderBy(F.desc("priority"), "item_kind", "ord")


def high_priority_count(tasks: DataFrame, floor: int = 7) -> DataFrame:
    return tasks.agg(F.count_if(F.col("priority") >= floor).alias("n_high"))
