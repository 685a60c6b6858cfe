"""Review tasks as a table: defaults, states, ordering, updates and export of corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import stable_id

#: order of the priority words; other words come last
PRIORITY_ORDER = {"high": 0, "medium": 1, "low": 2}


def with_defaults(tasks: DataFrame) -> DataFrame:
    """Tasks with missing id, priority and status filled: a stable id of the content, 'medium', 'pending_review'."""
    content = [c for c in tasks.columns if c not in ("task_id", "priority", "status")]
    return tasks.withColumns(
        {
            "task_id": F.coalesce("task_id", stable_id(*content)),
            "priority": F.coalesce("priority", F.lit("medium")),
            "status": F.coalesce("status", F.lit("pending_review")),
        }
    )


def priority_word(score) -> F.Column:
    """The word of a numeric priority: 7 and more high, 4 to 6 medium, else low."""
    return F.when(score >= 7, "high").when(score >= 4, "medium").otherwise("low")


def by_status(tasks: DataFrame, status: str) -> DataFrame:
    return tasks.where(F.col("status") == status)


def pending(tasks: DataFrame, order: str = "ord") -> DataFrame:
    """Pending tasks: high, medium, low, others, each in their order."""
    rank = F.lit(len(PRIORITY_ORDER))
    for word, k in PRIORITY_ORDER.items():
        rank = F.when(F.col("priority") == word, k).otherwise(rank)
    return by_status(tasks, "pending_review").orderBy(rank, order)


def find(tasks: DataFrame, task_id: str) -> DataFrame:
    return tasks.where(F.col("task_id") == task_id).limit(1)


def update(tasks: DataFrame, updates: DataFrame) -> DataFrame:
    """Tasks after updates (task_id, corrected, notes, reviewed_at): updated ones become reviewed.

    Several updates of a task: the latest counts (ties by the corrected text). An
    update of an unknown task changes nothing (see :func:`unknown_updates`). A task may be reviewed again.
    """
    last = updates.groupBy("task_id").agg(F.max_by(F.struct("corrected", "notes", "reviewed_at"), F.struct("reviewed_at", "corrected")).alias("u"))
    hit = F.col("u").isNotNull()
    keep = [c for c in tasks.columns if c not in ("status", "corrected", "notes", "reviewed_at")]
    old = lambda c, t: F.col(c) if c in tasks.columns else F.lit(None).cast(t)
    return tasks.join(last, "task_id", "left").select(
        *keep,
        F.when(hit, "reviewed").otherwise(F.col("status")).alias("status"),
        F.when(hit, F.col("u.corrected")).otherwise(old("corrected", "string")).alias("corrected"),
        F.when(hit, F.col("u.notes")).otherwise(old("notes", "string")).alias("notes"),
        F.when(hit, F.col("u.reviewed_at")).otherwise(old("reviewed_at", "timestamp_ntz")).alias("reviewed_at"),
    )


def unknown_updates(tasks: DataFrame, updates: DataFrame) -> DataFrame:
    """The updates whose task does not exist, the latest of each task; :func:`update` leaves them out."""
    last = updates.groupBy("task_id").agg(F.max_by(F.struct("corrected", "notes", "reviewed_at"), F.struct("reviewed_at", "corrected")).alias("u"))
    return last.join(tasks.select("task_id"), "task_id", "left_anti").select("task_id", "u.*")


def corrections(tasks: DataFrame) -> DataFrame:
    """(task_id, original, corrected) of reviewed tasks; the corrected data default to the original."""
    return by_status(tasks, "reviewed").select("task_id", F.col("extracted").alias("original"), F.coalesce("corrected", "extracted").alias("corrected"))


def export_corrected(tasks: DataFrame, kinds: tuple[str, ...] = ("event", "actor", "concept", "publication", "location")) -> DataFrame:
    """(kind, item): every corrected item of reviewed tasks; ``items`` is array<struct<kind, item>>, unknown kinds are dropped."""
    return by_status(tasks, "reviewed").select(F.explode("items").alias("i")).select("i.kind", "i.item").where(F.col("kind").isin(*kinds))


def card(tasks: DataFrame) -> DataFrame:
    """Display fields of a task list: short id, title-cased type, line breaks as markup."""
    return tasks.select(
        F.left("task_id", F.lit(8)).alias("short_id"), F.initcap(F.replace("task_type", F.lit("_"), F.lit(" "))).alias("type"), F.replace("note", F.lit("\n"), F.lit("<br>")).alias("note")
    )
