"""Problem 6: references to records that do not exist.

References and parents are hash-partitioned and sorted on (table, key, salt) and
merged in one linear pass (a sort-merge join). Each parent carries one validity
interval [earliest load, deletion), which tells missing, deleted and late apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.runtime import blank, cut_lineage

#: endpoint type -> table of the records it names (fixed values of the data model)
PARENT_TABLES = {
    "actor": "actors",
    "event": "event_records",
    "concept": "concepts",
    "publication": "publications",
    "location": "locations",
}

#: a key that holds more than this share of all references is dealt over blocks of about that size; at most 2 / share keys can be hot
HOT_SHARE = 0.001


#: white space, brackets, quotes and hyphens that do not matter in a key
KEY_NOISE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000{}()[]<>\"'`-"


def reference_key(c) -> F.Column:
    """The 32 hexadecimal digits of a key, or null when the value is no such key.

    Letter case, hyphens, a ``urn:uuid:`` prefix, wrapping brackets or quotes and
    blanks do not matter. Character tables instead of patterns: this runs on every
    reference.
    """
    bare = F.translate(F.lower(c), KEY_NOISE, "")
    bare = F.when(bare.startswith("urn:"), F.substring(bare, 5, 1 << 30)).otherwise(bare)
    bare = F.when(bare.startswith("uuid:"), F.substring(bare, 6, 1 << 30)).otherwise(bare)
    return F.when((F.char_length(bare) == 32) & (F.translate(bare, "0123456789abcdef", "") == ""), bare)


def endpoint_table(c) -> F.Column:
    """Table named by an endpoint type written in any case, in singular or plural."""
    names = F.create_map(*(F.lit(x) for kind, table in PARENT_TABLES.items() for x in (kind, table, f"{kind}s", table)))
    return F.try_element_at(names, F.translate(F.lower(c), KEY_NOISE[:KEY_NOISE.index("{")], ""))


def parent_intervals(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per (table_name, key): earliest loaded_at and deleted_at (null while alive)."""
    union = None
    for name, df in tables.items():
        part = df.select(
            F.lit(name).alias("table_name"), reference_key(F.col("id")).alias("key"), "loaded_at", "deleted_at"
        ).where(F.col("key").isNotNull())
        union = part if union is None else union.unionByName(part)
    return union.groupBy("table_name", "key").agg(
        F.min("loaded_at").alias("first_loaded"), F.min("deleted_at").alias("deleted_at")
    )


def reference_stream(relationships: DataFrame) -> DataFrame:
    """Both endpoints of every relationship as rows; null and blank references are left out."""
    # keys are made before the rows are doubled, so that no later filter makes them again
    ends = relationships.select(
        "rel_id",
        "created_at",
        *(x for s in ("source", "target") for x in (blank(F.col(s)).alias(f"{s}_blank"), endpoint_table(F.col(f"{s}_type")).alias(f"{s}_table"), reference_key(F.col(s)).alias(f"{s}_key"))),
    )
    side = lambda s: F.struct(
        F.lit(s).alias("side"), F.col(f"{s}_blank").alias("blank"), F.col(f"{s}_table").alias("table_name"), F.col(f"{s}_key").alias("key")
    )
    rows = ends.select("rel_id", "created_at", F.explode(F.array(side("source"), side("target"))).alias("e"))
    return rows.where("NOT e.blank").select("rel_id", "created_at", "e.side", "e.table_name", "e.key")


def orphans(relationships: DataFrame, tables: dict[str, DataFrame], hot_share: float = HOT_SHARE, least: int = 1000) -> DataFrame:
    """Orphan references: rel_id, created_at, side, table_name, reason.

    reason is ``missing`` (no such record, no such key, or an endpoint type that
    names no table), else ``deleted`` (deleted_at <= created_at), else ``late``
    (created_at before the earliest load). A null created_at can only be missing.
    Repeated relationship rows give repeated result rows; empty tables make every
    reference missing. Extra columns of the inputs are ignored.

    References that are no key or name no table are missing without a join. A key
    held by more than ``hot_share`` of the references (``least`` at least) is dealt
    over blocks by its count, and its parent is repeated in each of them.
    """
    refs = reference_stream(relationships)
    known = F.col("key").isNotNull() & F.col("table_name").isNotNull()
    most = max(float(least), hot_share * relationships.count())
    hot = refs.where(known).groupBy("table_name", "key").agg(F.count("*").alias("c")).where(F.col("c") > most)
    # counted once; at most 2 / hot_share rows, so the broadcast has a proven bound
    hot = cut_lineage(hot.select("table_name", "key", F.ceil(F.col("c") / most).cast("int").alias("blocks")))
    blocks = F.coalesce("blocks", F.lit(1))
    keyed = (
        refs.where(known)
        .join(F.broadcast(hot), ["table_name", "key"], "left")
        .withColumn("salt", F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("rel_id", "side", "created_at"), F.col("blocks")).cast("int")).otherwise(0))
        .drop("blocks")
    )
    parents = (
        parent_intervals(tables)
        .join(F.broadcast(hot), ["table_name", "key"], "left")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .drop("blocks")
        .withColumn("known", F.lit(True))
    )
    joined = keyed.join(parents.hint("merge"), ["table_name", "key", "salt"], "left")
    reason = (
        F.when(F.col("known").isNull(), "missing")
        .when(F.col("deleted_at") <= F.col("created_at"), "deleted")
        .when(F.col("created_at") < F.col("first_loaded"), "late")
    )
    found = joined.select("rel_id", "created_at", "side", "table_name", reason.alias("reason")).where(F.col("reason").isNotNull())
    return found.unionByName(refs.where(~known).select("rel_id", "created_at", "side", "table_name", F.lit("missing").alias("reason")))


def orphan_report(found: DataFrame) -> DataFrame:
    """Counts per referenced table, month of created_at and reason; unknown tables count as ``(unknown)``."""
    return found.groupBy(
        F.coalesce("table_name", F.lit("(unknown)")).alias("table_name"),
        F.coalesce(F.date_format("created_at", "yyyy-MM"), F.lit("(none)")).alias("month"),
        "reason",
    ).agg(F.count("*").alias("n"))
