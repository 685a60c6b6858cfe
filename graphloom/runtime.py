"""Session-level helpers shared by all operators."""

from __future__ import annotations

import pathlib
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Scan one table of a data set; columns are pruned by the plan that uses it."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder named by ``spark.checkpoint.dir``.

    Only where that setting is absent and the master is local (tests) a temporary
    folder is set; on a cluster a missing setting is an error, as a folder of one
    machine would be lost with it. Unlike localCheckpoint the copy survives the
    loss of executors.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="graphloom-"))
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over all cores before CPU-heavy Python work when the input has too few splits.

    A scan of much data has many splits and is left as it is. A small table may
    arrive as one file, and adaptive execution may have merged a small shuffle
    into one partition; such rows are repartitioned round-robin.
    """
    spark = df.sparkSession
    cores = max(spark.sparkContext.defaultParallelism, 1)
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    unknown = size >= 1 << 60  # no estimate, as for checkpointed rows
    if not unknown:
        # the files of a small table are few enough to be listed
        if size > cores * split or len(df.inputFiles()) >= cores:
            return df
    return df.repartition(max(2 * cores, int(spark.conf.get("spark.sql.shuffle.partitions"))))


#: most bytes of strings and rows of a frame that is broadcast
BROADCAST_BYTES, BROADCAST_ROWS = 32 << 20, 100_000
#: a key that holds more than this share of the rows of a join is dealt over blocks; at most 1 / share keys can be hot
HOT_SHARE = 0.001


def small(df: DataFrame) -> bool:
    """Whether counting shows that the frame may be broadcast, by its rows and by the bytes of its strings."""
    text = sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint") for c, t in df.dtypes if t == "string"), F.lit(0).cast("bigint"))
    other = sum(t != "string" for _, t in df.dtypes)
    if any(t.startswith(("array", "map", "struct", "binary")) for _, t in df.dtypes):
        return False
    n, size = df.limit(BROADCAST_ROWS + 1).agg(F.count("*"), F.coalesce(F.sum(text + 16 * other + 16), F.lit(0))).first()
    return n <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def lookup(rows: DataFrame, table: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """``rows`` joined with ``table``, whose keys ``on`` are unique; null keys meet nothing.

    A table that was counted to be small is broadcast. Else both are shuffled, and
    a key held by more than HOT_SHARE of the rows is dealt over so many blocks that
    each holds about that share; only those rows of the table are repeated.
    ``table`` is read more than once, so it should not be costly to compute.
    """
    if small(table):
        return rows.join(F.broadcast(table), on, how)
    full = None
    for k in on:
        full = F.col(k).isNotNull() if full is None else full & F.col(k).isNotNull()
    most = max(1000.0, HOT_SHARE * rows.count())
    hot = rows.where(full).groupBy(*on).agg(F.count("*").alias("_c")).where(F.col("_c") > most)
    hot = F.broadcast(cut_lineage(hot.select(*on, F.ceil(F.col("_c") / most).cast("int").alias("_blocks"))))  # at most 1 / HOT_SHARE rows
    # by the content of a row, so that a task that is run again deals it alike
    place = F.xxhash64(*(c for c, t in rows.dtypes if "map<" not in t and t != "variant"))
    blocks = F.when(full, F.coalesce("_blocks", F.lit(1)))
    dealt = rows.join(hot, on, "left").withColumn("_salt", F.when(full, F.pmod(place, blocks)).otherwise(-1 - F.pmod(place, F.lit(64))).cast("int"))
    spread_out = table.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_blocks", F.lit(1)) - 1)))
    return dealt.drop("_blocks").join(spread_out.drop("_blocks"), [*on, "_salt"], how).drop("_salt")


def blank(c) -> F.Column:
    """True where a string is null or holds nothing but white space."""
    return c.isNull() | F.regexp_replace(c, r"[\s\p{Z}\x{85}\x1c-\x1f]+", "").eqNullSafe("")




_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so it need not be installed there.

    The archive is written on the driver and fetched by executors from Spark's own file server.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = pathlib.Path(__file__).resolve().parent
    target = pathlib.Path(tempfile.mkdtemp(prefix="graphloom-")) / "graphloom.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
