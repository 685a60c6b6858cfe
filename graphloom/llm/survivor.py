"""Problem 5: the best representative of each group of copies.

Method: consistent bundles. Fields that depend on one another form a bundle and
are taken from one row together. Candidates of a bundle are ordered by trust;
whole bundles are chosen by branch and bound so that the total trust is greatest
among the choices that respect the dependencies between bundles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.runtime import blank

#: fillers that say nothing, compared without case, outer blanks and punctuation
FILLERS = (
    "n a", "na", "none", "null", "nil", "nan", "unknown", "undefined", "unspecified", "not known", "not specified", "not given",
    "not available", "not applicable", "unavailable", "missing", "pending", "empty", "blank", "tbd", "tbc", "tba", "todo", "to do", "wip",
    "to be added", "to be added later", "to be done", "to be confirmed", "to be determined", "to be completed", "to be defined",
    "to follow", "coming soon", "placeholder", "see above", "see below", "see name", "see title", "see source", "see note",
    "as above", "same as above", "same as before", "same", "ditto", "idem", "xxx", "asdf", "test", "lorem ipsum", "description", "definition",
)
#: "No description available.", "Definition pending" and the like
FILLER_SHAPE = (
    r"^(no|missing|empty|the)? ?(description|definition|text|summary|abstract|details?|information|info|content|data)"
    r"( (is|was|are|has been|to be|not|yet|currently|available|pending|missing|given|provided|added|found|follows?|unknown|later|here|entered|supplied|recorded|at|this|time|present))*$"
)
#: machine-made stubs
STUB_SHAPE = r"^\s*(auto[- ]?(matically)?[- ]?(created|generated|imported|extracted|filled)|(created|generated|imported|extracted) (automatically|by (the )?(pipeline|script|machine|system|model|import)))\b"
#: marks of a text cut off before its end
CUT_SHAPE = r"(\.\.+|…|[\[({<]\s*(\.\.+|…|truncated|cut( off)?|more|continued|shortened)\s*[\])}>])[\s\p{Z}\"'”’»)\]]*$"
END_SHAPE = r"[.!?。！？؟।][\s\p{Z}\"'”’»)\]]*$"


def usable(c) -> F.Column:
    """True for a text that may survive: it says something, is no stub and reaches the end of a sentence."""
    plain = F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))
    return F.coalesce(
        ~blank(c)
        & (plain != "")
        & ~plain.isin(*FILLERS)
        & ~plain.rlike(FILLER_SHAPE)
        & ~F.lower(c).rlike(STUB_SHAPE)
        & ~F.lower(c).rlike(CUT_SHAPE)
        & c.rlike(END_SHAPE),
        F.lit(False),
    )


#: trust of one rank of an account; more than the sum of all other bundles (10 a filled field, at most 7 for the rest, of each)
ACCOUNT = 1000.0


@dataclass(frozen=True)
class Bundle:
    """Dependent fields that must come from one row; ``text`` is the field judged by :func:`usable`, if any."""

    name: str
    fields: tuple[str, ...]
    text: str | None = None
    #: fields that dependencies with other bundles read
    linked: tuple[str, ...] = field(default=())


#: bundles of each table, the leading one first, and its dependencies between bundles: (bundle, field, bundle, field)
SCHEMES: dict[str, tuple[tuple[Bundle, ...], tuple[tuple[str, str, str, str], ...]]] = {
    "actors": (
        (
            Bundle("account", ("description", "supporting_text", "source_chunk"), "description", linked=("type",)),
            Bundle("kind", ("type",), linked=("type",)),
            Bundle("office", ("role", "expertise"), linked=("role",)),
            Bundle("place", ("country",), linked=("country",)),
            Bundle("naming", ("name", "affiliations")),
        ),
        (("account", "type", "kind", "type"), ("kind", "type", "office", "role"), ("office", "role", "place", "country")),
    ),
    "concepts": (
        (
            Bundle("account", ("definition", "source_chunk"), "definition", linked=("parent_concept_id",)),
            Bundle("naming", ("name", "alternative_names")),
            Bundle("tree", ("parent_concept_id",), linked=("parent_concept_id",)),
            Bundle("field", ("domain",)),
            Bundle("weight", ("significance",), linked=("significance",)),
        ),
        (("account", "parent_concept_id", "tree", "parent_concept_id"), ("tree", "parent_concept_id", "weight", "significance")),
    ),
    "event_records": (
        (
            Bundle("account", ("description", "source_chunk"), "description", linked=("type",)),
            Bundle("naming", ("title",)),
            Bundle("time", ("year", "start_date", "end_date"), linked=("year",)),
            Bundle("kind", ("type",), linked=("type",)),
            Bundle("setting", ("locations", "tags")),
            Bundle("weight", ("significance",)),
        ),
        (("account", "type", "kind", "type"), ("time", "year", "kind", "type")),
    ),
}


def _candidates(df: DataFrame, table: str) -> DataFrame:
    """One row per (id, bundle, linked values): its most trusted source row.

    Only linked values matter to the dependencies, so among equal ones the most
    trusted row dominates the others. The reduction is a hash aggregate with
    map-side combine; a group of any size never stands in one task's memory.
    """
    bundles, _ = SCHEMES[table]
    seen = df.where(F.col("id").isNotNull())
    one = []
    for b in bundles:
        filled = sum((F.when(F.col(f).isNotNull() & (F.size(f) > 0 if t.startswith("array") else ~blank(F.col(f).cast("string"))), 1).otherwise(0) for f, t in df.dtypes if f in b.fields), F.lit(0))
        ok = usable(F.col(b.text)) if b.text else filled > 0
        one.append(
            F.when(
                ok,
                F.struct(
                    F.lit(b.name).alias("bundle"),
                    F.to_json(F.struct(*(F.col(f) for f in b.linked)), {"ignoreNullFields": "false"}).alias("link") if b.linked else F.lit("{}").alias("link"),
                    (F.lit(0) if b.text else filled).cast("int").alias("filled"),
                ),
            )
        )
    rows = seen.select(
        "id", "rec_id", F.coalesce("reviewed", F.lit(False)).alias("reviewed"), "revised_at", F.explode(F.array_compact(F.array(*one))).alias("c")
    )
    # accounts: reviewed, then latest revised_at, then smaller rec_id; elsewhere fuller rows come first
    order = F.struct("c.filled", "reviewed", F.coalesce("revised_at", F.to_timestamp_ntz(F.lit("0001-01-01 00:00:00"))).alias("at"), (-F.col("rec_id")).alias("neg"))
    return rows.groupBy("id", "c.bundle", "c.link").agg(F.max(order).alias("best"), F.count("*").alias("votes"))


def branch_and_bound(options: list[list[tuple[float, str, int]]], allowed) -> list[tuple[float, str, int] | None]:
    """The choice of one option (trust, link, row) per bundle with the greatest total trust.

    ``options[i]`` is ordered by falling trust; ``allowed(i, a, j, b)`` says whether
    links a and b of bundles i and j go together. A branch is dropped when even
    the best rest cannot beat the best choice found. When no choice satisfies
    every dependency the bundle may stay empty (trust 0). Ties keep the earlier option.
    """
    n = len(options)
    rest = [0.0] * (n + 1)
    for i in range(n - 1, -1, -1):
        rest[i] = rest[i + 1] + (options[i][0][0] if options[i] else 0.0)
    best: list = [-1.0, [None] * n]
    chosen: list = [None] * n

    def go(i: int, total: float) -> None:
        if total + rest[i] <= best[0] + 1e-12:
            return
        if i == n:
            best[0], best[1] = total, list(chosen)
            return
        for o in options[i]:
            if total + o[0] + rest[i + 1] <= best[0] + 1e-12:
                break
            if all(chosen[j] is None or allowed(j, chosen[j][1], i, o[1]) for j in range(i)):
                chosen[i] = o
                go(i + 1, total + o[0])
                chosen[i] = None
        go(i + 1, total)  # leave the bundle empty

    go(0, 0.0)
    return best[1]


def choose(df: DataFrame, table: str) -> DataFrame:
    """For each id with two or more rows, the row each bundle comes from: id, bundle, rec_id.

    The search maximises the total trust of whole bundles. Of an account
    (description, definition) only usable texts are options, and its trust is the
    rank among them by review, then the latest revised_at (null is oldest), then
    the smaller rec_id, times ACCOUNT, more than all other bundles can bring: so
    the account of the choice is the best one, and the bundles that depend on it
    follow. Without a usable text it is absent. The trust of another bundle is its
    filled fields, review, recency rank and votes. Two linked values go together
    when some row of the id holds both, or an account's row leaves its own null. Null ids are left out, tables may be
    empty, extra columns are ignored.
    """
    bundles, links = SCHEMES[table]
    names = [b.name for b in bundles]
    at = {b.name: b for b in bundles}
    many = df.groupBy("id").agg(F.count("*").alias("n_rows")).where("n_rows > 1 AND id IS NOT NULL")
    cands = (
        _candidates(df, table)
        .groupBy("id")
        .agg(F.collect_list(F.struct("bundle", "link", F.col("best.filled").alias("filled"), F.col("best.reviewed").alias("reviewed"), F.col("best.at").cast("string").alias("at"), (-F.col("best.neg")).alias("rec_id"), "votes")).alias("options"))
    )
    pair = lambda x, fx, y, fy: F.struct(
        F.lit(f"{x}|{y}").alias("pair"),
        F.to_json(F.struct(F.col(fx)), {"ignoreNullFields": "false"}).alias("a"),
        F.to_json(F.struct(F.col(fy)), {"ignoreNullFields": "false"}).alias("b"),
    )
    witness = (
        df.select("id", F.explode(F.array(*(pair(*x) for x in links))).alias("w")).groupBy("id").agg(F.collect_set("w").alias("witness"))
    )
    grouped = many.join(cands, "id").join(witness, "id", "left").select("id", "options", "witness")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        linked = {f"{x}|{y}" for x, _, y, _ in links}
        for pdf in batches:
            out = []
            for ident, options, witness in zip(pdf["id"], pdf["options"], pdf["witness"]):
                held = {(w["pair"], w["a"], w["b"]) for w in (witness if witness is not None else ())}
                by: dict[str, list] = {n: [] for n in names}
                for o in options:
                    by[o["bundle"]].append(o)
                choice = []
                for n in names:
                    opts = sorted(by[n], key=lambda o: (o["filled"], o["reviewed"], o["at"], -o["rec_id"]), reverse=True)
                    top = len(opts)
                    # rank by the trust order; an extra row that agrees counts for a little
                    if at[n].text is None:
                        scored = [(10.0 * o["filled"] + 5.0 * bool(o["reviewed"]) + (top - r) / top + 0.1 * min(o["votes"], 9), o["link"], o["rec_id"]) for r, o in enumerate(opts)]
                        scored.sort(key=lambda s: -s[0])
                    else:
                        scored = [(ACCOUNT * (top - r), o["link"], o["rec_id"]) for r, o in enumerate(opts)]
                    choice.append(scored)

                def allowed(j: int, a: str, i: int, b: str) -> bool:
                    p = f"{names[j]}|{names[i]}"
                    # an account whose row does not fill the linked field binds nothing
                    free = at[names[j]].text is not None and a.endswith(":null}")
                    return p not in linked or free or (p, a, b) in held

                out += [(ident, n, c[2]) for n, c in zip(names, branch_and_bound(choice, allowed)) if c is not None]
            yield pd.DataFrame(out, columns=["id", "bundle", "rec_id"])

    return grouped.mapInPandas(run, "id string, bundle string, rec_id bigint")


def survivors(tables: dict[str, DataFrame]) -> DataFrame:
    """:func:`choose` over several tables with their names: table_name, id, bundle, rec_id."""
    out = None
    for name, df in tables.items():
        part = choose(df, name).withColumn("table_name", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out.select("table_name", "id", "bundle", "rec_id")


def build(df: DataFrame, table: str) -> DataFrame:
    """One row per id with two or more rows, each bundle's fields taken from its chosen row."""
    picks = choose(df, table)
    out = picks.select("id").distinct()
    for b in SCHEMES[table][0]:
        part = picks.where(F.col("bundle") == b.name).select("id", "rec_id").join(df.select("rec_id", *b.fields), "rec_id").drop("rec_id")
        out = out.join(part, "id", "left")
    return out
