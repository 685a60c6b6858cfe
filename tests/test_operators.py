import io
import json
import zipfile

from pyspark.sql import functions as F

from graphloom.operators import extraction as E
from graphloom.operators import graph as G
from graphloom.operators import heuristics as H
from graphloom.operators import quality as Q
from graphloom.operators import references as P
from graphloom.operators import resolve as R
from graphloom.operators import review as V
from graphloom.operators import validate as W
from graphloom.sources import readers, sinks
from graphloom.streaming.snapshots import snapshot_stream


def test_merge_is_ordered(spark):
    rows = [("k", 2, "B", 5, 3, ["y", "x"], "q"), ("k", 1, "A", 2, 0, ["x"], "p"), ("k", 3, "A", None, 7, None, "p"), ("", 4, "Z", 1, 1, None, None), (None, 5, "Z", 1, 1, None, None)]
    df = spark.createDataFrame(rows, "key string, ord int, description string, significance int, source_chunk int, tags array<string>, supporting_text string")
    args = dict(joined={"description": " ", "supporting_text": " | "}, largest=("significance",), unions=("tags",))
    r = R.resolve_entities(df, ["key"], "ord", **args).first()
    assert (r.n_merged, r.description, r.supporting_text, r.significance, r.source_chunk, r.tags) == (3, "A B A", "p | q | p", 5, 0, ["x", "y"])
    assert R.resolve_entities(df, ["key"], "ord", compat=True, **args).first().source_chunk == 3


def test_dedup_edges_and_ties(spark):
    df = spark.createDataFrame([("a", "b", "t", 3), ("a", "b", "t", 1), (None, "b", "t", 2), ("", "b", "t", 9)], "source_id string, target_id string, relationship_type string, ord int")
    assert sorted((r.source_id, r.ord) for r in R.dedup_edges(df, "ord").collect()) == [("", 2), ("a", 1)]


def test_exact_and_scalable_resolution(spark):
    rels = spark.createDataFrame(
        [(1, "One Health", "Concept", "New Thing", "Concept", "Extends", "d"), (2, "new thing", "Concept", "ONE HEALTH (x)", "Concept", "Extends", "d"), (3, "Twin", "Actor", "Twin", "Actor", "Funds", "d"), (4, None, "Actor", "x", "Actor", "Funds", "d")],
        "ord bigint, source string, source_type string, target string, target_type string, relationship_type string, description string",
    )
    ents = spark.createDataFrame([("concept", "One Health", "c1", 0)], "kind string, entity_name string, id string, ord bigint")
    edges, made = R.resolve_relationships(rels, ents)
    e = {r.ord: (r.source_id, r.target_id) for r in edges.collect()}
    assert set(e) == {1, 2, 3} and e[1][0] == e[2][1] == "c1" and e[1][1] == e[2][0] and e[3][0] == e[3][1]
    assert made.count() == 2
    exact = [(r.ord, r.side, r.created) for r in R.resolve_exact_mode(rels, ents).collect()]
    assert sum(c for _, _, c in exact) == 3  # the twins are made twice in exact mode
    assert (2, 0, False) in exact


def test_trails_end_on_cycles(spark):
    edges = spark.createDataFrame([(1, "a", "b", "P"), (2, "b", "a", "P"), (3, "b", "c", "Q")], "edge_id int, source_id string, target_id string, relationship_type string")
    start = spark.createDataFrame([("a",)], "id string")
    got = sorted((r.end, r.hops, r.path) for r in G.trails(edges, start, max_hops=9).collect())
    assert got == [("a", 2, "a>b>a"), ("b", 1, "a>b"), ("c", 2, "a>b>c")]


def test_validation_rules(spark):
    ok = "123e4567-e89b-12d3-a456-426614174000"
    df = spark.createDataFrame(
        [(1, ok, 2000, "t", "d", 3, "Policy", "2001-02-03"), (2, "nope", 1700, "x" * 101, None, 9, "Legal", "2001-02-30"), (3, None, None, None, None, None, None, None)],
        "rec_id int, id string, year int, title string, description string, significance int, type string, start_date string",
    )
    got = {}
    for r in W.errors(df, "event", key="rec_id").collect():
        got.setdefault(r.rec_id, set()).add((r.field, r.rule))
    assert 1 not in got
    assert got[2] == {("id", "format"), ("year", "range"), ("title", "max_length"), ("description", "required"), ("significance", "range"), ("type", "enum"), ("start_date", "format")}
    assert got[3] == {(f, "required") for f in ("id", "year", "title", "description")}
    counts = {r.kind: (r.total, r.valid, r.invalid) for r in W.dataset_counts({"events": (df, "rec_id"), "oddities": (df, "rec_id")}).collect()}
    assert counts == {"event": (3, 1, 2), "oddities": (3, 0, 3), "(all)": (6, 1, 5)}


def test_load_rules(tmp_path):
    (tmp_path / "thing.json").write_text(json.dumps({"required": ["id"], "properties": {"id": {"type": "string", "format": "uuid"}, "n": {"minimum": 1, "maximum": 5}, "k": {"enum": ["a"]}}}))
    rules = W.load_rules(str(tmp_path))["thing"]
    assert {(r.field, r.kind) for r in rules} == {("id", "required"), ("id", "format"), ("n", "range"), ("k", "enum")}


def test_recommendations_compat(spark):
    ev = spark.createDataFrame([("entity", "actor", "1", 1, 1.0, "poor", True)], "item_kind string, entity_type string, item_id string, ord int, overall_confidence double, extraction_quality string, human_review_recommended boolean")
    a = Q.assessment(ev)
    assert [r.rank for r in Q.recommendations(a).collect()] == [1, 3, 4]
    assert [r.rank for r in Q.recommendations(a, compat=True).collect()] == [1, 2, 3, 4]
    assert Q.summary(ev.limit(0)).first().review_rate is None


def test_review_update(spark):
    t = V.with_defaults(spark.createDataFrame([("a", None, None, "x"), ("b", "low", "reviewed", "y")], "task_id string, priority string, status string, extracted string"))
    u = spark.createDataFrame([("a", "1", None, "2024-01-01"), ("a", "2", "n", "2024-01-02"), ("zz", "3", None, "2024-01-01")], "task_id string, corrected string, notes string, at string").select(
        "task_id", "corrected", "notes", F.to_timestamp_ntz("at").alias("reviewed_at")
    )
    got = {r.task_id: (r.status, r.corrected, r.priority) for r in V.update(t, u).collect()}
    assert got == {"a": ("reviewed", "2", "medium"), "b": ("reviewed", None, "low")}


def test_parse_responses(spark):
    items = ['talk ```json\n{"events": [{"t": "a"}]}\n``` end', 'x {"events":[]} y', 'not json "events"', "nothing", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, r string")
    got = df.select("i", E.parse_response("r", "events array<struct<t:string>>").alias("p"), E.degraded_keys("r").alias("k")).orderBy("i").collect()
    assert got[0].p.events[0].t == "a" and got[1].p.events == [] and got[2].p is None and got[2].k == ["events"] and got[3].k is None and got[4].p is None


def test_model_errors_become_values(spark):
    def client():
        def ask(p):
            if p == "bad":
                raise RuntimeError("no")
            return p.upper()

        return ask

    df = spark.createDataFrame([("good",), ("bad",)], "prompt string")
    assert {(r.prompt, r.response, r.error) for r in E.call_model(df, client).collect()} == {("good", "GOOD", None), ("bad", None, "no")}


def test_year_events_positions(spark):
    df = spark.createDataFrame([(1, "In 1999 a conference. " + "x" * 200 + " In 2004 a report."), (2, None), (3, "")], "chunk_id int, text string")
    got = [(r.year, r.title) for r in H.year_events(df).orderBy("hit").collect()]
    assert got == [(1999, "Conference"), (2004, "Report")]
    assert [r.year for r in H.year_events(df, compat=True).orderBy("hit").collect()] == [19, 20]


def test_orphans(spark):
    k = "aaaaaaaa-bbbb-4ccc-8ddd-eeeeeeeeeeee"
    ts = lambda c: F.to_timestamp_ntz(c)
    one = spark.createDataFrame([(k, "2020-01-02", "2020-06-01", 1), (k, "2020-01-05", "2020-06-01", 2)], "id string, l string, d string, extra int").select("id", ts("l").alias("loaded_at"), ts("d").alias("deleted_at"), "extra")
    none = one.limit(0)
    tables = {t: (one if t == "actors" else none) for t in P.PARENT_TABLES.values()}
    rows = [
        (1, k.upper(), " Actors", "{" + k + "}", "actor", "2020-03-01"), (2, "urn:uuid:" + k, "ACTOR", k.replace("-", ""), "Actor", "2020-06-01"), (3, k + "\t", "Actor", " ", "Actor", "2020-01-01"),
        (4, "n/a", "Actor", None, "Event", "2020-03-01"), (5, k, "Event", k, "Planet", None), (5, k, "Event", k, "Planet", None), (6, k, "Actor", k, "Actor", None),
    ]
    rel = spark.createDataFrame(rows, "rel_id bigint, source string, source_type string, target string, target_type string, c string").withColumn("created_at", ts("c"))
    got = sorted((r.rel_id, r.side, r.reason) for r in P.orphans(rel, tables, least=1, hot_share=0.2).collect())
    assert got == [(2, "source", "deleted"), (2, "target", "deleted"), (3, "source", "late"), (4, "source", "missing")] + [(5, "source", "missing")] * 2 + [(5, "target", "missing")] * 2
    assert P.orphans(rel.limit(0), tables).count() == 0


def test_hot_key_is_salted(spark):
    k = "aaaaaaaa-bbbb-4ccc-8ddd-eeeeeeeeeeee"
    actors = spark.createDataFrame([(k,)], "id string").withColumn("loaded_at", F.to_timestamp_ntz(F.lit("2020-01-01"))).withColumn("deleted_at", F.lit(None).cast("timestamp_ntz"))
    tables = {t: (actors if t == "actors" else actors.limit(0)) for t in P.PARENT_TABLES.values()}
    rel = spark.range(3000).select(
        F.col("id").alias("rel_id"), F.lit(k).alias("source"), F.lit("Actor").alias("source_type"), F.lit(k).alias("target"), F.lit("Event").alias("target_type"), F.to_timestamp_ntz(F.lit("2020-02-01")).alias("created_at")
    )
    out = P.orphans(rel, tables)
    assert out.groupBy("side", "reason").count().collect() == [("target", "missing", 3000)]


def test_docx_reader(spark):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    doc = f'<w:document {w}><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>Top</w:t></w:r></w:p><w:p><w:r><w:t>a</w:t><w:tab/><w:t>b</w:t></w:r></w:p></w:body></w:document>'
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("word/document.xml", doc)
    files = spark.createDataFrame([("x.docx", bytearray(buf.getvalue())), ("y.doc", bytearray(b"old"))], "path string, content binary")
    got = readers.read_docx(files).orderBy("source", "pos").collect()
    assert [(r.source, r.style, r.text) for r in got[:2]] == [("x.docx", "Heading1", "Top"), ("x.docx", None, "a\tb")] and got[2].error
    assert readers.read_pdf(files).where("error IS NOT NULL").count() == 2


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "list.json").write_text(json.dumps([{"text": "a", "metadata": {"section_title": "s"}}, {"text": "b"}]))
    (tmp_path / "obj.json").write_text(json.dumps({"chunks": [{"text": "c"}]}))
    (tmp_path / "bad.json").write_text("{nope")
    assert [(r.chunk_ix, r.text) for r in readers.read_chunks(spark, str(tmp_path / "list.json")).orderBy("chunk_ix").collect()] == [(0, "a"), (1, "b")]
    assert readers.read_chunks(spark, str(tmp_path / "obj.json")).first().text == "c"
    assert readers.read_chunks(spark, str(tmp_path / "bad.json")).count() == 0
    (tmp_path / "graph.json").write_text(json.dumps({"events": [{"id": "1", "title": 'say "hi"', "year": 2000}], "relationships": []}))
    g = readers.read_graph(spark, str(tmp_path / "graph.json"))
    assert g["event"].first().title == 'say "hi"' and g["actor"].count() == 0
    assert sinks.write_csv(g["event"], "event", str(tmp_path / "csv")) and not sinks.write_csv(g["actor"], "actor", str(tmp_path / "none"))
    assert spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv")).first().Title == 'say "hi"'
    (tmp_path / "tasks.json").write_text(json.dumps({"review_tasks": [{"task_id": "t"}]}))
    assert readers.read_tasks(spark, str(tmp_path / "tasks.json")).first().task_id == "t"
    p = str(tmp_path / "table")
    spark.range(3).write.parquet(p)
    sinks.replace_table(spark.read.parquet(p).where("id > 0"), p)
    assert spark.read.parquet(p).count() == 2


def test_snapshot_stream(spark, tmp_path):
    src = tmp_path / "in"
    for i in range(2):
        spark.createDataFrame([(i, f"n{i % 1}")], "ord int, name string").coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema("ord int, name string").option("maxFilesPerTrigger", 1).parquet(str(src))
    q = snapshot_stream(stream, lambda b: b, lambda r: R.resolve_entities(r, ["name"], "ord"), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out" / "snapshot_1")).first().n_merged == 2


def test_entry_without_llm(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"chunk_stats", "p6_found"} <= names and set(entry.oracle_sql()) <= names


def test_malformed_references_leave_partitions_even(spark):
    """Half of all references are no keys and a third name one record: the first need no join, the other is dealt over blocks."""
    key = "0" * 31 + "1"
    rows = [(i, "junk" if i % 2 else f"{i:032x}", "Actor", key if i % 3 else None, "actors ", "2024-01-01 00:00:00") for i in range(4000)]
    rel = spark.createDataFrame(rows, "rel_id bigint, source string, source_type string, target string, target_type string, created_at string").withColumn("created_at", F.to_timestamp_ntz("created_at"))
    actors = spark.createDataFrame([(key.upper(), None, None)], "id string, loaded_at timestamp_ntz, deleted_at timestamp_ntz")
    out = P.orphans(rel, {"actors": actors}, least=50)
    assert out.where("side = 'source'").count() == 4000 and out.where("side = 'target'").count() == 0
    # the malformed half is in no join, and the hot key is dealt over blocks
    joined = out._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count("Join LeftOuter") == 3 and "salt" in joined
