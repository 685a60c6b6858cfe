"""Drivers over an offline model, rules on JSON records and schemas with nested objects."""

import json

from graphloom.operators import pipeline as P
from graphloom.operators import validate as W
from graphloom.plans import pipeline as plans


def test_schema_with_nested_rules(spark, tmp_path):
    schema = {
        "required": ["name"], "additionalProperties": False,
        "properties": {
            "name": {"type": "string"}, "size": {"type": "number"},
            "place": {"type": "object", "required": ["type"], "additionalProperties": False, "properties": {"type": {"enum": ["Point"]}}},
            "links": {"type": "array", "items": {"type": "object", "required": ["url"]}},
        },
    }
    (tmp_path / "thing.json").write_text(json.dumps(schema))
    rules = W.load_rules(str(tmp_path), records=True)["thing"]
    rows = [
        (1, '{"name": "a", "size": 1.5, "place": {"type": "Point"}, "links": [{"url": "u"}]}'), (2, '{"size": "1"}'), (3, '{"name": "a", "other": 1, "place": {"x": 1}}'),
        (4, '{"name": "a", "place": {"type": "Line"}, "links": [{"url": "u"}, {}]}'), (5, None), (6, "3"), (7, '{"name": null}'),
    ]
    got = {(r.id, r.field, r.rule) for r in W.json_errors(spark.createDataFrame(rows, "id int, record string"), rules).collect()}
    assert got == {
        (2, "name", "required"), (2, "size", "type"), (3, "", "keys"), (3, "place", "nested_required"), (3, "place", "keys"),
        (4, "place.type", "enum"), (4, "links", "items_required"), (6, "", "type"), (7, "name", "required"),
    }
    assert W.json_errors(spark.createDataFrame([], "id int, record string"), rules).count() == 0


def test_extraction_of_nothing_and_of_failures(spark):
    empty = spark.createDataFrame([], "chunk_id bigint, text string")
    g = P.extract_graph(empty, plans._extractor, ("event", "actor"))
    assert g["nodes"].count() == g["edges"].count() == g["failures"].count() == 0

    def broken():
        def ask(prompt):
            raise RuntimeError("no model")

        return ask

    g = P.extract_graph(spark.createDataFrame([(1, "a text"), (2, None), (3, "")], "chunk_id bigint, text string"), broken, ("event",))
    assert g["nodes"].count() == 0 and {(r.chunk_id, r.answer) for r in g["failures"].collect()} == {(1, "no model"), (3, "no model")}


def test_critic_of_unknown_ends(spark):
    ents = spark.createDataFrame([("a", "actor", "Ann", 1, 1, False), ("b", "actor", "Auto", 1, 2, True)], "id string, kind string, name string, source_chunk bigint, ord bigint, auto_created_from_relationship boolean")
    edges = spark.createDataFrame([(7, "a", "zz", "Funds", None, 1)], "edge_id bigint, source_id string, target_id string, relationship_type string, source_chunk bigint, ord bigint")
    chunks = spark.createDataFrame([(None, 1, "some text")], "chunk_ix int, chunk_id bigint, text string")
    got = {(r.item_kind, r.item_id): (r.overall_confidence, r.failed) for r in P.critique(ents, edges, chunks, plans._critic).collect()}
    assert got == {("entity", "a"): (4.0, False), ("relationship", "7"): (1.0, False)}
