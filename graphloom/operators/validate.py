"""Validation: rule rows from schemas, checks as columns, referential integrity, uniqueness and roll-ups."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import singular

#: fixed values: patterns of formats
FORMATS = {
    "uuid": r"(?i)^(?:urn:uuid:)?[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}$",
    "email": r"^[^@\s]+@[^@\s]+\.[^@\s]+$",
    "uri": r"^[a-zA-Z][a-zA-Z0-9+.-]*:[^\s]+$",
    "date": r"^\d{4}-\d{2}-\d{2}$",
    "date-time": r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:?\d{2})$",
}
#: fixed values: allowed words
EVENT_TYPES = ("Publication", "Conference", "Policy", "Research", "Movement", "Organization", "Other")
ACTOR_TYPES = ("Individual", "Institution", "Government", "NGO", "Coalition", "Other")
LOCATION_TYPES = ("City", "Country", "Region", "Virtual", "Natural", "Institution", "Other")
ENDPOINT_TYPES = ("Event", "Actor", "Location", "Concept", "Publication")
RELATIONSHIP_TYPES = (
    "Influences", "IsInfluencedBy", "Precedes", "Follows", "References", "IsReferencedBy", "Participates", "Develops", "IsLocatedIn", "Contains",
    "Publishes", "IsPublishedBy", "Advocates", "Criticizes", "Collaborates", "Funds", "IsFundedBy", "Implements", "IsImplementedBy", "Builds",
    "IsBuiltOn", "Extends", "IsExtendedBy", "Other",
)
DOMAINS = (
    "Ecology", "PublicHealth", "Medicine", "EnvironmentalScience", "SocialScience", "Policy", "Economics", "Ethics", "Sustainability",
    "ClimateScience", "Biodiversity", "OneHealth", "PlanetaryBoundaries", "Other",
)
PUBLICATION_TYPES = (
    "Journal Article", "Book", "Book Chapter", "Conference Paper", "Report", "Policy Brief", "White Paper", "Thesis", "Preprint", "Commentary", "Review", "Editorial", "Other",
)


@dataclass(frozen=True)
class Rule:
    """One check of a field.

    ``kind`` is required, enum, items_enum, range, max_length, pattern, format or
    items; on JSON records also type, nested_required (keys of an object),
    items_required (keys of every object of a list) and keys (the allowed keys of
    the field, of the record where the field is empty).
    """

    field: str
    kind: str
    arg: object = None


RULES: dict[str, tuple[Rule, ...]] = {
    "event": (
        *(Rule(f, "required") for f in ("id", "year", "title", "description")),
        Rule("id", "format", "uuid"), Rule("year", "range", (1800, 2100)), Rule("title", "max_length", 100), Rule("significance", "range", (1, 5)),
        Rule("type", "enum", EVENT_TYPES), Rule("start_date", "format", "date"), Rule("end_date", "format", "date"),
    ),
    "actor": (
        *(Rule(f, "required") for f in ("id", "name", "type")),
        Rule("id", "format", "uuid"), Rule("type", "enum", ACTOR_TYPES), Rule("country", "pattern", r"^[A-Z]{2}$"), Rule("website", "format", "uri"),
        Rule("orcid", "pattern", r"^\d{4}-\d{4}-\d{4}-\d{3}[0-9X]$"), Rule("email", "format", "email"), Rule("start_date", "format", "date"),
    ),
    "location": (
        *(Rule(f, "required") for f in ("id", "name", "type")),
        Rule("id", "format", "uuid"), Rule("type", "enum", LOCATION_TYPES), Rule("country", "pattern", r"^[A-Z]{2}$"), Rule("population", "range", (0, None)),
        Rule("area", "range", (0, None)), Rule("coordinates", "items", (2, 2)),
    ),
    "concept": (
        *(Rule(f, "required") for f in ("id", "name", "definition")),
        Rule("id", "format", "uuid"), Rule("domain", "items_enum", DOMAINS), Rule("significance", "range", (1, 5)),
    ),
    "publication": (
        *(Rule(f, "required") for f in ("id", "title", "year")),
        Rule("id", "format", "uuid"), Rule("type", "enum", PUBLICATION_TYPES), Rule("significance", "range", (1, 5)), Rule("citation_count", "range", (0, None)), Rule("url", "format", "uri"),
    ),
    "relationship": (
        *(Rule(f, "required") for f in ("id", "source_id", "source_type", "target_id", "target_type", "relationship_type")),
        Rule("id", "format", "uuid"), Rule("source_type", "enum", ENDPOINT_TYPES), Rule("target_type", "enum", ENDPOINT_TYPES),
        Rule("relationship_type", "enum", RELATIONSHIP_TYPES), Rule("strength", "range", (1, 5)), Rule("confidence", "range", (0, 1)), Rule("created_at", "format", "date-time"),
    ),
}


def fails(rule: Rule, c: Column, dtype: str) -> Column:
    """True where a present value breaks the rule (absent values only break 'required')."""
    if rule.kind == "required":
        return c.isNull()
    if rule.kind == "enum":
        bad = ~c.isin(*rule.arg)
    elif rule.kind == "items_enum":
        bad = F.exists(c, lambda x: ~x.isin(*rule.arg))
    elif rule.kind == "range":
        lo, hi = rule.arg
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (c < lo)
        if hi is not None:
            bad = bad | (c > hi)
    elif rule.kind == "max_length":
        bad = F.char_length(c) > rule.arg
    elif rule.kind == "pattern":
        bad = ~c.rlike(rule.arg)
    elif rule.kind == "format":
        bad = ~c.cast("string").rlike(FORMATS[rule.arg])
        if rule.arg == "date":
            bad = bad | F.try_to_date(c.cast("string")).isNull()
    elif rule.kind == "items":
        lo, hi = rule.arg
        bad = ~F.size(c).between(lo, hi)
    else:
        raise ValueError(f"unknown rule {rule.kind}")
    return c.isNotNull() & F.coalesce(bad, F.lit(False))


def errors(rows: DataFrame, kind: str, rules: tuple[Rule, ...] | None = None, key: str = "id") -> DataFrame:
    """(key, field, rule) of every broken rule; all rules are checked in one pass over the rows.

    Rules on columns that the rows lack count as absent values.
    """
    rules = RULES[kind] if rules is None else rules
    types = dict(rows.dtypes)
    found = []
    for r in rules:
        if r.field not in types:
            if r.kind != "required":
                continue
            bad = F.lit(True)
        else:
            bad = fails(r, F.col(r.field), types[r.field])
        found.append(F.when(bad, F.struct(F.lit(r.field).alias("field"), F.lit(r.kind).alias("rule"))))
    return rows.select(F.col(key), F.explode(F.array_compact(F.array(*found))).alias("e")).select(key, "e.field", "e.rule")


def collection_counts(rows: DataFrame, kind: str, key: str) -> DataFrame:
    """One row: kind, total, valid, invalid."""
    bad = errors(rows, kind, key=key).select(key).distinct()
    return rows.select(key).join(bad.withColumn("_bad", F.lit(True)), key, "left").agg(
        F.lit(kind).alias("kind"), F.count("*").alias("total"), F.count_if(F.col("_bad").isNull()).alias("valid"), F.count_if(F.col("_bad")).alias("invalid")
    )


def dataset_counts(collections: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Counts per collection and in all ('(all)'); plural collection names are read as their singular kinds."""
    out = None
    for name, (rows, key) in collections.items():
        kind = name[:-1] if name.endswith("s") and name[:-1] in RULES else name
        if kind not in RULES:
            part = rows.agg(F.lit(name).alias("kind"), F.count("*").alias("total"), F.lit(0).cast("bigint").alias("valid"), F.count("*").alias("invalid"))
        else:
            part = collection_counts(rows, kind, key)
        out = part if out is None else out.unionByName(part)
    total = out.agg(F.lit("(all)").alias("kind"), F.sum("total").alias("total"), F.sum("valid").alias("valid"), F.sum("invalid").alias("invalid"))
    return out.unionByName(total)


def unknown_kinds(rows: DataFrame, kind: str = "kind") -> DataFrame:
    """Rows whose kind has no schema; plural kinds are known by their singular."""
    return rows.where(~F.lower(singular(F.lower(F.col(kind)))).isin(*RULES) & ~F.lower(F.col(kind)).isin(*RULES))


def uniqueness(rows: DataFrame, column: str) -> DataFrame:
    """(value, n) of values held by more than one row; nulls are not compared."""
    return rows.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n")).where("n > 1")


def not_null(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(field, n) of null values, zero included, in one pass."""
    counts = rows.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("n")) for c in columns))).alias("x")).select("x.field", "x.n")


def unknown_keys(rows: DataFrame, json_column: str, allowed: tuple[str, ...], key: str) -> DataFrame:
    """(key, extra) of keys of a JSON object that the schema does not allow."""
    extra = F.array_except(F.json_object_keys(F.col(json_column)), F.array(*(F.lit(a) for a in allowed)))
    return rows.select(F.col(key), F.explode(extra).alias("extra"))


#: JSON type -> types that a parsed value of it may have
JSON_TYPES = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DECIMAL|DOUBLE|FLOAT", "boolean": "BOOLEAN", "array": "ARRAY", "object": "OBJECT"}
#: what must stand in the data-entry form of an event, where the type is required too
FORM_RULES = tuple(Rule(f, "required") for f in ("title", "year", "type", "description"))


def json_fails(rule: Rule, record: Column) -> Column:
    """True where a JSON record (text) breaks the rule; absent and null fields only break 'required'."""
    path = f"$.{rule.field}" if rule.field else "$"
    raw = F.get_json_object(record, path)
    if rule.kind == "type":
        kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(record), path, "variant"))
        # a number without a fraction is an integer
        whole = (kind.startswith("DECIMAL") & raw.try_cast("double").eqNullSafe(F.floor(raw.try_cast("double")))) if rule.arg == "integer" else F.lit(False)
        return raw.isNotNull() & F.coalesce(~(kind.rlike(f"^({JSON_TYPES[rule.arg]})") | whole), F.lit(False))
    if rule.kind in ("nested_required", "keys"):
        keys = F.json_object_keys(raw)
        want = F.array(*(F.lit(k) for k in rule.arg))
        missing = F.array_except(want, keys) if rule.kind == "nested_required" else F.array_except(keys, want)
        return F.coalesce(F.size(missing) > 0, F.lit(False))
    if rule.kind == "items_required":
        items = F.from_json(raw, "array<map<string,string>>")
        return F.coalesce(F.exists(items, lambda x: F.size(F.array_except(F.array(*(F.lit(k) for k in rule.arg)), F.map_keys(x))) > 0), F.lit(False))
    if rule.kind in ("items", "items_enum"):
        return fails(rule, F.from_json(raw, "array<string>"), "array<string>")
    return fails(rule, raw.try_cast("double") if rule.kind == "range" else raw, "string")


def json_errors(rows: DataFrame, rules: tuple[Rule, ...], record: str = "record", key: str = "id") -> DataFrame:
    """(key, field, rule) of every rule that a JSON record breaks; a text that is no JSON object breaks ('', 'type'). Null records are left out."""
    no_object = ~F.coalesce(F.schema_of_variant(F.try_parse_json(F.col(record))).startswith("OBJECT"), F.lit(False))
    found = [F.when(no_object, F.struct(F.lit("").alias("field"), F.lit("type").alias("rule")))]
    found += [F.when(~no_object & json_fails(r, F.col(record)), F.struct(F.lit(r.field).alias("field"), F.lit(r.kind).alias("rule"))) for r in rules]
    # outer, as the filter that is inferred for a plain explode would run every check twice
    out = rows.where(F.col(record).isNotNull()).select(F.col(key), F.explode_outer(F.array_compact(F.array(*found))).alias("e"))
    return out.where("e IS NOT NULL").select(key, "e.field", "e.rule")


#: rules that only JSON records can break
JSON_ONLY = ("type", "nested_required", "items_required", "keys")


def load_rules(folder: str, records: bool = False) -> dict[str, tuple[Rule, ...]]:
    """Rules read from a folder of JSON schemas, by file name.

    With ``records`` the rules of JSON records: types, allowed keys, nested objects
    and lists of objects too. Without, those of typed columns.
    """
    out = {}
    for p in sorted(Path(folder).glob("*.json")):
        schema = json.loads(p.read_text(encoding="utf-8"))
        out[p.stem] = tuple(r for r in _rules_of(schema) if records or (r.kind not in JSON_ONLY and "." not in r.field))
    return out


def _rules_of(schema: dict) -> list[Rule]:
    rules = [Rule(f, "required") for f in schema.get("required", [])]
    if schema.get("additionalProperties") is False:
        rules.append(Rule("", "keys", tuple(schema.get("properties", {}))))
    for f, s in schema.get("properties", {}).items():
        items = s.get("items", {})
        if s.get("type") in JSON_TYPES:
            rules.append(Rule(f, "type", s["type"]))
        if "enum" in s:
            rules.append(Rule(f, "enum", tuple(s["enum"])))
        if "enum" in items:
            rules.append(Rule(f, "items_enum", tuple(items["enum"])))
        if "minItems" in s or "maxItems" in s:
            rules.append(Rule(f, "items", (s.get("minItems", 0), s.get("maxItems", 2**31 - 1))))
        if "minimum" in s or "maximum" in s:
            rules.append(Rule(f, "range", (s.get("minimum"), s.get("maximum"))))
        if "maxLength" in s:
            rules.append(Rule(f, "max_length", s["maxLength"]))
        if "pattern" in s:
            rules.append(Rule(f, "pattern", s["pattern"]))
        if s.get("format") in FORMATS:
            rules.append(Rule(f, "format", s["format"]))
        if s.get("type") == "object" and s.get("required"):
            rules.append(Rule(f, "nested_required", tuple(s["required"])))
        if s.get("type") == "object" and s.get("additionalProperties") is False:
            rules.append(Rule(f, "keys", tuple(s.get("properties", {}))))
        if items.get("type") == "object" and items.get("required"):
            rules.append(Rule(f, "items_required", tuple(items["required"])))
        # the fields of a nested object, by their path
        if s.get("type") == "object":
            nested = {"properties": {f"{f}.{k}": v for k, v in s.get("properties", {}).items()}}
            rules += _rules_of(nested)
    return rules
