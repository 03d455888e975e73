"""JSON Schema over VARIANT: keywords, nested items, references, kinds of records."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialoom.operators import annotation, validation

TURN = {
    "type": "object", "required": ["i", "role"], "additionalProperties": False,
    "properties": {
        "i": {"type": "integer", "minimum": 0}, "role": {"enum": ["a", "b", 3]}, "at": {"type": "string", "format": "date-time"},
        "tags": {"type": "array", "uniqueItems": True, "items": {"type": "string"}},
    },
}
SCHEMA = {
    "type": "object", "additionalProperties": False, "required": ["id", "turns", "k"],
    "properties": {
        "record_type": {"const": "x"}, "id": {"type": "string", "minLength": 1}, "k": {"type": ["integer", "null"], "minimum": 0}, "odd key": {"type": "number"},
        "turns": {"type": "array", "minItems": 1, "items": TURN}, "tree": {"$ref": "#/$defs/t"}, "either": {"oneOf": [{"type": "string"}, {"type": "integer"}, {"minimum": 3}]},
        "extra": {"type": "object", "additionalProperties": {"type": "boolean"}}, "never": {"not": {"const": 1}}, "some": {"anyOf": [{"type": "null"}, {"exclusiveMinimum": 1, "type": "number"}]},
        "short": {"maxLength": 2, "pattern": "^q"}, "few": {"maxItems": 1, "allOf": [{"type": "array"}]}, "low": {"exclusiveMaximum": 5, "maximum": 9},
    },
    "$defs": {"t": {"type": "object", "properties": {"l": {"$ref": "#/$defs/t"}, "v": {"type": "integer", "maximum": 9}}}},
}
CASES = {
    '{"record_type":"x","id":"q","k":1,"turns":[{"i":0,"role":"a"}],"some":null,"short":"qq","few":[1],"low":4.5,"odd key":1e3}': [],
    '{"record_type":"x","id":"","k":null,"turns":[]}': ["$.id minLength", "$.turns minItems"],
    '{"record_type":"x","id":5,"k":1.5,"turns":[{"i":-1,"role":"c","z":1,"y":2},{"role":3,"tags":["a","a",1],"at":"x"},7]}': [
        "$.id type", "$.k type", "$.turns[0] additionalProperties y,z", "$.turns[0].i minimum", "$.turns[0].role enum", "$.turns[1] required i", "$.turns[1].tags uniqueItems", "$.turns[1].tags[2] type", "$.turns[2] type"],
    '{"record_type":"x","id":"1","k":true,"turns":{},"odd key":"s","tree":{"v":10,"l":{"v":"a","l":{"v":11}}},"either":5,"extra":{"a":true,"b":1},"never":1,"some":1,"short":"abc","few":[1,2],"low":5}': [
        "$.either oneOf", "$.extra.b type", "$.few maxItems", "$.k type", "$.low exclusiveMaximum", "$.never not", "$.short maxLength", "$.short pattern", "$.some anyOf", "$.tree.l.l.v maximum", "$.tree.l.v type", "$.tree.v maximum", "$.turns type", "$['odd key'] type"],
    '{"record_type":"x","id":null,"k":2.0,"turns":null,"more":1}': ["$ additionalProperties more", "$.id type", "$.turns type"],
    '{"record_type":"x"}': ["$ required id", "$ required k", "$ required turns"],
    '{"record_type":"other"}': [], "[1]": [], "{bad": [], "": [], None: [],
}


def shown(i):
    return " ".join(x for x in (i.path, i.keyword, i.detail) if x)


def test_keywords(spark):
    df = spark.createDataFrame([(t, "column that stays") for t in CASES], "raw string, schema_issues_2 string")
    got = {r.raw: sorted(map(shown, r.schema_issues)) for r in validation.validated(df, "raw", {"x": SCHEMA}).collect()}
    assert got == CASES
    dated = validation.validated(df.filter("raw like '%\"at\"%'"), "raw", {"x": SCHEMA}, formats=True).first()
    assert "$.turns[1].at format" in map(shown, dated.schema_issues)
    assert validation.validated(df.limit(0), "raw", {"x": SCHEMA}).count() == 0


def test_references_with_more_beside_them(spark):
    schema = {"$defs": {"code": {"type": "string", "pattern": "^[a-z]+$"}}, "properties": {"c": {"$ref": "#/$defs/code", "enum": ["de", "EN"]}}}
    df = spark.createDataFrame([('{"c":"EN"}',), ('{"c":"fr"}',), ('{"c":"de"}',)], "raw string")
    got = {r.raw: [x.keyword for x in r.i] for r in df.select("raw", validation.issues(schema, F.parse_json("raw"), F.lit("$")).alias("i")).collect()}
    assert got == {'{"c":"EN"}': ["pattern"], '{"c":"fr"}': ["enum"], '{"c":"de"}': []}


def test_schemas_of_annotation_records(spark, tmp_path):
    (tmp_path / "style_label.schema.json").write_text('{"type":"object","required":["label_id"],"properties":{"evidence":{"type":"array","items":{"type":"string","minLength":1}}}}')
    schemas = validation.load_local(str(tmp_path))
    assert schemas == validation.load(spark, f"{tmp_path}/*.json")
    lines = spark.createDataFrame([("f", 1, '{"record_type":"style_label","evidence":["x",""]}'), ("f", 2, '{"record_type":"style_label","label_id":"a","evidence":["x"]}'), ("g", 1, "{")], "file string, line long, raw string")
    got = sorted((r.file, r.line, r.code, r.path) for r in annotation.issues(lines, schemas=schemas).collect())
    assert got == [("f", 1, "schema_validation_error", "$"), ("f", 1, "schema_validation_error", "$.evidence[1]"), ("g", 0, "json_load_error", "$")]
