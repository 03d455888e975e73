"""JSON Schema over records that are parsed once into VARIANT.

A schema becomes one expression: properties are read by path from the parsed
value, items of arrays by a transform over its elements, so nested records of
any depth the schema states are checked in the row, without a second parse, a
join or a shuffle.

Known keywords: type (also a list of types), required, properties,
additionalProperties (false or a schema), items, minItems, maxItems,
uniqueItems, enum, const, minimum, maximum, exclusiveMinimum, exclusiveMaximum,
minLength, maxLength, pattern, allOf, anyOf, oneOf, not, $ref into $defs, and
format date-time where ``formats`` is set; others are passed over, as are
keywords that do not apply to a value's type.  Issues carry the path of the
value that fails, the keyword, and for required and additionalProperties, which
fail at the object, the names; messages are not those of any validator.  A
reference that leads to itself is followed ``DEPTH`` times.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ISSUE = "array<struct<path:string,keyword:string,detail:string>>"
DEPTH = 6
NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
INSTANT = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"


def load(spark: SparkSession, pattern: str) -> dict[str, dict]:
    """Schemas by file name, without ``.schema.json`` or ``.json``; schema files are small and bounded in number."""
    rows = spark.read.text(pattern, wholetext=True).select("value", F.col("_metadata.file_name").alias("name")).collect()
    return {re.sub(r"(\.schema)?\.json$", "", r.name): json.loads(r.value) for r in rows}


def load_local(folder: str) -> dict[str, dict]:
    return {re.sub(r"(\.schema)?\.json$", "", p.name): json.loads(p.read_text()) for p in sorted(Path(folder).glob("*.json"))}


def kind_of(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, BOOLEAN, VOID (a JSON null) or the name of a kind of number."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _as(v: Column, kind: str) -> Column:
    return F.try_variant_get(v, "$", kind)


def _step(name: str) -> str:
    return f".{name}" if re.fullmatch(r"[A-Za-z_][A-Za-z_0-9]*", name) else f"['{name}']"


def _issue(path: Column, keyword: str, detail: Column | None = None) -> Column:
    return F.struct(path.alias("path"), F.lit(keyword).alias("keyword"), (F.lit(None).cast("string") if detail is None else detail).alias("detail"))


def _canonical(value: object) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"), sort_keys=True)


def _is(v: Column, kind: Column, name: str) -> Column:
    number = kind.isin(*NUMBERS)
    return {
        "object": kind == "OBJECT", "array": kind == "ARRAY", "string": kind == "STRING", "boolean": kind == "BOOLEAN", "null": kind == "VOID", "number": number,
        "integer": number & F.coalesce(_as(v, "double") % 1 == 0, F.lit(False)),
    }[name]


def issues(schema: dict, v: Column, path: Column, root: dict | None = None, formats: bool = False, depth: int = DEPTH) -> Column:
    """(path, keyword, detail) of all that is wrong with the variant ``v``, which is at ``path``."""
    root = schema if root is None else root
    below = lambda s, x, p, d=depth: issues(s, x, p, root, formats, d)
    none = F.array().cast(ISSUE)
    if "$ref" in schema:
        target = reduce(lambda at, key: at[key], schema["$ref"].removeprefix("#/").split("/"), root)
        rest = {k: x for k, x in schema.items() if k != "$ref"}
        return F.concat(below(target, v, path, depth - 1) if depth else none, below(rest, v, path) if rest else none)
    kind, text, number, listed = kind_of(v), _as(v, "string"), _as(v, "double"), _as(v, "array<variant>")
    is_text, is_number, is_list, is_object = kind == "STRING", kind.isin(*NUMBERS), kind == "ARRAY", kind == "OBJECT"
    types = lambda k: [k] if isinstance(k, str) else k
    checks: dict[str, Callable[[object], Column]] = {
        "type": lambda k: ~reduce(Column.__or__, [_is(v, kind, t) for t in types(k)]),
        "enum": lambda k: ~F.to_json(v).isin([_canonical(x) for x in k]),
        "const": lambda k: F.to_json(v) != _canonical(k),
        "minimum": lambda k: is_number & (number < k), "maximum": lambda k: is_number & (number > k),
        "exclusiveMinimum": lambda k: is_number & (number <= k), "exclusiveMaximum": lambda k: is_number & (number >= k),
        "minLength": lambda k: is_text & (F.length(text) < k), "maxLength": lambda k: is_text & (F.length(text) > k), "pattern": lambda k: is_text & ~text.rlike(k),
        "minItems": lambda k: is_list & (F.size(listed) < k), "maxItems": lambda k: is_list & (F.size(listed) > k),
        "uniqueItems": lambda k: is_list & (F.size(F.array_distinct(F.transform(listed, lambda x: F.to_json(x)))) < F.size(listed)) if k else F.lit(False),
        "format": lambda k: is_text & ~text.rlike(INSTANT) if formats and k == "date-time" else F.lit(False),
    }
    made = [F.when(F.coalesce(check(schema[name]), F.lit(False)), _issue(path, name)) for name, check in checks.items() if name in schema]
    known = schema.get("properties", {})
    child = {name: F.try_variant_get(v, f"${_step(name)}", "variant") for name in {*known, *schema.get("required", [])}}
    for name in schema.get("required", []):
        made.append(F.when(is_object & child[name].isNull(), _issue(path, "required", F.lit(name))))
    out = [F.array_compact(F.array(*made)).cast(ISSUE)] if made else []
    for name, own in known.items():
        out.append(F.when(child[name].isNotNull(), below(own, child[name], F.concat(path, F.lit(_step(name))))).otherwise(none))
    more = schema.get("additionalProperties", True)
    if more is not True:
        members = F.map_filter(_as(v, "map<string,variant>"), lambda k, _: ~F.array_contains(F.array(*[F.lit(x) for x in known]).cast("array<string>"), k))
        if more is False:
            names = F.array_join(F.array_sort(F.map_keys(members)), ",")
            wrong = F.when(F.size(members) > 0, F.array(_issue(path, "additionalProperties", names))).otherwise(none)
        else:
            wrong = F.flatten(F.transform(F.map_entries(members), lambda e: below(more, e.value, F.concat(path, F.lit("."), e.key))))
        out.append(F.when(is_object, wrong).otherwise(none))
    if isinstance(schema.get("items"), dict):
        each = F.transform(listed, lambda x, i: below(schema["items"], x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        out.append(F.when(is_list, F.flatten(each)).otherwise(none))
    out += [below(one, v, path) for one in schema.get("allOf", [])]
    holds = lambda s: (F.size(below(s, v, path)) == 0).cast("int")
    count = lambda name: reduce(Column.__add__, [holds(s) for s in schema[name]])
    fails = {"anyOf": lambda: count("anyOf") == 0, "oneOf": lambda: count("oneOf") != 1, "not": lambda: holds(schema["not"]) == 1}
    wrong = [F.when(when(), _issue(path, name)) for name, when in fails.items() if name in schema]
    if wrong:
        out.append(F.array_compact(F.array(*wrong)).cast(ISSUE))
    return F.concat(*out) if out else none


def validated(records: DataFrame, raw: str, schemas: dict[str, dict], kind: str = "record_type", formats: bool = False, column: str = "schema_issues") -> DataFrame:
    """``records`` with ``column``: the issues of the JSON text ``raw`` under the schema that its field ``kind`` names.

    Text that is no JSON, that is no object, or of a kind without a schema has an empty list.
    """
    parsed = records.withColumn("__parsed", F.try_parse_json(raw)).withColumn("__kind", F.try_variant_get("__parsed", f"$.{kind}", "string"))
    found = F.array().cast(ISSUE)
    for name, schema in schemas.items():
        found = F.when(F.col("__kind") == name, issues(schema, F.col("__parsed"), F.lit("$"), formats=formats)).otherwise(found)
    return parsed.withColumn(column, F.coalesce(found, F.array().cast(ISSUE))).drop("__parsed", "__kind")
