"""Sidecars: assembly to JSON and validation of JSON of any shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.operators import rules

FIELDS = {"schemaVersion": "int", "title": "str", "source": "str", "addedAt": "str", "sourceFormat": "str", "pageCount": "int", "kind": "str", "units": "list"}
UNIT_FIELDS = {"type": "str", "label": "str", "path": "list", "text": "str", "page": "int"}


def sidecar_json(sidecars: DataFrame, units: DataFrame) -> DataFrame:
    """(doc, json): header and units of each document in the order of the schema; absent values are left out.

    Both frames hold each document and each unit once.
    """
    box = F.when(F.size("bbox") == 4, F.col("bbox"))
    ocr = F.when(F.col("ocr"), F.lit(True))
    unit = F.struct("type", F.coalesce("label", F.lit("")).alias("label"), "path", "text", "page", box.alias("bbox"), ocr.alias("ocr"))
    listed = units.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("unit_no", unit.alias("unit")))).alias("_units"))
    rows = sidecars.join(listed, "doc")
    header = F.struct(
        F.col("schemaversion").alias("schemaVersion"), F.coalesce("title", F.lit("")).alias("title"), "source", F.col("addedat").alias("addedAt"),
        F.col("sourceformat").alias("sourceFormat"), F.col("pagecount").alias("pageCount"), "kind", F.transform("_units", lambda x: x["unit"]).alias("units"),
    )
    return rows.select("doc", F.to_json(header).alias("json"))


def _kind(v: Column) -> Column:
    """Kind of a variant value in the terms of the contract."""
    s = F.schema_of_variant(v)
    return F.when(s == "BIGINT", "int").when(s == "STRING", "str").when(s == "BOOLEAN", "bool").when(s.startswith("ARRAY"), "list").when(s == "VOID", "null").when(s.startswith("OBJECT"), "object").otherwise("number")


def _field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def _text(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "string")


def _messages(*checks: tuple[Column, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(wrong, F.lit(False)), message) for wrong, message in checks]))


def validation_errors(df: DataFrame, json: str = "json") -> DataFrame:
    """df with `errors`: what is wrong with each sidecar, empty if it is valid.

    Fields of the header are checked first; if their shape is broken nothing else is. A
    boolean is no number, and 1.0 is no integer. Text that is no JSON object has one error.
    """
    rows = df.withColumn("_v", F.try_parse_json(F.col(json)))
    v = F.col("_v")
    shape = []
    for name, kind in FIELDS.items():
        field = _field(v, name)
        shape.append((field.isNull(), F.lit(f"missing field: {name}")))
        shape.append((field.isNotNull() & (_kind(field) != kind), F.lit(f"field {name} wrong type: expected {kind}")))
    rows = rows.withColumn("_shape", F.when(v.isNull() | (_kind(v) != "object"), F.array(F.lit("not an object"))).otherwise(_messages(*shape)))

    def one_of(name: str, allowed: tuple[str, ...]) -> tuple[Column, Column]:
        return ~_text(v, name).isin(*allowed), F.concat(F.lit(f"{name} invalid: "), _text(v, name))

    count = F.try_variant_get(v, "$.pageCount", "bigint")
    deep = _messages(
        (F.try_variant_get(v, "$.schemaVersion", "bigint") != rules.SCHEMA_VERSION, F.lit(f"schemaVersion must be {rules.SCHEMA_VERSION}")),
        one_of("source", rules.SOURCES),
        one_of("sourceFormat", rules.SOURCE_FORMATS),
        one_of("kind", rules.KINDS),
        (count < 1, F.lit("pageCount must be >= 1")),
        (F.size(F.try_variant_get(v, "$.units", "array<variant>")) == 0, F.lit("units must not be empty")),
    )
    rows = rows.withColumn("_units", F.try_variant_get(v, "$.units", "array<variant>"))

    def unit_errors(u: Column, i: Column) -> Column:
        where = F.concat(F.lit("units["), i.cast("string"), F.lit("]"))
        checks = []
        for name, kind in UNIT_FIELDS.items():
            field = _field(u, name)
            checks.append((field.isNull(), F.concat(where, F.lit(f" missing {name}"))))
            checks.append((field.isNotNull() & (_kind(field) != kind), F.concat(where, F.lit(f" {name} wrong type"))))
        checks.append((~F.coalesce(_text(u, "type"), F.lit("None")).isin(*rules.UNIT_TYPES), F.concat(where, F.lit(" type invalid: "), F.coalesce(_text(u, "type"), F.lit("None")))))
        checks.append((F.coalesce(_text(u, "text"), F.lit("")) == "", F.concat(where, F.lit(" text must not be empty"))))
        checks.append(((_kind(_field(u, "page")) == "int") & (F.try_variant_get(u, "$.page", "bigint") < 1), F.concat(where, F.lit(" page must be >= 1"))))
        boxes = F.try_variant_get(u, "$.bbox", "array<variant>")
        numbers = F.forall(boxes, lambda x: F.coalesce(_kind(x).isin("int", "number"), F.lit(False)))
        checks.append((_field(u, "bbox").isNotNull() & ~F.coalesce((F.size(boxes) == 4) & numbers, F.lit(False)), F.concat(where, F.lit(" bbox must be a list of 4 numbers"))))
        checks.append((_field(u, "ocr").isNotNull() & (_kind(_field(u, "ocr")) != "bool"), F.concat(where, F.lit(" ocr must be a boolean"))))
        return _messages(*checks)

    units = F.coalesce(F.flatten(F.transform("_units", unit_errors)), F.array().cast("array<string>"))
    return rows.withColumn("errors", F.when(F.size("_shape") > 0, F.col("_shape")).otherwise(F.concat(deep, units))).drop("_v", "_shape", "_units")
