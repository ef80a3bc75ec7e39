"""Column functions over VARIANT: raw JSON records of unknown shape."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .text import normalize

LENIENT_JSON = "spark.sql.variant.allowDuplicateKeys"


def lenient(spark: SparkSession) -> None:
    """Lets later plans of the session take the last of repeated JSON keys; without it such a record is malformed."""
    spark.conf.set(LENIENT_JSON, "true")


#: Closes the list in which a text is parsed. Fixed value.
_LAST = "\x01 last"


def parse(raw: Column) -> Column:
    """A VARIANT, or null if the text is not one JSON value. Duplicate keys: the last wins under LENIENT_JSON. Spark's
    parser stops after a value, whatever follows it, so the text is parsed as the first of two elements of a list."""
    pair = F.try_parse_json(F.concat(F.lit("["), raw, F.lit(',"\\u0001 last"]')))
    alone = lambda v: (F.try_variant_get(v, "$[1]", "string") == _LAST) & F.try_variant_get(v, "$[2]", "variant").isNull()
    return let(pair, lambda v: F.when(alone(v), F.try_variant_get(v, "$[0]", "variant")))


def kind(v: Column) -> Column:
    """'string', 'array', 'object', 'null', 'bool', 'number', or null if the variant is missing."""
    schema = F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    known = F.create_map(*(F.lit(x) for x in ("VOID", "null", "STRING", "string", "ARRAY", "array", "OBJECT", "object", "BOOLEAN", "bool")))
    return F.when(v.isNotNull(), F.coalesce(F.try_element_at(known, schema), F.lit("number")))


def let(value: Column, body) -> Column:
    """body(x) with x bound to the value: evaluated once, and one node in the expression tree however
    often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def get(v: Column, path: str, to: str = "variant") -> Column:
    return F.try_variant_get(v, path, to)


def key(v: Column, name: str, to: str = "variant") -> Column:
    return get(v, f"$['{name}']", to)


def items(v: Column) -> Column:
    """The elements of an array variant; null for anything else."""
    return F.when(kind(v) == "array", F.try_variant_get(v, "$", "array<variant>"))


def text_of(v: Column) -> Column:
    """Any value as text: strings as they are, null as null, others as JSON."""
    return F.when(kind(v) == "string", F.try_variant_get(v, "$", "string")).when(kind(v) == "null", F.lit(None)).otherwise(F.to_json(v))


def is_truthy(v: Column) -> Column:
    """False for missing, null, false, 0, empty texts, lists and objects."""
    return F.coalesce(~F.to_json(v).isin("null", "false", "0", "0.0", '""', "[]", "{}"), F.lit(False))


def content_text(v: Column) -> Column:
    """The plain text of a string, of an object with a text, or of a list of such blocks."""

    def block(x: Column) -> Column:
        def text_block(text: Column) -> Column:
            typed = (get(x, "$.type", "string") == "text") & text.isNotNull() & (kind(text) != "null")
            return F.when((kind(x) == "object") & ((kind(text) == "string") | F.coalesce(typed, F.lit(False))), text_of(text))

        return F.when(kind(x) == "string", get(x, "$", "string")).otherwise(let(get(x, "$.text"), text_block))

    def whole(x: Column) -> Column:
        listed = F.array_join(F.filter(F.transform(items(x), block), lambda t: t.isNotNull()), "\n")
        single = let(get(x, "$.text"), lambda t: F.when(kind(t) == "string", text_of(t)))
        return F.coalesce(F.when(kind(x) == "string", get(x, "$", "string")).when(kind(x) == "array", listed).when(kind(x) == "object", single), F.lit(""))

    return let(v, whole)


def normalize_value(v: Column) -> Column:
    """normalize() of any value: lists are joined by LF, objects become JSON."""
    def one(x: Column) -> Column:
        listed = F.array_join(F.transform(items(x), lambda y: normalize(text_of(y))), "\n")
        return normalize(F.when(kind(x) == "array", listed).otherwise(text_of(x)))

    return let(v, one)
