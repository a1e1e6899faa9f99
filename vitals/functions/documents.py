"""JSON documents of untrusted origin: strict parsing and run-time type tests on VARIANT values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# NaN and the infinities are accepted as bare words. Outside string literals they are read as null:
# no field accepts either, so both are refused for the same reason. Every quantifier is possessive,
# which Java matches in a loop, so a long text cannot exhaust the stack.
_BARE_NON_FINITE = (
    r'\G((?:(?!NaN|-?Infinity)[^"]|"(?:[^"\\]|\\.)*+")*+)(?:NaN|-?Infinity)'
)


def decode_transport(data: Column) -> Column:
    """Base64 text to UTF-8 text; malformed bytes become U+FFFD."""
    return F.make_valid_utf8(F.try_to_binary(data, F.lit("base64")).cast("string"))


def with_document(df: DataFrame, text: str, fields: Iterable[str]) -> DataFrame:
    """Add ``is_json`` and ``document``, a struct of one VARIANT per field (null unless an object).

    The parser behind ``try_parse_json`` stops at the end of the first value and ignores what
    follows. So the text is parsed as the first element of an array whose second element is the
    hash of the text: only a text that is exactly one JSON value leaves that hash in its place.
    """
    struct_type = "struct<" + ", ".join(f"{name}: variant" for name in fields) + ">"
    finite = F.when(
        F.col(text).contains("NaN") | F.col(text).contains("Infinity"),
        F.regexp_replace(text, _BARE_NON_FINITE, "$1null"),
    ).otherwise(F.col(text))
    framed = F.concat(
        F.lit("["), F.col("_finite"), F.lit(","), F.col("_mark").cast("string"), F.lit("]")
    )
    return (
        df.withColumn("_finite", finite)
        .withColumn("_mark", F.xxhash64("_finite"))
        .withColumn("_framed", F.try_parse_json(framed))
        .withColumns(
            {
                "is_json": F.coalesce(
                    F.try_variant_get("_framed", "$[1]", "bigint") == F.col("_mark"), F.lit(False)
                ),
                "document": F.try_variant_get("_framed", "$[0]", struct_type),
            }
        )
        .drop("_finite", "_mark", "_framed")
    )


def json_type(value: Column) -> Column:
    """Type name of a VARIANT: BIGINT, DECIMAL(..), DOUBLE, STRING, BOOLEAN, VOID; null if missing."""
    return F.schema_of_variant(value)


def is_number_type(type_name: Column) -> Column:
    return (
        (type_name == "BIGINT") | type_name.startswith("DECIMAL") | (type_name == "DOUBLE")
    )


def text_of(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def bigint_of(value: Column) -> Column:
    """Number by way of its JSON text, which is cheaper than the VARIANT cast; null for other types."""
    return F.to_json(value).try_cast("bigint")


def double_of(value: Column) -> Column:
    return F.to_json(value).try_cast("double")


def materialize(df: DataFrame, keep: Iterable[str], computed: Iterable[str]) -> DataFrame:
    """Emit the computed columns through a one-element generator.

    The optimizer moves a filter below a projection by substituting the projected expressions, which
    would parse every document again inside the filter. It does not move one below a generator.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*computed))))
