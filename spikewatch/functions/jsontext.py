"""Loosely typed JSON: one parse per line, and column expressions for its fields.

Fields whose JSON type matters are read as variants and looked at through their JSON
text, which keeps ``false`` and ``"false"`` apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# JSON texts that count as false, besides numeric zero.
FALSY = ("null", "false", '""', "[]", "{}")
QUOTED_INT = r'^"\s*[+-]?\d+\s*"$'
QUOTED_NUMBER = r'^"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*"$'


def parse_once(lines: DataFrame, schema: str, options: dict[str, str]) -> DataFrame:
    """Add ``_raw``, the JSON of column ``value``.

    Written as the explosion of a one-element array: filters on parsed fields would be
    pushed below a plain projection and parse every line a second time.
    """
    return lines.withColumn("_raw", F.explode(F.array(F.from_json("value", schema, options))))


def not_blank(line: Column) -> Column:
    return line.rlike(r"(?U)\S")


def single_object(line: Column) -> Column:
    """Whether nothing but one JSON object is on the line.

    The JSON parser stops at the end of the first object. A line whose first closing
    brace is its last character needs no more checking. Others are parsed once more as the
    one element of an array, which leaves only a bracket possible after the object, and
    as the one field of an object, which leaves only a brace.
    """
    in_array = F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<variant>")
    in_object = F.from_json(
        F.concat(F.lit('{"o":'), line, F.lit("}")),
        "o variant, _corrupt string",
        {"columnNameOfCorruptRecord": "_corrupt"},
    )
    alone = (F.size(in_array) == 1) & in_object["_corrupt"].isNull() & in_object["o"].isNotNull()
    # Used once: a repeated expression would be computed ahead for every line.
    return F.when(F.instr(line, "}") == F.length(F.rtrim(line)), True).otherwise(
        F.coalesce(alone, F.lit(False))
    )


def truthy(field: Column) -> Column:
    """Truth of a JSON value: empty and zero values and absent fields are false."""
    text = F.to_json(field)
    zero = F.coalesce(text.try_cast("double") == 0, F.lit(False))
    return F.coalesce(~text.isin(*FALSY) & ~zero, F.lit(False))


def _truncated(text: Column) -> Column:
    return text.try_cast("decimal(38,10)").try_cast("bigint")


def to_integer(field: Column) -> Column:
    """Whole number of a JSON value, cut towards zero; null when it has none.

    Numbers, whole numbers in quotes and booleans convert.
    """
    text = F.to_json(field)
    return (
        F.when(text == "true", F.lit(1).cast("bigint"))
        .when(text == "false", F.lit(0).cast("bigint"))
        .when(text.rlike(QUOTED_INT), F.trim(F.btrim(text, F.lit('"'))).try_cast("bigint"))
        .otherwise(_truncated(text))
    )


def to_number(field: Column) -> Column:
    """Double value of a JSON number, a number in quotes or a boolean; null otherwise."""
    text = F.to_json(field)
    return (
        F.when(text == "true", F.lit(1.0))
        .when(text == "false", F.lit(0.0))
        .when(text.rlike(QUOTED_NUMBER), F.trim(F.btrim(text, F.lit('"'))).try_cast("double"))
        .otherwise(text.try_cast("double"))
    )


def is_given(field: Column) -> Column:
    """Present and not JSON null."""
    return F.coalesce(F.to_json(field) != "null", F.lit(False))


def missing_names(present: dict[str, Column]) -> Column:
    """Comma-separated names of the fields that are absent, in alphabetical order."""
    marks = [F.when(~present[name], F.lit(name)) for name in sorted(present)]
    return F.concat_ws(", ", *marks)
