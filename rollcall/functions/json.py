"""JSON tests and field access as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StructType

# Accepted besides strict JSON: single quotes (a reader default) and bare names.
READ_OPTIONS = {"allowUnquotedFieldNames": "true"}
# An object of which nothing is kept: its text is read over, not stored.
ANY_OBJECT = "struct<`_`:string>"


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def _in_array(value: Column, kind: str) -> Column:
    """The text parsed as the content of an array of ``kind``.

    ``from_json`` stops after the first value; inside an array, text left over
    behind it breaks the array, adds elements or closes it early.
    """
    return F.from_json(
        F.concat(F.lit("["), value, F.lit("]")), f"array<{kind}>", READ_OPTIONS
    )


def ends_with_first_object(value) -> Column:
    """For text that starts with an object: nothing follows that object.

    Only text that might add elements to the array or close it is parsed again,
    inside an object, where neither is possible.
    """
    value = _col(value)
    in_object = F.from_json(
        F.concat(F.lit('{"v":'), value, F.lit("}")), f"struct<v:{ANY_OBJECT}>", READ_OPTIONS
    )
    suspect = value.rlike(r"\}\s*[\],]")
    return F.when(suspect, in_object["v"].isNotNull()).otherwise(F.lit(True))


def is_json_object(value) -> Column:
    """True only when the whole text is one JSON object."""
    value = _col(value)
    first = F.get(_in_array(value, ANY_OBJECT), F.lit(0))
    return F.coalesce(first.isNotNull() & ends_with_first_object(value), F.lit(False))


def json_record(value, schema: StructType) -> Column:
    """Fields of the JSON object at the start of the text, or null."""
    return F.get(_in_array(_col(value), schema.simpleString()), F.lit(0))


def json_rows(value, schema: StructType) -> Column:
    """The same as a generator: a row of fields, parsed once however often used.

    Keep to rows that pass ``ends_with_first_object``.
    """
    return F.inline(_in_array(_col(value), schema.simpleString()))


def blank_to_null(c) -> Column:
    c = _col(c)
    return F.when(F.trim(c) != "", c)


def json_text(value, field: str) -> Column:
    return F.get_json_object(_col(value), f"$.{field}")


def json_int(value, field: str, default: int | None = None) -> Column:
    number = F.trim(json_text(value, field)).try_cast("int")
    return number if default is None else F.coalesce(number, F.lit(default))


def record_json(*columns) -> Column:
    """The given columns as a JSON object; null fields are left out."""
    return F.to_json(F.struct(*columns))
