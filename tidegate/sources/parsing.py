"""Strict JSON parsing shared by the file, message and stream readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import _parse_datatype_string

from tidegate.functions.numbers import _col

CORRUPT = "_corrupt"


def as_struct(schema: str | T.StructType) -> T.StructType:
    return _parse_datatype_string(schema) if isinstance(schema, str) else schema


def with_corrupt(schema: str | T.StructType) -> T.StructType:
    return T.StructType([*as_struct(schema).fields, T.StructField(CORRUPT, T.StringType())])


STRICT_JSON = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "allowSingleQuotes": "false"}


def parse_json(c: Column | str, schema: str) -> Column:
    """Struct of the payload plus ``_corrupt``, set when the text is not a JSON object."""
    return F.from_json(_col(c), with_corrupt(schema), STRICT_JSON)


def typed(c: Column, data_type: T.DataType) -> Column:
    return c if isinstance(data_type, T.StringType) else c.try_cast(data_type)


def as_text(schema: str | T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in as_struct(schema).fields])


def parse_records(raw: DataFrame, body: str, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """One parsed frame: wanted fields (bad values null) and a ``_bad`` flag.

    Fields are parsed as text first: a field of the wrong type must not turn a
    well-formed message into a malformed one.
    """
    # Exploding a one-element array pins the parse to one evaluation per row;
    # a filter on the result would otherwise be pushed below and parse again.
    parsed = raw.select(*keep, body, F.explode(F.array(parse_json(body, as_text(schema)))).alias("_p"))
    bad = F.col("_p").isNull() | F.col(f"_p.{CORRUPT}").isNotNull()
    fields = [typed(F.col(f"_p.{f.name}"), f.dataType).alias(f.name) for f in as_struct(schema).fields]
    return parsed.select(*keep, body, bad.alias("_bad"), *fields)
