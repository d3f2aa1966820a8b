"""String cleaning, redaction, code maps and column renaming."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.numbers import _col

# Patterns and word lists that decide the result.
EMAIL_PATTERN = r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+"
AU_PHONE_PATTERN = r"\b(?:\+61|0)[2-9]\d{8,9}\b"
STRICT_PHONE_PATTERN = r"(?:\+61|\b0)[2-9]\d{8,9}\b"
POI_PATTERN = r"POI-[A-Z]{3}[0-9]{4}"
POSITIVE_WORDS = ("great", "excellent", "fast", "love", "perfect", "reliable", "happy", "amazing")
NEGATIVE_WORDS = ("slow", "terrible", "awful", "disconnected", "outage", "useless", "poor", "dropout")
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

WORD_BREAK = r"(?U)[\s\x1c-\x1f]+"

# (pattern, replacement, text every match contains): the last one lets a text
# without it skip the pattern altogether.
DEFAULT_REDACTIONS = ((EMAIL_PATTERN, "[EMAIL]", "@"), (AU_PHONE_PATTERN, "[PHONE]", ""))


def redact(c: Column | str, patterns: Sequence[tuple[str, str, str]] = DEFAULT_REDACTIONS) -> Column:
    """Replace every match of each pattern, in order, over the whole text."""
    c = _col(c)
    for pattern, replacement, needs in patterns:
        replaced = F.regexp_replace(c, pattern, replacement)
        c = F.when(F.contains(c, F.lit(needs)), replaced).otherwise(c) if needs else replaced
    return c


def clean_verbatim(c: Column | str, width: int | None = None, patterns=DEFAULT_REDACTIONS) -> Column:
    """Redact and strip; a missing text is empty. ``width`` is for a published column of that width only."""
    clean = redact(c, patterns)
    if width is not None:
        clean = F.substring(clean, 1, width)
    return F.coalesce(F.btrim(clean, F.lit(WHITESPACE)), F.lit(""))


def _words(c: Column | str) -> Column:
    return F.split(F.lower(_col(c)), WORD_BREAK)


def word_set(c: Column | str) -> Column:
    """Distinct lower-case words, split on white space only."""
    return F.array_distinct(F.array_remove(_words(c), ""))


def keyword_hits(c: Column | str, vocabulary: Sequence[str]) -> Column:
    """The distinct words of the vocabulary that occur in the text."""
    return F.array_intersect(_words(c), F.array(*[F.lit(w) for w in vocabulary]))


def count_words(words: Column, vocabulary: Sequence[str]) -> Column:
    return F.size(F.array_intersect(words, F.array(*[F.lit(w) for w in vocabulary])))


def map_codes(c: Column | str, mapping: Mapping[str, str], default: str | None = "UNKNOWN") -> Column:
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _col(c)), F.lit(default))


def extract_or_null(c: Column | str, pattern: str = POI_PATTERN) -> Column:
    return F.nullif(F.regexp_extract(_col(c), pattern, 0), F.lit(""))


def composite_id(*cols: Column | str, sep: str = "_") -> Column:
    """Join the parts with a separator, so (1, 23) and (12, 3) stay apart."""
    return F.concat_ws(sep, *[_col(c).cast("string") for c in cols])


def clean_strings(df: DataFrame, widths: Mapping[str, int] | None = None) -> DataFrame:
    """Blank strings become null and long ones are cut to the declared width."""
    widths = widths or {}
    out = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            c = F.col(f"`{field.name}`")
            kept = F.substring(c, 1, widths[field.name]) if field.name in widths else c
            out[field.name] = F.when(F.trim(c) != "", kept)
    return df.withColumns(out)


def mask(df: DataFrame, env: str, rules: Mapping[str, Column | str]) -> DataFrame:
    """Overwrite personal columns outside production; nulls stay null."""
    if env == "prod":
        return df
    return df.withColumns(
        {
            name: F.when(F.col(name).isNotNull(), v if isinstance(v, Column) else F.lit(v))
            for name, v in rules.items()
        }
    )


def snake_case(name: str) -> str:
    name = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name)
    return re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name).lower()


def _rename(data_type: T.DataType) -> T.DataType:
    if isinstance(data_type, T.StructType):
        return T.StructType(
            [T.StructField(snake_case(f.name), _rename(f.dataType), f.nullable) for f in data_type.fields]
        )
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(_rename(data_type.elementType), data_type.containsNull)
    return data_type


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename camelCase columns and nested fields; a cast, so no data moves."""
    return df.select(
        [F.col(f"`{f.name}`").cast(_rename(f.dataType)).alias(snake_case(f.name)) for f in df.schema.fields]
    )


def normalise_columns(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Apply explicit renames, then lower-case what is left."""
    df = df.withColumnsRenamed(dict(mapping or {}))
    return df.toDF(*[c.lower() for c in df.columns])


def decode_segments(df: DataFrame, c: str = "segments") -> DataFrame:
    """Split a dotted ledger account and label its account range."""
    parts = F.split(F.col(c), r"\.")
    account = F.get(parts, 2)
    number = account.try_cast("long")
    return df.withColumns(
        {
            "entity": F.get(parts, 0),
            "cost_centre": F.get(parts, 1),
            "account_code": account,
            "project_code": F.nullif(F.get(parts, 3), F.lit("")),
            # Account ranges.
            "account_range": F.when(number.between(1_500_000, 1_599_999), "CAPEX")
            .when(number.between(6_000_000, 6_999_999), "OPEX")
            .otherwise("OTHER"),
        }
    )
