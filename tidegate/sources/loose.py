"""Documents whose fields are not all declared: nothing they carry is lost, and drift is reported.

A document is parsed once into a ``VARIANT``. Its leaves are its members by path (``location.region``);
an array is one leaf, and so is what lies deeper than ``depth`` or at a declared path. A name that holds a
dot or a backtick is quoted with backticks in its path, so two members never share one.

``Fields`` maps an output column to the path and the SQL type of its value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Fields = Mapping[str, tuple[str, str]]
MEMBERS = "map<string,variant>"
DEPTH = 4


def read_loose(raw: DataFrame, body: str, keep: Sequence[str] = (), doc: str = "doc") -> tuple[DataFrame, DataFrame]:
    """``keep`` and the parsed document of every text that is a JSON object; the other rows with their text.

    Null, broken or empty text, a text that names a member twice, an array and a plain value are no objects.
    """
    # The one-element array pins the parse, which a filter above would otherwise repeat.
    parsed = raw.select(*keep, body, F.explode(F.array(F.try_parse_json(body))).alias(doc))
    is_object = F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False))
    return parsed.filter(is_object).drop(body), parsed.filter(~is_object).drop(doc)


def _members(value: Column, under: Column | None = None) -> Column:
    """Array of (path, value) of an object's members; null for anything else."""

    def step(entry: Column) -> Column:
        name = entry["key"]
        quoted = F.concat(F.lit("`"), F.replace(name, F.lit("`"), F.lit("``")), F.lit("`"))
        name = F.when(name.contains(".") | name.contains("`"), quoted).otherwise(name)
        path = name if under is None else F.concat(under, F.lit("."), name)
        return F.struct(path.alias("path"), entry["value"].alias("value"))

    return F.transform(F.map_entries(F.try_variant_get(value, "$", MEMBERS)), step)


def leaves(doc: str = "doc", whole: Sequence[str] = (), depth: int = DEPTH) -> Column:
    """Array of (path, value) of a document; members at a path of ``whole`` are not taken apart."""

    def open_up(entry: Column) -> Column:
        shut = entry["path"].isin(*whole) if whole else F.lit(False)

        def choose(inner: Column) -> Column:
            return F.when(shut | (F.coalesce(F.size(inner), F.lit(0)) == 0), F.array(entry)).otherwise(inner)

        # An array of one lets the members be found once for the test and the result.
        return F.flatten(F.transform(F.array(_members(entry["value"], entry["path"])), choose))

    found = _members(F.col(doc))
    for _ in range(depth - 1):
        found = F.flatten(F.transform(found, open_up))
    return found


def _kind(value: Column) -> Column:
    """null, text, boolean, number, array, object, else the type's own name."""
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z_]+", 0)
    names = {"VOID": "null", "STRING": "text", "BOOLEAN": "boolean", "ARRAY": "array", "OBJECT": "object"}
    out = F.when(name.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "number")
    for sql, plain in names.items():
        out = out.when(name == sql, plain)
    return out.otherwise(F.lower(name))


def profile_fields(docs: DataFrame, doc: str = "doc", depth: int = DEPTH) -> DataFrame:
    """path, kind, n: how many documents hold each path with each kind of value."""
    found = docs.select(F.inline(leaves(doc, depth=depth)))
    return found.groupBy("path", _kind(F.col("value")).alias("kind")).agg(F.count("*").alias("n"))


def _fits(path: Column, value: Column, fields: Fields) -> Column:
    """Whether the value at a declared path has its type or is null; null at any other path."""
    out = F.lit(None).cast("boolean")
    for at, sql in fields.values():
        fit = F.is_variant_null(value) | F.try_variant_get(value, "$", sql).isNotNull()
        out = F.when(path == at, fit).otherwise(out)
    return out


def field_drift(docs: DataFrame, fields: Fields, doc: str = "doc", depth: int = DEPTH) -> DataFrame:
    """One row per path that is declared or found: path, declared, n_docs, n_misfit, status.

    ``status`` is ``new`` (found, not declared), ``missing`` (declared, in no document), ``misfit`` (some
    values are neither null nor of the declared type) or ``as declared``. Counts combine on the map side.
    """
    declared = docs.sparkSession.createDataFrame(list(fields.values()), "path string, declared string")
    found = docs.select(F.inline(leaves(doc, [at for at, _ in fields.values()], depth)))
    counted = found.groupBy("path").agg(
        F.count("*").alias("n_docs"),
        F.count_if(~_fits(F.col("path"), F.col("value"), fields)).alias("n_misfit"),
    )
    status = (
        F.when(F.col("declared").isNull(), "new")
        .when(F.col("n_docs").isNull(), "missing")
        .when(F.col("n_misfit") > 0, "misfit")
        .otherwise("as declared")
    )
    return declared.join(counted, "path", "full").select(
        "path",
        "declared",
        F.coalesce("n_docs", F.lit(0)).alias("n_docs"),
        F.coalesce("n_misfit", F.lit(0)).alias("n_misfit"),
        status.alias("status"),
    )


def _at(found: Column, path: str) -> Column:
    return F.get(F.filter(found, lambda e: e["path"] == path), F.lit(0))["value"]


def flatten_loose(
    docs: DataFrame, fields: Fields, keep: Sequence[str] = (), doc: str = "doc", rest: str = "rest", depth: int = DEPTH
) -> DataFrame:
    """``keep``, a typed column per field, and a map from path to JSON text of all else.

    A value that does not have its declared type leaves its column null and stands in the map.
    """
    paths = [at for at, _ in fields.values()]
    # Leaves are found once per row, not once per column.
    found = docs.select(*keep, F.explode(F.array(leaves(doc, paths, depth))).alias("_found"))
    entries = F.col("_found")
    left = F.filter(entries, lambda e: ~F.coalesce(_fits(e["path"], e["value"], fields), F.lit(False)))
    return found.select(
        *keep,
        *[F.try_variant_get(_at(entries, at), "$", sql).alias(name) for name, (at, sql) in fields.items()],
        F.map_from_entries(F.transform(left, lambda e: F.struct(e["path"], F.to_json(e["value"])))).alias(rest),
    )


def promote(flat: DataFrame, fields: Fields, rest: str = "rest") -> DataFrame:
    """Columns for paths that were not declared when the rows landed, taken out of the map where they fit."""
    parsed = {name: F.try_parse_json(F.try_element_at(rest, F.lit(at))) for name, (at, _) in fields.items()}
    moved = {name: F.try_variant_get(parsed[name], "$", sql) for name, (_, sql) in fields.items()}
    out = flat.withColumns(moved)
    taken = F.array_compact(F.array(*[
        F.when(F.col(name).isNotNull() | F.coalesce(F.is_variant_null(parsed[name]), F.lit(False)), F.lit(at))
        for name, (at, _) in fields.items()
    ]))
    return out.withColumn(rest, F.map_filter(rest, lambda k, _: ~F.array_contains(taken, k)))
