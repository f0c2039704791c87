"""Flatten struct columns and JSON text columns into top-level columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from ..session import remove_path, scratch_path

UNPARSED = "_unparsed"


def json_columns(df: DataFrame, candidates: Sequence[str]) -> list[str]:
    """Those of the text columns in which some value looks like an object or an array."""
    looks = [
        F.bool_or(text.strip_whitespace(F.col(f"`{c}`")).rlike(r"^[\{\[]")).alias(c)
        for c in candidates
    ]
    found = df.agg(*looks).first().asDict() if looks else {}
    return [c for c in candidates if found[c]]


def infer_json_schemas(df: DataFrame, columns: Sequence[str]) -> dict[str, T.DataType]:
    """Object schemas of JSON text columns, from all of their values, in one aggregate.

    Each task merges the schemas of its own rows; only merged schemas are shuffled.
    Fields whose types conflict, and fields that are always null, are read as text.
    Columns without any JSON object are left out.
    """
    merged = [
        F.schema_of_variant_agg(
            F.when(
                text.strip_whitespace(F.col(f"`{c}`")).startswith("{"),
                F.try_parse_json(F.col(f"`{c}`")),
            )
        ).alias(c)
        for c in columns
    ]
    rendered = df.agg(*merged).first().asDict() if merged else {}
    return {c: found for c in columns if (found := _object_schema(rendered[c])) is not None}


def _object_schema(ddl: str | None) -> T.DataType | None:
    """The struct that a merged schema of VARIANT values stands for; None if it is no object with fields."""
    if not ddl or not ddl.startswith("OBJECT<") or ddl == "OBJECT<>":
        return None
    return _readable(T.DataType.fromDDL(_ddl(ddl)))


def _ddl(rendered: str) -> str:
    return rendered.replace("OBJECT<", "STRUCT<")


def _readable(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.StructType):
        return T.StructType(
            [T.StructField(f.name, _readable(f.dataType)) for f in dtype.fields]
        ) if dtype.fields else T.StringType()
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_readable(dtype.elementType))
    if isinstance(dtype, (T.VariantType, T.NullType)):
        return T.StringType()
    return dtype


def _leaves(
    c: Column, dtype: T.DataType, name: str, sep: str
) -> list[tuple[str, Column]]:
    if not isinstance(dtype, T.StructType):
        return [(name, c)]
    out: list[tuple[str, Column]] = []
    for f in dtype.fields:
        child = _child(name, f.name, sep)
        out += _leaves(c.getField(f.name), f.dataType, child, sep)
    return out


def flatten(
    df: DataFrame,
    json_schemas: Mapping[str, T.DataType] | None = None,
    *,
    sep: str = "_",
) -> DataFrame:
    """Replace struct and JSON text columns by their leaves, appended at the end.

    Leaves are called ``<column>_<field>``, unless the field already starts with the
    column's name. Arrays stay arrays. Text that is not a JSON object is kept in
    ``<column>_unparsed``. Two leaves of one name raise instead of hiding each other.
    ``json_schemas`` comes from ``infer_json_schemas``, or is pinned by the caller.
    """
    json_schemas = json_schemas or {}
    flat: list[tuple[str, Column]] = []
    nested: list[tuple[str, Column]] = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in json_schemas:
            is_object = text.parses_as_json(c) & text.strip_whitespace(c).startswith("{")
            parsed = F.when(is_object, F.from_json(c, json_schemas[f.name]))
            nested += _leaves(parsed, json_schemas[f.name], f.name, sep)
            nested.append(
                (f.name + UNPARSED, F.when(~F.coalesce(is_object, F.lit(False)), c))
            )
        elif isinstance(f.dataType, T.StructType):
            nested += _leaves(c, f.dataType, f.name, sep)
        else:
            flat.append((f.name, c))
    return _select(df, flat + nested)


def _select(df: DataFrame, columns: list[tuple[str, Column]]) -> DataFrame:
    names = [n for n, _ in columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"flattening gives several columns named {clashes}")
    return df.select(*[c.alias(n) for n, c in columns])


_PARSED = "_parsed"
#: Characters of keys that a path into a VARIANT cannot have.
_NOT_IN_PATHS = set("\"'?\\[]")


def _variant_leaves(
    parsed: Column, dtype: T.DataType, name: str, path: str, sep: str, maps: Sequence[str]
) -> list[tuple[str, Column, bool]]:
    """Leaves of a VARIANT column: name, value, and whether it is text that may hold JSON itself."""
    if name in maps:
        return [(name, F.try_variant_get(parsed, path, "variant"), False)]
    if not isinstance(dtype, T.StructType):
        value = F.try_variant_get(parsed, path, dtype.simpleString())
        return [(name, value, isinstance(dtype, T.StringType))]
    out: list[tuple[str, Column, bool]] = []
    for f in dtype.fields:
        child = _child(name, f.name, sep)
        if set(f.name) & _NOT_IN_PATHS:
            value = F.try_variant_get(parsed, path, "map<string,variant>")[f.name]
            out += _variant_leaves(value, f.dataType, child, "$", sep, maps)
        else:
            out += _variant_leaves(parsed, f.dataType, child, f'{path}["{f.name}"]', sep, maps)
    return out


def _child(name: str, key: str, sep: str) -> str:
    return key if key.startswith(name) else f"{name}{sep}{key}"


def _keys_towards(maps: Sequence[str], name: str, sep: str) -> list[str]:
    """Keys that an object called ``name`` may have on the way to one of ``maps``, or as one of them."""
    starts = {m[:i] for m in maps for i in range(len(m) + 1)}
    keys = starts | {s[len(name + sep) :] for s in starts if s.startswith(name + sep)}
    return sorted(k for k in keys if _child(name, k, sep) in starts)


def _infer_without_maps(
    stored: DataFrame, columns: Sequence[str], maps: Sequence[str], sep: str
) -> dict[str, T.DataType]:
    """Object schemas of the VARIANT columns of text columns, in which ``maps`` are leaves.

    Keys of a map are no fields, so they take no part in the merging of schemas, which would grow with the
    data. One aggregate, and another one for each further object on the way to a map.
    """
    rest: dict[tuple[str, ...], str | None] = {}
    found: dict[tuple[str, ...], str] = {(c,): c for c in columns}
    opened = dict(found)
    while opened:
        measures: list[Column] = []
        towards: dict[tuple[str, ...], list[str]] = {}
        for i, (at, name) in enumerate(opened.items()):
            value = F.col(f"`{at[0]}{_PARSED}`")
            for key in at[1:]:
                value = F.try_variant_get(value, "$", "map<string,variant>")[key]
            fields = F.try_variant_get(value, "$", "map<string,variant>")
            towards[at] = [] if name in maps else _keys_towards(maps, name, sep)
            if name in maps:
                kept = F.when(F.size(fields) > 0, F.parse_json(F.lit('{"key":null}'))).otherwise(value)
            elif towards[at]:
                known = towards[at]
                others = F.map_filter(fields, lambda k, _: ~k.isin(known))
                kept = F.coalesce(F.to_variant_object(others), value)
            else:
                kept = value
            measures.append(F.schema_of_variant_agg(kept).alias(f"rest_{i}"))
            measures += [
                F.coalesce(F.bool_or(F.map_contains_key(fields, key)), F.lit(False)).alias(f"has_{i}_{j}")
                for j, key in enumerate(towards[at])
            ]
        row = stored.agg(*measures).first()
        new: dict[tuple[str, ...], str] = {}
        for i, at in enumerate(opened):
            rest[at] = row[f"rest_{i}"]
            new |= {
                (*at, key): _child(opened[at], key, sep) for j, key in enumerate(towards[at]) if row[f"has_{i}_{j}"]
            }
        found |= new
        opened = {at: name for at, name in new.items() if name not in maps}

    def schema(at: tuple[str, ...]) -> T.DataType:
        if at not in rest:
            return T.StringType()
        inner = [T.StructField(deeper[-1], schema(deeper)) for deeper in found if deeper[:-1] == at]
        if rest[at] == "OBJECT<>" and inner:
            fields = inner
        else:
            own = _object_schema(rest[at])
            if own is None:
                ddl = rest[at] or "VOID"
                return T.StringType() if ddl.startswith("OBJECT<") else _readable(T.DataType.fromDDL(_ddl(ddl)))
            fields = own.fields + inner
        return T.StructType(sorted(fields, key=lambda f: f.name.encode("utf-16-be")))

    schemas = {c: schema((c,)) for c in columns}
    return {c: s for c, s in schemas.items() if isinstance(s, T.StructType)}


def flatten_all(df: DataFrame, *, sep: str = "_", maps: Sequence[str] = ()) -> DataFrame:
    """``flatten`` until nothing nested remains: JSON text inside JSON text is flattened as well.

    Works by level. A level parses the text columns that the level before has brought, once, and writes
    the rows with the parsed values as VARIANT; one aggregate over these gives all schemas (one more for each
    object on the way to a map), and their leaves are taken out of the stored values. Text leaves are the columns of the next level. Levels
    end when no text holds a JSON object any more, which is after as many as JSON is nested in text.

    ``maps`` names columns, as they are called after flattening, whose keys are data: they stay VARIANT, so
    that a key is no column. Arrays stay arrays.
    """
    spark = df.sparkSession
    rows = flatten(df, sep=sep)
    fresh = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.StringType)]
    last = None
    while fresh:
        looks = {c: text.strip_whitespace(F.col(f"`{c}`")).startswith("{") for c in fresh}
        parsed = [F.when(looks[c], F.try_parse_json(F.col(f"`{c}`"))).alias(c + _PARSED) for c in fresh]
        path = scratch_path(spark, "flatten")
        with_parsed = rows.select("*", *parsed)
        with_parsed.write.parquet(path)
        if last:
            remove_path(spark, last)
        last, stored = path, spark.read.schema(with_parsed.schema).parquet(path)
        # An object and nothing else: of values that conflict in kind none is taken apart.
        schemas = _infer_without_maps(stored, fresh, maps, sep)
        columns: list[tuple[str, Column]] = []
        nested: list[tuple[str, Column]] = []
        known = set(fresh)
        fresh = []
        for f in rows.schema.fields:
            c, parsed_c = F.col(f"`{f.name}`"), F.col(f"`{f.name + _PARSED}`")
            if f.name not in schemas or f.name not in known:
                columns.append((f.name, c))
                continue
            for name, value, is_text in _variant_leaves(parsed_c, schemas[f.name], f.name, "$", sep, maps):
                nested.append((name, value))
                fresh += [name] * is_text
            nested.append((f.name + UNPARSED, F.when(parsed_c.isNull(), c)))
        rows = _select(stored, columns + nested)
    return rows
