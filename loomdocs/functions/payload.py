"""JSON payload columns. Results are JSON text; compare them parsed. Needs spark.sql.mapKeyDedupPolicy=LAST_WIN for merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import _c, scrub, strip


def _map(c) -> Column:
    return F.coalesce(F.try_parse_json(F.coalesce(_c(c), F.lit("{}"))), F.parse_json(F.lit("{}"))).cast("map<string,variant>")


def _later(*maps: Column) -> Column:
    """Union of maps; a key's last value wins, whatever the session's policy."""

    def two(a: Column, b: Column) -> Column:
        return F.map_concat(F.map_filter(a, lambda k, _: ~F.array_contains(F.map_keys(b), k)), b)

    return reduce(two, maps)


def json_first(data, *paths: str) -> Column:
    """The first path that holds a value."""
    return F.coalesce(*[F.get_json_object(_c(data), p) for p in paths])


def has_key(data, key: str) -> Column:
    """F16: the payload has the key, also with a JSON null."""
    return F.coalesce(F.array_contains(F.json_object_keys(_c(data)), key), F.lit(False))


def json_set(data, path: str, value) -> Column:
    """Set `a` or `a.b`, creating the leaf; a null value is a JSON null. Missing parents leave the payload as it is."""
    first, _, rest = path.partition(".")
    value = F.coalesce(F.try_parse_json(F.to_json(F.array(_c(value)))).cast("array<variant>")[0], F.parse_json(F.lit("null")))
    own = _map(data)
    if not rest:
        return F.to_json(_later(own, F.create_map(F.lit(first), value)))
    inner = F.get_json_object(_c(data), f"$.{first}")
    changed = F.to_json(_later(_map(inner), F.create_map(F.lit(rest), value)))
    return F.when(inner.isNotNull(), F.to_json(_later(own, F.create_map(F.lit(first), F.parse_json(changed))))).otherwise(_c(data))


def json_merge(*payloads) -> Column:
    """Shallow merge, later payloads win; null counts as {}."""
    return F.to_json(_later(*[_map(p) for p in payloads]))


def json_rename(data, old: str, new: str) -> Column:
    """Rename a key; an existing new key keeps its value and the old one goes."""
    own = _map(data)
    rest = F.map_filter(own, lambda k, _: k != old)
    moved = F.transform_keys(F.map_filter(own, lambda k, _: k == old), lambda k, _: F.lit(new))
    return F.to_json(F.when(F.array_contains(F.map_keys(own), old), _later(moved, rest)).otherwise(own))


def json_drop(data, key: str) -> Column:
    return F.to_json(F.map_filter(_map(data), lambda k, _: k != key))


def tags_to_map(tags) -> Column:
    """`Label: value` texts to a map with snake-case keys; the last of a label wins."""
    pairs = F.transform(
        F.filter(tags, lambda t: F.contains(t, F.lit(":"))),
        lambda t: F.struct(
            F.regexp_replace(F.regexp_replace(F.lower(strip(F.split(t, ":", 2)[0])), r"[^a-z0-9]+", "_"), r"^_+|_+$", "").alias("key"),
            strip(F.split(t, ":", 2)[1]).alias("value"),
        ),
    )
    keys = F.array_distinct(F.transform(pairs, lambda p: p["key"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k.alias("key"), F.element_at(F.filter(pairs, lambda p: p["key"] == k), -1)["value"].alias("value"))))


def scrub_value(c: Column, kind: T.DataType) -> Column:
    """Scrub every text value inside a column of this type; keys and other values stay."""
    if isinstance(kind, T.StringType):
        return scrub(c)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: scrub_value(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, x: scrub_value(x, kind.valueType))
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[scrub_value(c[f.name], f.dataType).alias(f.name) for f in kind]))
    return c


def scrub_struct(df, columns: list[str] | None = None):
    """Scrub the named columns (all unless named), whatever their nesting."""
    kinds = {f.name: f.dataType for f in df.schema}
    return df.select(*[scrub_value(F.col(c), kinds[c]).alias(c) if columns is None or c in columns else F.col(c) for c in df.columns])
