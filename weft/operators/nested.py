"""Ids within nested rows: found and replaced at any depth, by plans made from the schema.

A path names fields from the outside in; arrays on the way, of structs or of ids, are gone through element by element.
What a row asks for is a list of its own ids: these meet the mapping by one join, whatever the mapping's size and however
many paths there are, and come back as the row's own small map.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

Path = str | Sequence[str]


def _parts(path: Path) -> list[str]:
    return path.split(".") if isinstance(path, str) else list(path)


def _field(kind: DataType, name: str, path: Path) -> DataType:
    if not isinstance(kind, StructType) or name not in kind.names:
        raise ValueError(f"no field {name!r} on the path {'.'.join(_parts(path))}")
    return kind[name].dataType


def _found(c: Column, kind: DataType, parts: list[str], path: Path) -> Column:
    if isinstance(kind, ArrayType):
        each = F.transform(c, lambda x: _found(x, kind.elementType, parts, path))
        return F.flatten(F.coalesce(F.filter(each, lambda x: x.isNotNull()), F.array().cast("array<array<string>>")))
    if not parts:
        return F.array(c.cast("string"))
    return _found(c.getField(parts[0]), _field(kind, parts[0], path), parts[1:], path)


def values_at(df: DataFrame, path: Path) -> Column:
    """All values at a path of a row, as one array of text without nulls."""
    return F.array_compact(_found(F.col(f"`{_parts(path)[0]}`"), _field(df.schema, _parts(path)[0], path), _parts(path)[1:], path))


def _replaced(c: Column, kind: DataType, parts: list[str], path: Path, fn) -> Column:
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda x: _replaced(x, kind.elementType, parts, path, fn))
    if not parts:
        return fn(c)
    return c.withField(f"`{parts[0]}`", _replaced(c.getField(parts[0]), _field(kind, parts[0], path), parts[1:], path, fn))


def replaced_at(df: DataFrame, path: Path, fn) -> DataFrame:
    """``df`` with ``fn`` of each value at a path in its place; nulls on the way stay null, and arrays keep their order."""
    top, *rest = _parts(path)
    return df.withColumn(top, _replaced(F.col(f"`{top}`"), _field(df.schema, top, path), rest, path, fn))


def remapped(df: DataFrame, mapping: DataFrame, key: str, paths: Sequence[Path]) -> DataFrame:
    """``df`` with the ids at all ``paths`` replaced by ``mapping`` (old, new); ids without an entry stay. ``key`` is a row's own.

    Raises if an old id has two new ones. A row meets the mapping by its own different ids, once for all paths.
    """
    if row := mapping.groupBy("old").agg(F.min("new").alias("a"), F.max("new").alias("b")).filter("a <> b").first():
        raise ValueError(f"{row.old!r} becomes both {row.a!r} and {row.b!r}")
    m = mapping.select("old", "new").filter("old IS NOT NULL AND new IS NOT NULL").distinct()
    asked = df.select(F.col(key).alias("_key"), F.array_distinct(F.flatten(F.array(*[values_at(df, p) for p in paths]))).alias("_ids"))
    asked = asked.select("_key", F.explode("_ids").alias("old")).join(m, "old")
    own = asked.groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("old", "new"))).alias("_map"))
    out = df.join(own, F.col(key).eqNullSafe(F.col("_key")), "left")
    for p in paths:
        out = replaced_at(out, p, lambda v: F.coalesce(F.try_element_at("_map", v), v))
    return out.select(*[F.col(f"`{c}`") for c in df.columns])


def unmapped(df: DataFrame, mapping: DataFrame, key: str, paths: Sequence[Path], legacy: str) -> DataFrame:
    """(key, path, value) of ids at ``paths`` that match ``legacy`` and have no entry in ``mapping``: what a migration would leave behind."""
    out = None
    for p in paths:
        one = df.select(key, F.lit(".".join(_parts(p))).alias("path"), F.explode(F.array_distinct(values_at(df, p))).alias("value"))
        out = one if out is None else out.unionByName(one)
    return out.filter(F.col("value").rlike(legacy)).join(mapping.select(F.col("old").alias("value")).distinct(), "value", "left_anti").select(key, "path", "value")


def former_ids(former: Column, own: Column, legacy: str) -> Column:
    """A record's list of former ids: distinct in order, without blank ones, and its own id behind them if that is ``legacy`` and to be replaced."""
    kept = F.array_distinct(F.filter(F.coalesce(former, F.array().cast("array<string>")), lambda x: F.trim(x) != ""))
    mine = F.trim(own)
    return F.when(mine.rlike(legacy) & ~F.array_contains(kept, mine), F.array_append(kept, mine)).otherwise(kept)


def repeated_ids(records: DataFrame, key: str, former: str, legacy: str) -> DataFrame:
    """(id, n) of legacy ids that several records bear, as their own or a former one, or one record twice."""
    ids = F.concat(F.array(F.col(key)), F.coalesce(F.col(former), F.array().cast("array<string>")))
    return records.select(F.explode(F.filter(ids, lambda x: x.rlike(legacy))).alias("id")).groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")
