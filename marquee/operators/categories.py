"""Categorical columns: an integer code and a dictionary kept with it.

The dictionary and whether it is ordered lie in the column's metadata, so
they go through selects, filters and joins with the codes; equal frames of
codes can be joined on them.  Codes follow the dictionary's order; a value
outside it, and NULL, has code -1.  Changing a dictionary remaps codes by
one expression over the column.

A dictionary is part of the schema: it has ``MAX`` categories at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX = 10_000
KEY = "categories"


def dictionary(df: DataFrame, col: str) -> tuple[list, bool]:
    """Categories of a column, and whether they are ordered."""
    held = df.schema[col].metadata
    if KEY not in held:
        raise TypeError(f"{col} is not categorical")
    return list(held[KEY]), bool(held.get("ordered"))


def _with(df: DataFrame, col: str, code: Column, categories: list, ordered: bool) -> DataFrame:
    if len(categories) > MAX:
        raise ValueError(f"{len(categories)} categories, {MAX} at most")
    if len(set(categories)) < len(categories) or None in categories:
        raise ValueError("categories are distinct and not NULL")
    return df.withColumn(col, code.cast("int")).withMetadata(col, {KEY: list(categories), "ordered": bool(ordered)})


def _position(value: Column, categories: list) -> Column:
    if not categories:
        return F.lit(-1)
    table = F.array(*[F.lit(c) for c in categories])
    return F.coalesce(F.array_position(table, value) - 1, F.lit(-1))


def encode(df: DataFrame, col: str, categories: list | None = None, ordered: bool = False) -> DataFrame:
    """Values to codes; the dictionary is given, or the sorted distinct values."""
    if categories is None:
        found = df.select(col).where(F.col(col).isNotNull()).distinct().limit(MAX + 1).collect()
        categories = sorted(r[0] for r in found)
    return _with(df, col, _position(F.col(col), categories), categories, ordered)


def decode(df: DataFrame, col: str) -> DataFrame:
    """Codes to values."""
    categories, _ = dictionary(df, col)
    value = F.lit(None)
    if categories:
        value = F.when(F.col(col) >= 0, F.element_at(F.array(*[F.lit(c) for c in categories]), F.col(col) + 1))
    return df.withColumn(col, value).withMetadata(col, {})


def set_categories(df: DataFrame, col: str, categories: list, ordered: bool | None = None) -> DataFrame:
    """Another dictionary: values it lacks become -1, all others keep their value."""
    old, was = dictionary(df, col)
    table = {c: i for i, c in enumerate(categories)}
    moved = [table.get(c, -1) for c in old]
    code = F.when(F.col(col) >= 0, F.element_at(F.array(*[F.lit(x) for x in moved]), F.col(col) + 1)).otherwise(F.lit(-1)) if moved else F.lit(-1)
    return _with(df, col, code, list(categories), was if ordered is None else ordered)


def add(df: DataFrame, col: str, more: list) -> DataFrame:
    """New categories at the end: codes stay."""
    old, _ = dictionary(df, col)
    if set(old) & set(more):
        raise ValueError("categories are there already")
    return set_categories(df, col, old + list(more))


def remove(df: DataFrame, col: str, gone: list) -> DataFrame:
    """Their values become -1."""
    old, _ = dictionary(df, col)
    if set(gone) - set(old):
        raise ValueError("no such category")
    return set_categories(df, col, [c for c in old if c not in set(gone)])


def remove_unused(df: DataFrame, col: str) -> DataFrame:
    """Categories that no row has go (one aggregate over the codes)."""
    old, _ = dictionary(df, col)
    used = {r[0] for r in df.select(col).distinct().collect()}
    return set_categories(df, col, [c for i, c in enumerate(old) if i in used])


def reorder(df: DataFrame, col: str, order: list, ordered: bool | None = None) -> DataFrame:
    """The same categories in another order."""
    old, _ = dictionary(df, col)
    if sorted(map(repr, old)) != sorted(map(repr, order)):
        raise ValueError("the same categories are needed")
    return set_categories(df, col, order, ordered)


def rename(df: DataFrame, col: str, names: dict | list) -> DataFrame:
    """Other names, by a mapping or in the dictionary's order: codes stay."""
    old, ordered = dictionary(df, col)
    if not isinstance(names, dict) and len(names) != len(old):
        raise ValueError("as many names as categories are needed")
    new = [names.get(c, c) for c in old] if isinstance(names, dict) else list(names)
    return _with(df, col, F.col(col), new, ordered)


def below(df: DataFrame, col: str, value) -> Column:
    """Whether an ordered category lies below ``value``."""
    categories, ordered = dictionary(df, col)
    if not ordered:
        raise TypeError("the categories have no order")
    return (F.col(col) >= 0) & (F.col(col) < categories.index(value))
