"""Month maps and other nested values. Maps can't be compared, so their sorted entries are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def entries(m: Column) -> Column:
    return F.array_sort(F.map_entries(m))


def maps_equal(a: Column, b: Column) -> Column:
    return entries(a).eqNullSafe(entries(b))


def keys_equal(a: Column, b: Column) -> Column:
    return F.array_sort(F.map_keys(a)).eqNullSafe(F.array_sort(F.map_keys(b)))


def map_total(m: Column, kind: str = "bigint") -> Column:
    """Sum of a map's values; 0 for an empty map, and nulls count as 0."""
    return F.aggregate(F.map_values(m), F.lit(0).cast(kind), lambda a, x: (a + F.coalesce(x, F.lit(0).cast(kind))).cast(kind))


def month_value(m: Column, month: str | Column, default=0) -> Column:
    key = F.lit(month) if isinstance(month, str) else month
    return F.coalesce(F.try_element_at(m, key), F.lit(default))


def months_inside(m: Column, first: Column, last: Column) -> Column:
    return F.forall(F.map_keys(m), lambda k: (k >= first) & (k <= last))


def changed_keys(old: Column, new: Column) -> Column:
    """Keys of the old map that the new one lacks or has with another value, sorted."""
    return F.array_sort(F.filter(F.map_keys(old), lambda k: ~F.try_element_at(new, k).eqNullSafe(F.try_element_at(old, k))))


def new_entries(old: Column, new: Column) -> Column:
    return F.map_filter(new, lambda k, v: ~F.map_contains_key(old, k))


def extend_history(old: Column, new: Column) -> Column:
    """(value, conflicts): old months stay, new ones are appended; a month that differs is a conflict and changes nothing."""
    clash = F.array_sort(F.filter(F.map_keys(old), lambda k: F.map_contains_key(new, k) & ~F.element_at(new, k).eqNullSafe(F.element_at(old, k))))
    merged = F.map_from_entries(F.array_sort(F.map_entries(F.map_concat(old, new_entries(old, new)))))
    return F.struct(F.when(F.size(clash) == 0, merged).otherwise(old).alias("value"), clash.alias("conflicts"))


def month_column(month: str, prefix: str = "amount", suffix: str = "_C") -> str:
    return f"{prefix}_{month.replace('-', '_')}{suffix}"


def to_wide(df: DataFrame, m: str, months: Sequence[str], prefix: str = "amount", suffix: str = "_C") -> DataFrame:
    """One column for each month of the list in place of the map; a month without an entry is 0."""
    return df.select("*", *(month_value(F.col(m), x).alias(month_column(x, prefix, suffix)) for x in months)).drop(m)


def from_wide(months: Sequence[str], prefix: str = "amount", suffix: str = "_C") -> Column:
    """The month map of a wide row."""
    return F.map_from_arrays(F.array(*map(F.lit, months)), F.array(*(F.col(month_column(x, prefix, suffix)) for x in months)))


def unpivot(df: DataFrame, keys: Sequence[str], maps: dict[str, str], month: str = "ym") -> DataFrame:
    """A row for each key and month of the first map, with the other maps' values of that month beside it."""
    first, *rest = maps.items()
    long = df.select(*keys, *(m for m, _ in rest), F.explode(F.col(first[0])).alias(month, first[1]))
    return long.select(*keys, month, first[1], *(F.try_element_at(F.col(m), F.col(month)).alias(name) for m, name in rest))


def field_difference(a: Column, b: Column) -> Column:
    """Names that only one of two arrays holds, sorted."""
    return F.array_sort(F.array_union(F.array_except(a, b), F.array_except(b, a)))


def dotted_updates(field: str, old: Column, new: Column) -> Column:
    """The new months as a map from dotted path to value text, never the whole map."""
    added = new_entries(old, new)
    return F.transform_values(F.transform_keys(added, lambda k, v: F.concat(F.lit(f"{field}."), k)), lambda k, v: v.cast("string"))


def overlapping_paths(paths: Column) -> Column:
    """Whether one dotted path of the array lies under another."""
    return F.exists(paths, lambda a: F.exists(paths, lambda b: (a != b) & b.startswith(F.concat(a, F.lit(".")))))


def same_variant(a: Column, b: Column) -> Column:
    """Deep equality of two variants that tells booleans, whole numbers and decimals apart."""
    kind = lambda v: F.schema_of_variant(v)
    both = F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull())
    return both.otherwise((kind(a) == kind(b)) & (F.to_json(a) == F.to_json(b)))
