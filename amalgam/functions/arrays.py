"""Array expressions with explicit null and tie rules; none of them needs a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(values: Column) -> Column:
    """The elements that are not null."""
    return F.filter(values, lambda v: v.isNotNull())


def list_mode(values: Column) -> Column:
    """The most frequent element, nulls ignored; of equals the one seen first."""
    seen = present(values)
    ranked = F.transform(
        F.array_distinct(seen),
        lambda v: F.struct(F.size(F.filter(seen, lambda w: w == v)).alias("n"), (-F.array_position(seen, v)).alias("p"), v.alias("v")),
    )
    return F.array_max(ranked)["v"]


def by_frequency(values: Column, most: int | None = None) -> Column:
    """Distinct elements, most frequent first, then first seen; at most ``most`` of them."""
    seen = present(values)
    ranked = F.transform(
        F.array_distinct(seen),
        lambda v: F.struct((-F.size(F.filter(seen, lambda w: w == v))).alias("n"), F.array_position(seen, v).alias("p"), v.alias("v")),
    )
    out = F.transform(F.array_sort(ranked), lambda r: r["v"])
    return F.slice(out, 1, most) if most else out


def any_value(values: Column) -> Column:
    """The first element that is not null."""
    return F.get(present(values), F.lit(0))


def distinct(values: Column) -> Column:
    """Sorted distinct elements without null."""
    return F.sort_array(F.array_distinct(present(values)))


def joined(*lists: Column) -> Column:
    """Concatenation in which a null list is an empty one."""
    return F.concat(*[F.coalesce(x, F.array()) for x in lists])


def flattened(lists: Column) -> Column:
    """Flatten that skips null lists."""
    return F.flatten(present(lists))


def contains(values: Column, value) -> Column:
    """Membership that is false, never null."""
    return F.coalesce(F.array_contains(values, value), F.lit(False))


def n_distinct(values: Column) -> Column:
    return F.size(F.array_distinct(present(values)))
