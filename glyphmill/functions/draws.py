"""Seeded draws as pure expressions: equal for equal seeds, whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(n, *parts) -> Column:
    """An integer from 0 to n - 1 that depends on the parts alone."""
    joined = F.concat_ws("|", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    bits = F.conv(F.substring(F.md5(joined.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(bits, n if isinstance(n, Column) else F.lit(n))


def between(low, high, *parts) -> Column:
    """An integer from low to high, both included."""
    return draw(high - low + 1, *parts) + low


def unit(*parts) -> Column:
    """A number in [0, 1) in steps of 2**-20."""
    return draw(1 << 20, *parts) / float(1 << 20)


def uniform(low: float, high: float, *parts) -> Column:
    return low + (high - low) * unit(*parts)


def choice(values, *parts) -> Column:
    """One of a short list of constants."""
    return F.element_at(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]), (draw(len(values), *parts) + 1).cast("int"))


def weighted(values, weights, *parts) -> Column:
    """One of a short list of constants, as often as its whole weight says."""
    return choice([v for v, w in zip(values, weights) for _ in range(w)], *parts)


def shuffled(values: Column, *parts) -> Column:
    """An array column in a drawn order, inside its row."""
    keyed = F.transform(values, lambda v, i: F.struct(F.md5(F.concat_ws("|", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts], i.cast("string")).cast("binary")).alias("k"), v.alias("v")))
    return F.transform(F.array_sort(keyed), lambda s: s["v"])
