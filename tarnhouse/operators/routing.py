"""Answering a grouped sum from the smallest aggregate table that can give it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnhouse.operators.bitmaps import BITS, RANGE, count_bitmaps


@dataclass(frozen=True)
class Aggregate:
    """A stored aggregate: its grouping columns and its sums.

    ``sums`` maps a measure to the column that holds its sum. ``read`` is called only
    when the aggregate is chosen. ``all_groups`` says that groups whose sums are all null are
    stored too; only then can values of the grain be counted from it. ``distinct`` maps a column
    that can be counted without being in the grain to its bitmaps by the grain.
    """

    name: str
    read: Callable[[], DataFrame]
    grain: frozenset[str]
    sums: dict[str, str]
    all_groups: bool = False
    distinct: Mapping[str, Callable[[], DataFrame]] = field(default_factory=dict)


@dataclass(frozen=True)
class Measure:
    """A requested measure: ``sum`` or ``distinct_count`` of a fact column."""

    name: str
    kind: str
    column: str


def _covers(aggregate: Aggregate, by: Sequence[str], measures: Sequence[Measure]) -> bool:
    """Sums re-aggregate from sums, distinct counts from bitmaps or a grain that has the column."""
    counted = {*(aggregate.grain if aggregate.all_groups else ()), *aggregate.distinct}
    return set(by) <= aggregate.grain and all(
        m.column in (aggregate.sums if m.kind == "sum" else counted) for m in measures
    )


def choose_aggregate(
    aggregates: Sequence[Aggregate], by: Sequence[str], measures: Sequence[Measure]
) -> Aggregate | None:
    """The covering aggregate with the fewest grouping columns, or none."""
    able = [a for a in aggregates if _covers(a, by, measures)]
    return min(able, key=lambda a: len(a.grain), default=None)


def aggregate_routing(
    base: DataFrame, aggregates: Sequence[Aggregate], by: Sequence[str], measures: Sequence[Measure]
) -> DataFrame:
    """Grouped measures from an aggregate table where one covers them, else from ``base``."""
    chosen = choose_aggregate(aggregates, by, measures)
    rows = chosen.read() if chosen else base
    sums = [
        F.sum(chosen.sums[m.column] if chosen else m.column).alias(m.name)
        for m in measures
        if m.kind == "sum"
    ]
    found = rows.groupBy(*by).agg(*sums) if sums else rows.select(*by).distinct()
    for m in (m for m in measures if m.kind == "distinct_count"):
        keys = [f"_by_{c}" for c in by]
        renamed = [F.col(c).alias(k) for c, k in zip(by, keys, strict=True)]
        if chosen and m.column in chosen.distinct:
            stored = chosen.distinct[m.column]()
            counted = count_bitmaps(stored.select(*renamed, RANGE, BITS), keys, m.name)
        else:
            # A blank counts as one value. Duplicates go first, so no task holds a group's values.
            values = rows.select(*renamed, F.col(m.column).alias("_value")).distinct()
            counted = values.groupBy(*keys).agg(F.count("*").alias(m.name))
        same = F.lit(True)
        for c in by:
            same &= F.col(c).eqNullSafe(F.col(f"_by_{c}"))
        found = found.join(counted, same).drop(*keys)
    return found
