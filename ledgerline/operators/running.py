"""Ordered running values per key that stay whole when one key is huge.

``running`` evaluates values such as "previous row", "last valid value so far"
or "sum so far" over the rows of a key. Normally that is one Spark window per
key. When the caller gives a slice column (see ``hot.cut_slices``), the rows of
hot keys are windowed per (key, slice) and staged; a table with one row per
slice carries each value from slice to slice and is joined back. Rows with a
NULL slice never touch that table. Both ways give the same result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.operators.hot import SLICE, apart, cut_slices, hot_keys
from ledgerline.sources.tables import stage

UNBOUNDED = W.unboundedPreceding


@dataclass(frozen=True)
class Previous:
    """Value of the row before, NULL included."""

    value: Column

    def within(self, w: WindowSpec) -> Column:
        return F.lag(F.struct(self.value.alias("v"))).over(w)

    def of_slice(self, at: Column) -> Column:
        return F.max_by(F.struct(self.value.alias("v")), at)

    def before_slice(self, w: WindowSpec, part: Column) -> Column:
        return F.lag(part).over(w)

    def merge(self, within: Column, before: Column) -> Column:
        return F.coalesce(within, before)

    def finish(self, merged: Column) -> Column:
        return merged["v"]


@dataclass(frozen=True)
class Latest:
    """Last non-NULL value so far; ``strictly`` leaves out the current row."""

    value: Column
    strictly: bool = False

    def within(self, w: WindowSpec) -> Column:
        return F.last(self.value, ignorenulls=True).over(w.rowsBetween(UNBOUNDED, -1 if self.strictly else 0))

    def of_slice(self, at: Column) -> Column:
        return F.max_by(self.value, F.when(self.value.isNotNull(), at))

    def before_slice(self, w: WindowSpec, part: Column) -> Column:
        return F.last(part, ignorenulls=True).over(w.rowsBetween(UNBOUNDED, -1))

    def merge(self, within: Column, before: Column) -> Column:
        return F.coalesce(within, before)

    def finish(self, merged: Column) -> Column:
        return merged


@dataclass(frozen=True)
class SumSoFar:
    """Sum up to and including the current row; NULL counts as nothing."""

    value: Column

    def within(self, w: WindowSpec) -> Column:
        return F.sum(self.value).over(w.rowsBetween(UNBOUNDED, 0))

    def of_slice(self, at: Column) -> Column:
        return F.sum(self.value)

    def before_slice(self, w: WindowSpec, part: Column) -> Column:
        return F.sum(part).over(w.rowsBetween(UNBOUNDED, -1))

    def merge(self, within: Column, before: Column) -> Column:
        return F.when(before.isNull(), within).when(within.isNull(), before).otherwise(within + before)

    def finish(self, merged: Column) -> Column:
        return merged


@dataclass(frozen=True)
class LargestSoFar:
    """Largest value up to and including the current row; NULL counts as nothing."""

    value: Column

    def within(self, w: WindowSpec) -> Column:
        return F.max(self.value).over(w.rowsBetween(UNBOUNDED, 0))

    def of_slice(self, at: Column) -> Column:
        return F.max(self.value)

    def before_slice(self, w: WindowSpec, part: Column) -> Column:
        return F.max(part).over(w.rowsBetween(UNBOUNDED, -1))

    def merge(self, within: Column, before: Column) -> Column:
        return F.greatest(within, before)

    def finish(self, merged: Column) -> Column:
        return merged


@dataclass(frozen=True)
class LatestOfAll:
    """Last non-NULL value of the whole key, on each of its rows."""

    value: Column

    def within(self, w: WindowSpec) -> Column:
        return F.last(self.value, ignorenulls=True).over(w.rowsBetween(UNBOUNDED, W.unboundedFollowing))

    def of_slice(self, at: Column) -> Column:
        return F.max_by(self.value, F.when(self.value.isNotNull(), at))

    def before_slice(self, w: WindowSpec, part: Column) -> Column:
        return F.last(part, ignorenulls=True).over(w.rowsBetween(UNBOUNDED, W.unboundedFollowing))

    def merge(self, within: Column, before: Column) -> Column:
        return F.coalesce(before, within)

    def finish(self, merged: Column) -> Column:
        return merged


@dataclass(frozen=True)
class TotalOfAll:
    """Sum (or max) over the whole key, on each of its rows."""

    value: Column
    combine: str = "sum"

    def _agg(self, value: Column) -> Column:
        return F.max(value) if self.combine == "max" else F.sum(value)

    def within(self, w: WindowSpec) -> Column:
        return self._agg(self.value).over(w.rowsBetween(UNBOUNDED, W.unboundedFollowing))

    def of_slice(self, at: Column) -> Column:
        return self._agg(self.value)

    def before_slice(self, w: WindowSpec, part: Column) -> Column:
        return self._agg(part).over(w.rowsBetween(UNBOUNDED, W.unboundedFollowing))

    def merge(self, within: Column, before: Column) -> Column:
        return F.coalesce(before, within)

    def finish(self, merged: Column) -> Column:
        return merged


def running(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[Column],
    values: Mapping[str, object],
    slice_by: str | None = None,
    backwards: bool = False,
) -> DataFrame:
    """Add one column per entry of ``values``, over ``key`` in ``order``.

    ``order`` must be total. ``backwards`` says that it runs from late to early,
    so that slices are visited in that direction, too. Column names in ``values``
    must be new.
    """
    keys = list(key)
    if slice_by is None:
        w = W.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[op.finish(op.within(w)).alias(name) for name, op in values.items()])

    w = W.partitionBy(*keys, slice_by).orderBy(*order)
    local = df.select(
        "*",
        F.row_number().over(w).alias("_at"),
        *[op.within(w).alias(f"_in_{name}") for name, op in values.items()],
    )
    # Read twice below; unstaged, each further pass would double the work before it.
    local = stage(local, "running")
    parts = (
        local.where(F.col(slice_by).isNotNull())
        .groupBy(*keys, slice_by)
        .agg(*[op.of_slice(F.col("_at")).alias(f"_of_{name}") for name, op in values.items()])
    )
    across = W.partitionBy(*keys).orderBy(F.desc(slice_by) if backwards else F.asc(slice_by))
    carried = parts.select(
        *keys,
        slice_by,
        *[op.before_slice(across, F.col(f"_of_{name}")).alias(f"_pre_{name}") for name, op in values.items()],
    )
    renamed = carried.select("*", *[F.col(k).alias(f"_of_{k}") for k in [*keys, slice_by]]).drop(*keys, slice_by)
    same = F.lit(True)
    for k in [*keys, slice_by]:  # NULL is a key like any other; a NULL slice meets none
        same = same & (F.col(k) == F.col(f"_of_{k}") if k == slice_by else F.col(k).eqNullSafe(F.col(f"_of_{k}")))
    joined = local.join(renamed, same, "left")
    return joined.select(
        *[c for c in df.columns],
        *[
            op.finish(op.merge(F.col(f"_in_{name}"), F.col(f"_pre_{name}"))).alias(name)
            for name, op in values.items()
        ],
    )


def running_measured(
    df: DataFrame,
    key: Sequence[str],
    seconds: Column,
    order: Sequence[Column],
    values: Mapping[str, object],
    hot_rows: int | None = None,
) -> DataFrame:
    """``running`` with the keys too big for one task found first.

    Keys are counted by the first key column. ``order`` must start with the time
    that ``seconds`` gives, and not depend on the other key columns.
    """
    first = key[0]
    hot = hot_keys(df, first, hot_rows)

    def sliced(rows: DataFrame) -> DataFrame:
        return running(cut_slices(rows, first, [seconds, *order], "running-cut"), key, order, values, SLICE).drop(SLICE)

    return apart(df, first, hot, lambda rows: running(rows, key, order, values), sliced)
