"""Which interval of its key contains a point in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import epoch_micros
from ledgerline.operators.hot import SLICE, cut_slices
from ledgerline.operators.running import LargestSoFar, Latest, Previous, running
from ledgerline.sources.tables import stage

BITS = 2  # a bucket of time holds four of the level below
LEVELS = 27  # from one microsecond to 4 ** 26 of them, 142 years
BLOCK = 1024  # facts, and intervals, that meet in one group of a bucket
BUCKET = ["_key", "_level", "_bucket"]


def interval_join(
    facts: DataFrame,
    intervals: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str,
    carry: Sequence[str],
    applies=None,
    hot: Sequence = (),
) -> DataFrame:
    """Left join facts to the half-open intervals ``[start, end)`` around ``at``.

    ``end`` must be filled in. ``carry`` names the interval columns to add; facts
    for which ``applies`` is not true, or whose key is NULL, get NULLs. Intervals
    of a key normally follow each other, so the last one to start decides: facts
    and starts are put in time order and each fact sees the start before it.

    The part of an interval after the next start of its key is an overhang. If
    there are any, the sweep also carries how far they reach: a fact lies in an
    overhang exactly if the farthest end so far is later than the fact. Only
    these facts meet the overhangs, in buckets of time (``_stabbed``).

    ``intervals`` is read several times: pass a staged frame. Give all keys as
    ``hot`` if the rows of one may be too many for a task.
    """
    slice_by = SLICE if hot else None
    applies = F.lit(True) if applies is None else applies
    intervals = intervals.where(F.col(key).isNotNull())
    info = F.struct(F.col(start).alias("start"), F.col(end).alias("end"), *carry)
    over = _overhang(intervals.select(key, info.alias("_iv")), key, hot)
    over = stage(over.withColumn("_id", F.monotonically_increasing_id()), "interval-overhang")
    overlaps = not over.isEmpty()

    starts = intervals.select(F.col(key), F.col(start).alias("_t"), info.alias("_iv")).where(F.col("_t").isNotNull())
    points = facts.withColumn("_t", F.col(at)).withColumn("_fact", F.lit(True))
    rows = points.unionByName(starts, allowMissingColumns=True)
    values = {"_last": Latest(F.col("_iv"))}
    if overlaps:
        reaches = over.select(F.col(key), F.col("_next").alias("_t"), F.col("_over.end").alias("_end"))
        rows = rows.unionByName(reaches, allowMissingColumns=True)
        values["_reach"] = LargestSoFar(F.col("_end"))
    # At one time, starts come before facts; the order among facts does not matter.
    order = [F.asc_nulls_first("_t"), F.asc_nulls_first("_fact"), F.asc("_iv")]
    if hot:
        spread = F.xxhash64(*facts.columns)  # lets a cut fall between facts of one time
        rows = cut_slices(rows, key, [*order, spread], "interval-cut")
    seen = running(rows, [key], order, values, slice_by).where("_fact")
    inside = F.col("_last.end") > F.col(at)
    hit = F.when(applies & inside, F.col("_last"))
    carried = [F.col(f"_hit.{c}").alias(c) for c in carry]
    if not overlaps:
        return seen.withColumn("_hit", hit).select(*facts.columns, *carried)
    open_at = F.coalesce(applies & (F.col("_reach") > F.col(at)), F.lit(False))
    seen = seen.select(
        *facts.columns, hit.alias("_hit"), open_at.alias("_open"), F.monotonically_increasing_id().alias("_id")
    )
    seen = stage(seen, "interval-facts")
    alone = seen.where(F.col("_hit").isNotNull() | ~F.col("_open")).select(*facts.columns, "_hit")
    stabbed = _stabbed(seen.where("_open"), over, key, at)
    both = stabbed.select(*[F.col(f"_row.{c}").alias(c) for c in facts.columns], F.col("_over").alias("_hit"))
    return alone.unionByName(both).select(*facts.columns, *carried)


def _overhang(intervals: DataFrame, key: str, hot: Sequence) -> DataFrame:
    """Parts of intervals that lie after the start of the next one of their key."""
    rows = intervals
    if hot:
        rows = cut_slices(rows, key, [F.asc("_iv")], "overhang-cut")
    later = running(rows, [key], [F.desc("_iv")], {"_next": Previous(F.col("_iv.start"))}, SLICE if hot else None, True)
    return later.where(F.col("_iv.end") > F.col("_next")).select(key, "_next", F.col("_iv").alias("_over"))


def _stabbed(facts: DataFrame, over: DataFrame, key: str, at: str) -> DataFrame:
    """All pairs of a fact (``_row``) and an overhang ``[_next, _over.end)`` around it.

    An overhang is cut into whole buckets of time, at most six a level and each
    as large as fits, so a fact in it lies in exactly one of them. A fact looks
    into its bucket of every level. Buckets need no further test: whatever meets
    in one is a pair of the result.

    A bucket of f facts and o overhangs is a grid of groups of about ``BLOCK`` a
    side. Facts are repeated once per row of the grid and overhangs once per
    column, so no task holds all of a bucket and the repeats stay below the pairs.
    The grid has one row per bucket; where its join meets a heavy bucket, adaptive
    execution splits the other side. Ids are stored ones, so a task run again
    deals its rows alike.
    """
    levels = F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("_level")
    # Plain columns up to the last join: Spark loses fields of a struct that passes several generators.
    row = [F.col(c).alias(f"_row_{i}") for i, c in enumerate(facts.columns)]
    fields = over.schema["_over"].dataType.names
    part = [F.col("_over")[c].alias(f"_over_{i}") for i, c in enumerate(fields)]
    points = facts.select(F.col(key).alias("_key"), epoch_micros(F.col(at)).alias("_at"), "_id", *row)
    points = points.select("*", levels)
    points = points.withColumn("_bucket", _floored(F.col("_at"), F.col("_level"))).drop("_at")
    spans = over.select(
        F.col(key).alias("_key"),
        "_id",
        *part,
        epoch_micros(F.col("_next")).alias("_from"),
        epoch_micros(F.col("_over.end")).alias("_until"),
    )
    row = [f"_row_{i}" for i in range(len(row))]
    part = [f"_over_{i}" for i in range(len(part))]
    spans = spans.select("*", levels)
    spans = spans.select("_key", "_id", *part, "_level", F.explode(_whole_buckets()).alias("_bucket"))

    grid = (
        _sizes(spans, "_rows")
        .join(_sizes(points, "_columns"), BUCKET)
        .select(*BUCKET, "_rows", "_columns")
    )
    points = points.join(grid, BUCKET).select(
        *BUCKET, *row, _dealt("_columns").alias("_column"), F.explode(_upto("_rows")).alias("_line")
    )
    spans = spans.join(grid, BUCKET).select(
        *BUCKET, *part, _dealt("_rows").alias("_line"), F.explode(_upto("_columns")).alias("_column")
    )
    pairs = points.join(spans, [*BUCKET, "_line", "_column"])
    return pairs.select(
        F.struct(*[F.col(a).alias(c) for a, c in zip(row, facts.columns, strict=True)]).alias("_row"),
        F.struct(*[F.col(a).alias(c) for a, c in zip(part, fields, strict=True)]).alias("_over"),
    )


def _floored(micros: Column, level: Column) -> Column:
    return F.call_function("shiftright", micros, level * BITS)


def _whole_buckets() -> Column:
    """Buckets of ``_level`` inside ``[_from, _until)``, without those in a whole bucket of the next level."""
    level, above = F.col("_level"), F.col("_level") + 1

    def ends(at_level: Column) -> tuple[Column, Column]:
        return -_floored(-F.col("_from"), at_level), _floored(F.col("_until"), at_level)

    first, last = ends(level)
    up_first, up_last = ends(above)
    covered = (above < LEVELS) & (up_first < up_last)
    wide = 1 << BITS
    left = F.when(covered, up_first * wide).otherwise(last)
    right = F.when(covered, up_last * wide).otherwise(last)
    return F.concat(_range(first, left), _range(right, last))


def _range(first: Column, end: Column) -> Column:
    none = F.array().cast("array<bigint>")
    return F.when(first < end, F.sequence(first, F.greatest(first, end - 1))).otherwise(none)


def _sizes(rows: DataFrame, name: str) -> DataFrame:
    """Groups into which the rows of each bucket are dealt."""
    return rows.groupBy(*BUCKET).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias(name))


def _dealt(groups: str) -> Column:
    return F.pmod(F.xxhash64("_id"), F.col(groups))


def _upto(groups: str) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.col(groups) - 1)
