"""Steps that take one part of the keys after the other, so that shuffles hold a bounded share of the disk.

A part is all rows whose key falls into one residue of a hash. A step that treats
each key by itself gives the same rows in parts as at once. Each part is stored;
its shuffle files and what it staged on the way go before the next begins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.sources.tables import COMPACT, passing, stage_parts

PASSES = 4
PASS_ROWS = 500_000  # a step all of whose tables have fewer rows runs at once


def passes_for(*tables: DataFrame) -> int:
    return PASSES if any(df.count() > PASS_ROWS for df in tables) else 1


def part_of(df: DataFrame, key: str, number: int, passes: int) -> DataFrame:
    """Rows of one pass; NULL is a key like any other."""
    return df if passes == 1 else df.where(F.pmod(F.xxhash64(key), F.lit(passes)) == number)


def in_passes(step: Callable[..., DataFrame], key: str, passes: int, label: str, *tables: DataFrame) -> DataFrame:
    """``step(*tables)``, stored part by part of ``key``, which all tables have; lazy in a single pass."""
    if passes == 1:
        return step(*tables)

    def parts() -> Iterator[DataFrame]:
        for number in range(passes):
            with passing(tables[0].sparkSession):
                yield step(*[part_of(df, key, number, passes) for df in tables])

    return stage_parts(parts(), label, COMPACT)
