"""Row layout for skipping: files along a curve that keeps near values of several columns near."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.plans.numbering import running_total

#: Bits of each column's place on the curve. Three columns fit a long; more columns get fewer bits.
BITS = 16


def along_curve(df: DataFrame, columns: list[str], files: int) -> DataFrame:
    """Rows in about ``files`` range partitions along the interleaved bits of the columns' places.

    A value's place is the share of rows up to it, so a frequent tenant gets the room its rows need. The places of the
    distinct values are found by range partitions and joined back, nulls included. Rows of one cell, such as a day
    of a hot tenant, are dealt to several files by a hash of the whole row.
    """
    bits = min(BITS, 62 // len(columns))
    placed, names = df, []
    for i, name in enumerate(columns):
        mine = f"__place_{i}"
        names.append(mine)
        placed = placed.join(_places(df, name, mine, bits), F.col(name).eqNullSafe(F.col(f"{mine}_of")), "left").drop(f"{mine}_of")
    salt = F.xxhash64(*[F.col(c) for c in df.columns if not _is_map(df, c)])
    curve = interleaved([F.col(n) for n in names], bits)
    ranged = placed.withColumns({"__curve": curve, "__salt": salt}).repartitionByRange(files, "__curve", "__salt")
    return ranged.sortWithinPartitions("__curve", *columns).select(*df.columns)


def interleaved(places: list[Column], bits: int) -> Column:
    """One number of the bits of all, the highest of each first."""
    picked = [
        F.shiftleft(F.getbit(place, F.lit(b)).cast("long"), b * len(places) + len(places) - 1 - i)
        for b in range(bits) for i, place in enumerate(places)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), picked)


def _places(df: DataFrame, name: str, place: str, bits: int) -> DataFrame:
    counts = df.groupBy(F.col(name).alias(f"{place}_of")).agg(F.count(F.lit(1)).alias("__n"))
    upto = running_total(counts, "__upto", F.col("__n"), [F.asc(f"{place}_of")], total="__all")
    share = (F.col("__upto") - F.col("__n")) / F.col("__all")
    return upto.select(f"{place}_of", F.floor(share * (1 << bits)).cast("long").alias(place))


def _is_map(df: DataFrame, name: str) -> bool:
    return "map<" in df.schema[name].dataType.simpleString()
