"""Row frames along a global order, in blocks that know the border rows of their neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from millrace.plans.numbering import number_rows

#: Rows of a block: what one task sorts, besides the border rows.
BLOCK_ROWS = 1_000_000


def over_long_series(
    df: DataFrame, order: list, columns: dict, before: int, after: int = 0, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Windows over one series of any length, with frames of at most ``before`` rows back and ``after`` rows ahead.

    ``columns`` maps names to functions of a window, which are given the window to use: ``lambda over:
    series.moving_avg("price", over, 30)``. Rows are numbered along the order from range partitions and cut into blocks of
    equal size, whatever the distribution of the order's values. A block also gets copies of the rows that its frames
    reach in its neighbours; these are computed nowhere else and dropped afterwards. So the result equals the window
    over the whole frame, and no task holds more than ``block_rows + before + after`` rows.

    The order should end in a unique key: rows that tie stand in any order. Nulls come first where it ascends. An empty
    frame stays empty. A name that the frame has already is overwritten, as by ``withColumns``; inner names are ``__no``,
    ``__block`` and ``__home``, which a frame may not have.
    """
    if before < 0 or after < 0 or block_rows < 1:
        raise ValueError("frames reach back and ahead by rows, blocks have at least one row")
    clash = {"__no", "__block", "__home"} & set(df.columns)
    if clash:
        raise ValueError(f"the frame has columns with inner names: {sorted(clash)}")
    at = number_rows(df, "__no", order)
    home = _block(F.col("__no"), block_rows)
    # A row at place p is reached by rows p - after ... p + before, so it is needed in all of their blocks.
    first, last = _block(F.greatest(F.col("__no") - after, F.lit(1)), block_rows), _block(F.col("__no") + before, block_rows)
    dealt = at.withColumn("__home", home).withColumn("__block", F.explode(F.sequence(first, last)))
    over: WindowSpec = Window.partitionBy("__block").orderBy("__no")
    done = dealt.withColumns({name: make(over) for name, make in columns.items()})
    return done.filter("__block = __home").drop("__no", "__block", "__home")


def _block(place: Column, rows: int) -> Column:
    return F.floor((place - 1) / rows)
