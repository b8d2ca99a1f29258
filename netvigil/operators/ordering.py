"""Row numbers and moving frames over a whole table, without a task that sees all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netvigil.session import materialize
from netvigil.sources.flows import inline_rows

PLACE_BITS = 33  # of monotonically_increasing_id: the place within a partition
BLOCK_ROWS = 10_000


def numbered(table: DataFrame, *order: str, name: str = "row_no") -> DataFrame:
    """``table`` with the number of every row (from 0) in the given order of columns.

    Rows are dealt by ranges and sorted in their range; a row's number is its
    place there plus the rows of all ranges before, of which one count per
    range goes through the driver. The sorted ranges are written with their
    places, so that both steps see the same ones.
    """
    place = F.monotonically_increasing_id()
    ranges = table.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({
        "part": F.shiftright(place, PLACE_BITS), "place": place.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))})
    written = materialize(ranges, "ranges")
    earlier, offsets = 0, []
    for part, n in sorted(map(tuple, written.groupBy("part").count().collect())):
        offsets.append((part, earlier))
        earlier += n
    if not offsets:
        return written.select(*table.columns, F.col("place").alias(name))
    before = inline_rows(table.sparkSession, offsets, "part bigint, earlier bigint")
    return written.join(F.broadcast(before), "part").select(*table.columns, (F.col("earlier") + F.col("place")).alias(name))


def moving(table: DataFrame, order: str, rows: int, block: int = BLOCK_ROWS, **aggregates: Column) -> DataFrame:
    """Aggregates over each row and the ``rows`` - 1 before it, for a table with unique ``order`` values.

    Numbered rows are dealt in blocks, and each block is also given the rows
    before it that its first frames reach into, so every block is computed by itself.
    """
    block = max(block, rows)
    number = F.col("row_no")
    own = F.floor(number / block).cast("long")
    lent = F.floor((number + rows - 1) / block).cast("long")
    dealt = numbered(table, order).select("*", own.alias("own"), F.explode(F.array_distinct(F.array(own, lent))).alias("block"))
    frame = Window.partitionBy("block").orderBy("row_no").rowsBetween(1 - rows, Window.currentRow)
    framed = dealt.select("*", *[value.over(frame).alias(name) for name, value in aggregates.items()])
    return framed.where("own = block").select(*table.columns, *aggregates)
