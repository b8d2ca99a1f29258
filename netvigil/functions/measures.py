"""Aggregates that work alike on single flows and on pre-summed rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLOW_COUNT = "flow_count"


def sum_name(metric: str) -> str:
    return f"{metric}_sum"


PART_BITS = 21


def exact_sum(value: Column) -> Column:
    """Sum of longs that never overflows.

    The three parts of 21 bits (the highest with the sign) are summed as longs, which keeps the hash aggregate and
    has room for 2**42 rows, and joined at the end.
    """
    mask = F.lit(2**PART_BITS - 1).cast("long")
    parts = [F.shiftright(value, 2 * PART_BITS), F.shiftright(value, PART_BITS).bitwiseAND(mask), value.bitwiseAND(mask)]
    high, middle, low = (F.sum(part).cast("decimal(20,0)") for part in parts)
    scale = F.lit(2**PART_BITS).cast("decimal(8,0)")
    return ((high * scale + middle).cast("decimal(29,0)") * scale + low).cast("decimal(38,0)")


def as_double(total: Column) -> Column:
    return total.cast("double")


class Measures:
    """Aggregate expressions over a flow table or over a rollup of one.

    A rollup has ``flow_count`` and ``<metric>_sum`` columns; every aggregate
    below gives the same value on it as on the flows it was built from. Sums
    are exact and wide enough for any flows, and a mean is one division at the end, so results do not
    depend on the order in which partitions are merged.
    """

    def __init__(self, table: DataFrame):
        self.rolled = FLOW_COUNT in table.columns

    def _weight(self) -> Column:
        return F.col(FLOW_COUNT) if self.rolled else F.lit(1).cast("long")

    def flows(self) -> Column:
        return F.sum(FLOW_COUNT) if self.rolled else F.count(F.lit(1))

    def flows_where(self, condition: Column) -> Column:
        if self.rolled:
            return F.sum(F.when(condition, F.col(FLOW_COUNT)).otherwise(F.lit(0)))
        return F.count_if(condition)

    def total(self, metric: str) -> Column:
        """Exact sum as decimal(38,0); ``as_double`` turns it into a number to divide."""
        if self.rolled:
            return F.sum(sum_name(metric)).cast("decimal(38,0)")
        return exact_sum(F.col(metric))

    def mean(self, metric: str) -> Column:
        return as_double(self.total(metric)) / self.flows()

    def mean_of(self, value: Column) -> Column:
        """Mean of a per-flow expression over grouping columns of the rollup."""
        return F.sum(value * self._weight()) / self.flows()
