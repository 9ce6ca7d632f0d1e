"""Counting pairs of a group's rows that ascend in two orders, without listing them.

Rows are numbered within their group by the first order. Two numbers differ first at some binary digit: those of
one pair agree in the digits above it, where one has 0 and the other 1. So for each digit, the group's rows fall into
blocks that agree above it, and the pairs are counted in each block by one pass in the second order. A group
of n rows has log2(n) digits, so n log n thin rows are sorted in all, however many pairs there are.

The passes are ranks by one range-partitioned sort (``ranking``), so a group of a third of all rows is spread
over the partitions and no window exceeds one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwise.operators.iterate import materialize
from ringwise.operators.ranking import later_in_group


def ascending_pairs(rows: DataFrame, group: list[str], first: str, second: str) -> DataFrame:
    """(group, pairs): pairs of rows of a group of which one is less in ``first`` and less in ``second``.

    ``first`` must be unique within a group; equal values in ``second`` make no pair. Groups without pairs have no row.
    """
    numbered = later_in_group(rows.select(*group, first, second), group, first).drop(first).withColumnRenamed("later", "_n")
    # all digits that a number of the group can have
    sizes, _ = materialize(numbered.groupBy(*group).agg(F.max("_n").alias("_top")).where("_top > 0"), "pairs-sizes")
    digits = F.explode(F.sequence(F.lit(0), F.length(F.bin("_top")) - 1)).alias("_digit")
    dealt = numbered.join(sizes, group).select(*group, second, "_n", digits)
    block, digit = F.expr("shiftright(_n, _digit + 1)"), F.expr("shiftright(_n, _digit) & 1")
    # rows of larger number are less in the first order: a 1 pairs with each later 0; of equal rows, the 0 comes first
    dealt = dealt.select(*group, second, "_n", "_digit", block.alias("_block"), digit.alias("_one"), (1 - digit).alias("_zero"))
    counted = later_in_group(dealt, [*group, "_digit", "_block"], [second, "_one", "_n"], weight="_zero")
    return counted.where("_one = 1").groupBy(*group).agg(F.sum("later").alias("pairs")).where("pairs > 0")
