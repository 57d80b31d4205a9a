"""Problem 4: the N best items of every group.

Method: a global range-partitioned sort on group, score and identifier; counts
of each partition's edge groups are prefix-summed into exact positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from foreglass.plans.prefix import BLOCK_ROWS, best_of_blocks, group_positions


def top_n(df: DataFrame, group: str, order: list[str], n: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The first ``n`` distinct rows of each group by ``order``, all ascending, with their ``position``.

    ``order`` must end with an identifier, so that ties are settled the same
    way every time; strings compare by their bytes, nulls come first. Rows
    with a null group come out nowhere; rows equal in all keys count once. An
    empty input gives an empty result; other columns are dropped.

    Before the sort each task keeps only the ``n`` best of a group among the
    rows of a block, so a hot group shrinks to ``n`` rows for each block before
    anything is shuffled.
    """
    rows = df.select(group, *order).filter(F.col(group).isNotNull())
    return group_positions(best_of_blocks(rows, group, order, n, block_rows), group, order, keep=n)
