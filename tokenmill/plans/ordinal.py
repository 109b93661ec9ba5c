"""Global ordinals and running sums without a single-partition window.

``row_number() over (order by k)`` with no partition moves every row into one
task.  Instead the keys are range-partitioned into blocks, each sorted in its
own task, and a row's position is the rows before its block plus its place in
the block.  The place comes with the row (``monotonically_increasing_id`` is
block and place in one number), so numbering needs no window.

Rows before a block are prefix sums over one row a block, taken in two levels
(inside runs of ``FAN`` blocks, then over the runs) and kept as a table: no
row of it reaches the driver, however many blocks there are.  Spark picks the
join of rows and block offsets by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.session import materialize

#: Rows that one block (one sort task) is sized for.
BLOCK_ROWS = 1_000_000
#: Blocks whose prefix sums one window partition takes.
FAN = 1024
#: A monotonically increasing id holds the place of the row in its low bits.
_PLACE_BITS = 33


def prefix_sums(blocks: DataFrame, key: str, values: list[str], fan: int = FAN) -> DataFrame:
    """(key, values): for each row of ``blocks`` the sums of ``values`` over
    the rows of smaller ``key``, a whole number that is unique.

    Two levels: the last one orders one row for each ``fan`` blocks.
    """
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    total = lambda v, w: F.coalesce(F.sum(v).over(earlier(w)), F.lit(0))
    rows = blocks.select(key, *values, F.floor(F.col(key) / fan).alias("_run"))
    runs = rows.groupBy("_run").agg(*[F.sum(v).alias(f"_run_{v}") for v in values])
    runs = runs.select("_run", *[total(f"_run_{v}", Window.orderBy("_run")).alias(f"_run_{v}") for v in values])
    inside = Window.partitionBy("_run").orderBy(key)
    rows = rows.select(key, "_run", *[total(v, inside).alias(v) for v in values])
    return rows.join(runs, "_run").select(key, *[(F.col(v) + F.col(f"_run_{v}")).alias(v) for v in values])


def with_ordinal(df: DataFrame, order_cols: list[str], group_cols: list[str] | None = None, out: str = "ord",
                 value: Column | None = None, cum_out: str | None = None,
                 n_blocks: int | None = None) -> tuple[DataFrame, tuple[int, int]]:
    """Add ``out`` = 0-based position of the row within its group by
    ``order_cols`` (of any ordered type; a total order, or equal rows are
    numbered arbitrarily), and optionally ``cum_out`` = sum of ``value`` over
    all earlier rows of the group.

    Returns (DataFrame, (row count, value sum)) over the whole input.  Callers
    pass keys (and sizes), never texts or token arrays: the input is written
    once to the checkpoint folder, and again in order.  The number of blocks
    follows the row count.
    """
    groups = list(group_cols or [])
    order = [F.col(c).asc_nulls_first() for c in [*groups, *order_cols]]
    d = df.withColumn("_val", (value if value is not None else F.lit(0)).cast("long"))
    d = materialize(d, "ordinal-input")
    count, total = d.agg(F.count(F.lit(1)), F.coalesce(F.sum("_val"), F.lit(0))).first()
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = n_blocks or max(1, min(least, -(-count // 1000)), -(-count // BLOCK_ROWS))
    d = d.repartitionByRange(blocks, *order).sortWithinPartitions(*order)
    # written in order, so block and place stay what they are when a task is lost
    d = materialize(d.withColumn("_at", F.monotonically_increasing_id()), "ordinal-blocks")
    d = (d.withColumn("_blk", F.shiftright("_at", _PLACE_BITS))
         .withColumn("_place", F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))).drop("_at"))
    sums = d.groupBy("_blk").agg(F.count(F.lit(1)).alias("_rows"), F.sum("_val").alias("_sum"))
    d = d.join(materialize(prefix_sums(sums, "_blk", ["_rows", "_sum"]), "ordinal-offsets"), "_blk")
    d = d.withColumn(out, F.col("_rows") + F.col("_place"))
    if cum_out:
        before = Window.partitionBy("_blk").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
        d = d.withColumn(cum_out, F.col("_sum") + F.coalesce(F.sum("_val").over(before), F.lit(0)))
    if groups:
        firsts = [F.min(out).alias("_first")] + ([F.min(cum_out).alias("_first_sum")] if cum_out else [])
        d = d.join(d.groupBy(*groups).agg(*firsts), groups)
        d = d.withColumn(out, F.col(out) - F.col("_first"))
        if cum_out:
            d = d.withColumn(cum_out, F.col(cum_out) - F.col("_first_sum"))
    return d.drop("_val", "_blk", "_place", "_rows", "_sum", "_first", "_first_sum"), (count, total)
