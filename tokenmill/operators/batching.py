"""Order-based corpus operators: W1 split, W3 stream split, W4 shuffle and
batches, W5 optimizer/log schedule.

All ordinals come from :func:`tokenmill.plans.ordinal.with_ordinal`, so no
step funnels the corpus through one task; shuffled positions are computed from
them row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.functions import arrays as A
from tokenmill.plans.ordinal import with_ordinal


@dataclass(frozen=True)
class TrainArgs:
    """Trainer defaults of the reference (job parameters here)."""
    n_epochs: int = 20
    batch_size: int = 16
    n_accumulation_steps: int = 4
    log_interval: int = 3
    train_test_split_ratio: float = 0.9
    seed: str = "0"


def split_keys(df: DataFrame, ratio: float, order_col: str = "doc_id") -> DataFrame:
    """W1 on keys: (order_col, ord, split); the first ``int(ratio * N)`` rows
    by ``order_col`` are train.  Only the keys are numbered."""
    withord, (n, _) = with_ordinal(df.select(order_col), [order_col])
    cut = int(ratio * n)  # Python float semantics, exactly as upstream (Q12)
    return withord.withColumn("split", F.when(F.col("ord") < cut, F.lit("train")).otherwise(F.lit("test")))


def train_test_split(df: DataFrame, ratio: float, order_col: str = "doc_id") -> DataFrame:
    """First ``int(ratio * N)`` rows by ``order_col`` are train, rest test.

    Positional, not random.  Adds ``split``.  The one key at the cut is found
    on the numbered keys; the rows themselves are then split by a narrow
    comparison, so no text or token array is written or shuffled.  A key that
    stands on both sides of the cut names no position: that raises.
    """
    keys = split_keys(df, ratio, order_col)
    train = F.col("split") == "train"
    cut = keys.agg(F.max(F.when(train, F.col(order_col))).alias("last"), F.min(F.when(~train, F.col(order_col))).alias("first"),
                   F.max(train & F.col(order_col).isNull()).alias("null")).first()
    if cut["first"] is not None and cut["first"] == cut["last"]:
        raise ValueError(f"{order_col} repeats at the cut: {cut['first']!r}")
    if cut["first"] is None:  # all in train, or nothing but null keys
        return df.withColumn("split", F.lit("train" if cut["last"] is not None or cut["null"] else "test"))
    before = F.coalesce(F.col(order_col) < F.lit(cut["first"]), F.lit(bool(cut["null"])))
    return df.withColumn("split", F.when(before, F.lit("train")).otherwise(F.lit("test")))


def stream_split(df: DataFrame, train_size: float, col: str = "encoded",
                 order_col: str = "doc_id") -> DataFrame:
    """The corpus read as one token stream (documents in ``order_col``
    order) is cut at ``int(train_size * total)``; the one straddling document
    is sliced.  Adds ``offset`` (tokens before the document), ``train``, ``test``.
    """
    if not 0 <= train_size <= 1:
        raise ValueError("train_size must be between 0 and 1")
    sizes = df.select(order_col, F.size(col).alias("_n"))
    offsets, (_, total) = with_ordinal(sizes, [order_col], value=F.col("_n"), cum_out="offset")
    cut = int(train_size * total)
    k = F.least(F.greatest(F.lit(cut) - F.col("offset"), F.lit(0)), F.size(col))
    return df.join(offsets.select(order_col, "offset"), order_col).select(
        "*", A.head(F.col(col), k).alias("train"), A.tail(F.col(col), k).alias("test"))


#: Rounds of the shuffle's Feistel network, and cycle-walking steps it may take.
FEISTEL_ROUNDS, WALK_STEPS = 4, 64


def shuffled_position(ordinal: Column, n: Column | int, key: Column) -> Column:
    """W4's order: a seeded bijection of 0 .. n - 1, row by row.

    ``ordinal`` is a cell (l, r) of the near-square a x b grid that holds n; each Feistel round adds a
    hash of one coordinate to the other, modulo its side, which can be undone,
    so the rounds permute the grid.  A cell beyond n - 1 (fewer than a of the
    a * b are) goes through the rounds again until it is within: cycle
    walking, which keeps it a permutation of 0 .. n - 1.  ``WALK_STEPS`` is
    beyond the walk of any n seen by chance below n ** -32; a longer one fails
    rather than repeat a position.  No row needs another: no sort, no exchange.
    """
    n = n if isinstance(n, Column) else F.lit(n).cast("long")
    a = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    b = F.ceil(n / a).cast("long")

    def draw(i: Column, v: Column) -> Column:
        digest = F.md5(F.concat_ws(":", key, i.cast("string"), v.cast("string")))
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")

    def turn(s: Column, i: Column) -> Column:
        l, r = s["l"], s["r"]
        return F.when(i % 2 == 0, F.struct(((l + draw(i, r)) % a).alias("l"), r.alias("r"))).otherwise(
            F.struct(l.alias("l"), ((r + draw(i, l)) % b).alias("r")))

    def once(x: Column) -> Column:
        cell = F.struct(F.floor(x / b).cast("long").alias("l"), (x % b).cast("long").alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(FEISTEL_ROUNDS - 1)), cell, turn, lambda s: s["l"] * b + s["r"])

    def walk(x: Column) -> Column:
        steps = F.aggregate(F.sequence(F.lit(1), F.lit(WALK_STEPS)), x, lambda y, _: F.when(y < n, y).otherwise(once(y)))
        return F.transform(F.array(steps), lambda y: F.when(y < n, y).otherwise(
            F.raise_error(F.lit("cycle walk too long")).cast("long")))[0]

    # the one-element array names the first cell, so few rows pay for a walk
    return F.transform(F.array(once(ordinal.cast("long"))), lambda y: F.when(y < n, y).otherwise(walk(y)))[0]


def shuffle_batches(df: DataFrame, args: TrainArgs = TrainArgs(),
                    split_col: str = "split", key_col: str = "doc_id", first_epoch: int = 1) -> DataFrame:
    """For every epoch and split, a seeded shuffle cut into batches of
    ``batch_size``; the last partial batch stays.  Both loaders shuffle.

    One row per (epoch, document): ``epoch``, ``ord`` (position in the
    shuffled epoch), ``batch_id``.  ``df`` holds the keys with their ``ord``
    as :func:`split_keys` numbers them (each split a run of ordinals); keys
    without are numbered once.  Every epoch's position follows from the
    ordinal alone (:func:`shuffled_position`), so epochs cost no exchange.
    Only the keys travel: the result is a small assignment table, joined back
    to the sequences where needed.
    """
    if "ord" not in df.columns:
        df, _ = with_ordinal(df.select(key_col, split_col), [split_col, key_col])
    df = df.select(key_col, split_col, "ord")
    sizes = df.groupBy(split_col).agg(F.min("ord").alias("first"), F.count(F.lit(1)).alias("n"), F.max("ord").alias("last")).collect()
    if any(r["last"] - r["first"] + 1 != r["n"] for r in sizes):
        raise ValueError(f"ord does not run through within each {split_col}")
    ep = df.withColumn("epoch", F.explode(F.sequence(F.lit(first_epoch), F.lit(args.n_epochs))))
    place = F.lit(None).cast("long")
    for r in sizes:  # one row a split
        key = F.concat_ws(":", F.lit(args.seed), F.col("epoch").cast("string"), F.lit(r[split_col]))
        place = F.when(F.col(split_col).eqNullSafe(F.lit(r[split_col])),
                       shuffled_position(F.col("ord") - r["first"], r["n"], key)).otherwise(place)
    out = ep.withColumn("ord", place)
    return out.withColumn("batch_id", F.floor(F.col("ord") / args.batch_size).cast("long"))


def batch_plan(batches: DataFrame, args: TrainArgs = TrainArgs()) -> DataFrame:
    """Per training batch, whether the optimizer steps and whether the
    loss is logged, plus the logged example counter."""
    tr = batches.where(F.col("split") == "train")
    sizes = tr.groupBy("epoch", "batch_id").agg(F.count(F.lit(1)).alias("n_examples"))
    n = tr.where(F.col("epoch") == 1).count()
    n_batches = -(-n // args.batch_size)
    b = F.col("batch_id")
    seen = F.least((b + 1) * args.batch_size, F.lit(n))
    return sizes.select(
        F.col("epoch").cast("long").alias("epoch"), b.cast("long").alias("batch_id"),
        F.col("n_examples").cast("long").alias("n_examples"),
        seen.cast("long").alias("examples_seen"),
        (((b + 1) % args.n_accumulation_steps == 0) | (b + 1 == n_batches)).alias("step"),
        ((b % args.log_interval == 0) | (seen == n)).alias("log"),
        (b * args.batch_size + (F.col("epoch") - 1) * n).cast("long").alias("train_counter"))


def test_counters(n_train: int, args: TrainArgs = TrainArgs()) -> list[int]:
    """Example counters at which the test loss is recorded (epochs 0..n)."""
    return [i * n_train for i in range(args.n_epochs + 1)]
