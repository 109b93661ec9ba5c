"""Ordinals, positional split, stream split, shuffle batches, plan shape."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import docs_df
from tokenmill.operators import batching as W
from tokenmill.plans.ordinal import prefix_sums, with_ordinal


def test_split_sizes_use_binary_doubles(spark):
    df = spark.range(100).withColumnRenamed("id", "doc_id")
    out = W.train_test_split(df, 0.29)
    assert out.where(F.col("split") == "train").count() == 28
    out = W.train_test_split(spark.range(1000).withColumnRenamed("id", "doc_id"), 0.9)
    train = out.where(F.col("split") == "train").agg(F.max("doc_id")).first()[0]
    assert train == 899


def test_ordinal_matches_row_number(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"),
                                  (F.col("id") % 3).alias("g"), (F.col("id") % 11).alias("v"))
    got, totals = with_ordinal(df, ["k"], ["g"], value=F.col("v"), cum_out="cum")
    w = Window.partitionBy("g").orderBy("k")
    ref = df.select("k", "g", (F.row_number().over(w) - 1).alias("ord"),
                    F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                               F.lit(0)).alias("cum"))
    assert got.select("k", "g", "ord", "cum").exceptAll(ref).count() == 0
    assert totals == (5000, df.agg(F.sum("v")).first()[0])


def test_ordinal_plan_has_no_single_partition_exchange(spark):
    df = spark.range(1000).withColumnRenamed("id", "doc_id")
    out, _ = with_ordinal(df, ["doc_id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_stream_split(spark):
    df = spark.createDataFrame([(0, [1, 2, 3]), (1, [4, 5]), (2, [6, 7, 8, 9, 10])],
                               "doc_id long, encoded array<int>")
    rows = W.stream_split(df, 0.5).orderBy("doc_id").collect()  # 10 tokens, cut at 5
    assert [(r["train"], r["test"]) for r in rows] == [([1, 2, 3], []), ([4, 5], []),
                                                        ([], [6, 7, 8, 9, 10])]
    rows = W.stream_split(df, 0.4).orderBy("doc_id").collect()  # cut at 4
    assert rows[1]["train"] == [4] and rows[1]["test"] == [5]


def test_shuffle_batches_cover_each_epoch(spark):
    df = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("train").alias("split"))
    args = W.TrainArgs(n_epochs=3, batch_size=16)
    b = W.shuffle_batches(df, args)
    per = b.groupBy("epoch").agg(F.countDistinct("doc_id").alias("n"), F.max("batch_id").alias("mb"))
    assert sorted((r["epoch"], r["n"], r["mb"]) for r in per.collect()) == [(1, 50, 3), (2, 50, 3), (3, 50, 3)]
    o1 = [r["doc_id"] for r in b.where("epoch = 1").orderBy("ord").collect()]
    o2 = [r["doc_id"] for r in b.where("epoch = 2").orderBy("ord").collect()]
    assert o1 != o2 and sorted(o1) == list(range(50))
    plan = W.batch_plan(b, args).where("epoch = 1").orderBy("batch_id").collect()
    assert [r["step"] for r in plan] == [False, False, False, True]
    assert [r["log"] for r in plan] == [True, False, False, True]


def test_only_keys_cross_an_exchange(spark):
    """W1 and M1 read a framed corpus without shuffling texts or arrays."""
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"),
                                  F.array(F.lit(1), F.lit(5), F.lit(2)).alias("encoded"))
    out = W.train_test_split(df, 0.9)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.where(F.col("split") == "train").count() == 1800
    from tokenmill.operators.ngram import transitions
    plan = transitions(out.where(F.col("split") == "train"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "encoded" not in plan.split("Exchange")[0]


def test_keys_of_any_ordered_type(spark):
    names = ["b", "", "aa", "é", "Z", "a", "zz"]
    got, _ = with_ordinal(spark.createDataFrame([(x,) for x in names], "k string"), ["k"])
    assert [r["k"] for r in got.orderBy("ord").collect()] == sorted(names)
    empty, totals = with_ordinal(spark.createDataFrame([], "k string"), ["k"])
    assert empty.count() == 0 and totals == (0, 0)


def test_blocks_follow_the_row_count(spark, monkeypatch):
    from tokenmill.plans import ordinal
    monkeypatch.setattr(ordinal, "BLOCK_ROWS", 50)
    got, _ = with_ordinal(spark.range(3000).withColumnRenamed("id", "k"), ["k"])
    assert [r["ord"] for r in got.orderBy("k").collect()] == list(range(3000))


def test_many_blocks_give_the_same(spark):
    df = spark.range(1500).select((F.col("id") * 7 % 1500).alias("k"), (F.col("id") % 5).alias("v"))
    few, _ = with_ordinal(df, ["k"], value=F.col("v"), cum_out="cum")
    many, _ = with_ordinal(df, ["k"], value=F.col("v"), cum_out="cum", n_blocks=150)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))


def test_prefix_sums_of_ten_thousand_blocks(spark):
    from itertools import accumulate
    rows = [(3 * k, k % 7, k % 5) for k in range(10_000)]
    got = sorted(map(tuple, prefix_sums(spark.createDataFrame(rows, "b long, n long, v long"), "b", ["n", "v"]).collect()))
    want = zip((r[0] for r in rows), accumulate([0] + [r[1] for r in rows]), accumulate([0] + [r[2] for r in rows]))
    assert got == list(want)
    plan = prefix_sums(spark.range(10).withColumn("n", F.lit(1)), "id", ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "CASE" not in plan


def test_numbering_has_no_case_tree(spark):
    got, _ = with_ordinal(spark.range(1000).withColumnRenamed("id", "k"), ["k"], n_blocks=50)
    assert "CASE" not in got._jdf.queryExecution().executedPlan().toString()


def test_shuffled_positions_are_a_permutation_for_every_size(spark):
    n = F.col("id")
    rows = spark.range(1, 2001).repartition(16).withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    got = (rows.select("id", W.shuffled_position(F.col("x"), n, F.lit("seed:1")).alias("y")).groupBy("id")
           .agg(F.countDistinct("y").alias("k"), F.min("y").alias("low"), F.max("y").alias("high")).persist())
    assert got.count() == 2000 and got.where("k <> id or low <> 0 or high <> id - 1").count() == 0


def test_shuffle_needs_no_exchange_per_epoch(spark):
    keys = W.split_keys(spark.range(500).withColumnRenamed("id", "doc_id"), 0.9)
    plan = W.shuffle_batches(keys, W.TrainArgs(n_epochs=3))._jdf.queryExecution().executedPlan().toString()
    ordinals = keys._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == ordinals.count("Exchange") and "Sort" not in plan


def test_a_key_on_both_sides_of_the_cut_raises(spark):
    import pytest
    df = spark.createDataFrame([(1,), (2,), (2,), (3,)], "doc_id long")
    with pytest.raises(ValueError):
        W.train_test_split(df, 0.5)
    rows = W.train_test_split(df, 0.75).collect()
    assert sorted(r["split"] for r in rows) == ["test", "train", "train", "train"]
    df = spark.createDataFrame([(None,), (1,), (2,), (3,)], "doc_id long")
    assert {r["doc_id"]: r["split"] for r in W.train_test_split(df, 0.5).collect()} == {
        None: "train", 1: "train", 2: "test", 3: "test"}
