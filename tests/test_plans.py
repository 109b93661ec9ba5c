"""Plan-shape checks: broadcasts where sizes are known, no single-task
windows, filters evaluated after (not inlined into) expensive columns."""

from conftest import docs_df
from pyspark.sql import functions as F

from tokenmill.operators import batching as W
from tokenmill.operators import sequence as S
from tokenmill.operators.bpe import BPETokenizer
from tokenmill.operators.tokenizer import CharacterTokenizer


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_vocabulary_join_is_broadcast(spark):
    tok = BPETokenizer(2).fit(docs_df(spark, ["ab ab ab"]))
    plan = _plan(tok.encode_by_join(docs_df(spark, ["ab ba"])))
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_shuffle_batches_has_no_single_partition_exchange(spark):
    df = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("train").alias("split"))
    plan = _plan(W.shuffle_batches(df, W.TrainArgs(n_epochs=2)))
    assert "SinglePartition" not in plan


def test_length_filter_runs_after_encoding(spark):
    enc = CharacterTokenizer().encode(docs_df(spark, ["abc", "abcdefgh"]))
    opt = S.length_filter(enc, 5)._jdf.queryExecution().optimizedPlan().toString()
    filter_lines = [ln for ln in opt.splitlines() if "Filter" in ln]
    assert filter_lines and all("transform" not in ln for ln in filter_lines)


def test_joins_carry_a_row_for_each_different_token(spark):
    """A join encoder's rows follow a document's different tokens, not its length."""
    from tokenmill.operators.arrow_ids import places
    df = spark.createDataFrame([(1, [5, 7, 5, 5]), (2, []), (3, None)], "doc_id long, ids array<int>")
    rows = {(r["doc_id"], r["id"], None if r["at"] is None else tuple(r["at"])) for r in places(df, "ids", "id", "int").collect()}
    assert rows == {(1, 5, (0, 2, 3)), (1, 7, (1,)), (2, None, ()), (3, None, None)}
    tok = BPETokenizer(2).fit(docs_df(spark, ["ab ab ab"]))
    plan = _plan(tok.encode_by_join(docs_df(spark, ["ab ba"])))
    assert "posexplode" not in plan


def test_losses_exchange_no_positions(spark):
    from tokenmill.operators import ngram as M
    df = spark.createDataFrame([(1, [1, 5, 7, 2]), (2, [1, 5, 2, 0])], "doc_id long, encoded array<int>")
    plan = _plan(M.sequence_losses(df, M.transitions(df), 10))
    assert "keys=[doc_id" in plan and "keys=[doc_id" not in plan.split("MapInArrow")[-1] and "explode" not in plan


def test_spread_follows_the_rows(spark, tmp_path):
    """One row group in many splits is read by one task, whatever the number of splits."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F
    from tokenmill.sources.tables import spread
    rows = {"doc_id": list(range(4000)), "text": [f"text {i * 7919}" for i in range(4000)]}
    keys = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    filled = lambda df: df.select(F.spark_partition_id()).distinct().count()
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        pq.write_table(pa.table(rows), tmp_path / "one.parquet")
        pq.write_table(pa.table(rows), tmp_path / "even.parquet", row_group_size=125)
        one = spark.read.parquet(str(tmp_path / "one.parquet"))
        target = spark.sparkContext.defaultParallelism
        assert one.rdd.getNumPartitions() >= target and filled(one) == 1
        assert filled(spread(one, "doc_id")) >= target
        assert sorted(r["doc_id"] for r in spread(one, "doc_id").collect()) == rows["doc_id"]
        even = spark.read.parquet(str(tmp_path / "even.parquet"))
        assert spread(even, "doc_id") is even
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_corpus_is_encoded_once(spark):
    """Split, counts and both kinds of the framed filter read stored ids."""
    from tokenmill.plans import queries as Q
    for name in ("transitions", "framed_filter"):
        plan = Q.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" not in plan, name


def test_reference_cleaning_deletes_what_the_pattern_does(spark):
    from pyspark.sql import functions as F
    from tokenmill.functions import text as TX
    texts = ["".join(map(chr, range(0x300))), "".join(map(chr, range(0x2000, 0x2070))), "a　 b\\\\c\x85\x1c d", "", None, "Привет мир\n\\"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = df.select(TX.clean_text(F.col("text")).alias("x"), F.regexp_replace(TX.transliterate(F.col("text")), f"[{TX.WS_CLASS}\\\\]+", "").alias("y")).collect()
    assert [r["x"] for r in rows] == [r["y"] for r in rows]
