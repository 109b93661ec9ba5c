"""H2 by distinct runs: blocks of texts against the narrow encode."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenmill.operators import run_blocks
from tokenmill.operators.bpe import BPETokenizer
from tokenmill.operators.bpe_kernel import BatchEncoder, tokenize_text


def tokenizer(*merges):
    tok = BPETokenizer(len(merges))
    for rank, (l, r) in enumerate(merges):
        tok._register(rank, 98, l, r, 1)
    return tok


TOK = tokenizer(("l", "o"), ("lo", "w"), ("a", "b"))


def test_texts_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(n):
        made.add(1)
        return f"low {n} slow low"
    df = spark.range(0, 40, 1, 4).select(F.col("id").alias("doc_id"), text("id").alias("text"))
    got = {r["doc_id"]: r["encoded"] for r in TOK.encode(df, strategy="distinct").collect()}
    assert got[7] == [99, 3, TOK.stoi["7"], 3, 85, 99, 3, 99]
    assert len(got) == made.value == 40


def test_every_different_run_is_solved_once(spark, monkeypatch):
    monkeypatch.setattr(run_blocks, "LEAST", 64)  # several blocks and slots
    solved = spark.sparkContext.accumulator(0)
    stoi = TOK.stoi

    class Counting(BatchEncoder):
        def run_ids(self, runs):
            solved.add(len(runs))
            return super().run_ids(runs)
    df = spark.createDataFrame([(i, f"low r{i % 9} slow  x r{i % 4}") for i in range(60)], "doc_id long, text string")
    got = run_blocks.encode_by_runs(df, "text", "encoded", lambda: Counting(stoi))
    assert {r["doc_id"]: r["encoded"] for r in got.collect()} == {r["doc_id"]: r["encoded"] for r in TOK.encode(df).collect()}
    assert solved.value == 2 + 9  # low, slow, r0 to r8; a run of one character never travels


def test_blocks_agree_with_the_narrow_encode(spark, monkeypatch):
    monkeypatch.setattr(run_blocks, "LEAST", 32)
    texts = ["low slow", None, "", " ", "  low\n\nab a", "abé low", "　low　x ", "ab" * 300, "東京", "~", "a\U0001f600b ab", "low\tlow"]
    df = spark.createDataFrame([(i, t, i * 2) for i, t in enumerate(texts * 3)], "doc_id long, text string, more long")
    got = TOK.encode(df, on_oov="null", strategy="distinct")
    assert got.columns == ["doc_id", "text", "more", "encoded"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, TOK.encode(df, on_oov="null").collect()))
    none = df.where("doc_id < 0")
    assert TOK.encode(none, strategy="distinct").collect() == []


def test_rows_of_one_key_share_their_runs(spark):
    df = spark.createDataFrame([(1, "low ab"), (1, "low"), (2, "ab"), (2, None), (None, "low"), (None, None), (3, "x"), (3, "é")],
                               "doc_id long, text string")
    got = sorted(((r["doc_id"], r["text"], r["encoded"]) for r in TOK.encode(df, on_oov="null", strategy="distinct").collect()), key=str)
    assert got == sorted([(1, "low ab", [99, 99, 3, 100]), (1, "low", [99, 99, 3, 100]), (2, "ab", [100]), (2, None, None),
                          (None, "low", []), (None, None, None), (3, "x", None), (3, "é", None)], key=str)


@pytest.mark.parametrize("entries", [3, 0])
def test_run_ids_by_text_and_run_by_run(monkeypatch, entries):
    from tokenmill.operators import bpe_kernel
    if not entries:
        monkeypatch.setattr(bpe_kernel, "REWRITE_ENTRIES", 0)
    runs = ["low", "slow", "abé", "abab", "xyz"]
    got = BatchEncoder(TOK.stoi).run_ids(pa.array(runs)).to_pylist()
    assert got == [None if "é" in r else [TOK.stoi[t] for t in tokenize_text(r, TOK.stoi)] for r in runs]
    assert BatchEncoder(TOK.stoi).run_ids(pa.array([], pa.string())).to_pylist() == []
