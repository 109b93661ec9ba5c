"""Pluggable tokenizers over DataFrames.

``fit(df, col) -> self``, ``encode(df, col, out) -> df``,
``decode(df, col, out) -> df``.  The fitted state is three small tables held
on the driver (bounded by the number of merges) and shipped to tasks either
as literals, broadcast joins or a broadcast variable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.functions import arrays as A
from tokenmill.functions import text as TX
from tokenmill.functions.vocab import base_stoi, char_of_id
from tokenmill.operators.arrow_ids import in_order, joined_ids, joined_text, places, token_text


class Tokenizer:
    """Base class: vocabulary ``stoi`` (last write wins) and ``itos`` (all ids)."""

    def __init__(self) -> None:
        self.stoi: dict[str, int] = base_stoi()
        self.itos: dict[int, str] = {v: k for k, v in self.stoi.items()}

    def __len__(self) -> int:  # A5: keys of stoi, which may be < max id + 1 (Q5)
        return len(self.stoi)

    # -- to be provided by subclasses -------------------------------------
    def fit(self, df: DataFrame, col: str = "text") -> "Tokenizer":
        raise NotImplementedError

    def tokenize(self, df: DataFrame, col: str, out: str) -> DataFrame:
        raise NotImplementedError

    # -- shared ------------------------------------------------------------
    def encode(self, df: DataFrame, col: str = "text", out: str = "encoded",
               on_oov: str = "fail") -> DataFrame:
        """Tokens -> ids through a broadcast join with the vocabulary table
        (a literal map would be scanned key by key for every token)."""
        return self.encode_by_join(df, col, out, on_oov)

    def decode_col(self, ids: Column) -> Column:
        """Concatenate the tokens of the ids (unknown id -> error)."""
        text = token_text(ids, [self.itos.get(i) for i in range(max(self.itos) + 1)])
        return F.when(text.isNull() & ids.isNotNull(), A.raise_oov("id").cast("string")).otherwise(text)

    def decode(self, df: DataFrame, col: str = "encoded", out: str = "text") -> DataFrame:
        return df.withColumn(out, self.decode_col(F.col(col)))

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(sorted(self.stoi.items(), key=lambda kv: kv[1]),
                                     "token string, id int")

    def inverse_vocab_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(sorted((k, v) for k, v in self.itos.items()),
                                     "id int, token string")


class CharacterTokenizer(Tokenizer):
    """One token per character; ``fit`` is a no-op (K3)."""

    def fit(self, df: DataFrame, col: str = "text") -> "CharacterTokenizer":
        return self

    def tokenize(self, df: DataFrame, col: str, out: str) -> DataFrame:
        return df.withColumn(out, TX.chars(F.col(col)))

    def encode(self, df: DataFrame, col: str = "text", out: str = "encoded",
               on_oov: str = "fail") -> DataFrame:
        """Closed-form ids, O(1) per character, no map lookups."""
        return df.withColumn(out, A.char_encode(F.col(col), on_oov))

    def decode_col(self, ids: Column) -> Column:
        def one(i: Column) -> Column:
            return F.coalesce(char_of_id(i), F.when(i == 0, F.lit("<PAD>"))
                              .when(i == 1, F.lit("<SOS>")).when(i == 2, F.lit("<EOS>")),
                              A.raise_oov("id").cast("string"))
        return F.array_join(F.transform(ids, one), "")


def oov_report(df: DataFrame, col: str, tokenizer: Tokenizer | None = None) -> DataFrame:
    """Characters of ``col`` missing from the base vocabulary.

    (token, occurrences, documents) via explode + left-anti join against the
    vocabulary table (broadcast: its size is the tokenizer's, known here).
    """
    tokenizer = tokenizer or CharacterTokenizer()
    spark = df.sparkSession
    vocab = F.broadcast(tokenizer.vocab_df(spark).select(F.col("token").alias("c")))
    exploded = df.select("doc_id", F.explode(TX.chars(F.col(col))).alias("c"))
    missing = exploded.join(vocab, "c", "left_anti")
    return missing.groupBy(F.col("c").alias("token")).agg(
        F.count(F.lit(1)).cast("long").alias("occurrences"),
        F.countDistinct("doc_id").cast("long").alias("documents"))


def quarantine(df: DataFrame, col: str, tokenizer: Tokenizer | None = None) -> tuple[DataFrame, DataFrame]:
    """P8 with the quarantine policy: (rows whose characters are all in the
    vocabulary, the others with ``n_oov``, their number of characters that are
    not).  Both are narrow filters of the input; a NULL text is no OOV."""
    tokenizer = tokenizer or CharacterTokenizer()
    known = "".join(sorted(t for t in tokenizer.stoi if len(t) == 1))
    n_oov = F.length(F.translate(F.col(col), known, ""))
    rest = df.withColumn("n_oov", F.coalesce(n_oov, F.lit(0)).cast("long"))
    return rest.where(F.col("n_oov") == 0).drop("n_oov"), rest.where(F.col("n_oov") > 0)


def _encode_by_join(self: Tokenizer, df: DataFrame, col: str = "text",
                    out: str = "encoded", on_oov: str = "fail") -> DataFrame:
    """J1 as a join: one row for each document and different token with the
    token's places, equi-join the vocabulary (broadcast; its size is the
    tokenizer's), reassemble per document by place.  A group holds at most as
    many rows as the vocabulary and the unknown tokens, and 4 bytes a token."""
    spark = df.sparkSession
    tok = self.tokenize(df.select("doc_id", col), col, "_tokens")
    vocab = F.broadcast(self.vocab_df(spark))  # as large as the tokenizer
    joined = places(tok, "_tokens", "token", "string").join(vocab, "token", "left")
    if on_oov == "fail":
        joined = joined.withColumn("id", F.when(F.col("token").isNotNull(), F.coalesce(
            F.col("id"), A.raise_oov("token").cast("int"))))
    per_doc = joined.groupBy("doc_id").agg(
        F.max((F.col("token").isNotNull() & F.col("id").isNull())).alias("_oov"),
        F.collect_list(F.when(F.col("id").isNotNull(), F.struct("at", F.col("id").alias("v")))).alias("parts"))
    res = df.join(in_order(per_doc, out, "array<int>", "_oov", joined_ids), "doc_id", "left")
    return res.withColumn(out, F.when(F.col(col).isNotNull() & ~F.col("_oov"), F.col(out))).drop("_oov")


Tokenizer.encode_by_join = _encode_by_join


def _decode_by_join(self: Tokenizer, df: DataFrame, col: str = "encoded",
                    out: str = "text") -> DataFrame:
    """J2 as a join: one row for each document and different id with the id's
    places, equi-join the inverse vocabulary (broadcast; tokenizer-sized),
    concatenate per document in the order of the places.  An unknown id
    raises, as upstream's KeyError."""
    spark = df.sparkSession
    ex = places(df, col, "id", "int")
    inv = F.broadcast(self.inverse_vocab_df(spark))  # as large as the tokenizer
    joined = ex.join(inv, "id", "left").withColumn("token", F.when(F.col("id").isNotNull(), F.coalesce(
        F.col("token"), A.raise_oov("id").cast("string"))))
    per_doc = joined.groupBy("doc_id").agg(
        F.max(F.col("at").isNull()).alias("_null"),
        F.collect_list(F.when(F.col("id").isNotNull(), F.struct("at", F.col("token").alias("v")))).alias("parts"))
    res = df.drop(col).join(in_order(per_doc, out, "string", "_null", joined_text), "doc_id", "left")
    return res.withColumn(out, F.when(~F.col("_null"), F.col(out))).drop("_null")


Tokenizer.decode_by_join = _decode_by_join
