"""Base vocabulary (G2) and character ids as closed-form expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The special tokens and their ids, then the base characters in
# id order (printable ASCII 32..126 without the backslash, then newline).
PAD, SOS, EOS = "<PAD>", "<SOS>", "<EOS>"
PAD_ID, SOS_ID, EOS_ID = 0, 1, 2
SPECIALS = (PAD, SOS, EOS)
BASE_CHARS = "".join(chr(c) for c in range(32, 127) if c != 92) + "\n"
BASE_SIZE = len(SPECIALS) + len(BASE_CHARS)  # 98; first learned id


def base_stoi() -> dict[str, int]:
    stoi = {tok: i for i, tok in enumerate(SPECIALS)}
    for i, ch in enumerate(BASE_CHARS):
        stoi[ch] = i + len(SPECIALS)
    return stoi


def base_vocab_df(spark: SparkSession) -> DataFrame:
    """G2 as a table ``(token string, id int)``."""
    rows = sorted(base_stoi().items(), key=lambda kv: kv[1])
    return spark.createDataFrame(rows, "token string, id int")


def char_id(c: Column) -> Column:
    """Id of a one-character string in the base vocabulary, NULL when OOV.

    Closed form of the base table: newline is 97, code points 32..91 map to
    ``cp - 29`` and 93..126 to ``cp - 30`` (the backslash, 92, is absent).
    """
    cp = F.ascii(c)
    return (F.when(c == "\n", F.lit(97))
            .when((cp >= 32) & (cp <= 91) & (F.length(c) == 1), cp - 29)
            .when((cp >= 93) & (cp <= 126) & (F.length(c) == 1), cp - 30))


def ascii_id_table() -> list[int | None]:
    """Id of each ASCII code point 0..127 (None when out of vocabulary)."""
    stoi = base_stoi()
    return [stoi.get(chr(c)) for c in range(128)]


def char_id_lookup(c: Column) -> Column:
    """Same as :func:`char_id` through a 128-entry constant array: one array
    access per character, which matters inside ``transform`` lambdas (they are
    evaluated without code generation).  Non-ASCII gives NULL."""
    lut = F.array(*[F.lit(v) for v in ascii_id_table()]).cast("array<int>")
    return F.try_element_at(lut, F.ascii(c) + 1)


def char_of_id(i: Column) -> Column:
    """Inverse of :func:`char_id` for base character ids 3..97 (NULL otherwise)."""
    return (F.when(i == 97, F.lit("\n"))
            .when((i >= 3) & (i <= 62), F.char(i + 29))
            .when((i >= 63) & (i <= 96), F.char(i + 30)))
