"""Array-valued token expressions (G1, G3, G5-G9, W2, W7), all built-in
but the character ids, which tasks look up in arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenmill.functions.vocab import EOS_ID, PAD_ID, SOS_ID
from tokenmill.operators.arrow_ids import char_ids


def raise_oov(what: str) -> Column:
    return F.raise_error(F.lit(f"token not in vocabulary ({what})"))


def char_encode(text: Column, on_oov: str = "fail") -> Column:
    """One id per character.  ``on_oov``: 'fail' raises; 'null' gives a NULL
    array for a text that holds any character outside the vocabulary."""
    ids = char_ids(text)
    if on_oov == "fail":
        return F.when(ids.isNull() & text.isNotNull(), raise_oov("character").cast("array<int>")).otherwise(ids)
    return ids


def frame(encoded: Column, context_length: int, sos: int = SOS_ID,
          eos: int = EOS_ID, pad: int = PAD_ID) -> Column:
    """[SOS] + encoded + [EOS] + PAD... to length ``context_length + 1``.

    Callers keep only rows with ``size(encoded) < context_length`` (P3).
    """
    n_pad = F.lit(context_length) - F.size(encoded) - 1
    return F.concat(F.array(F.lit(sos)), encoded, F.array(F.lit(eos)),
                    F.array_repeat(F.lit(pad), n_pad))


def shift_inputs(seq: Column) -> Column:
    """G7 x: all but the last element."""
    return F.slice(seq, 1, F.greatest(F.size(seq) - 1, F.lit(0)))


def shift_targets(seq: Column) -> Column:
    """G7 y: all but the first element."""
    return F.slice(seq, 2, F.greatest(F.size(seq) - 1, F.lit(0)))


def adjacent_pairs(seq: Column) -> Column:
    """Array of struct(l, r) for each adjacent pair (empty if size < 2).

    Two shifted slices zipped together; no index lambda, so it stays cheap.
    """
    n = F.greatest(F.size(seq) - 1, F.lit(0))
    return F.arrays_zip(F.slice(seq, 1, n).alias("l"), F.slice(seq, 2, n).alias("r"))


def keep_last(seq: Column, n: int) -> Column:
    """The last ``n`` elements."""
    return F.slice(seq, F.greatest(F.size(seq) - n, F.lit(0)) + 1, n)


def split_point(length: Column, ratio: float) -> Column:
    """``int(ratio * length)`` on binary doubles (Q12), as a BIGINT."""
    return F.floor(F.lit(float(ratio)).cast("double") * length.cast("double")).cast("long")


def head(seq: Column, n: Column) -> Column:
    """W2 train part: first ``n`` elements."""
    return F.slice(seq, 1, n.cast("int"))


def tail(seq: Column, n: Column) -> Column:
    """W2 test part: everything after the first ``n`` elements."""
    return F.slice(seq, n.cast("int") + 1, F.greatest(F.size(seq) - n.cast("int"), F.lit(0)))


def append(seq: Column, x: Column) -> Column:
    """Append one token."""
    return F.concat(seq, F.array(x))


def ids_str(seq: Column) -> Column:
    """Arrays leave queries as space-joined strings (oracle-friendly)."""
    return F.array_join(F.transform(seq, lambda x: x.cast("string")), " ")
