"""H2 by distinct runs, in blocks of texts.

Texts are dealt by ``doc_id`` over blocks of about ``BLOCK`` bytes.  A block
sends its different runs, one row for each slot (a hash of the run); a slot
meets all blocks' rows, solves each different run once and answers row by row;
a block joins the answers back by run and puts them in the places of its runs.
A row holds many runs as one text or one packed array, so what Spark moves,
sorts and copies are rows of blocks, not of runs.  The number of blocks and
slots follows the bytes of text, so a task's memory does not grow with the
table; a frequent run comes once from each block.

Runs are maximal stretches without white space or one white space character;
those of one character are their own tokens and never travel.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill.operators.arrow_ids import char_table, code_points, lists, row_of
from tokenmill.session import materialize

#: Bytes of text that a block holds and, were all runs different, a slot meets;
#: small tables are cut finer for their cores, down to ``LEAST``.
BLOCK, SLOT, LEAST = 1 << 23, 1 << 24, 1 << 18


@functools.lru_cache(maxsize=1)
def _space() -> np.ndarray:
    return np.array([chr(c).isspace() for c in range(0x110000)])


def _one(column, kind: pa.DataType) -> pa.Array:
    """The column of a table as one array."""
    whole = column.combine_chunks()
    return whole if whole.type == kind else whole.cast(kind)


def cut(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(runs of each row; of each run: whether it has two characters or more,
    and the character id of its first or -1; the texts of the long runs)."""
    texts = pc.fill_null(texts, "")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    data = texts.buffers()[2] if offsets[-1] else None
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.zeros(0, np.uint8)
    units, bounds, byte = raw, offsets - offsets[0], None
    if len(raw) and raw.max() > 127:
        units = code_points(raw.tobytes().decode())
        byte = np.append(0, np.cumsum(1 + (units >= 0x80) + (units >= 0x800) + (units >= 0x10000)))
        bounds = np.searchsorted(byte, bounds)
    space = _space()[units]
    head = space.copy()
    head[1:] |= space[:-1]
    head[bounds[:-1][bounds[:-1] < len(units)]] = True
    starts = np.flatnonzero(head)
    ends = np.append(starts, len(units))
    long = np.diff(ends) > 1
    at = pa.py_buffer((ends if byte is None else byte[ends]).astype(np.int32))
    runs = pa.StringArray.from_buffers(len(starts), at, pa.py_buffer(raw)).filter(pa.array(long))
    return np.diff(np.searchsorted(starts, bounds)), long, char_table()[units[starts]], runs


def _packed(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Rows of ``sizes`` whole numbers each as binary values."""
    at = np.append(0, np.cumsum(sizes, dtype=np.int64) * 4).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(values, np.int32))])


def _unpacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each row's values."""
    ends = np.append(0, np.cumsum(values, dtype=np.int64))
    at = np.append(0, np.cumsum(sizes))
    return ends[at[1:]] - ends[at[:-1]]


def _sent(col: str, slots: int):
    """A block's different long runs, one row a slot, parted by spaces."""
    def run(key, table):
        known = pc.unique(cut(_one(table[col], pa.string()))[3])
        slot = np.array([zlib.crc32(r) % slots for r in known.cast(pa.binary()).to_pylist()], np.int64)
        filled, sizes = np.unique(slot, return_counts=True)
        runs = lists(known.take(pa.array(np.argsort(slot, kind="stable"))), sizes, np.zeros(len(filled), bool))
        return pa.table({"_block": pa.array([key[0].as_py()] * len(filled), pa.int32()), "_slot": pa.array(filled, pa.int32()),
                         "_runs": pc.binary_join(runs, " ")})
    return run


def _solved(encoder):
    """A slot's rows with the number of ids of each run (-1: out of vocabulary)
    and the ids, each different run encoded once."""
    def run(table):
        runs = _one(table["_runs"], pa.string())
        parts = pc.split_pattern(runs, " ")
        coded = parts.flatten().dictionary_encode()
        ids = encoder().run_ids(coded.dictionary).take(coded.indices)
        sizes = pc.fill_null(pc.list_value_length(ids), -1).to_numpy(zero_copy_only=False)
        n_runs = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        return pa.table({"_block": _one(table["_block"], pa.int32()), "_runs": runs, "_sizes": _packed(sizes, n_runs),
                         "_ids": _packed(flat, _sums(np.maximum(sizes, 0), n_runs))})
    return run


def _answers(table) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(runs, sizes, ids) of all answers to a block."""
    if not table.num_rows:
        return pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(0, np.int32)
    return (pc.split_pattern(_one(table["_runs"], pa.string()), " ").flatten(),
            _unpacked(_one(table["_sizes"], pa.binary())), _unpacked(_one(table["_ids"], pa.binary())))


def _merged(keys: pa.Array, sizes: np.ndarray, code: np.ndarray, known: pa.Array, found: pa.Array) -> pa.Array:
    """``found`` where rows of one key share their runs: in the order of their
    places, equal places by their ids; none where one of them has none."""
    coded = keys.dictionary_encode()
    group = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False)
    times = np.bincount(group[group >= 0], minlength=1)
    if times.max() < 2:
        return found
    ends = np.append(0, np.cumsum(sizes))
    rows_of: dict[int, list[int]] = {}
    for i in np.flatnonzero((group >= 0) & (times[group] > 1)).tolist():
        rows_of.setdefault(int(group[i]), []).append(i)
    take, made = np.arange(len(found)), []
    for rows in rows_of.values():
        parts = [(place, ids) for i in rows for place, ids in enumerate(known.take(pa.array(code[ends[i]:ends[i + 1]])).to_pylist())]
        take[rows] = len(found) + len(made)
        made.append(None if any(ids is None for _, ids in parts) else [v for _, ids in sorted(parts) for v in ids])
    return pa.concat_arrays([found, pa.array(made, found.type)]).take(pa.array(take))


def _whole(col: str, out: str):
    """A block's rows with the ids of their texts, null for a text that is null
    or holds a run out of vocabulary."""
    def run(rows, answers):
        texts = _one(rows[col], pa.string())
        runs, n_ids, ids = _answers(answers)
        sizes, long, first, mine = cut(texts)
        # all answers, then each character's id as a list of one, then an unknown character
        letters = np.arange(int(char_table().max()) + 1, dtype=np.int32)
        each = np.concatenate([n_ids, np.ones(len(letters), np.int32), [-1]])
        known = lists(np.concatenate([ids, letters]), np.maximum(each, 0), each < 0)
        code = np.where(first < 0, len(each) - 1, len(runs) + first).astype(np.int64)
        code[long] = pc.index_in(mine, value_set=runs).to_numpy(zero_copy_only=False)
        bad = _sums(each[code] < 0, sizes) > 0
        null = bad | texts.is_null().to_numpy(zero_copy_only=False)
        row = row_of(sizes)
        kept = code[~null[row]]
        found = lists(known.take(pa.array(kept)).flatten(), np.where(null, 0, _sums(np.maximum(each[code], 0), sizes)), null)
        found = _merged(_one(rows["doc_id"], rows["doc_id"].type), sizes, code, known, found)
        found = pc.if_else(texts.is_null(), pa.scalar(None, found.type), found)
        names = [n for n in rows.column_names if n != "_block"]
        return pa.table([*(rows[n] for n in names), found], [*names, out])
    return run


def encode_by_runs(df: DataFrame, col: str, out: str, encoder) -> DataFrame:
    """``df`` with the ids of its texts, every different run solved once by
    ``encoder()``, a :class:`BatchEncoder`.  The texts are stored once, so that
    neither their number nor what makes them is worked out again."""
    spark = df.sparkSession
    size = F.octet_length(col).alias("_size")
    stored = materialize(df.select("*", size), "texts")
    total = stored.agg(F.sum("_size")).first()[0] or 0
    cores = spark.sparkContext.defaultParallelism
    parts = lambda most: max(-(-total // most), min(4 * cores, -(-total // LEAST)), 1)
    # rows without a key have no row to share their runs with: dealt by text
    key = F.when(F.col("doc_id").isNull(), F.xxhash64(col)).otherwise(F.xxhash64("doc_id"))
    blocks = stored.drop("_size").withColumn("_block", F.pmod(key, F.lit(parts(BLOCK))).cast("int"))
    blocks = blocks.repartition(parts(BLOCK), "_block")  # both uses below read the one exchange
    sent = blocks.groupBy("_block").applyInArrow(_sent(col, parts(SLOT)), "_block int, _slot int, _runs string")
    solved = sent.groupBy("_slot").applyInArrow(_solved(encoder), "_block int, _runs string, _sizes binary, _ids binary")
    schema = T.StructType([*stored.drop("_size").schema, T.StructField(out, T.ArrayType(T.IntegerType()))])
    return blocks.groupBy("_block").cogroup(solved.groupBy("_block")).applyInArrow(_whole(col, out), schema)
