"""Array work on Arrow batches inside tasks: ids of characters, counts of
adjacent ids, and the places of tokens in their texts.

A batch is cut into slices of bounded size first (``SLICE``), so a Python
worker's memory follows neither the table nor the number of rows in a batch.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters or ids that one slice of a batch holds (a longer row is a slice of its own).
SLICE = 1 << 18
#: Key spaces up to this size are counted in a table, larger ones by sorting.
TABLE = 1 << 22


def slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, stop) of runs of rows whose sizes sum up to ``SLICE`` at most."""
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + SLICE, "right")))
        yield start, stop
        start = stop


def text_slices(batch: pa.Array) -> Iterator[pa.Array]:
    for a, b in slices(pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False)) if len(batch) else [(0, 0)]:
        yield batch.slice(a, b - a)


def lists(flat, sizes: np.ndarray, null: np.ndarray) -> pa.ListArray:
    """Rows of ``sizes`` values each; ``null`` marks the rows without a list."""
    at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), flat if isinstance(flat, pa.Array) else pa.array(flat), mask=pa.array(null))


def code_points(text: str) -> np.ndarray:
    if text.isascii():
        return np.frombuffer(text.encode(), np.uint8)
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def row_of(sizes: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(sizes)), sizes)


def lookup(codes: np.ndarray, table: np.ndarray, sizes: np.ndarray, null: np.ndarray) -> pa.ListArray:
    """Ids of the code points; a row that holds an unknown one (-1) is null."""
    ids = table[codes]
    bad = np.flatnonzero(ids < 0)
    if len(bad):
        null = null.copy()
        null[np.searchsorted(np.cumsum(sizes), bad, "right")] = True
    return lists(ids, sizes, null)


@functools.lru_cache(maxsize=1)
def char_table() -> np.ndarray:
    from tokenmill.functions.vocab import base_stoi
    table = np.full(0x110000, -1, np.int32)
    for token, i in base_stoi().items():
        if len(token) == 1:
            table[ord(token)] = i
    return table


def char_ids(text: Column) -> Column:
    """Ids of the characters, null for a text that holds an unknown one."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for part in text_slices(batch):
                texts = part.to_pylist()
                sizes = np.array([len(t or "") for t in texts], np.int64)
                null = np.array([t is None for t in texts], bool)
                yield lookup(code_points("".join(t or "" for t in texts)), char_table(), sizes, null)
    return F.arrow_udf(run, "array<int>")(text)


def flat_lists(column: pa.Array) -> Iterator[tuple[int, np.ndarray, pa.Array]]:
    """(first row, sizes, flat values) of the slices of a list column."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    for a, b in slices(sizes):
        yield a, sizes[a:b], column.slice(a, b - a).flatten()


#: Stands for a null id while ids are counted.
_NULL = -(1 << 31)


def _grams(sizes: np.ndarray, values: np.ndarray, order: int, split: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, grams, counts): the different (up to ``order - 1`` ids, next id)
    of the rows, one column an id, counted over all rows or, with ``split``,
    for each row.  ``_NULL - 1`` stands before the first id of a row."""
    row = row_of(sizes)
    place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.flatnonzero(place > 0)  # the next id's place
    columns = [np.where(place[at] > k, values[np.maximum(at - 1 - k, 0)], _NULL - 1) for k in range(order - 2, -1, -1)]
    columns.append(values[at])
    key, parts = (row[at] if split else np.zeros(len(at), np.int64)), []
    space = len(sizes) if split else 1
    for column in columns:
        low, high = (int(column.min()), int(column.max())) if len(column) else (0, 0)
        known, code = None, column - low
        if high - low >= TABLE or low < _NULL + TABLE:  # sparse ids, or marks among them
            known, code = np.unique(column, return_inverse=True)
        width = len(known) if known is not None else high - low + 1
        if space * width >= 1 << 62:
            seen, key = np.unique(key, return_inverse=True)
            parts.append(("dense", seen))
            space = len(seen)
        parts.append(("id", known, low, width))
        key, space = key * width + code, space * width
    if space <= TABLE:
        counts = np.bincount(key, minlength=1)
        keys = np.flatnonzero(counts)
        counts = counts[keys]
    else:
        keys, counts = np.unique(key, return_counts=True)
    out = []
    for part in reversed(parts):
        if part[0] == "dense":
            keys = part[1][keys]
            continue
        _, known, low, width = part
        keys, code = np.divmod(keys, max(width, 1))
        out.append(known[code] if known is not None else code + low)
    return keys, np.stack(out[::-1], 1) if out else np.zeros((0, order)), counts


def _contexts(grams: np.ndarray) -> pa.Array:
    """Space-joined ids of the columns; of a single id that is null, null."""
    if grams.shape[1] == 1:
        ids = pa.array(grams[:, 0], mask=grams[:, 0] == _NULL)
        return ids.cast(pa.string())
    known, code = np.unique(grams, axis=0, return_inverse=True)
    names = [" ".join(str(v) for v in row if v > _NULL) for row in known.tolist()]
    return pa.array(names, pa.string()).take(pa.array(code.reshape(-1)))


def gram_counts(df: DataFrame, col: str, order: int, key: str | None = None) -> DataFrame:
    """([key,] ctx, next, c): each task's counts of (context, next id) in the id
    lists ``col``: over a slice of rows, or with ``key`` over each single row."""
    kind = f"{key} {df.schema[key].dataType.simpleString()}, " if key else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(col))
            for first, sizes, flat in flat_lists(column):
                values = pc.fill_null(flat, _NULL).to_numpy(zero_copy_only=False).astype(np.int64)
                rows, grams, counts = _grams(sizes, values, order, key is not None)
                if not len(counts):
                    continue
                out = [_contexts(grams[:, :-1]), pa.array(grams[:, -1].astype(np.int32), mask=grams[:, -1] == _NULL), pa.array(counts.astype(np.int64))]
                names = ["ctx", "next", "c"]
                if key:
                    out, names = [batch.column(batch.schema.get_field_index(key)).take(pa.array(rows + first)), *out], [key, *names]
                yield pa.RecordBatch.from_arrays(out, names)
    columns = [key, col] if key else [col]
    return df.select(*columns).mapInArrow(run, f"{kind}ctx string, next int, c long")


def char_pair_counts(df: DataFrame, col: str) -> DataFrame:
    """(pair, c): each task's counts of two adjacent characters of the texts ``col``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch.column(0)):
                texts = [t for t in part.to_pylist() if t]
                sizes = np.array([len(t) for t in texts], np.int64)
                _, grams, counts = _grams(sizes, code_points("".join(texts)).astype(np.int64), 2, False)
                yield pa.RecordBatch.from_arrays([pa.array([chr(a) + chr(b) for a, b in grams.astype(np.int64).tolist()], pa.string()),
                                                  pa.array(counts.astype(np.int64))], ["pair", "c"])
    return df.select(col).mapInArrow(run, "pair string, c long")


def places(df: DataFrame, col: str, item: str, value_type: str) -> DataFrame:
    """(doc_id, item, at): one row for each row and different value of its list
    ``col``, with the value's places; a row without values gives a null item
    (and without a list, null places)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            for first, sizes, flat in flat_lists(column):
                coded = flat.dictionary_encode()
                known = len(coded.dictionary)
                code = pc.fill_null(coded.indices, known).to_numpy(zero_copy_only=False).astype(np.int64)
                row = row_of(sizes)
                place = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                key = row * (known + 1) + code
                order = np.argsort(key, kind="stable")
                key = key[order]
                heads = np.flatnonzero(np.diff(key, prepend=-1))
                rows, codes = np.divmod(key[heads], known + 1)
                none = codes == known
                at = pa.ListArray.from_arrays(pa.array(np.append(heads, len(key)).astype(np.int32)), pa.array(place[order].astype(np.int32)))
                items = coded.dictionary.take(pa.array(np.where(none, 0, codes), mask=none))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows + first)), items, at], ["doc_id", item, "at"])
                empty = np.flatnonzero(sizes == 0)
                if len(empty):
                    null = column.is_null().to_numpy(zero_copy_only=False)[empty + first]
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(empty + first)), pa.nulls(len(empty), flat.type),
                                                      lists(pa.array([], pa.int32()), np.zeros(len(empty), np.int64), null)], ["doc_id", item, "at"])
    kind = df.schema["doc_id"].dataType.simpleString()
    return df.select("doc_id", col).mapInArrow(run, f"doc_id {kind}, {item} {value_type}, at array<int>")


def order_of(sizes: np.ndarray, place: np.ndarray, values) -> np.ndarray:
    """Indices of the elements of each row in the order of their places; equal
    places (a repeated key) go by ``values()``."""
    start = np.cumsum(sizes) - sizes
    out = np.full(len(place), -1, np.int64)
    if not len(place) or (place < np.repeat(sizes, sizes)).all():
        out[np.repeat(start, sizes) + place] = np.arange(len(place))
    if (out >= 0).all():
        return out
    row, items = row_of(sizes), values()
    return np.array(sorted(range(len(place)), key=lambda i: (row[i], place[i], items[i])), np.int64)


def in_order(per_doc: DataFrame, out: str, out_type: str, keep: str, whole) -> DataFrame:
    """(doc_id, keep, out) of rows (doc_id, keep, parts), ``parts`` an array
    of (at, v): ``whole(sizes, elements)`` makes the list column of the values
    v, one for each place in ``at``, in the order of the places."""
    fields = ["doc_id", keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column(batch.schema.get_field_index("parts"))
            # elements of a row: the places of all its parts
            weight = pc.fill_null(pc.list_value_length(parts.flatten().field("at")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            n_parts = pc.fill_null(pc.list_value_length(parts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = np.bincount(row_of(n_parts), weight, len(n_parts)).astype(np.int64)
            for a, b in slices(sizes):
                items = parts.slice(a, b - a).flatten()
                at, v = items.field("at"), items.field("v")
                each = pc.list_value_length(at).to_numpy(zero_copy_only=False)
                place = at.flatten().to_numpy(zero_copy_only=False)
                which = np.repeat(np.arange(len(v)), each)
                order = order_of(sizes[a:b], place, lambda: [v[i].as_py() for i in which.tolist()])
                column = whole(sizes[a:b], v.take(pa.array(which[order])))
                yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(f)).slice(a, b - a) for f in fields), column], [*fields, out])
    kinds = [f"{f} {per_doc.schema[f].dataType.simpleString()}" for f in fields]
    return per_doc.select(*fields, "parts").mapInArrow(run, ", ".join([*kinds, f"{out} {out_type}"]))


def joined_ids(sizes: np.ndarray, ids: pa.Array) -> pa.Array:
    return lists(ids, sizes, np.zeros(len(sizes), bool))


def joined_text(sizes: np.ndarray, tokens: pa.Array) -> pa.Array:
    return pc.binary_join(lists(tokens, sizes, np.zeros(len(sizes), bool)), "")


def token_text(ids: Column, tokens: list[str | None]) -> Column:
    """The tokens of the ids as one text, null where an id has none."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = pa.array(tokens, pa.string())
        for batch in batches:
            for first, sizes, flat in flat_lists(batch) if len(batch) else [(0, np.zeros(0, np.int64), batch.flatten())]:
                inside = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(known)))
                text = joined_text(sizes, known.take(pc.if_else(inside, flat, pa.scalar(None, flat.type))))
                null = batch.slice(first, len(sizes)).is_null()
                yield pc.if_else(null, pa.scalar(None, pa.string()), text)
    return F.arrow_udf(run, "string")(ids)
