"""Exact dedup over an extendible-hash index kept on shared files.

The index maps a text to its class.  A record is addressed by the leading
bits of ``xxhash64(text)`` through a directory of ``2**depth`` entries; an
overfull bucket is split, and the directory doubles when the split bucket
already uses all its bits.  The directory is built from a histogram of
distinct hashes over 16 leading bits (65,536 rows reach the driver at most),
with a bucket capacity that grows with the number of distinct hashes, so it
never has more than 65,536 entries however large the corpus is.

Owner tasks hold key ranges (whole buckets): rows arrive sorted by bucket and
hash, so a task holds one collision chain at a time.  Texts with equal hash
are compared byte by byte; different texts get different chain places.
Before that shuffle each task combines the copies it has read itself, so a
group of copies that holds a third of the corpus sends one row per task.
The index (bucket, hash, chain place, digest, class data; no text) is a
Parquet table in the shared folder.  Each document then finds its class by
(hash, digest) in an equi-join of narrow rows, which Spark splits when one
group is hot.

Defined cases: a null text is the empty text; of equal texts the largest id
stays (a null id is smaller than any id); of rows that repeat both id and
text exactly one stays; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm import tables as T

HISTOGRAM_BITS = 16
MAX_BUCKETS = 1 << 13
MIN_CAPACITY = 64
#: Bytes of text that a task's combiner holds before it sends what it has.
COMBINE_BYTES = 16 << 20
#: Rows that one repeated (id, text) expands to in one step.
REPEAT_BLOCK = 4096


@dataclass
class Directory:
    """``entries[p]`` is the bucket of the keys with the ``depth``-bit prefix ``p``."""

    depth: int
    entries: np.ndarray
    local_depth: list[int]

    def bucket(self, hashes: np.ndarray) -> np.ndarray:
        if self.depth == 0:
            return np.zeros(len(hashes), np.int64)
        return self.entries[(hashes.astype(np.uint64) >> np.uint64(64 - self.depth)).astype(np.int64)]


def build_directory(histogram: np.ndarray, capacity: int) -> Directory:
    """Split overfull buckets until all hold ``capacity`` keys at most or use
    every bit of the histogram (``len(histogram)`` is a power of two)."""
    bits = int(len(histogram)).bit_length() - 1
    total = np.concatenate([[0], np.cumsum(histogram)])

    def load(prefix: int, local: int) -> int:
        width = bits - local
        return int(total[(prefix + 1) << width] - total[prefix << width])

    depth, entries = 0, np.zeros(1, np.int64)
    local, prefix = [0], [0]
    waiting = [0]
    while waiting:
        b = waiting.pop()
        if local[b] == bits or load(prefix[b], local[b]) <= capacity:
            continue
        if local[b] == depth:
            entries, depth = np.repeat(entries, 2), depth + 1
        local[b] += 1
        prefix[b] <<= 1
        new = len(local)
        local.append(local[b])
        prefix.append(prefix[b] | 1)
        width = depth - local[b]
        entries[prefix[new] << width:(prefix[new] + 1) << width] = new
        waiting += [b, new]
    return Directory(depth, entries, local)


def _keys(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return df.select(F.col(f"`{id_col}`").cast("long").alias("_tm_id"), F.xxhash64(text).alias("_tm_h"),
                     F.sha2(text, 256).alias("_tm_sha"), text.alias("_tm_text"))


_ENTRY = pa.schema([("bucket", pa.int64()), ("h", pa.int64()), ("text", pa.string()), ("sha", pa.string()),
                    ("keep_id", pa.int64()), ("group_size", pa.int64()), ("n_keep", pa.int64())])
_INDEX = pa.schema([("bucket", pa.int64()), ("h", pa.int64()), ("chain", pa.int32()), ("sha", pa.string()),
                    ("keep_id", pa.int64()), ("group_size", pa.int64()), ("n_keep", pa.int64())])


def _join(chain: list, text: bytes, sha: str, keep, size: int, n_keep: int) -> bool:
    """Put a record into the collision chain of its hash; False if it was new."""
    for e in chain:
        if e[0] == text:
            if e[2] == keep:
                e[4] += n_keep
            elif e[2] is None or keep is not None and keep > e[2]:
                e[2], e[4] = keep, n_keep
            e[3] += size
            return True
    chain.append([text, sha, keep, size, n_keep])
    return False


def _combiner(directory: Directory):
    chains: dict[int, list] = {}
    held = 0

    def emit():
        nonlocal held
        rows = [(h, *e) for h, c in chains.items() for e in c]
        chains.clear()
        held = 0
        if rows:
            h, text, sha, keep, size, n_keep = zip(*rows)
            bucket = directory.bucket(np.array(h, np.int64))
            yield pa.record_batch([pa.array(bucket), pa.array(h, pa.int64()),
                                   pa.array(text, pa.binary()).cast(pa.string()), pa.array(sha), pa.array(keep, pa.int64()),
                                   pa.array(size, pa.int64()), pa.array(n_keep, pa.int64())], schema=_ENTRY)

    def fn(batch):
        nonlocal held
        cols = [batch.column(i) for i in range(4)]
        texts = cols[3].cast(pa.binary())
        for id_, h, sha, text in zip(*(c.to_pylist() for c in cols[:3]), texts.to_pylist()):
            if not _join(chains.setdefault(h, []), text, sha, id_, 1, 1):
                held += len(text) + 256
                if held > COMBINE_BYTES:
                    yield from emit()

    fn.end = emit
    return fn


def _owner():
    at, chain = None, []

    def flush(out):
        out += [(*at, i, *e[1:]) for i, e in enumerate(chain)]
        chain.clear()

    def batch_of(out):
        cols = list(zip(*out))
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, _INDEX)], schema=_INDEX)

    def fn(batch):
        nonlocal at
        out: list = []
        texts = batch.column(2).cast(pa.binary()).to_pylist()
        rest = [batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5, 6)]
        for text, bucket, h, sha, keep, size, n_keep in zip(texts, *rest):
            if at != (bucket, h):
                flush(out)
                at = (bucket, h)
            _join(chain, text, sha, keep, size, n_keep)
        if out:
            yield batch_of(out)

    def end():
        out: list = []
        flush(out)
        if out:
            yield batch_of(out)

    fn.end = end
    return fn


def build_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index: bucket, h, chain, sha, keep_id, group_size, n_keep
    (rows of the class that carry keep_id)."""
    keys = _keys(df, id_col, text_col)
    cells = (keys.groupBy("_tm_h").agg(F.lit(1).alias("one"))
             .groupBy(F.shiftrightunsigned("_tm_h", 64 - HISTOGRAM_BITS).alias("cell")).agg(F.count("one").alias("n")).collect())
    histogram = np.zeros(1 << HISTOGRAM_BITS, np.int64)
    for r in cells:
        histogram[r["cell"]] = r["n"]
    directory = build_directory(histogram, max(MIN_CAPACITY, -(-int(histogram.sum()) // MAX_BUCKETS)))
    entries = T.map_arrow(keys, lambda: _combiner(directory), "bucket long, h long, text string, sha string, "
                          "keep_id long, group_size long, n_keep long")
    owned = entries.repartition("bucket").sortWithinPartitions("bucket", "h")
    index = T.map_arrow(owned, _owner, "bucket long, h long, chain int, sha string, keep_id long, "
                        "group_size long, n_keep long")
    return T.store(index, "exact-index")


def dedup_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    index = build_index(df, id_col, text_col).withColumnsRenamed({"h": "_tm_h", "sha": "_tm_sha"})
    cols = [F.col("keep_id"), F.col("group_size"), F.col("kept"), F.col("_tm_sha").alias("text_sha256")]
    is_keep = F.col("_tm_id").eqNullSafe(F.col("keep_id"))
    rows = (_keys(df, id_col, text_col).drop("_tm_text").join(index, ["_tm_h", "_tm_sha"])
            .where(~is_keep | (F.col("n_keep") == 1)).withColumn("kept", is_keep)
            .select(F.col("_tm_id").alias("doc_id"), *cols))
    # Rows repeating both id and text are alike in this report: n_keep of them, the first kept.
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n_keep - 1) div {REPEAT_BLOCK}"))).alias("_tm_b")
    each = F.explode(F.sequence(F.col("_tm_b") * REPEAT_BLOCK,
                                F.least(F.col("n_keep"), (F.col("_tm_b") + 1) * REPEAT_BLOCK) - 1)).alias("_tm_i")
    repeats = (index.where(F.col("n_keep") > 1).select("*", block).select("*", each)
               .withColumn("kept", F.col("_tm_i") == 0).select(F.col("keep_id").alias("doc_id"), *cols))
    return rows.unionByName(repeats)


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with their own columns only."""
    index = (build_index(df, id_col, text_col).select(F.col("h").alias("_tm_h"), F.col("sha").alias("_tm_sha"),
                                                      F.col("keep_id").alias("_tm_keep"), F.col("n_keep").alias("_tm_n")))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = T.with_record(df, id=F.col(f"`{id_col}`").cast("long"), h=F.xxhash64(text), sha=F.sha2(text, 256))
    rows = rows.join(index, ["_tm_h", "_tm_sha"]).where(F.col("_tm_id").eqNullSafe(F.col("_tm_keep")))
    if index.where("_tm_n > 1").isEmpty():
        return T.records(rows)
    one = rows.where("_tm_n > 1").groupBy("_tm_h", "_tm_sha").agg(F.first("_tm_rec").alias("_tm_rec"))
    return T.records(rows.where("_tm_n = 1").select("_tm_rec").unionByName(one.select("_tm_rec")))
