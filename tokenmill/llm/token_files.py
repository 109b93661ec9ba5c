"""Token ids in binary files of directly addressable codes (DACs).

An id is cut into chunks of bits, the lowest first.  Level 1 of a file holds
the first chunk of every id, level 2 the second chunk of those ids that have
one, and so on.  Each level but the last has a bitmap that says, in the order
of the level, whether the id goes on; a rank directory (ones before each run
of ``RANK_BITS`` bits) makes "the place of this id in the next level" one
lookup and one popcount.  So any id is read from a few bits at known places,
and ids i to j are one slice of each level: nothing before them is decoded.
The chunk widths are those of the smallest file, found from the histogram of
bit lengths.

A file is an image of bytes::

    header   magic "DACS", version, documents, ids, levels, and each level's
             width, entries and section lengths
    docs     doc ids (int64), a null map, start of each document in the file
    levels   for each: packed chunks, packed bitmap, rank directory

and ends with the crc32 of all before it, so a damaged image raises.  Images
are rows of a Parquet table (file number, ids, documents, image): Spark's
writer commits them whole and a lost executor's task runs again; any store
that Spark reads will do.

Documents go into the files in ascending id.  A range partitioning of the texts
orders them; each task encodes its range and packs it at once into images of
about ``FILE_IDS`` ids (a document is never cut), so that no ids but the images
are written or shuffled; two-level prefix sums over the images give the ids
before each.
Reading takes a file's documents one by one through the levels.

The tokenizer's file is a parameter.  Where its pre-tokenizer cuts at white
space and keeps none (read from the file), words between blanks are encoded
apart, each distinct one by the library and from then on from a task's memo of
``MEMO_BYTES`` (closing marks apart from their word); otherwise texts go to the
library whole.  Both give the library's ids of the whole text.

Defined cases: a null text is empty and holds the end id alone; a null id
sorts before all and stays null; rows that repeat an id stand side by side,
those with equal texts in any order, for they are alike; an empty table gives
no file and an empty result; extra columns play no part.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.llm import tables as T
from tokenmill.plans.ordinal import prefix_sums

END_ID = 2
#: Ids of a file, and of a task, which takes texts of up to ``ID_BYTES`` for each.
FILE_IDS, TASK_IDS = 1 << 18, 1 << 22
ID_BYTES = 8
#: Text that a task has at least, where the cores would take more tasks.
LEAST_BYTES = 1 << 20
#: Bits between two entries of a rank directory.
RANK_BITS = 512
MEMO_BYTES = 64 << 20
MAGIC, VERSION = b"DACS", 1
_HEAD = struct.Struct("<4sIQQI")
_LEVEL = struct.Struct("<IQQQQ")


# --- the code -----------------------------------------------------------------
def widths(ids: np.ndarray, max_levels: int = 8) -> list[int]:
    """Chunk widths, the lowest first, of the smallest DAC of ``ids``."""
    if not len(ids):
        return [1]
    need = np.frexp(ids.astype(np.float64))[1]  # bit length of each id, 0 for 0
    top = max(1, int(need.max()))
    longer = len(ids) - np.cumsum(np.bincount(need, minlength=top + 1))  # ids that have a bit b
    longer[0] = len(ids)
    extra = 1 + 64 / RANK_BITS
    # best[b]: bits of all levels from bit b on, and the first of their widths
    best: list[tuple[float, int]] = [(0.0, 0)] * (top + 1)
    for b in range(top - 1, -1, -1):
        best[b] = min((longer[b] * (e - b + (extra if e < top else 0)) + best[e][0], e - b) for e in range(b + 1, top + 1))
    out, b = [], 0
    while b < top:
        out.append(best[b][1])
        b += best[b][1]
    return out if len(out) <= max_levels else [*out[:max_levels - 1], top - sum(out[:max_levels - 1])]


def _room(width: int) -> int:
    """Bytes of the number type that holds ``width`` bits."""
    return next(n for n in (1, 2, 4, 8) if width <= 8 * n)


def pack(values: np.ndarray, width: int) -> bytes:
    """``width`` bits of each value, lowest bit first."""
    size = -(-len(values) * width // 8)
    if width > 16:
        n = _room(width)
        bits = np.unpackbits(values.astype(f"<u{n}").view(np.uint8).reshape(len(values), n), axis=1, bitorder="little")
        return np.packbits(bits[:, :width].ravel(), bitorder="little").tobytes()
    # eight values fill ``width`` bytes: a word of four values each, or one of all
    eights = np.zeros((-(-len(values) // 8), 8), np.uint64)
    eights.ravel()[:len(values)] = values
    eights &= np.uint64((1 << width) - 1)
    words = np.zeros((len(eights), 2), "<u8")
    half = 4 * width
    for k in range(4):
        words[:, 0] |= eights[:, k] << np.uint64(k * width)
        words[:, 1] |= eights[:, k + 4] << np.uint64(k * width)
    if half < 64:
        words[:, 0] |= words[:, 1] << np.uint64(half)
        words[:, 1] >>= np.uint64(64 - half)
    return np.ascontiguousarray(words.view(np.uint8)[:, :width]).tobytes()[:size]


def unpack(data: memoryview, width: int, i: int, j: int) -> np.ndarray:
    """Values i to j of :func:`pack`; only their bytes are looked at."""
    if width > 16:
        low = i * width
        bits = np.unpackbits(np.frombuffer(data[low // 8:-(-j * width // 8)], np.uint8), bitorder="little")
        n = _room(width)
        out = np.zeros((j - i, 8 * n), np.uint8)
        out[:, :width] = bits[low % 8:low % 8 + (j - i) * width].reshape(j - i, width)
        return np.packbits(out, axis=1, bitorder="little").view(f"<u{n}").ravel().astype(np.int64)
    first, n = i // 8, -(-j // 8) - i // 8
    part = np.frombuffer(data[first * width:min((first + n) * width, -(-j * width // 8))], np.uint8)
    if len(part) < n * width:
        part = np.concatenate([part, np.zeros(n * width - len(part), np.uint8)])
    words = np.zeros((n, 16), np.uint8)
    words[:, :width] = part.reshape(n, width)
    words, half, mask = words.view("<u8"), 4 * width, np.uint64((1 << width) - 1)
    low = words[:, 0]
    high = words[:, 1] if half == 64 else low >> np.uint64(half) | words[:, 1] << np.uint64(64 - half)
    out = np.empty((n, 8), np.int64)
    for k in range(4):
        out[:, k] = low >> np.uint64(k * width) & mask
        out[:, k + 4] = high >> np.uint64(k * width) & mask
    return out.ravel()[i - 8 * first:j - 8 * first]


def build(docs: list[tuple[int | None, np.ndarray]]) -> bytes:
    """The image of a file of (doc id, ids) in the order given."""
    ids = np.concatenate([x for _, x in docs]).astype(np.int64) if docs else np.zeros(0, np.int64)
    if len(ids) and (ids.min() < 0 or ids.max() >> 52):
        raise ValueError("token ids are from 0 to 2**52 - 1")
    starts = np.zeros(len(docs) + 1, np.int64)
    np.cumsum([len(x) for _, x in docs], out=starts[1:])
    names = np.array([0 if i is None else i for i, _ in docs], np.int64).tobytes()
    nulls = np.packbits(np.array([i is None for i, _ in docs], bool), bitorder="little").tobytes()
    sizes, sections, rest = [], [], ids
    plan = widths(ids)
    for k, width in enumerate(plan):
        more = rest >> width > 0
        last = k + 1 == len(plan)
        bitmap = b"" if last else np.packbits(more, bitorder="little").tobytes()
        ones = np.zeros(0, np.int64) if last else np.add.reduceat(more, np.arange(0, len(more), RANK_BITS), dtype=np.int64)
        ranks = np.concatenate([[0], np.cumsum(ones)]).astype(np.uint64).tobytes() if len(ones) else b""
        chunks = pack(rest & ((1 << width) - 1), width)
        sizes.append(_LEVEL.pack(width, len(rest), len(chunks), len(bitmap), len(ranks)))
        sections += [chunks, bitmap, ranks]
        rest = rest[more] >> width
    body = b"".join([_HEAD.pack(MAGIC, VERSION, len(docs), len(ids), len(plan)), *sizes, names, nulls, starts.tobytes(), *sections])
    return body + struct.pack("<I", zlib.crc32(body))


class File:
    """Reads an image: ids by place, documents by number."""

    def __init__(self, image: bytes) -> None:
        self.view = memoryview(image)
        if len(image) < _HEAD.size + 4 or zlib.crc32(self.view[:-4]) != struct.unpack("<I", self.view[-4:])[0]:
            raise ValueError("damaged token file")
        magic, version, self.n_docs, self.n_ids, n_levels = _HEAD.unpack_from(image)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token file of this version")
        at = _HEAD.size
        plan = [_LEVEL.unpack_from(image, at + k * _LEVEL.size) for k in range(n_levels)]
        at += n_levels * _LEVEL.size

        def take(n: int) -> memoryview:
            nonlocal at
            at += n
            return self.view[at - n:at]

        names, nulls = np.frombuffer(take(8 * self.n_docs), np.int64), take(-(-self.n_docs // 8))
        null = np.unpackbits(np.frombuffer(nulls, np.uint8), bitorder="little")[:self.n_docs]
        self.doc_ids = [None if gone else int(i) for i, gone in zip(names, null)]
        self.starts = np.frombuffer(take(8 * (self.n_docs + 1)), np.int64)
        self.levels = [(width, n, take(a), take(b), np.frombuffer(take(c), np.uint64)) for width, n, a, b, c in plan]

    @staticmethod
    def _rank(bitmap: memoryview, ranks: np.ndarray, i: int) -> int:
        """Ones before bit i: the directory's entry and one popcount."""
        run = i // RANK_BITS
        if run * RANK_BITS == i:
            return int(ranks[run])
        part = int.from_bytes(bitmap[run * RANK_BITS // 8:-(-i // 8)], "little")
        return int(ranks[run]) + (part & ((1 << (i - run * RANK_BITS)) - 1)).bit_count()

    def token(self, i: int) -> int:
        """The i-th id of the file."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value = shift = 0
        for width, _, chunks, bitmap, ranks in self.levels:
            low = i * width
            part = int.from_bytes(chunks[low // 8:-(-(low + width) // 8)], "little")
            value |= (part >> low % 8 & ((1 << width) - 1)) << shift
            if not len(bitmap) or not bitmap[i >> 3] >> (i & 7) & 1:
                break
            shift += width
            i = self._rank(bitmap, ranks, i)
        return value

    def slice(self, i: int, j: int) -> np.ndarray:
        """Ids i to j: one slice of each level."""
        out, at, shift = np.zeros(j - i, np.int64), None, 0
        for width, _, chunks, bitmap, ranks in self.levels:
            if i == j:
                break
            if at is None:
                out = unpack(chunks, width, i, j)
            else:
                out[at] |= unpack(chunks, width, i, j) << shift
            if not len(bitmap):
                break
            bits = np.unpackbits(np.frombuffer(bitmap[i // 8:-(-j // 8)], np.uint8), bitorder="little")
            more = np.flatnonzero(bits[i % 8:i % 8 + j - i])
            at = more if at is None else at[more]
            i = self._rank(bitmap, ranks, i)
            j = i + len(at)
            shift += width
        return out

    def document(self, k: int) -> np.ndarray:
        return self.slice(int(self.starts[k]), int(self.starts[k + 1]))


# --- encoding -----------------------------------------------------------------
def words_apart(tokenizer: dict) -> bool:
    """Whether white space only separates tokens: the pre-tokenizer keeps
    matches of a pattern none of whose parts matches a blank, and nothing
    before or after it looks across blanks."""
    pre = tokenizer.get("pre_tokenizer") or {}
    steps = pre.get("pretokenizers", [pre])
    norm = tokenizer.get("normalizer") or {}
    plain = {"NFC", "Lowercase", "Replace"}
    if any(x.get("type") not in plain or x.get("type") == "Replace" and x["pattern"].get("Regex") != r"\s+"
           for x in norm.get("normalizers", [norm] if norm else [])):
        return False
    first = steps[0] if steps else {}
    pattern = (first.get("pattern") or {}).get("Regex", " ")
    inside = re.sub(r"\[\^\\s[^]]*\]", "", pattern)  # classes that shut white space out
    return (first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert"))
            and not re.search(r" |\\s|\\S|\\W|\[\^|\.|\\n", inside)
            and all(s.get("type") == "ByteLevel" and not s.get("add_prefix_space") for s in steps[1:])
            and tokenizer.get("post_processor") is None
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in tokenizer.get("added_tokens", [])))


def letters_whole(tokenizer: dict) -> bool:
    """Whether, of a tokenizer with :func:`words_apart`, a word of letters is
    one piece, cut into bytes: the pattern's other parts start otherwise."""
    steps = tokenizer["pre_tokenizer"].get("pretokenizers", [])
    parts = steps[0]["pattern"]["Regex"].split("|") if steps else []
    return (r"[\p{L}]+" in parts and all(x[:1] == "'" or x in (r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+") for x in parts)
            and [x["type"] for x in steps[1:]] == ["ByteLevel"] and not steps[1].get("use_regex", True))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK, _MARK = (np.isin(np.arange(256), list(x)) for x in (b" \n", b".,;:!?)%$#&*"))


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words, first): all texts' words, cut at blanks, A-Z lowered, and the
    place of each text's first word, with the end.  Marks between a letter and
    a blank or the end are a word.  A text that might spell a special token
    once lowered is cut at blanks only."""
    offs = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offs[0]:offs[-1]]
    offs = (offs - offs[0]).astype(np.int64)
    data, n = _LOWER[raw], len(raw)
    blank, mark = _BLANK[data], _MARK[data]
    cut = np.zeros(n + 1, bool)
    cut[1:] = blank
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    # runs of marks, inside one text
    run = np.flatnonzero(mark & (edge[:-1] | ~np.concatenate([[False], mark[:-1]])))
    end = np.flatnonzero(mark & (edge[1:] | ~np.concatenate([mark[1:], [False]]))) + 1
    before, lead = data[np.maximum(run - 1, 0)], data[np.maximum(run - 2, 0)]
    letter = (before >= 97) & (before <= 122) | (lead == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7)
    cut[run[letter & ~edge[run] & (edge[end] | np.append(blank, False)[end])]] = True
    special = np.flatnonzero((raw[:-1] == 60) & (raw[1:] == 124))  # <|
    for k in np.unique(np.searchsorted(offs, special, "right") - 1):
        i, j = offs[k], offs[k + 1]
        data[i:j], cut[i + 1:j] = raw[i:j], blank[i:j - 1]
    kept = np.concatenate([[0], np.cumsum(~blank)])
    at = np.flatnonzero(cut | edge)
    at = at[:-1] if len(at) and at[-1] == n else at  # the end of all
    bounds = np.append(kept[at], kept[-1]).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(data[~blank])])
    return words, np.searchsorted(at, offs)


@lru_cache(maxsize=1)
def _library(path: str) -> tuple:
    """(tokenizer, words apart, tokens that end a word, tokenizer of words of
    letters, their lower case) of a file, kept for a worker's next tasks."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers
    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    apart = words_apart(spec)
    suffix = spec["model"].get("end_of_word_suffix")
    ends = np.zeros(tokenizer.get_vocab_size() + 1, bool)
    if suffix:
        ends[[i for t, i in tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
    # words of composed letters: nothing to compose, replace or cut
    by_letters, lower = tokenizer, str
    if apart and letters_whole(spec):
        # the model alone, unless an added token could stand among letters and blanks
        apart_from_added = all(re.search(r"[^\w\s]", t["content"]) for t in spec.get("added_tokens", []))
        by_letters = Tokenizer(tokenizer.model) if apart_from_added else Tokenizer.from_file(path)
        by_letters.normalizer = None
        by_letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(False, use_regex=False)])
        if "Lowercase" in str(spec.get("normalizer")):
            lower = str.lower
    return tokenizer, apart, ends, by_letters, lower


class Encoder:
    """Texts to ids (little-endian unsigned 32-bit bytes, the end id last)."""

    def __init__(self, path: str, end_id: int = END_ID, memo_bytes: int = MEMO_BYTES) -> None:
        self.tokenizer, self.apart, self.ends, self.by_letters, self.lower = _library(path)
        self.end = np.array([end_id], "<u4").tobytes()
        # two generations: words met since the last turn, and those of the turn before
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.half = memo_bytes // 2 // 250

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Words of letters in one call: each ends with its one token that ends a word."""
        if not self.ends.any() or len(words) < 2:
            return self._whole(words)
        text = " ".join(words)
        ids = np.array(self.by_letters.encode_batch_fast([self.lower(text)], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(words):
            return self._whole(words)
        data = ids.tobytes()
        return [data[4 * i:4 * j] for i, j in zip([0, *cuts[:-1].tolist()], cuts.tolist())]

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        found = {w: self.old[w] for w in words if w in self.old}
        letters, rest = [], []
        for w in words.difference(found):
            (letters if w.isalpha() and (w.isascii() or max(w) < "\u0250" and "\u0130" not in w) and len(w) < 100 else rest).append(w)
        for k in range(0, len(letters), 2000):
            found.update(zip(letters[k:k + 2000], self._letters(letters[k:k + 2000])))
        found.update(zip(rest, self._whole(rest)))
        # no word of a generation is longer than a few hundred bytes, so counting entries bounds it
        if len(self.memo) + len(found) > self.half:
            self.old, self.memo = self.memo, {}
        if len(found) <= self.half:
            self.memo.update(found if not rest else {w: x for w, x in found.items() if len(w) < 100})
        return found

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        if not self.apart:
            return [x + self.end for x in self._whole(texts if isinstance(texts, list) else texts.to_pylist())]
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        words, first = split_words(texts)
        coded = words.dictionary_encode()
        code, different = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.memo.get, different))
        if None in ids:
            found = self._learn({w for w, x in zip(different, ids) if x is None})
            ids = [found[w] if x is None else x for w, x in zip(different, ids)]
        # each text's words and the end id, laid side by side
        code = np.insert(code, first[1:], len(ids))
        ids.append(self.end)
        laid = pa.array(ids, pa.large_binary()).take(pa.array(code))
        bounds = np.frombuffer(laid.buffers()[1], np.int64)[laid.offset:laid.offset + len(laid) + 1]
        stop = bounds[first[1:] + np.arange(1, len(texts) + 1)].tolist()
        data = laid.buffers()[2].to_pybytes() if stop else b""
        return [data[i:j] for i, j in zip([0, *stop[:-1]], stop)]


def _narrow(ids: bytes) -> bytes:
    """The ids in two bytes each where they fit, behind their width."""
    wide = np.frombuffer(ids, "<u4")
    return b"\4" + ids if len(wide) and wide.max() >> 16 else b"\2" + wide.astype("<u2").tobytes()


def _widen(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if ids[0] == 2 else "<u4", offset=1)


def _encode_task(path: str, end_id: int):
    encoder = Encoder(path, end_id)

    def fn(batch):
        texts = batch.column(1).cast(pa.string())
        sizes = pc.binary_length(texts).to_pylist()
        at = 0
        while at < len(texts):  # a bounded part of the batch, or one long text
            end, size = at, 0
            while end < len(texts) and (end == at or size + sizes[end] < 1 << 21):
                size += sizes[end]
                end += 1
            part = texts.slice(at, end - at)
            ids = encoder.encode(part)
            yield pa.record_batch([batch.column(0).slice(at, end - at), pa.array([_narrow(x) for x in ids], pa.binary())],
                                  names=["doc_id", "ids"])
            at = end
    return fn


# --- files --------------------------------------------------------------------
_IMAGE = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n", pa.int64()), ("docs", pa.int64()), ("image", pa.binary())])


def _pack_task(file_ids: int):
    from pyspark import TaskContext
    docs: list[tuple[int | None, np.ndarray]] = []
    part, seq, held = TaskContext.get().partitionId(), 0, 0

    def emit():
        nonlocal seq, held
        if docs:
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([held], pa.int64()),
                                   pa.array([len(docs)], pa.int64()), pa.array([build(docs)], pa.binary())], schema=_IMAGE)
            docs.clear()
            seq, held = seq + 1, 0

    def fn(batch):
        nonlocal held
        for id_, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = _widen(raw)
            if docs and held + len(ids) > file_ids:
                yield from emit()
            docs.append((id_, ids))
            held += len(ids)

    fn.end = emit
    return fn


def _write_task(path: str, end_id: int, file_ids: int):
    """Texts in order to images: a part is packed as soon as it is encoded."""
    encode, pack_ = _encode_task(path, end_id), _pack_task(file_ids)

    def fn(batch):
        for part in encode(batch):
            yield from pack_(part)

    fn.end = pack_.end
    return fn


def write(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
          file_ids: int = FILE_IDS, task_ids: int = TASK_IDS) -> DataFrame:
    """Encode and write: the table of files (file, n, docs, image), in
    ascending doc id from file to file (:func:`starts` gives their places).  ``path`` is the tokenizer's file."""
    spark = T.ready(df.sparkSession)
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // (ID_BYTES * task_ids)), min(spark.sparkContext.defaultParallelism, size // LEAST_BYTES))
    rows = rows.withColumn("tie", F.crc32("text")).withColumn("row", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("row")]
    ordered = rows.coalesce(1) if parts == 1 else rows.repartitionByRange(parts, *order)
    ordered = ordered.sortWithinPartitions(*order).select("doc_id", "text")
    images = T.store(T.map_arrow(ordered, lambda: _write_task(path, end_id, file_ids), "part int, seq int, n long, docs long, image binary"),
                     "token-files")
    return images.select(_file_number().alias("file"), "n", "docs", "image")


def _file_number() -> Column:
    """A task writes its images in order, so part and number give the order of the files."""
    return F.col("part").cast("long") * (1 << 31) + F.col("seq")


def starts(files: DataFrame) -> DataFrame:
    """(file, start): the ids of all files before each, kept as a table."""
    sizes = files.select("file", "n", F.shiftright("file", 31).alias("part"))
    per_part = prefix_sums(sizes.groupBy("part").agg(F.sum("n").alias("before")), "part", ["before"])
    inside = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return T.store(sizes.join(per_part, "part").select("file", (F.col("before") + F.col("inside")).alias("start")), "token-starts")


def _read_task(use: Callable[[np.ndarray], tuple], schema: pa.Schema):
    def fn(batch):
        for number, image in zip(batch.column(0).to_pylist(), batch.column(1)):
            file = File(image.as_buffer().to_pybytes())
            for low in range(0, file.n_docs, 1000):
                at = file.starts[low:low + 1001].tolist()
                block = file.slice(at[0], at[-1])
                rows = [(number, file.doc_ids[low + k], i, *use(block[i - at[0]:j - at[0]])) for k, (i, j) in enumerate(zip(at, at[1:]))]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    return fn


def _read(files: DataFrame, use: Callable[[np.ndarray], tuple], fields: list[tuple[str, pa.DataType]], kinds: str) -> DataFrame:
    schema = pa.schema([("file", pa.int64()), ("doc_id", pa.int64()), ("inside", pa.int64()), *fields])
    rows = T.map_arrow(files.select("file", "image"), lambda: _read_task(use, schema), f"file long, doc_id long, inside long, {kinds}")
    return (rows.join(starts(files), "file")
            .select("doc_id", (F.col("start") + F.col("inside")).alias("start"), *[n for n, _ in fields]))


def documents(files: DataFrame) -> DataFrame:
    """The documents read back: doc_id, start, ids (array)."""
    return _read(files, lambda x: (x.tolist(),), [("ids", pa.list_(pa.int64()))], "ids array<long>")


def digests(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of the documents read back."""
    return _read(files, lambda x: (len(x), zlib.crc32(x.astype("<u4").tobytes())),
                 [("n_tokens", pa.int64()), ("ids_crc32", pa.int64())], "n_tokens long, ids_crc32 long")


def _lookup_task():
    def fn(batch):
        for image, start, places in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            file = File(image.as_buffer().to_pybytes())
            yield pa.record_batch([pa.array(places, pa.int64()), pa.array([file.token(p - start) for p in places], pa.int64())],
                                  names=["place", "id"])
    return fn


def tokens_at(files: DataFrame, places: DataFrame, place_col: str = "place") -> DataFrame:
    """(place, id) of single tokens by their place in the whole stream, each
    different place once; places beyond the stream have no row.  Files are
    found by the cells of ``FILE_IDS`` places they cover, and a file is opened
    once for all the places asked of one cell."""
    cell = lambda c: F.floor(c / FILE_IDS).cast("long")
    want = places.select(F.col(f"`{place_col}`").cast("long").alias("place")).distinct().withColumn("cell", cell(F.col("place")))
    covered = F.explode(F.sequence(cell(F.col("start")), cell(F.col("start") + F.col("n") - 1)))
    files = files.join(starts(files), "file")
    where = files.where("n > 0").select("file", "start", "n", covered.alias("cell"))
    found = want.join(where, "cell").where("place >= start and place < start + n")
    found = found.groupBy("file", "cell").agg(F.collect_list("place").alias("places"))
    rows = found.join(files.select("file", "start", "image"), "file").select("image", "start", "places")
    return T.map_arrow(rows, _lookup_task, "place long, id long")


def write_and_read(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    return digests(write(df, path, id_col, text_col))
