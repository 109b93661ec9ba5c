"""SentencePiece encoding and decoding: unigram Viterbi over a double array.

A vocabulary file (a SentencePiece model: pieces with log scores and types,
byte pieces among them) is read once on the driver; its trie is laid out as a
double array over UTF-8 bytes and sent to the tasks, a size fixed by the file.
A text is encoded as the piece sequence of the highest summed log score over
``U+2581 + text`` with spaces written as U+2581.  A character that no piece
begins with gets the unknown score (least score - 10) and is written as its
byte pieces.  Of equal scores the path whose last pieces are longest wins.

If no piece has the marker after another character (checked), the best path
splits exactly before every run of markers that follows another character, so
each run of markers with the word after it is a chunk that can be solved
alone.  New chunks of a run of texts are solved together, one vectorised
Viterbi step for each pair of byte positions; long ones (over
``VECTOR_BYTES``) alone in plain Python.  A task keeps solved short chunks,
bounded by ``MEMO_BYTES``.  Nothing is shuffled.

Decoding joins the pieces' bytes, drops the marker put in front, writes
markers as spaces and replaces bytes that are no UTF-8 by U+FFFD.  Decoding
an encoded text gives the text back, except that a literal U+2581 comes back
as a space.

Defined cases: null encodes and decodes to null; the empty text to no pieces;
an id outside the vocabulary fails; control pieces decode to nothing.
"""

import re
import struct
from dataclasses import dataclass
from functools import cached_property
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm import tables as T

MARK = "▁"
_MARK = MARK.encode()
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # piece types of the file format
UNKNOWN_PENALTY = 10.0
VECTOR_BYTES = 96
MEMO_BYTES = 64 << 20
#: Of these, a character that no piece holds is always alone and ends a chunk.
BREAKS = "\n\r\t"
#: Characters of text whose chunks are solved together.
RUN_CHARS = 1 << 20


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol-buffer message."""
    i = 0

    def varint() -> int:
        nonlocal i
        value = shift = 0
        while True:
            value |= (data[i] & 127) << shift
            shift += 7
            i += 1
            if data[i - 1] < 128:
                return value

    while i < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            n = varint() if tag & 7 == 2 else {1: 8, 5: 4}[tag & 7]
            yield tag >> 3, data[i:i + n]
            i += n


@dataclass
class Vocabulary:
    pieces: list[str]
    scores: np.ndarray
    kinds: np.ndarray

    @classmethod
    def load(cls, path: str) -> "Vocabulary":
        """Read a SentencePiece model file on the driver."""
        with open(path, "rb") as f:
            rows = [dict(_fields(v)) for k, v in _fields(f.read()) if k == 1]
        score = [struct.unpack("<f", r[2])[0] if 2 in r else 0.0 for r in rows]
        return cls([r[1].decode() for r in rows], np.array(score, np.float64), np.array([r.get(3, NORMAL) for r in rows]))

    def __post_init__(self) -> None:
        if any(MARK in p.lstrip(MARK) for p, k in zip(self.pieces, self.kinds) if k in (NORMAL, USER)):
            raise ValueError("a piece holds the marker after another character")
        if (self.kinds == BYTE).sum() != 256:
            raise ValueError("the vocabulary has no byte pieces")

    @cached_property
    def byte_ids(self) -> np.ndarray:
        ids = np.zeros(256, np.int32)
        for i in np.flatnonzero(self.kinds == BYTE):
            ids[int(self.pieces[i][3:5], 16)] = i
        return ids

    @cached_property
    def trie(self) -> "DoubleArray":
        return DoubleArray.build({p.encode(): i for i, p in enumerate(self.pieces) if self.kinds[i] in (NORMAL, USER) and p})

    @cached_property
    def chunk(self) -> re.Pattern:
        letters = {c for p, k in zip(self.pieces, self.kinds) if k in (NORMAL, USER) for c in p}
        alone = "".join(c for c in BREAKS if c not in letters)
        return re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + (f"|[{alone}]" if alone else ""))

    @property
    def unknown_score(self) -> float:
        return float(self.scores[self.kinds == NORMAL].min()) - UNKNOWN_PENALTY

    @cached_property
    def piece_bytes(self) -> list[bytes]:
        out = []
        for p, k in zip(self.pieces, self.kinds):
            if k == BYTE:
                out.append(bytes([int(p[3:5], 16)]))
            elif k == CONTROL:
                out.append(b"")
            else:
                out.append((p if k != UNKNOWN else f"{MARK}⁇{MARK}").replace(MARK, " ").encode())
        return out


@dataclass
class DoubleArray:
    """State s goes by byte c to ``base[s] + c + 1`` if ``check`` there is s;
    ``piece[s]`` is the piece that ends in s, or -1.  The root is 0."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray

    @classmethod
    def build(cls, keys: dict[bytes, int]) -> "DoubleArray":
        nodes: list[dict[int, int]] = [{}]
        ends: list[int] = [-1]
        for key, value in keys.items():
            at = 0
            for c in key:
                if c not in nodes[at]:
                    nodes[at][c] = len(nodes)
                    nodes.append({})
                    ends.append(-1)
                at = nodes[at][c]
            ends[at] = value
        used = bytearray(4 * len(nodes) + 1024)  # grows at need
        used[0] = 1
        place = {0: 0}  # node to state
        base_of: dict[int, int] = {}
        parent = {0: 0}
        free = wide = 1  # no free place, no good place for several children lies before
        waiting = [0]
        for node in waiting:
            codes = sorted(c + 1 for c in nodes[node])
            if not codes:
                continue
            at = max(codes[0], free if len(codes) == 1 else wide)
            tried = 0
            while True:
                at = used.find(0, at)
                b = at - codes[0]
                if at < 0 or b + 257 >= len(used):
                    at = len(used) if at < 0 else at
                    used.extend(bytes(len(used)))
                    continue
                tried += 1
                if not any(used[b + c] for c in codes):
                    break
                at += 1
            if len(codes) == 1:
                free = at
            elif tried > 32:
                wide = at  # the places before are nearly full
            base_of[node] = b
            for c in codes:
                used[b + c] = 1
                child = nodes[node][c - 1]
                place[child], parent[child] = b + c, node
                waiting.append(child)
        size = max(place.values()) + 258
        base, check, piece = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        for node, state in place.items():
            base[state], check[state], piece[state] = base_of.get(node, 0), place[parent[node]], ends[node]
        check[0] = -1
        return cls(base, check, piece)


class Encoder:
    """Encodes texts with one vocabulary; one to a task."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        v = vocabulary
        self.trie, self.scores, self.byte_ids, self.unknown = v.trie, v.scores, v.byte_ids, v.unknown_score
        self.chunk = v.chunk
        self.memo: dict[str, bytes] = {}
        self.held = 0

    @cached_property
    def _plain(self):
        t = self.trie
        return t.base.tolist(), t.check.tolist(), t.piece.tolist(), self.scores.tolist()

    def solve_one(self, chunk: bytes) -> np.ndarray:
        """Viterbi over one chunk, in plain Python."""
        base, check, piece, scores = self._plain
        n = len(chunk)
        best, back, by = [float("-inf")] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        i = 0
        while i < n:
            width = 1 if chunk[i] < 0x80 else 2 if chunk[i] < 0xE0 else 3 if chunk[i] < 0xF0 else 4
            here, state, single = best[i], 0, False
            for at in range(i, n):
                to = base[state] + chunk[at] + 1
                if check[to] != state:
                    break
                state = to
                p = piece[state]
                if p >= 0:
                    single |= at + 1 == i + width
                    if here + scores[p] > best[at + 1]:
                        best[at + 1], back[at + 1], by[at + 1] = here + scores[p], i, p
            if not single and here + self.unknown > best[i + width]:
                best[i + width], back[i + width], by[i + width] = here + self.unknown, i, -1
            i += width
        parts, at = [], n
        while at:
            parts.append([by[at]] if by[at] >= 0 else self.byte_ids[list(chunk[back[at]:at])].tolist())
            at = back[at]
        return np.array([i for p in reversed(parts) for i in p], np.int32)

    def solve(self, chunks: list[bytes]) -> list[bytes]:
        """Viterbi over many short chunks at once; ids as int32 bytes."""
        out: list[bytes] = [b""] * len(chunks)
        length = np.array([len(c) for c in chunks], np.int64)
        order = np.argsort(length, kind="stable")
        at = 0
        while at < len(order):
            # Chunks of like length: at most half as long again as the shortest.
            to = max(at + 1, int(np.searchsorted(length[order], max(8, length[order[at]] * 3 // 2), "right")))
            for a in range(at, to, 8192):
                rows = order[a:min(to, a + 8192)]
                if length[rows[-1]] > VECTOR_BYTES:
                    for r in rows:
                        out[r] = self.solve_one(chunks[r]).tobytes()
                else:
                    self._solve_block(chunks, rows, length[rows], out)
            at = to
        return out

    def _solve_block(self, chunks, rows, length, out) -> None:
        t, n, wide = self.trie, len(rows), int(length.max())
        text = np.frombuffer(b"".join(chunks[r].ljust(wide, b"\0") for r in rows), np.uint8).reshape(n, wide).astype(np.int32) + 1
        best = np.full((n, wide + 1), -np.inf)
        best[:, 0] = 0.0
        back = np.zeros((n, wide + 1), np.int16)
        by = np.full((n, wide + 1), -1, np.int32)
        for i in range(wide):
            row = np.flatnonzero((best[:, i] > -np.inf) & (length > i))
            if not len(row):
                continue
            lead = text[row, i] - 1
            width = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
            single = np.zeros(n, bool)
            end_of = np.zeros(n, np.int64)
            end_of[row] = i + width
            first, state = row, np.zeros(len(row), np.int32)
            for at in range(i, wide):
                to = t.base[state] + text[row, at]
                ok = (t.check[to] == state) & (length[row] > at)
                row, state = row[ok], to[ok]
                if not len(row):
                    break
                p = t.piece[state]
                ends = p >= 0
                r, p = row[ends], p[ends]
                single[r[end_of[r] == at + 1]] = True
                score = best[r, i] + self.scores[p]
                up = score > best[r, at + 1]
                r = r[up]
                best[r, at + 1], back[r, at + 1], by[r, at + 1] = score[up], i, p[up]
            lost = first[~single[first]]
            if len(lost):
                to = end_of[lost]
                score = best[lost, i] + self.unknown
                up = score > best[lost, to]
                lost, to = lost[up], to[up]
                best[lost, to], back[lost, to], by[lost, to] = score[up], i, -1
        ids, begin = np.full((n, wide), -1, np.int32), np.zeros((n, wide), np.int16)
        rare = np.zeros(n, bool)
        at, slot, live = length.copy(), np.full(n, wide), np.arange(n)
        while len(live):
            p = by[live, at[live]]
            rare[live[p < 0]] = True
            slot[live] -= 1
            ids[live, slot[live]] = p
            at[live] = begin[live, slot[live]] = back[live, at[live]]
            live = live[at[live] > 0]
        for k, r in enumerate(rows):
            if not rare[k]:
                out[r] = ids[k, slot[k]:].tobytes()
                continue
            cuts = [*begin[k, slot[k]:].tolist(), int(length[k])]
            out[r] = b"".join(p.tobytes() if p >= 0 else self.byte_ids[list(chunks[r][a:b])].tobytes()
                              for p, a, b in zip(ids[k, slot[k]:], cuts, cuts[1:]))

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Ids of each text, solved in runs of ``RUN_CHARS`` characters."""
        out: list[np.ndarray | None] = []
        a = 0
        while a < len(texts):
            b, chars = a, 0
            while b < len(texts) and (b == a or chars + len(texts[b] or "") <= RUN_CHARS):
                chars += len(texts[b] or "")
                b += 1
            split = [self.chunk.findall((MARK + t).replace(" ", MARK)) if t else [] for t in texts[a:b]]
            memo = self.memo
            new = list({c for chunks in split for c in chunks if c not in memo})
            solved = self.solve([c.encode("utf-8", "replace") for c in new])
            memo.update(zip(new, solved))
            self.held += sum(4 * len(c) + len(s) + 128 for c, s in zip(new, solved))
            for t, chunks in zip(texts[a:b], split):
                out.append(None if t is None else np.frombuffer(b"".join([memo[c] for c in chunks]), np.int32))
            if self.held > MEMO_BYTES:
                memo.clear()
                self.held = 0
            a = b
        return out


def decode_ids(ids: np.ndarray, piece_bytes: list[bytes]) -> str:
    text = b"".join([piece_bytes[i] for i in ids.tolist()]).decode("utf-8", "replace")
    return text[1:] if text[:1] == " " else text


def encoder(df: DataFrame, vocabulary: Vocabulary):
    """A column function: text to array of piece ids."""
    vocabulary.trie  # built once, on the driver
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)  # as large as the vocabulary file

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = Encoder(shared.value)
        for batch in texts:
            ids = enc.encode(batch.to_pylist())
            sizes = np.cumsum([0, *(0 if x is None else len(x) for x in ids)])
            flat = np.concatenate([np.zeros(0, np.int32), *(x for x in ids if x is not None)])
            yield pa.ListArray.from_arrays(pa.array(sizes.astype(np.int32)), pa.array(flat),
                                           mask=pa.array([x is None for x in ids]))

    return F.arrow_udf(run, "array<int>").asNondeterministic()


def decoder(df: DataFrame, vocabulary: Vocabulary):
    """A column function: array of piece ids to text."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary.piece_bytes)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            flat, at = batch.values.to_numpy(zero_copy_only=False), batch.offsets.to_numpy()
            yield pa.array([None if not ok else decode_ids(flat[a:b], shared.value)
                            for a, b, ok in zip(at[:-1], at[1:], batch.is_valid().to_pylist())], pa.string())

    return F.arrow_udf(run, "string").asNondeterministic()


def encode(df: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, ids (null for a null text), n_ids."""
    enc = encoder(df, Vocabulary.load(model_file))
    return (df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), enc(F.col(f"`{text_col}`").cast("string")).alias("ids"))
            .withColumn("n_ids", F.when(F.col("ids").isNotNull(), F.size("ids")).cast("long")))


def round_trip(df: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, ids, n_ids, decoded, exact (decoding gave the text back)."""
    v = Vocabulary.load(model_file)
    enc, dec, text = encoder(df, v), decoder(df, v), F.col("_tm_text")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("_tm_text"))
    rows = rows.withColumn("ids", enc(text)).withColumn("decoded", dec("ids"))
    return rows.select("doc_id", "ids", F.when(F.col("ids").isNotNull(), F.size("ids")).cast("long").alias("n_ids"), "decoded",
                       F.col("decoded").eqNullSafe(text).alias("exact"))
