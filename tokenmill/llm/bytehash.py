"""Vectorised word hashing over Arrow string columns.

Works on the UTF-8 bytes of many texts at once: a word's 64-bit hash is a
sum of random byte values, each weighted by its place in the word (a weight
that never repeats, however long the word), taken with ``np.add.reduceat`` over
the word's bytes, so no Python object is made per word.  All arithmetic is
modulo 2**64.  Texts are taken in runs of about ``CHUNK_BYTES``; a longer
single text forms its own run and is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: About fifty bytes of work arrays for each byte of text.
CHUNK_BYTES = 1 << 18
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the output."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def random_words(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    return random_at(np.arange(n), seed)


def random_at(i: np.ndarray, seed: int) -> np.ndarray:
    """The values at places ``i`` of the endless series of a seed."""
    with np.errstate(over="ignore"):
        return mix((i.astype(U64) + U64(seed + 1)) * U64(0x9E3779B97F4A7C15))


_BYTE = random_words(256, 11)
_PLACE_SEED = 23
#: The first weights; later ones are computed where a word is that long.
_PLACE = random_words(1 << 12, _PLACE_SEED) | U64(1)
#: White space of the word contracts: tab to carriage return, and the space.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def text_runs(column: pa.Array, chunk: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) over consecutive texts; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + chunk, "right")) - 1)
        yield a, b, data[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
        a = b


def words(data: np.ndarray, offs: np.ndarray, separator: np.ndarray = SPACE,
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes (A-Z lowered) of the words, and for each text
    the index of its first word (one more entry than texts)."""
    if not len(data):
        return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64),
                np.zeros(len(offs), np.int64))
    inside = ~separator[data]
    first = inside.copy()
    first[1:] &= separator[data[:-1]]
    heads = offs[:-1][(offs[:-1] < len(data))]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, starts, np.zeros(0, U64), np.zeros(len(offs), np.int64)
    lengths = np.add.reduceat(inside, starts, dtype=np.int64)
    marks = np.concatenate([[0], starts, [len(data)]])
    place = np.arange(len(data)) - np.repeat(marks[:-1], np.diff(marks))
    weight = _PLACE[np.minimum(place, len(_PLACE) - 1)]
    far = np.flatnonzero(place >= len(_PLACE))
    weight[far] = random_at(place[far], _PLACE_SEED) | U64(1)
    value = np.where(inside, _BYTE[LOWER[data]], U64(0)) * weight
    with np.errstate(over="ignore"):
        h = mix(np.add.reduceat(value, starts) + lengths.astype(U64) * U64(0xD6E8FEB86659FD93))
    return starts, starts + lengths, h, np.searchsorted(starts, offs)
