"""Set similarity join on word shingles: partition the token universe and
use the pigeonhole principle, then verify exactly.

A text's set holds its distinct five-word shingles (64-bit hashes).  Sizes
fall into bands ``[2**j, 2**(j+1))``.  The scheme of band j deals the universe
into ``m_j`` segments by a token hash.  For a pair with ``|s| <= |r|`` and s
in band j, Jaccard >= 0.8 means a Hamming distance of at most
``H = (|r| + |s|) // 9``, so of any units ``sum(allocation) >= H + 1`` that r
spends on segments, one segment must agree: exactly for an allocation of 1,
up to one deletion on either side for 2, not looked at for 0.

* Index side: a signature of every segment that is not empty under the set's
  own scheme, in bands below 64 tokens also of its one-deletion neighbours.
* Probe side: under its own scheme and, where a pair across bands is
  possible, the scheme below, r spends its H + 1 units where they cost least.
  The cost of a segment is the document frequency of its rarest token (times
  its neighbours for the second unit), read from a fixed table of 2**21
  counters over all documents.  Segments that lie wholly inside a passage
  shared by many documents are thus passed over.
* If a set's tokens fall into too few segments for H + 1 units (chance below
  1e-6 a document), it probes again under another seed, in a further run
  over all documents, until none is left.  No case is dropped.

Signatures travel as packed blocks (4 bytes plus a 2-byte reference each, and
the sets' first fingerprints) to the owner of their hash range; a task sends one
entry for all equal sets it has read.  Pairs are never expanded inside a bucket:
equal sets are one node (their class), and each bucket that holds two of them or
more and a probe hands its members to one probing member, its center; the
members of all buckets of a center are its cluster.  Owners hold whole buckets
and return (center, member) with the buckets shared, so buckets themselves are
neither stored nor shuffled.  Classes that share a first fingerprint stand in
each other's clusters, which only adds candidates.

* Sketches: a pair whose parity sketches (:func:`parities`) differ in more bits
  than a link's sets may in tokens is ruled out before its sets travel; sets of
  no pair to verify stay where they are, behind a Bloom filter.
* Stars: a center is verified against the members it shares two buckets or
  more with; similar ones are merged to components.
* Hubs: of a cluster with ``HUB_MEMBERS`` or more in several components, the
  member nearest to the bits that most members' parity sketches have is its
  hub.  Each component is verified at the member next to a hub, so that a
  group around one text becomes one component for a pair a member; further
  rounds take hubs from those outside the largest component, until a round
  connects few.
* Rest: two members of a cluster can still be similar only if they lie in
  different components.  In clusters below ``HUB_MEMBERS`` such members meet by
  their sketches.  In larger ones they must share one of the rarest tokens of
  both (n - o + 1 of n, for an intersection of o): members of clusters that hold
  several components meet by such a token, those of the token's largest
  component only the others.  Pairs that their sketches leave are verified.
  Large groups of near copies thus pay for the tokens that tell their members
  apart, not for their pairs.

Every link comes from a verification on the full sets; pairs not verified are
ruled out by a bound or already connected, so components are exact.  Sets of
cluster members are made in a further scan, behind a Bloom filter of their
ids (2**26 bits at most); texts are never shuffled.

Defined cases: null or empty texts have no set and link with nothing; fewer
than five words are one shingle; rows repeating an id and text are copies; a
row whose id is null takes no part (component null); an empty table gives an
empty result.  Different texts should have different ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.llm import tables as T
from tokenmill.llm.bytehash import U64, mix, random_words, text_runs, words
from tokenmill.llm.components import components, extend

SHINGLE = 5
CELL_BITS = 21
#: The counter table travels in blocks of this many counters.
CELL_BLOCK = 1 << 15
#: Bands below this one index one-deletion neighbours (sets below 64 tokens).
DELETION_BANDS = 6
#: Entries and documents that a task packs into one set of blocks.
PACK_ENTRIES, PACK_DOCS = 1 << 19, 1 << 15
#: Entries that an owner handles at a time.
OWNER_ENTRIES = 400_000
MAX_SEEDS = 16
#: Parts that the members of one center are dealt to.
CENTER_SALTS = 16
#: Longs of a set's parity sketch.
SKETCH_WORDS = 16
#: Members from which on a cluster has a hub.
HUB_MEMBERS = 32
_WEIGHT = random_words(SHINGLE, 5) | U64(1)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes."""
    for a, b, data, offs in text_runs(column):
        _, _, w, first = words(data, offs)
        if len(w) >= SHINGLE:
            full = sum(w[k:len(w) - SHINGLE + 1 + k] * _WEIGHT[k] for k in range(SHINGLE))
            full = mix(full)
        for i in range(b - a):
            lo, hi = first[i], first[i + 1]
            if hi - lo >= SHINGLE:
                yield np.unique(full[lo:hi - SHINGLE + 1])
            elif hi > lo:
                yield mix((w[lo:hi] * _WEIGHT[:hi - lo]).sum(keepdims=True) + U64(hi - lo))
            else:
                yield w[:0]


def _fingerprint(s: np.ndarray) -> tuple[int, int]:
    return (int(mix(s + U64(1)).sum().astype(np.int64)), int(mix(s ^ U64(0x5851F42D4C957F2D)).sum().astype(np.int64)))


def _cell(s: np.ndarray) -> np.ndarray:
    return (s >> U64(64 - CELL_BITS)).astype(np.int64)


_KEYS = pa.schema([("kind", pa.int32()), ("id", pa.int64()), ("n", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()),
                   ("cells", pa.binary())])


def _key_task():
    """Rows (0, id, set size, fingerprint) and, at the end, (1, block, packed counters)."""
    cells = np.zeros(1 << CELL_BITS, np.uint32)
    seen: set[int] = set()

    def fn(batch):
        out = []
        for s in shingle_sets(batch.column(1)):
            f = _fingerprint(s)
            out.append((len(s), *f))
            if f[0] not in seen:
                seen.add(f[0])
                np.add.at(cells, _cell(s), 1)
        if len(seen) > 1 << 20:
            seen.clear()
        n, f1, f2 = zip(*out) if out else ((), (), ())
        yield pa.record_batch([pa.array(np.zeros(len(n), np.int32)), batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()),
                               pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.nulls(len(n), pa.binary())], schema=_KEYS)

    def end():
        blocks = cells.reshape(-1, CELL_BLOCK)
        at = np.flatnonzero(blocks.any(1))
        zero = pa.array(np.zeros(len(at), np.int64))
        yield pa.record_batch([pa.array(np.ones(len(at), np.int32)), pa.array(at), zero, zero, zero,
                               pa.array([zlib.compress(blocks[b].tobytes(), 1) for b in at], pa.binary())], schema=_KEYS)

    fn.end = end
    return fn


def _cell_sum_task():
    """Sums the blocks, which come sorted, of all tasks."""
    at, total = None, np.zeros(CELL_BLOCK, np.int64)

    def flush():
        if at is not None:
            yield pa.record_batch([pa.array([at]), pa.array([total.tobytes()], pa.binary())], names=["block", "cells"])

    def fn(batch):
        nonlocal at, total
        for block, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if block != at:
                yield from flush()
                at, total = block, np.zeros(CELL_BLOCK, np.int64)
            total += np.frombuffer(zlib.decompress(cells), np.uint32)

    fn.end = flush
    return fn


def scheme(n: int) -> int:
    return n.bit_length() - 1


def n_segments(j: int) -> int:
    return -(-3 * 2 ** (j + 1) // 10) + 1


class Signer:
    """Signatures of one set, under one seed; ``cost`` is the counter table."""

    def __init__(self, cost: np.ndarray, seed: int) -> None:
        self.cost, self.salt = cost, random_words(4 * (seed + 1), 77)[-4:]

    def _segments(self, s: np.ndarray, j: int):
        m = n_segments(j)
        seg = ((mix(s + self.salt[0] + U64(j)) >> U64(32)) * U64(m) >> U64(32)).astype(np.int64)
        order = np.argsort(seg, kind="stable")
        seg = seg[order]
        heads = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
        token = mix(s + self.salt[1])[order]
        total = np.add.reduceat(token, heads)
        place = mix(seg[heads].astype(U64) * U64(1 << 20) + U64(j) + self.salt[2])
        k = np.diff(np.append(heads, len(s)))
        rarest = np.minimum.reduceat(self.cost[_cell(s)][order], heads)
        return token, total, place, k, rarest

    @staticmethod
    def allocate(k: np.ndarray, rarest: np.ndarray, need: int, deletions: bool) -> np.ndarray | None:
        """Units (0, 1 or 2) for each segment, ``need`` in all, at least cost;
        None if the segments cannot take so many."""
        units = np.arange(len(k))
        cost = rarest.astype(np.float64)
        if deletions:
            two = np.flatnonzero(k >= 2)
            units, cost = np.concatenate([units, two]), np.concatenate([cost, cost[two] * k[two]])
        if need > len(units):
            return None
        taken = units[np.argsort(cost, kind="stable")[:need]]
        return np.bincount(taken, minlength=len(k))

    def sign(self, s: np.ndarray, probing: bool) -> tuple[np.ndarray, np.ndarray, bool]:
        """(signatures, is-probe flags, whether some scheme was too short)."""
        n, out, flags, short = len(s), [], [], False
        j = scheme(n)
        ways = [(j, 2 * n // 9 + 1, True)]
        if probing and j and 4 * n <= 5 * (2 ** j - 1):
            ways.append((j - 1, (n + 2 ** j - 1) // 9 + 1, False))
        for at, need, own in ways:
            deletions = at < DELETION_BANDS
            token, total, place, k, rarest = self._segments(s, at)
            units = self.allocate(k, rarest, need, deletions) if probing else None
            short |= probing and units is None
            if units is None:
                units = np.zeros(len(k), np.int64)
            full = mix(total + place)
            use = slice(None) if own else units > 0
            out.append(full[use])
            flags.append(units[use] > 0)
            if deletions:
                less = mix(np.repeat(total + place, k) - token)
                wide = np.repeat(k >= 2, k) & (np.ones(len(s), bool) if own else np.repeat(units == 2, k))
                out.append(less[wide])
                flags.append(np.repeat(units == 2, k)[wide])
        return np.concatenate(out), np.concatenate(flags), short


_BLOCK = pa.schema([("part", pa.int64()), ("sets", pa.binary()), ("low", pa.binary()), ("ref", pa.binary())])
#: The part that carries sets (first fingerprints) that must probe under a further seed.
SHORT = -1


def _sign_task(cost, seed: int, n_parts: int, signer: type = Signer):
    signers = [signer(cost.value, k) for k in range(seed + 1)]
    names: list[int] = []
    short: list[int] = []
    sigs: list[np.ndarray] = []
    flags: list[np.ndarray] = []
    seen: set[tuple[int, int]] = set()
    held = 0

    def emit():
        nonlocal held
        rows = []
        if short:
            rows.append((SHORT, np.array(short, np.int64).tobytes(), b"", b""))
        if sigs:
            sig, flag = np.concatenate(sigs), np.concatenate(flags)
            ref = (np.repeat(np.arange(len(sigs)), [len(x) for x in sigs]) << 1 | flag).astype(np.uint16)
            part = (sig >> U64(32)) * U64(n_parts) >> U64(32)
            order = np.argsort(part, kind="stable")
            part, sig, ref = part[order], sig[order].astype(np.uint32), ref[order]
            heads = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            name_of = np.array(names, np.int64)
            for a, b in zip(heads, np.append(heads[1:], len(part))):
                docs, inverse = np.unique(ref[a:b] >> 1, return_inverse=True)
                local = (inverse.astype(np.uint16) << 1) | (ref[a:b] & 1)
                rows.append((int(part[a]), name_of[docs].tobytes(), sig[a:b].tobytes(), local.astype(np.uint16).tobytes()))
        for x in (names, short, sigs, flags):
            x.clear()
        held = 0
        if rows:
            cols = list(zip(*rows))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, _BLOCK)], schema=_BLOCK)

    def fn(batch):
        nonlocal held
        for id_, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1))):
            if id_ is None or not len(s):
                continue
            f = _fingerprint(s)
            if f in seen:
                continue
            seen.add(f)
            probing = all(g.sign(s, True)[2] for g in signers[:-1])
            sig, flag, too_short = signers[-1].sign(s, probing)
            if too_short:
                short.append(f[0])
            names.append(f[0])
            sigs.append(sig)
            flags.append(flag)
            held += len(sig)
            if held >= PACK_ENTRIES or len(names) >= PACK_DOCS - 1:
                yield from emit()
        if len(seen) > 1 << 20:
            seen.clear()

    fn.end = emit
    return fn


#: ``shared`` is 0 in the rows of sets that must probe again.
_MEMBER = pa.schema([("center", pa.int64()), ("member", pa.int64()), ("shared", pa.int64())])


def _heads(*sorted_: np.ndarray) -> np.ndarray:
    """Where a new tuple of values begins."""
    return np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([x[1:] != x[:-1] for x in sorted_])]))


def _meet(low: np.ndarray, name: np.ndarray, probe: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(center, member, shared) of the buckets of equal ``low``: the center is
    the smallest probing member; buckets of one member or without a probe give none."""
    order = np.argsort(low, kind="stable")
    size = np.diff(np.append(at := _heads(low[order]), len(low)))
    order = order[np.repeat((size >= 2) & np.logical_or.reduceat(probe[order], at), size)]
    if not len(order):
        return (np.zeros(0, np.int64),) * 3
    order = order[np.lexsort((name[order], low[order]))]
    low, name, probe = low[order], name[order], probe[order]
    at = _heads(low, name)  # copies from several tasks are one member
    low, name, probe = low[at], name[at], np.logical_or.reduceat(probe, at)
    at = _heads(low)
    size = np.diff(np.append(at, len(low)))
    first = np.minimum.reduceat(np.where(probe, np.arange(len(low)), len(low) - 1), at)
    keep = np.repeat(size >= 2, size)
    center, member = np.repeat(name[first], size)[keep], name[keep]
    if not len(center):
        return center, member, member
    order = np.lexsort((member, center))
    center, member = center[order], member[order]
    at = _heads(center, member)
    return center[at], member[at], np.diff(np.append(at, len(center)))


def _owner_task():
    at, held = None, []

    def flush():
        if not held:
            return
        if at == SHORT:
            short = np.concatenate([np.frombuffer(h[0], np.int64) for h in held])
            yield pa.record_batch([pa.array(short), pa.array(short), pa.array(np.zeros(len(short), np.int64))], schema=_MEMBER)
        else:
            ref = [np.frombuffer(h[2], np.uint16) for h in held]
            found = _meet(np.concatenate([np.frombuffer(h[1], np.uint32) for h in held]),
                          np.concatenate([np.frombuffer(h[0], np.int64)[r >> 1] for h, r in zip(held, ref)]),
                          (np.concatenate(ref) & 1).astype(bool))
            yield pa.record_batch([pa.array(x) for x in found], schema=_MEMBER)
        held.clear()

    def fn(batch):
        nonlocal at
        cols = [batch.column(i).to_pylist() for i in range(4)]
        for part, *block in zip(*cols):
            if part != at:
                yield from flush()
                at = part
            held.append(block)

    fn.end = flush
    return fn


def _bloom_bits(ids: np.ndarray, n_bits: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(ids.astype(np.int64).view(U64) + U64(3))
    return (h & U64(n_bits - 1)).astype(np.int64), (h >> U64(38) & U64(n_bits - 1)).astype(np.int64)


def _bloom_task(n_bits: int):
    """Words of the filter that this task's ids set, sent once at its end."""
    bits = np.zeros(n_bits, bool)

    def fn(batch):
        for at in _bloom_bits(batch.column(0).to_numpy(), n_bits):
            bits[at] = True
        return ()

    def end():
        packed = np.packbits(bits).view(np.int64)
        at = np.flatnonzero(packed)
        yield pa.record_batch([pa.array(at), pa.array(packed[at])], names=["at", "word"])

    fn.end = end
    return fn


def _set_task(bloom, n_bits: int):
    def fn(batch):
        bits = bloom.value
        known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
        one, two = _bloom_bits(batch.column(0).cast(pa.int64()).fill_null(0).to_numpy(), n_bits)
        hit = known & bits[one] & bits[two]
        if hit.any():
            batch = batch.filter(pa.array(hit))
            sets = [s.tobytes() for s in shingle_sets(batch.column(1))]
            yield pa.record_batch([batch.column(0).cast(pa.int64()), pa.array(sets, pa.binary())], names=["id", "set"])
    return fn


def _pick_task(bloom, n_bits: int):
    """The rows of the filter's ids."""
    def fn(batch):
        one, two = _bloom_bits(batch.column(0).to_numpy(), n_bits)
        bits = bloom.value
        hit = bits[one] & bits[two]
        if hit.any():
            yield batch.filter(pa.array(hit))
    return fn


def _rare_task(cost):
    """(id, n, place, token): the n // 5 + 1 rarest tokens, by counter and hash."""
    def fn(batch):
        for id_, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            s = np.frombuffer(raw, U64)
            top = s[np.lexsort((s, cost.value[_cell(s)]))[:len(s) // 5 + 1]]
            full = np.full(len(top), id_, np.int64), np.full(len(top), len(s), np.int64)
            yield pa.record_batch([pa.array(full[0]), pa.array(full[1]), pa.array(np.arange(1, len(top) + 1)),
                                   pa.array(top.view(np.int64))], names=["id", "n", "place", "token"])
    return fn


def parities(s: np.ndarray) -> np.ndarray:
    """Whether each of ``SKETCH_WORDS`` * 64 cells holds an odd number of the
    set's tokens.  A token in one of two sets turns one bit, so sketches differ
    in no more bits than the sets in tokens."""
    bits = np.bincount((mix(s + U64(9)) & U64(64 * SKETCH_WORDS - 1)).astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _sketch_task():
    def fn(batch):
        found = [parities(np.frombuffer(raw, U64)).tolist() for raw in batch.column(1).to_pylist()]
        yield pa.record_batch([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["id", "sketch"])
    return fn


def _apart(sketch: str, other: str) -> Column:
    """Bits in which two sketches differ."""
    return sum((F.bit_count(F.col(sketch)[k].bitwiseXOR(F.col(other)[k])) for k in range(SKETCH_WORDS)), F.lit(0))


def _may_link(sketch: str, other: str, n: str, n2: str) -> Column:
    """Whether the sketches leave the (n + n2) / 9 differing tokens a link may have."""
    return 9 * _apart(sketch, other) <= F.col(n) + F.col(n2)


def _vote_task(last: bool):
    """Sums the sketches (of a first run: the votes) of each center, which come
    sorted: sets and, for each bit, sets that have it; in the last run the
    sketch of the bits that most sets have."""
    at, total = None, np.zeros(64 * SKETCH_WORDS + 1, np.int64)

    def flush():
        if at is not None and last:
            most = np.packbits((2 * total[1:] > total[0]).astype(np.uint8)).view(np.int64).tolist()
            yield pa.record_batch([pa.array([at]), pa.array([most], pa.list_(pa.int64()))], names=["center", "heart"])
        elif at is not None:
            yield pa.record_batch([pa.array([at]), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], names=["center", "votes"])

    def fn(batch):
        nonlocal at
        for center, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if center != at:
                yield from flush()
                at = center
                total[:] = 0
            if last:
                total[:] += np.frombuffer(zlib.decompress(x), np.int64)
            else:
                total[0] += 1
                total[1:] += np.unpackbits(np.array(x, np.int64).view(np.uint8))

    fn.end = flush
    return fn


def _hub_pairs(members: DataFrame, among: DataFrame) -> DataFrame:
    """(a, b): for each component among ``members`` (center, salt, rep, n,
    label, sketch) its member next to the hub of one of its centers.  A
    center's hub is the one of ``among`` next to the bits that most of them have."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(CENTER_SALTS - 1))).alias("salt")
    votes = among.select("center", "sketch", "salt").repartition("center", "salt").sortWithinPartitions("center")
    votes = T.map_arrow(votes.drop("salt"), lambda: _vote_task(False), "center long, votes binary")
    hearts = T.map_arrow(votes.repartition("center").sortWithinPartitions("center"), lambda: _vote_task(True),
                         "center long, heart array<long>")
    hearts = T.store(hearts, "hearts").select("center", "heart", salts)
    hubs = (among.join(hearts, ["center", "salt"])
            .groupBy("center").agg(F.min(F.struct(_apart("sketch", "heart").alias("apart"), "rep", "n", "label", "sketch")).alias("h")))
    hubs = T.store(hubs, "hubs").select("center", F.col("h.rep").alias("r2"), F.col("h.n").alias("n2"), F.col("h.label").alias("l2"),
                                        F.col("h.sketch").alias("s2"), salts)
    near = (members.join(hubs, ["center", "salt"])
            .where((F.col("label") != F.col("l2")) & _sizes_fit("n", "n2") & _may_link("sketch", "s2", "n", "n2"))
            .groupBy("label").agg(F.min(F.struct(_apart("sketch", "s2").alias("apart"), "rep", "r2")).alias("p")))
    return near.select(F.least("p.rep", "p.r2").alias("a"), F.greatest("p.rep", "p.r2").alias("b")).distinct()


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """100 * intersection >= 80 * union, of sorted distinct arrays."""
    both = len(x) + len(y) - len(np.union1d(x, y))
    return 100 * both >= 80 * (len(x) + len(y) - both)


def _verify_task():
    def fn(batch):
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        ok = [similar(np.frombuffer(p, U64), np.frombuffer(q, U64)) for p, q in zip(x, y)]
        yield pa.record_batch([pa.array([i for i, k in zip(a, ok) if k], pa.int64()),
                               pa.array([i for i, k in zip(b, ok) if k], pa.int64())], schema=_PAIR)
    return fn


def _docs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def _bloom(wanted: DataFrame):
    """(broadcast filter, its bits) of different ids."""
    n_bits = 1 << min(26, max(16, (16 * wanted.count()).bit_length()))
    words = (T.map_arrow(wanted, lambda: _bloom_task(n_bits), "at long, word long")
             .groupBy("at").agg(F.bit_or("word").alias("word")).toPandas())
    packed = np.zeros(n_bits // 64, np.int64)
    packed[words["at"].to_numpy(np.int64)] = words["word"].to_numpy(np.int64)
    return wanted.sparkSession.sparkContext.broadcast(np.unpackbits(packed.view(np.uint8)).astype(bool)), n_bits


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, set) of the wanted ids, and of few others."""
    bloom, n_bits = _bloom(T.store(wanted.distinct(), "set-ids"))
    return T.store(T.map_arrow(docs, lambda: _set_task(bloom, n_bits), "id long, set binary"), "sets")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar.  Only sets of some pair, and few others, travel."""
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    bloom, n_bits = _bloom(T.store(wanted, "pair-ids"))
    sets = T.map_arrow(sets, lambda: _pick_task(bloom, n_bits), "id long, set binary")
    both = (pairs.join(sets.select(F.col("id").alias("b"), F.col("set").alias("y")), "b")
            .join(sets.select(F.col("id").alias("a"), F.col("set").alias("x")), "a").select("a", "b", "x", "y"))
    return T.store(T.map_arrow(both, _verify_task, "a long, b long").distinct(), "links")


def _sizes_fit(a: str, b: str):
    return 100 * F.least(a, b) >= 80 * F.greatest(a, b)


class Join:
    """The stored results of one join: ``keys`` (id, n, class fingerprints),
    ``classes`` (fingerprints, rep, copies), ``links`` between class
    representatives, and ``labels`` (node, label)."""

    def __init__(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", signer: type = Signer) -> None:
        spark = T.ready(df.sparkSession)
        docs = _docs(df, id_col, text_col)
        found = T.store(T.map_arrow(docs, _key_task, "kind int, id long, n long, fp1 long, fp2 long, cells binary"), "set-keys")
        self.keys = found.where("kind = 0").drop("kind", "cells")
        blocks = found.where("kind = 1").select("id", "cells").repartition("id").sortWithinPartitions("id")
        cost = np.zeros((1 << CELL_BITS, ), np.int64).reshape(-1, CELL_BLOCK)
        for r in T.map_arrow(blocks, _cell_sum_task, "block long, cells binary").collect():
            cost[r["block"]] = np.frombuffer(r["cells"], np.int64)
        cost = np.minimum(cost.ravel(), 2 ** 32 - 1).astype(np.uint32)
        tokens = self.keys.agg(F.sum("n")).first()[0] or 0
        self.classes = T.store(self.keys.where("n > 0 and id is not null").groupBy("fp1", "fp2", "n")
                               .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "set-classes")
        shared = spark.sparkContext.broadcast(cost)  # 2**21 counters, whatever the corpus
        members, seed = [], 0
        n_parts = max(64, -(-int(0.45 * tokens) // OWNER_ENTRIES))
        while True:
            blocks = T.map_arrow(docs, lambda seed=seed: _sign_task(shared, seed, n_parts, signer),
                                 "part long, sets binary, low binary, ref binary")
            owned = blocks.repartition("part").sortWithinPartitions("part")
            found = T.store(T.map_arrow(owned, _owner_task, "center long, member long, shared long"), "bucket-members")
            members.append(found.where("shared > 0"))
            if found.where("shared = 0").isEmpty():
                break
            seed += 1
            if seed == MAX_SEEDS:
                raise RuntimeError("sets without enough segments under every seed")
        rows = members[0]
        for more in members[1:]:
            rows = rows.unionByName(more)
        self._link(rows, docs, shared)

    def _link(self, rows: DataFrame, docs: DataFrame, shared) -> None:
        rows = T.store(rows.groupBy("center", "member").agg(F.sum("shared").alias("shared")), "members")
        for end, rep, n in ("center", "c", "cn"), ("member", "rep", "n"):
            rows = rows.join(self.classes.select(F.col("fp1").alias(end), F.col("rep").alias(rep), F.col("n").alias(n)), end).drop(end)
        clusters = T.store(rows.withColumnRenamed("c", "center"), "clusters")
        sets = _sets(docs, clusters.select(F.col("rep").alias("id")))
        sketches = T.map_arrow(sets, _sketch_task, "id long, sketch array<long>").withColumnRenamed("id", "rep")
        sketches = T.store(sketches.distinct(), "sketches")
        star = (clusters.where((F.col("rep") != F.col("center")) & (F.col("shared") > 1) & _sizes_fit("n", "cn"))
                .join(sketches, "rep").join(sketches.select(F.col("rep").alias("center"), F.col("sketch").alias("s2")), "center")
                .where(_may_link("sketch", "s2", "n", "cn"))
                .select(F.least("rep", "center").alias("a"), F.greatest("rep", "center").alias("b")).distinct())
        star = T.store(star, "star-pairs")
        links = _verified(star, sets)
        labels = components(links)
        at = self._open(clusters, labels)
        # Members of crowded clusters meet their hubs, until that connects few.
        others, more = "size", True
        while more:
            crowd = at.where(F.col(others) >= HUB_MEMBERS)
            if crowd.isEmpty():
                break
            crowd = T.store(crowd.join(sketches, "rep"), "crowd")
            near = T.store(_hub_pairs(crowd, crowd if others == "size" else crowd.where("label <> major")), "hub-pairs")
            tried, second = near.count(), _verified(near, sets)
            found = second.count()
            if found:
                links, labels = links.unionByName(second), extend(labels, second)
                at = self._open(clusters, labels)
            others, more = "outside", found >= max(HUB_MEMBERS, tried / 4)
        # What is left: members of one cluster in different components.  In small clusters they all meet.
        small = T.store(at.where(F.col("size") < HUB_MEMBERS).select("center", "rep", "n", "label").join(sketches, "rep"), "small-clusters")
        few = small.select("center", F.col("rep").alias("r2"), F.col("n").alias("n2"), F.col("label").alias("l2"), F.col("sketch").alias("s2"))
        near = (small.join(few, "center")
                .where((F.col("rep") < F.col("r2")) & (F.col("label") != F.col("l2")) & _sizes_fit("n", "n2") & _may_link("sketch", "s2", "n", "n2"))
                .select(F.col("rep").alias("a"), F.col("r2").alias("b")))
        # In the others they share a rare token.
        at = T.store(at.where(F.col("size") >= HUB_MEMBERS).groupBy("rep").agg(F.max("label").alias("label")), "open-members")
        rare = T.map_arrow(sets.join(at.select(F.col("rep").alias("id")), "id", "left_semi"),
                           lambda: _rare_task(shared), "id long, n long, place long, token long")
        rare = T.store(at.join(rare.withColumnRenamed("id", "rep"), "rep"), "rare-tokens")
        most = (rare.groupBy("token", "label").agg(F.count(F.lit(1)).alias("k"))
                .groupBy("token").agg(F.max(F.struct("k", "label")).alias("m"), F.count(F.lit(1)).alias("labels"))
                .where("labels > 1").select("token", F.col("m.label").alias("most")))
        rare = T.store(rare.join(most, "token").join(sketches, "rep"), "shared-tokens")
        few = rare.where("label <> most").select("token", F.col("rep").alias("r2"), F.col("n").alias("n2"),
                                                 F.col("place").alias("p2"), F.col("label").alias("l2"), F.col("sketch").alias("s2"))
        both = F.ceil((F.col("n") + F.col("n2")) * 4 / F.lit(9.0) - 1e-9)  # the intersection that a link needs
        rest = (rare.join(few, "token")
                .where((F.col("label") != F.col("l2")) & _sizes_fit("n", "n2")
                       & (F.col("place") <= F.col("n") - both + 1) & (F.col("p2") <= F.col("n2") - both + 1)
                       & _may_link("sketch", "s2", "n", "n2"))
                .select(F.least("rep", "r2").alias("a"), F.greatest("rep", "r2").alias("b"))
                .union(near).distinct().join(star, ["a", "b"], "left_anti"))
        rest = T.store(rest, "rest-pairs")
        if not rest.isEmpty():
            second = _verified(rest, sets)
            if not second.isEmpty():
                links, labels = links.unionByName(second), extend(labels, second)
        self.links, self.labels = links, labels

    @staticmethod
    def _open(clusters: DataFrame, labels: DataFrame) -> DataFrame:
        """(center, salt, rep, n, label, major, size, outside) of clusters that hold several
        components: the largest, all members and those not in the largest."""
        at = (clusters.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
              .select("center", "rep", "n", F.coalesce("label", "rep").alias("label")))
        at = T.store(at, "labelled-clusters")
        major = (at.groupBy("center", "label").agg(F.count(F.lit(1)).alias("k"))
                 .groupBy("center").agg(F.max(F.struct("k", "label")).alias("m"), F.count(F.lit(1)).alias("labels"), F.sum("k").alias("size"))
                 .where("labels > 1").select("center", F.col("m.label").alias("major"), "size", (F.col("size") - F.col("m.k")).alias("outside"))
                 .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(CENTER_SALTS - 1)))))
        # A center of many near copies is a hot key: its members are dealt over the salts.
        at = at.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(CENTER_SALTS)).cast("int"))
        return T.store(at.join(major, ["center", "salt"]), "open-clusters")

    def report(self) -> DataFrame:
        """One row per input row: doc_id, n_shingles, component_id."""
        home = (self.classes.join(self.labels.withColumnRenamed("node", "rep"), "rep", "left")
                .select("fp1", "fp2", "n", F.coalesce("label", "rep").alias("component")))
        return (self.keys.join(home, ["fp1", "fp2", "n"], "left")
                .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id")))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id."""
    return Join(df, id_col, text_col).report()


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with the smallest id of each component (rows without an id
    stay), with their own columns only.  Rows that repeat an id all stay."""
    gone = (near_duplicates(df, id_col, text_col).where("component_id <> doc_id")
            .select(F.col("doc_id").alias("_tm_id")).distinct())
    return T.records(T.with_record(df, id=F.col(f"`{id_col}`").cast("long")).join(gone, "_tm_id", "left_anti"))
