"""Per-run BPE tokenization helper used inside Arrow-batched UDFs.

Rule being reproduced: repeat { among adjacent token pairs whose
concatenation is a vocabulary entry, take the one with the lowest id; merge
every occurrence left to right without overlap } until no pair qualifies.

A linked list plus a heap keyed by id gives O(n log n) per run instead of a
rescan per merge, which matters for long runs (cleaned text in reference
mode is one run per document).  A small vocabulary takes a shorter way with
the same result (:class:`Rewriter`): whole texts, one string replacement for
each entry in id order.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa

from tokenmill.operators.arrow_ids import code_points, lists, lookup, text_slices

# Python whitespace (str.isspace) -- a run is a maximal non-whitespace
# stretch or one whitespace character.  No vocabulary entry contains
# whitespace, so runs never merge across each other.
_RUNS = re.compile(r"\s|\S+")


def tokenize_run(run: str, stoi: dict[str, int]) -> list[str]:
    n = len(run)
    if n < 2:
        return list(run)
    toks = list(run)
    nxt = list(range(1, n + 1))
    nxt[-1] = -1
    prv = list(range(-1, n - 1))
    alive = [True] * n
    occ: dict[str, set[int]] = {}
    heap: list[tuple[int, str]] = []

    def add(i: int) -> None:
        j = nxt[i]
        if j < 0:
            return
        s = toks[i] + toks[j]
        sid = stoi.get(s)
        if sid is None:
            return
        st = occ.get(s)
        if st is None:
            occ[s] = {i}
            heapq.heappush(heap, (sid, s))
        else:
            st.add(i)

    def remove(i: int) -> None:
        j = nxt[i]
        if j < 0:
            return
        st = occ.get(toks[i] + toks[j])
        if st:
            st.discard(i)

    for i in range(n - 1):
        add(i)
    while heap:
        _, s = heapq.heappop(heap)
        st = occ.pop(s, None)
        if not st:
            continue
        for i in sorted(st):  # node ids follow text order
            if not alive[i]:
                continue  # consumed as the right half of the previous merge
            j = nxt[i]
            if j < 0 or toks[i] + toks[j] != s:
                continue
            p = prv[i]
            if p >= 0:
                remove(p)
            remove(j)
            toks[i] = s
            alive[j] = False
            k = nxt[j]
            nxt[i] = k
            if k >= 0:
                prv[k] = i
            if p >= 0:
                add(p)
            add(i)
    out = []
    i = 0
    while i >= 0:
        out.append(toks[i])
        i = nxt[i]
    return out


def tokenize_text(text: str, stoi: dict[str, int]) -> list[str]:
    out: list[str] = []
    for run in _RUNS.findall(text):
        out.extend(tokenize_run(run, stoi))
    return out


#: The memo holds so many characters of runs (about 25 bytes each with their
#: ids), and no run longer than this: long runs are documents, which rarely repeat.
MEMO_CHARS = 2_000_000
MEMO_RUN = 64


class RunEncoder:
    """Encodes texts run by run; a memo of short runs bounded by characters."""

    def __init__(self, stoi: dict[str, int], memo_chars: int = MEMO_CHARS) -> None:
        self.stoi = stoi
        self.memo: dict[str, list[int] | None] = {}
        self.memo_chars = memo_chars
        self.held = 0

    def solve(self, run: str) -> list[int] | None:
        try:
            return [self.stoi[t] for t in tokenize_run(run, self.stoi)]
        except KeyError:
            return None

    def run_ids(self, run: str) -> list[int] | None:
        if len(run) > MEMO_RUN:
            return self.solve(run)
        got = self.memo.get(run, False)
        if got is not False:
            return got
        ids = self.solve(run)
        self.held += len(run)
        if self.held > self.memo_chars:
            self.memo.clear()
            self.held = len(run)
        self.memo[run] = ids
        return ids

    def encode(self, text: str | None) -> list[int] | None:
        """Ids of the whole text, or None when any token is out of vocabulary."""
        if text is None:
            return None
        out: list[int] = []
        for run in _RUNS.findall(text):
            ids = self.run_ids(run)
            if ids is None:
                return None
            out.extend(ids)
        return out


#: Vocabularies with more entries than this are worked run by run.
REWRITE_ENTRIES = 512
_FIRST_SYMBOL = 0xE000  # private use: one character stands for one entry
_PRIVATE = re.compile("[\ue000-\uf8ff]")


class Rewriter:
    """The rule of :func:`tokenize_run` on whole texts, each entry written as
    one private-use character.

    Runs do not touch each other, so the lowest entry of the whole text is the
    lowest of every run that holds it.  A replacement makes new pairs with its
    own symbol only, so the search goes on at the lowest entry that has it as a
    half; no entry holds whitespace, so nothing is merged across runs.
    """

    def __init__(self, stoi: dict[str, int]) -> None:
        entries = [s for _, s in sorted((i, s) for s, i in stoi.items() if len(s) > 1 and not any(c.isspace() for c in s))]
        symbol = {s: chr(_FIRST_SYMBOL + j) for j, s in enumerate(entries)}
        self.steps: list = []
        back = dict.fromkeys(entries, len(entries))
        for j, s in enumerate(entries):
            halves = [(a, b) for a, b in ((s[:k], s[k:]) for k in range(1, len(s)))
                      if (len(a) == 1 or a in symbol) and (len(b) == 1 or b in symbol)]
            for half in {x for pair in halves for x in pair if x in symbol}:
                back[half] = min(back[half], j)
            needles = [symbol.get(a, a) + symbol.get(b, b) for a, b in halves]
            some = re.compile("|".join(map(re.escape, needles))) if len(needles) > 1 else None
            self.steps.append((needles, some, symbol[s]))
        self.back = [back[s] for s in entries]
        self.table = np.full(0x110000, -1, np.int32)
        for token, i in stoi.items():
            if len(token) == 1:
                self.table[ord(token)] = i
        for s, c in symbol.items():
            self.table[ord(c)] = stoi[s]
        self.token = {ord(c): s for s, c in symbol.items()}

    def rewrite(self, text: str) -> str:
        j = 0
        while j < len(self.steps):
            needles, some, made = self.steps[j]
            if any(n in text for n in needles):
                text = some.sub(made, text) if some else text.replace(needles[0], made)
                j = min(self.back[j], j + 1)
            else:
                j += 1
        return text


class BatchEncoder:
    """Tokens or ids of Arrow batches of texts, slice by slice."""

    def __init__(self, stoi: dict[str, int]) -> None:
        self.stoi = stoi
        self.runs = RunEncoder(stoi)
        self.rewriter = Rewriter(stoi) if len(stoi) <= REWRITE_ENTRIES else None

    def _rewritten(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """(code points, sizes, null) of the rewritten texts; None where the
        texts themselves hold private-use characters, or entries are too many."""
        if self.rewriter is None or any(t and not t.isascii() and _PRIVATE.search(t) for t in texts):
            return None
        new = [self.rewriter.rewrite(t) if t else "" for t in texts]
        return code_points("".join(new)), np.array([len(t) for t in new], np.int64), np.array([t is None for t in texts], bool)

    def ids(self, batch: pa.Array):
        for part in text_slices(batch):
            texts = part.to_pylist()
            found = self._rewritten(texts)
            if found:
                codes, sizes, null = found
                yield lookup(codes, self.rewriter.table, sizes, null)
            else:
                yield pa.array([self.runs.encode(t) for t in texts], pa.list_(pa.int32()))

    def run_ids(self, runs: pa.Array) -> pa.Array:
        """Ids of runs (no white space in them), slices of them as one text."""
        made = [pa.array([], pa.list_(pa.int32()))]
        for part in text_slices(runs):
            found = self._rewritten([" ".join(part.to_pylist())]) if len(part) else None
            if not found:
                made += self.ids(part)
                continue
            ends = np.append(np.flatnonzero(found[0] == ord(" ")), len(found[0]))
            sizes = np.diff(ends, prepend=-1) - 1
            made.append(lookup(found[0][found[0] != ord(" ")], self.rewriter.table, sizes, np.zeros(len(sizes), bool)))
        return pa.concat_arrays(made)

    def tokens(self, batch: pa.Array):
        for part in text_slices(batch):
            texts = part.to_pylist()
            found = self._rewritten(texts)
            if found:
                codes, sizes, null = found
                known, code = np.unique(codes, return_inverse=True)
                names = pa.array([self.rewriter.token.get(c, chr(c)) for c in known.tolist()], pa.string())
                yield lists(names.take(pa.array(code)), sizes, null)
            else:
                yield pa.array([None if t is None else tokenize_text(t, self.stoi) for t in texts], pa.list_(pa.string()))
