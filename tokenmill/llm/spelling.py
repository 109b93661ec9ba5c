"""Spelling variants: words at one edit from each other, by search schemes
over bidirectional FM-indexes of the vocabulary.

The vocabulary (distinct words and their counts) is one aggregation of the
corpus, map-side combined.  A word x is cut in two halves.  A word at one
inserted, deleted or replaced code point agrees exactly with one of them:
with the first (and stands at its beginning) or with the second (at its end).
So x meets its candidates under two keys, first half and second half; a word y
is put under every prefix and suffix that can be the half of a word one code
point shorter, as long, or longer.  Words with equal keys meet in one task,
and a key with more than ``BLOCK_CHARS`` of words is dealt over parts, each of
which answers all its queries; no pairs of a key are formed.

A task indexes the words of its keys, delimited as $w1$w2$...$, in both
directions: suffix ranks of the text and of its reversal, each with a wavelet
matrix over its BWT, which gives the rank of a symbol, and the number of
smaller symbols in a range, in one bit rank a level.  A search state is a pair
of suffix-rank intervals (lo, reverse lo, size).  The scheme for the first half
matches it right to left from the middle, then the delimiter, turns round, and
extends over the second half, where each step may spend the one allowed error:
all extensions of an interval by one symbol are enumerated level by level, so
only symbols that occur cost anything.  A state that reaches the closing
delimiter is one word: the rank of its suffix among those of the delimiter.
The other scheme is the mirror image, on the same index with the directions
exchanged.  Both run over all queries of a block at once, in numpy.

A near word found by the second scheme that also shares the first half was
found by the first, so each pair of words is reported once, from each side.

Defined cases: a text that is null has no words; a null id hashes as the empty
string; rows that repeat count again; words of any length and in any letters
of the pattern take part; of near words with equal counts the smallest in
code-point order is taken; an empty table gives an empty result; extra columns
play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm import tables as T

MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
#: One run in so many loses a code point (drawn by its hash).
DAMAGE = 31
LETTERS = "A-Za-zÀ-ÿ"

#: Characters that a block's index holds, about; queries searched together, in characters.
BLOCK_CHARS, QUERY_CHARS = 1 << 18, 1 << 17
END, DELIMITER = 0, 1


# --- the index ------------------------------------------------------------------
def suffix_ranks(text: np.ndarray) -> np.ndarray:
    """Start places of the sorted suffixes (prefix doubling); the text ends in
    its one smallest symbol."""
    n, step = len(text), 4
    key = np.zeros(n, np.int64)
    for k in range(step):
        key <<= 12
        key[:n - k] += text[k:]
    rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
    while True:
        second = np.zeros(n, np.int64)
        second[:max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]]))
        rank = new
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


class Wavelet:
    """Ranks over a sequence of symbols below ``2 ** bits``."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.bits, self.n = bits, len(symbols)
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for k in range(bits - 1, -1, -1):
            bit = symbols >> k & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(self.n - self.ones[-1][-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For ranges lo to hi: occurrences of the symbol before lo and in the
        range, and smaller symbols in the range."""
        smaller, begin = np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = symbol >> (self.bits - 1 - level) & 1 == 1
            a, b, s = ones[lo], ones[hi], ones[begin]
            smaller += np.where(bit, (hi - b) - (lo - a), 0)
            lo, hi, begin = (np.where(bit, zeros + a, lo - a), np.where(bit, zeros + b, hi - b), np.where(bit, zeros + s, begin - s))
        return lo - begin, hi - lo, smaller

    def symbols(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
        """All symbols of the ranges: (range, symbol, occurrences before lo,
        in the range, smaller symbols in the range)."""
        of, symbol = np.arange(len(lo)), np.zeros(len(lo), np.int64)
        smaller, begin = np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            a, b, s = ones[lo].astype(np.int64), ones[hi].astype(np.int64), ones[begin].astype(np.int64)
            off, on = (hi - b) > (lo - a), b > a
            less = smaller + (hi - b) - (lo - a)
            lo, hi, begin, of, symbol, smaller = (
                np.concatenate([x[off], y[on]]) for x, y in (
                    (lo - a, zeros + a), (hi - b, zeros + b), (begin - s, zeros + s), (of, of),
                    (symbol * 2, symbol * 2 + 1), (smaller, less)))
        return of, symbol, lo - begin, hi - lo, smaller


class BiIndex:
    """Suffix-rank intervals of a delimited vocabulary, extended on either side."""

    def __init__(self, words: list[str]) -> None:
        flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.alphabet = np.unique(flat)
        length = np.array([len(w) for w in words], np.int64)
        text = np.full(len(flat) + len(words) + 2, DELIMITER, np.int64)
        starts = np.concatenate([[0], np.cumsum(length)[:-1]]) + np.arange(len(words)) + 1  # $w1$w2$
        places = np.arange(len(flat)) + np.repeat(np.arange(len(words)) + 1, length)
        text[places] = self.code(flat)
        text[-1] = END
        self.size = len(text)
        bits = max(2, int(len(self.alphabet) + 2).bit_length())
        ranks = suffix_ranks(text)
        back = np.concatenate([text[-2::-1], [END]])
        self.sides = [Wavelet(text[ranks - 1], bits), Wavelet(back[suffix_ranks(back) - 1], bits)]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << bits))])
        # the suffixes that begin with the delimiter, by rank: the word that follows
        at = ranks[self.first[DELIMITER]:self.first[DELIMITER + 1]]
        self.word_at = np.searchsorted(starts, at + 1)
        del starts

    def code(self, points: np.ndarray) -> np.ndarray:
        """Symbols of code points; one that no word has gets the symbol after all."""
        at = np.searchsorted(self.alphabet, points)
        known = at < len(self.alphabet)
        known[known] = self.alphabet[at[known]] == points[known]
        return np.where(known, at, len(self.alphabet)) + 2

    def start(self, n: int) -> np.ndarray:
        """States (lo, lo in the reversal, size) of the empty pattern, one a column."""
        return np.array([np.zeros(n), np.zeros(n), np.full(n, self.size)], np.int64)

    def extend(self, state: np.ndarray, symbol: np.ndarray, side: int) -> np.ndarray:
        """States with the symbol added at the left (side 0) or right (1); size 0: none."""
        lo = state[side]
        before, size, smaller = self.sides[side].rank(symbol, lo, lo + state[2])
        out = np.empty_like(state)
        out[side], out[1 - side], out[2] = self.first[symbol] + before, state[1 - side] + smaller, size
        return out

    def extensions(self, state: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(state number, symbol, new state) of all extensions that occur."""
        lo = state[side]
        of, symbol, before, size, smaller = self.sides[side].symbols(lo, lo + state[2])
        out = np.empty((3, len(of)), np.int64)
        out[side], out[1 - side], out[2] = self.first[symbol] + before, state[1 - side][of] + smaller, size
        return of, symbol, out


def search(index: BiIndex, patterns: list[str], second: bool) -> tuple[np.ndarray, np.ndarray]:
    """(pattern number, word number) of the words at exactly one edit that
    share the pattern's first half exactly (``second``: its second half)."""
    m = len(patterns)
    length = np.array([len(p) for p in patterns], np.int64)
    half = length - length // 2 if second else length // 2
    # the second half is the first one of the reversed pattern, read with the sides exchanged
    flat = "".join(p[::-1] for p in patterns) if second else "".join(patterns)
    flat = index.code(np.frombuffer(flat.encode("utf-32-le"), np.uint32))
    start = np.cumsum(length) - length
    left, right = (1, 0) if second else (0, 1)
    which, state = np.arange(m), index.start(m)
    for k in range(int(half.max(initial=0)) + 1):  # the exact half from the middle outwards, then the delimiter
        go = half[which] >= k
        at = np.where(k < half[which], start[which] + half[which] - 1 - k, 0)
        symbol = np.where(k < half[which], flat[at], DELIMITER)
        new = state.copy()
        new[:, go] = index.extend(state[:, go], symbol[go], left)
        alive = new[2] > 0
        which, state = which[alive], new[:, alive]
    # Step by step over the other half: exact states, and those that have spent the error.  All stand at
    # the same distance from the middle, so ways that lead to one interval meet and go on as one.
    place = half.copy()
    spent, wrong = np.zeros(0, np.int64), index.start(0)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while len(which) or len(spent):
        of, symbol, new = index.extensions(state, right)
        letter = symbol > DELIMITER
        q, symbol, new = which[of[letter]], symbol[letter], new[:, letter]
        spent, wrong = np.concatenate([spent, q]), np.concatenate([wrong, new], axis=1)  # one more symbol
        ends = place >= length
        wanted = np.where(ends, DELIMITER, flat[np.where(ends, 0, start + place)])
        go = index.extend(wrong, wanted[spent], right)
        done = (go[2] > 0) & ends[spent]
        found.append((spent[done], go[0][done]))
        on = (go[2] > 0) & ~ends[spent]
        replaced = ~ends[q] & (symbol != wanted[q])
        left_out = ~ends[which]
        spent = np.concatenate([spent[on], q[replaced], which[left_out]])
        wrong = np.concatenate([go[:, on], new[:, replaced], state[:, left_out]], axis=1)
        spent, wrong = _distinct(spent, wrong, index.size)
        same = ~ends[q] & (symbol == wanted[q])
        which, state = q[same], new[:, same]
        place = place + 1
    q, lo = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    word = index.word_at[lo - index.first[DELIMITER]]
    pairs = np.unique(q * len(index.word_at) + word)
    return pairs // len(index.word_at), pairs % len(index.word_at)


def _distinct(which: np.ndarray, state: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """One of each state: equal intervals in both directions are one string."""
    order = np.lexsort((state[2], state[1], which * (size + 1) + state[0]))
    which, state = which[order], state[:, order]
    first = np.ones(len(which), bool)
    first[1:] = (which[1:] != which[:-1]) | (state[:, 1:] != state[:, :-1]).any(0)
    return which[first], state[:, first]


# --- Spark ----------------------------------------------------------------------
def vocabulary(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT, damage: int = DAMAGE) -> DataFrame:
    """(word, n): the distinct words and their occurrences.  One run in
    ``damage``, drawn by its hash, loses one code point first."""
    upper = "".join(map(chr, range(65, 91)))
    runs = F.regexp_extract_all(F.col(f"`{text_col}`").cast("string"), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    rows = df.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    rows = rows.select("id", F.translate("run", upper, upper.lower()).alias("run"))
    h = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "utf-8"))
    rows = rows.select("run", h.alias("h"), F.char_length("run").alias("k"))
    at = (F.col("h") % F.col("k")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.col("k")))
    rows = rows.select(F.when(F.col("h") % damage == 0, cut).otherwise(F.col("run")).alias("word"))
    rows = rows.where(F.char_length("word") >= min_length)
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _keys(words: DataFrame) -> DataFrame:
    """(key, word, n, ask): the words under their prefixes and suffixes; ask
    marks the key that is the word's own half."""
    k = F.char_length("word")
    lengths = F.array_distinct(F.transform(F.array(k - 1, k, k + 1), lambda x: F.floor(x / 2).cast("int")))
    front = F.transform(lengths, lambda x: F.struct(F.concat(F.lit("<"), F.substring(F.col("word"), F.lit(1), x)).alias("key"),
                                                    (x == F.floor(k / 2)).alias("ask")))
    rest = F.array_distinct(F.transform(F.array(k - 1, k, k + 1), lambda x: (x - F.floor(x / 2)).cast("int")))
    back = F.transform(rest, lambda x: F.struct(F.concat(F.lit(">"), F.substring(F.col("word"), k - x + 1, x)).alias("key"),
                                                (x == k - F.floor(k / 2)).alias("ask")))
    return (words.select("word", "n", F.explode(F.concat(front, back)).alias("e"))
            .select(F.col("e.key").alias("key"), "word", "n", F.col("e.ask").alias("ask")))


def _near_task(block_chars: int):
    """Rows (key, part, ask, word, n), sorted by key, part and words before
    queries, to (word, near, near's n)."""
    schema = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])
    words: dict[str, list] = {}  # word: its count, and the keys that it stands under here
    queries: dict[bool, set[str]] = {False: set(), True: set()}
    held = asked = 0
    at = index = None
    names: list[str] = []

    def own(x: str, y: str, second: bool) -> bool:
        """y is here under x's key, and no other scheme reports the pair."""
        h = len(x) // 2
        return (">" + x[h:] in words[y] and not y.startswith(x[:h])) if second else "<" + x[:h] in words[y]

    def answer():
        nonlocal asked, index, names
        if index is None and (queries[False] or queries[True]):
            names = list(words)
            index = BiIndex(names)
        for second, wanted in queries.items():
            patterns = sorted(wanted, key=len)
            wanted.clear()
            low = 0
            while low < len(patterns):
                high, size = low, 0
                while high < len(patterns) and (high == low or size < QUERY_CHARS):
                    size += len(patterns[high])
                    high += 1
                q, w = search(index, patterns[low:high], second)
                rows = [(patterns[low + i], names[j]) for i, j in zip(q.tolist(), w.tolist())]
                rows = [(x, y, words[y][0]) for x, y in rows if own(x, y, second)]
                low = high
                if rows:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        asked = 0

    def close():
        nonlocal held, index
        yield from answer()
        words.clear()
        held, index = 0, None

    def fn(batch):
        nonlocal at, held, asked
        for key, part, ask, word, n in zip(*[batch.column(i).to_pylist() for i in range(5)]):
            if not ask:
                if index is not None or at != (key, part) and held >= block_chars:
                    yield from close()
                at = key, part
                entry = words.setdefault(word, [n])
                if len(entry) == 1:
                    held += len(word) + 1
                entry.append(key)
            elif at == (key, part):  # else no word stands under the key in this part
                queries[key[0] == ">"].add(word)
                asked += len(word)
                if asked >= 8 * QUERY_CHARS:
                    yield from answer()

    fn.end = close
    return fn


def near_words(words: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(word, near, near_n): every pair of words at exactly one edit, from each side."""
    keys = _keys(words)
    chars = keys.groupBy("key").agg(F.sum(F.char_length("word") + 1).alias("chars"))
    total = chars.agg(F.sum("chars")).first()[0] or 0
    # at most one row for each block_chars characters
    hot = T.store(chars.where(F.col("chars") > block_chars)
                  .select("key", F.ceil(F.col("chars") / block_chars).cast("int").alias("parts")), "hot-keys")
    rows = keys.join(hot, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    stand = rows.select("key", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int").alias("part"), F.lit(False).alias("ask"), "word", "n")
    query = (rows.where("ask").select("key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("ask"),
                                      "word", "n"))
    tasks = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")) if total > block_chars else 1, -(-total // (4 * block_chars)))
    met = stand.union(query).repartition(tasks, "key", "part").sortWithinPartitions("key", "part", "ask")
    return T.map_arrow(met, lambda: _near_task(block_chars), "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the end of each word's chain of forms.
    Counts grow along a chain by the factor ``RATIO``, so it has an end; each
    round doubles the links looked through."""
    now = T.store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = T.store(now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                             F.col("further").isNotNull().alias("moved")), "roots")
        now = new.drop("moved")
        if new.where("moved").isEmpty():
            return now


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
             min_count: int = MIN_COUNT, ratio: int = RATIO, damage: int = DAMAGE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    T.ready(df.sparkSession)
    words = T.store(vocabulary(df, id_col, text_col, min_length, min_count, damage), "vocabulary")
    near = near_words(words, block_chars).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    best = F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best"))
    rows = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), best["form"].alias("form"), (-best["less"]).alias("form_n"))
    rows = T.store(rows, "variants")
    ends = roots(rows.where("form is not null").select("word", "form"))
    return (rows.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
