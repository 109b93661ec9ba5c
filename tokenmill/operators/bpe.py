"""Byte-pair encoding as Spark jobs.

Fit: the corpus is reduced once to a table of distinct words
``(sym, freq, seen)`` and its pair counts.  A round applies as many merges as
are exact together (:mod:`tokenmill.operators.bpe_batch`), rewrites the words
narrowly and counts pairs again only in the words it changed.  The driver holds
the best ``KEEP`` pairs with exact counts and the count that all others stay
below; changed counts come from the round's delta, so the whole pair table is
read only when the best pairs are used up.  Words with nothing left to merge
leave the table; lineage is cut, or the state published for a resumable fit,
every few rounds.  Ties follow first insertion: (first word seen, position in
word).

Encode: texts are tokenized in an Arrow-batched UDF holding the vocabulary as
a broadcast variable (size = number of merges, known on the driver), whole
slices of bounded size at a time (:mod:`tokenmill.operators.bpe_kernel`).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.functions import arrays as A
from tokenmill.functions import text as TX
from tokenmill.functions.vocab import SPECIALS
from tokenmill.operators.arrow_ids import char_pair_counts
from tokenmill.operators.bpe_batch import safe_prefix
from tokenmill.operators.run_blocks import encode_by_runs
from tokenmill.operators.tokenizer import Tokenizer
from tokenmill.session import cut_lineage

# Characters that the upstream regex-escape prefixes with a
# backslash when a merged pair is written back into the working words.
ESCAPED = "#$&()*+-.?[]^{|}~"


def escape_replacement(s: str) -> str:
    """Q4: working-symbol spelling of a merged pair in reference mode."""
    return "".join("\\" + c if c in ESCAPED else c for c in s)


# First-insertion order is the tuple (doc_id, word position, pair index).  It
# is packed into one exact DECIMAL(38,0) key, ``(doc_id * 2^31 + pos) * 2^31 +
# i``: positions are < 2^31 (Spark's array bound), so the packing preserves
# lexicographic order, and a decimal min stays on the hash-aggregate path
# (a struct min would force a sort-based aggregation).
_KEY = "decimal(38,0)"


def _shift() -> Column:
    return F.lit(2 ** 31).cast(_KEY)


def _seen_key(doc_id: Column, pos: Column) -> Column:
    return (doc_id.cast(_KEY) * _shift() + pos.cast(_KEY)).cast(_KEY)


def first_doc(seen: Column) -> Column:
    """Document of a packed first-seen key."""
    return F.floor(seen / _shift()).cast("long")


def word_table(df: DataFrame, col: str = "text", mode: str = "reference") -> DataFrame:
    """A1 (+F6, F7): distinct words with frequency and first position.

    ``sym`` holds the word's characters separated by one space (reference) or
    each wrapped in its own spaces (canonical).  Partial aggregation keeps a
    hot word from reaching one reducer as raw rows.
    """
    w = (df.select("doc_id", F.posexplode(F.split(F.col(col), TX.WS_RUN)).alias("pos", "word"))
         .where(F.col("word") != ""))
    agg = w.groupBy("word").agg(F.count(F.lit(1)).alias("freq"),
                                F.min(_seen_key(F.col("doc_id"), F.col("pos"))).alias("seen"))
    sep = " " if mode == "reference" else "  "
    sym = F.array_join(F.split(F.col("word"), ""), sep)
    if mode == "canonical":
        sym = F.concat(F.lit(" "), sym, F.lit(" "))
    return agg.select("word", sym.alias("sym"), "freq", "seen")


def _symbols(sym: Column, mode: str) -> Column:
    if mode == "reference":
        return F.split(sym, " ")
    return F.split(F.trim(sym), "  ")


def pair_stats(words: DataFrame, mode: str = "reference") -> DataFrame:
    """A2 (+G3): frequency-weighted adjacent pairs; overlaps count.

    ``s`` is the packed first-seen key of the first word holding the pair.
    Pairs come from zipping two slices of the symbol array (cheaper than an
    index lambda), and no per-row arithmetic runs before the aggregation.
    """
    sy = F.col("syms") if "syms" in words.columns else _symbols(F.col("sym"), mode)
    n = F.size(sy) - 1
    zipped = F.arrays_zip(F.slice(sy, 1, n).alias("l"), F.slice(sy, 2, n).alias("r"))
    p = words.select("freq", "seen", F.explode(zipped).alias("p"))
    return p.groupBy(F.col("p.l").alias("l"), F.col("p.r").alias("r")).agg(
        F.sum("freq").alias("c"), F.min("seen").alias("s"))


def top_pairs(stats: DataFrame, k: int = 1) -> DataFrame:
    """A3 candidates: highest count, then the earliest first word."""
    return stats.orderBy(F.desc("c"), F.asc("s")).limit(k)


def best_pair(words: DataFrame, stats: DataFrame, mode: str = "reference", k: int = 16):
    """A3: the arg-max pair, ties to first insertion (word, then index in word).

    Pairs tied on count *and* first word are ordered by their first index in
    that one word, read on the driver from that single word (bounded by its
    length).  Returns a Row(l, r, c, s) or None when no pair is left.
    """
    rows = top_pairs(stats, k).collect()
    if not rows:
        return None
    head = rows[0]
    tied = [r for r in rows if r["c"] == head["c"] and r["s"] == head["s"]]
    if len(tied) == 1:
        return head
    if len(tied) == len(rows):
        tied = stats.where((F.col("c") == F.lit(head["c"])) & (F.col("s") == F.lit(head["s"]))).collect()
    sym = words.where(F.col("seen") == F.lit(head["s"])).select("sym").first()["sym"]
    symbols = sym.split(" ") if mode == "reference" else sym.strip().split("  ")
    first_index: dict[tuple[str, str], int] = {}
    for i in range(len(symbols) - 1):
        first_index.setdefault((symbols[i], symbols[i + 1]), i)
    return min(tied, key=lambda r: first_index[(r["l"], r["r"])])


def merge_pair(sym: Column, left: str, right: str, mode: str = "reference") -> Column:
    """F8: literal, non-overlapping, left-to-right replacement of one pair.

    Reference mode is unanchored (Q2) and writes the escaped spelling (Q4);
    canonical mode matches whole symbols only.
    """
    if mode == "reference":
        return F.replace(sym, F.lit(f"{left} {right}"), F.lit(escape_replacement(left + right)))
    return F.replace(sym, F.lit(f" {left}  {right} "), F.lit(f" {left}{right} "))


def _pair_rows(words: DataFrame, mode: str, sign: int) -> DataFrame:
    """Exploded pairs of ``words`` weighted by ``sign * freq``."""
    sy = _symbols(F.col("sym"), mode)
    n = F.size(sy) - 1
    zipped = F.arrays_zip(F.slice(sy, 1, n).alias("l"), F.slice(sy, 2, n).alias("r"))
    return words.select((F.col("freq") * sign).alias("dc"), "seen",
                        F.explode(zipped).alias("p")).select(
        F.col("p.l").alias("l"), F.col("p.r").alias("r"), "dc", "seen")


def pair_delta(affected_old: DataFrame, affected_new: DataFrame, mode: str) -> DataFrame:
    """Change of the pair table when ``affected_old`` words become
    ``affected_new``: old pairs count negative, new pairs positive.
    ``s_add`` = first word among the additions; ``removed`` flags pairs that
    lost occurrences (their stored first-seen may now be too early)."""
    rows = _pair_rows(affected_old, mode, -1).unionByName(_pair_rows(affected_new, mode, 1))
    return rows.groupBy("l", "r").agg(
        F.sum("dc").alias("dc"),
        F.min(F.when(F.col("dc") > 0, F.col("seen"))).alias("s_add"),
        F.max(F.when(F.col("dc") < 0, F.lit(True)).otherwise(F.lit(False))).alias("removed"))


def compact(log: list[DataFrame]) -> DataFrame:
    """The pair table of a base table and the deltas after it.  Counts are
    exact; ``s`` is a lower bound of the true first-seen key."""
    rows = log[0].select("l", "r", "c", "s")
    for delta in log[1:]:
        rows = rows.unionByName(delta.select("l", "r", F.col("dc").alias("c"), F.col("s_add").alias("s")))
    return rows.groupBy("l", "r").agg(F.sum("c").alias("c"), F.min("s").alias("s")).where(F.col("c") > 0)


def order_of_ties(words: DataFrame, tied: list[tuple[str, str]], mode: str) -> list[tuple[str, str]]:
    """Pairs of equal count by first insertion: the first word that holds a
    pair (exact, from the words as they are), then its index in that word."""
    df = F.broadcast(words.sparkSession.createDataFrame(tied, "l string, r string"))  # at most KEEP rows
    first = (_pair_rows(words, mode, 1).join(df, ["l", "r"]).groupBy("l", "r").agg(F.min("seen").alias("s"))).collect()
    place = {(r["l"], r["r"]): r["s"] for r in first}
    times: dict = {}
    for s in place.values():
        times[s] = times.get(s, 0) + 1
    shared = [s for s, n in times.items() if n > 1]
    index: dict[tuple, int] = {}
    if shared:
        for row in words.where(F.col("seen").isin(shared)).select("seen", "sym").collect():
            symbols = row["sym"].split(" ") if mode == "reference" else row["sym"].strip().split("  ")
            for i in range(len(symbols) - 1):
                index.setdefault((row["seen"], symbols[i], symbols[i + 1]), i)
    return sorted(tied, key=lambda p: (place[p], index.get((place[p], *p), 0)))


def first_of_many(words: DataFrame, pairs: DataFrame, count: int, mode: str) -> tuple[str, str]:
    """The first inserted of all pairs with the top count when they are too
    many for the driver: the earliest word in Spark, then the index in it."""
    tied = pairs.where(F.col("c") == F.lit(count)).select("l", "r")
    first = (_pair_rows(words, mode, 1).join(tied, ["l", "r"], "left_semi").groupBy("l", "r").agg(F.min("seen").alias("s")))
    low = first.agg(F.min("s").alias("s")).first()["s"]
    here = {(r["l"], r["r"]) for r in first.where(F.col("s") == F.lit(low)).collect()}  # bounded by the word's length
    sym = words.where(F.col("seen") == F.lit(low)).select("sym").first()["sym"]
    symbols = sym.split(" ") if mode == "reference" else sym.strip().split("  ")
    return next(p for p in zip(symbols, symbols[1:]) if p in here)


#: Best pairs that the driver keeps, and candidates and adjacent pairs of one round.
KEEP, ROUND, MAX_ADJACENT = 512, 24, 20_000


class MergeRounds:
    """The state of a fit between rounds: the words, the pair table as a base
    and deltas, the best pairs with exact counts and the ``bound`` that every
    other pair's count is at most, and every symbol there may be."""

    def __init__(self, words: DataFrame, pairs: DataFrame, mode: str, refused: tuple[str, ...] = ()) -> None:
        self.words, self.log, self.mode, self.refused = words, [pairs], mode, refused
        self.best: dict[tuple[str, str], int] = {}
        self.bound = 0
        self.symbols: set[str] | None = None
        self.stale: list[DataFrame] = []
        self.waiting: list[DataFrame] = []
        self.rounds = self.scans = 0

    def spell(self, pair: tuple[str, str], left: str, right: str) -> str:
        joined = pair[0] + pair[1]
        return left[:len(left) - len(pair[0])] + (escape_replacement(joined) if self.mode == "reference" else joined) + right[len(pair[1]):]

    def scan(self) -> None:
        """Read the whole pair table for the best pairs."""
        self.scans += 1
        if len(self.log) > 1:
            whole = compact(self.log).persist()
            self.stale += self.log
            self.log = [whole]
        rows = self.log[0].orderBy(F.desc("c")).limit(KEEP + 1).collect()
        self.bound = rows[KEEP]["c"] if len(rows) > KEEP else 0
        self.best = {(r["l"], r["r"]): r["c"] for r in rows if r["c"] > self.bound}

    def ranked(self, limit: int) -> list[tuple[str, str]]:
        """The next pairs in their order, at most ``limit``; ties are settled
        where they stand first, and end the list further on."""
        out: list[tuple[str, str]] = []
        by_count: dict[int, list] = {}
        for pair, c in self.best.items():
            by_count.setdefault(c, []).append(pair)
        for c in sorted(by_count, reverse=True):
            group = by_count[c]
            if len(group) > 1 and out:
                break
            out += order_of_ties(self.words, group, self.mode) if len(group) > 1 else group
            if len(out) >= limit:
                break
        return out[:limit]

    def adjacent(self, pairs: list[tuple[str, str]]) -> list[tuple[str, str]] | None:
        """The pairs of the table that a merge of ``pairs`` joins; None if too many."""
        if self.mode == "canonical":
            return list(pairs)
        hit = F.lit(False)
        for l, r in pairs:
            hit = hit | (F.endswith("l", F.lit(l)) & F.startswith("r", F.lit(r)))
        rows = self.log[0].select("l", "r").where(hit)
        for delta in self.log[1:]:
            rows = rows.unionByName(delta.where(F.col("dc") > 0).select("l", "r").where(hit))
        found = rows.distinct().limit(MAX_ADJACENT + 1).collect()
        return None if len(found) > MAX_ADJACENT else [(r["l"], r["r"]) for r in found]

    def all_symbols(self) -> set[str]:
        """Every symbol of the pair table: characters at first, so bounded by the alphabet."""
        rows = compact(self.log).select(F.explode(F.array("l", "r")).alias("s")).distinct().collect()
        return {r["s"] for r in rows}

    def merge(self, left_over: int) -> list[tuple[str, str, int]]:
        """One round: the merges made, (left, right, count), none at the end."""
        if not self.best or max(self.best.values()) <= self.bound:
            self.scan()
        if not self.best and self.bound == 0:
            return []
        self.rounds += 1
        if not self.best:  # more pairs share the top count than the driver keeps
            pair = first_of_many(self.words, self.log[0], self.bound, self.mode)
            batch, counts, exact = [pair], {pair: self.bound}, False
        else:
            ranked = self.ranked(min(ROUND, left_over))
            adjacent = self.adjacent(ranked)
            if adjacent is None:
                k, exact, new = 1, False, set()
            else:
                self.symbols = self.all_symbols() if self.symbols is None else self.symbols
                k, new, exact = safe_prefix(ranked, adjacent, self.symbols, self.spell, self.mode == "canonical")
                self.symbols |= new
            batch = ranked[:k]
            counts = {p: self.best[p] for p in batch}
        made = [(l, r, counts[l, r]) for l, r in batch]
        if not exact:
            self.symbols = None
        if left_over > len(batch):
            self._apply(batch, exact)
        return made

    def _apply(self, batch: list[tuple[str, str]], exact: bool) -> None:
        hit, sym = F.lit(False), F.col("sym")
        for l, r in batch:
            hit = hit | F.col("sym").contains(f"{l} {r}" if self.mode == "reference" else f" {l}  {r} ")
            sym = merge_pair(sym, l, r, self.mode)
        old = self.words.where(hit)
        delta = pair_delta(old, old.withColumn("sym", sym), self.mode)
        if self.refused:
            delta = delta.where(~F.concat("l", "r").isin(*self.refused))
        delta = delta.where(F.col("dc") != 0).persist()
        words = self.words.withColumn("sym", F.when(hit, sym).otherwise(F.col("sym"))).persist()
        changed = self._changed(delta)
        # this job filled the cache of the present words: their predecessors can go, they themselves only next time
        self.stale += self.waiting
        self.waiting = [self.words]
        self.words = words
        self.log.append(delta)
        if not exact:  # a symbol that was there before, or that is not known: counts of old pairs may have risen
            self.best, self.bound = {}, 0
            return
        for l, r, dc in changed:
            c = self.best.get((l, r), 0) + dc
            if c > self.bound:
                self.best[l, r] = c
            else:
                self.best.pop((l, r), None)
        if len(self.best) > 4 * KEEP:
            self.bound = sorted(self.best.values(), reverse=True)[KEEP]
            self.best = {p: c for p, c in self.best.items() if c > self.bound}

    def _changed(self, delta: DataFrame) -> list[tuple[str, str, int]]:
        """The delta of the kept pairs and of new ones above the bound (a new
        pair's delta is its count)."""
        keys = ", ".join(f"'{f'{l} {r}'.encode().hex().upper()}'" for l, r in self.best)
        kept = F.expr(f"hex(encode(concat_ws(' ', l, r), 'utf-8')) in ({keys})") if keys else F.lit(False)
        rows = delta.where(kept | (F.col("dc") > F.lit(self.bound))).select("l", "r", "dc").collect()
        return [(r["l"], r["r"], r["dc"]) for r in rows]

    def keep(self, publish=None) -> None:
        """Cut lineage: through ``publish`` (tables to tables read back) or a checkpoint."""
        space = " " if self.mode == "reference" else "  "
        words, pairs = self.words.where(F.col("sym").contains(space)), compact(self.log)
        tables = publish({"words": words, "pairs": pairs}) if publish else {"words": cut_lineage(words), "pairs": cut_lineage(pairs)}
        self.stale += [self.words, *self.waiting, *self.log]
        self.waiting = []
        self.words, self.log = tables["words"].persist(), [tables["pairs"].persist()]

    def release(self, everything: bool = False) -> None:
        """Drop the caches that nothing reads any more."""
        for df in self.stale + ([self.words, *self.waiting, *self.log] if everything else []):
            df.unpersist()
        self.stale = []


class BPETokenizer(Tokenizer):
    """BPE tokenizer (K2): ``fit`` learns merges, ``encode`` applies them.

    ``merges`` lists (rank, left, right, count, id) in learning order.
    ``reserve_special`` refuses merges that would spell a special token
    (off in reference mode, where such a merge overwrites its id, Q5).
    """

    def __init__(self, num_merges: int, mode: str = "reference",
                 checkpoint_every: int = 8, reserve_special: bool = False) -> None:
        super().__init__()
        if mode not in ("reference", "canonical"):
            raise ValueError("mode must be 'reference' or 'canonical'")
        self.num_merges = num_merges
        self.mode = mode
        self.checkpoint_every = checkpoint_every
        self.reserve_special = reserve_special
        self.merges: list[tuple[int, str, str, int, int]] = []
        #: Rounds of the last fit, and how often it read the whole pair table.
        self.rounds = self.scans = 0

    # -- H1 ------------------------------------------------------------------
    def _register(self, rank: int, start: int, l: str, r: str, c: int) -> None:
        token = l + r
        new_id = start + rank
        self.stoi[token] = new_id
        self.itos[new_id] = token
        self.merges.append((rank, l, r, c, new_id))

    def fit(self, df: DataFrame, col: str = "text", state: str | None = None) -> "BPETokenizer":
        """H1 in exact batched rounds.  ``state`` names a shared folder that
        makes the fit resumable: every ``checkpoint_every`` rounds its tables
        and merges are published there, and a fit over the same input with the
        same parameters goes on after the newest published round.
        """
        from tokenmill.plans.rounds import Rounds, input_fingerprint
        start = len(self)
        space = " " if self.mode == "reference" else "  "
        refused = tuple(SPECIALS) if self.reserve_special else ()
        spark = df.sparkSession
        kept = Rounds(spark, state, input_fingerprint(df, col, self.mode, self.num_merges, self.reserve_special)) if state else None
        found = kept.latest() if kept else None
        if found:
            number, tables, values = found
            for rank, l, r, c, _ in values["merges"]:
                self._register(rank, start, l, r, c)
            rounds = MergeRounds(tables["words"].persist(), tables["pairs"].persist(), self.mode, refused)
            rounds.rounds = number
        else:
            words = word_table(df, col, self.mode).select("sym", "freq", "seen")
            words = words.where(F.col("sym").contains(space)).persist()
            pairs = pair_stats(words, self.mode)
            if refused:  # a refused pair never wins; other pairs go on
                pairs = pairs.where(~F.concat("l", "r").isin(*refused))
            rounds = MergeRounds(words, pairs.persist(), self.mode, refused)
        while len(self.merges) < self.num_merges:
            made = rounds.merge(self.num_merges - len(self.merges))
            rounds.release()
            if not made:
                break
            for l, r, c in made:
                self._register(len(self.merges), start, l, r, int(c))
            if self.checkpoint_every and rounds.rounds % self.checkpoint_every == 0 and len(self.merges) < self.num_merges:
                rounds.keep((lambda tables: kept.publish(rounds.rounds, tables, {"merges": self.merges})) if kept else None)
        self.rounds, self.scans = rounds.rounds, rounds.scans
        rounds.release(everything=True)
        return self

    def fingerprint(self) -> str:
        import hashlib
        h = hashlib.sha1(repr(sorted(self.stoi.items())).encode())
        return h.hexdigest()

    def merges_df(self, spark) -> DataFrame:
        return spark.createDataFrame(self.merges, "rank int, l string, r string, c long, id int")

    # -- H2 ------------------------------------------------------------------
    def _batches(self, df: DataFrame, method: str, kind: str):
        """A column function over Arrow batches: the texts' tokens or ids."""
        bc = df.sparkSession.sparkContext.broadcast(dict(self.stoi))
        key = self.fingerprint()

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            work = getattr(_worker_encoder(bc, key), method)
            for batch in batches:
                yield from work(batch)
        return F.arrow_udf(run, kind)

    def tokenize(self, df: DataFrame, col: str, out: str) -> DataFrame:
        return df.withColumn(out, self._batches(df, "tokens", "array<string>")(F.col(col)))

    def encode(self, df: DataFrame, col: str = "text", out: str = "encoded",
               on_oov: str = "fail", strategy: str = "narrow") -> DataFrame:
        """H2 + J1.  ``narrow``: one Arrow UDF pass, no shuffle.  ``distinct``:
        the different runs of blocks of texts, encode each distinct run once,
        join back by run and reassemble by place
        (:mod:`tokenmill.operators.run_blocks`)."""
        if strategy == "distinct":
            return self._encode_distinct(df, col, out, on_oov)
        res = df.withColumn(out, self._batches(df, "ids", "array<int>")(F.col(col)))
        if on_oov == "fail":
            res = res.withColumn(out, F.when(F.col(out).isNull() & F.col(col).isNotNull(),
                                             A.raise_oov("bpe").cast("array<int>"))
                                 .otherwise(F.col(out)))
        return res

    def _encode_distinct(self, df, col, out, on_oov):
        bc = df.sparkSession.sparkContext.broadcast(dict(self.stoi))
        key = self.fingerprint()
        res = encode_by_runs(df, col, out, lambda: _worker_encoder(bc, key))
        if on_oov == "fail":
            res = res.withColumn(out, F.when(F.col(out).isNull() & F.col(col).isNotNull(),
                                             A.raise_oov("bpe").cast("array<int>"))
                                 .otherwise(F.col(out)))
        # a text without a key gets no ids, as from a join on the key
        none = F.col("doc_id").isNull() & F.col(col).isNotNull()
        res = res.withColumn(out, F.when(none, F.array().cast("array<int>")).otherwise(F.col(out)))
        return res.select("doc_id", *(c for c in res.columns if c != "doc_id"))


_ENCODERS: dict[str, object] = {}


def _worker_encoder(bc, key: str):
    """One BatchEncoder per Python worker and vocabulary (memo survives batches)."""
    from tokenmill.operators.bpe_kernel import BatchEncoder
    enc = _ENCODERS.get(key)
    if enc is None:
        enc = BatchEncoder(bc.value)
        _ENCODERS.clear()
        _ENCODERS[key] = enc
    return enc


def vocab_pair_hits(df: DataFrame, col: str, tokenizer: Tokenizer) -> DataFrame:
    """Adjacent character pairs whose concatenation is a vocabulary entry.

    Every task counts its pairs in arrays; the counted pairs meet the
    (broadcast, tokenizer-sized) vocabulary in a left-semi join and are summed.
    """
    spark = df.sparkSession
    vocab = F.broadcast(tokenizer.vocab_df(spark).select(F.col("token").alias("pair")))
    hits = char_pair_counts(df, col).join(vocab, "pair", "left_semi")
    return hits.groupBy("pair").agg(F.sum("c").cast("long").alias("occurrences"))
