"""Language identification with hyperdimensional profiles.

Each letter has a fixed random vector of +1 and -1 (``DIMENSIONS`` long, from
a seed and its code point).  A trigram's vector binds its letters: the first
is rotated by two places, the second by one, and the three are multiplied.  A
text's vector bundles (adds) the vectors of all its trigrams; a language's
prototype bundles the unit vectors of its training texts.  The prediction is
the prototype of the highest cosine, which is also the score (negative: 0).

Training reads at most about ``TRAIN_PER_LANGUAGE`` texts of each language,
chosen by a hash of the id, never held-out ones (crc32 of the id as text,
mod 5 = 0).  That sample bound is the only one: every text is scored whole,
its trigrams counted first, so a long text costs one vector row for each
different trigram.  Nothing is shuffled by text; prototypes (one row a
language) are broadcast, their number is checked.

The cosine of a text that shares no trigram with a language is noise of
standard deviation 1 / sqrt(``DIMENSIONS``).  A text is rejected as like no
learned language only where noise does not decide: below the highest of the
languages' noise cosines (but for ``FALSE_KEEP`` of texts), and with trigrams
enough (squared sum over sum of squares of their counts, so repeats are no
evidence) that ``LEAST_SIGNAL`` would be twice that bound.  Shorter texts with
a letter stay.

Defined cases: a text that is null or without a letter is ``und`` with score
0, as is every text when nothing could be learned; equal cosines go to the
first language by code point; a null id is never held out, and such rows are
drawn for training by their text.  Repeated rows are predicted alike and each
may be drawn; an empty table gives an empty result.  Extra columns with
clashing names play no part.
"""

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm import tables as T
from tokenmill.llm.bytehash import U64, mix, random_words

DIMENSIONS = 4096
TRAIN_PER_LANGUAGE = 2000
MAX_LANGUAGES = 4096
#: Bytes of trigram vectors, and of letter vectors, that a task keeps (one byte a dimension).
CACHE_BYTES, LETTER_BYTES = 48 << 20, 8 << 20
#: Trigram vectors that are widened at a time.
SLICE = 256
UNKNOWN = "und"
#: Share of long texts of no learned language that may look like one.
FALSE_KEEP = 0.001
#: A text of n trigrams in a learned language has a cosine of this times sqrt(n)
#: at least (1 % quantile of five-word excerpts of the test documents: 0.03).
LEAST_SIGNAL = 0.025
_SPACE = 32


class Bundler:
    """Text to vector; keeps the vectors of trigrams it has met."""

    def __init__(self, dimensions: int = DIMENSIONS) -> None:
        self.dimensions = dimensions
        self.letters: dict[int, np.ndarray] = {}
        alpha = np.zeros(0x110000, bool)
        alpha[[c for c in range(0x110000) if chr(c).isalpha()]] = True
        self.alpha = alpha
        self.keys = np.zeros(0, np.int64)
        self.rows = np.zeros(0, np.int64)
        self.room = CACHE_BYTES // dimensions
        self.vectors = np.zeros((self.room, dimensions), np.int8)
        self.wide = np.zeros((SLICE, dimensions), np.float32)
        self.used = 0

    def letter(self, c: int) -> np.ndarray:
        if c not in self.letters:
            if len(self.letters) >= LETTER_BYTES // self.dimensions:
                self.letters.clear()
            bits = mix(random_words(self.dimensions, 101) ^ mix(np.full(self.dimensions, c + 1, U64)))
            self.letters[c] = np.where(bits & U64(1), 1, -1).astype(np.int8)
        return self.letters[c]

    def bind(self, key: int) -> np.ndarray:
        a, b, c = key >> 42, key >> 21 & 0x1FFFFF, key & 0x1FFFFF
        return np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)

    def trigrams(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Different trigrams of the lower-cased words and their counts; None without a letter."""
        cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        letter = self.alpha[cp]
        if not letter.any():
            return None
        cp = np.concatenate([[_SPACE], np.where(letter, cp, _SPACE), [_SPACE]])
        cp = cp[np.concatenate([[True], (cp[1:] != _SPACE) | (cp[:-1] != _SPACE)])]
        return np.unique(cp[:-2] << 42 | cp[1:-1] << 21 | cp[2:], return_counts=True)

    def _known(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        found = at < len(self.keys)
        found[found] = self.keys[at[found]] == keys[found]
        if not found.all():
            new = keys[~found]
            if self.used + len(new) > self.room:
                self.keys, self.rows, self.used = self.keys[:0], self.rows[:0], 0
                new = keys
            for i, k in enumerate(new.tolist()):
                self.vectors[self.used + i] = self.bind(k)
            rows = np.arange(self.used, self.used + len(new))
            self.used += len(new)
            order = np.argsort(np.concatenate([self.keys, new]), kind="stable")
            self.rows = np.concatenate([self.rows, rows])[order]
            self.keys = np.concatenate([self.keys, new])[order]
            at = np.searchsorted(self.keys, keys)
        return self.rows[at]

    def bundle(self, text: str | None) -> np.ndarray | None:
        found = self.trigrams(text) if text else None
        return None if found is None else self.add(*found)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        counts = counts.astype(np.float32)
        out = np.zeros(self.dimensions, np.float32)
        for a in range(0, len(keys), SLICE):
            rows = self._known(keys[a:a + SLICE])
            wide = self.wide[:len(rows)]
            wide[:] = self.vectors[rows]
            out += counts[a:a + SLICE] @ wide
        return out


def _train_task():
    bundler = Bundler()
    sums: dict[str, np.ndarray] = {}

    def fn(batch):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            v = bundler.bundle(text)
            if v is not None and (norm := np.linalg.norm(v)) > 0:
                sums[lang] = sums.get(lang, 0) + v.astype(np.float64) / norm
        return ()

    def end():
        if sums:
            yield pa.record_batch([pa.array(list(sums)), pa.array(list(sums.values()), pa.list_(pa.float64()))],
                                  names=["lang", "v"])

    fn.end = end
    return fn


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = TRAIN_PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """(languages by code point, unit prototypes) from rows that are not held out."""
    id_ = F.col(f"`{id_col}`")
    rows = df.where(~T.held_out(id_)).select(id_.cast("long").alias("id"), F.col(f"`{lang_col}`").cast("string").alias("lang"),
                                             F.col(f"`{text_col}`").cast("string").alias("text")).where("lang is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values in {lang_col}")
    if not counts:
        return [], np.zeros((0, DIMENSIONS), np.float32)
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, per_language / n))])
    drawn = F.pmod(F.xxhash64(F.coalesce(F.col("id"), F.xxhash64("text")), F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(drawn < F.element_at(share, F.col("lang"))).select("lang", "text")
    parts = T.map_arrow(sample, _train_task, "lang string, v array<double>")
    sums = (parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v"))
            .select("lang", F.transform("v", lambda c: c["x"]).alias("v")).orderBy("lang").toArrow())
    # One row of numbers a language, and never as Python objects.
    names = sums.column("lang").to_pylist()
    flat = sums.column("v").combine_chunks().flatten() if names else pa.array([], pa.float64())
    v = flat.to_numpy(zero_copy_only=False).reshape(len(names), DIMENSIONS)
    return names, (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def rejection(languages: int, dimensions: int = DIMENSIONS) -> tuple[float, float]:
    """(cosine below which a text is like no language, trigrams it needs for that)."""
    bound = (2 * np.log(max(1, languages) / FALSE_KEEP) / dimensions) ** 0.5
    return float(bound), float((2 * bound / LEAST_SIGNAL) ** 2)


def predictor(df: DataFrame, langs: list[str], prototypes: np.ndarray):
    """A column function: text to struct(lang, score, trigrams that count as evidence)."""
    model = df.sparkSession.sparkContext.broadcast((langs, prototypes))

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bundler, (names, p) = Bundler(), model.value
        for batch in texts:
            lang, score, evidence = [], [], []
            for text in batch.to_pylist():
                found = bundler.trigrams(text) if names and text else None
                v = None if found is None else bundler.add(*found)
                evidence.append(0.0 if found is None else float(found[1].sum()) ** 2 / float((found[1].astype(float) ** 2).sum()))
                norm = 0.0 if v is None else float(np.linalg.norm(v))
                if norm == 0.0:
                    lang.append(UNKNOWN)
                    score.append(0.0)
                    continue
                cosines = p @ v / norm
                best = int(np.argmax(cosines))
                lang.append(names[best])
                score.append(min(1.0, max(0.0, float(cosines[best]))))
            yield pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(evidence, pa.float64())],
                                             ["lang", "score", "evidence"])
        del bundler
        T.release()

    return F.arrow_udf(run, "lang string, score double, evidence double").asNondeterministic()


def predict(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score."""
    guess = predictor(df, *train(df, id_col, text_col, lang_col))
    id_ = F.col(f"`{id_col}`").cast("long")
    return (df.select(id_.alias("doc_id"), T.held_out(id_).alias("held_out"),
                      guess(F.col(f"`{text_col}`").cast("string")).alias("g"))
            .select("doc_id", "held_out", F.col("g.lang").alias("lang_pred"), F.col("g.score").alias("score")))


def keep_known(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows whose text has a letter and is not like no learned language, with their own columns only."""
    langs, prototypes = train(df, id_col, text_col, lang_col)
    bound, needed = rejection(len(langs))
    rows = T.with_record(df, g=predictor(df, langs, prototypes)(F.col(f"`{text_col}`").cast("string")))
    return T.records(rows.where((F.col("_tm_g.lang") != UNKNOWN)
                                & ((F.col("_tm_g.score") >= bound) | (F.col("_tm_g.evidence") < needed))))
