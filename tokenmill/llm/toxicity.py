"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's probability is the logistic
of a bias and the weights of its words' features (the word, its beginnings of
3 to 7 bytes and its last 4, hashed to 2**18 weights); the document's is the
noisy-or of its sentences, ``1 - prod(1 - p)``.  Only document labels are
learned from: the gradient reaches each sentence in proportion to its share
in the document's probability, so afterwards the sentences themselves have
scores, and those of 0.5 or more are reported as the offending ones.

Training takes at most about ``TRAIN_PER_CLASS`` labelled documents of each
class and ``TRAIN_FEATURES`` features in all, chosen by a hash of the id and
never held out (crc32 of the id as text, mod 5 = 0).  The chosen labels are a
table of that bounded size and broadcast to the documents; features are made
in the tasks and only these reach the driver.  Scoring covers every row and
whole text, shuffles nothing, and makes no Python object for a word.

Defined cases: a text that is null or has no word scores 0; labels that are
null teach nothing; if one class has no label, every text scores the share
of toxic labels (0 without labels); a null id is never held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm import tables as T
from tokenmill.llm.bytehash import _BYTE, _PLACE, LOWER, U64, mix, text_runs, words

TRAIN_PER_CLASS = 2000
TRAIN_FEATURES = 16_000_000
FEATURE_BITS = 18
PREFIXES = (3, 4, 5, 6, 7)
SUFFIX = 4
#: A feature needs this many training documents, else its weight stays 0.
MIN_DOCUMENTS = 4
EPOCHS, BATCH, RATE, DECAY = 25, 64, 0.15, 1e-4
#: Toxic documents weigh (clean / toxic) to this power.
BALANCE = 0.5

#: Word characters: ASCII letters and digits, and every byte of other characters.
_BREAK = np.ones(256, bool)
_BREAK[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?\n"]] = True


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    return (mix(h + U64(kind * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> U64(64 - FEATURE_BITS)).astype(np.uint32)


@dataclass
class Bags:
    """Features of a run of texts: ``feature`` (one row a word, one column a
    kind; the last bucket + 1 stands for none), and where sentences and texts begin."""

    feature: np.ndarray
    sentence: np.ndarray  # index of each sentence's first word
    text: np.ndarray      # index of each text's first sentence, and the end
    begin: np.ndarray     # character offsets in the text
    end: np.ndarray


NONE = 1 << FEATURE_BITS


def bags(data: np.ndarray, offs: np.ndarray) -> Bags:
    start, stop, h, first = words(data, offs, _BREAK)
    feature = np.full((len(start), 2 + len(PREFIXES)), NONE, np.uint32)
    if not len(start):
        zero = np.zeros(0, np.int64)
        return Bags(feature, zero, np.zeros(len(offs), np.int64), zero, zero)
    feature[:, 0] = _bucket(h, 0)
    value = _BYTE[LOWER[data]]
    for c, n in enumerate(PREFIXES, 1):
        at = start[stop - start >= n]
        feature[stop - start >= n, c] = _bucket(sum(value[at + k] * _PLACE[k] for k in range(n)), n)
    at = stop[stop - start >= SUFFIX + 1]
    feature[stop - start >= SUFFIX + 1, -1] = _bucket(sum(value[at - 1 - k] * _PLACE[k] for k in range(SUFFIX)), 100)
    text_of = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    stops = np.cumsum(_STOP[data])[start]
    head = np.flatnonzero(np.concatenate([[True], (stops[1:] != stops[:-1]) | (text_of[1:] != text_of[:-1])]))
    last = np.append(head[1:], len(start)) - 1
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    base = chars[offs[text_of[head]]]
    return Bags(feature, head, np.searchsorted(head, first), chars[start[head]] - base, chars[stop[last]] - base)


@dataclass
class Model:
    """``weights[NONE]`` is 0; without weights every text scores ``share``."""

    weights: np.ndarray | None
    bias: float
    share: float = 0.0

    def sentences(self, bag: Bags) -> np.ndarray:
        """Logit of each sentence."""
        if not len(bag.sentence):
            return np.zeros(0)
        return np.add.reduceat(self.weights[bag.feature].sum(1, dtype=np.float64), bag.sentence) + self.bias

    def texts(self, bag: Bags, z: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(bag.text) - 1, self.share)
        keep = np.concatenate([[0.0], np.cumsum(np.logaddexp(0.0, z))])
        return np.where(bag.text[1:] > bag.text[:-1], -np.expm1(-(keep[bag.text[1:]] - keep[bag.text[:-1]])), 0.0)


def fit(samples: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray) -> Model:
    """Stochastic gradient (Adagrad) on the noisy-or likelihood of texts, each
    given by its features (a row a word) and its sentences' first words."""
    kinds = samples[0][0].shape[1]
    documents = np.zeros(NONE + 1, np.int32)
    for feature, _ in samples:
        documents[np.unique(feature)] += 1
    useful = documents >= MIN_DOCUMENTS
    useful[NONE] = False
    w, square, bias, bias_square = np.zeros(NONE + 1), np.full(NONE + 1, 1e-3), -4.0, 1e-3
    weigh = ((toxic == 0).sum() / max(1, (toxic == 1).sum())) ** BALANCE
    rng = np.random.default_rng(7)
    for _ in range(EPOCHS):
        order = rng.permutation(len(toxic))
        for a in range(0, len(order), BATCH):
            docs = np.sort(order[a:a + BATCH])
            f = np.concatenate([samples[d][0] for d in docs])
            if not len(f):
                continue
            base = np.cumsum([0, *(len(samples[d][0]) for d in docs)])
            heads = np.concatenate([samples[d][1] + n for d, n in zip(docs, base)])
            of = np.repeat(np.arange(len(docs)), [len(samples[d][1]) for d in docs])
            sizes = np.diff(np.append(heads, len(f)))
            z = np.add.reduceat(w[f].sum(1), heads) + bias
            clean = np.exp(-np.bincount(of, np.logaddexp(0.0, z), len(docs)))  # probability of no toxic sentence
            pull = np.where(toxic[docs] == 1, -weigh * clean / np.maximum(1 - clean, 1e-6), 1.0)
            g = pull[of] * logistic(z) / len(docs)
            grad = np.bincount(f.ravel().astype(np.int64), np.repeat(np.repeat(g, sizes), kinds), NONE + 1)
            grad = np.where(useful, grad + DECAY * w / len(docs), 0.0)
            square += grad ** 2
            w -= RATE * grad / np.sqrt(square)
            gb = g.sum()
            bias_square += gb ** 2
            bias -= RATE * gb / np.sqrt(bias_square)
    return Model(w.astype(np.float32), float(bias))


def _feature_task():
    def fn(batch):
        ids, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for a, b, data, offs in text_runs(batch.column(2)):
            bag = bags(data, offs)
            word_at = np.append(bag.sentence, len(bag.feature))
            feats, sents = [], []
            for i in range(b - a):
                lo, hi = bag.text[i], bag.text[i + 1]
                feats.append(bag.feature[word_at[lo]:word_at[hi]].tobytes())
                sents.append((bag.sentence[lo:hi] - word_at[lo]).astype(np.uint32).tobytes())
            yield pa.record_batch([pa.array(ids[a:b], pa.int64()), pa.array(labels[a:b], pa.int32()),
                                   pa.array(feats, pa.binary()), pa.array(sents, pa.binary())], names=["id", "toxic", "feats", "sents"])
    return fn


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", per_class: int = TRAIN_PER_CLASS) -> Model:
    id_ = F.col(f"`{id_col}`").cast("long")
    known = (labels.select(id_.alias("id"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
             .where(F.col("toxic").isin(0, 1) & F.col("id").isNotNull() & ~T.held_out(F.col("id"))))
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = n.get(1, 0) / max(1, sum(n.values()))
    if len(n) < 2:
        return Model(None, 0.0, share)
    draw = F.pmod(F.xxhash64("id", F.lit("toxic")), F.lit(1 << 30)) / float(1 << 30)
    rate = F.when(F.col("toxic") == 1, min(1.0, per_class / n[1])).otherwise(min(1.0, per_class / n[0]))
    texts = docs.select(id_.alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    chosen = texts.join(F.broadcast(known.where(draw < rate)), "id").select("id", "toxic", "text")
    made = T.store(T.map_arrow(chosen, _feature_task, "id long, toxic int, feats binary, sents binary"), "toxic-sample")
    total = made.agg(F.sum(F.octet_length("feats"))).first()[0] or 0
    fits = F.pmod(F.xxhash64("id", F.lit("bytes")), F.lit(1 << 30)) / float(1 << 30) < min(1.0, 4 * TRAIN_FEATURES / max(1, total))
    rows = made.where(fits).orderBy("id", "toxic").toArrow()  # at most about TRAIN_FEATURES numbers
    toxic = rows["toxic"].to_numpy()
    if len(np.unique(toxic)) < 2:
        return Model(None, 0.0, share)
    kinds = 2 + len(PREFIXES)
    read = lambda x: np.frombuffer(x.as_buffer(), np.uint32)
    return fit([(read(x).reshape(-1, kinds), read(y).astype(np.int64)) for x, y in zip(rows["feats"], rows["sents"])], toxic)


_SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


def _score_task(shared):
    def fn(batch):
        model: Model = shared.value
        for a, b, data, offs in text_runs(batch.column(1)):
            bag = bags(data, offs)
            z = model.sentences(bag) if model.weights is not None else np.zeros(len(bag.sentence))
            score = np.clip(model.texts(bag, z), 0.0, 1.0)
            bad = np.flatnonzero(z >= 0) if model.weights is not None else np.zeros(0, np.int64)
            at = np.searchsorted(bad, bag.text).astype(np.int32)
            spans = pa.StructArray.from_arrays([pa.array(bag.begin[bad]), pa.array(bag.end[bad]),
                                                pa.array(logistic(z[bad]))], fields=list(_SPAN))
            yield pa.record_batch([batch.column(0).slice(a, b - a).cast(pa.int64()), pa.array(score),
                                   pa.ListArray.from_arrays(pa.array(at), spans)], names=["doc_id", "score", "offending"])
    return fn


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, offending
    (character spans and scores of the sentences of 0.5 or more)."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, label_col))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    out = T.map_arrow(texts, lambda: _score_task(shared),
                      "doc_id long, score double, offending array<struct<begin:long,end:long,score:double>>")
    return out.select("doc_id", T.held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending")
