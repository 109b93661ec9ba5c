"""Next-token statistics: an order-n count model standing in for the network.

M1 transitions, M2 probabilities with excluded ids, M3 seeded categorical
draw, M4 batch completion, M5 held-out loss with the upstream aggregation
(A7) and the scaled train batch loss (A8).  Same operator surface as the
upstream model's data path, not the same predictions.

Scale notes: transitions are counted in the tasks before the shuffle (the
PAD->PAD pair is the hottest key by far); a context's distribution is
bounded by the vocabulary, so per-context windows stay small; the model is
a table (one row a context for decoding) that rows reach through equi-joins,
whose strategy Spark picks from its size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.functions import arrays as A
from tokenmill.functions.vocab import EOS_ID, PAD_ID, SOS_ID
from tokenmill.operators.arrow_ids import gram_counts
from tokenmill.session import cut_lineage, materialize

EXCLUDED = (SOS_ID, PAD_ID)  # never generated (upstream zeroes them)


def _ctx_key(seq: Column, t: Column, order: int) -> Column:
    """Space-joined ids of the (up to) ``order - 1`` tokens ending at ``t``."""
    start = F.greatest(t - (order - 2), F.lit(0))
    return F.array_join(F.transform(F.slice(seq, start + 1, t - start + 1),
                                    lambda v: v.cast("string")), " ")


def transitions(framed: DataFrame, order: int = 2, col: str = "encoded",
                include_pad_targets: bool = True) -> DataFrame:
    """M1: counts of (context, next) over the (x, y) pairs of framed sequences."""
    ex = gram_counts(framed, col, order)  # counted in the tasks
    if not include_pad_targets:
        ex = ex.where(F.col("next") != PAD_ID)
    return ex.groupBy("ctx", "next").agg(F.sum("c").alias("c"))


def _suffixes(ctx: Column) -> Column:
    """The context and all its shorter suffixes, the longest first, '' last."""
    parts = F.filter(F.split(ctx, " "), lambda x: x != "")
    n = F.size(parts)
    return F.transform(F.sequence(F.lit(0), n), lambda k: F.array_join(F.slice(parts, k + 1, n - k), " "))


def backoff_transitions(framed: DataFrame, order: int, col: str = "encoded") -> DataFrame:
    """M1 of every context length up to ``order - 1``: counts of (context,
    next), '' for none.  A position's shorter contexts are the suffixes of its
    longest one, so they are summed from the counted table, not from the text."""
    longest = materialize(transitions(framed, order, col), "transitions")
    return (longest.select(F.explode(_suffixes(F.col("ctx"))).alias("ctx"), "next", "c")
            .groupBy("ctx", "next").agg(F.sum("c").alias("c")))


def longest_known(contexts: DataFrame, known: DataFrame) -> DataFrame:
    """(ctx, used, n_ctx): the longest suffix of each ``ctx`` in ``known``
    (used, n_ctx).  One row for each different context and suffix is joined."""
    tried = contexts.select("ctx").distinct().select("ctx", F.posexplode(_suffixes(F.col("ctx"))).alias("k", "used"))
    return (tried.join(known, "used").groupBy("ctx").agg(F.min_by(F.struct("used", "n_ctx"), F.col("k")).alias("m"))
            .select("ctx", "m.used", "m.n_ctx"))


def backoff_losses(framed: DataFrame, counts: DataFrame, vocab_size: int, order: int, k: float = 1.0, col: str = "encoded") -> DataFrame:
    """M5 with back-off: as :func:`sequence_losses`, each position under the
    add-k distribution of its longest context that the training text holds."""
    pairs = transitions(framed, order, col).select("ctx", "next")
    known = counts.groupBy(F.col("ctx").alias("used")).agg(F.sum("c").alias("n_ctx"))
    scores = (pairs.join(longest_known(pairs, known), "ctx", "left").withColumn("used", F.coalesce("used", F.lit("")))
              .join(counts.withColumnRenamed("ctx", "used"), ["used", "next"], "left"))
    return _summed(framed, col, order, scores, vocab_size, k)


def _summed(framed: DataFrame, col: str, order: int, scores: DataFrame, vocab_size: int, k: float) -> DataFrame:
    """Each sequence's summed loss and number of positions.  ``scores`` holds
    every different (ctx, next) of ``framed`` once, with its counts, so one
    join scores the positions, which are counted within their row: nothing of
    the sequences is exchanged but a partial sum."""
    lp = F.log((F.coalesce("c", F.lit(0)) + k) / (F.coalesce("n_ctx", F.lit(0)) + k * vocab_size))
    scores = materialize(scores.select("ctx", "next", lp.alias("lp")), "scores")
    j = gram_counts(framed, col, order, key="doc_id").join(scores, ["ctx", "next"], "left")
    unseen = F.log(F.lit(float(k)) / (k * vocab_size))  # a null id meets no score
    return j.groupBy("doc_id").agg((-F.sum(F.col("c") * F.coalesce("lp", unseen))).alias("nll"), F.sum("c").alias("n_pos"))


def next_token_probs(trans: DataFrame, excluded=EXCLUDED) -> DataFrame:
    """M2: p(next | ctx) with excluded ids removed and the rest renormalised.

    Also ``hi`` and ``n``: the running count in id order and the context's
    total, whole numbers, so the slices [hi - c, hi) of [0, n) have no gaps
    (inverse-CDF sampling, M3).  The window is per context, so its size is
    bounded by the vocabulary.
    """
    t = trans.where(~F.col("next").isin(list(excluded)))
    w = Window.partitionBy("ctx")
    wc = Window.partitionBy("ctx").orderBy("next").rowsBetween(Window.unboundedPreceding, 0)
    return (t.withColumn("n", F.sum("c").over(w)).withColumn("p", F.col("c") / F.col("n"))
            .withColumn("hi", F.sum("c").over(wc)))


def greedy_table(probs: DataFrame) -> DataFrame:
    """Arg-max next token per context (ties to the lowest id)."""
    return probs.groupBy("ctx").agg(F.min_by("next", F.struct(-F.col("c"), F.col("next"))).alias("next"))


def context_table(probs: DataFrame) -> DataFrame:
    """One row per context: its total, next ids in id order with their running
    counts (arrays no longer than the vocabulary), and the arg-max."""
    row = F.sort_array(F.collect_list(F.struct("next", "hi")))
    return (probs.groupBy("ctx").agg(F.max("n").alias("n"), row.alias("r"),
                                     F.min_by("next", F.struct(-F.col("c"), F.col("next"))).alias("greedy"))
            .select("ctx", "n", F.col("r.next").alias("nexts"), F.col("r.hi").alias("his"), "greedy"))


@dataclass(frozen=True)
class Model:
    probs: DataFrame     # ctx, next, c, n, p, hi
    contexts: DataFrame  # ctx, n, nexts, his, greedy; '' is the context-free row
    order: int = 2


def fit(framed: DataFrame, order: int = 2, excluded=EXCLUDED) -> Model:
    """Fit the count model over all context lengths below ``order``.  A
    context is looked up by its longest known suffix; the last one is '',
    the context-free distribution of all targets.  Without any training
    target that row generates EOS."""
    probs = materialize(next_token_probs(backoff_transitions(framed, order), excluded), "probs")
    contexts = context_table(probs)
    if probs.isEmpty():
        contexts = contexts.unionByName(framed.sparkSession.range(1).select(
            F.lit("").alias("ctx"), F.lit(1).cast("long").alias("n"), F.array(F.lit(EOS_ID)).alias("nexts"),
            F.array(F.lit(1).cast("long")).alias("his"), F.lit(EOS_ID).alias("greedy")))
    return Model(probs, materialize(contexts, "contexts"), order)


def _draw(seed: str, row_key: Column, step: Column, n: Column) -> Column:
    """Seeded whole number in [0, n): 48 bits of md5(seed:row:step), mod n."""
    key = F.concat_ws(":", F.lit(seed), row_key.cast("string"), step.cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("long") % n


def _with_context(rows: DataFrame, model: Model) -> DataFrame:
    """Each row (column ``ctx``) with the row of its context's longest known
    suffix, the '' row at last.  One row a context, so rows never multiply."""
    found = ("n", "nexts", "his", "greedy")
    known = model.contexts
    rest = model.contexts.where(F.col("ctx") == "").select(*[F.col(c).alias(f"_{c}") for c in known.columns])
    j = rows.join(known, "ctx", "left")
    for k in range(1, model.order - 1):  # the suffix without its first k tokens
        at = F.get(_suffixes(F.col("ctx")), F.lit(k))
        shorter = known.select(F.col("ctx").alias("_short"), *[F.col(c).alias(f"_s_{c}") for c in found])
        j = j.withColumn("_at", at).join(shorter, F.col("_at") == F.col("_short"), "left")
        j = j.select(*rows.columns, *[F.coalesce(c, f"_s_{c}").alias(c) for c in found])
    j = j.join(F.broadcast(rest), F.col("_ctx") == "", "left")  # one row
    return j.select(*rows.columns, *[F.coalesce(c, f"_{c}").alias(c) for c in found])


def draw_next(rows: DataFrame, model: Model, seed: str, step: Column | int) -> DataFrame:
    """M3: one categorical draw per row (columns ``rid``, ``ctx``): the first
    next id whose running count exceeds the draw.  Adds ``next``."""
    step = F.lit(step) if isinstance(step, int) else step
    j = _with_context(rows, model).withColumn("_u", _draw(seed, F.col("rid"), step, F.col("n")))
    at = F.size(F.filter("his", lambda h: h <= F.col("_u"))) + 1
    return j.withColumn("next", F.element_at("nexts", at)).drop("n", "nexts", "his", "greedy", "_u")


def greedy_paths(model: Model, max_new_tokens: int) -> DataFrame:
    """(state, path): the greedy bigram continuation of every last token, up to
    EOS, by doubling: a path of 2**k tokens goes on with the path of its last
    token.  One small join a round; the state '' stands for unseen tokens."""
    states = model.contexts.select(F.col("ctx").alias("state")).union(
        model.contexts.select(F.col("greedy").cast("string"))).distinct()
    nxt = _with_context(states.withColumn("ctx", F.col("state")), model).select("state", "greedy")
    over = F.col("greedy") == EOS_ID
    paths = materialize(nxt.select("state", F.when(over, F.array().cast("array<int>")).otherwise(
        F.array("greedy")).alias("path"), over.alias("over")), "paths")
    length = 1
    while length < max_new_tokens:
        more = paths.select(F.col("state").alias("last"), F.col("path").alias("tail"), F.col("over").alias("tail_over"))
        last = F.when(~F.col("over"), F.element_at("path", -1).cast("string"))
        paths = materialize(paths.withColumn("last", last).join(more, "last", "left").select(
            "state", F.when(F.col("over"), F.col("path")).otherwise(F.concat("path", "tail")).alias("path"),
            (F.col("over") | F.col("tail_over")).alias("over")), "paths")
        length *= 2
    return paths.select("state", F.slice("path", 1, max_new_tokens).alias("path"))


def generate(prompts: DataFrame, model: Model, order: int = 2, max_new_tokens: int = 100,
             mode: str = "greedy", seed: str = "0", context_length: int = 1024,
             checkpoint_every: int = 20) -> DataFrame:
    """M4: complete every prompt (columns ``rid``, ``ids``) up to
    ``max_new_tokens``; stop at EOS (not emitted).  Output keeps the prompt.

    Greedy bigram completion is one join with :func:`greedy_paths`.  Otherwise
    each step is W7 crop -> context key -> join with the context table -> draw
    or arg-max -> G9 append; lineage is cut every few steps and the loop ends
    when all rows are done.  An empty prompt starts from SOS (Q14).  The model
    stays a table throughout.
    """
    if mode not in ("greedy", "sample"):
        raise ValueError("mode must be 'greedy' or 'sample'")
    start = prompts.select("rid", F.when(F.size("ids") == 0, F.array(F.lit(SOS_ID))).otherwise(F.col("ids")).alias("ids"))
    if order != model.order:
        raise ValueError(f"the model is of order {model.order}, not {order}")
    if mode == "greedy" and order == 2:
        paths = greedy_paths(model, max_new_tokens)
        unseen = paths.where(F.col("state") == "").select(F.col("path").alias("_path"), F.col("state").alias("_state"))
        j = (start.withColumn("state", F.element_at("ids", -1).cast("string")).join(paths, "state", "left")
             .join(F.broadcast(unseen), F.col("_state") == "", "left"))  # one row
        more = F.coalesce("path", "_path")
        return j.select("rid", F.concat("ids", more).alias("ids"), F.size(more).alias("n_new"))
    cur = start.withColumn("n_new", F.lit(0)).withColumn("done", F.lit(False))
    for step in range(max_new_tokens):
        ctx_ids = A.keep_last(F.col("ids"), context_length)
        act = cur.withColumn("ctx", _ctx_key(ctx_ids, F.size(ctx_ids) - 1, order))
        if mode == "greedy":
            act = _with_context(act, model).withColumn("next", F.col("greedy"))
        else:
            act = draw_next(act, model, seed, step)
        stop = F.col("done") | (F.col("next") == EOS_ID)
        cur = act.select("rid", F.when(stop, F.col("ids")).otherwise(A.append(F.col("ids"), F.col("next"))).alias("ids"),
                         (F.col("n_new") + F.when(stop, 0).otherwise(1)).alias("n_new"), stop.alias("done"))
        if (step + 1) % checkpoint_every == 0:
            cur = cut_lineage(cur)
            if cur.where(~F.col("done")).isEmpty():
                break
    return cur.drop("done")


def _one_order(trans: DataFrame) -> None:
    """The bigram loss looks up one token: a longer context would match nothing."""
    if not trans.where(F.col("ctx").contains(" ")).isEmpty():
        raise ValueError("transitions of order 2 expected; use backoff_losses for longer contexts")


def sequence_losses(framed: DataFrame, model_trans: DataFrame, vocab_size: int,
                    k: float = 1.0, col: str = "encoded") -> DataFrame:
    """Per sequence: summed negative log-likelihood of all (x, y) positions
    (PAD targets included, as upstream) under add-k smoothing over the full
    vocabulary, and the number of positions."""
    _one_order(model_trans)
    totals = model_trans.groupBy("ctx").agg(F.sum("c").alias("n_ctx"))
    pairs = transitions(framed, col=col).select("ctx", "next")
    return _summed(framed, col, 2, pairs.join(model_trans, ["ctx", "next"], "left").join(totals, "ctx", "left"), vocab_size, k)


def loss_report(seq_losses: DataFrame, batches: DataFrame, n_acc: int) -> tuple[DataFrame, DataFrame]:
    """A7/A8 over batches (``doc_id, split, epoch, batch_id``), every epoch.

    Returns (per-batch, summary).  Per batch: mean NLL over all its positions,
    and that mean divided by the accumulation steps (train log, A8).  Summary
    per split and epoch: ``reference_loss`` = sum of batch means / number of examples
    (upstream's test aggregation, Q9) and ``token_mean_loss`` = all NLL / all
    positions.
    """
    j = batches.join(seq_losses, "doc_id")
    per_batch = j.groupBy("split", "epoch", "batch_id").agg(
        F.count(F.lit(1)).alias("n_examples"), F.sum("nll").alias("nll"), F.sum("n_pos").alias("n_pos")
    ).withColumn("batch_mean", F.col("nll") / F.col("n_pos")).withColumn(
        "scaled_loss", F.col("batch_mean") / n_acc)
    summary = per_batch.groupBy("split", "epoch").agg(
        F.sum("n_examples").alias("n_examples"), F.count(F.lit(1)).alias("n_batches"),
        (F.sum("batch_mean") / F.sum("n_examples")).alias("reference_loss"),
        (F.sum("nll") / F.sum("n_pos")).alias("token_mean_loss"))
    return per_batch, summary
