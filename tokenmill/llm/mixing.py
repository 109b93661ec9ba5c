"""Mixing sources to target weights with nested hash thresholds.

Each source's target is its weight's share of all words, stopped at
``MAX_REPEATS`` times its size, the excess reshared by weight.  With
``target = k * size + extra`` every document is taken ``k`` times and those
whose 48-bit hash lies below the source's threshold once more.  The threshold
comes from histograms: words summed by (source, 12 leading hash bits), the
bucket where the running sum passes the extra budget, then only that bucket
again by the next 12 bits, four levels in all.  Nothing is sorted by row, and
histograms (at most 4,096 rows a source) are pre-aggregated in the map tasks.
A threshold is a function of the budget alone, so larger budgets take
supersets and reruns agree.

Weights go to the sources by code point, null last.  Per-source tables have
one row a source.  Defined cases: a null text has no words; a null id hashes
by its text; rows that repeat an id share a hash, so they are taken together;
a source without words has target 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.llm import tables as T

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
LEVELS = 4
LEVEL_BITS = 12


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash48(id_col: Column, text_col: Column) -> Column:
    """48 bits of md5 over the id (the text's md5 where the id is null)."""
    key = F.coalesce(id_col.cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(text_col, F.lit("")).cast("binary"))))
    return F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), key).cast("binary")), 1, 12), 16, 10).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """From (src, size), one row a source: adds weight, target, copies, extra."""
    rank = F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last())) - 1
    s = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                (rank % len(weights) + 1).cast("int")))
    cap = F.col("size") * F.lit(float(max_repeats))
    by_ratio = Window.orderBy(cap / F.col("weight"), F.col("src").asc_nulls_last())
    below = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    # Sources in order of cap / weight: the level that would hold if all before are stopped.
    level = ((F.sum("size").over(every) - F.coalesce(F.sum(cap).over(below), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(below), F.lit(0.0))))
    s = s.withColumn("level", level).withColumn("open", cap >= F.col("level") * F.col("weight"))
    s = s.withColumn("level", F.min(F.struct(F.when(F.col("open"), F.lit(0)).otherwise(1), cap / F.col("weight"),
                                             F.col("level"))).over(every).getField("level"))
    s = s.withColumn("target", F.least(cap, F.col("level") * F.col("weight")))
    copies = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(F.lit(0)).cast("long")
    return (s.withColumn("copies", copies).withColumn("extra", F.col("target") - F.col("copies") * F.col("size"))
            .select("src", "size", "weight", "target", "copies", "extra"))


def _boundary(rows: DataFrame, open_: DataFrame, level: int) -> DataFrame:
    """The bucket of this level in which each source's running sum passes its
    extra budget: adds ``prefix`` (of the hash, so far) and what lies before."""
    shift = LEVEL_BITS * (LEVELS - 1 - level)
    cells = rows.groupBy("src", F.shiftright("h", shift).alias("cell")).agg(F.sum("size").alias("words"))
    w = Window.partitionBy("src").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn("through", F.sum("words").over(w))
    o = open_.select(F.col("src").alias("_tm_s"), "extra", "before")
    hit = cells.join(o, cells["src"].eqNullSafe(o["_tm_s"])).where(F.col("before") + F.col("through") > F.col("extra"))
    return (hit.groupBy("src").agg(F.min(F.struct("cell", "words", "through", "extra", "before")).alias("m"))
            .select("src", F.col("m.cell").alias("prefix"), F.col("m.extra").alias("extra"), F.col("m.words").alias("words"),
                    (F.col("m.before") + F.col("m.through") - F.col("m.words")).alias("before")))


def thresholds(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """(src, threshold): documents with ``h < threshold`` are taken once more."""
    found = per_source.where("extra > 0").select("src", "extra", F.lit(0).cast("long").alias("before"))
    inside = rows
    for level in range(LEVELS):
        found = T.store(_boundary(inside, found, level), "mix-boundary")
        if level + 1 < LEVELS:
            cell = F.shiftright("h", LEVEL_BITS * (LEVELS - 1 - level))
            b = found.select(F.col("src").alias("_tm_s"), F.col("prefix").alias("_tm_p"))
            inside = inside.join(b, inside["src"].eqNullSafe(b["_tm_s"]) & (cell == F.col("_tm_p"))).select("src", "h", "size")
            inside = T.store(inside, "mix-inside")
    # The last bucket is one hash value: take it if that comes nearer to the budget.
    nearer = F.col("before") + F.col("words") - F.col("extra") < F.col("extra") - F.col("before")
    return found.select("src", (F.col("prefix") + F.when(nearer, 1).otherwise(0)).alias("threshold"))


def _sized(df: DataFrame, id_col: str, text_col: str, source_col: str) -> dict[str, Column]:
    id_, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")
    return {"id": id_, "src": F.col(f"`{source_col}`").cast("string"), "size": n_words(text), "h": hash48(id_, text)}


def plan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> tuple[DataFrame, DataFrame]:
    """(rows: _tm_id, src, size, h; per source: src, source_size, target, copies, threshold)."""
    cols = _sized(df, id_col, text_col, source_col)
    rows = T.store(df.select(cols["id"].alias("_tm_id"), *[cols[k].alias(k) for k in ("src", "size", "h")]), "mix-rows")
    per_source = T.store(targets(rows.groupBy("src").agg(F.sum("size").alias("size")), weights, max_repeats), "mix-targets")
    cut = thresholds(rows.select("src", "h", "size"), per_source).withColumnRenamed("src", "_tm_s")
    per_source = (per_source.join(cut, per_source["src"].eqNullSafe(cut["_tm_s"]), "left")
                  .select("src", F.col("size").alias("source_size"), "target", "copies",
                          F.coalesce("threshold", F.lit(0)).alias("threshold")))
    return rows, per_source


def mix_report(df: DataFrame, **options) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken."""
    rows, per_source = plan(df, **options)
    p = per_source.withColumnRenamed("src", "_tm_s")
    times = F.col("copies") + (F.col("h") < F.col("threshold")).cast("long")
    return (rows.join(p, rows["src"].eqNullSafe(p["_tm_s"]))
            .select(F.col("_tm_id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * times).alias("taken")))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed rows with their own columns only; a row taken n times stands n times."""
    _, per_source = plan(df, id_col, text_col, source_col, **options)
    cols = _sized(df, id_col, text_col, source_col)
    rows = T.with_record(df, src=cols["src"], h=cols["h"])
    p = per_source.select(F.col("src").alias("_tm_s"), "copies", "threshold")
    times = F.col("copies") + (F.col("_tm_h") < F.col("threshold")).cast("long")
    taken = rows.join(p, F.col("_tm_src").eqNullSafe(F.col("_tm_s"))).withColumn("_tm_times", times).where("_tm_times > 0")
    return T.records(taken.select("_tm_rec", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_tm_times")))))
