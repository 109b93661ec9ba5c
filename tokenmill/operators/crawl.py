"""Crawl by frontier expansion, re-aimed onto the ``pages`` table.

J3 link edges, J4/U2 exclusion, U1 frontier union, W8 seeded sample, W9
page bound, U3 accumulation, A4 title dedup, C1 sampled crawl, C2 full
reachability (breadth-first depth).  The driver loops hold only counts and
DataFrame handles; every frontier and visited set stays distributed and
lineage is cut with reliable checkpoints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.plans.rounds import Rounds, input_fingerprint
from tokenmill.session import cut_lineage, materialize


def link_terms(pages: DataFrame) -> DataFrame:
    """(src, term): one row per link, term lower-cased."""
    return pages.select(F.col("page_id").alias("src"),
                        F.explode("links").alias("term")).select("src", F.lower("term").alias("term"))


def link_edges(pages: DataFrame) -> DataFrame:
    """A link term resolves to one page, as a title lookup does: the
    smallest page_id whose title's first word equals it (case-insensitive).
    Distinct (src, dst), never more rows than links; equi-join on the term,
    so the shuffle is keyed by term and AQE splits a hot term."""
    keys = pages.groupBy(F.col("title_key").alias("term")).agg(F.min("page_id").alias("dst"))
    return link_terms(pages).distinct().join(keys, "term").select("src", "dst").distinct()


def frontier_union(frontier: DataFrame, new: DataFrame) -> DataFrame:
    """Distinct union by column name."""
    return frontier.unionByName(new).distinct()


def frontier_except(frontier: DataFrame, removed: DataFrame, on: list[str]) -> DataFrame:
    """Anti-join (keeps duplicates of the left side's distinct rows)."""
    return frontier.join(removed, on, "left_anti")


def sample_frontier(frontier: DataFrame, key: str, k: int, seed: str, round_no: int) -> DataFrame:
    """Seeded, repeatable sample without replacement of ``k`` rows:
    the ``k`` smallest md5(seed:round:key).  A top-k, so no global sort."""
    h = F.md5(F.concat_ws(":", F.lit(seed), F.lit(str(round_no)), F.col(key).cast("string")))
    return frontier.withColumn("_h", h).orderBy("_h", key).limit(k).drop("_h")


def dedup_title(records: DataFrame, order_col: str = "ord") -> DataFrame:
    """A4: one row per title, carrying the *last* record's values and the
    *first* record's position (``first_ord``), as a dict keyed by title does.
    A hot title is pre-aggregated map-side (max_by/min are partial aggs)."""
    cols = [c for c in records.columns if c not in ("title",)]
    return records.groupBy("title").agg(
        F.max_by(F.struct(*cols), F.col(order_col)).alias("last"),
        F.min(order_col).alias("first_ord")).select("title", "last.*", "first_ord")


def _in_bitmap(bitmap: Column, place: Column) -> Column:
    """Whether bit ``place`` of a binary bitmap is set (false without one)."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))


def as_bitmaps(ids: DataFrame) -> DataFrame:
    """(bucket, bits): the set of ``page_id`` as one bitmap for each id range."""
    return ids.groupBy(F.bitmap_bucket_number("page_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("page_id")).alias("bits"))


def not_in_bitmaps(ids: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The rows of ``ids`` whose ``page_id`` is in none of the bitmaps: a join
    with one row for each id range, not with the members."""
    rows = ids.withColumn("bucket", F.bitmap_bucket_number("page_id"))
    return (rows.join(bitmaps, "bucket", "left")
            .where(~_in_bitmap(F.col("bits"), F.bitmap_bit_position("page_id"))).drop("bucket", "bits"))


def crawl_depth(edges: DataFrame, start: DataFrame, max_rounds: int | None = None, state: str | None = None) -> DataFrame:
    """Breadth-first depth of every page reachable from ``start``
    (column ``page_id``).

    A round joins the newest frontier with the edges and drops what was
    visited.  The visited set is a table of bitmaps, one for a range of 32,768
    ids and or-ed together each round, so it grows with the id range by an
    eighth of a byte an id and no round reads the visited rows again.  Each
    round's frontier is written once and is part of the result.  ``state``
    names a shared folder to go on from after a stop (same input and bound).
    """
    kept = Rounds(edges.sparkSession, state, input_fingerprint(edges, "depth", max_rounds)) if state else None
    e = materialize(edges.select("src", "dst"), "edges")
    done = kept.latest() if kept else None
    if done:
        depth, tables, values = done
        frontier, visited, grew = tables["frontier"], tables["visited"], values["grew"]
    else:
        first = start.select("page_id", F.lit(0).cast("long").alias("depth")).distinct()
        depth, grew = 0, True
        frontier, visited = _keep_depth(kept, 0, first, as_bitmaps(first), grew)
    found = [frontier]
    while grew and (max_rounds is None or depth < max_rounds):
        depth += 1
        near = frontier.join(e, F.col("page_id") == F.col("src")).select(F.col("dst").alias("page_id")).distinct()
        new = materialize(not_in_bitmaps(near, visited).select("page_id", F.lit(depth).cast("long").alias("depth")), "frontier")
        more = visited.unionByName(as_bitmaps(new)).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        grew = not new.isEmpty()
        if grew or kept:
            frontier, visited = _keep_depth(kept, depth, new, more, grew)
            found.append(frontier)
    return kept.all("frontier") if kept else edges.sparkSession.read.schema("page_id long, depth long").parquet(
        *[f for df in found for f in df.inputFiles()])


def _keep_depth(kept: Rounds | None, depth: int, frontier: DataFrame, visited: DataFrame, grew: bool) -> tuple[DataFrame, DataFrame]:
    """A round's tables as stored: published for a resumable crawl, else as plain tables."""
    if kept:
        tables = kept.publish(depth, {"frontier": frontier, "visited": visited}, {"grew": grew})
        return tables["frontier"], tables["visited"]
    return frontier if depth else materialize(frontier, "frontier"), materialize(visited, "visited")


def crawl_log(edges: DataFrame, start_page: int, n_pages: int, sample_size: int = 100, seed: str = "0",
              revisit: bool = False, state: str | None = None, publish_every: int = 8) -> DataFrame:
    """C1's fetch log (round, ord, page_id): which pages a sampled crawl takes.

    Each round samples ``min(sample_size, |frontier|, n_pages - collected)``
    page ids (in sample order, which numbers them), removes them from the
    frontier and adds their out-links.  With ``revisit=True`` a fetched page
    can re-enter the frontier (upstream has no visited set, Q10); by default
    fetched pages are excluded.  Ends at ``n_pages`` or an empty frontier.

    The loop works on ids and the edge table alone.  The ids of one sample
    (at most ``sample_size``) pass through the driver, and the log of at most
    ``n_pages`` ids, both parameters; frontiers stay distributed.  ``state``
    names a shared folder where the frontier and the log are published every
    ``publish_every`` rounds; the same crawl goes on from there after a stop.
    """
    spark = edges.sparkSession
    ids = "page_id long"
    kept = Rounds(spark, state, input_fingerprint(edges, start_page, n_pages, sample_size, seed, revisit)) if state else None
    e = edges.select("src", "dst").persist()
    frontier = spark.createDataFrame([(start_page,)], ids)
    log: list[tuple[int, int, int]] = []
    round_no = 0
    done = kept.latest() if kept else None
    if done:
        round_no, tables, _ = done
        frontier = tables["frontier"]
        log = sorted((tuple(r) for r in tables["log"].collect()), key=lambda r: r[1])
    while len(log) < n_pages:
        sample = [r["page_id"] for r in sample_frontier(
            frontier, "page_id", min(sample_size, n_pages - len(log)), seed, round_no).collect()]
        if not sample:
            break
        log += [(round_no, len(log) + i, p) for i, p in enumerate(sample)]
        taken = spark.createDataFrame([(p,) for p in sample], ids)
        new = e.join(F.broadcast(taken), e.src == F.col("page_id")).select(F.col("dst").alias("page_id"))
        frontier = frontier_union(frontier_except(frontier, taken, ["page_id"]), new)
        if not revisit:
            seen = spark.createDataFrame([(p,) for p in sorted({p for _, _, p in log})], ids)
            frontier = frontier_except(frontier, seen, ["page_id"])
        round_no += 1
        if kept and round_no % publish_every == 0:
            frontier = kept.publish(round_no, {"frontier": frontier, "log": spark.createDataFrame(log, _LOG)}, {})["frontier"]
        else:
            frontier = cut_lineage(frontier)
    e.unpersist()
    return spark.createDataFrame(log, _LOG)


_LOG = "round long, ord long, page_id long"


def crawl(pages: DataFrame, edges: DataFrame, start_page: int, n_pages: int, sample_size: int = 100,
          seed: str = "0", revisit: bool = False) -> tuple[DataFrame, DataFrame]:
    """Sampled frontier crawl.  One join fetches all logged pages (U3),
    then titles are deduplicated (A4).  Returns (deduplicated records, fetched
    records with ``round`` and ``ord``)."""
    log = crawl_log(edges, start_page, n_pages, sample_size, seed, revisit)
    fetched = pages.join(F.broadcast(log), "page_id")  # at most n_pages rows
    return dedup_title(fetched, "ord"), fetched
