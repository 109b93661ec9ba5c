"""Sharding through fixed virtual slots and a versioned slot-to-shard map.

Every record hashes to one of ``N_SLOTS`` virtual slots (never changed).  The
bytes and rows of each slot are summed (one aggregation, ``N_SLOTS`` rows
reach the driver, whatever the corpus size).  Version 0 of the map deals the
slots round; each later version is an edit of the one before: shards above
the mean release their smallest slots, which go to the lightest shards.
Versions are stored as Parquet in the shared folder.  A record's place in its
shard is its slot's offset plus its number inside the virtual slot, so no
window holds more than a virtual slot.

Law ``bytes``: shard sizes are near equal, up to the size of a small slot.
The virtual slot hashes the id, the text's crc32 and size, and a number that
tells rows equal in all three apart, so neither copies of a text nor rows that
repeat an id, with one text or many, share a slot.  Equal rows are counted
first (map-side combined) and numbered from their count, a hot one in chunks
of ``CHUNK_ROWS`` dealt to different tasks; the numbers depend on nothing but
the rows.  A null id hashes by the rest.  An empty table gives an empty
result, and a text that is null has no bytes.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenmill.llm import tables as T

N_SLOTS = 8192
ROW_BYTES = 8
#: Equal rows that one task numbers at a time.
CHUNK_ROWS = 8192


def virtual_slot(n_slots: int = N_SLOTS) -> Column:
    """The slot of a row of :func:`numbered` rows."""
    return F.pmod(F.xxhash64("doc_id", "text_crc32", "size", "repeat"), F.lit(n_slots)).cast("int")


def numbered(rows: DataFrame) -> DataFrame:
    """One row per input row (doc_id, size, text_crc32) with ``repeat``: 0, 1, ...
    among rows equal in all three."""
    same = ["doc_id", "size", "text_crc32"]
    counts = T.store(rows.groupBy(*same).agg(F.count(F.lit(1)).alias("n")), "equal-rows")
    few = counts.where(F.col("n") <= CHUNK_ROWS).select(*same, F.lit(0).cast("long").alias("base"), "n")
    base = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(CHUNK_ROWS).cast("long")))
    many = (counts.where(F.col("n") > CHUNK_ROWS).select(*same, "n", base.alias("base"))
            .select(*same, "base", F.least(F.lit(CHUNK_ROWS), F.col("n") - F.col("base")).alias("n")).repartition(*same, "base"))
    return few.union(many).select(*same, F.explode(F.sequence("base", F.col("base") + F.col("n") - 1)).alias("repeat"))


def record_size(text_col: Column) -> Column:
    return (F.coalesce(F.octet_length(text_col), F.lit(0)) + ROW_BYTES).cast("long")


def initial_map(n_shards: int, n_slots: int = N_SLOTS) -> list[int]:
    return [s % n_shards for s in range(n_slots)]


def rebalance(shard_of: list[int], load: dict[int, int], n_shards: int) -> list[int]:
    """Edit the map until no single move makes shard sizes more equal."""
    shard_of = list(shard_of)
    total = [0] * n_shards
    members: list[list[tuple[int, int]]] = [[] for _ in range(n_shards)]
    for slot, n in load.items():
        total[shard_of[slot]] += n
        members[shard_of[slot]].append((n, slot))
    mean = sum(total) / n_shards
    pool = []
    for k in range(n_shards):
        members[k].sort(reverse=True)
        while total[k] > mean and len(members[k]) > 1:
            pool.append(members[k].pop())
            total[k] -= pool[-1][0]
    heap = [(total[k], k) for k in range(n_shards)]
    heapq.heapify(heap)
    for n, slot in sorted(pool, reverse=True):
        t, k = heapq.heappop(heap)
        shard_of[slot] = k
        members[k].append((n, slot))
        heapq.heappush(heap, (t + n, k))
    total = [t for t, _ in sorted(heap, key=lambda x: x[1])]
    for _ in range(len(load)):
        hi, lo = max(range(n_shards), key=total.__getitem__), min(range(n_shards), key=total.__getitem__)
        gap = total[hi] - total[lo]
        fits = [x for x in members[hi] if 0 < x[0] < gap]
        if not fits:
            break
        n, slot = min(fits, key=lambda x: (abs(x[0] - gap / 2), x[1]))
        members[hi].remove((n, slot))
        members[lo].append((n, slot))
        shard_of[slot] = lo
        total[hi] -= n
        total[lo] += n
    return shard_of


def grow(shard_of: list[int], load: dict[int, int], n_shards: int) -> list[int]:
    """The map for one more shard: slots move into the new shard only."""
    shard_of = list(shard_of)
    total = [0] * n_shards
    members: list[list[tuple[int, int]]] = [[] for _ in range(n_shards)]
    for slot, n in sorted(load.items()):
        total[shard_of[slot]] += n
        members[shard_of[slot]].append((n, slot))
    share, taken = sum(total) / (n_shards + 1), 0
    for m in members:
        m.sort(reverse=True)
    while taken < share:
        k = max(range(n_shards), key=total.__getitem__)
        if not members[k] or total[k] <= taken + members[k][-1][0]:
            break
        n, slot = members[k].pop()
        shard_of[slot] = n_shards
        total[k] -= n
        taken += n
    return shard_of


def _map_frame(spark: SparkSession, version: int, shard_of: list[int], load: dict[int, tuple[int, int]]) -> DataFrame:
    """One row per virtual slot: version, vslot, shard, bytes, rows, and the
    records of the same shard in earlier virtual slots."""
    before: dict[int, int] = {}
    rows = []
    for slot, shard in enumerate(shard_of):
        b, n = load.get(slot, (0, 0))
        rows.append({"v": version, "s": slot, "d": shard, "b": b, "n": n, "o": before.get(shard, 0)})
        before[shard] = before.get(shard, 0) + n
    kind = "array<struct<v:int,s:int,d:int,b:bigint,n:bigint,o:bigint>>"
    return (spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), kind)).alias("m"))
            .select(F.col("m.v").alias("version"), F.col("m.s").alias("vslot"), F.col("m.d").alias("shard"),
                    F.col("m.b").alias("bytes"), F.col("m.n").alias("rows"), F.col("m.o").alias("offset")))


def shard_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    """A stored version of the map."""
    return spark.read.parquet(f"{path}/version={version}")


def shard(df: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
          n_slots: int = N_SLOTS) -> tuple[DataFrame, str]:
    """(rows, map folder): doc_id, size, text_crc32, law, shard, slot (place
    in the shard, from 0 without gaps), grown_shard (null under this law),
    vslot, map_version."""
    spark = df.sparkSession
    id_, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")
    rows = df.select(id_.alias("doc_id"), record_size(text).alias("size"),
                     F.crc32(F.encode(F.coalesce(text, F.lit("")), "utf-8")).alias("text_crc32"))
    rows = numbered(rows).withColumn("vslot", virtual_slot(n_slots))
    sums = rows.groupBy("vslot").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    load = {r["vslot"]: (r["b"], r["n"]) for r in sums}
    path = T.shared_folder(spark, "shard-map")
    first = initial_map(n_shards, n_slots)
    edited = rebalance(first, {k: b for k, (b, _) in load.items()}, n_shards)
    for version, m in enumerate((first, edited)):
        _map_frame(spark, version, m, load).write.parquet(f"{path}/version={version}")
    # n_slots rows: a size fixed by the parameter.
    placed = rows.join(F.broadcast(shard_map(spark, path, 1).select("version", "vslot", "shard", "offset")), "vslot")
    inside = Window.partitionBy("vslot").orderBy("doc_id", "size", "text_crc32", "repeat")
    return (placed.withColumn("slot", F.col("offset") + F.row_number().over(inside) - 1)
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"), "vslot", F.col("version").alias("map_version")), path)
