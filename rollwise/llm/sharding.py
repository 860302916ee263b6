"""Sharding by fixed virtual slots.

A record is hashed into one of ``SLOTS`` fixed slots; a versioned map says which shard holds
which slot. Rebalancing and growing edit the map, never the hash:

1. ``slotted``: id, text size, CRC-32 and slot of every record, by JVM functions. The hash is of id
   and text, so that null or repeated ids do not meet in one slot.
2. Bytes and records are aggregated per slot (partial sums before the shuffle); only these, at most
   ``SLOTS`` rows, reach the driver. A slot that holds more than ``HOT`` mean slots in several records (equal
   rows have one hash) is split into parts of about the mean, records dealt to parts by their place.
3. The map starts with equal ranges of slots. ``rebalanced`` moves slots from the heaviest shard to the
   lightest while a move brings the two closer; ``grown`` adds a shard and moves slots into it alone.
   Every edit is a new ``version`` below the map's folder; what is read is the newest one.
4. The map, at most ``2 * SLOTS`` rows, is joined to the records. A record's place in its shard is its number
   within its slot part plus what the shard's earlier parts hold.

The law is ``bytes``: shards differ by less than a record or a slot part, whichever is larger. Defined
cases: a null text has no bytes (size 1, CRC-32 of nothing: 0); null ids, repeated ids and repeated rows are records
of their own; a record is never divided, so one that is larger than a shard's share stays whole; extra columns
are ignored by ``sharded`` and kept by ``write_shards``; an empty table gives no rows and a map without weights.
"""

from __future__ import annotations

import bisect
import heapq
import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans import files
from ..session import scratch_path
from .common import prepare, stored

SHARDS = 8
SLOTS = 4096
#: A slot above this many mean slots is split.
HOT = 4

MAP = "slot int, part int, parts int, shard int"
#: (slot, part, parts) -> shard
SlotMap = dict[tuple[int, int, int], int]


# ------------------------------------------------------------------- the map
def even_map(shards: int, slots: int = SLOTS) -> SlotMap:
    """Slots in equal ranges."""
    return {(s, 0, 1): s * shards // slots for s in range(slots)}


def _fitted(slot_map: SlotMap, sizes: dict[tuple[int, int, int], int]) -> SlotMap:
    """The map for the parts in ``sizes``: of a slot that is divided in another way now, every part starts
    where the slot's first part was."""
    home = {s: shard for (s, part, _), shard in sorted(slot_map.items(), reverse=True)}
    parts = {s: n for s, _, n in sizes}
    out = {k: v for k, v in slot_map.items() if parts.get(k[0], k[2]) == k[2]}
    return out | {k: out.get(k, home[k[0]]) for k in sizes}


def rebalanced(slot_map: SlotMap, sizes: dict[tuple[int, int, int], int], shards: int) -> SlotMap:
    """The map with slots moved from the heaviest to the lightest shard, each time the one that brings
    the two closest, until none does."""
    out = _fitted(slot_map, sizes)
    held: list[list[tuple[int, tuple[int, int, int]]]] = [[] for _ in range(shards)]
    for k, size in sizes.items():
        bisect.insort(held[out[k]], (size, k))
    total = [sum(size for size, _ in h) for h in held]
    while True:
        top, low = max(range(shards), key=total.__getitem__), min(range(shards), key=total.__getitem__)
        gap = total[top] - total[low]
        at = bisect.bisect_left(held[top], (gap / 2,))
        near = [i for i in (at - 1, at) if 0 <= i < len(held[top]) and 0 < held[top][i][0] < gap]
        if not near:
            return out
        size, k = held[top].pop(min(near, key=lambda i: abs(held[top][i][0] - gap / 2)))
        bisect.insort(held[low], (size, k))
        total[top], total[low], out[k] = total[top] - size, total[low] + size, low


def grown(slot_map: SlotMap, sizes: dict[tuple[int, int, int], int], shards: int) -> SlotMap:
    """The map with one more shard, number ``shards``: slots move into it only, from the shard that is heaviest at
    the time, until it holds its share (by bytes, or by slots if there are no records)."""
    out = _fitted(slot_map, sizes)
    weight = sizes if sum(sizes.values()) else dict.fromkeys(out, 1)
    held: list[list[tuple[int, tuple[int, int, int]]]] = [[] for _ in range(shards)]
    for k, size in weight.items():
        heapq.heappush(held[out[k]], (-size, k))
    total = [-sum(size for size, _ in h) for h in held]
    share, moved = sum(total) / (shards + 1), 0
    for _ in range(len(weight)):
        top = max(range(shards), key=total.__getitem__)
        if not held[top] or moved - held[top][0][0] > share:
            break
        size, k = heapq.heappop(held[top])
        total[top], moved, out[k] = total[top] + size, moved - size, shards
    return out


def write_map(spark: SparkSession, root: str, slot_map: SlotMap) -> int:
    """The map as the next version below ``root``; returns its number. One writer of a map at a time."""
    version = max(map_versions(spark, root), default=-1) + 1
    rows = [(*k, shard) for k, shard in sorted(slot_map.items())]
    spark.createDataFrame(rows, MAP).coalesce(1).write.parquet(f"{root.rstrip('/')}/version={version}")
    return version


def map_versions(spark: SparkSession, root: str) -> list[int]:
    """The versions that were written whole."""
    done = files.matching(spark, f"{root.rstrip('/')}/version=*/_SUCCESS")
    return sorted(int(p.rsplit("version=", 1)[1].split("/", 1)[0]) for p in done)


def read_map(spark: SparkSession, root: str, version: int | None = None) -> SlotMap:
    """The newest version of the map, or the one asked for; empty if there is none."""
    versions = map_versions(spark, root)
    if not versions:
        return {}
    path = f"{root.rstrip('/')}/version={versions[-1] if version is None else version}"
    return {(r["slot"], r["part"], r["parts"]): r["shard"] for r in spark.read.schema(MAP).parquet(path).collect()}


# --------------------------------------------------------------- the records
def _facts(id_col: str, text_col: str, slots: int) -> list:
    text = F.col(f"`{text_col}`").cast("string")
    raw = F.coalesce(text.cast("binary"), F.lit(b""))
    return [F.col(f"`{id_col}`").alias("id"), (F.octet_length(raw) + 1).cast("long").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.pmod(F.xxhash64(F.col(f"`{id_col}`"), text), F.lit(slots)).cast("int").alias("slot")]


def slotted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """(id, size, text_crc32, slot, place): one narrow row per record; ``place`` is its place in the table as read."""
    return docs.select(*_facts(id_col, text_col, slots), F.monotonically_increasing_id().alias("place"))


def _parts(rows: DataFrame, hot: dict[int, int]) -> DataFrame:
    """``rows`` with (part, parts) of their slot."""
    many = F.lit(1)
    if hot:
        split = F.create_map(*[F.lit(x) for pair in sorted(hot.items()) for x in pair])
        many = F.coalesce(F.try_element_at(split, F.col("slot")), F.lit(1))
    return rows.withColumn("parts", many).withColumn(
        "part", F.pmod(F.xxhash64("place"), F.col("parts")).cast("int"))


def slot_sizes(rows: DataFrame, slots: int = SLOTS) -> tuple[dict[tuple[int, int, int], tuple[int, int]], dict[int, int]]:
    """((slot, part, parts) -> (bytes, records), slot -> parts of the slots that are split)."""
    sums = [F.sum("size").alias("bytes"), F.count("*").alias("n")]
    whole = {r["slot"]: (r["bytes"], r["n"]) for r in rows.groupBy("slot").agg(*sums).collect()}
    mean = sum(b for b, _ in whole.values()) / slots
    hot = {s: math.ceil(b / mean) for s, (b, n) in whole.items() if n > 1 and b > HOT * mean and b > HOT * (b / n)}
    out = {(s, 0, 1): v for s, v in whole.items() if s not in hot}
    if hot:
        out |= {(s, part, n): (0, 0) for s, n in hot.items() for part in range(n)}
        cut = _parts(rows.filter(F.col("slot").isin(*hot)), hot).groupBy("slot", "part", "parts").agg(*sums)
        out |= {(r["slot"], r["part"], r["parts"]): (r["bytes"], r["n"]) for r in cut.collect()}
    return out, hot


def sharded(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS,
            map_root: str | None = None) -> DataFrame:
    """(id, size, text_crc32, shard, place, slot, part, map_version) of every record; ``place`` counts from 0 in its
    shard. The map below ``map_root`` (a scratch folder if not given) is made or edited for these records."""
    spark = docs.sparkSession
    prepare(spark)
    root = map_root or scratch_path(spark, "llm", "slot_map")
    rows = stored(slotted(docs, id_col, text_col, slots), "slotted")
    held, hot = slot_sizes(rows, slots)
    before = read_map(spark, root)
    if not before:
        before = even_map(shards, slots)
        write_map(spark, root, before)
    slot_map = rebalanced(before, {k: b for k, (b, _) in held.items()}, shards)
    version = write_map(spark, root, slot_map) if slot_map != before else map_versions(spark, root)[-1]
    start, bases = [0] * shards, []
    for k in sorted(held):
        bases.append((*k[:2], slot_map[k], start[slot_map[k]]))
        start[slot_map[k]] += held[k][1]
    where = F.broadcast(spark.createDataFrame(bases, "slot int, part int, shard int, base long"))  # at most 2 * slots rows
    number = F.row_number().over(Window.partitionBy("slot", "part").orderBy("id", "text_crc32", "place"))
    return (_parts(rows, hot).join(where, ["slot", "part"]).withColumn("number", number)
            .select("id", "size", "text_crc32", "shard", (F.col("base") + F.col("number") - 1).alias("place"),
                    "slot", "part", F.lit(version).alias("map_version")))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                 slots: int = SLOTS, map_root: str | None = None) -> None:
    """``docs`` below ``path`` by shard (folders ``shard=<n>``; ``_shard`` if there is such a column), by the rebalanced
    map; a shard is written by as many tasks as hold its records, nothing is shuffled."""
    spark = docs.sparkSession
    prepare(spark)
    root = map_root or scratch_path(spark, "llm", "slot_map")
    rows = stored(slotted(docs, id_col, text_col, slots), "slotted")
    held, hot = slot_sizes(rows, slots)
    before = read_map(spark, root) or even_map(shards, slots)
    slot_map = rebalanced(before, {k: b for k, (b, _) in held.items()}, shards)
    write_map(spark, root, slot_map)
    pairs = F.broadcast(spark.createDataFrame([(k[0], k[1], slot_map[k]) for k in sorted(held)] or [(-1, 0, 0)],
                                              "slot int, part int, shard int"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    named = docs.select(whole, _facts(id_col, text_col, slots)[-1], F.monotonically_increasing_id().alias("place"))
    name = "shard"
    while name in docs.columns:
        name = "_" + name
    (_parts(named, hot).join(pairs, ["slot", "part"]).select("row.*", F.col("shard").alias(name))
     .write.partitionBy(name).parquet(path))
