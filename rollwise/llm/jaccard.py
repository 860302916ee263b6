"""Exact n-gram Jaccard join: PartEnum signatures.

Documents are sets of word shingles (64-bit hashes). Two link when
``100 * |intersection| >= percent * |union|``.

1. Sets of equal elements are one set from here on.
2. Sizes fall into bands so that linked sets are in the same or in adjacent bands; a
   band bounds the number ``k`` of elements by which linked sets differ. The element
   domain is cut into ``n1`` parts, each into ``PARTS`` sub-parts; sets that differ in at
   most ``k`` elements differ in at most one element of some part, hence agree on all but
   one of its sub-parts. Every (part, sub-parts but one) is a signature of the elements
   in it: linked sets share one. No element or bucket is capped. Below ``RARE_PERCENT``
   sub-parts would be almost empty and bring unrelated sets together; there the signatures
   of a set are its rarest elements, one more than linked sets may lack of it (prefix
   filter). Rare is what falls into a bucket of few elements (``BUCKET_BITS``): any order
   that is the same for all sets finds all links, this one keeps common shingles out.
3. Sets that share a signature are joined as stars around their smallest member, first
   within each block of a task, so a bucket sends one row per task through the shuffle.
   The components of these stars are clusters: every link lies within one.
4. Each cluster is solved exactly. Clusters are cut into blocks of a bounded number of
   sets, every pair of blocks is one task that counts all its intersections as a matrix
   product and returns only a spanning forest of its links. The components of the
   forests are those of all links.

Defined cases: a null text, or one without words, has no shingles and links with
nothing; a text of fewer words than a shingle is one shingle; null ids are never the
smallest id of a component unless all are; repeated rows are linked; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, prepare, stored
from .components import connected_components
from .hashing import mix, shingle_sets

WIDTH, PERCENT = 3, 90
PARTS = 3
RARE_PERCENT = 90
BUCKET_BITS, CHUNK = 24, 1 << 16
STEP_BYTES = 2 << 20
BLOCK_SIGNATURES = 1_000_000
BLOCK_SETS, BLOCK_SHINGLES = 256, 200_000
COLUMNS = 8192


@lru_cache(maxsize=8)
def bands(percent: int) -> np.ndarray:
    """Smallest sizes of the bands: a set links only with sizes of its own or adjacent bands."""
    lows = [1]
    while lows[-1] < 1 << 40:
        lows.append(max(lows[-1] + 1, lows[-1] * 100 // percent + 1))
    return np.array(lows, np.int64)


def differing(percent: int, low: int) -> int:
    """The most elements in which linked sets of sizes below ``low`` differ."""
    # |a ^ b| = |a| + |b| - 2 * inter, and inter >= percent / (100 + percent) * (|a| + |b|)
    return (100 - percent) * 2 * (low - 1) // (100 + percent)


def signatures(elements: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of one non-empty set of sorted hashes."""
    lows = bands(percent)
    band = int(np.searchsorted(lows, len(elements), "right")) - 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(elements + np.uint64(0x632BE59BD9B4E019)))])
    out = []
    for tag in (band, band + 1):  # sets of the band below meet this one under its own tag
        k = differing(percent, int(lows[tag + 1]))
        if not k:  # only equal sets link, and they are one set already
            continue
        n1 = (k + 2) // 2  # at most one difference in some part
        cells = n1 * PARTS
        # cells are equal ranges of the hash domain, so sorted elements lie in cell order
        edge = (np.arange(1, cells, dtype=np.uint64) * np.uint64((1 << 64) // cells))
        cut = np.concatenate([[0], np.searchsorted(elements, edge), [len(elements)]])
        cell = np.diff(sums[cut]).reshape(n1, PARTS)
        names = np.arange(cells, dtype=np.uint64).reshape(n1, PARTS)
        both = cell.sum(axis=1, dtype=np.uint64)[:, None] - cell  # all sub-parts but one
        out.append(mix(mix(both) + names * np.uint64(0x9E3779B97F4A7C15) + np.uint64((tag + 1) << 40)).ravel())
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _buckets(elements: np.ndarray) -> np.ndarray:
    return (mix(elements) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def rare_signatures(elements: np.ndarray, percent: int, counts: np.ndarray) -> np.ndarray:
    """Signatures of one non-empty set of hashes, for any ``counts`` of the buckets."""
    band = int(np.searchsorted(bands(percent), len(elements), "right")) - 1
    needed = -(-percent * len(elements) // 100)  # linked sets share as many elements at least
    rare = elements[np.lexsort((elements, counts[_buckets(elements)]))[: len(elements) - needed + 1]]
    return np.concatenate([mix(mix(rare) + np.uint64((tag + 1) << 40)) for tag in (band, band + 1)])


def set_id(elements: np.ndarray) -> int:
    """A 64-bit identity of a non-empty set, as a signed integer."""
    total = int(mix(elements).sum(dtype=np.uint64)) + len(elements) * 0xC2B2AE3D27D4EB4F
    return int(mix(np.array([total % (1 << 64)], np.uint64)).view(np.int64)[0])


def _sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The shingle set of each text; texts are taken a bounded number of bytes at a time."""
    held, size = [], 0
    for t in texts:
        blob = (t.as_py() or "").encode("utf-8", "replace")
        if held and size + len(blob) > STEP_BYTES:
            yield from shingle_sets(held, width)
            held, size = [], 0
        held.append(blob)
        size += len(blob)
    if held:
        yield from shingle_sets(held, width)


def _identify(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [(len(s), set_id(s) if len(s) else None) for s in _sets(b.column(2), width)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([s[0] for s in sets], pa.int64()),
                 pa.array([s[1] for s in sets], pa.int64())], ["key", "id", "n", "fp"])

    return run


def _stars(groups: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (group, member) rows: the groups, their smallest members, and the distinct
    (smallest, other) pairs."""
    order = np.lexsort((members, groups))
    g, m = groups[order], members[order]
    first = np.concatenate([[True], g[1:] != g[:-1]])
    head = m[first][np.cumsum(first) - 1]
    other = head != m
    pairs = np.unique(np.stack([head[other], m[other]], axis=1), axis=0)
    return g[first], m[first], pairs


def _star_batch(groups: np.ndarray, heads: np.ndarray, pairs: np.ndarray) -> pa.RecordBatch:
    sig = pa.concat_arrays([pa.array(groups.view(np.int64)), pa.nulls(len(pairs), pa.int64())])
    a = np.concatenate([heads, pairs[:, 0]])
    b = pa.concat_arrays([pa.nulls(len(heads), pa.int64()), pa.array(np.ascontiguousarray(pairs[:, 1]))])
    return pa.RecordBatch.from_arrays([sig, pa.array(a), b], ["sig", "a", "b"])


def _count(width: int):
    """(chunk, counts) of the buckets of a task's elements."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, np.uint32)
        for b in batches:
            for s in _sets(b.column(0), width):
                np.add.at(counts, _buckets(s), 1)
        for at in range(0, len(counts), CHUNK):
            part = counts[at : at + CHUNK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                                                 ["chunk", "counts"])

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of the chunks of a task."""
    held: dict[int, np.ndarray] = {}
    for b in batches:
        for at, part in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            held[at] = np.minimum(held.get(at, 0) + np.frombuffer(part.as_py(), np.uint32).astype(np.int64), 0xFFFF)
    for at, counts in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([counts.astype(np.uint16).tobytes()], pa.binary())],
                                         ["chunk", "counts"])


def bucket_counts(rows: DataFrame, width: int) -> np.ndarray:
    """How many elements of the sets of (text) ``rows`` fall into each bucket, 65,535 at most: a
    table of fixed size."""
    kind = "chunk int, counts binary"
    parts = rows.select("text").mapInArrow(_count(width), kind).repartition("chunk").mapInArrow(_add, kind).collect()
    counts = np.zeros(1 << BUCKET_BITS, np.uint16)
    for r in parts:
        counts[r["chunk"] : r["chunk"] + CHUNK] = np.frombuffer(r["counts"], np.uint16)
    return counts


def _sign(width: int, percent: int, counts=None):
    """(sig, smallest set) per signature and block of rows, and the block's own star edges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs: list[np.ndarray] = []
        owners: list[int] = []
        seen: set[int] = set()
        held = 0

        def flush() -> pa.RecordBatch:
            members = np.repeat(np.array(owners, np.int64), [len(s) for s in sigs])
            return _star_batch(*_stars(np.concatenate(sigs), members))

        for b in batches:
            for s in _sets(b.column(0), width):
                if not len(s) or (fp := set_id(s)) in seen:
                    continue
                seen.add(fp)
                own = signatures(s, percent) if counts is None else rare_signatures(s, percent, counts.value)
                if not len(own):
                    continue
                sigs.append(own)
                owners.append(fp)
                held += len(own)
                if held >= BLOCK_SIGNATURES:
                    yield flush()
                    sigs, owners, seen, held = [], [], set(), 0
        if sigs:
            yield flush()

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (sig, a): star edges to the smallest member of each signature. Edges
    made within blocks pass through."""
    last_sig, last_head = None, None
    for b in batches:
        made = b.column(2).is_valid()
        edges = [np.stack([np.asarray(b.column(i).filter(made)) for i in (1, 2)], axis=1)]
        sig, a = (np.asarray(b.column(i).filter(pc.invert(made))) for i in (0, 1))
        if len(sig):
            if last_sig == sig[0]:
                sig, a = np.concatenate([[last_sig], sig]), np.concatenate([[last_head], a])
            first = np.concatenate([[True], sig[1:] != sig[:-1]])
            head = a[first][np.cumsum(first) - 1]
            last_sig, last_head = sig[-1], head[-1]
            other = head != a
            edges.append(np.stack([head[other], a[other]], axis=1))
        out = np.unique(np.concatenate(edges), axis=0)
        if len(out):
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(out[:, i])) for i in (0, 1)], ["a", "b"])


def link_matrix(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Boolean matrix of all links: intersections are products of 0/1 columns, a bounded
    number of columns at a time. Elements of one set only cannot add to an intersection."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    use = shared[column]
    column, owner = number[column[use]], owner[use]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((len(sets), len(sets)), np.int64)
    for at in range(0, int(shared.sum()), COLUMNS):
        lo, hi = np.searchsorted(column, [at, at + COLUMNS])
        x = np.zeros((len(sets), COLUMNS), np.float32)
        x[owner[lo:hi], column[lo:hi] - at] = 1
        common += (x @ x.T).astype(np.int64)
    union = sizes[:, None] + sizes[None] - common
    return 100 * common >= percent * union


def forest(linked: np.ndarray) -> np.ndarray:
    """For each row the smallest row it is connected with."""
    label = np.arange(len(linked))
    linked = linked | np.eye(len(linked), dtype=bool)
    while True:
        new = np.where(linked, label[None], len(linked)).min(axis=1)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _solve(percent: int):
    def run(group: pa.Table) -> pa.Table:
        fp, first = np.unique(np.asarray(group["fp"]), return_index=True)
        sets = [np.asarray(group["elements"][int(i)].values).view(np.uint64) for i in first]
        label = forest(link_matrix(sets, percent))
        other = label != np.arange(len(label))
        return pa.table({"a": pa.array(fp[label[other]]), "b": pa.array(fp[other])})

    return run


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
               percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: (key, id, n_shingles, component_id, group). ``key`` is a hash of
    id and text; ``group`` names the component also where it has no id (null without shingles)."""
    prepare(docs.sparkSession)
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.xxhash64(F.col(f"`{id_col}`"), text).alias("key"), F.col(f"`{id_col}`").alias("id"),
                       text.alias("text"))
    kind = rows.schema["id"].dataType
    base = stored(rows.mapInArrow(_identify(width), T.StructType([
        T.StructField("key", T.LongType()), T.StructField("id", kind), T.StructField("n", T.LongType()),
        T.StructField("fp", T.LongType())])), "jaccard_sets")
    counts = None
    if percent < RARE_PERCENT:
        counts = docs.sparkSession.sparkContext.broadcast(bucket_counts(rows, width))
    stars = (rows.select("text").mapInArrow(_sign(width, percent, counts), "sig long, a long, b long")
             .repartition(F.coalesce("sig", "a")).sortWithinPartitions("sig", "a")
             .mapInArrow(_meet, "a long, b long").distinct())
    clusters = stored(connected_components(stars, "jaccard_stars"), "jaccard_clusters")

    one = base.filter("fp IS NOT NULL").groupBy("fp").agg(F.min(F.struct("key", "n")).alias("r"))
    members = (clusters.select(F.col("node").alias("fp"), F.col("component").alias("cluster"))
               .join(one, "fp").select("fp", "cluster", "r.key", "r.n"))
    sizes = (members.groupBy("cluster").agg(F.count("*").alias("m"), F.sum("n").alias("t"))
             .select("cluster", F.greatest(F.ceil(F.col("m") / BLOCK_SETS), F.ceil(F.col("t") / BLOCK_SHINGLES))
                     .cast("int").alias("blocks")))
    members = (members.join(sizes, "cluster")
               .withColumn("x", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
               .select("key", "fp", "cluster", "x", "blocks"))
    texts = rows.select("key", "text").join(members, "key")
    with_sets = texts.select("fp", "cluster", "x", "blocks", "text").mapInArrow(
        _elements(width), "fp long, cluster long, x int, blocks int, elements array<long>")
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda y: y != F.col("x")))
    pairs = (with_sets.withColumn("y", F.explode(others))
             .select("cluster", F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi"), "fp", "elements"))
    links = pairs.groupBy("cluster", "lo", "hi").applyInArrow(_solve(percent), "a long, b long")
    joined = connected_components(links, "jaccard_links").select(F.col("node").alias("fp"), F.col("component").alias("to"))
    labelled = stored(base.join(joined, "fp", "left").select("key", "id", "n", F.coalesce("to", "fp").alias("group")),
                      "jaccard_groups")
    discard(base, clusters)
    least = labelled.filter("group IS NOT NULL").groupBy("group").agg(F.min("id").alias("component_id"))
    return (labelled.join(least, "group", "left")
            .select("key", "id", F.col("n").alias("n_shingles"),
                    F.when(F.col("group").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
                    "group"))


def _elements(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [s.view(np.int64) for s in _sets(b.column(4), width)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(sets, pa.list_(pa.int64()))],
                                             ["fp", "cluster", "x", "blocks", "elements"])

    return run


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
             percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component (the smallest id; null ids last); rows without
    shingles all stay."""
    found = components(docs, id_col, text_col, width, percent)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("key"))).alias("r")
    keep = (found.filter("group IS NOT NULL").groupBy("group").agg(first).select("r.key")
            .unionByName(found.filter("group IS NULL").select("key")).distinct())
    key = F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string"))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    kept = named.join(keep, "key", "left_semi")
    words = F.col(f"row.`{text_col}`").rlike(r"[^ \t\n\x0B\f\r]")
    some, none = kept.filter(words), kept.filter(~F.coalesce(words, F.lit(False)))
    return some.dropDuplicates(["key"]).unionByName(none).select("row.*")
