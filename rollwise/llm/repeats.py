"""Removal of repeated byte strings: two-stage suffix sorting.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts at any
other place of the table (same document included, never across documents).

1. *Partition.* Every string of ``LENGTH`` bytes is named by the smallest hash among its
   ``GRAM``-byte substrings, so equal strings have equal names. Runs of starts with one
   name are segments; a document's segments cover each start once. Segments whose name
   is unique hold no repeat. Segments with equal name and equal bytes are repeats
   throughout; one of them stands for all in the next step.
2. *Sort.* The segments of one name that differ in bytes meet in one task, many names at a
   time. Two-stage suffix sorting: only suffixes smaller than their successors are
   sorted directly; the others are induced by scanning the buckets of their first
   bytes in order. A start is a repeat if it shares ``LENGTH`` bytes with a neighbour in
   the sorted order.
3. *Remove.* Repeated starts go back to all segments with those bytes, and their bytes
   are cut out of the documents.

A name with more than ``VARIANTS`` different segments is not gathered in one task: there
each start's string is hashed, and hashes that occur twice are found by a shuffle with
partial counts, which is exact as well.

Defined cases: a null or empty text has no bytes; texts shorter than ``LENGTH`` lose none;
repeated rows repeat each other; null ids keep their rows; extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, stored
from .hashing import Prefix

LENGTH = 400
GRAM = 100
VARIANTS = 4096
BLOCK_BYTES = 1 << 20
SORT_BYTES = 100
_PLACE = np.uint64((1 << 20) - 1)


def segments(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first start, last start, name, hash of the bytes) of a text's segments."""
    n, w = len(data) - length + 1, length - gram + 1
    prefix = Prefix(data)
    names = prefix.windows(gram)
    keyed = (names & ~_PLACE) | (np.arange(len(names), dtype=np.uint64) & _PLACE)  # ties to the left
    padded = np.full(-(-len(keyed) // w) * w, ~np.uint64(0))
    padded[: len(keyed)] = keyed
    rows = padded.reshape(-1, w)
    to_left = np.minimum.accumulate(rows, axis=1).ravel()
    to_right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(to_right[:n], to_left[w - 1 : w - 1 + n])  # sliding minimum of w places
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    last = np.append(first[1:], n) - 1
    place = first + ((least[first] - first.astype(np.uint64)) & _PLACE).astype(np.int64)
    return first, last, names[place], prefix.ranges(first, last + length)


def _segments(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts: list[tuple] = []
            keys: list[np.ndarray] = []
            for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                data = (text.as_py() or "").encode("utf-8", "replace")
                if len(data) >= length:
                    parts.append(segments(np.frombuffer(data, np.uint8), length, gram))
                    keys.append(np.full(len(parts[-1][0]), key, np.int64))
            if parts:
                first, last, name, content = (np.concatenate(c) for c in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (np.concatenate(keys), first.astype(np.int64), last.astype(np.int64),
                                           name.view(np.int64), content.view(np.int64))],
                    ["key", "s1", "s2", "name", "content"])

    return run


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch of segments one row for each (name, content), with its count."""
    for b in batches:
        name, content = np.asarray(b.column(3)), np.asarray(b.column(4))
        order = np.lexsort((content, name))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(name[order]) != 0) | (np.diff(content[order]) != 0)
        at = np.flatnonzero(new)
        pick = b.take(pa.array(order[at]))
        count = pa.array(np.diff(np.append(at, len(order))).astype(np.int64))
        yield pa.RecordBatch.from_arrays([*pick.columns, count], ["key", "s1", "s2", "name", "content", "n"])


def smaller_than_successor(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the suffix that starts one place later."""
    sign = np.sign(text[1:].astype(np.int16) - text[:-1])
    decided = np.where(sign != 0, np.arange(len(sign)), len(sign))
    nearest = np.minimum.accumulate(decided[::-1])[::-1]  # equal bytes: as the first difference after them
    return np.append(np.append(sign, 1)[nearest] > 0, True)


def sort_directly(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """``at`` in the order of the ``depth`` bytes from there, ``SORT_BYTES`` of the still equal ones at a time."""
    padded = np.concatenate([text, np.zeros(depth + SORT_BYTES, np.uint8)])
    view = np.lib.stride_tricks.as_strided(padded, (len(text) + depth, SORT_BYTES), (1, 1))
    order, group = at.copy(), np.zeros(len(at), np.int64)  # group: first place of its equals so far
    tied = np.arange(len(at))
    for d in range(0, depth, SORT_BYTES):
        if not len(tied):
            break
        chunk = view[order[tied] + d].view(f"S{SORT_BYTES}").ravel()
        by = np.argsort(chunk, kind="stable")
        by = by[np.argsort(group[tied][by], kind="stable")]
        order[tied], chunk, g = order[tied][by], chunk[by], group[tied][by]
        new = np.ones(len(tied), bool)
        new[1:] = (g[1:] != g[:-1]) | (chunk[1:] != chunk[:-1])
        group[tied] = tied[np.flatnonzero(new)][np.cumsum(new) - 1]
        alone = new & np.append(new[1:], True)
        tied = tied[~alone]
    return order


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes in order (those equal for ``depth`` bytes in any order), by two-stage sorting."""
    n = len(text)
    small = smaller_than_successor(text)
    direct = sort_directly(text, np.flatnonzero(small), depth)
    rank, order = np.zeros(n + 1, np.int64), np.empty(n, np.int64)
    sizes = np.bincount(text, minlength=256)
    starts = np.cumsum(sizes) - sizes
    of_direct = np.searchsorted(text[direct], np.arange(257))
    induced = np.flatnonzero(~small)  # each has a successor that begins with a byte not above its own
    begins_lower = text[induced + 1] < text[induced]
    entry = induced[begins_lower]
    entry = entry[np.argsort(text[entry], kind="stable")]
    of_entry = np.searchsorted(text[entry], np.arange(257))
    for c in np.flatnonzero(sizes).tolist():
        at = starts[c]
        level = entry[of_entry[c] : of_entry[c + 1]]
        level = level[np.argsort(rank[level + 1], kind="stable")]  # their successors' buckets are complete
        while len(level):  # then those that begin with one more c, in the same order
            order[at : at + len(level)] = level
            at += len(level)
            before = level[level > 0] - 1
            level = before[text[before] == c]
        own = direct[of_direct[c] : of_direct[c + 1]]
        order[at : at + len(own)] = own
        rank[order[starts[c] : starts[c] + sizes[c]]] = np.arange(starts[c], starts[c] + sizes[c])
    return order


def repeated_starts(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """For each piece which of its starts have ``length`` bytes that also start at another place
    of the pieces."""
    # UTF-8 has no byte 255, so every byte can move up by one and 0 ends a piece
    text = np.frombuffer(b"\xff".join([*pieces, b""]), np.uint8) + np.uint8(1)
    ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
    firsts = np.concatenate([[0], ends[:-1] + 1])
    inside = np.zeros(len(text), bool)
    for f, e in zip(firsts.tolist(), ends.tolist(), strict=True):
        inside[f : max(f, e - length + 1)] = True
    order = suffix_order(text, length)
    order = order[inside[order]]
    same = np.zeros(len(order) + 1, bool)
    if len(order):
        strings = Prefix(text).windows(length)  # neighbours with a common prefix of ``length`` bytes
        same[1:-1] = strings[order[1:]] == strings[order[:-1]]
    found = np.zeros(len(text), bool)
    found[order[same[1:] | same[:-1]]] = True
    return [found[f : max(f, e - length + 1)] for f, e in zip(firsts.tolist(), ends.tolist(), strict=True)]


def _runs(flags: np.ndarray) -> list[dict[str, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return [{"lo": int(a), "hi": int(b) - 1} for a, b in zip(edge[0::2], edge[1::2], strict=True)]


RANGES = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
RANGES_SQL = "array<struct<lo: long, hi: long>>"


def _regions(length: int):
    """The bytes of segments, from documents with the list of those they hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for text, wanted in zip(b.column(2), b.column(3).to_pylist(), strict=True):
                data = text.as_py().encode("utf-8", "replace")
                out += [(w["name"], w["content"], w["many"], data[w["s1"] : w["s2"] + length]) for w in wanted]
            cols = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.bool_(), pa.binary()), strict=True)],
                ["name", "content", "many", "data"])

    return run


def _sort_names(length: int):
    """Repeated starts of the segments of whole names; rows come sorted by name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, bytes]] = []
        held = 0

        def solve(part: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
            flags = repeated_starts([p[2] for p in part], length)
            hits = [(p[0], p[1], _runs(f)) for p, f in zip(part, flags, strict=True) if f.any()]
            cols = list(zip(*hits, strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(cols, (pa.int64(), pa.int64(), RANGES), strict=True)],
                ["name", "content", "ranges"])

        for b in batches:
            for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if held >= BLOCK_BYTES and rows[-1][0] != r[0]:
                    yield solve(rows)
                    rows, held = [], 0
                rows.append(r)
                held += len(r[2])
        if rows:
            yield solve(rows)

    return run


def _start_hashes(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                h = Prefix(np.frombuffer(data, np.uint8)).windows(length).view(np.int64)
                n = len(h)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, name)), pa.array(np.full(n, content)), pa.array(np.arange(n)), pa.array(h)],
                    ["name", "content", "at", "h"])

    return run


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs [start, end) of ranges that overlap or touch."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, found in zip(b.column(2), b.column(3).to_pylist(), strict=True):
                data = (text.as_py() or "").encode("utf-8", "replace")
                spans = merge([(r["s1"] + x["lo"], r["s1"] + x["hi"] + length) for r in found or () for x in r["ranges"]])
                kept, at = hashlib.sha256(), 0
                for lo, hi in spans:
                    kept.update(data[at:lo])
                    at = hi
                kept.update(data[at:])
                out.append((len(data), sum(hi - lo for lo, hi in spans), len(spans), kept.hexdigest(),
                            [{"lo": lo, "hi": hi} for lo, hi in spans]))
            cols = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), RANGES)
            yield pa.RecordBatch.from_arrays(
                [b.column(1), *(pa.array(list(c), t) for c, t in zip(cols, kinds, strict=True))],
                ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, spans) per row; spans: removed bytes [lo, hi)."""
    prepare(docs.sparkSession)
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.xxhash64(F.col(f"`{id_col}`"), text).alias("key"), F.col(f"`{id_col}`").alias("id"),
                       text.alias("text"))
    segs = stored(rows.select("key", "text").mapInArrow(
        _segments(length, gram), "key long, s1 long, s2 long, name long, content long"), "repeat_segments")
    combined = (segs.mapInArrow(_combine, "key long, s1 long, s2 long, name long, content long, n long")
                .repartition("name").groupBy("name", "content")
                .agg(F.sum("n").alias("n"), F.min(F.struct("key", "s1", "s2")).alias("r")))
    variants = F.count("*").over(Window.partitionBy("name")).alias("variants")
    found = stored(combined.select("*", variants).filter("variants > 1 OR n > 1"), "repeat_names")

    wanted = (found.filter("variants > 1")
              .select("r.key", F.struct("name", "content", (F.col("variants") > VARIANTS).alias("many"), "r.s1", "r.s2")
                      .alias("w"))
              .groupBy("key").agg(F.collect_list("w").alias("wanted")))
    # documents with one key are equal, one of them is enough
    regions = rows.join(wanted, "key").mapInArrow(_regions(length), "name long, content long, many boolean, data binary")
    some = (regions.filter("NOT many").select("name", "content", "data").dropDuplicates(["name", "content"])
            .repartition("name").sortWithinPartitions("name")
            .mapInArrow(_sort_names(length), f"name long, content long, ranges {RANGES_SQL}"))
    hashes = (regions.filter("many").select("name", "content", "data").dropDuplicates(["name", "content"])
              .mapInArrow(_start_hashes(length), "name long, content long, at long, h long"))
    twice = hashes.groupBy("h").agg(F.count("*").alias("c")).filter("c > 1").select("h")
    many = (hashes.join(twice, "h").groupBy("name", "content")
            .agg(F.collect_list(F.struct(F.col("at").alias("lo"), F.col("at").alias("hi"))).alias("ranges")))
    whole = found.filter("n > 1").select(
        "name", "content", F.array(F.struct(F.lit(0).cast("long").alias("lo"), (F.col("r.s2") - F.col("r.s1")).alias("hi")))
        .alias("ranges"))
    if found.filter(F.col("variants") > VARIANTS).limit(1).count():
        some = some.unionByName(many)
    ranges = some.unionByName(whole)
    by_doc = (segs.join(ranges, ["name", "content"]).groupBy("key")
              .agg(F.collect_set(F.struct("s1", "ranges")).alias("found")))
    kind = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("id", kind), *T._parse_datatype_string(
        f"n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans {RANGES_SQL}").fields])
    return rows.join(by_doc, "key", "left").mapInArrow(_remove(length), schema)
