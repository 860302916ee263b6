"""Secret scan: keyword prefilter, anchored expressions near hits, embedded checksums.

1. One Aho-Corasick pass over the text (ASCII letters lowered) finds every keyword.
2. At each hit, and only there, the expression of that keyword is tried, anchored
   at the hit. Long hexadecimal runs have no keyword; their single character
   class is scanned directly.
3. Kinds that carry a checksum (GitHub and npm tokens: the CRC-32 of their
   random part in base 62) are reported only if it is right.

Results per kind are the leftmost non-overlapping matches, as a whole-text search
would give: a keyword inside an earlier match of its kind is skipped, also when that
match was then dropped for its length. Spans count code points, the end is exclusive.

Defined cases: a null or empty text has no spans; a null id keeps its row; repeated
rows are scanned each; other columns of the input are ignored; an empty table gives
an empty result. Time and memory are linear in the text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24

ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9_])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9_])")
#: Lower-cased keyword -> kind.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign",
    "apikey": "assign", "api_key": "assign", "akia": "access",
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm",
}
EXPRESSIONS = {"assign": ASSIGN, "access": ACCESS, "github": GITHUB, "npm": NPM}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                     T.StructField("end", T.IntegerType())])


def base62_crc32(text: str) -> str:
    """CRC-32 of ``text`` as six base-62 digits."""
    n, out = zlib.crc32(text.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = BASE62[d] + out
    return out


def accepted(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return len(m[1]) >= MIN_VALUE
    if kind == "access":
        return m.end() - m.start() >= MIN_ACCESS
    return base62_crc32(m[1]) == m[2]


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        a.add_word(word, (len(word), kind))
    a.make_automaton()
    return a


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of one text: by start, then in the order of ``KINDS``."""
    if not text:
        return []
    # bytes.lower() lowers A-Z only, so offsets stay those of the text.
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    hits = sorted((end + 1 - size, kind) for end, (size, kind) in automaton().iter(lowered))
    found, done = [], dict.fromkeys(EXPRESSIONS, 0)
    for start, kind in hits:
        if start >= done[kind] and (m := EXPRESSIONS[kind].match(text, start)):
            done[kind] = m.end()
            if accepted(kind, m):
                found.append((kind, start, m.end()))
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for b in batches:
        spans = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in scan(t.as_py())] for t in b.column(1)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, kind)], ["id", "spans"])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (id, spans array<struct<kind, start, end>>)."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("spans", T.ArrayType(SPAN))])
    return rows.mapInArrow(_scan_batches, schema)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by [KIND]; overlapping spans become one."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: s[1]):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]
