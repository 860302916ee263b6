"""Language identification: a byte convolutional network, trained in numpy.

Texts are cut into fixed windows of ``WINDOW`` UTF-8 bytes; all windows of a text are
scored, so long texts are read whole. A window goes through filters of widths 2, 3
and 4 over learnt byte embeddings, a ReLU, the maximum over positions, and a softmax
layer. A text's score is the mean of its windows' probabilities, each weighed by its
number of bytes.

Training uses a bounded sample of labelled rows: about ``SAMPLE_PER_CLASS`` rows a
language, drawn by a hash of the text, at most ``SAMPLE_ROWS`` in all, and at most
``SAMPLE_WINDOWS`` windows of each. The sample is fitted on the driver (a fixed
amount of work whatever the input); prediction is row-wise on Spark. The result is
deterministic for a given table.

Defined cases: a text that is null or has no letter is ``und`` with score 0; so is
every text if there is no labelled row. Equal texts get equal results; a null id
keeps its row; null labels are not learnt from; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
SAMPLE_PER_CLASS = 400
SAMPLE_ROWS = 4000
SAMPLE_WINDOWS = 4
MAX_CLASSES = 200
EPOCHS, BATCH, RATE, SEED = 10, 64, 0.004, 7
SCORED_AT_ONCE = 256
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


def windows(data: bytes) -> np.ndarray:
    """(n, WINDOW) byte windows that cover the text; the last is padded with zero bytes."""
    n = max(1, -(-len(data) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(n, WINDOW)


def new_parameters(classes: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    p = {"E": rng.normal(0, 0.5, (256, EMBEDDING))}
    for w in WIDTHS:
        p[f"W{w}"] = rng.normal(0, (2 / (w * EMBEDDING)) ** 0.5, (w * EMBEDDING, FILTERS))
        p[f"b{w}"] = np.zeros(FILTERS)
    p["V"] = rng.normal(0, (FILTERS * len(WIDTHS)) ** -0.5, (FILTERS * len(WIDTHS), classes))
    p["c"] = np.zeros(classes)
    return {k: v.astype(np.float32) for k, v in p.items()}


def _columns(emb: np.ndarray, w: int) -> np.ndarray:
    """(n, WINDOW - w + 1, w * EMBEDDING): each position with the w - 1 after it."""
    n, size, d = emb.shape
    s = emb.strides
    return np.lib.stride_tricks.as_strided(emb, (n, size - w + 1, w * d), (s[0], s[1], s[2]))


def forward(p: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, dict]:
    emb = np.ascontiguousarray(p["E"][x])
    pooled, kept = [], {"emb": emb}
    for w in WIDTHS:
        cols = np.ascontiguousarray(_columns(emb, w)).reshape(-1, w * EMBEDDING)
        y = (cols @ p[f"W{w}"]).reshape(len(x), WINDOW - w + 1, FILTERS)
        at = y.argmax(axis=1)
        top = np.take_along_axis(y, at[:, None, :], axis=1)[:, 0] + p[f"b{w}"]
        kept[w] = (at, top > 0)
        pooled.append(np.maximum(top, 0))
    h = np.concatenate(pooled, axis=1)
    z = h @ p["V"] + p["c"]
    e = np.exp(z - z.max(axis=1, keepdims=True))
    kept["h"] = h
    return e / e.sum(axis=1, keepdims=True), kept


def gradients(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    prob, kept = forward(p, x)
    n = len(x)
    dz = prob.copy()
    dz[np.arange(n), y] -= 1
    dz /= n
    g = {"V": kept["h"].T @ dz, "c": dz.sum(axis=0), "E": np.zeros_like(p["E"])}
    dh = dz @ p["V"].T
    for i, w in enumerate(WIDTHS):
        at, on = kept[w]
        d = dh[:, i * FILTERS : (i + 1) * FILTERS] * on
        g[f"b{w}"] = d.sum(axis=0)
        pos = at[:, :, None] + np.arange(w)  # (n, filters, w): only the winning positions carry gradient
        seen = x[np.arange(n)[:, None, None], pos]
        e = p["E"][seen].reshape(n, FILTERS, w * EMBEDDING)
        g[f"W{w}"] = np.einsum("nf,nfk->kf", d, e)
        back = (d[:, :, None] * p[f"W{w}"].T[None]).reshape(n, FILTERS, w, EMBEDDING)
        np.add.at(g["E"], seen.reshape(-1), back.reshape(-1, EMBEDDING))
    return g


def train(x: np.ndarray, y: np.ndarray, classes: int) -> dict[str, np.ndarray]:
    """Adam on the cross-entropy; deterministic for given windows and labels."""
    rng = np.random.default_rng(SEED)
    p = new_parameters(classes, rng)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(u) for k, u in p.items()}
    weight = 1.0 / np.maximum(np.bincount(y, minlength=classes), 1)
    chance = weight[y] / weight[y].sum()  # languages weigh the same whatever their share
    t = 0
    for _ in range(EPOCHS):
        order = rng.choice(len(x), len(x), p=chance)
        for i in range(0, len(x), BATCH):
            t += 1
            pick = order[i : i + BATCH]
            for k, g in gradients(p, x[pick], y[pick]).items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                p[k] -= RATE * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return p


def sample(labelled: DataFrame) -> list[tuple[bytes, str]]:
    """The bounded training sample of (text, lang): languages from their counts (at most
    ``MAX_CLASSES``, the most frequent), rows by a hash of the text."""
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n"))
              .orderBy(F.desc("n"), "lang").limit(MAX_CLASSES).collect()}
    if not counts:
        return []
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == F.lit(lang), F.lit(min(1.0, SAMPLE_PER_CLASS / n))).otherwise(share)
    draw = F.pmod(F.xxhash64("text", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    head = F.substring(F.encode("text", "UTF-8"), 1, WINDOW * SAMPLE_WINDOWS)
    rows = (labelled.filter(draw < share).select(F.xxhash64("text").alias("h"), "lang", head.alias("head"))
            .orderBy("h", "lang").limit(SAMPLE_ROWS).collect())
    return [(bytes(r["head"]), r["lang"]) for r in rows]


def fit(labelled: DataFrame) -> tuple[list[str], dict[str, np.ndarray]] | None:
    """``labelled``: (text, lang) rows; rows with a null in either take no part."""
    rows = sample(labelled.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL"))
    if not rows:
        return None
    langs = sorted({lang for _, lang in rows})
    cut = [(w, langs.index(lang)) for head, lang in rows for w in windows(head)]
    return langs, train(np.stack([w for w, _ in cut]), np.array([k for _, k in cut]), len(langs))


class Scorer:
    """Forward pass for many windows. The embedding and the filters are folded into
    tables of byte pairs, so a filter of width 4 is two lookups and one addition."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p, self.pairs = p, {}
        a, b = np.divmod(np.arange(65536), 256)
        for w in WIDTHS:
            parts = []
            for j in range(0, w, 2):
                k = p[f"W{w}"].reshape(w, EMBEDDING, FILTERS)
                t = p["E"][a] @ k[j]
                parts.append(t + p["E"][b] @ k[j + 1] if j + 1 < w else (p["E"] @ k[j]))
            self.pairs[w] = [t.astype(np.float32) for t in parts]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        pair = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        pooled = []
        for w in WIDTHS:
            size = WINDOW - w + 1
            y = None
            for i, t in enumerate(self.pairs[w]):
                at = (pair if len(t) == 65536 else x)[:, 2 * i : 2 * i + size]
                y = t[at] if y is None else np.add(y, t[at], out=y)
            pooled.append(np.maximum(y.max(axis=1) + self.p[f"b{w}"], 0))
        z = np.concatenate(pooled, axis=1) @ self.p["V"] + self.p["c"]
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def classify(texts: list[str | None], langs: list[str], scorer: Scorer) -> list[tuple[str, float]]:
    """(language, score) of each text."""
    data = [t.encode("utf-8", "replace") if t and LETTER.search(t) else b"" for t in texts]
    cut = [windows(d) for d in data if d]
    out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
    if not cut:
        return out
    x = np.concatenate(cut)
    # windows of a constant number at a time: memory does not grow with the texts
    prob = np.concatenate([scorer(x[i : i + SCORED_AT_ONCE]) for i in range(0, len(x), SCORED_AT_ONCE)])
    at = 0
    for i, d in enumerate(data):
        if d:
            n = -(-len(d) // WINDOW)
            weight = np.full(n, WINDOW, np.float64)
            weight[-1] = len(d) - WINDOW * (n - 1)
            mean = weight @ prob[at : at + n] / weight.sum()
            k = int(mean.argmax())
            out[i], at = (langs[k], float(min(1.0, mean[k]))), at + n
    return out


def predict(docs: DataFrame, model: tuple[list[str], dict[str, np.ndarray]] | None, text_col: str = "text",
            lang_as: str = "lang_pred", score_as: str = "score") -> DataFrame:
    """``docs`` with the two columns added (columns of the same names are replaced)."""
    prepare(docs.sparkSession)
    keep = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (lang_as, score_as)])
    place = keep.columns.index(text_col)
    schema = T.StructType([*keep.schema.fields, T.StructField(lang_as, T.StringType()),
                           T.StructField(score_as, T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model[1]) if model else None
        for b in batches:
            texts = b.column(place).to_pylist()
            got = classify(texts, model[0], scorer) if model else [(UNKNOWN, 0.0)] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                schema.names)

    return keep.mapInArrow(score, schema)


def lettered(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a letter."""
    prepare(docs.sparkSession)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([bool(t and LETTER.search(t)) for t in b.column(place).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    """The fold that is never learnt from: crc32 of the id's text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
