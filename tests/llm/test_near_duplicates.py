"""The pipeline's near-duplicate stage: 5-word shingles, Jaccard 0.8."""

from functools import partial

import corpus_pipeline as P
import numpy as np
import pytest
from rollwise.llm import jaccard as J

from . import test_jaccard
from .frames import docs


def test_stage_equals_brute_force_on_five_words_and_80_percent(spark, monkeypatch):
    texts = test_jaccard.corpus(n=400, seed=12)
    ids = list(range(len(texts)))
    narrow = test_jaccard.brute(ids, texts)
    monkeypatch.setattr(test_jaccard, "shingles", partial(test_jaccard.shingles, width=5))
    wide = test_jaccard.brute(ids, texts, percent=80)
    kept = lambda groups: {d for d, n, c in groups if n == 0 or d == c}
    assert kept(wide) != kept(narrow)
    got = {r["doc_id"] for r in P.near_duplicates(spark, docs(spark, texts, ids, extra=True, partitions=4), "").collect()}
    assert got == kept(wide)


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_linked_sets_share_a_rare_signature(most):
    rng = np.random.default_rng(most)
    counts = rng.integers(0, most, 1 << J.BUCKET_BITS).astype(np.uint16)
    met = 0
    for size in (1, 2, 4, 5, 6, 9, 10, 11, 50, 300):
        for _ in range(60):
            a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2))
            b = a.copy()
            b[rng.choice(len(a), min(len(a), int(rng.integers(0, size // 5 + 2))), replace=False)] += np.uint64(1)
            b = np.unique(b[: max(1, size - int(rng.integers(0, size // 4 + 1)))])
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                met += 1
                assert len(np.intersect1d(J.rare_signatures(a, 80, counts), J.rare_signatures(b, 80, counts)))
    assert met > 100


def test_unlike_sets_share_no_rare_signature():
    # a passage that all sets hold is common, hence no signature
    rng = np.random.default_rng(3)
    passage = rng.integers(0, 2**63, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate([passage, rng.integers(0, 2**63, 100, dtype=np.uint64)])) for _ in range(200)]
    counts = np.bincount(J._buckets(np.concatenate(sets)), minlength=1 << J.BUCKET_BITS).astype(np.uint16)
    _, times = np.unique(np.concatenate([J.rare_signatures(s, 80, counts) for s in sets]), return_counts=True)
    assert times.max() == 1
