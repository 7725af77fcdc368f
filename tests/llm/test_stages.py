"""Stages of the pipeline against brute force, at the stages' own settings."""

import random

import numpy as np
import pytest
from test_documents import jaccard_brute, near_copies

from weirgate.llm import jaccard_join

FOLDER = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


# Near copies


def test_near_copies_by_five_words_leave_one(spark):
    """Two words of 100 changed: five-word similarity 86/106, three-word similarity 92/104."""
    import corpus_pipeline

    base = [f"w{i}" for i in range(100)]
    near, far = list(base), list(base)
    near[30] = near[60] = "new"
    far[20] = far[40] = far[60] = "new"  # 81/111
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far[:50] + ["x"] + far[50:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert ids(corpus_pipeline.jaccard_stage(spark, docs, FOLDER)) == [1, 3]


def test_jaccard_stage_equals_brute_force(spark, monkeypatch):
    import corpus_pipeline

    monkeypatch.setattr(jaccard_join, "FREQUENT", 4)
    monkeypatch.setattr(jaccard_join, "BLOCK", 24)
    monkeypatch.setattr(jaccard_join, "FEW", 4)
    rng = random.Random(8)
    rows = near_copies(rng, 3, 40, 150, 6) + [(i + 1000, t) for i, t in near_copies(rng, 20, 3, 24, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = jaccard_brute(rows, 5, 80)
    assert ids(corpus_pipeline.jaccard_stage(spark, docs, FOLDER)) == sorted({c for _, _, c in want})
    assert {c for _, _, c in want} != {c for _, _, c in jaccard_brute(rows, 3, 90)}


@pytest.mark.parametrize("seed", range(2))
def test_sets_linked_at_80_percent_share_a_signature(seed):
    rng = np.random.default_rng(seed)
    universe = np.sort(rng.integers(1, 1 << 64, 4000, dtype=np.uint64))
    draw = rng.random(len(universe))
    repeated, frequent = universe[(draw > 0.1) & (draw < 0.3)], universe[draw >= 0.3]

    def signed(tokens):
        n, low = len(tokens), int((tokens < np.uint64(int(jaccard_join.COUNTED * 2**64))).sum())
        need = n - jaccard_join.least_overlap(n, 80) + 1
        more = tokens[low : low + need] if low < 2 * need else tokens[:0]
        return jaccard_join.signatures(n, tokens[:low], more, repeated, frequent, 80)

    linked = 0
    for _ in range(600):
        n = int(rng.integers(5, 900))
        one = np.sort(rng.choice(universe, n, replace=False))
        lost = int(rng.integers(0, n // 5 + 1))
        gone = one[:lost] if rng.random() < 0.5 else rng.choice(one, lost, replace=False)
        other = np.sort(np.r_[np.setdiff1d(one, gone), rng.choice(np.setdiff1d(universe, one), int(rng.integers(0, lost + 1)), replace=False)])
        shared = len(np.intersect1d(one, other))
        if 100 * shared >= 80 * (len(one) + len(other) - shared) and not np.array_equal(one, other):
            linked += 1
            assert len(np.intersect1d(signed(one), signed(other))), (n, lost)
    assert linked > 200
