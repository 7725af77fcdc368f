"""Phrase collocations against brute force, and the kernels at small sizes of everything."""

import random
import re
from collections import Counter

import pytest

from weirgate.llm import phrases


def pieces(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", text)]


def counted(rows, longest=5):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            totals[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(longest, len(words) - i) + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    return counts, totals


def collocations_brute(rows, least, longest=5, first=2000):
    counts, totals = counted(rows, longest)
    found = {}
    for (lang, g), a in counts.items():
        if a < least or len(g) < 2:
            continue
        if any(m == lang and len(h) > len(g) and f >= a and any(h[i : i + len(g)] == g for i in range(len(h))) for (m, h), f in counts.items() if f >= least):
            continue
        n = totals[lang]
        score, k = min((1000 * a * n // (counts[lang, g[:k]] * counts[lang, g[k:]]), k) for k in range(1, len(g)))
        found.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), counts[lang, g[:k]], counts[lang, g[k:]], n))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n, -s) for lang, rows in found.items() for i, (s, a, p, l, r, n) in enumerate(sorted(rows)[:first]))


def some_texts(rng, n):
    words = ["the", "The", "of", "a", "ß", "naïve", "x\x00y", " ", "end\x1c", "w1", "w2", "w3", "日本"]
    parts = [" ", "  ", "\t", " ", " ", ", ", ".", "\n", " ! ", " "]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(parts) for _ in range(rng.randrange(0, 40)))
        rows.append((rng.choice(["en", "de", None, "und"]), text + rng.choice(["", "of the w1 w2 w3 a", "x the of", " "])))
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_flows_over_any_chunks_and_borders(seed, monkeypatch):
    """Counts do not depend on chunks, runs, forgotten words or where the ranges begin."""
    import pyarrow as pa

    rng = random.Random(seed)
    monkeypatch.setattr(phrases, "CHUNK_WORDS", rng.choice([3, 50, 1000]))
    monkeypatch.setattr(phrases, "RUN_BYTES", rng.choice([4, 30, 1000]))
    monkeypatch.setattr(phrases, "HELD_WORDS", rng.choice([2, 1000]))
    monkeypatch.setattr(phrases, "MOST_LANGS", rng.choice([1, 64]))
    rows = [("und" if lang is None else lang, t) for lang, t in some_texts(rng, 60)]
    counts, totals = counted(rows)
    grams = sorted((lang.encode(), [w.encode() for w in g]) for lang, g in counts)
    borders = sorted(rng.sample(grams, rng.choice([0, 1, 5, 40])))
    borders = [(lang.decode(), g) for lang, g in borders]
    batches = [pa.record_batch([pa.array(c, pa.string()) for c in zip(*rows[i : i + 7])], ["lang", "text"]) for i in range(0, len(rows), 7)]
    blocks = [r for half in (batches[::2], batches[1::2]) for b in phrases._blocks(iter(half), 5, borders) for r in zip(*(c.to_pylist() for c in b.columns))]
    blocks.sort(key=lambda r: r[:2])
    least, got, paths = 4, Counter(), 0
    for b in phrases._paths(iter([phrases.as_batch([r], phrases.BLOCK) for r in blocks]), 5, least, borders):
        for lang, phrase, shortest, n, f, is_open in zip(*(c.to_pylist() for c in b.columns)):
            paths += 1
            for k in range(shortest, n + 1):
                key = (lang, tuple(phrase.split(" ")[:k]) if k else ())
                assert is_open or key not in got
                got[key] += f
    assert {lang: n for (lang, g), n in got.items() if g == ()} == {k: v for k, v in totals.items() if v}
    assert {k: f for k, f in got.items() if k[1] and f >= least} == {k: f for k, f in counts.items() if f >= least}


def test_collocations_equal_brute_force(spark):
    rows = some_texts(random.Random(9), 300)
    docs = spark.createDataFrame([(t, lang, 1, None, "x", 0) for lang, t in rows], "text string, lang string, rank int, score long, phrase string, f int")
    got = sorted(tuple(r) for r in phrases.mine_collocations(docs, least=8, first=30).collect())
    assert got == collocations_brute(rows, 8, first=30) and len(got) > 60
    assert phrases.mine_collocations(docs.limit(0)).collect() == []


def test_collocations_of_odd_documents(spark, odd_documents):
    rows = [(r.lang, r.text) for r in odd_documents.collect()]
    got = sorted(tuple(r) for r in phrases.mine_collocations(odd_documents, least=4).collect())
    assert got == collocations_brute(rows, 4)


def test_scores_beyond_64_bits(spark, monkeypatch):
    """Counts as large as a corpus of 10^13 words has them: products pass 64 bits, scores do not."""
    a, l, r, n = 9_000_000_000_123, 9_100_000_000_457, 9_200_000_000_891, 10_000_000_000_007
    counts = spark.createDataFrame([("en", "x y", 2, a), ("en", "x", 1, l), ("en", "y", 1, r)], "lang string, phrase string, len int, f long")
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    monkeypatch.setattr(phrases, "phrase_counts", lambda *x: (counts, totals))
    row = phrases.mine_collocations(counts).collect()[0]
    assert row.score == 1000 * a * n // (l * r) and (row.a, row.l, row.r, row.n) == (a, l, r, n)
