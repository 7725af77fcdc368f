import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weirgate.functions.kernels import DUP_SIZES, TOP_SIZES
from weirgate.operators import funnel
from weirgate.operators import quality as q

GOOD = "The house of the river stands with that old bridge and to be seen there is a treat."


def measures(spark, text, lang="en"):
    return q.with_measures(spark.createDataFrame([(1, text, lang)], "doc_id long, text string, lang string")).first()


def reasons(spark, texts, stage, lang="en", config=q.FilterConfig()):
    df = spark.createDataFrame([(i, t, lang) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    rows = q.filter_documents(df, config, stages=(stage,)).select("doc_id", "reason").collect()
    return [r.reason for r in sorted(rows)]


def brute_force(words):
    """The definition, one position at a time."""
    out = {}
    for n in range(2, 11):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        count = Counter(grams)
        if n in TOP_SIZES:
            best = max(((c, len(" ".join(g))) for g, c in count.items() if c > 1), default=(0, 0))
            out[f"top_{n}_chars"] = best[0] * best[1]
        if n in DUP_SIZES:
            seen, covered = set(), set()
            for i, g in enumerate(grams):
                if g in seen:
                    covered.update(range(i, i + n))
                seen.add(g)
            out[f"dup_{n}_chars"] = sum(len(words[i]) for i in covered)
    return out


def test_ngram_measures_equal_brute_force(spark):
    rng = random.Random(3)
    texts = ["", "one", "a b a b a b"] + [" ".join(rng.choice(["ab", "c", "déf", "ghij"]) for _ in range(rng.randint(2, 120))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for row in q.with_measures(df).collect():
        expected = brute_force(row.text.split())
        assert {k: row[k] for k in expected} == expected


def test_words_and_tokens(spark):
    m = measures(spark, "Ünïcode, şu 12_x __ … #tag.")
    assert (m.n_words, m.n_tokens, m.n_letter_tokens, m.n_hashes, m.n_ellipses) == (4, 9, 4, 1, 1)


@pytest.mark.parametrize("text", ["", " \n\n \t", None, "!!! ... ??"])
def test_text_without_words_is_empty(spark, text):
    assert reasons(spark, [text], "repetition") == ["empty"]


def test_paragraph_rules(spark):
    para = "First paragraph with its own words.\n\n"
    assert reasons(spark, [para * 3 + "Other text here.\n\nMore of it.", "x y.\n\nz w."], "repetition") == ["dup_para_frac", None]


def test_line_share_is_dropped_only_above_the_threshold(spark):
    lines = [" ".join(f"{w}{i}" for w in ("alpha", "beta", "gamma", "delta", "epsilon")) for i in range(7)]
    at = "\n".join([*lines, "dup", "dup", "dup", "dup"][:10])  # 2 of 10 repeat
    exactly = "\n".join([*lines[:6], "d", "d", "d", "d"])  # 3 of 10 repeat
    above = "\n".join([*lines[:5], "d", "d", "d", "d", "d"])  # 4 of 10 repeat
    assert reasons(spark, [at, exactly, above], "repetition") == [None, None, "dup_line_frac"]


def test_word_count_boundary(spark):
    base = GOOD.rstrip(".").split()
    fifty = (base * 4)[:50]
    assert reasons(spark, [" ".join(fifty[:49]), " ".join(fifty)], "quality") == ["gopher_short_doc", None]


def test_quality_rules_one_by_one(spark):
    long = " ".join((GOOD.split() * 5)[:60])
    cases = {
        "gopher_too_many_hashes": long + " " + "# " * 7,
        "gopher_too_many_ellipsis": long.replace("river", "river ...").replace("bridge", "bridge …").replace("treat.", "treat ..."),
        "gopher_too_many_bullets": "\n".join(f"• {GOOD}" for _ in range(10)),
        "gopher_too_many_end_ellipsis": "\n".join([GOOD[:-1] + "…", GOOD, GOOD[:-1] + " ...", GOOD]),
        "gopher_below_alpha_threshold": long + " 1001 2002 3003" * 12,
        "gopher_above_avg_threshold": " ".join(["extraordinarily"] * 50),
        "gopher_below_avg_threshold": " ".join(["ab"] * 50),
        "gopher_enough_stop_words": " ".join(["green", "apples", "fall"] * 20),
    }
    assert dict(zip(cases, reasons(spark, list(cases.values()), "quality"))) == {k: k for k in cases}


def test_stop_words_follow_the_language(spark):
    turkish = " ".join(["ağaç ve gölge için yeşil"] * 12)
    assert reasons(spark, [turkish], "quality", "tr") == [None]
    assert reasons(spark, [turkish], "quality", "en") == ["gopher_enough_stop_words"]
    assert reasons(spark, [turkish], "quality", "fi") == [None]


def test_line_structure_rules(spark):
    no_end = "\n".join(f"a fairly long line without its end {i} and more words" for i in range(10))
    short = "\n".join(["Short one."] + [f"Tiny {i}." for i in range(5)])
    dup = "\n".join(["This is a line that is long enough to count here."] * 2 + ["And another line, which is rather longer than that one."])
    assert reasons(spark, [no_end, short, dup], "fineweb") == ["line_punct_ratio", "short_line_ratio", "char_dup_ratio"]


def test_filter_on_reason_computes_measures_once(spark):
    docs = spark.createDataFrame([(1, GOOD, "en")], "doc_id long, text string, lang string")
    plan = q.filter_documents(docs).where("reason IS NULL")._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("ArrowEvalPython") == 1


def test_funnel_adds_up(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    judged = q.filter_documents(docs).withColumn("doc_len", F.length("text").cast("long"))
    counts = funnel.stage_counts(judged)
    rows = {(r.source, r.stage): r for r in counts.collect()}
    reasons_n = {(r.source, r.stage): 0 for r in rows.values()}
    for r in funnel.reason_counts(judged).collect():
        reasons_n[(r.source, r.stage)] += r.n
    for (source, stage), r in rows.items():
        assert r.total == r.forwarded + r.dropped
        assert r.dropped == reasons_n[(source, stage)]
    for source in {s for s, _ in rows}:
        for before, after in zip(q.STAGES, q.STAGES[1:]):
            assert rows[(source, after)].total == rows[(source, before)].forwarded
    nested = funnel.nested_counts(counts, funnel.reason_counts(judged))
    assert nested.count() == len(rows)
    assert all(sum(r.dropped_by.values()) == r.dropped for r in nested.where("dropped_by IS NOT NULL").collect())


def test_repetition_measures_take_a_bounded_number_of_words_at_a_time(monkeypatch):
    """A batch of ten times the documents takes no more memory, and slices change no value."""
    import tracemalloc

    import pyarrow as pa

    from weirgate.functions import kernels

    rng = random.Random(2)
    lists = [None, [], *([f"w{rng.randrange(12)}" for _ in range(rng.randrange(400))] for _ in range(3000)), []]
    words = pa.array(lists, pa.list_(pa.string()))
    whole = kernels._repetition_chars(words)
    monkeypatch.setattr(kernels, "REPETITION_WORDS", 5_000)
    peaks = []
    for n in (300, len(words)):
        tracemalloc.start()
        found = kernels.repetition_chars(words.slice(0, n))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert found.equals(whole) and peaks[1] < 2 * peaks[0]
    assert kernels.repetition_chars(words.slice(0, 0)).equals(whole.slice(0, 0)) and kernels.repetition_chars(words.slice(40, 50)).equals(whole.slice(40, 50))
