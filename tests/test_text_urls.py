import re

from pyspark.sql import functions as F

from weirgate.functions import text as tx
from weirgate.functions.maintext import ExtractConfig, main_text
from weirgate.operators import urlclf as uc
from weirgate.operators.extract import extract_text


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x"))).first()[0]


def test_markup_noise(spark):
    cases = {
        "<p>a</p><SCRIPT>var t='</p><style>';</SCRIPT ><b>b</b>": "<p>a</p><b>b</b>",
        "<style>p{}</style>x<link rel=a>y": "xy",
        "a<svg a=1><g><svg><path/></svg></g></svg>b": "ab",
        "<!-- <script> --><p>kept</p><script>x</script>": "<!-- <script> --><p>kept</p>",
        "a<script>never closed": "a",
        "a" + "<svg>" * 9 + "x" + "</svg>" * 9 + "b": "ab",
        "a" + "<svg><g>" * 50 + "x" + "</g></svg>" * 50 + "b<svg/>c": "abc",
        "a<svg>b<svg></svg>c": "a",
        "a</svg>b": "ab",
        "<scripture>s</scripture><links>": "<scripture>s</scripture><links>",
    }
    for html, expected in cases.items():
        assert one(spark, tx.strip_markup_noise, html) == expected
    assert one(spark, tx.strip_markup_noise, None) is None
    many = "<svg>" + "<g/>" * 200_000 + "</svg>z"
    assert one(spark, tx.strip_markup_noise, many) == "z"


def test_quotes(spark):
    assert one(spark, tx.straighten_quotes, "“a” «b» ‘c’ d’e") == "\"a\" \"b\" 'c' d'e"


def test_url_path_words(spark):
    expected = {
        "https://x.com/haber/2024/05/12/a-1234-567": "haber/<year>/05/<2number>/a-<number>-<3number>",
        "https://x.com/t%C3%BCrk%C3%A7e+1999": "türkçe+<year>",
        "https://x.com/%zz/%FF/10": "%zz/\ufffd/<2number>",
        "https://x.com": "https://x.com",
        "x.com/a/b": "a/b",
        "no-slash-123": "no-slash-<3number>",
        "https://x.com/ö2024/2024ö/é-2024": "ö2024/2024ö/é-<year>",
        "http://x.com/0123/9/20255": "0123/9/<number>",
        "": "",
        "https://x.com//a//b?c=%26": "/a//b?c=&",
    }
    rows = uc.with_path_words(spark.createDataFrame([(u,) for u in expected], "url string")).collect()
    assert {r.url: r.url_p for r in rows} == expected


def test_main_text():
    page = """<html><head><title>T</title></head><body><nav><p>Menu entries of this site, many of them</p></nav><!-- no -->
      <article><h1>Head &amp; line</h1><p>First paragraph that is long enough.<br>Second part that is long enough.</p>
      <p>short</p><p><a href=x>All of this long block is one link to elsewhere</a></p><script>var t='</p>';</script></article>
      <footer>Footer text that is long enough to be kept</footer></body></html>"""
    config = ExtractConfig()
    assert main_text(page, config)[0] == "Head & line\nFirst paragraph that is long enough.\nSecond part that is long enough."
    assert main_text(None, config) == (None, False) and main_text("", config) == (None, False)
    assert main_text(page, ExtractConfig(time_limit_s=-1)) == (None, True)
    assert main_text("<head><title>x</title><body><p>A body after an open head element.", config)[0] == "A body after an open head element."


LONG = "Words enough to be taken for a paragraph."
PAGES = [
    ("""<html><head><title>T</title></head><body><nav><p>Menu entries of this site, many of them</p></nav><!-- no -->
      <article><h1>Head &amp; line</h1><p>First paragraph that is long enough.<br>Second part that is long enough.</p>
      <p>short</p><p><a href=x>All of this long block is one link to elsewhere</a></p><script>var t='</p>';</script></article>
      <footer>Footer text that is long enough to be kept</footer></body></html>""", "Head & line\nFirst paragraph that is long enough.\nSecond part that is long enough."),
    (None, None), ("", None), ("<p>short</p>", None),
    ("<head><title>x</title><body><p>A body after an open head element.", "A body after an open head element."),
    (f"<nav><nav><p>{LONG}</p></nav><p>{LONG}</p></nav><p>{LONG}</p></nav><p>{LONG}", f"{LONG}\n{LONG}"),
    (f"<aside><form><p>{LONG}</p></form></aside><P>{LONG}</P><footer>{LONG}", LONG),
    ("<p>&#73;t&#x2019;s&nbsp;&nbsp;&copy; &unknown; &#xD800; &#1114112; &amp;lt; &lt;b&gt; &NotEqualTilde;</p>", "It\u2019s \u00a9 &unknown; &#xD800; &#1114112; &lt; <b> \u2242\u0338"),
    (f"<p>{LONG} <a href=x>linked</a> {LONG}</p><p>{LONG} <a>{LONG} {LONG}</a></p>", f"{LONG} linked {LONG}"),
    (f"<p>one\x01two\x02\x03 {LONG}</p>", f"one two {LONG}"),
    (f"<h2>Head</h2><h2>  </h2><textarea><p>{LONG}</p>", "Head"),
]


def test_main_text_as_an_expression(spark):
    df = spark.createDataFrame([(i, page, "x") for i, (page, _) in enumerate(PAGES)], "id long, raw string, text2 string")
    found = extract_text(df)
    assert not re.search("Python|Pandas|ArrowEval|InArrow", found._jdf.queryExecution().executedPlan().toString())
    assert {r.id: r.text for r in found.collect()} == {i: text for i, (_, text) in enumerate(PAGES)}
    assert extract_text(df.limit(0)).collect() == []


def test_the_expression_agrees_with_the_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", F.col("html").alias("raw"))
    plain = {r.page_id: r.text for r in extract_text(pages).collect()}
    timed = {r.page_id: r.text for r in extract_text(pages, config=ExtractConfig(time_limit_s=60)).collect()}
    assert sum(plain[i] == timed[i] for i in plain) > 0.95 * len(plain)


def test_extraction_leaves_no_markup(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", F.col("html").alias("raw"))
    texts = extract_text(pages).collect()
    assert len(texts) == 50 and not any(re.search(r"</?(p|div|script|nav)\b", r.text or "") for r in texts)
    assert sum(r.text is not None for r in texts) > 40


def test_tfidf_by_hand(spark):
    df = spark.createDataFrame([(1, "aa bb aa", True), (2, "bb", True), (3, "aa cc", False)], "id long, t string, fit boolean")
    rows = {(r.row_id, r.term): r.weight for r in uc.tfidf(df, "id", "t", F.col("fit")).collect()}
    assert set(rows) == {(1, "aa"), (1, "bb"), (1, "aa bb"), (1, "bb aa"), (1, "aa bb aa"), (2, "bb"), (3, "aa")}
    assert rows[(2, "bb")] == rows[(3, "aa")] == 1.0
    import math

    rare, common = math.log(3 / 2) + 1, 1.0
    norm = math.sqrt((2 * rare) ** 2 + common**2 + 3 * rare**2)
    assert abs(rows[(1, "aa")] - 2 * rare / norm) < 1e-12


def test_class_scores_by_hand(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (0, 0), (0, 1), (2, 0)], "label int, prediction int")
    rows = {r["class"]: r for r in uc.class_scores(df).collect()}
    assert (rows[1].precision, rows[1].recall, rows[1].support) == (2 / 3, 2 / 3, 3)
    assert (rows[2].precision, rows[2].recall, rows[2].f1) == (0.0, 0.0, 0.0)
    assert rows[0].accuracy == 0.5


def test_model_round_trip(spark, tmp_path):
    rows = [(i, f"https://x.com/{'haber' if i % 2 else 'video'}/{i}", i % 2) for i in range(40)]
    df = uc.with_path_words(spark.createDataFrame(rows, "id long, url string, label int"))
    model = uc.fit(df, config=uc.ClassifierConfig(features=1 << 10, max_iter=5))
    uc.save(model, str(tmp_path / "m"))
    raw = df.select("id", "url", "label")
    for m in (model, uc.load(str(tmp_path / "m"))):
        assert uc.classify_urls(m, raw).where("label != prediction").count() == 0


# The kernel learner


def test_fourier_features_approach_the_kernel():
    import numpy as np

    from weirgate.operators.fourier import Directions

    rng = np.random.default_rng(1)
    directions = Directions(20_000, 0.7, 3)
    x = [(np.sort(rng.choice(1000, 6, replace=False)), rng.standard_normal(6) / 2) for _ in range(8)]
    dense = np.zeros((8, 1000))
    for row, (i, v) in zip(dense, x):
        row[i] = v
    z = np.array([directions.map(i, v) for i, v in x])
    want = np.exp(-0.7 * ((dense[:, None] - dense[None]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - want).max() < 0.03


def test_the_kernel_learns_what_no_line_separates(spark, tmp_path):
    """The label is whether exactly one of two words occurs."""
    import random

    rng = random.Random(5)
    rows = []
    for i in range(800):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append((i, f"{'alpha' if a else 'gamma'} some words between {'beta' if b else 'delta'}", int(a != b)))
    df = spark.createDataFrame(rows, "id long, url_p string, label int")
    train, held = df.where("id < 600"), df.where("id >= 600")
    share = lambda m: uc.predict(m, held).where("label = prediction").count() / 200
    linear = share(uc.fit(train, config=uc.ClassifierConfig(features=1 << 10, max_iter=50)))
    config = uc.ClassifierConfig(features=1 << 10, reg_param=1e-4, max_iter=40, fourier=512, gamma=1.0)
    model = uc.fit(train, config=config)
    assert share(model) > 0.95 and linear < 0.8
    uc.save(model, str(tmp_path / "m"))
    assert share(uc.load(str(tmp_path / "m"))) == share(model)
    assert uc.predict(model, df.where("id < 0")).count() == 0


def test_toxic_is_predicted_from_text(spark):
    from weirgate import registry

    rows = registry.QUERIES["toxic_predictions"](spark, "/root/testdata/sf0.1").where("split = 'validation'").collect()
    right = sum(r.label == r.prediction for r in rows)
    assert len(rows) > 200 and right > max(sum(r.label == c for r in rows) for c in (0, 1))
