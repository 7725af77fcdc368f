"""Search, URL and page operators, the registered SQL, and the pipeline."""

import hashlib
import html
import pickle
import re
import time

import numpy as np
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from weirgate.llm import main_text, topk, url_filter
from weirgate.llm.registry import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), SQL[name]) is None


# Top-k


def test_top_k_with_ties_repeats_nulls_and_short_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), [int(x) for x in rng.integers(-2, 3, rng.integers(0, 5))]) for i in rng.permutation(60)]
    rows += [rows[0], (7, [5, 5]), (None, [1]), (61, None)]
    vectors = spark.createDataFrame(rows, "id long, vec array<long>")
    got = topk.top_k(vectors.where("id % 3 = 0"), vectors, k=4, query_block=8, candidate_block=9).collect()
    best = {}
    for q, a in rows:
        for c, b in rows:
            if q is not None and c is not None and a is not None and b is not None and q % 3 == 0 and q != c:
                score = sum(x * y for x, y in zip(a, b))
                best[q, c] = max(best.get((q, c), score), score)
    want = []
    for q in {q for q, _ in best}:
        order = sorted((-s, c) for (p, c), s in best.items() if p == q)[:4]
        want += [(q, i + 1, c, -s) for i, (s, c) in enumerate(order)]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_search_leaves_out_vectors_that_are_not_finite(spark):
    rows = [(0, [0.5, -0.5001]), (1, [1.0, None]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, None), (5, [0.25, 0.25]), (100, [])]
    got = topk.search_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted(tuple(r) for r in got) == [(0, 1, 100, 0), (0, 2, 5, 512 * 256 - 513 * 256), (100, 1, 0, 0), (100, 2, 5, 0)]
    assert topk.search_embeddings(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


# URLs


def test_urls_by_hand(spark):
    urls = [
        (1, "http://A.Example.NET/en/x?q#f"), (2, "https://example.net/fr"), (3, "x.net/none"), (4, None), (5, "ftp://example.com/de/"), (6, "http://org/fr/a"),
        (7, "http://notorg/fr/a"), (8, "http://x.net"), (9, "https://listed.com/p/?utm_a=1&b=2#x"), (10, "http://listed.com/p?b=2"), (11, "http://listed.com/p?b=3"), (None, "http://listed.com/p?b=2"), (9, "https://listed.com/p/?utm_a=1&b=2#x"),
    ]
    pages = spark.createDataFrame([(i, u, "h", True, None) for i, u in urls], "page_id long, url string, host string, listed boolean, block string")
    listed = spark.createDataFrame([("https://LISTED.com/p?b=2",), (None,), ("",), ("https://LISTED.com/p?b=2",)], "url string")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, listed).collect()), key=repr)
    want = [
        (1, "a.example.net", "/en/x", "example.net/en/", "allow"), (2, "example.net", "/fr", "net/", "block"), (3, "", "", None, "allow"), (4, "", "", None, "allow"),
        (5, "example.com", "/de/", "example.com/de/", "block"), (6, "org", "/fr/a", "org/fr/", "allow"), (7, "notorg", "/fr/a", None, "allow"), (8, "x.net", "", None, "allow"),
        (9, "listed.com", "/p/", None, "block"), (9, "listed.com", "/p/", None, "block"), (10, "listed.com", "/p", None, "block"), (11, "listed.com", "/p", None, "allow"), (None, "listed.com", "/p", None, "block"),
    ]
    assert got == sorted(want, key=repr)
    assert url_filter.judge_urls(pages.limit(0), listed).collect() == []
    assert {r.verdict for r in url_filter.judge_urls(pages.where("page_id in (10, 11)"), listed.limit(0)).collect()} == {"allow"}


def test_a_full_filter_still_gives_exact_verdicts(spark):
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.com/"), F.col("id")).alias("url"))
    got = url_filter.judge_urls(pages, pages.where("page_id % 2 = 0"), blocks=1)
    assert {(r.page_id % 2, r.verdict) for r in got.collect()} == {(0, "block"), (1, "allow")}


@pytest.mark.parametrize("name", ["op4_url_filter"])
def test_native_plan(spark, name):
    assert not re.search("Python|Pandas|Arrow", QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString())


# Pages

ARTICLE = "<h1>A &amp; title</h1><p>First   <b>bold</b> line<br>second.<p>It.</p><ul><li>one <a href=x>two</a></li></ul>"
TEXT = "A & title\nFirst bold line\nsecond.\nIt.\none two"
AROUND = (
    "<header><p>The site of many words and some more words that are long enough</p></header><nav><ul><li><a href=/>Home</a></ul></nav>"
    "<aside><p>Sidebar text with a good many words in it, as long as a paragraph of the article would be.</p></aside>"
)
AFTER = (
    "<div class='cookie-notice'><p>We use cookies on this site, please read all of this long and tedious notice about them.</p></div>"
    "<form><label>Name</label><input name=a><button>Send</button></form><section id=comments><p>I think that this article is wrong in each and every word of it.</p></section>"
    "<footer>&copy; site</footer>"
)


def test_pages_by_hand(spark):
    head = "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
    pages = [
        (1, "u", f"{head}{AROUND}<article>{ARTICLE}</article>{AFTER}</body></html>"), (2, "u", f"{head}{AROUND}<article>{ARTICLE}"), (3, None, None), (4, "u", ""),
        (5, "u", f"{head}<article><header>{ARTICLE}</header><div class='ad'>Buy this now</div><p>End &lt;tag&gt; &#233;&nbsp;x</p></article>{AFTER}"), (None, "u", f"<article>{ARTICLE}</article>"),
    ]
    df = spark.createDataFrame([(*p, "x", 0) for p in pages], "page_id long, url string, html string, text string, words int")
    got = {r.page_id: r.text for r in main_text.extract_main_text(df).collect()}
    assert got == {1: TEXT, 2: TEXT, 3: "", 4: "", 5: TEXT + "\nEnd <tag> é x", None: TEXT}
    assert main_text.extract_main_text(df.limit(0)).collect() == []


LONG = "Some words of an article that go on for so long that nobody takes them for a menu or a caption of any kind at all."
ODD_PAGES = [
    ("<article><p>a\u200bb \ufeffc\u00a0d\u2003e</p></article>", "a\u200bb \ufeffc d e"),
    (f"<article><p>{LONG} <a title=it's href=x>two</a> three</p></article>", f"{LONG} two three"),
    (f"<article><p>{LONG} <a title=\"a > b\" href='c > d'>two</a></p></article>", f"{LONG} two"),
    (f'<div class="content no-sidebar"><p>{LONG}</p></div>', LONG),
    (f'<div id="main" class="has-sidebar"><p>{LONG}</p></div>', LONG),
    (f'<div class="post related-off"><p>{LONG}</p></div>', LONG),
    (f'<article><section id="advertising-history"><p>{LONG}</p></section></article>', LONG),
    (f"<form action=x><nav><a href=y>Menu</a></nav><article><p>{LONG}</p><form><p>{LONG}</p></form></article><p>{LONG}</p></form>", LONG),
    (f"<article><p>{LONG} one<script>var x = '</p>';</script> two</p></article>", f"{LONG} one two"),
    (f"<article><!--><p>{LONG}</p><!---><p>Two.</p><!-- <p>no</p> --!><p>Three.</p></article>", f"{LONG}\nTwo.\nThree."),
    (f'<article><p>{LONG}</p><div class="comment-text"><p>{LONG}</p></div><div class="siteFooter">x</div></article>', LONG),
    (f'<article><p data-class="ad">{LONG}</p><p class="ad-slot">Buy</p></article>', LONG),
]


@pytest.mark.parametrize("page,text", ODD_PAGES)
def test_odd_pages(page, text):
    assert main_text.main_text(page, main_text.trained_tree()) == text


@pytest.mark.parametrize("piece", ['<a b="', "<a b='\"", "<a b=", "<p ", "<!-", "<script>", "<div><p>", "</", "&amp", "='", "<svg>"])
def test_hostile_pages_take_linear_time(piece):
    page = f"<article>{piece * (500_000 // len(piece))}"
    start = time.process_time()
    main_text.main_text(page, main_text.trained_tree())
    assert time.process_time() - start < 10


def test_pages_without_markup_that_tells():
    long = "Some words of the text go on for quite a while, so that the paragraph has more than two dozen words in it and is taken for text. " * 2
    page = f"<div><a href=a>One</a> <a href=b>Two</a></div><div><p>{long}</p><p>Short one.</p><p>{long}</p></div><div><a href=c>More links here</a></div><div>Imprint</div>"
    assert main_text.main_text(page, main_text.trained_tree()) == f"{long.strip()}\nShort one.\n{long.strip()}"


def test_articles_of_the_table(spark):
    """In these tables the article element holds the main text; its blocks are split here by another way."""
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "html")
    for r in QUERIES["op2_main_text"](spark, FOLDER).join(pages, "page_id").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(b)).strip() for b in re.split(r"</?(?:p|h1|br)>", re.sub(r"</?b>", "", article))]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


# Pipeline


def test_pipeline_stages_and_their_decisions(spark):
    """Each stage on the small table, against code that shares nothing with it but the network."""
    import corpus_pipeline as p
    from public_tokenizers import path
    from test_documents import jaccard_brute
    from tokenizers import Tokenizer
    from weirgate.llm import mixing, toxicity
    from weirgate.llm.recurrent import Scorer

    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    steps = {}
    for name, stage in p.STAGES:
        before = docs
        docs = p.materialise(stage(spark, docs, FOLDER))
        steps[name] = (before.collect(), docs.collect(), before)
        if name != "bpe":
            assert docs.columns == before.columns
    ids = lambda rows: sorted(r.doc_id for r in rows)
    before, after, df = steps["toxicity"]
    scorer = Scorer(pickle.loads(toxicity.train_model(df.select("doc_id", "text"), labels)))
    assert ids(after) == ids(r for r in before if scorer.score([r.text])[0] < 0.5) and len(after) < len(before)
    before, after, _ = steps["exact_dedup"]
    texts = {}
    for r in before:
        key = re.sub("[A-Z]", lambda m: m[0].lower(), r.text)
        texts[key] = max(texts.get(key, -1), r.doc_id)
    assert ids(after) == sorted(texts.values())
    before, after, _ = steps["jaccard_join"]
    assert ids(after) == sorted({c for _, _, c in jaccard_brute([(r.doc_id, r.text) for r in before], 5, 80)})
    before, after, df = steps["mixing"]
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)
    sizes = {}
    for r in before:
        sizes[r.source] = sizes.get(r.source, 0) + len(words(r.text))
    got, source = {}, {r.doc_id: (r.source, words(r.text)) for r in before}
    for r in after:
        assert r.source == source[r.doc_id][0] and r.n_chars == len(r.text)
        own = iter(source[r.doc_id][1])
        assert all(w in own for w in words(r.text))  # in the document's order
        got[r.source] = got.get(r.source, 0) + len(words(r.text))
    for s, want in brute_targets(sizes).items():
        assert abs(got.get(s, 0) - want) <= 3 * mixing.BLOCK_WORDS  # a shorter last block in each of three passes
    before, after, _ = steps["bpe"]
    library = Tokenizer.from_file(str(path("word_bpe_49k.json")))
    library.no_truncation(), library.no_padding()
    want = []
    for r in before:
        found = library.encode(r.text, add_special_tokens=False).ids
        packed = np.array(found, "<u4").tobytes()
        want.append((r.doc_id, len(found), hashlib.sha256(packed).hexdigest(), hashlib.sha256(library.decode(found, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, after)) == sorted(want)
    assert sorted(map(tuple, p.run(spark, FOLDER).collect())) == sorted(want)


def brute_targets(sizes):
    """Targets by raising capped sources one by one."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    capped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3 * sizes[s] for s in over}


def test_stages_follow_rows_with_null_and_repeated_ids(spark, monkeypatch):
    """Nulls, repeated ids, clashing columns and empty tables through every stage but the network's training."""
    import corpus_pipeline as p
    from weirgate.llm import toxicity

    prose = " ".join(f"w{i % 37} v{i % 11}" for i in range(60))
    rows = [(1, prose, "a"), (1, "BAD " + prose[::-1], "a"), (None, "BAD one", "a"), (None, "fine words here " * 40, None), (None, None, "b"), (2, prose.upper(), "b"), (3, "", "b"), (4, "z " * 40 + "q", "b"), (2, "another text of id two", "b")]
    schema = "doc_id long, text string, source string, _size int, _words int, _ranges int, row_no int, score double, sha int, th int, n_chars long"
    docs = spark.createDataFrame([(i, t, s, 1, 2, 3, 4, 0.5, 6, 7, len(t or "")) for i, t, s in rows], schema)
    monkeypatch.setattr(toxicity, "train_model", lambda *a: pickle.dumps(1.0))
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.keep_clean(docs, labels).count() == 0
    bad = lambda model: lambda text: F.when(text.startswith("BAD") if not isinstance(text, str) else F.col(text).startswith("BAD"), 1.0).otherwise(0.0)
    monkeypatch.setattr(toxicity, "toxicity_score", bad)
    plain = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
    clean = toxicity.keep_clean(docs.fillna("", ["text"]), labels)
    want = [(i, t or "") for i, t, _ in rows if not (t or "").startswith("BAD")]
    assert plain(clean) == sorted(want, key=repr) and clean.columns == docs.columns
    once = p.exact_dedup_stage(spark, clean, FOLDER)
    assert once.columns == docs.columns
    gone = [(1, prose), (None, "")]  # prose.upper() has the larger id; of the empty texts id 3 stays
    assert plain(once) == sorted([w for w in want if w not in gone], key=repr)
    near = p.jaccard_stage(spark, once, FOLDER)
    assert plain(near) == plain(once) and near.columns == docs.columns
    mixed = p.mixing_stage(spark, p.materialise(near), FOLDER)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} >= {None, 2, 4}
    encoded = p.encoding_stage(spark, p.materialise(mixed), FOLDER)
    assert encoded.count() == mixed.count()
    for stage in (p.exact_dedup_stage, p.jaccard_stage, p.mixing_stage, p.encoding_stage):
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
