import gzip
import json

from pyspark.sql import functions as F

from weirgate.functions.text import surt_key
from weirgate.operators import captures as cap
from weirgate.operators import worklist as wl
from weirgate.operators.seen import SeenKeys
from weirgate.sources import cdx as cx


def _cdx_rows(spark, rows):
    full = [(k, u, "text/html", 200, d, 20_000, 0, "f", o) for k, u, d, o in rows]
    schema = "urlkey string, url string, `mime-detected` string, status int, digest string, length long, offset long, filename string, o long"
    return spark.createDataFrame(full, schema)


def test_digest_is_compared_among_urlkey_survivors_only(spark):
    rows = _cdx_rows(spark, [("a", "u1", "d1", 1), ("a", "u2", "d2", 2), ("b", "u3", "d2", 3), ("c", "u4", "d1", 4)])
    kept = cap.unique_captures(rows, [F.asc("o")]).collect()
    assert sorted(r.url for r in kept) == ["u1", "u3"]  # u2 lost by key, so its digest does not remove u3


def test_null_keys_are_one_key(spark):
    rows = _cdx_rows(spark, [(None, "u1", "d1", 1), (None, "u2", "d2", 2), ("b", "u3", "d3", 3)])
    assert sorted(r.url for r in cap.keep_first(rows, ["urlkey"], [F.asc("o")]).collect()) == ["u1", "u3"]


def test_keep_first_limits_each_key_before_the_shuffle(spark):
    rows = _cdx_rows(spark, [("a", "u1", "d1", 1)])
    plan = cap.keep_first(rows, ["urlkey"], [F.asc("o")])._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "Partial" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_usable_captures_nulls_and_bounds(spark):
    rows = [(10_000, "text/html", 200), (10_001, "text/html", None), (None, "text/html", 200), (20_000, None, 200), (20_000, "text/html", 300), (20_000, "text/html", 299)]
    df = spark.createDataFrame(rows, "length long, `mime-detected` string, status int")
    assert sorted((r.length, r.status) for r in cap.usable_captures(df).collect()) == [(10_001, 0), (20_000, 299)]


def test_scan_order_is_files_descending_then_rows(spark, tmp_path):
    for name, urls in (("cc-2023", ["a", "b", "c"]), ("cc-2024", ["d", "e"])):
        with gzip.open(tmp_path / f"{name}.gz", "wt") as f:
            f.writelines(json.dumps({"url": u, "status": "200", "unused": 1}) + "\n" for u in urls)
    scanned = cx.read_cdx(spark, str(tmp_path / "cc-*"))
    assert {r.status for r in scanned.collect()} == {200}
    numbered = wl.number_rows(scanned.repartition(5), cx.newest_first())
    assert [r.url for r in numbered.orderBy("id").collect()] == ["d", "e", "a", "b", "c"]
    assert sorted(r.id for r in numbered.collect()) == [1, 2, 3, 4, 5]


def test_numbers_in_quotes_count_like_bare_ones(spark, tmp_path):
    rows = [("a", "200", "20001"), ("b", 200, 20001), ("c", "404", 20001), ("d", 404, "20001"), ("e", "-", "20001"), ("f", None, "x")]
    with open(tmp_path / "cc.jsonl", "w") as f:
        f.writelines(json.dumps({"url": u, "status": s, "length": n, "offset": "7", "mime-detected": "text/html"}) + "\n" for u, s, n in rows)
    scanned = cx.read_cdx(spark, str(tmp_path / "cc.jsonl"))
    got = {r.url: (r.status, r.length, r.offset) for r in scanned.collect()}
    assert got == {"a": (200, 20001, 7), "b": (200, 20001, 7), "c": (404, 20001, 7), "d": (404, 20001, 7)}
    rejected = {r.url: (r.reason, r.value) for r in cx.read_cdx_rejects(spark, str(tmp_path / "cc.jsonl")).collect()}
    assert rejected == {"e": ("status", "-"), "f": ("length", "x")}
    assert sorted(r.url for r in cap.usable_captures(scanned).collect()) == ["a", "b"]


def test_surt_lookup(spark):
    urls = ["https://www.aa.com.tr/tr/x", "http://aa.com.tr/en", "https://sub.aa.com.tr:8080/tr/", "https://baa.com.tr/tr/", "http://aa.com.tr"]
    df = spark.createDataFrame([(u,) for u in urls], "url string").withColumn("urlkey", surt_key(F.col("url")))
    find = lambda p: {r.url for r in df.where(cx.matches_url(p)).collect()}
    assert find("https://www.aa.com.tr/tr/*") == {urls[0]}
    assert find("*.aa.com.tr") == {urls[0], urls[1], urls[2], urls[4]}
    assert find("https://aa.com.tr/") == {urls[4]}


def _list(spark):
    requests = spark.createDataFrame([(f"u{i}", "f", i, 1, i) for i in range(6)], "url string, filename string, offset long, length long, o long")
    return wl.build_worklist(requests, [F.desc("o")], F.lit("2024-01-01"))


def test_latest_log_entry_wins_per_field(spark):
    listed = _list(spark)
    stamp = lambda d: F.lit(f"2024-01-0{d}").cast("timestamp")
    pages = spark.createDataFrame([(1, "<p>"), (2, None)], "id long, raw string")
    again = spark.createDataFrame([(1, None)], "id long, raw string")
    labels = spark.createDataFrame([(2, True)], "id long, label boolean")
    by_url = spark.createDataFrame([("u3", False), ("nowhere", True)], "url string, label boolean")
    log = (
        wl.result_log(pages, stamp(2), F.lit(0))
        .unionByName(wl.result_log(again, stamp(3), F.lit(1)))
        .unionByName(wl.label_log(labels, stamp(2), F.lit(2)))
        .unionByName(wl.label_log_by_url(listed, by_url, stamp(2), F.lit(3)))
    )
    now = wl.current_worklist(listed, log)
    rows = {r.id: (r.url, r.result, r.label, r.updated.day) for r in now.collect()}
    assert rows == {1: ("u5", False, None, 3), 2: ("u4", False, True, 2), 3: ("u3", None, False, 2), 4: ("u2", None, None, 1), 5: ("u1", None, None, 1), 6: ("u0", None, None, 1)}
    assert [r.id for r in wl.incomplete(now, limit=2, offset=1).collect()] == [4, 5]
    assert [r.id for r in wl.incomplete(now, limit=None).collect()] == [3, 4, 5, 6]
    assert sorted(r.id for r in wl.unlabelled(now).collect()) == [1, 4, 5, 6]
    assert {r.slice for r in wl.run_slices(now, 2).collect()} == {0, 1}


def test_seen_keys_are_stored_once(spark, tmp_path):
    path = str(tmp_path / "seen")
    one = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "key string")
    SeenKeys(spark, path).add(one)
    again = SeenKeys(spark, path)
    again.add(spark.createDataFrame([("b",), ("c",)], "key string"))
    assert sorted(r.key for r in again.table().collect()) == ["a", "b", "c"]
    probe = spark.createDataFrame([("a",), ("z",)], "key string")
    assert [r.key for r in again.missing(probe).collect()] == ["z"] and [r.key for r in again.contained(probe).collect()] == ["a"]


def test_an_unreadable_status_is_no_missing_one(spark, tmp_path):
    """A decimal without a fraction is a number; other texts and broken lines are rejects, and never pass."""
    rows = [("a", "404.0"), ("b", "200.0"), ("c", "-"), ("d", "4.5"), ("e", None), ("f", ""), ("g", " 200 "), ("h", "1e99"), ("i", "99999999999")]
    line = lambda u, s: json.dumps({"url": u, "status": s, "length": 20001, "offset": 7, "mime-detected": "text/html"})
    (tmp_path / "cc.jsonl").write_text("\n".join([*(line(u, s) for u, s in rows), '{"url": "z", "status": 200', "no json", ""]))
    read = cx.read_cdx(spark, str(tmp_path / "cc.jsonl"))
    assert {r.url: r.status for r in read.collect()} == {"a": 404, "b": 200, "e": None, "f": None, "g": 200}
    assert {r.url for r in cap.usable_captures(read).collect()} == {"b", "e", "f", "g"}
    rejected = cx.read_cdx_rejects(spark, str(tmp_path / "cc.jsonl")).collect()
    assert sorted((r.reason, r.value) for r in rejected) == sorted(
        [("status", "-"), ("status", "4.5"), ("status", "1e99"), ("status", "99999999999"), ("line", '{"url": "z", "status": 200'), ("line", "no json")]
    )
