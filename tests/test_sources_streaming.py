import pytest
from pyspark.sql import functions as F

from weirgate.operators.worklist import WORKLIST_SCHEMA
from weirgate.plans.corpus import STAGES, corpus
from weirgate.operators.dedup import MinHashConfig
from weirgate.operators import funnel
from weirgate.registry.fixtures import encode_record, write_archives
from weirgate.sources import files, warc
from weirgate.streaming import fetch


def test_slices(spark, tmp_path):
    records = [
        encode_record("u", "<p>ş</p>"),
        encode_record("u", "asked", "request") + encode_record("u", "answered"),
        encode_record("u", "only asked", "request"),
        encode_record("u", "x"),
    ]
    bad = warc.gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 21\r\n\r\nHTTP/1.1 200 OK\r\n\r\n\xff\xfe")
    records.append(bad)
    (tmp_path / "a.warc.gz").write_bytes(b"".join(records))
    starts = [sum(map(len, records[:i])) for i in range(len(records))]
    rows = [(i, "u", "a.warc.gz", s, len(r)) for i, (s, r) in enumerate(zip(starts, records))]
    rows += [(10, "u", "missing.warc.gz", 0, 10), (11, "u", "a.warc.gz", 10**9, 10), (12, "u", "a.warc.gz", 3, 10)]
    df = spark.createDataFrame(rows, "id long, url string, filename string, offset long, length long")
    found = {r.id: r.raw for r in warc.read_slices(df, str(tmp_path)).collect()}
    assert found == {0: "<p>ş</p>", 1: "answered", 2: None, 3: "x", 4: None, 10: None, 11: None, 12: None}


def test_a_root_without_a_scheme_is_taken_as_spark_takes_it(spark, tmp_path):
    """On a cluster, too: no session is refused, and its executors get the folder with its scheme."""
    from pyarrow import fs

    root = tmp_path / "a folder, 100%"
    found = warc.qualified_root(spark, str(root))
    assert found.startswith("file:/") and warc.qualified_root(spark, found) == found
    system, path = warc.open_root(found)
    assert isinstance(system, fs.LocalFileSystem) and path == str(root)
    pages = spark.createDataFrame([(1, "u", "<p>ş</p>", "f"), (2, "v", None, "f")], "id long, url string, raw string, filename string")
    stored = write_archives(pages, str(root)).collect()
    requests = spark.createDataFrame(stored, "id long, url string, filename string, offset long, length long")
    assert {r.id: r.raw for r in warc.read_slices(requests, str(root)).collect()} == {1: "<p>ş</p>", 2: None}


def test_chunked_and_compressed_bodies():
    assert warc.http_body(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n2;x=1\r\nde\r\n0\r\n\r\n") == b"abcde"
    packed = warc.gzip.compress(b"page")
    assert warc.http_body(b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\n" + packed) == b"page"


def test_json_lines_keep_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "a\nb"), (2, "v", None)], "id long, url string, raw string")
    for archive in (False, True):
        path = str(tmp_path / f"p{archive}")
        files.write_jsonl(df, path, archive)
        assert sorted(tuple(r) for r in files.read_pages(spark, path).collect()) == [(1, "u", "a\nb"), (2, "v", None)]
        assert '"raw":null' in "".join(r.value for r in spark.read.text(path).collect())


def test_rejects_go_to_their_own_folders(spark, tmp_path):
    df = spark.createDataFrame([(1, "quality", "gopher_short_doc"), (2, "fineweb", "x"), (3, None, None)], "id long, stage string, reason string")
    files.write_rejected(df, str(tmp_path / "r"))
    assert [(r.id, r.stage, r.reason) for r in spark.read.json(str(tmp_path / "r")).collect()] == [(1, "quality", "gopher_short_doc")]


def test_merge_files(spark, tmp_path):
    for i, cols in enumerate((["a"], ["a", "b"])):
        spark.range(3).select(*[(F.col("id") + i).alias(c) for c in cols]).write.parquet(str(tmp_path / f"f{i}"))
    files.merge_files(spark, str(tmp_path / "f*"), str(tmp_path / "all"))
    assert spark.read.parquet(str(tmp_path / "all")).where("b IS NULL").count() == 3


def _run_dirs(tmp_path):
    return f"{tmp_path}/list", f"{tmp_path}/out", f"{tmp_path}/checkpoint"


def _write_list(spark, path, n, per_file):
    rows = spark.range(1, n + 1).select("id", F.concat(F.lit("u"), "id").alias("url"), F.lit("f").alias("filename"), F.lit(0).alias("offset"), F.lit(1).alias("length"))
    full = rows.select(*[F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in WORKLIST_SCHEMA])
    fetch.write_chunks(full.coalesce(1), path, chunk_size=per_file)


def _fetch_even(requests):
    return requests.select("id", "url", F.when(F.col("id") % 2 == 0, F.lit("<p>")).alias("raw"))


def test_a_failed_batch_loses_and_doubles_nothing(spark, tmp_path):
    listed, out, checkpoint = _run_dirs(tmp_path)
    _write_list(spark, listed, 10, 4)
    calls = []

    def flaky(requests):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("archive went away")
        return _fetch_even(requests)

    with pytest.raises(Exception):
        fetch.run_fetch(spark, listed, out, checkpoint, flaky, batch_bytes=4)
    assert len(calls) == 2
    fetch.run_fetch(spark, listed, out, checkpoint, flaky, batch_bytes=4)
    assert len(calls) == 4
    log = sorted((r.id, r.value) for r in fetch.read_log(spark, out).collect())
    assert log == [(i, i % 2 == 0) for i in range(1, 11)]
    assert sorted(r.id for r in fetch.read_fetched(spark, out).collect()) == [2, 4, 6, 8, 10]


def test_row_limit_and_resume(spark, tmp_path):
    listed, out, checkpoint = _run_dirs(tmp_path)
    _write_list(spark, listed, 10, 4)
    assert fetch.run_fetch(spark, listed, out, checkpoint, _fetch_even, batch_bytes=4, max_rows=4) == 4
    assert fetch.run_fetch(spark, listed, out, checkpoint, _fetch_even) == 6
    assert sorted(r.id for r in fetch.read_log(spark, out).collect()) == list(range(1, 11))


def test_batches_follow_bytes_and_read_no_page_back(spark, tmp_path):
    listed, out, checkpoint = _run_dirs(tmp_path)
    rows = spark.range(1, 41).select("id", F.concat(F.lit("u"), "id").alias("url"), F.lit("f").alias("filename"), F.lit(0).alias("offset"), F.lit(100).alias("length"))
    full = rows.select(*[F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in WORKLIST_SCHEMA])
    fetch.write_chunks(full, listed, chunk_bytes=500)
    files_of_list = spark.read.parquet(listed).groupBy(F.input_file_name()).count().collect()
    assert len(files_of_list) == 8 and max(r["count"] for r in files_of_list) <= 10
    calls = []

    def counting(requests):
        calls.append(requests.count())
        return _fetch_even(requests)

    assert fetch.run_fetch(spark, listed, out, checkpoint, counting, batch_bytes=2000) == 40
    assert 2 <= len(calls) <= 4 and sum(calls) == 40
    plan = fetch.read_log(spark, out)._jdf.queryExecution().executedPlan().toString()
    assert "raw" not in plan and "result" in plan
    assert sorted((r.id, r.value) for r in fetch.read_log(spark, out).collect()) == [(i, i % 2 == 0) for i in range(1, 41)]
    for archive in (False, True):
        fetch.export_pages(spark, out, f"{tmp_path}/json{archive}", archive)
        assert sorted(r.id for r in files.read_pages(spark, f"{tmp_path}/json{archive}").collect()) == list(range(2, 41, 2))


def test_pages_to_corpus_accounts_for_every_page(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select(
        F.col("page_id").alias("id"), F.regexp_extract("url", "^https?://([^/?#]*)", 1).alias("source"), F.lit("en").alias("lang"), F.col("html").alias("raw")
    )
    judged = corpus(pages, minhash=MinHashConfig(14, 8)).withColumn("doc_len", F.length("text").cast("long"))
    assert judged.count() == judged.select("id").distinct().count() == 50
    totals = {r.stage: r for r in funnel.stage_totals(funnel.stage_counts(judged, stages=STAGES)).collect()}
    assert totals["extract"].total == 50
    for before, after in zip(STAGES, STAGES[1:]):
        assert totals[after].total == totals[before].forwarded


def test_files_follow_sizes_not_folders(spark, tmp_path):
    """A large reason is split over files of the advisory size; small ones have one file each."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    counts = {}
    try:
        for rows in (2_000, 40_000):
            verdicts = spark.range(0, rows, 1, 64).select(
                F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 512).alias("text"), F.lit("quality").alias("stage"),
                F.when(F.col("id") % 50 > 0, "common").otherwise(F.concat(F.lit("rare"), F.col("id") % 4)).alias("reason"),
            )
            files.write_rejected(verdicts, str(tmp_path / f"{rows}"))
            sizes = {k: [f.stat().st_size for f in (tmp_path / f"{rows}" / "stage=quality").glob(f"reason={k}/part-*.gz")] for k in ("common", "rare0", "rare2")}
            counts[rows] = {k: len(v) for k, v in sizes.items()}
            assert max(sizes["common"]) < 200_000 and spark.read.json(str(tmp_path / f"{rows}")).count() == rows
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert counts[2_000]["common"] <= 8 and counts[40_000]["common"] >= 4 * counts[2_000]["common"]
    assert all(n["rare0"] <= 2 and n["rare2"] <= 2 for n in counts.values())
