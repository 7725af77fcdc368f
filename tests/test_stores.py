"""Stored logs and key sets: what is read, what a crash leaves, compaction."""

import pytest
from pyspark.sql import functions as F

from weirgate.operators import worklist as wl
from weirgate.operators.seen import SeenKeys
from weirgate.sources.commits import Commits


def _entries(spark, rows):
    schema = "id long, field string, value boolean, t int, batch long"
    return spark.createDataFrame(rows, schema).withColumn("updated", F.timestamp_seconds("t"))


def _latest(log):
    return {r.id: (r._r.value if r._r else None, r._l.value if r._l else None) for r in log.latest().collect()}


def test_log_reads_one_snapshot_and_the_tail(spark, tmp_path):
    log = wl.WorkLog(spark, str(tmp_path / "log"))
    assert _latest(log) == {}
    log.compact()
    log.append(_entries(spark, [(1, "result", True, 10, 0), (2, "result", False, 10, 0)]))
    log.append(_entries(spark, [(1, "label", True, 11, 1)]))
    log.compact()
    log.append(_entries(spark, [(1, "label", False, 12, 2), (3, "result", True, 12, 2), (2, "result", True, 9, 1)]))
    assert _latest(log) == {1: (True, False), 2: (False, None), 3: (True, None)}
    snapshot, tail, last = log.commits.live()
    assert snapshot and len(tail) == 1 and last == 4
    files = log.latest().inputFiles()
    assert {f.rsplit("/", 2)[1] for f in files} == {snapshot.rsplit("/", 1)[1], tail[0].rsplit("/", 1)[1]}
    log.compact()
    assert _latest(log) == {1: (True, False), 2: (False, None), 3: (True, None)} and log.commits.live()[1] == []


def test_a_crash_between_writes_loses_and_doubles_nothing(spark, tmp_path, monkeypatch):
    log = wl.WorkLog(spark, str(tmp_path / "log"))
    log.append(_entries(spark, [(1, "result", True, 10, 0)]))
    plain = Commits.commit

    def crash(*a, **kw):
        raise OSError("gone")

    monkeypatch.setattr(Commits, "commit", crash)
    for write in (log.compact, lambda: log.append(_entries(spark, [(1, "result", False, 20, 1)]))):
        with pytest.raises(OSError):
            write()
        assert _latest(log) == {1: (True, None)}
    monkeypatch.setattr(Commits, "commit", plain)
    (tmp_path / "log" / "_commits" / "000000000002").write_bytes(b"")  # a writer that died inside its commit
    assert _latest(log) == {1: (True, None)}
    log.append(_entries(spark, [(1, "result", False, 20, 1)]))
    assert _latest(log) == {1: (False, None)} and log.commits.live()[2] == 3
    # Entries committed while a snapshot is written are not in it and stay in the tail.
    folder = log.commits.folder()
    snapshot, tail, last = log.commits.live()
    log._merged(snapshot, tail).write.parquet(folder)
    log.append(_entries(spark, [(5, "label", True, 30, 2)]))
    log.commits.commit(folder, snapshot_of=last)
    assert _latest(log) == {1: (False, None), 5: (None, True)}


def test_keys_read_their_slices_only(spark, tmp_path):
    keys = SeenKeys(spark, str(tmp_path / "keys"), "k", slices=8)
    rows = spark.range(400).select(F.concat(F.lit("key"), "id").alias("k"))
    assert keys.missing(rows).count() == 400 and keys.contained(rows).count() == 0
    keys.add(rows.where("substring(k, 4) < 200"))
    keys.add(rows)
    keys.add(rows.unionByName(spark.createDataFrame([(None,), ("key0",)], "k string")))
    assert sorted(r.k for r in keys.table().collect()) == sorted(f"key{i}" for i in range(400))
    one = keys._sliced(rows).where("slice = 3").select("k").unionByName(spark.createDataFrame([("other",)], "k string").where("pmod(xxhash64(k), 8) = 3"))
    for found in (keys.missing(one), keys.contained(one)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [(slice" in plan.replace("isnotnull(slice", "(slice") and "= 3)" in plan
    stored = keys.table([3])._jdf.queryExecution().executedPlan()
    assert keys.table([3]).count() == one.where("k <> 'other'").count() and "PartitionFilters" in stored.toString()
    assert keys.contained(one).count() == one.where("k <> 'other'").count()
    before = len(keys.table().inputFiles())
    keys.compact()
    assert len(keys.table().inputFiles()) <= 8 < before and keys.table().count() == 400
    keys.add(spark.createDataFrame([("new",)], "k string"))
    assert keys.table().count() == 401 and keys.missing(spark.createDataFrame([("new",), ("newer",)], "k string")).collect()[0].k == "newer"


def test_discard_deletes_tables_of_its_own_only(spark, tmp_path):
    from weirgate.session import discard, materialise

    spark.range(10).write.parquet(str(tmp_path / "kept"))
    kept, gone = spark.read.parquet(str(tmp_path / "kept")), materialise(spark.range(10))
    files = gone.inputFiles()
    discard(kept)
    discard(gone)
    assert kept.count() == 10 and files
    with pytest.raises(Exception):
        spark.read.parquet(*files).count()


def test_written_tables_leave_no_shuffle_files(spark):
    from weirgate.session import SHUFFLE_CLEANUP, materialise

    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = store.getAllFiles()
        return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}

    before, setting = files(), spark.conf.get(SHUFFLE_CLEANUP, None)
    table = materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert not files() - before and spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    assert table.count() == 7
