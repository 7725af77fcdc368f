import random

import pytest
from pyspark.sql import functions as F

from weirgate.operators import components
from weirgate.operators import dedup as dd
from weirgate.operators.components import connected_components
from weirgate.operators.skew import attach_group_value, hot_threshold

SMALL = dd.MinHashConfig(buckets=20, rows=5)


def union_find(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("seed", range(2))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(1000 + i, 1001 + i) for i in range(60)]
    edges = [(a, b) for a, b in edges if a != b]
    found = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.component for r in found} == union_find(edges)
    assert len(found) == len({r.node for r in found})


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_hot_groups_get_the_same_values(spark):
    rows = spark.range(3000).select((F.col("id") % 7 * (F.col("id") % 2)).alias("k"), F.col("id").alias("v"))
    groups = rows.groupBy("k").agg(F.min("v").alias("m"), F.count("*").alias("n")).where("k != 3")
    results = []
    for hot in (10, 10**9):
        joined = attach_group_value(rows, groups, ["k"], "m", "n", hot)
        results.append(sorted((r.k, r.v, r.m) for r in joined.select("k", "v", "m").collect()))
    assert results[0] == results[1] and len(results[0]) == 3000 - rows.where("k = 3").count()


@pytest.fixture
def plain_joins(spark):
    """Nothing but the operator itself may spread a key."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_groups_leave_before_the_shuffle(spark, tmp_path, plain_joins):
    """A stored key with nine tenths of the rows; the value is used, so the join stays."""
    made = spark.range(80_000).select(F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    made.repartition(8).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    groups = rows.groupBy("k").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    joined = attach_group_value(rows, groups, ["k"], "m", "n", 10_000)
    sizes = [r["count"] for r in joined.where("m >= 0").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 80_000 and max(sizes) <= 2 * 80_000 / 8


def test_hot_rows_are_broadcast_in_every_operator(spark, tmp_path, plain_joins, monkeypatch):
    from weirgate.operators import components, dedup, urlclf

    for module in (components, dedup, urlclf):
        monkeypatch.setattr(module, "hot_threshold", lambda total: 5)
    sigs = spark.range(60).select(F.col("id").alias("doc_id"), F.lit("").alias("scope"), F.array(F.lit(1), F.col("id")).alias("bands"))
    sigs.write.parquet(str(tmp_path / "sigs"))
    sigs = spark.read.parquet(str(tmp_path / "sigs"))
    found = dedup.bucket_matches(sigs, dd.MinHashConfig(buckets=2, rows=1))
    assert sorted(tuple(r) for r in found.collect()) == [(i, 0) for i in range(1, 60)]
    texts = spark.range(40).select("id", F.concat(F.lit("common "), F.col("id")).alias("t"))
    edges = found.select(F.col("doc_id").alias("u"), F.col("first_id").alias("v"))
    for df in (found, components._with_smallest(edges, 60), dedup.clusters_of(found), urlclf.tfidf(texts, "id", "t", F.lit(True))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") >= 2 and "Union" in plan


def test_hot_threshold_bounds_the_broadcast():
    for total in (0, 10**5, 10**9, 10**13):
        assert total / hot_threshold(total) <= 20_000


def _text(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def _documents(spark):
    rng = random.Random(5)
    rows = []
    for i in range(12):
        base = _text(rng, 120)
        rows += [(10 * i, base, f"s{i % 2}"), (10 * i + 1, base.upper() + "!", f"s{i % 2}"), (10 * i + 2, base + " extra", "s0")]
        rows.append((10 * i + 3, _text(rng, 100), "s1"))
    rows += [(900, "too short", "s0"), (901, "too short", "s1"), (902, "also short", "s0"), (903, None, "s0"), (904, None, "s0"), (905, "", "s0")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def _clusters(df):
    return sorted((r.doc_id, r.cluster_id, r.cluster_size, r.keep) for r in df.collect())


def test_clusters_find_copies_and_near_copies_only(spark):
    found = {r.doc_id: r for r in dd.duplicate_clusters(_documents(spark), SMALL).collect()}
    for i in range(12):
        assert {found[10 * i + k].cluster_id for k in range(3)} == {10 * i}
        assert found[10 * i].keep and not found[10 * i + 1].keep and found[10 * i].cluster_size == 3
        assert 10 * i + 3 not in found
    assert found[901].cluster_id == 900 and 902 not in found and 903 not in found and 905 not in found


def test_clusters_do_not_depend_on_partitioning(spark):
    docs = _documents(spark)
    assert _clusters(dd.duplicate_clusters(docs.repartition(2), SMALL)) == _clusters(dd.duplicate_clusters(docs.repartition(16), SMALL))


def test_default_configuration_finds_very_similar_texts(spark):
    rng = random.Random(9)
    words = [f"w{rng.randrange(5000)}" for _ in range(400)]
    near = words[:200] + ["changed"] + words[201:]  # shingle similarity about 0.975
    far = words[:200] + [f"x{i}" for i in range(200)]  # about a third
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate((words, near, far))], "doc_id long, text string")
    assert _clusters(dd.duplicate_clusters(docs)) == [(0, 0, 2, True), (1, 0, 2, False)]


def test_a_third_of_all_documents_with_one_text(spark):
    rng = random.Random(2)
    same = _text(rng, 40)
    docs = spark.createDataFrame([(i, same if i % 3 == 0 else _text(rng, 40)) for i in range(600)], "doc_id long, text string")
    found = dd.duplicate_clusters(docs, SMALL).collect()
    assert {r.doc_id for r in found} == set(range(0, 600, 3)) and sum(r.keep for r in found) == 1


def test_a_third_of_all_documents_nearly_the_same(spark, monkeypatch):
    rng = random.Random(6)
    words = _text(rng, 150).split()
    near = lambda i: " ".join([*words[: i % 140], f"only{i}", *words[i % 140 + 1 :]])
    docs = spark.createDataFrame([(i, near(i) if i % 3 == 0 else _text(rng, 60)) for i in range(300)], "doc_id long, text string")
    plain = _clusters(dd.duplicate_clusters(docs, SMALL))
    for module in (dd, components):  # every group of more than 20 rows takes the hot path
        monkeypatch.setattr(module, "hot_threshold", lambda total: 20)
    assert _clusters(dd.duplicate_clusters(docs, SMALL)) == plain
    assert {c[0] for c in plain} == set(range(0, 300, 3)) and {c[1] for c in plain} == {0}


def test_scope_keeps_copies_of_other_sources(spark):
    rng = random.Random(4)
    t = _text(rng, 50)
    docs = spark.createDataFrame([(1, t, "a"), (2, t, "a"), (3, t, "b"), (4, _text(rng, 50), "b")], "doc_id long, text string, source string")
    assert _clusters(dd.duplicate_clusters(docs, SMALL, scope="source")) == [(1, 1, 2, True), (2, 1, 2, False)]
    both = {r.doc_id: r.stage for r in dd.dedup_by_scope_then_all(docs, "source", SMALL).collect()}
    assert both == {1: None, 2: "dedup_scope", 3: "dedup_all", 4: None}
    marked = dd.mark_duplicates(docs, dd.duplicate_clusters(docs, SMALL))
    assert sorted(r.doc_id for r in marked.where("keep").collect()) == [1, 4]


def test_chain_joins_documents_that_share_no_bucket(spark):
    matches = spark.createDataFrame([(2, 1), (3, 2), (4, 3), (9, 8)], "doc_id long, first_id long")
    assert _clusters(dd.clusters_of(matches)) == [(1, 1, 4, True), (2, 1, 4, False), (3, 1, 4, False), (4, 1, 4, False), (8, 8, 2, True), (9, 8, 2, False)]


# Contraction, sketch and stored signatures


@pytest.mark.parametrize("seed", range(3))
def test_spanning_stars_equal_union_find(seed, monkeypatch):
    import numpy as np
    import pyarrow as pa

    from weirgate.functions import kernels

    rng = np.random.default_rng(seed)
    u, v = rng.integers(0, 400, 500), rng.integers(0, 400, 500) + 200 * (seed > 0)
    want = {x: r for x, r in union_find(zip(u.tolist(), v.tolist())).items() if x != r}
    assert dict(zip(*(x.tolist() for x in kernels.spanning_stars(u, v)))) == want
    monkeypatch.setattr(kernels, "EDGES", 40)
    batches = [pa.record_batch([pa.array(u[i : i + 30]), pa.array(v[i : i + 30])], ["u", "v"]) for i in range(0, 500, 30)]
    stars = [e for b in kernels.contracted(iter(batches)) for e in zip(*(c.to_pylist() for c in b.columns))]
    assert len(stars) < 500 and {x: r for x, r in union_find(stars).items() if x != r} == want


def test_a_long_chain_takes_fewer_rounds_and_edges(spark, monkeypatch):
    chain = spark.range(100_000).select(F.col("id").alias("v"), (F.col("id") + 1).alias("u"))
    written, plain = [], components.materialise

    def counting(df):
        out = plain(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(components, "materialise", counting)
    found = connected_components(chain)
    assert found.where("component <> 0").count() == 0 and found.count() == 100_001
    rounds, edges = len(written), sum(written)
    written.clear()
    monkeypatch.setattr(components, "contract", lambda df: df.where("u <> v").select("u", "v"))
    assert connected_components(chain).where("component <> 0").count() == 0
    assert rounds <= len(written) / 2 and edges <= sum(written) / 2


def test_a_sketch_loses_no_shared_band_and_drops_most_others(spark):
    rng = random.Random(3)
    rows = [(i, "=a" if i % 2 else "=b", [rng.randrange(1 << 62) for _ in range(20)]) for i in range(2000)]
    rows += [(5000 + i, s, [b if j % 5 == 0 else rng.randrange(1 << 62) for j, b in enumerate(bands)]) for i, s, bands in rows[:100]]
    sigs = spark.createDataFrame(rows, "doc_id long, scope string, bands array<long>").repartition(7)
    long = dd.long_bands(sigs)
    shared = long.groupBy("scope", "bucket", "band_hash").count().where("count > 1").drop("count")
    kept = {tuple(r) for r in dd.shared_bands(sigs, 42_000).collect()}
    must = {tuple(r) for r in long.join(shared, ["scope", "bucket", "band_hash"]).select("doc_id", "scope", "bucket", "band_hash").collect()}
    assert len(must) == 800 and must <= kept and len(kept) < 0.3 * 42_000
    assert kept <= {tuple(r) for r in long.select("doc_id", "scope", "bucket", "band_hash").collect()}


def test_most_bands_of_the_table_are_not_shuffled(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    signed = dd.sign(docs)
    total = signed.bands.count() * 450
    assert dd.shared_bands(signed.bands, total).count() < 0.1 * total


def test_texts_are_shuffled_once(spark, plain_joins, monkeypatch, tmp_path):
    """Exchanges that carry text, over all plans of both passes: one, the bucketed write."""
    from weirgate import session

    _documents(spark).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    plans = []

    def wrapped(f):
        def call(df, *keys, **kw):
            rows = df.repartition(8, *keys) if keys and not kw.get("placed") else df
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
            return f(df, *keys, **kw)

        return call

    for name in ("materialise", "materialise_by"):
        monkeypatch.setattr(dd, name, wrapped(getattr(session, name)))
    out = dd.dedup_by_scope_then_all(docs, "source", SMALL)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    carrying = []
    for plan in plans:
        lines = plan.split("\n")
        for i, line in enumerate(lines):
            if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line:
                depth = len(line) - len(line.lstrip(" :+-"))
                below = []
                for x in lines[i + 1 :]:
                    if len(x) - len(x.lstrip(" :+-")) <= depth:
                        break
                    below.append(x)
                if any("Scan parquet" in x and "text" in x for x in below) and not any("sha2" in x or "Aggregate" in x for x in below):
                    carrying.append(line)
    assert len(carrying) == 1, carrying
    assert "doc_id" in carrying[0] and out.count() == 54


def test_a_second_crawl_is_matched_without_hashing_the_first(spark, monkeypatch):
    docs = _documents(spark)
    old, new = docs.where("source = 's0'"), docs.where("source = 's1'")
    stored = dd.sign(old, SMALL)
    read = []
    monkeypatch.setattr(dd, "signatures", lambda rows, *a, f=dd.signatures: read.append(sorted(r.doc_id for r in rows.collect())) or f(rows, *a))
    verdicts, grown = dd.dedup_new_crawl(new, stored, SMALL)
    got = {r.doc_id: (r.cluster_id, r.keep) for r in verdicts.collect()}
    assert set(got) == {r.doc_id for r in new.collect() if r.text is not None} and not set(read[0]) & {r.doc_id for r in old.collect()}
    clusters = {r.doc_id: r.cluster_id for r in dd.duplicate_clusters(docs, SMALL).collect()}
    with_old = {clusters.get(r.doc_id) for r in old.collect()} - {None}
    first = {}
    for i in sorted(got):
        first.setdefault(clusters.get(i), i)
    want = {i: (clusters.get(i), clusters.get(i) is None or (clusters[i] not in with_old and first[clusters[i]] == i)) for i in got}
    assert got == want
    assert grown.digests.count() == stored.digests.count() + len(got)
    again, _ = dd.dedup_new_crawl(spark.createDataFrame([(9999, "too short")], "doc_id long, text string"), grown, SMALL)
    assert [tuple(r) for r in again.collect()] == [(9999, 900, False)]


@pytest.mark.parametrize("held, tasks", [(1 << 24, 3), (700, 3), (150, 40)])
def test_slices_give_exactly_the_shared_bands(held, tasks, monkeypatch):
    """Whatever a task holds, one bucket's documents dealt to several slices included; ids of any kind."""
    import numpy as np
    import pyarrow as pa

    from weirgate.functions import kernels

    monkeypatch.setattr(kernels, "SLICE_BANDS", held)
    monkeypatch.setattr(kernels, "SLICE_ROWS", 100)
    monkeypatch.setattr(kernels, "CHUNK_ROWS", 64)
    monkeypatch.setattr(kernels, "OUT_ROWS", 50)
    rng = np.random.default_rng(4)
    bands = rng.integers(-(1 << 63), 1 << 63, (400, 12))
    bands[210:270, :5] = bands[:60, :5]  # same scopes: 210 is a multiple of 21
    bands[300:, 7] = 9  # a band that a quarter of the documents have
    scope = [f"={i % 3}" if i % 7 else "" for i in range(400)]
    ids = [f"d{i}" for i in range(400)]
    sigs = pa.record_batch([pa.array(ids), pa.array(scope), pa.array(bands.tolist())], ["doc_id", "scope", "bands"])
    parts = [sigs.slice(i, 150) for i in range(0, 400, 150)]
    rows = pa.Table.from_batches([r for p in parts for r in kernels.slice_bands(iter([p]), 4800, tasks)]).sort_by("slice")
    width, dealt = kernels.slicing(4800, 12, tasks)
    assert rows["slice"].to_pylist()[-1] < -(-12 // width) * dealt and (dealt > 1) == (held == 150)
    assert max(len(d) for d in rows["docs"]) <= 64
    groups = {}
    for i, b in enumerate(bands.tolist()):
        for j, h in enumerate(b):
            groups.setdefault((scope[i], j, h), []).append(ids[i])
    want = sorted((d, s, j, h) for (s, j, h), found in groups.items() if len(found) > 1 for d in found)
    found = kernels.repeated_bands(iter(rows.to_batches(max_chunksize=5)), 4800, tasks, 12)
    assert sorted(t for b in found for t in zip(*(c.to_pylist() for c in b.columns))) == want and len(want) > 100


def test_only_shared_bands_become_rows(spark):
    rng = random.Random(8)
    rows = [(i, "", [rng.randrange(1 << 62) for _ in range(40)]) for i in range(3000)]
    rows[7] = (7, "", rows[5][2][:20] + rows[7][2][20:])
    sigs = spark.createDataFrame(rows, "doc_id long, scope string, bands array<long>").repartition(5)
    found = sorted(tuple(r) for r in dd.shared_bands(sigs, 120_000).collect())
    assert found == sorted((i, "", j, rows[5][2][j]) for i in (5, 7) for j in range(20))
    assert dd.shared_bands(sigs.where("false"), 0).count() == 0


def test_shingles_and_bands_equal_the_definition():
    import numpy as np
    import pyarrow as pa

    from weirgate.functions.kernels import MinHasher, hash60, shingle_hashes

    words = "çok a b ş a b c çok a b ş".split()
    want = {hash60(" ".join(words[i : i + 3])) for i in range(len(words) - 2)}
    assert shingle_hashes(" ".join(words).encode(), 3).tolist() == sorted(want)
    assert [len(shingle_hashes(t.encode(), n)) for t, n in (("", 1), ("a", 1), ("a b", 3), ("a b c", 3))] == [0, 1, 0, 1]
    many = np.unique(np.random.default_rng(1).integers(0, 1 << 60, 1500, dtype=np.uint64))
    for buckets, rows in ((14, 8), (300, 20)):  # both ways to take the minimum
        hasher = MinHasher(buckets, rows, 1)
        low = np.min([hasher.mul * x + hasher.add for x in many], axis=0)
        assert (hasher.bands(many) == (low.reshape(buckets, rows) * hasher.mix).sum(axis=1, dtype=np.uint64).view(np.int64)).all()
    hasher = MinHasher(14, 8, 1)
    found = hasher.batch(pa.array(["a b", None, " ".join(words)]), 3).to_pylist()
    assert found[:2] == [None, None] and found[2] == hasher.bands(np.array(sorted(want), np.uint64)).tolist()


def test_small_components_take_few_tasks_and_no_round_on_stars(spark, monkeypatch):
    written, plain = [], components.materialise

    def counting(df):
        out = plain(df)
        written.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(components, "materialise", counting)
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stars = spark.range(200).select((F.col("id") % 10).alias("u"), (F.col("id") + 10).alias("v"))
        assert connected_components(stars).where("component <> (node - 10) % 10 AND node >= 10").count() == 0
        assert len(written) == 1
        written.clear()
        chain = spark.range(0, 60, 1, 12).select(F.col("id").alias("v"), (F.col("id") + 1).alias("u")).repartition(12, "u")
        found = connected_components(chain)
        assert found.where("component <> 0").count() == 0 and found.count() == 61
        assert max(written[1:]) <= components.TASKS
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
