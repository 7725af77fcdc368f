"""Ring shards against a row-by-row placement, and what the law promises."""

import hashlib
import re
import zlib
from collections import Counter

import pytest

from weirgate.llm import sharding
from weirgate.llm.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


def brute(rows, shards, virtual, seed=sharding.SEED):
    """Arcs with more rows first; each gives its rows one by one to the first shard clockwise that has room."""
    number = lambda t, k: int(hashlib.md5(t.encode()).hexdigest()[:k], 16)
    points = sorted((number(f"{seed}/{s}/{r}", 4), s, r) for s in range(shards) for r in range(virtual))
    arcs = {}
    for doc, text in rows:
        key = number(text or "", 15)
        idx = next((i for i, p in enumerate(points) if p[0] >= key >> 44), 0)
        arcs.setdefault(idx, []).append((key, doc is not None, doc, text or ""))
    room = [len(rows) // shards + (s < len(rows) % shards) for s in range(shards)]
    found = []
    for i, waiting in sorted(arcs.items(), key=lambda a: (-len(a[1]).bit_length(), a[0])):
        waiting.sort()
        for shard in dict.fromkeys(points[(i + j) % len(points)][1] for j in range(len(points))):
            while waiting and room[shard]:
                _, _, doc, text = waiting.pop(0)
                room[shard] -= 1
                found.append((shard, i, len(found), doc, text))
    slots, placed = Counter(), []
    for shard, _, _, doc, text in sorted(found, key=lambda f: f[:3]):
        placed.append((doc, len(text.encode()) + 1, zlib.crc32(text.encode()), "rows", shard, slots[shard], None))
        slots[shard] += 1
    return sorted(placed, key=repr)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("shards,virtual", [(16, 8), (5, 3), (1, 1), (40, 2)])
def test_rows_go_as_one_by_one(spark, odd_documents, shards, virtual):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    rows += [(i, f"text {i % 300}") for i in range(100, 700)] + [(i, "a hot text") for i in range(1000, 1400)]
    docs = odd_documents.select("doc_id", "text").unionByName(spark.createDataFrame(rows[odd_documents.count() :], "doc_id long, text string"))
    assert plain(sharding.shard_rows(docs, shards, virtual)) == brute(rows, shards, virtual)


def test_law_and_slots(spark, odd_documents):
    got = sharding.shard_rows(odd_documents, 4).collect()
    by_shard = {s: sorted(r.slot for r in got if r.shard == s) for s in range(4)}
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1
    assert all(slots == list(range(len(slots))) for slots in by_shard.values())
    assert sharding.shard_rows(odd_documents.limit(0)).collect() == []
    with pytest.raises(ValueError):
        sharding.shard_rows(odd_documents, 1 << 10, 1 << 10)


def test_equal_texts_stay_together_and_little_moves(spark):
    docs = spark.range(12_000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('text ', id div 2) END AS text")
    before = {r.doc_id: r.shard for r in sharding.shard_rows(docs).collect()}
    hot = Counter(before[i] for i in before if i % 3 == 0)
    assert len(hot) == 6 and max(hot.values()) == 750  # a third of all rows: it fills five shards and runs on clockwise
    after = {r.doc_id: r.shard for r in sharding.shard_rows(docs.where("doc_id % 100 <> 7")).collect()}
    assert sum(before[i] != s for i, s in after.items()) < 0.2 * len(after)
    grown = {r.doc_id: r.shard for r in sharding.shard_rows(docs, 17).collect()}
    assert sum(before[i] != s for i, s in grown.items()) < 0.5 * len(before)  # by remainders 94 % would move


def test_native_plan(spark):
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", QUERIES["op12_sharding"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString())
