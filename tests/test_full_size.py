"""MinHash at its full size, 450 buckets of 20 rows: bands by plain integers, the rest by SQL on those bands."""

import hashlib
import re

import pytest
from compare import connect, differences

from weirgate import registry
from weirgate.operators import dedup as dd
from weirgate.registry.duplicates import OVER_STORED_BANDS

FOLDER = "/root/testdata/sf0.001"


def plain_bands(text, config):
    """Band hashes in Python's integers, from the definition."""
    h60 = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:15], 16)
    words = re.findall(r"\w*[^\W_]\w*", text.lower())
    shingles = {h60(" ".join(words[i : i + config.shingle_words])) for i in range(len(words) - config.shingle_words + 1)}
    if not shingles:
        return None
    n, top = config.buckets * config.rows, 1 << 64
    low = [min((x * (h60(f"{config.seed}:mul:{i}") | 1) + h60(f"{config.seed}:add:{i}")) % top for x in shingles) for i in range(n)]
    bands = [sum(low[b * config.rows + r] * (h60(f"{config.seed}:mix:{r}") | 1) for r in range(config.rows)) % top for b in range(config.buckets)]
    return [b - top if b >= top >> 1 else b for b in bands]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bands") / "bands")
    registry.QUERIES["minhash_bands"](spark, FOLDER).write.parquet(path)
    con = connect(FOLDER)
    con.execute(f"CREATE TABLE stored_bands AS SELECT * FROM '{path}/*.parquet'")
    return con


def test_bands_equal_plain_integers(spark, stored):
    config = dd.MinHashConfig()
    ascii_only = spark.read.parquet(f"{FOLDER}/documents.parquet").where("length(text) < 900 AND text RLIKE '^[\\\\x00-\\\\x7f]*$'")
    rows = ascii_only.orderBy("doc_id").limit(12).collect()
    for r in rows:
        want = plain_bands(r.text, config)
        got = stored.execute("SELECT band_hash FROM stored_bands WHERE doc_id = ? ORDER BY bucket", [r.doc_id]).fetchall()
        assert [b for (b,) in got] == (want or []), r.doc_id
    assert len(rows) == 12


@pytest.mark.parametrize("name", sorted(OVER_STORED_BANDS))
def test_full_size_queries_equal_sql_over_the_bands(spark, stored, name):
    assert differences(registry.QUERIES[name](spark, FOLDER), stored, OVER_STORED_BANDS[name]) is None
