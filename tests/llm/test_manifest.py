"""The Merkle manifest against a plain one, over small superblocks and odd rows."""

import hashlib
import random
import zlib

import pytest

from weirgate.llm import manifest


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def parents(nodes):
    return [h("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]


def climb(nodes, at):
    """Siblings with their side, up to the root of ``nodes``, and the root."""
    steps = []
    while len(nodes) > 1:
        run = nodes[at - at % 3 : at - at % 3 + 3]
        steps.append((run[: at % 3], run[at % 3 + 1 :]))
        nodes, at = parents(nodes), at // 3
    return steps, nodes[0]


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for leaves in by_source.values():
        leaves.sort(key=lambda x: x[:3])
    subroots = [climb([x[2] for x in by_source[s]], 0)[1] for s in names]
    found = []
    for i, s in enumerate(names):
        nodes = [x[2] for x in by_source[s]]
        for at, (_, _, own, r) in enumerate(by_source[s]):
            local, subroot = climb(nodes, at)
            top, root = climb(subroots, i)
            node = own
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None:
                node = leaf(r, r["text"].replace("\n", ""))
            for left, right in local + top:
                node = h("".join([*left, node, *right]))
            proof = h("".join("".join(left + right) for left, right in local + top))
            found.append((r["doc_id"], own, subroot, root, proof, node, node == root))
    return sorted(found, key=repr)


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_equals_a_plain_one(spark, odd_documents, levels):
    rng = random.Random(levels)
    rows = [r.asDict() for r in odd_documents.collect()]
    for source, n in (("big", 250), ("", 27), ("three", 3), ("Z", 28), ("é", 2), ("one", 1), (None, 40)):
        for i in rng.sample(range(2000), n):
            rows.append({"doc_id": i, "source": source, "lang": rng.choice([None, "en"]), "n_chars": rng.choice([None, i]), "text": rng.choice([None, "", "a\nb", "line\r\n", f"t {i}"])})
    rows += [dict(rows[-1]), {**rows[-1], "doc_id": (1 << 62) + 1}]
    schema = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos int, node string"
    docs = spark.createDataFrame([tuple(r.get(c) for c in ("doc_id", "source", "lang", "n_chars", "text")) + ("x", 1, None) for r in rows], schema)
    rows = [{**r, "n_chars": None if r["n_chars"] is None else int(r["n_chars"])} for r in rows]
    assert sorted((tuple(r) for r in manifest.merkle_manifest(docs, levels).collect()), key=repr) == brute(rows)


def test_lone_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", "en", 3, "x")], "doc_id long, source string, lang string, n_chars long, text string")
    (row,) = manifest.merkle_manifest(docs).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.proof_sha256 == h("") and row.verified
    assert manifest.merkle_manifest(docs.limit(0)).collect() == []
