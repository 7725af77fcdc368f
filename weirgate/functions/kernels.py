"""Arrow kernels: the per-document work that column expressions cannot state.

Each takes one Arrow batch and returns one; Spark partitions the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOP_SIZES = (2, 3, 4)
DUP_SIZES = (5, 6, 7, 8, 9, 10)
REPETITION_FIELDS = [f"top_{n}_chars" for n in TOP_SIZES] + [f"dup_{n}_chars" for n in DUP_SIZES]


# Words that are looked at together; only a longer document has more.
REPETITION_WORDS = 1 << 17


def repetition_chars(words: pa.Array) -> pa.Array:
    """Characters in repeated word n-grams, for a batch of word lists.

    ``top_n_chars``: occurrences times length of the most frequent n-gram (words joined by
    one space), 0 if none occurs twice; ties go to the longest. ``dup_n_chars``: lengths of
    the words covered by an occurrence after the first, each word once.

    Documents are taken some at a time: a worker holds about twenty numbers for each of
    their words, so a batch's size does not decide its memory.
    """
    ends = np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    found, at = [], 0
    while at < len(words) or not found:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + REPETITION_WORDS, "right")))
        found.append(_repetition_chars(words.slice(at, to - at)))
        at = to
    return pa.concat_arrays(found)


def _repetition_chars(words: pa.Array) -> pa.Array:
    n_docs = len(words)
    sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = words.flatten()
    out = {name: np.zeros(n_docs, np.int64) for name in REPETITION_FIELDS}
    if len(flat):
        doc = np.repeat(np.arange(n_docs), sizes)
        doc_end = np.cumsum(sizes)[doc]
        length = pc.utf8_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
        start_char = np.concatenate([[0], np.cumsum(length)])
        code = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        n_codes = int(code.max()) + 1

        # An n-gram can only repeat where the (n-1)-gram before it repeats, so the
        # positions that remain shrink quickly with n.
        position = np.arange(len(flat))
        group = doc * n_codes + code
        _, group, count = np.unique(group, return_inverse=True, return_counts=True)
        repeated = count[group] > 1
        for n in range(2, max(DUP_SIZES) + 1):
            position, group = position[repeated], group[repeated]
            fits = position + n <= doc_end[position]
            position, group = position[fits], group[fits]
            if not len(position):
                break
            key = group * n_codes + code[position + n - 1]
            _, first, group, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            repeated = count[group] > 1
            if n in TOP_SIZES:
                many = count > 1
                at, times = position[first[many]], count[many]
                chars = start_char[at + n] - start_char[at] + n - 1
                order = np.lexsort((chars, times, doc[at]))
                best = order[np.append(np.diff(doc[at][order]) > 0, True)] if len(order) else order
                out[f"top_{n}_chars"][doc[at][best]] = times[best] * chars[best]
            if n in DUP_SIZES:
                later = np.ones(len(position), bool)
                later[first] = False
                at = position[later]
                edge = np.bincount(at, minlength=len(flat) + 1) - np.bincount(at + n, minlength=len(flat) + 1)
                covered = np.cumsum(edge[:-1]) > 0
                out[f"dup_{n}_chars"] += np.bincount(doc[covered], weights=length[covered], minlength=n_docs).astype(np.int64)
    return pa.StructArray.from_arrays([pa.array(out[name]) for name in REPETITION_FIELDS], names=REPETITION_FIELDS)


def hash60(text: str) -> int:
    """First 60 bits of the MD5 digest; SQL can state the same."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def shingle_hashes(words: bytes, size: int) -> np.ndarray:
    """Distinct 60-bit hashes (see :func:`hash60`) of the word n-grams of ``words``, which have a space between them."""
    gaps = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    count = len(gaps) + 2 - size
    if not words or count <= 0:
        return np.zeros(0, np.uint64)
    starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(words)]
    md5 = hashlib.md5
    digests = b"".join([md5(words[a:b]).digest() for a, b in zip(starts[:count], ends[size - 1 :])])
    return np.unique(np.frombuffer(digests, ">u8")[::2].astype(np.uint64) >> np.uint64(4))


# Hashes held at a time where there are few permutations, and how few shingles make that slower.
HASH_CELLS = 1 << 16
MIN_WIDTH = 64


class MinHasher:
    """Band hashes of a shingle-hash set: min over a*x+b mod 2^64 per permutation, then
    one 64-bit combination per bucket."""

    def __init__(self, buckets: int, rows: int, seed: int) -> None:
        count = buckets * rows
        self.shape = (buckets, rows)
        self.mul = np.array([hash60(f"{seed}:mul:{i}") | 1 for i in range(count)], np.uint64)
        self.add = np.array([hash60(f"{seed}:add:{i}") for i in range(count)], np.uint64)
        self.mix = np.array([hash60(f"{seed}:mix:{i}") | 1 for i in range(rows)], np.uint64)

    def bands(self, shingles: np.ndarray) -> np.ndarray:
        x = shingles.astype(np.uint64)
        low = np.full(len(self.mul), np.iinfo(np.uint64).max, np.uint64)
        width = HASH_CELLS // len(low)
        if width >= MIN_WIDTH:  # few permutations: all of them against many shingles at a time
            for at in range(0, len(x), width):
                hashed = self.mul[:, None] * x[at : at + width]
                hashed += self.add[:, None]
                np.minimum(low, hashed.min(axis=1), out=low)
        else:
            # One shingle against all permutations at a time: the working set is a few vectors
            # of one value per permutation, however long the document is.
            hashed = np.empty_like(low)
            for at in range(len(x)):
                np.multiply(self.mul, x[at : at + 1], hashed)
                np.add(hashed, self.add, hashed)
                np.minimum(low, hashed, low)
        return (low.reshape(self.shape) * self.mix).sum(axis=1, dtype=np.uint64).view(np.int64)

    def batch(self, words: pa.Array, size: int) -> pa.Array:
        """Band hashes per document, from its words with a space between them; null for a
        document without a shingle. Equal sets are hashed once."""
        known: dict[bytes, np.ndarray] = {}
        rows: list[np.ndarray | None] = []
        for text in words:
            shingles = shingle_hashes(text.as_py().encode(), size) if text.is_valid else []
            if not len(shingles):
                rows.append(None)
                continue
            key = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
            if key not in known:
                known[key] = self.bands(shingles)
            rows.append(known[key])
        return pa.array(rows, pa.list_(pa.int64()))


# Edges that a task contracts at a time; it holds up to twice as many between batches.
EDGES = 1 << 20


def spanning_stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node that has a smaller one in its component, with the smallest.

    Roots hook to smaller roots across the remaining edges, then paths are halved, until no
    edge is left between two components.
    """
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        a, b = root[a], root[b]
        apart = a != b
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            above = root[root]
            if (above == root).all():
                break
            root = above
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges ``(u, v)`` of a task replaced by stars that connect the same nodes, at most as many."""
    held: list[pa.RecordBatch] = []
    size = 0

    def stars(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        u, v = (np.concatenate([p.column(i).to_numpy(zero_copy_only=False) for p in parts]) for i in (0, 1))
        u, v = spanning_stars(u, v)
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((u, v), parts[0].schema)], schema=parts[0].schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size >= 2 * EDGES:
            found = stars(held)
            held, size = [found], found.num_rows
            if size >= EDGES:  # they share too little: pass them on
                yield found
                held, size = [], 0
    if held:
        yield stars(held)


# Bands of a slice that a task holds at a time, and the buckets it has at most.
SLICE_BANDS = 1 << 24
SLICE_BUCKETS = 8
# Documents of a bucket that are worth a slice of their own.
SLICE_ROWS = 1 << 16
# Documents whose bands are looked at together, and rows of a result.
CHUNK_ROWS = 2048
OUT_ROWS = 1 << 16


def slicing(total: int, buckets: int, tasks: int) -> tuple[int, int]:
    """Buckets of a slice, and slices that the documents of a bucket are dealt to by their hash."""
    docs = max(1, total // buckets)
    width = max(1, min(SLICE_BUCKETS, SLICE_BANDS // docs, buckets // tasks))
    parts = max(-(-docs // SLICE_BANDS), min(tasks // buckets, docs // SLICE_ROWS)) if width == 1 else 1
    return width, max(1, parts)


def slice_bands(batches: Iterator[pa.RecordBatch], total: int, tasks: int) -> Iterator[pa.RecordBatch]:
    """The bands of ``(doc_id, scope, bands)`` as rows ``(slice, docs, scopes, scope, bands)``.

    A row has the bands of some documents in a few buckets; ``scope`` numbers their ``scopes``.
    Equal bands of a bucket are in one slice.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK_ROWS):
            part = batch.slice(at, CHUNK_ROWS)
            bands = part.column("bands").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
            width, parts = slicing(total, bands.shape[1], tasks)
            scopes = part.column("scope").dictionary_encode()
            code = scopes.indices.to_numpy(zero_copy_only=False).astype(np.uint16)
            names, docs, rows = scopes.dictionary.to_pylist(), part.column("doc_id"), []
            for first in range(0, bands.shape[1], width):
                cut = np.ascontiguousarray(bands[:, first : first + width].T)
                number = first // width * parts
                if parts == 1:
                    rows.append((number, docs, code.tobytes(), cut.tobytes()))
                    continue
                share = ((cut[0].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(parts)
                order = np.argsort(share, kind="stable")
                for mine in np.split(order, np.flatnonzero(np.diff(share[order])) + 1):
                    rows.append((number + int(share[mine[0]]), docs.take(pa.array(mine)), code[mine].tobytes(), cut[0][mine].tobytes()))
            ends = np.cumsum([0, *(len(r[1]) for r in rows)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int32()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays([r[1] for r in rows])),
                    pa.array([names] * len(rows), pa.list_(pa.string())), pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.binary()),
                ],
                names=["slice", "docs", "scopes", "scope", "bands"],
            )


def repeated_bands(batches: Iterator[pa.RecordBatch], total: int, tasks: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """``(doc_id, scope, bucket, band_hash)`` of the bands that two documents of a scope have.

    Takes the rows of :func:`slice_bands` in the order of their slices.
    """
    width, parts = slicing(total, buckets, tasks)
    at, held, names = None, [], {}

    def found() -> Iterator[pa.RecordBatch]:
        docs = pa.concat_arrays([d for d, _, _ in held])
        scope = np.concatenate([s for _, s, _ in held])
        listed = pa.array(list(names), pa.string())
        for j in range(len(held[0][2])):
            bands = np.concatenate([b[j] for _, _, b in held])
            order = np.argsort(bands)
            order = order[_in_runs(bands[order])]
            if len(names) > 1:
                order = order[np.lexsort((scope[order], bands[order]))]
                order = order[_in_runs(bands[order], scope[order])]
            bucket = at // parts * width + j
            for i in range(0, len(order), OUT_ROWS):
                rows = order[i : i + OUT_ROWS]
                columns = [docs.take(pa.array(rows)), listed.take(pa.array(scope[rows])), pa.array(np.full(len(rows), bucket, np.int32)), pa.array(bands[rows])]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "scope", "bucket", "band_hash"])

    for batch in batches:
        for i, number in enumerate(batch.column("slice").to_pylist()):
            if held and number != at:
                yield from found()
                held, names = [], {}
            at = number
            docs = batch.column("docs")[i].values
            local = np.array([names.setdefault(s, len(names)) for s in batch.column("scopes")[i].as_py()], np.int32)
            scope = local[np.frombuffer(batch.column("scope")[i].as_buffer(), np.uint16)]
            # A copy, so that no batch is kept for it.
            bands = np.frombuffer(batch.column("bands")[i].as_buffer(), np.int64).reshape(-1, len(docs)).copy()
            held.append((pa.concat_arrays([docs.slice(0, 0), docs]), scope, bands))
    if held:
        yield from found()


def _in_runs(*sorted_by: np.ndarray) -> np.ndarray:
    """Which rows equal a neighbour in all of the columns that they are sorted by."""
    same = np.logical_and.reduce([c[1:] == c[:-1] for c in sorted_by])
    out = np.zeros(len(sorted_by[0]), bool)
    out[1:] |= same
    out[:-1] |= same
    return out
