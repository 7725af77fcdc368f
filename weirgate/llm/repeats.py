"""Operator 3: suffix-array dedup by column-wise construction over many documents.

A window is a string of WINDOW bytes. Each window names one gram inside it, its anchor: the
one with the smallest hash. Equal windows have equal anchors at the same place, so only the
surroundings of anchors that occur more than once need sorting. Surroundings of one anchor
are aligned at it, as the rows of a collection. The collection's suffixes are then sorted from
the right: every round inserts one symbol of each document, which is the column of the
collection's Burrows-Wheeler transform in the order so far, and updates the order and the
common prefixes of neighbours. Where a common prefix reaches WINDOW, the window repeats.

Anchors, candidate documents and repeats are tables in the shared folder, written and read in
sequence. A hot anchor's surroundings are dealt to several collections; what stays alone in
one of them, and one of each repeat, meet again by a hash of the whole window.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import as_batch, in_batches, mixed, partitions, slices, table
from weirgate.llm.shingles import pieces, powers
from weirgate.session import discard, materialise, materialise_by

WINDOW = 200
GRAM = 32

# Surroundings sorted together; more of one anchor are dealt to several collections.
COLLECTION = 4096
# Small collections are sorted side by side, up to this many rows.
ROWS = 16_384

# A piece of a text is at most this long when its anchors are sought, so that a place fits 24 bits.
PIECE = 1 << 22
_PLACE_BITS = np.uint64(24)

_CODES = np.random.default_rng(3).integers(1, 1 << 63, (2, 256), dtype=np.uint64)

ANCHORS = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("n", pa.int64()), ("sha", pa.binary()), ("h", pa.list_(pa.int64())), ("a", pa.list_(pa.int32())), ("p", pa.list_(pa.int32())), ("q", pa.list_(pa.int32()))])
ANCHORS_DDL = "id long, th long, n long, sha binary, h array<long>, a array<int>, p array<int>, q array<int>"
PACKED = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("packed", pa.binary())])
AROUND = pa.schema([("h", pa.int64()), ("deal", pa.int32()), ("deals", pa.int32()), ("id", pa.int64()), ("th", pa.int64()), ("p", pa.int32()), ("off", pa.int32()), ("bytes", pa.binary())])
AROUND_DDL = "h long, deal int, deals int, id long, th long, p int, off int, bytes binary"
FOUND = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("w1", pa.int64()), ("w2", pa.int64()), ("open", pa.bool_())])
FOUND_DDL = "id long, th long, first int, last int, w1 long, w2 long, open boolean"
KEPT = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.binary())])
KEPT_DDL = "id long, th long, spans array<array<long>>, kept binary"


def string_hashes(data: np.ndarray, width: int, code: int) -> np.ndarray:
    """A hash of each string of ``width`` bytes in ``data``."""
    n = len(data)
    up, down = powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODES[code][data] * up[:n], out=sums[1:])
    return mixed((sums[width:] - sums[: n + 1 - width]) * down[: n + 1 - width])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` neighbours."""
    least, have = values, 1
    while 2 * have <= width:
        least = np.minimum(least[: len(least) - have], least[have:])
        have *= 2
    more = width - have
    return np.minimum(least[: len(least) - more], least[more:]) if more else least


def anchors(data: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchors of all windows of texts laid end to end.

    Returns ``(text, hash, place, first, last)``: windows first to last of a text, counted in
    ``data``, name the anchor at ``place``.
    """
    none = tuple(np.empty(0, np.int64) for _ in range(5))
    if len(data) < window:
        return none
    hashes = string_hashes(data, gram, 0)
    named = (hashes >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
    least = sliding_least(named, window - gram + 1)
    place = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
    start = np.arange(len(place))
    text = np.searchsorted(offsets, start, "right") - 1
    start = start[start + window <= offsets[text + 1]]
    if not len(start):
        return none
    place, text = place[start], text[start]
    new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (text[1:] != text[:-1])])
    last = np.r_[new[1:], len(start)] - 1
    return text[new], hashes[place[new]].view(np.int64), place[new], start[new], start[last]


def _anchored(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for first, data, offsets in pieces(batch.column(2)):
            if len(offsets) == 2 and len(data) > PIECE:  # one long text, in pieces that share window - 1 bytes
                parts = [data[i : i + PIECE + window - 1] for i in range(0, len(data), PIECE)]
                found = [(t, h, a + i * PIECE, p + i * PIECE, q + i * PIECE) for i, x in enumerate(parts) for t, h, a, p, q in [anchors(x, np.array([0, len(x)]), window, gram)]]
                text, h, a, p, q = (np.concatenate(c) for c in zip(*found))
            else:
                text, h, a, p, q = anchors(data, offsets, window, gram)
            at = np.searchsorted(text, np.arange(len(offsets)))
            rows = []
            for i, (x, y, base, end) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), offsets[:-1].tolist(), offsets[1:].tolist())):
                sha = hashlib.sha256(data[base:end]).digest()
                rows.append((ids[first + i], hashes[first + i], end - base, sha, h[x:y], *((v[x:y] - base).astype(np.int32) for v in (a, p, q))))
            yield as_batch(rows, ANCHORS)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, for they are shuffled and stored once as a whole."""

    def rows() -> Iterator[tuple]:
        for batch in slices(batches):
            for id_, th, text in zip(*(c.to_pylist() for c in batch.columns)):
                yield id_, th, zlib.compress(text.encode(), 6)

    yield from in_batches(rows(), PACKED, 2)


def _surroundings(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Each candidate anchor with the bytes of the windows that name it."""

    def rows() -> Iterator[tuple]:
        for batch in slices(batches):
            for id_, th, packed, named in zip(*(c.to_pylist() for c in batch.columns)):
                raw = zlib.decompress(packed)
                for m in named:
                    yield m["h"], m["deal"], m["deals"], id_, th, m["p"], m["a"] - m["p"], raw[m["p"] : m["q"] + window]

    yield from in_batches(rows(), AROUND, 7, 8 << 20)


def sort_columns(group: np.ndarray, off: np.ndarray, lengths: np.ndarray, flat: np.ndarray, window: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Column-wise sorting of the suffixes of aligned rows, collection by collection.

    Row i has ``lengths[i]`` bytes in ``flat``, its anchor at ``off[i]``; ``group`` ascends. Of
    each column, from the rightmost to the leftmost, one symbol of every row is inserted.
    Yields, for columns at or left of the anchor, the column, the rows in the order of their
    suffixes there, and the common prefix of each with the row before it.
    """
    rows = len(group)
    right, left = int((lengths - off).max()), int(off.max())
    start = np.cumsum(lengths) - lengths
    row = np.repeat(np.arange(rows), lengths)
    column = np.arange(len(flat)) - start[row] - off[row]
    symbols = np.zeros((right + left, rows), np.uint16)  # 0 where a row has not begun, from the right
    symbols[right - 1 - column, row] = flat.astype(np.uint16) + 1
    order, common = np.arange(rows), np.zeros(rows, np.int64)
    base = group.astype(np.int64) * 257
    for step in range(right + left):
        at = right - 1 - step
        if at < 0:
            stay = off[order] >= -at
            if not stay.all():
                kept = np.flatnonzero(stay)
                if not len(kept):
                    return
                common = np.minimum.reduceat(common[: kept[-1] + 1], np.r_[0, kept[:-1] + 1])
                order = order[kept]
        key = base[order] + symbols[step][order]
        moved = np.argsort(key, kind="stable")
        key = key[moved]
        same = np.flatnonzero((key[1:] == key[:-1]) & (key[1:] % 257 != 0)) + 1
        fresh = np.zeros(len(order), np.int64)
        if len(same):
            i, j = moved[same - 1] + 1, moved[same] + 1
            ends = np.empty(2 * len(same), np.int64)
            ends[::2], ends[1::2] = i, j
            fresh[same] = np.minimum.reduceat(np.r_[common, 0], ends)[::2] + 1
        order, common = order[moved], fresh
        if at <= 0:
            yield at, order, common


def repeats_in(rows: list[tuple], window: int) -> Iterator[tuple]:
    """Repeats in some collections ``(h, deal, deals, id, th, p, off, bytes)``, sorted by the first two.

    Yields runs of windows that repeat, with ``open`` false; for collections that share their
    anchor with others also every window that does not repeat, ``open``, and one of each that
    does, with two hashes of the window.
    """
    h, deal, deals, ids, ths, p, off, text = zip(*rows)
    lengths = np.fromiter(map(len, text), np.int64, len(rows))
    flat = np.frombuffer(b"".join(text), np.uint8)
    off, shared = np.array(off, np.int64), np.array(deals) > 1
    tag = np.array(h, np.int64), np.array(deal, np.int64)
    group = np.cumsum(np.r_[False, (tag[0][1:] != tag[0][:-1]) | (tag[1][1:] != tag[1][:-1])])
    width = int(off.max()) + 1
    hit = np.zeros((len(rows), width), bool)  # by row and window, counted from the row's first byte
    first = np.zeros((len(rows), width), bool)
    for at, order, common in sort_columns(group, off, lengths, flat, window):
        long = common >= window
        after = np.r_[long[1:], False]
        some = order[long | after]
        hit[some, off[some] + at] = True
        lead = order[after & ~long]
        first[lead, off[lead] + at] = True
    edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    for (r, a), (_, b) in zip(np.argwhere(edge == 1).tolist(), np.argwhere(edge == -1).tolist()):
        yield ids[r], ths[r], p[r] + a, p[r] + b - 1, 0, 0, False
    if shared.any():
        start = np.cumsum(lengths) - lengths
        w1, w2 = string_hashes(flat, window, 0).view(np.int64), string_hashes(flat, window, 1).view(np.int64)
        there = (np.arange(width)[None, :] <= (lengths - window)[:, None]) & shared[:, None] & (~hit | first)
        for r, a in np.argwhere(there).tolist():
            yield ids[r], ths[r], p[r] + a, p[r] + a, int(w1[start[r] + a]), int(w2[start[r] + a]), not hit[r, a]


def _sorted(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        held: list[tuple] = []
        for batch in slices(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(held) >= ROWS and held[-1][:2] != row[:2]:
                    yield from repeats_in(held, window)
                    held = []
                held.append(row)
        if held:
            yield from repeats_in(held, window)

    held = []
    for row in rows():
        held.append(row)
        if len(held) == 32_768:
            yield as_batch(held, FOUND)
            held = []
    if held:
        yield as_batch(held, FOUND)


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The maximal removed runs of each text, and what is left of it."""

    def rows() -> Iterator[tuple]:
        for batch in slices(batches):
            for id_, th, packed, found in zip(*(c.to_pylist() for c in batch.columns)):
                spans: list[list[int]] = []
                for first, last in sorted((f["first"], f["last"]) for f in found):
                    if spans and first <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], last + window)
                    else:
                        spans.append([first, last + window])
                raw, at, kept = zlib.decompress(packed), 0, []
                for a, b in spans:
                    kept.append(raw[at:a])
                    at = b
                yield id_, th, spans, b"".join([*kept, raw[at:]])

    yield from in_batches(rows(), KEPT, 3)


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, collection: int = COLLECTION, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept_sha256, kept)``, one row per input row.

    A byte goes if a string of ``window`` bytes covers it that also starts at another place of
    this or another document. ``spans`` are the maximal removed runs ``[start, stop]`` of the
    UTF-8 text; ``kept`` is the rest, as binary, for a character may be cut, and null where
    nothing goes and the text stays as it is.

    A null text is an empty text; texts shorter than the window lose nothing; rows with a null
    id are documents like others. Repeated rows are documents each, so their long texts go.
    Very long texts are read whole, in pieces that overlap. Extra columns are not read. An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("th"), "text")
    named = materialise(rows.mapInArrow(lambda b: _anchored(b, window, gram), ANCHORS_DDL))
    base = materialise(named.select("id", "th", "n", "sha"))
    counts = materialise(named.select(F.explode("h").alias("h")).groupBy("h").agg(F.count("*").alias("n")).where("n > 1"))

    each = named.select("id", "th", F.explode(F.arrays_zip("h", "a", "p", "q")).alias("m")).select("id", "th", "m.h", "m.a", "m.p", "m.q")
    deals = F.ceil(F.col("n") / collection).cast("int")
    each = each.join(counts, "h").withColumn("deals", deals).withColumn("deal", F.pmod(F.xxhash64("id", "th", "a"), "deals").cast("int"))
    # Rows that repeat an id and a text share one list; each of them sends its own surroundings.
    lists = each.groupBy("id", "th").agg(F.collect_set(F.struct("h", "deal", "deals", "a", "p", "q")).alias("named"))
    # Texts are shuffled once, to buckets by id and text, where their repeats find them later.
    packed = rows.mapInArrow(_packed, "id long, th long, packed binary").repartition(partitions(spark), "id", "th")
    wanted = materialise_by(packed.join(lists, ["id", "th"]), "id", "th", placed=True)
    discard(named)
    discard(counts)

    around = wanted.select("id", "th", "packed", "named").mapInArrow(lambda b: _surroundings(b, window), AROUND_DDL)
    around = around.repartition(partitions(spark), "h", "deal").sortWithinPartitions("h", "deal")
    found = materialise(around.mapInArrow(lambda b: _sorted(b, window), FOUND_DDL))

    runs = found.where("NOT open AND w1 = 0 AND w2 = 0").select("id", "th", "first", "last")
    meet = found.where("w1 <> 0 OR w2 <> 0").groupBy("w1", "w2").agg(F.count("*").alias("n"), F.collect_list(F.struct("id", "th", "first", "open")).alias("ones"))
    met = meet.where("n > 1").select(F.explode("ones").alias("o")).where("o.open").select("o.id", "o.th", "o.first", F.col("o.first").alias("last"))
    ranges = runs.unionByName(met).groupBy("id", "th").agg(F.collect_list(F.struct("first", "last")).alias("found"))
    cut = wanted.select("id", "th", "packed").join(ranges, ["id", "th"]).mapInArrow(lambda b: _cut(b, window), KEPT_DDL)
    changed = materialise(cut).withColumn("cut_sha", F.sha2("kept", 256)).dropDuplicates(["id", "th"])
    return base.join(changed, ["id", "th"], "left").select(
        F.when(F.col("id") != -(1 << 63), F.col("id")).alias("doc_id"),
        F.col("n").alias("n_bytes"),
        F.coalesce("spans", F.array().cast("array<array<long>>")).alias("spans"),
        F.coalesce("cut_sha", F.lower(F.hex("sha"))).alias("kept_sha256"),
        "kept",
    )


def query(spark, folder: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    found = remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), places AS (
  SELECT doc_id, unnest(range(0, length(h) // 2 - 199)) AS p FROM d
), strings AS (
  SELECT places.doc_id, p, hash(substr(h, CAST(2 * p + 1 AS BIGINT), 400)) AS s FROM places JOIN d USING (doc_id)
), repeated AS (
  SELECT doc_id, p FROM strings WHERE s IN (SELECT s FROM strings GROUP BY s HAVING count(*) > 1)
), marked AS (
  SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 200, true) AS fresh FROM repeated
), runs AS (
  SELECT doc_id, min(p) AS a, max(p) + 200 AS b
  FROM (SELECT doc_id, p, count(*) FILTER (WHERE fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked) GROUP BY doc_id, run
), pieces AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS x, a AS y, a, b FROM runs
  UNION ALL SELECT d.doc_id, coalesce(max(b), 0), length(max(h)) // 2, NULL, NULL FROM d LEFT JOIN runs USING (doc_id) GROUP BY d.doc_id
)
SELECT doc_id, any_value(length(h) // 2) AS n_bytes, CAST(coalesce(sum(b - a), 0) AS BIGINT) AS n_removed, count(a) AS n_spans,
  sha256(unhex(coalesce(string_agg(substr(h, CAST(2 * x + 1 AS BIGINT), CAST(2 * (y - x) AS BIGINT)), '' ORDER BY x, y), ''))) AS kept_sha256
FROM pieces JOIN d USING (doc_id) GROUP BY doc_id
"""
