"""Operator 5: n-gram Jaccard join by token-combination prefixes.

A document is a set of hashed shingles, its tokens. If two sets link, each lacks at most a
tenth of its tokens in the other. Tokens have a global order: first a fixed share of all
tokens, chosen by hash and counted over the corpus, those of one document before repeated
ones and frequent ones last, by subclass; then the uncounted tokens. A prefix of a set is
extended until losing a tenth of the set cannot break all of its signatures: a rare token is a
signature alone, two frequent tokens of one subclass are one together. Linked sets then share
a signature. Sets that do, directly or through others, meet and are verified exactly. A token
that one document has alone counts in its prefix and is no signature.

Sets with equal tokens are one class from the start. Groups that share signatures are linked
as stars and never paired off. A class of candidates larger than a block is mostly a chain of
chance tokens: it goes through the same once more, with tokens counted within the class and
two repeated tokens to a signature, and falls apart. What is left is verified in tiles of two blocks, each of which passes on a
spanning forest of its links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import as_batch, free_name, in_batches, mixed, partitions, released, slices, table
from weirgate.llm.shingles import shingle_sets
from weirgate.llm.url_filter import marked
from weirgate.operators.components import connected_components
from weirgate.session import discard, materialise

WIDTH = 3
PERCENT = 90

# The tokens that are counted: those whose hash is below this share of its range.
COUNTED = 0.25

# The same for classes of candidates larger than a block, where tokens are counted by class.
COUNTED_IN_CLASS = 0.5

# A counted token in at least this many documents is frequent.
FREQUENT = 32

# Linked sets are of like size: signatures and candidates are kept apart by bands of sizes, each
# this much wider than the one below; a set near the border of a band belongs to both.
BAND_RATIO = 1.5
BANDS = np.unique(np.ceil(BAND_RATIO ** np.arange(90)))

# The least size in a band, divided by this, is its number of subclasses of frequent tokens; by
# less where a larger share of the tokens is counted.
SUBCLASS = 40

# Up to this many candidates, their places are broadcast (32 bytes each). With more, texts that a
# Bloom filter of their ids passes on are joined by a shuffle.
BROADCAST_IDS = 1 << 19

# Sets verified against each other in one tile: one block, or two, of so many sets and tokens.
BLOCK = 1024
BLOCK_TOKENS = 1 << 19
# Rows of a tile whose links are listed at a time.
ROWS = 64
# Up to this many sets are compared pair by pair, more by a matrix product.
FEW = 16

TOKENS = pa.list_(pa.int64())
SKETCH = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.binary()), ("th", pa.int64()), ("counted", pa.int64()), ("low", TOKENS), ("more", TOKENS)])
SKETCH_DDL = "row long, doc_id long, n long, key binary, th long, counted long, low array<long>, more array<long>"
CLASS_SKETCH = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("band", pa.int64()), ("n", pa.int64()), ("counted", pa.int64()), ("low", TOKENS), ("more", TOKENS)])
CLASS_SKETCH_DDL = "row long, doc_id long, band long, n long, counted long, low array<long>, more array<long>"
SIGNED = pa.schema([("doc_id", pa.int64()), ("sigs", TOKENS)])
MEMBER = pa.schema([("component", pa.int64()), ("band", pa.int64()), ("blocks", pa.int32()), ("block", pa.int32()), ("doc_id", pa.int64()), ("tokens", pa.binary())])
MEMBER_DDL = "component long, band long, blocks int, block int, doc_id long, tokens binary"
LINK = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def least_overlap(n: int, percent: int) -> int:
    """Tokens that a set of n shares at least with any set it links to."""
    return -(-n * percent // 100)


def size_bands(n: int, percent: int) -> range:
    """The bands of sizes that a set of n belongs to."""
    first, last = np.searchsorted(BANDS, [least_overlap(n, percent), n], "right").tolist()
    return range(first, last + 1)


def subclasses(band: int, share: float) -> int:
    """The number of subclasses of a band's frequent tokens if ``share`` of all tokens is counted."""
    return max(1, int(BANDS[max(0, band - 1)] * share) // int(SUBCLASS * COUNTED))


def uncounted(n: int, counted: int, last: int, share: float, percent: int) -> int:
    """Uncounted tokens that signatures of a set may take, if ``last`` is the largest of its bands."""
    return max(0, n - least_overlap(n, percent) + 1 - counted + subclasses(last, share))


def _sketches(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Each set's size, a digest of it, its counted tokens, and others if those may not do."""
    bound = np.uint64(int(COUNTED * 2**64))
    held: list[tuple] = []
    for batch in batches:
        for row, doc, th, tokens in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), shingle_sets(batch.column(2), width)):
            n, counted = len(tokens), int(np.searchsorted(tokens, bound))
            more = tokens[counted : counted + uncounted(n, counted, size_bands(n, percent)[-1], COUNTED, percent)]
            key = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if n else None
            held.append((row, doc, n, key, th, counted, tokens[:counted].view(np.int64), more.view(np.int64)))
            if len(held) == 512:
                yield as_batch(held, SKETCH)
                held = []
    if held:
        yield as_batch(held, SKETCH)


def _class_sketches(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """The same of ``(component, band, doc_id, row, text)``, without digest; classes share no tokens."""
    bound = np.uint64(int(COUNTED_IN_CLASS * 2**64))
    held: list[tuple] = []
    size = 0
    for batch in slices(batches):
        places = zip(*(c.to_pylist() for c in batch.columns[:4]))
        for (component, band, doc, row), tokens in zip(places, shingle_sets(batch.column(4), width)):
            band += 1  # places number bands from 0
            n, counted = len(tokens), int(np.searchsorted(tokens, bound))
            taken = counted + uncounted(n, counted, band, COUNTED_IN_CLASS, percent)
            own = mixed(mixed(np.array([component], np.int64).view(np.uint64)) + np.uint64(band))
            tokens = (tokens[:taken] ^ own).view(np.int64)
            held.append((row, doc, band, n, counted, tokens[:counted], tokens[counted:]))
            size += taken
            if size > 200_000:
                yield as_batch(held, CLASS_SKETCH)
                held, size = [], 0
    if held:
        yield as_batch(held, CLASS_SKETCH)


def links_to_equal_only(n: int, percent: int) -> bool:
    return n < 2 or (least_overlap(n, percent) == n and n * 100 // percent == n)


def signatures(n: int, low: np.ndarray, more: np.ndarray, repeated: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of a set of n tokens: its sorted counted tokens, some of the others, and
    which of the counted ones are repeated, or frequent even.

    Losing a rare token breaks one signature. In a subclass with m frequent tokens, m - 1 of
    them must be lost before no pair is left. The prefix ends where what must be lost exceeds
    what a link allows. Signatures and subclasses hang on the band of sizes.
    """
    if links_to_equal_only(n, percent):
        return low[:0]
    often, again = np.isin(low, frequent), np.isin(low, repeated)
    lone = low[~again & ~often]
    own = [mixed(lone[: n - least_overlap(n, percent) + 1] + np.uint64(band)) for band in size_bands(n, percent)]
    shared = shared_signatures(n, len(lone), low[again & ~often], low[often], more, size_bands(n, percent), COUNTED, percent)
    return np.unique(np.concatenate([*own, shared]))


def shared_signatures(
    n: int, lone: int, again: np.ndarray, often: np.ndarray, more: np.ndarray, bands: range, share: float, percent: int, alone: bool = True
) -> np.ndarray:
    """Those of the :func:`signatures` that another set may have too, for some bands.

    ``lone`` is the number of counted tokens that no other set has; ``again`` are the sorted
    repeated ones, ``often`` the sorted frequent ones. Unless they are signatures ``alone``,
    two repeated tokens of a subclass are one together, as two frequent ones are.
    """
    if links_to_equal_only(n, percent):
        return again[:0]
    need = n - least_overlap(n, percent) + 1
    singles = again[: max(0, need - lone) if alone else 0]
    found = []
    for band in bands:
        held = min(need, lone + len(singles))
        found.append(mixed(singles + np.uint64(band)))
        for rest in (often,) if alone else (again, often):
            if held == need:
                break
            sub = (mixed(rest ^ np.uint64(band)) % np.uint64(subclasses(band, share))).astype(np.int64)
            order = np.lexsort((rest, sub))
            sub, ordered = sub[order], rest[order]
            broken = held + np.cumsum(np.r_[False, sub[1:] == sub[:-1]][: len(sub)])
            end = int(np.searchsorted(broken, need)) + 1
            held = int(broken[min(end, len(sub)) - 1]) if len(sub) else held
            sub, ordered = sub[:end], ordered[:end]
            starts = np.flatnonzero(np.r_[True, sub[1:] != sub[:-1]][: len(sub)])
            for a, b in zip(starts, [*starts[1:], len(sub)]):
                i, j = np.triu_indices(b - a, 1)
                found.append(mixed(ordered[a + i] * np.uint64(3) + mixed(ordered[a + j] + np.uint64(band))))
        found.append(mixed(more[: need - held] + np.uint64(band)))
    return np.unique(np.concatenate(found))


def flat_lists(column: pa.Array) -> tuple[list[int], pa.Array]:
    """Where each list begins and ends, and the values of all; a null list is empty."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return [0, *np.cumsum(sizes).tolist()], column.flatten()


def _signed(batches: Iterator[pa.RecordBatch], share: float, percent: int, alone: bool) -> Iterator[pa.RecordBatch]:
    """Shared signatures of ``(doc_id, band, n, counted, more, again, often)``; a null band stands for all of the set."""
    for batch in slices(batches):
        held, size = [], 0
        places = zip(*(c.to_pylist() for c in batch.columns[:4]))
        lists = [(at, values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) for at, values in map(flat_lists, batch.columns[4:])]
        for i, (doc, band, n, counted) in enumerate(places):
            more, again, often = (values[at[i] : at[i + 1]] for at, values in lists)
            bands = size_bands(n, percent) if band is None else range(band, band + 1)
            sigs = shared_signatures(n, counted - len(again) - len(often), np.sort(again), np.sort(often), more, bands, share, percent, alone)
            if len(sigs):
                held.append((doc, sigs.view(np.int64)))
                size += len(sigs)
            if size > 200_000:
                yield as_batch(held, SIGNED)
                held, size = [], 0
        if held:
            yield as_batch(held, SIGNED)


def _members(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            places = zip(*(c.to_pylist() for c in batch.columns[:5]))
            for place, tokens in zip(places, shingle_sets(batch.column(5), width)):
                yield *place, tokens.tobytes()

    yield from in_batches(rows(), MEMBER, 5)


def _linked(shared: np.ndarray, one: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    return 100 * shared >= percent * (one + other - shared)


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets on the left with all on the right."""
    every = left + right
    flat = np.concatenate(every)
    order = np.argsort(flat, kind="stable").astype(np.int32)
    flat = flat[order]
    row = np.repeat(np.arange(len(every), dtype=np.int32), [len(x) for x in every])[order]
    del order
    new = np.r_[True, flat[1:] != flat[:-1]][: len(flat)]
    del flat
    starts = np.flatnonzero(new)
    often = np.diff(np.r_[starts, len(new)]) > 1  # of each distinct token
    there = np.repeat(often, np.diff(np.r_[starts, len(new)]))
    row, token = row[there], (np.cumsum(new[there], dtype=np.int32) - 1)
    out = np.zeros((len(left), len(right)), np.float32)
    step = 1024
    for first in range(0, int(token[-1]) + 1 if len(token) else 0, step):
        a, b = np.searchsorted(token, [first, first + step])
        dense = np.zeros((len(every), step), np.float32)
        dense[row[a:b], token[a:b] - first] = 1
        out += dense[: len(left)] @ dense[len(left) :].T
    return out


def forest(ids: list[int], sets: list[np.ndarray], side: list[bool], across: bool, percent: int) -> Iterator[tuple[int, int]]:
    """Links that join each set of a tile to the others it is linked to, through others or not.

    ``across`` tiles compare the two sides with each other; other tiles compare all sets.
    """
    root = list(range(len(ids)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    left = [i for i in range(len(ids)) if not side[i]] if across else list(range(len(ids)))
    right = [i for i in range(len(ids)) if side[i]] if across else left
    if not left or not right:
        return
    if len(left) + len(right) <= 2 * FEW:
        pairs = ((i, j) for i in left for j in right if across or i < j)
        for i, j in pairs:
            a, b = len(sets[i]), len(sets[j])
            if find(i) != find(j) and 100 * min(a, b) >= percent * max(a, b):
                shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if _linked(shared, a, b, percent):
                    root[find(i)] = find(j)
                    yield ids[i], ids[j]
        return
    sizes = np.array([len(s) for s in sets])
    shared = _shared_counts([sets[i] for i in left], [sets[j] for j in right])
    for first in range(0, len(left), ROWS):
        some = left[first : first + ROWS]
        hits = _linked(shared[first : first + ROWS].astype(np.int64), sizes[some][:, None], sizes[right][None, :], percent)
        for x, y in zip(*(h.tolist() for h in np.nonzero(hits))):
            i, j = some[x], right[y]
            if find(i) != find(j):
                root[find(i)] = find(j)
                yield ids[i], ids[j]


def _verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links of the tiles in rows sorted by tile: ``(component, band, i, j, block, doc_id, tokens)``."""

    def rows() -> Iterator[tuple]:
        at, ids, sets, side = None, [], [], []
        for batch in slices(batches):
            for *tile, block, doc, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                if tile != at:
                    if at is not None:
                        yield from forest(ids, sets, side, at[2] != at[3], percent)
                    at, ids, sets, side = tile, [], [], []
                ids.append(doc)
                sets.append(np.frombuffer(tokens, np.uint64))
                side.append(block != tile[2])
        if at is not None:
            yield from forest(ids, sets, side, at[2] != at[3], percent)

    held = []
    for row in rows():
        held.append(row)
        if len(held) == 4096:
            yield as_batch(held, LINK)
            held = []
    if held:
        yield as_batch(held, LINK)


def signed_sets(sets: DataFrame, tokens: DataFrame, share: float, percent: int, alone: bool = True) -> DataFrame:
    """``(doc_id, sigs)`` of ``sets(row, doc_id, band, n, counted, more)`` with the counted ``tokens(row, token)``."""
    counts = materialise(tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1"))
    known = tokens.join(counts.select("token", (F.col("n") >= FREQUENT).alias("frequent")), "token")
    lists = [F.collect_list(F.when(when, F.col("token"))).alias(name) for name, when in (("again", ~F.col("frequent")), ("often", F.col("frequent")))]
    sets = sets.join(known.groupBy("row").agg(*lists), "row", "left").select("doc_id", "band", "n", "counted", "more", "again", "often")
    signed = materialise(sets.mapInArrow(lambda b: released(_signed(b, share, percent, alone)), "doc_id long, sigs array<long>"))
    discard(counts)
    return signed


def candidates(signed: DataFrame) -> DataFrame:
    """``(doc_id, component)`` of the documents that share a signature, directly or through others.

    A group of documents is a star of edges; pairs need no join back. ``signed`` is deleted.
    """
    rows = signed.select(F.explode("sigs").alias("sig"), "doc_id")
    groups = rows.groupBy("sig").agg(F.min("doc_id").alias("u"), F.max("doc_id").alias("v"), F.count("*").alias("n"))
    groups = materialise(groups.where("n > 1"))
    more = rows.join(groups.where("n > 2").select("sig", "u"), "sig").select("u", F.col("doc_id").alias("v"))
    found = materialise(connected_components(groups.select("u", "v").unionByName(more).where("u < v").distinct()))
    discard(groups)
    discard(signed)
    return found.withColumnRenamed("node", "doc_id")


def in_blocks(banded: DataFrame) -> DataFrame:
    """The written ``(component, band, blocks, block, doc_id, n)`` of ``banded(component, band, doc_id, n)``.

    A component's candidates of a band are a class; classes of one are left out.
    """
    needed = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_TOKENS)).cast("int")
    blocks = banded.groupBy("component", "band").agg(needed.alias("blocks"), F.count("*").alias("members")).where("members > 1")
    block = F.pmod(F.xxhash64("doc_id"), "blocks").cast("int")
    return materialise(banded.join(blocks, ["component", "band"]).select("component", "band", "blocks", block.alias("block"), "doc_id", "n"))


def with_texts(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """The places with the texts of ``rows(doc_id, text)``; texts that have none are not shuffled."""
    placed = placed.drop("n")
    n = placed.count()
    if n <= BROADCAST_IDS:
        return rows.join(F.broadcast(placed), "doc_id")
    return marked(rows, F.col("doc_id"), placed.select("doc_id"), n, "hit").where("hit").drop("hit").join(placed, "doc_id")


def refined(rows: DataFrame, large: DataFrame, width: int, percent: int) -> DataFrame:
    """``(component, band, doc_id, n)`` of the classes ``large``, parted by signatures of their own.

    Within a class a set has many more tokens alone than within the corpus, and more of them
    are counted; a repeated token is no signature alone, so chance does not chain families of
    alike sets. Few sets are left but copies.
    """
    texts = with_texts(rows, large).select("component", "band", "doc_id", F.monotonically_increasing_id().alias("row"), "text")
    sketch = materialise(texts.mapInArrow(lambda b: released(_class_sketches(b, width, percent)), CLASS_SKETCH_DDL))
    signed = signed_sets(sketch.drop("low"), sketch.select("row", F.explode("low").alias("token")), COUNTED_IN_CLASS, percent, alone=False)
    discard(sketch)
    return large.select("doc_id", "band", "n").join(candidates(signed), "doc_id").select("component", "band", "doc_id", "n")


def jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per input row.

    Words are runs of other characters than space and U+0009 to U+000D, A-Z lower-cased. Two
    documents link if the intersection of their sets of ``width``-word shingles is at least
    ``percent`` of the union. ``component_id`` is the smallest id reachable by links.

    Nulls: a null or blank text has no shingles and links to nothing; a row with a null id
    takes no part and has a null component. Equal rows are linked by their equal sets. Rows
    that repeat an id with another text share the links of that id. Texts of any length are
    read whole. Extra columns are not read. An empty table gives an empty result.
    """
    return text_components(docs, id_col, text_col, width, percent).drop("th")


def text_components(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """The rows of :func:`jaccard_join`, with ``th``, a hash of the row's text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", F.xxhash64("text").alias("th"))
    sketch = materialise(numbered.mapInArrow(lambda b: released(_sketches(b, width, percent)), SKETCH_DDL))
    sizes = materialise(sketch.select("doc_id", "n", "key", "th"))
    some = sizes.where("key IS NOT NULL AND doc_id IS NOT NULL")
    firsts = materialise(some.groupBy("key").agg(F.min("doc_id").alias("rep")))

    taking = sketch.where("key IS NOT NULL AND doc_id IS NOT NULL")
    sets = taking.select("row", "doc_id", "key", F.lit(None).cast("long").alias("band"), "n", "counted", "more")
    different = sets.join(firsts.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id", "key"])
    signed = signed_sets(different.drop("key"), taking.select("row", F.explode("low").alias("token")), COUNTED, percent)
    discard(sketch)

    # A component's candidates by bands of sizes, and a band's in blocks.
    band = lambda n: F.floor(F.log(n) / float(np.log(BAND_RATIO)))
    bands = F.explode(F.sequence(band(F.ceil(F.col("n") * percent / 100)), band(F.col("n"))))
    sized = some.select("doc_id", "n").join(candidates(signed), "doc_id")
    banded = sized.select("doc_id", "component", "n", bands.alias("band")).groupBy("doc_id", "component", "band").agg(F.max("n").alias("n"))
    placed = in_blocks(banded)
    large = placed.where("blocks > 1")
    if not large.isEmpty():
        placed = placed.where("blocks = 1").unionByName(in_blocks(refined(rows, large, width, percent)))

    texts = with_texts(rows, placed).select("component", "band", "blocks", "block", "doc_id", "text")
    members = texts.mapInArrow(lambda b: released(_members(b, width)), MEMBER_DDL)
    tiles = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc_id", "tokens"
    )
    tile = ["component", "band", "i", "j"]
    tiles = tiles.repartition(partitions(docs.sparkSession), *tile).sortWithinPartitions(*tile, "doc_id")
    links = materialise(tiles.mapInArrow(lambda b: released(_verified(b, percent)), "u long, v long"))
    found = connected_components(links).select(F.col("node").alias("rep"), "component")

    classes = firsts.join(found, "rep", "left").select("key", F.coalesce("component", "rep").alias("component_id"))
    placed = some.select("doc_id", F.col("n").alias("n_shingles"), "key", "th").join(classes, "key").drop("key")
    alone = sizes.where("key IS NULL OR doc_id IS NULL").select("doc_id", F.col("n").alias("n_shingles"), "th", F.col("doc_id").alias("component_id"))
    return placed.unionByName(alone)


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that are the smallest id of their component, with their own columns.

    A row goes by its id and its text; a row with a null id links to nothing and stays.
    """
    th, hit = free_name(docs, "th"), free_name(docs, "hit")
    found = text_components(docs, "doc_id", "text", width, percent).where("doc_id > component_id")
    gone = materialise(found.select(F.col("doc_id").alias("_gone_id"), F.col("th").alias("_gone_th")).distinct())
    # Rows whose id a Bloom filter doesn't know stay where they lie, so that few texts are shuffled.
    named = marked(docs.withColumn(th, F.xxhash64("text")), F.col("doc_id").cast("long"), gone.select("_gone_id"), gone.count(), hit)
    known = named.where(hit)
    same = (known["doc_id"].cast("long") == gone["_gone_id"]) & (known[th] == gone["_gone_th"])
    return named.where(~F.col(hit)).unionByName(known.join(gone, same, "left_anti")).select(*docs.columns)


def query(spark, folder: str) -> DataFrame:
    return jaccard_join(table(spark, folder, "documents"))


SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END) AS shingles FROM w
), sets AS (
  SELECT shingles, min(doc_id) AS rep, len(shingles) AS n FROM (SELECT doc_id, list_sort(shingles) AS shingles FROM s) GROUP BY shingles
), tokens AS (
  SELECT rep, n, hash(unnest(shingles)) AS token FROM sets WHERE n > 0
), pairs AS (
  SELECT a.rep AS u, b.rep AS v FROM tokens a JOIN tokens b ON a.token = b.token AND a.rep < b.rep AND a.n * 10 >= b.n * 9 AND b.n * 10 >= a.n * 9
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), sides AS (
  SELECT u, v FROM pairs UNION SELECT v, u FROM pairs
), reach(node, root) AS (
  SELECT rep, rep FROM sets WHERE n > 0 UNION SELECT sides.v, reach.root FROM reach JOIN sides ON sides.u = reach.node AND reach.root < sides.v
), labels AS (
  SELECT node, min(root) AS component FROM reach GROUP BY node
)
SELECT s.doc_id, len(s.shingles) AS n_shingles, CASE WHEN len(s.shingles) = 0 THEN s.doc_id ELSE labels.component END AS component_id
FROM s JOIN sets ON list_sort(s.shingles) = sets.shingles LEFT JOIN labels ON labels.node = sets.rep
"""
