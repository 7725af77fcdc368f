"""Operator 11: phrase collocations by a weighted de Bruijn graph.

Every word of a piece starts one gram: its next LONGEST words, or fewer where the piece ends.
A gram of full length is an edge between two overlapping nodes (all but its last word, all but
its first), weighted by its occurrences; a shorter gram is the correction at a piece's end. Only
these are aggregated. The count of a shorter phrase is the flow through its node: the weights of
all edges and corrections that begin with it.

Grams travel once, sorted by words and cut into ranges, so that grams with a common beginning
lie together and their flows are sums over runs. A range may begin or end anywhere, also inside
the grams of one very common word pair; the few phrases that lie across a border leave as partial
flows and are added up. A node whose whole flow leaves by one edge has the count of the longer
phrase; such unary paths leave as one row. Ranges follow a sample of grams, which decides how
even they are and nothing else.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirgate.llm.common import as_batch, in_batches, partitions, table
from weirgate.session import materialise

LEAST = 100
LONGEST = 5
FIRST = 2000

# Grams are combined in a task in runs of about this many words.
CHUNK_WORDS = 1 << 20
# Words of a text are found in runs of about this many bytes.
RUN_BYTES = 2 << 20
# A task forgets all words of its languages beyond this many languages.
MOST_LANGS = 64
# A worker forgets its numbers of words beyond this many.
HELD_WORDS = 1 << 19
# Ranges of grams: four for each shuffle partition, more if the text is longer than this for each.
RANGE_BYTES = 8 << 20
MOST_RANGES = 1 << 16
# The borders of ranges come from one of so many documents, and so many grams a range.
SAMPLED = 50
GRAMS_A_RANGE = 16

_MARK = b"\xff"  # in no UTF-8 text: the end of a piece
_PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", _MARK * 10 + b" ")

BLOCK = pa.schema([("range", pa.int32()), ("lang", pa.string()), ("grams", pa.binary())])
BLOCK_DDL = "range int, lang string, grams binary"
PATH = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("least", pa.int32()), ("len", pa.int32()), ("f", pa.int64()), ("open", pa.bool_())])
PATH_DDL = "lang string, phrase string, least int, len int, f long, open boolean"
GRAM_DDL = "lang string, gram array<binary>"


def words_and_marks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, A-Z lower-cased, with a mark at each end of a piece, in runs."""
    text = text.lower().translate(_PIECES)
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > RUN_BYTES:
            end = max(text.rfind(b" ", at, at + RUN_BYTES), text.rfind(_MARK, at, at + RUN_BYTES)) + 1
            if end == 0:  # a word longer than the run
                ends = [x for x in (text.find(b" ", at), text.find(_MARK, at)) if x >= 0]
                end = min(ends) + 1 if ends else len(text)
        yield text[at:end].replace(_MARK, b" \xff ").split()
        at = end
    yield [_MARK]


def grams_of(numbers: np.ndarray, longest: int) -> np.ndarray:
    """The gram that begins at each place, as rows of word numbers; 0 is a mark, or no word."""
    padded = np.r_[numbers, np.zeros(longest, numbers.dtype)]
    grams = np.empty((len(numbers), longest), np.int32)
    grams[:, 0] = numbers
    for k in range(1, longest):
        grams[:, k] = np.where(grams[:, k - 1] != 0, padded[k : k + len(numbers)], 0)
    return grams


def combined(grams: np.ndarray, weight: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, and the sum of their weights."""
    if not len(grams):
        return grams, np.zeros(0, np.int64)
    bits = max(1, int(grams.max()).bit_length())
    fit = max(1, 63 // bits)
    keys = []
    for k in range(0, grams.shape[1], fit):
        key = grams[:, k].astype(np.int64)
        for j in range(k + 1, min(k + fit, grams.shape[1])):
            key = (key << bits) | grams[:, j]
        keys.append(key)
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(grams), bool)
    new[0] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    starts = np.flatnonzero(new)
    sums = np.diff(np.r_[starts, len(grams)]) if weight is None else np.add.reduceat(weight[order], starts)
    return grams[order[starts]], sums.astype(np.int64)


def packed(grams: np.ndarray, sums: np.ndarray, words: list[bytes]) -> bytes:
    """Sorted grams of numbers into the sorted ``words`` (from 1), compressed column by column."""
    there = np.zeros(len(words) + 1, bool)
    there[grams] = there[0] = True
    used = np.flatnonzero(there)
    local = np.zeros(len(there), np.uint16 if len(used) < 1 << 16 else np.uint32)
    local[used] = np.arange(len(used))
    names = b" ".join([words[i - 1] for i in used[1:].tolist()])
    body = local[grams.T].tobytes()
    heavy = np.flatnonzero(sums != 1)
    weights = heavy.astype(np.uint32).tobytes() + sums[heavy].tobytes()
    return zlib.compress(struct.pack("<4q", len(grams), len(used), len(names), len(heavy)) + names + body + weights, 1)


def unpacked(block: bytes, longest: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    raw = zlib.decompress(block)
    n, used, named, heavy = struct.unpack_from("<4q", raw)
    at = 32 + named
    kind = np.dtype(np.uint16 if used < 1 << 16 else np.uint32)
    grams = np.frombuffer(raw, kind, n * longest, at).reshape(longest, n).T
    at += n * longest * kind.itemsize
    sums = np.ones(n, np.int64)
    places = np.frombuffer(raw, np.uint32, heavy, at).astype(np.int64)
    sums[places] = np.frombuffer(raw[at + 4 * heavy :], np.int64, heavy)
    return raw[32 : 32 + named].split(b" "), grams, sums


def below(grams: np.ndarray, words: list[bytes], border: list[bytes]) -> int:
    """How many of the sorted grams come before ``border``."""
    low, high = 0, len(grams)
    for k in range(grams.shape[1]):
        if k >= len(border):
            return low  # the border's own shorter gram comes first among those that begin with it
        place = bisect_left(words, border[k])
        number, column = place + 1, grams[low:high, k]
        if place == len(words) or words[place] != border[k]:
            return low + int(np.searchsorted(column, number))
        low, high = low + int(np.searchsorted(column, number)), low + int(np.searchsorted(column, number, "right"))
        if low == high:
            return low
    return low


class Chunk:
    """Words of one language, until they are combined and cut into ranges."""

    def __init__(self, lang: str, longest: int):
        self.lang, self.longest = lang, longest
        self.forget()

    def forget(self) -> None:
        self.number = defaultdict(count(1).__next__)
        self.number[_MARK] = 0
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes]) -> None:
        found = self.number
        self.held.append(np.fromiter(map(found.__getitem__, words), np.int64, len(words)))
        self.size += len(words)

    def take(self, whole: bool) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Sorted distinct grams, their sums, and the words in order; within a text, the last words stay."""
        numbers = np.concatenate([*self.held, np.zeros(0, np.int64)])
        stay = numbers[max(0, len(numbers) - self.longest + 1) :] if not whole else numbers[:0]
        grams = grams_of(numbers, self.longest)[: len(numbers) - len(stay)]
        grams = grams[grams[:, 0] != 0]
        names = [*self.number]  # a word's place is its number; the mark is at 0
        used = sorted(np.flatnonzero(np.bincount(numbers, minlength=1)[1:]).tolist(), key=lambda i: names[i + 1])
        rank = np.zeros(len(names), np.int32)
        rank[np.array(used, np.int64) + 1] = np.arange(1, len(used) + 1)
        grams, sums = combined(rank[grams], None)
        if whole and len(self.number) > HELD_WORDS:
            self.forget()
        else:
            self.held, self.size = [stay], len(stay)
        return grams, sums, [names[i + 1] for i in used]


def _blocks(batches: Iterator[pa.RecordBatch], longest: int, borders: list[tuple[str, list[bytes]]]) -> Iterator[pa.RecordBatch]:
    """Blocks ``(range, lang, grams)`` of each task's languages."""
    own: dict[str, tuple[int, list[list[bytes]]]] = {}

    def of_lang(lang: str) -> tuple[int, list[list[bytes]]]:
        if lang not in own:
            key = lang.encode()
            own[lang] = sum(x.encode() < key for x, _ in borders), [b for x, b in borders if x == lang]
        return own[lang]

    def flush(chunk: Chunk, whole: bool) -> Iterator[tuple]:
        grams, sums, words = chunk.take(whole)
        first, cuts = of_lang(chunk.lang)
        at = [below(grams, words, b) for b in cuts]
        for i, (a, b) in enumerate(zip([0, *at], [*at, len(grams)])):
            if a < b:
                yield first + i, chunk.lang, packed(grams[a:b], sums[a:b], words)

    def rows() -> Iterator[tuple]:
        chunks: dict[str, Chunk] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                chunk = chunks.get(lang)
                if chunk is None:
                    chunk = chunks[lang] = Chunk(lang, longest)
                for words in words_and_marks(text.as_py().encode()):
                    chunk.add(words)
                    if chunk.size > CHUNK_WORDS:
                        yield from flush(chunk, words[-1:] == [_MARK])
                if len(chunks) > MOST_LANGS or sum(c.size for c in chunks.values()) > CHUNK_WORDS:
                    for chunk in chunks.values():  # every one of them is at the end of a text
                        yield from flush(chunk, True)
                    if len(chunks) > MOST_LANGS:
                        chunks = {}
        for chunk in chunks.values():
            if chunk.size:
                yield from flush(chunk, True)

    yield from in_batches(rows(), BLOCK, 2)


def _sampled(batches: Iterator[pa.RecordBatch], longest: int, every: int) -> Iterator[pa.RecordBatch]:
    """Every so many grams of a sample of texts, for the borders of ranges."""
    held, at = [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for words in words_and_marks(text.as_py().encode()):
                while at < len(words):
                    gram = words[at : at + longest]
                    held.append((lang, gram[: gram.index(_MARK)] if _MARK in gram else gram))
                    at += every
                at -= len(words)
    if held:
        schema = pa.schema([("lang", pa.string()), ("gram", pa.list_(pa.binary()))])
        yield as_batch([h for h in held if h[1]], schema)


def range_borders(rows: DataFrame, longest: int) -> list[tuple[str, list[bytes]]]:
    """Borders ``(lang, words)`` of the ranges in order, at most MOST_RANGES of them."""
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    ranges = min(MOST_RANGES, max(4 * partitions(rows.sparkSession), -(-size // RANGE_BYTES)))
    some = rows.where(F.pmod(F.xxhash64("text", F.lit(11)), F.lit(SAMPLED)) == 0)
    every = max(1, size // 6 // SAMPLED // (GRAMS_A_RANGE * ranges))  # about six bytes a word
    found = some.mapInArrow(lambda b: _sampled(b, longest, every), GRAM_DDL).collect()  # some GRAMS_A_RANGE a range
    grams = sorted((lang.encode(), [bytes(w) for w in gram]) for lang, gram in found)
    cuts = [grams[i] for i in range(0, len(grams), max(1, len(grams) // ranges))][1:]
    return [(cuts[i][0].decode(), cuts[i][1]) for i in range(len(cuts)) if i == 0 or cuts[i] != cuts[i - 1]]


def flows(grams: np.ndarray, sums: np.ndarray, words: list[bytes], edges: list[list[bytes]], least: int) -> Iterator[tuple[list[bytes], int, int, bool]]:
    """Unary paths ``(words, shortest, f, open)`` of a range's sorted distinct grams.

    A path stands for its beginnings of ``shortest`` words and more, which all have the flow f.
    Phrases that begin a border in ``edges`` are open: their flow may go on in another range.
    """
    longest = grams.shape[1]
    new = np.zeros(len(grams), bool)
    new[0] = True
    levels = []
    for k in range(longest):
        new[1:] |= grams[1:, k] != grams[:-1, k]
        starts = np.flatnonzero(new)
        flow = np.add.reduceat(sums, starts)
        there = grams[starts, k] != 0
        levels.append((starts[there], flow[there]))
    number = {w: i + 1 for i, w in enumerate(words)}
    open_at: list[set[tuple[int, ...]]] = [set() for _ in range(longest)]
    for edge in edges:
        path = tuple(number.get(w, -1) for w in edge)
        for k in range(len(path)):
            open_at[k].add(path[: k + 1])
    shortest = {}  # of the paths that go on, by the place of their first gram
    for k, (starts, flow) in enumerate(levels):
        after = levels[k + 1] if k + 1 < longest else (starts[:0], flow[:0])
        at = np.searchsorted(after[0], starts)
        unary = np.zeros(len(starts), bool)
        inside = at < len(after[0])
        unary[inside] = (after[0][at[inside]] == starts[inside]) & (after[1][at[inside]] == flow[inside])
        is_open = np.zeros(len(starts), bool)
        for path in open_at[k]:
            low, high = 0, len(grams)
            for j, x in enumerate(path):
                column = grams[low:high, j]
                low, high = low + int(np.searchsorted(column, x)), low + int(np.searchsorted(column, x, "right"))
            if low < high:
                # Shorter grams come first in a run, so its first gram is the phrase's own start.
                is_open[np.searchsorted(starts, low)] = True
        going = {}
        for i in np.flatnonzero((flow >= least) | is_open).tolist():
            start, f = int(starts[i]), int(flow[i])
            names = lambda: [words[x - 1] for x in grams[start, : k + 1].tolist()]  # noqa: E731, B023
            if is_open[i]:
                yield names(), k + 1, f, True
            elif unary[i]:
                going[start] = shortest.get(start, k + 1)
            else:
                yield names(), shortest.get(start, k + 1), f, False
        shortest = going


def _paths(batches: Iterator[pa.RecordBatch], longest: int, least: int, borders: list[tuple[str, list[bytes]]]) -> Iterator[pa.RecordBatch]:
    """The paths of each range, from its blocks in order of range and language."""

    def of_range(at: int, lang: str, blocks: list[bytes]) -> Iterator[tuple]:
        parts = [unpacked(b, longest) for b in blocks]
        words = sorted(set().union(*(p[0] for p in parts)))
        number = {w: i + 1 for i, w in enumerate(words)}
        grams = np.concatenate([np.r_[np.int32(0), np.fromiter(map(number.__getitem__, w), np.int32, len(w))][g] for w, g, _ in parts])
        grams, sums = combined(grams, np.concatenate([p[2] for p in parts]))
        yield lang, "", 0, 0, int(sums.sum()), True
        edges = [borders[i][1] for i in (at - 1, at) if 0 <= i < len(borders) and borders[i][0] == lang]
        for names, first, f, is_open in flows(grams, sums, words, edges, least):
            yield lang, b" ".join(names).decode(), first, len(names), f, is_open

    def rows() -> Iterator[tuple]:
        at, held = None, []
        for batch in batches:
            for number, lang, block in zip(*(c.to_pylist() for c in batch.columns)):
                if (number, lang) != at:
                    if held:
                        yield from of_range(*at, held)
                    at, held = (number, lang), []
                held.append(block)
        if held:
            yield from of_range(*at, held)

    yield from in_batches(rows(), PATH, 1)


def phrase_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, len, f)`` of all phrases of 1 to ``longest`` words with f >= ``least``, and ``(lang, n)``."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    borders = range_borders(rows, longest)
    blocks = rows.mapInArrow(lambda b: _blocks(b, longest, borders), BLOCK_DDL)
    blocks = blocks.repartition(partitions(docs.sparkSession), "range").sortWithinPartitions("range", "lang")
    paths = materialise(blocks.mapInArrow(lambda b: _paths(b, longest, least, borders), PATH_DDL))
    whole = paths.where("NOT open").select("lang", F.split("phrase", " ").alias("words"), F.explode(F.sequence("least", "len")).alias("len"), "f")
    whole = whole.select("lang", F.array_join(F.slice("words", F.lit(1), F.col("len")), " ").alias("phrase"), "len", "f")
    parts = paths.where("open").groupBy("lang", "phrase", "len").agg(F.sum("f").alias("f"))
    counts = whole.unionByName(parts.where((F.col("len") > 0) & (F.col("f") >= least)))
    return materialise(counts), parts.where("len = 0").select("lang", F.col("f").alias("n"))


def mine_collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST, first: int | None = FIRST
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: collocations of each language, best first.

    Words are runs of other characters than space and tab, A-Z lower-cased; no phrase crosses
    ``. , ; : ! ?`` or U+000A to U+000D. A phrase of 2 to ``longest`` words that occurs a >=
    ``least`` times among the n words of its language scores ``floor(1000 a n / (l r))`` at the
    cut into parts with l and r occurrences where that is least, the smallest cut among ties.
    Phrases that lie inside a longer one with the same count go. The ``first`` by score, a and
    phrase stay, all if it is None.

    A null text is an empty one; a null language is ``und``, like that word itself. Empty texts
    and single words give no phrase; a word or text of any length is read whole. Repeated rows
    count each. Ties end with the phrase in byte order, which is unique in its language. Other
    columns are not read. An empty table gives an empty result.
    """
    counts, totals = phrase_counts(docs, lang_col, text_col, least, longest)
    phrases = counts.where("len > 1").withColumn("words", F.split("phrase", " "))
    # Inside a longer phrase of equal count, every phrase between the two has that count as
    # well, so it is enough to look at phrases of one word more, on either side.
    side = lambda at: F.array_join(F.slice("words", F.lit(at), F.col("len") - 1), " ")
    inside = phrases.where("len > 2").select("lang", F.explode(F.array(side(1), side(2))).alias("phrase"), "f")
    alone = phrases.join(inside, ["lang", "phrase", "f"], "left_anti")
    k = F.explode(F.sequence(F.lit(1), F.col("len") - 1)).alias("k")
    cuts = alone.select("lang", "phrase", "words", "len", F.col("f").alias("a"), k).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("len") - F.col("k")), " ").alias("tail"),
    )
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang")
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    score = F.expr("(a1000 * n1) div (l1 * r1)")
    scored = scored.withColumns({"a1000": (wide("a") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(24,0)"), "n1": wide("n"), "l1": wide("l"), "r1": wide("r")})
    scored = scored.withColumn("score", score.cast("long"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("b"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = best.select("lang", "phrase", "b.*").withColumn("rank", rank)
    ranked = ranked if first is None else ranked.where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(spark, folder: str) -> DataFrame:
    return mine_collocations(table(spark, folder, "documents"))


SQL = """
WITH t AS (
  SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), p AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS words FROM t
), g AS (
  SELECT lang, words[i:i + k - 1] AS g, k FROM (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM p), range(1, 6) AS sizes(k) WHERE i + k - 1 <= len(words)
), f AS (
  SELECT lang, g, k, count(*) AS f FROM g GROUP BY lang, g, k HAVING count(*) >= 100
), n AS (
  SELECT lang, sum(len(words)) AS n FROM p GROUP BY lang
), inside AS (
  SELECT DISTINCT lang, unnest([g[1:k - 1], g[2:k]]) AS g, f FROM f WHERE k > 2
), c AS (
  SELECT f.* FROM f ANTI JOIN inside USING (lang, g, f) WHERE k > 1
), cuts AS (
  SELECT lang, g, k, f AS a, unnest(range(1, k)) AS cut FROM c
), scored AS (
  SELECT cuts.lang, cuts.g, a, cut, x.f AS l, y.f AS r, n.n, (1000::HUGEINT * a * n.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.g = cuts.g[1:cut] JOIN f y ON y.lang = cuts.lang AND y.g = cuts.g[cut + 1:cuts.k] JOIN n ON n.lang = cuts.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(g, ' '))) AS rank,
  array_to_string(g, ' ') AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM best QUALIFY rank <= 2000
"""
