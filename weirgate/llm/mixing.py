"""Operator 8: mixing sources to target weights by Sainte-Laguë apportionment.

Documents of a source are dealt to shards. Each shard's words, in a seeded order of its
documents, are cut into blocks of equal length. Highest quotients give every source a whole
number of blocks, then every shard of the source; the shard takes that many blocks of its
stream in a seeded order, going through the stream again when the quota exceeds it. Sources
whose target is no more than a few blocks share theirs among themselves, in blocks of a word.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirgate.llm.common import free_name, table
from weirgate.session import materialise

WEIGHTS = (1, 2, 3)
REPEATS = 3
BLOCK_WORDS = 50
# A source with a target below so many blocks is apportioned by words.
FEW_BLOCKS = 20
SHARD_DOCUMENTS = 2_000
SEED = 20
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of ``text``: separators to single spaces, then spaces between words plus one."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.when(flat == "", F.lit(0)).otherwise(F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit(""))) + 1).cast("long")


def sainte_lague(votes: np.ndarray, most: np.ndarray, seats: int) -> np.ndarray:
    """Seats by highest quotients ``votes / (2 * seats + 1)``, at most ``most`` each.

    It starts from the rounding that a common divisor gives and then moves single seats, so
    the steps depend on the number of parties and not on the number of seats. Ties go to the
    earlier party.
    """
    votes, most = votes.astype(float), np.where(votes > 0, most, 0).astype(np.int64)
    seats = int(min(seats, most.sum()))
    low, high = 0.0, 2.0 * seats + 2.0
    total = max(votes.sum(), 1e-300)
    given = lambda x: np.minimum(np.floor(votes / total * x + 0.5), most).astype(np.int64)
    while given(high).sum() < seats and high < 1e300:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if given(middle).sum() <= seats else (low, middle)
    won = given(low)
    while won.sum() < seats:
        won[np.argmax(np.where(won < most, votes / (2 * won + 1), -1.0))] += 1
    return won


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn. A source is capped if
    its cap per weight is at most the level that the rest shares; in the order of that ratio
    the level after i capped sources is (total - their caps) / (weight of the others), and the
    capped ones are a prefix. Targets come from running sums over one row per source.
    """
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    rows = sizes.withColumn("weight", weight.cast("double")).withColumn("cap", F.col("source_size") * float(repeats))
    by_ratio = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.encode("source", "utf-8"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy(F.lit(0))
    rows = rows.withColumn("place", F.row_number().over(by_ratio))
    rows = rows.withColumn("used", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    rows = rows.withColumn("left", F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rows = rows.withColumn("level", (F.sum("source_size").over(everywhere) - F.col("used")) / F.col("left"))
    rows = rows.withColumn("capped", F.col("cap") / F.col("weight") <= F.col("level"))
    first_uncapped = F.min(F.when(~F.col("capped"), F.struct("place", "level"))).over(everywhere)
    level = first_uncapped["level"]
    target = F.when(F.col("capped"), F.col("cap")).otherwise(level * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def _blocks(words: Column) -> Column:
    return F.ceil(words / F.col("block")).cast("long")


def _source_quotas(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("source_no", ignore_index=True)
    rows["quota"] = sainte_lague(rows["target"].to_numpy(), rows["most"].to_numpy(), int(rows["blocks"].iloc[0]))
    return rows


def _shard_quotas(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("shard", ignore_index=True)
    rows["shard_quota"] = sainte_lague(rows["words"].to_numpy(), rows["most"].to_numpy(), int(rows["quota"].iloc[0]))
    return rows[["source_no", "shard", "words", "shard_quota"]]


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    repeats: int = REPEATS,
    block: int = BLOCK_WORDS,
    shard_documents: int = SHARD_DOCUMENTS,
    seed: int = SEED,
    row_col: str | None = None,
) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, passes)``, one row per input row.

    ``passes`` lists what the mix takes: for each time it goes through the document, the word
    ranges ``(start, end)`` it takes; ``taken`` is their length. The words taken from a source
    differ from its target by the rounding to blocks and by the shorter last block of a shard.

    Nulls: a null text has no words, a null source is a source of its own, a null id is kept;
    documents without words have ``taken`` 0. Repeated rows are documents each, side by side
    in the seeded order. A long text spans many blocks. Extra columns are not read. An empty
    table gives an empty result. The order within a shard hangs on ids, sizes and the seed
    only, so reruns agree. Sources, and shards of a source, are tables of a row for each;
    documents are never gathered beyond a shard.
    """
    sized = materialise(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"),
            *([F.col(row_col).alias("row")] if row_col else []),
        )
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    targets = source_targets(totals.select("source", "source_size"), weights, repeats).join(
        totals.select(F.col("source").alias("_s"), "documents"), F.equal_null("source", "_s")
    )
    everywhere = Window.partitionBy(F.lit(0))
    same_block = Window.partitionBy("block")
    blocked = targets.withColumn("block", F.when(F.col("target") < FEW_BLOCKS * block, 1).otherwise(block))
    numbered = blocked.select(
        F.row_number().over(everywhere.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))).alias("source_no"),
        "source",
        "source_size",
        F.col("target"),
        F.greatest(F.lit(1), F.ceil(F.col("documents") / shard_documents)).cast("long").alias("shards"),
        "block",
        F.round(F.sum("target").over(same_block) / F.col("block")).cast("long").alias("blocks"),
        F.ceil(F.col("source_size") * repeats / F.col("block")).cast("long").alias("most"),
    )
    kinds = "source_no int, source string, source_size long, target double, shards long, block int, blocks long, most long, quota long"
    sources = materialise(numbered.groupBy("block").applyInPandas(_source_quotas, kinds))

    row = ["row"] if row_col else []
    named = sources.select(F.col("source").alias("_s"), "source_no", "source_size", "target", "shards", "block", "quota")
    dealt = sized.join(named, F.equal_null("source", "_s")).select(
        "doc_id", "size", "source_no", "source_size", "target", "block", "quota",
        F.pmod(F.xxhash64("doc_id", F.lit(seed)), "shards").alias("shard"), *row,
    )
    shards = dealt.groupBy("source_no", "shard").agg(F.sum("size").alias("words"), F.first("quota").alias("quota"), F.first("block").alias("block"))
    shards = shards.withColumn("most", _blocks(F.col("words")) * repeats)
    quotas = shards.groupBy("source_no").applyInPandas(_shard_quotas, "source_no int, shard long, words long, shard_quota long")

    stream = Window.partitionBy("source_no", "shard").orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id", "size")
    placed = dealt.withColumn("stop", F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.join(quotas, ["source_no", "shard"]).withColumn("start", F.col("stop") - F.col("size"))
    n = _blocks(F.col("words"))
    placed = placed.withColumn("n", n).withColumn("whole", F.when(n > 0, F.floor(F.col("shard_quota") / n)).otherwise(0).cast("int"))
    placed = placed.withColumn("more", F.col("shard_quota") - F.col("whole") * F.col("n"))
    ranges = F.when(F.col("size") == 0, F.array().cast("array<struct<start:long,stop:long>>")).otherwise(_taken_ranges(seed))
    placed = placed.withColumn("ranges", ranges)
    whole = F.array_repeat(F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("size").alias("stop"))), F.when(F.col("size") > 0, F.col("whole")).otherwise(0))
    part = F.when(F.size("ranges") > 0, F.array("ranges")).otherwise(F.array().cast("array<array<struct<start:long,stop:long>>>"))
    some = F.aggregate("ranges", F.lit(0).cast("long"), lambda a, r: a + r["stop"] - r["start"])
    taken = F.col("size") * F.col("whole") + some
    return placed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), F.concat(whole, part).alias("passes"), *row)


def _taken_ranges(seed: int) -> Column:
    """Word ranges of the document in those of its blocks that the last, partial pass takes.

    Block i comes at place ``(spread(i) + turn) mod n`` of the shard's seeded order.
    """
    block = F.col("block").cast("long")
    first, last = F.floor(F.col("start") / block), F.floor((F.col("stop") - 1) / block)
    turn = F.pmod(F.xxhash64(F.col("source_no"), F.col("shard"), F.lit(seed)), F.greatest("n", F.lit(1)))
    chosen = F.filter(F.sequence(first, last), lambda i: F.pmod(_spread(i, F.col("n")) + turn, F.col("n")) < F.col("more"))
    cut = lambda i: F.struct(
        (F.greatest(i * block, F.col("start")) - F.col("start")).alias("start"),
        (F.least((i + 1) * block, F.col("stop")) - F.col("start")).alias("stop"),
    )
    return F.transform(chosen, cut)


def _spread(i: Column, n: Column) -> Column:
    """A one-to-one map of 0..n-1 to itself: multiples of a number without common factor with n."""
    step = F.lit(1).cast("long")
    for prime in (7919, 104_729, 1_299_709):
        step = F.when(n % prime != 0, F.lit(prime).cast("long")).otherwise(step)
    return (i * (step % n)) % n


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents: one row for each pass, with the words that the pass takes.

    A whole pass keeps the text as it is; a partial one has the taken words, joined by one
    space. The other columns are those of the row; ``n_chars`` is counted anew. Rows are
    numbered once and follow their numbers, so null and repeated ids are rows like others.
    """
    row = free_name(docs, "row_no")
    numbered = materialise(docs.withColumn(row, F.monotonically_increasing_id()))
    plan = mix_sources(numbered, row_col=row).where("taken > 0").select(F.col("row").alias("_row"), F.col("size").alias("_size"), F.explode("passes").alias("_ranges"))
    fields = {c: F.col("_doc").getField(c) for c in docs.columns}
    joined = numbered.select(F.col(row).alias("_row"), F.struct(*docs.columns).alias("_doc")).join(plan, "_row")
    words = F.filter(F.split(fields["text"], r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # The words are the one element of a list, so that a text is split once and not for each range.
    taken = lambda w: F.flatten(F.transform("_ranges", lambda r: F.slice(w, (r["start"] + 1).cast("int"), (r["stop"] - r["start"]).cast("int"))))
    some = F.transform(F.array(words), lambda w: F.array_join(taken(w), " "))[0]
    entire = (F.size("_ranges") == 1) & (F.col("_ranges")[0]["stop"] - F.col("_ranges")[0]["start"] == F.col("_size"))
    whole = joined.where(entire).select(*[f.alias(c) for c, f in fields.items()])
    cut = joined.where(~entire).withColumn("_text", some)
    fields |= {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return whole.unionByName(cut.select(*[fields[c].alias(c) for c in docs.columns]))


def query(spark, folder: str) -> DataFrame:
    return mix_sources(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")
