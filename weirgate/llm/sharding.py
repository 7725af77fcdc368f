"""Operator 12: shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has several points on a ring of CELLS cells. A text's hash is its key, so equal texts
lie at one place and in one arc, that between two points. The keys of an arc belong to the shard
of the point at its end. A shard takes no more rows than its bound; what overflows continues
clockwise to the next shard that is not full. Bounds are the row count divided among the shards,
so counts are at most one apart, and only what overflows leaves its own arc.

Loads are settled on counts by arc, a table whose size hangs on the ring only. Arcs come in, the
fuller ones first (by the bits of their counts, then in ring order), and each gives its rows to
its own shard as far as there is room, then to the next shards clockwise: so a hot text, which
makes its arc full, is spread over no more shards than it needs. Rows then find their shard by
their place in the arc's order of keys and ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weirgate.llm.common import crc32_list_sql, positioned, table
from weirgate.session import materialise

SHARDS = 16
VIRTUAL = 128
SEED = "ring"
CELLS = 1 << 16

LAW = "rows"


def _hex(text: Column, digits: int) -> Column:
    """The first hex digits of the text's md5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def ring_points(spark: SparkSession, shards: int, virtual: int, seed: str) -> DataFrame:
    """``(idx, cell, shard)``: the points in ring order; a table of ``shards * virtual`` rows."""
    shard, replica = F.floor(F.col("id") / virtual).cast("int"), F.col("id") % virtual
    points = spark.range(shards * virtual).select(shard.alias("shard"), replica.alias("replica"))
    points = points.withColumn("cell", _hex(F.concat_ws("/", F.lit(seed), "shard", "replica"), 4))
    order = Window.partitionBy(F.lit(0)).orderBy("cell", "shard", "replica")
    return points.select((F.row_number().over(order) - 1).alias("idx"), "cell", "shard")


def cells_to_arcs(points: DataFrame) -> DataFrame:
    """``(cell, idx)``: the first point at or after each cell, clockwise."""
    firsts = points.groupBy("cell").agg(F.min("idx").alias("own"))
    cells = points.sparkSession.range(CELLS).select(F.col("id").alias("cell")).join(firsts, "cell", "left")
    onwards = Window.partitionBy(F.lit(0)).orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, 0)
    return cells.select("cell", F.coalesce(F.last("own", ignorenulls=True).over(onwards), F.lit(0)).cast("int").alias("idx"))


def settled_loads(arcs: DataFrame, points: DataFrame, shards: int) -> DataFrame:
    """``(idx, entries)`` from ``arcs(idx, n)``: which rows of an arc go to which shard.

    An entry ``(first, stop, shard, slot)`` gives the arc's rows from ``first`` to before ``stop``
    to ``shard``, where the first of them has the place ``slot``.
    """
    ring = points.agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "shard"))), lambda p: p["shard"]).alias("ring"))
    order = F.struct((-F.length(F.bin("n"))).alias("bits"), "idx", "n")
    counted = arcs.agg(F.array_sort(F.collect_list(order)).alias("arcs"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    held = counted.join(ring, F.lit(True))  # one row each, of as many entries as the ring has points
    room = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.expr(f"rows div {shards}") + F.when(s < F.col("rows") % shards, 1).otherwise(0))
    none = F.array().cast("array<struct<idx:int,place:int,shard:int,n:bigint>>")

    def give(arc: Column, x: Column, shard: Column) -> Column:
        """What is left of the arc goes to ``shard`` as far as that has room."""
        take = F.least(x["left"], F.get(x["room"], shard))
        entry = F.struct(arc["idx"].alias("idx"), x["place"].alias("place"), shard.alias("shard"), take.alias("n"))
        return F.struct(
            F.when(take > 0, F.transform(x["room"], lambda r, s: F.when(s == shard, r - take).otherwise(r))).otherwise(x["room"]).alias("room"),
            F.when(take > 0, F.concat(x["taken"], F.array(entry))).otherwise(x["taken"]).alias("taken"),
            (x["left"] - take).alias("left"),
            (x["place"] + 1).alias("place"),
        )

    def settle(state: Column, arc: Column) -> Column:
        clockwise = F.array_distinct(F.slice(F.concat("ring", "ring"), arc["idx"] + 1, F.size("ring")))
        start = F.struct(state["room"].alias("room"), state["taken"].alias("taken"), arc["n"].alias("left"), F.lit(0).alias("place"))
        return F.aggregate(clockwise, start, lambda x, s: give(arc, x, s), lambda x: F.struct(x["room"].alias("room"), x["taken"].alias("taken")))

    taken = F.aggregate("arcs", F.struct(room.alias("room"), none.alias("taken")), settle)["taken"]
    entries = held.select(F.explode(taken).alias("t")).select("t.*")
    first = F.sum("n").over(Window.partitionBy("idx").orderBy("place")) - F.col("n")
    slot = F.sum("n").over(Window.partitionBy("shard").orderBy("idx")) - F.col("n")
    entries = entries.withColumns({"first": first, "slot": slot})
    return entries.groupBy("idx").agg(F.collect_list(F.struct("first", (F.col("first") + F.col("n")).alias("stop"), "shard", "slot")).alias("entries"))


def shard_rows(
    docs: DataFrame, shards: int = SHARDS, virtual: int = VIRTUAL, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``, one row per input row.

    Row counts of shards are at most one apart (law ``rows``); ``slot`` numbers the rows of a
    shard from 0 without gaps. Equal texts share a place on the ring, so they come to one shard
    unless it is full, and then to the next ones clockwise. ``grown_shard`` is null, for a
    further shard also lowers the bounds of the others.

    A null text is an empty one; a null id comes first among its equals; rows that repeat an id
    and a text are alike, so any of them may have either place. Texts are hashed whole. Other
    columns are not read. An empty table gives an empty result. ``shards * virtual`` must not
    exceed CELLS; settling the loads takes ``shards`` steps a point, in one row.
    """
    if not 0 < shards * virtual <= CELLS:
        raise ValueError(f"shards * virtual must lie between 1 and {CELLS}")
    spark, text = docs.sparkSession, F.coalesce(F.col(text_col), F.lit(""))
    rows = materialise(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("crc"),
            _hex(text, 15).alias("key"),
        )
    )
    points = materialise(ring_points(spark, shards, virtual, seed))
    in_arcs = rows.withColumn("cell", F.shiftright("key", 44)).join(F.broadcast(cells_to_arcs(points)), "cell").drop("cell")  # CELLS rows
    placed = materialise(positioned(in_arcs, ["idx"], ["key", "doc_id", "size", "crc"]).drop("total"))
    arcs = placed.groupBy("idx").agg(F.count("*").alias("n"))
    loads = settled_loads(arcs, points, shards)
    found = placed.join(F.broadcast(loads), "idx")  # a row for each point of the ring at most
    found = found.withColumn("e", F.filter("entries", lambda e: (e["first"] <= F.col("pos")) & (F.col("pos") < e["stop"]))[0])
    return found.select(
        "doc_id", "size", F.col("crc").alias("text_crc32"), F.lit(LAW).alias("law"), F.col("e.shard").cast("int").alias("shard"),
        (F.col("e.slot") + F.col("pos") - F.col("e.first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def query(spark, folder: str) -> DataFrame:
    return shard_rows(table(spark, folder, "documents"))


def _sql() -> str:
    n = SHARDS * VIRTUAL
    number = "CAST('0x' || substr(md5({}), 1, {}) AS BIGINT)".format
    before = "list_sum(list_transform(o.near, lambda x: CASE WHEN x.place < p.place THEN room[x.shard + 1] ELSE 0 END))"
    takes = f"list_transform(o.near, lambda p: greatest(0, least(room[p.shard + 1], o.n - {before})))"
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, {number("coalesce(text, '')", 15)} AS key,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bytes FROM documents
), c AS (
  SELECT doc_id, size, key, key >> 44 AS cell, {crc32_list_sql("bytes")} AS crc FROM d
), points AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY cell, shard, replica) - 1 AS idx, cell, shard
  FROM (SELECT i // {VIRTUAL} AS shard, i % {VIRTUAL} AS replica, {number(f"'{SEED}/' || (i // {VIRTUAL}) || '/' || (i % {VIRTUAL})", 4)} AS cell FROM range(0, {n}) AS r(i))
), clockwise AS MATERIALIZED (
  SELECT idx, list({{'shard': shard, 'place': place}} ORDER BY shard) AS near
  FROM (SELECT idx, shard, row_number() OVER (PARTITION BY idx ORDER BY far) - 1 AS place
    FROM (SELECT a.idx, b.shard, min((b.idx - a.idx + {n}) % {n}) AS far FROM points a, points b GROUP BY a.idx, b.shard)) GROUP BY idx
), r AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY idx ORDER BY key, doc_id NULLS FIRST, size, crc) - 1 AS pos
  FROM (SELECT c.*, coalesce((SELECT min(idx) FROM points WHERE points.cell >= c.cell), 0) AS idx FROM c)
), o AS MATERIALIZED (
  SELECT idx, n, near, row_number() OVER (ORDER BY length(bin(n)) DESC, idx) AS turn FROM (SELECT idx, count(*) AS n FROM r GROUP BY idx) JOIN clockwise USING (idx)
), settled(turn, room, idx, takes) AS (
  SELECT 0, list_transform(range(0, {SHARDS}), lambda s: total // {SHARDS} + CASE WHEN s < total % {SHARDS} THEN 1 ELSE 0 END), CAST(NULL AS BIGINT), CAST([] AS BIGINT[])
  FROM (SELECT count(*) AS total FROM r)
  UNION ALL
  SELECT turn, list_transform(range(1, {SHARDS + 1}), lambda s: room[s] - takes[s]), idx, takes
  FROM (SELECT o.turn, o.idx, settled.room, CAST({takes} AS BIGINT[]) AS takes FROM settled JOIN o ON o.turn = settled.turn + 1)
), taken AS (
  SELECT settled.idx, p.shard, p.place, settled.takes[p.shard + 1] AS n FROM settled JOIN clockwise USING (idx), unnest(clockwise.near) AS u(p) WHERE settled.takes[p.shard + 1] > 0
), e AS (
  SELECT *, sum(n) OVER (PARTITION BY idx ORDER BY place) - n AS first, sum(n) OVER (PARTITION BY shard ORDER BY idx) - n AS slot FROM taken
)
SELECT r.doc_id, r.size, r.crc AS text_crc32, '{LAW}' AS law, CAST(e.shard AS INTEGER) AS shard, CAST(e.slot + r.pos - e.first AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM r JOIN e ON e.idx = r.idx AND r.pos >= e.first AND r.pos < e.first + e.n
"""


SQL = _sql()
