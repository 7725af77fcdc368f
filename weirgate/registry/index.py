"""Crawl index, keep-first, key sets and the fetch list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.functions.text import surt_key, url_contains
from weirgate.operators import captures as cap
from weirgate.operators import seen
from weirgate.operators import worklist as wl
from weirgate.plans.fetchlist import fetch_list, request_list
from weirgate.registry.fixtures import CDX_SQL, cdx_order, cdx_table, write_archives
from weirgate.session import materialise, scratch_path
from weirgate.sources import cdx as cx
from weirgate.sources.tables import read_table
from weirgate.sources.warc import read_slices

MIN_LENGTH = 1_000
NOW = "2024-01-01 00:00:00"
LATER = "2024-01-02 00:00:00"


def _cdx(spark: SparkSession, sf: str) -> DataFrame:
    return cdx_table(read_table(spark, sf, "pages"))


def _now(text: str = NOW):
    return F.lit(text).cast("timestamp")


def _recrawled(spark: SparkSession, sf: str) -> DataFrame:
    """Usable captures of one collection, and again of the next under other keys and digests, as
    a page that moved and changed has them."""
    usable = _usable(spark, sf)
    later = usable.where("collection = 'C0'").withColumns({
        "urlkey": F.concat(F.lit("moved/"), "urlkey"), "digest": F.md5(F.concat(F.lit("changed "), "digest")), "collection": F.lit("C1"),
    })
    return usable.unionByName(later)


def _worklist(spark: SparkSession, sf: str) -> DataFrame:
    return fetch_list(_cdx(spark, sf), cdx_order(), _now(), MIN_LENGTH)


def _fetched(spark: SparkSession, sf: str, listed: DataFrame) -> DataFrame:
    """The requests read from archives of all pages, some of whose records are broken."""
    root = scratch_path(spark, "archives")
    pages = read_table(spark, sf, "pages").select("url", F.col("html").alias("raw"))
    stored = materialise(write_archives(listed.select("id", "url", "filename").join(pages, "url"), root, flaws=True))
    return materialise(read_slices(stored, root))


def _log(spark: SparkSession, sf: str, listed: DataFrame) -> DataFrame:
    # The first of two runs that share the list.
    results = wl.result_log(_fetched(spark, sf, listed.where("id % 2 = 0")), _now(LATER), F.lit(0))
    by_id = listed.where("filename = 'crawl-0.warc.gz'").select("id", url_contains(F.col("url"), ".COM/").alias("label"))
    by_url = listed.where("filename = 'crawl-1.warc.gz'").select("url", url_contains(F.col("url"), ".org/").alias("label"))
    labels = wl.label_log(by_id, _now(LATER), F.lit(1)).unionByName(wl.label_log_by_url(listed, by_url, _now(LATER), F.lit(2)))
    return results.unionByName(labels)


def _current(spark: SparkSession, sf: str) -> DataFrame:
    listed = materialise(_worklist(spark, sf))
    return wl.current_worklist(listed, _log(spark, sf, listed))


def _compacted(spark: SparkSession, sf: str) -> DataFrame:
    """The list after the same run, from a stored log: a snapshot between results and labels."""
    listed = materialise(_worklist(spark, sf))
    stored = wl.WorkLog(spark, scratch_path(spark, "log"))
    log = materialise(_log(spark, sf, listed))
    for batch, compact in ((0, True), (1, False), (2, True), (1, False)):  # a batch again changes nothing
        stored.append(log.where(F.col("batch") == batch))
        if compact:
            stored.compact()
    return stored.current(listed)


def _readable(df: DataFrame) -> DataFrame:
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return df.select("id", "url", "filename", "offset", "length", "result", "label", stamp("created"), stamp("updated"))


def cdx_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Index files written and scanned back, rows numbered newest capture first."""
    path = scratch_path(spark, "cdx")
    rows = _cdx(spark, sf).repartitionByRange("collection", F.desc("page_id")).sortWithinPartitions("collection", "page_id")
    rows.drop("page_id").write.partitionBy("collection").option("compression", "gzip").json(path)
    return wl.number_rows(cx.read_cdx(spark, path), cx.newest_first()).select("id", "urlkey", "url", "mime-detected", "status", "digest", "length", "offset", "filename")


# How the flawed index spells the status of the pages whose id leaves this number by 9.
FLAWED_STATUS = {1: "-", 2: "404.0", 3: "200.0", 4: "4.5", 5: "", 6: "200"}


def cdx_flawed(spark: SparkSession, sf: str) -> DataFrame:
    """An index with flawed lines: every line as usable or not, or why it was rejected."""
    path = scratch_path(spark, "cdx")
    kind = F.col("page_id") % 9
    status = F.coalesce(*[F.when(kind == k, F.lit(text)) for k, text in FLAWED_STATUS.items()], F.col("status").cast("string"))
    line = F.to_json(F.struct("urlkey", "url", "mime-detected", status.alias("status"), "digest", "length", "offset", "filename"))
    _cdx(spark, sf).select(F.when(kind == 7, F.substring(line, 1, 40)).otherwise(line).alias("value")).write.text(path)
    read = cx.read_cdx(spark, path)
    usable = cap.usable_captures(read, MIN_LENGTH).select("url", F.lit("usable").alias("verdict"), F.col("status").cast("string").alias("value"))
    rejected = cx.read_cdx_rejects(spark, path).select("url", F.concat(F.lit("rejected: "), "reason").alias("verdict"), "value")
    return usable.unionByName(rejected)


def cdx_lookup(pattern: str, key_form: str = "host"):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        table = _cdx(spark, sf)
        if key_form == "surt":
            table = table.withColumn("urlkey", surt_key(F.col("url")))
        return table.where(cx.matches_url(pattern, key_form)).select("page_id", "urlkey", "url")

    return query


def cdx_collection(collection: str | None):
    return lambda spark, sf: cx.choose_collection(_cdx(spark, sf), collection).select("page_id", "url", "collection")


def _usable(spark: SparkSession, sf: str) -> DataFrame:
    return cap.usable_captures(_cdx(spark, sf), MIN_LENGTH)


def _against_first_collection(test):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        cdx = _cdx(spark, sf)
        keys = materialise(cdx.where("collection = 'C0'").select("urlkey").distinct())
        return test(cdx.where("collection != 'C0'"), keys, "urlkey").select("page_id", "urlkey", "collection")

    return query


def key_set(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of one collection after another added to a stored set: each key once."""
    keys = seen.SeenKeys(spark, scratch_path(spark, "seen"), "urlkey")
    for name in ("C0", "C1", "C2"):
        keys.add(cx.choose_collection(_cdx(spark, sf), name))
    keys.compact()
    return keys.table()


def done_by_archive(spark: SparkSession, sf: str) -> DataFrame:
    return wl.with_markup(_fetched(spark, sf, _worklist(spark, sf))).select("id", "url", "raw")


QUERIES = {
    "cdx_scan": cdx_scan,
    "cdx_flawed_lines": cdx_flawed,
    "cdx_prefix_lookup": cdx_lookup("http://spam-farm.example.org/*"),
    "cdx_domain_lookup": cdx_lookup("*.example.com"),
    "cdx_exact_lookup": cdx_lookup("https://m.ththth.example.net/en/25#top"),
    "cdx_prefix_lookup_surt": cdx_lookup("http://www.cheap-pills.example.com/en/*", "surt"),
    "cdx_domain_lookup_surt": cdx_lookup("*.example.net", "surt"),
    "cdx_fields": lambda spark, sf: cx.select_fields(_cdx(spark, sf), "url,mime-detected,status,digest"),
    "cdx_newest_collection": cdx_collection(None),
    "cdx_all_collections": cdx_collection("all"),
    "cdx_one_collection": cdx_collection("C1"),
    "captures_usable": lambda spark, sf: _usable(spark, sf).select("page_id", "urlkey", "status", "length"),
    "captures_usable_default": lambda spark, sf: cap.usable_captures(_cdx(spark, sf)).select("page_id", "urlkey", "status", "length"),
    "captures_first_by_urlkey": lambda spark, sf: cap.keep_first(_usable(spark, sf), ["urlkey"], cdx_order()).select("page_id", "urlkey"),
    "captures_first_by_digest": lambda spark, sf: cap.keep_first(
        cap.keep_first(_usable(spark, sf), ["urlkey"], cdx_order()), ["digest"], cdx_order()
    ).select("page_id", "urlkey", "digest"),
    "capture_requests": lambda spark, sf: request_list(_cdx(spark, sf), cdx_order(), MIN_LENGTH),
    "repeated_digests": lambda spark, sf: cap.duplicate_urls(_usable(spark, sf).select(F.col("digest").alias("url"))),
    "keys_not_seen": _against_first_collection(seen.not_seen),
    "keys_seen": _against_first_collection(seen.seen),
    "keys_stored": key_set,
    "fetch_list": lambda spark, sf: _readable(_worklist(spark, sf)),
    "fetch_list_default": lambda spark, sf: _readable(fetch_list(_cdx(spark, sf), cdx_order(), _now())),
    "fetch_list_repeated_urls": lambda spark, sf: cap.duplicate_urls(_worklist(spark, sf)),
    "captures_repeated_urls": lambda spark, sf: cap.duplicate_urls(_recrawled(spark, sf)),
    "captures_unique_urls": lambda spark, sf: cap.duplicate_urls(cap.unique_captures(_recrawled(spark, sf), cdx_order())),
    "fetch_list_after_run": lambda spark, sf: _readable(_current(spark, sf)),
    "fetch_list_after_compaction": lambda spark, sf: _readable(_compacted(spark, sf)),
    "fetch_list_next": lambda spark, sf: wl.incomplete(_current(spark, sf), limit=60, offset=20),
    "fetch_list_slices": lambda spark, sf: wl.run_slices(_current(spark, sf), 4),
    "fetch_list_unlabelled": lambda spark, sf: wl.unlabelled(wl.current_worklist(
        listed := _worklist(spark, sf), _log(spark, sf, listed).where("batch != 2"))),
    "fetch_list_by_url": lambda spark, sf: _readable(wl.by_url(_current(spark, sf), "https://m.ththth.example.net/en/25#top")),
    "fetched_with_markup": done_by_archive,
}

_USABLE = CDX_SQL + f""", usable AS (
  SELECT * REPLACE (coalesce(status, 0) AS status) FROM cdx
  WHERE length > {MIN_LENGTH} AND mime = 'text/html' AND coalesce(status, 0) < 300)"""
_BY_KEY = _USABLE + """, by_key AS (
  SELECT * FROM usable QUALIFY row_number() OVER (PARTITION BY urlkey ORDER BY collection DESC, page_id) = 1)"""
_BY_DIGEST = _BY_KEY + """, by_digest AS (
  SELECT * FROM by_key QUALIFY row_number() OVER (PARTITION BY digest ORDER BY collection DESC, page_id) = 1)"""
WORKLIST_SQL = _BY_DIGEST + f""", by_url AS (
  SELECT * FROM by_digest QUALIFY row_number() OVER (PARTITION BY url ORDER BY collection DESC, page_id) = 1),
listed AS (
  SELECT row_number() OVER (ORDER BY collection DESC, page_id)::BIGINT AS id, url, filename, "offset", length,
    NULL::BOOLEAN AS result, NULL::BOOLEAN AS label, '{NOW}' AS created, '{NOW}' AS updated FROM by_url)"""
_CURRENT = WORKLIST_SQL + f""", current_list AS (
  SELECT l.id, l.url, l.filename, l."offset", l.length,
    CASE WHEN l.id % 2 = 0 THEN l.id % 10 NOT IN (4, 7) END AS result,
    CASE l.filename WHEN 'crawl-0.warc.gz' THEN contains(lower(l.url), '.com/')
      WHEN 'crawl-1.warc.gz' THEN contains(lower(l.url), '.org/') END AS label,
    '{NOW}' AS created, CASE WHEN l.id % 2 = 0 OR l.filename <> 'crawl-2.warc.gz' THEN '{LATER}' ELSE '{NOW}' END AS updated
  FROM listed l)"""
_TODO = 'id, url, filename, "offset", length'
_HOST = r"lower(regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)', 1))"
_SURT = CDX_SQL + r""", parts AS (
  SELECT page_id, url, regexp_replace(regexp_replace(lower(url), '^([a-z][a-z0-9+.-]*:)?//', ''), '#.*$', '') AS rest FROM cdx),
halves AS (
  SELECT page_id, url, regexp_replace(regexp_extract(rest, '^([^/?:]*)', 1), '^www[0-9]*\.', '') AS host,
    regexp_replace(rest, '^[^/?]*', '') AS tail FROM parts),
keyed AS (
  SELECT page_id, url, array_to_string(list_reverse(string_split(host, '.')), ',') || ')'
    || CASE WHEN starts_with(tail, '/') THEN tail ELSE '/' || tail END AS urlkey FROM halves)"""

SQL = {
    "cdx_scan": f"""WITH {CDX_SQL}
        SELECT row_number() OVER (ORDER BY collection DESC, page_id)::BIGINT AS id, urlkey, url, mime AS "mime-detected",
          status, digest, length, "offset", filename FROM cdx""",
    "cdx_flawed_lines": f"""WITH {CDX_SQL}, spelled AS (
          SELECT *, CASE page_id % 9 {" ".join(f"WHEN {k} THEN '{t}'" for k, t in FLAWED_STATUS.items())} ELSE status::VARCHAR END AS text FROM cdx),
        lines AS (SELECT *, CASE WHEN page_id % 9 IN (1, 4) THEN 'status' WHEN page_id % 9 = 7 THEN 'line' END AS reason,
          coalesce(try_cast(nullif(text, '') AS DOUBLE)::INTEGER, 0) AS code FROM spelled)
        SELECT url, 'usable' AS verdict, code::VARCHAR AS "value" FROM lines
        WHERE reason IS NULL AND length > {MIN_LENGTH} AND mime = 'text/html' AND code < 300
        UNION ALL SELECT CASE WHEN reason = 'status' THEN url END, 'rejected: ' || reason,
          CASE WHEN reason = 'status' THEN text ELSE '{{"urlkey":"' || substr(urlkey || '","url":"' || url, 1, 29) END
        FROM lines WHERE reason IS NOT NULL""",
    "captures_repeated_urls": f"""WITH {_USABLE} SELECT url, count(*) AS n FROM (
          SELECT url FROM usable UNION ALL SELECT url FROM usable WHERE collection = 'C0') GROUP BY url HAVING count(*) > 1""",
    "captures_unique_urls": f"WITH {_USABLE} SELECT url, count(*) AS n FROM usable WHERE false GROUP BY url",
    "cdx_prefix_lookup": f"""WITH {CDX_SQL} SELECT page_id, urlkey, url FROM cdx
        WHERE starts_with(urlkey, 'spam-farm.example.org/') OR urlkey = 'spam-farm.example.org'""",
    "cdx_domain_lookup": f"""WITH {CDX_SQL} SELECT page_id, urlkey, url FROM cdx
        WHERE {_HOST} = 'example.com' OR ends_with({_HOST}, '.example.com')""",
    "cdx_exact_lookup": f"WITH {CDX_SQL} SELECT page_id, urlkey, url FROM cdx WHERE urlkey = 'ththth.example.net/en/25'",
    "cdx_prefix_lookup_surt": f"WITH {_SURT} SELECT page_id, urlkey, url FROM keyed WHERE starts_with(urlkey, 'com,example,cheap-pills)/en/')",
    "cdx_domain_lookup_surt": f"""WITH {_SURT} SELECT page_id, urlkey, url FROM keyed
        WHERE starts_with(urlkey, 'net,example)') OR starts_with(urlkey, 'net,example,')""",
    "cdx_fields": f'WITH {CDX_SQL} SELECT url, mime AS "mime-detected", status, digest FROM cdx',
    "cdx_newest_collection": f"WITH {CDX_SQL} SELECT page_id, url, collection FROM cdx WHERE collection = (SELECT max(collection) FROM cdx)",
    "cdx_all_collections": f"WITH {CDX_SQL} SELECT page_id, url, collection FROM cdx",
    "cdx_one_collection": f"WITH {CDX_SQL} SELECT page_id, url, collection FROM cdx WHERE collection = 'C1'",
    "captures_usable": f"WITH {_USABLE} SELECT page_id, urlkey, status, length FROM usable",
    "captures_usable_default": f"WITH {_USABLE.replace(f'length > {MIN_LENGTH}', 'length > 10000')} SELECT page_id, urlkey, status, length FROM usable",
    "captures_first_by_urlkey": f"WITH {_BY_KEY} SELECT page_id, urlkey FROM by_key",
    "captures_first_by_digest": f"WITH {_BY_DIGEST} SELECT page_id, urlkey, digest FROM by_digest",
    "capture_requests": f'WITH {WORKLIST_SQL} SELECT url, filename, "offset", length FROM listed',
    "repeated_digests": f"WITH {_USABLE} SELECT digest AS url, count(*) AS n FROM usable GROUP BY digest HAVING count(*) > 1",
    "keys_not_seen": f"""WITH {CDX_SQL} SELECT page_id, urlkey, collection FROM cdx
        WHERE collection <> 'C0' AND urlkey NOT IN (SELECT urlkey FROM cdx WHERE collection = 'C0')""",
    "keys_seen": f"""WITH {CDX_SQL} SELECT page_id, urlkey, collection FROM cdx
        WHERE collection <> 'C0' AND urlkey IN (SELECT urlkey FROM cdx WHERE collection = 'C0')""",
    "keys_stored": f"WITH {CDX_SQL} SELECT DISTINCT urlkey FROM cdx",
    "fetch_list": f"WITH {WORKLIST_SQL} SELECT * FROM listed",
    "fetch_list_default": f"WITH {WORKLIST_SQL.replace(f'length > {MIN_LENGTH}', 'length > 10000')} SELECT * FROM listed",
    "fetch_list_repeated_urls": f"WITH {WORKLIST_SQL} SELECT url, count(*) AS n FROM listed GROUP BY url HAVING count(*) > 1",
    "fetch_list_after_run": f"WITH {_CURRENT} SELECT * FROM current_list",
    "fetch_list_after_compaction": f"WITH {_CURRENT} SELECT * FROM current_list",
    "fetch_list_next": f"WITH {_CURRENT} SELECT {_TODO} FROM current_list WHERE result IS NULL ORDER BY id LIMIT 60 OFFSET 20",
    "fetch_list_slices": f"WITH {_CURRENT} SELECT {_TODO}, id % 4 AS slice FROM current_list WHERE result IS NULL",
    "fetch_list_unlabelled": f"""WITH {_CURRENT} SELECT id, url FROM current_list
        WHERE filename <> 'crawl-0.warc.gz'""",
    "fetch_list_by_url": f"WITH {_CURRENT} SELECT * FROM current_list WHERE url = 'https://m.ththth.example.net/en/25#top'",
    "fetched_with_markup": f"""WITH {WORKLIST_SQL} SELECT id, url, html AS raw FROM listed JOIN pages USING (url)
        WHERE id % 10 NOT IN (4, 7)""",
}
