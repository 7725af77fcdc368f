"""Text measures, filters and funnel reports over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.functions import text as tx
from weirgate.functions.kernels import DUP_SIZES, REPETITION_FIELDS, TOP_SIZES
from weirgate.operators import funnel
from weirgate.operators import quality as q
from weirgate.sources.tables import read_table

CONFIG = q.FilterConfig()
PLAIN_MEASURES = [m for m in q.MEASURES if m not in REPETITION_FIELDS]


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "documents")


def verdicts(spark: SparkSession, sf: str, stages: tuple[str, ...] = q.STAGES) -> DataFrame:
    judged = q.with_verdict(q.with_measures(_docs(spark, sf), CONFIG, ngrams="repetition" in stages), CONFIG, stages)
    return judged.select("doc_id", "source", "lang", F.col("n_chars_text").alias("doc_len"), "stage", "reason")


def _stage(name: str):
    return lambda spark, sf: verdicts(spark, sf, (name,)).select("doc_id", "reason")


def _counts(spark: SparkSession, sf: str) -> DataFrame:
    return funnel.stage_counts(verdicts(spark, sf))


def kept_per_source(spark: SparkSession, sf: str) -> DataFrame:
    """Documents each rule drops per source, and how many remain."""
    judged = verdicts(spark, sf)
    outcome = judged.select("source", F.coalesce("stage", F.lit("kept")).alias("stage"), F.coalesce("reason", F.lit("kept")).alias("reason"))
    return outcome.groupBy("source", "stage", "reason").agg(F.count("*").alias("n"))


def _all_counts(spark: SparkSession, sf: str) -> DataFrame:
    return funnel.all_counts(verdicts(spark, sf)).withColumn("doc_len_avg", F.round("doc_len_avg", 6))


def _nested(spark: SparkSession, sf: str) -> DataFrame:
    """Stage counts with the drops by reason as one JSON object."""
    judged = verdicts(spark, sf)
    nested = funnel.nested_counts(funnel.stage_counts(judged), funnel.reason_counts(judged))
    dropped_by = F.to_json(F.map_from_entries(F.array_sort(F.map_entries("dropped_by"))))
    return nested.select("source", "stage", "total", "forwarded", "dropped", dropped_by.alias("dropped_by"))


QUERIES = {
    "kept_per_source": kept_per_source,
    "text_measures": lambda spark, sf: q.with_measures(_docs(spark, sf)).select("doc_id", *PLAIN_MEASURES),
    "repetition_measures": lambda spark, sf: q.with_measures(_docs(spark, sf)).select("doc_id", *REPETITION_FIELDS),
    "repetition_filter": _stage("repetition"),
    "quality_filter": _stage("quality"),
    "fineweb_filter": _stage("fineweb"),
    "filter_chain": lambda spark, sf: verdicts(spark, sf).select("doc_id", "stage", "reason"),
    "filter_survivors": lambda spark, sf: verdicts(spark, sf).where("reason IS NULL").select("doc_id", "source", "doc_len"),
    "funnel_stage_counts": lambda spark, sf: _counts(spark, sf).withColumn("doc_len_avg", F.round("doc_len_avg", 6)),
    "funnel_reason_counts": lambda spark, sf: funnel.reason_counts(verdicts(spark, sf)),
    "funnel_stage_totals": lambda spark, sf: funnel.stage_totals(_counts(spark, sf)),
    "funnel_drop_shares": lambda spark, sf: funnel.drop_shares(funnel.stage_totals(_counts(spark, sf))).withColumn("share", F.round("share", 9)),
    "funnel_all_counts": _all_counts,
    "funnel_nested_counts": _nested,
    "token_counts": lambda spark, sf: _docs(spark, sf).select("doc_id", tx.token_count(F.col("text")).alias("n_tokens")),
    "token_totals": lambda spark, sf: _docs(spark, sf).groupBy("source").agg(F.sum(tx.token_count(F.col("text"))).alias("n_tokens")),
    "document_lengths": lambda spark, sf: _docs(spark, sf).groupBy("source").agg(
        F.min(F.length("text").cast("long")).alias("len_min"), F.max(F.length("text").cast("long")).alias("len_max"),
        F.round(F.avg(F.length("text")), 6).alias("len_avg")),
    "quotes_straightened": lambda spark, sf: _docs(spark, sf).select("doc_id", tx.straighten_quotes(F.col("text")).alias("text")),
}


def _quoted(names: list[str]) -> str:
    return ", ".join(f"'{n}'" for n in names)


ARRAYS_SQL = f"""
arrays AS (
  SELECT doc_id, source, lang, text, regexp_extract_all(text, '{tx.WORD}') AS words,
    [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '\\S')] AS lines,
    [x FOR x IN string_split_regex(text, '\\n{{2,}}') IF regexp_matches(x, '\\S')] AS paras
  FROM (SELECT doc_id, source, lang, coalesce(text, '') AS text FROM documents))"""


def _dup_chars_sql(a: str) -> str:
    return f"(length(array_to_string({a}, '')) - length(array_to_string(list_distinct({a}), '')))::BIGINT"


def _lines_like_sql(pattern: str) -> str:
    return "len([x FOR x IN lines IF regexp_matches(x, '" + pattern.replace("'", "''") + "')])::BIGINT"


_STOP_SQL = "CASE lang " + " ".join(
    f"WHEN '{code}' THEN len(list_intersect(list_distinct([lower(x) FOR x IN words]), list_distinct([{_quoted(listed)}])))"
    for code, listed in q.STOP_WORDS.items()
) + " END::BIGINT"

MEASURES_SQL = ARRAYS_SQL + f""",
plain AS (
  SELECT doc_id, source, lang, length(text)::BIGINT AS n_chars_text, length(replace(text, chr(10), ''))::BIGINT AS n_chars_inline,
    len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, {_dup_chars_sql('lines')} AS n_dup_line_chars,
    len(paras)::BIGINT AS n_paras, (len(paras) - len(list_distinct(paras)))::BIGINT AS n_dup_paras, {_dup_chars_sql('paras')} AS n_dup_para_chars,
    len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS n_word_chars,
    len(regexp_extract_all(text, '{tx.TOKEN}'))::BIGINT AS n_tokens, len(regexp_extract_all(text, '{tx.LETTER_TOKEN}'))::BIGINT AS n_letter_tokens,
    len(regexp_extract_all(text, '#'))::BIGINT AS n_hashes, len(regexp_extract_all(text, '\\.\\.\\.|…'))::BIGINT AS n_ellipses,
    {_lines_like_sql('^[[:space:]]*[•*-]')} AS n_bullet_lines, {_lines_like_sql('(?:[.][.][.]|…)[[:space:]]*$')} AS n_ellipsis_lines,
    {_lines_like_sql('''[.!?…"'”’»][[:space:]]*$''')} AS n_punct_lines,
    len([x FOR x IN lines IF length(x) < {CONFIG.short_line_chars}])::BIGINT AS n_short_lines,
    {_STOP_SQL} AS n_stop_words
  FROM arrays)"""

_TOP = ", ".join(f"coalesce(max(CASE WHEN n = {n} THEN top END), 0)::BIGINT AS top_{n}_chars" for n in TOP_SIZES)
_DUP = ", ".join(f"coalesce(max(CASE WHEN n = {n} THEN dup END), 0)::BIGINT AS dup_{n}_chars" for n in DUP_SIZES)
_NEXT = ", ".join(f"lead(w, {i}) OVER follow AS w{i}" for i in range(1, 10))
_GRAMS = " UNION ALL ".join(
    f"SELECT doc_id, {n} AS n, p, w || ' ' || " + " || ' ' || ".join(f"w{i}" for i in range(1, n)) + f" AS gram FROM wide WHERE w{n - 1} IS NOT NULL"
    for n in range(2, 11)
)
REPETITION_SQL = f""",
tok AS (SELECT doc_id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS p FROM arrays),
wide AS (SELECT doc_id, p, w, {_NEXT} FROM tok WINDOW follow AS (PARTITION BY doc_id ORDER BY p)),
grams AS ({_GRAMS}),
seen_grams AS (
  SELECT doc_id, n, p, gram, row_number() OVER (PARTITION BY doc_id, n, gram ORDER BY p) AS k,
    count(*) OVER (PARTITION BY doc_id, n, gram) AS c FROM grams),
tops AS (
  SELECT doc_id, n, c * length(gram) AS top FROM seen_grams WHERE c > 1 AND n <= {max(TOP_SIZES)}
  QUALIFY row_number() OVER (PARTITION BY doc_id, n ORDER BY c DESC, length(gram) DESC) = 1),
covered AS (
  SELECT DISTINCT doc_id, n, unnest(range(p, p + n)) AS p FROM seen_grams WHERE k > 1 AND n >= {min(DUP_SIZES)}),
dups AS (
  SELECT c.doc_id, c.n, sum(length(t.w)) AS dup FROM covered c JOIN tok t ON t.doc_id = c.doc_id AND t.p = c.p GROUP BY c.doc_id, c.n),
repetition AS (
  SELECT d.doc_id, {_TOP}, {_DUP}
  FROM documents d LEFT JOIN (
    SELECT doc_id, n, top, NULL AS dup FROM tops UNION ALL SELECT doc_id, n, NULL, dup FROM dups) USING (doc_id)
  GROUP BY d.doc_id)"""


def _ratio(part: str, whole: str) -> str:
    return f"({part}::DOUBLE / nullif({whole}, 0)::DOUBLE)"


def _rules_sql() -> dict[str, list[tuple[str, str]]]:
    c = CONFIG
    empty = ("empty", "n_words = 0 OR n_lines = 0")
    return {
        "repetition": [
            empty,
            ("dup_para_frac", f"{_ratio('n_dup_paras', 'n_paras')} > {c.max_dup_para_share}::DOUBLE"),
            ("dup_para_char_frac", f"{_ratio('n_dup_para_chars', 'n_chars_text')} > {c.max_dup_para_char_share}::DOUBLE"),
            ("dup_line_frac", f"{_ratio('n_dup_lines', 'n_lines')} > {c.max_dup_line_share}::DOUBLE"),
            ("dup_line_char_frac", f"{_ratio('n_dup_line_chars', 'n_chars_text')} > {c.max_dup_line_char_share}::DOUBLE"),
            *[(f"top_{n}_gram", f"{_ratio(f'top_{n}_chars', 'n_chars_text')} > {c.max_top_share[n]}::DOUBLE") for n in TOP_SIZES],
            *[(f"duplicated_{n}_n_grams", f"{_ratio(f'dup_{n}_chars', 'n_chars_text')} > {c.max_dup_share[n]}::DOUBLE") for n in DUP_SIZES],
        ],
        "quality": [
            empty,
            ("gopher_short_doc", f"n_words < {c.min_words}"),
            ("gopher_long_doc", f"n_words > {c.max_words}"),
            ("gopher_below_avg_threshold", f"{_ratio('n_word_chars', 'n_words')} < {c.min_mean_word}::DOUBLE"),
            ("gopher_above_avg_threshold", f"{_ratio('n_word_chars', 'n_words')} > {c.max_mean_word}::DOUBLE"),
            ("gopher_too_many_hashes", f"{_ratio('n_hashes', 'n_words')} > {c.max_hashes_per_word}::DOUBLE"),
            ("gopher_too_many_ellipsis", f"{_ratio('n_ellipses', 'n_words')} > {c.max_ellipses_per_word}::DOUBLE"),
            ("gopher_too_many_bullets", f"{_ratio('n_bullet_lines', 'n_lines')} > {c.max_bullet_share}::DOUBLE"),
            ("gopher_too_many_end_ellipsis", f"{_ratio('n_ellipsis_lines', 'n_lines')} > {c.max_ellipsis_end_share}::DOUBLE"),
            ("gopher_below_alpha_threshold", f"{_ratio('n_letter_tokens', 'n_tokens')} < {c.min_letter_share}::DOUBLE"),
            ("gopher_enough_stop_words", f"n_stop_words < {c.min_stop_words}"),
        ],
        "fineweb": [
            empty,
            ("line_punct_ratio", f"{_ratio('n_punct_lines', 'n_lines')} <= {c.min_punct_line_share}::DOUBLE"),
            ("short_line_ratio", f"{_ratio('n_short_lines', 'n_lines')} >= {c.max_short_line_share}::DOUBLE"),
            ("char_dup_ratio", f"{_ratio('n_dup_line_chars', 'n_chars_inline')} >= {c.max_dup_char_share}::DOUBLE"),
        ],
    }


def _reason_sql(stage: str) -> str:
    return "CASE " + " ".join(f"WHEN {cond} THEN '{name}'" for name, cond in _rules_sql()[stage]) + " END"


JUDGED_SQL = MEASURES_SQL + REPETITION_SQL + f""",
reasons AS (
  SELECT doc_id, source, n_chars_text AS doc_len, {_reason_sql('repetition')} AS r1, {_reason_sql('quality')} AS r2, {_reason_sql('fineweb')} AS r3
  FROM plain JOIN repetition USING (doc_id)),
judged AS (
  SELECT doc_id, source, doc_len, coalesce(r1, r2, r3) AS reason,
    CASE WHEN r1 IS NOT NULL THEN 'repetition' WHEN r2 IS NOT NULL THEN 'quality' WHEN r3 IS NOT NULL THEN 'fineweb' END AS stage,
    CASE WHEN r1 IS NOT NULL THEN 0 WHEN r2 IS NOT NULL THEN 1 WHEN r3 IS NOT NULL THEN 2 ELSE 3 END AS rank
  FROM reasons)"""


def counts_sql(stages: tuple[str, ...], judged: str = "judged") -> str:
    """One row per source and stage, from rows with ``rank`` = index of the stage that dropped them."""
    return " UNION ALL ".join(
        f"""SELECT source, '{s}' AS stage, count(*) FILTER (rank >= {i}) AS total, count(*) FILTER (rank > {i}) AS forwarded,
          count(*) FILTER (rank = {i}) AS dropped, min(doc_len) FILTER (rank > {i}) AS doc_len_min, max(doc_len) FILTER (rank > {i}) AS doc_len_max,
          avg(doc_len) FILTER (rank > {i}) AS doc_len_avg FROM {judged} GROUP BY source"""
        for i, s in enumerate(stages)
    )


_COUNTS = JUDGED_SQL + f", counts AS ({counts_sql(q.STAGES)})"
_TOTALS = _COUNTS + ", totals AS (SELECT stage, sum(total)::BIGINT AS total, sum(forwarded)::BIGINT AS forwarded, sum(dropped)::BIGINT AS dropped FROM counts GROUP BY stage)"

SQL = {
    "kept_per_source": f"""WITH {JUDGED_SQL} SELECT source, coalesce(stage, 'kept') AS stage, coalesce(reason, 'kept') AS reason, count(*) AS n
        FROM judged GROUP BY ALL""",
    "text_measures": f"WITH {MEASURES_SQL} SELECT doc_id, {', '.join(PLAIN_MEASURES)} FROM plain",
    "repetition_measures": f"WITH {MEASURES_SQL} {REPETITION_SQL} SELECT * FROM repetition",
    "repetition_filter": f"WITH {JUDGED_SQL} SELECT doc_id, r1 AS reason FROM reasons",
    "quality_filter": f"WITH {JUDGED_SQL} SELECT doc_id, r2 AS reason FROM reasons",
    "fineweb_filter": f"WITH {JUDGED_SQL} SELECT doc_id, r3 AS reason FROM reasons",
    "filter_chain": f"WITH {JUDGED_SQL} SELECT doc_id, stage, reason FROM judged",
    "filter_survivors": f"WITH {JUDGED_SQL} SELECT doc_id, source, doc_len FROM judged WHERE reason IS NULL",
    "funnel_stage_counts": f"WITH {_COUNTS} SELECT * REPLACE (round(doc_len_avg, 6) AS doc_len_avg) FROM counts",
    "funnel_reason_counts": f"WITH {JUDGED_SQL} SELECT source, stage, reason, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY ALL",
    "funnel_stage_totals": f"WITH {_TOTALS} SELECT * FROM totals",
    "funnel_drop_shares": f"""WITH {_TOTALS}, parts AS (
          SELECT stage, dropped AS n FROM totals UNION ALL SELECT 'remained', min(forwarded) FROM totals)
        SELECT stage, n, round(n / sum(n) OVER (), 9) AS share FROM parts""",
    "funnel_all_counts": f"""WITH {_COUNTS}, drops AS (SELECT source, stage, reason, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY ALL),
        stage_lengths AS ({counts_sql(q.STAGES, "(SELECT 'all' AS source, rank, doc_len FROM judged)")})
        SELECT source, false AS all_sources, stage, NULL AS reason, total, forwarded, dropped, doc_len_min, doc_len_max, round(doc_len_avg, 6) AS doc_len_avg
        FROM counts WHERE total > 0
        UNION ALL SELECT source, false, stage, reason, n, 0, n, NULL, NULL, NULL FROM drops
        UNION ALL SELECT NULL, true, stage, reason, sum(n), 0, sum(n), NULL, NULL, NULL FROM drops GROUP BY stage, reason
        UNION ALL SELECT NULL, true, stage, NULL, total, forwarded, dropped, doc_len_min, doc_len_max, round(doc_len_avg, 6) FROM stage_lengths WHERE total > 0""",
    "funnel_nested_counts": f"""WITH {_COUNTS}, drops AS (SELECT source, stage, reason, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY ALL),
        maps AS (SELECT source, stage, '{{' || string_agg('"dropped_' || reason || '":' || n, ',' ORDER BY reason) || '}}' AS dropped_by FROM drops GROUP BY source, stage)
        SELECT c.source, c.stage, total, forwarded, dropped, dropped_by FROM counts c LEFT JOIN maps m ON m.source IS NOT DISTINCT FROM c.source AND m.stage = c.stage""",
    "token_counts": f"SELECT doc_id, len(regexp_extract_all(text, '{tx.TOKEN}'))::BIGINT AS n_tokens FROM documents",
    "token_totals": f"SELECT source, sum(len(regexp_extract_all(text, '{tx.TOKEN}')))::BIGINT AS n_tokens FROM documents GROUP BY source",
    "document_lengths": """SELECT source, min(length(text))::BIGINT AS len_min, max(length(text))::BIGINT AS len_max,
        round(avg(length(text)), 6) AS len_avg FROM documents GROUP BY source""",
    "quotes_straightened": f"""SELECT doc_id, translate(text, '{tx.DOUBLE_QUOTES + tx.SINGLE_QUOTES}',
        '{'"' * len(tx.DOUBLE_QUOTES) + "''" * len(tx.SINGLE_QUOTES)}') AS text FROM documents""",
}
