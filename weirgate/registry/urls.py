"""URL work over ``pages`` and classifier scores over ``labels``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.functions import text as tx
from weirgate.operators import urlclf as uc
from weirgate.registry.index import NOW, _now, _worklist
from weirgate.registry.index import WORKLIST_SQL as _WORKLIST_SQL
from weirgate.session import scratch_path
from weirgate.sources.tables import read_table

HOLDOUT = "Cheap-Pills"
MODEL = uc.ClassifierConfig()
TEXT_MODEL = uc.ClassifierConfig(reg_param=1e-5, max_iter=50, standardize=False)


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "pages")


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with their path words, split, and whether the markup says English."""
    english = (F.regexp_extract("html", r'<html lang="([^"]*)"', 1) == "en").cast("int")
    return uc.with_split(uc.with_path_words(_pages(spark, sf)), "page_id", holdout=HOLDOUT).select("page_id", "url", "url_p", "split", english.alias("label"))


def _model(spark: SparkSession, sf: str):
    """Fitted, stored and loaded again."""
    path = scratch_path(spark, "model")
    uc.save(uc.fit(_labelled(spark, sf).where("split = 'train'"), config=MODEL), path)
    return uc.load(path)


def _kernel_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """The kernel learner on the same labels, stored and loaded again."""
    rows, path = _labelled(spark, sf), scratch_path(spark, "model")
    train = rows.where("split = 'train'")
    uc.save(uc.fit(train, config=uc.kernel_config(train.count())), path)
    return uc.predict(uc.load(path), rows).select("page_id", "split", "label", "prediction")


def _rated(spark: SparkSession, sf: str) -> DataFrame:
    """Documents rated toxic or not, which no URL tells; one in ten is held out."""
    docs = read_table(spark, sf, "documents").select("doc_id", "source", "text")
    rows = docs.join(read_table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label")), "doc_id")
    return uc.with_split(rows, "doc_id", holdout="no such source", url="source")


def _toxic_predictions(spark: SparkSession, sf: str) -> DataFrame:
    rows = _rated(spark, sf)
    model = uc.fit(rows.where("split = 'train'"), text="text", config=TEXT_MODEL)
    return uc.predict(model, rows).select("doc_id", "split", "label", "prediction")


def _toxic_log(spark: SparkSession, sf: str) -> DataFrame:
    """Log entries that label every document nobody has rated."""
    rows = _rated(spark, sf)
    model = uc.fit(rows, text="text", config=TEXT_MODEL)
    unrated = read_table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text").join(rows.select(F.col("doc_id").alias("id")), "id", "left_anti")
    return uc.label_rows(model, unrated, _now(NOW), F.lit(0)).select("id", "field", "value")


def _tfidf(spark: SparkSession, sf: str) -> DataFrame:
    rows = _labelled(spark, sf)
    return uc.tfidf(rows, "page_id", "url_p", F.col("split") == "train").select("row_id", "term", F.round("weight", 9).alias("weight"))


def _length_rule(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of a plain rule as a classifier: 50 words or more means good quality."""
    docs = read_table(spark, sf, "documents").select("doc_id", (F.size(tx.words(F.col("text"))) >= 50).cast("int").alias("prediction"))
    scores = uc.class_scores(read_table(spark, sf, "labels").join(docs, "doc_id"), "quality")
    return scores.select("class", "support", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1", "accuracy")])


def _cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return _pages(spark, sf).select("page_id", tx.strip_markup_noise(F.col("html")).alias("html"))


QUERIES = {
    "markup_cleaned": _cleaned,
    "url_path_words": lambda spark, sf: uc.with_path_words(_pages(spark, sf)).select("page_id", "url", "url_p"),
    "url_holdout": lambda spark, sf: _pages(spark, sf).select("page_id", tx.url_contains(F.col("url"), HOLDOUT).alias("held_out")),
    "url_splits": lambda spark, sf: _labelled(spark, sf).select("page_id", "url_p", "split", "label"),
    "url_tfidf": _tfidf,
    "url_predictions": lambda spark, sf: uc.predict(_model(spark, sf), _labelled(spark, sf)).select("page_id", "split", "label", "prediction"),
    "url_scores": lambda spark, sf: uc.class_scores(uc.predict(_model(spark, sf), _labelled(spark, sf).where("split = 'validation'"))),
    "url_bulk_labels": lambda spark, sf: uc.label_worklist(_model(spark, sf), _worklist(spark, sf), _now(NOW), F.lit(0)).select("id", "field", "value"),
    "class_scores": _length_rule,
    "url_predictions_kernel": _kernel_predictions,
    "toxic_predictions": _toxic_predictions,
    "toxic_scores": lambda spark, sf: uc.class_scores(_toxic_predictions(spark, sf).where("split = 'validation'")),
    "toxic_bulk_labels": _toxic_log,
}

_PATH_SQL = """CASE WHEN slash = 0 THEN decoded ELSE substr(decoded, slash + start) END"""
_WORDS_SQL = _PATH_SQL
for _pattern, _placeholder in tx.URL_PLACEHOLDERS:
    _WORDS_SQL = f"regexp_replace({_WORDS_SQL}, '{_pattern}', '{_placeholder}', 'g')"
PATH_WORDS_SQL = f"""
hosts AS (
  SELECT *, strpos(decoded, '://') + 3 AS start FROM (SELECT page_id, url, html, url_decode(url) AS decoded FROM pages)),
cuts AS (SELECT *, strpos(substr(decoded, start), '/') AS slash FROM hosts),
path_words AS (SELECT page_id, url, html, {_WORDS_SQL} AS url_p FROM cuts)"""
SPLIT_SQL = PATH_WORDS_SQL + f""",
split_rows AS (
  SELECT page_id, url_p, CASE WHEN contains(lower(url), '{HOLDOUT.lower()}') THEN 'test'
    WHEN ('0x' || substr(md5('42:' || page_id), 1, 8))::BIGINT % 10 = 0 THEN 'validation' ELSE 'train' END AS split,
    (regexp_extract(html, '<html lang="([^"]*)"', 1) = 'en')::INTEGER AS label
  FROM path_words)"""
_RATIO = "coalesce(round({0}::DOUBLE / nullif({1}, 0)::DOUBLE, 9), 0)"

SQL = {
    "markup_cleaned": r"""SELECT page_id, regexp_replace(html, '(<!--.*?-->)|<script\b[^>]*>.*?(?:</script\s*>|\z)|<style\b[^>]*>.*?(?:</style\s*>|\z)|</?link\b[^>]*>|<svg\b[^>]*>.*?</svg\s*>',
        '\1', 'gis') AS html FROM pages""",
    "url_path_words": f"WITH {PATH_WORDS_SQL} SELECT page_id, url, url_p FROM path_words",
    "url_holdout": f"SELECT page_id, contains(lower(url), '{HOLDOUT.lower()}') AS held_out FROM pages",
    "url_splits": f"WITH {SPLIT_SQL} SELECT page_id, url_p, split, label FROM split_rows",
    "url_tfidf": f"""WITH {SPLIT_SQL},
        tokens AS (SELECT page_id, split, regexp_extract_all(lower(url_p), '{uc.TERM}') AS t FROM split_rows),
        grams AS (
          SELECT page_id, split, array_to_string(t[p : p + n - 1], ' ') AS term
          FROM (SELECT *, unnest(range(1, len(t) + 1)) AS p FROM tokens), range(1, 4) AS sizes(n) WHERE p + n - 1 <= len(t)),
        tf AS (SELECT page_id, split, term, count(*) AS tf FROM grams GROUP BY ALL),
        idf AS (
          SELECT term, ln((1.0::DOUBLE + (SELECT count(*) FROM split_rows WHERE split = 'train')) / (1.0::DOUBLE + count(*))) + 1.0 AS idf
          FROM tf WHERE split = 'train' GROUP BY term),
        raw AS (SELECT page_id, term, tf * idf AS w FROM tf JOIN idf USING (term))
        SELECT page_id AS row_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY page_id)), 9) AS weight FROM raw""",
    "class_scores": f"""WITH rated AS (
          SELECT l.quality AS a, (len(regexp_extract_all(d.text, '{tx.WORD}')) >= 50)::INTEGER AS p FROM labels l JOIN documents d USING (doc_id)),
        classes AS (SELECT a AS c FROM rated UNION SELECT p FROM rated),
        sums AS (
          SELECT c, count(*) FILTER (a = c) AS support, count(*) FILTER (p = c) AS predicted, count(*) FILTER (a = c AND p = c) AS hits
          FROM classes, rated GROUP BY c)
        SELECT c::BIGINT AS class, support::BIGINT AS support, {_RATIO.format('hits', 'predicted')} AS precision, {_RATIO.format('hits', 'support')} AS recall,
          {_RATIO.format('2 * hits', '(support + predicted)')} AS f1, round(sum(hits) OVER () / sum(support) OVER (), 9) AS accuracy FROM sums""",
}
# The language is a folder of the path, a rule the model has to learn without an error.
SQL["url_predictions"] = f"WITH {SPLIT_SQL} SELECT page_id, split, label, label::DOUBLE AS prediction FROM split_rows"
_SCORED = f"WITH {SPLIT_SQL}, rated AS (SELECT label AS a, label AS p FROM split_rows WHERE split = 'validation')"
SQL["url_scores"] = _SCORED + """
    SELECT a::BIGINT AS class, 1.0::DOUBLE AS precision, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1, count(*)::BIGINT AS support, 1.0::DOUBLE AS accuracy
    FROM rated GROUP BY a"""
SQL["url_bulk_labels"] = (
    f"WITH {_WORKLIST_SQL} SELECT id, 'label' AS field, regexp_matches(url, '/en/') AS \"value\" FROM listed"
)
