"""Operator 7: toxicity by a recurrent network over characters and words (see ``recurrent``)."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType, arrow_udf

from weirgate.llm.common import free_name, released, table
from weirgate.llm.recurrent import Scorer, train

# The network learns from at most this many labelled texts of each class.
SAMPLE = 1000
FOLDS = 5

# Texts are scored in runs of about this many characters.
RUN_CHARS = 1 << 20
# So many texts are Python objects at a time.
SLICE = 512


def is_held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 0 by FOLDS; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, text, toxic, prior)``: at most ``sample`` texts of each class, by a hash of the id.

    Labels of held-out ids take no part. Where an id has several labels it is toxic if one says
    so, and where it has several texts the smallest is taken. ``prior`` is the share of toxic
    ids among all labelled ones.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known.where(~is_held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    prior = known.agg(F.avg("toxic")).first()[0] or 0.0
    ranked = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for c in (0, 1)]
    chosen = ranked[0].unionByName(ranked[1]).withColumn("prior", F.lit(float(prior)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id")  # at most 2 * sample rows of numbers
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"), F.first("prior").alias("prior"))


def _trained(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(frames), ignore_index=True)
    if len(rows):
        rows = rows.sort_values("doc_id", ignore_index=True)
        labels = rows["toxic"].to_numpy()
        if len(set(labels.tolist())) == 2:
            model = pickle.dumps(train(rows["text"].tolist(), labels, float(rows["prior"].iloc[0])))
        else:
            model = pickle.dumps(float(labels[0]))
        yield pd.DataFrame({"model": [model]})


def train_model(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> bytes:
    """The pickled model, trained in one task on the bounded sample; half a megabyte.

    Without labelled texts it is the constant 0; with one class only, that class.
    """
    found = training_sample(docs, labels, sample).coalesce(1).mapInPandas(_trained, "model binary").first()
    return bytes(found[0]) if found else pickle.dumps(0.0)


@lru_cache(maxsize=1)
def scorer_of(model: bytes) -> Scorer | float:
    """A worker's scorer; Spark reuses workers, so later tasks find the words of earlier ones."""
    found = pickle.loads(model)
    return found if isinstance(found, float) else Scorer(found)


def _scores(texts: list[str | None], scorer: Scorer | float) -> np.ndarray:
    """Scores of texts, in runs of about RUN_CHARS characters."""
    if isinstance(scorer, float):
        return np.full(len(texts), scorer)
    found, first, size = [], 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size > RUN_CHARS or i + 1 == len(texts):
            found.append(scorer.score(texts[first : i + 1]))
            first, size = i + 1, 0
    return np.concatenate(found)


def toxicity_score(model: bytes) -> Callable[[Column], Column]:
    """The score of a text column, by a model of :func:`train_model`."""

    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = scorer_of(model)
        for batch in batches:
            parts = [_scores(batch.slice(at, SLICE).to_pylist(), scorer) for at in range(0, len(batch), SLICE)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0))

    # Declared non-deterministic so that a filter on the score stays above it and scores once.
    return arrow_udf(lambda batches: released(scored(batches)), "double", ArrowUDFType.SCALAR_ITER).asNondeterministic()


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs``.

    The score is the probability of label 1, from the highest of all overlapping windows of
    the whole text. Ids decide only which labels may be learnt from; nothing but the text
    enters a score, so equal texts have equal scores.

    Nulls: a null or empty text is scored as one empty window; a null id is kept, is not held
    out and never learnt from; null labels are ignored. Repeated rows are scored each. Very
    long texts have more windows, a very long word several pieces. Other columns are not read.
    Without labels every score is 0; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    model = train_model(rows, labels, sample)
    scored = rows.select("doc_id", toxicity_score(model)("text").alias("score"))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is predicted clean, with their own columns.

    Each row follows the verdict on its own text, whatever its id; nothing is joined or shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    score = toxicity_score(train_model(rows, labels))("text")
    name = free_name(docs, "score")
    return docs.withColumn(name, score).where(F.col(name) < 0.5).select(*docs.columns)


def query(spark, folder: str) -> DataFrame:
    return score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
