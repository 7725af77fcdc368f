"""A URL classifier: path words, n-gram weights, a linear or kernel model, and its scores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import IDF, ElementwiseProduct, HashingTF, NGram, Normalizer, RegexTokenizer, SQLTransformer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weirgate.functions import text as tx
from weirgate.operators import worklist as wl
from weirgate.operators.fourier import FourierFeatures
from weirgate.operators.skew import attach_group_value, hot_threshold
from weirgate.session import materialise

TERM = r"[\p{L}\p{N}_]{2,}"


def with_path_words(df: DataFrame, url: str = "url", out: str = "url_p") -> DataFrame:
    return df.withColumn(out, tx.url_path_words(F.col(url)))


def with_split(df: DataFrame, row_id: str, holdout: str, url: str = "url", parts: int = 10, seed: int = 42) -> DataFrame:
    """Add ``split``: ``test`` where the URL contains ``holdout``, else one part in
    ``parts`` is ``validation`` and the rest ``train``.

    The part comes from a hash of seed and id, so it does not depend on row order.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string")))
    part = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % parts
    return df.withColumn(
        "split", F.when(tx.url_contains(F.col(url), holdout), "test").when(part == 0, "validation").otherwise("train")
    )


def terms(text: Column, sizes: tuple[int, ...] = (1, 2, 3)) -> Column:
    """All word n-grams of the given sizes, lower-cased, with repeats."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))
    return F.flatten(F.array(*[_ngrams(tokens, n) for n in sizes]))


def _ngrams(tokens: Column, n: int) -> Column:
    if n == 1:
        return tokens
    starts = F.sequence(F.lit(1), F.size(tokens) - F.lit(n - 1))
    joined = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.when(F.size(tokens) >= n, joined).otherwise(F.array().cast("array<string>"))


def tfidf(df: DataFrame, row_id: str, text: str, fitted_on: Column) -> DataFrame:
    """Long form ``(row_id, term, weight)``; document frequencies come from the rows where
    ``fitted_on`` holds, and other rows keep only terms seen there.

    Weight: count x (ln((1 + n) / (1 + df)) + 1), scaled to unit length per row. A term that
    occurs in most rows is spread over tasks.
    """
    rows = df.select(F.col(row_id).alias("row_id"), terms(F.col(text)).alias("_terms"), fitted_on.alias("_fit"))
    counts = materialise(
        rows.select("row_id", "_fit", F.explode("_terms").alias("term")).groupBy("row_id", "_fit", "term").agg(F.count("*").alias("tf"))
    )
    n, pairs = rows.agg(F.count_if("_fit"), F.coalesce(F.sum(F.size("_terms")), F.lit(0))).first()
    idf = counts.where("_fit").groupBy("term").agg(F.count("*").alias("df")).select(
        "term", "df", (F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("idf")
    )
    weighted = attach_group_value(counts, idf, ["term"], "idf", "df", hot_threshold(pairs))
    raw = weighted.withColumn("_w", F.col("tf") * F.col("idf"))
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(W.partitionBy("row_id")))
    return raw.select("row_id", "term", (F.col("_w") / length).alias("weight"))


@dataclass(frozen=True)
class ClassifierConfig:
    """``features`` is the size of the hashed term space. With ``fourier`` cosines of a Gaussian
    kernel of width ``gamma`` the learner is one with that kernel; with 0 it is linear. Scaling
    terms to like spread (``standardize``) suits short texts; in long ones it drowns the frequent
    terms in rare ones."""

    features: int = 1 << 18
    reg_param: float = 1e-2
    max_iter: int = 20
    tol: float = 1e-3
    standardize: bool = True
    fourier: int = 0
    gamma: float = 0.1
    seed: int = 7


def kernel_config(rows: int, cost: float = 20.0, gamma: float = 0.1, fourier: int = 512) -> ClassifierConfig:
    """A kernel learner for a training set of that many rows; ``cost`` weighs its errors."""
    return ClassifierConfig(reg_param=1.0 / (cost * max(1, rows)), max_iter=100, tol=1e-4, fourier=fourier, gamma=gamma)


def fit(train: DataFrame, text: str = "url_p", label: str = "label", config: ClassifierConfig = ClassifierConfig()) -> PipelineModel:
    """A pipeline from text to prediction with the weights of :func:`tfidf` on hashed terms.

    The feature space is hashed, so neither the driver nor the model grows with the
    vocabulary.
    """
    tokenizer = RegexTokenizer(inputCol=text, outputCol="_t1", pattern=TERM, gaps=False, toLowercase=True)
    stages = [
        tokenizer,
        NGram(n=2, inputCol="_t1", outputCol="_t2"),
        NGram(n=3, inputCol="_t1", outputCol="_t3"),
        SQLTransformer(statement="SELECT *, concat(_t1, _t2, _t3) AS _terms FROM __THIS__"),
        HashingTF(inputCol="_terms", outputCol="_tf", numFeatures=config.features),
    ]
    counted = PipelineModel(stages).transform(train).select("_tf", F.col(label).cast("double").alias(label)).persist()
    smooth = IDF(inputCol="_tf", outputCol="_idf").fit(counted).idf.toArray() + 1.0
    stages += [
        ElementwiseProduct(scalingVec=Vectors.dense(smooth), inputCol="_tf", outputCol="_w"),
        Normalizer(inputCol="_w", outputCol="_x" if config.fourier else "features", p=2.0),
    ]
    if config.fourier:
        stages.append(FourierFeatures(inputCol="_x", outputCol="features", features=config.fourier, gamma=config.gamma, seed=config.seed))
    vectors = PipelineModel(stages[5:]).transform(counted).select(label, "features")
    vectors = materialise(vectors) if config.fourier else vectors  # the learner reads them once a step
    model = LinearSVC(labelCol=label, regParam=config.reg_param, maxIter=config.max_iter, tol=config.tol, standardization=config.standardize).fit(vectors)
    counted.unpersist()
    return PipelineModel([*stages, model])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The input columns and ``prediction``."""
    return model.transform(df).select(*df.columns, "prediction")


def classify_urls(model: PipelineModel, df: DataFrame, url: str = "url") -> DataFrame:
    """Predictions for raw URLs."""
    return predict(model, with_path_words(df, url))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def class_scores(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class: precision, recall, F1 and support; and the overall accuracy on each row."""
    pairs = predictions.groupBy(F.col(label).cast("long").alias("a"), F.col(prediction).cast("long").alias("p")).agg(F.count("*").alias("n"))
    hit = F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(F.lit(0))
    none = F.lit(0).cast("long")
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("a").alias("class"), F.col("n").alias("support"), none.alias("predicted"), hit.alias("hits")),
                F.struct(F.col("p").alias("class"), none.alias("support"), F.col("n").alias("predicted"), none.alias("hits")),
            )
        )
    )
    per_class = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    precision, recall = ratio(F.col("hits"), F.col("predicted")), ratio(F.col("hits"), F.col("support"))
    whole = W.partitionBy(F.lit(1))
    return per_class.select(
        "class",
        precision.alias("precision"),
        recall.alias("recall"),
        ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
        (F.sum("hits").over(whole) / F.sum("support").over(whole)).alias("accuracy"),
    )


def label_worklist(model: PipelineModel, worklist: DataFrame, now: Column, batch: Column) -> DataFrame:
    """Log entries that label every unlabelled row of the fetch list."""
    return label_rows(model, with_path_words(wl.unlabelled(worklist)), now, batch)


def label_rows(model: PipelineModel, rows: DataFrame, now: Column, batch: Column) -> DataFrame:
    """Log entries that label every row, which has an ``id`` and the text the model was fitted on."""
    return wl.label_log(predict(model, rows).select("id", (F.col("prediction") == 1.0).alias("label")), now, batch)
