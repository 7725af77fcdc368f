"""Repetition, quality and line-structure filters with one recorded reason per document.

Measures are integer counts computed once per document; rules compare their ratios with
thresholds in a fixed order, and the first rule that fails names the reason.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from weirgate.functions import text as tx
from weirgate.functions.kernels import DUP_SIZES, REPETITION_FIELDS, TOP_SIZES, repetition_chars

STAGES = ("repetition", "quality", "fineweb")

# Stop words per language.
STOP_WORDS = {
    "tr": [
        "ve", "bir", "da", "de", "bu", "için", "ile", "olarak", "hakkında", "çok", "ise", "ama", "gibi", "ne", "var",
        "bu", "şu", "o", "biz", "siz", "onlar", "ben", "sen", "benim", "ya", "göre", "kadar", "sonra", "her", "diye",
        "yüzde", "ilgili",
    ],
    "en": ["the", "be", "to", "of", "and", "that", "have", "with"],
}


@dataclass(frozen=True)
class FilterConfig:
    """Thresholds. Each is a parameter; the defaults follow the published rules."""

    max_dup_line_share: float = 0.30
    max_dup_line_char_share: float = 0.20
    max_dup_para_share: float = 0.30
    max_dup_para_char_share: float = 0.20
    max_top_share: dict[int, float] = field(default_factory=lambda: {2: 0.20, 3: 0.18, 4: 0.16})
    max_dup_share: dict[int, float] = field(
        default_factory=lambda: {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
    )
    min_words: int = 50
    max_words: int = 100_000
    min_mean_word: float = 3.0
    max_mean_word: float = 10.0
    max_hashes_per_word: float = 0.1
    max_ellipses_per_word: float = 0.1
    max_bullet_share: float = 0.9
    max_ellipsis_end_share: float = 0.3
    min_letter_share: float = 0.7
    min_stop_words: int = 2
    min_punct_line_share: float = 0.12
    short_line_chars: int = 30
    max_short_line_share: float = 0.67
    max_dup_char_share: float = 0.10
    stop_words: dict[str, list[str]] = field(default_factory=lambda: STOP_WORDS)


def with_measures(
    docs: DataFrame, config: FilterConfig = FilterConfig(), text: str = "text", lang: str = "lang", ngrams: bool = True
) -> DataFrame:
    """Add the integer measures behind every rule. ``lang`` may name a missing column.

    Only the repetition stage needs the n-gram measures; ``ngrams=False`` leaves them out
    and keeps all work in the JVM.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    arrays = docs.select(
        "*",
        tx.words(body).alias("_words"),
        tx.lines(body).alias("_lines"),
        tx.paragraphs(body).alias("_paras"),
        (F.col(lang) if lang in docs.columns else F.lit(None).cast("string")).alias("_lang"),
    )
    repetition = arrow_udf(repetition_chars, "struct<" + ", ".join(f"{f}: bigint" for f in REPETITION_FIELDS) + ">")
    lowered = F.split(F.lower(F.concat_ws(" ", "_words")), " ")
    stop_hits = F.lit(None).cast("long")
    for code, listed in config.stop_words.items():
        known = F.array(*[F.lit(w) for w in listed])
        stop_hits = F.when(F.col("_lang") == code, F.size(F.array_intersect(lowered, known)).cast("long")).otherwise(stop_hits)
    measures = F.struct(
        F.length(body).cast("long").alias("n_chars_text"),
        F.length(F.replace(body, F.lit("\n"), F.lit(""))).cast("long").alias("n_chars_inline"),
        _long(F.size("_lines")).alias("n_lines"),
        _long(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        _dup_chars("_lines").alias("n_dup_line_chars"),
        _long(F.size("_paras")).alias("n_paras"),
        _long(F.size("_paras") - F.size(F.array_distinct("_paras"))).alias("n_dup_paras"),
        _dup_chars("_paras").alias("n_dup_para_chars"),
        _long(F.size("_words")).alias("n_words"),
        _long(F.length(F.concat_ws("", "_words"))).alias("n_word_chars"),
        tx.token_count(body).alias("n_tokens"),
        tx.token_count(body, tx.LETTER_TOKEN).alias("n_letter_tokens"),
        _long(F.regexp_count(body, F.lit("#"))).alias("n_hashes"),
        _long(F.regexp_count(body, F.lit(r"\.\.\.|…"))).alias("n_ellipses"),
        _lines_like(r"^\s*[•*-]").alias("n_bullet_lines"),
        _lines_like(r"(?:\.\.\.|…)\s*$").alias("n_ellipsis_lines"),
        _lines_like(r"""[.!?…"'”’»]\s*$""").alias("n_punct_lines"),
        _long(F.size(F.filter("_lines", lambda x: F.length(x) < config.short_line_chars))).alias("n_short_lines"),
        stop_hits.alias("n_stop_words"),
        *([F.col(f"_rep.{f}").alias(f) for f in REPETITION_FIELDS] if ngrams else []),
    )
    # Going through a generator keeps later filters on the measures above it. Pushed below,
    # they would copy every measure into the filter and compute it twice.
    counted = arrays.withColumn("_rep", repetition("_words")) if ngrams else arrays
    return counted.select(*docs.columns, F.inline(F.array(measures)))


MEASURES = [
    "n_chars_text", "n_chars_inline", "n_lines", "n_dup_lines", "n_dup_line_chars", "n_paras", "n_dup_paras",
    "n_dup_para_chars", "n_words", "n_word_chars", "n_tokens", "n_letter_tokens", "n_hashes", "n_ellipses",
    "n_bullet_lines", "n_ellipsis_lines", "n_punct_lines", "n_short_lines", "n_stop_words", *REPETITION_FIELDS,
]


def _long(c: Column) -> Column:
    return c.cast("long")


def _dup_chars(array: str) -> Column:
    return _long(F.length(F.concat_ws("", array)) - F.length(F.concat_ws("", F.array_distinct(array))))


def _lines_like(pattern: str) -> Column:
    return _long(F.size(F.filter("_lines", lambda x: x.rlike(pattern))))


def _share(part: str, whole: str) -> Column:
    return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))


def repetition_rules(config: FilterConfig) -> list[tuple[str, Column]]:
    empty = (F.col("n_words") == 0) | (F.col("n_lines") == 0)
    return [
        ("empty", empty),
        ("dup_para_frac", _share("n_dup_paras", "n_paras") > config.max_dup_para_share),
        ("dup_para_char_frac", _share("n_dup_para_chars", "n_chars_text") > config.max_dup_para_char_share),
        ("dup_line_frac", _share("n_dup_lines", "n_lines") > config.max_dup_line_share),
        ("dup_line_char_frac", _share("n_dup_line_chars", "n_chars_text") > config.max_dup_line_char_share),
        *[(f"top_{n}_gram", _share(f"top_{n}_chars", "n_chars_text") > config.max_top_share[n]) for n in TOP_SIZES],
        *[
            (f"duplicated_{n}_n_grams", _share(f"dup_{n}_chars", "n_chars_text") > config.max_dup_share[n])
            for n in DUP_SIZES
        ],
    ]


def quality_rules(config: FilterConfig) -> list[tuple[str, Column]]:
    mean_word = _share("n_word_chars", "n_words")
    return [
        ("empty", (F.col("n_words") == 0) | (F.col("n_lines") == 0)),
        ("gopher_short_doc", F.col("n_words") < config.min_words),
        ("gopher_long_doc", F.col("n_words") > config.max_words),
        ("gopher_below_avg_threshold", mean_word < config.min_mean_word),
        ("gopher_above_avg_threshold", mean_word > config.max_mean_word),
        ("gopher_too_many_hashes", _share("n_hashes", "n_words") > config.max_hashes_per_word),
        ("gopher_too_many_ellipsis", _share("n_ellipses", "n_words") > config.max_ellipses_per_word),
        ("gopher_too_many_bullets", _share("n_bullet_lines", "n_lines") > config.max_bullet_share),
        ("gopher_too_many_end_ellipsis", _share("n_ellipsis_lines", "n_lines") > config.max_ellipsis_end_share),
        ("gopher_below_alpha_threshold", _share("n_letter_tokens", "n_tokens") < config.min_letter_share),
        ("gopher_enough_stop_words", F.col("n_stop_words") < config.min_stop_words),
    ]


def fineweb_rules(config: FilterConfig) -> list[tuple[str, Column]]:
    return [
        ("empty", (F.col("n_words") == 0) | (F.col("n_lines") == 0)),
        ("line_punct_ratio", _share("n_punct_lines", "n_lines") <= config.min_punct_line_share),
        ("short_line_ratio", _share("n_short_lines", "n_lines") >= config.max_short_line_share),
        ("char_dup_ratio", _share("n_dup_line_chars", "n_chars_inline") >= config.max_dup_char_share),
    ]


RULES = {"repetition": repetition_rules, "quality": quality_rules, "fineweb": fineweb_rules}


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first rule that holds; null if none does."""
    return F.coalesce(*[F.when(failed, F.lit(name)) for name, failed in rules])


def with_verdict(measured: DataFrame, config: FilterConfig = FilterConfig(), stages: tuple[str, ...] = STAGES) -> DataFrame:
    """Add ``stage`` and ``reason`` of the first failing rule; both null for kept rows."""
    reasons = measured.select("*", *[first_reason(RULES[s](config)).alias(f"_{s}") for s in stages])
    stage = F.coalesce(*[F.when(F.col(f"_{s}").isNotNull(), F.lit(s)) for s in stages])
    return reasons.select("*", stage.alias("stage"), F.coalesce(*[F.col(f"_{s}") for s in stages]).alias("reason")).drop(
        *[f"_{s}" for s in stages]
    )


def filter_documents(
    docs: DataFrame, config: FilterConfig = FilterConfig(), text: str = "text", lang: str = "lang", stages: tuple[str, ...] = STAGES
) -> DataFrame:
    """The input columns with ``stage`` and ``reason``; keep rows whose ``reason`` is null."""
    measured = with_measures(docs, config, text, lang, ngrams="repetition" in stages)
    return with_verdict(measured, config, stages).select(*docs.columns, "stage", "reason")
