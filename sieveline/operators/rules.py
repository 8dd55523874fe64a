"""Rule operators: image resolution and blur, text quality, language."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.context import Context
from sieveline.functions import text as X
from sieveline.operators.base import Operator, ScoreFilter, marked
from sieveline.registry import register_op
from sieveline.schema import json_text
from sieveline.sources import images


@register_op("image_resolution_filter")
class ImageResolutionFilter(Operator):
    """Drops images that are unreadable, too small, too large or too oblong, by their headers."""

    def __init__(self, min_side: int = 224, max_side: int = 10000, max_aspect_ratio: float = 3.0):
        self.min_side, self.max_side, self.max_aspect_ratio = min_side, max_side, max_aspect_ratio

    def codes(self, width: Column, height: Column) -> tuple[Column, Column, Column]:
        """Code, shorter side and aspect ratio from a width and a height (null: unreadable)."""
        short, long = F.least(width, height), F.greatest(width, height)
        ratio = F.when(short == 0, F.lit(float("inf"))).otherwise(long / F.nullif(short, F.lit(0)))
        code = (
            F.when(width.isNull() | height.isNull(), F.lit("unreadable"))
            .when(short < self.min_side, F.lit("too_small"))
            .when(long > self.max_side, F.lit("too_large"))
            .when(ratio > self.max_aspect_ratio, F.lit("bad_aspect"))
        )
        return code, short, ratio

    def apply(self, df: DataFrame, ctx: Context, stage_no: int = 0) -> DataFrame:
        names = df.columns
        df = images.with_sizes(df, ctx)
        code, short, ratio = self.codes(F.col("_width"), F.col("_height"))
        readable = F.col("_width").isNotNull() & F.col("_height").isNotNull()
        return marked(df, self, code, stage_no, {"min_side": F.when(readable, short), "aspect_ratio": F.when(readable, F.bround(ratio, 3))}).select(*names)


@register_op("text_quality_filter")
class TextQualityFilter(Operator):
    """Drops texts that are too short, too long, repetitive or full of junk characters."""

    def __init__(self, min_chars: int = 10, max_chars: int = 4000, max_rep_ratio: float = 0.30, max_junk_ratio: float = 0.15, ngram: int = 5):
        self.min_chars, self.max_chars, self.max_rep_ratio, self.max_junk_ratio, self.ngram = min_chars, max_chars, max_rep_ratio, max_junk_ratio, ngram

    def measured(self, df: DataFrame) -> DataFrame:
        """``df`` with _n_chars, _rep and _junk."""
        df = df.withColumn("_text", X.stripped(F.col("text")))
        df = df.withColumn("_words", X.word_hashes(F.col("_text")))
        return df.withColumns({"_n_chars": F.length("_text"), "_rep": X.repeated_ngram_ratio(F.col("_words"), self.ngram), "_junk": X.junk_char_ratio(F.col("_text"))})

    def code(self) -> Column:
        return (
            F.when(F.col("_n_chars") < self.min_chars, F.lit("too_short"))
            .when(F.col("_n_chars") > self.max_chars, F.lit("too_long"))
            .when(F.col("_rep") > self.max_rep_ratio, F.lit("repetitive"))
            .when(F.col("_junk") > self.max_junk_ratio, F.lit("junk_chars"))
        )

    def apply(self, df: DataFrame, ctx: Context, stage_no: int = 0) -> DataFrame:
        scores = {"rep_ratio": F.bround("_rep", 4), "junk_ratio": F.bround("_junk", 4), "n_chars": F.col("_n_chars")}
        return marked(self.measured(df), self, self.code(), stage_no, scores).select(*df.columns)


@register_op("lang_id_filter")
class LangIdFilter(Operator):
    """Drops texts that are empty, in other languages or of uncertain language."""

    def __init__(self, keep_langs: list[str] | tuple[str, ...] = ("en",), min_confidence: float = 0.5, backend: str = "auto", model_path: str | None = None):
        self.keep_langs, self.min_confidence, self.backend, self.model_path = list(keep_langs), min_confidence, backend, model_path

    def predicted(self, df: DataFrame, ctx: Context) -> DataFrame:
        """``df`` with _lang and _conf of _text: from the provider lang_model if there is one, else from scripts.

        Counts are a projection of their own, so that each is made once however often it is read; dropped rows, of
        which nothing is recorded, are not counted.
        """
        model = ctx.providers.get("lang_model")
        if model is not None and self.backend in ("auto", "fasttext"):
            lang, confidence = model(F.regexp_replace("_text", "\n", " "), self.model_path)
            return df.withColumns({"_lang": lang, "_conf": confidence})
        if self.backend == "fasttext":
            raise RuntimeError("backend fasttext needs a provider lang_model")
        if self.backend == "auto":
            warnings.warn("no lang_model: languages are told by their scripts", stacklevel=4)
        counts = X.script_counts(F.when(F.col("keep"), F.col("_text")))
        df = df.withColumns({f"_n_{k}": c for k, c in counts.items()})
        lang, confidence = X.script_language({k: F.col(f"_n_{k}") for k in counts})
        return df.withColumns({"_lang": lang, "_conf": confidence})

    def apply(self, df: DataFrame, ctx: Context, stage_no: int = 0) -> DataFrame:
        names = df.columns
        df = self.predicted(df.withColumn("_text", X.stripped(F.col("text"))), ctx)
        code = (
            F.when(F.col("_text") == "", F.lit("empty"))
            .when(F.col("_lang").isNull() | ~F.col("_lang").isin(self.keep_langs), F.lit("wrong_lang"))
            .when(F.col("_conf") < self.min_confidence, F.lit("low_confidence"))
        )
        some = F.col("_text") != ""
        lang_json = F.when(some, F.coalesce(json_text(F.col("_lang")), F.lit("null")))
        return marked(df, self, code, stage_no, {"lang_conf": F.when(some, F.bround("_conf", 4))}, {"lang": lang_json}).select(*names)


@register_op("image_blur_filter")
class ImageBlurFilter(ScoreFilter):
    """Drops blurred images: those whose Laplacian varies little."""

    score_key = "blur_var"
    kind = "model"

    def __init__(self, min_variance: float = 100.0, resize_to: int = 512):
        self.min_variance, self.resize_to = min_variance, resize_to
        self.min_score = min_variance

    def score_column(self, df: DataFrame, ctx: Context) -> tuple[DataFrame, Column]:
        return images.with_measure(df, ctx, "_blur", images.blur_measure(self.resize_to), "double"), F.col("_blur")
