"""How an operator turns samples into samples.

Rows stay; an operator only marks them.  The first rejection of a row owns its reason, and an operator neither
scores nor rejects rows that are dropped already.  Row-local operators give Columns, so that Catalyst fuses a
chain of them into one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.context import Context
from sieveline.schema import with_entries


class Operator:
    """kind: 'narrow' (Columns alone), 'model' (needs joined or computed inputs) or 'global' (compares rows)."""

    name = "operator"
    stage = "rule"
    kind = "narrow"
    score_key: str | None = None

    def apply(self, df: DataFrame, ctx: Context, stage_no: int = 0) -> DataFrame:
        raise NotImplementedError

    def describe(self) -> dict:
        """Parameters: the public attributes that were set on this instance."""
        return {k: v for k, v in vars(self).items() if not k.startswith("_") and k not in ("name", "stage", "kind")}


def marked(df: DataFrame, op: Operator, code: Column, stage_no: int, scores: dict[str, Column] | None = None, meta: dict[str, Column] | None = None) -> DataFrame:
    """``df`` after ``op``: ``code`` (null to pass) becomes the reason of rows still alive; scores and meta (JSON) that are not null are recorded for them."""
    alive = F.col("keep")
    names = df.columns
    df = df.withColumn("_code", code)
    hit = alive & F.col("_code").isNotNull()
    out = {
        "drop_reason": F.when(hit, F.concat(F.lit(f"{op.name}:"), F.col("_code"))).otherwise(F.col("drop_reason")),
        "drop_stage": F.when(hit, F.lit(stage_no)).otherwise(F.col("drop_stage")),
        "keep": alive & F.col("_code").isNull(),
    }
    for column, values, kind in (("scores", scores, "double"), ("meta", meta, "string")):
        if values:
            df = df.withColumns({f"_{column}_{k}": F.when(alive, v.cast(kind)) for k, v in values.items()})
            out[column] = with_entries(F.col(column), {k: F.col(f"_{column}_{k}") for k in values})
    return df.withColumns(out).select(*names)


class ScoreFilter(Operator):
    """Keeps rows whose score lies within min_score and max_score, both inclusive.

    A row without a score is unscorable; every other row gets its score recorded, passing or not.  A score that is
    not a number passes both bounds.
    """

    min_score: float | None = None
    max_score: float | None = None

    def score_column(self, df: DataFrame, ctx: Context) -> tuple[DataFrame, Column]:
        """``df``, with helper columns if need be (named with a leading underscore), and the score."""
        raise NotImplementedError

    def code(self, score: Column) -> Column:
        number = ~F.isnan(score)
        code = F.when(score.isNull(), F.lit("unscorable"))
        if self.min_score is not None:
            code = code.when(number & (score < self.min_score), F.lit("below_min"))
        if self.max_score is not None:
            code = code.when(number & (score > self.max_score), F.lit("above_max"))
        return code

    def apply(self, df: DataFrame, ctx: Context, stage_no: int = 0) -> DataFrame:
        names = df.columns
        df, score = self.score_column(df, ctx)
        return marked(df, self, self.code(score), stage_no, {self.score_key: score}).select(*names)
