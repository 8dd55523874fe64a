"""Queries over the driver's tables, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline import oracle as O
from sieveline.context import Context
from sieveline.functions import scalar as S
from sieveline.functions import text as X
from sieveline.operators.perception import text_share
from sieveline.operators.phash import first_match_dedup, matching_pairs
from sieveline.operators.rules import ImageResolutionFilter, LangIdFilter, TextQualityFilter
from sieveline.operators.semantic import cosine_pairs
from sieveline.plans import evaluate as E
from sieveline.plans import noise as N
from sieveline.plans import report as R
from sieveline.plans import sft
from sieveline.plans.pipeline import Pipeline
from sieveline.plans.prepare import distinct_images, synthetic, synthetic_images
from sieveline.registry import build_op
from sieveline.schema import as_samples, meta_text
from sieveline.sources.images import PICTURES_AT_ONCE, NoisyImages, header_sizes
from sieveline.sources.results import delta_table
from sieveline.storage import balanced, written

Query = Callable[[SparkSession, str], DataFrame]
SEED = O.SEED
STEPS = [{"name": "text_quality_filter"}, {"name": "lang_id_filter", "params": {"keep_langs": ["en"], "backend": "heuristic"}}]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as samples; a label of quality 0 makes a row noise of type lowquality_text."""
    docs, labels = balanced(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels").select("doc_id", "quality")
    bad = F.coalesce(F.col("quality") == 0, F.lit(False))
    base = F.create_map(F.lit("is_noise"), F.when(bad, F.lit("true")).otherwise(F.lit("false")))
    meta = F.when(bad, F.map_concat(base, F.create_map(F.lit("noise_type"), F.lit('"lowquality_text"')))).otherwise(base)
    rows = docs.join(labels, "doc_id", "left")
    image = F.concat(F.lit("img/"), F.col("doc_id").cast("string"), F.lit(".jpg"))
    return as_samples(rows.select(F.col("doc_id").alias("row_idx"), F.col("doc_id").cast("string").alias("id"), image.alias("image_path"), "text", meta.alias("meta")))


def clean_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = balanced(table(spark, sf_dir, "documents"))
    image = F.concat(F.lit("img/"), F.col("doc_id").cast("string"), F.lit(".jpg"))
    return as_samples(docs.select(F.col("doc_id").alias("row_idx"), F.col("doc_id").cast("string").alias("id"), image.alias("image_path"), "text"))


def noise_counts(n: int) -> dict[str, int]:
    """A tenth as many noisy rows of each class as half a clean corpus would take at full size."""
    return N.plan_counts(n, counts={k: max(1, v * n // 20_000) for k, v in N.DEFAULT_COUNTS.items()})


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = clean_samples(spark, sf_dir)
    return N.dealt_sources(clean, noise_counts(clean.count()), SEED)


def mixed(spark: SparkSession, sf_dir: str, write: bool = True, each=None) -> DataFrame:
    clean = clean_samples(spark, sf_dir)
    return N.inject(clean, noise_counts(clean.count()), SEED, write=write, each=each)


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once, without the texts, which are not shuffled either: what reads it may filter or aggregate as it likes."""
    ops, ctx = Pipeline({"ops": STEPS}), Context(spark)
    return written(mixed(spark, sf_dir, write=False, each=lambda rows: ops.transform(rows, ctx).drop("conversations", "text")), "annotated")


def long(*names: str) -> list:
    return [F.col(n).cast("long").alias(n) for n in names]


# ---------------------------------------------------------------- text


def text_quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = build_op("text_quality_filter").apply(samples(spark, sf_dir), Context(spark))
    score = lambda k: F.col("scores")[k].alias(k)
    return out.select(F.col("row_idx").alias("doc_id"), "keep", "drop_reason", score("n_chars"), score("rep_ratio"), score("junk_ratio"))


def text_quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = build_op("text_quality_filter").apply(samples(spark, sf_dir), Context(spark))
    return out.groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def text_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TextQualityFilter().measured(table(spark, sf_dir, "documents")).select("doc_id", F.col("_n_chars").cast("long").alias("n_chars"), F.col("_rep").alias("repeated_ngram_ratio"), F.col("_junk").alias("junk_char_ratio"))


def script_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = {k: c.cast("long") for k, c in X.script_counts(X.stripped(F.col("text"))).items()}
    return mixed(spark, sf_dir, write=False, each=lambda rows: rows.withColumns(counts).drop("conversations", "text")).select("id", *counts)


def lang_id_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    op, ctx = LangIdFilter(backend="heuristic"), Context(spark)
    out = mixed(spark, sf_dir, write=False, each=lambda rows: op.apply(rows, ctx).drop("conversations", "text"))
    return out.select("id", "keep", "drop_reason", F.col("scores")["lang_conf"].alias("lang_conf"), meta_text("lang").alias("lang"))


def token_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    toks = table(spark, sf_dir, "documents").select("doc_id", X.word_set(F.col("text")).alias("toks"))
    nxt = toks.select((F.col("doc_id") - 1).alias("doc_id"), F.col("toks").alias("next"))
    return toks.join(nxt, "doc_id").select("doc_id", X.jaccard(F.col("toks"), F.col("next")).alias("jaccard"))


# ---------------------------------------------------------------- pipeline and report


def pipeline_annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = annotated(spark, sf_dir)
    score = lambda k: F.col("scores")[k].alias(k)
    return rows.select("row_idx", "id", "keep", "drop_reason", *long("drop_stage"), score("n_chars"), score("rep_ratio"), score("junk_ratio"), score("lang_conf"))


def pipeline_op_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = spark.createDataFrame([(i, o["name"]) for i, o in enumerate(STEPS)], "stage_no int, op string")
    return R.op_counts(annotated(spark, sf_dir), ops).select(*long("stage_no"), "op", *long("n_in", "n_dropped", "n_out"), "drop_rate")


def drop_reason_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.reason_histogram(annotated(spark, sf_dir)).select(*long("drop_stage"), "drop_reason", "n")


def drops_by_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.noise_histogram(annotated(spark, sf_dir)).select(*long("drop_stage"), "noise_type", "n")


def score_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.score_distribution(R.scores_of(annotated(spark, sf_dir)))


def pipeline_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.totals(annotated(spark, sf_dir))


def latency_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.latency_quantiles(table(spark, sf_dir, "events").select(F.col("event_type").alias("key"), "value"))


def serving_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as requests: one a second, four levels of concurrency, one in seven failed."""
    k = F.col("event_id")
    rows = table(spark, sf_dir, "events").select(F.pmod("user_id", F.lit(4)).cast("long").alias("concurrency"), (k % 7 != 0).alias("ok"), k.cast("double").alias("begun"), (k + 2).cast("double").alias("ended"), F.col("value").alias("ttft"), (F.col("value") / 8).alias("tpot"), (k % 100).alias("out_tokens"))
    found = R.serving_stats(rows)
    return found.select(*(F.round(c, 6).alias(c) if c in ("req_per_s", "out_tok_per_s", "tpot_p50", "mean_out_tokens") else c for c in found.columns))


# ---------------------------------------------------------------- noise


def inject_mismatch_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.mismatched(sources(spark, sf_dir)).select("id", "image_path", meta_text("original_image").alias("original_image"))


def inject_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.duplicated(sources(spark, sf_dir)).select("id", "text", meta_text("duplicate_source").alias("duplicate_source"))


def inject_gibberish(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.gibberish(sources(spark, sf_dir), SEED).select("id", "text")


def inject_wrong_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.foreign(sources(spark, sf_dir), SEED).select("id", "text")


def noise_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.composition(mixed(spark, sf_dir))


def inject_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(spark, sf_dir).select("row_idx", "id")


# ---------------------------------------------------------------- evaluation


def eval_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.overall(E.labelled(annotated(spark, sf_dir)))


def eval_per_operator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.per_operator(E.labelled(annotated(spark, sf_dir)))


def eval_operator_noise_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.operator_noise_types(E.labelled(annotated(spark, sf_dir)))


def eval_per_noise_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.per_noise_type(E.labelled(annotated(spark, sf_dir)))


def eval_caught_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.caught_by(E.labelled(annotated(spark, sf_dir)))


def eval_dedup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.dedup_groups(E.labelled(annotated(spark, sf_dir)))


def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.sweep(E.sweep_rows(annotated(spark, sf_dir), "n_chars", "gibberish"))


def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.best_threshold(threshold_sweep(spark, sf_dir))


# ---------------------------------------------------------------- vectors


def vector_samples(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Context]:
    """embeddings as samples; the text of a row is paired with the vector of the row after it (the last with the first)."""
    vecs = table(spark, sf_dir, "embeddings")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    rows = vecs.select("vec_id").join(docs, "vec_id", "left")
    n = vecs.count()
    own = vecs.select(F.col("vec_id").cast("string").alias("key"), F.col("embedding").alias("vec"))
    text = vecs.select(F.concat(F.lit("txt:"), F.pmod(F.col("vec_id") - 1, F.lit(n)).cast("string")).alias("key"), F.col("embedding").alias("vec"))
    made = as_samples(rows.select(F.col("vec_id").alias("row_idx"), F.col("vec_id").cast("string").alias("id"), "text"))
    return made, Context(spark, embeddings=own.unionByName(text))


def clip_score_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, ctx = vector_samples(spark, sf_dir)
    out = build_op("clip_score_filter", {"threshold": 0.05}).apply(rows, ctx)
    return out.select(F.col("row_idx").alias("vec_id"), "keep", "drop_reason", F.round(F.col("scores")["clip_score"], 6).alias("clip_score"))


def aesthetic_score_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, ctx = vector_samples(spark, sf_dir)
    weight = [((i * 37) % 11 - 5) / 4 for i in range(64)]
    ctx.providers["aesthetic_head"] = lambda vec: S.dot(vec, F.lit(weight)) + 5.0
    out = build_op("aesthetic_score_filter").apply(rows, ctx)
    return out.select(F.col("row_idx").alias("vec_id"), "keep", "drop_reason", F.round(F.col("scores")["aesthetic"], 6).alias("aesthetic"))


def cosine_pair_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row_idx"), F.col("embedding").alias("vec"))
    return cosine_pairs(vecs, 0.4).select("i", "j", F.round("sim", 6).alias("sim"))


def _semantic(spark: SparkSession, sf_dir: str, params: dict) -> DataFrame:
    rows, ctx = vector_samples(spark, sf_dir)
    out = build_op("semantic_dedup", params).apply(rows, ctx)
    return out.select(F.col("row_idx").alias("vec_id"), "keep", "drop_reason", meta_text("duplicate_of").alias("duplicate_of"), F.col("scores")["dedup_cluster"].alias("dedup_cluster"))


def semantic_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _semantic(spark, sf_dir, {"sim_threshold": 0.4, "text_aware": False})


def semantic_dedup_text_aware(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _semantic(spark, sf_dir, {"sim_threshold": 0.4, "text_sim_threshold": 0.02})


# ---------------------------------------------------------------- hashes


def hash_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-bit hashes of the signs of embeddings, and two copies of each with one and with three bits flipped."""
    vecs = table(spark, sf_dir, "embeddings")
    h = F.aggregate(F.transform("embedding", lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    base = vecs.select("vec_id", h.alias("h"))
    flip = lambda *offsets: [F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col("vec_id") * k + o, F.lit(64)).cast("int")) for k, o in offsets]
    one, a, b = flip((7, 1), (5, 3), (5, 19))
    made = [base.select((F.col("vec_id") * 3).alias("row_idx"), "h"), base.select((F.col("vec_id") * 3 + 1).alias("row_idx"), F.col("h").bitwiseXOR(one).alias("h")), base.select((F.col("vec_id") * 3 + 2).alias("row_idx"), F.col("h").bitwiseXOR(one).bitwiseXOR(a).bitwiseXOR(b).alias("h"))]
    return made[0].unionByName(made[1]).unionByName(made[2])


def band_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hash_rows(spark, sf_dir)
    bands = F.explode(F.array(*(F.struct(F.lit(i).cast("long").alias("band"), S.band(F.col("h"), i).alias("value")) for i in range(4)))).alias("b")
    return rows.select("row_idx", bands).groupBy("b.band", "b.value").agg(F.count("*").alias("n")).filter("n > 1")


def hamming_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching_pairs(written(hash_rows(spark, sf_dir), "hashes"), 3, None).select("i", "j", *long("band"))


def phash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hash_rows(spark, sf_dir)
    return first_match_dedup(rows, 3, None)


def phash_dedup_text_aware(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with captions of ten words: of some copies one word is another, of some there is one word more."""
    rows = hash_rows(spark, sf_dir)
    own = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.concat(F.lit("w"), F.pmod(F.floor(F.col("row_idx") / 3) + i, F.lit(50)).cast("string")))
    copy, vec = F.pmod("row_idx", F.lit(3)), F.floor(F.col("row_idx") / 3)
    toks = F.when((copy == 2) & (vec % 2 == 0), F.array_append(F.slice(own, 2, 9), "other")).when((copy == 1) & (vec % 3 == 0), F.array_append(own, "more")).otherwise(own)
    return first_match_dedup(rows.withColumn("toks", toks), 3, 0.9)


# ---------------------------------------------------------------- pictures


def blur_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blur gate over gray pictures of 12 by 12 whose values follow from a supplier's key."""
    k = F.col("s_suppkey").cast("long")
    cell = lambda i: F.pmod(k * 31 + F.pmod(i, F.lit(12)) * F.pmod(i, F.lit(12)) * 7 + F.floor(i / 12) * 13 + F.pmod(i, F.lit(12)) * F.floor(i / 12) * F.pmod(k, F.lit(5)), F.lit(256))
    data = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(143)), lambda i: F.lpad(F.hex(cell(i).cast("long")), 2, "0")), ""))
    rows = table(spark, sf_dir, "supplier").select(k.alias("row_idx"), F.concat(F.lit("/"), k.cast("string")).alias("image_path"), data.alias("data"))
    side = F.lit(12)
    pictures = rows.select(F.col("image_path").alias("image_file"), side.alias("width"), side.alias("height"), F.lit(1).alias("n_channels"), "data")
    out = build_op("image_blur_filter", {"min_variance": 20000.0}).apply(as_samples(rows.select("row_idx", F.col("row_idx").cast("string").alias("id"), "image_path", F.lit("").alias("text"))), Context(spark, images=pictures))
    return out.select(F.col("row_idx").alias("s_suppkey"), "keep", "drop_reason", F.round(F.col("scores")["blur_var"], 3).alias("blur_var"))


def image_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes read from PNG, GIF and BMP headers that are made of a part's numbers."""
    w, h = F.col("p_size").cast("long") * 40, F.floor("p_retailprice").cast("long")
    big = lambda v: F.lpad(F.hex(v), 8, "0")
    low = lambda v, n: F.concat(*(F.lpad(F.hex(F.pmod(F.floor(v / 256**i), F.lit(256)).cast("long")), 2, "0") for i in range(n)))
    png = F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), big(w), big(h))
    gif = F.concat(F.lit("474946383961"), low(w, 2), low(h, 2))
    bmp = F.concat(F.lit("424D" + "00" * 16), low(w, 4), low(h, 4))
    kind = F.pmod("p_partkey", F.lit(3))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.unhex(F.when(kind == 0, png).when(kind == 1, gif).otherwise(bmp)).alias("content"))
    return rows.select("p_partkey", header_sizes(F.col("content")).alias("s")).select("p_partkey", F.col("s.width").cast("long").alias("width"), F.col("s.height").cast("long").alias("height"))


def image_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic pictures, one for each supplier, with near copies and spoilt ones among them, through resolution, blur and hash dedup."""
    n = table(spark, sf_dir, "supplier").count()
    clean = synthetic(spark, n)
    drawn = synthetic_images(clean)
    pictures = written(drawn.select(F.concat(F.lit("/"), "name").alias("image_file"), "width", "height", F.lit(3).alias("n_channels"), F.col("rgb").alias("data")), "pictures", PICTURES_AT_ONCE)
    hook = NoisyImages(Context(spark, images=pictures))
    absolute = clean.withColumn("image_path", F.concat(F.lit("/"), "image_path"))
    rows = N.inject(absolute, {"duplicate_near": max(1, n // 10), "lowquality_image": max(1, n // 5)}, SEED, hook)
    steps = [{"name": "image_resolution_filter"}, {"name": "image_blur_filter", "params": {"min_variance": 30.0}}, {"name": "phash_dedup"}]
    out = Pipeline({"ops": steps}).transform(rows, hook.context())
    return out.select("row_idx", "id", "keep", "drop_reason", meta_text("noise_type").alias("noise_type"), meta_text("degrade_mode").alias("degrade_mode"))


# ---------------------------------------------------------------- training sets


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.col("role").alias("from"), F.col("text").alias("value")))).alias("t"))
    said = F.transform("t", lambda t: F.struct(t["from"].alias("from"), t["value"].alias("value")))
    return as_samples(grouped.select(F.col("conv_id").alias("row_idx"), F.col("conv_id").cast("string").alias("id"), F.lit("shared.jpg").alias("image_path"), said.alias("conversations")))


def extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats(spark, sf_dir).select(F.col("row_idx").alias("conv_id"), sft.extract_text(F.col("conversations")).alias("text"))


def to_sharegpt(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = sft.with_messages(chats(spark, sf_dir), "/data")
    flat = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n--\n")
    return made.select(F.col("row_idx").alias("conv_id"), flat.alias("messages"), F.get("images", 0).alias("image"), F.size("messages").cast("long").alias("n_messages"))


def sft_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = sft.groups(annotated(spark, sf_dir))
    out = None
    for name, rows in sets.items():
        part = rows.select(F.lit(name).alias("grp"), "row_idx", "id")
        out = part if out is None else out.unionByName(part)
    return out


def sft_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = sft.groups(annotated(spark, sf_dir))
    out = None
    for name, rows in sets.items():
        part = N.composition(rows).select(F.lit(name).alias("grp"), "noise_type", "n", S.steps_for(F.lit(1) * F.col("n"), 2, 8, 3.0).cast("long").alias("steps"))
        out = part if out is None else out.unionByName(part)
    return out


def size_matched_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir)
    return sft.size_matched(rows, rows.count() // 3, SEED).select(F.col("row_idx").alias("doc_id"))


# ---------------------------------------------------------------- images, references, results


def resolution_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 40).alias("w"), F.floor(F.col("p_retailprice")).cast("int").alias("h"))
    code, short, ratio = ImageResolutionFilter(max_side=1600).codes(F.col("w"), F.col("h"))
    return parts.select("p_partkey", code.alias("code"), short.cast("long").alias("min_side"), ratio.alias("aspect_ratio"))


def ocr_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("p_size").cast("double"), F.floor(F.col("p_retailprice") / 10).cast("double")
    zero = F.lit(0.0)
    square = F.array(F.array(zero, zero), F.array(x, zero), F.array(x, y), F.array(zero, y))
    corner = F.array(F.array(zero, zero), F.array(zero, y), F.array(x, zero))
    share = text_share(F.array(square, corner), F.lit(100), F.lit(150))
    return table(spark, sf_dir, "part").select("p_partkey", F.round(share, 6).alias("text_area_ratio"), F.when(share > 0.25, F.lit("ocr_density_filter:above_max")).alias("drop_reason"))


def distinct_image_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    rows = events.select(F.col("event_id").alias("row_idx"), F.concat(F.lit("u/"), F.col("user_id").cast("string"), F.lit(".jpg")).alias("image_path"))
    return distinct_images(rows)


def result_delta_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = F.get(F.array(*map(F.lit, ("base", "a_dirty", "b_cleaned", "c_random"))), F.pmod("c_custkey", F.lit(4)).cast("int"))
    cells = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("dataset"), model.alias("model")).agg((F.count_if(F.col("c_acctbal") > 0) * 100 / F.count("*")).alias("score"))
    return delta_table(cells.withColumn("score", F.floor("score")))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        text_quality_filter, text_quality_summary, text_ratios, script_counts, lang_id_filter, token_jaccard,
        pipeline_annotated, pipeline_op_report, pipeline_totals, drop_reason_histogram, drops_by_noise, score_distribution, latency_quantiles, serving_stats,
        inject_mismatch_ring, inject_duplicates, inject_gibberish, inject_wrong_lang, inject_order, noise_composition,
        eval_overall, eval_per_operator, eval_operator_noise_types, eval_per_noise_type, eval_caught_by, eval_dedup_groups, threshold_sweep, best_threshold,
        clip_score_filter, aesthetic_score_filter, semantic_dedup, semantic_dedup_text_aware, band_candidates, hamming_pairs, phash_dedup, phash_dedup_text_aware, blur_filter, image_headers, image_noise,
        extract_text, to_sharegpt, sft_groups, sft_manifest, size_matched_sample,
        resolution_gate, ocr_density, distinct_image_refs,
    )
} | {"cosine_pairs": cosine_pair_rows, "delta_table": result_delta_table}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in O.sql().items() if k in QUERIES}
