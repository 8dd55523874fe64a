"""Labelled noise: every noisy row says what was done to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.scalar import or_text
from sieveline.plans.order import first_rows, order_key, renumbered
from sieveline.schema import json_text, meta_text, with_entry
from sieveline.storage import written

#: How many rows of each class a full-size run makes, in the order in which sources are dealt.
DEFAULT_COUNTS = {"mismatch": 4000, "duplicate_exact": 2000, "duplicate_near": 1000, "gibberish": 1500, "lowquality_image": 1000, "wrong_lang": 500}
#: Ends of the ids of noisy rows.
SUFFIXES = {"mismatch": "__mismatch", "duplicate_exact": "__dupexact", "duplicate_near": "__dupnear", "gibberish": "__gibberish", "lowquality_image": "__lowq", "wrong_lang": "__lang"}
#: Sentences in Chinese, German, Russian, Japanese, French, Arabic, Korean and Spanish.
FOREIGN = (
    "河边有一座古老的石桥，孩子们在桥上放风筝。",
    "Auf dem Marktplatz verkauft eine alte Frau frische Äpfel und Birnen.",
    "Зимой наш двор всегда засыпан глубоким снегом.",
    "駅の前の小さな店で温かいお茶を飲みました。",
    "Le boulanger ouvre sa boutique bien avant le lever du soleil.",
    "يجلس الصياد على الشاطئ وينتظر عودة القوارب.",
    "산 위에 있는 작은 집에서 연기가 피어오른다.",
    "La biblioteca del pueblo cierra temprano los domingos de invierno.",
)
JUNK = "§¶†‡◊∆∂ƒ©¬˚≈Ω√∫"


def plan_counts(n_clean: int, scale: float = 1.0, counts: dict[str, int] | None = None) -> dict[str, int]:
    """How many rows of each class; at least one each when scaled.  Fails if there are too few clean rows for disjoint sources."""
    counts = dict(counts or DEFAULT_COUNTS)
    if scale != 1.0:
        counts = {k: max(1, int(v * scale)) for k, v in counts.items()}
    if sum(counts.values()) > n_clean:
        raise ValueError(f"{sum(counts.values())} sources needed, only {n_clean} clean rows")
    return counts


def dealt_ranks(clean: DataFrame, counts: dict[str, int], seed: int) -> DataFrame:
    """(_row, _class, _place) of the rows picked as sources: disjoint runs of one shuffled order.

    Only as many rows as are needed are ranked, by ranges of the order.
    """
    keyed = clean.select(order_key(seed).alias("_order"), "row_idx", F.col("row_idx").alias("_row"), F.lit(0).alias("_part"))
    ranked = renumbered(first_rows(keyed, sum(counts.values()), "_order", "row_idx")).withColumnRenamed("row_idx", "_rank")
    low, kind, place = 0, None, None
    for name, n in counts.items():
        hit = F.col("_rank") < low + n
        kind = F.when(hit, F.lit(name)) if kind is None else kind.when(hit, F.lit(name))
        place = F.when(hit, F.col("_rank") - low) if place is None else place.when(hit, F.col("_rank") - low)
        low += n
    return ranked.select("_row", kind.alias("_class"), place.alias("_place"))


def dealt_sources(clean: DataFrame, counts: dict[str, int], seed: int) -> DataFrame:
    """The rows picked as sources, with _class and _place within the class."""
    return clean.join(dealt_ranks(clean, counts, seed), F.col("row_idx") == F.col("_row")).drop("_row")


def class_of(ranks: DataFrame, counts: dict[str, int], seed: int) -> Column:
    """The class that a row is a source of, null for none, told by its place in the shuffled order: no row is moved for it.

    All that comes to the driver is the last row of each class.
    """
    last = {r["_class"]: r["_last"] for r in ranks.groupBy("_class").agg(F.max(F.struct(order_key(seed, "_row").alias("key"), F.col("_row").alias("row"))).alias("_last")).collect()}
    key, row, kind = order_key(seed), F.col("row_idx"), F.lit(None).cast("string")
    for name in reversed([k for k in counts if k in last]):
        end = last[name]
        kind = F.when((key < end["key"]) | ((key == end["key"]) & (row <= end["row"])), F.lit(name)).otherwise(kind)
    return kind


def noisy(rows: DataFrame, kind: str, **meta: Column) -> DataFrame:
    """Rows as noise of this class: id with its suffix, labels and ``meta`` (JSON columns)."""
    m = F.col("meta")
    for k, v in {"is_noise": F.lit("true"), "noise_type": F.lit(f'"{kind}"'), **meta}.items():
        m = with_entry(m, k, v)
    return rows.withColumn("meta", m).withColumn("id", F.concat("id", F.lit(SUFFIXES[kind])))


def mismatched(src: DataFrame) -> DataFrame:
    """Each row with the image of the next in place; the last with that of the first."""
    src = src.filter(F.col("_class") == "mismatch")
    n = src.agg(F.count("*").alias("_n"))
    nxt = src.select(F.col("_place").alias("_next"), F.col("image_path").alias("_image"))
    ring = src.join(F.broadcast(n)).withColumn("_next", F.pmod(F.col("_place") + 1, F.col("_n"))).join(nxt, "_next")
    out = noisy(ring, "mismatch", original_image=F.coalesce(json_text(F.col("image_path")), F.lit("null")))
    return out.withColumn("image_path", F.col("_image")).drop("_next", "_n", "_image")


def duplicated(src: DataFrame) -> DataFrame:
    rows = src.filter(F.col("_class") == "duplicate_exact")
    return noisy(rows, "duplicate_exact", duplicate_source=json_text(F.col("id")))


def gibberish_text(text: Column, key: Column) -> Column:
    """Broken text, one of three ways by ``key``: cut to 2-8 % (3 characters at least), a few words over and over, junk behind a fifth."""
    pick = lambda salt, n: F.pmod(F.floor(key / salt), F.lit(n))
    n = F.length(text)
    cut = F.substring(text, F.lit(1), F.greatest(F.lit(3), F.floor(n * (pick(7, 7) + 2) / 100).cast("int")))
    words = F.split(F.trim(text), r"\s+")
    run = F.array_join(F.slice(words, F.lit(1), (pick(11, 3) + 4).cast("int")), " ")
    loop = F.when(F.size(words) < 6, F.repeat(F.concat(text, F.lit(" ")), F.lit(12))).otherwise(F.repeat(F.concat(run, F.lit(" ")), (pick(13, 16) + 10).cast("int")))
    junk = F.array_join(F.transform(F.sequence(F.lit(1), (pick(17, 141) + 60).cast("int")), lambda i: F.substring(F.lit(JUNK), (F.pmod(key + i * i * 31 + i * 7, F.lit(len(JUNK))) + 1).cast("int"), F.lit(1))), "")
    tail = F.concat(F.substring(text, F.lit(1), F.floor(n / 5).cast("int")), F.lit(" "), junk)
    way = pick(1, 3)
    return F.when(way == 0, cut).when(way == 1, F.trim(loop)).otherwise(tail)


def new_texts(seed: int) -> dict[str, Column]:
    """The texts of the classes whose texts are not those of their sources."""
    pick = F.pmod(order_key(seed + 2), F.lit(len(FOREIGN)))
    return {"gibberish": gibberish_text(F.coalesce("text", F.lit("")), order_key(seed + 1)), "wrong_lang": F.get(F.array(*map(F.lit, FOREIGN)), pick.cast("int"))}


def gibberish(src: DataFrame, seed: int) -> DataFrame:
    rows = src.filter(F.col("_class") == "gibberish")
    return noisy(rows.withColumn("text", new_texts(seed)["gibberish"]), "gibberish")


def foreign(src: DataFrame, seed: int) -> DataFrame:
    rows = src.filter(F.col("_class") == "wrong_lang")
    return noisy(rows.withColumn("text", new_texts(seed)["wrong_lang"]), "wrong_lang")


def worked(clean: DataFrame, counts: dict[str, int], seed: int, each) -> DataFrame:
    """``clean`` after ``each``, with _class; a source whose class has a text of its own comes once more, with that text and _new."""
    rows, made = clean.withColumn("_class", class_of(dealt_ranks(clean, counts, seed), counts, seed)), new_texts(seed)
    twice = F.when(F.col("_class").isin(*made), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    text = F.when(~F.col("_new"), F.col("text"))
    for kind, value in made.items():
        text = text.when(F.col("_class") == kind, value)
    return each(rows.withColumn("_new", F.explode(twice)).withColumn("text", text))


def placed(src: DataFrame, seed: int) -> DataFrame:
    """Sources of one class with their _place in it."""
    ranked = renumbered(src.withColumns({"_order": order_key(seed), "_row": F.col("row_idx"), "_part": F.lit(0)}))
    return ranked.withColumnsRenamed({"row_idx": "_place", "_row": "row_idx"})


def inject(clean: DataFrame, counts: dict[str, int], seed: int = 42, images=None, write: bool = True, each=None) -> DataFrame:
    """``clean`` samples with labelled noise added, in shuffled order (row_idx is anew).

    ``images`` makes the two classes of changed images: (rows, class, seed) -> rows with image_path replaced,
    without those that failed, with any column _mode for how an image was degraded; without it these get no rows.
    Without ``write`` the rows are not written, for a caller that reads them once.
    ``each`` is work on rows that reads nothing of them but the text (rows -> rows): it is done where the rows lie, once
    for all copies of a text, before any is copied or put in order.  If it drops the text, no text is shuffled.
    """
    first = F.when(F.map_contains_key("meta", F.lit("is_noise")), F.col("meta")).otherwise(with_entry(F.col("meta"), "is_noise", F.lit("false")))
    clean = clean.withColumn("meta", first)
    if each is None:
        src = written(dealt_sources(clean, counts, seed), "sources")  # five parts read it
        parts = [clean, mismatched(src), duplicated(src), gibberish(src, seed), foreign(src, seed)]
    else:
        done = written(worked(clean, counts, seed, each), "sources")
        clean, src, new = done.filter("not _new").drop("_class", "_new"), done.filter("not _new and _class is not null"), done.filter("_new")
        ring = mismatched(placed(src.filter(F.col("_class") == "mismatch"), seed))
        parts = [clean, ring, duplicated(src), *(noisy(new.filter(F.col("_class") == kind), kind) for kind in new_texts(seed))]
    names = clean.columns
    if images is not None:
        near = images(src.filter(F.col("_class") == "duplicate_near"), "duplicate_near", seed)
        parts.append(noisy(near, "duplicate_near", duplicate_source=json_text(F.col("id"))))
        low = images(src.filter(F.col("_class") == "lowquality_image"), "lowquality_image", seed)
        parts.append(noisy(low, "lowquality_image", degrade_mode=json_text(F.col("_mode"))))
    mixed = parts[0].withColumn("_part", F.lit(0)).select(*names, "_part")
    for i, p in enumerate(parts[1:], 1):
        mixed = mixed.unionByName(p.withColumn("_part", F.lit(i)).select(*names, "_part"))
    order = F.pmod(order_key(seed + 3) + F.col("_part").cast("long") * 1566083941, F.lit(4294967291))
    made = renumbered(mixed.withColumn("_order", order))
    return written(made, "mixed") if write else made


def composition(samples: DataFrame) -> DataFrame:
    """(noise_type, n): rows without a type are clean."""
    return samples.groupBy(or_text(meta_text("noise_type"), "clean").alias("noise_type")).agg(F.count("*").alias("n"))
