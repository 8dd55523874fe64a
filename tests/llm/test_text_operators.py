"""Operators on single texts, against brute force and hand-made cases."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.llm import language, packing, quality, toxicity

DOCS = "doc_id long, text string"


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), DOCS)


def words(n, seed=0):
    dice = random.Random(seed)
    return [f"w{dice.randrange(400)}" for _ in range(n)]


# ---------------------------------------------------------------- quality


def brute_quality(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(zip(w, w[1:], w[2:]))
    covered = {k for i in range(len(w) - 2) if runs[w[i], w[i + 1], w[i + 2]] > 1 for k in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_quality_counts_match_brute_force(spark):
    texts = [None, "", " \t\n", "one", "a b", "a a a a a", "a b c a b c x", " ".join(words(120)), "same line\nsame line\n\n\nsame line ", "x# y$ <z>|  é ü", " ".join(words(60) * 2), "a\x1cb c", "é " * 70]
    target = spark.createDataFrame([(7,)], "doc_id long")
    frame = docs(spark, texts)
    got = quality.rate(frame, quality.fit(frame, target)).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) for r in got] == [brute_quality(t) for t in texts]
    assert not any(r["kept"] for r in got if r["base_failed"])


def test_quality_of_odd_rows(spark, monkeypatch):
    long = " ".join(words(30_000))
    rows = [(1, "a b c d a b c"), (1, "a b c d a b c"), (None, "x y z x y z x"), (2, long), (3, None), (4, ""), (5, "p q r s p q r\n" * 3)]
    frame = spark.createDataFrame(rows, DOCS).withColumn("row", F.lit("clash")).withColumn("trusted", F.lit("clash")).withColumn("w", F.lit(1))
    target = spark.createDataFrame([(1,), (None,), (77,)], "doc_id long")
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = Counter((d, *brute_quality(t)) for d, t in rows)
    ratios = []
    # a shuffle for the trusted ids, runs sorted as text, runs whose hashes clash: nothing changes
    for ids, position in ((100, 20), (0, 20), (100, 2), (100, 60)):
        monkeypatch.setattr(quality, "_POSITION", position)
        got = quality.rate(frame, quality.fit(frame, target, ids)).collect()
        assert Counter((r["doc_id"], *(r[c] for c in columns)) for r in got) == want
        ratios.append(sorted((str(r["doc_id"]), r["n_words"], str(r["ratio"])) for r in got))
    assert ratios[0] == ratios[1] == ratios[2] == ratios[3]


def test_quality_ratio_matches_brute_force(spark):
    texts = [" ".join(words(n, n)) for n in (5, 60, 200)] + [None, "lone"]
    frame = docs(spark, texts)
    grams = lambda t: [g for i, w in enumerate((t or "").split()) for g in [(w[-3:],), *([(w[-3:], (t.split())[i + 1][-3:])] if i + 1 < len(t.split()) else [])]]
    every = {g for t in texts for g in grams(t)}
    one, two = [g for g in every if len(g) == 1], [g for g in every if len(g) == 2]
    at = {}
    for group, schema in ((one, "a string"), (two, "a string, b string")):
        own = spark.createDataFrame(group, schema)
        for r in own.select("*", F.pmod(F.xxhash64(*own.columns), F.lit(quality.BUCKETS)).alias("n")).collect():
            at[tuple(r)[:-1]] = r["n"]
    raw, trusted = Counter(at[g] for t in texts for g in grams(t)), Counter(at[g] for g in grams(texts[1]))
    n, m = sum(raw.values()) + quality.BUCKETS, sum(trusted.values()) + quality.BUCKETS
    logs = {b: np.log((trusted[b] + 1) / m) - np.log((raw[b] + 1) / n) for b in raw}
    got = quality.rate(frame, quality.fit(frame, spark.createDataFrame([(1,)], "doc_id long"))).orderBy("doc_id").collect()
    for r, t in zip(got, texts, strict=True):
        assert (r["ratio"] is None) if not t else abs(r["ratio"] - np.mean([logs[at[g]] for g in grams(t)])) < 1e-5


def test_quality_is_rated_row_by_row(spark):
    # a shuffle by row gives as many files of results as it has parts, however small they are
    frame = spark.createDataFrame([(i, f"word{i} " * 9 + "other words here") for i in range(40)], "doc_id long, text string").repartition(3)
    rated = quality.rate(frame, quality.fit(frame, frame.filter("doc_id < 9")))
    plan = rated._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Generate" not in plan
    assert rated.rdd.getNumPartitions() == 3 and all(r["ratio"] is not None for r in rated.collect())


def test_quality_ratio_tells_junk(spark):
    texts = [" ".join(f"{w}ing" for w in words(3000, i)) for i in range(8)] + [" ".join(f"{w}###" for w in words(3000, i)) for i in range(8)]
    frame = docs(spark, texts)
    got = quality.rate(frame, quality.fit(frame, frame.filter("doc_id < 4"))).orderBy("doc_id").collect()
    assert [r["kept"] for r in got] == [True] * 8 + [False] * 8
    empty = quality.rate(frame.limit(0), quality.fit(frame.limit(0), frame.limit(0)))
    assert empty.count() == 0


# ---------------------------------------------------------------- language


def test_language_model_on_held_out_rows(spark):
    pools = {"en": "the of and thing thorn thatch", "de": "der die und schein kettung ungeheit", "fr": "le des que aux elle étre", "es": "los que ción mente ñado el"}
    dice = random.Random(2)
    rows = [(i, " ".join(dice.choices(pools[k].split(), k=12)), k) for i, k in enumerate(list(pools) * 30)]
    frame = spark.createDataFrame([*rows, (900, None, "en"), (901, "12 34", "de"), (902, "", None)], "doc_id long, text string, lang string")
    model = language.learn(frame.filter("doc_id < 100 or doc_id > 899"), per_lang=15)
    got = {r["doc_id"]: r for r in language.identify(frame, model).collect()}
    assert all(got[i]["lang_pred"] == k for i, _, k in rows)
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (900, 901, 902))
    assert all(0 <= r["score"] <= 1 for r in got.values())
    none = language.learn(frame.limit(0))
    assert language.identify(docs(spark, ["text"]), none).first()["lang_pred"] == "und"


def test_language_of_odd_rows(spark):
    rows = [(i, t, k) for i in range(40) for t, k in ((f"the thing and {i} thorn", "en"), (f"der schein und {i} kette", "de"))]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    probes = [(1, "der schein"), (1, "der schein"), (None, "the thorn and"), (2, "½ ² Ⅷ ① 12 _"), (3, "the thing and thorn " * 100_000), (4, None)]
    frame = spark.createDataFrame(probes, DOCS).withColumn("score", F.lit("clash")).withColumn("lang", F.lit("fr"))
    got = Counter((r["doc_id"], r["lang_pred"]) for r in language.identify(frame, model).collect())
    assert got == {(1, "de"): 2, (None, "en"): 1, (2, "und"): 1, (3, "en"): 1, (4, "und"): 1}
    assert language.identify(frame.limit(0), model).count() == 0


def test_language_op_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    true = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    got = [r for r in language.op4_language(spark, folder).collect() if r["held_out"] and r["lang_pred"] != "und"]
    assert len(got) > 150 and sum(true[r["doc_id"]] == r["lang_pred"] for r in got) >= 0.98 * len(got)


def test_toxicity_op_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    true = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic").collect()}
    got = [r for r in toxicity.op10_toxicity(spark, folder).collect() if r["held_out"] and r["doc_id"] in true]
    toxic = [r for r in got if true[r["doc_id"]]]
    # about one labelled row in ten holds no word that other toxic rows have
    assert len(toxic) > 30 and sum(r["predicted"] for r in toxic) >= 0.85 * len(toxic)
    assert sum(r["predicted"] for r in got if not true[r["doc_id"]]) <= 0.01 * len(got)


def hits_by_hand(lexicon, text):
    """The features of a text by looking for every term at every place of the folded text."""
    folded, hits = toxicity.fold(text), {}
    spared = [range(i, i + len(p) + 1) for p in lexicon.exceptions for i in range(len(folded)) if folded.startswith(f" {p} ", i)]
    for term, weight in lexicon.terms.items():
        for i in range(len(folded)):
            if folded.startswith(term, i) and not any(i in s for s in spared):
                hits[i] = max(weight, hits.get(i, 0.0))
    return max(hits.values(), default=0.0), np.log1p(sum(hits.values())), 10 * sum(hits.values()) / max(1, folded.count(" ") - 1)


def test_toxicity_hits_match_brute_force():
    dice = random.Random(8)
    pool = ["zug", "zugb", "bug", "flim", "flam", "fish", "1d10t", "a"]
    lexicon = toxicity.Lexicon({" zug ": 2.0, " zug": 1.0, " bug ": 3.5, " flim": 0.5, " idiot ": 4.0}, ("zug fish", "bug zug bug", "fish flim"), (0.0, 1.0, 1.0, 1.0))
    automaton = lexicon.automaton()
    for _ in range(500):
        text = " ".join(dice.choices(pool, k=dice.randrange(14)))
        assert np.allclose(lexicon.features(automaton, text), hits_by_hand(lexicon, text)), text
    assert lexicon.features(automaton, "zug fish " * 200_000)[0] == 0.0  # in time about linear


def test_toxicity_of_odd_rows(spark):
    lexicon = toxicity.Lexicon({" zug ": 5.0}, (), (-4.0, 1.0, 0.0, 0.0))
    frame = spark.createDataFrame([(1, "zug"), (1, "zug"), (None, "zug"), (2, "other words " * 200_000 + "zug"), (3, "")], DOCS).withColumn("toxicity", F.lit("clash")).withColumn("score", F.lit("x"))
    got = toxicity.score(frame, lexicon)
    assert got.columns == ["doc_id", "text", "score", "toxicity"]
    assert Counter((r["doc_id"], r["toxicity"] > 0.7) for r in got.collect()) == {(1, True): 2, (None, True): 1, (2, True): 1, (3, False): 1}
    assert toxicity.score(frame.limit(0), lexicon).count() == 0
    labels = spark.createDataFrame([(1, 1), (1, 0), (9, 1)], "doc_id long, toxic int")
    assert toxicity.learn(frame.select("doc_id", "text"), labels, least_docs=2, least_weight=0.1, least_places=1).terms


def test_language_features_do_not_depend_on_blocks():
    text = "Ein längerer Text über nichts. " * 40
    assert np.allclose(language.features(text, 1 << 10), language.features(text, 1 << 10, step=97))


# ---------------------------------------------------------------- toxicity


def test_toxicity_learns_folds_and_spares(spark):
    dice = random.Random(4)
    rows, labels = [], []
    for i in range(120):
        text = [w.translate(str.maketrans("0123456789", "abcdefghij")) for w in words(40, i)]
        if i % 3 == 0:
            text[dice.randrange(40)] = "zugbug"
            text[dice.randrange(40)] = f"flim{dice.choice('abcdefgh')}{i}"
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 3 == 0)))
    frame = spark.createDataFrame(rows, DOCS)
    lexicon = toxicity.learn(frame, spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int"), exceptions=("zugbug fish",))
    assert " zugbug " in lexicon.terms
    probes = ["hello zugbug there", "hello ZUGBUG!!", "a zуgbug here", "a zugbug fish here", "nothing here", None, "", "zugbugs zugbu"]
    got = [r["toxicity"] for r in toxicity.score(docs(spark, probes), lexicon).orderBy("doc_id").collect()]
    assert min(got[:2]) >= 0.7 and max(got[3:7]) < 0.5
    none = toxicity.learn(frame.limit(0), spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(docs(spark, ["x"]), none).first()["toxicity"] < 0.5


def test_folding():
    assert toxicity.fold("1d10t m0r0n") == " idiot moron "
    assert toxicity.fold("price 100$ A4!!") == " price a "
    assert toxicity.fold(None) == "  "


# ---------------------------------------------------------------- packing


def test_encoder_is_the_tokenizer():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    whole, own = Tokenizer.from_file(public.path(packing.TOKENIZER)), packing.Encoder(public.path(packing.TOKENIZER), most=50)
    dice = random.Random(1)
    pool = "aB'sDé ñßÜ\t\n\r.,!#$%12९²ªµ¼ \x1c\x85\xa0中文ひΣςİ́x<|>'re'll😀÷×ÿ"
    for _ in range(800):
        text = "".join(dice.choices(pool, k=dice.randrange(40)))
        assert own(text).tolist() == whole.encode(text, add_special_tokens=False).ids
    for text in ("<|endoftext|> hi", "it's I'LL we're", " ".join(words(500))):
        assert own(text).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_plan_places_every_length_once():
    dice = random.Random(9)
    for histogram in ({dice.randint(1, 4096): dice.randint(1, 40) for _ in range(300)}, {500: 900}, {4096: 3, 1: 5}, {}):
        packs = packing.plan_packs(histogram)
        placed = Counter()
        for n, pack in packs:
            assert sum(pack) <= 4096
            for size in pack:
                placed[size] += n
        assert placed == Counter(histogram)
    full = packing.plan_packs({500: 900})
    assert sum(n for n, _ in full) == -(-900 // 8)


def test_packed_pieces_are_whole(spark):
    pytest.importorskip("public_tokenizers")
    texts = [" ".join(words(n, n)) for n in (0, 3, 3, 50, 400, 3000)] + [None, "", "same", "same"]
    got = packing.pack(docs(spark, texts).withColumn("length", F.lit("clash")), length=512, with_ids=True).collect()
    assert {r["doc_id"] for r in got} == set(range(len(texts)))
    ends = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0) and len(r["ids"]) == r["length"]
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 512
    encode = packing.encoder()
    for i, t in enumerate(texts):
        ids = [x for r in sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["start"]) for x in r["ids"]]
        assert ids == [*encode(t or "").tolist(), 2]
    assert packing.pack(docs(spark, texts).limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "one two"), (None, "one two"), (1, "x " * 200_000), (1, None)], DOCS)
    got = packing.pack(odd).collect()
    assert sorted((str(r["doc_id"]), r["doc_tokens"]) for r in got if r["start"] == 0) == sorted([("None", 3), ("None", 3), ("1", 200_001), ("1", 1)])
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got)


def test_packing_op_has_little_padding(spark):
    pytest.importorskip("public_tokenizers")
    got = packing.op8_packing(spark, "/root/testdata/sf0.01").groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    sizes = [r["n"] for r in got]
    padded = [n if n & (n - 1) == 0 else 4096 for n in sizes]
    assert max(sizes) <= 4096 and sum(sizes) >= 0.99 * sum(padded)
