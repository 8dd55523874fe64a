"""Decontamination against every window of every text."""

import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

decontamination = pytest.importorskip("sieveline.llm.decontamination")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(dice, n, pool=400):
    return [f"w{dice.randrange(pool)}" for _ in range(n)]


def best_window(item, text):
    """(similarity, first word) of the best window of ``text`` for ``item``, both lists of words, or None."""
    k, n = min(5, len(item)), min(len(item), len(text))
    want = Counter(tuple(item[i : i + k]) for i in range(len(item) - k + 1))
    best = None
    for s in range(len(text) - n + 1):
        own = Counter(tuple(text[i : i + k]) for i in range(s, s + n - k + 1))
        share = sum((want & own).values()) / sum(want.values())
        if best is None or share > best[0]:
            best = (share, s)
    return best if best and best[0] >= 0.8 else None


def test_every_window_is_found_or_its_miss_is_rare():
    dice = random.Random(1)
    items = [words(dice, n, pool) for n, pool in [(30, 400), (12, 400), (3, 400), (5, 400), (80, 400), (200, 400), (40, 3), (25, 2), (1, 400)]]
    index = decontamination.ItemIndex([(i, " ".join(x)) for i, x in enumerate(items)])
    wanted = Counter()
    found = Counter()
    for _ in range(400):
        text = words(dice, dice.randrange(60), dice.choice([400, 3, 2]))
        for x in dice.sample(items, 2):
            copy = [w if dice.random() > dice.choice([0, 0.01, 0.03]) else "other" for w in x]
            text += copy + words(dice, dice.randrange(40))
        got = index.matches(" ".join(text))
        hand = {i: b for i, x in enumerate(items) if (b := best_window(x, text))}
        assert set(got) <= set(hand)
        for i, b in hand.items():
            level = round(b[0] * 20) / 20
            wanted[level] += 1
            found[level] += i in got
            if i in got and got[i] != b:
                assert got[i][0] <= b[0]
    assert sum(wanted.values()) > 700
    assert all(found[x] == wanted[x] for x in wanted if x >= 0.9)
    assert sum(found.values()) >= 0.995 * sum(wanted.values()), (wanted, found)


def test_rows_match_brute_force(spark):
    dice = random.Random(91)
    one, two = words(dice, 30), words(dice, 12)
    items = [(1, " ".join(one)), (2, " ".join(two)), (3, "only three words"), (4, None), (5, " "), (None, " ".join(two)), (1, " ".join(one))]
    changed = [*one[:15], "other", *one[16:]]
    texts = [
        " ".join([*words(dice, 50), *one, *words(dice, 50)]),
        " ".join([*words(dice, 50), *changed, *words(dice, 50)]),
        " ".join([*words(dice, 50), *one[:15], *words(dice, 60)]),
        "x " + ", ".join(two).upper() + "!",
        "Only three words",
        None,
        "",
        " ".join(words(dice, 200)),
    ]
    rows = [*enumerate(texts), (None, texts[0]), (4, texts[4])]
    frame = spark.createDataFrame(rows, DOCS).withColumn("item_id", F.lit("clash")).withColumn("similarity", F.lit("clash"))
    bench = spark.createDataFrame(items, ITEMS).withColumn("doc_id", F.lit(0))
    got = Counter((r["doc_id"], r["item_id"]) for r in decontamination.contaminations(frame, bench).collect())
    assert got == {(0, 1): 2, (None, 1): 2, (1, 1): 2, (3, 2): 1, (3, None): 1, (4, 3): 2}
    first = {(r["doc_id"], r["item_id"]): (r["similarity"], r["first_word"]) for r in decontamination.contaminations(frame, bench).collect()}
    assert first[0, 1] == (1.0, 50) and first[1, 1] == best_window(one, texts[1].split())
    for sizes in ({"at_once": 1}, {"letters": 10}):
        again = Counter((r["doc_id"], r["item_id"]) for r in decontamination.contaminations(frame, bench, **sizes).collect())
        assert again == got
    for sizes in ({}, {"at_once": 2}):
        clean = decontamination.decontaminate(frame, bench, **sizes)
        assert sorted(r["doc_id"] for r in clean.collect()) == [2, 5, 6, 7] and clean.columns == frame.columns
    assert decontamination.contaminations(frame, bench.limit(0)).count() == 0
    assert decontamination.contaminations(frame.limit(0), bench).count() == 0
    assert decontamination.decontaminate(frame.limit(0), bench).count() == 0


def test_many_items_and_long_texts_take_linear_time():
    dice = random.Random(4)
    head = words(dice, 10)
    items = [(i, " ".join([*head, *words(dice, 10, 5000)])) for i in range(50_000)]
    index = decontamination.ItemIndex(items)
    text = [*words(dice, 1_000_000, 5000)]
    for k, i in enumerate((5, 77, 4000)):
        text[200_000 * k : 200_000 * k + 20] = items[i][1].split()
    begun = time.time()
    assert set(index.matches(" ".join(text))) == {5, 77, 4000}
    long = " ".join(["a", "b", "c"] * 700)
    index = decontamination.ItemIndex([(1, long)])
    assert index.matches(" ".join([long] * 20)) == {0: (1.0, 0)}
    assert time.time() - begun < 120
