"""Near copies against brute force."""

import random

import pytest

nearcopies = pytest.importorskip("sieveline.llm.nearcopies")


def classes_of(texts):
    """Smallest doc_id reachable, comparing every pair of texts by its sets of five-word shingles."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

    def shingles(text):
        words = (text or "").translate(lower).split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = {i: shingles(t) for i, t in texts}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and (a == b or len(a & b) >= 0.8 * len(a | b)):
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return {i: top(i) for i in sets}


def edited(dice, words, share):
    return [w if dice.random() > share else "".join(dice.choices("klmnop", k=6)) for w in words]


@pytest.mark.parametrize(("split_rows", "rows_at_once"), [(4096, 1 << 16), (16, 64)])
def test_all_classes_are_found(spark, split_rows, rows_at_once):
    dice = random.Random(7)
    words = lambda n: ["".join(dice.choices("abcdefgh", k=5)) for _ in range(n)]
    texts = []
    for n in (8, 30, 60, 120, 400):
        for _ in range(6):
            base = words(n)
            texts.append(" ".join(base))
            for share in (0.0, 0.005, 0.01, 0.02, 0.04, 0.1):
                texts.append(" ".join(edited(dice, base, share)).upper())
    hot = words(200)
    texts += [" ".join(edited(dice, hot, 0.006)) for _ in range(150)]
    texts += [" ".join(words(50)) for _ in range(40)]
    dice.shuffle(texts)
    rows = list(enumerate(texts, 1))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in nearcopies.near_copies(frame, split_rows=split_rows, rows_at_once=rows_at_once).collect()}
    expected = classes_of(rows)
    # no class joins texts that brute force keeps apart; at most one document in a hundred is missed
    assert all(expected[i] == expected[c] for i, c in got.items())
    assert sum(got[i] != c for i, c in expected.items()) <= len(rows) // 100
    assert got.keys() == expected.keys()


def test_odd_rows(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, None), (2, ""), (3, " \n"), (4, text), (5, text.upper()), (5, "its other text"), (6, "ITS  other\ttext"), (7, "one"), (None, text), (9, "x " * 30_000), (8, "x " * 40_000), (10, "Ärger"), (11, "ärger")]
    frame = spark.createDataFrame([(i, t, "n", "c") for i, t in rows], "doc_id long, text string, node string, copy string")
    got = {}
    for r in nearcopies.near_copies(frame).collect():
        got.setdefault(r["doc_id"], set()).add(r["component_id"])
    # texts of one repeated word are alike; a row without doc_id takes no part; only A-Z are lower-cased
    assert got == {1: {1}, 2: {1}, 3: {1}, 4: {4}, 5: {4}, 6: {4}, 7: {7}, 8: {8}, 9: {8}, 10: {10}, 11: {11}}
    kept = nearcopies.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 4, 7, 8, 10, 11]
    assert nearcopies.near_copies(frame.limit(0)).count() == 0
    assert nearcopies.one_of_each(frame.limit(0)).count() == 0


def test_similarity_bounds():
    a = " ".join(f"w{i}" for i in range(50))
    assert nearcopies.similarity(a, a.upper()) == 1.0
    assert nearcopies.similarity("", None) == 1.0
    assert nearcopies.similarity(a, "") == 0.0
    assert nearcopies.similarity("a b", "a b c") == 0.0


def drawn(dice, n):
    return ["".join(dice.choices("abcdefgh", k=5)) for _ in range(n)]


def assert_as_brute_force(spark, rows, **sizes):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r["doc_id"]: r["component_id"] for r in nearcopies.near_copies(frame, **sizes).collect()} == classes_of(rows)


def test_texts_of_one_filler_word_are_compared_with_each_other(spark):
    dice = random.Random(3)
    filler, other, own = ["spam"] * 400, drawn(dice, 60), drawn(dice, 60)
    rows = [(1, filler + other), (2, filler + own), (3, filler + [*own[:-1], "last"])]
    rows = [(i, " ".join(words)) for i, words in rows]
    assert classes_of(rows) == {1: 1, 2: 2, 3: 2}
    assert_as_brute_force(spark, rows)


def test_a_repeated_passage_does_not_part_copies(spark):
    dice, rows = random.Random(4), []
    for n in (5, 10, 20, 50):
        for _ in range(5):
            passage, own = drawn(dice, 25), drawn(dice, 200)
            rows += [(len(rows) + 1, " ".join(passage + own)), (len(rows) + 2, " ".join(passage * n + own))]
    assert len(set(classes_of(rows).values())) == len(rows) // 2
    assert_as_brute_force(spark, rows)


def family(seed, size, twins, changes):
    """Texts alike by less than 0.8 for the most part, and for some of them a copy with ``changes`` more words changed."""
    dice = random.Random(seed)
    base, texts = drawn(dice, 300), []
    for k in range(size):
        own = list(base)
        for at in dice.sample(range(5, 295), 5):
            own[at] = drawn(dice, 1)[0] + str(k)
        texts.append(own)
    for k in range(twins):
        own = list(texts[k])
        for at in dice.sample(range(5, 295), changes):
            own[at] = f"twin{k}"
        texts.append(own)
    dice.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts, 1)]


def test_a_group_in_many_blocks_is_compared_whole(spark):
    assert_as_brute_force(spark, family(5, 150, 50, 1), split_rows=16, rows_at_once=1 << 19)


def test_pairs_below_the_bound_hide_none_above_it(spark):
    rows = family(6, 300, 60, 5)
    classes = classes_of(rows)
    assert 100 < len(set(classes.values())) < 301
    assert_as_brute_force(spark, rows)
