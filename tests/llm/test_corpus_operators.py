"""Operators that compare documents, against brute force."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from sieveline.llm import linededup, simhash
from sieveline.llm.cuckoo import CuckooFilter

DOCS = "doc_id long, text string"


def classes_by_hand(fps, radius):
    label = list(range(len(fps)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def clustered(n, seed):
    dice = random.Random(seed)
    out = []
    for _ in range(n):
        x = dice.getrandbits(64) if not out or dice.random() < 0.4 else dice.choice(out)
        for _ in range(dice.randrange(5)):
            x ^= 1 << dice.randrange(64)
        out.append(x)
    return out


def fingerprint_by_hand(text, size=3):
    """Bit by bit, from the definition."""
    import xxhash

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    own, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            own, word = own + [word] * bool(word), ""
        else:
            word += c
    runs = [" ".join(own[i : i + size]) for i in range(len(own) - size + 1)] if len(own) >= size else [" ".join(own)] * bool(own)
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_match_the_definition(spark):
    dice = random.Random(6)
    texts = [None, "", " \t", "One", "a B", "a b c", "a b c a b c", "É é\x1cx Ünï", "x " * 5000] + [" ".join(dice.choices(["Aa", "b", "cé", "d\t", "ee\n"], k=dice.randrange(60))) for _ in range(60)]
    got = simhash.fingerprints(spark.createDataFrame(list(enumerate(texts)), DOCS)).select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("x")).collect()
    assert {r["doc_id"]: r["x"] for r in got} == {i: f"{fingerprint_by_hand(t):016x}" for i, t in enumerate(texts)}


def test_op1_matches_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    fps = [fingerprint_by_hand(t) for _, t in rows]
    hand = classes_by_hand(fps, 3)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op1_simhash_dedup(spark, folder).collect()}
    assert got == {d: (f"{f:016x}", rows[h][0]) for (d, _), f, h in zip(rows, fps, hand, strict=True)}


def test_of_rows_that_repeat_an_id_the_least_text_stays(spark):
    rows = [(1, "b b b"), (1, "a a a"), (1, "a a a"), (2, "c c c"), (None, "c c c")]
    frame = spark.createDataFrame(rows, DOCS).withColumn("n", F.lit(1))
    assert sorted(map(str, (tuple(r) for r in simhash.one_of_each(frame).collect()))) == sorted(map(str, [(1, "a a a", 1), (2, "c c c", 1), (None, "c c c", 1)]))


def test_gray_rank_steps_through_the_code():
    codes = np.arange(64, dtype=np.uint64)
    codes = codes ^ (codes >> np.uint64(1))
    assert simhash.gray_rank(codes).tolist() == list(range(64))


def test_index_finds_the_classes_of_a_group():
    for seed in range(5):
        fps = sorted(set(clustered(300, seed)))
        index = simhash.GrayIndex(np.zeros(len(fps), np.int64), np.array(fps, np.uint64), fan=4)
        label = index.classes(3, chunk=64)
        hand = classes_by_hand([int(v) for v in index.value], 3)
        assert [hand[i] for i in label] == hand and len(set(label.tolist())) == len(set(hand))


def test_links_over_split_groups(spark):
    fps = sorted(set(clustered(500, 11)))
    frame = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    hand = classes_by_hand(fps, 3)
    for split in (1, 100_000):
        edges = simhash.near_links(frame, 3, split_rows=split, rows_at_once=64).collect()
        own = {x - (1 << 64) if x >> 63 else x: h for x, h in zip(fps, hand, strict=True)}
        assert all(own[r["u"]] == own[r["v"]] for r in edges)
        found = simhash.components(spark.createDataFrame([(r["u"], r["v"]) for r in edges], "u long, v long"))
        roots = {r["node"]: r["root"] for r in found.collect()}
        groups = {}
        for fp, h in own.items():
            groups.setdefault(h, set()).add(roots.get(fp, fp))
        assert all(len(g) == 1 for g in groups.values())


def test_near_duplicates_with_odd_rows(spark):
    base = " ".join(f"w{i}" for i in range(200))
    rows = [(5, base), (3, base), (None, base), (9, None), (8, ""), (7, " \t"), (2, "Other TEXT here"), (4, "other text here"), (4, "other text here"), (6, "alone in this")]
    frame = spark.createDataFrame(rows, DOCS).withColumn("fp", F.lit("clash"))
    got = simhash.near_duplicates(frame)
    assert got.columns == ["doc_id", "fp", "component_id"]
    found = sorted(((r["doc_id"], r["component_id"]) for r in got.collect()), key=str)
    assert found == sorted([(5, 3), (3, 3), (None, 3), (9, 7), (8, 7), (7, 7), (2, 2), (4, 2), (4, 2), (6, 6)], key=str)
    kept = simhash.one_of_each(frame)
    assert sorted(((r["doc_id"]) for r in kept.collect()), key=str) == sorted([3, None, 7, 2, 6], key=str)
    assert simhash.near_duplicates(frame.limit(0)).count() == 0


# ---------------------------------------------------------------- lines


def test_cuckoo_filter_keeps_what_it_got():
    keys = np.random.default_rng(0).integers(-(1 << 62), 1 << 62, (30_000, 2))
    known = CuckooFilter(1000)
    known.insert(keys[:20_000, 0], keys[:20_000, 1])
    known = CuckooFilter.from_bytes(known.to_bytes())
    assert known.contains(keys[:20_000, 0], keys[:20_000, 1]).all()
    assert known.contains(keys[20_000:, 0], keys[20_000:, 1]).mean() < 0.01
    known.delete(keys[:10_000, 0], keys[:10_000, 1])
    assert known.contains(keys[10_000:20_000, 0], keys[10_000:20_000, 1]).all()
    assert known.contains(keys[:10_000, 0], keys[:10_000, 1]).mean() < 0.01
    known.delete(keys[10_000:20_000, 0], keys[10_000:20_000, 1])
    assert not any(t.slots.any() for t in known.tables)


def lines_by_hand(rows):
    def key(line):
        return line.encode().strip().translate(linededup.ASCII_LOWER).decode()

    first = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if d is not None and len(key(line)) >= 10:
                first.setdefault(key(line), set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or len(key(x)) < 10 or len(first[key(x)]) < 2 or min(first[key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def digests(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)).collect()), key=str)


LINES = ["a shared line of text", "  A Shared LINE of text\t", "short", "another shared one", "ünïcöde 123", "ünïcöde 12", "", "only in one place"]


def made(n, seed):
    dice = random.Random(seed)
    return [(i, "\n".join(dice.choices(LINES[:-1], k=dice.randrange(6))) + f"\nthe own line of {i}") for i in range(n)]


def test_lines_match_brute_force(spark):
    rows = [*made(40, 1), (100, None), (101, ""), (102, "a shared line of text\r\na shared line of text"), (None, "a shared line of text")]
    frame = spark.createDataFrame(rows, DOCS).withColumn("drop", F.lit(1)).withColumn("other", F.lit("x"))
    got = linededup.deduplicate_lines(frame)
    assert got.columns == ["doc_id", "text", "drop", "other", "n_lines", "n_dropped"]
    assert digests(got) == lines_by_hand(rows)
    assert linededup.deduplicate_lines(frame.limit(0)).count() == 0


def test_insertions_and_deletions_are_reversible(spark):
    rows = made(30, 2)
    frame = spark.createDataFrame(rows, DOCS)
    first, second = frame.filter("doc_id % 3 <> 0"), frame.filter("doc_id % 3 = 0")
    one = linededup.LineIndex.create(spark, 8).insert(first)
    both = one.insert(second)
    assert digests(both.deduplicate(frame)) == lines_by_hand(rows)
    back = both.delete(second.select("doc_id"))
    state = lambda x: sorted(map(tuple, x.refs.select("k1", "k2", "n", "first").collect()))
    assert state(back) == state(one)
    part = [r for r in rows if r[0] % 3]
    assert digests(back.deduplicate(first)) == lines_by_hand(part)
    again = back.insert(second)
    assert state(again) == state(both)
    assert digests(again.deduplicate(frame)) == lines_by_hand(rows)


def test_documents_that_are_in_already_count_once(spark):
    rows = made(20, 3)
    frame = spark.createDataFrame(rows, DOCS)
    state = lambda x: sorted(map(tuple, x.refs.select("k1", "k2", "n", "first").collect()))
    once = linededup.LineIndex.create(spark, 8).insert(frame)
    assert state(once.insert(frame.filter("doc_id < 9"))) == state(once)
    assert state(linededup.LineIndex.create(spark, 8).insert(frame.unionByName(frame))) == state(once)
    more = once.insert(spark.createDataFrame([(3, "the own line of 4\n" + "a line " * 50_000)], DOCS))
    assert [(r["n"], r["first"]) for r in more.refs.join(once.refs, ["k1", "k2"], "left_anti").collect()] == [(2, 3)]


def lines_of_one_mark():
    """Two lines that a filter of 16 buckets cannot tell apart."""
    held = {}
    for i in range(100_000):
        line = f"line number {i} of the many"
        k1, k2 = np.frombuffer(linededup.line_keys(line)[0], "<i8").reshape(2, 1)
        mark = CuckooFilter._mark(k2)
        table = CuckooFilter(1).tables[0]
        bucket = CuckooFilter._bucket(table, k1)
        place = (int(mark[0]), *sorted((int(bucket[0]), int(table._other(bucket, mark)[0]))))
        if place in held:
            return held[place], line
        held[place] = line
    raise AssertionError("no two lines with one mark")


def test_deleting_a_line_leaves_another_of_its_mark_known(spark):
    a, b = lines_of_one_mark()
    frame = lambda *rows: spark.createDataFrame(rows, "doc_id long, text string")
    one = linededup.LineIndex.create(spark, 1).insert(frame((1, a))).insert(frame((2, b))).delete(frame((2, b)).select("doc_id"))
    both = one.insert(frame((3, a)))
    kept = {r["doc_id"]: r["n_dropped"] for r in both.deduplicate(frame((1, a), (3, a))).collect()}
    assert kept == {1: 0, 3: 1}
    rows = [tuple(r) for r in both.refs.select("n", "first").collect()]
    assert rows == [(2, 1)]
