"""BagMinHash classes against brute force."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from ampora.llm.near_dedup import (BANDS, ROWS, SIGNS, WIDE, _kept, _sign_batches, _verified, bag_minhash, components, near_duplicates,
                                   one_of_each)
from ampora.llm.words import U, mix

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def bag(text):
    w = WORD.findall((text or "").translate(ASCII_LOWER))
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute_classes(docs):
    parent = {d: d for d in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = {d: bag(t) for d, t in docs.items()}
    for a, b in itertools.combinations(docs, 2):
        both, either = sum((bags[a] & bags[b]).values()), sum((bags[a] | bags[b]).values())
        if either and both >= 0.8 * either:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in docs}


def planted(rng):
    """Groups of near copies at all similarities, a shared passage, copies, short and empty texts."""
    words = [f"w{i}" for i in range(3000)]
    docs = []
    for _ in range(6):
        base = rng.choices(words, k=rng.choice([12, 80, 400]))
        for edits in (0, 0, 1, 2, 4, 8, 16, 30):
            text = list(base)
            for _ in range(min(edits, len(text) // 8)):
                text[rng.randrange(len(text))] = rng.choice(words)
            docs.append(" ".join(text))
    passage = rng.choices(words, k=60)
    docs += [" ".join(rng.choices(words, k=30) + passage) for _ in range(25)]
    docs += [" ".join(["again"] * n) for n in (3, 50, 52, 54, 400)]
    docs += ["", None, "...", "", "one", "One!", "one two", "one two three four five", "é è ê"]
    rng.shuffle(docs)
    return dict(enumerate(docs))


def test_classes_equal_brute_force(spark):
    docs = planted(random.Random(11))
    rows = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.class_id for r in near_duplicates(rows).collect()}
    assert got == brute_classes(docs)
    kept = one_of_each(rows)
    assert kept.columns == ["doc_id", "text"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute_classes(docs).values()))


def test_null_ids_repeated_rows_and_clashing_columns(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = spark.createDataFrame([(5, long, 1), (5, long, 1), (9, long, 2), (None, long, 3), (2, "other words here", 4)],
                                 "doc_id long, text string, class_id int")
    got = sorted((r.doc_id or 0, r.class_id) for r in near_duplicates(rows).where("doc_id IS NOT NULL").collect())
    assert got == [(2, 2), (5, 5), (5, 5), (9, 5)]
    assert [r.class_id for r in near_duplicates(rows).where("doc_id IS NULL").collect()] == [None]
    kept = one_of_each(rows)
    assert kept.columns == ["doc_id", "text", "class_id"] and kept.where("doc_id = 9").count() == 0
    assert near_duplicates(rows.limit(0)).collect() == []


def test_signature_estimates_weighted_jaccard():
    rng = np.random.default_rng(3)
    shared, own = mix(rng.integers(1, 2**62, 300).astype(U)), mix(rng.integers(1, 2**62, 100).astype(U))
    # counts 1 to 40: one side has more of each shared element
    less, more = rng.integers(1, 20, 300), rng.integers(20, 41, 300)
    a = np.repeat(shared, less)
    b = np.concatenate([np.repeat(shared, more), own])
    truth = less.sum() / (more.sum() + 100)
    docs = np.concatenate([np.zeros(len(a), np.int64), np.ones(len(b), np.int64)])
    sig = bag_minhash(docs, np.concatenate([a, b]), 2, m=4000)
    assert abs((sig[0] == sig[1]).mean() - truth) < 0.04


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r.id: r.root for r in components(spark, edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_first_band_by_signs_is_shared():
    """Pairs of similarity 0.81 to 0.90 whose first band by signs isn't a band that they share would never be verified."""
    rng = random.Random(7)
    texts = []
    for k in range(8000):
        base = [f"{rng.getrandbits(40):x}" for _ in range(60)]
        changed = 3 + k % 4      # of 56 shingles 53 to 50 stay
        texts += [" ".join(base), " ".join(base[:-changed] + [f"{rng.getrandbits(40):x}" for _ in range(changed)])]
    (signed,) = _sign_batches(iter([pa.array(texts)]))
    bands = signed.field("bands").flatten().to_numpy().reshape(-1, 2, BANDS)
    signs = np.frombuffer(b"".join(signed.field("signs").to_pylist()), np.uint16).reshape(-1, 2, BANDS * ROWS)
    shared = bands[:, 0] == bands[:, 1]
    same = signs[:, 0] == signs[:, 1]
    first = same.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1)
    linked = shared.any(axis=1)
    assert linked.mean() > 0.999
    assert (linked & ~shared[np.arange(len(shared)), first]).sum() <= 1
    assert (same.mean(axis=1) < SIGNS).sum() <= 8


def test_one_row_of_each_class_stays(spark):
    long = " ".join(f"w{i}" for i in range(40))
    other = " ".join(f"v{i}" for i in range(40))
    rows = [(5, long, 1), (5, long, 1), (5, long, 2), (9, long, 2), (9, other, 3), (None, long, 4), (None, long, 4), (7, "...", 5), (7, "...", 5), (8, "...", 6)]
    kept = one_of_each(spark.createDataFrame(rows, "doc_id long, text string, content int").repartition(3))
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted(
        [("5", long), ("9", other), ("None", long), ("7", "..."), ("8", "...")])


def test_a_large_group_in_small_cells(spark, monkeypatch):
    """Near copies of one text, half of them too far from the rest to be links, and their leader among the others."""
    from ampora.llm import near_dedup
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(2000)]
    base = rng.choices(words, k=60)
    docs = {}
    for i in range(150):
        text = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 2, 3])):
            text[rng.randrange(60)] = rng.choice(words)
        docs[i] = " ".join(text)
    rows = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    assert {r.doc_id: r.class_id for r in near_duplicates(rows).collect()} == brute_classes(docs)


def test_a_very_long_text(spark):
    rng = random.Random(5)
    long = [f"w{rng.randrange(10**6)}" for _ in range(200_000)]
    near = long[:100_000] + ["x"] * 1000 + long[101_000:]
    rows = [(1, " ".join(long)), (2, " ".join(near)), (3, " ".join(long[:100_000]))]
    got = {r.doc_id: r.class_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_a_wide_session_writes_few_files(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 5000, 1, 20 * WIDE * cores)
    for per_core, table in ((1, _kept(spark, rows, "few")), (WIDE, _kept(spark, rows, "more", WIDE))):
        assert len(table.inputFiles()) <= per_core * cores
        assert table.count() == 5000


def test_texts_of_pairs_are_thinned_without_a_second_worker(spark, monkeypatch):
    """Bags are made in the only Python step of their stage, from the texts that pairs need and few others."""
    from ampora.llm import near_dedup

    plans = {}

    def seen(spark, df, name, *wide):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return _kept(spark, df, name, *wide)

    monkeypatch.setattr(near_dedup, "_kept", seen)
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(i, text if i < 8 else f"other {i}") for i in range(-2000, 2000)], "doc_id long, text string")
    pairs = spark.createDataFrame([(a, b, a, 0) for a in (-2000, 0, 7, 1999) for b in (-1999, 5, 6)], "a long, b long, x long, y long")
    found = {(r.a, r.b): r.similarity for r in _verified(spark, pairs, docs).collect()}
    assert found[0, 5] == found[7, 6] == found[-2000, -1999] == 1.0 and found[1999, 5] == 0.0 and len(found) == 12
    assert plans["near-bags"].count("ArrowEvalPython") == 1
    needed, docs = spark.createDataFrame([(-2000,), (7,), (1999,)], "id long"), docs.withColumnRenamed("doc_id", "id")
    assert {-2000, 7, 1999} <= {r.id for r in near_dedup._thinned(docs, needed).collect()} and near_dedup._thinned(docs, needed).count() < 20
