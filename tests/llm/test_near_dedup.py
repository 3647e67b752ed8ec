from itertools import combinations

import pytest

from tablewright.llm import near_dedup
from tablewright.llm._spark import setting


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = {k: shingles(t) for k, t in rows}
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {(k, len(sets[k]), root(k), root(k) == k) for k in sets}


def result(df):
    return {tuple(r) for r in near_dedup.near_duplicates(df).collect()}


def test_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    assert result(docs) == brute([tuple(r) for r in docs.collect()])


def test_chain_and_odd_rows(spark):
    words = [f"w{i}" for i in range(140)]
    rows = [(k, " ".join(words[4 * k : 4 * k + 60])) for k in range(20)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, "A b"), (104, "a  B"), (105, "é" * 3), (106, " ".join(words[:60]).upper())]
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, component_id string")
    assert result(df) == brute(rows)


def test_near_copies_in_one_bucket(spark):
    base = [f"t{i}" for i in range(200)]
    rows = []
    for k in range(150):
        w = list(base)
        w[k % 200] = f"x{k}"
        w[(k * 7 + 3) % 200] = f"y{k}"
        rows.append((k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r[2] for r in result(df)} == {0}


def test_rows_without_id_and_repeated_ids(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(40)) for c in "abc")
    rows = [(5, one), (None, one), (None, two), (7, three), (7, one), (9, three + " end"), (None, None), (8, ""), (5, one)]
    df = spark.createDataFrame([(k, t, n) for n, (k, t) in enumerate(rows)], "doc_id long, text string, v long")
    got = sorted((tuple(r) for r in near_dedup.near_duplicates(df).collect()), key=repr)
    want = [(5, 36, 5, True), (None, 36, 5, False), (None, 36, None, True), (7, 36, 7, True), (7, 36, 5, False), (9, 37, 7, False), (None, 0, None, True), (8, 0, 8, True), (5, 36, 5, True)]
    assert got == sorted(want, key=repr)
    kept = near_dedup.drop_duplicates(df)
    assert kept.columns == df.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert found == sorted([(5, one), (None, two), (7, three), (None, None), (8, "")], key=repr)


def family(n):
    """Documents that share 71 of a hundred words in one run, and so less than the threshold."""
    shared = [f"s{i}" for i in range(170)]
    return [(k, " ".join([*shared, *(f"x{k}_{i}" for i in range(33))])) for k in range(n)]


def test_a_family_below_the_threshold_meets_nowhere(spark):
    rows = family(3000)
    a, b = shingles(rows[0][1]), shingles(rows[1][1])
    assert 0.7 < len(a & b) / len(a | b) < 0.75
    rows += [(9000 + k, rows[k][1] + " more") for k in range(0, 3000, 500)]
    found = result(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r[0], r[2]) for r in found if r[0] != r[2]} == {(9000 + k, k) for k in range(0, 3000, 500)}


def test_prefixes_of_sets_that_are_alike_meet():
    import numpy as np

    rng = np.random.default_rng(8)
    count = rng.integers(0, 3, 64).astype(np.int32)
    for _ in range(500):
        a = np.unique(rng.integers(0, 2**64, rng.integers(1, 40), dtype=np.uint64))
        b = np.unique(np.concatenate((a[rng.random(len(a)) < 0.9], rng.integers(0, 2**64, rng.integers(0, 8), dtype=np.uint64))))
        both = len(np.intersect1d(a, b))
        if both and 100 * both >= 75 * (len(a) + len(b) - both):
            assert len(np.intersect1d(near_dedup.prefix(a, count, 75), near_dedup.prefix(b, count, 75)))


def shuffled(spark):
    """Bytes written to shuffles so far."""
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(k).totalShuffleWrite() for k in range(executors.size()))


def test_texts_that_meet_no_other_are_not_sent(spark):
    import random

    rng = random.Random(3)
    rows = [(k, " ".join(f"{rng.getrandbits(64):x}" for _ in range(2500))) for k in range(150)]
    rows += [(1000 + k, rows[k][1] + " more") for k in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path = spark.conf.get("spark.sql.warehouse.dir") + "/texts"
    df.write.mode("overwrite").parquet(path)
    before = shuffled(spark)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        kept = {r.doc_id for r in near_dedup.drop_duplicates(spark.read.parquet(path)).collect()}
    assert kept == set(range(150))
    # the sets of ten documents are sent, a few numbers of each other one
    assert shuffled(spark) - before < sum(len(t) for _, t in rows) / 2


def test_very_long_text(spark):
    text = " ".join(f"w{i % 70_000}" for i in range(300_000))
    rows = [(1, text), (2, text + " tail"), (3, "other words are in this one")]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == {(1, 70_000, 1, True), (2, 70_001, 1, False), (3, 2, 3, True)}


def test_empty(spark):
    assert result(spark.createDataFrame([], "doc_id long, text string")) == set()
    assert near_dedup.drop_duplicates(spark.createDataFrame([(1, None), (2, None)], "doc_id long, text string")).count() == 2


@pytest.mark.parametrize("n", [1, 3, 50, 4000])
def test_sketch_fills_every_coordinate(n):
    import numpy as np

    s = near_dedup.sketch(np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64))
    assert (s != 2**64 - 1).all()
