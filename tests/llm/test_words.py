import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewright.llm import _words, quality
from tablewright.llm._spark import bytes_of, slices

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("ab #\n\té A<"), max_size=40), st.text(max_size=30)), max_size=8)


def split(text, lower=False):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words(texts):
    w = _words.words(*bytes_of(pa.array(texts, pa.string())), lower=True)
    for k, t in enumerate(texts):
        a, b = w.first[k], w.first[k + 1]
        assert [bytes(w.data[s:e]) for s, e in zip(w.start[a:b], w.end[a:b], strict=True)] == split(t, True)
    seen = {}
    for s, e, h in zip(w.start, w.end, w.hash, strict=True):
        assert seen.setdefault(bytes(w.data[s:e]), h) == h
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_slices_cover_a_batch(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    assert [x for p in slices(batch, "text", 7) for x in p.column(0).to_pylist()] == texts


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    wins = {}
    for i in range(len(w) - 7):
        wins.setdefault(tuple(w[i : i + 8]), []).append(i)
    inside = {j for at in wins.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    failed = len(w) < 20 or 100 * len(inside) > 30 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_quality_counts(texts):
    m = quality.measure_texts(*bytes_of(pa.array(texts, pa.string())), quality.Limits())
    for k, t in enumerate(texts):
        assert tuple(m[n][k].item() for n in NAMES) == brute(t)


def test_quality_of_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = {r.doc_id: r for r in quality.op8_quality(spark, data).collect()}
    for d in docs.collect():
        assert tuple(got[d.doc_id][n] for n in NAMES) == brute(d.text)
        assert not (got[d.doc_id].kept and got[d.doc_id].base_failed)
    good = {r.doc_id for r in spark.read.parquet(f"{data}/labels.parquet").where("quality = 1").collect()}
    assert all(got[d].kept or got[d].base_failed for d in good)
    bad = {r.doc_id for r in spark.read.parquet(f"{data}/labels.parquet").where("quality = 0").collect()}
    assert not any(got[d].kept for d in bad)
    kept = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert kept == {d for d, r in got.items() if r.kept} and quality.keep_good(docs).columns == docs.columns


def test_repetition_is_rejected(spark):
    clean = " ".join(f"word{i}" for i in range(200))
    rows = [(1, clean), (2, " ".join(["a b c d e f"] * 40)), (3, None), (4, ""), (5, " ".join(f"w{i} ###" for i in range(100))), (6, clean)]
    df = spark.createDataFrame([(k, t, None) for k, t in rows], "doc_id long, text string, kept string")
    assert {r.doc_id for r in quality.measure(df).where("kept").collect()} == {1, 6}
    assert {r.doc_id for r in quality.keep_good(df).collect()} == {1, 6}
    assert quality.measure(df.limit(0)).count() == 0
    long = np.random.default_rng(1).integers(0, 10**9, 300_000)
    assert quality.measure(spark.createDataFrame([(1, " ".join(map(str, long)))], "doc_id long, text string")).first().n_words == 300_000
