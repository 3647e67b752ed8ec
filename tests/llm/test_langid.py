import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.llm import langid


def longest_phrases(text, sample):
    """Cross-parsing by plain search: the longest prefix found in the sample, or one sign."""
    n = at = 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in sample:
            end += 1
        at, n = end, n + 1
    return n


@settings(max_examples=150, deadline=None)
@given(st.text("ab c", min_size=1, max_size=60), st.lists(st.text("abcd ", max_size=50), min_size=1, max_size=4))
def test_phrases_equal_plain_search(sample, texts):
    model = langid.Model.of({"x": [sample], "y": ["dad"]}, 10_000)
    if "x" not in model.langs:
        return
    whole = "".join(chr(c) if c else " " for c in langid._signs([sample, " "])[0])
    signs, at, _ = langid._signs(texts)
    found = model.phrases(signs, at)[:, model.langs.index("x")]
    for k in range(len(texts)):
        text = "".join(chr(c) if c else " " for c in signs[at[k] : at[k + 1]])
        assert found[k] == longest_phrases(text, whole)


def test_lanes_do_not_show(monkeypatch):
    """Texts of many lanes, one of them a phrase of the sample from end to end, parse as plain search does."""
    monkeypatch.setattr(langid, "LANE", 16)
    rng = np.random.default_rng(5)
    sample = "".join(rng.choice(list("aab c"), 3000))
    texts = ["".join(rng.choice(list("aab cd"), n)) for n in (0, 1, 16, 17, 700)] + [sample[100:900], sample[5:400] + "d" * 40 + sample[:300]]
    model = langid.Model.of({"x": [sample], "y": ["dad"]}, 10_000)
    whole = "".join(chr(c) if c else " " for c in langid._signs([sample, " "])[0])
    signs, at, _ = langid._signs(texts)
    found = model.phrases(signs, at)[:, model.langs.index("x")]
    for k in range(len(texts)):
        assert found[k] == longest_phrases("".join(chr(c) if c else " " for c in signs[at[k] : at[k + 1]]), whole)
    assert found[5] == 1


def test_automaton_knows_every_substring():
    text = np.array([1, 2, 1, 1, 2, 2, 1, 2, 1, 1])
    state, sign, to, _ = langid.suffix_automaton(text)
    arcs = {(s, c): t for s, c, t in zip(state.tolist(), sign.tolist(), to.tolist(), strict=True)}

    def known(word):
        s = 1
        for c in word:
            s = arcs.get((s, c))
            if not s:
                return False
        return True

    whole = text.tolist()
    subs = {tuple(whole[i:j]) for i in range(len(whole)) for j in range(i + 1, len(whole) + 1)}
    words = [()]
    for _ in range(5):
        words = [w + (c,) for w in words for c in (1, 2)]
        assert all(known(w) == (w in subs) for w in words)


def test_arcs_are_found():
    rng = np.random.default_rng(2)
    pairs = np.unique(rng.integers(0, 200 * 3000, 5000))
    state, sign = pairs // 3000, pairs % 3000
    table = langid.Arcs.of(state, sign, np.arange(1, len(pairs) + 1), 200)
    assert (table.find(state, sign) == np.arange(1, len(pairs) + 1)).all()
    other = np.setdiff1d(rng.integers(0, 200 * 3000, 5000), pairs)
    assert not table.find(other // 3000, other % 3000).any()
    assert not langid.Arcs.of(state[:0], sign[:0], sign[:0], 200).find(state, sign).any()


def test_price_ties_go_to_the_first_name():
    model = langid.Model.of({"b": ["same words here"], "a": ["same words here"]}, 100)
    assert model.predict(["same words"])[0] == ["a"]


def test_languages_are_bounded(spark):
    rows = [(k, f"word{k} " * 20, f"l{k % 7}" if k % 3 else "often") for k in range(60)] + [(1, "twice", "l1"), (1, "twice", "l1")]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), langs=3)
    assert model.langs == ["l1", "l2", "often"] or len(model.langs) == 3 and "often" in model.langs
    assert len(langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), chars=30).price) <= 8


def test_held_out_accuracy(spark, data):
    got = {r.doc_id: r for r in langid.op6_langid(spark, data).collect()}
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang").collect()
    assert len(got) == len(docs)
    held = [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 4 == 2]
    assert {d.doc_id for d in held} == {k for k, r in got.items() if r.held_out}
    assert sum(got[d.doc_id].lang_pred == d.lang for d in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_odd_rows(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(docs)
    odd = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "12 %% 7", 0), (None, "the of and " * 30_000, 0), (4, "le des une ouen", 0), (4, "le des une ouen", 0)], "doc_id long, text string, score int")
    rows = [tuple(r) for r in langid.identify(odd, model).collect()]
    assert [r[1] for r in rows[:3]] == ["und"] * 3 and [r[2] for r in rows[:3]] == [0.0] * 3
    assert rows[3][1] == "en" and rows[4] == rows[5]
    kept = langid.keep_known(odd, model)
    assert kept.columns == odd.columns and kept.where("text is null or length(text) < 9").count() == 0
    assert langid.identify(odd.limit(0), model).count() == 0
    nothing = langid.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in langid.identify(odd, nothing).collect()} == {"und"}


def test_every_chosen_document_is_in_the_sample(spark):
    """A long document with a small id does not fill its language's sample."""
    rows = [(0, "abc " * 20_000, "x"), *((k, f"{chr(0x3B1 + k)}{chr(0x3B1 + k)} " * 40, "x") for k in range(1, 15))]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert all(model.kind[0x3B1 + k] == model.kind[ord("q")] for k in (20,)) and all(model.kind[0x3B1 + k] != model.kind[ord("q")] for k in range(1, 15))
    parts = langid.shares(["a" * 100, "b" * 3, "c" * 100], 40)
    assert [len(p) for p in parts] == [17, 3, 17] and langid.shares([], 5) == [] and langid.shares(["ab"] * 9, 4) == [""] * 9
