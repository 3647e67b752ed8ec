import hashlib
import struct
import zlib
from types import SimpleNamespace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewright.llm import bpe, packing

public = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))


@pytest.fixture(scope="module", params=[False, True])
def coder(request):
    return bpe.Coder(bpe.default_source(), keep=50, propose=request.param)


def ids(data):
    return list(struct.unpack(f"<{len(data) // 4}I", data))


ALPHABET = st.one_of(st.sampled_from(list("aeintho '’s.,!1É") + ["<|endoftext|>", "<|", "the", "ing", "ͅ", "Σ", "İ", "́", " ", " ", "\x1c", "\n"]), st.characters(exclude_categories=["Cs"]))
STRINGS = st.lists(ALPHABET, max_size=40).map("".join)


@settings(max_examples=400, deadline=None)
@given(text=STRINGS)
def test_equals_the_library(coder, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    got = coder.encode(text.encode())
    assert ids(got) == want
    assert coder.decode(got) == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["", "a" * 5000, "ab" * 3000 + " the", "<|endoftext|>the<|startoftext|>", "é" * 700])
def test_long_words(coder, library, text):
    assert ids(coder.encode(text.encode())) == library.encode(text, add_special_tokens=False).ids


def test_automaton_accepts_only_encodings():
    """A small vocabulary: of all ways to cut a word, one is accepted, and it is what merging in order gives."""
    merges = [("a", "a"), ("b", "a"), ("aa", "b"), ("ba", "aa"), ("a", "b")]
    vocab = {c: k for k, c in enumerate(["a", "b"])} | {u + v: k + 2 for k, (u, v) in enumerate(merges)}
    a = bpe.Automaton({"vocab": vocab, "merges": [list(m) for m in merges], "end_of_word_suffix": None})
    names = {t: n for n, t in vocab.items()}

    def merged(word):
        parts = list(word)
        for u, v in merges:
            out, k = [], 0
            while k < len(parts):
                if parts[k : k + 2] == [u, v]:
                    out.append(u + v)
                    k += 2
                else:
                    out.append(parts[k])
                    k += 1
            parts = out
        return parts

    def words(n):
        return [""] if not n else [w + c for w in words(n - 1) for c in "ab"]

    for n in range(1, 9):
        for w in words(n):
            assert [names[t] for t in a.word(w)] == merged(w)


def test_documents(spark, data, library):
    got = {r.doc_id: r for r in bpe.op9_bpe(spark, data).collect()}
    for d in spark.read.parquet(f"{data}/documents.parquet").collect():
        want = library.encode(d.text or "", add_special_tokens=False).ids
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(want), hashlib.sha256(struct.pack(f"<{len(want)}I", *want)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()


def check_packing(rows, tokens, capacity):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == tokens.keys()
    for k, found in by_doc.items():
        at = 0
        for r in sorted(found, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(tokens[k])
            part = tokens[k][at : at + r.length]
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += r.length
        assert at == len(tokens[k])
    for found in by_sequence.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity and at & (at - 1) == 0  # never padded


def test_packing(spark, data, library):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    tokens = {d.doc_id: [*library.encode(d.text or "", add_special_tokens=False).ids, 1] for d in docs.collect()}
    check_packing(packing.op5_packing(spark, data).collect(), tokens, 2048)
    check_packing(packing.pack(docs.repartition(3), capacity=64).collect(), tokens, 64)


def test_packing_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (None, "the", "z"), (3, "the " * 5000, "z")], "doc_id long, text string, start string")
    rows = packing.pack(df).collect()
    assert {r.doc_id: r.doc_tokens for r in rows} == {1: 1, 2: 1, None: 2, 3: 5001}
    assert packing.pack(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(df, capacity=100)


@given(st.lists(st.integers(1, 500), max_size=80), st.sampled_from([1, 2, 64, 128]))
def test_bins(lengths, capacity):
    bins = packing.Bins(capacity, 0)
    tokens = {}
    for k, n in enumerate(lengths):
        tokens[k] = [k * 1000 + j for j in range(n)]
        bins.add(k, struct.pack(f"<{n}I", *tokens[k]))
        assert sum(len(held) for held, _ in bins.open.values()) <= sum(range(packing.CLASSES)) + capacity
    bins.finish()
    rows = [SimpleNamespace(**dict(zip(packing.NAMES, r, strict=True))) for r in bins.done]
    check_packing(rows, tokens, capacity)
    # one cut for each bin; the last, short sequences are one for each binary digit
    assert len(rows) <= len(lengths) + len({r.sequence_id for r in rows})


def test_a_bin_takes_its_classes_count():
    bins = packing.Bins(1000, 0)
    for k in range(4):
        bins.add(k, bytes(4 * 300))  # class 3: three whole, and the fourth one's beginning
    found = [r for r in bins.done]
    assert [(r[0], r[2]) for r in found] == [(0, 300), (1, 300), (2, 300), (3, 100)] and {r[5] for r in found} == {0}
    assert {k: [len(p[2]) // 4 for p in held] for k, (held, _) in bins.open.items()} == {5: [200]}


def test_packing_few_cuts_and_repeated_rows(spark):
    import random

    random.seed(4)
    df = spark.createDataFrame([(k // 2, "the of and " * random.randint(1, 400)) for k in range(3000)], "doc_id long, text string").coalesce(1)
    rows = packing.pack(df).collect()
    whole = sum(r.length == 2048 for r in rows)
    assert len(rows) - whole <= 1.8 * 3000 and sum(r.length for r in rows) == sum(len(t.split()) + 1 for _, t in df.collect())
    sizes = {}
    for r in rows:
        sizes[r.sequence_id] = sizes.get(r.sequence_id, 0) + r.length
    assert sum(n < 2048 for n in sizes.values()) <= 11
