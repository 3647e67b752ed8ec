"""Byte-pair encoding and decoding by a tokenization automaton.

The merges are compiled, in their order, into a deterministic automaton over tokens that accepts exactly
the token sequences byte-pair encoding can produce.  It starts with one state in which every base symbol
may follow.  The gadget of merge k, ``u v -> w``:

* the state reached by ``u`` loses its arc ``v`` (the pair would have been merged);
* wherever an arc ``u`` leaves whose target has an arc ``v``, an arc ``w`` is put beside it;
* ``w`` leads to the state that ``v`` led to, as it was before this gadget.

Every token leads to one state of its own, so a gadget only has to record one removed arc and two
ancestors: arcs ``w`` go along with arcs ``u`` of time k, the state of ``w`` is that of ``v`` at time k.
Gadgets therefore cost O(1) each, and an arc is looked up by walking those records back (``_arc``); arcs
that have been looked up lie in a table.

A word is encoded from left to right by following arcs whose labels spell it; the automaton accepts exactly
one such sequence.  Decoding emits the labels of the arcs.

Texts are cut as the vocabulary's file says: canonical composition, white space runs to one space, lower
case, contractions / runs of letters / single digits / runs of other signs, bytes as printable characters,
with an end-of-word mark on each word's last symbol.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._spark import slices, two_columns


def _printable() -> list[str]:
    """The printable character of each byte: itself where it is a visible Latin-1 sign, else the next free one from 256."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, free = [], 256
    for b in range(256):
        out.append(chr(b if b in keep else free))
        free += b not in keep
    return out


#: Stands for the end-of-word mark in a label; no printable character of a byte is this one.
MARK = "\0"
#: Stands for the mark in bytes; UTF-8 never has this byte.
_END_BYTE = b"\xff"
_LITTLE = sys.byteorder == "little" and array("I").itemsize == 4
#: Longer words don't go through the table of tails.
LONG = 100


class Automaton:
    """Tokens, their gadgets and the table of arcs."""

    def __init__(self, model: dict) -> None:
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        size = max(self.vocab.values()) + 1
        #: of a merged token: its parts and the time of its gadget; base symbols have time -1
        self.left, self.right, self.time = [-1] * size, [-1] * size, [-1] * size
        #: removed arcs and the time of their removal
        self.removed: dict[tuple[int, int], int] = {}
        #: is the token what its own characters are encoded as?
        self.sound = [True] * size
        self.width, self.shorter, self.tree = [0] * size, [-1] * size, {}
        for name, t in self.vocab.items():
            self.width[t] = len(self._marked(name))
        for k, pair in enumerate(model["merges"]):
            u, v = pair.split(" ") if isinstance(pair, str) else pair
            self._gadget(k, self.vocab[u], self.vocab[v], self.vocab[u + v])
        self.arcs: dict[tuple[int, int], bool] = {}
        self._compile_labels()

    def _gadget(self, k: int, u: int, v: int, w: int) -> None:
        if self.time[w] >= 0:
            raise ValueError("two merges make the same token")
        self.sound[w] = self.sound[u] and self.sound[v] and self._arc(u, v, k)
        self.removed[u, v] = k
        self.left[w], self.right[w], self.time[w] = u, v, k

    def _arc(self, s: int, t: int, now: int) -> bool:
        """Has the state of ``s`` an arc ``t`` once the gadgets before time ``now`` are in?"""
        time, removed = self.time, self.removed
        while True:
            if removed.get((s, t), now) < now:
                return False
            a, b = time[s], time[t]
            if a < b:  # t lies beside the arcs of its left part, as they are after the removal
                now, t = b + 1, self.left[t]
            elif b < a:  # the state of s is the one its right part had
                now, s = a, self.right[s]
            elif a < 0:
                return True
            else:
                now, s, t = a, self.right[s], self.left[t]

    def _compile_labels(self) -> None:
        """The table of labels: a tree of the sound tokens' characters, and each token's longest proper prefix that is a token."""
        for name, t in self.vocab.items():
            if self.sound[t]:
                node = self.tree
                for c in self._marked(name):
                    node = node.setdefault(c, {})
                node[""] = t
        self._spread(self.tree, -1)
        for name, t in self.vocab.items():
            node = self.tree
            for c in self._marked(name)[:-1]:
                node = node.get(c)
                if node is None:
                    break
                self.shorter[t] = node[""]

    def _spread(self, node: dict, t: int) -> None:
        """Each node gets the longest token on the way to it."""
        t = node.setdefault("", t)
        for c, below in node.items():
            if c:
                self._spread(below, t)

    def _marked(self, name: str) -> str:
        return name.removesuffix(self.end) + MARK if self.end and name.endswith(self.end) else name

    def word(self, symbols: str) -> list[int]:
        """Tokens of one word, given as printable characters without the end mark.

        The longest token at the place reached is tried first, then its prefixes; a place from which no
        sequence reaches the end is left for good, so no place is entered twice.
        """
        text = symbols + MARK if self.end else symbols
        n, at, out, dead = len(text), 0, [], set()
        arcs, shorter, width, late, tree = self.arcs, self.shorter, self.width, len(self.time), self.tree
        while at < n:
            node = tree
            for c in text[at:] if at else text:
                below = node.get(c)
                if below is None:
                    break
                node = below
            t = node[""]
            while True:
                if t >= 0 and at + width[t] not in dead:
                    if not out:
                        break
                    s = out[-1]
                    ok = arcs.get((s, t))
                    if ok is None:
                        ok = arcs[s, t] = self._arc(s, t, late)
                    if ok:
                        break
                if t >= 0:
                    t = shorter[t]
                if t < 0:
                    dead.add(at)
                    t = out.pop()
                    at -= width[t]
                    t = shorter[t]
            out.append(t)
            at += width[t]
        return out


class Tails:
    """The automaton's transitions, by the token before and the rest of the word: raw ids, or nothing if no arc leads on.

    Words share their ends, so after a word's first token the rest is mostly in the table.
    """

    def __init__(self, automaton: Automaton, raw: list[bytes], keep: int) -> None:
        self.automaton, self.raw = automaton, raw
        self.known = Recent(self._rest, keep)

    def _rest(self, key: tuple[int, str]) -> bytes:
        s, text = key
        a = self.automaton
        node = a.tree
        for c in text:
            below = node.get(c)
            if below is None:
                break
            node = below
        t = node[""]
        while t >= 0:
            ok = a.arcs.get((s, t)) if s >= 0 else True
            if ok is None:
                ok = a.arcs[s, t] = a._arc(s, t, len(a.time))
            if ok:
                n = a.width[t]
                if n == len(text):
                    return self.raw[t]
                more = self.known[t, text[n:]]
                if more:
                    return self.raw[t] + more
            t = a.shorter[t]
        return b""

    def accepted(self, tokens: list[int]) -> bool:
        """Is there a path of arcs with these labels?  Then they are the encoding of the word that they spell."""
        a, before = self.automaton, -1
        arcs, sound = a.arcs, a.sound
        for t in tokens:
            if not sound[t]:
                return False
            if before >= 0:
                ok = arcs.get((before, t))
                if ok is None:
                    ok = arcs[before, t] = a._arc(before, t, len(a.time))
                if not ok:
                    return False
            before = t
        return True

    def word(self, symbols: str) -> bytes:
        if len(symbols) > LONG:
            return b"".join([self.raw[t] for t in self.automaton.word(symbols)])
        return self._rest((-1, symbols + MARK if self.automaton.end else symbols))


class Recent(dict):
    """What was made for recent keys, in two generations of at most ``keep`` entries each."""

    def __init__(self, make, keep: int) -> None:
        self.make, self.keep, self.old = make, keep, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.keep:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


#: How a vocabulary file of this kind says its words are cut: contractions, letters, single digits, other signs.
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: White space outside ASCII.
_SPACES = frozenset("\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
#: The same over one stand-in for each kind of character outside ASCII.
_LETTER, _DIGIT, _SPACE, _SIGN, _NEW = "\u00e9\u00b2\u00a0\u00a1\ufffd"
_CUT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LETTER}]+|[0-9{_DIGIT}]|[^\\t-\\r a-z0-9{_LETTER}{_DIGIT}{_SPACE}]+")


class _Kinds(dict):
    """The stand-in of each character; characters this Python's tables don't know yet are ``_NEW``."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        kind = unicodedata.category(c)
        out = c if code < 128 else _SPACE if c in _SPACES else _LETTER if kind[0] == "L" else _DIGIT if kind[0] == "N" else _NEW if kind == "Cn" else _SIGN
        if len(self) < 100_000:
            self[code] = out
        return out


class Coder:
    """Encodes and decodes whole texts; arcs and recent words are kept in tables of bounded size."""

    def __init__(self, source: bytes, keep: int = 300_000, propose: bool = False) -> None:
        """``propose``: let a byte-pair library propose a word's tokens, and take them if the automaton accepts them."""
        spec = json.loads(source)
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] or spec["model"]["type"] != "BPE":
            raise ValueError("this vocabulary cuts texts in another way than the encoder does")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        if split["pattern"]["Regex"] != CUTS:
            raise ValueError("this vocabulary cuts words in another way than the encoder does")
        self.source, self.library, self.kinds = source, None, _Kinds()
        self.byte = _printable()
        self.code = {c: b for b, c in enumerate(self.byte)}
        self.automaton = Automaton(spec["model"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        self.labels = [""] * (max([*self.automaton.vocab.values(), *self.special.values()]) + 1)
        for name, t in [*self.automaton.vocab.items(), *self.special.items()]:
            self.labels[t] = name
        self.raw = [np.array([t], "<u4").tobytes() for t in range(len(self.labels))]
        self.tails = Tails(self.automaton, self.raw, keep // 3)
        self.proposed = self._proposer() if propose and self.automaton.end else None
        self.by_word = Recent(self._word, keep // 10)
        self.by_chunk = Recent(self._chunk, keep)

    def _proposer(self):
        """A library's merging by rank of concatenations; where those ranks lead it elsewhere, the automaton refuses."""
        import tiktoken

        of = {c: bytes([b]) for b, c in enumerate(self.byte)}
        ranks = {}
        for name, t in self.automaton.vocab.items():
            label = name.removesuffix(self.automaton.end)
            ranks[b"".join([of[c] for c in label]) + (_END_BYTE if label != name else b"")] = t
        if len(ranks) < len(self.automaton.vocab) or any(bytes([b]) not in ranks for b in range(256)):
            return None
        return tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def _word(self, piece: str) -> bytes:
        byte = self.byte
        if self.proposed is not None:
            tokens = self.proposed(piece.encode() + _END_BYTE)
            if self.tails.accepted(tokens):
                return array("I", tokens).tobytes() if _LITTLE else b"".join([self.raw[t] for t in tokens])
        plain = piece.isascii() and piece.isprintable()  # no space is in a piece
        symbols = piece if plain else "".join([byte[b] for b in piece.encode()])
        if len(self.automaton.arcs) > 1_000_000:
            self.automaton.arcs.clear()
        return self.tails.word(symbols)

    def _plain(self, raw: str) -> bytes:
        text = raw
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")
        text = text.lower()
        if text.isalpha():
            return self._word(text)
        if text[-1:] in (".", ",") and text[:-1].isalpha():
            return self.by_chunk[text[:-1].encode()] + self.by_word[text[-1]]
        return b"".join([self.by_word[p] for p in self._pieces(text, raw)])

    def _pieces(self, text: str, raw: str) -> list[str]:
        if text.isascii():
            return _CUT.findall(text)
        kinds = text.translate(self.kinds)
        if _NEW not in kinds:
            return [text[m.start() : m.end()] for m in _CUT.finditer(kinds)]
        # characters newer than this Python: the library's own tables cut the text, as they may cut it otherwise
        if self.library is None:
            import tokenizers

            self.library = tokenizers.Tokenizer.from_str(self.source.decode())
        text = self.library.normalizer.normalize_str(raw)
        return [bytes([self.code[c] for c in p]).decode() for p, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _chunk(self, chunk: bytes) -> bytes:
        """Ids of what lies between two white spaces; no word crosses white space."""
        if chunk.isalpha():
            return self._word(chunk.decode().lower())
        text = chunk.decode()
        if "<|" not in text:
            return self._plain(text)
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += [self._plain(text[at : m.start()]), self.raw[self.special[m[0]]]]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def encode(self, text: bytes) -> bytes:
        """Ids of a UTF-8 text as little-endian unsigned 32-bit integers."""
        if b"<|" not in text:  # else a special token could come of it
            text = text.lower()
        return b"".join(map(self.by_chunk.__getitem__, text.split()))

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs; a vocabulary file without a decoder sets a space between them."""
        return " ".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(2)
def coder(source: bytes, propose: bool = False) -> Coder:
    return Coder(source, propose=propose)


def default_source(path: str | None = None) -> bytes:
    """The vocabulary file's content, read once by the driver."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, "rb") as f:
        return f.read()


def texts_of(batch: pa.RecordBatch) -> Iterator[tuple[int | None, bytes]]:
    """Id and UTF-8 text of each row; null texts are empty."""
    for part in slices(batch, "text"):
        texts = part.column("text").cast(pa.binary())
        for k, t in zip(part.column("id").to_pylist(), texts.to_pylist(), strict=True):
            yield k, t or b""


def encode_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Ids and decoded text of each row: ``doc_id``, ``ids`` (binary, unsigned 32-bit little-endian), ``decoded``.

    A null or empty text has no ids and decodes to the empty text.  Rows with equal ids are coded one by one;
    columns other than ``key`` and ``text`` are ignored.
    """
    return _coded(docs, key, text, path, False)


def digest_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """As ``encode_documents``, with digests instead of ids and text: nothing long leaves the worker."""
    return _coded(docs, key, text, path, True)


def _coded(docs: DataFrame, key: str, text: str, path: str | None, digest: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(default_source(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(shared.value)
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digest else ["doc_id", "n_tokens", "ids", "decoded"]
        for batch in batches:
            rows: list[tuple] = []
            for k, t in texts_of(batch):
                ids = code.encode(t)
                decoded = code.decode(ids)
                rows.append((k, len(ids) // 4, *((hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()) if digest else (ids, decoded))))
            if rows:
                a, b, c, d = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string() if digest else pa.binary()), pa.array(d, pa.string())], names)

    kind = "doc_id long, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digest else "ids binary, decoded string")
    return two_columns(docs, key, text).mapInArrow(run, kind)


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    return digest_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
