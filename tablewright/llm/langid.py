"""Language identification by cross-parsing.

For each language a suffix automaton of a bounded sample of labelled text knows every substring of that
sample.  A text is parsed from left to right into the longest phrases that occur in the sample; few phrases
mean that text and sample are alike.  The language whose parse needs the fewest phrases, each priced at the
logarithm of its sample's length and divided by the text's length, wins.

Letters are folded to lower case and all runs of other signs are one space; that holds for samples and texts.
Whole texts are parsed.  They are laid out as lanes of at most ``LANE`` signs, and all lanes of a slice and
all languages step through one table of transitions at once, so a text of any length costs memory by its
slice alone.  Lanes don't show in the result: each is first parsed as if a phrase began with it, then its beginning again from the
state that the lane before really ends in, until both parses agree; where they don't agree before its end, so
is the next lane.

The table holds each state's arcs in a short row that its letters index by their lower bits, so it grows with the
samples' arcs and not with the number of letters that the languages have.

Only the sample is bounded: ``langs`` languages (those with the most labelled documents, ties to the first name), ``docs_per_lang``
rows each (those with the smallest hash of their id; of rows that share an id and a language the last text in order is read) and ``chars_per_lang`` signs each, of which each
document gives an equal share; all languages together have at most ``chars`` signs.  The classifier needs no more,
and the table that goes to the workers, of at most 2 x ``chars`` states and 3 x ``chars`` arcs, does not grow with the input.

Defined results: null text or text without a letter is ``und`` with score 0; so is every text if nothing was
labelled.  Equal prices go to the first name in order.  Rows with equal ids are judged one by one.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._spark import slices, small_batches

LANE = 2048
#: Signs handled at once in a worker.
SLICE = 4 << 20
UND = "und"


@lru_cache(1)
def _fold() -> np.ndarray:
    """The lower-case letter of each code point, or 0 for what isn't a letter (combining marks go with letters)."""
    out = np.zeros(sys.maxunicode + 1, np.uint32)
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c))[0] in "LM":
            low = chr(c).lower()
            out[c] = ord(low[0])
    return out


def _signs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded signs of the texts, one after the other, spaces collapsed; where each begins (n + 1); does it have a letter?"""
    data = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), "<u4")
    at = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    folded = _fold()[data]
    keep = np.ones(len(folded), bool)
    keep[1:] = (folded[1:] != 0) | (folded[:-1] != 0)
    begins = at[:-1][np.diff(at) > 0]
    keep[begins] = folded[begins] != 0
    total = np.concatenate(([0], np.cumsum(keep)))
    letters = np.concatenate(([0], np.cumsum(folded != 0)))
    return folded[keep], total[at], letters[at[1:]] > letters[at[:-1]]


def suffix_automaton(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Arcs (state, sign, next state) of the automaton that knows every substring of ``text``, and how many states there are; 0 is none, 1 the start."""
    going: list[dict[int, int]] = [{}, {}]
    link, length, last = [0, 0], [0, 0], 1
    for c in text.tolist():
        new = len(going)
        going.append({})
        link.append(1)
        length.append(length[last] + 1)
        p = last
        while p and c not in going[p]:
            going[p][c] = new
            p = link[p]
        if p:
            q = going[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                twin = len(going)
                going.append(dict(going[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p and going[p].get(c) == q:
                    going[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    state = np.repeat(np.arange(len(going)), [len(arcs) for arcs in going])
    sign = np.fromiter((c for arcs in going for c in arcs), np.int64, len(state))
    return state, sign, np.fromiter((t for arcs in going for t in arcs.values()), np.int64, len(state)), len(going)


@dataclass
class Arcs:
    """Each state's arcs in a row of its own: as many places as the least power of two by which its signs differ.

    ``row``: where a state's row begins, and its length less one in the lower half; ``arc``: sign and next state.
    """

    row: np.ndarray
    arc: np.ndarray

    @staticmethod
    def of(state: np.ndarray, sign: np.ndarray, to: np.ndarray, states: int) -> Arcs:
        length = np.ones(states, np.int64)
        left = np.arange(len(state))
        while len(left):
            place = state[left] << 32 | sign[left] & (length[state[left]] - 1)
            found, times = np.unique(place, return_counts=True)
            clash = np.zeros(states, bool)
            clash[found[times > 1] >> 32] = True
            length[clash] *= 2
            left = left[clash[state[left]]]
        first = np.cumsum(length) - length
        arc = np.full(int(length.sum()), -1 << 32, np.int64)
        arc[first[state] + (sign & (length[state] - 1))] = sign << 32 | to
        return Arcs(first << 32 | (length - 1), arc)

    def find(self, state: np.ndarray, sign: np.ndarray) -> np.ndarray:
        """The next states; 0 where there is none."""
        row = self.row[state]
        arc = self.arc[(row >> 32) + (sign & row)]
        return np.where(arc >> 32 == sign, arc & 0xFFFFFFFF, 0)


@dataclass
class Model:
    """One table of arcs for all languages; state 0 has none.  ``restart``: where each language goes from its start."""

    langs: list[str]
    kind: np.ndarray
    arcs: Arcs
    restart: np.ndarray
    price: np.ndarray

    @staticmethod
    def of(samples: dict[str, list[str]], chars_per_lang: int) -> Model:
        langs, signs = [], []
        for lang in sorted(samples):
            text = _signs([x for t in samples[lang] for x in (t, " ")])[0][:chars_per_lang]
            if (text != 0).any():
                langs.append(lang)
                signs.append(text)
        known = np.unique(np.concatenate([np.zeros(1, np.uint32), *signs]))
        kinds = len(known) + 1  # the last is for signs that no sample has
        kind = np.full(sys.maxunicode + 1, kinds - 1, np.int32)
        kind[known] = np.arange(len(known))
        restart, arcs, base = np.zeros((len(langs), kinds), np.int64), [np.zeros((3, 0), np.int64)], 1
        for j, text in enumerate(signs):
            state, sign, following, states = suffix_automaton(kind[text])
            # state s of this automaton is base + s - 1; its start's arcs are in ``restart``
            begins = state == 1
            restart[j, sign[begins]] = following[begins] - 1 + base
            arcs.append(np.stack((state[~begins] - 1 + base, sign[~begins], following[~begins] - 1 + base)))
            base += states - 1
        return Model(langs, kind, Arcs.of(*np.concatenate(arcs, 1), base), restart, np.log2(np.maximum([len(t) for t in signs], 2)) if signs else np.zeros(0))

    def _step(self, state: np.ndarray, lang: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and whether a phrase ended before this letter.  State 0: a phrase begins."""
        new = self.arcs.find(state, code)
        ends = new == 0
        at = np.flatnonzero(ends)
        new[at] = self.restart[lang[at], code[at]]
        return new, ends

    def phrases(self, signs: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Phrases of each text's parse by each language, texts x languages."""
        n, many = len(at) - 1, len(self.langs)
        codes = self.kind[signs].astype(np.int64)
        lanes = -(-np.diff(at) // LANE)
        text = np.repeat(np.arange(n), lanes)
        number = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        start = at[text] + number * LANE
        length = np.minimum(at[text + 1] - start, LANE)
        order = np.argsort(-length, kind="stable")
        active = np.searchsorted(-length[order], -np.arange(LANE), "left")  # lanes longer than k
        state, count = np.zeros((len(text), many), np.int64), np.zeros((len(text), many), np.int64)
        lang = np.tile(np.arange(many), len(text))
        s, c = np.zeros((len(text), many), np.int64), np.zeros((len(text), many), np.int32)
        for k in range(int(length.max(initial=0))):
            m = active[k]
            new, ends = self._step(s[:m].ravel(), lang[: m * many], np.repeat(codes[start[order[:m]] + k], many))
            s[:m] = new.reshape(m, many)
            c[:m] += ends.reshape(m, many)
        state[order], count[order] = s, c

        # ``began``: the state each lane's parse was last begun in; one that its lane before doesn't end in is begun anew
        began = np.zeros_like(state)
        follows = np.flatnonzero(number > 0)
        while True:
            lane, j = np.nonzero(state[follows - 1] != began[follows])
            if not len(lane):
                break
            lane = follows[lane]
            old, new = began[lane, j].copy(), state[lane - 1, j].copy()
            began[lane, j] = new
            k = 0
            while len(lane):
                code = codes[start[lane] + k]
                old, ends_old = self._step(old, j, code)
                new, ends_new = self._step(new, j, code)
                count[lane, j] += ends_new.astype(np.int64) - ends_old
                k += 1
                last = length[lane] == k
                state[lane[last], j[last]] = new[last]
                on = (old != new) & ~last
                lane, j, old, new = lane[on], j[on], old[on], new[on]
        out = np.zeros((n, many))
        np.add.at(out, text, count)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        signs, at, lettered = _signs([t or "" for t in texts])
        if not self.langs:
            return [UND] * len(texts), np.zeros(len(texts))
        length = np.maximum(np.diff(at), 1)
        cost = self.phrases(signs, at) * self.price
        best = cost.argmin(1)
        # the weight of the winner among all, at the price for each sign and the confidence of at most 64 signs
        weight = np.exp2(-(cost - cost.min(1, keepdims=True)) / length[:, None] * np.minimum(length, 64)[:, None])
        score = np.where(lettered, 1 / weight.sum(1), 0.0)
        return [self.langs[b] if ok else UND for b, ok in zip(best, lettered, strict=True)], score


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", langs: int = 200, docs_per_lang: int = 60, chars_per_lang: int = 30_000, chars: int = 1_200_000) -> Model:
    """Learn from the rows of ``labelled`` with text and language.

    Languages are counted first; the ids with the smallest hashes are found language by language before any text
    moves; then the texts of those at most ``langs`` x ``docs_per_lang`` ids are fetched, one of each id and language.
    """
    rows = labelled.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where("text is not null and lang is not null and id is not null")
    some = rows.where(F.length("text") >= 1)
    names = [r.lang for r in some.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(langs).collect()]
    if not names:
        return Model.of({}, 0)
    most = max(1, min(chars_per_lang, chars // len(names)))
    # the window's group limit keeps what a task sends small
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = some.where(F.col("lang").isin(names)).select("id", "lang").withColumn("n", F.row_number().over(order)).where(F.col("n") <= docs_per_lang)
    wanted = {(r.id, r.lang) for r in chosen.select("id", "lang").collect()}
    fetched = some.where(F.col("id").isin(sorted({i for i, _ in wanted})) & F.col("lang").isin(names)).groupBy("id", "lang").agg(F.max(F.substring("text", 1, most)).alias("text"))
    samples: dict[str, list[tuple[int, str]]] = {}
    for r in fetched.collect():
        if (r.id, r.lang) in wanted:
            samples.setdefault(r.lang, []).append((r.id, r.text))
    return Model.of({k: shares([t for _, t in sorted(v)], most) for k, v in samples.items()}, most)


def shares(texts: list[str], most: int) -> list[str]:
    """The beginnings of the texts, ``most`` signs in all (a space after each counts): an equal share of each, what short ones leave goes to the others."""
    out, room = list(texts), most
    for left, k in zip(range(len(texts), 0, -1), sorted(range(len(texts)), key=lambda k: len(texts[k])), strict=True):
        out[k] = texts[k][: max(room // left - 1, 0)]
        room -= len(out[k]) + 1
    return out


def _parts(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    for part in slices(batch, column, SLICE):
        yield part, part.column(column).to_pylist()


def identify(docs: DataFrame, model: Model | Broadcast, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of each row; only the text is looked at."""
    shared = model if isinstance(model, Broadcast) else docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _parts(batch, "text"):
                langs, score = shared.value.predict(texts)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(langs, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model | Broadcast, text: str = "text", least: float = 0.3) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are in a known language with a score of ``least`` or more."""
    shared = model if isinstance(model, Broadcast) else docs.sparkSession.sparkContext.broadcast(model)
    small_batches(docs.sparkSession)
    schema, place = docs.schema, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns, [str(k) for k in range(batch.num_columns)])
            for part, texts in _parts(batch, str(place)):
                langs, score = shared.value.predict(texts)
                part = part.filter(pa.array((np.array(langs) != UND) & (score >= least)))
                yield pa.RecordBatch.from_arrays(part.columns, [f.name for f in schema])

    return docs.mapInArrow(run, schema)


def fold_of(key: str = "doc_id", folds: int = 4):
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(folds))


def op6_langid(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = fit(docs.where(fold_of() != 2))
    found = identify(docs, model)
    return found.select("doc_id", F.coalesce(fold_of() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
