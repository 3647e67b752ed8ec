"""Quality rules by repetition coverage.

For several n-gram lengths the operator takes rolling hashes of all word n-grams of a text (prefix-sum
polynomials in numpy) and measures which share of the text's word characters lies inside n-grams that
occur more than once, and inside lines that repeat an earlier line.  Every text is judged on its own and
whole, so the work is one narrow pass without a shuffle.

Defined results: a null or empty text has no words and fails; rows with the same id are judged one by one;
other columns of the input are ignored (``measure``) or kept as they are (``keep_good``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import _words
from ._spark import bytes_of, slices, small_batches, two_columns

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, dup_line_share double, repeat_share double, dup_shares array<double>"
)


@dataclass(frozen=True)
class Limits:
    """Shares of a text's word characters above which it is rejected."""

    #: inside words that repeat an earlier word, for texts of 100 words; rises by ``rise`` each time the text doubles
    repeat: float = 0.45
    rise: float = 0.05
    #: inside lines that repeat an earlier line
    lines: float = 0.30
    #: symbols for each word
    symbols: float = 0.25
    #: n-gram length and the share inside n-grams that occur more than once
    grams: tuple[tuple[int, float], ...] = ((4, 0.45), (5, 0.42), (6, 0.40), (7, 0.38), (8, 0.36), (10, 0.34))


def _covered(hashes: np.ndarray, first: np.ndarray, w: _words.Words, n: int) -> np.ndarray:
    """Of each word: is it inside an n-word window that occurs twice or more in its text?"""
    inside = np.zeros(len(w.hash) + 1, np.int64)
    if len(hashes):
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        order = np.lexsort((hashes, text))
        h, t = hashes[order], text[order]
        same = (h[1:] == h[:-1]) & (t[1:] == t[:-1])
        twice = np.zeros(len(h), bool)
        twice[1:] |= same
        twice[:-1] |= same
        at = order[twice]
        at = at - first[text[at]] + w.first[text[at]]
        np.add.at(inside, at, 1)
        np.add.at(inside, at + n, -1)
    return np.cumsum(inside[:-1]) > 0


def _repeats(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Of each entry: does an earlier entry of the same text have the same hash?"""
    out = np.zeros(len(hashes), bool)
    if len(hashes):
        order = np.lexsort((np.arange(len(hashes)), hashes, text))
        h, t = hashes[order], text[order]
        out[order[1:]] = (h[1:] == h[:-1]) & (t[1:] == t[:-1])
    return out


def _sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[first[1:]] - total[first[:-1]]


def measure_texts(data: np.ndarray, at: np.ndarray, limits: Limits) -> dict[str, np.ndarray]:
    n = len(at) - 1
    w = _words.words(data, at, lower=False)
    chars = _words.code_points(w)
    n_words, word_chars = np.diff(w.first), _sum(chars, w.first)
    text = np.repeat(np.arange(n), n_words)
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[data])))
    n_symbols = symbols[at[1:]] - symbols[at[:-1]]

    breaks = np.flatnonzero(data == 0x0A)
    line_start = np.unique(np.concatenate((at[:-1][np.diff(at) > 0], breaks[~np.isin(breaks + 1, at)] + 1)))
    line_end = np.concatenate((line_start[1:], at[-1:])) if len(line_start) else line_start
    if len(line_start):
        line_end = line_end - (data[line_end - 1] == 0x0A)
        line_end = np.maximum(line_end, line_start)
    words_in = np.searchsorted(w.start, line_end) - np.searchsorted(w.start, line_start)
    line_start, line_end = line_start[words_in > 0], line_end[words_in > 0]
    line_text = np.searchsorted(at, line_start, "right") - 1
    again = _repeats(_words.span_hashes(_words._OF_BYTE[data], line_start, line_end), line_text)
    n_dup_lines = np.bincount(line_text[again], minlength=n)
    char_at = np.concatenate(([0], np.cumsum(chars)))
    line_chars = char_at[np.searchsorted(w.start, line_end)] - char_at[np.searchsorted(w.start, line_start)]
    dup_line_chars = np.bincount(line_text[again], line_chars[again], n)

    whole = np.maximum(word_chars, 1)
    repeat_share = _sum(np.where(_repeats(w.hash, text), chars, 0), w.first) / whole
    shares, n_repeat = [], np.zeros(n, np.int64)
    for k, _ in limits.grams:
        covered = _covered(*_words.windows(w, k), w, k)
        shares.append(_sum(np.where(covered, chars, 0), w.first) / whole)
        if k == 8:
            n_repeat = _sum(covered, w.first)
    if 8 not in dict(limits.grams):
        n_repeat = _sum(_covered(*_words.windows(w, 8), w, 8), w.first)
    failed = (n_words < 20) | (100 * n_repeat > 30 * n_words)
    line_share = dup_line_chars / whole
    bad = (line_share > limits.lines) | (n_symbols > limits.symbols * n_words) | (repeat_share > np.minimum(0.95, limits.repeat + limits.rise * np.log2(np.maximum(n_words, 100) / 100)))
    for (_, most), share in zip(limits.grams, shares, strict=True):
        bad |= share > most
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat,
        "base_failed": failed, "kept": ~failed & ~bad, "dup_line_share": line_share, "repeat_share": repeat_share, "dup_shares": np.stack(shares, 1),
    }


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text", limits: Limits | None = None) -> DataFrame:
    """A row of counts, shares and verdicts for each row of ``docs``."""
    limits = limits or Limits()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                m = measure_texts(*bytes_of(part.column("text")), limits)
                shares = m.pop("dup_shares")
                lists = pa.ListArray.from_arrays(np.arange(0, shares.size + 1, shares.shape[1], dtype=np.int32), shares.ravel())
                yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(v) for v in m.values()), lists], ["doc_id", *m, "dup_shares"])

    return two_columns(docs, key, text).mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame, key: str = "doc_id", text: str = "text", limits: Limits | None = None) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text is kept.  One narrow pass: the verdict travels with the row."""
    small_batches(docs.sparkSession)
    limits, names, place = limits or Limits(), docs.schema, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns, [str(k) for k in range(batch.num_columns)])
            for part in slices(batch, str(place)):
                kept = measure_texts(*bytes_of(part.column(place)), limits)["kept"]
                part = part.filter(pa.array(kept))
                yield pa.RecordBatch.from_arrays(part.columns, [f.name for f in names])

    return docs.mapInArrow(run, names)


def op8_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return measure(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")



def _sql(limits: Limits) -> str:
    word = r"[\x20\x09-\x0D]"
    parts = [
        f"texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '{word}+'), lambda x: x <> '') AS w FROM documents)",
        "places AS (SELECT row, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM texts)",
        "counts AS (SELECT row, count(*) AS n_words, sum(length(word)) AS word_chars FROM places GROUP BY row)",
        "again AS (SELECT row, sum((n - 1) * length(word)) AS chars FROM (SELECT row, word, count(*) AS n FROM places GROUP BY ALL) GROUP BY row)",
        f"lines AS (SELECT row, line, count(*) AS n FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM texts) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY ALL)",
        f"dup AS (SELECT row, sum(n - 1) AS n_dup_lines, sum((n - 1) * length(regexp_replace(line, '{word}', '', 'g'))) AS chars FROM lines GROUP BY row)",
    ]
    lengths = sorted({8, *(k for k, _ in limits.grams)})
    for k in lengths:
        parts += [
            f"w{k} AS (SELECT row, i, array_to_string(w[i:i + {k - 1}], ' ') AS s FROM (SELECT row, w, unnest(range(1, len(w) - {k - 2})) AS i FROM texts))",
            f"t{k} AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, s) AS n FROM w{k}) WHERE n > 1)",
            f"c{k} AS (SELECT row, count(*) AS n, sum(length(word)) AS chars FROM (SELECT DISTINCT row, i + d AS i FROM t{k}, range({k}) r(d)) JOIN places USING (row, i) GROUP BY row)",
        ]
    whole = "greatest(coalesce(word_chars, 0), 1)"
    bad = [
        f"coalesce(dup.chars, 0) / {whole} > {limits.lines}",
        f"length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) > {limits.symbols} * coalesce(n_words, 0)",
        f"coalesce(again.chars, 0) / {whole} > least(0.95, {limits.repeat} + {limits.rise} * log2(greatest(coalesce(n_words, 0), 100) / 100))",
        *(f"coalesce(c{k}.chars, 0) / {whole} > {most}" for k, most in limits.grams),
    ]
    joins = " ".join(f"LEFT JOIN {t} USING (row)" for t in ("counts", "again", "dup", *(f"c{k}" for k in lengths)))
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT bad AS kept FROM (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM (
    SELECT doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
      CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, coalesce(c8.n, 0) AS n_repeat_words, {" OR ".join(bad)} AS bad
    FROM texts {joins}))"""
    )


OP8_SQL = _sql(Limits())
