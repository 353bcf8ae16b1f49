"""Periodic runs of words by a sparse table of diagonals.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are equal),
at least ``least`` words and ``times`` periods long, that no neighbouring word
extends. It is a diagonal at lag ``q``: one position after another matches the one
``q`` before it. Each word adds one to the match length of the lag of its earlier
occurrence; where that lag is not taken up by the next word, the diagonal ends and
is a run if it is long enough.

Two facts keep the table sparse. A run matches at least ``_first_scale`` words in a
row, so texts without a repeated stretch of that many words have none. And inside a
run of period ``q`` the nearest earlier occurrence of a stretch of ``q`` or more
words lies exactly ``q`` back (a nearer one would be a smaller period), so for the
periods between half of ``g`` and ``g`` one lag per position is enough: that of the
nearest earlier occurrence of its ``g`` words. With ``g`` doubled up to the longest
possible period, a text of n words costs n log n, however often a word occurs.
Stretches are named exactly, by doubling from the words; hashes only sort out texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pricewright.llm.common import texts
from pricewright.llm.words import Words, pieces_of

LEAST_WORDS, TIMES = 24, 3


def _first_scale(least: int, times: int) -> int:
    """The largest power of two that no run's number of matching words falls short of."""
    fewest = min(max(least - q, (times - 1) * q) for q in range(1, least + 1))
    return 1 << (max(1, fewest).bit_length() - 1)


def _doubled(names: np.ndarray, valid: np.ndarray, size: int, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of all stretches of ``2 * size`` words from those of ``size``, and where they fit into their text."""
    valid = valid[valid + 2 * size <= ends[valid]]
    pairs = names[valid] * np.int64(len(names) + 1) + names[valid + size]
    out = np.full(len(names), -1, dtype=np.int64)
    out[valid] = np.unique(pairs, return_inverse=True)[1]
    return out, valid


def _earlier(names: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """For each of the ``valid`` positions the distance to the nearest earlier one of the same name, or 0."""
    order = valid[np.argsort(names[valid], kind="stable")]
    same = np.flatnonzero(names[order[1:]] == names[order[:-1]])
    lags = np.zeros(len(names), dtype=np.int64)
    lags[order[same + 1]] = order[same + 1] - order[same]
    return lags[valid]


def find_runs(names: np.ndarray, first: np.ndarray, least: int = LEAST_WORDS, times: int = TIMES) -> np.ndarray:
    """Rows of ``text, start, length, period``, by text, start and period.

    ``names`` numbers the words of all texts, ``first[i]:first[i + 1]`` are those of
    text ``i``; equal words of different texts must have different numbers.
    """
    if times < 3:
        raise ValueError("a run has at least three periods")
    counts = np.diff(first)
    ends, of = np.repeat(first[1:], counts), np.repeat(np.arange(len(counts)), counts)
    valid, size, scale, found = np.arange(len(names)), 1, _first_scale(least, times), []
    while size < scale:
        names, valid = _doubled(names, valid, size, ends)
        size *= 2
    shortest = 1
    while len(valid):
        lags = np.zeros(len(names), dtype=np.int64)
        lags[valid] = _earlier(names, valid)
        if not lags.any():
            break
        borders = np.flatnonzero(np.diff(lags, prepend=-1, append=-1))
        begin, stop = borders[:-1], borders[1:]
        q = lags[begin]
        matched = stop - begin + size - 1
        good = (q >= shortest) & (q <= size) & (matched >= np.maximum(least - q, (times - 1) * q))
        begin, q, matched = begin[good], q[good], matched[good]
        found.append(np.stack([of[begin], begin - q - first[of[begin]], matched + q, q], axis=1))
        shortest = size + 1
        if times * shortest > counts.max():
            break
        names, valid = _doubled(names, valid, size, ends)
        size *= 2
    out = np.concatenate(found) if found else np.zeros((0, 4), dtype=np.int64)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _suspects(words: Words, scale: int) -> np.ndarray:
    """The texts in which ``scale`` words in a row occur again, by hash: all that have, perhaps a few more."""
    grams, at = words.grams(words.hashes(), scale)
    of = np.searchsorted(words.first, at, side="right") - 1
    order = np.lexsort((grams, of))
    same = (grams[order[1:]] == grams[order[:-1]]) & (of[order[1:]] == of[order[:-1]])
    return np.unique(of[order[1:][same]])


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("kept", pa.string())])
_FOUND_DDL = ("doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, kept string")


def _collapse(least: int, times: int):
    scale = _first_scale(least, times)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, column = batch.column("doc_id"), batch.column("text")
            for row, data, offsets in pieces_of(column):
                words = Words(data, offsets)
                raw = data.tobytes()
                cut = [raw[offsets[i]:offsets[i + 1]].split() for i in range(len(offsets) - 1)]
                runs: list[list[dict]] = [[] for _ in cut]
                some = _suspects(words, scale)
                names, first = [], [0]
                for text in some:
                    known: dict[bytes, int] = {}
                    names.extend(first[-1] + known.setdefault(word, len(known)) for word in cut[text])
                    first.append(len(names))
                for text, start, length, period in find_runs(
                        np.array(names, dtype=np.int64), np.array(first), least, times).tolist():
                    runs[some[text]].append({"start": start, "length": length, "period": period})
                kept = []
                for text, own in zip(cut, runs, strict=True):
                    if own:
                        stay = np.ones(len(text), dtype=bool)
                        for run in own:
                            stay[run["start"] + run["period"]:run["start"] + run["length"]] = False
                        text = [text[i] for i in np.flatnonzero(stay)]
                    kept.append(b" ".join(text))
                yield pa.RecordBatch.from_arrays([
                    keys.slice(row, len(cut)), pa.array(np.diff(words.first)), pa.array(runs, pa.list_(_RUN)),
                    pa.array(kept, pa.binary()).cast(pa.string())], schema=_FOUND)

    return apply


def collapsed(docs: DataFrame, least: int = LEAST_WORDS, times: int = TIMES,
              key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, kept`` for every row.

    Words are runs of signs other than ASCII white space, numbered from 0. ``runs``
    holds ``start, length, period`` by start, then period. ``kept`` is the words that
    no run contains behind its first period, joined by single spaces. Null and empty
    texts have no words, no runs and keep ''. Each row is looked at by itself, so
    repeated rows and null identifiers have results of their own; an empty table
    gives an empty result.
    """
    return texts(docs, key, text).mapInArrow(_collapse(least, times), _FOUND_DDL)
