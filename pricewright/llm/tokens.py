"""Token ids of whole texts by the tokenizers library, in Arrow batches.

The library cuts a text into words and signs before it merges, and never merges
across a cut, so the ids of a text are those of its parts in turn. Texts in Latin
letters are cut here by the vocabulary's own rule, and each different part of a
slice goes to the library once; its ids are remembered, up to a fixed number of
parts. Texts with other signs go to the library whole, and so do texts that hold an
added token of the vocabulary where such a token counts as one.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pricewright.llm.common import worker_store

MOST_PARTS = 400_000
PARTS_AT_ONCE = 1000
# How the vocabularies mark a token that ends a word, and one that begins with a space.
WORD_END, SPACE = "</w>", "\u0120"
SLICE_BYTES = 1 << 20

# Signs for which Python's letters, digits and white space are those of the vocabularies' rules.
_LATIN = re.compile("[\\x00-\\x1b\\x20-\\x7f\u00c0-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]*")
# Letters of such texts, also after they are put in lower case.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af\u2c60-\u2c7f"
_SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
# How the vocabularies cut texts.
_CUTS = {
    "spaced": re.compile(rf" ?[{_LETTERS}]+| ?[0-9]+|{_SHORT}| ?[^\s0-9{_LETTERS}]+|\s+(?!\S)|\s+"),
    "plain": re.compile(rf"[{_LETTERS}]+|[0-9]|{_SHORT}|[^\s0-9{_LETTERS}]+"),
}


class _Numbers(dict):
    """Parts to numbers from 0 on; a part that is not known gets the next one and is noted as new."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, part: str) -> int:
        number = self[part] = len(self)
        self.new.append(part)
        return number


class _Ids:
    """The ids of numbered parts: ``data[starts[n]:starts[n] + sizes[n]]``."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        self.data, self.starts, self.sizes = data, starts, sizes

    def followed_by(self, other: _Ids) -> _Ids:
        return _Ids(np.concatenate([self.data, other.data]), np.concatenate([self.starts, other.starts + len(self.data)]),
                    np.concatenate([self.sizes, other.sizes]))

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these parts in turn, and where each part ends."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[numbers] - ends + sizes, sizes)
        return self.data[at], ends


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    With ``added`` the vocabulary's added tokens in a text have their own ids, as by the
    library's default; without it they are ordinary signs.
    """

    def __init__(self, path: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = not added
        self.added = [token.content for token in self.model.get_added_tokens_decoder().values()] if added else []
        self.lower = self.model.normalizer is not None
        self.cuts = _CUTS["plain" if self.lower else "spaced"]
        vocabulary = self.model.get_vocab()
        self.border = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.border[[number for token, number in vocabulary.items() if (
            token.endswith(WORD_END) if self.lower else token.startswith(SPACE))]] = True
        self.numbers = _Numbers()
        self.known = self._encode_parts([])

    def _arrays(self, texts: list[str]) -> list[np.ndarray]:
        found = self.model.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, dtype="<u4") for one in found]

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [ids.tobytes() for ids in self._arrays(texts)]

    def _bounds(self, ids: np.ndarray) -> np.ndarray:
        """Where parts begin and end in the ids of parts in a row, by the tokens that begin or end one."""
        at = np.flatnonzero(self.border[ids])
        return np.concatenate([[0], at + 1]) if self.lower else np.append(at, len(ids))

    def _encode_parts(self, parts: list[str]) -> _Ids:
        """Parts go to the library many in a row where the vocabulary tells their borders, else alone."""
        in_row = [self.lower or part[0] == " " and not part.isspace() for part in parts]
        row, alone = ([at for at, joined in enumerate(in_row) if joined is kind] for kind in (True, False))
        groups = [row[at:at + PARTS_AT_ONCE] for at in range(0, len(row), PARTS_AT_ONCE)]
        data, starts, sizes = [], np.zeros(len(parts), dtype=np.int64), np.zeros(len(parts), dtype=np.int64)
        done = 0
        glue = " " if self.lower else ""
        for group, ids in zip(groups, self._arrays([glue.join([parts[at] for at in group]) for group in groups]),
                              strict=True):
            bounds = self._bounds(ids)
            if len(bounds) != len(group) + 1 or bounds[0] or bounds[-1] != len(ids):
                alone.extend(group)
                continue
            starts[group], sizes[group] = done + bounds[:-1], np.diff(bounds)
            data.append(ids)
            done += len(ids)
        for at, ids in zip(alone, self._arrays([parts[at] for at in alone]), strict=True):
            starts[at], sizes[at] = done, len(ids)
            data.append(ids)
            done += len(ids)
        return _Ids(np.concatenate([np.zeros(0, dtype="<u4"), *data]), starts, sizes)

    def encode(self, texts: list[str]) -> list[bytes]:
        latin = [_LATIN.fullmatch(text) is not None and not any(token in text for token in self.added) for text in texts]
        cut = [self.cuts.findall(text.lower() if self.lower else text)
               for text, plain in zip(texts, latin, strict=True) if plain]
        numbers = self.numbers
        row = np.fromiter(map(numbers.__getitem__, chain.from_iterable(cut)), dtype=np.int64, count=sum(map(len, cut)))
        new, numbers.new = numbers.new, []
        room = max(0, MOST_PARTS - len(numbers) + len(new))
        if new[:room]:
            self.known = self.known.followed_by(self._encode_parts(new[:room]))
        for part in new[room:]:
            del numbers[part]
        now = self.known.followed_by(self._encode_parts(new[room:])) if new[room:] else self.known
        ids, ends = now.of(row)
        last = np.concatenate([[0], ends])[np.cumsum([0, *map(len, cut)])].tolist()
        mine = iter([ids[a:b].tobytes() for a, b in zip(last[:-1], last[1:], strict=True)])
        others = iter(self._encode([text for text, plain in zip(texts, latin, strict=True) if not plain]))
        return [next(mine) if plain else next(others) for plain in latin]


def encoder(path: str, added: bool = False) -> Encoder:
    """The worker's encoder for a vocabulary file; it stays until another operator asks for its own store."""
    store = worker_store("tokens")
    if (path, added) not in store:
        store[path, added] = Encoder(path, added)
    return store[path, added]


def slices_of(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts in slices of bounded size, or one text: the first row, and the texts."""
    sizes = np.cumsum(np.frombuffer(pc.binary_length(column).fill_null(0).cast(pa.int64()).buffers()[1],
                                    dtype=np.int64)[:len(column)])
    row = 0
    while row < len(column):
        before = sizes[row - 1] if row else 0
        last = max(row + 1, int(np.searchsorted(sizes, before + SLICE_BYTES, side="right")))
        yield row, column.slice(row, last - row).to_pylist()
        row = last


def encoded(path: str, columns: Callable, schema: pa.Schema, added: bool = False):
    """A function for ``mapInArrow``: ``columns(keys, ids)`` makes the arrays of each slice of rows."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(path, added)
        for batch in batches:
            keys = batch.column("doc_id")
            for row, texts in slices_of(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    columns(keys.slice(row, len(texts)), model.encode(texts)), schema=schema)

    return apply


def checksum(ids: bytes) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids)
