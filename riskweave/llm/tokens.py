"""Token ids of whole texts by a vocabulary file of the tokenizers library.

The vocabulary must fold case and white space and keep letters, single digits
and other marks apart (as ``word_bpe_49k.json`` does), so a worker lets the
library encode each distinct unit once and looks the rest up.  A unit is a run
of letters, a digit or a run of marks inside a word; a word with an apostrophe
(contractions), a ``<`` (added tokens) or other than ASCII and Latin-1 letters
is one unit.  Units are hashed by numpy, found in an open-addressing table,
and their ids gathered from one flat array, without Python code per word.  The
bytes of every unit found are compared with those it was learnt from, so two
units of one hash are told apart.

What a worker remembers is bounded in bytes (``CACHE_BYTES``).  Strings of added tokens in a text are those tokens, as
the library has it.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from riskweave.llm.common import HASH_BYTES, SEPARATORS, SLICE_BYTES, mix64, slices, text_bytes, text_sizes

#: Bytes of units, ids and table that a worker remembers before it starts afresh.
CACHE_BYTES = 96 << 20
#: Units of letters that the library gets as one text, and how their last id is spelt.
TOGETHER, WORD_END = 500, "</w>"


def gathered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``starts[i] : starts[i] + lengths[i]``, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


_LETTER, _DIGIT, _MARK, _BLANK, _OTHER = range(5)
_KIND = np.full(256, _MARK, np.uint8)
_KIND[128:] = _OTHER
_KIND[np.frombuffer(SEPARATORS, np.uint8)] = _BLANK
_KIND[48:58] = _DIGIT
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[np.frombuffer(b"'<", np.uint8)] = _OTHER
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_rng = np.random.Generator(np.random.PCG64(7341))
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = int(_rng.integers(0, 2**61)) * 8 + 5


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with ASCII letters folded where a word is cut, starts, stops) of the texts' units."""
    kind = _KIND[data]
    # the two bytes of a Latin-1 letter: C3 and 80 to BF, but for the signs at 97 and B7
    lead = np.flatnonzero(data == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    inside = kind != _BLANK
    other = kind[1:] != kind[:-1]
    edge = inside & (first[:-1] | (kind == _DIGIT))
    edge[1:] |= inside[1:] & other
    folded = _FOLD[data]
    odd = np.flatnonzero(kind == _OTHER)
    if len(odd):  # their words go to the library as they are
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | first[1:-1]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:] | first[1:-1]
        start, stop = np.flatnonzero(begins), np.flatnonzero(closes) + 1
        whole = np.unique(np.searchsorted(start, odd, "right") - 1)
        at = gathered(start[whole], (stop - start)[whole])
        edge[at] = False
        edge[start[whole]] = True
        folded[at] = data[at]
    last = inside.copy()
    last[:-1] &= edge[1:] | ~inside[1:] | first[1:-1]
    return folded, np.flatnonzero(edge), np.flatnonzero(last) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span (ascending, not overlapping)."""
    out = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(stops, starts[low] + HASH_BYTES, "right")))
        base, end = int(starts[low]), int(stops[high - 1])
        power, inverse = _powers(max(HASH_BYTES, end - base))
        run = np.zeros(end - base + 1, np.uint64)
        np.cumsum(_BYTE[data[base:end]] * power[: end - base], out=run[1:])
        a, b = starts[low:high] - base, stops[low:high] - base
        out[low:high] = mix64((run[b] - run[a]) * inverse[a] + (b - a).astype(np.uint64))
        low = high
    return out


def _powers(n: int, _kept: list = []) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006 - kept for the worker
    if n <= HASH_BYTES and _kept:
        return _kept[0]
    made = []
    for b in (_STEP, pow(_STEP, -1, 1 << 64)):
        factors = np.full(n + 1, b, np.uint64)
        factors[0] = 1
        made.append(np.cumprod(factors, dtype=np.uint64))
    if n <= HASH_BYTES:
        _kept.append(tuple(made))
    return tuple(made)


class WordTable:
    """Hash -> number of a unit, by linear probing; numbers count up from 0."""

    def __init__(self, bits: int = 16) -> None:
        self.bits, self.n = bits, 0
        self.keys = np.zeros(1 << bits, np.uint64)
        self.numbers = np.full(1 << bits, -1, np.int64)

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Each hash's number, -1 if it is not there."""
        at, mask = self._places(hashes), len(self.keys) - 1
        out = self.numbers[at]
        # a place that holds another hash: go on to the next
        left = np.flatnonzero((out >= 0) & (self.keys[at] != hashes))
        while len(left):
            at[left] = (at[left] + 1) & mask
            out[left] = self.numbers[at[left]]
            left = left[(out[left] >= 0) & (self.keys[at[left]] != hashes[left])]
        return out

    def add(self, hashes: np.ndarray) -> None:
        """Number distinct hashes that are not there yet."""
        while 2 * (self.n + len(hashes)) > len(self.keys):
            old = self.numbers >= 0
            keys, numbers = self.keys[old], self.numbers[old]
            n, self.bits = self.n, self.bits + 1
            self.keys, self.numbers = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -1, np.int64)
            self._put(keys, numbers)
            self.n = n
        self._put(hashes, self.n + np.arange(len(hashes)))
        self.n += len(hashes)

    def _put(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        at, mask = self._places(hashes), len(self.keys) - 1
        left = np.arange(len(hashes))
        while len(left):
            free = left[self.numbers[at[left]] < 0]
            self.numbers[at[free]] = numbers[free]  # of several for one place, the last stays
            won = free[self.numbers[at[free]] == numbers[free]]
            self.keys[at[won]] = hashes[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            at[left] = (at[left] + 1) & mask


class Rows:
    """Rows of varying length in one flat array that grows by doubling."""

    def __init__(self, kind: type) -> None:
        self.flat, self.size = np.zeros(1 << 12, kind), 0
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        while self.size + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.size : self.size + len(flat)] = flat
        self.starts = np.concatenate([self.starts, self.size + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.size += len(flat)

    def take(self, rows: np.ndarray) -> np.ndarray:
        return self.flat[gathered(self.starts[rows], self.lengths[rows])]

    @property
    def nbytes(self) -> int:
        return self.flat.nbytes + self.starts.nbytes + self.lengths.nbytes


class WordEncoder:
    def __init__(self, vocabulary: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(names.values()) + 1, bool)
        self.closes[[i for name, i in names.items() if name.endswith(WORD_END)]] = True
        self.forget()

    def forget(self) -> None:
        self.table, self.ids, self.spelt = WordTable(), Rows(np.uint32), Rows(np.uint8)

    @property
    def nbytes(self) -> int:
        return self.table.keys.nbytes + self.table.numbers.nbytes + self.ids.nbytes + self.spelt.nbytes

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each has)."""
        told = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.array([len(x) for x in told], np.int64)
        return np.fromiter((i for x in told for i in x), np.uint32, int(lengths.sum())), lengths

    def _learn(self, units_: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for units.  Those of letters alone are one piece each, which ends
        at an id with the vocabulary's word end, so many go to the library at once."""
        single = np.array([x.isalpha() and x[-1] <= "\xff" for x in units_], bool)
        names = [x for x, one in zip(units_, single) if one]
        flat, _ = self._library([" ".join(names[i : i + TOGETHER]) for i in range(0, len(names), TOGETHER)])
        ends = np.flatnonzero(self.closes[flat]) + 1
        if len(ends) != len(names):
            return self._library(units_)
        rest, counts = self._library([x for x, one in zip(units_, single) if not one])
        lengths = np.zeros(len(units_), np.int64)
        lengths[single], lengths[~single] = np.diff(ends, prepend=0), counts
        out = np.empty(int(lengths.sum()), np.uint32)
        at = np.cumsum(lengths) - lengths
        out[gathered(at[single], lengths[single])] = flat
        out[gathered(at[~single], counts)] = rest
        return out, lengths

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after the other; how many each text has; null: none)."""
        if self.nbytes > CACHE_BYTES:
            self.forget()
        raw_data, offsets = text_bytes(column)
        data, start, stop = units(raw_data, offsets)
        hashes, bounds, size = span_hashes(data, start, stop), np.searchsorted(start, offsets), stop - start
        word = self.table.find(hashes)
        new = np.flatnonzero(word < 0)
        if len(new):
            _, first = np.unique(hashes[new], return_index=True)
            first = np.sort(new[first])
            spelt = data[gathered(start[first], size[first])]
            raw, ends = spelt.tobytes(), np.cumsum(size[first]).tolist()
            flat, lengths = self._learn([raw[a:b].decode() for a, b in zip([0, *ends], ends)])
            self.ids.add(flat, lengths)
            self.spelt.add(spelt, size[first])
            self.table.add(hashes[first])
            word[new] = self.table.find(hashes[new])
        told = self.spelt.lengths[word]
        if not (told == size).all() or not (self.spelt.take(word) == data[gathered(start, size)]).all():
            flat, lengths = self._library([x or "" for x in column.to_pylist()])  # two units of one hash
            return flat, lengths
        ends = np.concatenate([[0], np.cumsum(self.ids.lengths[word])])
        return self.ids.take(word), ends[bounds[1:]] - ends[bounds[:-1]]


_loaded: dict[str, WordEncoder] = {}


def encoder(vocabulary: str) -> WordEncoder:
    key = hashlib.sha256(vocabulary.encode()).hexdigest()
    if key not in _loaded:
        _loaded[key] = WordEncoder(vocabulary)
    return _loaded[key]


def encoded_slices(
    batches: Iterator[pa.RecordBatch], vocabulary: str, text: int, slice_bytes: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Bounded slices of the batches with the ids of the texts in column
    ``text``, one after the other, and how many each text has."""
    own = encoder(vocabulary)
    for batch in batches:
        for i, j in slices(text_sizes(batch.column(text)), slice_bytes):
            part = batch.slice(i, j - i)
            yield part, *own.encode(part.column(text))
