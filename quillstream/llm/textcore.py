"""Vectorised text helpers that run inside tasks: word spans and rolling hashes over Arrow batches.

Words are runs of bytes other than U+0020 and U+0009..U+000D; since these are ASCII, bytes and characters agree on
the boundaries. Hashes are prefix sums of a random byte value times an odd base's power, modulo 2**64: the hash of
any span is then two look-ups and one multiplication, for bytes in a word and for words in a window alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_RANDOM = np.random.default_rng(20240117).integers(1, 1 << 63, 256, dtype=np.uint64)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls."""
    have = _powers.get(str(base))
    if have is None or len(have) < n:
        size = max(n, 1 << 16, 0 if have is None else 2 * len(have))
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[str(base)] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (multiply and shift, twice)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xCA4BCAA75EC3F625)
    h ^= h >> np.uint64(29)
    return h


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed hash of values[start:end] for each span; values are uint64."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(_BASE, len(values)), out=total[1:])
    return mix((total[ends] - total[starts]) * _power(_INVERSE, len(values) + 1)[starts] + (ends - starts).astype(np.uint64))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if len(column) and column.buffers()[2] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)


def slices(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `most` bytes; a row is never split."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, b
        a = b


class Words:
    """Words of some rows: starts and ends (bytes), row of each word, first word of each row (n rows + 1), hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = data = _LOWER[data] if lower else data
        full = ~_BLANK[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets[(offsets > 0) & (offsets < len(data))]] = True
        before = np.zeros(len(data), bool)
        if len(data):
            before[1:] = full[:-1]
        begin = full & (~before | edge[:-1])
        after = np.zeros(len(data), bool)
        if len(data):
            after[:-1] = full[1:]
        edge[len(data)] = True
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(full & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        return spans_hash(_RANDOM[self.data], self.starts, self.ends)

    def windows(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of each run of k words inside one row."""
        at = np.arange(max(0, len(hashes) - k + 1))
        at = at[self.row[at] == self.row[at + k - 1]] if len(at) else at
        return at, spans_hash(hashes, at, at + k)

    def text(self, i: int) -> str:
        return self.data[self.starts[i] : self.ends[i]].tobytes().decode()


def blocks(batch: pa.RecordBatch, text: str, lower: bool = False, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of slices of a batch's text column."""
    data, offsets = column_bytes(batch.column(batch.schema.get_field_index(text)))
    for a, b in slices(offsets, most):
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[0], starts[0]+1, .., for every range, joined."""
    total = int(lengths.sum())
    out = np.ones(total, np.int64)
    if not total:
        return out
    keep = lengths > 0
    starts, lengths = starts[keep], lengths[keep]
    ends = np.cumsum(lengths)
    out[0] = starts[0]
    out[ends[:-1]] = starts[1:] - (starts[:-1] + lengths[:-1] - 1)
    return np.cumsum(out)


class PieceCache:
    """Ids of word-like chunks by hash, kept by a worker between batches; bounded, and started anew when full.

    encode(list of texts) -> (number of ids of each, all ids). Only chunks not yet seen are encoded. Sorted tables of
    doubling size are merged as they fill, so that a few new chunks do not move all the others.
    """

    def __init__(self, encode, most: int = 1_000_000):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []  # (sorted keys, place of each)
        self.at = np.zeros(0, np.int64)  # start in ids of each place's chunk, then the end
        self.ids = np.zeros(0, np.uint16)
        self.used, self.places = 0, 0

    def _append(self, keys: np.ndarray, n: np.ndarray, flat: np.ndarray) -> None:
        """keys are sorted."""
        for name, new, used in (("ids", flat.astype(np.uint16), self.used), ("at", self.used + np.r_[0, np.cumsum(n)], self.places)):
            own = getattr(self, name)
            if len(own) < used + len(new):
                own = np.concatenate([own[:used], np.zeros(used + len(new), own.dtype)])
                setattr(self, name, own)
            own[used : used + len(new)] = new
        table = keys, np.arange(self.places, self.places + len(keys))
        self.used, self.places = self.used + len(flat), self.places + len(keys)
        while self.tables and len(self.tables[-1][0]) <= 2 * len(table[0]):
            other = self.tables.pop()
            merged = np.concatenate([other[0], table[0]])
            order = np.argsort(merged, kind="stable")
            table = merged[order], np.concatenate([other[1], table[1]])[order]
        self.tables.append(table)

    def _places(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 if it is not held."""
        out = np.full(len(keys), -1)
        for own, place in self.tables:
            left = np.flatnonzero(out < 0)
            at = np.minimum(np.searchsorted(own, keys[left]), len(own) - 1)
            out[left] = np.where(own[at] == keys[left], place[at], -1)
        return out

    def distinct(self, hashes: np.ndarray, text_of=None, encode=None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For the distinct chunks: (hash, number of one chunk that has it, start and length in self.ids); and for each
        chunk the number of its distinct one. text_of(i) is the text of chunk i; or encode(numbers of chunks) gives what
        self.encode gives of their texts."""
        order = np.argsort(hashes)
        held = hashes[order]
        begin = np.r_[True, held[1:] != held[:-1]] if len(held) else np.zeros(0, bool)
        keys, first = held[begin], order[begin]
        inverse = np.empty(len(order), np.int64)
        inverse[order] = np.cumsum(begin) - 1
        return keys, first, *self.of(keys, first, text_of, encode), inverse

    def of(self, keys: np.ndarray, first: np.ndarray, text_of=None, encode=None) -> tuple[np.ndarray, np.ndarray]:
        """Start and length in self.ids of distinct, sorted hashes; first: the number of one chunk that has each."""
        place = self._places(keys)
        new = np.flatnonzero(place < 0)
        if len(new):
            if self.places + len(new) > self.most:
                self._clear()
                new = np.arange(len(keys))
            n, flat = encode(first[new]) if encode else self.encode([text_of(i) for i in first[new].tolist()])
            place[new] = np.arange(self.places, self.places + len(new))
            self._append(keys[new], n, flat)
        return self.at[place], self.at[place + 1] - self.at[place]

    def look_up(self, hashes: np.ndarray, text_of) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length) in self.ids of each chunk and the chunk's number among the distinct ones."""
        _, _, at, n, inverse = self.distinct(hashes, text_of)
        return at[inverse], n[inverse], inverse


def flattened(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, all values) of lists."""
    n = np.fromiter(map(len, found), np.int64, len(found))
    return n, np.fromiter((x for ids in found for x in ids), np.int64, int(n.sum()))
