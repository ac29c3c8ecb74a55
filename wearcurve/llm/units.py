"""Texts cut into words that a tokenizer treats alone, so that each distinct word is worked on once.

Words of some megabytes of text are found, hashed and made distinct by numpy; only distinct ones become objects of
Python. Equal hashes are compared byte by byte. A task remembers at most ``limit`` words between runs of texts, then
starts anew, so its memory does not grow with its input.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from wearcurve.llm.merging import gather

MEMO_UNITS = 400_000
#: Bytes of texts worked on together.
CHUNK_BYTES = 2_000_000
_STEP = 0x9E3779B97F4A7C15


class Memo(dict):
    """Number of a unit; a new unit gets the next number and waits in ``fresh``."""

    def __init__(self):
        super().__init__()
        self.fresh: list = []

    def __missing__(self, unit):
        self[unit] = number = len(self)
        self.fresh.append(unit)
        return number


class Ragged:
    """Values of units, kept once for each distinct unit: ``work`` gives those of new ones, flat, with their numbers."""

    def __init__(self, work: Callable[[list], tuple[np.ndarray, np.ndarray]], limit: int = MEMO_UNITS):
        self.work, self.limit = work, limit
        self.clear()

    def clear(self) -> None:
        self.memo, self.values, self.offsets = Memo(), np.empty(0, np.int32), np.zeros(1, np.int64)

    def numbers(self, units: list) -> np.ndarray:
        return np.fromiter(map(self.memo.__getitem__, units), np.int64, len(units))

    def learn(self) -> None:
        if self.memo.fresh:
            values, sizes = self.work(self.memo.fresh)
            self.memo.fresh = []
            self.offsets = np.concatenate((self.offsets, self.offsets[-1] + np.cumsum(sizes)))
            self.values = np.concatenate((self.values, values))

    def spread(self, numbers: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of numbered units, flat, and how many each run of ``sizes`` units has."""
        self.learn()
        total = np.concatenate(([0], np.cumsum(self.offsets[numbers + 1] - self.offsets[numbers])))
        bounds = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        return gather(self.values, self.offsets, numbers), np.diff(total[bounds])

    def __call__(self, units: list, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.memo) > self.limit:
            self.clear()
        return self.spread(self.numbers(units), np.asarray(sizes, np.int64))

    def of_texts(self, texts: list[bytes], space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the words of each text; ``space`` marks the bytes between words."""
        if len(self.memo) > self.limit:
            self.clear()
        blob, starts, ends, sizes = cut(texts, space)
        first, inverse = distinct(blob, starts, ends)
        heads = [blob[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        return self.spread(self.numbers(heads)[inverse], sizes)


def cut(texts: list[bytes], space: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one string, where its words start and end, and the number of words of each text."""
    gap = bytes([int(np.flatnonzero(space)[0])])
    blob = gap + gap.join(texts) + gap
    blank = space[np.frombuffer(blob, np.uint8)]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, ends = edge[::2], edge[1::2]
    bounds = 1 + np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    return blob, starts, ends, np.diff(np.searchsorted(starts, bounds))


@lru_cache(1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n, back = 1 << bits, pow(_STEP, -1, 1 << 64)
    out = []
    for base in (_STEP, back):
        x = np.full(n, base, np.uint64)
        x[0] = 1
        out.append(np.cumprod(x, dtype=np.uint64))
    return out[0], out[1]


_LETTER = np.random.default_rng(7).integers(0, 1 << 63, 256, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def distinct(blob: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first of each distinct word, and for each word the place of its first in that list."""
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    raw = np.frombuffer(blob, np.uint8)
    up, down = _powers(max(20, int(len(raw) + 1).bit_length()))
    # Hash of a word: sum of its letters' values times rising powers, taken from one running sum.
    run = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_LETTER[raw] * up[: len(raw)], out=run[1:])
    key = (run[ends] - run[starts]) * down[starts]
    sizes = ends - starts
    _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    shift = starts[first][inverse] - starts
    same = (sizes[first][inverse] == sizes).all()
    if same:
        total = int(sizes.sum())
        at = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(total)
        same = bool((raw[at] == raw[at + np.repeat(shift, sizes)]).all())
    if same:
        return first, inverse
    memo = Memo()  # two words share a hash: by the words themselves
    inverse = np.array([memo[blob[a:b]] for a, b in zip(starts.tolist(), ends.tolist())])
    return np.unique(inverse, return_index=True)[1], inverse


def chunks(texts: list[bytes], space: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[list[bytes], list[int]]]:
    """Runs of texts of about ``limit`` bytes with their places; a longer text is cut at spaces into several."""
    run, places, size = [], [], 0
    for place, text in enumerate(texts):
        for part in _parts(text, space, limit):
            if run and size + len(part) > limit:
                yield run, places
                run, places, size = [], [], 0
            run.append(part)
            places.append(place)
            size += len(part)
    if run:
        yield run, places


def _parts(text: bytes, space: np.ndarray, limit: int) -> Iterator[bytes]:
    at = 0
    while len(text) - at > limit:
        blank = np.flatnonzero(space[np.frombuffer(text, np.uint8, limit, at)])
        if not len(blank):  # a word over the limit stays whole
            ahead = np.flatnonzero(space[np.frombuffer(text, np.uint8, -1, at)])
            blank = ahead[:1]
            if not len(blank):
                break
        yield text[at : at + int(blank[-1])]
        at += int(blank[-1]) + 1
    yield text[at:]


def by_text(texts: list[bytes], space: np.ndarray, work, limit: int = CHUNK_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Values of all texts, flat, and the number of each; ``work`` gets runs of texts or of parts of texts."""
    values, sizes = [np.empty(0, np.int32)], np.zeros(len(texts), np.int64)
    for run, places in chunks(texts, space, limit):
        flat, each = work(run)
        values.append(flat)
        np.add.at(sizes, places, each)
    return np.concatenate(values), sizes


def list_array(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Arrow lists of int from flat values."""
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def space_table(bytes_: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(bytes_)] = True
    return table


#: White space between words.
ASCII_SPACE = space_table(b" \t\n\x0b\x0c\r")


#: Rows of a batch worked on together.
SLICE_ROWS = 2_000


def map_texts(batches, text: str, work: Callable[[list[bytes]], list[pa.Array]], names: list[str]):
    """For ``mapInArrow``: each batch without its text column, with what ``work`` gives for the texts (null: empty)."""
    for batch in batches:
        at = batch.schema.names.index(text)
        for begin in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(begin, SLICE_ROWS)
            texts = [t or b"" for t in part.column(at).cast(pa.binary()).to_pylist()]
            rest = [(n, part.column(i)) for i, n in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([c for _, c in rest] + work(texts), names=[n for n, _ in rest] + names)


def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches``; what is free after each goes back to the system, which an idle worker would keep from its executor."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()
        if trim:
            trim(0)


def schema_with(df, text: str, added: str):
    """Schema of ``df`` without its text column, and with the columns of the DDL ``added``."""
    from pyspark.sql import types as T

    fields = [f for f in df.schema.fields if f.name != text]
    return T.StructType(fields + T.StructType.fromDDL(added).fields)
