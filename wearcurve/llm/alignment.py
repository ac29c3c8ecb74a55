"""Alignment of the tokens that two tokenizers give for the same text.

One is a byte-level pair encoding of the tokenizers library (A), the other a SentencePiece model with byte fallback (B).
The libraries' spans, character offsets of A and spans of the proto of pieces of B, are coarse cuts. Inside characters
of several bytes, and where a character falls back to bytes, a span says too little; there the cut is the last sure one
plus the decoded bytes since. Byte offsets where tokens of both end part the text into groups.

Texts are cut into units that both tokenizers treat alone: before a single space or line break between characters that
are surely no white space, and before a point or comma behind a letter. Distinct units are aligned once in a task and remembered, up to a limit. Documents are worked
on in slices of bounded size, and a slice lists each pair of ids once, so corpus-wide counts cost one row for each pair
of a slice and not one for each pair of a document.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearcurve.llm.merging import gather
from wearcurve.llm.units import Memo, distinct
from wearcurve.llm.word_bpe import byte_letters
from wearcurve.llm.work import stage, without

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Units a task remembers; units given to a library as one text; rows and bytes of a slice.
MEMO_UNITS, JOINED, SLICE_ROWS, SLICE_BYTES = 200_000, 4_000, 2_000, 1_500_000
MARK = "▁"
#: White space and separators of ASCII, and the first bytes of characters that may be white space or a mark in some table.
_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), *range(28, 33)]] = True
_LEAD = np.zeros(256, bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


class Pair:
    """Both tokenizers, with the bytes of each id."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        kind = spec["pre_tokenizer"] or {}
        if spec["model"]["type"] != "BPE" or kind.get("type") != "ByteLevel" or spec["normalizer"] or kind.get("add_prefix_space"):
            raise ValueError(f"{a_path}: not a plain byte-level pair encoding")
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        of = {c: b for b, c in enumerate(byte_letters())}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in spec["model"]["vocab"].items():
            self.a_bytes[i] = bytes(map(of.__getitem__, token))
        self.b = SentencePieceProcessor(model_file=b_path)
        self.n_b = self.b.get_piece_size()
        self.b_bytes = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()
            for i, p in enumerate(map(self.b.id_to_piece, range(self.n_b)))
        ]
        # A never joins a letter and a point; B does not if no piece of it holds both.
        self.points = not any(re.search(r"[A-Za-z][.,]", self.b.id_to_piece(i)) for i in range(self.n_b))
        self.names = list(map(str, range(max(self.n_b, len(self.a_bytes)))))
        self.a_size, self.b_size = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes))

    def of_a(self, text: str, byte_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a text and the byte offsets where their tokens end."""
        got = self.a.encode(text, add_special_tokens=False)
        spans = np.array(got.offsets, np.int64).reshape(-1, 2)
        ids = np.array(got.ids, np.int64)
        return ids, _refined(byte_at[spans[:, 0]], byte_at[spans[:, 1]], self.a_size[ids])

    def of_b(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The same of B, whose text is that of A without its first space and whose spans count bytes."""
        pieces = self.b.encode(text[1:], return_type="proto").pieces
        rows = np.array([(p.id, p.begin, p.end) for p in pieces], np.int64).reshape(-1, 3)
        ids, begin, end = rows[:, 0], rows[:, 1] + 1, rows[:, 2] + 1
        begin[:1] = 0  # the space that B adds
        return ids, _refined(begin, end, self.b_size[ids])

    def cuts(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool]:
        """Ids and ends of both for a text that starts with a space, and whether both give the text back."""
        raw = text.encode()
        byte_at = np.concatenate(([0], np.cumsum(_widths(text))))
        a, a_end = self.of_a(text, byte_at)
        b, b_end = self.of_b(text)
        whole = b"".join(map(self.a_bytes.__getitem__, a.tolist())) == raw
        whole = whole and b"".join(map(self.b_bytes.__getitem__, b.tolist())) == raw
        return a, a_end, b, b_end, whole


def _widths(text: str) -> np.ndarray:
    """Bytes of each character in UTF-8."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)


def _refined(begin: np.ndarray, end: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Byte offsets of the ends of tokens from their spans, where those agree with the decoded bytes, else from these."""
    sure = end - begin == size
    total = np.cumsum(size)
    # Decoded bytes up to the last token whose span is sure, and where that one ends.
    last = np.maximum.accumulate(np.where(sure, np.arange(len(size)), -1))
    known, base = np.where(last >= 0, end[last], 0), np.where(last >= 0, total[last], 0)
    return np.where(sure, end, known + total - base)


def unit_starts(blob: np.ndarray, points: bool) -> np.ndarray:
    """Offsets in a text where a unit starts, apart from its first byte.

    That is at a space or line break that stands alone and, with ``points``, at a point or comma behind a letter.
    """
    blank = _BLANK[blob]
    may = blank | _LEAD[blob]  # as a next character
    wide = blob >= 0x80
    was = blank.copy()  # as a previous character, by its last byte
    was[1:] |= wide[1:] & (blob[:-1] == 0xC2)
    was[2:] |= wide[2:] & _LEAD[blob[:-2]]
    starts = ((blob[1:-1] == 0x20) | (blob[1:-1] == 0x0A)) & ~was[:-2] & ~may[2:]
    if points:
        starts |= ((blob[1:-1] == 0x2E) | (blob[1:-1] == 0x2C)) & _LETTER[blob[:-2]]
    return np.flatnonzero(starts) + 1


class Aligner:
    """Alignments of texts, from those of their distinct units.

    For each unit: the number of tokens of A and of B, of groups, the groups as text, and a key ``a * n_b + b`` for each
    link. A unit that a tokenizer does not give back has no text of groups.
    """

    def __init__(self, pair: Pair, limit: int = MEMO_UNITS):
        self.pair, self.limit = pair, limit
        self.clear()

    def clear(self) -> None:
        self.memo = Memo()
        self.texts: list[str | None] = []
        self.sizes = np.empty((0, 3), np.int64)
        self.links, self.offsets = np.empty(0, np.int64), np.zeros(1, np.int64)

    def learn(self, odd: np.ndarray) -> None:
        """Align the units that wait; ``odd`` marks those that may hold white space or marks inside."""
        fresh, self.memo.fresh = self.memo.fresh, []
        if not fresh:
            return
        parts = []
        alone = [i for i in np.flatnonzero(odd).tolist()] + [len(fresh)]
        begin = 0
        for stop in alone:
            for i in range(begin, stop, JOINED):
                # A unit of its own in front gives the first one the neighbour it may need.
                parts.append(self.align([b" x", *fresh[i : min(i + JOINED, stop)]], 1))
            if stop < len(fresh):
                first = fresh[stop][:1] == b" "
                parts.append(self.align([fresh[stop]], 0) if first else self.align([b" x", fresh[stop]], 1))
            begin = stop + 1
        texts, sizes, links, counts = zip(*parts)
        self.texts += [t for part in texts for t in part]
        self.sizes = np.concatenate([self.sizes, *sizes])
        self.links = np.concatenate([self.links, *links])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(np.concatenate(counts))])

    def align(self, units: list[bytes], skip: int):
        """Texts of groups, sizes, links and numbers of links of ``units`` less the first ``skip``, read as one text."""
        raw = b"".join(units)
        a, a_end, b, b_end, whole = self.pair.cuts(raw.decode())
        n = len(units) - skip
        if not whole:
            if n > 1:
                raise ValueError("a tokenizer does not give back text without marks of its own")
            return [None], np.zeros((1, 3), np.int64), np.empty(0, np.int64), np.zeros(1, np.int64)
        is_end = np.zeros((2, len(raw) + 1), bool)
        is_end[0, a_end], is_end[1, b_end] = True, True
        is_both = is_end.all(axis=0)
        bounds = np.cumsum([len(u) for u in units])
        if not is_both[bounds].all():
            raise ValueError("a token reaches over the edge of a unit")
        # The first token of each side that ends at or after each cut, and one more.
        both = np.flatnonzero(is_both)
        a_stop, b_stop = np.searchsorted(a_end, both) + 1, np.searchsorted(b_end, both) + 1
        in_a, in_b = np.diff(a_stop, prepend=0), np.diff(b_stop, prepend=0)
        owner = np.searchsorted(bounds, both) - skip
        # Every A token of a group with every B token of it, group after group.
        times = np.repeat(in_b, in_a)
        each = np.repeat(np.arange(len(a)), times)
        inner = np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)
        links = a[each] * self.pair.n_b + b[np.repeat(np.repeat(b_stop - in_b, in_a), times) + inner]
        n_links = in_a * in_b
        first = int(np.searchsorted(owner, 0))
        edge = np.searchsorted(owner, np.arange(n + 1))
        sums = [np.concatenate(([0], np.cumsum(x))) for x in (in_a, in_b, np.ones(len(both), np.int64), n_links)]
        sizes = np.stack([x[edge[1:]] - x[edge[:-1]] for x in sums], axis=1)
        names = self.pair.names
        a_text, b_text = [names[i] for i in a.tolist()], [names[i] for i in b.tolist()]
        # Most groups are of one token each.
        groups = [
            f"{a_text[p - 1]}|{b_text[q - 1]}" if m == 1 else f"{','.join(a_text[p - i : p])}|{','.join(b_text[q - j : q])}"
            for p, q, i, j, m in zip(a_stop.tolist(), b_stop.tolist(), in_a.tolist(), in_b.tolist(), n_links.tolist())
        ]
        texts = [";".join(groups[i:j]) for i, j in zip(edge[:-1].tolist(), edge[1:].tolist())]
        return texts, sizes[:, :3], links[int(sums[3][first]) :], sizes[:, 3]

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """For each text: tokens of A, of B and groups; its groups as text; all its links, flat, and their numbers.

        A text that a tokenizer does not give back, like an empty one, has zeros and the empty text.
        """
        if len(self.memo) > self.limit:
            self.clear()
        # White space between the texts, so that their ends are never inside a unit.
        blob = b"".join(b" " + t + b"\n\n" for t in texts)
        sizes = np.fromiter((len(t) + 3 for t in texts), np.int64, len(texts))
        stops = np.cumsum(sizes)
        raw = np.frombuffer(blob, np.uint8)
        starts = np.union1d(unit_starts(raw, self.pair.points), stops - sizes) if len(texts) else np.empty(0, np.int64)
        text_of = np.searchsorted(stops, starts, side="right")
        ends = np.minimum(np.append(starts[1:], len(blob)), stops[text_of] - 2)
        first, inverse = distinct(blob, starts, ends)
        heads = [blob[i:j] for i, j in zip(starts[first].tolist(), ends[first].tolist())]
        known = len(self.memo)
        numbers = np.fromiter(map(self.memo.__getitem__, heads), np.int64, len(heads))
        unsure = np.concatenate(([0], np.cumsum(_BLANK[raw] | _LEAD[raw])))
        i, j = starts[first][numbers >= known], ends[first][numbers >= known]
        lone = (raw[i] != 0x20) & (raw[i] != 0x0A)
        self.learn((unsure[j] > unsure[np.minimum(i + 1, j)]) | (j - i < 2) | lone)
        numbers = numbers[inverse]
        bounds = np.searchsorted(text_of, np.arange(len(texts) + 1)).tolist()
        found = list(map(self.texts.__getitem__, numbers.tolist()))
        out = ["" if sizes[i] == 3 or None in (u := found[p:q]) else ";".join(u) for i, (p, q) in enumerate(zip(bounds, bounds[1:]))]
        holds = np.fromiter(map(bool, out), bool, len(out))
        numbers, text_of = numbers[holds[text_of]], text_of[holds[text_of]]
        counts = np.stack([
            np.bincount(text_of, weights=self.sizes[numbers, c], minlength=len(texts)) for c in range(3)
        ], axis=1).astype(np.int64)
        n_links = self.offsets[numbers + 1] - self.offsets[numbers]
        return counts, out, gather(self.links, self.offsets, numbers), np.bincount(text_of, weights=n_links, minlength=len(texts)).astype(np.int64)


@lru_cache(1)
def aligner(a_path: str, b_path: str, limit: int = MEMO_UNITS) -> Aligner:
    return Aligner(Pair(a_path, b_path), limit)


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def _slices(df: DataFrame, text: str, a_path: str, b_path: str, digest: bool) -> DataFrame:
    """One row for each slice of documents.

    ``rows``: the documents' other columns with their counts and groups; ``pairs``: the distinct linked pairs of ids;
    ``held``: how many documents of the slice hold each; ``at``, ``many``: for each document the places of its pairs
    in that list and how often it links them; ``each``: how many these are.
    """
    rest = [f for f in df.schema.fields if f.name != text]
    inner = T.StructType(rest + T.StructType.fromDDL("n_a long, n_b long, n_groups long, n_links long, `groups` string").fields)
    schema = T.StructType(
        [T.StructField("slice", T.LongType()), T.StructField("rows", T.ArrayType(inner))]
        + T.StructType.fromDDL("pairs array<long>, held array<int>, at array<int>, many array<int>, each array<int>").fields
    )

    def row(number: int, part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        counts, groups, links, sizes = aligner(a_path, b_path)(texts)
        if digest:
            groups = [sha256(g.encode()).hexdigest() if g else "" for g in groups]
        pairs, place = np.unique(links, return_inverse=True)
        owner = np.repeat(np.arange(len(texts)), sizes)
        both, many = np.unique(owner * max(1, len(pairs)) + place, return_counts=True)
        own, at = both // max(1, len(pairs)), both % max(1, len(pairs))
        at_text = part.schema.names.index(text)
        columns = [c for i, c in enumerate(part.columns) if i != at_text]
        values = [pa.array(counts[:, i]) for i in range(3)] + [pa.array(sizes), pa.array(groups, pa.string())]
        names = [f.name for f in rest] + _COUNTS + ["groups"]
        rows = pa.StructArray.from_arrays(columns + values, names=names)
        held = np.bincount(at, minlength=len(pairs))
        each = np.bincount(own, minlength=len(texts))
        lists = [pairs, *(x.astype(np.int32) for x in (held, at, many, each))]
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x if isinstance(x, pa.Array) else pa.array(x))
        return pa.RecordBatch.from_arrays([pa.array([number]), one(rows), *map(one, lists)], names=schema.names)

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            column = batch.column(batch.schema.names.index(text)).cast(pa.binary())
            sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
            begin = 0
            while begin < batch.num_rows:
                end, size = begin + 1, int(sizes[begin])
                while end < batch.num_rows and end - begin < SLICE_ROWS and size + sizes[end] <= SLICE_BYTES:
                    size += int(sizes[end])
                    end += 1
                part = batch.slice(begin, end - begin)
                texts = [t or b"" for t in column.slice(begin, end - begin).to_pylist()]
                yield row(number, part, texts)
                number, begin = number + 1, end

    return df.mapInArrow(run, schema)


def align(docs: DataFrame, a_path: str, b_path: str, *, text: str = "text", digest: bool = False) -> DataFrame:
    """``docs`` without its text, with the alignment of its tokens and how usual its links are in the whole table.

    ``n_a``, ``n_b``: tokens of a space and the text by A, and of the text by B, which adds that space. ``n_groups`` and
    ``groups`` (``a1,a2|b1;a3|b2``): stretches between the byte offsets where tokens of both end. ``n_links``: pairs of
    an A and a B token of one group. An id pair counts the documents that link it; ``count_sum`` adds these counts up
    over all links, and ``n_best`` counts the links whose count is the highest of their A id, ties included.

    Null and empty texts, and those that one of the tokenizers does not give back byte by byte, such as texts with the
    mark that B writes for a space, have zeros and the empty text, and link nothing. Special tokens' strings are plain
    text. Each row stands for itself and counts as one document, repeated rows too; null keys stay null, an empty table
    stays empty, columns named as the outputs are replaced. The slices are written once. With ``digest`` the column
    ``groups`` holds the SHA-256 of the groups in their place, which is much less to move.
    """
    docs = without(docs, *_COUNTS, "groups", "n_best", "count_sum")
    sliced = stage(_slices(docs, text, a_path, b_path, digest), "slices")
    n_b = aligner(a_path, b_path).pair.n_b
    entries = sliced.select("slice", F.posexplode(F.arrays_zip("pairs", "held")).alias("place", "x"))
    counts = entries.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.held").alias("n"))
    counts = counts.withColumn("a", F.floor(F.col("pair") / n_b))
    # An A id has at most as many pairs as B has ids.
    best = counts.groupBy("a").agg(F.max("n").alias("most"))
    known = counts.join(best, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    told = (
        entries.select("slice", "place", F.col("x.pairs").alias("pair"))
        .join(known, "pair")
        .groupBy("slice")
        .agg(F.sort_array(F.collect_list(F.struct("place", "n", "best"))).alias("told"))
    )
    told = told.select("slice", F.col("told.n").alias("counts"), F.col("told.best").alias("is_best"))
    inner = sliced.schema["rows"].dataType.elementType
    schema = T.StructType(inner.fields + T.StructType.fromDDL("n_best long, count_sum long").fields)

    def run(batches):
        for batch in batches:
            column = dict(zip(batch.schema.names, batch.columns))
            for i in range(batch.num_rows):
                rows, at, many, each, counts, is_best = (
                    column[c][i].values for c in ("rows", "at", "many", "each", "counts", "is_best")
                )
                at, many, each = (np.asarray(x, np.int64) for x in (at, many, each))
                owner = np.repeat(np.arange(len(each)), each)
                if counts is None:
                    n_best, total = np.zeros(len(each), np.int64), np.zeros(len(each), np.int64)
                else:
                    n = np.asarray(counts, np.int64)[at] * many
                    hit = np.asarray(is_best.cast(pa.int8()), np.int64)[at] * many
                    total, n_best = (_sums(owner, x, len(each)) for x in (n, hit))
                yield pa.RecordBatch.from_arrays([*rows.flatten(), pa.array(n_best), pa.array(total)], names=schema.names)

    joined = sliced.select("slice", "rows", "at", "many", "each").join(told, "slice", "left")
    return joined.drop("slice").mapInArrow(run, schema)


def _sums(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Whole-number sums by owner; owners ascend."""
    total = np.concatenate(([0], np.cumsum(values)))
    edge = np.searchsorted(owner, np.arange(n + 1))
    return total[edge[1:]] - total[edge[:-1]]


def report(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Counts of the alignment and a digest of its groups, for each document."""
    found = align(docs.select("doc_id", "text"), a_path, b_path, digest=True)
    return found.select("doc_id", *_COUNTS, "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
