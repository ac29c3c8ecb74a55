"""Near copies by 64-bit fingerprints of word shingles, compared exactly in tiles.

Fingerprints that differ in few bits have bytes of near-equal population counts. The eight counts of a fingerprint
(one a byte) name its cell, in bands of four; a fingerprint also visits the cells that one within the radius could lie
in, always of a larger number, so each pair meets in one cell. A cell is sorted by population counts and cut into
tiles; a pair of tiles whose counts differ beyond the radius is skipped, the others are compared by exclusive-or and
bit counts. Only distinct fingerprints are compared, so copies cost nothing.

About one pair in a thousand survives the tiles of random fingerprints, and each visits about 20 cells at 8 bytes. Cells
are counted first where one may be too large for a task: its own fingerprints are split into parts and its guests into
blocks, and each part meets each block in a task of its own. Up to a hundred million fingerprints few cells need that.
The comparisons still grow with the square of the distinct fingerprints; the exact method has no way around this.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearcurve.llm.components import components
from wearcurve.llm.units import map_texts, schema_with
from wearcurve.llm.work import stage, without

WORDS = 3
RADIUS = 3
BAND = 4
CELLS = 3**8
TILE = 128
#: Words of a text that are hashed together.
BLOCK_WORDS = 100_000
#: Fingerprints of a cell, and guests of it, that one task should hold; larger cells are split.
CELL_ROWS = 2_000_000


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Majority bits of the XXH64 hashes of all shingles of lower-cased words; 0 without words."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        return xxhash.xxh64_intdigest(b" ".join(tokens), 42)
    total, counts = len(tokens) - words + 1, np.zeros(64, np.int64)
    for begin in range(0, total, BLOCK_WORDS):
        part = tokens[begin : begin + BLOCK_WORDS + words - 1]
        shingles = map(b" ".join, zip(*[part[k:] for k in range(words)]))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), "<u8", len(part) - words + 1)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int32)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, text: str = "text", out: str = "fp", words: int = WORDS) -> DataFrame:
    """``docs`` without its text, with the fingerprint of the whole text as a signed long; null texts have 0."""
    docs = without(docs, out)

    def work(texts: list[bytes]) -> list[pa.Array]:
        return [pa.array(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64))]

    return docs.mapInArrow(
        lambda batches: map_texts(batches, text, work, [out]), schema_with(docs, text, f"`{out}` long")
    )


def _counts(prints: np.ndarray) -> np.ndarray:
    return np.bitwise_count(prints.view(np.uint8).reshape(-1, 8)).astype(np.int16)


def _cells(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Home cell of each print; cell and place in ``prints`` of every visit as a guest."""
    counts = _counts(prints)
    band, within = counts // BAND, counts % BAND
    weight = 3 ** np.arange(8)
    home = band @ weight
    cost = {1: np.where(band < 2, BAND - within, 99), -1: np.where(band > 0, within + 1, 99)}
    none = np.empty(0, np.int64)
    where, cells = [none], [none]
    for n in range(1, radius + 1):
        for dims in combinations(range(8), n):
            for moves in product((1, -1), repeat=n):
                step = sum(m * weight[d] for d, m in zip(dims, moves))
                if step > 0:
                    near = np.flatnonzero(sum(cost[m][:, d] for d, m in zip(dims, moves)) <= radius)
                    where.append(near)
                    cells.append(home[near] + step)
    return home, np.concatenate(cells), np.concatenate(where)


def cell_sizes(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of ``prints`` each cell holds at home and as guests."""
    home, cells, _ = _cells(prints, radius)
    return np.bincount(home, minlength=CELLS), np.bincount(cells, minlength=CELLS)


def split_cells(at_home: np.ndarray, guests: np.ndarray, cell_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Parts of a cell's own prints, and blocks of its guests, of ``cell_rows`` each; every part meets every block."""
    parts = 1 + at_home // cell_rows
    return parts, 1 + (guests + np.where(parts > 1, at_home, 0)) // cell_rows


def visits(prints: np.ndarray, radius: int, parts: np.ndarray, blocks: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Cell, part, block, whether at home, and place in ``prints`` of every visit; one item a part.

    At home a print goes to all blocks of its part; as a guest to its block of all parts of the cell it visits, and of
    the later parts of its own cell.
    """
    home, cells, guests = _cells(prints, radius)
    part = (prints * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % parts[home]
    spread = (prints * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(33)).astype(np.int64)
    for s in range(int(parts.max())):
        mine = np.flatnonzero(part == s)
        times = blocks[home[mine]]
        block = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        mine = np.repeat(mine, times)
        later = np.flatnonzero((part < s) & (parts[home] > s))
        here = parts[cells] > s
        place = np.concatenate([later, guests[here]])
        cell = np.concatenate([home[later], cells[here]])
        yield (
            np.concatenate([home[mine], cell]),
            np.full(len(mine) + len(cell), s),
            np.concatenate([block, spread[place] % blocks[cell]]),
            np.arange(len(mine) + len(cell)) < len(mine),
            np.concatenate([mine, place]),
        )


def pairs_in_cell(
    home: np.ndarray, guests: np.ndarray, radius: int, tile: int = TILE, inner: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within ``radius`` bits: of two at home, if ``inner``, and of one at home with a guest."""

    def tiles(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        counts = _counts(prints)
        order = np.lexsort(counts.T[::-1])
        prints, counts = prints[order], counts[order]
        starts = np.arange(0, len(prints), tile)
        if not len(starts):
            return prints, np.empty((0, 8)), np.empty((0, 8))
        return prints, np.minimum.reduceat(counts, starts), np.maximum.reduceat(counts, starts)

    home, low, high = tiles(home)
    guests, guest_low, guest_high = tiles(guests)
    left, right = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    for t in range(len(low)):
        mine = home[t * tile : (t + 1) * tile]
        for other, lo, hi, first in ((home, low, high, t if inner else len(low)), (guests, guest_low, guest_high, 0)):
            apart = np.maximum(0, np.maximum(lo[first:] - high[t], low[t] - hi[first:])).sum(1)
            for k in first + np.flatnonzero(apart <= radius):
                theirs = other[k * tile : (k + 1) * tile]
                x, y = np.nonzero(np.bitwise_count(mine[:, None] ^ theirs[None, :]) <= radius)
                if other is home and k == t:
                    x, y = x[x < y], y[x < y]
                left.append(mine[x])
                right.append(theirs[y])
    return np.concatenate(left), np.concatenate(right)


def near_prints(distinct: DataFrame, radius: int = RADIUS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct fingerprints (column ``fp``) that differ in at most ``radius`` bits."""
    if not 0 <= radius <= BAND:
        raise ValueError(f"the radius is from 0 to {BAND}")
    distinct = distinct.select("fp")
    at_home = guests = np.zeros(CELLS, np.int64)
    if distinct.count() > cell_rows:  # fewer cannot fill a cell
        at_home, guests = _count_cells(distinct, radius)
    parts, blocks = split_cells(at_home, guests, cell_rows)

    def deal(batches):
        for prints in _prints(batches):
            for cell, part, block, home, place in visits(prints, radius, parts, blocks):
                columns = [pa.array(x.astype(np.int32)) for x in (cell, part, block)]
                columns += [pa.array(home), pa.array(prints[place].view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["cell", "part", "block", "home", "fp"])

    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        prints, home = frame["fp"].to_numpy().view(np.uint64), frame["home"].to_numpy()
        a, b = pairs_in_cell(prints[home], prints[~home], radius, inner=key[2] == 0)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = distinct.mapInArrow(deal, "cell int, part int, block int, home boolean, fp long")
    return dealt.groupBy("cell", "part", "block").applyInPandas(compare, "a long, b long")


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for begin in range(0, batch.num_rows, 20_000):
            yield batch.slice(begin, 20_000).column(0).to_numpy().view(np.uint64)


def _count_cells(distinct: DataFrame, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """``cell_sizes`` of the whole table; the driver sees one row a cell, at most ``CELLS``."""

    def count(batches):
        at_home = guests = np.zeros(CELLS, np.int64)
        for prints in _prints(batches):
            own, visiting = cell_sizes(prints, radius)
            at_home, guests = at_home + own, guests + visiting
        names = ["cell", "at_home", "guests"]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CELLS)), pa.array(at_home), pa.array(guests)], names=names)

    sizes = distinct.mapInArrow(count, "cell long, at_home long, guests long")
    totals = sizes.groupBy("cell").agg(F.sum("at_home").alias("at_home"), F.sum("guests").alias("guests"))
    found = np.zeros((2, CELLS), np.int64)
    for row in totals.collect():
        found[:, row["cell"]] = row["at_home"], row["guests"]
    return found[0], found[1]


def _labelled(groups: DataFrame, radius: int) -> DataFrame:
    """``groups`` of one row a fingerprint, with the ``component`` of each."""
    linked = components(near_prints(groups, radius)).withColumnRenamed("node", "fp")
    return groups.join(linked, "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def classes(docs: DataFrame, *, radius: int = RADIUS, words: int = WORDS) -> DataFrame:
    """Each document's fingerprint, of shingles of ``words`` words, and the smallest ``doc_id`` reachable by links of
    fingerprints that differ in at most ``radius`` bits.

    Texts without words have fingerprint zero and link like any other. One row comes back for each row that goes in;
    a null ``doc_id`` is nobody's smallest, and a class of nulls alone has a null ``component_id``.
    """
    prints = stage(fingerprints(docs.select("doc_id", "text"), words=words), "prints")
    groups = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "groups")
    labelled = _labelled(groups, radius)
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = labelled.select("fp", "component").join(least, "component").select("fp", "component_id")
    return prints.join(ids, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, *, radius: int = RADIUS, words: int = WORDS) -> DataFrame:
    """Exactly one row of each class of near copies: of the smallest ``doc_id``, nulls last, then of the smallest digest
    of the whole row.

    Rows that repeat a ``doc_id`` with unlike texts are of unlike classes, and each class keeps its own. An empty table
    stays empty; texts without words, null ones too, are one class.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    named = docs.select(F.col("doc_id").alias("of_id"), row.alias("of_row"), F.col("text").alias("text"))
    prints = stage(fingerprints(named, words=words), "prints")
    first = F.min(F.struct(F.col("of_id").isNull().alias("unnamed"), "of_id", "of_row")).alias("first")
    # One row a fingerprint before classes are known, so that a group of copies is small when it moves.
    firsts = stage(prints.groupBy("fp").agg(first), "firsts")
    kept = _labelled(firsts, radius).groupBy("component").agg(F.min("first").alias("first"))
    kept = kept.select("first.of_id", "first.of_row")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), row.alias("digest"))
    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("digest") == F.col("of_row"))
    one = whole.join(kept, same, "left_semi").groupBy("id", "digest").agg(F.first("row").alias("row"))
    return one.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
