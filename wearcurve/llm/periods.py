"""Periodic runs of words: maximal stretches that repeat a shortest period, found by block convolution.

At scale B a text is cut into blocks of B words. The squared differences between a block and every place of the window
that follows it are one convolution, computed for all blocks of a scale together by a number-theoretic transform on
integers. Places without a difference are the block's occurrences; each of their distances is a period's seed, which is
extended to both sides. A run of period q and length at least ``max(12, 2 q)`` holds a whole block of the scale that
looks at distance q, so none is missed:

    B = 2 looks at distance 6, B = 4 at 1 to 14, B = 8, 16, ... at 2 B - 1 to 4 B - 2.

Sums are exact modulo a prime, so a seed is compared word by word before it counts. A block is transformed only if each
of its words comes again within reach, and not if its whole window lies in a run of a shorter period, which explains
every distance there.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearcurve.llm.units import schema_with
from wearcurve.llm.work import without, words

MIN_WORDS = 12
#: Order of the field: 15 * 2**27 + 1, with 31 as a generator, so transforms of up to 2**27 numbers exist.
PRIME, GENERATOR = 2013265921, 31
#: Numbers transformed together.
TOGETHER = 1 << 17
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


@lru_cache(64)
def _roots(half: int, back: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of a root of unity of order ``2 * half``, and each times 2**32 / PRIME for a product without division."""
    root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
    if back:
        root = pow(root, -1, PRIME)
    powers = np.ones(1, np.uint64)
    while len(powers) < half:
        powers = np.concatenate((powers, powers * np.uint64(pow(root, len(powers), PRIME)) % np.uint64(PRIME)))
    powers = powers[:half]
    return powers.astype(np.uint32), (powers << np.uint64(32)) // np.uint64(PRIME), powers


_P32, _P64, _32 = np.uint32(PRIME), np.uint64(PRIME), np.uint64(32)


def _times(x: np.ndarray, half: int, back: bool) -> np.ndarray:
    """``x`` times the powers of the root, reduced."""
    powers, scaled, _ = _roots(half, back)
    whole = ((x.astype(np.uint64) * scaled) >> _32).astype(np.uint32)
    left = x * powers - whole * _P32
    return np.minimum(left, left - _P32)


def _forward(x: np.ndarray) -> np.ndarray:
    """Transform of each row, in bit-reversed order."""
    rows, n = x.shape
    half = n // 2
    while half:
        pairs = x.reshape(rows, -1, 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        total, less = a + b, a - b
        less = np.minimum(less, less + _P32)
        out = np.empty_like(pairs)
        out[:, :, 0] = np.minimum(total, total - _P32)
        out[:, :, 1] = _times(less, half, False) if half > 1 else less
        x, half = out.reshape(rows, n), half // 2
    return x


def _backward(x: np.ndarray) -> np.ndarray:
    """Rows from their transforms in bit-reversed order."""
    rows, n = x.shape
    half = 1
    while half < n:
        pairs = x.reshape(rows, -1, 2, half)
        a = pairs[:, :, 0]
        b = _times(pairs[:, :, 1], half, True) if half > 1 else pairs[:, :, 1]
        total, less = a + b, a - b
        out = np.empty_like(pairs)
        out[:, :, 0] = np.minimum(total, total - _P32)
        out[:, :, 1] = np.minimum(less, less + _P32)
        x, half = out.reshape(rows, n), 2 * half
    return (x.astype(np.uint64) * np.uint64(pow(n, -1, PRIME)) % _P64).astype(np.uint32)


def occurrences(ids: np.ndarray, at: np.ndarray, size: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks ``ids[s:s + size]`` for ``s`` in ``at`` that recur ``low`` to ``high`` words later: places and distances.

    ``ids`` are small non-negative integers.
    """
    reach = high - low + size
    width = 1 << (reach + size - 2).bit_length()
    # Behind the end stands a number that no block holds.
    padded = np.concatenate((ids, np.full(high + size, ids.max() + 1))).astype(np.uint32)
    squares = np.concatenate(([0], np.cumsum(padded.astype(np.uint64) ** np.uint64(2) % _P64, dtype=np.uint64)))
    found = []
    step = max(1, TOGETHER // width)
    for begin in range(0, len(at), step):
        s = at[begin : begin + step]
        block = np.zeros((len(s), width), np.uint32)
        window = np.zeros((len(s), width), np.uint32)
        block[:, :size] = padded[s[:, None] + np.arange(size - 1, -1, -1)]
        window[:, :reach] = padded[s[:, None] + np.arange(low, low + reach)]
        product = (_forward(block).astype(np.uint64) * _forward(window) % _P64).astype(np.uint32)
        both = _backward(product)[:, size - 1 : reach].astype(np.uint64)
        distances = np.arange(low, high + 1)
        there = s[:, None] + distances
        apart = (squares[s + size] - squares[s])[:, None] + squares[there + size] - squares[there]
        row, column = np.nonzero((apart + _P64 * np.uint64(2) - np.uint64(2) * both) % _P64 == 0)
        found.append((s[row], distances[column]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([s for s, _ in found]), np.concatenate([d for _, d in found])


def _first_other(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading values of two arrays agree."""
    n, done, step = min(len(a), len(b)), 0, 64
    while done < n:
        other = a[done : min(done + step, n)] != b[done : min(done + step, n)]
        k = int(other.argmax())
        if other[k]:
            return done + k
        done, step = done + len(other), step * 2
    return n


def _extend(ids: np.ndarray, s: int, d: int, size: int) -> tuple[int, int] | None:
    """Start and end of the longest stretch of period ``d`` around a seed; None if the seed does not hold."""
    if _first_other(ids[s : s + size], ids[s + d : s + d + size]) < size:
        return None
    ahead = _first_other(ids[s + size :], ids[s + size + d :])
    back = _first_other(ids[:s][::-1], ids[d : s + d][::-1])
    return s - back, s + size + d + ahead


def _scales(n: int) -> Iterator[tuple[int, int, int]]:
    """Size of the blocks, and the smallest and largest distance looked at."""
    if n >= MIN_WORDS:
        yield 2, 6, 6
        yield 4, 1, 14
        size = 8
        while 2 * (2 * size - 1) <= n:
            yield size, 2 * size - 1, 4 * size - 2
            size *= 2


def runs(ids: np.ndarray) -> np.ndarray:
    """All runs of a sequence of small integers as rows ``start, length, period``, by start, then period.

    A run is a stretch with smallest period q and length at least ``max(12, 2 q)`` that cannot be made longer.
    """
    n = len(ids)
    spans: dict[tuple[int, int], int] = {}
    if n < MIN_WORDS:
        return np.empty((0, 3), np.int64)
    order = np.argsort(ids, kind="stable")
    ahead = np.full(n, n, np.int64)
    again = ids[order[1:]] == ids[order[:-1]]
    ahead[order[:-1][again]] = np.diff(order)[again]
    # Farthest next occurrence of a word of each block, from that of the two halves.
    farthest, size = ahead, 1
    for scale, low, high in _scales(n):
        while size < scale:
            farthest = np.maximum(farthest[: len(farthest) // 2 * 2 : 2], farthest[1::2])
            size *= 2
        near = farthest <= high
        near[(n - low) // size :] = False
        if not near.any():
            continue
        wide = [(a, b, q) for (a, b), q in spans.items() if b - a >= low + size]
        for a, b, q in wide:
            if q <= size:
                near[-(-a // size) : max(0, (b - high - size) // size + 1)] = False
        s, d = occurrences(ids, np.flatnonzero(near) * size, size, low, high)
        for a, b, q in wide:
            s, d = (x[(s < a) | (s + d + size > b) | (d % q > 0)] for x in (s, d))
        if not len(s):
            continue
        order = np.lexsort((s, d))
        last, upto = -1, -1
        for place, apart in zip(s[order].tolist(), d[order].tolist()):
            # A stretch of this distance that was just found holds the seed.
            if apart == last and place + apart + size <= upto:
                continue
            span = _extend(ids, place, apart, size)
            if span is None:
                continue
            last, upto = apart, span[1]
            if span[1] - span[0] >= max(MIN_WORDS, 2 * apart):
                # A multiple of the smallest period spans the same words.
                spans[span] = min(apart, spans.get(span, apart))
    found = sorted((a, q, b - a) for (a, b), q in spans.items())
    return np.array([(a, length, q) for a, q, length in found], np.int64).reshape(-1, 3)


def repeated(n: int, found: np.ndarray) -> np.ndarray:
    """Which of ``n`` words some run holds after its first period."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, found[:, 0] + found[:, 2], 1)
    np.add.at(marks, found[:, 0] + found[:, 1], -1)
    return np.cumsum(marks[:n]) > 0


def find_runs(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_words``, its ``runs`` and its ``collapsed`` text.

    ``runs`` holds every run of words as ``start, length, period``, by start, then period; ``collapsed`` joins by single
    spaces the words that no run holds after its first period. Null, empty and blank texts have no words, no runs and
    collapse to the empty text. Texts are worked on whole, one at a time, in memory that grows with one text. Rows stand
    for themselves: repeated rows get equal results, null keys stay null, an empty table stays empty, and columns named
    as the outputs are replaced.
    """
    names = ["n_words", "runs", "collapsed"]
    docs = without(docs, *names)
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for batch in batches:
            at = batch.schema.names.index(text)
            rest = [(name, batch.column(i)) for i, name in enumerate(batch.schema.names) if i != at]
            sizes, rows, kept = [], [], []
            for value in batch.column(at).cast(pa.binary()):
                # Splitting bytes parts them at the six white space characters of ASCII.
                tokens = (value.as_py() or b"").split()
                number = defaultdict(count().__next__)
                ids = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
                found = runs(ids)
                if len(found):
                    gone = repeated(len(tokens), found)
                    tokens = [t for t, out in zip(tokens, gone.tolist()) if not out]
                sizes.append(len(ids))
                rows.append(found)
                kept.append(b" ".join(tokens).decode())
            flat = np.concatenate([np.empty((0, 3), np.int64), *rows])
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in rows]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(
                pa.array(offsets), pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(kind))
            )
            new = [pa.array(sizes, pa.int64()), lists, pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([c for _, c in rest] + new, names=[x for x, _ in rest] + names)

    return docs.mapInArrow(run, schema_with(docs, text, f"n_words bigint, runs {RUNS}, collapsed string"))


def with_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the words of about a tenth of its texts repeated from some place on, chosen by the key's digest.

    With h the CRC-32 of the decimal key and g = h div 10: where h is divisible by 10, word i from a = g mod n on
    becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). A null key changes nothing.
    """
    h = F.crc32(F.col(f"`{key}`").cast("string"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    inner = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.when(chosen, words(F.col(f"`{text}`"))).alias("words"),
        F.floor(h / 10).alias("g"),
    )
    n = F.size("words")
    a = (F.col("g") % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
    place = F.when(n > 0, F.struct(a.alias("a"), p.alias("p")))
    inner = inner.select("row", "words", place.alias("place"))
    changed = F.transform(
        "words",
        lambda w, i: F.when(i < F.col("place.a"), w).otherwise(
            F.get(F.col("words"), F.col("place.a") + (i - F.col("place.a")) % F.col("place.p"))
        ),
    )
    value = F.when(F.col("place").isNotNull(), F.array_join(changed, " ")).otherwise(F.col(f"row.`{text}`"))
    return inner.select(*[(value if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """Number of runs, the longest one and digests, for each document; nulls where there is no run."""
    found = find_runs(docs.select("doc_id", "text"))
    least = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    best = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), least.alias("best"), listed.alias("listed"), "collapsed")
    length = -F.col("best.l")
    return best.select(
        "doc_id",
        "n_runs",
        F.col("best.s").alias("start"),
        length.alias("length"),
        F.col("best.p").alias("period"),
        F.floor(1000 * length / F.col("best.p")).alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
