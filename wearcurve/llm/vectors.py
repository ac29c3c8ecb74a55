"""Near copies among embeddings by sorted projection passes.

Each pass draws random hyperplanes, writes down on which side of each a vector lies, orders all vectors by these signs
read as one word, and compares each with the few before it. Pairs with cosine at the threshold or above are joined
over all passes into components. All passes are one shuffle; what a partition's first and last rows miss is compared
afterwards from these rows alone.

The number of passes follows from the rows and from how crowded they are (``passes_for``), so that a pair right at the
threshold is met with probability ``RECALL`` or more at any size. Where no number of passes does that, as signs cannot
part a crowd, all pairs of that length are compared instead.

The window bounds what a pass finds, not what is counted: links are then counted over whole components. A vector within
half the threshold's angle of its component's smallest member links with every other such vector, so these are counted
and not compared; the others are compared with their whole component, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearcurve.llm.components import components
from wearcurve.llm.work import sample_by_hash, stage

THRESHOLD = 0.9
#: Probability that a pair at the threshold which nothing else connects is met in some pass.
RECALL = 0.99
WINDOW = 64
#: Vectors from which the crowding around a vector is told.
SAMPLE = 1024
#: Vectors of one side of a task where all pairs are compared.
ALL_BLOCK = 16384
#: Single-precision cosines closer to the threshold are computed again in double precision.
SLACK = 1e-4
#: Signs of a pass, read as one number.
SIGNS = 60
#: Members of a component compared by one task.
BLOCK = 4096


def usable(vector: str) -> F.Column:
    """Whether a vector can link: not null, not zero, all components there and finite."""
    c = F.col(vector)
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return c.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(c, lambda x: x != 0)


def _unit(lists: pa.ListArray | pa.ChunkedArray, dim: int) -> np.ndarray:
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _planes(dim: int, number: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, number, dim]).standard_normal((dim, SIGNS))


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch.column("vec").value_lengths().to_numpy()
    for dim in np.unique(dims):
        yield int(dim), batch.filter(pa.array(dims == dim))


def _near(x: np.ndarray, y: np.ndarray, threshold: float, rows: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in ``x`` and ``y`` of all pairs with cosine at the threshold or above."""
    y32 = y.astype(np.float32).T
    for begin in range(0, len(x), rows):
        cos = x[begin : begin + rows].astype(np.float32) @ y32
        i, j = np.nonzero(cos >= threshold - SLACK)
        unsure = np.flatnonzero(cos[i, j] < threshold + SLACK)
        i += begin
        ok = np.ones(len(i), bool)
        ok[unsure] = np.einsum("ij,ij->i", x[i[unsure]], y[j[unsure]]) >= threshold
        yield i[ok], j[ok]


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root``, the smallest place of each place's component, after the links ``a``, ``b``."""
    while (root[a] != root[b]).any():
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    return root


def passes_for(sample: np.ndarray, rows: int, threshold: float, window: int, recall: float = RECALL) -> float:
    """Passes in which a pair at the threshold is met with probability ``recall``, among ``rows`` vectors of which
    ``sample`` (unit vectors) are some; infinite where signs cannot part the crowd.

    Two vectors at angle t agree in a sign with probability 1 - t / pi. So the number of vectors that agree with one in
    its first n signs is the sum of (1 - t / pi)^n over all vectors. Where it falls to the window, a pair that agrees in
    n signs is met. Vectors that link with it are no crowd: they lead to the same component. The most crowded vector of
    the sample decides; a table is never taken as less crowded than random directions.
    """
    if rows <= window + 1:
        return 1
    cos = np.clip(sample @ sample.T, -1, 1)
    agree = np.where(cos >= threshold, 0.0, 1 - np.arccos(cos) / np.pi)
    low, high = np.zeros(max(len(sample), 1)), np.full(max(len(sample), 1), float(SIGNS))
    for step in range(30):
        signs = (low + high) / 2 if step else high
        crowd = rows * 0.5**signs
        if len(sample):
            crowd = np.maximum(crowd, rows * (agree ** np.maximum(signs, 1e-9)[:, None]).mean(1))
        if not step and (crowd > window).any():
            return np.inf
        low, high = np.where(crowd > window, signs, low), np.where(crowd > window, high, signs)
    meets = (1 - np.arccos(threshold) / np.pi) ** high.max()
    return float(np.ceil(np.log1p(-recall) / np.log1p(-meets))) if meets < 1 else 1


def planned(vectors: DataFrame, threshold: float, window: int, recall: float) -> tuple[dict[int, int], dict[int, int]]:
    """Passes for each length of vector, and the rows of the lengths whose crowds no passes part."""
    sizes = {r["dim"]: r["count"] for r in vectors.groupBy(F.size("vec").alias("dim")).count().collect()}
    if not sizes:
        return {}, {}
    some: dict[int, list] = {}
    for r in sample_by_hash(vectors.select("id", "vec"), SAMPLE, "id").collect():
        some.setdefault(len(r["vec"]), []).append(r["vec"])
    passes, whole = {}, {}
    for dim, rows in sizes.items():
        sample = _unit(pa.array(some.get(dim, []), pa.list_(pa.float32())), dim) if dim in some else np.empty((0, dim))
        number = passes_for(sample, rows, threshold, window, recall)
        if np.isinf(number):
            whole[dim] = rows
        else:
            passes[dim] = int(number)
    return passes, whole


def all_links(vectors: DataFrame, rows: dict[int, int], threshold: float, block: int = ALL_BLOCK) -> DataFrame:
    """Links ``a``, ``b`` that join what any pair at the threshold joins, among the vectors of the lengths in ``rows``."""
    blocks = F.create_map(*[F.lit(x) for dim, n in rows.items() for x in (dim, -(-n // block))])
    dealt = vectors.select("id", "vec", F.size("vec").alias("dim")).filter(F.col("dim").isin(*rows))
    dealt = dealt.withColumn("n", F.element_at(blocks, F.col("dim"))).withColumn("at", F.pmod(F.xxhash64("id"), "n").cast("int"))
    ours = dealt.select("dim", F.col("at").alias("i"), F.explode(F.sequence("at", F.col("n") - 1)).alias("j"), "id", "vec")
    theirs = dealt.select("dim", F.explode(F.sequence(F.lit(0), "at")).alias("i"), F.col("at").alias("j"), "id", "vec")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        a = b = np.empty(0, np.int64)
        if left.num_rows and right.num_rows:
            dim = left.column("dim")[0].as_py()
            ids = np.concatenate([t.column("id").to_numpy() for t in (left, right)])
            root, begin = np.arange(len(ids)), left.num_rows
            x, y = (_unit(t.column("vec").combine_chunks(), dim) for t in (left, right))
            for i, j in _near(x, y, threshold):
                root = _join(root, i, j + begin)
            child = np.flatnonzero(ids[root] != ids)
            a, b = ids[child], ids[root[child]]
        return pa.table({"a": a, "b": b})

    keys = ["dim", "i", "j"]
    return ours.groupBy(*keys).cogroup(theirs.groupBy(*keys)).applyInArrow(compare, "a long, b long")


def near_links(vectors: DataFrame, threshold: float, passes: dict[int, int], window: int, seed: int) -> DataFrame:
    """Links ``a``, ``b`` (ids) that join what the passes verify; ``vectors`` has ``id`` and a usable ``vec``, and
    ``passes`` a number for each length of vector."""
    weights = 1 << np.arange(SIGNS - 1, -1, -1, dtype=np.int64)

    def project(batches):
        for batch in batches:
            for dim, part in _by_dim(batch):
                x = _unit(part.column("vec"), dim)
                for number in range(passes.get(dim, 0)):
                    key = (x @ _planes(dim, number, seed) > 0) @ weights
                    columns = [pa.array(np.full(len(x), number, np.int32)), pa.array(np.full(len(x), dim, np.int32))]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array(key), part.column("id"), part.column("vec")],
                        names=["pass", "dim", "key", "id", "vec"],
                    )

    def links_of(ids: np.ndarray, x: np.ndarray, old: int) -> tuple[np.ndarray, np.ndarray]:
        """Links that join each row from ``old`` on with those of the ``window`` rows before it that are near."""
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for begin in range(old, len(x), 2 * window):
            low = max(0, begin - window)
            for i, j in _near(x[begin : begin + 2 * window], x[low : begin + 2 * window], threshold):
                i, j = i + begin, j + low
                ok = (j < i) & (i - j <= window)
                a.append(i[ok])
                b.append(j[ok])
        root = _join(np.arange(len(x)), np.concatenate(a), np.concatenate(b))
        child = np.flatnonzero(root != np.arange(len(x)))
        return ids[child], ids[root[child]]

    kinds = "kind string, a long, b long, part int, pass int, dim int, key long, id long, vec array<float>"
    names = ["kind", "a", "b", "part", "pass", "dim", "key", "id", "vec"]

    def found(a, b):
        none = lambda t: pa.nulls(len(a), t)
        kind = pa.array(["link"] * len(a), pa.string())
        rest = [none(pa.int32())] * 3 + [none(pa.int64())] * 2 + [none(pa.list_(pa.float32()))]
        return pa.RecordBatch.from_arrays([kind, pa.array(a), pa.array(b), *rest], names=names)

    def edge(kind, table):
        none = pa.nulls(table.num_rows, pa.int64())
        columns = [pa.array([kind] * table.num_rows, pa.string()), none, none, *table.columns]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def slide(batches):
        """Links inside the partition, and its rows that a neighbouring partition may link with."""
        tail, head = None, None
        for batch in batches:
            runs = np.stack([batch.column(c).to_numpy() for c in ("pass", "dim")])
            cuts = np.flatnonzero((runs[:, 1:] != runs[:, :-1]).any(0)) + 1
            for begin, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                part = batch.slice(begin, end - begin)
                here = (part.column("pass")[0].as_py(), part.column("dim")[0].as_py())
                if head is None or here != run:
                    if tail is not None:
                        yield edge("last", tail)
                    run, tail, head = here, None, part.slice(0, 0)
                if head.num_rows < window:
                    more = part.slice(0, window - head.num_rows)
                    yield edge("first", more)
                    head = pa.concat_batches([head, more])
                old = tail.num_rows if tail is not None else 0
                both = pa.concat_batches([tail, part]) if old else part
                yield found(*links_of(both.column("id").to_numpy(), _unit(both.column("vec"), here[1]), old))
                tail = both.slice(max(0, both.num_rows - window))
        if tail is not None:
            yield edge("last", tail)

    def across(frame: pd.DataFrame) -> pd.DataFrame:
        """Links between the last rows before a cut and the first after it."""
        frame = frame.sort_values(["side", "key", "id"])
        old = int((frame["side"] == 0).sum())
        x = _unit(pa.array(list(frame["vec"]), pa.list_(pa.float32())), int(frame["dim"].iloc[0]))
        a, b = links_of(frame["id"].to_numpy(), x, old)
        return pd.DataFrame({"a": a, "b": b})

    count = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = vectors.mapInArrow(project, "pass int, dim int, key long, id long, vec array<float>")
    order = ["pass", "dim", "key", "id"]
    sorted_ = dealt.repartitionByRange(count, *order).sortWithinPartitions(*order)
    numbered = sorted_.select(F.spark_partition_id().alias("part"), *order, "vec")
    slid = stage(numbered.mapInArrow(slide, kinds), "slid")
    ends = slid.filter("kind <> 'link'").withColumn("side", F.when(F.col("kind") == "last", 0).otherwise(1))
    # Partitions can be empty, so the cut is before the next partition that has rows of the same pass.
    parts = ends.groupBy("pass", "dim", "part").agg(F.count("id")).select("pass", "dim", "part")
    parts = parts.join(parts.withColumnRenamed("part", "next"), ["pass", "dim"]).filter("next > part")
    parts = parts.groupBy("pass", "dim", "part").agg(F.min("next").alias("cut"))
    before = ends.filter("side = 0").join(parts, ["pass", "dim", "part"])
    after = ends.filter("side = 1").withColumn("cut", F.col("part"))
    columns = ["pass", "dim", "cut", "side", "key", "id", "vec"]
    fenced = before.select(*columns).union(after.select(*columns)).groupBy("pass", "dim", "cut")
    return slid.filter("kind = 'link'").select("a", "b").union(fenced.applyInPandas(across, "a long, b long"))


def _count_links(vectors: DataFrame, linked: DataFrame, threshold: float, block: int) -> DataFrame:
    """``id``, ``n_links`` over whole components, for the members of components."""
    half = float(np.cos(np.arccos(threshold) / 2 - 1e-6))
    members = vectors.join(linked, vectors["id"] == linked["node"]).select("id", "component", "vec")
    pivots = members.filter("id = component").select("component", F.col("vec").alias("pivot"))

    def near_pivot(batches):
        for batch in batches:
            x, p = batch.column("vec"), batch.column("pivot")
            inner = np.zeros(batch.num_rows, bool)
            dims = x.value_lengths().to_numpy()
            for dim in np.unique(dims):
                at = dims == dim
                pick = pa.array(at)
                cos = np.einsum("ij,ij->i", _unit(x.filter(pick), int(dim)), _unit(p.filter(pick), int(dim)))
                inner[at] = cos >= half
            keep = [batch.column(c) for c in ("id", "component", "vec")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(inner)], names=["id", "component", "vec", "inner"])

    placed = stage(
        members.join(pivots, "component").mapInArrow(
            near_pivot, "id long, component long, vec array<float>, inner boolean"
        ),
        "members",
    )
    sizes = placed.groupBy("component").agg(
        F.count("id").alias("size"),
        F.count_if("inner").alias("n_inner"),
        F.count_if(~F.col("inner")).alias("n_outer"),
    )
    certain = placed.filter("inner").join(sizes, "component").select("id", (F.col("n_inner") - 1).alias("n"))
    # Outer members, in blocks, against all members of their component, in blocks.
    mixed = placed.join(sizes.filter("n_outer > 0"), "component")
    spread = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.ceil(F.col(n) / block))
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col(n) / block) - 1))
    outer = mixed.filter("NOT inner").select(
        "component", spread("n_outer", 1).alias("i"), all_of("size").alias("j"), "id", "vec"
    )
    whole = mixed.select(
        F.col("component").alias("their_component"),
        all_of("n_outer").alias("their_i"),
        spread("size", 2).alias("their_j"),
        F.col("id").alias("their_id"),
        F.col("vec").alias("their_vec"),
        F.col("inner").alias("their_inner"),
    )

    def compare(ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if not len(ours) or not len(theirs):
            return pd.DataFrame({"id": np.empty(0, np.int64), "n": np.empty(0, np.int64)})
        dim = len(ours["vec"].iloc[0])
        x, y = (_unit(pa.array(list(v), pa.list_(pa.float32())), dim) for v in (ours["vec"], theirs["their_vec"]))
        mine, other, inner = (c.to_numpy() for c in (ours["id"], theirs["their_id"], theirs["their_inner"]))
        near = (x @ y.T >= threshold) & (mine[:, None] != other[None, :])
        ids = np.concatenate((mine, other[inner]))
        return pd.DataFrame({"id": ids, "n": np.concatenate((near.sum(1), near[:, inner].sum(0)))})

    pairs = outer.groupBy("component", "i", "j").cogroup(whole.groupBy("their_component", "their_i", "their_j"))
    compared = pairs.applyInPandas(compare, "id long, n long")
    return certain.union(compared).groupBy("id").agg(F.sum("n").alias("n_links"))


def near_copies(
    vectors: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = THRESHOLD,
    passes: int | None = None,
    window: int = WINDOW,
    recall: float = RECALL,
    seed: int = 17,
) -> DataFrame:
    """One row per vector: ``n_links``, ``component_id`` and ``kept``, whether it is its component's smallest.

    Vectors that are null, empty or zero, or that hold null or non-finite components, link with nothing, nor do vectors
    of different lengths. ``key`` names a vector: of rows that repeat a key, the one of the smallest vector counts, and
    one row comes back. Rows without a key link with nothing and come back with a null ``component_id``, kept. A pair at
    the threshold that nothing else connects is found with probability ``recall`` or more, unless ``passes`` are given.
    Components are read as single-precision numbers, as the tables hold them, and compared in double precision.
    """
    named = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<float>").alias("vec"))
    one = stage(named.filter("id IS NOT NULL").groupBy("id").agg(F.min("vec").alias("vec")), "vectors")
    good = one.filter(usable("vec"))
    number, whole = planned(good, threshold, window, recall)
    if passes is not None:
        number, whole = dict.fromkeys([*number, *whole], passes), {}
    links = [near_links(good, threshold, number, window, seed)] if number else []
    links += [all_links(good, whole, threshold)] if whole else []
    if not links:
        links = [good.select(F.col("id").alias("a"), F.col("id").alias("b"))]
    linked = components(reduce(DataFrame.union, links))
    counted = _count_links(good, linked, threshold, BLOCK)
    out = (
        one.select("id")
        .join(linked.withColumnRenamed("node", "id"), "id", "left")
        .join(counted, "id", "left")
        .select(
            F.col("id").alias(key),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    lost = named.filter("id IS NULL").select(
        F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id")
    )
    return out.union(lost).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
