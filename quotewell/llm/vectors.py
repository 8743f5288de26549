"""Near-duplicate vectors by PCA-ordered, tiled comparison.

Equal vectors are folded first.  A rotation to principal axes, which changes no
product, puts most of every vector into few leading dimensions.  Vectors are cut
into ranges along the first axis, large ranges into chunks, and every chunk
meets the chunks of all ranges near enough to hold a partner; such a meeting is
one task of bounded size.  In it, tiles of products are made of leading
dimensions, the rest is bounded by the product of the suffix norms, and only
pairs that can still reach the threshold go on.  The first bound of a tile is one
product of matrices in single precision, lowered by the most it can be off.  A task returns counts of links
and a spanning forest, not the links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewell.llm.common import stored
from quotewell.llm.graph import components, local_components

THRESHOLD = 0.9
#: Vectors in a chunk, in a tile, in the sample that the axes and ranges are fitted on, and the most ranges.
CHUNK, TILE, SAMPLE, RANGES = 8192, 1024, 10_000, 1024
#: Products closer to the threshold than this are decided by exactly rounded sums.
CLOSE = 1e-9


@dataclass(frozen=True)
class Raw:
    """(uid, vec_id, embedding) to (uid, vec_id, dim, raw): 0 dimensions for what links with nothing."""

    kind: str

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, raws = [], []
            for vector in batch.column(2):
                values = vector.values
                x = None if values is None or not len(values) or values.null_count else values.to_numpy(zero_copy_only=False)
                good = x is not None and np.isfinite(x).all() and bool(x.any())
                dims.append(len(x) if good else 0)
                raws.append((x + 0.0).astype(self.kind).tobytes() if good else b"")  # -0 becomes 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(raws, pa.binary())],
                names=["uid", "vec_id", "dim", "raw"],
            )


def matrix(raws: list[bytes], kind: str) -> np.ndarray:
    """Rows scaled by powers of two, which changes no rounding, so that squares stay in range."""
    x = np.frombuffer(b"".join(raws), kind).astype(np.float64).reshape(len(raws), -1)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def exact_cosine(x: np.ndarray, y: np.ndarray) -> float:
    return math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y))


def linked_pairs(x: np.ndarray, y: np.ndarray, axes: np.ndarray, threshold: float = THRESHOLD) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into x, into y) of cosine at least ``threshold``, a tile at a time."""
    rx, ry = unit(x) @ axes, unit(y) @ axes
    d = rx.shape[1]
    steps = [max(1, 3 * d // 8), max(1, d // 2), d]
    order_x, order_y = np.argsort(rx[:, 0], kind="stable"), np.argsort(ry[:, 0], kind="stable")
    apart = math.sqrt(max(0.0, 2 - 2 * threshold)) + CLOSE
    tails = [tuple(np.sqrt(np.maximum(0.0, (r[:, k:] ** 2).sum(axis=1))) for r in (rx, ry)) for k in steps]
    # leading dimensions and suffix norm as one row, so that one product in single precision is the bound, but for its rounding
    bound_x, bound_y = (np.column_stack([r[:, : steps[0]], t]).astype(np.float32) for r, t in zip((rx, ry), tails[0]))
    least = np.float32(threshold - CLOSE - (d + 16) * 2.0**-22)
    for at_x in range(0, len(x), TILE):
        own_x = order_x[at_x : at_x + TILE]
        a, bound_a = rx[own_x], bound_x[own_x]
        for at_y in range(0, len(y), TILE):
            own_y = order_y[at_y : at_y + TILE]
            b = ry[own_y]
            if a[0, 0] - b[-1, 0] > apart or b[0, 0] - a[-1, 0] > apart:
                continue
            i, j = np.divmod(np.flatnonzero(bound_a @ bound_y[own_y].T >= least), len(b))
            product = np.zeros(len(i))
            for low, high, (tail_x, tail_y) in zip([0, *steps[1:]], steps[1:], tails[1:]):
                if not len(i):
                    break
                if 8 * len(i) > product_size(a, b):
                    product = product + (a[:, low:high] @ b[:, low:high].T)[i, j]
                else:
                    product = product + np.concatenate(
                        [np.einsum("nk,nk->n", a[i[s : s + 65536], low:high], b[j[s : s + 65536], low:high]) for s in range(0, len(i), 65536)]
                    )
                on = product + tail_x[own_x[i]] * tail_y[own_y[j]] >= threshold - CLOSE
                i, j, product = i[on], j[on], product[on]
            i, j = own_x[i], own_y[j]
            near = np.flatnonzero(product < threshold + CLOSE)
            if len(near):
                keep = np.ones(len(i), bool)
                keep[near] = [exact_cosine(x[p], y[q]) >= threshold for p, q in zip(i[near], j[near])]
                i, j = i[keep], j[keep]
            if len(i):
                yield i, j


def product_size(a: np.ndarray, b: np.ndarray) -> int:
    return len(a) * len(b)


@dataclass(frozen=True)
class Meeting:
    """Rows of one chunk or of two: links of each vector, and the root of its component among them."""

    axes: np.ndarray
    kind: str
    threshold: float

    def __call__(self, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        first = table["side"].to_numpy() == 0
        reps, n = table["rep"].to_numpy(), table["n"].to_numpy()
        x = matrix(table["raw"].to_pylist(), self.kind)
        left = np.flatnonzero(first)
        right = left if table["a"][0] == table["b"][0] else np.flatnonzero(~first)
        links, roots = np.zeros(len(reps), np.int64), np.arange(len(reps))
        forest: list[np.ndarray] = []
        for i, j in linked_pairs(x[left], x[right], self.axes, self.threshold):
            i, j = left[i], right[j]
            if right is left:
                other = i != j
                i, j = i[other], j[other]
                np.add.at(links, i, n[j])
            else:
                np.add.at(links, i, n[j])
                np.add.at(links, j, n[i])
            roots = local_components(len(reps), np.concatenate([i, np.arange(len(reps))]), np.concatenate([j, roots]))
        on = links > 0
        by_rep = np.full(len(reps), np.iinfo(np.int64).max)
        np.minimum.at(by_rep, roots, reps)
        return pa.table({"rep": reps[on], "links": links[on], "root": by_rep[roots][on]})


def links_of(vectors: DataFrame, dim: int, kind: str, threshold: float, chunk: int, ranges: int) -> DataFrame:
    """(rep, links, root) rows of the folded ``vectors`` (rep, n, raw) of one dimension."""
    spark = vectors.sparkSession
    sample = matrix([bytes(r["raw"]) for r in vectors.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("raw").collect()], kind)
    values, axes = np.linalg.eigh(unit(sample).T @ unit(sample))
    axes = np.ascontiguousarray(axes[:, ::-1])
    total = vectors.count()
    parts = min(ranges, -(-total // chunk))
    cuts = np.unique(np.quantile(unit(sample) @ axes[:, 0], np.arange(1, parts) / parts)) if parts > 1 else np.zeros(0)
    lead = axes[:, 0].copy()

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = unit(matrix(batch.column(2).to_pylist(), kind)) @ lead if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.searchsorted(cuts, at).astype(np.int32)), pa.array(at)],
                names=["rep", "n", "raw", "part", "lead"],
            )

    rows = stored(vectors.select("rep", "n", "raw").mapInArrow(placed, "rep long, n long, raw binary, part int, lead double"), "vectors")
    found = {r["part"]: r for r in rows.groupBy("part").agg(F.count("*").alias("n"), F.min("lead").alias("lo"), F.max("lead").alias("hi")).collect()}
    apart, first, bounds = math.sqrt(max(0.0, 2 - 2 * threshold)) + CLOSE, 0, []
    for part in sorted(found):
        r = found[part]
        chunks = -(-r["n"] // chunk)
        bounds.append((part, first, chunks, r["lo"], r["hi"]))
        first += chunks
    reach = [
        (
            part, begin, chunks,
            min(b for _, b, _, _, hi2 in bounds if lo - hi2 <= apart),
            max(b + c - 1 for _, b, c, lo2, _ in bounds if lo2 - hi <= apart),
        )
        for part, begin, chunks, lo, hi in bounds
    ]
    table = F.broadcast(spark.createDataFrame(reach, "part int, begin long, chunks int, low long, high long"))  # at most ``ranges`` rows
    met = (
        rows.join(table, "part")
        .withColumn("own", F.col("begin") + F.pmod(F.xxhash64("rep"), F.col("chunks")))
        .withColumn("other", F.explode(F.sequence("low", "high")))
        .select(
            F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"),
            (F.col("own") > F.col("other")).cast("int").alias("side"), "rep", "n", "raw",
        )
    )
    meeting = Meeting(axes, kind, threshold)
    return met.groupBy("a", "b").applyInArrow(lambda t: meeting(t), "rep long, links long, root long")


def near_duplicates(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", threshold: float = THRESHOLD,
    chunk: int = CHUNK, ranges: int = RANGES,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors``.

    Two rows link if the cosine of their vectors, in double precision, is at
    least ``threshold``; vectors of different lengths never do.  Null, empty and
    zero vectors and those with null or non-finite components link with nothing.
    Repeated rows and ids are vectors of their own.  A component's id is the
    smallest id in it, nulls aside; a row whose id is null is not kept.  Other
    columns are left behind.
    """
    field = next(f for f in vectors.schema.fields if f.name == vector_column)
    kind = "<f4" if isinstance(field.dataType.elementType, T.FloatType) else "<f8"
    given = vectors.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector_column).cast("array<float>" if kind == "<f4" else "array<double>").alias("embedding"),
    )
    rows = stored(given.mapInArrow(Raw(kind), "uid long, vec_id long, dim int, raw binary"), "vectors")
    folded = stored(
        rows.where("dim > 0").groupBy("dim", "raw").agg(F.min("uid").alias("rep"), F.count("*").alias("n"), F.min("vec_id").alias("least")), "folded"
    )
    dims = [r["dim"] for r in folded.select("dim").distinct().collect()]
    links = None
    for dim in sorted(dims):
        of_dim = links_of(folded.where(F.col("dim") == dim), dim, kind, threshold, chunk, ranges)
        links = of_dim if links is None else links.unionAll(of_dim)
    if links is None:
        links = vectors.sparkSession.createDataFrame([], "rep long, links long, root long")
    links = stored(links, "links")
    counted = links.groupBy("rep").agg(F.sum("links").alias("links"))
    member = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    each = folded.join(counted, "rep", "left").join(member, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    each = stored(each.select("dim", "raw", "n", "least", F.coalesce("links", F.lit(0)).alias("links"), "component"), "members")
    least = each.groupBy("component").agg(F.min("least").alias("component_id"))
    known = each.join(least, "component").select("dim", "raw", "n", "links", "component_id")
    return rows.join(known, ["dim", "raw"], "left").select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.coalesce("n", F.lit(1)) - 1).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"),
    )
