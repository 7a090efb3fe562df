r"""Exact top-k search by inner product, over vectors sorted by length.

Vectors are scaled to integers (``floor(scale * x)``), so scores are exact. All vectors are
rotated by the singular vectors of their second-moment matrix, which keeps inner products
and moves most of each product into the first coordinates. With a query q and a vector x,
split after ``LEADING`` rotated coordinates, Cauchy-Schwarz gives

    <q, x> <= |q| |x|   and   <q, x> <= <q', x'> + |q''| |x''|.

Vectors are sorted by descending length and cut into blocks. Seeds, the longest vectors of
each dimension, give every query a lower bound of its k-th score. A block of queries meets
just the longest blocks, up to the first whose longest vector cannot reach the bound of any
of its queries: blocks and bounds are ranked together, and only that many numbers are
written out for it. Inside a joined pair of blocks rows are met by descending length until
the first bound ends the scan, and the second bound leaves few rows to be scored exactly.
Ties are kept by pruning strictly below the bound.

Blocks of queries and of vectors meet in an equi-join on the number of the block, so neither
is broadcast and no task holds more than one block of each; adaptive execution splits the
queries of a block that many of them meet. Two things pass through the driver: the moment
matrix of each dimension, its size the square of the dimension, and the seeds, ``SEED_BYTES``
for all dimensions together, but at least ``k + 1`` vectors of each.

Defined results: vectors that are null, empty or hold a null or non-finite component take no
part, nor do rows without an id; vectors of different dimensions are never compared; rows of
equal vectors are separate candidates, ranked by id; rows that repeat an id are queries and
candidates of their own: a query row leaves out itself only; a query with fewer than k
candidates gets them all; other columns, whatever their names, are ignored; an empty table
gives no rows. Scores are exact sums of doubles as long as no product of two lengths reaches
2 ** 53; longer vectors are refused.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweir.llm.frames import numbered, saved

BLOCK_ROWS = 8192
QUERY_ROWS = 2048
LEADING = 16
STEP = 512
SEED_BYTES = 1 << 23
SLACK = 1e-6  # relative error allowed to rotated sums


def scaled(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """id, v (array of double, integers), dim and norm of the vectors that take part."""
    usable = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("x")).where(
        F.col("id").isNotNull() & (F.size("x") > 0)
        & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))),
    )
    exact = F.transform("x", lambda c: F.floor(c * scale).cast("double"))
    return usable.select("id", exact.alias("v"), F.size("x").alias("dim"), F.monotonically_increasing_id().alias("row")).withColumn(
        "norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, c: total + c * c)),
    )


def _rotations(rows: DataFrame) -> dict[int, np.ndarray]:
    """For each dimension the singular vectors of the second moments of all its vectors."""
    def moments(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                m = np.stack(part["v"].to_numpy())
                sums[dim] = sums.get(dim, 0) + m.T @ m
        for dim, total in sums.items():
            yield pd.DataFrame({"dim": dim, "row": np.arange(dim), "sums": list(total)})

    parts = rows.select("dim", "v").mapInPandas(moments, "dim int, row int, sums array<double>")
    summed = parts.select("dim", "row", F.posexplode("sums").alias("col", "s")).groupBy("dim", "row", "col").agg(F.sum("s").alias("s"))
    found: dict[int, np.ndarray] = {}
    for r in summed.toLocalIterator():
        found.setdefault(r["dim"], np.zeros((r["dim"], r["dim"])))[r["row"], r["col"]] = r["s"]
    return {dim: np.linalg.svd(m)[0] for dim, m in found.items()}


def _blocks(rows: DataFrame, size: int, rotations: dict[int, np.ndarray], label: str) -> DataFrame:
    """Blocks of at most ``size`` rows of one dimension, by descending length.

    One row per block: block (a number), dim, top (its greatest length), ids, rows, norms, and
    the integer and rotated vectors as matrices.
    """
    ranges = max(1, -(-rows.count() // size))
    spread = rows.repartitionByRange(ranges, "dim", F.desc("norm"), "id", "row").sortWithinPartitions("dim", F.desc("norm"), "id")

    def cut(batches):
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                for begin in range(0, len(part), size):
                    some = part.iloc[begin:begin + size]
                    exact = np.stack(some["v"].to_numpy())
                    yield pd.DataFrame({
                        "block": [number], "dim": [dim], "top": [some["norm"].max()],
                        "ids": [some["id"].to_numpy(np.int64).tobytes()], "rows": [some["row"].to_numpy(np.int64).tobytes()],
                        "norms": [some["norm"].to_numpy().tobytes()],
                        "exact": [exact.tobytes()], "rotated": [(exact @ rotations[dim]).tobytes()],
                    })
                    number += 1

    shape = "block long, dim int, top double, ids binary, rows binary, norms binary, exact binary, rotated binary"
    return saved(spread.mapInPandas(cut, shape), label)


def _seeds(others: DataFrame, rotations: dict[int, np.ndarray], k: int) -> dict[int, dict]:
    """The first rows of the block of the longest vectors of each dimension."""
    longest = others.groupBy("dim").agg(F.max_by("block", "top").alias("block")).select("block")
    room = SEED_BYTES // max(1, len(rotations))

    def cut(batches):
        for batch in batches:
            for _, row in batch.iterrows():
                dim = int(row["dim"])
                rows = max(k + 1, room // (16 * dim))
                yield pd.DataFrame({
                    "dim": [dim], **{c: [row[c][:8 * rows]] for c in ("ids", "rows", "norms")},
                    **{c: [row[c][:8 * rows * dim]] for c in ("exact", "rotated")},
                })

    shape = "dim int, ids binary, rows binary, norms binary, exact binary, rotated binary"
    heads = others.join(longest, "block", "left_semi").mapInPandas(cut, shape)
    return {r["dim"]: r.asDict() for r in heads.toLocalIterator()}


def _meetings(bounded: DataFrame, others: DataFrame) -> DataFrame:
    """(q_block, block) for every block that may hold one of the best of a block of queries.

    ``bounded`` has q_block, dim and reach, the least length that is still of use. A block of
    queries is preceded by its blocks in the common order; their number is its place in it less
    its place among queries.
    """
    by = F.struct("value", "asks", "number").alias("order")
    blocks = others.select("dim", (-F.col("top") * (1 + SLACK)).alias("value"), F.lit(0).alias("asks"), F.col("block").alias("number"))
    asking = bounded.select("dim", (-F.col("reach")).alias("value"), F.lit(1).alias("asks"), F.col("q_block").alias("number"))
    asking = asking.select("dim", by)
    blocks = blocks.select("dim", by)
    among_all = numbered(blocks.union(asking), "dim", "order", "topk-order").where("order.asks = 1")
    among_queries = numbered(asking, "dim", "order", "topk-asking")
    reached = (
        among_all.select(F.col("order.number").alias("q_block"), "dim", F.col("rank").alias("before"))
        .join(among_queries.select(F.col("order.number").alias("q_block"), "rank"), "q_block")
        .where("before > rank")
        .select("q_block", "dim", F.explode(F.sequence(F.lit(0).cast("long"), F.col("before") - F.col("rank") - 1)).alias("rank"))
    )
    places = numbered(blocks, "dim", "order", "topk-places").select("dim", "rank", F.col("order.number").alias("block"))
    return reached.join(places, ["dim", "rank"]).select("q_block", "block")


class _Block:
    def __init__(self, row, prefix: str):
        dim = int(row["dim"])
        self.ids = np.frombuffer(row[f"{prefix}ids"], np.int64)
        self.rows = np.frombuffer(row[f"{prefix}rows"], np.int64)
        self.norms = np.frombuffer(row[f"{prefix}norms"])
        self.exact = np.frombuffer(row[f"{prefix}exact"]).reshape(-1, dim)
        rotated = np.frombuffer(row[f"{prefix}rotated"]).reshape(-1, dim)
        self.lead = rotated[:, :LEADING]
        self.rest = np.sqrt(np.maximum(0, (rotated[:, LEADING:] ** 2).sum(1)))


def scan(queries: _Block, others: _Block, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best ``k`` of ``others`` for every query, as (query places, other places, scores).

    ``bounds`` holds a lower bound of each query's k-th score; what lies below it is left out.
    """
    bounds = bounds.copy()
    count = len(queries.ids)
    held = np.full((count, 0), -np.inf)
    who = np.zeros((count, 0), np.int64)
    for begin in range(0, len(others.ids), STEP):
        part = slice(begin, begin + STEP)
        open_ = queries.norms * others.norms[part.start] * (1 + SLACK) >= bounds
        if not open_.any():
            break
        q = np.flatnonzero(open_)
        reach = queries.norms[q, None] * others.norms[None, part]
        best = queries.lead[q] @ others.lead[part].T + queries.rest[q, None] * others.rest[None, part] + SLACK * reach
        near = (best >= bounds[q, None]) & (queries.rows[q, None] != others.rows[None, part])
        columns = np.flatnonzero(near.any(0))
        rows = np.flatnonzero(near.any(1))
        if not len(rows):
            continue
        q, near = q[rows], near[np.ix_(rows, columns)]
        scores = np.where(near, queries.exact[q] @ others.exact[begin + columns].T, -np.inf)
        places = np.broadcast_to(begin + columns, scores.shape)
        all_scores = np.concatenate([held[q], scores], 1)
        all_places = np.concatenate([who[q], places], 1)
        # by descending score, then ascending id
        order = np.lexsort((others.ids[all_places], -all_scores), axis=1)[:, :k]
        if held.shape[1] < order.shape[1]:
            more = order.shape[1] - held.shape[1]
            held = np.pad(held, ((0, 0), (0, more)), constant_values=-np.inf)
            who = np.pad(who, ((0, 0), (0, more)))
        held[q, :order.shape[1]] = np.take_along_axis(all_scores, order, 1)
        who[q, :order.shape[1]] = np.take_along_axis(all_places, order, 1)
        if held.shape[1] == k:
            bounds = np.maximum(bounds, held[:, -1])
    found, slot = np.nonzero(held > -np.inf)
    return found, who[found, slot], held[found, slot]


_QUERY = ["ids", "rows", "norms", "exact", "rotated"]


def top_k(
    vectors: DataFrame, query: Column, k: int = 5, scale: int = 256, key: str = "vec_id", vector: str = "embedding",
    block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), the key, and score of the ``k`` best rows for each query row.

    ``query`` is a condition on the column ``id``, the key of a vector.
    """
    kind = vectors.schema[key].dataType.simpleString()
    rows = saved(scaled(vectors, key, vector, scale), "topk-scaled")
    longest = rows.agg(F.max("norm")).first()[0]
    if longest is not None and longest * longest >= 2.0**53:
        raise ValueError(f"scores of vectors as long as {longest:.3g} (scaled) are not exact")
    rotations = _rotations(rows)
    others = _blocks(rows, block_rows, rotations, "topk-blocks")
    asked = _blocks(rows.where(query), query_rows, rotations, "topk-queries").select(
        F.col("block").alias("q_block"), "dim", *(F.col(c).alias(f"q_{c}") for c in _QUERY),
    )

    seeds = _seeds(others, rotations, k)

    def bounding(batches):
        for batch in batches:
            out = []
            for _, row in batch.iterrows():
                queries, block = _Block(row, "q_"), _Block(seeds[int(row["dim"])], "")
                bounds = np.full(len(queries.ids), -np.inf)
                at, _, scores = scan(queries, block, bounds, k)
                full = np.bincount(at, minlength=len(bounds)) == k
                np.minimum.at(least := np.full(len(bounds), np.inf), at, scores)
                bounds[full] = least[full]
                with np.errstate(divide="ignore", invalid="ignore"):
                    reach = np.where(queries.norms > 0, bounds / queries.norms, -np.inf)
                out.append((row["q_block"], row["dim"], float(reach.min()), bounds.tobytes()))
            yield pd.DataFrame(out, columns=["q_block", "dim", "reach", "bounds"])

    bounded = saved(asked.mapInPandas(bounding, "q_block long, dim int, reach double, bounds binary"), "topk-bounds")
    meetings = _meetings(bounded, others)

    def scoring(batches):
        for batch in batches:
            for _, row in batch.iterrows():
                queries, block = _Block(row, "q_"), _Block(row, "")
                at, other, scores = scan(queries, block, np.frombuffer(row["bounds"]), k)
                yield pd.DataFrame({
                    "query_id": queries.ids[at], "query_row": queries.rows[at], "other": block.ids[other], "score": scores.astype(np.int64),
                })

    met = (
        saved(meetings, "topk-meetings").join(asked.join(bounded.select("q_block", "bounds"), "q_block"), "q_block")
        .join(others.drop("dim", "top"), "block")
    )
    found = met.mapInPandas(scoring, "query_id long, query_row long, other long, score long")
    place = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "other"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select(
        F.col("query_id").cast(kind), "rank", F.col("other").cast(kind).alias(key), "score",
    )
