"""Nearest neighbours by collision counting: sorted projections, windows around the query that grow by virtual rehashing."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from sedimart.session import stage

#: Projections; the share of them in which a candidate collides; the first half width of a window and its
#: growth, in lengths of the longest vector.
PROJECTIONS, THRESHOLD, WIDTH, GROWTH = 48, 0.75, 0.4, 1.2
#: Windows whose places are looked up for all queries at once.
STEPS = 10
#: The chance at most that a vector as near as the last one wanted collides too seldom when the search ends.
MISS = 0.05
SEED = 5
#: More than products of a matrix may differ from sums row by row, in products of the lengths.
ROUNDING = 1e-9
#: Vectors in a block of the index, and queries in a block of queries.
BLOCK, QUERIES = 8192, 512


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def reach(projections: int, need: int, miss: float) -> float:
    """The least half width, in units of a vector's distance, at which it collides ``need`` times with a chance of 1 - miss.

    Along a direction of standard normal components, two vectors lie a normal number times their
    distance apart, so the number of collisions is binomial.
    """

    def enough(width: float) -> float:
        p = math.erf(width / math.sqrt(2))
        return math.fsum(math.comb(projections, i) * p**i * (1 - p) ** (projections - i) for i in range(need, projections + 1))

    low, high = 0.0, 8.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if enough(middle) >= 1 - miss else (middle, high)
    return high


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    return pc.list_flatten(column).to_numpy().reshape(len(column), -1)


class Projections:
    """Sorted projections of a block of vectors, lifted so that the largest product is the least distance.

    A vector gets one more component that gives all of them the length of the longest, ``bound``; a
    query gets a zero there and the same length.
    """

    def __init__(self, vectors: np.ndarray, bound: float, directions: np.ndarray):
        self.vectors = vectors
        rest = np.sqrt(np.maximum(bound**2 - (vectors**2).sum(1), 0.0))
        values = np.hstack([vectors, rest[:, None]]) @ directions.T
        self.order = np.argsort(values, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(values.T, self.order, axis=1)
        self.scale = bound

    def _steps(self, places: np.ndarray) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """(width, first places, last places) of the first windows of all queries, as they grow if nothing ends them."""
        steps, width = [], WIDTH * self.scale
        for _ in range(STEPS):
            lows = [v.searchsorted(a - width) for v, a in zip(self.values, places.T, strict=True)]
            highs = [v.searchsorted(a + width, side="right") for v, a in zip(self.values, places.T, strict=True)]
            steps.append((width, np.array(lows).T, np.array(highs).T))
            width *= GROWTH
        return steps

    def search(self, queries: np.ndarray, own: np.ndarray, directions: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query, the places and products of the nearest ``k`` vectors, or more, that collide with it in enough projections.

        Windows around the query's own projections begin narrow and grow together; each step only
        counts what lies between the last windows and the new ones, and verifies the vectors that
        have collided often enough by then. The search ends when the windows are so wide that a
        vector as near as the k-th verified one would have collided with a chance of 1 - MISS, or
        when they hold everything. ``own`` is each query's own place here, which is left out, or -1.
        """
        n = self.values.shape[1]
        need = math.ceil(THRESHOLD * len(directions))
        wide = reach(len(directions), need, MISS)
        lengths = np.linalg.norm(queries, axis=1)
        places = (queries * (self.scale / lengths[:, None])) @ directions[:, :-1].T
        steps = self._steps(places)
        for i, (query, length, at, mine) in enumerate(zip(queries, lengths, places, own, strict=True)):
            counts, fresh = np.zeros(n, np.int64), np.ones(n, dtype=bool)
            fresh[mine : mine + 1 if mine >= 0 else mine] = False
            found, products = np.zeros(0, np.int64), np.zeros(0)
            width, low, high = WIDTH * self.scale, None, None
            for step in itertools.count():
                if step < len(steps) and steps[step][0] == width:
                    lows, highs = (side[i].tolist() for side in steps[step][1:])
                else:
                    lows = [v.searchsorted(a - width) for v, a in zip(self.values, at, strict=True)]
                    highs = [v.searchsorted(a + width, side="right") for v, a in zip(self.values, at, strict=True)]
                if low is None:
                    new = [order[a:b] for order, a, b in zip(self.order, lows, highs, strict=True)]
                else:
                    new = [order[a:b] for order, a, b in zip(self.order, lows, low, strict=True)]
                    new += [order[a:b] for order, a, b in zip(self.order, high, highs, strict=True)]
                counts += np.bincount(np.concatenate(new), minlength=n)
                low, high = lows, highs
                more = np.flatnonzero((counts >= need) & fresh)
                fresh[more] = False
                found, products = np.concatenate([found, more]), np.concatenate([products, self.vectors.take(more, axis=0) @ query])
                if max(low) == 0 and min(high) == n:
                    break
                if len(found) >= k:
                    last = np.partition(products, len(products) - k)[len(products) - k]
                    enough = wide * math.sqrt(max(0.0, 2 * self.scale**2 - 2 * self.scale * last / length))
                    if width >= enough:
                        break
                    width = min(width * GROWTH, enough)
                else:
                    width *= GROWTH
            if len(found) > k:
                # a matrix product may round the k-th one away: what is as near but for rounding stays
                last = np.partition(products, len(products) - k)[len(products) - k]
                found = found[~(products < last - ROUNDING * self.scale * length)]
            # summed row by row, so equal vectors have equal products wherever they stand
            yield found, (self.vectors[found] * query).sum(1)


def _searched(k: int, bound: float):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """The nearest in one block of the index to each query of one block."""
        out: dict[str, list] = {"query_row": [], "query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            vectors, ids, rows = _matrix(left["vector"]), left["id"].to_numpy(), left["row"].to_numpy()
            directions = np.random.default_rng(SEED).standard_normal((PROJECTIONS, vectors.shape[1] + 1))
            index = Projections(vectors, bound, directions)
            queries = _matrix(right["vector"])
            asking = right["row"].to_numpy()
            order = np.argsort(rows)
            at = np.minimum(np.searchsorted(rows, asking, sorter=order), len(rows) - 1)
            own = np.where(rows[order[at]] == asking, order[at], -1)
            for q, row, (found, scores) in zip(right["id"].to_pylist(), asking.tolist(), index.search(queries, own, directions, k), strict=True):
                best = np.lexsort((ids[found], -scores))[:k]
                out["query_row"] += [row] * len(best)
                out["query_id"] += [q] * len(best)
                out["vec_id"] += ids[found[best]].tolist()
                out["score"] += scores[best].tolist()
        kinds = {"query_row": pa.int64(), "query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        return pa.Table.from_pydict({c: pa.array(v, kinds[c]) for c, v in out.items()})

    return run


def nearest(df: DataFrame, queries: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """For each row that ``queries`` picks, the ``k`` nearest other rows found: query_id, rank, vec_id, score.

    Nearness is the inner product in double precision; ties go to the smaller id. Blocks of queries
    meet blocks of the index; both are dealt by hash, and more rows make more blocks, not larger
    ones. In a block, the index is one sorted array for each projection; vectors that collide with
    the query in enough of them are verified by their true products, until the windows are so wide
    that the block's k-th nearest has been met with a chance of 1 - ``MISS``. The nearest of all blocks
    are then ranked together. So a vector may be missed with that chance; tests measure it.

    Vectors that are null, zero, or hold null or non-finite components take no part, neither do
    queries among them, and vectors of another length than the query's are no candidates. Rows of
    equal vectors, and of equal or null ids, are rows of their own. An empty table gives no rows.
    Other columns are not read.
    """
    rows = df.filter(usable(F.col(vector))).select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("asks"), F.size(vector).alias("length"),
    )
    rows = stage(rows, "vectors")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    sums = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("asks"), F.max(norm).alias("bound")).first()
    blocks, asking = max(1, -(-sums["n"] // block)), max(1, -(-sums["asks"] // QUERIES))
    own = F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block")
    ask = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(asking)).alias("ask")
    others = lambda n, name: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias(name)
    index = rows.select("row", "id", "vector", "length", own, others(asking, "ask"))
    asked = rows.filter("asks").select("row", "id", "vector", "length", ask, others(blocks, "block"))
    keys = ["length", "block", "ask"]
    met = index.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_searched(k, sums["bound"] or 1.0), "query_row long, query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
