"""Approximate nearest neighbours by cosine: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a sample of at most ``SAMPLE`` vectors: nodes are split into ``BRANCH`` by spherical
k-means until a leaf stands for about ``LEAF`` of all vectors. Every vector is indexed in its nearest leaf. A
query walks the tree with a priority queue of centroids by their cosine and visits leaves in that order. How
many is calibrated: for at most ``PROBES`` vectors the exact neighbours among all vectors are found by
brute force in blocks, and leaf visits are widened until ``RECALL`` of them are reached.

Equal vectors are indexed once, with their smallest ids: more can't be among the nearest of any query, as
ties go to the smaller id. So a vector in a third of all rows is one entry. Neighbouring leaves are put
together up to ``CHUNK`` entries, and a larger leaf is cut into chunks by a hash; a query meets each chunk
that holds a leaf it visits, is compared with those leaves only, and brings back its best from there once. So
no task grows with a leaf, and what is shuffled follows the chunks, not the leaves. Scores are computed pair by pair in double precision from the original vectors.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without id or
vectors of another length than the most frequent one (ties: the longer). Rows equal in id and vector are
one row. Fewer candidates than asked for are all returned; no vectors, no rows. Other columns aren't read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from semesta.llm.common import stored

#: Vectors that the tree is fitted on, at most; children of a node; vectors a leaf should stand for.
SAMPLE, BRANCH, LEAF = 20_000, 8, 256
#: Vectors that the width is calibrated with, at most, and the share of neighbours to be reached by them.
PROBES, RECALL = 200, 0.97
#: Entries that a task holds together, and queries that it asks them about.
CHUNK, ASKED = 4096, 4096
#: Vectors that are scored exactly at once.
BLOCK = 1024


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vec): the rows that take part, each vector as packed doubles."""
    numbers = F.col(vector).cast("array<double>")
    fine = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(numbers, lambda x: x != 0)
    rows = vectors.select(F.col(key).cast("long").alias("id"), numbers.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull() & fine & some
    )
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    rows = rows.filter(F.size("v") == (sizes[0]["size"] if sizes else 0))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            # One zero: -0.0 is the same number.
            packed = [row.tobytes() for row in values.astype("<f8") + 0.0]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["id", "vec"])

    return rows.mapInArrow(pack, "id bigint, vec binary")


def _matrix(packed) -> np.ndarray:
    packed = list(packed)
    return np.frombuffer(b"".join(packed), "<f8").reshape(len(packed), -1) if packed else np.zeros((0, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


@dataclass
class Tree:
    """Centroids by node; children of a node, or none at a leaf; leaves are numbered by node."""

    centroids: np.ndarray
    children: list[list[int]]

    @property
    def leaves(self) -> int:
        return sum(not x for x in self.children)

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """Nodes of the first ``most`` leaves, best bin first."""
        found: list[int] = []
        queue = [(0.0, 0)]
        while queue and len(found) < most:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                found.append(node)
                continue
            for child, near in zip(below, (self.centroids[below] @ query).tolist(), strict=True):
                heapq.heappush(queue, (-near, child))
        return found

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """Node of each row's leaf, by the nearest child at every level."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not (below := self.children[node]):
                out[rows] = node
                continue
            nearest = np.argmax(x[rows] @ self.centroids[below].T, 1)
            todo += [(child, rows[nearest == k]) for k, child in enumerate(below) if (nearest == k).any()]
        return out


def grow(sample: np.ndarray, leaf_size: float, seed: int = 5) -> Tree:
    """Tree of unit vectors with leaves of about ``leaf_size`` of them."""
    rng = np.random.default_rng(seed)
    centroids, children = [np.zeros(sample.shape[1])], [[]]
    todo = [(0, sample)]
    while todo:
        node, part = todo.pop()
        k = min(BRANCH, int(np.ceil(len(part) / leaf_size)))
        if k < 2:
            continue
        centers = part[rng.choice(len(part), k, replace=False)]
        for _ in range(12):
            near = np.argmax(part @ centers.T, 1)
            sums = np.zeros_like(centers)
            np.add.at(sums, near, part)
            size = np.linalg.norm(sums, axis=1)
            centers = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-12)[:, None], centers)
        near = np.argmax(part @ centers.T, 1)
        parts = [part[near == i] for i in range(k)]
        if max(map(len, parts)) == len(part):
            continue
        for center, inside in zip(centers, parts, strict=True):
            if len(inside):
                children[node].append(len(centroids))
                centroids.append(center)
                children.append([])
                todo.append((children[node][-1], inside))
    return Tree(np.array(centroids), children)


def _best(queries: np.ndarray, x: np.ndarray, ids: list[list[int]], most: int) -> list[list[tuple[float, int]]]:
    """The ``most`` nearest of each query by (score, id); ids of equal vectors stand with their vector."""
    out = []
    unit, norms = _unit(x), np.sqrt((x * x).sum(1))
    for i in range(0, len(queries), 256):
        block = queries[i : i + 256]
        near = _unit(block) @ unit.T
        # A few more than wanted: products of blocks may differ in the last bit from those of pairs.
        width = min(most + 8, near.shape[1])
        for query, row in zip(block, near, strict=True):
            edge = np.partition(row, -width)[-width] - 1e-12
            pairs: list[tuple[float, int]] = []
            # All that lie at the edge are scored, in blocks, however many they are.
            for at in np.array_split(tied := np.flatnonzero(row >= edge), len(tied) // BLOCK + 1):
                with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
                    scores = (x[at] * query).sum(1) / (norms[at] * np.sqrt((query * query).sum()))
                scores = np.where(np.isfinite(scores), scores, row[at])
                near_by = ((-s, one) for s, k in zip(scores.tolist(), at.tolist(), strict=True) for one in ids[k])
                pairs = heapq.nsmallest(most, [*pairs, *near_by])
            out.append([(-s, one) for s, one in pairs])
    return out


def grouped(sizes: dict[int, int]) -> dict[int, tuple[int, int]]:
    """(group, number of its chunks) of each leaf: neighbouring leaves together up to CHUNK entries."""
    out: dict[int, tuple[int, int]] = {}
    group, held = 0, 0
    for leaf, size in sorted(sizes.items()):
        if held and held + size > CHUNK:
            group, held = group + 1, 0
        out[leaf] = (group, max(1, -(-size // CHUNK)))
        held += size
    return out


class Index:
    """Vectors by leaf, with the calibrated width."""

    def __init__(self, vectors: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding"):
        self.k = k
        self.rows = stored(usable(vectors, key, vector), "vectors")
        # The row number's bound is applied before the shuffle, so no task gets all rows of a frequent vector.
        place = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
        few = self.rows.distinct().withColumn("place", place).filter(F.col("place") <= k + 1)
        entries = few.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
        self.entries = stored(entries, "entries")
        self.count = self.entries.count()
        self.tree, sample = self._fit()
        self.placed = stored(self._place(), "leaves")
        sizes = self.placed.groupBy("leaf").count().collect()
        # One number a leaf; the tree has at most SAMPLE leaves.
        self.groups = grouped({row["leaf"]: row["count"] for row in sizes})
        self.width = self._calibrate(sample) if self.count else 0

    def _fit(self) -> tuple[Tree, np.ndarray]:
        share = min(1.0, 0.9 * SAMPLE / max(1, self.count))
        drawn = F.pmod(F.xxhash64("vec"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
        packed = sorted(bytes(row["vec"]) for row in self.entries.filter(drawn).limit(SAMPLE).select("vec").collect())
        sample = _matrix(packed)
        if not packed:
            return Tree(np.zeros((1, 1)), [[]]), sample
        return grow(_unit(sample), max(4.0, LEAF * len(packed) / max(1, self.count))), sample

    def _place(self) -> DataFrame:
        tree = self.tree

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    leaf = tree.leaf(_unit(_matrix(batch.column(0).to_pylist())))
                    yield pa.RecordBatch.from_arrays([pa.array(leaf), *batch.columns], ["leaf", "vec", "ids"])

        return self.entries.mapInArrow(run, "leaf bigint, vec binary, ids array<bigint>")

    def _calibrate(self, sample: np.ndarray) -> int:
        """Leaf visits after which RECALL of the probes' exact neighbours are reached."""
        rng = np.random.default_rng(2)
        probes = sample[rng.permutation(len(sample))[:PROBES]]
        most = self.k + 1

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, leaf = _matrix(batch.column(1).to_pylist()), batch.column(0).to_pylist()
                best = _best(probes, x, [[i] for i in range(len(x))], most)
                rows = [(p, leaf[i], s) for p, found in enumerate(best) for s, i in found]
                columns = [pa.array([r[c] for r in rows], t) for c, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, ["probe", "leaf", "score"])

        nearest = Window.partitionBy("probe").orderBy(F.desc("score"), "leaf")
        found = self.placed.mapInArrow(run, "probe bigint, leaf bigint, score double")
        truth = found.withColumn("place", F.row_number().over(nearest)).filter(F.col("place") <= most).collect()
        orders = [{leaf: i for i, leaf in enumerate(self.tree.visits(q, self.tree.leaves))} for q in _unit(probes)]
        needed = sorted(orders[row["probe"]][row["leaf"]] + 1 for row in truth)
        return needed[int(np.ceil(RECALL * len(needed))) - 1]

    def search(self, wanted: Column) -> DataFrame:
        """(query_id, rank, vec_id, score) for the rows that ``wanted`` (of ``id``) picks."""
        tree, width, groups, most = self.tree, self.width, self.groups, self.k + 1
        queries = self.rows.filter(wanted).distinct()
        distinct = queries.groupBy("vec").agg(F.min("id").alias("q"))

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, group, chunks, leaves = [], [], [], []
                for i, query in enumerate(_unit(_matrix(batch.column(1).to_pylist()))) if batch.num_rows else ():
                    visited: dict[tuple[int, int], list[int]] = {}
                    for node in tree.visits(query, width):
                        if node in groups:
                            visited.setdefault(groups[node], []).append(node)
                    for (one, parts), nodes in visited.items():
                        at.append(i)
                        group.append(one)
                        chunks.append(parts)
                        leaves.append(nodes)
                rows = batch.take(pa.array(at, pa.int64()))
                columns = [pa.array(group, pa.int64()), pa.array(chunks, pa.int64()), pa.array(leaves, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*columns, *rows.columns], ["group", "chunks", "leaves", "q", "vec"])

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [groups[node] for node in batch.column(0).to_pylist()]
                group = [one for one, _ in found]
                drawn = [h % parts for h, (_, parts) in zip(batch.column(3).to_pylist(), found, strict=True)]
                columns = [pa.array(group, pa.int64()), pa.array(drawn, pa.int64()), *batch.columns[:3]]
                yield pa.RecordBatch.from_arrays(columns, ["group", "chunk", "leaf", "vec", "ids"])

        def meet(key, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            if not len(asked) or not len(held):
                return pd.DataFrame({"q": [], "id": [], "score": []})
            queries = _matrix(asked["vec"])
            best: list[list[tuple[float, int]]] = [[] for _ in range(len(queries))]
            by_leaf: dict[int, list[int]] = {}
            for i, nodes in enumerate(asked["leaves"]):
                for node in nodes:
                    by_leaf.setdefault(int(node), []).append(i)
            for node, rows in held.groupby("leaf"):
                at = by_leaf.get(int(node), [])
                found = _best(queries[at], _matrix(rows["vec"]), [list(x) for x in rows["ids"]], most) if at else []
                for i, pairs in zip(at, found, strict=True):
                    best[i] = heapq.nsmallest(most, [*best[i], *((-s, one) for s, one in pairs)])
            out = [(q, one, -s) for q, pairs in zip(asked["q"], best, strict=True) for s, one in pairs]
            return pd.DataFrame(out, columns=["q", "id", "score"])

        visits = distinct.select("q", "vec").mapInArrow(visit, "group bigint, chunks bigint, leaves array<bigint>, q bigint, vec binary")
        visits = stored(visits, "visits")
        # A group that many queries visit is asked in blocks of them: one row a group.
        blocks = visits.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / ASKED).cast("bigint").alias("blocks"))
        none = F.lit(0).cast("bigint")
        asked = visits.join(blocks, "group").select(
            "group",
            F.explode(F.sequence(none, F.col("chunks") - 1)).alias("chunk"),
            F.pmod(F.xxhash64("q"), F.col("blocks")).alias("block"),
            "leaves",
            "q",
            "vec",
        )
        hashed = self.placed.select("leaf", "vec", "ids", F.xxhash64("vec").alias("h"))
        held = (
            hashed.mapInArrow(deal, "group bigint, chunk bigint, leaf bigint, vec binary, ids array<bigint>")
            .join(blocks, "group")
            .select("group", "chunk", F.explode(F.sequence(none, F.col("blocks") - 1)).alias("block"), "leaf", "vec", "ids")
        )
        task = ["group", "chunk", "block"]
        met = asked.groupBy(*task).cogroup(held.groupBy(*task))
        pairs = met.applyInPandas(meet, "q bigint, id bigint, score double")
        place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
        nearest = (
            pairs.withColumn("place", place)
            .filter(F.col("place") <= most)
            .groupBy("q")
            .agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("found"))
        )
        groups = distinct.join(nearest, "q").select("vec", "found")
        others = F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, self.k)
        return (
            queries.withColumnRenamed("id", "query_id")
            .join(groups, "vec")
            .select("query_id", F.posexplode(others).alias("at", "hit"))
            .select(
                "query_id",
                (F.col("at") + 1).alias("rank"),
                F.col("hit.id").alias("vec_id"),
                F.col("hit.score").alias("score"),
            )
        )
