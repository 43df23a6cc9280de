"""SimHash near-dedup: 64-bit fingerprints, exact links within a bit distance by vantage-point trees.

Fingerprint: a bit is 1 if it is set in over half of the XXH64 (seed 42) of a text's word shingles,
repeats included. Equal fingerprints are first reduced to one, so copies cost nothing further.

Links: a sample of at most ``SAMPLE`` fingerprints is split by vantage points into a tree, each time at the
median Hamming distance. A fingerprint belongs to the shard of its leaf; it also goes to the inner side
of each split whose boundary lies within the bit distance below it. By the triangle bound, of any two linked
fingerprints one meets the other in that one's own shard; which side it is follows from the first split
between them. Inside a shard the same splitting goes on in memory until the parts are small, and there
distances are computed exactly. A shard yields a spanning forest of its links, never all pairs, so dense
groups stay linear in output. The depth follows the number of fingerprints, so shards keep their size.

Null and empty texts have fingerprint 0 and link like any other. Rows of null id take part; a component's id
is the smallest id in it, null if it has none. Repeated rows stay. An empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semesta.llm.common import small_batches, stored, words_of
from semesta.llm.components import components

#: Fingerprints that the tree's vantage points and medians are taken from, at most.
SAMPLE = 1 << 16
#: Fingerprints a shard is meant to hold, and the largest part that is compared pair by pair.
SHARD, PART = 32_768, 1024
#: Share of a side's parent in it, own and overlapping: half, and over half as much again at three bits.
_SHRINK = 0.64


def fingerprint(words: list[bytes], shingle: int) -> int:
    """Signed 64-bit fingerprint of the words' shingles; fewer words than a shingle make one shingle."""
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(text, 42)]
    else:
        digest = xxhash.xxh64_intdigest
        ends, at = [], -1
        for word in words:
            at += len(word) + 1
            ends.append(at)
        starts = [0, *(end + 1 for end in ends)]
        hashes = [digest(text[a:b], 42) for a, b in zip(starts, ends[shingle - 1 :], strict=False)]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_bits = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) of every row."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.lit(0).cast("long").alias("row"))
    return fingerprints_of_rows(rows, shingle).drop("row")


def fingerprints_of_rows(rows: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, row, fp) of (doc_id, text, row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(words_of(value.as_py()), shingle) for value in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), fps], ["doc_id", "row", "fp"])

    small_batches(rows.sparkSession)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, row bigint, fp bigint")


class Tree:
    """Vantage points with their median distances, in heap order; a node without one is a leaf."""

    def __init__(self, sample: np.ndarray, depth: int, seed: int = 11):
        self.depth = depth
        self.points = np.zeros(1 << depth, np.uint64)
        self.medians = np.full(1 << depth, -1, np.int64)
        rng = np.random.default_rng(seed)
        todo = [(1, sample)]
        while todo:
            node, part = todo.pop()
            if node >> depth or len(part) < 2:
                continue
            point, median = vantage(part, rng)
            if median < 0:
                continue
            far = np.bitwise_count(part ^ point) > median
            self.points[node], self.medians[node] = point, median
            todo += [(2 * node, part[~far]), (2 * node + 1, part[far])]

    def shards(self, fps: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``fps``, leaf) for the own shard of each and those whose boundary it overlaps."""
        at, node = np.arange(len(fps)), np.ones(len(fps), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        for _ in range(self.depth):
            median = self.medians[node]
            leaf = median < 0
            done.append((at[leaf], node[leaf]))
            at, node, median = at[~leaf], node[~leaf], median[~leaf]
            distance = np.bitwise_count(fps[at] ^ self.points[node]).astype(np.int64)
            far = distance > median
            overlap = far & (distance <= median + reach)
            at, node = np.concatenate([at, at[overlap]]), np.concatenate([2 * node + far, 2 * node[overlap]])
        done.append((at, node))
        return np.concatenate([x for x, _ in done]), np.concatenate([x for _, x in done])


def vantage(part: np.ndarray, rng: np.random.Generator) -> tuple[np.uint64, int]:
    """The one of a few candidates whose distances spread most, with the median; -1 if nothing lies beyond it."""
    best, spread, median = part[0], -1.0, -1
    for point in part[rng.integers(len(part), size=min(5, len(part)))]:
        distance = np.bitwise_count(part[:4096] ^ point)
        middle = int(np.median(distance))
        if distance.std() > spread and (distance > middle).any():
            best, spread, median = point, float(distance.std()), middle
    return best, median


def forest(fps: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fingerprint, smaller one reached) that span all links within ``reach`` among ``fps``."""
    rng = np.random.default_rng(5)
    left, right = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    todo = [np.unique(fps)]
    while todo:
        part = todo.pop()
        if len(part) > PART:
            point, median = vantage(part, rng)
            distance = np.bitwise_count(part ^ point).astype(np.int64)
            inner = part[distance <= median + reach]
            if median >= 0 and len(inner) < 0.95 * len(part):
                todo += [inner, part[distance > median]]
                continue
        # Breadth first: what is reached leaves the rest, so a dense part takes few comparisons.
        rest = part
        while len(rest):
            queue, root, rest = [rest[0]], rest[0], rest[1:]
            reached = []
            while queue and len(rest):
                near = np.bitwise_count(rest ^ queue.pop()) <= reach
                if near.any():
                    found = rest[near]
                    queue.extend(found)
                    reached.append(found)
                    rest = rest[~near]
            if reached:
                right.append(np.concatenate(reached))
                left.append(np.full(len(right[-1]), root, np.uint64))
    return np.concatenate(left), np.concatenate(right)


def links(distinct: DataFrame, reach: int) -> DataFrame:
    """(u, v): fingerprint pairs that connect whatever links within ``reach`` bits connect. ``distinct``: (fp)."""
    count = distinct.count()
    depth = max(0, min(int(math.log2(SAMPLE)) - 3, math.ceil(math.log(max(count, 1) / SHARD) / -math.log(_SHRINK))))
    tree = None
    if depth:
        # The hash makes the sample the same however the rows are dealt out.
        share = min(1.0, 0.9 * SAMPLE / count)
        drawn = distinct.filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) < int(share * (1 << 20))).limit(SAMPLE)
        sample = np.sort(drawn.toPandas()["fp"].to_numpy(np.int64)).view(np.uint64)
        tree = Tree(sample, depth)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)).view(np.uint64)
            at, shard = tree.shards(fps, reach) if tree else (np.arange(len(fps)), np.ones(len(fps), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(fps[at].view(np.int64))], ["shard", "fp"])

    def connect(part: pd.DataFrame) -> pd.DataFrame:
        u, v = forest(part["fp"].to_numpy(np.int64).view(np.uint64), reach)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    placed = distinct.mapInArrow(place, "shard bigint, fp bigint")
    return placed.groupBy("shard").applyInPandas(connect, "u bigint, v bigint")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, reach: int = 3, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, fp, component_id) of every row."""
    prints = stored(fingerprints(docs, shingle, key, text), "fingerprints")
    classes = _classes(prints, reach)
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def _classes(prints: DataFrame, reach: int) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of (doc_id, fp)."""
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(distinct.select("fp"), reach))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(named, "root").select("fp", "root", "component_id")


def first_of_group(
    docs: DataFrame, shingle: int = 3, reach: int = 3, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, then of the smallest text hash.

    Rows without an id stay only where their whole component has none. Of rows equal in id and text one stays.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("row"))
    prints = stored(fingerprints_of_rows(rows, shingle), "fingerprints")
    classes = _classes(prints, reach)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    first = prints.groupBy("fp").agg(F.min(place).alias("place")).join(classes, "fp")
    kept = first.groupBy("root").agg(F.min("place").alias("place")).select(
        F.col("place.doc_id").alias("__first_id"), F.col("place.row").alias("__first_row")
    )
    same = docs[key].eqNullSafe(kept["__first_id"]) & F.xxhash64(docs[text]).eqNullSafe(kept["__first_row"])
    once = docs.join(kept, same, "left_semi")
    # Repeated rows of one id and text: any of them is the same.
    return once.dropDuplicates([key, text]) if _repeats(prints) else once


def _repeats(prints: DataFrame) -> bool:
    """Whether a row hash occurs twice under one id."""
    return bool(prints.groupBy("doc_id", "row").count().filter("count > 1").take(1))
