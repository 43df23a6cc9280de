"""Interpolated modified Kneser-Ney language model, counted in Spark, scored from memory-mapped files.

Tokens are the lower-cased (A-Z) words of a text and one end, which is also the context of the first word.

Counting, three shuffles of sorted and compressed blocks, reduced in the tasks before they are sent:

1. words: a word's XXH64 and its count, dealt out by hash; a bucket's sorted hashes and counts are a file. A
   word's id is its bucket's offset plus its place.
2. pairs: (context id, word id) packed into 64 bits, dealt out by a mix of both, so that a frequent context
   is spread over all buckets; a bucket's sorted pairs are a file, with the counts beyond one beside them.
3. contexts: what the pair buckets know of a word as context (count; pairs seen once, twice, more often) and
   as continuation (contexts it follows), dealt out by the word's bucket, as files in the order of ids.

Only counts of counts reach the driver. Files lie in the folder that all executors share, written under
another name and renamed, so a task can be repeated. Workers map them into memory, look up the sorted,
distinct pairs of a batch bucket by bucket, and hold no table of their own; a file system that can't be mapped
is copied to the worker's own temporary folder first. The number of buckets follows the number of input
partitions, so files keep their size. Orders above two aren't built: see the README for the figures.

Null and empty texts are one token, the end. Rows without id are a fold like the empty id. Repeated rows count
as often as they come. With no training rows every probability is uniform over one unknown word. An
empty table gives an empty one. Other columns pass; ones of the added names are replaced.
"""

from __future__ import annotations

import os
import tempfile
import urllib.parse
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semesta.llm.common import scratch, small_batches, words_of

#: Tokens that a counting task holds at once; words after which a task's memory of them is emptied.
HELD, REMEMBERED = 3_000_000, 300_000
#: Least number of buckets.
BUCKETS = 64
#: The base model's pseudo-count.
ADDED = 0.1
#: Hash of the end token, which no word has but by chance of 64 bits.
END = 0

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_LOW = np.uint64(0xFFFFFFFF)


# Files and blocks -------------------------------------------------------------------------------------


def _local(path: str) -> str | None:
    parts = urllib.parse.urlparse(path)
    return urllib.parse.unquote(parts.path) if parts.scheme in ("", "file") else None


def _write(path: str, array: np.ndarray) -> None:
    """The array's bytes under ``path``, all or nothing."""
    part = f"{path}.{uuid.uuid4().hex}"
    if (local := _local(path)) is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        array.tofile(_local(part))
        os.replace(_local(part), local)
        return
    files, name = pyarrow.fs.FileSystem.from_uri(part)
    files.create_dir(os.path.dirname(name), recursive=True)
    with files.open_output_stream(name) as out:
        out.write(array.tobytes())
    files.move(name, pyarrow.fs.FileSystem.from_uri(path)[1])


def _mapped(path: str, kind: str) -> np.ndarray:
    """The file as an array; a bucket that got no rows has no file and is empty."""
    local = _local(path)
    if local is None:
        files, name = pyarrow.fs.FileSystem.from_uri(path)
        if files.get_file_info(name).type == pyarrow.fs.FileType.NotFound:
            return np.zeros(0, kind)
        with tempfile.NamedTemporaryFile() as copy, files.open_input_stream(name) as source:
            while block := source.read(1 << 24):
                copy.write(block)
            copy.flush()
            # The mapping outlives the name.
            return np.memmap(copy.name, kind, "r") if os.path.getsize(copy.name) else np.zeros(0, kind)
    return np.memmap(local, kind, "r") if os.path.exists(local) and os.path.getsize(local) else np.zeros(0, kind)


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of unsigned integers in one compressed block; a sorted first column as differences."""
    first = columns[0].astype(np.uint64)
    parts = [np.diff(first, prepend=np.uint64(0)), *(x.astype(np.uint64) for x in columns[1:])]
    raw = b"".join(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes() for x in parts)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def _unpacked(block: bytes, columns: int) -> list[np.ndarray]:
    raw = pa.Codec("zstd").decompress(block[8:], int.from_bytes(block[:8], "little"), asbytes=True)
    size = len(raw) // (8 * columns)
    out = []
    for k in range(columns):
        part = np.frombuffer(raw, np.uint8, 8 * size, 8 * size * k).reshape(8, size).T
        out.append(np.ascontiguousarray(part).view(np.uint64).ravel())
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def _summed(blocks: list[bytes], columns: int) -> list[np.ndarray]:
    """Blocks merged by their first column, the others added up."""
    parts = [_unpacked(block, columns) for block in blocks]
    keys = np.concatenate([p[0] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    sums = [np.concatenate([p[k] for p in parts])[order] for k in range(1, columns)]
    return [keys[starts], *(np.add.reduceat(x, starts) if len(starts) else x for x in sums)]


def _dealt(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(bucket, block) of columns sorted by the first."""
    order = np.argsort(bucket, kind="stable")
    found, starts = np.unique(bucket[order], return_index=True)
    for b, at in zip(found.tolist(), np.split(order, starts[1:]) if len(found) else [], strict=True):
        yield int(b), _packed(*(x[at] for x in columns))


def _blocks(found: Iterator[tuple[int, bytes]]) -> pa.RecordBatch:
    rows = list(found)
    columns = [pa.array([b for b, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "block"])


_BLOCKS = "bucket bigint, block binary"


def _word_bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _pair_bucket(pairs: np.ndarray, bits: int) -> np.ndarray:
    mixed = (pairs ^ (pairs >> np.uint64(31))) * _MIX
    return ((mixed ^ (mixed >> np.uint64(29))) * _MIX >> np.uint64(64 - bits)).astype(np.int64)


# The model --------------------------------------------------------------------------------------------


def discounts(n: list[int]) -> np.ndarray:
    """Discounts of counts 1, 2 and from 3 on, from the counts of counts 1 to 4; where one is missing, half the count."""
    out = np.array([0.5, 1.0, 1.5])
    if n[0] and n[1]:
        y = n[0] / (n[0] + 2 * n[1])
        for k in range(3):
            if n[k]:
                value = k + 1 - (k + 2) * y * n[k + 1] / n[k]
                if 0 < value <= k + 1:
                    out[k] = value
    return out


@dataclass
class Model:
    """Where the files are and the few numbers that belong to all words."""

    folder: str
    bits: int
    offsets: np.ndarray
    tokens: int = 0
    words: int = 0
    pairs: int = 0
    discount: np.ndarray = field(default_factory=lambda: np.array([0.5, 1.0, 1.5]))
    lower_discount: np.ndarray = field(default_factory=lambda: np.array([0.5, 1.0, 1.5]))
    lower_rest: float = 1.0

    def path(self, kind: str, bucket: int) -> str:
        return f"{self.folder}/{kind}/{bucket:05d}"


class Reader:
    """Lookups in the model's files, mapped when first needed."""

    def __init__(self, model: Model):
        self.model = model
        self._files: dict[tuple[str, int], np.ndarray] = {}
        self._known: dict[bytes, int] = {}

    def _file(self, kind: str, bucket: int, dtype: str) -> np.ndarray:
        key = (kind, bucket)
        if key not in self._files:
            self._files[key] = _mapped(self.model.path(kind, bucket), dtype)
        return self._files[key]

    def _by_bucket(self, bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(bucket, kind="stable")
        found, starts = np.unique(bucket[order], return_index=True)
        return zip(found.tolist(), np.split(order, starts[1:]) if len(found) else [], strict=True)

    def _ids_of(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of distinct sorted hashes, -1 for unknown words."""
        out = np.full(len(hashes), -1, np.int64)
        for b, at in self._by_bucket(_word_bucket(hashes, self.model.bits)):
            known = self._file("words", b, "<u8")
            place = np.searchsorted(known, hashes[at])
            hit = place < len(known)
            hit[hit] = known[place[hit]] == hashes[at][hit]
            out[at[hit]] = self.model.offsets[b] + place[hit]
        return out

    def ids(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all tokens, ends included; number of tokens of each text)."""
        if len(self._known) > REMEMBERED:
            self._known.clear()
        split = [words_of(text) for text in texts]
        new = list({word for words in split for word in words if word not in self._known})
        if new or b"" not in self._known:
            # No word is empty: its place is the end's.
            new.append(b"")
            hashes = np.array([xxhash.xxh64_intdigest(word) if word else END for word in new], np.uint64)
            order = np.argsort(hashes)
            for k, i in zip(order.tolist(), self._ids_of(hashes[order]).tolist(), strict=True):
                self._known[new[k]] = i
        known, end = self._known, self._known[b""]
        out: list[int] = []
        for words in split:
            out.extend([known[word] for word in words])
            out.append(end)
        return np.array(out, np.int64), np.array([len(words) + 1 for words in split], np.int64)

    def counts(self, kind: str, ids: np.ndarray, width: int) -> np.ndarray:
        """Rows of a file in id order; zeros for -1."""
        distinct, inverse = np.unique(ids, return_inverse=True)
        rows = np.zeros((len(distinct), width), np.int64)
        known = np.flatnonzero(distinct >= 0)
        bucket = np.searchsorted(self.model.offsets, distinct[known], side="right") - 1
        for b, at in self._by_bucket(bucket):
            values = self._file(kind, b, "<i8").reshape(-1, width)
            rows[known[at]] = values[distinct[known[at]] - self.model.offsets[b]]
        return rows[inverse]

    def pair_counts(self, pairs: np.ndarray) -> np.ndarray:
        distinct, inverse = np.unique(pairs, return_inverse=True)
        out = np.zeros(len(distinct), np.int64)
        for b, at in self._by_bucket(_pair_bucket(distinct, self.model.bits)):
            keys = self._file("pairs", b, "<u8")
            place = np.searchsorted(keys, distinct[at])
            hit = place < len(keys)
            hit[hit] = keys[place[hit]] == distinct[at][hit]
            count = np.ones(int(hit.sum()), np.int64)
            more = self._file("more", b, "<u8").reshape(-1, 2)
            again = np.searchsorted(more[:, 0], distinct[at][hit])
            several = again < len(more)
            several[several] = more[again[several], 0] == distinct[at][hit][several]
            count[several] = more[again[several], 1].astype(np.int64)
            out[at[hit]] = count
        return out[inverse]

    def log10(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(model's and base model's log10 probability, whether known) of each token."""
        m = self.model
        end = self._known[b""]
        before = np.concatenate([[end], ids[:-1]]) if len(ids) else ids
        before[np.cumsum(sizes)[:-1]] = end
        raw = self.counts("raw", ids, 1)[:, 0]
        base = np.log10((raw + ADDED) / (m.tokens + ADDED * (m.words + 1)))
        follows = self.counts("contexts", ids, 5)[:, 4]
        lower = m.lower_rest / (m.words + 1)
        if m.pairs:
            lower = lower + (follows - _discount(follows, m.lower_discount)) / m.pairs
        lower = np.broadcast_to(lower, ids.shape)
        context = self.counts("contexts", before, 5)
        total = np.maximum(context[:, 0], 1)
        both = (ids >= 0) & (context[:, 0] > 0)
        count = np.zeros(len(ids), np.int64)
        count[both] = self.pair_counts(before[both].astype(np.uint64) << np.uint64(32) | ids[both].astype(np.uint64))
        rest = context[:, 1:4] @ m.discount / total
        higher = (count - _discount(count, m.discount)) / total + rest * lower
        return np.log10(np.where(context[:, 0] > 0, higher, lower)), base, raw > 0


def _discount(count: np.ndarray, by: np.ndarray) -> np.ndarray:
    return np.concatenate([[0.0], by])[np.minimum(count, 3)]


def _count_words(bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        ends = 0

        def drain() -> pa.RecordBatch:
            hashes = np.array([END, *(xxhash.xxh64_intdigest(word) for word in seen)], np.uint64)
            counts = np.array([ends, *seen.values()], np.uint64)
            seen.clear()
            order = np.argsort(hashes)
            return _blocks(_dealt(_word_bucket(hashes[order], bits), hashes[order], counts[order]))

        for batch in batches:
            for value in batch.column(0):
                seen.update(words_of(value.as_py()))
                ends += 1
                if len(seen) > REMEMBERED:
                    yield drain()
                    ends = 0
        if seen or ends:
            yield drain()

    return run


def _count_pairs(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, held, size = Reader(model), [], 0

        def drain() -> pa.RecordBatch:
            pairs, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return _blocks(_dealt(_pair_bucket(pairs, model.bits), pairs, counts.astype(np.uint64)))

        for batch in batches:
            texts = batch.column(0)
            for i in range(0, len(texts), 500):
                ids, sizes = reader.ids(texts.slice(i, 500).to_pylist())
                before = np.concatenate([[0], ids[:-1]])
                before[np.concatenate([[0], np.cumsum(sizes)[:-1]])] = reader._known[b""]
                held.append(before.astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64))
                size += len(ids)
                if size > HELD:
                    yield drain()
                    size = 0
        if held:
            yield drain()

    return run


def train(docs: DataFrame, text: str = "text") -> Model:
    """Model of all texts of ``docs``."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(text))
    parts = texts.rdd.getNumPartitions()
    bits = max(BUCKETS, 2 * parts).bit_length() - 1
    folder = scratch(docs.sparkSession, "ngram")
    buckets = 1 << bits
    model = Model(folder, bits, np.zeros(buckets, np.int64))

    def keep_words(part: pd.DataFrame) -> pd.DataFrame:
        hashes, counts = _summed(list(part["block"]), 2)
        bucket = int(part["bucket"].iloc[0])
        _write(model.path("words", bucket), hashes.astype("<u8"))
        _write(model.path("raw", bucket), counts.astype("<i8"))
        return pd.DataFrame({"bucket": [bucket], "words": [len(hashes)], "tokens": [int(counts.sum())]})

    counted = texts.mapInArrow(_count_words(bits), _BLOCKS).groupBy("bucket")
    rows = counted.applyInPandas(keep_words, "bucket bigint, words bigint, tokens bigint").collect()
    sizes = np.zeros(buckets, np.int64)
    for row in rows:
        sizes[row["bucket"]] = row["words"]
    model.offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    model.words, model.tokens = int(sizes.sum()), sum(row["tokens"] for row in rows)

    def keep_pairs(part: pd.DataFrame) -> pd.DataFrame:
        pairs, counts = _summed(list(part["block"]), 2)
        bucket = int(part["bucket"].iloc[0])
        _write(model.path("pairs", bucket), pairs.astype("<u8"))
        several = counts > 1
        _write(model.path("more", bucket), np.stack([pairs[several], counts[several]], 1).astype("<u8"))
        ones = np.ones(len(pairs), np.uint64)
        context, word = pairs >> np.uint64(32), pairs & _LOW
        seen = [counts, counts == 1, counts == 2, counts > 2]
        out = []
        for ids, columns in ((context, [*seen, 0 * ones]), (word, [*(0 * ones,) * 4, ones])):
            order = np.argsort(ids, kind="stable")
            distinct, starts = np.unique(ids[order], return_index=True)
            sums = [np.add.reduceat(x[order].astype(np.uint64), starts) for x in columns]
            where = np.searchsorted(model.offsets, distinct.astype(np.int64), side="right") - 1
            out += _dealt(where, distinct, *sums)
        size = [int((counts == k).sum()) for k in range(1, 5)]
        # One more row has the bucket's counts of counts.
        out.append((-1, np.array(size, "<i8").tobytes()))
        return pd.DataFrame({"bucket": [b for b, _ in out], "block": [x for _, x in out]})

    def keep_contexts(part: pd.DataFrame) -> pd.DataFrame:
        bucket = int(part["bucket"].iloc[0])
        if bucket < 0:
            found = np.sum([np.frombuffer(x, "<i8") for x in part["block"]], axis=0)
            return pd.DataFrame([[0, *found.tolist(), 0, 0]], columns=["kind", "n1", "n2", "n3", "n4", "more", "all"])
        ids, *sums = _summed(list(part["block"]), 6)
        rows = np.zeros((int(sizes[bucket]), 5), "<i8")
        rows[ids.astype(np.int64) - model.offsets[bucket]] = np.stack(sums, 1).astype("<i8")
        _write(model.path("contexts", bucket), rows)
        follows = rows[:, 4]
        n = [int((follows == k).sum()) for k in range(1, 5)]
        return pd.DataFrame(
            [[1, *n, int((follows > 2).sum()), int(follows.sum())]],
            columns=["kind", "n1", "n2", "n3", "n4", "more", "all"],
        )

    pairs = texts.mapInArrow(_count_pairs(model), _BLOCKS).groupBy("bucket").applyInPandas(keep_pairs, _BLOCKS)
    kinds = ", ".join(f"{name} bigint" for name in ("kind", "n1", "n2", "n3", "n4", "more", "all"))
    stats = pairs.groupBy("bucket").applyInPandas(keep_contexts, kinds).groupBy("kind").sum()
    names = ["n1", "n2", "n3", "n4", "more", "all"]
    found = {row["kind"]: [row[f"sum({name})"] for name in names] for row in stats.collect()}
    if 0 in found and 1 in found:
        model.discount = discounts(found[0][:4])
        model.lower_discount = discounts(found[1][:4])
        n1, n2, _, _, more, model.pairs = found[1]
        model.lower_rest = float(np.array([n1, n2, more]) @ model.lower_discount / model.pairs)
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, n_known, train_tokens, base_score, score and perplexity of each text."""
    added = {
        "n_tokens": T.LongType(),
        "n_known": T.LongType(),
        "train_tokens": T.LongType(),
        "base_score": T.DoubleType(),
        "score": T.DoubleType(),
        "perplexity": T.DoubleType(),
    }
    small_batches(docs.sparkSession)
    kept = docs.drop(*added)
    at = kept.columns.index(text)
    schema = T.StructType([*kept.schema.fields, *(T.StructField(name, kind) for name, kind in added.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for whole in batches:
            for i in range(0, whole.num_rows, 1000):
                batch = whole.slice(i, 1000)
                ids, sizes = reader.ids(batch.column(at).to_pylist())
                starts = np.cumsum(sizes) - sizes
                log, base, known = reader.log10(ids, sizes)
                total = np.add.reduceat(log, starts)
                columns = [
                    sizes,
                    np.add.reduceat(known.astype(np.int64), starts),
                    np.full(len(sizes), model.tokens),
                    np.add.reduceat(base, starts),
                    total,
                    10 ** np.minimum(-total / sizes, 300),
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, columns)], schema.names)

    return kept.mapInArrow(run, schema)
