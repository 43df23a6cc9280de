"""Byte-level BPE: encoding by ranked merges folded in Spark expressions, decoding by joining pieces.

1. A text is cut by the vocabulary's pattern into words; words are counted over all texts and the
   ``frequent`` most frequent ones (a fixed bound, each of at most ``LONGEST`` bytes) are taken.
2. ``merged`` encodes a word: its bytes are an array of token ids and ``aggregate`` folds the merges over it.
   Each step joins the pair of lowest rank, leftmost first, and looks up only the two pairs that this
   changes. The rank map is a literal of the plan, a perfect hash from pairs of ids to the joined id.
3. The frequent words are stored, merged once and sent to the tasks. Every other word is merged beside the first
   document of a partition that has it; its ids are kept until ``REMEMBERED`` words are. So no text is
   shuffled, and a hot word or source costs nothing extra.
4. A task reads a text twice: to count its words, and to number them. The numbers go on as one binary value per
   text, and the ids are gathered from arrays by them, so no second dictionary of words is held.
5. Decoding joins the pieces of the ids, as characters U+0000 to U+00FF that stand for bytes.

Null text counts as empty: no ids, empty bytes. Repeated rows stay repeated rows. Other columns pass
unchanged; a column of the name asked for is replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semesta.llm.common import small_batches, stored

#: Words that are merged once for all documents.
FREQUENT = 262_144
#: Bytes of the longest word kept as a frequent one.
LONGEST = 64
#: Entries after which a task hands on its counts, and after which its memory of words is emptied.
COUNTED, REMEMBERED = 200_000, 60_000
#: Words whose ids are gathered at once.
GATHERED = 500_000
#: Characters of a plan's description: it would repeat the literals, and the driver keeps descriptions.
PLAN_TEXT = 200_000

#: Where a cell's rank begins, and the bits of its place.
_RANK, _PLACES = 47, ((1 << 31) - 1) << 16

_TAIL, _TAIL_IDS, _CODES, _BASE = "__bpe_tail", "__bpe_tail_ids", "__bpe_codes", "__bpe_base"


def read_ranks(path: str) -> dict[str, int]:
    """Rank file (base64 token, rank) as byte text to rank."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token).decode("latin-1"): int(rank) for token, rank in pairs}


class Lookup:
    """A literal map from byte text to int, as an array of small maps: one array access and one crc32 a key.

    A map is searched entry by entry, hence the array. An expression should name ``maps`` once, as
    each naming puts a literal of about a megabyte into the plan.
    """

    def __init__(self, items: Iterable[tuple[str, int]]):
        items = list(items)
        self.size = 1 << max(1, (2 * len(items)).bit_length() - 1)
        buckets: list[dict[str, int]] = [{} for _ in range(self.size)]
        for key, value in items:
            buckets[zlib.crc32(key.encode()) % self.size][key] = value
        self.maps = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")

    def find(self, maps: Column, key: Column) -> Column:
        return F.get(maps, (F.crc32(key.cast("binary")) % self.size).cast("int"))[key]


class Pairs:
    """A literal map from pairs of ids to the id of the joined token: a perfect hash, so a look-up is one array access each
    in two arrays of numbers.

    A pair is one number, its group that number modulo ``groups``, its place the number plus its group's shift modulo
    ``size``. Numbers that agree in both modules are equal, as the modules have no common divisor and a larger product.
    """

    BITS = 16
    #: An id that no token has.
    EDGE = (1 << BITS) - 1

    def __init__(self, ranks: dict[str, int]):
        if max(ranks.values()) >= self.EDGE:
            raise ValueError(f"ids of more than {self.BITS} bits")
        joined: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    joined[left << self.BITS | right] = rank
        #: Tokens that merging their bytes does not lead to: only as whole words do they stand.
        self.apart = [(token, rank) for token, rank in ranks.items() if _merge(token, ranks, joined, self.BITS) != [rank]]
        self.size = _prime(int(1.5 * len(joined)) + 7)
        self.groups = _prime(self.size // 3)
        while self.size * self.groups >> (2 * self.BITS) == 0:
            self.size, self.groups = _prime(2 * self.size), _prime(2 * self.groups)
        grouped: dict[int, list[int]] = {}
        for pair in joined:
            grouped.setdefault(pair % self.groups, []).append(pair)
        shifts, table = [0] * self.groups, [-1] * self.size
        for group, members in sorted(grouped.items(), key=lambda g: (-len(g[1]), g[0])):
            shift = 0
            while any(table[(pair + shift) % self.size] >= 0 for pair in members):
                shift += 1
            shifts[group] = shift
            for pair in members:
                table[(pair + shift) % self.size] = pair << self.BITS | joined[pair]
        self.literal = F.from_json(F.lit(json.dumps({"shifts": shifts, "table": table})), "shifts array<int>, table array<bigint>")

    def find(self, literal: Column, left: Column, right: Column) -> Column:
        """Id of the joined token, as a bigint; EDGE if there is none."""

        def found(pair: Column) -> Column:
            shift = F.get(literal["shifts"], (pair % self.groups).cast("int"))
            entry = F.get(literal["table"], ((pair + shift) % self.size).cast("int"))
            # The entry of another pair is off by more than an id.
            return F.least(F.pmod(entry - pair * (1 << self.BITS), F.lit(1 << 50)), F.lit(self.EDGE))

        return let(left * (1 << self.BITS) + right, found)


def _merge(token: str, ranks: dict[str, int], joined: dict[int, int], bits: int) -> list[int]:
    """Ids of a token's bytes after all merges."""
    ids = [ranks[byte] for byte in token]
    while len(ids) > 1:
        pairs = [joined.get(left << bits | right, -1) for left, right in zip(ids, ids[1:])]
        lowest = min((rank for rank in pairs if rank >= 0), default=-1)
        if lowest < 0:
            break
        at = pairs.index(lowest)
        ids[at : at + 2] = [lowest]
    return ids


def _prime(least: int) -> int:
    """The first prime from ``least`` on."""
    while least < 2 or any(least % d == 0 for d in range(2, int(least**0.5) + 1)):
        least += 1
    return least


def let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def byte_text(word: Column) -> Column:
    return F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")


class ByteBPE:
    def __init__(self, ranks: dict[str, int], pattern: str):
        self._pattern = pattern
        self._pairs = Pairs(ranks)
        self._apart = Lookup(self._pairs.apart) if self._pairs.apart else None
        self._bytes = F.array(*(F.lit(ranks[chr(byte)]).cast("bigint") for byte in range(256)))
        pieces = [""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            pieces[rank] = token
        self._pieces = F.from_json(F.lit(json.dumps(pieces)), "array<string>")

    def merged(self, words: Column) -> Column:
        """Ids of each word of an array."""

        def each(pairs: Column, maps: Column | None) -> Column:
            return F.transform(words, lambda word: self._merged(pairs, maps, byte_text(word)))

        if self._apart is None:
            return let(self._pairs.literal, lambda pairs: each(pairs, None))
        return let(self._pairs.literal, lambda pairs: let(self._apart.maps, lambda maps: each(pairs, maps)))

    def _merged(self, pairs: Column, maps: Column | None, word: Column) -> Column:
        def rank_of(left: Column, right: Column) -> Column:
            return self._pairs.find(pairs, left, right)

        # A cell is one number: the id that its pair joins to, the place of its first letter, its own id. So the least cell
        # is the leftmost pair of lowest rank, and no two are equal. The cells stand between two edges, so every pair
        # has a neighbour on either side.
        def id_of(cell: Column) -> Column:
            return cell.bitwiseAND(F.lit(Pairs.EDGE))

        def step(cells: Column, _: Column) -> Column:
            def join(low: Column) -> Column:
                def around(at: Column) -> Column:
                    joined = F.shiftright(low, _RANK)
                    before = F.get(cells, at - 2)
                    pair = F.array(
                        rank_of(id_of(before), joined) * (1 << _RANK) + before.bitwiseAND(F.lit((1 << _RANK) - 1)),
                        rank_of(joined, id_of(F.get(cells, at + 1))) * (1 << _RANK) + low.bitwiseAND(F.lit(_PLACES)) + joined,
                    )
                    return F.concat(F.slice(cells, F.lit(1), at - 2), pair, F.slice(cells, at + 2, F.size(cells)))

                return let(F.array_position(cells, low).cast("int"), around)

            return let(F.array_min(cells), lambda low: F.when(low >= Pairs.EDGE << _RANK, cells).otherwise(join(low)))

        def fold(ids: Column) -> Column:
            after = F.concat(F.slice(ids, F.lit(2), F.size(ids)), F.array(F.lit(Pairs.EDGE).cast("bigint")))
            ranks = F.zip_with(ids, after, lambda left, right: rank_of(left, right) * (1 << _RANK) + left)
            return F.aggregate(
                F.slice(ids, F.lit(4), F.size(ids)),
                F.transform(ranks, lambda cell, place: cell + place.cast("bigint") * (1 << Pairs.BITS)),
                step,
                lambda cells: F.transform(F.slice(cells, F.lit(2), F.size(cells) - 2), lambda cell: id_of(cell).cast("int")),
            )

        edge = F.array(F.lit(Pairs.EDGE).cast("bigint"))
        letters = F.concat(edge, F.transform(F.split(word, ""), lambda letter: F.get(self._bytes, F.ascii(letter))), edge)
        if maps is None:
            return let(letters, fold)
        whole = let(self._apart.find(maps, word), lambda rank: F.when(rank.isNotNull(), F.array(rank)))
        return F.coalesce(whole, let(letters, fold))

    def word_counts(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """Every word of all texts with its count: (word, n)."""
        pattern = self._pattern

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            split, seen = regex.compile(pattern).findall, Counter()

            def drain() -> pa.RecordBatch:
                counted = pa.RecordBatch.from_arrays(
                    [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"]
                )
                seen.clear()
                return counted

            for batch in batches:
                for value in batch.column(0):
                    seen.update(split(value.as_py() or ""))
                    if len(seen) > COUNTED:
                        yield drain()
            yield drain()

        parts = docs.select(F.col(text)).mapInArrow(count, "word string, n bigint")
        return parts.groupBy("word").agg(F.sum("n").alias("n"))

    def frequent(self, docs: DataFrame, text: str, most: int) -> bytes:
        """The ``most`` most frequent words with their ids, as an Arrow stream; ties by the word."""
        counts = self.word_counts(docs, text).filter(F.octet_length("word") <= LONGEST)
        top = counts.orderBy(F.desc("n"), "word").limit(most).select("word")
        # The sort leaves one partition; merging is dealt out again. The words are stored for it, as a plan with the rank
        # map is described again, all entries of it, after each of its stages.
        dealt = top.repartition(docs.sparkSession.sparkContext.defaultParallelism * 2, "word")
        merged = stored(dealt, "frequent").select("word", F.get(self.merged(F.array("word")), F.lit(0)).alias("ids")).toArrow()
        # The driver holds columns, never a dictionary of so many words.
        stream = pa.BufferOutputStream()
        with pa.ipc.new_stream(stream, merged.schema) as out:
            out.write_table(merged, max_chunksize=10_000)
        return stream.getvalue().to_pybytes()

    def encode(
        self, docs: DataFrame, text: str = "text", ids: str = "ids", frequent: int = FREQUENT, *,
        packed: str | None = None, keep_text: bool = True,
    ) -> DataFrame:
        """``docs`` with the column ``ids``: array of token ids of the whole text.

        ``packed`` names another column with the ids as little-endian unsigned 32-bit integers; the text can be left out.
        """
        small_batches(docs.sparkSession)
        short_plans(docs.sparkSession)
        kept = docs.drop(ids, *([packed] if packed else []))
        sent = docs.sparkSession.sparkContext.broadcast(self.frequent(docs, text, frequent))
        pattern, at = self._pattern, kept.columns.index(text)
        out = [i for i in range(len(kept.columns)) if keep_text or i != at]
        fields = [kept.schema.fields[i] for i in out]
        numbered = [
            *fields, T.StructField(_TAIL, T.ArrayType(T.StringType())), T.StructField(_CODES, T.BinaryType()),
            T.StructField(_BASE, T.LongType()),
        ]
        with_ids = [*fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]
        if packed:
            with_ids.append(T.StructField(packed, T.BinaryType()))

        def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Numbers of each text's words: a frequent one's place, or minus its place among the others, less one."""
            split, known = regex.compile(pattern).findall, word_places(sent.value)
            told: dict[str, int] = {}
            count = base = 0
            for batch in batches:
                tails, codes, bases = [], [], []
                for value in batch.column(at):
                    if len(told) > REMEMBERED:
                        # Whoever gathers forgets them, too: no later text refers to a place before ``base``.
                        told.clear()
                        base = count
                    words = split(value.as_py() or "")
                    row = [known.get(word) for word in words]
                    new = []
                    if None in row:
                        for i, code in enumerate(row):
                            if code is None:
                                code = told.get(words[i])
                                if code is None:
                                    count += 1
                                    code = told[words[i]] = -count
                                    new.append(words[i])
                                row[i] = code
                    tails.append(new)
                    codes.append(np.array(row, "<i4").tobytes())
                    bases.append(base)
                columns = [pa.array(tails, pa.list_(pa.string())), pa.array(codes, pa.binary()), pa.array(bases, pa.int64())]
                yield _with(batch.select(out), [_TAIL, _CODES, _BASE], columns)

        def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            values, ends = word_ids(sent.value)
            frequent_words = len(ends) - 1
            # Ids of the other words from place ``first`` on.
            others, other_ends, first = np.zeros(0, np.int32), np.zeros(1, np.int64), 0
            for batch in batches:
                _, codes, bases, merged = batch.columns[len(out) :]
                if batch.num_rows == 0:
                    continue
                forget = bases[0].as_py() - first
                if forget > 0:
                    others, first = others[other_ends[forget] :], first + forget
                    other_ends = other_ends[forget:] - other_ends[forget]
                new_values, new_ends = _flat(merged)
                other_ends = np.concatenate([other_ends, other_ends[-1] + new_ends[1:]])
                others = np.concatenate([others, new_values])
                table = np.concatenate([values, others])
                starts = np.concatenate([ends[:-1], ends[-1] + other_ends])
                sizes = np.diff(starts)
                words = np.array([len(code) // 4 for code in codes.to_pylist()])
                for rows in _chunks(words, GATHERED):
                    part = batch.slice(rows.start, len(rows))
                    word = np.frombuffer(b"".join(codes.slice(rows.start, len(rows)).to_pylist()), "<i4").astype(np.int64)
                    word = np.where(word >= 0, word, frequent_words - 1 - word - first)
                    size = sizes[word]
                    row_ends = np.concatenate([[0], np.cumsum(size)])
                    found = table[np.repeat(starts[word] - row_ends[:-1], size) + np.arange(row_ends[-1])].astype("<i4")
                    bounds = row_ends[np.concatenate([[0], np.cumsum(words[rows.start : rows.stop])])]
                    columns = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(found))]
                    if packed:
                        columns.append(pa.array([found[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()))
                    yield _with(part.select(range(len(out))), [ids, packed][: len(columns)], columns)

        tailed = kept.mapInArrow(number, T.StructType(numbered))
        merged = tailed.withColumn(_TAIL_IDS, self.merged(F.col(_TAIL)))
        return merged.mapInArrow(gather, T.StructType(with_ids))

    def decode(self, ids: Column) -> Column:
        """Bytes of an array of ids: their pieces, put together; null stays null."""
        joined = let(self._pieces, lambda pieces: F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), ""))
        return F.encode(joined, "ISO-8859-1")


@F.pandas_udf(T.BinaryType())
def little_endian(column: pd.Series) -> pd.Series:
    """Ids as little-endian unsigned 32-bit integers; null stays null."""
    return column.map(lambda each: None if each is None else np.asarray(each, "<u4").tobytes())


def word_places(stream: bytes) -> dict[str, int]:
    """Words of an Arrow stream with their places."""
    words = (word for part in pa.ipc.open_stream(stream) for word in part.column(0).to_pylist())
    return {word: place for place, word in enumerate(words)}


def word_ids(stream: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words of an Arrow stream one after the other, and where each word's begin; the end last."""
    parts = [_flat(part.column(1)) for part in pa.ipc.open_stream(stream)]
    sizes = [np.diff(ends) for _, ends in parts]
    values = [values for values, _ in parts]
    none = np.zeros(0, np.int64)
    return np.concatenate([none.astype(np.int32), *values]), np.concatenate([[0], np.cumsum(np.concatenate([none, *sizes]))])


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of an array of lists, or of lists of lists, and where the innermost lists begin."""
    while pa.types.is_list(lists.type.value_type):
        lists = lists.flatten()
    ends = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32), ends - ends[0]


def _chunks(sizes: np.ndarray, limit: int) -> Iterator[range]:
    """Rows in runs of at most ``limit``, or single rows of more."""
    first, total = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > first and total + size > limit:
            yield range(first, row)
            first, total = row, 0
        total += size
    yield range(first, len(sizes))


def short_plans(spark: SparkSession) -> None:
    """Let the session describe plans in at most PLAN_TEXT characters."""
    spark.conf.set("spark.sql.maxPlanStringLength", PLAN_TEXT)


def _with(batch: pa.RecordBatch, names: list[str], columns: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])
