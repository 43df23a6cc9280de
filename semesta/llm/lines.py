"""Line dedup by passages of lines.

A passage is a run of whole lines with at least ``PASSAGE`` words. It is found wherever it stands: from each
line that has words, the shortest run of that many words that begins there is a piece, and the shortest one
that ends there. All depend on the passage's own lines only, and the pieces inside a repeated passage
cover all of it, so every repeated passage is taken out whole, be it one long line or many short ones.

Shorter passages are found by content-defined chunks: a rolling hash over the last ``WINDOW`` line hashes ends
a chunk where it is divisible by ``DIVISOR``. Chunks of two lines or more and ``LEAST_WORDS`` words are
pieces too; of passages below ``PASSAGE`` words only whole chunks are found.

A piece that occurs more than once in all texts stays at its first place, in the order of (doc_id, nulls
first; row hash; position), and is taken out everywhere else, also later in the same text, but for lines it
shares with its own first place. Pieces overlap, so a first place may lose lines that another piece has
earlier; each line taken out stands in an earlier place of its piece, and by that order once stays. Counting
combines before the shuffle, so a piece in a third of all documents is one row a task. There are at most two
pieces a line, and the chunks.

Equal SHA-256 digests only name candidates: a piece is taken out after its bytes were compared with those of its
first place. Pieces of a text that overlap and lie equally far from their first places are compared as one span,
so what travels for it is about the text that is taken out, once, and the first places' own.

Null text stays null, empty text empty; a text all of whose lines are gone becomes empty, its row stays.
Rows equal in id and text are one document, kept as often as they come. Other columns pass; an empty table
gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semesta.llm.common import small_batches, stored

#: Lines that a boundary looks at, and one in how many places is a boundary.
WINDOW, DIVISOR = 2, 3
#: Words that make lines a passage, and a chunk long enough to be removed.
PASSAGE, LEAST_WORDS = 50, 10

_MASK, _BASE = (1 << 64) - 1, 0x9E3779B97F4A7C15
_ROW, _GONE = "__lines_row", "__lines_gone"


def chunks(text: str) -> list[tuple[int, int, int, int]]:
    """(start, end, lines, words) of each chunk, as code points; a chunk takes in its last line's end."""
    out: list[tuple[int, int, int, int]] = []
    start = at = lines = words = 0
    recent: list[int] = []
    for line in text.split("\n"):
        size = len(line.split())
        if size >= PASSAGE and lines:
            out.append((start, at, lines, words))
            start, lines, words = at, 0, 0
        at, lines, words = at + len(line) + 1, lines + 1, words + size
        recent = [*recent[1 - WINDOW :], xxhash.xxh64_intdigest(line.strip().encode("utf-8", "surrogatepass"))]
        rolling = 0
        for value in recent:
            rolling = (rolling * _BASE + value) & _MASK
        if size >= PASSAGE or (rolling >> 17) % DIVISOR == 0:
            out.append((start, at, lines, words))
            start, lines, words = at, 0, 0
    if lines:
        out.append((start, at, lines, words))
    return out


def removable(text: str) -> list[tuple[int, int]]:
    """Spans of the chunks that are long enough to be removed."""
    return [
        (start, end)
        for start, end, lines, words in chunks(text)
        if words >= LEAST_WORDS and (lines > 1 or words >= PASSAGE)
    ]


def passages(text: str) -> list[tuple[int, int]]:
    """Spans of the pieces that cover every passage, and of the chunks below them; they overlap.

    They begin and end with lines that have words, so the same text at the same place is one span.
    """
    own: list[tuple[int, int, int]] = []
    at = 0
    for line in text.split("\n"):
        if size := len(line.split()):
            own.append((at, at + len(line) + 1, size))
        at += len(line) + 1
    found: set[tuple[int, int]] = set()
    first = words = 0
    for _, end, size in own:
        words += size
        while words >= PASSAGE:
            found.add((own[first][0], end))
            words -= own[first][2]
            first += 1
        # Too few words are left from ``first`` on, and enough with the line before it.
        if first:
            found.add((own[first - 1][0], end))
    line = 0
    for _, end, count, size in chunks(text):
        begin = line
        while line < len(own) and own[line][0] < end:
            line += 1
        if LEAST_WORDS <= size < PASSAGE and count > 1:
            found.add((own[begin][0], own[line - 1][1]))
    return sorted(found)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same places as spans that don't overlap."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    rest = "".join([*kept, text[at:]])
    # The last line has no line end of its own.
    return rest[:-1] if at > len(text) and rest.endswith("\n") else rest


def _digest(piece: bytes) -> bytes:
    return hashlib.sha256(piece).digest()


def repeated_pieces(docs: DataFrame, key: str, text: str, pieces: Callable[[str], list[tuple[int, int]]]) -> DataFrame:
    """(doc_id, row, start, end) of every piece that also occurs earlier, byte for byte, without lines of that place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, spans, hashes = [], [], []
            for i, value in enumerate(batch.column(2)):
                whole = value.as_py() or ""
                for start, end in pieces(whole):
                    # What is compared begins and ends with text.
                    piece = whole[start:end].lstrip("\n")
                    at = min(end, len(whole)) - len(piece)
                    piece = piece.rstrip("\n")
                    ids.append(i)
                    spans.append((start, end, at, at + len(piece)))
                    hashes.append(_digest(piece.encode("utf-8", "surrogatepass")))
            rows = pa.array(ids, pa.int64())
            columns = [
                batch.column(0).take(rows),
                batch.column(1).take(rows),
                *(pa.array([each[k] for each in spans], pa.int32()) for k in range(4)),
                pa.array(hashes, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "start", "end", "at", "upto", "hash"])

    small_batches(docs.sparkSession)
    named = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("row"), F.col(text).alias("text"))
    kind = named.schema["doc_id"].dataType.simpleString()
    found = named.mapInArrow(run, f"doc_id {kind}, row bigint, start int, end int, at int, upto int, hash binary")
    place = F.struct("doc_id", "row", "start", "end", "at")
    counted = found.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    repeated = counted.filter(F.col("n") > 1).select("hash", "first")
    again = found.join(repeated, "hash").filter(place != F.col("first"))
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("row") == F.col("first.row"))
    after = F.when(same, F.greatest("start", "first.end")).otherwise(F.col("start"))
    candidates = again.select(
        "doc_id",
        "row",
        F.col("first.doc_id").alias("first_id"),
        F.col("first.row").alias("first_row"),
        (F.col("at") - F.col("first.at")).alias("shift"),
        F.struct("at", "upto", after.alias("start"), "end").alias("piece"),
    )
    return _equal_bytes(docs, key, text, candidates)


def _equal_bytes(docs: DataFrame, key: str, text: str, candidates: DataFrame) -> DataFrame:
    """Of the candidates those whose bytes, from ``at`` to ``upto``, stand ``shift`` before in the first place's text."""
    pairs = ["doc_id", "row", "first_id", "first_row", "shift"]
    grouped = candidates.groupBy(*pairs).agg(F.sort_array(F.collect_set("piece")).alias("pieces"))
    schema = T.StructType(
        [*grouped.schema.fields[:-1], T.StructField("at", T.IntegerType()), T.StructField("upto", T.IntegerType()), grouped.schema["pieces"]]
    )

    def spans_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, spans = [], []
            for i, given in enumerate(batch.column(len(pairs)).to_pylist()):
                begun = len(spans)
                for piece in given:
                    if len(spans) > begun and piece["at"] < spans[-1][1]:
                        at, upto, inside = spans[-1]
                        spans[-1] = (at, max(upto, piece["upto"]), [*inside, piece])
                    else:
                        owners.append(i)
                        spans.append((piece["at"], piece["upto"], [piece]))
            rows = pa.array(owners, pa.int64())
            columns = [
                *(column.take(rows) for column in batch.columns[: len(pairs)]),
                pa.array([at for at, _, _ in spans], pa.int32()),
                pa.array([upto for _, upto, _ in spans], pa.int32()),
                pa.array([inside for _, _, inside in spans], batch.column(len(pairs)).type),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    spans = stored(grouped.mapInArrow(spans_of, schema), "lines-candidates")

    spans = spans.select(
        F.col("doc_id").alias("own_id"), "row", "at", "pieces", "first_id", "first_row",
        (F.col("at") - F.col("shift")).alias("first_at"), (F.col("upto") - F.col("at")).alias("size"),
    )

    def with_text(places: DataFrame, owner: str, row: str, at: str, name: str) -> DataFrame:
        """The places with their text; all joins with the texts have one key, so that one shuffle of them can serve."""
        of = docs[key].eqNullSafe(places[owner]) & (F.xxhash64(docs[text]) == places[row])
        cut = F.substring(docs[text], places[at] + 1, places["size"])
        return places.join(docs, of).select(*(places[c] for c in places.columns), cut.alias(name))

    own = with_text(spans, "own_id", "row", "at", "own")
    place = ["first_id", "first_row", "first_at", "size"]
    firsts = with_text(spans.select(*place).distinct(), "first_id", "first_row", "first_at", "there")
    # A document that is there twice gives its text once.
    first = firsts.groupBy(*place).agg(F.min("there").alias("there")).select(*(F.col(c).alias(f"f_{c}") for c in place), "there")
    meet = F.col("first_id").eqNullSafe(F.col("f_first_id"))
    for c in place[1:]:
        meet &= F.col(c) == F.col(f"f_{c}")

    def piece_of(column: str, piece: Column) -> Column:
        return F.substring(F.col(column), piece["at"] - F.col("at") + 1, piece["upto"] - piece["at"])

    equal = F.when(F.col("own") == F.col("there"), F.col("pieces")).otherwise(
        F.filter("pieces", lambda piece: piece_of("own", piece) == piece_of("there", piece))
    )
    return own.join(first, meet).select(F.col("own_id").alias("doc_id"), "row", F.explode(equal).alias("piece")).select(
        "doc_id", "row", "piece.start", "piece.end"
    )


def dedup(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    removed: str | None = None,
    pieces: Callable[[str], list[tuple[int, int]]] = removable,
) -> DataFrame:
    """``docs`` with repeated pieces taken out of ``text``; ``removed`` names a column for the spans taken out.

    ``pieces`` says what is compared: chunks only, or ``passages``.
    """
    gone = repeated_pieces(docs, key, text, pieces)
    gone = gone.groupBy("doc_id", "row").agg(F.collect_set(F.struct("start", "end")).alias(_GONE))
    gone = gone.withColumnsRenamed({"doc_id": "__lines_id", "row": _ROW})
    matched = docs.join(
        gone, docs[key].eqNullSafe(gone["__lines_id"]) & (F.xxhash64(docs[text]) == gone[_ROW]), "left"
    ).select(*[docs[name] for name in docs.columns if name != removed], _GONE)
    at = matched.columns.index(text)
    spans = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([*matched.schema.fields[:-1], *([T.StructField(removed, spans)] if removed else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [merged([(x["start"], x["end"]) for x in each.as_py() or []]) for each in batch.column(_GONE)]
            texts = [
                value.as_py() if not spans else _without(value.as_py(), spans)
                for value, spans in zip(batch.column(at), lists, strict=True)
            ]
            columns = [pa.array(texts, pa.string()) if i == at else x for i, x in enumerate(batch.columns[:-1])]
            if removed:
                pairs = [[{"start": a, "end": b} for a, b in each] for each in lists]
                columns.append(pa.array(pairs, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return matched.mapInArrow(run, schema)
