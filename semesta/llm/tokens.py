"""Token counts: texts are encoded in batches inside Arrow functions, and only the numbers of tokens leave them.

A batch given to the encoder holds about BATCH_BYTES, whatever number of texts that is: rows of an Arrow batch are cut
into runs of equal bytes. A text of more than PIECE code points is cut into pieces at safe boundaries, places that no
match of the pre-tokenizer and no added token goes across; the pieces' tokens add up to those of the whole text. So a
worker holds the tokens of one batch only, however long a text is. Only a run without any boundary (a word without
end) stays whole.

Between two boundaries next to each other lies a stretch, mostly a word with the space before it. Stretches repeat as words do, so
a worker has the library encode each one once, and adds up the numbers of tokens of a text's stretches. At most KNOWN
numbers are kept, and none of a stretch longer than SHORT.

Safe boundaries are known for byte-level pre-tokenizers with the usual pattern and no normalizer: before white space
or sentence punctuation that follows a letter or digit. Tokenizers of other kinds get their texts whole.

Null text counts as the empty one: no bytes, no tokens. Strings of special tokens inside texts are treated as the library
does by default. One row comes out for each row that goes in, so repeated rows and null ids stay; an empty table gives an
empty one. Only key and text are read, so other columns may have any name.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semesta.llm.common import whole

#: Bytes of text that are encoded at once.
BATCH_BYTES = 1 << 20
#: Code points from which on a text is cut.
PIECE = 1 << 16
#: Stretches of at most SHORT code points whose tokens a worker knows at once.
KNOWN, SHORT = 1 << 18, 64
#: Letters and digits (Latin, Cyrillic, kana, Han, Hangul) of which every version of Unicode says the same.
_WORD = "0-9A-Za-zÀ-ÖØ-öø-ɏЀ-ҁぁ-ゖァ-ヺ一-鿿가-힣"
#: White space and punctuation before which a text may be cut.
_BREAKS = " \t\n\r.,;:!?()、。，！：；？"


def _breaks(spec: dict) -> str:
    """Characters before which a text may be cut, for a tokenizer's JSON; none where no boundary is known."""
    pre = spec.get("pre_tokenizer") or {}
    added = spec.get("added_tokens") or []
    plain = (
        pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space", True)
        and spec.get("normalizer") is None
        and not any(token["lstrip"] or token["rstrip"] or token["single_word"] for token in added)
    )
    # No added token goes across a break that is not part of it.
    return "".join(c for c in _BREAKS if not any(c in token["content"] for token in added)) if plain else ""


def boundary(spec: dict) -> re.Pattern | None:
    """What ends at a safe boundary, for a tokenizer's JSON; None where none is known."""
    breaks = re.escape(_breaks(spec))
    return re.compile(f"[{_WORD}](?=[{breaks}])") if breaks else None


def stretch(spec: dict) -> re.Pattern | None:
    """What lies between safe boundaries next to each other; all matches together are the text."""
    breaks = re.escape(_breaks(spec))
    return re.compile(f"[{breaks}]*+[^{breaks}]*+(?:(?<![{_WORD}])[{breaks}]++[^{breaks}]*+)*+") if breaks else None


def pieces(text: str, limit: int, safe: re.Pattern | None) -> Iterator[str]:
    """``text`` in pieces of at most ``limit`` code points, longer ones only where no boundary is."""
    start = 0
    while safe and len(text) - start > limit:
        end = start + limit
        cut = None
        for width in (256, limit):
            for match in safe.finditer(text, max(start, end - width), end):
                cut = match.end()
            if cut is not None:
                break
        else:
            match = safe.search(text, end - 1)
            if match is None:
                break
            cut = match.end()
        yield text[start:cut]
        start = cut
    yield text[start:]


class Sums:
    """Sums of ``count`` over the parts of texts; a part that is met again is not counted again."""

    def __init__(self, count: Callable[[list[str]], list[int]]):
        self.count = count
        self.known: dict[str, int] = {}

    def __call__(self, texts: list[list[str]]) -> list[int]:
        known = self.known
        fresh = list(set().union(*texts).difference(known))
        known.update(zip(fresh, self.count(fresh)))
        sums = [sum(map(known.__getitem__, parts)) for parts in texts]
        for part in fresh:
            if len(part) > SHORT:
                del known[part]
        if len(known) > KNOWN:
            known.clear()
        return sums


def counts(
    docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", piece: int = PIECE, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row; ``tokenizer`` is the path of a tokenizers JSON file on the driver."""
    with open(tokenizer, encoding="utf-8") as file:
        content = file.read()
    spec = json.loads(content)
    safe, between = boundary(spec), stretch(spec)
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_str(shared.value)
        encoder.no_padding()
        encoder.no_truncation()
        summed = Sums(lambda parts: [len(found) for found in encoder.encode_batch_fast(parts, add_special_tokens=False)])
        for batch in batches:
            totals = [0] * batch.num_rows
            waiting: list[list[str]] = []
            owners: list[int] = []
            size = 0

            def flush() -> None:
                for owner, n in zip(owners, summed(waiting)):
                    totals[owner] += n
                waiting.clear()
                owners.clear()

            column, lengths = batch.column(2), batch.column(1).to_pylist()
            # Equal shares of the bytes, instead of full batches and a small rest.
            share = sum(lengths) / max(1, round(sum(lengths) / batch_bytes))
            for row in range(batch.num_rows):
                for part in pieces(column[row].as_py(), piece, safe):
                    waiting.append(between.findall(part) if between else [part])
                    owners.append(row)
                    size += len(part) if len(part) == lengths[row] else len(part.encode("utf-8", "surrogatepass"))
                    if size >= share:
                        flush()
                        size = 0
            flush()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(totals, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.octet_length(whole(F.col(text))).cast("long").alias("n_bytes"),
        whole(F.col(text)).alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
