"""Benchmark decontamination by templates.

A text's words, without the punctuation around them, become template tokens: numbers, units of measure and
names (capitalised words that don't begin a sentence) become typed placeholders, all others stand
lower-cased. Names in a row are one token, and so are a number and its unit, in one word or two. Windows of ``WINDOW`` tokens are hash-joined with the benchmark's; an item of fewer tokens is
one window of its own length, from ``SHORTEST`` tokens on. A window counts if half its tokens are literal. An item
without such a window is matched by windows of its own words; an item of one word by texts that are that
word. As a capitalised word may begin an item anywhere in a text, after a line break or a quote, it is also
tried as a plain word where a window begins with it.

Matches of a text and an item at the same offset, or at offsets up to ``SHIFT`` apart, are one alignment. It is a leak if it covers at least
``SHARE`` of the item's windows and its slots are consistent: each value of the item stands for one value of
the text throughout, and the other way round. So a question with other numbers or names is found, while
windows that agree by chance are not. A window that n items hold counts as 1/n of one: an instruction that many
items begin with says little about any of them. Pairs of a text and an item come from the item's heaviest windows,
of which any leak holds one.

Words and windows that no benchmark window can equal are left out by Bloom filters of fixed size before the join;
the join itself compares the templates. It follows that only few rows are shuffled, whatever the sizes.
Groups are alignments, at most as long as an item, so a passage in a third of all texts is no hot group
but for the join, where Spark splits it or sends the small side out, by its size.

Null or empty texts leak nothing; null items hold nothing. Rows equal in id and text are found together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from semesta.llm.common import small_batches, stored

#: Tokens of a window; tokens that an item needs; share of an item's windows that make a leak.
WINDOW, SHORTEST, SHARE = 8, 4, 0.5
#: Tokens by which the offsets of one copy may differ, as words are put in or left out.
SHIFT = 4
#: Weight of a window that one item holds.
WEIGHT = 1 << 20
#: Bits of the Bloom filter (2 MB).
BLOOM_BITS = 1 << 24
#: Words after which a task's memory of them is emptied.
REMEMBERED = 200_000
#: Codes of the words that no benchmark window holds: without and with a sentence's end.
OTHER, OTHER_ENDS = 1, 2

# Units of measure.
UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg t lb oz ml l s sec min h hr hrs hour hours minute minutes second seconds day days"
    " week weeks month months year years meter meters metre metres kilometer kilometers kilometre kilometres mile miles"
    " inch inches foot feet yard yards gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres"
    " dollar dollars euro euros cent cents percent hz khz mhz ghz w kw kwh v j kj cal kcal °c °f $ € £ ¥ %".split()
)
NUMBER, UNIT, NAME = "<num>", "<unit>", "<name>"

_KIND = {NUMBER: 1, UNIT: 2, NAME: 3}

_AROUND = re.compile(r"^[^\w$€£¥%°]+|[^\w$€£¥%°]+$")
_NUMBER = re.compile(r"[$€£¥+-]?\d[\d.,:/]*(?:%|[a-zA-Z]{1,3})?")
_ENDS = re.compile(r"[.!?:]\W*$")
_EXACT = 0x9E3779B97F4A7C15
_WEIGHTS = np.array([xxhash.xxh64_intdigest(bytes([k]), 1) | 1 for k in range(WINDOW)], np.uint64)


def _hash(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"), 3)


def _mix(mixed: np.ndarray) -> np.ndarray:
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return mixed


def _without(codes: np.ndarray, size: int) -> np.ndarray:
    """Whether each window of ``size`` codes holds no word that is in no benchmark window."""
    others = np.concatenate([[0], np.cumsum(codes <= OTHER_ENDS)])
    return others[size:] == others[:-size] if len(codes) >= size else np.zeros(0, bool)


class Templates:
    """Template tokens of texts; words met before are remembered."""

    def __init__(self, vocabulary: bytes | None = None):
        #: Bloom filter of the words that a benchmark window can hold; without it all words are told apart.
        self._vocabulary = vocabulary
        self._codes: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        self._codes.clear()
        # By code: token if it begins a sentence or not, value; code 0 is no token.
        self.first, self.inner, self.value = ["", "?", "?"], ["", "?", "?"], ["", "?", "?"]
        # The same as arrays: hashes of both tokens, whether they are literal, whether it is one, ends one; its kind; the hash
        # of the word itself.
        self._arrays = [np.zeros(1 << 12, kind) for kind in (np.uint64, np.uint64, bool, bool, bool, bool, np.int8, np.uint64)]
        for flag in self._arrays[2:5]:
            flag[OTHER] = flag[OTHER_ENDS] = True
        self._arrays[5][OTHER_ENDS] = True

    def _learn(self, word: str) -> int:
        if word.islower() and word.isalpha() and word not in UNITS:
            # Most words: nothing around them, a plain token wherever they stand.
            if self._unheard(word):
                self._codes[word] = OTHER
                return OTHER
            h = _hash(word)
            return self._enter(word, word, word, word, (h, h, True, True, True, False, 0, h))
        bare = _AROUND.sub("", word)
        ends = bool(_ENDS.search(word))
        if bare or ends:
            lower = bare.lower()
            if not bare:
                first = inner = ""
            elif _NUMBER.fullmatch(bare):
                first = inner = NUMBER
            elif lower in UNITS and not (len(bare) == 1 and bare.isupper()):
                first = inner = UNIT
            else:
                first = lower
                inner = NAME if bare[0].isupper() and not bare[1:].isupper() else lower
                if inner is lower and self._unheard(lower):
                    code = self._codes[word] = OTHER_ENDS if ends else OTHER
                    return code
            entry = (_hash(first), _hash(inner), first[:1] != "<", inner[:1] != "<", first != "", ends, _KIND.get(inner, 0), _hash(lower))
            return self._enter(word, first, inner, lower, entry)
        self._codes[word] = 0
        return 0

    def _unheard(self, token: str) -> bool:
        """Whether no benchmark window can hold this token."""
        if self._vocabulary is None:
            return False
        bit = xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"), 42) % BLOOM_BITS
        return not self._vocabulary[bit >> 3] >> (bit & 7) & 1

    def _enter(self, word: str, first: str, inner: str, lower: str, entry: tuple) -> int:
        code = len(self.first)
        self.first.append(first)
        self.inner.append(inner)
        self.value.append(lower)
        if code == len(self._arrays[0]):
            self._arrays = [np.concatenate([x, np.zeros_like(x)]) for x in self._arrays]
        for array, value in zip(self._arrays, entry, strict=True):
            array[code] = value
        self._codes[word] = code
        return code

    def read(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(code, whether it begins a sentence) of the text's words; (first word, its sentence begin) of its tokens.

        Names in a row, and a number and its unit, are one token.
        """
        if len(self._codes) > REMEMBERED:
            self._clear()
        known, learn = self._codes.get, self._learn
        codes = np.array(
            [code if (code := known(word)) is not None else learn(word) for word in text.split()], np.int64
        )
        codes = codes[codes > 0]
        if not len(codes):
            return codes, np.zeros(0, bool), codes, np.zeros(0, bool)
        begins = np.concatenate([[True], self._arrays[5][codes[:-1]]])
        token = self._arrays[4][codes]
        # Punctuation alone ends a sentence for the word after it, but is no token.
        codes, begins = codes[token], begins[token]
        kind = self._arrays[6][codes]
        if not kind.any():
            return codes, begins, np.arange(len(codes)), begins
        name = (kind == 3) & ~begins
        goes_on = (name[1:] & name[:-1]) | ((kind[1:] == 2) & (kind[:-1] == 1))
        starts = np.flatnonzero(np.concatenate([[True], ~goes_on])[: len(codes)])
        return codes, begins, starts, begins[starts]

    def windows(self, codes: np.ndarray, begins: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, whether half the tokens are literal and none is a word of no benchmark window) of each window of ``size`` tokens."""
        count = len(codes) - size + 1
        if count < 1:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        fits = _without(codes, size)
        if not fits.any():
            return np.zeros(count, np.uint64), fits
        first, inner, first_literal, inner_literal = self._arrays[:4]
        token = np.where(begins, first[codes], inner[codes])
        literal = np.concatenate([[0], np.cumsum(np.where(begins, first_literal[codes], inner_literal[codes]))])
        mixed = np.zeros(count, np.uint64)
        for k in range(size):
            mixed += token[k : k + count] * _WEIGHTS[k]
        return _mix(mixed), fits & (2 * (literal[size:] - literal[:-size]) >= size)

    def exact(self, codes: np.ndarray, size: int) -> np.ndarray:
        """Hash of the words themselves of each window of ``size`` words; one word counts as a whole text only."""
        count = len(codes) - size + 1
        if count < 1 or (size == 1 and count > 1) or not _without(codes, size).any():
            return np.zeros(0, np.uint64)
        word = self._arrays[7][codes]
        mixed = np.full(count, _EXACT, np.uint64)
        for k in range(size):
            mixed += word[k : k + count] * _WEIGHTS[k]
        return _mix(mixed)

    def begun(
        self, words: np.ndarray, starts: np.ndarray, begins: np.ndarray, size: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word, next token, hash, whether half literal) of each window that begins with a name read as a plain word."""
        codes = words[starts]
        first, inner, first_literal, inner_literal, _, _, kind, own = self._arrays
        name = (kind[codes] == 3) & ~begins
        if not name.any() or (size > 1 and not _without(codes, size - 1).any()):
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0, np.uint64), np.zeros(0, bool)
        token = np.where(begins, first[codes], inner[codes])
        literal = np.concatenate([[0], np.cumsum(np.where(begins, first_literal[codes], inner_literal[codes]))])
        group = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(words)))
        last = np.append(starts[1:], len(words))[group] - 1
        word = np.flatnonzero(name[group])
        # What is left of the names in a row is a token behind it.
        after = group[word] + (word == last[word])
        fits = after + size - 1 <= len(starts)
        word, after = word[fits], after[fits]
        mixed = own[words[word]] * _WEIGHTS[0]
        for k in range(size - 1):
            mixed += token[after + k] * _WEIGHTS[k + 1]
        return word, after, _mix(mixed), 2 * (1 + literal[after + size - 1] - literal[after]) >= size

    def spelled(self, codes: np.ndarray, starts: np.ndarray, begins: np.ndarray) -> tuple[str, list[str]]:
        """(template, values of its slots) of a window of tokens; ``starts`` has one more, its end."""
        bounds, words = starts.tolist(), codes[starts[0] : starts[-1]].tolist()
        tokens, slots = [], []
        for begin, end, sentence in zip(bounds, bounds[1:], begins.tolist(), strict=False):
            group = words[begin - bounds[0] : end - bounds[0]]
            token = self.first[group[0]] if sentence else self.inner[group[0]]
            tokens.append(token)
            if token in _KIND:
                slots.append(token + ("" if token == NUMBER else " ").join(self.value[c] for c in group))
        return " ".join(tokens), slots


_SCHEMA = "row bigint, size int, at int, place int, h bigint, template string, slots array<string>"


def template_windows(
    rows: DataFrame, key: str, text: str, sizes: set[int] | None, bloom: bytes | None, vocabulary: bytes | None = None
) -> DataFrame:
    """(key, row, size, at, place, h, template, slots); without sizes, an item's windows; with filters, those passing.

    ``at`` counts tokens, ``place`` words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Templates(vocabulary)
        bits = None if bloom is None else np.frombuffer(bloom, np.uint8)

        def passing(hashes: np.ndarray) -> np.ndarray:
            if bits is None:
                return np.ones(len(hashes), bool)
            bit = hashes & np.uint64(BLOOM_BITS - 1)
            return (bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1

        for batch in batches:
            out: list[tuple] = []
            for i, value in enumerate(batch.column(2)):
                words, _, starts, begins = reader.read(value.as_py() or "")
                codes, bounds, already = words[starts], np.append(starts, len(words)), len(out)
                wanted = sizes if sizes is not None else {min(WINDOW, len(codes))}
                for size in wanted:
                    if size < SHORTEST:
                        continue
                    hashes, literal = reader.windows(codes, begins, size)
                    for at in np.flatnonzero(literal & passing(hashes)).tolist():
                        spelled = reader.spelled(words, bounds[at : at + size + 1], begins[at : at + size])
                        out.append((i, size, at, int(starts[at]), int(hashes[at].view(np.int64)), *spelled))
                    if bits is None:
                        continue
                    word, after, hashes, literal = reader.begun(words, starts, begins, size)
                    for k in np.flatnonzero(literal & passing(hashes)).tolist():
                        at, here = int(after[k]), int(word[k])
                        cut = np.concatenate([[here, here + 1], bounds[at + 1 : at + size]])
                        spelled = reader.spelled(words, cut, np.append(True, begins[at : at + size - 1]))
                        out.append((i, size, at - 1, here, int(hashes[k].view(np.int64)), *spelled))
                # An item without a window of its own, and what may equal it.
                exact = {min(WINDOW, len(words))} if sizes is None and len(out) == already else set()
                for size in exact if sizes is None else {-n for n in sizes if n < 0}:
                    if size < 1:
                        continue
                    hashes = reader.exact(words, size)
                    for at in np.flatnonzero(passing(hashes)).tolist():
                        text = " ".join(["=", *(reader.value[c] for c in words[at : at + size].tolist())])
                        out.append((i, -size, at, at, int(hashes[at].view(np.int64)), text, []))
            picked = pa.array([x[0] for x in out], pa.int64())
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.string())]
            columns = [pa.array([x[k + 1] for x in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(picked), batch.column(1).take(picked), *columns],
                [key, "row", "size", "at", "place", "h", "template", "slots"],
            )

    small_batches(rows.sparkSession)
    named = rows.select(F.col(key), F.xxhash64(text).alias("row"), F.col(text).alias("text"))
    return named.mapInArrow(run, f"`{key}` {named.schema[key].dataType.simpleString()}, {_SCHEMA}")


def bloom_of(hashes: DataFrame) -> bytes:
    """Bitmap of the hashes' low bits: a fixed size, put together from one row per 4 kB that holds any bit."""
    bit = F.pmod(F.col("h"), F.lit(BLOOM_BITS)) + 1
    rows = hashes.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")
    )
    out = bytearray(BLOOM_BITS // 8)
    for row in rows.collect():
        at = (row["bucket"] - 1) * 4096
        out[at : at + 4096] = row["bits"]
    return bytes(out)


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row, item_id, at, windows, share, slots, changed) of every alignment that is a leak.

    ``row`` is the hash of the text, ``at`` the first token of the alignment in it, ``changed`` the number of
    slots with another value than the item's.
    """
    once = benchmark.select("item_id", "text").distinct()
    items = stored(template_windows(once, "item_id", "text", None, None), "item-windows")
    sizes = {row["size"] for row in items.select("size").distinct().collect()}
    bits = bloom_of(items)
    # Tokens are the words they stand for, in templates and in windows of words alike.
    vocabulary = bloom_of(items.select(F.explode(F.split("template", " ")).alias("token")).select(F.xxhash64("token").alias("h")))
    item = weighed(items)
    named = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    found = stored(template_windows(named, "doc_id", "text", sizes, bits, vocabulary), "windows")
    # A leak holds one of its item's telling windows; the others are looked up for the pairs that these give only, so an
    # opening that many items and many texts share makes no pairs.
    copy = ["doc_id", "row", "item_id", "item_row"]
    telling = item.filter("telling").select("template", "item_id", "item_row").distinct()
    pair = found.select("template", "doc_id", "row").join(telling, "template").select(*copy).distinct()
    expected = pair.join(
        item.withColumnsRenamed({"item_id": "i", "item_row": "r"}), _same("item_id", "item_row")
    ).drop("i", "r")
    matched = found.withColumnsRenamed({"doc_id": "d", "row": "x", "template": "t"}).join(
        expected, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("x")) & (F.col("template") == F.col("t"))
    )
    pairs = F.arrays_zip(F.col("item_slots").alias("a"), F.col("slots").alias("b"))
    offset = F.col("at") - F.col("item_at")
    # Each offset by itself, and with its neighbours in two sorts of bands, of which one holds any SHIFT of them.
    bands = [F.struct(F.lit(0).alias("sort"), offset.alias("at"))] + [
        F.struct(F.lit(k).alias("sort"), F.floor((offset + add) / (2 * SHIFT)).cast("int").alias("at"))
        for k, add in ((1, 0), (2, SHIFT))
    ]
    aligned = (
        matched.withColumn("band", F.explode(F.array(*bands)))
        .groupBy(*copy, "band", "of")
        .agg(
            F.collect_set(F.struct("item_at", "weight")).alias("windows"),
            F.min("place").alias("at"),
            F.max("place").alias("last"),
            F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"),
        )
        .withColumn("weight", F.aggregate("windows", F.lit(0).cast("bigint"), lambda sum_, w: sum_ + w["weight"]))
        .withColumn("windows", F.size("windows").cast("bigint"))
    )

    def different(field: int) -> Column:
        return F.size(F.array_distinct(F.transform("pairs", lambda p: p["ab"[field]])))

    whole = aligned.filter(F.col("weight") >= SHARE * F.col("of")).filter(
        (different(0) == F.size("pairs")) & (different(1) == F.size("pairs"))
    )
    # Bands show a copy more than once: it counts where it begins first, and with most windows.
    before = Window.partitionBy(*copy).orderBy("at", F.desc("windows"), "band")
    furthest = F.max("last").over(before.rowsBetween(Window.unboundedPreceding, -1))
    return (
        whole.withColumn("furthest", furthest)
        .filter(F.col("furthest").isNull() | (F.col("at") > F.col("furthest")))
        .select(
            "doc_id",
            "row",
            "item_id",
            "at",
            "windows",
            (F.col("weight") / F.col("of")).alias("share"),
            F.size("pairs").alias("slots"),
            F.size(F.filter("pairs", lambda p: p["a"] != p["b"])).alias("changed"),
        )
    )


def weighed(items: DataFrame) -> DataFrame:
    """(template, item_id, item_row, item_at, item_slots, weight, of, telling) of items' windows.

    A window that n different items hold weighs WEIGHT / n, ``of`` is the weight of all windows of an item. The heaviest
    windows without which no alignment reaches SHARE are ``telling``; of equally heavy ones those that stand last.
    """
    holders = items.groupBy("template").agg(F.countDistinct("row").alias("holders"))
    rows = items.join(holders, "template").select(
        "template",
        "item_id",
        F.col("row").alias("item_row"),
        F.col("at").alias("item_at"),
        F.col("slots").alias("item_slots"),
        F.floor(F.lit(WEIGHT) / F.col("holders")).cast("bigint").alias("weight"),
    )
    # An item is one text of the benchmark: its windows fit in one window frame.
    of_item = Window.partitionBy("item_id", "item_row")
    lighter = of_item.orderBy("weight", "item_at", "template").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("of", F.sum("weight").over(of_item))
        .withColumn("telling", F.sum("weight").over(lighter) >= SHARE * F.col("of"))
    )


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col("i")) & F.col(right).eqNullSafe(F.col("r"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that leak an item."""
    found = leaks(docs, benchmark, key, text).select(F.col("doc_id").alias("__leak_id"), F.col("row").alias("__leak_row"))
    same = docs[key].eqNullSafe(found["__leak_id"]) & (F.xxhash64(docs[text]) == found["__leak_row"])
    return docs.join(found.distinct(), same, "left_anti")
