"""Periodic runs of a word sequence, found by recompression.

The words of a group of texts are numbered and written one text after the other, each followed by a mark of its own.
Recompression turns that sequence into a run-length grammar: block compression replaces each maximal block of one symbol by
a symbol for (symbol, length), pair compression replaces neighbours of a left and a right class by a symbol for the pair,
and the two alternate until only marks and one symbol per text are left. What is replaced depends on the symbols
alone, so equal parts of a text become equal symbols but for their borders. An extension query (how far do the texts from i
and j on agree) climbs through the levels while symbols agree and comes down where they don't: one step per level, in either
direction, for all queries at once. No suffix array is built.

A run of period q and exponent of EXPONENT or more matches itself, shifted by q, over at least three places that are
multiples of q. So for each q the candidates are places k*q whose word equals the ones at (k+1)*q and (k+2)*q (a
harmonic grid: n/q places for each q, n log n in all). Their exact borders are two extension queries. A text without
candidates has no run and needs no grammar.

Work is dealt out by rows, and in a task by groups of texts of GROUP_BYTES; a longer text is a group of its own, and
every array of a group is a small multiple of its words. Null text has no words. Repeated rows, null ids and empty tables
keep their rows. Only key and text are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that are compressed together.
GROUP_BYTES = 1 << 21
#: Extension queries that are answered at once.
BLOCK = 1 << 18
#: A run holds its period so often, and at least LEAST words.
EXPONENT, LEAST = 4, 6


class Level:
    """One step of the compression: the symbols before it, and each one's place in the symbols after it."""

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, blocks: bool):
        self.symbols = symbols
        self.blocks = blocks
        #: First symbol of each symbol of the next level, and one past the last.
        self.starts = np.append(starts, len(symbols))
        self.parent = np.repeat(np.arange(len(starts)), np.diff(self.starts))

    def ahead(self, at: np.ndarray, step: int) -> np.ndarray:
        """Equal symbols from ``at`` on within its parent in direction ``step``, itself included."""
        if not self.blocks:
            return np.ones(len(at), np.int64)
        if step > 0:
            return self.starts[self.parent[at] + 1] - at
        return at - self.starts[self.parent[at]] + 1

    def aligned(self, at: np.ndarray, step: int) -> np.ndarray:
        """Whether ``at`` is the symbol that its parent begins with in direction ``step``."""
        return at == (self.starts[self.parent[at]] if step > 0 else self.starts[self.parent[at] + 1] - 1)


def _numbered(first: np.ndarray, second: np.ndarray, base: int) -> np.ndarray:
    """One new symbol for each distinct pair, from ``base`` on."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    fresh = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])) if len(a) else np.zeros(0, bool)
    out = np.empty(len(first), np.int64)
    out[order] = base + np.cumsum(fresh) - 1
    return out


def _scattered(symbols: np.ndarray, salt: int) -> np.ndarray:
    """A pseudo-random class of each symbol, the same for equal symbols."""
    x = symbols.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x >> np.uint64(40)) & np.uint64(1)).astype(bool)


class Grammar:
    """Run-length grammar of a sequence. ``marks`` (below 0, each once) are never replaced."""

    def __init__(self, sequence: np.ndarray):
        self.levels: list[Level] = []
        symbols = sequence.astype(np.int64)
        base = int(symbols.max(initial=0)) + 1
        salt = 0
        while True:
            word = symbols >= 0
            inner = word[1:] & word[:-1]
            if not inner.any():
                break
            # Blocks
            fresh = np.append(True, symbols[1:] != symbols[:-1])
            starts = np.flatnonzero(fresh)
            length = np.diff(np.append(starts, len(symbols)))
            if len(starts) < len(symbols):
                self.levels.append(Level(symbols, starts, blocks=True))
                symbols = symbols[starts].copy()
                many = np.flatnonzero(length > 1)
                symbols[many] = _numbered(symbols[many], length[many], base)
                base = int(symbols.max(initial=base)) + 1
            # Pairs: of the two orders of the classes, the one with more neighbours
            word = symbols >= 0
            side = _scattered(symbols, salt)
            salt += 1
            near = word[1:] & word[:-1]
            forth = np.flatnonzero(near & ~side[:-1] & side[1:])
            back = np.flatnonzero(near & side[:-1] & ~side[1:])
            pair = forth if len(forth) >= len(back) else back
            if len(pair):
                single = np.ones(len(symbols), bool)
                single[pair + 1] = False
                made = _numbered(symbols[pair], symbols[pair + 1], base)
                self.levels.append(Level(symbols, np.flatnonzero(single), blocks=False))
                symbols = symbols.copy()
                symbols[pair] = made
                symbols = symbols[single]
                base += len(pair)

    def extend(self, left: np.ndarray, right: np.ndarray, step: int) -> np.ndarray:
        """Words that agree from ``left`` and ``right`` on, in direction ``step``; both lie in one text, and differ."""
        out = np.empty(len(left), np.int64)
        for low in range(0, len(left), BLOCK):
            out[low : low + BLOCK] = self._extend(left[low : low + BLOCK], right[low : low + BLOCK], step)
        return out

    def _extend(self, left: np.ndarray, right: np.ndarray, step: int) -> np.ndarray:
        x, y = left.astype(np.int64), right.astype(np.int64)
        turned = np.full(len(x), -1)
        # Up, while the symbols agree. Marks differ from all else, so no place leaves its text.
        active = np.arange(len(x))
        for depth, level in enumerate(self.levels):
            if not len(active):
                break
            a, b = x[active], y[active]
            both = level.aligned(a, step) & level.aligned(b, step)
            equal = ~both & (level.symbols[a] == level.symbols[b])
            some = np.flatnonzero(equal)
            run = np.minimum(level.ahead(a[some], step), level.ahead(b[some], step)) * step
            a[some] += run
            b[some] += run
            # The symbols behind the last ones of both parents begin their own; else one block goes on and the other doesn't.
            both[some] = level.aligned(a[some], step) & level.aligned(b[some], step)
            x[active], y[active] = a, b
            turned[active[~both]] = depth
            active = active[both]
            x[active], y[active] = level.parent[x[active]], level.parent[y[active]]
        turned[active] = len(self.levels)
        # Down again, from where they differ.
        for depth in range(len(self.levels) - 1, -1, -1):
            level = self.levels[depth]
            active = np.flatnonzero(turned > depth)
            if not len(active):
                continue
            if step > 0:
                a, b = level.starts[x[active]], level.starts[y[active]]
            else:
                a, b = level.starts[x[active] + 1] - 1, level.starts[y[active] + 1] - 1
            some = np.flatnonzero(level.symbols[a] == level.symbols[b])
            run = np.minimum(level.ahead(a[some], step), level.ahead(b[some], step)) * step
            a[some] += run
            b[some] += run
            x[active], y[active] = a, b
        return (x - left) * step


def _candidates(sequence: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of the grid places that may lie in a run; texts come longest first."""
    places, periods = [], []
    for period in range(1, int(lengths[0]) // EXPONENT + 1):
        # Texts that are long enough for this period.
        n = int(np.searchsorted(-lengths, -max(LEAST, EXPONENT * period), side="right"))
        if n == 0:
            break
        grid = sequence[: ends[n - 1] : period]
        same = grid[1:] == grid[:-1]
        found = np.flatnonzero(same[1:] & same[:-1])
        if len(found):
            places.append(found * period)
            periods.append(np.full(len(found), period))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place, period = np.concatenate(places), np.concatenate(periods)
    # The words next to the grid have to agree as well.
    beside = np.minimum(place + 2 * period + 1, len(sequence) - 1)
    fit = (period == 1) | (
        (sequence[place + 1] == sequence[place + period + 1]) & (sequence[place + 1] == sequence[beside])
    )
    return place[fit], period[fit]


def runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Per text (word numbers from 0) its runs as rows (start, length, period), by start, then period."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    out: list[np.ndarray] = [np.zeros((0, 3), np.int64)] * len(texts)
    order = [i for i in order if len(texts[i]) >= LEAST]
    if not order:
        return out
    place, period, starts, sequence = _in_texts(texts, order)
    if not len(place):
        return out
    # Texts without candidates are left out of the grammar.
    owner = np.searchsorted(starts, place, side="right") - 1
    kept = np.unique(owner)
    shift = np.zeros(len(starts), np.int64)
    parts, at = [], 0
    for i in kept:
        end = starts[i + 1] if i + 1 < len(starts) else len(sequence)
        shift[i] = at - starts[i]
        parts.append(sequence[starts[i] : end])
        at += len(parts[-1])
    place = place + shift[owner]
    grammar = Grammar(np.concatenate(parts))

    # Neighbours on the grid mostly lie in one run: the first of each row of them is asked first.
    row = np.cumsum(np.append(True, (period[1:] != period[:-1]) | (place[1:] != place[:-1] + period[1:]))) - 1
    found = []
    while len(place):
        first = np.append(True, row[1:] != row[:-1])
        i, q = place[first], period[first]
        ahead = grammar.extend(i, i + q, 1)
        behind = grammar.extend(i, i + q, -1) - 1
        begin, length = i - behind, behind + ahead + q
        good = length >= np.maximum(LEAST, EXPONENT * q)
        found.append(np.stack([begin, length, q, owner[first]], axis=1)[good])
        # Places that the same stretch holds have the same borders.
        asked = np.cumsum(first) - 1
        rest = place >= (i + ahead)[asked]
        place, period, owner, row = place[rest], period[rest], owner[rest], row[rest]
    all_runs = np.concatenate(found)
    # One stretch found at several periods: the smallest is its period, as it divides the others.
    all_runs = all_runs[np.lexsort((all_runs[:, 2], all_runs[:, 1], all_runs[:, 0]))]
    once = np.append(True, (all_runs[1:, :2] != all_runs[:-1, :2]).any(axis=1)) if len(all_runs) else np.zeros(0, bool)
    all_runs = all_runs[once]
    # Ordered by start, so a text's runs are neighbours.
    for low, high in zip(*_stretches(all_runs[:, 3])):
        i, mine = all_runs[low, 3], all_runs[low:high, :3]
        mine[:, 0] -= starts[i] + shift[i]
        out[order[i]] = mine[np.lexsort((mine[:, 2], mine[:, 0]))]
    return out


def _stretches(values: np.ndarray) -> tuple[list[int], list[int]]:
    """Where each row of equal neighbours begins and ends."""
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    return [0, *cuts.tolist()][: len(values)], [*cuts.tolist(), len(values)]


def _in_texts(texts: list[np.ndarray], order: list[int]) -> tuple[np.ndarray, ...]:
    """Candidates over all texts, the places where texts start, and their sequence with its marks."""
    lengths = np.array([len(texts[i]) for i in order])
    sequence = np.concatenate([part for mark, i in enumerate(order) for part in (texts[i], [-1 - mark])]).astype(np.int64)
    ends = np.cumsum(lengths + 1)
    place, period = _candidates(sequence, ends, lengths)
    # The grid goes on from text to text; a run doesn't.
    inside = place + 2 * period < ends[np.searchsorted(ends, place, side="right")] - 1
    return place[inside], period[inside], ends - lengths - 1, sequence


def _groups(sizes: list[int], limit: int) -> Iterator[range]:
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield range(first, i)
            first, total = i, 0
        total += size
    yield range(first, len(sizes))


def repetitions(
    docs: DataFrame, planted: Callable[[object, list[bytes]], list[bytes]] | None = None, *,
    key: str = "doc_id", text: str = "text", group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """(doc_id, runs, kept) of every row: its runs by start, then period, and the words outside repeated parts.

    A word is left out of ``kept`` where a run holds it after the run's first period; the rest are joined by a space. ``planted``
    may exchange the words of a text, which it gets with the row's key, before they are searched.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            column = batch.column(1)
            sizes = [0 if not column[i].is_valid else column[i].as_buffer().size for i in range(len(keys))]
            for group in _groups(sizes, group_bytes):
                words = []
                for i in group:
                    split = column[i].as_buffer().to_pybytes().split() if sizes[i] else []
                    words.append(planted(keys[i], split) if planted and split else split)
                numbers: dict[bytes, int] = {}
                found = runs([np.array([numbers.setdefault(w, len(numbers)) for w in x], np.int64) for x in words])
                kept = []
                for mine, x in zip(found, words):
                    # +1 where a run's second period begins, -1 where the run ends.
                    steps = np.zeros(len(x) + 1, np.int64)
                    np.add.at(steps, mine[:, 0] + mine[:, 2], 1)
                    np.add.at(steps, mine[:, 0] + mine[:, 1], -1)
                    kept.append(
                        b" ".join([w for w, inside in zip(x, np.cumsum(steps[:-1]).tolist()) if not inside]) if len(mine) else b" ".join(x)
                    )
                records = [[{"start": s, "length": n, "period": q} for s, n, q in mine.tolist()] for mine in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(group.start, len(group)),
                        pa.array(records, pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))),
                        pa.array(kept, pa.binary()),
                    ],
                    ["doc_id", "runs", "kept"],
                )

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(search, f"doc_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, kept binary")
