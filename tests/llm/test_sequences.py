"""Token counts, periodic runs and conversation repair, each against a plain version."""

from __future__ import annotations

import hashlib
import itertools
import json
import random
import re
import signal
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from semesta.llm import queries, repair, repetitions, tokens

SF = "/root/testdata/sf0.001"

# Token counts

JSON_PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return Tokenizer.from_file(JSON_PATH)


def _count(encoder, text: str) -> int:
    return len(encoder.encode(text, add_special_tokens=False))


ODD = [
    "", " ", "\n\n \t", "<|endoftext|>", "a<|endoftext|>b <|endoftext|> ", "it's I'll 'tis don''t", "x" * 3000,
    "  two  spaces  　 wide ", "1,234.5 kg; (see) 'd", "世界，你好。" * 300, "añó naïve​", "😀😀 a", "a.b,c;d" * 400,
]


def test_token_counts_equal_the_library(spark, encoder):
    rng = random.Random(5)
    alphabet = ["a", "B", "7", " ", "  ", "\n", "'", "s", ".", ",", "é", "中", "。", "<|endoftext|>", "\t", " ", "'ll"]
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 400))) for _ in range(150)]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(None, None, None, None), (3, texts[3], "again", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, n_bytes int")
    for piece, batch in ((7, 50), (64, 1000), (1 << 16, 1 << 20)):
        got = sorted(map(tuple, tokens.counts(docs, JSON_PATH, piece=piece, batch_bytes=batch).collect()), key=repr)
        expected = [(i, len((t or "").encode()), _count(encoder, t or "")) for i, t, *_ in rows]
        assert got == sorted(expected, key=repr)


def test_pieces_of_a_long_text(encoder):
    safe = tokens.boundary(json.loads(encoder.to_str()))
    text = " ".join(ODD * 20)
    cut = list(tokens.pieces(text, 500, safe))
    assert "".join(cut) == text and len(cut) > 20
    assert sum(_count(encoder, part) for part in cut) == _count(encoder, text)
    # A word without end has no boundary.
    assert list(tokens.pieces("x" * 5000, 500, safe)) == ["x" * 5000]
    assert list(tokens.pieces(text, 500, None)) == [text]


def test_stretches_of_a_text(encoder):
    spec = json.loads(encoder.to_str())
    between = tokens.stretch(spec)
    assert between.findall("The cat, the cat -- sat.") == ["The", " cat", ", the", " cat", " -- sat", ".", ""]
    for text in (*ODD, " ".join(ODD), "-," * 300_000):
        parts = between.findall(text)
        assert "".join(parts) == text
        assert sum(_count(encoder, part) for part in parts) == _count(encoder, text)


def test_repeated_stretches_are_counted_once(monkeypatch):
    """The encoder got every word of every text."""
    asked = []

    def count(parts: list[str]) -> list[int]:
        asked.extend(parts)
        return [len(part) for part in parts]

    sums = tokens.Sums(count)
    long = "x" * (tokens.SHORT + 1)
    assert sums([["a", " b", "a"], [], [long, ""]]) == [4, 0, len(long)]
    assert sums([["a", long], ["c"] * 3]) == [1 + len(long), 3]
    assert sorted(asked) == sorted(["a", " b", long, "", long, "c"])
    monkeypatch.setattr(tokens, "KNOWN", 2)
    assert sums([["a", "d"], ["d"]]) == [2, 1] and not sums.known


def test_other_tokenizers_get_whole_texts(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        assert tokens.boundary(json.load(file)) is None
    docs = spark.createDataFrame([(1, "Some  WORDS, here."), (2, None)], "doc_id long, text string")
    other = Tokenizer.from_file(path)
    assert sorted(map(tuple, tokens.counts(docs, path, piece=3).collect())) == [(1, 18, _count(other, "Some  WORDS, here.")), (2, 0, 0)]


def test_op11(spark, encoder):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = queries.op11_tokens(spark, SF).collect()
    assert len(out) == len(docs)
    for row in out:
        n = _count(encoder, docs[row["doc_id"]])
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len(docs[row["doc_id"]].encode()), n, n > 512)
    assert tokens.counts(spark.createDataFrame([], "doc_id long, text string"), JSON_PATH).count() == 0


# Periodic runs


def plain_runs(x: list) -> list[tuple[int, int, int]]:
    """(start, length, period), by comparing every word with the one a period later."""
    best: dict[tuple[int, int], int] = {}
    for q in range(1, len(x) // 4 + 1):
        i = 0
        while i + q < len(x):
            first = i
            while i + q < len(x) and x[i] == x[i + q]:
                i += 1
            length = i - first + q
            if i > first and length >= max(6, 4 * q):
                best.setdefault((first, length), q)
            i += i == first
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def plain_kept(x: list, found: list[tuple[int, int, int]]) -> list:
    return [w for i, w in enumerate(x) if not any(s + q <= i < s + n for s, n, q in found)]


def _some_text(rng: random.Random) -> list[int]:
    n, k = rng.choice([0, 1, 5, 6, 7, 20, 60, 200, 500]), rng.choice([1, 2, 3, 50])
    x = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n > 10 else 0):
        first, period, length = rng.randrange(n), rng.randint(1, n // 5), rng.randint(1, n)
        for i in range(first + period, min(n, first + length)):
            x[i] = x[i - period]
    return x


def test_runs_equal_plain_runs():
    rng = random.Random(3)
    for _ in range(120):
        texts = [_some_text(rng) for _ in range(rng.randint(1, 12))]
        got = repetitions.runs([np.array(x, np.int64) for x in texts])
        assert [[tuple(r) for r in found.tolist()] for found in got] == [plain_runs(x) for x in texts]


def test_words_that_are_alike_across_texts_are_no_run():
    """Grid places in two texts, the second of which has no run: the search went on without end."""

    def late(*_: object) -> None:
        raise TimeoutError

    texts = [[*range(100, 112), 1, 2], [1, 2, 50, 1, 2, *range(60, 68)], [3, 4] * 6]
    before = signal.signal(signal.SIGALRM, late)
    signal.alarm(20)
    try:
        assert [x.tolist() for x in repetitions.runs([np.array(x, np.int64) for x in texts])] == [[], [], [[0, 12, 2]]]
    finally:
        signal.alarm(0)
        signal.signal(signal.SIGALRM, before)


def test_extensions_equal_plain_ones():
    rng = random.Random(4)
    for _ in range(30):
        x = [y + 1 for y in _some_text(rng)]
        if len(x) < 3:
            continue
        grammar = repetitions.Grammar(np.array([*x, -1]))
        pairs = [sorted(rng.sample(range(len(x)), 2)) for _ in range(60)]
        left, right = (np.array(side) for side in zip(*pairs))
        for step in (1, -1):
            got = grammar.extend(left, right, step).tolist()
            for (i, j), n in zip(pairs, got):
                m = 0
                while 0 <= i + m * step and 0 <= j + m * step < len(x) and x[i + m * step] == x[j + m * step]:
                    m += 1
                assert n == m


def test_very_long_texts_of_one_word_and_of_none(spark):
    assert repetitions.runs([np.zeros(200_000, np.int64)])[0].tolist() == [[0, 200_000, 1]]
    assert len(repetitions.runs([np.arange(200_000)])[0]) == 0
    docs = spark.createDataFrame(
        [(1, "a " * 100_000, "x"), (2, None, "y"), (2, None, "y"), (None, " \n", "z"), (5, "p q r " * 4 + "p", None)],
        "doc_id long, text string, runs string",
    )
    out = sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], bytes(r["kept"])) for r in repetitions.repetitions(docs).collect()), key=repr)
    assert out == sorted(
        [(1, [(0, 100_000, 1)], b"a"), (2, [], b""), (2, [], b""), (None, [], b""), (5, [(0, 13, 3)], b"p q r")], key=repr
    )
    assert repetitions.repetitions(docs.limit(0)).count() == 0


def test_op12(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = queries.op12_runs(spark, SF).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(docs)
    several = 0
    for row in out:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (docs[row["doc_id"]] or "").encode())
        h = zlib.crc32(str(row["doc_id"]).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if len(words) > 3000:
            continue
        found = plain_runs(words)
        several += len(found) > 0
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        kept = b" ".join(plain_kept(words, found))
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(found), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if found else None)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(kept).hexdigest()
    assert several > 10


# Conversation repair

NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def plain_faults(rows: list[tuple[str, str]]) -> list[str]:
    out, seen = [], set()
    for role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        if not solid:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows: list[tuple[str, str]]) -> tuple[int, str, str]:
    """Cheapest (cost, audit, repaired text), every way spelled out as strings."""
    ways = {"": (0, "", ())}

    def put(into, state, way):
        into[state] = min(way, into.get(state, way), key=lambda w: w[:2])

    def grown(held):
        held = dict(held)
        for _ in range(3):
            for state, (cost, audit, text) in list(held.items()):
                for role in NEXT[state]:
                    if role != "s":
                        put(held, role, (cost + 2, audit + "I", (*text, {"u": "user:", "a": "assistant:"}[role])))
        return held

    ways = grown(ways)
    for (role, text), fault in zip(rows, plain_faults(rows)):
        then: dict = {}
        for state, (cost, audit, out) in ways.items():
            put(then, state, (cost + 3, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            extra = fault == "truncated"
            for follow in NEXT[state]:
                if role[:1] == follow:
                    put(then, follow, (cost + extra, audit + "K", (*out, f"{role}:{text}")))
                if follow != "s":
                    name = {"u": "user", "a": "assistant"}[follow]
                    put(then, follow, (cost + 2 + extra, audit + "R", (*out, f"{name}:{text}")))
        ways = grown(then)
    cost, audit, out = min((ways[s] for s in ("", "a") if s in ways), key=lambda w: w[:2])
    return cost, audit, "\n".join(out)


def expected_repair(rows: list[tuple]) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of (turn, role, text) rows in order."""
    said = [(" " if role is None else role, " " if text is None else text) for _, role, text in rows]
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    found = plain_faults(said)
    initials = [role[:1] for role, _ in said]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    cost, audit, text = plain_repair(said)
    return (
        gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit,
        hashlib.sha256(text.encode()).hexdigest(),
    )


def _ordered(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (" " if r[1] is None else r[1]).encode(), (" " if r[2] is None else r[2]).encode()))


def _some_conversation(rng: random.Random, size: int) -> list[tuple]:
    roles, texts = ["system", "user", "assistant", "tool", None, ""], ["Yes.", "no", "", " \t", None, "Why?", "So…", "ok!"]
    weights = [1, 5, 5, 1, 1, 1]
    return [
        (rng.choice([None, *range(max(1, size))]) if rng.random() < 0.9 else rng.randrange(5 * size + 1),
         rng.choices(roles, weights)[0], rng.choice(texts) if rng.random() < 0.3 else f"Text {rng.randrange(3 * size + 1)}{rng.choice(['.', '', '!'])}")
        for _ in range(size)
    ]


def _repaired(spark, conversations: dict, partitions: int) -> dict:
    rows = [(conv, *row, "clash") for conv, found in conversations.items() for row in found]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string").repartition(3)
    held = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        out = repair.repair(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    assert len(out) == len({r["conv_id"] for r in out})
    return {r["conv_id"]: tuple(r)[1:] for r in out}


def test_repair_equals_plain_repair(spark):
    rng = random.Random(8)
    conversations = {i: _some_conversation(rng, rng.choice([1, 2, 3, 5, 9, 20])) for i in range(250)}
    conversations[None] = _some_conversation(rng, 15)
    # One that most rows belong to, so that it lies in several ranges.
    conversations[1000] = _some_conversation(rng, 900)
    conversations[1001] = [(5, "user", "Again.")] * 40
    expected = {conv: expected_repair(_ordered(rows)) for conv, rows in conversations.items()}
    assert _repaired(spark, conversations, 7) == expected
    assert _repaired(spark, conversations, 1) == expected


def test_audits_are_compared_by_their_first_difference():
    rng = random.Random(2)
    nodes = [repair.ROOT]
    for _ in range(300):
        nodes.append(repair.Edit(rng.choice(nodes[-12:]), rng.choice("DIKR")))
    for one, two in itertools.product(rng.sample(nodes, 60), repeat=2):
        assert repair.less(one, two) == (one.audit() < two.audit())


def test_equal_hashes_do_not_hide_a_difference(monkeypatch):
    # With this modulus hashes say next to nothing.
    monkeypatch.setattr(repair, "_MODULUS", 2)
    root, rng = repair.Edit(None, ""), random.Random(3)
    nodes = [root]
    for _ in range(200):
        nodes.append(repair.Edit(rng.choice(nodes[-9:]), rng.choice("DIKR")))
    for one, two in itertools.product(rng.sample(nodes, 50), repeat=2):
        assert repair.less(one, two) == (one.audit() < two.audit())


def test_a_very_long_conversation_shares_its_edits():
    rng = random.Random(1)
    rows = [(rng.choice(["user", "assistant"]), f"T{i}." if i % 3 else f"T{i}") for i in range(3000)]
    best = repair.start(0)
    for (role, _), fault in zip(rows, plain_faults(rows)):
        best = repair.after_row(best, role[:1], fault)
    assert repair.finish(best) == plain_repair(rows)[:2]


def test_op13(spark):
    given: dict = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        rows = given.setdefault(r["conv_id"], [])
        fault = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        role, text = r["role"] or " ", " " if r["text"] is None else r["text"]
        if fault == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
        rows += [(r["turn"], "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    out = {r["conv_id"]: tuple(r)[1:] for r in queries.op13_repair(spark, SF).collect()}
    assert out == {conv: expected_repair(_ordered(rows)) for conv, rows in given.items()}
    nothing = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair(nothing).count() == 0
    lost = spark.createDataFrame([(7, 0, "user", "x"), (None, 0, "user", "x")], nothing.schema)
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert {tuple(r) for r in repair.empty(repair.repair(nothing), lost).collect()} == {(7, *empty), (None, *empty)}


def test_damage(spark):
    rows = [(c, t, None, None) for c in range(30) for t in (None, 1)] + [(c, 2, "assistant", "A. b!") for c in range(30)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(map(tuple, queries.damaged(df).collect()), key=repr)
    expected = []
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        if fault:
            text = {1: "", 2: text.replace(".", "").replace("!", "")}.get(fault, text)
            expected += [(c, t, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    assert got == sorted(expected, key=repr)
