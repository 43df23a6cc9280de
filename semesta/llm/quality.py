"""Quality classifier: attention-based multiple-instance learning over a text's passages.

A text is a bag of passages of ``PASSAGE`` words. A passage is described by what its words look like (case,
digits, marks, lengths, repetition) and a hashed bag of them, and encoded by one tanh layer. Gated attention
weighs the passages of a text, the weighted sum of their encodings is scored by a logistic unit; all
weights are learned together from labels of whole texts, by Adam on a sample of at most ``FIT`` labelled rows
(the same rows however the tables are dealt out) and ``FIT_PASSAGES`` passages of each, which bounds what the driver
gets whatever the length of texts. Every row is scored over its whole text.

A null or empty text is one passage without words, and has a score too. Several labels of an id count as
their mean, null labels and ids don't count. Without any labelled row the score is 0.5. Repeated rows are
scored alike; an empty table gives an empty one. Other columns pass; one named ``score`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semesta.llm.common import fold_of, small_batches

#: Scores from here on are label 1.
THRESHOLD = 0.3
#: Labelled rows to learn from, at most; words of a passage; buckets of its bag of words.
FIT, PASSAGE, BUCKETS = 10_000, 100, 64
#: Passages of a text to learn from, at most: of longer ones, so many at equal distances. Scores see all of them.
FIT_PASSAGES = 32
#: Rows whose crc32(doc_id) modulo this is 0 are held out.
FOLDS = 5
#: Sizes of a passage's encoding and of the attention's hidden layer; passes over the sample.
ENCODING, ATTENTION, EPOCHS = 24, 16, 20
#: Words after which a task's memory of them is emptied.
REMEMBERED = 100_000

_MARKS = ("!", "|", "#$%&*", ".,;:?")
_TRAITS = 13
FEATURES = _TRAITS + 4 + BUCKETS


class Passages:
    """Features of a text's passages; words met before are remembered."""

    def __init__(self):
        self._codes: dict[str, int] = {}
        self._traits = np.zeros((1 << 12, _TRAITS), np.float32)
        self._bucket = np.zeros(1 << 12, np.int64)

    def _learn(self, word: str) -> int:
        code = self._codes[word] = len(self._codes)
        if code == len(self._bucket):
            self._traits = np.concatenate([self._traits, np.zeros_like(self._traits)])
            self._bucket = np.concatenate([self._bucket, np.zeros_like(self._bucket)])
        n = len(word)
        upper = sum(map(str.isupper, word))
        marks = [sum(map(word.count, kind)) for kind in _MARKS]
        self._traits[code] = (
            min(n, 40) / 10,
            n <= 3,
            n > 20,
            upper / n,
            upper > 1 and not any(map(str.islower, word)),
            word[0].isupper(),
            sum(map(str.isdigit, word)) / n,
            *(min(m, 4) / 2 for m in marks),
            sum(not c.isalnum() for c in word) / n,
            not word.isascii(),
        )
        self._bucket[code] = xxhash.xxh64_intdigest(word.lower().encode("utf-8", "surrogatepass"), 9) % BUCKETS
        return code

    def features(self, text: str | None) -> np.ndarray:
        """One row of FEATURES per passage."""
        words = text.split() if text else []
        if not words:
            return np.zeros((1, FEATURES), np.float32)
        if len(self._codes) > REMEMBERED:
            self._codes.clear()
        known, learn = self._codes.get, self._learn
        codes = np.array([c if (c := known(word)) is not None else learn(word) for word in words], np.int64)
        starts = np.arange(0, len(codes), PASSAGE)
        sizes = np.diff(np.append(starts, len(codes))).astype(np.float32)
        of = np.arange(len(codes)) // PASSAGE
        out = np.zeros((len(starts), FEATURES), np.float32)
        out[:, :_TRAITS] = np.add.reduceat(self._traits[codes], starts) / sizes[:, None]
        again = np.append(False, codes[1:] == codes[:-1])
        pairs = np.unique(of * (len(self._codes) + 1) + codes) // (len(self._codes) + 1)
        out[:, _TRAITS] = np.add.reduceat(again.astype(np.float32), starts) / sizes
        out[:, _TRAITS + 1] = np.bincount(pairs, minlength=len(starts)) / sizes
        out[:, _TRAITS + 2] = np.log1p(sizes)
        out[:, _TRAITS + 3] = len(set(words)) / len(words)
        bag = np.bincount(of * BUCKETS + self._bucket[codes], minlength=len(starts) * BUCKETS)
        out[:, _TRAITS + 4 :] = np.sqrt(bag.reshape(-1, BUCKETS) / sizes[:, None])
        return out


@dataclass
class Model:
    """Learned weights; see the module's text."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def _forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        n = np.diff(np.append(starts, len(x)))
        h = np.tanh(x @ w["encode"] + w["encode_0"])
        t, g = np.tanh(h @ w["look"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        e = (t * g) @ w["attend"]
        top = np.repeat(np.maximum.reduceat(e, starts), n)
        a = np.exp(e - top)
        a /= np.repeat(np.add.reduceat(a, starts), n)
        z = np.add.reduceat(a[:, None] * h, starts)
        p = 1 / (1 + np.exp(-np.clip(z @ w["score"] + w["score_0"], -30, 30)))
        return {"n": n, "h": h, "t": t, "g": g, "a": a, "z": z, "p": p}

    def probability(self, bags: list[np.ndarray]) -> np.ndarray:
        starts = np.cumsum([0, *(len(bag) for bag in bags[:-1])])
        x = np.clip((np.concatenate(bags) - self.mean) / self.scale, -6, 6)
        return self._forward(x, starts)["p"]

    def gradients(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.weights, self._forward(x, starts)
        n, h, t, g, a = f["n"], f["h"], f["t"], f["g"], f["a"]
        d = (f["p"] - y) / len(y)
        dz = np.repeat(d[:, None] * w["score"][None, :], n, axis=0)
        da = (dz * h).sum(1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, starts), n))
        dtg = de[:, None] * w["attend"][None, :]
        dt, dg = dtg * g * (1 - t * t), dtg * t * g * (1 - g)
        dh = (a[:, None] * dz + dt @ w["look"].T + dg @ w["gate"].T) * (1 - h * h)
        return {
            "encode": x.T @ dh,
            "encode_0": dh.sum(0),
            "look": h.T @ dt,
            "gate": h.T @ dg,
            "attend": (t * g).T @ de,
            "score": f["z"].T @ d,
            "score_0": d.sum(keepdims=True),
        }

    def score(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``docs`` with ``score``, the probability of label 1."""
        small_batches(docs.sparkSession)
        kept = docs.drop("score")
        at = kept.columns.index(text)
        schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])
        model = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            reader = Passages()
            for batch in batches:
                scores = np.zeros(batch.num_rows)
                # Alike for every way of cutting batches: a text is scored by itself.
                for i in range(0, batch.num_rows, 256):
                    bags = [reader.features(value.as_py()) for value in batch.column(at).slice(i, 256)]
                    scores[i : i + 256] = model.probability(bags)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], schema.names)

        return kept.mapInArrow(run, schema)


def spread(bag: np.ndarray) -> np.ndarray:
    """At most FIT_PASSAGES rows of a bag, at equal distances from its first to its last."""
    if len(bag) <= FIT_PASSAGES:
        return bag
    return bag[np.linspace(0, len(bag) - 1, FIT_PASSAGES).round().astype(int)]


def learn(bags: list[np.ndarray], labels: np.ndarray, seed: int = 3) -> Model:
    """Model of bags of passages and their labels, by Adam over shuffled batches."""
    rng = np.random.default_rng(seed)
    shapes = {
        "encode": (FEATURES, ENCODING),
        "encode_0": (ENCODING,),
        "look": (ENCODING, ATTENTION),
        "gate": (ENCODING, ATTENTION),
        "attend": (ATTENTION,),
        "score": (ENCODING,),
        "score_0": (1,),
    }
    weights = {k: rng.normal(0, 0 if k.endswith("_0") else shape[0] ** -0.5, shape) for k, shape in shapes.items()}
    if not bags:
        weights["score"] *= 0
        return Model(np.zeros(FEATURES), np.ones(FEATURES), weights)
    every = np.concatenate(bags)
    model = Model(every.mean(0, dtype=np.float64), every.std(0, dtype=np.float64) + 1e-3, weights)
    first, second = ({k: np.zeros(v.shape) for k, v in weights.items()} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), 128):
            chosen = order[i : i + 128]
            part = [bags[k] for k in chosen]
            x = np.clip((np.concatenate(part) - model.mean) / model.scale, -6, 6)
            starts = np.cumsum([0, *(len(bag) for bag in part[:-1])])
            step += 1
            for k, d in model.gradients(x, starts, labels[chosen]).items():
                d = d + 1e-4 * weights[k]
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                weights[k] -= 0.01 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Model learned from at most FIT labelled rows outside the held-out fold."""
    small_batches(docs.sparkSession)
    known = (
        labels.select(F.col(key).alias("doc_id"), F.col(label).alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (fold_of(F.col("doc_id"), FOLDS) != 0))
        .groupBy("doc_id")
        .agg(F.avg("label").alias("label"))
    )
    share = min(1.0, FIT / max(1, known.count()))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))
    # At most FIT rows of two numbers: the side that is sent out has this bound.
    sample = known.filter(drawn).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT)
    texts = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    rows = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Passages()
        for batch in batches:
            bags = [spread(reader.features(value.as_py())).tobytes() for value in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(bags, pa.binary())], ["doc_id", "label", "bag"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    described = rows.mapInArrow(describe, f"doc_id {kind}, label double, bag binary")
    # Several rows of an id are one bag: the first by its bytes.
    once = described.groupBy("doc_id").agg(F.min("bag").alias("bag"), F.first("label").alias("label"))
    got = once.toArrow().sort_by("doc_id")
    bags = [np.frombuffer(bag.as_buffer(), np.float32).reshape(-1, FEATURES) for bag in got["bag"]]
    return learn(bags, got["label"].to_numpy().astype(float))
