"""Quality classifier on supervised subword embeddings.

A text is the average of learned vectors of its words and character n-grams, which are
found by hash, and of the distances at which words repeat; a softmax layer over it gives the score. Vectors and layer are trained
together by stochastic gradient descent in numpy on a bounded sample of labelled rows;
all texts are then scored in tasks. As the average and the layer are linear, scoring
needs the product of both only, one number for each hash value.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.llm.common import SPACE, chunks, mixed, sliced, utf8, word_hashes

#: Hash values of words, and as many again of character n-grams.
BITS = 17
BUCKETS = 1 << BITS
GRAMS = (2, 3, 4)
#: Classes of distances to the last place of a word.
GAPS = 12
SLOTS = 2 * BUCKETS + GAPS
DIMENSIONS = 12
EPOCHS = 8
RATE = 1.5
#: Factor of the rate of vectors, as each is a small share of a text only.
GAIN = np.float32(20)
#: Bounds of the training sample: labelled rows, and bytes of a text that is used for training.
TRAIN_ROWS = 3000
TRAIN_BYTES = 32_000


@dataclass
class Model:
    """``weights`` holds each hash value's share of the score's log odds, ``bias`` that of a text without any."""

    weights: np.ndarray
    bias: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        out = np.empty(len(texts))
        for lo, hi in chunks(np.fromiter(map(len, texts), np.int64, len(texts)), 1 << 20):
            total, count = np.zeros(hi - lo), np.zeros(hi - lo)
            for ids, ends in features(texts[lo:hi]):
                sums = np.concatenate(([0.0], np.cumsum(self.weights[ids], dtype=np.float64)))
                total += np.diff(sums[ends])
                count += np.diff(ends)
            out[lo:hi] = total / np.maximum(count, 1) + self.bias
        return 1 / (1 + np.exp(-out))


def features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hash values of the words and of the n-grams of each length, text by text, with the bounds of the texts in them.

    N-grams stay within a word and the white space next to it.
    """
    data = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    space = SPACE[data]
    plain = np.where(space, np.uint8(32), data).astype(np.uint32)
    # The white space before a text is the first place that counts as its own.
    begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    words, at = word_hashes(data)
    bounds = np.searchsorted(at, begins)
    yield (words >> np.uint64(64 - BITS)).astype(np.int64), bounds
    yield gaps(words, bounds) + 2 * BUCKETS, bounds
    for n in GRAMS:
        size = max(len(data) - n + 1, 0)
        h = np.full(size, n * 0x05EBCA6B, np.uint32)
        valid = ~(space[:size] & space[1 : size + 1]) if n == 2 else np.ones(size, bool)
        for i in range(n):
            h = (h ^ plain[i : i + size]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            if 0 < i < n - 1:
                valid &= ~space[i : i + size]
        at = np.flatnonzero(valid)
        buckets = (h[at] * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)
        yield buckets.astype(np.int64) + BUCKETS, np.searchsorted(at, begins)


def gaps(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each word of each text how far back it last stood there, by powers of two; 0 if it did not."""
    owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(bounds))
    key = mixed(words + owner * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    again = np.flatnonzero(key[order[1:]] == key[order[:-1]]) if len(order) else order
    back = np.zeros(len(words), np.int64)
    back[order[again + 1]] = order[again + 1] - order[again]
    return np.where(back > 0, np.minimum(np.log2(np.maximum(back, 1)).astype(np.int64) + 1, GAPS - 1), 0)


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 1) -> Model:
    """Gradient descent over texts given as (hash values, shares of the average), in a new order each epoch."""
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((SLOTS, DIMENSIONS)) - 0.5) * (2 / DIMENSIONS)).astype(np.float32)
    layer = ((rng.random((DIMENSIONS, 2)) - 0.5) / DIMENSIONS).astype(np.float32)
    bias = np.zeros(2, np.float32)
    steps, step = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)).tolist():
            rate = np.float32(RATE * (1 - step / steps))
            step += 1
            ids, shares = bags[i]
            hidden = shares @ vectors[ids] if len(ids) else np.zeros(DIMENSIONS, np.float32)
            odds = hidden @ layer + bias
            odds = np.exp(odds - odds.max())
            slope = odds / odds.sum()
            slope[labels[i]] -= 1
            back = layer @ slope
            layer -= rate * np.outer(hidden, slope)
            bias -= np.float32(0.02) * rate * slope
            if len(ids):
                vectors[ids] -= np.outer(GAIN * rate * shares, back)
    return Model((vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hash values of a text and the share of each in the average."""
    ids, counts = np.unique(np.concatenate([i for i, _ in features([text])]), return_counts=True)
    return ids, (counts / max(counts.sum(), 1)).astype(np.float32)


def _bags(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 200):
        made = [bag(t) for t in utf8(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("quality"),
                pa.array([i.astype(np.int32).tobytes() for i, _ in made], pa.binary()),
                pa.array([s.tobytes() for _, s in made], pa.binary()),
            ],
            names=["doc_id", "quality", "ids", "shares"],
        )


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Train on at most ``rows`` labelled texts of up to ``TRAIN_BYTES`` bytes, drawn by a hash of the id.

    Labels other than 0 and 1, null ids and null texts are left out; of several labels of a document the highest
    counts. Without any example, or with one class only, all texts get the share of class 1 as score (0.5 if none).
    """
    drawn = (
        labels.where("quality in (0, 1) and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(F.octet_length("text") <= TRAIN_BYTES)
    # At most `rows` rows, so they may go to every task.
    chosen = texts.join(F.broadcast(drawn), "doc_id").select("doc_id", "quality", "text")
    kind = chosen.schema["doc_id"].dataType.simpleString()
    found = chosen.mapInArrow(_bags, f"doc_id {kind}, quality int, ids binary, shares binary")
    # One task trains, on what the bounds leave; the driver gets the finished model alone.
    one = found.dropDuplicates(["doc_id"]).repartition(1).sortWithinPartitions("doc_id")
    trained = one.select("quality", "ids", "shares").mapInArrow(_train, "weights binary, bias double").first()
    if trained is None:
        return Model(np.zeros(SLOTS, np.float32), 0.0)
    return Model(np.frombuffer(bytes(trained["weights"]), np.float32), trained["bias"])


def _train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bags: list[tuple[np.ndarray, np.ndarray]] = []
    answers: list[int] = []
    for batch in batches:
        answers += batch.column("quality").to_pylist()
        for i, s in zip(batch.column("ids").to_pylist(), batch.column("shares").to_pylist(), strict=True):
            bags.append((np.frombuffer(i, np.int32), np.frombuffer(s, np.float32)))
    if len(set(answers)) < 2:
        share = min(max(float(np.mean(answers)) if answers else 0.5, 1e-6), 1 - 1e-6)
        model = Model(np.zeros(SLOTS, np.float32), float(np.log(share / (1 - share))))
    else:
        model = train(bags, np.array(answers, np.int64))
    yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias])], names=["weights", "bias"])


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _scorer(model: Model):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            scores = pa.array(model.score(utf8(batch.column("text"))), pa.float64())
            columns = [batch.column(c) for c in batch.schema.names if c != "_text"]
            names = [c for c in batch.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays([*columns, scores], names=[*names, "score"])

    return score


def score_quality(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The columns of ``docs`` with ``score`` (0 to 1, higher for quality 1) and ``predicted`` (1 from ``threshold`` on).

    Null and empty texts get the score of a text without words. Repeated rows get equal scores.
    """
    given = docs.withColumn("text", F.col("text").cast("string")).drop("score", "predicted")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema) + ", score double"
    scored = given.mapInArrow(_scorer(model), schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
