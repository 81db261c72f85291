"""Quality classifier: a convolutional network over the bytes of a text, in numpy.

A filter is ``WIDTH`` tables of a weight for each byte; its response at a position is the sum of the weights of the
bytes there. Blocks of ``STRIDE`` positions are max-pooled, and two neighbouring blocks make a chunk, so chunks overlap
by half and cover the whole text, however long. A document's features are the largest, the mean and the least
value of each filter over its chunks; a logistic unit turns them into one probability.

Only the text is an input. Filters and unit are learned together by Adam from at most ``TRAIN_ROWS`` labelled rows,
taken by a hash of the id, in equal shares of the two labels as far as there are; of a text longer than
``TRAIN_CHUNKS`` chunks, evenly spaced ones. Scoring uses every byte.

A null or empty text has zero features and gets the score of the bias. Labels that are null, rows held out and labels
without a document are not learned from. Without any label the score is 0.5. Repeated ids are scored row by row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import slices

WIDTH, FILTERS = 5, 16
STRIDE = 256
TRAIN_ROWS, TRAIN_CHUNKS = 2000, 32
EPOCHS, BATCH, RATE = 8, 64, 0.02
_PIECE = 1 << 15


def _chunks(data: bytes, most: int | None = None) -> np.ndarray:
    """The chunks of a text as rows of ``2 * STRIDE + WIDTH - 1`` bytes, filled up with zeros; and none for none."""
    n = len(data)
    if not n:
        return np.zeros((0, 2 * STRIDE + WIDTH - 1), np.uint8)
    count = max(1, -(-n // STRIDE) - 1)
    room = np.zeros((count + 1) * STRIDE + WIDTH - 1, np.uint8)
    room[:n] = np.frombuffer(data, np.uint8)[: len(room)]
    which = np.arange(count) if not most or count <= most else np.linspace(0, count - 1, most).astype(int)
    return room[which[:, None] * STRIDE + np.arange(2 * STRIDE + WIDTH - 1)]


class Network:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.tables = rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32)
        self.weights = np.zeros(3 * FILTERS, np.float32)
        self.bias = np.zeros(1, np.float32)

    # --- learning, on batches of chunks

    def _pool(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        response = self.tables[0][chunks[:, : 2 * STRIDE]]
        for k in range(1, WIDTH):
            response += self.tables[k][chunks[:, k : 2 * STRIDE + k]]
        # Positions in the filling hold no byte; the first position of a chunk always does.
        response[chunks[:, : 2 * STRIDE] == 0] = -np.inf
        response[:, 0][np.isinf(response[:, 0])] = 0
        at = response.argmax(1)
        return np.take_along_axis(response, at[:, None], 1)[:, 0], at

    def _step(self, chunks: np.ndarray, owner: np.ndarray, labels: np.ndarray, weight: np.ndarray):
        """Gradients of the weighted log loss for documents whose chunks are given; ``owner`` rises."""
        pooled, at = self._pool(chunks)
        starts = np.searchsorted(owner, np.arange(len(labels)))
        n = np.diff(np.concatenate((starts, [len(owner)])))[:, None]
        top, low = np.maximum.reduceat(pooled, starts), np.minimum.reduceat(pooled, starts)
        mean = np.add.reduceat(pooled, starts) / n
        features = np.concatenate((top, mean, low), 1)
        p = 1 / (1 + np.exp(-np.clip(features @ self.weights + self.bias, -30, 30)))
        slope = ((p - labels) * weight / len(labels)).astype(np.float32)
        down = slope[:, None] * self.weights
        g = (down[:, FILTERS : 2 * FILTERS] / n)[owner]
        g = g + down[owner, :FILTERS] * (pooled == top[owner]) + down[owner, 2 * FILTERS :] * (pooled == low[owner])
        tables = np.zeros_like(self.tables)
        rows, columns = np.arange(len(chunks))[:, None], np.arange(FILTERS)[None, :]
        for k in range(WIDTH):
            np.add.at(tables[k], (chunks[rows, at + k], np.broadcast_to(columns, at.shape)), g)
        return tables, features.T @ slope, slope.sum(keepdims=True)

    def fit(self, texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> Network:
        cut = [_chunks(t, TRAIN_CHUNKS) for t in texts]
        used = np.array([k for k, c in enumerate(cut) if len(c)], int)
        labels = np.asarray(labels, np.float32)
        shares = np.bincount(labels.astype(int), minlength=2)
        if not len(used) or not shares.all():
            self.bias[:] = 0 if not len(labels) else 4 * (labels.mean() - 0.5)
            return self
        weight = (len(labels) / (2 * shares))[labels.astype(int)].astype(np.float32)
        parameters = [self.tables, self.weights, self.bias]
        first, second = ([np.zeros_like(p) for p in parameters] for _ in range(2))
        rng, step = np.random.default_rng(seed), 0
        for epoch in range(epochs):
            for batch in np.array_split(rng.permutation(used), -(-len(used) // BATCH)):
                chunks = np.concatenate([cut[k] for k in batch])
                owner = np.repeat(np.arange(len(batch)), [len(cut[k]) for k in batch])
                step += 1
                rate = RATE * (1 - epoch / epochs)
                for p, g, m, v in zip(
                    parameters, self._step(chunks, owner, labels[batch], weight[batch]), first, second, strict=True
                ):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
        return self

    # --- scoring, over all bytes of many texts

    def scores(self, texts: list[bytes]) -> np.ndarray:
        sizes = np.array([len(t) for t in texts], np.int64)
        blocks = -(-sizes // STRIDE)
        out = np.full((len(texts), 3 * FILTERS), 0, np.float32)
        for k in np.flatnonzero(blocks):
            pooled = self._blocks(texts[k], int(blocks[k]))
            chunk = np.maximum(pooled[:-1], pooled[1:]) if len(pooled) > 1 else pooled
            out[k] = np.concatenate((chunk.max(0), chunk.mean(0), chunk.min(0)))
        return 1 / (1 + np.exp(-np.clip((out @ self.weights + self.bias).astype(np.float64), -30, 30)))

    def _blocks(self, data: bytes, count: int) -> np.ndarray:
        room = np.zeros(count * STRIDE + WIDTH - 1, np.uint8)
        room[: len(data)] = np.frombuffer(data, np.uint8)
        out = []
        for a in range(0, count * STRIDE, _PIECE):
            n = min(_PIECE, count * STRIDE - a)
            response = self.tables[0][room[a : a + n]]
            for k in range(1, WIDTH):
                response += self.tables[k][room[a + k : a + n + k]]
            response[room[a : a + n] == 0] = -np.inf
            response[::STRIDE][np.isinf(response[::STRIDE])] = 0
            out.append(response.reshape(-1, STRIDE, FILTERS).max(1))
        return np.concatenate(out)


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_quality(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    rows: int = TRAIN_ROWS,
) -> Network:
    """Learn from at most ``rows`` rows of ``labels`` that are not held out."""
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    order = F.xxhash64(F.col("doc_id").cast("string"))
    some = known.where("label = 0").orderBy(order, "doc_id").limit(rows // 2).unionByName(
        known.where("label = 1").orderBy(order, "doc_id").limit(rows // 2)
    )
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    span = (2 * STRIDE) * TRAIN_CHUNKS

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of a long text, evenly spaced stretches that add up to the bound."""
        for batch in batches:
            out = []
            for t in batch["text"].to_pylist():
                data = (t or "").encode("utf-8", "surrogatepass")
                if len(data) > span:
                    starts = np.linspace(0, len(data) - 2 * STRIDE, TRAIN_CHUNKS).astype(int).tolist()
                    data = b"".join(data[s : s + 2 * STRIDE] for s in starts)
                out.append(data)
            yield pa.RecordBatch.from_arrays([batch["label"], pa.array(out, pa.binary())], ["label", "data"])

    sample = (
        named.join(F.broadcast(some), "doc_id")  # at most ``rows`` rows
        .dropDuplicates(["doc_id"])
        .orderBy(order, "doc_id")
        .limit(rows)
        .select("label", "text")
        .mapInArrow(shorten, "label int, data binary")
        .toPandas()
    )
    return Network().fit([bytes(b) for b in sample["data"]], sample["label"].to_numpy())


def quality_scores(docs: DataFrame, network: Network, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``score double`` and ``predicted int``."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("double")
    def score(texts):
        return texts.__class__(
            shared.value.scores([t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]), dtype="float64"
        )

    scored = docs.withColumn("score", score(F.col(text)))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
