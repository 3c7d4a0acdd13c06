"""Quality classifier: a byte-level convolutional network in numpy.

A document's bytes are cut into overlapping chunks that cover all of it. Learned filters run over the
embedded bytes of each chunk, each filter keeps its largest response in the chunk, and the means of these
over the chunks, weighted and summed, give one probability. It is fitted on a bounded sample of labelled
documents (``TRAIN_DOCS``, drawn by hash of the id), each with all its chunks. Scoring reads every byte. Very
long texts go through the filters in blocks of ``CHUNKS_AT_ONCE`` chunks, in training as in scoring.

A NULL text counts as an empty one, which has one empty chunk. Several labels of an id are averaged; of several
texts of a labelled id the least is learned from. Repeated rows are scored each for itself. Where there is no
labelled document that may be learned from, as with an empty table, every score is 0.5. Further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_slices, sampled

CHUNK, HOP, STRIDE = 512, 448, 4
EMBED, FILTERS = 8, 32
#: labelled documents that are learned from at most, each with all its chunks
TRAIN_DOCS = 3000
EPOCHS, BATCH, RATE = 8, 64, 0.01
CHUNKS_AT_ONCE = 512
SPAN = STRIDE * EMBED  # floats of a half window; a window is two halves


def chunks_of(data: bytes) -> np.ndarray:
    """All chunks of a document; the last is filled up with zeros."""
    n = 1 + max(0, -(-(len(data) - CHUNK) // HOP))
    padded = np.zeros((n - 1) * HOP + CHUNK, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::HOP]


class Network:
    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.embed = draw.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.filters = draw.normal(0, 1 / np.sqrt(2 * SPAN), (2 * SPAN, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = draw.normal(0, 0.1, FILTERS).astype(np.float32)
        self.shift = np.zeros(1, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.out, self.shift]

    def pooled(self, chunks: np.ndarray, places: bool = False):
        """Largest response of each filter in each chunk, and where it was."""
        halves = self.embed[chunks].reshape(len(chunks) * (CHUNK // STRIDE), SPAN)
        both = halves @ np.hstack([self.filters[:SPAN], self.filters[SPAN:]])
        both = both.reshape(len(chunks), CHUNK // STRIDE, 2 * FILTERS)
        response = both[:, :-1, :FILTERS] + both[:, 1:, FILTERS:]
        top = np.maximum(response.max(1) + self.bias, 0)
        return (top, response.argmax(1)) if places else top

    def scores(self, texts: list[str | None]) -> np.ndarray:
        sums, seen = np.zeros((len(texts), FILTERS)), np.zeros(len(texts))
        waiting, owners = [], []

        def flush():
            block = np.concatenate(waiting)
            owner = np.repeat(owners, [len(w) for w in waiting])
            for at in range(0, len(block), CHUNKS_AT_ONCE):
                np.add.at(sums, owner[at:at + CHUNKS_AT_ONCE], self.pooled(block[at:at + CHUNKS_AT_ONCE]))
            np.add.at(seen, owner, 1)
            waiting.clear()
            owners.clear()

        for i, text in enumerate(texts):
            waiting.append(chunks_of((text or "").encode("utf-8", "replace")))
            owners.append(i)
            if sum(map(len, waiting)) >= CHUNKS_AT_ONCE:
                flush()
        if waiting:
            flush()
        logits = (sums / seen[:, None]) @ self.out + self.shift
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))

    def step(self, chunks: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean log loss of some documents; owner: document of each chunk."""
        blocks = [slice(at, at + CHUNKS_AT_ONCE) for at in range(0, len(chunks), CHUNKS_AT_ONCE)]
        top, place = (np.concatenate(x) for x in zip(*(self.pooled(chunks[b], places=True) for b in blocks), strict=True))
        share = 1 / np.bincount(owner, minlength=len(labels))
        mean = np.zeros((len(labels), FILTERS))
        np.add.at(mean, owner, top * share[owner, None])
        wrong = (1 / (1 + np.exp(-np.clip(mean @ self.out + self.shift, -30, 30))) - labels) / len(labels)
        back = (wrong[owner] * share[owner])[:, None] * self.out * (top > 0)
        d_filters, d_embed = np.zeros((2 * SPAN, FILTERS)), np.zeros((256, EMBED))
        for b in blocks:
            offsets = place[b][:, :, None] * STRIDE + np.arange(2 * STRIDE)
            window = chunks[b][np.arange(len(offsets))[:, None, None], offsets]  # chunk, filter, byte of the window
            inside = self.embed[window].reshape(len(offsets), FILTERS, 2 * SPAN)
            d_filters += np.einsum("cf,cfk->kf", back[b], inside)
            d_inside = (back[b][:, :, None] * self.filters.T[None]).reshape(-1, EMBED)
            d_embed += np.stack([np.bincount(window.ravel(), d_inside[:, e], minlength=256) for e in range(EMBED)], axis=1)
        return [d_embed, d_filters, back.sum(0), mean.T @ wrong, np.array([wrong.sum()])]

    def train(self, documents: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> None:
        draw = np.random.default_rng(seed)
        first = [np.zeros_like(p, dtype=np.float64) for p in self.parameters()]
        second = [np.zeros_like(p, dtype=np.float64) for p in self.parameters()]
        count, steps = 0, max(1, epochs * -(-len(documents) // BATCH))
        for _ in range(epochs):
            order = draw.permutation(len(documents))
            for at in range(0, len(order), BATCH):
                batch = order[at:at + BATCH]
                cut = [chunks_of(documents[i]) for i in batch]
                owner = np.repeat(np.arange(len(batch)), list(map(len, cut)))
                grads = self.step(np.concatenate(cut), owner, labels[batch])
                count += 1
                rate = RATE * (1 - count / (steps + 1))
                for p, g, a, b in zip(self.parameters(), grads, first, second, strict=True):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    p -= (rate * (a / (1 - 0.9**count)) / (np.sqrt(b / (1 - 0.999**count)) + 1e-8)).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, train_docs: int = TRAIN_DOCS) -> Network:
    """A network from the labelled documents for which ``may_learn`` (a condition on doc_id) holds."""
    marks = labels.select("doc_id", "quality").filter(may_learn & F.col("quality").isNotNull())
    marks = marks.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    share = min(1.0, train_docs / max(1, marks.count()))
    # bounded by train_docs but for the luck of the draw, hence the limit above it
    marks = marks.filter(sampled(F.col("doc_id"), F.lit(share), 3)).limit(2 * train_docs)
    drawn = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(
        F.broadcast(marks), "doc_id"
    )

    # one row of an id, so repeated ids cannot outgrow the bound
    rows = drawn.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label")).collect()
    rows.sort(key=lambda r: str(r["doc_id"]))
    network = Network()
    if rows:
        network.train([r["text"].encode("utf-8", "replace") for r in rows], np.array([r["label"] for r in rows]))
    else:
        network.out[:] = 0
    return network


def score(docs: DataFrame, network: Network, held_out: Column) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def look(batches):
        for part in row_slices(batches):
            found = network.scores(part.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(found, pa.float64()), pa.array((found >= 0.5).astype(np.int32), pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select("doc_id", held_out.alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(look, f"doc_id {kind}, held_out boolean, score double, predicted int")
