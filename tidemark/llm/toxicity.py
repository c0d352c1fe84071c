"""Toxicity classifier: subword bags, averaged, into a linear softmax.

A text's features are the hashes of its character n-grams, blanks marking where words
begin and end. Their embeddings are averaged, and a linear layer with a softmax gives the
probability. Embeddings and layer are trained jointly, in numpy in one task, from a
bounded sample of labelled rows; only the finished model reaches the driver. An unseen misspelling shares most of its n-grams with the
word it hides, and so their vectors.

Scoring runs where the documents are, over whole texts; the model is of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import quoted
from tidemark.llm.common import map_batches, mix, pieces, slices


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 17
    dim: int = 8
    smallest: int = 3
    largest: int = 5
    epochs: int = 12
    batch: int = 128
    rate: float = 0.3
    #: Labelled rows that training reads at most, those with the least hash of the id.
    sample: int = 4000
    #: Of toxic rows at most, counted within the sample bound.
    sample_toxic: int = 1500
    #: Weight of the clean class against the toxic one: a clean text lost costs more.
    clean_weight: float = 4.0
    #: The mean over hundreds of words leaves little of a few; a fixed scale gives it back.
    scale: float = 10.0


_FIRST_UPPER, _SHIFT = ord("A"), 32


def _characters(text: bytes) -> np.ndarray:
    """Code points in lower case (A-Z by rule, others by Unicode), blanks as one code."""
    points = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le", "replace"), np.uint32)
    blank = (points == 32) | ((points >= 9) & (points <= 13))
    return np.where(blank, np.uint32(32), points)


def ngrams(text: bytes, settings: Settings) -> Iterator[np.ndarray]:
    """Bucket numbers of the n-grams of a text, in parts; none for a blank text."""
    for piece in pieces(text):
        points = np.concatenate([[np.uint32(32)], _characters(piece), [np.uint32(32)]])
        blank = points == 32
        # Words seen up to and including each place: an n-gram holds no blank but at its ends.
        seen = np.cumsum(blank)
        wide = mix(points.astype(np.uint64) + np.uint64(1))
        rolled = wide
        for n in range(2, settings.largest + 1):
            rolled = mix(rolled[:-1]) + wide[n - 1 :]
            if n < settings.smallest:
                continue
            inner = seen[n - 2 : -1] - seen[: -n + 1]
            whole = inner[: len(rolled)] == 0
            hashes = mix(rolled[whole] + np.uint64(n))
            yield ((hashes >> np.uint64(32)) % np.uint64(settings.buckets)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """What scoring needs: for each bucket, the difference of logits that its vector makes."""

    settings: Settings
    weights: np.ndarray
    bias: float

    def score(self, text: bytes) -> float:
        total, n = 0.0, 0
        for part in ngrams(text, self.settings):
            total += float(self.weights[part].sum(dtype=np.float64))
            n += len(part)
        logit = self.bias + (total / n if n else 0.0)
        return float(1.0 / (1.0 + np.exp(-np.clip(logit, -50, 50))))


def train(texts: list[bytes], labels: list[int], settings: Settings = Settings(), seed: int = 11) -> Model:
    """Cross-entropy over two classes, weighed by ``clean_weight``; Adagrad steps.

    With rows of one class only, or none, the model answers with that class's share.
    """
    y = np.array(labels, np.int64)
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 0.01), 0.99)
        return Model(settings, np.zeros(settings.buckets), float(np.log(share / (1 - share))))
    bags = []
    for text in texts:
        parts = list(ngrams(text, settings))
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        found, counts = np.unique(flat, return_counts=True)
        bags.append((found.astype(np.int32), (counts / max(1, len(flat))).astype(np.float32)))
    # Two large arrays in place of thousands of small ones: freed memory goes back at once.
    bounds = np.cumsum([0, *(len(found) for found, _ in bags)])
    all_places = np.concatenate([found for found, _ in bags])
    all_shares = np.concatenate([shares for _, shares in bags])
    del bags
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (settings.buckets, settings.dim)).astype(np.float32)
    layer = rng.normal(0, 0.5, (settings.dim, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    sums = [np.full(x.shape, 1e-8, np.float32) for x in (embed, layer, bias)]
    weight = (len(y) / np.bincount(y, minlength=2) * [settings.clean_weight, 1]).astype(np.float32)
    weight /= settings.clean_weight + 1
    scale = np.float32(settings.scale)
    for epoch in range(settings.epochs):
        order = rng.permutation(len(y))
        rate = settings.rate * (1 - epoch / settings.epochs)
        for start in range(0, len(order), settings.batch):
            chosen = order[start : start + settings.batch]
            sizes = bounds[chosen + 1] - bounds[chosen]
            owner = np.repeat(np.arange(len(chosen)), sizes)
            places = np.concatenate([all_places[bounds[i] : bounds[i + 1]] for i in chosen])
            shares = np.concatenate([all_shares[bounds[i] : bounds[i + 1]] for i in chosen]) * scale
            mean = np.stack(
                [np.bincount(owner, embed[places, d] * shares, len(chosen)) for d in range(settings.dim)], 1
            ).astype(np.float32)
            logits = mean @ layer + bias
            odds = np.exp(logits - logits.max(1, keepdims=True))
            odds /= odds.sum(1, keepdims=True)
            error = odds.copy()
            error[np.arange(len(chosen)), y[chosen]] -= 1
            error *= (weight[y[chosen]] / len(chosen))[:, None]
            back = error @ layer.T
            used, inverse = np.unique(places, return_inverse=True)
            grad = np.stack(
                [np.bincount(inverse, shares * back[owner, d], len(used)) for d in range(settings.dim)], 1
            ).astype(np.float32)
            sums[0][used] += grad**2
            embed[used] -= rate * grad / np.sqrt(sums[0][used])
            for value, g, s in ((layer, mean.T @ error, sums[1]), (bias, error.sum(0), sums[2])):
                s += g**2
                value -= rate * g / np.sqrt(s)
    weights = scale * (embed.astype(np.float64) @ (layer[:, 1] - layer[:, 0]).astype(np.float64))
    return Model(settings, weights, float(bias[1] - bias[0]))


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch.column(batch.num_columns - 1)):
                values = [model.value.score(text) for text in texts]
                rest = [c.slice(first, len(texts)) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(values, pa.float64())], [*batch.schema.names[:-1], "__score"]
                )

    return run


def fit(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """A model from at most ``settings.sample`` labelled rows whose id is not held out.

    Rows without a text, a label or an id, and labels other than 0 and 1, are not learned from. Toxic rows are
    rarer, so they fill half of the sample where there are enough.
    """
    marked = labels.select(quoted(id_col).alias("id"), quoted(label_col).cast("int").alias("y"))
    marked = marked.filter(F.col("y").isin(0, 1) & ~held_out(F.col("id")))
    rank = F.xxhash64("id")
    chosen = [
        marked.filter(F.col("y") == y).orderBy(rank, "id").limit(n)
        for y, n in ((1, settings.sample_toxic), (0, settings.sample - settings.sample_toxic))
    ]
    few = F.broadcast(chosen[0].unionAll(chosen[1]))
    texts = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")).filter("text is not null")
    sample = texts.join(few, "id").orderBy("id", "text", "y").limit(settings.sample)
    trained = map_batches(sample.select("text", "y"), _trained(settings), "weights binary, bias double")
    found = trained.first()
    if found is None:
        return train([], [], settings)
    return Model(settings, np.frombuffer(found["weights"], np.float64), found["bias"])


def _trained(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels = [], []
        for batch in batches:
            texts += [text.encode() for text in batch.column(0).to_pylist()]
            labels += batch.column(1).to_pylist()
        if texts:
            model = train(texts, labels, settings)
            weights = pa.array([model.weights.tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([weights, pa.array([model.bias])], ["weights", "bias"])

    return run


def held_out(ids) -> F.Column:
    return F.pmod(F.crc32(ids.cast("string")), F.lit(5)) == 0


def with_score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``__score``, the probability that a text is toxic.

    Null and blank texts get the score of a text without features.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    columns = [quoted(c).alias(f"c{i}") for i, c in enumerate(names)]
    rows = docs.select(*columns, quoted(text_col).alias("text"))
    schema = rows.drop("text").schema.add("__score", "double")
    scored = map_batches(rows, _scores(shared), schema)
    return scored.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "__score")
