"""Toxicity: a convolutional classifier over hashed words, trained in numpy.

Words, and their first four and five bytes, are hashed to rows of an embedding table, and a word's vector
is the sum of its rows; filters one, two and three words wide slide over the
whole text, each keeps its greatest response, and a logistic layer turns the responses into a score.
Only the text enters the score. The classifier is fitted on a bounded sample of labelled rows; scoring
reads every word of every text, on the executors. The scale of the scores is fitted on rows of the sample that
training did not see. Thresholds, of best F1, come from the scores of all labelled rows that training did not
take, counted on Spark by language and label.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.llm import words as W
from tracewell.llm.filters import filter_of
from tracewell.llm.tables import free_name, stored

#: Labelled rows of each class that training may take, chosen by a hash of their id.
SAMPLE_ROWS = 4000
#: Longer texts are left out of the training sample (not of scoring).
SAMPLE_WORDS = 20_000

BUCKETS = 1 << 14
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 6
BATCH = 32
RATE = 0.05
#: Texts of average make-up that are added to each class when a bucket's log odds are taken.
SHRINK = 30
#: The row of the embedding table that stands beyond a text's end.
PADDING = 3 * BUCKETS
PREDICTED_FROM = 0.3
#: Labelled rows of each class, not trained on, that a language needs for a threshold of its own.
LEAST_LABELS = 20
#: Steps of the counted scores' log odds.
STEPS = 64


def feature_ids(found: W.Words) -> np.ndarray:
    """(words x 3) rows of the embedding table: of the word, of its first four and first five bytes."""
    length = found.end - found.start
    out = np.empty((len(found), 3), dtype=np.int32)
    if not len(found):
        return out
    out[:, 0] = found.hash >> np.uint64(50)
    total = np.zeros(len(found), dtype=np.uint64)
    last = len(found.lower) - 1
    for j in range(5):
        byte = np.where(j < length, found.lower[np.minimum(found.start + j, last)], 0)
        total = W.mixed(total + byte.astype(np.uint64) + np.uint64(1))
        if j >= 3:
            out[:, j - 2] = (total >> np.uint64(50)).astype(np.int32) + BUCKETS * (j - 2)
    return out


@dataclass
class Classifier:
    """Embedding table (last row: padding), filters (all widths side by side), output layer and scale."""

    embedding: np.ndarray
    filters: list[np.ndarray]
    shifts: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = PREDICTED_FROM

    def responses(self, ids: np.ndarray, first: np.ndarray):
        """Responses (places x filters), the padded word features and where each text begins there.

        Every text is followed by two words of padding, so that each filter has a place in it, and
        places that begin in the padding count only for a text without words.
        """
        rows, count = len(first) - 1, np.diff(first)
        begin = first[:-1] + 2 * np.arange(rows)
        padded = np.full((len(ids) + 2 * rows, 3), PADDING, dtype=np.int32)
        padded[np.arange(len(ids)) + 2 * np.repeat(np.arange(rows), count)] = ids
        vectors = self.embedding[padded[:, 0]]
        vectors += self.embedding[padded[:, 1]]
        vectors += self.embedding[padded[:, 2]]
        out = np.empty((len(padded), len(self.shifts)), dtype=np.float32)
        for k, f in enumerate(self.filters):
            own = vectors @ f[0]
            for j in range(1, len(f)):
                own[:-j] += (vectors @ f[j])[j:]
            out[:, k * FILTERS: (k + 1) * FILTERS] = own
        out[begin + count + 1] = -np.inf
        out[(begin + count)[count > 0]] = -np.inf
        return out, vectors, padded, begin

    def pooled(self, response: np.ndarray, begin: np.ndarray) -> np.ndarray:
        if not len(begin):
            return np.zeros((0, len(self.shifts)), dtype=np.float32)
        return np.maximum(np.maximum.reduceat(response, begin, axis=0) + self.shifts, 0)

    def margins(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        response, _, _, begin = self.responses(ids, first)
        return self.pooled(response, begin) @ self.weights + self.bias

    def scores(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Scores of the texts whose words are ids[first[r]:first[r + 1]]."""
        return _logistic(self.slope * self.margins(ids, first).astype(np.float64) + self.offset)


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


#: Rows of the three kinds of features stand one after the other in the embedding table; texts of the
#: sample hold them without that, in two bytes each.
_KINDS = np.array([0, BUCKETS, 2 * BUCKETS], dtype=np.int32)


def _flat(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return (np.concatenate(texts) if texts else np.zeros((0, 3), dtype=np.uint16)) + _KINDS, first


def start(texts: list[np.ndarray], labels: np.ndarray, rng) -> Classifier:
    """Before training: the first dimension holds each bucket's log odds over texts, shrunk where it
    is rare, which points the filters at telling words; all else is small noise."""
    seen = np.zeros((2, PADDING + 1))
    for t, y in zip(texts, labels):
        seen[int(y), np.unique(t + _KINDS)] += 1
    size = np.array([[max((labels == y).sum(), 1)] for y in (0, 1)])
    overall = (seen.sum(0) + 0.5) / size.sum()
    share = (seen + SHRINK * overall) / (size + SHRINK)
    embedding = rng.normal(0, 0.02, (PADDING + 1, DIMENSIONS)).astype(np.float32)
    embedding[:, 0] = np.clip(np.log(share[1] / share[0]), -3, 3) / 3
    embedding[PADDING] = 0
    filters = []
    for width in WIDTHS:
        f = rng.normal(0, 0.1, (width, DIMENSIONS, FILTERS)).astype(np.float32)
        f[0, 0, :] += 1
        filters.append(f)
    n = FILTERS * len(WIDTHS)
    return Classifier(embedding, filters, np.zeros(n, dtype=np.float32), np.full(n, 2 / n, dtype=np.float32), -2.0)


def train(texts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Classifier:
    """Fit by Adagrad on the logistic loss; gradients flow through the place of each greatest response."""
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, dtype=np.float32)
    model = start(texts, labels, rng)
    past = {"embedding": np.full(PADDING + 1, 1e-2, dtype=np.float32), "bias": 1e-2,
            "filters": [np.full(f.shape, 1e-2, dtype=np.float32) for f in model.filters],
            "shifts": np.full(model.shifts.shape, 1e-2, dtype=np.float32),
            "weights": np.full(model.weights.shape, 1e-2, dtype=np.float32)}
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for part in np.array_split(order, max(1, len(texts) // BATCH)):
            if len(part):
                _step(model, past, *_flat([texts[k] for k in part]), labels[part])
    return model


def _step(model: Classifier, past, ids, first, labels) -> None:
    response, vectors, padded, begin = model.responses(ids, first)
    pooled = model.pooled(response, begin)
    wrong = ((_logistic(pooled @ model.weights + model.bias) - labels) / len(labels)).astype(np.float32)
    back = wrong[:, None] * model.weights[None, :] * (pooled > 0)
    stops = [*begin[1:].tolist(), len(padded)]
    best = np.stack([b + response[b:e].argmax(0) for b, e in zip(begin.tolist(), stops)])

    grown = np.zeros((len(padded), DIMENSIONS), dtype=np.float32)
    for k, f in enumerate(model.filters):
        own, at = back[:, k * FILTERS: (k + 1) * FILTERS], best[:, k * FILTERS: (k + 1) * FILTERS]
        step = np.zeros_like(f)
        for j in range(len(f)):
            spots = np.minimum(at + j, len(padded) - 1)
            step[j] = np.einsum("rfd,rf->df", vectors[spots], own)
            np.add.at(grown, spots.ravel(), (own[:, :, None] * f[j].T[None]).reshape(-1, DIMENSIONS))
        past["filters"][k] += step ** 2
        f -= RATE * step / np.sqrt(past["filters"][k])
    for name, step in (("shifts", back.sum(0)), ("weights", pooled.T @ wrong + 1e-4 * model.weights)):
        past[name] += step ** 2
        setattr(model, name, (getattr(model, name) - RATE * step / np.sqrt(past[name])).astype(np.float32))
    past["bias"] += float(wrong.sum()) ** 2
    model.bias -= RATE * float(wrong.sum()) / np.sqrt(past["bias"])

    touched = np.flatnonzero(grown.any(1))
    rows, slot = np.unique(padded[touched].ravel(), return_inverse=True)
    step = np.zeros((len(rows), DIMENSIONS), dtype=np.float32)
    np.add.at(step, slot, np.repeat(grown[touched], 3, axis=0))
    past["embedding"][rows] += (step ** 2).mean(1)
    model.embedding[rows] -= RATE * step / np.sqrt(past["embedding"][rows])[:, None]
    model.embedding[PADDING] = 0


def calibrate(model: Classifier, texts, labels: np.ndarray, clean_share: float) -> None:
    """Fit the scale of the scores on rows not trained on.

    ``clean_share`` is how many labelled clean rows one sampled clean row stands for.
    """
    if not len(texts):
        return
    margins = np.concatenate([model.margins(*_flat(texts[k: k + BATCH])) for k in range(0, len(texts), BATCH)])
    weight = np.where(labels == 1, 1.0, clean_share)
    slope, offset = 1.0, 0.0
    for _ in range(300):
        p = _logistic(slope * margins + offset)
        wrong = weight * (p - labels) / weight.sum()
        slope -= 0.5 * (float((wrong * margins).sum()) + 1e-3 * (slope - 1))
        offset -= 0.5 * float(wrong.sum())
    if slope > 0.05:
        model.slope, model.offset = slope, offset


def best_threshold(steps, toxic, clean, otherwise: float) -> float:
    """The threshold of best F1 for the weights of toxic and clean rows in each step of the log odds; of
    equals the one nearest the middle of the gap it lies in."""
    steps, slot = np.unique(np.asarray(steps, dtype=np.int64), return_inverse=True)
    hits, false = np.bincount(slot, toxic, len(steps)), np.bincount(slot, clean, len(steps))
    if not hits.sum() or not false.sum():
        return otherwise
    cuts = np.concatenate([[steps[0]], (steps[1:] + steps[:-1] + 1) / 2]) / STEPS
    right, wrong = np.cumsum(hits[::-1])[::-1], np.cumsum(false[::-1])[::-1]
    f1 = 2 * right / (right + wrong + hits.sum())
    return float(_logistic(cuts[int(f1.argmax())]))


def _label_ids(batch) -> np.ndarray:
    return W.mixed(batch.column(0).to_numpy().view(np.uint64))


def _label_steps(model, known):
    """doc_id, lang and step of the log odds of the documents whose id the filter knows."""

    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(known.value.has(_label_ids(batch))))
            steps = [np.zeros(0)]
            for piece in W.pieces(batch.column(2)):
                found = W.words_of(piece, W.ALNUM)
                margins = model.value.margins(feature_ids(found), found.first).astype(np.float64)
                steps.append(np.floor(np.clip(model.value.slope * margins + model.value.offset, -30, 30) * STEPS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.concatenate(steps).astype(np.int32))],
                names=["doc_id", "lang", "step"])

    return run


def take_thresholds(model: Classifier, texts: DataFrame, marked: DataFrame, trained: list[tuple[int, int]]) -> None:
    """Thresholds from all rows of ``marked`` (doc_id, toxic) whose documents were not ``trained`` on.

    Documents are scored on the executors, and what leaves them are counts by language, label and step. A
    class that training took much of weighs as much as before. Languages with fewer than ``LEAST_LABELS``
    of either class keep the general threshold.
    """
    spark = texts.sparkSession
    taken = spark.createDataFrame(sorted({(d,) for d, _ in trained}), "doc_id long")
    marked = marked.join(F.broadcast(taken), "doc_id", "left_anti")
    known = spark.sparkContext.broadcast(filter_of(marked.select("doc_id"), _label_ids, marked.count(), twice=False))
    steps = (
        texts.select("doc_id", F.col("lang").cast("string").alias("lang"), "text").filter("doc_id is not null")
        .mapInArrow(_label_steps(spark.sparkContext.broadcast(model), known), "doc_id long, lang string, step int")
    )
    counts = stored(
        steps.join(marked, "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.struct("lang", "step")).alias("own"))
        .groupBy("own.lang", "own.step", "toxic").agg(F.count("*").alias("n")), "toxicity-counts")

    def by_class(*keys):
        return counts.groupBy(*keys).agg(*(F.sum(F.when(F.col("toxic") == y, F.col("n")).otherwise(0)).alias(f"n{y}") for y in (0, 1)))

    rows = by_class("step").collect()
    left = [sum(r[f"n{y}"] for r in rows) for y in (0, 1)]
    weight = [(left[y] + sum(x == y for _, x in trained)) / max(left[y], 1) for y in (0, 1)]

    def best(rows, otherwise):
        return best_threshold([r["step"] for r in rows], [r["n1"] * weight[1] for r in rows], [r["n0"] * weight[0] for r in rows], otherwise)

    if not rows:
        return
    model.threshold = best(rows, PREDICTED_FROM)
    enough = by_class("lang").filter(f"lang is not null and n0 >= {LEAST_LABELS} and n1 >= {LEAST_LABELS}").select("lang")
    by_lang: dict[str, list] = {}
    for r in by_class("lang", "step").join(enough, "lang").toLocalIterator():
        by_lang.setdefault(r["lang"], []).append(r)
    for lang, own in by_lang.items():
        model.thresholds[lang] = best(own, model.threshold)


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def _id_rows(batches):
    for batch in batches:
        ids = []
        for piece in W.pieces(batch.column(0)):
            found = W.words_of(piece, W.ALNUM)
            flat = (feature_ids(found) - _KINDS).astype(np.uint16)
            ids.extend(flat[lo:hi].tobytes() for lo, hi in zip(found.first[:-1], found.first[1:]))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), *batch.columns[1:]],
                                         names=["ids", *batch.schema.names[1:]])


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Classifier:
    """Train and calibrate on at most ``sample_rows`` rows of each class, take thresholds from all others too;
    held-out rows are never used.

    A document with several label rows counts once for each class it is given. Rows without id, text
    or label are passed over. With no rows, or one class only, the scores carry no information and
    the classifier stays as it starts.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marked = marked.filter("doc_id is not null and toxic in (0, 1)").filter(~held_out()).distinct()
    sizes = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for label in (0, 1):
        part = marked.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").filter("text is not null")
    rows = (
        texts.join(F.broadcast(chosen), "doc_id")
        .select("text", "toxic", F.xxhash64("doc_id").alias("draw"), "doc_id")
        .mapInArrow(_id_rows, "ids binary, toxic int, draw long, doc_id long")
        .filter(F.length("ids") <= 6 * SAMPLE_WORDS)
        .dropDuplicates(["doc_id", "toxic"])
        .orderBy("draw", "doc_id", "toxic")
    )
    ids, toxic, docs = [], [], []
    for r in rows.toLocalIterator():
        ids.append(np.frombuffer(bytes(r["ids"]), dtype=np.uint16).reshape(-1, 3))
        toxic.append(r["toxic"])
        docs.append(r["doc_id"])
    toxic = np.array(toxic, dtype=np.int64)
    apart = np.arange(len(ids)) % 4 == 3
    model = train([t for t, x in zip(ids, apart) if not x], toxic[~apart])
    taken = {k: max(int((toxic == k).sum()), 1) for k in (0, 1)}
    clean_share = (sizes.get(0, 0) / taken[0]) / max(sizes.get(1, 0) / taken[1], 1e-9) if sizes.get(1) else 1.0
    calibrate(model, [t for t, x in zip(ids, apart) if x], toxic[apart], max(clean_share, 1e-3))
    del ids
    if sizes:
        take_thresholds(model, texts, marked, [(d, int(y)) for d, y, x in zip(docs, toxic, apart) if not x])
    return model


def score(documents: DataFrame, model: Classifier, column: str = "score") -> DataFrame:
    """``documents`` with a score in the new column ``column``; null texts are scored as empty ones."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    at = [c.lower() for c in documents.columns].index("text")
    schema = T.StructType([*documents.schema, T.StructField(column, T.DoubleType())])

    def scored(batches):
        model = sent.value
        for batch in batches:
            out = [np.zeros(0)]
            for piece in W.pieces(batch.column(at)):
                found = W.words_of(piece, W.ALNUM)
                out.append(model.scores(feature_ids(found), found.first))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out))], names=schema.names)

    return documents.mapInArrow(scored, schema)


def threshold_of(model: Classifier, lang) -> F.Column:
    """The threshold of a row's language, or the general one."""
    out = F.lit(model.threshold)
    for name, value in sorted(model.thresholds.items()):
        out = F.when(lang == name, F.lit(value)).otherwise(out)
    return out


def report(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= 0.3), threshold and rejected for every document."""
    model = fit(documents, labels, sample_rows)
    scored = score(documents.select("doc_id", "text", "lang"), model)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= PREDICTED_FROM).cast("int").alias("predicted"),
        threshold_of(model, F.col("lang")).alias("threshold"),
        (F.col("score") >= threshold_of(model, F.col("lang"))).alias("rejected"),
    )


def without_toxic(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that score below the threshold of their language, with their own columns."""
    model = fit(documents, labels, sample_rows)
    name = free_name(documents, "score")
    return score(documents, model, name).filter(F.col(name) < threshold_of(model, F.col("lang"))).drop(name)
