"""Quality classifier by co-training two views of a document.

The content view sees the text (shares of repeated, capital, decorated and rare tokens, punctuation, digits); the
metadata view sees what surrounds it (language, source, length and the layout of lines).  Each view has its own
logistic model over binned features.  In every round each model labels the unlabelled pool, and what it is sure of after
calibration joins the *other* view's training rows; then the calibrated views are combined by a logistic model fitted on
rows that neither view was trained on.  All documents are scored.

Training takes at most ``TRAIN_ROWS`` labelled rows outside the held-out fold and ``POOL_ROWS`` unlabelled ones (both
by hash of the id); copies of a text fall on one side of the calibration split.

Null and empty texts are scored like any other (all shares 0); null metadata count as one more value.  Null labels are
ignored, ids that occur several times in the labels count once with the largest label.  Without both classes every
probability is the smoothed share of good rows, and documents are kept.  Repeated rows are scored alike; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermaster.llm.bpe import texts_of
from quartermaster.llm.common import fold_of, map_batches, schema_of
from quartermaster.llm.toxicity import fit_logistic, sampled_labels

TRAIN_ROWS = 20_000
POOL_ROWS = 20_000
ROUNDS = 4
SURE = 0.98
BINS = 12
RIDGE = 1.0
THRESHOLD = 0.5
MOST = 8.0
CALIBRATION_PARTS = 3

UPPER, LOWER, DIGIT, BLANK, MARK, ODD, HIGH = range(7)
BYTE_CLASS = np.full(256, ODD, np.int64)
BYTE_CLASS[65:91], BYTE_CLASS[97:123], BYTE_CLASS[48:58], BYTE_CLASS[128:] = UPPER, LOWER, DIGIT, HIGH
BYTE_CLASS[[32, 9, 10, 11, 12, 13]] = BLANK
BYTE_CLASS[[46, 44, 59, 58, 63, 39, 34, 45]] = MARK
CONTENT, METADATA = 14, 7
SOURCE_BUCKETS = 64


def content_view(text: str) -> list[float]:
    """Shares that describe the text itself; 0 where there is nothing to share."""
    words = text.split()
    n, raw = len(words), text.encode()
    if not n:
        return [0.0] * CONTENT
    kinds = np.bincount(BYTE_CLASS[np.frombuffer(raw, np.uint8)], minlength=7) / len(raw)
    distinct = len(set(words))
    same = sum(map(eq, words, words[1:]))
    repeated, last, run = 0, None, 0
    if same:
        for w in words:
            run = run + 1 if w == last else 1
            repeated, last = max(repeated, run), w
    bars = words.count("|")
    shouted = sum(map(str.isupper, words))
    decorated = text.count("!! ") + text.count("!!\n") + sum(text.count(s) for s in ("***", "###", "%%%", "&&&", "$$$"))
    letters = kinds[UPPER] + kinds[LOWER] + kinds[HIGH]
    return [distinct / n, same / n, np.log1p(repeated), shouted / n, bars / n, decorated / n,
            kinds[UPPER], kinds[DIGIT], kinds[MARK], kinds[ODD], kinds[BLANK], letters, len(raw) / n,
            (text.count(".") + text.count("!") + text.count("?")) / n]


def metadata_view(text: str, lang: str | None, source: str | None, n_chars: int | None) -> list[float]:
    """Language and source as hash buckets, length, and the layout of the lines."""
    bucket = lambda s: float(zlib.crc32((s or "\0").encode()) % SOURCE_BUCKETS)
    lines = text.split("\n")
    lengths = np.fromiter(map(len, lines), np.float64, len(lines))
    return [bucket(lang), bucket(source), np.log1p(max(0, n_chars or 0)), np.log1p(len(lines)), np.log1p(lengths.mean()),
            np.log1p(lengths.max()), lengths.std() / (1 + lengths.mean())]


class Binned:
    """Logistic model over one-hot quantile bins (values of buckets: one bin each), calibrated by a line on its logits."""

    def __init__(self, x: np.ndarray, y: np.ndarray, buckets: tuple[int, ...] = ()):
        self.buckets = buckets
        self.edges = [None if j in buckets else self.cuts(x[:, j]) for j in range(x.shape[1])]
        self.weights = fit_logistic(self.design(x), y, RIDGE)
        self.line = np.array([1.0, 0.0])

    @staticmethod
    def cuts(x: np.ndarray) -> np.ndarray:
        """Quantiles of all values and of those above zero, and a bin for zero: most shares are zero in most documents."""
        grid = np.linspace(0, 1, BINS + 1)[1:-1]
        some = x[x > 0]
        return np.unique(np.concatenate([np.quantile(x, grid), np.quantile(some, grid) if len(some) else [], [1e-9]]))

    def design(self, x: np.ndarray) -> np.ndarray:
        out = []
        for j, e in enumerate(self.edges):
            at = x[:, j].astype(int) if e is None else np.searchsorted(e, x[:, j], "right")
            out.append(np.eye(SOURCE_BUCKETS if e is None else len(e) + 1)[at])
        return np.column_stack(out)

    def logits(self, x: np.ndarray) -> np.ndarray:
        raw = self.design(x) @ self.weights[:-1] + self.weights[-1]
        return raw * self.line[0] + self.line[1]

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> "Binned":
        self.line = np.array([1.0, 0.0])
        self.line = fit_logistic(self.logits(x)[:, None], y, 1e-3)
        return self


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def held(logits: np.ndarray) -> np.ndarray:
    """Logits between -MOST and MOST: where a view separates the classes, its size says nothing more."""
    return np.clip(logits, -MOST, MOST)


def combine(a: np.ndarray, b: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the two views' logits and a constant; a view that would count against itself has no weight."""
    x = np.column_stack([held(a), held(b)])
    use = [0, 1]
    while True:
        w = fit_logistic(x[:, use], y, RIDGE)
        if (w[:-1] >= 0).all() or len(use) == 1:
            break
        use.remove(use[int(np.argmin(w[:-1]))])
    out = np.zeros(3)
    out[use], out[2] = np.maximum(0.0, w[:-1]), w[-1]
    return out


class QualityModel:
    def __init__(self, prior: float, content: Binned | None = None, metadata: Binned | None = None, joint=None):
        self.prior, self.content, self.metadata, self.joint = prior, content, metadata, joint

    def probabilities(self, c: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of good quality, by content, by metadata, and by both."""
        if self.content is None or not len(c):
            return (np.full(len(c), self.prior),) * 3
        a, b = self.content.logits(c), self.metadata.logits(m)
        return sigmoid(a), sigmoid(b), sigmoid(held(a) * self.joint[0] + held(b) * self.joint[1] + self.joint[2])


def co_train(c: np.ndarray, m: np.ndarray, y: np.ndarray, part: np.ndarray, pool_c: np.ndarray, pool_m: np.ndarray) -> QualityModel:
    """``part`` 0 calibrates the views, part 1 fits their combination, the others train."""
    prior = float((y.sum() + 0.5) / (len(y) + 1)) if len(y) else 1.0
    fit, check, join = part >= 2, part == 0, part == 1
    for need in (fit, check, join):
        if len(np.unique(y[need])) < 2:
            fit = check = join = np.ones(len(y), bool)  # too few labelled rows to set some aside
    if len(np.unique(y[fit])) < 2:
        return QualityModel(prior)
    views = [(c, pool_c, ()), (m, pool_m, (0, 1))]
    given: list[np.ndarray] = [np.full(len(pool_c), np.nan) for _ in views]  # pseudo-labels given to each view
    models: list[Binned] = []
    for round_ in range(ROUNDS + 1):
        models = []
        for (x, pool, buckets), labels in zip(views, given):
            has = ~np.isnan(labels)
            models.append(Binned(np.vstack([x[fit], pool[has]]), np.concatenate([y[fit], labels[has]]), buckets).calibrate(x[check], y[check]))
        if round_ == ROUNDS or not len(pool_c):
            break
        sure = [np.where(p >= SURE, 1.0, np.where(p <= 1 - SURE, 0.0, np.nan))
                for p in (sigmoid(model.logits(pool)) for model, (_, pool, _) in zip(models, views))]
        if all(np.array_equal(a, b, equal_nan=True) for a, b in zip(given, sure[::-1])):
            break
        given = sure[::-1]  # what one view is sure of teaches the other
    a, b = (model.logits(x[join]) for model, (x, _, _) in zip(models, views))
    return QualityModel(prior, models[0], models[1], combine(a, b, y[join]))


VIEWS = [f"c{i}" for i in range(CONTENT)] + [f"m{i}" for i in range(METADATA)]


def both_views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    texts = texts_of(batch)
    meta = zip(*(batch.column(k).to_pylist() for k in ("lang", "source", "n_chars")))
    return (np.array([content_view(t) for t in texts]).reshape(-1, CONTENT),
            np.array([metadata_view(t, *k) for t, k in zip(texts, meta)]).reshape(-1, METADATA))


def view_rows(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns of ``keep`` and both views' features."""
    def run(batch):
        x = np.hstack(both_views(batch))
        return {**{k: batch.column(k) for k in keep}, **{v: pa.array(x[:, i]) for i, v in enumerate(VIEWS)}}

    kinds = schema_of(*((k, docs.schema[k].dataType) for k in keep), *((v, T.DoubleType()) for v in VIEWS))
    return map_batches(docs.select(*keep, "text", "lang", "source", "n_chars"), run, kinds)


def train(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Both samples are bounded, so their features come to the driver."""
    sample = F.broadcast(sampled_labels(labels, "quality", TRAIN_ROWS))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars"))
    labelled = own.join(sample, "doc_id").withColumn("part", F.pmod(F.xxhash64("text"), F.lit(2 + CALIBRATION_PARTS)).cast("int"))
    n = docs.count()
    share = int(1e6 * min(1.0, POOL_ROWS / max(1, n)))
    pool = own.where((F.pmod(F.xxhash64("doc_id", F.lit("pool")), F.lit(1_000_000)) < share) & ~fold_of(F.col("doc_id")))
    pool = pool.join(F.broadcast(labels.select(F.col("doc_id").cast("long").alias("doc_id")).where(
        F.pmod(F.xxhash64("doc_id", F.lit("pool")), F.lit(1_000_000)) < share).distinct()), "doc_id", "left_anti")
    rows = view_rows(labelled, ["part", "y"]).toPandas()
    free = view_rows(pool.withColumn("y", F.lit(0)), ["y"]).toPandas()
    split = lambda f: (f[VIEWS[:CONTENT]].to_numpy(float), f[VIEWS[CONTENT:]].to_numpy(float))
    (c, m), (pool_c, pool_m) = split(rows), split(free)
    return co_train(c, m, (rows["y"] > 0).to_numpy(float), rows["part"].to_numpy(int), pool_c, pool_m)


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, held_out, p_content, p_metadata, score, predicted): probabilities of good quality for every row."""
    def run(batch):
        a, b, p = model.probabilities(*both_views(batch))
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "p_content": pa.array(a, pa.float64()),
                "p_metadata": pa.array(b, pa.float64()), "score": pa.array(p, pa.float64()),
                "predicted": pa.array((p >= THRESHOLD).astype(np.int32))}

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), fold_of(F.col("doc_id")).alias("held_out"), "text", "lang",
                      "source", F.col("n_chars").cast("long").alias("n_chars"))
    kinds = schema_of(("doc_id", T.LongType()), ("held_out", T.BooleanType()), ("p_content", T.DoubleType()),
                      ("p_metadata", T.DoubleType()), ("score", T.DoubleType()), ("predicted", T.IntegerType()))
    return map_batches(own, run, kinds)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, that the model does not reject."""
    model = train(docs, labels)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(model.probabilities(*both_views(batch))[2] >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
