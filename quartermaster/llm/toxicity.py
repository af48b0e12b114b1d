"""Toxicity after noisy-channel deobfuscation.

A character language model (byte trigrams of words, counted over every document) and a channel of disguises make a
lattice for each token that holds any of them: digits and symbols that stand for letters, separators put between letters, letters
repeated, letters spaced out.  Viterbi decoding finds the likeliest plain reading, and the likeliest one in which every
disguise is a letter; the *restored* text is scored, the words as written with it.

Scoring: the evidence of a word is the largest weight among the word and its beginnings of 3 to 6 letters; a document's
score is a calibrated logistic function of its strongest evidence
and its length.  Weights are lower confidence bounds of log-odds over
labelled training rows, calibrated out of fold.  Training takes at most ``TRAIN_ROWS`` labelled rows (by hash of the
id), never held-out ones, and weighs every feature of ``MIN_TOXIC`` toxic ones; the language model covers all rows.

Null and empty texts have no evidence and get the score of none.  Null labels and ids that occur several times in the
labels count once, toxic if any row says so.  Without both classes to learn from every score is the smoothed share of
toxic rows.  Repeated rows are scored alike; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermaster.llm.bpe import texts_of
from quartermaster.llm.common import cut, fold_of, map_batches, schema_of

TRAIN_ROWS = 20_000
MIN_TOXIC = 5
#: Standard errors by which a weight is lowered.
SURENESS = 2.0
THRESHOLD = 0.3
FOLDS = 5
CACHE_TOKENS = 400_000
#: Longest token that a worker remembers.
LONG_TOKEN = 64

#: Symbols and the letters they stand for (fixed values of common disguises).
DISGUISES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
             "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i"}
SEPARATORS = ".-_*~·'`,/:"
EDGE = "\"#%&()*+,-./:;<=>?[\\]^_`{|}~!'«»“”„…¿¡ "
LETTER = re.compile(r"[^\W\d_]")
PLAIN = re.compile(r"[^\W\d_]+")
RUN = re.compile(r"(?s:(.)\1*)")
DOUBLED = re.compile(r"([^\W\d_])\1")
SPACED = re.compile(r"(?<!\S)(?:\S[ \t]){2,}\S(?!\S)")
CHANNEL = re.compile("[" + re.escape("".join(DISGUISES) + SEPARATORS) + "]")
DISGUISED = re.compile("[" + re.escape("".join(DISGUISES)) + "]")
#: Characters that can only be a boundary or nothing at the ends of a token, so taking them off changes no reading.
BARE_EDGE = "".join(c for c in EDGE if c not in DISGUISES)

# Symbols of the language model: a boundary (0), a to z, bytes of 128 and more.
SYMBOLS = 155
SYMBOL_OF = np.zeros(256, np.int64)
SYMBOL_OF[97:123] = np.arange(1, 27)
SYMBOL_OF[65:91] = np.arange(1, 27)
SYMBOL_OF[128:] = np.arange(27, 155)
LM_BYTES = 1 << 20


# ---- character language model -------------------------------------------------------------------------------------

def count_trigrams(df: DataFrame, text: str = "text") -> dict[int, int]:
    """Counts of the trigrams of symbols over all rows; the alphabet bounds the result, not the data."""
    out = pa.schema([("gram", pa.int64()), ("n", pa.int64())])

    def run(batches):
        total, pending, size = np.zeros(SYMBOLS ** 3, np.int64), [], 0

        def flush():
            s = SYMBOL_OF[np.frombuffer(b"  ".join([b"", *pending, b""]), np.uint8)]
            np.add(total, np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS ** 3), out=total)

        for batch in batches:
            for t in texts_of(batch, text):
                raw = t.lower().encode()
                for a in range(0, len(raw), LM_BYTES):  # consecutive parts share two bytes, so no trigram is lost or new
                    pending.append(raw[a:a + LM_BYTES] if a == 0 else raw[a - 2:a + LM_BYTES])
                    size += len(pending[-1])
                    if size >= LM_BYTES:
                        flush()
                        pending, size = [], 0
        flush()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], schema=out)

    grams = df.select(text).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r["gram"]: r["n"] for r in grams.collect()}


class CharModel(dict):
    """Trigrams interpolated with bigrams and single symbols: trigram -> its logarithm, worked out when first asked for."""

    def __init__(self, trigrams: dict[int, int], weight: float = 5.0):
        super().__init__()
        self.k = weight
        self.tri, self.bi, self.uni, self.context1, self.context2 = trigrams, Counter(), Counter(), Counter(), Counter()
        for g, n in trigrams.items():
            a, b, c = g // SYMBOLS ** 2, g // SYMBOLS % SYMBOLS, g % SYMBOLS
            self.context2[a * SYMBOLS + b] += n
            self.bi[b * SYMBOLS + c] += n
            self.context1[b] += n
            self.uni[c] += n
        self.total = sum(self.uni.values())

    def __missing__(self, g: int) -> float:
        ab, b, c = g // SYMBOLS, g // SYMBOLS % SYMBOLS, g % SYMBOLS
        one = (self.uni[c] + 1) / (self.total + SYMBOLS)
        two = (self.bi[b * SYMBOLS + c] + self.k * one) / (self.context1[b] + self.k)
        self[g] = p = math.log((self.tri.get(g, 0) + self.k * two) / (self.context2[ab] + self.k))
        return p

    def log_p(self, a: int, b: int, c: int) -> float:
        return self[(a * SYMBOLS + b) * SYMBOLS + c]


# ---- noisy channel ------------------------------------------------------------------------------------------------

@lru_cache(1 << 16)
def readings_of(c: str, n: int, letters: bool) -> list[tuple[str, float]]:
    """What a run of ``n`` (three or more: 3) equal characters may stand for, with the logarithms of the probabilities."""
    if LETTER.match(c):
        return [(c, 0.0)] if n == 1 else [(c, -2.0 if n == 2 else -0.7), (c * 2, -0.2 if n == 2 else -0.7)]
    readings = [] if letters and c in DISGUISES else [(" ", -3.0)]
    if c in SEPARATORS or c.isspace():
        readings.append(("", -0.5))
    for x in DISGUISES.get(c, ""):
        readings += [(x, -0.7), (x * 2, -1.5)] if n > 1 else [(x, -0.5)]
    return readings


def lattice(token: str, letters: bool = False) -> list[list[tuple[str, float]]]:
    """For each run of equal characters, its readings with the logarithms of their channel probabilities; with
    ``letters`` every disguise stands for a letter."""
    return [readings_of(m[1], min(3, m.end() - m.start()), letters) for m in RUN.finditer(token)]


@lru_cache(1 << 16)
def options_of(c: str, n: int, letters: bool) -> list[tuple[str, float, tuple[int, ...]]]:
    """The readings with their symbols."""
    return [(reading, cost, tuple(SYMBOL_OF[np.frombuffer(reading.encode(), np.uint8)].tolist())) for reading, cost in readings_of(c, n, letters)]


def decode(token: str, model: CharModel, letters: bool = False) -> str:
    """The likeliest plain reading of a token of any length; boundaries are blanks.

    A state is the last two symbols; its reading is a chain of links to the states before, so a step costs the same
    wherever in the token it is."""
    best: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for options in [*(options_of(m[1], min(3, m.end() - m.start()), letters) for m in RUN.finditer(token)), [(" ", 0.0, (0,))]]:
        step: dict[int, tuple[float, tuple | None]] = {}
        for before, (score, link) in best.items():
            for reading, cost, own in options:
                state, s = before, score + cost
                for z in own:
                    last = state % SYMBOLS
                    if z or last:  # further boundaries cost nothing
                        s += model[state * SYMBOLS + z]
                        state = last * SYMBOLS + z
                if state not in step or step[state][0] < s:
                    step[state] = (s, (link, reading) if reading else link)
        best = step
    _, link = max(best.values(), key=itemgetter(0))
    out = []
    while link is not None:
        link, reading = link
        out.append(reading)
    return "".join(reversed(out)).strip()


def suspicious(token: str) -> bool:
    return bool(" " in token or CHANNEL.search(token) or DOUBLED.search(token))


class Restorer(dict):
    """Token -> its distinct words as written and as restored; tokens a worker has seen are remembered (bounded)."""

    def __init__(self, model: CharModel):
        super().__init__()
        self.model = model
        self.weight_of: WordWeights | None = None

    def __missing__(self, token: str) -> tuple[str, ...]:
        known = tuple(self._words(token))
        if len(token) <= LONG_TOKEN:
            if len(self) >= CACHE_TOKENS:
                self.clear()
            self[token] = known
        return known

    def _words(self, token: str) -> set[str]:
        bare = token.strip(BARE_EDGE)
        if bare.isalpha() and not DOUBLED.search(bare):
            return {bare}
        words = set(PLAIN.findall(token))
        for form in {bare, token.strip(EDGE)}:
            if form and suspicious(form):
                words.update(decode(form, self.model).split())
                if DISGUISED.search(form):  # the plain words are there already, so a disguise may not be a boundary only
                    words.update(decode(form, self.model, True).split())
        return words

    def words(self, text: str) -> set[str]:
        low = text.lower()
        tokens = set(low.split())
        for m in SPACED.finditer(low):
            tokens.add(" ".join(m[0].split()))  # each blank may be a boundary or nothing
        return set(chain.from_iterable(map(self.__getitem__, tokens)))


# ---- evidence and training ----------------------------------------------------------------------------------------

def features(word: str) -> list[str]:
    return [word + "$", *(word[:n] for n in range(3, min(6, len(word)) + 1))]


class WordWeights(dict):
    """The largest weight among a word's features (0 if none is above), remembered for words seen before (bounded)."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHE_TOKENS:
            self.clear()
        get = self.weights.get
        self[word] = w = max(0.0, *[get(f, 0.0) for f in features(word)])
        return w


def evidence(words: set[str], weight_of: WordWeights) -> tuple[float, float, float]:
    """The two largest word weights above zero, and the logarithm of the number of words (more words, more chances)."""
    found = sorted(filter(None, map(weight_of.__getitem__, words)), reverse=True)[:2] if weight_of.weights else []
    found += [0.0, 0.0]
    return found[0], found[1], math.log1p(len(words))


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Lower confidence bounds of the features' log-odds."""
    t, c = toxic + 0.5, clean + 0.5
    return np.log(t / (n_toxic + 1) / (c / (n_clean + 1))) - SURENESS * np.sqrt(1 / t + 1 / c)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 100) -> np.ndarray:
    """Damped Newton steps for a ridge logistic regression (convex, so any start ends at the same fit); the last
    coefficient is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6

    def loss(w):
        z = x @ w
        return np.logaddexp(0.0, z).sum() - y @ z + 0.5 * penalty @ (w * w)

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        grad = x.T @ (p - y) + penalty * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), grad)
        size, gain = 1.0, grad @ step
        while (new := loss(w - size * step)) > now - 1e-4 * size * gain and size > 1e-8:
            size /= 2
        if new >= now:
            break
        w, done, now = w - size * step, now - new < 1e-9 * (1 + abs(now)), new
        if done:
            break
    return w


def sampled_labels(labels: DataFrame, column: str, most: int) -> DataFrame:
    """(doc_id, y) of labelled rows outside the held-out fold: all, or about ``most`` of them chosen by hash of the id."""
    own = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & ~fold_of(F.col("doc_id")))
    own = own.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(column).cast("int").alias("y"))
    n = own.count()
    return own if n <= most else own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1e6 * most / n))


def knots_of(x: np.ndarray) -> list[list[float]]:
    """For the two evidences, quantiles of their positive values, at which the logistic function may bend."""
    return [[0.0, *np.unique(np.quantile(c[c > 0], [0.2, 0.4, 0.6, 0.8, 0.95])).tolist()] if (c > 0).any() else [0.0]
            for c in x[:, :2].T]


def bent(x: np.ndarray, knots: list[list[float]]) -> np.ndarray:
    return np.column_stack([*(np.maximum(0.0, x[:, i] - k) for i in (0, 1) for k in knots[i]), x[:, 2]])


class ToxicityModel:
    def __init__(self, trigrams: dict[int, int], weights: dict[str, float], knots: list[list[float]], coefficients: np.ndarray):
        self.trigrams, self.weights, self.knots, self.coefficients = trigrams, weights, knots, coefficients

    def scores(self, restorer: Restorer, texts: list[str]) -> list[float]:
        """``restorer`` remembers the words' weights, too: a worker has one restorer for one model."""
        if restorer.weight_of is None:
            restorer.weight_of = WordWeights(self.weights)
        x = bent(np.array([evidence(restorer.words(t), restorer.weight_of) for t in texts]).reshape(-1, 3), self.knots)
        return (1 / (1 + np.exp(-np.clip(x @ self.coefficients[:-1] + self.coefficients[-1], -500, 500)))).tolist()


def train(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    trigrams = count_trigrams(docs)
    sample = sampled_labels(labels, "toxic", TRAIN_ROWS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")

    def restored(batch):
        restorer = Restorer(CharModel(trigrams))
        return {"y": batch.column("y"), "fold": batch.column("fold"),
                "words": [sorted(restorer.words(t)) for t in texts_of(batch)]}

    # copies of a text share a fold
    rows = rows.select("text", "y", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold"))
    kinds = schema_of(("y", T.IntegerType()), ("fold", T.IntegerType()), ("words", T.ArrayType(T.StringType())))
    rows = cut(map_batches(rows, restored, kinds))
    n = np.zeros((FOLDS, 2), int)  # by fold and label
    for r in rows.groupBy("fold", "y").count().collect():
        n[r["fold"], int(r["y"] > 0)] += r["count"]
    n_clean, n_toxic = n.sum(axis=0)
    if not n_toxic or not n_clean:
        prior = math.log((n_toxic + 0.5) / (n_clean + 0.5)) if n_toxic + n_clean else 0.0
        return ToxicityModel(trigrams, {}, [[0.0], [0.0]], np.array([0.0, 0.0, 0.0, prior]))

    def in_toxic(batch):
        c = Counter(f for ws in batch.column("words").to_pylist() for f in {f for w in ws for f in features(w)})
        return {"feature": list(c), "n": list(c.values())}

    counted = map_batches(rows.where("y > 0"), in_toxic, schema_of(("feature", T.StringType()), ("n", T.LongType())))
    counted = counted.groupBy("feature").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_TOXIC)
    listed = sorted(r["feature"] for r in counted.select("feature").collect())  # TRAIN_ROWS and MIN_TOXIC bound them
    number = {f: i for i, f in enumerate(listed)}

    def by_class(batch):
        seen: Counter[int] = Counter()
        for y, fold, ws in zip(*(batch.column(c).to_pylist() for c in ("y", "fold", "words"))):
            seen.update({number[f] * 2 * FOLDS + 2 * fold + (y > 0) for w in ws for f in features(w) if f in number})
        cells = np.fromiter(seen, np.int64, len(seen))
        at, row = np.unique(cells // (2 * FOLDS), return_inverse=True)
        table = np.zeros((len(at), 2 * FOLDS), np.int64)
        table[row, cells % (2 * FOLDS)] = np.fromiter(seen.values(), np.int64, len(seen))
        return {"i": pa.array(at), **{f"n{k}": pa.array(table[:, k]) for k in range(2 * FOLDS)}}

    columns = [f"n{k}" for k in range(2 * FOLDS)]
    sums = map_batches(rows, by_class, schema_of(*((c, T.LongType()) for c in ("i", *columns))))
    table = np.zeros((len(listed), FOLDS, 2), np.int64)
    for r in sums.groupBy("i").agg(*(F.sum(c).alias(c) for c in columns)).collect():
        table[r["i"]] = np.array([r[c] for c in columns]).reshape(FOLDS, 2)

    def weighed(counts, of_all):
        w = log_odds(counts[:, 1], counts[:, 0], of_all[1], of_all[0])
        return {f: float(x) for f, x, t in zip(listed, w, counts[:, 1]) if x > 0 and t >= MIN_TOXIC - 1}

    other = [weighed(table.sum(axis=1) - table[:, k], n.sum(axis=0) - n[k]) for k in range(FOLDS)]

    def out_of_fold(batch):
        weights = [WordWeights(w) for w in other]
        got = [evidence(set(ws), weights[fold]) for fold, ws in zip(batch.column("fold").to_pylist(), batch.column("words").to_pylist())]
        return {"y": batch.column("y"), **{c: [g[k] for g in got] for k, c in enumerate("abc")}}

    seen = map_batches(rows, out_of_fold, schema_of(("y", T.IntegerType()), *((c, T.DoubleType()) for c in "abc"))).collect()
    x, y = np.array([[r["a"], r["b"], r["c"]] for r in seen]), np.array([r["y"] > 0 for r in seen], float)
    knots = knots_of(x)
    return ToxicityModel(trigrams, weighed(table.sum(axis=1), n.sum(axis=0)), knots, fit_logistic(bent(x, knots), y, 0.1))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    def run(batches):
        restorer = Restorer(CharModel(model.trigrams))
        for batch in batches:
            s = model.scores(restorer, texts_of(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s, pa.float64()),
                                              pa.array([int(x >= THRESHOLD) for x in s], pa.int32())],
                                             names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), fold_of(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, that the model does not call toxic."""
    model = train(docs, labels)
    return filter_rows(docs, lambda: Restorer(CharModel(model.trigrams)),
                       lambda restorer, texts: [x < THRESHOLD for x in model.scores(restorer, texts)])


def filter_rows(docs: DataFrame, setup, keep, text: str = "text") -> DataFrame:
    """Rows whose text passes; every column is handed through unchanged."""
    def run(batches):
        state = setup()
        for batch in batches:
            yield batch.filter(pa.array(keep(state, texts_of(batch, text)), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
