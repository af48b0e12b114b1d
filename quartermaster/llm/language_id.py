"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public byte-level vocabulary.  A word -- a run of letters,
lower-cased, with a space before it -- has the probability that a random sequence of pieces spells it: the sum over all its
segmentations, which a forward algorithm over its bytes gives.  Every byte is a piece, so every word has segmentations.  A
text's evidence is the sum of its words' logarithms, and its score the posterior of the language predicted (prior: the
share of the learnt documents; evidence is divided by ``TEMPER``, as the words of a text do not speak independently).

The probabilities are learnt by expectation maximisation from uniform ones: a forward-backward pass gives the expected
number of uses of each piece in each word, weighted by how often the language's learnt documents hold the word.  Word
counts come from all learnt documents, are aggregated in Spark before and after the shuffle, and grow with the input; what
reaches the driver is one number for each language and piece.

Null texts and texts without a letter are ``und`` with score 0, as is every text when no document could be learnt from.
A null language is never learnt; an empty one is a value like any other.  Equal scores go to the smaller value.  Repeated
rows, repeated ids and null ids (whose fold is that of the empty id) keep their rows; learning counts every row.  Words of
any length are scored whole.  Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermaster.llm.bpe import PairTable, load_vocabulary, texts_of
from quartermaster.llm.common import cut, fold_of, map_batches, schema_of

UNKNOWN = "und"
#: Rounds of expectation maximisation, the count added to each piece, and the divisor of a text's evidence.
ROUNDS, SMOOTHING, TEMPER = 3, 0.01, 8.0
#: Bytes of words that a worker's forward pass takes at once, and words whose evidence it remembers.
PASS_BYTES, CACHE_WORDS = 1 << 15, 300_000
#: Longest word summed as plain numbers, and the factor of each of its bytes.
PLAIN_BYTES, BYTE_SCALE = 32, 2.0 ** 20

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """The runs of letters of a text, lower-cased; what ``re`` takes for letters besides is cut out."""
    found = _LETTERS.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for f in found for w in "".join(c if c.isalpha() else " " for c in f).split()]


class Lattice:
    """The pieces of a vocabulary as a trie, and all their occurrences in words."""

    def __init__(self, path: str):
        pieces = load_vocabulary(path).ids
        nodes: dict[tuple[int, int], int] = {}
        token = [-1]
        for raw, i in pieces.items():
            node = 0
            for x in raw:
                node = nodes.setdefault((node, x), len(token))
                if node == len(token):
                    token.append(-1)
            token[node] = i
        self.size = max(pieces.values()) + 1
        self.lengths = np.zeros(self.size, np.int64)
        for raw, i in pieces.items():
            self.lengths[i] = len(raw)
        self.trie = PairTable(np.array([n << 8 | x for n, x in nodes], np.int64), np.fromiter(nodes.values(), np.int64), -1)
        self.token = np.array(token, np.int64)

    def edges(self, words: list[str]) -> "Edges":
        raw = [b" " + w.encode() for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
        word = np.repeat(np.arange(len(raw)), lengths)
        ends = np.cumsum(lengths)
        start = np.arange(len(flat))
        at, node, found = start.copy(), np.zeros(len(flat), np.int64), []
        while len(start):
            node = self.trie.get(node << 8 | flat[at])
            on = node >= 0
            start, at, node = start[on], at[on] + 1, node[on]
            token = self.token[node]
            hit = token >= 0
            found.append((start[hit], at[hit], token[hit]))
            on = at < ends[word[start]]
            start, at, node = start[on], at[on], node[on]
        start, end, token = (np.concatenate(x) for x in zip(*found))
        # states: one before each byte and one after each word's last
        of = word[start]
        return Edges(start + of, end + of, token, of, ends - lengths + np.arange(len(raw)), ends + np.arange(len(raw)))


class Edges:
    """Occurrences of pieces between states of words; states of a word follow one another."""

    def __init__(self, start, end, token, word, first, last):
        self.start, self.end, self.token, self.word, self.first, self.last = start, end, token, word, first, last
        self.states = int(last[-1]) + 1

    def _sweep(self, weight: np.ndarray, source: np.ndarray, target: np.ndarray, place: np.ndarray, begin: np.ndarray, logs: bool) -> np.ndarray:
        """Path sums at every state (or their logarithms); states at the same place of their words are summed side by side."""
        out = np.full((self.states, weight.shape[1]), -np.inf if logs else 0.0)
        out[begin] = 0.0 if logs else 1.0
        order = np.argsort(place * self.states + target)
        source, target, weight = source[order], target[order], weight[order]
        steps = np.flatnonzero(np.append(True, np.diff(place[order]) != 0))
        heads = np.flatnonzero(np.append(True, np.diff(target) != 0))
        cuts = np.searchsorted(heads, steps)
        for a, b, c, d in zip(steps, np.append(steps[1:], len(source)), cuts, np.append(cuts[1:], len(heads))):
            terms, add = (out[source[a:b]] + weight[a:b], np.logaddexp) if logs else (out[source[a:b]] * weight[a:b], np.add)
            out[target[heads[c:d]]] = add.reduceat(terms, heads[c:d] - a, axis=0)
        return out

    def forward(self, weight: np.ndarray, logs: bool = True) -> np.ndarray:
        return self._sweep(weight, self.start, self.end, self.end - self.first[self.word], self.first, logs)

    def backward(self, weight: np.ndarray, logs: bool = True) -> np.ndarray:
        return self._sweep(weight, self.end, self.start, self.last[self.word] - self.start, self.last, logs)


@lru_cache(1)
def lattice(path: str) -> Lattice:
    """One for each worker process and vocabulary."""
    return Lattice(path)


def runs(words: list[str]):
    """Ranges of words of at most ``PASS_BYTES`` code points, or of one longer word."""
    begin, held = 0, 0
    for i, w in enumerate(words):
        if i > begin and held + len(w) > PASS_BYTES:
            yield begin, i
            begin, held = i, 0
        held += len(w) + 1
    if begin < len(words):
        yield begin, len(words)


def log_likelihoods(words: list[str], log_p: np.ndarray, path: str) -> np.ndarray:
    """(words, languages): the logarithm of each word's probability over all its segmentations.

    Words of up to ``PLAIN_BYTES`` bytes are summed as plain numbers, each byte scaled by ``BYTE_SCALE`` so that none leaves
    the range of doubles; longer ones are summed as logarithms, which gives the same but for rounding."""
    out = np.empty((len(words), log_p.shape[1]))
    lat = lattice(path)
    plain = np.exp(log_p + np.log(BYTE_SCALE) * lat.lengths[:, None])
    size = np.array([len(w.encode()) + 1 for w in words], np.int64)
    for chosen, logs in ((np.flatnonzero(size <= PLAIN_BYTES), False), (np.flatnonzero(size > PLAIN_BYTES), True)):
        listed = [words[i] for i in chosen.tolist()]
        for a, b in runs(listed):
            e, at = lat.edges(listed[a:b]), chosen[a:b]
            if logs:
                out[at] = e.forward(log_p[e.token])[e.last]
            else:
                out[at] = np.log(e.forward(plain[e.token], False)[e.last]) - np.log(BYTE_SCALE) * size[at][:, None]
    return out


def expected_uses(words: list[str], language: np.ndarray, count: np.ndarray, log_p: np.ndarray, path: str) -> np.ndarray:
    """(languages, pieces): the expected uses of each piece in the words, each by its language's probabilities."""
    lat = lattice(path)
    uses = np.zeros(log_p.shape[1] * lat.size)
    for a, b in runs(words):
        e = lat.edges(words[a:b])
        own = language[a:b][e.word]
        weight = log_p[e.token, own][:, None]
        ahead, behind = e.forward(weight)[:, 0], e.backward(weight)[:, 0]
        share = np.exp(ahead[e.start] + weight[:, 0] + behind[e.end] - ahead[e.last][e.word])
        uses += np.bincount(own * lat.size + e.token, share * count[a:b][e.word], minlength=len(uses))
    return uses.reshape(log_p.shape[1], lat.size)


def word_counts(learnt: DataFrame, lang: str, text: str) -> DataFrame:
    """(language, word, count) over all learnt documents; a task's batches are summed before the shuffle."""
    def run(batch):
        total: defaultdict[str, Counter] = defaultdict(Counter)
        for own, t in zip(batch.column(lang).to_pylist(), texts_of(batch, text)):
            total[own].update(words_of(t))
        return {"language": [own for own, words in total.items() for _ in words], "word": [w for words in total.values() for w in words],
                "count": [n for words in total.values() for n in words.values()]}

    found = map_batches(learnt.select(lang, text), run, schema_of(("language", T.StringType()), ("word", T.StringType()), ("count", T.LongType())))
    return found.groupBy("language", "word").agg(F.sum("count").alias("count"))


def fit(learnt: DataFrame, path: str, lang: str = "lang", text: str = "text") -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages in order, logarithms of their priors, logarithms of piece probabilities by piece and language)."""
    shares = {r[0]: r[1] for r in learnt.groupBy(lang).count().collect()}  # one row a language
    languages = sorted(shares)
    size = lattice(path).size
    log_p = np.full((size, len(languages)), -np.log(size))
    prior = np.log(np.array([shares[x] for x in languages], float) / max(1, sum(shares.values())))
    if not languages:
        return languages, prior, log_p
    counts = cut(word_counts(learnt, lang, text))
    number = {x: i for i, x in enumerate(languages)}
    out = schema_of(("language", T.IntegerType()), ("piece", T.IntegerType()), ("uses", T.DoubleType()))

    for _ in range(ROUNDS):
        # the model is sent once to each executor, and is one number for each language and piece
        sent = learnt.sparkSession.sparkContext.broadcast(log_p)

        def uses_of(batches):
            total = None
            for batch in batches:
                own = np.array([number[x] for x in batch.column("language").to_pylist()], np.int64)
                n = batch.column("count").to_numpy().astype(float)
                part = expected_uses(batch.column("word").to_pylist(), own, n, sent.value, path)
                total = part if total is None else total + part
            if total is not None:
                at, piece = np.nonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(piece, pa.int32()), pa.array(total[at, piece])], names=out.names)

        found = counts.mapInArrow(uses_of, out).groupBy("language", "piece").agg(F.sum("uses").alias("uses")).toPandas()
        uses = np.full((size, len(languages)), SMOOTHING)
        uses[found["piece"], found["language"]] += found["uses"]
        log_p = np.log(uses / uses.sum(axis=0))
        sent.unpersist()
    return languages, prior, log_p


class Scorer:
    """A worker's scorer, which remembers the evidence of words: a row for each, the last column its number of words."""

    def __init__(self, log_p: np.ndarray, path: str):
        self.log_p, self.path, self.known = log_p, path, {}
        self.table = np.empty((0, log_p.shape[1] + 1))

    def learn(self, seen: set[str]) -> None:
        new = list(seen.difference(self.known))
        if len(self.known) + len(new) > CACHE_WORDS:  # starts anew; results do not depend on it
            self.known, self.table, new = {}, self.table[:0], list(seen)
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        words = [[w] if w.isalpha() else words_of(w) for w in new]
        flat = [w for own in words for w in own]
        found = np.column_stack([log_likelihoods(flat, self.log_p, self.path), np.ones(len(flat))])
        ends = np.cumsum([len(own) for own in words], dtype=np.int64)
        upto = np.concatenate([np.zeros((1, found.shape[1])), np.cumsum(found, axis=0)]) if len(flat) != len(new) else None
        rows = found if upto is None or not len(new) else upto[ends] - upto[np.append(0, ends[:-1])]
        self.table = np.concatenate([self.table, rows.reshape(len(new), -1)])

    def evidence(self, texts: list[str]) -> np.ndarray:
        """(texts, languages): sums over the words of each text; not a number for a text without a letter."""
        runs_of = [_LETTERS.findall(t.lower()) for t in texts]
        self.learn(set().union(*runs_of))
        out = np.zeros((len(texts), self.table.shape[1]))
        of = self.known.__getitem__
        for i, own in enumerate(runs_of):
            out[i] = self.table[np.fromiter(map(of, own), np.int64, len(own))].sum(axis=0)
        out[out[:, -1] == 0] = np.nan
        return out[:, :-1]


_HELD: dict[str, Scorer] = {}


def held_scorer(name: str, log_p: np.ndarray, path: str) -> Scorer:
    """The worker process's scorer of a model, kept from task to task (what it remembers is bounded and changes no result)."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = Scorer(log_p, path)
    return _HELD[name]


def judge(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, held_out, lang_pred, score) of every row, learnt outside the held-out fold."""
    learnt = df.filter(~fold_of(F.col(key)) & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(lang, text)
    languages, prior, log_p = fit(learnt, path, lang, text)
    sent, name = df.sparkSession.sparkContext.broadcast(log_p), uuid.uuid4().hex
    out = schema_of((key, T.LongType()), ("held_out", T.BooleanType()), ("lang_pred", T.StringType()), ("score", T.DoubleType()))

    def run(batches):
        scorer = held_scorer(name, sent.value, path) if languages else None
        for batch in batches:
            texts = texts_of(batch, text)
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if scorer:
                logs = scorer.evidence(texts) / TEMPER + prior
                some = np.flatnonzero(~np.isnan(logs[:, 0]))
                best = logs[some].argmax(axis=1)
                scores[some] = 1 / np.exp(logs[some] - logs[some, best][:, None]).sum(axis=1)
                for i, b in zip(some.tolist(), best.tolist()):
                    names[i] = languages[b]
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores)], names=out.names)

    return df.select(F.col(key).cast("long").alias(key), fold_of(F.col(key)).alias("held_out"), text).mapInArrow(run, out)
