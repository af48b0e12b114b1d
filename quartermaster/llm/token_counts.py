"""Token counts at every prefix.

For byte-level BPE the encoding of a prefix is that of a shorter prefix plus one last token, and the last token is the
only token ending there that forms a *stable* pair with the last token of the shorter prefix (the pair encodes to
itself).  So a dynamic programme over prefixes gives the exact number of tokens at every prefix of a piece; pieces are
independent, hence a text's table is the chain of its pieces' tables, corrected where a cut would join characters to
another piece than the whole text does (the last character of a run of white space; contractions; special strings).

The table is kept as differences of counts, one 16-bit number for each code point.  From it, "how many tokens are the
first n characters" and "which longest prefix fits a budget" are sums and searches; nothing is encoded again.

Null text counts as the empty text: an empty table, 0 tokens.  Repeated rows give repeated results; other columns of
the input are ignored, whatever their names.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermaster.llm.bpe import (LONG_PIECE, PairTable, PieceCache, load_vocabulary, one_special,
                                   piece_runs, texts_of)
from quartermaster.llm.common import map_batches, schema_of

UNKNOWN = 2
#: Token pairs a worker remembers as stable or not; the table starts anew beyond it.
CACHE_PAIRS = 1_000_000


class PrefixCounter:
    def __init__(self, path: str):
        self.vocabulary = v = load_vocabulary(path)
        self.special = one_special(v)
        listed = list(v.ids)
        _, counts = v.merge_many(listed)
        own = [b for b, n in zip(listed, counts.tolist()) if n == 1]  # tokens that encode to themselves
        self.longest = max(map(len, own))
        self.own = {b: v.ids[b] for b in own}
        nodes: dict[tuple[int, int], int] = {}
        token = [-1]
        for b in own:
            node = 0
            for x in b:
                if (step := nodes.get((node, x))) is None:
                    step = nodes[node, x] = len(token)
                    token.append(-1)
                node = step
            token[node] = v.ids[b]
        self.trie = PairTable(np.array([n << 8 | x for n, x in nodes], np.int64), np.fromiter(nodes.values(), np.int64), -1)
        self.token = np.array(token, np.int64)
        self.stable = PairTable(np.zeros(0, np.int64), np.zeros(0, np.int64), UNKNOWN)
        self.cache = PieceCache(self.piece_tables)

    def stable_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        got = self.stable.get(keys)
        if (new := keys[got == UNKNOWN]).size:
            new = np.unique(new)
            if self.stable.count + len(new) > CACHE_PAIRS:
                self.stable = PairTable(np.zeros(0, np.int64), np.zeros(0, np.int64), UNKNOWN)
                new = np.unique(keys)
            of = self.vocabulary.bytes_of
            a, b = new >> 32, new & 0xFFFFFFFF
            ids, counts = self.vocabulary.merge_many([of[x] + of[y] for x, y in zip(a.tolist(), b.tolist())])
            first = ids[np.cumsum(counts) - counts]
            self.stable.add(new, ((counts == 2) & (first == a)).astype(np.int64))
            got = self.stable.get(keys)
        return got == 1

    def counts_at_bytes(self, pieces: list[bytes]) -> np.ndarray:
        """Token counts after every byte of non-empty pieces, one piece after the other."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        ends = np.cumsum(lengths)
        begin, end = np.repeat(ends - lengths, lengths), np.repeat(ends, lengths)
        found, start = [], np.arange(len(flat))
        at, node = start.copy(), np.zeros(len(flat), np.int64)
        while len(start):
            node = self.trie.get(node << 8 | flat[at])
            on = node >= 0
            start, at, node = start[on], at[on], node[on]
            token = self.token[node]
            hit = token >= 0
            found.append((start[hit], at[hit], token[hit]))
            at = at + 1
            on = at < end[start]
            start, at, node = start[on], at[on], node[on]
        start, last_byte, token = (np.concatenate(x) for x in zip(*found))
        rel = last_byte - begin[last_byte]
        order = np.argsort(rel, kind="stable")
        start, last_byte, token, rel = start[order], last_byte[order], token[order], rel[order]
        steps = np.searchsorted(rel, np.arange(int(lengths.max()) + 1))
        last, count = np.full(len(flat), -1, np.int64), np.zeros(len(flat), np.int64)
        for a, b in zip(steps, steps[1:]):
            s, e, t = start[a:b], last_byte[a:b], token[a:b]
            whole = s == begin[s]
            last[e[whole]], count[e[whole]] = t[whole], 1
            rest = ~whole
            s, e, t = s[rest], e[rest], t[rest]
            open_ = last[e] < 0
            s, e, t = s[open_], e[open_], t[open_]
            if len(s):
                ok = self.stable_pairs(last[s - 1], t)
                s, e, t = s[ok], e[ok], t[ok]
                last[e], count[e] = t, count[s - 1] + 1
        return count

    def counts_of_long(self, piece: bytes) -> np.ndarray:
        """The same programme for one piece of any length, byte by byte."""
        own, known, of = self.own, {}, self.vocabulary.bytes_of
        last, count = [-1] * len(piece), np.zeros(len(piece), np.int64)
        for e in range(len(piece)):
            for s in range(max(0, e + 1 - self.longest), e + 1):
                if (t := own.get(piece[s:e + 1])) is None:
                    continue
                if s:
                    pair = last[s - 1], t
                    if pair not in known:
                        known[pair] = self.vocabulary.parts(of[pair[0]] + of[t]) == [of[pair[0]], of[t]]
                    if not known[pair]:
                        continue
                last[e], count[e] = t, (count[s - 1] if s else 0) + 1
                break
        return count

    def piece_tables(self, pieces: list[str]) -> list[bytes]:
        raw = [p.encode() for p in pieces]
        short = [i for i, b in enumerate(raw) if len(b) <= LONG_PIECE]
        out: list[bytes] = [b""] * len(pieces)
        groups = [(short, self.counts_at_bytes([raw[i] for i in short]))] if short else []
        groups += [([i], self.counts_of_long(b)) for i, b in enumerate(raw) if len(b) > LONG_PIECE]
        for numbers, counts in groups:
            data = b"".join([raw[i] for i in numbers])
            ends_char = np.append((np.frombuffer(data, np.uint8)[1:] & 0xC0) != 0x80, True)
            counts = counts[ends_char]
            chars = np.array([len(pieces[i]) for i in numbers], np.int64)
            ends = np.cumsum(chars)
            before = np.empty_like(counts)
            before[0], before[1:] = 0, counts[:-1]
            before[ends - chars] = 0
            table, at = (counts - before).astype("<i2").tobytes(), (2 * ends).tolist()
            for i, a, b in zip(numbers, [0, *at], at):
                out[i] = table[a:b]
        for i, p in enumerate(pieces):
            if p in ("'re", "'ve", "'ll"):  # a cut after the second character leaves a quote and a letter
                total = int(np.frombuffer(out[i], "<i2").sum())
                out[i] = np.array([1, 1, total - 2], "<i2").tobytes()
        return out

    def tables(self, texts: list[str]) -> list[np.ndarray]:
        """For each text, the change of the token count at each of its code points."""
        s = self.special
        if s is None or not any(s in t for t in texts):
            return self._plain(texts)
        split = [t.split(s) for t in texts]
        parts = iter(self._plain([p + s[:-1] * (k < len(own) - 1) for own in split for k, p in enumerate(own)]))
        out = []
        for own in split:
            rows = []
            for k, p in enumerate(own):
                table = next(parts)
                rows.append(table)
                if k < len(own) - 1:  # at the special string's last character it becomes one token after p's own
                    rows.append(np.array([1 - int(table[len(p):].sum())], np.int16))
            out.append(np.concatenate(rows))
        return out

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        parts: list[list[bytes]] = [[] for _ in texts]
        ragged = {}
        get = self.cache.__getitem__
        for run in piece_runs(texts, note=lambda i, t, at, ends: ragged.__setitem__(i, (t, at, ends))):
            self.cache.learn(run)
            for i, pieces in run:
                parts[i].append(b"".join(map(get, pieces)))
            self.cache.forget_long(run)
        out = [np.frombuffer(b"".join(p), "<i2") for p in parts]
        for i, (t, at, ends) in ragged.items():
            out[i] = table = out[i].copy()
            begins = at[np.searchsorted(at, ends) - 1]
            for a, p in zip(begins.tolist(), ends.tolist()):
                joint = len(self.vocabulary.parts(t[a:p + 1].encode())) - int(table[a:p].sum())
                table[p + 1] += table[p] - joint
                table[p] = joint
        return out


@lru_cache(2)
def counter(path: str) -> PrefixCounter:
    """One counter for each worker process and vocabulary."""
    return PrefixCounter(path)


def tokens_of_prefix(table: np.ndarray, chars: int) -> int:
    """Exact token count of the text's first ``chars`` code points."""
    return int(table[:chars].sum(dtype=np.int64))


def longest_prefix(table: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    fits = np.flatnonzero(np.cumsum(table, dtype=np.int64) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def prefix_tables(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, table binary): little-endian 16-bit changes of the token count, one for each code point."""
    def run(batch):
        tables = counter(path).tables(texts_of(batch, text))
        return {key: batch.column(key), "table": [t.astype("<i2").tobytes() for t in tables]}

    return map_batches(df.select(key, text), run, schema_of((key, df.schema[key].dataType), ("table", T.BinaryType())))


def count(df: DataFrame, path: str, budget: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit, fits_chars): totals, whether they pass the budget, and the longest prefix
    within it, all read from the prefix tables."""
    def run(batch):
        texts = texts_of(batch, text)
        tables = counter(path).tables(texts)
        n = [tokens_of_prefix(t, len(t)) for t in tables]
        return {key: batch.column(key), "n_bytes": [len(t.encode()) for t in texts], "n_tokens": n,
                "over_limit": [x > budget for x in n],
                "fits_chars": [len(t) if x <= budget else longest_prefix(t, budget) for t, x in zip(tables, n)]}

    out = schema_of((key, T.LongType()), ("n_bytes", T.LongType()), ("n_tokens", T.LongType()),
                    ("over_limit", T.BooleanType()), ("fits_chars", T.LongType()))
    return map_batches(df.select(F.col(key).cast("long").alias(key), text), run, out)
