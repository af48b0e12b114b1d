"""Byte-level BPE encoding and decoding.

Pre-tokenisation is vectorised and uses no regular expression.  Every code point of a batch is mapped to one of a
few classes (letter, number, space, ...).  A class is a transition function of a small automaton, the functions
compose associatively, and their closure is a small monoid, so one blocked prefix scan over the monoid's
multiplication table gives the automaton's state at every code point; a table lookup of (class, state before) then
tells where a piece begins.  Pieces feed a pair merger with a bounded per-worker cache.  ``encode`` keeps the byte
offset of every token; ``decode`` places token bytes by them, so any token range can be decoded alone.

Null text counts as the empty text, which has no tokens.  Repeated rows give repeated results; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermaster.llm.common import map_batches, schema_of

# Classes of code points.  END stands between two texts of a batch.
END, LETTER, NUMBER, OTHER, SPACE, WHITE, QUOTE2, QUOTE3 = range(8)
# States after a code point: START also follows white space that never joins the next piece.
START, S_SPACE, S_LETTER, S_NUMBER, S_OTHER, ONE_LEFT, TWO_LEFT, CONTRACTED = range(8)
#: Code points with the property White_Space (fixed values of Unicode).
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SENTINEL = 0x110000
WINDOW = 1 << 19
#: Pieces a worker remembers; when full, the cache starts anew (results do not depend on it).
CACHE_PIECES = 400_000
LONG_PIECE = 96
#: Pieces handled at once.
RUN_PIECES = 100_000
NO_RANK = (1 << 31) - 1


@lru_cache(1)
def class_table() -> np.ndarray:
    """The class of every code point, and END at SENTINEL."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(SENTINEL)), np.uint8, SENTINEL)
    out[WHITE_SPACE] = WHITE
    out[32] = SPACE
    return np.append(out, np.uint8(END))


@lru_cache(1)
def automaton():
    """The monoid of the transition functions: (element of each class, product table, states by element and state,
    whether a piece begins by class and state before)."""
    functions = [
        (START,) * 8,                                                                    # END
        tuple({ONE_LEFT: CONTRACTED, TWO_LEFT: ONE_LEFT}.get(s, S_LETTER) for s in range(8)),  # LETTER
        (S_NUMBER,) * 8, (S_OTHER,) * 8, (S_SPACE,) * 8, (START,) * 8,                   # NUMBER OTHER SPACE WHITE
        tuple(S_OTHER if s in (S_SPACE, S_OTHER) else ONE_LEFT for s in range(8)),       # QUOTE2
        tuple(S_OTHER if s in (S_SPACE, S_OTHER) else TWO_LEFT for s in range(8)),       # QUOTE3
    ]
    elements = {tuple(range(8)): 0}
    for f in functions:
        elements.setdefault(f, len(elements))
    todo = list(elements)
    while todo:
        f = todo.pop()
        for g in functions:
            h = tuple(g[f[s]] for s in range(8))
            if h not in elements:
                elements[h] = len(elements)
                todo.append(h)
    listed = list(elements)
    k = len(listed)
    product = np.array([[elements[tuple(g[f[s]] for s in range(8))] for g in listed] for f in listed], np.uint8)
    joins = {LETTER: (S_LETTER, S_SPACE, ONE_LEFT, TWO_LEFT), NUMBER: (S_NUMBER, S_SPACE),
             OTHER: (S_OTHER, S_SPACE), QUOTE2: (S_OTHER, S_SPACE), QUOTE3: (S_OTHER, S_SPACE)}
    begins = np.array([[s not in joins.get(c, ()) for s in range(8)] for c in range(8)])
    return np.array([elements[f] for f in functions], np.uint8), product.ravel(), k, np.array(listed, np.uint8), begins


def prefix_products(x: np.ndarray, product: np.ndarray, k: int, block: int = 64) -> np.ndarray:
    """Inclusive prefix products of monoid elements: within blocks side by side, then over the blocks' totals."""
    n = len(x)
    if n <= block:
        out = x.copy()
        for i in range(1, n):
            out[i] = product[int(out[i - 1]) * k + int(x[i])]
        return out
    blocks = -(-n // block)
    cols = np.zeros(blocks * block, np.uint8)  # 0 is the identity
    cols[:n] = x
    cols = np.ascontiguousarray(cols.reshape(blocks, block).T)
    for j in range(1, block):
        cols[j] = product[cols[j - 1].astype(np.intp) * k + cols[j]]
    before = np.zeros(blocks, np.uint8)
    before[1:] = prefix_products(cols[-1], product, k, block)[:-1]
    out = product[(before.astype(np.intp) * k)[None, :] + cols]
    return out.T.reshape(-1)[:n]


def piece_starts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether a piece begins at each code point, whether it ends a run of two or more white space before other text).

    ``codes`` holds texts as code points, each followed by SENTINEL; it is scanned in windows, the state carried on.
    """
    of_class, product, k, states, begins = automaton()
    classes, n = class_table(), len(codes)
    starts, run_ends = np.empty(n, bool), np.empty(n, bool)
    state, last_white = START, False
    for a in range(0, n, WINDOW):
        b = min(n, a + WINDOW)
        code = np.full(b - a + 2, SENTINEL, np.uint32)
        seen = codes[a:min(n, b + 2)]
        code[:len(seen)] = seen
        cls = classes[code]
        q = np.flatnonzero(code[:b - a] == 39)
        if len(q):
            c1, c2 = code[q + 1], code[q + 2]
            two = np.isin(c1, [115, 116, 109, 100])                                      # 's 't 'm 'd
            three = (((c1 == 114) | (c1 == 118)) & (c2 == 101)) | ((c1 == 108) & (c2 == 108))  # 're 've 'll
            cls[q[two]], cls[q[three]] = QUOTE2, QUOTE3
        here = cls[:b - a]
        after = states.ravel()[prefix_products(of_class[here], product, k).astype(np.intp) * 8 + state]
        before = np.empty_like(after)
        before[0], before[1:] = state, after[:-1]
        white = (cls == SPACE) | (cls == WHITE)
        follows = np.empty(b - a, bool)
        follows[0], follows[1:] = last_white, white[:b - a - 1]
        last = ~white[1:b - a + 1] & (cls[1:b - a + 1] != END)
        starts[a:b] = np.where(white[:b - a], ~follows | last, begins.ravel()[here.astype(np.intp) * 8 + before])
        run_ends[a:b] = white[:b - a] & follows & last
        state, last_white = int(after[-1]), bool(white[b - a - 1])
    return starts, run_ends


def batch_pieces(texts: list[str], limit: int = WINDOW):
    """For each text in order: (text, places where its pieces begin plus its length, places of run ends)."""
    group, size = [], 0
    for i, t in enumerate(texts):
        group.append(t)
        size += len(t) + 1
        if size >= limit or i == len(texts) - 1:
            yield from _group_pieces(group)
            group, size = [], 0


def _group_pieces(group: list[str]):
    lengths = np.fromiter(map(len, group), np.int64, len(group))
    ends = np.cumsum(lengths + 1)
    codes = np.empty(int(ends[-1]), np.uint32)
    codes[ends - 1] = SENTINEL
    keep = np.ones(len(codes), bool)
    keep[ends - 1] = False
    codes[keep] = np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts, run_ends = piece_starts(codes)
    at, runs = np.flatnonzero(starts), np.flatnonzero(run_ends)
    cuts, run_cuts = np.searchsorted(at, ends - 1, "right"), np.searchsorted(runs, ends - 1)
    a = r = 0
    for t, end, n, c, rc in zip(group, ends.tolist(), lengths.tolist(), cuts.tolist(), run_cuts.tolist()):
        base = end - 1 - n
        yield t, at[a:c] - base, runs[r:rc] - base  # at END a "piece" begins: the text's length
        a, r = c, rc


def piece_runs(texts: list[str], size: int = RUN_PIECES, note=None):
    """Lists of (number of the text, some of its pieces), about ``size`` pieces in a list.

    ``note(number, text, places, run ends)`` is told of every text that has run ends.
    """
    out, held = [], 0
    for i, (t, at, run_ends) in enumerate(batch_pieces(texts)):
        if note and len(run_ends):
            note(i, t, at, run_ends)
        for c in range(0, max(1, len(at) - 1), size):
            cut = at[c:c + size + 1].tolist()
            out.append((i, [t[a:b] for a, b in zip(cut, cut[1:])]))
            held += len(cut)
            if held >= size:
                yield out
                out, held = [], 0
    if out:
        yield out


class PairTable:
    """A growing open-addressing table from 64-bit keys to integers, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int):
        self.missing, self.count = missing, 0
        self._alloc(max(1 << 10, 4 * len(keys)))
        self.add(keys, values)

    def _alloc(self, least: int) -> None:
        self.bits = int(least - 1).bit_length()
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, self.missing, np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Keys are distinct and not yet in the table."""
        if 3 * (self.count + len(keys)) > len(self.keys):
            used = self.keys >= 0
            keys, values = np.concatenate([self.keys[used], keys]), np.concatenate([self.values[used], values])
            self._alloc(6 * len(keys))
            self.count = 0
        self.count += len(keys)
        slot, mask = self._slot(keys), len(self.keys) - 1
        while len(keys):
            free = np.flatnonzero(self.keys[slot] < 0)
            self.keys[slot[free]] = keys[free]
            self.values[slot[free]] = values[free]
            lost = self.keys[slot] != keys
            placed = np.flatnonzero(~lost)
            self.values[slot[placed]] = values[placed]
            keys, values, slot = keys[lost], values[lost], (slot[lost] + 1) & mask

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], self.missing)
        again = np.flatnonzero((there != keys) & (there >= 0))
        while len(again):
            slot_a = (slot[again] + 1) & (len(self.keys) - 1)
            slot[again] = slot_a
            there = self.keys[slot_a]
            hit = there == keys[again]
            out[again[hit]] = self.values[slot_a[hit]]
            again = again[~hit & (there >= 0)]
        return out


class Vocabulary:
    """Token ids and merge ranks by token bytes; special strings (ids of their own) when the file names some."""

    def __init__(self, ids: dict[bytes, int], ranks: dict[bytes, int], special: dict[str, int]):
        self.ids, self.ranks, self.special = ids, ranks, special
        self.bytes_of = {i: b for b, i in ids.items()} | {i: s.encode() for s, i in special.items()}
        self.byte_ids = np.array([ids[bytes([b])] for b in range(256)], np.int64)
        pairs = [(ids[b[:k]] << 32 | ids[b[k:]], r, ids[b]) for b, r in ranks.items() for k in range(1, len(b))
                 if b[:k] in ids and b[k:] in ids]
        self.pair_ranks = PairTable(np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64), NO_RANK)
        self.id_of_rank = np.zeros(max(ranks.values()) + 1, np.int64)
        for b, r in ranks.items():
            self.id_of_rank[r] = ids[b]

    def merge_many(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces one after the other, how many each has): every round merges one pair in each piece."""
        counts = np.zeros(len(pieces), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []  # (numbers of pieces, their ids one after the other)
        long = [i for i, p in enumerate(pieces) if len(p) > LONG_PIECE]
        for i in long:
            ids = np.array([self.ids[x] for x in self.parts(pieces[i])], np.int64)
            counts[i] = len(ids)
            done.append((np.array([i]), ids))
        own = np.array([i for i, p in enumerate(pieces) if 0 < len(p) <= LONG_PIECE], np.int64)
        lengths = np.array([len(pieces[i]) for i in own.tolist()], np.int64)
        tokens = self.byte_ids[np.frombuffer(b"".join([pieces[i] for i in own.tolist()]), np.uint8)]
        ranks = self._ranks(tokens, lengths)
        while len(own):
            begins = np.cumsum(lengths) - lengths
            best = np.minimum.reduceat(ranks << 32 | np.arange(len(ranks)), begins)
            going = (best >> 32) != NO_RANK
            if not going.all():
                counts[own[~going]] = lengths[~going]
                stay = np.repeat(going, lengths)
                done.append((own[~going], tokens[~stay]))
                own, lengths, tokens, ranks = own[going], lengths[going], tokens[stay], ranks[stay]
                best = best[going]
                if not len(own):
                    break
                moved = np.cumsum(stay) - 1
                at = moved[best & 0xFFFFFFFF]
            else:
                at = best & 0xFFFFFFFF
            tokens[at] = self.id_of_rank[best >> 32]
            ranks[at] = ranks[at + 1]  # NO_RANK at a piece's last token
            keep = np.ones(len(tokens), bool)
            keep[at + 1] = False
            tokens, ranks = tokens[keep], ranks[keep]
            at -= np.arange(len(at))
            lengths -= 1
            ends = np.cumsum(lengths)
            right = at[at + 1 < ends]
            ranks[right] = self.pair_ranks.get(tokens[right] << 32 | tokens[right + 1])
            left = at[at > ends - lengths] - 1
            ranks[left] = self.pair_ranks.get(tokens[left] << 32 | tokens[left + 1])
        out = np.empty(int(counts.sum()), np.int64)
        begins = np.cumsum(counts) - counts
        for numbers, ids in done:
            n = counts[numbers]
            out[np.repeat(begins[numbers] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return out, counts

    def _ranks(self, tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        ranks = np.full(len(tokens), NO_RANK, np.int64)
        if len(tokens) > 1:
            ranks[:-1] = self.pair_ranks.get(tokens[:-1] << 32 | tokens[1:])
            ranks[np.cumsum(lengths) - 1] = NO_RANK
        return ranks

    def parts(self, piece: bytes) -> list[bytes]:
        """Merge the adjacent pair of lowest rank, leftmost first, until no pair has a rank."""
        if piece in self.ids:
            return [piece]
        if len(piece) > LONG_PIECE:
            return self._parts_of_long(piece)
        rank, none = self.ranks.get, 1 << 60
        parts = [piece[i:i + 1] for i in range(len(piece))]
        pairs = [rank(piece[i:i + 2], none) for i in range(len(piece) - 1)]
        while pairs:
            low = min(pairs)
            if low == none:
                break
            i = pairs.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], none)
        return parts

    def _parts_of_long(self, piece: bytes) -> list[bytes]:
        """The same with a heap over linked parts: n log n for pieces without white space of any length."""
        n, rank = len(piece), self.ranks.get
        end, prev, nxt = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        alive = bytearray(b"\1") * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = nxt[i]
            if not alive[i] or j >= n or end[j] != stop:
                continue
            alive[j], end[i], nxt[i] = 0, stop, nxt[j]
            if nxt[i] < n:
                prev[nxt[i]] = i
                if (r := rank(piece[i:end[nxt[i]]])) is not None:
                    heapq.heappush(heap, (r, i, end[nxt[i]]))
            if (p := prev[i]) >= 0 and (r := rank(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(piece[i:end[i]])
            i = nxt[i]
        return out


@lru_cache(4)
def load_vocabulary(path: str) -> Vocabulary:
    """A .tiktoken file of ranks, or a tokenizers .json of a byte-level BPE model."""
    if not path.endswith(".json"):
        with open(path, "rb") as f:
            ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return Vocabulary(ids, ids, {})
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in such files
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    raw = lambda s: bytes(byte_of[c] for c in s)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ids = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    ranks: dict[bytes, int] = {}
    for rank, (a, b) in enumerate(merges):
        ranks.setdefault(raw(a + b), rank)
    return Vocabulary(ids, ranks, special)


class PieceCache(dict):
    """piece -> value, learnt for all new pieces of a run at once; bounded (results do not depend on its contents)."""

    def __init__(self, compute, limit: int = CACHE_PIECES):
        super().__init__()
        self.compute, self.limit = compute, limit

    def learn(self, run: list[tuple[int, list[str]]]) -> None:
        seen = set().union(*(pieces for _, pieces in run))
        new = seen.difference(self)
        if len(self) + len(new) > self.limit:
            self.clear()
            new = seen
        if new:
            listed = list(new)
            self.update(zip(listed, self.compute(listed)))

    def forget_long(self, run: list[tuple[int, list[str]]]) -> None:
        for _, pieces in run:
            if len(pieces) and max(map(len, pieces)) > LONG_PIECE:
                for p in pieces:
                    if len(p) > LONG_PIECE:
                        self.pop(p, None)


def one_special(v: Vocabulary) -> str | None:
    """The special string of a vocabulary that has one; texts are split by one only, so more of them are refused."""
    if len(v.special) > 1:
        raise ValueError(f"vocabularies with several special strings are not supported: {sorted(v.special)}")
    return next(iter(v.special), None)


class Encoder:
    def __init__(self, path: str, specials: bool = False):
        self.vocabulary = v = load_vocabulary(path)
        self.special = (one_special(v), v.special[one_special(v)]) if specials and v.special else None
        self.cache = PieceCache(self.merged)
        size = max(v.bytes_of) + 1
        self.lengths = np.zeros(size, np.int64)
        for i, b in v.bytes_of.items():
            self.lengths[i] = len(b)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.table = np.frombuffer(b"".join(v.bytes_of.get(i, b"") for i in range(size)), np.uint8)
        self.decimal = [str(i) for i in range(size)]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers.  With specials, the special string is one token."""
        if self.special and any(self.special[0] in t for t in texts):
            joint = np.array([self.special[1]], "<u4").tobytes()
            split = [t.split(self.special[0]) for t in texts]
            parts = iter(self._ids([s for own in split for s in own]))
            return [joint.join([next(parts) for _ in own]) for own in split]
        return self._ids(texts)

    def merged(self, pieces: list[str]) -> list[bytes]:
        raw = [p.encode() for p in pieces]
        flat, counts = self.vocabulary.merge_many(raw)
        data, ends = flat.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def _ids(self, texts: list[str]) -> list[bytes]:
        parts: list[list[bytes]] = [[] for _ in texts]
        get = self.cache.__getitem__
        for run in piece_runs(texts):
            self.cache.learn(run)
            for i, pieces in run:
                parts[i].append(b"".join(map(get, pieces)))
            self.cache.forget_long(run)
        return [b"".join(p) for p in parts]

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.lengths[ids]) - self.lengths[ids]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """The bytes of tokens placed by their offsets; a slice of both decodes that range of tokens."""
        if not len(ids):
            return b""
        lengths = self.lengths[ids]
        total = int(offsets[-1] - offsets[0] + lengths[-1])
        source = np.repeat(self.begins[ids] - (offsets - offsets[0]), lengths) + np.arange(total)
        return self.table[source].tobytes()


@lru_cache(4)
def encoder(path: str, specials: bool = False) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    return Encoder(path, specials)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [t or "" for t in batch.column(name).to_pylist()]


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", specials: bool = False) -> DataFrame:
    """(key, ids array<int>, offsets array<long>): the tokens of each text and the byte at which each begins."""
    def run(batch):
        e = encoder(path, specials)
        ids = [np.frombuffer(x, "<u4") for x in e.ids(texts_of(batch, text))]
        return {key: batch.column(key), "ids": [i.astype(np.int32) for i in ids], "offsets": [e.offsets(i) for i in ids]}

    kind = df.schema[key].dataType
    out = schema_of((key, kind), ("ids", T.ArrayType(T.IntegerType())), ("offsets", T.ArrayType(T.LongType())))
    return map_batches(df.select(key, text), run, out)


def decode(df: DataFrame, path: str, key: str = "doc_id", specials: bool = False) -> DataFrame:
    """(key, data binary) of rows that ``encode`` gives."""
    def run(batch):
        e = encoder(path, specials)
        pairs = zip(batch.column("ids").to_pylist(), batch.column("offsets").to_pylist())
        return {key: batch.column(key), "data": [e.decode(np.array(i or [], np.int64), np.array(o or [], np.int64)) for i, o in pairs]}

    return map_batches(df.select(key, "ids", "offsets"), run, schema_of((key, df.schema[key].dataType), ("data", T.BinaryType())))


def digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every text in one pass, keeping digests only: (key, n_tokens, ids_sha256, decoded_sha256)."""
    def run(batch):
        e = encoder(path)
        out = {key: batch.column(key), "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for raw in e.ids(texts_of(batch, text)):
            ids = np.frombuffer(raw, "<u4").astype(np.int64)
            decimal = " ".join([e.decimal[i] for i in ids.tolist()])
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(decimal.encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(e.decode(ids, e.offsets(ids))).hexdigest())
        return out

    out = schema_of((key, T.LongType()), ("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType()))
    return map_batches(df.select(F.col(key).cast("long").alias(key), text), run, out)
