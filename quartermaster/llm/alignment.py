"""Alignment of two tokenizers' tokens by merge-path partitioning.

Both tokenizers cut the same bytes, so each gives a rising list of byte ends.  The texts of a block are laid one after the
other and the two lists of ends are merged: binary searches along evenly spaced diagonals of the merge grid divide the
merge into pieces of equal work that need nothing of each other.  Each piece emits its overlaps: every distinct end closes
one stretch of bytes, which lies in exactly one token of each side.  An end that both sides share closes a group; where its
two halves fell into neighbouring pieces, stitching joins them again and takes back the overlap counted twice.

How many documents hold a pair of ids linked is counted over the whole corpus: a block sends each of its distinct pairs
once, with the number of its documents that hold it, and gets the pair's count back by a join; copies and hot words so
never leave their block more than once.  Blocks hold at most ``BLOCK_CHARS`` code points, or one longer text.

Null and empty texts, and texts that a tokenizer does not give back byte for byte, have no tokens: their row holds zeros.
Repeated rows, repeated ids and null ids each keep their row and count as documents of their own.  Other columns of the
input are ignored, whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermaster.llm.bpe import encoder, texts_of
from quartermaster.llm.common import cut, schema_of
from quartermaster.session import scratch_path

#: Merged ends in a piece.
PIECE_ENDS = 1 << 16
#: New segments that are encoded as one text.
JOINED = 32
#: Characters of segments that a worker remembers.
CACHE_CHARS = 2_000_000
#: Code points of a block of documents.
BLOCK_CHARS = 1_000_000


@dataclass
class Side:
    """One tokenizer's tokens of a block: ids, byte ends over the whole block, and how many tokens each text has."""
    ids: np.ndarray
    ends: np.ndarray
    counts: np.ndarray


@dataclass
class Overlaps:
    """Linked token numbers (left, right), and the token numbers of both sides that end together, in order."""
    left: np.ndarray
    right: np.ndarray
    left_last: np.ndarray
    right_last: np.ndarray


class PieceTokenizer:
    """The ids of a sentencepiece BPE model, learnt by segment: where no piece of the model has a space after another
    character, no merge crosses the place before a word's spaces, so the segments between those places are encoded apart
    and remembered.  Other models encode whole texts."""

    def __init__(self, path: str):
        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        names = m.id_to_piece(list(range(m.get_piece_size())))
        self.raw = [bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.lengths = np.array(list(map(len, self.raw)), np.int64)
        self.segment = re.compile(" *[^ ]+| +" if not any(re.search("[^▁]▁", p) for p in names) else "(?s:.+)").findall
        self.cache: dict[str, bytes | None] = {}
        self.held = 0

    def learn(self, segments: set[str]) -> None:
        new = list(segments.difference(self.cache))
        if self.held + sum(map(len, new)) > CACHE_CHARS:  # the cache starts anew; results do not depend on it
            self.cache.clear()
            self.held, new = 0, list(segments)
        self.held += sum(map(len, new))
        # joined, they are texts of just these segments, but for those of spaces alone
        apart = [s for s in new if "▁" in s or not s.strip(" ")]
        new = list(set(new).difference(apart))
        joined = ["".join(new[k:k + JOINED])[1:] for k in range(0, len(new), JOINED)]
        ids = np.fromiter(chain.from_iterable(self.model.encode(joined, num_threads=1) if joined else ()), np.int64)
        if b"".join(map(self.raw.__getitem__, ids.tolist())) == "".join(new).encode():
            ends = np.append(0, np.cumsum(self.lengths[ids]))
            cuts = 4 * np.searchsorted(ends, np.cumsum([len(s.encode()) for s in new]))
            data = ids.astype("<u4").tobytes()
            self.cache.update(zip(new, (data[x:y] for x, y in zip([0, *cuts.tolist()], cuts.tolist()))))
        else:
            apart += new
        # the model adds the first space itself, but to an empty string
        for s, own in zip(apart, self.model.encode([s[1:] for s in apart], num_threads=1) if apart else ()):
            own = own if len(s) > 1 else [self.model.piece_to_id("▁")]
            same = b"".join(map(self.raw.__getitem__, own)) == s.encode()
            self.cache[s] = np.array(own, "<u4").tobytes() if same else None

    def ids(self, spaced: list[str]) -> list[np.ndarray | None]:
        """The ids of each text, given with a space before it; None where they do not give the text's bytes back."""
        out, segments = [], list(map(self.segment, spaced))
        self.learn(set().union(*segments))
        for own in segments:
            found = list(map(self.cache.__getitem__, own))
            out.append(None if None in found else np.frombuffer(b"".join(found), "<u4"))
        return out


@lru_cache(2)
def piece_tokenizer(path: str) -> PieceTokenizer:
    """One for each worker process and model file."""
    return PieceTokenizer(path)


def diagonals(a: np.ndarray, b: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """How many ends of ``a`` and of ``b`` lie before every ``step``-th place of their merge (``a`` first where equal)."""
    total = len(a) + len(b)
    place = np.append(np.arange(0, total, step), total)
    low, high = np.maximum(0, place - len(b)), np.minimum(place, len(a))
    while len(at := np.flatnonzero(low < high)):
        mid = (low[at] + high[at]) // 2
        first = a[mid] <= b[place[at] - mid - 1]
        low[at[first]] = mid[first] + 1
        high[at[~first]] = mid[~first]
    return low, place - low


def piece_overlaps(a: np.ndarray, b: np.ndarray, i: int, j: int) -> Overlaps:
    """The overlaps that a piece's own ends close; ``i`` and ``j`` are the numbers of its first tokens."""
    right = np.searchsorted(b, a, "left")
    left = np.searchsorted(a, b, "right")
    shared = np.zeros(len(b), bool)
    later = np.flatnonzero(left)
    shared[later] = a[left[later] - 1] == b[later]
    own, both = np.flatnonzero(~shared), np.flatnonzero(shared)
    return Overlaps(np.concatenate([np.arange(len(a)), left[own]]) + i, np.concatenate([right, own]) + j,
                    left[both] - 1 + i, both + j)


def overlaps(a: np.ndarray, b: np.ndarray, step: int = PIECE_ENDS) -> Overlaps:
    """Merge-path alignment of two rising lists of ends with one last end."""
    i, j = diagonals(a, b, step)
    pieces = [piece_overlaps(a[i0:i1], b[j0:j1], i0, j0) for i0, i1, j0, j1 in zip(i, i[1:], j, j[1:])]
    for k in range(1, len(pieces)):
        i0, j0 = i[k], j[k]
        if i0 and j0 < j[k + 1] and a[i0 - 1] == b[j0]:  # the piece before has the left half of a shared end
            p = pieces[k]
            again = (p.left == i0) & (p.right == j0)
            # the right end closes no stretch of its own: its overlap with the token after the shared end goes
            again &= np.arange(len(p.left)) >= i[k + 1] - i0
            pieces[k] = Overlaps(p.left[~again], p.right[~again], np.append(i0 - 1, p.left_last), np.append(j0, p.right_last))
    if not pieces:
        none = np.zeros(0, np.int64)
        return Overlaps(none, none, none, none)
    return Overlaps(*(np.concatenate([getattr(p, f) for p in pieces]) for f in ("left", "right", "left_last", "right_last")))


def tokens(texts: list[str], a_path: str, b_path: str) -> tuple[np.ndarray, Side, Side]:
    """(whether each text has tokens, its tokens by A with a space before it, its tokens by B, which adds the space)."""
    e, pieces = encoder(a_path), piece_tokenizer(b_path)
    spaced = [" " + t for t in texts]
    a = [np.frombuffer(x, "<u4") for x in e.ids(spaced)]
    b = pieces.ids(spaced)
    # byte-level tokens give every text back; their lengths are held against the text's all the same
    whole = np.array([bool(t) and y is not None and int(e.lengths[x].sum()) == len(s.encode())
                      for t, s, x, y in zip(texts, spaced, a, b)], bool)
    a = [x for x, ok in zip(a, whole) if ok]
    b = [y for y, ok in zip(b, whole) if ok]

    def side(ids, length):
        flat = np.concatenate(ids).astype(np.int64) if ids else np.zeros(0, np.int64)
        return Side(flat, np.cumsum(length[flat]), np.array(list(map(len, ids)), np.int64))

    return whole, side(a, e.lengths), side(b, pieces.lengths)


def group_digests(a: Side, b: Side, o: Overlaps, size: int) -> list[str]:
    """SHA-256 of each text's groups, as ``a1,a2|b1;a3|b2,b3``; ids are below ``size``."""
    written = written_ids(size)
    behind = np.append(0, o.right_last + 1)
    ahead = o.left_last + 1
    seq = np.empty(len(a.ids) + len(b.ids), np.int64)
    last = np.zeros(len(a.ids), np.int64)
    last[o.left_last] = 1
    n = np.arange(len(a.ids))
    seq[n + behind[np.searchsorted(o.left_last, n)]] = 3 * a.ids + last
    last = np.zeros(len(b.ids), np.int64)
    last[o.right_last] = 2
    n = np.arange(len(b.ids))
    seq[n + ahead[np.searchsorted(o.right_last, n)]] = 3 * b.ids + last
    ends = np.cumsum(a.counts + b.counts).tolist()
    of = written.__getitem__
    return [hashlib.sha256(b"".join(map(of, seq[s:t].tolist()))[:-1]).hexdigest() for s, t in zip([0, *ends], ends)]


@lru_cache(1)
def written_ids(n: int) -> list[bytes]:
    """For each id below ``n``: its decimal digits before a comma, a bar and a semicolon."""
    return [b"%d%s" % (i, mark) for i in range(n) for mark in (b",", b"|", b";")]


def _blocks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Runs of rows of at most ``BLOCK_CHARS`` code points, or of one longer text."""
    for batch in batches:
        texts = texts_of(batch, text)
        begin, held = 0, 0
        for i, t in enumerate(texts):
            if i > begin and held + len(t) > BLOCK_CHARS:
                yield batch.slice(begin, i - begin), texts[begin:i]
                begin, held = i, 0
            held += len(t)
        if begin < len(texts):
            yield batch.slice(begin), texts[begin:]


def groups(df: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, a_ids, b_ids, a_last, b_last): both token lists of every text and, for each group, the number of its last
    token on either side."""
    kind = df.schema[key].dataType
    out = schema_of((key, kind), *((n, T.ArrayType(T.IntegerType())) for n in ("a_ids", "b_ids", "a_last", "b_last")))

    def run(batches):
        for batch, texts in _blocks(batches, text):
            whole, a, b = tokens(texts, a_path, b_path)
            o = overlaps(a.ends, b.ends)
            of_text = np.searchsorted(np.cumsum(a.counts), o.left_last, "right")
            marks = np.bincount(of_text, minlength=len(a.counts))
            starts_a, starts_b = np.cumsum(a.counts) - a.counts, np.cumsum(b.counts) - b.counts
            cols = [_lists(whole, a.ids, a.counts), _lists(whole, b.ids, b.counts),
                    _lists(whole, o.left_last - starts_a[of_text], marks), _lists(whole, o.right_last - starts_b[of_text], marks)]
            yield pa.RecordBatch.from_arrays([batch.column(key), *cols], names=out.names)

    return df.select(key, text).mapInArrow(run, out)


def _lists(whole: np.ndarray, values: np.ndarray, counts: np.ndarray) -> pa.Array:
    sizes = np.zeros(len(whole), np.int64)
    sizes[whole] = counts
    return pa.ListArray.from_arrays(np.append(0, np.cumsum(sizes)).astype(np.int32), values.astype(np.int32))


_DOC = ("n_a", "n_b", "n_groups", "n_links")
_BLOCK = schema_of(("block", T.LongType()), ("ids", T.ArrayType(T.LongType())), *((n, T.ArrayType(T.LongType())) for n in _DOC),
                   ("digests", T.ArrayType(T.StringType())), ("begins", T.ArrayType(T.LongType())), ("slots", T.BinaryType()),
                   ("times", T.BinaryType()), ("pairs", T.ArrayType(T.LongType())), ("holders", T.ArrayType(T.IntegerType())))
_ARROW_BLOCK = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), *((n, pa.list_(pa.int64())) for n in _DOC),
                          ("digests", pa.list_(pa.string())), ("begins", pa.list_(pa.int64())), ("slots", pa.binary()),
                          ("times", pa.binary()), ("pairs", pa.list_(pa.int64())), ("holders", pa.list_(pa.int32()))])


def _block_row(block: int, ids: list, texts: list[str], a_path: str, b_path: str) -> dict:
    """A block's documents, their links as (slot in the block's list of pairs, how often), and that list with the number
    of documents that hold each pair."""
    whole, a, b = tokens(texts, a_path, b_path)
    o = overlaps(a.ends, b.ends)
    doc = np.flatnonzero(whole)
    n = len(texts)

    def per_doc(values):
        out = np.zeros(n, np.int64)
        out[doc] = values
        return out

    of_token = np.repeat(np.arange(len(doc)), a.counts)
    link_doc = of_token[o.left]
    slot, pairs = pd.factorize(a.ids[o.left] << 32 | b.ids[o.right])
    size = max(1, len(pairs))
    of_held, held = pd.factorize(link_doc * size + slot)
    order = np.argsort(held)
    held, times = held[order], np.bincount(of_held, minlength=len(held))[order]
    held_doc, held_slot = held // size, held % size
    digests, ids_below = [""] * n, max(len(encoder(a_path).lengths), len(piece_tokenizer(b_path).raw))
    for d, x in zip(doc.tolist(), group_digests(a, b, o, ids_below)):
        digests[d] = x
    return {"block": block, "ids": ids, "n_a": per_doc(a.counts), "n_b": per_doc(b.counts),
            "n_groups": per_doc(np.bincount(of_token[o.left_last], minlength=len(doc))),
            "n_links": per_doc(np.bincount(link_doc, minlength=len(doc))), "digests": digests,
            "begins": np.append(0, np.cumsum(per_doc(np.bincount(held_doc, minlength=len(doc))))),
            "slots": held_slot.astype("<u4").tobytes(), "times": times.astype("<u4").tobytes(),
            "pairs": pairs, "holders": np.bincount(held_slot, minlength=len(pairs)).astype(np.int32)}


def link_counts(df: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): each document's alignment, and its links weighed
    by how many documents of the corpus hold the same pair of ids linked.  ``n_best`` counts the links whose pair is the
    most common one of its A id, ties included."""
    def run(batches):
        base, k = TaskContext.get().partitionId() << 33, 0
        for batch, texts in _blocks(batches, text):
            row = _block_row(base + k, batch.column(key).to_pylist(), texts, a_path, b_path)
            k += 1
            yield pa.RecordBatch.from_arrays([pa.array([row[f.name]], type=f.type) for f in _ARROW_BLOCK], schema=_ARROW_BLOCK)

    spark, path = df.sparkSession, scratch_path(df.sparkSession, "alignment")
    found = df.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, _BLOCK)
    # block rows are large: the writer looks at its buffer after each few of them
    found.write.option("parquet.block.size.row.check.min", "4").option("parquet.page.size.row.check.min", "4").parquet(path)
    blocks = spark.read.parquet(path)
    pairs = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "holders")).alias("slot", "p")).select(
        "block", "slot", F.col("p.pairs").alias("pair"), F.col("p.holders").alias("holders"))
    counts = cut(pairs.groupBy("pair").agg(F.sum("holders").alias("count")))
    a_id = F.shiftright("pair", 32).alias("a_id")
    best = counts.groupBy(a_id).agg(F.max("count").alias("best"))  # at most one row for each id of A's vocabulary
    weights = counts.withColumn("a_id", a_id).join(F.broadcast(best), "a_id").select(
        "pair", "count", (F.col("count") == F.col("best")).alias("is_best"))
    back = pairs.select("block", "slot", "pair").join(weights, "pair").groupBy("block").agg(
        F.collect_list(F.struct("slot", "count", "is_best")).alias("weights"))
    docs = blocks.drop("pairs", "holders").join(back, "block", "left")
    out = schema_of((key, T.LongType()), *((n, T.LongType()) for n in (*_DOC, "n_best", "count_sum")), ("groups_sha256", T.StringType()))

    def finish(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(n)[r] for n in batch.schema.names}
                weights = row["weights"].values
                count = best_of = np.zeros(0, np.int64)
                if weights is not None and len(weights):
                    order = np.argsort(weights.field("slot").to_numpy(), kind="stable")
                    count = weights.field("count").to_numpy()[order]
                    best_of = weights.field("is_best").to_numpy(zero_copy_only=False)[order]
                slots = np.frombuffer(row["slots"].as_py(), "<u4")
                times = np.frombuffer(row["times"].as_py(), "<u4").astype(np.int64)
                begins = row["begins"].values.to_numpy()
                total = np.append(0, np.cumsum(times * count[slots]))[begins]
                top = np.append(0, np.cumsum(times * best_of[slots]))[begins]
                yield pa.RecordBatch.from_arrays(
                    [row["ids"].values, *(row[n].values for n in _DOC), pa.array(np.diff(top), pa.int64()),
                     pa.array(np.diff(total), pa.int64()), row["digests"].values], names=out.names)

    return docs.mapInArrow(finish, out)
