"""Homomorphic multiset fingerprints of documents.

A text is a multiset of paragraphs (lines that are not blank, white space normalised).  Its fingerprint is the sum, lane
by lane and modulo a power of two, of wide vectors hashed from its members, so it does not depend on their order, and
inserting or deleting a paragraph adds or subtracts that paragraph's vector.  It has two parts:

* 32 lanes modulo 2^32 of whole paragraphs: equal multisets are equal here, different ones differ but for chance;
* 256 lanes modulo 2^32 of the paragraphs' phrases, each told apart by how often its paragraph held it before, with
  entries +1 or -1: the products of two sums estimate how
  many phrases two texts share (the error is about 1/sqrt(256)), which gives the likeness.  A text of up to 2 GB, the
  most a row holds, has fewer than 2^31 phrases, so no lane wraps.

Phrases are cut at the ends of sentences and, as content decides, after about every eighth word, or inside words of more
than ``LONG`` bytes (text without white space) after about every 32nd byte, so a change reaches only the phrases it
touches.  Where content never decides, as in a repeated word, a phrase ends at the smallest hash of ``MOST_WORDS`` words or
``MOST_BYTES`` bytes.  A text without paragraphs has the zero fingerprint; two of them have likeness 1, one of
them and another text 0.  Null text counts as empty.

``neighbours`` brings to each document the next one in ascending order of (key, text), after the last the first; nulls
come first, and repeated keys follow each other.  Documents are dealt to ranges of keys once, and the first document of
a range is also sent to the range before it.  A table of one row is its own next document.  Other columns of the input
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermaster.llm.common import schema_of

WIDE, LANES = 32, 256
SEED_PARAGRAPH, SEED_PHRASE = 1, 2
BYTES = 4 * WIDE + 4 * LANES
CHUNK = 20_000
LONG, WINDOW = 32, 8
MOST_WORDS, MOST_BYTES = 64, 256
BLOCK = 1 << 18
#: Ranges of keys for each shuffle partition.
RANGES = 4
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """``n`` 64-bit words for each hash."""
    with np.errstate(over="ignore"):
        return mixed(hashes[:, None] + np.arange(1, n + 1, dtype=np.uint64)[None, :] * _ODD)


def paragraph_vector(hashes: np.ndarray) -> np.ndarray:
    """The sum of the paragraphs' vectors: WIDE lanes modulo 2^32."""
    total = np.zeros(WIDE, np.uint32)
    for a in range(0, len(hashes), CHUNK):
        total += words_of(hashes[a:a + CHUNK], WIDE // 2).view(np.uint32).sum(axis=0, dtype=np.uint32)
    return total


def phrase_vector(hashes: np.ndarray) -> np.ndarray:
    """The sum of the phrases' vectors of +1 and -1: LANES lanes modulo 2^32."""
    total = np.zeros(LANES, np.int64)
    for a in range(0, len(hashes), CHUNK):
        part = hashes[a:a + CHUNK]
        bits = np.unpackbits(words_of(part, LANES // 64).view(np.uint8), axis=1)
        total += 2 * bits.sum(axis=0, dtype=np.int64) - len(part)
    return total.astype(np.int32)


def forced(hashes: np.ndarray, most: int) -> Iterator[int]:
    """Ends of stretches of at most ``most`` where no other end is: after the last of the smallest hashes, so that equal
    contents are cut alike wherever they begin."""
    a = 0
    while len(hashes) - a > most:
        a += most - int(np.argmin(hashes[a:a + most][::-1]))
        yield a


def rolling(word: bytes, a: int, b: int) -> np.ndarray:
    """The hashes of the WINDOW bytes that end at each byte from a to b."""
    before = word[max(0, a - WINDOW + 1):a].rjust(WINDOW - 1, b"\0")
    raw, n = np.frombuffer(before + word[a:b], np.uint8).astype(np.uint64), b - a
    total = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WINDOW):
            total = total * _ODD + raw[k:k + n]
        return mixed(total)


def pieces(word: bytes) -> Iterator[bytes]:
    """A long word, cut where the hash of the last WINDOW bytes is 0 modulo 32; read in blocks, which change nothing."""
    a, n, held = 0, len(word), np.zeros(0, np.uint64)  # held: the hashes from a on
    for at in range(0, n, BLOCK):
        base, hashes = a, np.concatenate([held, rolling(word, at, min(n, at + BLOCK))])
        ends = np.flatnonzero(hashes[at - base:] & np.uint64(31) == 0) + at + 1
        for b, is_end in [*((b, True) for b in ends.tolist()), (base + len(hashes), base + len(hashes) == n)]:
            start = a
            for k in forced(hashes[start - base:b - base], MOST_BYTES):
                yield word[a:start + k]
                a = start + k
            if a < b and is_end:
                yield word[a:b]
                a = b
        held = hashes[a - base:]


def phrases(words: list[bytes]) -> Iterator[bytes]:
    """A phrase ends with a word that ends a sentence, or whose hash is 0 modulo 8, with a piece of a long word, or where
    it would grow beyond MOST_WORDS words."""
    a = 0

    def up_to(b):
        nonlocal a
        if b - a > MOST_WORDS:
            start = a
            for k in forced(np.array([xxhash.xxh64_intdigest(w) for w in words[a:b]], np.uint64), MOST_WORDS):
                yield b" ".join(words[a:start + k])
                a = start + k
        if a < b:
            yield b" ".join(words[a:b])
        a = b

    for i, w in enumerate(words, 1):
        if len(w) > LONG:
            yield from up_to(i - 1)
            yield from pieces(w)
            a = i
        elif w[-1] in b".!?" or not w[0] * 131 + w[-1] * 31 + len(w) & 7:
            yield from up_to(i)
    yield from up_to(len(words))


def fingerprint(text: str) -> bytes:
    whole, parts = [], []
    for line in text.split("\n"):
        if words := line.encode().split():
            whole.append(xxhash.xxh64_intdigest(b" ".join(words), SEED_PARAGRAPH))
            seen: dict[bytes, int] = {}
            for p in phrases(words):
                # a phrase that its paragraph holds several times counts as so many different ones, not as its square
                seen[p] = n = seen.get(p, -1) + 1
                parts.append(xxhash.xxh64_intdigest(p, SEED_PHRASE + n))
    return (paragraph_vector(np.array(whole, np.uint64)).astype("<u4").tobytes()
            + phrase_vector(np.array(parts, np.uint64)).astype("<i4").tobytes())


def _lanes(fp: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(fp[:4 * WIDE], "<u4"), np.frombuffer(fp[4 * WIDE:], "<i4")


def combine(a: bytes, b: bytes, sign: int = 1) -> bytes:
    """The fingerprint of two multisets together (sign 1), or of the first without the second (sign -1)."""
    (p, x), (q, y) = _lanes(a), _lanes(b)
    return ((p + q if sign > 0 else p - q).astype("<u4").tobytes()
            + (x.astype(np.int64) + sign * y.astype(np.int64)).astype("<i4").tobytes())


def likeness(a: bytes, b: bytes) -> float:
    """1 for equal fingerprints; else 2 xy / (xx + yy) over the phrase lanes, held between 0 and 1."""
    if a == b:
        return 1.0
    x, y = (_lanes(f)[1].astype(np.float64) for f in (a, b))
    norm = x @ x + y @ y
    return float(min(1.0, max(0.0, 2.0 * (x @ y) / norm))) if norm else 0.0


def neighbours(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (range, key, text, guest), to be read partition by partition in the order of the frame: the row after a
    document is its next one; guests are there for the document before them only."""
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = RANGES * n  # several ranges meet in a partition, so partitions are of like size
    keys = rows.select("key")
    bounds = np.unique(np.array(keys.select(F.percentile_approx("key", [i / ranges for i in range(1, ranges)], max(10_000, 10 * ranges))).first()[0] or [], np.int64))

    @F.pandas_udf(T.IntegerType())
    def place(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key, "right").astype(np.int32))

    where = place(F.coalesce("key", F.lit(-(1 << 63))))  # nulls go with the smallest keys
    firsts = keys.withColumn("range", where).groupBy("range").agg(  # a row for each range at most
        F.min("key").alias("low"), F.max(F.col("key").isNull()).alias("nulls")).orderBy("range").collect()
    lows = [(r["range"], None if r["nulls"] else r["low"]) for r in firsts]
    first = spark.createDataFrame([(w, low, lows[i - 1][0]) for i, (w, low) in enumerate(lows)], "range int, low long, before int")
    ranged = rows.withColumn("range", where).alias("r").join(F.broadcast(first).alias("f"), (
        F.col("r.range") == F.col("f.range")) & F.col("r.key").eqNullSafe(F.col("f.low")), "left")
    sent = F.array(F.struct(F.col("r.range").alias("range"), F.lit(False).alias("guest")),
                   F.struct(F.col("f.before").alias("range"), F.lit(True).alias("guest")))
    dealt = ranged.select("key", "text", F.explode(F.filter(sent, lambda s: s["range"].isNotNull())).alias("to"))
    dealt = dealt.select("to.range", "key", "text", "to.guest").repartition(n, "range")
    return dealt.sortWithinPartitions("range", "guest", F.col("key").asc_nulls_first(), "text")


def half_edited(text: str, following: str) -> str:
    """The last floor(n/2) code points replaced by the first as many (or all) of the next text."""
    k = len(text) // 2
    return text[:len(text) - k] + following[:k]


OUT = schema_of(("doc_id", T.LongType()), ("n_chars", T.LongType()), ("edited_sha256", T.StringType()),
                ("fingerprint", T.StringType()), ("edited_fingerprint", T.StringType()), ("near_edited", T.DoubleType()),
                ("near_next", T.DoubleType()))


def compare_with_next(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's fingerprint, that of its half-edited text, and its likeness to that and to the next document."""
    arrow = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *((f.name, pa.string()) for f in OUT.fields[2:5]),
                       ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def run(batches):
        held = None  # the document whose next one comes

        def rows(batch):
            nonlocal held
            for where, doc, body, guest in zip(*(batch.column(c).to_pylist() for c in ("range", "key", "text", "guest"))):
                fp = fingerprint(body)
                if held and held[0] == where:
                    _, of, own, own_fp = held
                    edited = half_edited(own, body)
                    edited_fp = fingerprint(edited)
                    yield (of, len(own), hashlib.sha256(edited.encode()).hexdigest(), own_fp.hex(), edited_fp.hex(),
                           likeness(own_fp, edited_fp), likeness(own_fp, fp))
                held = None if guest else (where, doc, body, fp)

        for batch in batches:
            cols = list(zip(*rows(batch)))
            yield pa.RecordBatch.from_arrays([pa.array(cols[i] if cols else [], f.type) for i, f in enumerate(arrow)], schema=arrow)

    return neighbours(df, key, text).mapInArrow(run, OUT)
