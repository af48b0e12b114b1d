"""Tokens, packing, fingerprints and SimHash against public libraries and brute force, with awkward rows."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from pyspark.sql import types as T
from tokenizers import Tokenizer

from quartermaster.llm import bpe, fingerprints, packing, simhash, token_counts
from quartermaster.llm.common import prepare

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")
WORDS = ["the", " and", "  ", "\n\n", "'s", "'re", "'ll", "don't", "1", "٣", "!", "--", "é", "ß", "你好", "😀", "　", "\x85",
         "<|endoftext|>", "abc", "\t", " x", "'", "ing"]
#: Extra columns named like the operators' own.
SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()),
    ("fp", T.StringType()), ("range", T.StringType()), ("length", T.StringType()), ("n_tokens", T.StringType()), ("key", T.StringType()),
    ("_slot", T.StringType()), ("component_id", T.StringType()), ("score", T.StringType()))])


def texts(n=60, seed=3):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(WORDS, k=rnd.randint(0, 40))) for _ in range(n)]


def frame(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(i, t, "en", None, None, "x", "x", "x", "x", "x", "x", "x", "x") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    out = list(enumerate(texts()))
    return out + [(3, "same id"), (None, "no id"), (None, None), (100, None), (101, ""), (102, "a b c"), (102, "a b c"),
                  (103, "word " * 30_000), (104, "z" * 3000)]


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encode_as_the_libraries_do(tik):
    t = texts(3000) + ["a" * 5000 + "!" * 300, " " * 700, "", "word " * 1000]
    assert [list(np.frombuffer(x, "<u4")) for x in bpe.Encoder(RANKS).ids(t)] == tik.encode_ordinary_batch(t)
    tok = Tokenizer.from_file(JSON)
    want = [e.ids for e in tok.encode_batch(t, add_special_tokens=False)]
    assert [list(np.frombuffer(x, "<u4")) for x in bpe.Encoder(JSON, True).ids(t)] == want


def test_pieces_do_not_depend_on_windows(monkeypatch):
    t = texts(50)
    want = [at.tolist() for _, at, _ in bpe.batch_pieces(t)]
    monkeypatch.setattr(bpe, "WINDOW", 7)
    assert [at.tolist() for _, at, _ in bpe.batch_pieces(t)] == want


def test_digests(spark, rows, tik):
    got = sorted(map(tuple, bpe.digests(frame(spark, rows), RANKS).collect()), key=str)
    want = []
    for i, t in rows:
        ids = tik.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.digests(frame(spark, []), RANKS).collect() == []


def test_encode_then_decode_any_range(spark, rows):
    enc = bpe.encode(frame(spark, rows), RANKS)
    back = bpe.decode(enc, RANKS)
    assert sorted(bytes(r["data"]) for r in back.collect()) == sorted((t or "").encode() for _, t in rows)
    e = bpe.Encoder(RANKS)
    ids = np.frombuffer(e.ids(["hello wide world"])[0], "<u4").astype(np.int64)
    assert e.decode(ids[1:], e.offsets(ids)[1:]) == b" wide world"


def test_every_prefix_count():
    tok, counter = Tokenizer.from_file(JSON), token_counts.PrefixCounter(JSON)
    t = texts(150) + ["a" * 150 + "!" * 120, "x'll've 'rex x'd"]
    for text, table in zip(t, counter.tables(t)):
        want = [len(e.ids) for e in tok.encode_batch([text[:k] for k in range(len(text) + 1)], add_special_tokens=False)]
        assert [token_counts.tokens_of_prefix(table, k) for k in range(len(text) + 1)] == want
        for budget in (0, 3, 1000):
            assert token_counts.longest_prefix(table, budget) == max(k for k, n in enumerate(want) if n <= budget)


def test_count(spark, rows):
    tok = Tokenizer.from_file(JSON)
    got = sorted((tuple(r)[:4] for r in token_counts.count(frame(spark, rows), JSON, 20).collect()), key=str)
    n = [len(tok.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    assert got == sorted(((i, len((t or "").encode()), k, k > 20) for (i, t), k in zip(rows, n)), key=str)
    assert token_counts.count(frame(spark, []), JSON).collect() == []


def test_plan_is_best_fit_decreasing():
    import bisect
    rnd = random.Random(5)
    for cap in (10, 64, 1024):
        for _ in range(20):
            counts = {}
            for _ in range(rnd.randint(0, 200)):
                n = rnd.randint(1, cap)
                counts[n] = counts.get(n, 0) + rnd.choice([1, 1, 2, 30])
            bins = []
            for n in sorted((n for n, k in counts.items() for _ in range(k)), reverse=True):
                i = bisect.bisect_left(bins, n)
                free = bins.pop(i) if i < len(bins) else cap
                bisect.insort(bins, free - n)
            assert packing.sequences_needed(counts, cap) == len(bins)


def test_pack(spark, rows, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 5)
    tok, got = Tokenizer.from_file(JSON), packing.pack(frame(spark, rows), JSON, 64, 2).collect()
    want = []
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % 64 + 1
        cuts = [(0, first), *((s, 64) for s in range(first, len(ids), 64))]
        want += [(i, k, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())) for k, (s, n) in enumerate(cuts)]
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    counts = {}
    for *_, n, _ in want:
        counts[n] = counts.get(n, 0) + 1
    assert len(by_sequence) == packing.sequences_needed(counts, 64)
    assert packing.pack(frame(spark, []), JSON, 64, 2).collect() == []


def test_fingerprints_are_homomorphic():
    a, b = "one two three.\nfour five", "six seven\n\n  eight  nine "
    whole = fingerprints.fingerprint(a + "\n" + b)
    assert whole == fingerprints.fingerprint(b + "\n" + a)
    assert whole == fingerprints.combine(fingerprints.fingerprint(a), fingerprints.fingerprint(b))
    assert fingerprints.combine(whole, fingerprints.fingerprint(b), -1) == fingerprints.fingerprint(a)
    assert whole != fingerprints.fingerprint(a)


def test_compare_with_next(spark, rows):
    got = fingerprints.compare_with_next(frame(spark, rows)).collect()
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for (i, t), (_, nxt) in zip(ordered, ordered[1:] + ordered[:1]):
        k = len(t) // 2
        edited = t[:len(t) - k] + nxt[:k]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((tuple(r)[:3] for r in got), key=str) == sorted(want, key=str)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert fingerprints.compare_with_next(frame(spark, [])).collect() == []
    one = fingerprints.compare_with_next(frame(spark, [(7, "alone here")])).collect()
    assert one[0]["near_next"] == 1.0 and one[0]["doc_id"] == 7


def test_likeness_follows_the_shared_half():
    rnd = random.Random(1)
    words = ["".join(rnd.choices("abcdefgh", k=6)) for _ in range(4000)]
    a, b = " ".join(words[:2000]), " ".join(words[2000:])
    half = fingerprints.half_edited(a, b)
    fa, fb, fh = map(fingerprints.fingerprint, (a, b, half))
    assert 0.35 < fingerprints.likeness(fa, fh) < 0.65 and fingerprints.likeness(fa, fb) < 0.25


def test_likeness_of_very_long_repetitive_texts():
    for n in (40_000, 65_536):
        a, b = "the same phrase.\n" * n, "one more of them.\n" * n
        fa, fh = fingerprints.fingerprint(a), fingerprints.fingerprint(fingerprints.half_edited(a, b))
        assert 0.7 < fingerprints.likeness(fa, fh) < 0.9
        assert fingerprints.combine(fingerprints.combine(fa, fh), fh, -1) == fa


def test_likeness_of_texts_without_phrase_ends():
    rnd = random.Random(2)
    cjk, other = ("".join(chr(rnd.randrange(0x4E00, 0x9FA5)) for _ in range(6000)) for _ in "ab")
    blob, blob2 = ("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=20_000)) for _ in "ab")
    for a, b in ((cjk, other), (blob, blob2)):
        fa, fb, fh = map(fingerprints.fingerprint, (a, b, fingerprints.half_edited(a, b)))
        assert 0.35 < fingerprints.likeness(fa, fh) < 0.65 and fingerprints.likeness(fa, fb) < 0.25
    for a, b in (("a " * 5000, "o " * 5000), ("a" * 50_000, "o" * 50_000)):
        fa, fb, fh = map(fingerprints.fingerprint, (a, b, fingerprints.half_edited(a, b)))
        assert 0.5 < fingerprints.likeness(fa, fh) < 1 and fingerprints.likeness(fa, fb) < 0.25
    shifted = fingerprints.fingerprint("x " + "a o " * 5000)
    assert fingerprints.likeness(fingerprints.fingerprint("o a " * 5000), shifted) > 0.9


def test_pieces_and_phrases_hold_every_byte(monkeypatch):
    rnd = random.Random(4)
    long = [bytes(rnd.choices(b"abcdefgh", k=5000)), b"ab" * 2000, b"a" * 3000, bytes(rnd.choices(b"ab", k=3000))]
    whole = [list(fingerprints.pieces(w)) for w in long]
    for size in (7, 8, 100, 256, 1000):
        monkeypatch.setattr(fingerprints, "BLOCK", size)
        assert [list(fingerprints.pieces(w)) for w in long] == whole
    assert all(b"".join(p) == w and len(p) > 8 and max(map(len, p)) <= 256 for p, w in zip(whole, long))
    for _ in range(200):
        words = [bytes(rnd.choices(b"ab.xyz\xe4", k=rnd.choice((1, 2, 5, 40, 700)))) for _ in range(rnd.choice((1, 3, 200)))]
        got = list(fingerprints.phrases(words))
        assert b"".join(got).replace(b" ", b"") == b"".join(words) and max(map(len, got)) <= 64 * 33
    assert list(fingerprints.phrases([])) == []


def brute_print(text, words=4):
    w = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    sh = [b" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, most):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= most:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def similar_rows():
    rnd = random.Random(9)
    base = [" ".join(rnd.choices(["alpha", "beta", "gamma", "delta", "Eta", "thé", "iota"], k=150)) for _ in range(6)]
    out = []
    for i in range(120):
        w = rnd.choice(base).split(" ")
        for _ in range(rnd.randint(0, 2)):
            w[rnd.randrange(len(w))] = rnd.choice(["new", "word"])
        out.append((i, " ".join(w)))
    return out + [(500, None), (501, ""), (502, " \n"), (503, "Two words"), (504, "two WORDS"), (3, "same id here"), (None, "no id"), (None, "no id")]


@pytest.mark.parametrize("most", [0, 2, 4, 6])
def test_near_duplicates(spark, most):
    data = similar_rows()
    prints = [brute_print(t) for _, t in data]
    root = brute_components(prints, most)
    least = {}
    for (i, _), r in zip(data, root):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    want = sorted(((i, f"{p:016x}", least[r]) for (i, _), p, r in zip(data, prints, root)), key=str)
    got = simhash.near_duplicates(frame(spark, data), 4, most).collect()
    assert sorted((tuple(r)[:3] for r in got), key=str) == want


def test_keep_one_of_each_component(spark):
    data = similar_rows()
    root = brute_components([brute_print(t) for _, t in data], 4)
    kept = simhash.keep_one(frame(spark, data), 4, 4)
    assert kept.columns == SCHEMA.names and kept.count() == len(set(root))
    assert simhash.near_duplicates(frame(spark, []), 4, 4).collect() == []
    assert simhash.keep_one(frame(spark, []), 4, 4).collect() == []


def test_long_chain_is_one_component(spark):
    chain = [(1 << i) - 1 for i in range(0, 60, 4)]  # each differs from the next in four bits
    df = spark.createDataFrame([(i, p) for i, p in enumerate(chain)], "doc_id long, fp long")
    assert {r["component_id"] for r in simhash.components(df, 4).collect()} == {0}
