"""Whitening, token alignment and language identification against plain versions, with awkward rows."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import types as T
from tokenizers import Tokenizer

from quartermaster.llm import alignment, language_id, queries, whitening
from quartermaster.llm.common import fold_of, prepare, table

A, B, MULTI = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), P.path("byte_bpe_multi_50k.tiktoken")
SF = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("block", T.StringType()), ("word", T.StringType()),
    ("pair", T.StringType()), ("count", T.StringType()), ("score", T.StringType()), ("held_out", T.StringType()))])
VECTORS = T.StructType([T.StructField(n, t) for n, t in (
    ("vec_id", T.LongType()), ("embedding", T.ArrayType(T.FloatType())), ("label", T.IntegerType()), ("_index", T.StringType()),
    ("x", T.StringType()), ("component", T.StringType()), ("n", T.StringType()))])


def docs(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(i, t, lang, *["z"] * 6) for i, t, lang in rows], DOCS)


def vectors(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(i, v, 1, "z", "z", "z", "z") for i, v in rows], VECTORS)


# --- whitening

def plain_whitening(rows, k=32):
    x = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(float)).astype(np.int64).astype(object) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    deviation = [int(((n * r - s) ** 2).sum()) for r in x]
    c = np.array([[float(n * a - b) / n for a, b in zip(r, s)] for r in x])
    e, u = np.linalg.eigh(c.T @ c / n)
    order = np.argsort(-e)[:k]
    return deviation, c @ u[:, order], e[order], e.sum()


def check_whitening(rows, got, k):
    deviation, raw, e, trace = plain_whitening(rows, k)
    by = defaultdict(dict)
    for r in got:
        by[r.vec_id][r.component] = r
    assert len(got) == len(rows) * len(e)
    for (i, _), d, p in zip(rows, deviation, raw):
        own = by[i]
        assert sorted(own) == list(range(1, len(e) + 1))
        assert all(r.n == len(rows) and r.deviation == d == r.deviation_exact for r in own.values())
        for j, r in own.items():
            assert math.isclose(r.explained, e[j - 1] / trace, rel_tol=1e-9, abs_tol=1e-12)
            if e[j - 1] > 1e-9:
                assert abs(abs(r.whitened) - abs(p[j - 1]) / math.sqrt(e[j - 1])) < 1e-6
            else:
                assert r.whitened is None


def test_whitening_of_the_table(spark):
    prepare(spark)
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").select("vec_id", "embedding").collect()]
    got = queries.op11_embedding_whitening(spark, SF).collect()
    check_whitening(rows, got, 32)
    assert got[0].identity_error < 1e-9


def test_whitening_with_awkward_rows(spark):
    rnd = np.random.default_rng(5)
    good = [(i, rnd.normal(size=5).astype(np.float32).tolist()) for i in range(40)]
    good += [(100, good[0][1]), (101, good[0][1])]  # ties
    bad = [(200, None), (201, []), (202, [1.0, None, 0.0, 0.0, 0.0]), (203, [math.nan] * 5), (204, [math.inf, 0.0, 0.0, 0.0, 0.0]),
           (205, [1.0, 2.0]), (206, [1e30] * 5)]
    got = whitening.whiten(vectors(spark, good + bad), components=3).collect()
    check_whitening(good, got, 3)
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, bad[:5])).collect() == []


def test_whitening_without_variance_and_beyond_64_bits(spark):
    flat = whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert len(flat) == 4 and all(r.whitened is None and r.identity_error is None and r.explained is None and r.deviation == 0 for r in flat)
    line = [(i, [float(i), float(i)]) for i in range(6)]  # the second component has no variance
    check_whitening(line, whitening.whiten(vectors(spark, line)).collect(), 2)
    far = [(1, [2.0 ** 33, 0.0]), (2, [-(2.0 ** 33), 1.0]), (3, [0.0, 2.0])]
    got = whitening.whiten(vectors(spark, far)).collect()
    deviation, *_ = plain_whitening(far)
    assert {r.vec_id: int(r.deviation_exact) for r in got} == dict(zip((1, 2, 3), deviation))
    assert {r.vec_id for r in got if r.deviation is None} == {i for (i, _), d in zip(far, deviation) if d >= 1 << 63}
    repeated = whitening.whiten(vectors(spark, [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [2.0, 5.0])])).collect()
    assert Counter(r.vec_id for r in repeated) == {1: 4, None: 2}


def test_blocks_in_many_splits(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)
    monkeypatch.setattr(whitening, "BLOCK_COLS", 4)
    rnd = np.random.default_rng(6)
    rows = [(i, rnd.normal(size=10).astype(np.float32).tolist()) for i in range(300)]
    check_whitening(rows, whitening.whiten(vectors(spark, rows), components=6).collect(), 6)


# --- alignment

def plain_overlaps(a, b):
    i = j = 0
    links, shared = [], []
    while i < len(a):
        links.append((i, j))
        end = min(a[i], b[j])
        x, y = a[i] == end, b[j] == end
        if x and y:
            shared.append((i, j))
        i, j = i + x, j + y
    return links, shared


def test_merge_path_pieces_of_every_size():
    rnd = random.Random(1)
    for _ in range(300):
        n = rnd.randint(1, 30)
        a, b = (np.array(sorted({*rnd.sample(range(1, n + 1), rnd.randint(0, n)), n})) for _ in range(2))
        links, shared = plain_overlaps(a.tolist(), b.tolist())
        for step in (1, 2, 3, 7, 100):
            o = alignment.overlaps(a, b, step)
            assert sorted(zip(o.left.tolist(), o.right.tolist())) == sorted(links)
            assert list(zip(o.left_last.tolist(), o.right_last.tolist())) == shared
    none = alignment.overlaps(np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert not len(none.left) and not len(none.left_last)


def plain_alignment(texts):
    """The contract's rows, one text after the other."""
    a_model = Tokenizer.from_file(A)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=B)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(c): c for c in plain} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in plain)}
    found = []
    for t in texts:
        rows = None
        if t:
            a = a_model.encode(" " + t, add_special_tokens=False).ids
            b = b_model.encode(t)
            raw_a = [bytes(byte[c] for c in a_model.id_to_token(i)) for i in a]
            raw_b = [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(raw_a) == b"".join(raw_b) == (" " + t).encode():
                links, shared = plain_overlaps(np.cumsum([len(r) for r in raw_a]).tolist(), np.cumsum([len(r) for r in raw_b]).tolist())
                rows = a, b, links, shared
        found.append(rows)
    held = Counter(p for r in found if r for p in {(r[0][i], r[1][j]) for i, j in r[2]})
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    out = []
    for r in found:
        if r is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, links, shared = r
        counts = [held[a[i], b[j]] for i, j in links]
        groups, i0, j0 = [], 0, 0
        for i, j in shared:
            groups.append(",".join(map(str, a[i0:i + 1])) + "|" + ",".join(map(str, b[j0:j + 1])))
            i0, j0 = i + 1, j + 1
        out.append((len(a), len(b), len(shared), len(links), sum(n == best[a[i]] for (i, j), n in zip(links, counts)), sum(counts),
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("block", [40, 4_000_000])
def test_alignment_equals_the_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK_CHARS", block)
    rnd = random.Random(2)
    parts = ["the", " ", "  ", "\n", " and", "don't", "▁", "1", "é", "\x00", "<s>", "<|endoftext|>", "你好", "   ", "\xa0", " tokenization", "</s>", "<0x0A>", "\t", "😀"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 25))) for _ in range(80)]
    texts += [None, "", " ", "   ", "the the", "the the", "word " * 5000, "y" * 3000]
    rows = [(None if i == 3 else min(i, 80), t, "en") for i, t in enumerate(texts)]  # repeated and null ids
    got = alignment.link_counts(docs(spark, rows), A, B).collect()
    want = [(i, *w) for (i, _, _), w in zip(rows, plain_alignment(texts))]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert alignment.link_counts(docs(spark, []), A, B).collect() == []
    blank = alignment.link_counts(docs(spark, [(1, None, None), (2, "", "en")]), A, B).collect()
    assert sorted(map(tuple, blank)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_groups_cover_both_sides(spark):
    rows = [(1, "tokenization of naïve words", "en"), (2, None, "en"), (3, "a▁b", "en"), (4, "  x", "en")]
    got = {r.doc_id: r for r in alignment.groups(docs(spark, rows), A, B).collect()}
    for i in (1, 4):
        r = got[i]
        assert r.a_last[-1] == len(r.a_ids) - 1 and r.b_last[-1] == len(r.b_ids) - 1 and len(r.a_last) == len(r.b_last)
    assert got[2].a_ids == got[3].a_ids == got[3].b_last == []


def test_segments_encode_like_whole_texts():
    model, own, rnd = sentencepiece.SentencePieceProcessor(model_file=B), alignment.piece_tokenizer(B), random.Random(4)
    texts = ["".join(rnd.choices(["the", " ", "  ", "\n", " a", "x", "1", "é", "<s>", ".", "</s>", "\t"], k=rnd.randint(1, 12))) for _ in range(3000)]
    for t, ids in zip(texts, own.ids([" " + t for t in texts])):
        assert ids.tolist() == model.encode(t)


# --- language identification

def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(0)
    lat = language_id.lattice(MULTI)
    log_p = np.log(rng.dirichlet(np.ones(lat.size), 2).T)
    ids = language_id.load_vocabulary(MULTI).ids

    def paths(raw, at=0):
        if at == len(raw):
            yield []
        for end in range(at + 1, len(raw) + 1):
            if raw[at:end] in ids:
                for rest in paths(raw, end):
                    yield [ids[raw[at:end]], *rest]

    words = ["the", "a", "häus", "你", "straße"]
    got = language_id.log_likelihoods(words, log_p, MULTI)
    uses = language_id.expected_uses(words, np.zeros(len(words), np.int64), np.ones(len(words)), log_p, MULTI)[0]
    want = np.zeros(lat.size)
    for w, row in zip(words, got):
        found = list(paths(b" " + w.encode()))
        weight = np.exp([[log_p[p, k].sum() for k in (0, 1)] for p in found])
        assert np.allclose(row, np.log(weight.sum(axis=0)))
        for p, x in zip(found, weight[:, 0] / weight[:, 0].sum()):
            np.add.at(want, p, x)
    assert np.allclose(uses, want)


def test_languages_of_held_out_documents(spark):
    prepare(spark)
    got = queries.op13_language_id(spark, SF).withColumnRenamed("doc_id", "i").collect()
    langs = dict(table(spark, SF, "documents").select("doc_id", "lang").collect())
    held = [r for r in got if r.held_out and langs[r.i]]
    assert len(got) == len(langs) and held
    assert sum(r.lang_pred == langs[r.i] for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_awkward_rows(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the house and the tree", "en"), ("das haus und der baum", "de")] * 20)]
    rows += [(100, None, "en"), (101, "", "de"), (102, "12 34 !?", "en"), (103, "the tree", None), (104, "und das haus", None),
             (None, "the house", "en"), (105, "the " * 20_000, None), (105, "x" * 50_000, None), (106, "²", None)]
    got = language_id.judge(docs(spark, rows), MULTI).collect()
    pred = {r.doc_id: r.lang_pred for r in got}
    assert len(got) == len(rows)
    assert [pred[i] for i in (100, 101, 102, 106)] == ["und"] * 4 and all(r.score == 0 for r in got if r.lang_pred == "und")
    assert (pred[103], pred[104], pred[None]) == ("en", "de", "en") and {r.lang_pred for r in got if r.doc_id == 105} <= {"en", "de"}
    assert language_id.judge(docs(spark, []), MULTI).collect() == []
    unlearnt = language_id.judge(docs(spark, [(0, "the house", None), (1, None, "en")]), MULTI).collect()
    assert [(r.lang_pred, r.score) for r in unlearnt] == [("und", 0.0)] * 2


def test_labels_of_the_held_out_fold_are_not_read(spark):
    rows = [(i, "the house and the tree", "en") for i in range(40)] + [(100 + i, "das haus und der baum", "de") for i in range(40)]
    frame = docs(spark, rows)
    held = {r.doc_id for r in frame.filter(fold_of(frame.doc_id)).collect()}
    swapped = docs(spark, [(i, t, "xx" if i in held else lang) for i, t, lang in rows])
    a, b = (sorted(map(tuple, language_id.judge(f, MULTI).collect())) for f in (frame, swapped))
    assert [r[:3] for r in a] == [r[:3] for r in b] and np.allclose([r[3] for r in a], [r[3] for r in b])
