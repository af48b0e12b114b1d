"""Classifiers by held-out labels, extraction, URL rules and nearest neighbours by plain versions of the rules."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quartermaster.llm import ann, html_extract, quality, queries, toxicity, url_filter
from quartermaster.llm.common import prepare, table

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, y string, c0 string"


def test_toxicity_held_out(spark):
    got = queries.op10_toxicity(spark, SF).join(table(spark, SF, "labels"), "doc_id").where("held_out").toPandas()
    pos, neg = got[got.toxic == 1].score.to_numpy(), got[got.toxic == 0].score.to_numpy()
    assert len(pos) and np.mean(pos[:, None] > neg[None, :]) > 0.85


def test_quality_held_out(spark):
    got = queries.op1_quality(spark, SF).join(table(spark, SF, "labels"), "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.9


def test_models_take_awkward_rows(spark):
    prepare(spark)
    rows = [(1, "fine words here", "en", "a", 10, "x", "x", "x"), (1, "fine words here", "en", "a", 10, "x", "x", "x"),
            (2, None, None, None, None, "x", "x", "x"), (3, "", "en", "a", 0, "x", "x", "x"), (None, "no id", "en", "a", 5, "x", "x", "x"),
            (4, "w" * 100_000, "en", "a", -1, "x", "x", "x"), (5, "1d10t " * 20_000, "en", "a", 1, "x", "x", "x")]
    docs, none = spark.createDataFrame(rows, DOCS), spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([(1, 1, 0), (1, None, None), (5, 0, 1), (None, 1, 1), (99, 1, 0)], "doc_id long, quality int, toxic int")
    for labelled in (labels, labels.limit(0)):
        for judge, keep in ((toxicity.judge, toxicity.keep_clean), (quality.judge, quality.keep_good)):
            out = judge(docs, labelled).collect()
            assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
            assert judge(none, labelled).collect() == []
            assert keep(docs, labelled).columns == docs.columns and keep(none, labelled).collect() == []
            assert keep(docs, labelled).count() <= len(rows)


def test_disguises_are_read():
    text = "you idiot and stupid loser you are a clown and a moron of no use worthless trash people " * 50
    s = toxicity.SYMBOL_OF[np.frombuffer(f"  {text} ".encode(), np.uint8)]
    grams, n = np.unique((s[:-2] * toxicity.SYMBOLS + s[1:-1]) * toxicity.SYMBOLS + s[2:], return_counts=True)
    r = toxicity.Restorer(toxicity.CharModel(dict(zip(grams.tolist(), n.tolist()))))
    for token, word in (("1d10t", "idiot"), ("i.d.i.o.t", "idiot"), ("stuuuupid", "stupid"), ("$tup1d", "stupid"), ("cl0wn!!", "clown"), ("m0r-0n", "moron")):
        assert word in r.words(f"a {token} b"), token
    assert "idiot" in r.words("an i d i o t here") and r.words("plain words") == {"plain", "words"}


def test_disguises_at_the_ends_are_read():
    text = "you idiot trash scum dumbass you ass idiot trash scum ass plain will " * 50
    s = toxicity.SYMBOL_OF[np.frombuffer(f"  {text} ".encode(), np.uint8)]
    grams, n = np.unique((s[:-2] * toxicity.SYMBOLS + s[1:-1]) * toxicity.SYMBOLS + s[2:], return_counts=True)
    r = toxicity.Restorer(toxicity.CharModel(dict(zip(grams.tolist(), n.tolist()))))
    for token, word in (("!diot", "idiot"), ("|diot", "idiot"), ("+rash", "trash"), ("idio+", "idiot"), ("(!diot),", "idiot"), ("a55", "ass"),
                        ("@55", "ass"), ("455", "ass"), ("iidiot", "idiot"), ("ttrash", "trash"), ("sscum", "scum"), ("will", "will"), ("plain!", "plain")):
        assert word in r.words(f"a {token} b"), token
    assert r.words("plain, \"words\".") == {"plain", "words"} and r.words("... , #") == set()


def test_rare_insults_are_weighed_beside_many_common_words(spark):
    import zlib
    prepare(spark)
    rnd = random.Random(3)
    common = sorted({"".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(8000)})
    ids = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 4 != 2][:300]
    rows = [(i, " ".join([str(i), *(common if n < 16 else common[:20]), *(["qwxyzzy"] if n < 5 else [])]), int(n < 8)) for n, i in enumerate(ids)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    assert len({f for w in common for f in toxicity.features(w)}) > 20_000
    assert model.weights["qwxyzzy$"] > 0 and len(model.weights) > 20_000


PAGES = [
    ("http://a.example/1", "<html><body><nav><a href=x>Menu</a></nav><div class=post><h1>T &amp;amp; t</h1><p>One  two\n three<p>Four <b>five</b></div><footer>f</footer>",
     "T &amp; t\nOne two three\nFour five"),
    ("http://a.example/2", "<div class='post'><p>Short</p><script>var x='</p>'</script><!-- c --><div class='comments'><p>Nice post nice post nice post</p></div></div>", "Short"),
    ("http://a.example/3", "<div class=ad><p>Buy now buy now buy now buy now</p></div><div class=post><ul><li>a<li>b</ul><form>Name <input></form></div><aside>x</aside>", "a\nb"),
    ("http://b.example/", "just text &lt;b&gt;", "just text <b>"),
    (None, None, ""), ("no host", "", ""),
]


def test_html(spark):
    prepare(spark)
    rows = [(i, u, h, "x", "x", "x") for i, (u, h, _) in enumerate(PAGES)] + [(0, *PAGES[0][:2], "x", "x", "x"), (None, *PAGES[0][:2], "x", "x", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, winners string, rank string")
    got = html_extract.main_text(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["page_id"] is not None:
            assert r["text"] == PAGES[r["page_id"]][2] and r["n_chars"] == len(r["text"])
    assert html_extract.main_text(df.limit(0)).collect() == []


def test_html_deep_and_long_pages():
    assert html_extract.extract("<div>" * 5000 + "<p>deep" + "</div>" * 5000, []) == "deep"
    assert len(html_extract.extract("<article>" + "<p>word " * 20_000 + "</article>", [])) == 20_000 * 5 - 1
    assert html_extract.extract("<article><p>open <b>bold", ["body>article"]) == "open bold"


def test_html_minority_templates_keep_their_container(spark):
    prepare(spark)
    text = "".join(f"<p>Sentence {{}} of a long story, number {k}, with enough words in it to count.</p>" for k in range(6))
    makers = [("<article>", "</article>")] * 700 + [("<div class=post>", "</div>")] * 250 + [("<div class=content>", "</div>")] * 50
    rows = [(i, f"http://big.example/{i}", f"<html><body><p>Site name and slogan</p>{a}{text.format(*[i] * 6)}{b}<p>Made by us</p></body></html>")
            for i, (a, b) in enumerate(makers)] + [(1000, "http://big.example/p", "<html><body><p>Only a plain page</p></body></html>")]
    got = {r["page_id"]: r["text"] for r in html_extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows) and got[1000] == "Only a plain page"
    for i in range(1000):
        assert got[i].startswith(f"Sentence {i} ") and "slogan" not in got[i] and "Made by" not in got[i]


def test_html_of_the_test_pages(spark):
    import html
    import re
    got = queries.op2_html_text(spark, SF).join(table(spark, SF, "pages").select("page_id", "html"), "page_id").collect()
    for r in got:
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"<br>", " ", p))).split()) for p in re.split(r"</?(?:p|h1)>", body)]
        assert r["text"] == "\n".join(p for p in parts if p)


URLS = ["https://WWW.Example.com/en/a?q#f", "http://example.com/en/x", "http://example.com/fr/x", "http://x.net/es/1", "http://x.net/esp", "http://net/fr/",
        "http://com", "http://com/", "http://ab.com:80/cart", "http://shop.org/cart", "http://shop.org/a?x=://b/c", "no scheme", "", None, "http://o.org/cartoon",
        "http://o.org/Setup.EXE", "http://user@h.org/wp-login.php"]


def plain_rule(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url[url.index("://") + 3:]
    n = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n]), rest[n:]
    path = tail[:min([i for i in (tail.find(c) for c in "?#") if i >= 0], default=len(tail))]
    fits = [r.text for r in queries.URL_RULES if (host == r.parts[0] or host.endswith("." + r.parts[0])) and path.startswith(r.parts[1])]
    return host, path, max(fits, key=len, default=None)


def test_url_rules(spark):
    prepare(spark)
    df = spark.createDataFrame([(i, u, "x", "x") for i, u in enumerate(URLS)] + [(None, URLS[0], "x", "x")], "page_id long, url string, host string, rule string")
    got = {r["page_id"]: r for r in url_filter.judge(df, queries.URL_RULES).collect()}
    verdicts = {r.text: r.verdict for r in queries.URL_RULES}
    for i, u in enumerate(URLS):
        host, path, rule = plain_rule(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        if rule:
            assert got[i]["verdict"] == verdicts[rule]
    assert [got[i]["verdict"] for i in (9, 14, 15, 16, 13)] == ["block", "allow", "block", "block", "allow"]
    assert url_filter.judge(df.limit(0), queries.URL_RULES).collect() == []


def test_only_candidates_of_the_rarest_literal_run():
    rules = (url_filter.PatternRule("block", "a-b", ("a", "b")), url_filter.PatternRule("block", "c", ("c",)))
    index = url_filter.PatternIndex(rules, {"a": 9, "b": 1, "c": 5})
    assert index.by_token == {"b": [0], "c": [1]}
    with pytest.raises(ValueError):
        url_filter.PatternIndex((url_filter.PatternRule("block", "x", ()),), {})


def brute_nearest(vectors, every, k):
    out = {}
    for q, x in vectors.items():
        if q % every == 0:
            near = sorted(((-float(np.dot(x, y)), i) for i, y in vectors.items() if i != q))[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def test_nearest_with_ties_and_awkward_vectors(spark):
    prepare(spark)
    rnd = np.random.default_rng(0)
    vectors = {i: rnd.normal(size=8).astype(np.float32).astype(float) for i in range(300)}
    for i in range(100, 180):
        vectors[i] = vectors[100]  # one common vector
    rows = [(i, v.tolist(), 1) for i, v in vectors.items()]
    rows += [rows[5], (900, None, 1), (901, [0.0] * 8, 1), (902, [float("nan")] * 8, 1), (903, [1.0, None] * 4, 1), (None, [1.0] * 8, 1), (904, [], 1), (1000, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = {}
    for r in ann.nearest(df, 10, 20).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = brute_nearest(vectors, 10, 20)
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.97 * 20 * len(want)
    for q, own in got.items():
        assert own == sorted(own, key=lambda f: (-round(f[1], 9), f[0])) and len(own) == 20
        assert all(abs(s - float(np.dot(vectors[q], vectors[i]))) < 1e-9 for i, s in own)
    assert [i for i, _ in got[100]] == [i for i, _ in want[100]]  # ties go to the smallest ids
    assert ann.nearest(df.limit(0), 10, 20).collect() == []


def test_recall_over_shards(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 150)
    got = queries.op4_nearest_neighbours(spark, SF).collect()
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in table(spark, SF, "embeddings").collect() if r["embedding"]}
    want = brute_nearest(vectors, 20, 20)
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert np.mean([len(found[q] & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.95


def test_batched_search_finds_what_it_should():
    x = np.random.default_rng(1).normal(size=(2000, 16)).astype(np.float32)
    g = ann.build(x)
    at, _ = ann.search(g, x, x[:100], 10)
    want = np.argsort(-(x[:100].astype(float) @ x.T.astype(float)), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(at.tolist(), want.tolist())]) > 0.95


def test_trigram_counts_do_not_depend_on_batches(spark):
    prepare(spark)
    df = spark.createDataFrame([("Abc déf.",), ("abc",), (None,), ("",)], "text string")
    a = toxicity.count_trigrams(df)
    assert a == toxicity.count_trigrams(df.repartition(3)) and sum(a.values()) > 0
    assert toxicity.count_trigrams(df.where(F.lit(False))) is not None


def test_random_tokens_never_break_the_channel():
    r = toxicity.Restorer(toxicity.CharModel({0: 1}))
    rnd = random.Random(0)
    for _ in range(300):
        r.words("".join(rnd.choices("ab01!@$.- é|\t\n😀", k=rnd.randint(0, 200))))
