"""Trained operators: held-out accuracy and hostile rows; embeddings against brute force; pages."""

from __future__ import annotations

import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paysignal.llm import boosted_trees, html_extraction, language_id, pivot_index, toxicity
from paysignal.llm.html_nodes import read_page
from paysignal.llm.queries import QUERIES
from paysignal.llm.rows import labelled_sample, remainder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels", "pages", "embeddings")}


def test_language_is_right_on_held_out_documents(spark, sf_dir, tables):
    found = QUERIES["op1_language_id"](spark, sf_dir)
    assert found.columns[:1] == ["doc_id"] and {"held_out", "lang_pred", "score"} <= set(found.columns)
    judged = found.filter("held_out").join(tables["documents"].filter("lang IS NOT NULL"), "doc_id")
    right = judged.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.9 and found.count() == tables["documents"].count()
    assert found.filter("score < 0 OR score > 1").isEmpty()


def test_language_of_hostile_rows(spark):
    rng = random.Random(2)
    vocabularies = {"aa": ["tora", "mika", "saru", "noki"], "bb": ["blent", "strug", "chwim", "grosp"]}
    rows = [(i, " ".join(rng.choice(v) for _ in range(30)), k, None, 1) for i, (k, v) in enumerate([*vocabularies.items()] * 60)]
    odd = [(900, None, "aa", "s", 1), (901, "", "bb", "s", 1), (902, "123 !!! \x00", None, "s", 1), (903, "TORA MIKA", None, None, 1),
           (None, "strug grosp blent", "bb", "s", 1), (904, "blent " * 20000, None, "s", 1), (903, "TORA MIKA", None, None, 1)]
    docs = spark.createDataFrame(rows + odd, SCHEMA).withColumn("score", F.lit(5))
    model = language_id.train(docs, remainder("doc_id", 5) != 0)
    found = language_id.predict(docs, model).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(rows) + len(odd)
    assert [by_id[i].lang_pred for i in (900, 901, 902, 903, 904, None)] == ["und", "und", "und", "aa", "bb", "bb"]
    assert by_id[900].score == 0.0 and by_id[904].score > 0.5
    none = language_id.train(docs, F.lit(False))
    assert {r.lang_pred for r in language_id.predict(docs, none).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), model).count() == 0
    assert 0 < (model.weights != 0).mean() < 1  # the L1 penalty leaves most features out


def test_temperature_is_the_best_one():
    rng = np.random.default_rng(0)
    logits = rng.normal(0, 1, (2000, 3))
    chance = language_id._softmax(logits / 2.5)
    targets = np.array([rng.choice(3, p=c) for c in chance])
    assert abs(language_id.fit_temperature(logits, targets) - 2.5) < 0.5


def test_sample_is_bounded_and_stable(spark):
    rows = spark.range(5000).withColumn("label", F.when(F.col("id") % 10 == 0, "rare").when(F.col("id") != 7, "common"))
    first = labelled_sample(rows, "label", "id", 50)
    assert {r["label"]: r["count"] for r in first.groupBy("label").count().collect()} == {"rare": 50, "common": 50}
    assert set(first.collect()) == set(labelled_sample(rows.repartition(7), "label", "id", 50).collect())


def toxic_rows(n: int, seed: int) -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(seed)
    plain = [a + b + c for a in ("ta", "re", "mo", "li") for b in ("na", "so", "ri") for c in ("k", "m", "t", "")]
    bad = ["grunthead", "stinkfool", "vilescum"]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(plain) for _ in range(rng.randint(10, 400))]
        toxic = i % 4 == 0
        for _ in range(2 * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        docs.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_toxic_documents_are_found(spark):
    rows, marks = toxic_rows(500, 1)
    odd = [(900, None, None, None, None), (901, "", "en", "s", 0), (902, "!!! 123", "en", "s", 0), (903, "the grunthaed stinkfol", "en", "s", 1),
           (None, "tana sok", "en", "s", 1), (904, "tanak " * 30000 + "vilescum grunthead", "en", "s", 1), (905, "tanak tanak", "en", "s", 1)]
    docs = spark.createDataFrame(rows + odd, SCHEMA).withColumn("predicted", F.lit(9))
    labels = spark.createDataFrame([*marks, (None, 1, 1), (1, 0, None), (905, 1, 0), (905, 1, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels, remainder("doc_id", 4) != 2)
    found = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert len(found) == len(rows) + len(odd)
    truth = {i: t for i, _, t in marks}
    wrong = [i for i, t in truth.items() if (found[i] >= toxicity.THRESHOLD) != t]
    assert len(wrong) <= 0.02 * len(truth)
    assert found[900] == found[901] == found[902] == 0.0
    assert found[903] >= toxicity.THRESHOLD and found[904] >= toxicity.THRESHOLD and found[905] < toxicity.THRESHOLD
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_toxicity_with_one_or_no_label():
    assert set(toxicity.fit(["a b", "c"], np.array([1, 1])).score(pa.array(["x", None]))) == {1.0}
    assert set(toxicity.fit([], np.array([], dtype=int)).score(pa.array(["x"]))) == {0.0}


def test_worst_stretch_of_rows():
    scores, limits = np.array([1.0, 2, 3, 9, 0, 0, 0]), np.array([0, 0, 2, 7])
    best, where = toxicity.worst_stretch(scores, limits, 3)
    assert best.tolist() == [0, 1.0, 4.0] and where.tolist() == [0, 0, 2]


def brute_links(ids, vectors, threshold=0.9):
    usable = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and np.any(v) for v in vectors]
    n = len(ids)
    near = np.zeros((n, n), dtype=bool)
    for i in range(n):
        for j in range(n):
            if i != j and usable[i] and usable[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], float), np.array(vectors[j], float)
                near[i, j] = a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold
    return near


def test_embedding_groups(spark):
    rng = np.random.default_rng(3)
    vectors = []
    for _ in range(60):
        centre = rng.normal(0, 1, 16)
        vectors += [(centre + rng.normal(0, s, 16)).tolist() for s in (0, 0.05, 0.1, 0.15)]
    vectors += [vectors[0], vectors[0], (2 * np.array(vectors[0])).tolist(), None, [], [0.0] * 16, [float("nan")] * 16,
                [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [1.0, 2.1]]
    ids = [*range(len(vectors) - 1), None]
    rows = spark.createDataFrame(list(zip(ids, vectors, [0] * len(ids), strict=True)), "vec_id long, embedding array<double>, node int")
    near = brute_links(ids, vectors)
    for block in (1024, 16):
        found = {r.vec_id: r for r in pivot_index.embedding_groups(rows, block=block).collect()}
        assert len(found) == len(ids)
        links = sum(found[i].n_links for i in ids)
        assert 0.9 * near.sum() <= links <= near.sum()
        assert all(found[i].n_links <= near[k].sum() for k, i in enumerate(ids))
        for i in ids[-8:-2]:
            assert found[i].n_links == 0 and found[i].component_id == i and found[i].kept
        assert found[0].component_id == found[240].component_id == 0 and not found[240].kept
    assert pivot_index.embedding_groups(rows.limit(0)).count() == 0


def test_embedding_recall_of_the_table(spark, sf_dir, tables):
    found = {r.vec_id: r for r in QUERIES["op5_pivot_index"](spark, sf_dir).collect()}
    rows = tables["embeddings"].collect()
    unit = np.array([r.embedding for r in rows], dtype=np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    links = sum(r.n_links for r in found.values())
    assert len(found) == len(rows) and 0.9 * near.sum() <= links <= near.sum()


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    model = boosted_trees.fit_trees(x[:2000], y[:2000])
    assert ((model.log_odds(x[2000:]) > 0) == y[2000:]).mean() > 0.95


ARTICLE = "<h1>A title &amp; more</h1><p>First paragraph, with <b>bold</b> words, long enough to be read as text.<p>Second one &eacute;\n here, " \
          "which goes on for a while, so that it is plainly a paragraph.</p>"


@pytest.fixture(scope="module")
def trees(spark, sf_dir, tables):
    return html_extraction.train(tables["pages"])


def test_pages_of_the_table(spark, sf_dir, tables, trees):
    rows = html_extraction.extract(tables["pages"].limit(80).withColumn("text", F.lit("own")), trees).collect()
    sources = {r.page_id: r.html for r in tables["pages"].collect()}
    right = 0
    for r in rows:
        page = read_page(sources[r.page_id])
        inside, expected = [False] * len(page.tag), []
        for i, tag in enumerate(page.tag):
            inside[i] = tag == "article" or (page.parent[i] >= 0 and inside[page.parent[i]])
            if inside[i] and not tag:
                expected.append(page.text[i])
        right += r.text == "\n\n".join(expected)
    assert right >= 0.97 * len(rows)


@pytest.mark.parametrize("wrapper", ["article", "main", 'div class="post-content"', "div"])
def test_surroundings_are_left_out(spark, trees, wrapper):
    name = wrapper.split()[0]
    page = (
        '<html><head><title>t</title><style>p{}</style></head><body><header><h2>Site</h2><nav><ul><li><a href=/>Home</a><li><a href=/a>About us'
        '</a></ul></nav></header><div class="cookie-notice"><p>We use cookies, please accept them all.</p></div>'
        f'<{wrapper}>{ARTICLE}</{name}><aside class="sidebar"><h3>Related</h3><ul><li><a href=/1>One</a></li><li><a href=/2>Two</a></li></ul>'
        '</aside><section id="comments"><h3>Comments</h3><p>I liked this very much, thanks for writing it.</p></section>'
        '<form><p>Newsletter</p><button>Go</button></form><footer>&copy; all rights reserved</footer><script>var a="</p>";</script></body>')
    hostile = [(1, "u", page), (2, "u", None), (3, "u", ""), (4, "u", "<p>"), (5, "u", "plain"), (6, "u", "<div><scr"), (1, "u", page),
               (7, "u", "<p>" + "long text, very long. " * 20000), (8, "u", "</div></p><b>x</b>")]
    frame = spark.createDataFrame(hostile, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_extraction.extract(frame, trees).collect()}
    assert found[1] == (
        "A title & more\n\nFirst paragraph, with bold words, long enough to be read as text.\n\nSecond one é here, which goes on for a "
        "while, so that it is plainly a paragraph.")
    assert found[2] == found[3] == found[4] == found[6] == ""
    assert html_extraction.extract(frame.limit(0), trees).count() == 0


def test_choice_is_closed_upwards():
    page = read_page("<div><p>a</p><div><p>b</p></div></div>")
    rng = np.random.default_rng(4)
    for _ in range(50):
        odds = rng.normal(0, 3, len(page.tag))
        taken = html_extraction.choose(page, odds)
        assert all(not t or taken[max(page.parent[i], 0)] for i, t in enumerate(taken))
        n = len(page.tag)
        cost = lambda s: sum(np.logaddexp(0, -o if k else o) for o, k in list(zip(odds, s, strict=True))[1:])
        every = ([True, *(bool(bits >> i & 1) for i in range(n - 1))] for bits in range(1 << (n - 1)))
        best = min(cost(s) for s in every if all(not s[i] or s[page.parent[i]] for i in range(1, n)))
        assert abs(cost(taken) - best) < 1e-9


def test_training_without_any_page(spark):
    model = html_extraction.train(spark.createDataFrame([], "page_id long, html string"))
    page = read_page(f"<article>{ARTICLE}</article>")
    assert html_extraction.main_text(page, model.log_odds(html_extraction.features(page)))


@pytest.mark.parametrize("source", ["<div>" * 100_000 + "x", "</div>" * 100_000 + "x", "<div><p>" + "</ul>" * 100_000 + "x", "<p><div>" * 50_000 + "x"])
def test_reader_is_linear_in_depth_and_stray_tags(source):
    began = time.process_time()
    page = read_page(source)
    assert time.process_time() - began < 5 and [t for t in page.text if t] == ["x"]


def test_reader_closes_within_the_nearest_container():
    page = read_page("<ul><li>a<ul><li>b<li>c</ul><li>d</ul><table><tr><td>e<p>f<td>g<tr><td>h</table></section>")
    shown = {page.text[i]: (page.tag[page.parent[i]], page.tag[page.parent[page.parent[i]]]) for i in range(len(page.tag)) if not page.tag[i]}
    assert shown == {"a": ("li", "ul"), "b": ("li", "ul"), "c": ("li", "ul"), "d": ("li", "ul"), "e": ("td", "tr"), "f": ("p", "td"),
                     "g": ("td", "tr"), "h": ("td", "tr")}


def test_toxicity_fit_with_few_examples():
    texts = ["a bad grunthead here"] + [f"plain words number {w} only" for w in ("one", "two", "three", "four")]
    for n_toxic in (1, 2):
        model = toxicity.fit(texts[:1] * n_toxic + texts[1:], np.array([1] * n_toxic + [0] * 4))
        score = model.score(pa.array(["grunthead bad grunthead here", "plain words only", None], pa.string()))
        assert score[0] > score[1] and score[2] == 0 and (n_toxic > 1) == (model.slopes != (0.0, 1.0))


@pytest.mark.parametrize("toxic", [20, 1, 0])
def test_toxicity_is_fitted_in_tasks(spark, monkeypatch, toxic):
    rows = [(i, int(i % 2 and i < 2 * toxic), ("you awful rotten fool" if i % 2 else "a kind and sunny day") + f" number {i % 7}") for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, m) for i, m, _ in rows], "doc_id long, toxic int")
    ordered = sorted(rows, key=lambda r: str(r[0]))
    expected = toxicity.fit([r[2] for r in ordered], np.array([r[1] for r in ordered]))
    monkeypatch.setattr(toxicity, "fit", None)  # nothing is fitted on the driver
    found = toxicity.train(docs, labels)
    assert np.array_equal(found.bucket_scores, expected.bucket_scores)
    assert (found.bias, found.slopes, found.shift) == (expected.bias, expected.slopes, expected.shift)
