"""Stages of the corpus pipeline: what they keep, against plain computations, on hostile rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paysignal.session import fresh_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
NAMES = [name for name, _ in corpus_pipeline.STAGES]


def sentence(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return [rng.choice("ta re mo li su ne ka vi".split()) + rng.choice("n s r l m t".split()) + str(rng.randrange(50)) for _ in range(n)]


@pytest.fixture(scope="module")
def folder(spark):
    """Tables with planted cases: 0-199 clean, 200-259 toxic, 300-302 near copies of 0, 310-311 exact copies of 1, 320-321
    share a passage, 330 junk."""
    rows = [(i, " ".join(sentence(i, 60 + i % 40)) + ".", "en", f"s{i % 3}", None) for i in range(200)]
    for i in range(200, 260):
        w = sentence(i, 50)
        w[i % 50] = w[(i + 9) % 50] = ["grunthead", "vilescum"][i % 2]
        rows.append((i, " ".join(w), "en", "s0", None))
    near = rows[0][1].split()
    for k in range(3):
        rows.append((300 + k, " ".join([*near[: 20 + k], "other", *near[21 + k :]]), "en", "s1", None))
    rows += [(310, rows[1][1], "en", "s1", None), (311, rows[1][1], "fr", "s2", None)]
    passage = sentence(999, 55)
    rows += [(320 + k, " ".join(sentence(700 + k, 70) + passage + sentence(800 + k, 30)), "en", "s0", None) for k in range(2)]
    rows += [(330, "### $$$ " * 100, "en", "s0", None), (340, None, None, None, None), (341, "", "en", "s0", 0), (3, rows[3][1], "en", "s0", None)]
    path = fresh_path(spark, "planted")
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.repartition(4).write.parquet(f"{path}/documents.parquet")
    marks = [(i, 1, int(200 <= i < 260)) for i in range(260)]
    spark.createDataFrame([*marks, (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def ids(frame) -> set:
    return {r.doc_id for r in frame.select("doc_id").collect()}


def test_each_stage_does_its_work(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert NAMES == ["toxicity", "quality_rules", "ngram_jaccard_join", "substring_dedup", "packing"]
    functions = dict(corpus_pipeline.STAGES)
    for name in NAMES[:-1]:
        assert functions[name](spark, docs, folder).columns == docs.columns
    left = ids(functions["toxicity"](spark, docs, folder))
    assert len(left & set(range(200, 260))) <= 2 and len(set(range(200)) - left) <= 4
    left = ids(functions["quality_rules"](spark, docs, folder))
    assert not left & {330, 340, 341} and set(range(200)) <= left
    kept = functions["ngram_jaccard_join"](spark, docs, folder)
    left = ids(kept)
    assert not left & {300, 301, 302, 310, 311} and {0, 1, 3, 320, 321, 340, 341} <= left
    assert kept.count() == len(left)  # the repeated row 3 is there once
    cut = {r.doc_id: r for r in functions["substring_dedup"](spark, docs, folder).collect()}
    before = {r.doc_id: r.text for r in docs.collect()}
    assert cut[320].text.split() == sentence(700, 70) + sentence(800, 30) and cut[320].n_chars == len(cut[320].text)
    assert cut[5].text == before[5] and cut[340].text is None and set(cut) == set(before)


def test_run_is_the_stages_in_turn(spark, folder):
    found = corpus_pipeline.run(spark, folder)
    left = ids(found)
    assert {5, 6, 7, 320, 321} <= left and not left & {300, 301, 302, 310, 311, 330}
    assert found.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").isEmpty()


def test_stages_of_empty_tables(spark, folder):
    docs = spark.createDataFrame([], SCHEMA)
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, docs, folder).count() == 0
