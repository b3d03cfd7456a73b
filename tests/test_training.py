from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from paysignal.functions.text import plain_decimal
from paysignal.operators.metrics import binary_metrics
from paysignal.operators.split import stratified_split
from paysignal.plans import training


@pytest.mark.parametrize("value, text", [
    (12.5, "12.5"), (100.0, "100.0"), (0.125, "0.12"), (0.375, "0.38"), (2.675, "2.68"), (1.005, "1.0"), (0.0, "0.0"),
    (9999999.994, "9999999.99"), (1e7, "10000000.0"), (12345678.25, "12345678.25"), (123456789012.5, "123456789012.5"),
])
def test_decimal_text(spark, value, text):
    assert round(float(text), 2) == float(text)
    df = spark.createDataFrame([(value,)], "v double")
    shown = df.select(plain_decimal(F.col("v"))).head()[0]
    assert shown == text == str(__import__("numpy").round(value, 2))


def test_labels_and_text(spark):
    df = spark.createDataFrame(
        [(" p1 ", "c1", 10.004, "españa", "Declined", 12.0, 2), ("p2", "c2", 5.0, "spain", "approved", 70.0, None),
         ("p3", "c3", 5.0, "PT", "approved", None, 1), ("", "c3", 5.0, "PT", "approved", 0.0, 1), ("p4", "c3", -5.0, "PT", "x", 0.0, 1)],
        "payment_id string, card_id string, amount double, country string, status string, risk_score double, tx_by_card_5m int")
    found = {r.payment_id: r for r in training.labelled(df).collect()}
    assert {k: r.label for k, r in found.items()} == {"p1": 1, "p2": 1, "p3": 0}
    assert found["p1"].text == ("amount=10.0 | card=C1 | country=ES | status=declined | risk_score=12.0 | tx_5m=2 | "
                                "merchants_10m=0 | countries_1h=0")
    assert found["p2"].country == "ES"
    assert training.training_set(df).columns == ["text", "label"]


@pytest.mark.parametrize("column", ["label", "is_fraud"])
def test_given_labels_win(spark, column):
    df = spark.createDataFrame([("p1", "c", 1.0, "declined", "0"), ("p2", "c", 1.0, "approved", "1"), ("p3", "c", 1.0, "approved", "x")],
                               f"payment_id string, card_id string, amount double, status string, {column} string")
    assert {r.payment_id: r.label for r in training.labelled(df).collect()} == {"p1": 0, "p2": 1, "p3": 0}


def test_last_copy_of_a_payment_is_kept(spark):
    df = spark.createDataFrame([("p", "c", 1.0, 5), ("p", "c", 2.0, 9), ("p", "c", 3.0, 7)], "payment_id string, card_id string, amount double, event_time int")
    assert [r.amount for r in training.labelled(df).collect()] == [2.0]


def test_split_is_exact(spark):
    keys = [(f"k{i}", int(i % 7 == 0)) for i in range(1000)] + [("only", 0)]
    df = spark.createDataFrame(keys, "key string, label int")
    found = {r.key: r.split for r in stratified_split(df, "label", "key").collect()}
    assert len(found) == len(keys)
    for label in (0, 1):
        mine = sorted((k for k, l in keys if l == label), key=lambda k: hashlib.md5(f"42{k}".encode()).hexdigest())
        wanted = int(0.2 * len(mine) + 0.5)
        assert {k for k in mine if found[k] == "eval"} == set(mine[:wanted])
    other = {r.key: r.split for r in stratified_split(df, "label", "key", seed=7).collect()}
    assert other != found


def test_split_of_tiny_and_unknown_classes(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "key string, label int")
    assert {r.split for r in stratified_split(df, "label", "key").collect()} == {"train"}
    everything = stratified_split(df, "label", "key", test_fraction=1.0).collect()
    assert {r.split for r in everything} == {"eval"} and len(everything) == 3
    with pytest.raises(Exception, match="known classes"):
        stratified_split(spark.createDataFrame([("a", 5)], "key string, label int"), "label", "key").collect()


def test_split_is_a_comparison_per_row(spark):
    rows = [(f"k{i}", i % 2) for i in range(500)] + [(None, 0), ("k0", 0), ("k0", 0)]
    df = spark.createDataFrame(rows, "key string, label int")
    found = stratified_split(df, "label", "key")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Sort" not in plan
    # null keys are kept, rows of equal key stay together
    assert found.count() == len(rows)
    assert found.filter("key = 'k0'").select("split").distinct().count() == 1


def test_inputs_are_bounded_and_apart(spark):
    rows = [(c, s, f"card{i}", 1.0, 1.0, 0.0, 0.0, 0.0, i % 2) for i, (c, s) in enumerate(
        [("ES", "approved")] * 4 + [("FR", "declined")] * 3 + [("PT", "approved")] * 2 + [("XX", "")])]
    df = spark.createDataFrame(rows, "country string, status string, card_id string, amount double, risk_score double, "
                                     "tx_5m double, merchants_10m double, countries_1h double, label int")
    assert training.categories(df, "country", 2) == ["ES", "FR"]
    from pyspark.ml import Pipeline

    stages = training.feature_stages(df, True, hash_size=16, most_categories=2)
    found = Pipeline(stages=stages).fit(df).transform(df).collect()
    # five numbers; country and status with two values and one column for others each; sixteen hashed columns of cards
    assert {r.features.size for r in found} == {5 + 3 + 3 + 16}
    columns = {r.country: r.features.toArray()[5:8].tolist() for r in found}
    assert columns == {"ES": [1, 0, 0], "FR": [0, 1, 0], "PT": [0, 0, 1], "XX": [0, 0, 1]}


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, guess int, score double")


def test_metrics(spark):
    found = binary_metrics(scored(spark, [(1, 1, 0.9), (1, 0, 0.4), (0, 1, 0.6), (0, 0, 0.1)]), "label", "guess", "score")
    assert found == {"accuracy": 0.5, "precision": 0.5, "recall": 0.5, "f1": 0.5, "roc_auc": 0.75}


def test_metrics_at_the_edges(spark):
    ties = binary_metrics(scored(spark, [(1, 0, 0.5), (0, 0, 0.5), (1, 0, 0.5)]), "label", "guess", "score")
    assert ties["roc_auc"] == 0.5 and ties["precision"] == 0.0 and ties["f1"] == 0.0
    one_class = binary_metrics(scored(spark, [(0, 0, 0.5), (0, 0, 0.7)]), "label", "guess", "score")
    assert "roc_auc" not in one_class and one_class["accuracy"] == 1.0


def test_single_class_is_an_error(spark):
    rows = training.labelled(spark.createDataFrame([("p", "c", 1.0)], "payment_id string, card_id string, amount double"))
    with pytest.raises(ValueError, match="single class"):
        training.train_classifier(rows)
    with pytest.raises(ValueError, match="empty"):
        training.train_classifier(rows.limit(0))
