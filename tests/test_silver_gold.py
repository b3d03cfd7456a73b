from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from paysignal import schemas
from paysignal.functions.rules import DEFAULT_RULES
from paysignal.plans import gold, silver
from tests.conftest import at


def by_id(df):
    return {r.payment_id: r for r in df.collect()}


def test_malformed_times_and_missing_keys_are_dropped(bronze):
    raw = bronze([{"payment_id": "ok"}, {"payment_id": "bad", "event_time": "not-a-date"},
                  {"payment_id": None}, {"payment_id": "no-card", "card_id": None}, {"payment_id": "no-device", "device_id": None}])
    assert set(by_id(silver.clean(raw))) == {"ok"}
    assert set(by_id(silver.clean(raw, strict=False))) == {"ok", None, "no-card", "no-device"}


def test_latest_copy_wins_by_the_chosen_time(bronze):
    raw = bronze([
        {"payment_id": "p", "second": 100, "ingestion_ts": at(500), "status": "late arrival"},
        {"payment_id": "p", "second": 200, "ingestion_ts": at(300), "status": "late event"},
    ])
    assert by_id(silver.clean(raw))["p"].status == "late arrival"
    assert by_id(silver.clean(raw, "event_time"))["p"].status == "late event"


def test_ties_are_broken_by_the_other_columns(bronze):
    raw = bronze([{"payment_id": "p", "amount": float(a)} for a in (3, 9, 5)])
    assert by_id(silver.clean(raw))["p"].amount == 9.0
    assert by_id(silver.clean(raw.repartition(3)))["p"].amount == 9.0


def test_features_of_hand_built_rows(bronze):
    raw = bronze([
        {"payment_id": "a", "second": 0, "merchant_id": "m1"},
        {"payment_id": "b", "second": 300, "merchant_id": "m2", "country": "PT", "status": "declined"},
        {"payment_id": "c", "second": 601, "merchant_id": "m1", "status": None},
        {"payment_id": "d", "second": 9000, "card_id": "c2"},
    ])
    found = by_id(silver.features(silver.clean(raw)))
    values = {k: tuple(r[c] for c in schemas.FEATURE_COLUMNS) for k, r in found.items()}
    assert values["a"] == (1, 1, 1, 2, 0.0)
    assert values["b"] == (2, 2, 2, 2, 0.5)
    assert values["c"] == (1, 2, 2, 2, 0.3333)  # a null status is not declined
    assert values["d"] == (1, 1, 1, 2, 0.0)  # the device count sees all rows


def test_lenient_mode_groups_null_keys(bronze):
    raw = bronze([
        {"payment_id": "a", "second": 0, "card_id": None}, {"payment_id": "b", "second": 10, "card_id": None},
        {"payment_id": None, "second": 20, "card_id": None, "device_id": None},
        {"payment_id": "c", "second": 0, "card_id": "c1", "device_id": None},
    ])
    found = by_id(silver.features(silver.clean(raw, strict=False), strict=False))
    assert len(found) == 4
    assert found["b"].tx_by_card_5m == 2
    assert found[None].tx_by_card_5m == 2  # a null payment id is not counted, its row is kept
    assert found["c"].distinct_cards_per_device == 1
    assert found["a"].distinct_cards_per_device == 0


def test_schemas(bronze):
    raw = bronze([{}])
    built = silver.features(silver.clean(raw))
    assert built.columns == schemas.SILVER_COLUMNS
    assert dict(built.dtypes)["event_time"] == "timestamp"
    assert [dict(built.dtypes)[c] for c in schemas.FEATURE_COLUMNS] == ["int", "int", "int", "int", "double"]
    assert silver.short_silver(built).columns == schemas.SHORT_SILVER_COLUMNS
    scored = gold.score(built)
    assert gold.alerts(scored).columns == schemas.ALERT_COLUMNS and len(schemas.ALERT_COLUMNS) == 18
    assert gold.alerts(scored, with_mcc=True).columns == schemas.ALERT_COLUMNS_WITH_MCC
    assert gold.graph_payments(scored).columns == schemas.GRAPH_PAYMENT_COLUMNS and len(schemas.GRAPH_PAYMENT_COLUMNS) == 18
    assert gold.payment_relations(scored).columns == schemas.RELATION_COLUMNS and len(schemas.RELATION_COLUMNS) == 21
    assert dict(scored.dtypes)["risk_score"] == "int" and dict(scored.dtypes)["reasons"] == "array<string>"


def test_empty_input(bronze):
    empty = bronze([])
    scored = gold.score(silver.features(silver.clean(empty)))
    assert scored.collect() == [] and gold.alerts(scored).columns == schemas.ALERT_COLUMNS


@pytest.fixture
def silver_row(spark):
    base = {"tx_by_card_5m": 0, "distinct_merchants_10m": 0, "distinct_countries_1h": 0,
            "distinct_cards_per_device": 0, "declined_ratio_1h": 0.0, "amount": 0.0}
    schema = ("tx_by_card_5m int, distinct_merchants_10m int, distinct_countries_1h int, "
              "distinct_cards_per_device int, declined_ratio_1h double, amount double")
    return lambda **kw: gold.score(spark.createDataFrame([tuple({**base, **kw}.values())], schema)).head()


@pytest.mark.parametrize("rule", DEFAULT_RULES, ids=lambda r: r.reason)
def test_each_rule_fires_at_its_threshold(silver_row, rule):
    integral = rule.column not in ("declined_ratio_1h", "amount")
    at_limit = int(rule.threshold) if integral else float(rule.threshold)
    below = at_limit - (1 if integral else 0.0001)
    hit, miss = silver_row(**{rule.column: at_limit}), silver_row(**{rule.column: below})
    assert (hit.risk_score, hit.reasons, hit.is_alert) == (rule.weight, [rule.reason], True)
    assert (miss.risk_score, miss.reasons, miss.is_alert) == (0, [], False)


def test_all_rules_and_nulls(silver_row):
    everything = silver_row(**{r.column: (r.threshold if r.column in ("declined_ratio_1h",) else
                                          float(r.threshold) if r.column == "amount" else int(r.threshold))
                               for r in DEFAULT_RULES})
    assert everything.risk_score == 100
    assert everything.reasons == [r.reason for r in DEFAULT_RULES]
    assert everything.reasons_text == ", ".join(everything.reasons)
    nothing = silver_row(**{r.column: None for r in DEFAULT_RULES})
    assert (nothing.risk_score, nothing.reasons, nothing.reasons_text, nothing.is_alert) == (0, [], "", False)


def test_layer_invariants(spark, sf_dir):
    from checks.sources import layers

    base = layers(spark, sf_dir)
    assert base.bronze.count() == 1031 and base.silver.count() == 1000
    assert base.alerts().count() == 776
    unexplained = base.gold.filter((F.col("risk_score") > 0) != F.col("is_alert"))
    assert unexplained.count() == 0
