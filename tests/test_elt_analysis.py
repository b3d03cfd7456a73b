from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from paysignal.functions import normalize
from paysignal.plans import analysis, elt
from paysignal.schemas import CANONICAL_COLUMNS, CONSOLIDATED_COLUMNS


@pytest.mark.parametrize("raw, code", [
    ("España", "ES"), ("españa ", "ES"), ("  spain", "ES"), ("México", "MX"), ("UK", "GB"), ("Reino Unido", "GB"),
    ("Estados Unidos", "US"), ("alemania", "DE"), ("Italia", "IT"), ("Narnia", "NARNIA"), (" ru ", "RU"), (None, None),
])
def test_country(spark, raw, code):
    df = spark.createDataFrame([(raw,)], "c string")
    assert df.select(normalize.country_code(F.col("c"))).head()[0] == code


@pytest.mark.parametrize("raw, status", [
    ("OK", "approved"), (" Approve", "approved"), ("Rejected", "declined"), ("FAIL", "declined"), ("pending", "pending"), (None, None),
])
def test_status(spark, raw, status):
    df = spark.createDataFrame([(raw,)], "s string")
    assert df.select(normalize.payment_status(F.col("s"))).head()[0] == status


@pytest.mark.parametrize("name", ["event_time", "event_ts", "timestamp"])
@pytest.mark.parametrize("raw, shown", [
    ("2024-01-02T03:04:05Z", "2024-01-02 03:04:05"), ("2024-01-02 03:04:05", "2024-01-02 03:04:05"),
    ("2024-01-02T03:04:05+02:00", "2024-01-02 01:04:05"), ("not-a-date", None), (None, None),
])
def test_event_time(spark, name, raw, shown):
    df = spark.createDataFrame([(raw,)], f"`{name}` string")
    assert df.select(F.date_format(normalize.event_time(df), "yyyy-MM-dd HH:mm:ss")).head()[0] == shown


RAW = "payment_id string, card_id string, amount string, event_time string, country string, status string"


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_canonical_keeps_valid_latest_rows(spark):
    df = raw(spark, [
        (" a ", "c1 ", "1.5", "2024-01-01 00:00:00", "es", "ok"),
        ("a", "c1", "2.5", "2024-01-01 00:00:09", "es", "denied"),
        ("", "c1", "1", "2024-01-01 00:00:00", "es", "ok"),
        ("b", " ", "1", "2024-01-01 00:00:00", "es", "ok"),
        ("c", "c1", "-1", "2024-01-01 00:00:00", "es", "ok"),
        ("d", "c1", "x", "2024-01-01 00:00:00", "es", "ok"),
        ("e", "c1", "1", "never", "es", "ok"),
    ])
    found = elt.canonical(df, "s3")
    assert found.columns == CANONICAL_COLUMNS
    (row,) = found.collect()
    assert (row.payment_id, row.card_id, row.amount, row.status, row.risk_score, row.tx_5m) == ("a", "C1", 2.5, "declined", 0.0, 0)


def test_merge_prefers_the_store_field_by_field(spark):
    store = raw(spark, [("a", "c1", "1", "2024-01-01 00:00:00", None, "ok"), ("b", "c2", "2", "2024-01-01 00:00:00", "PT", "ok")])
    other = raw(spark, [("a", "c9", "9", "2024-01-02 00:00:00", "FR", "denied"), ("z", "c3", "3", "2024-01-03 00:00:00", "IT", "ok")])
    merged = elt.merge(elt.canonical(store, "s3"), elt.canonical(other, "rds"))
    assert merged.columns == CONSOLIDATED_COLUMNS
    found = {r.payment_id: r for r in merged.collect()}
    assert (found["a"].card_id, found["a"].amount, found["a"].country, found["a"].status) == ("C1", 1.0, "FR", "approved")
    assert (found["a"].source_s3, found["a"].source_rds) == ("s3", "rds")
    assert (found["b"].source_s3, found["b"].source_rds) == ("s3", None)
    assert (found["z"].source_s3, str(found["z"].event_date)) == (None, "2024-01-03")


BASE = ("payment_id string, card_id string, amount double, event_time timestamp, country string, status string, "
        "risk_score double, tx_5m int, merchants_10m int, countries_1h int, source_s3 string, source_rds string, event_date date")


def base(spark, rows):
    import datetime as dt

    t = dt.datetime(2024, 1, 1, 10, 30, tzinfo=dt.timezone.utc)
    full = [(f"p{i}", r.get("card", "C"), 1.0, t, r.get("country", "ES"), r.get("status", "approved"), r.get("score", 0.0),
             r.get("tx", 0), r.get("merchants", 0), r.get("countries", 0), "s3", None, t.date()) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, BASE)


def test_risk_filter_branches(spark):
    rows = [{}, {"score": 60.0}, {"tx": 5}, {"merchants": 4}, {"countries": 3}, {"country": "RU"}, {"country": None},
            {"country": None, "tx": 5}]
    found = {r.payment_id for r in base(spark, rows).filter(elt.is_risky()).collect()}
    assert found == {"p1", "p2", "p3", "p4", "p5", "p7"}
    strict = elt.RiskThresholds(score=99, tx_5m=99, merchants_10m=99, countries_1h=99, countries=" es , pt")
    assert {r.payment_id for r in base(spark, rows).filter(elt.is_risky(strict)).collect()} == {"p0", "p1", "p2", "p3", "p4"}


def test_stage_counts(spark):
    counts = {r.stage: r.row_count for r in elt.stage_counts(base(spark, [{}, {"score": 80.0}])).collect()}
    assert counts == {"s3_clean": 2, "rds_clean": 0, "merged": 2, "filtered": 1}


def test_high_risk_variants(spark):
    rows = base(spark, [{"score": 70.0, "status": "declined"}, {"status": "declined"}, {"status": "DECLINED"}, {"score": 69.9}])
    job = {r.payment_id: r.risk_reason for r in analysis.high_risk_tx(rows).collect()}
    assert job == {"p0": "high_risk_score", "p1": "declined_status"}
    assert {r.payment_id for r in analysis.high_risk_tx_sql(rows).collect()} == {"p0", "p1", "p2"}


def test_suspicious_cards(spark):
    rows = base(spark, [
        {"card": "two high", "score": 70.0}, {"card": "two high", "score": 90.0}, {"card": "fast", "tx": 8},
        {"card": "abroad", "country": "ES"}, {"card": "abroad", "country": "PT"}, {"card": "quiet", "score": 99.0},
    ])
    found = {r.card_id: r for r in analysis.suspicious_cards(rows).collect()}
    assert set(found) == {"two high", "fast", "abroad"}
    assert (found["two high"].total_tx, found["two high"].high_risk_tx, found["two high"].avg_risk_score) == (2, 2, 80.0)
    assert "max_merchants_10m" not in analysis.suspicious_cards_sql(rows).columns


def test_geography(spark):
    rows = base(spark, [{"country": "RU"}, {"country": "ES", "countries": 2}, {"country": "PT"}, {"country": "FR", "status": "declined"},
                        {"country": "IT", "score": 75.0}])
    found = {r.country: r for r in analysis.geo_patterns(rows).collect()}
    assert set(found) == {"RU", "ES", "FR", "IT"}
    assert found["RU"].is_suspicious_country == 1 and found["FR"].declined_tx == 1
    assert [r.country for r in analysis.geo_patterns_sql(rows).collect()] == ["IT"]


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_written_analyses(spark, tmp_path, file_format):
    rows = base(spark, [{"score": 70.0}, {"score": 80.0}])
    summary = analysis.write_analyses(spark, rows, str(tmp_path), file_format).collect()
    assert [r.dataset for r in summary] == ["high_risk_transactions", "suspicious_cards", "geo_fraud_patterns"]
    for r in summary:
        assert spark.read.format(file_format).option("header", True).load(r.output_path).count() > 0
    with pytest.raises(ValueError):
        analysis.write_analyses(spark, rows, str(tmp_path), "orc")
