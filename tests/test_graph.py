from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from paysignal.operators.reach import members, reach_count
from paysignal.plans import graph
from paysignal.sinks import graph_files
from tests.conftest import at

GOLD = ("payment_id string, payment_group_id string, event_time timestamp, customer_id string, card_id string, merchant_id string, "
        "device_id string, ip string, country string, amount double, currency string, status string, mcc string, risk_score int, "
        "reasons_text string, is_alert boolean")


@pytest.fixture
def gold_rows(spark):
    def make(rows):
        full = []
        for i, r in enumerate(rows):
            full.append((r.get("payment", f"p{i}"), r.get("group", "g"), at(r.get("second", i)), r.get("customer", "u1"), r.get("card", "c1"),
                         r.get("merchant", "m1"), r.get("device", "d1"), "10.0.0.1", r.get("country", "ES"), r.get("amount", 1.0), "EUR",
                         "approved", r.get("mcc", "5411"), r.get("score", 0), r.get("reasons", ""), r.get("alert", False)))
        return spark.createDataFrame(full, GOLD)

    return make


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_staging_contract(spark, gold_rows):
    full = gold_rows([{"second": 0}, {"second": 10}, {"second": 20}])
    assert graph.staging(full).columns == list(graph.STAGING_TYPES)
    kept = graph.staging(full, "2024-01-01T00:00:10Z", "2024-01-01T00:00:20Z")
    assert [r.payment_id for r in kept.collect()] == ["p1"]
    with pytest.raises(ValueError, match="card_id, device_id"):
        graph.staging(full.drop("card_id", "device_id"))
    bare = graph.staging(full.select(*graph.REQUIRED).withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")),
                         start="2024-01-01T00:00:20+00:00")
    (row,) = bare.collect()
    assert (row.payment_id, row.ip, row.amount, row.risk_score, row.is_alert) == ("p2", "", 0.0, 0, False)


def test_nodes_take_the_latest_attributes(gold_rows):
    built = graph.nodes(gold_rows([
        {"payment": "a", "second": 5, "country": "PT", "mcc": "2"}, {"payment": "b", "second": 1, "country": "ES", "mcc": "1"},
        {"payment": "a", "second": 9, "merchant": "m2", "amount": 7.0, "group": None}, {"payment": None, "customer": None},
    ]), "g1")
    assert rows(built["merchants"].filter("merchant_id = 'm1'").select("country", "mcc")) == [("PT", "2")]
    payments = {r.payment_id: r for r in built["payments"].collect()}
    assert set(payments) == {"a", "b"}
    assert (payments["a"].amount, payments["a"].payment_group_id, payments["a"].graph_name) == (7.0, "", "g1")
    assert payments["a"].event_time == "2024-01-01 00:00:09.000000 UTC"
    assert rows(built["customers"]) == [("u1",)]


def test_loading_snapshots(gold_rows):
    a = graph.snapshot(gold_rows([{"payment": "p1"}, {"payment": "p2", "card": "c2", "merchant": "m2"}]), "a")
    b = graph.snapshot(gold_rows([{"payment": "p1", "amount": 9.0, "merchant": "m1", "country": "FR"}, {"payment": "p3", "card": "c3"}]), "b")
    store = graph.load_snapshot(a, b, "b")
    owner = {r.payment_id: (r.graph_name, r.amount) for r in store.nodes["payments"].collect()}
    assert owner == {"p1": ("b", 9.0), "p2": ("a", 1.0), "p3": ("b", 1.0)}
    assert {r.merchant_id: r.country for r in store.nodes["merchants"].collect()} == {"m1": "ES", "m2": "ES"}
    assert {r.card_id for r in store.nodes["cards"].collect()} == {"c1", "c2", "c3"}
    assert sorted(rows(store.edges["authorized"])) == [("c1", "p1"), ("c2", "p2"), ("c3", "p3")]
    # loading "b" again with less: its payments and their edges go, cards and devices stay
    again = graph.load_snapshot(store, graph.snapshot(gold_rows([{"payment": "p9", "card": "c9"}]), "b"), "b")
    assert {r.payment_id for r in again.nodes["payments"].collect()} == {"p2", "p9"}
    assert sorted(rows(again.edges["authorized"])) == [("c2", "p2"), ("c9", "p9")]
    assert {r.card_id for r in again.nodes["cards"].collect()} == {"c1", "c2", "c3", "c9"}
    assert len(rows(again.edges["used_on"])) == 4
    assert rows(graph.key_violations(again)) == []


def test_edges_need_both_ends(spark, gold_rows):
    built = graph.snapshot(gold_rows([{"card": "c1"}, {"card": "c2"}]), "g")
    nodes = {**built.nodes, "cards": built.nodes["cards"].filter("card_id = 'c1'")}
    resolved = graph.resolve_edges(built.edges, nodes)
    assert rows(resolved["used_on"]) == [("c1", "d1")] and rows(resolved["authorized"]) == [("c1", "p0")]


def test_key_violations_are_found(gold_rows):
    built = graph.snapshot(gold_rows([{}]), "g")
    doubled = graph.Graph({**built.nodes, "cards": built.nodes["cards"].union(built.nodes["cards"])}, built.edges)
    assert rows(graph.key_violations(doubled)) == [("cards", "c1", 2)]


def test_export_counts(gold_rows):
    found = dict(rows(graph.export_counts(gold_rows([{"card": "c1"}, {"card": "c2"}]))))
    assert found == {"rows": 2, "customers": 1, "cards": 2, "devices": 1, "merchants": 1, "payments": 2}


def test_clusters_list_alerting_cards_only(gold_rows):
    one_alerts = graph.snapshot(gold_rows([{"card": "c1", "alert": True}, {"card": "c2"}]), "g")
    assert rows(graph.device_clusters(one_alerts, "g")) == [("d1", "c1", 1)]
    alone = graph.snapshot(gold_rows([{"card": "c1", "alert": True}]), "g")
    assert rows(graph.device_clusters(alone, "g")) == []
    assert rows(graph.device_clusters(one_alerts, "other")) == []


def test_shared_devices_see_links_of_other_snapshots(gold_rows):
    a = graph.snapshot(gold_rows([{"payment": f"a{i}", "card": f"c{i}", "device": "d1"} for i in range(3)]), "a")
    b = graph.snapshot(gold_rows([{"payment": f"b{i}", "card": f"c{i}", "device": "d2"} for i in range(3)]), "b")
    store = graph.load_snapshot(a, b, "b")
    every = [(d, 3, c) for d in ("d1", "d2") for c in ("c0", "c1", "c2")]
    assert rows(graph.shared_devices(store, "b")) == every
    assert rows(graph.shared_devices(store)) == every
    assert rows(graph.shared_devices(store, "nothing")) == []


def test_random_graph_against_plain_python(gold_rows):
    rnd = random.Random(3)
    data = [{"card": "hub" if i % 3 == 0 else f"c{rnd.randrange(12)}", "customer": f"u{rnd.randrange(8)}", "device": f"d{rnd.randrange(6)}",
             "merchant": f"m{rnd.randrange(7)}", "country": rnd.choice("ABCDE"), "alert": rnd.random() < 0.4} for i in range(120)]
    built = graph.snapshot(gold_rows(data), "g")
    owners, links = {(d["customer"], d["card"]) for d in data}, {(d["card"], d["device"]) for d in data}

    expected = {}
    for device in {d["device"] for d in data}:
        on_device = {c for c, dev in links if dev == device}
        others = {o for c in on_device for o in on_device if c != o}  # the literal pairing
        paid = [(i, d["card"]) for i, d in enumerate(data) if d["alert"] and d["card"] in others]
        if paid:
            expected |= {(device, c): len({i for i, _ in paid}) for _, c in paid}
    found = {(r.device_id, r.card_id): r.alert_payments for r in graph.device_clusters(built, "g").collect()}
    assert found == expected

    expected = {}
    for merchant in {d["merchant"] for d in data}:
        cards = {d["card"] for d in data if d["merchant"] == merchant and d["alert"]}
        customers = {u for u, c in owners if c in cards}
        if len(customers) >= 2 or len(cards) >= 3:
            expected[merchant] = (len(customers), len(cards))
    found = {r.merchant_id: (r.suspicious_customers, r.suspicious_cards) for r in graph.risky_merchants(built, "g").collect()}
    assert found == expected

    expected = {}
    for d in data:
        expected.setdefault(d["card"], set()).add(d["country"])
    found = rows(graph.multi_country_cards(built, "g"))
    assert sorted(found) == sorted((c, len(s), x) for c, s in expected.items() if len(s) >= 3 for x in s)


def test_reach_count_counts_a_leaf_once(spark):
    links = spark.createDataFrame([("g1", "x"), ("g1", "y"), ("g2", "y"), ("g3", "z")], "g string, v string")
    leaves = spark.createDataFrame([("x", "shared"), ("y", "shared"), ("y", "own"), ("q", "far")], "v string, leaf string")
    assert dict(rows(reach_count(links, leaves, "g", "v", "leaf", "n"))) == {"g1": 2, "g2": 2}


@pytest.mark.parametrize("seed", range(4))
def test_reach_count_on_many_to_many_graphs_with_hubs(spark, seed):
    """Two hubs own most leaves, and many leaves have several vias."""
    rnd = random.Random(seed)
    links = {(f"g{rnd.randrange(9)}", rnd.choice(["hub1", "hub2", *(f"v{i}" for i in range(8))])) for _ in range(40)}
    leaves = {(rnd.choice(["hub1", "hub1", "hub2", *(f"v{i}" for i in range(10))]), f"l{rnd.randrange(300)}") for _ in range(700)}
    expected = {}
    for g, v in links:
        expected.setdefault(g, set()).update(leaf for w, leaf in leaves if w == v)
    found = reach_count(
        spark.createDataFrame(sorted(links), "g string, v string"), spark.createDataFrame(sorted(leaves), "v string, leaf string"),
        "g", "v", "leaf", "n",
    )
    assert dict(rows(found)) == {g: len(s) for g, s in expected.items() if s}


@pytest.mark.parametrize("size", [1, 1000, 5000])
def test_members_have_one_shape_at_any_size(spark, size):
    pairs = spark.range(size).select(F.lit("key").alias("k"), F.col("id").cast("string").alias("m"))
    found = members(pairs.union(spark.createDataFrame([("none", "1")], "k string, m string")).filter("k = 'key'"), "k", "m", "total")
    assert sorted(rows(found)) == sorted(("key", size, str(i)) for i in range(size))
    assert rows(members(pairs, "k", "m", "total", size + 1)) == []


def test_csv_files_bind_by_name_and_hold_one_row_per_key(spark, gold_rows, tmp_path):
    built = graph.snapshot(gold_rows([{"mcc": "1\n2"}, {"merchant": "m2", "card": "c2"}]), "g")
    graph_files.write_graph(built, str(tmp_path))
    merchants = built.nodes["merchants"]
    merchants.unionAll(merchants).select("mcc", "merchant_id", "country").write.mode("overwrite").options(
        header=True, escape='"').csv(f"{tmp_path}/merchants")
    extra = spark.createDataFrame([("c1", "nowhere"), ("c1", "d1")], "card_id string, device_id string")
    extra.write.mode("append").option("header", True).csv(f"{tmp_path}/rel_card_device")
    loaded = graph_files.read_graph(spark, str(tmp_path))
    assert sorted(rows(loaded.nodes["merchants"])) == sorted(rows(merchants.select("merchant_id", "country", "mcc")))
    assert sorted(rows(loaded.edges["used_on"])) == [("c1", "d1"), ("c2", "d1")]


def test_csv_snapshot_files(spark, gold_rows, tmp_path):
    tricky = 'high_amount, "quoted", x'
    built = graph.snapshot(gold_rows([{"alert": True, "reasons": tricky, "score": 12, "amount": 1.25}, {"payment": "p9", "card": "c2"}]), "g")
    graph_files.write_graph(built, str(tmp_path))
    header = spark.read.text(f"{tmp_path}/payments").head()[0]
    assert header == ",".join(graph_files.NODE_COLUMNS["payments"])
    loaded = graph_files.read_graph(spark, str(tmp_path))
    for label in graph.NODE_KEYS:
        assert sorted(rows(loaded.nodes[label])) == sorted(rows(built.nodes[label].select(*loaded.nodes[label].columns)))
    for name in loaded.edges:
        assert sorted(rows(loaded.edges[name])) == sorted(rows(built.edges[name]))
