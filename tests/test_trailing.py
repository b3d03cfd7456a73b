from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from paysignal.operators.trailing import Trailing, trailing_features

SPECS = [
    Trailing("n", "count", "pid", 300),
    Trailing("merchants", "distinct", "merchant", 600),
    Trailing("countries", "distinct", "country", 3600),
    Trailing("ratio", "mean", "declined", 3600),
]
SCHEMA = "card string, sec long, pid string, merchant string, country string, declined int"


def naive(rows):
    """Quadratic model: look at every other row of the card."""
    out = {}
    for card, sec, *_ in rows:
        def near(span):
            return [r for r in rows if r[0] == card and sec - span <= r[1] <= sec]

        hour = near(3600)
        out[(card, sec)] = (
            sum(r[2] is not None for r in near(300)),
            len({r[3] for r in near(600) if r[3] is not None}),
            len({r[4] for r in hour if r[4] is not None}),
            sum(r[5] for r in hour) / len(hour),
        )
    return out


def computed(spark, rows, bucket):
    found = trailing_features(spark.createDataFrame(rows, SCHEMA), "card", "sec", SPECS, bucket).collect()
    result = {(r.card, r.sec): (r.n, r.merchants, r.countries, r.ratio) for r in found}
    assert len(result) == len(found), "one row per key and second"
    return result


ROW = st.tuples(
    st.sampled_from(["a", "b", None]),
    st.integers(1_704_067_200, 1_704_067_200 + 9000),
    st.sampled_from(["p", "q", None]),
    st.sampled_from(["m1", "m2", "m3", "m4", None]),
    st.sampled_from(["ES", "PT", "FR", None]),
    st.integers(0, 1),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(ROW, min_size=1, max_size=50), bucket=st.sampled_from([600, 3600, 21600]))
def test_equals_the_quadratic_model(spark, rows, bucket):
    assert computed(spark, rows, bucket) == naive(rows)


@pytest.mark.parametrize("bucket", [100, 500, 21600])
def test_one_busy_card(spark, bucket):
    """A third of all rows on one card, many of them in the same second."""
    rnd = random.Random(7)
    rows = []
    for i in range(900):
        card = "hot" if i % 3 == 0 else f"card-{rnd.randrange(40)}"
        rows.append((card, 1_704_067_200 + rnd.randrange(0, 4000) // 10 * 10, f"p{i}", f"m{rnd.randrange(30)}",
                     rnd.choice(["ES", "PT", "FR"]), rnd.randrange(2)))
    assert computed(spark, rows, bucket) == naive(rows)


def test_bounds_are_inclusive(spark):
    t = 1_704_067_200
    rows = [("a", t, "p1", "m1", "ES", 0), ("a", t + 300, "p2", "m1", "ES", 1), ("b", t, "p3", "m1", "ES", 0),
            ("b", t + 301, "p4", "m2", "ES", 0)]
    found = computed(spark, rows, 21600)
    assert found[("a", t + 300)] == (2, 1, 1, 0.5)
    assert found[("b", t + 301)][0] == 1
    assert found[("b", t + 301)][1] == 2


def test_peers_in_one_second_count_each_other(spark):
    t = 1_704_067_200
    rows = [("a", t, "p1", "m1", "ES", 0), ("a", t, "p2", "m2", "PT", 1)]
    assert computed(spark, rows, 21600) == {("a", t): (2, 2, 2, 0.5)}


def test_seconds_before_1970(spark):
    rows = [("a", -10, "p1", "m1", "ES", 0), ("a", 5, "p2", "m2", "ES", 0)]
    assert computed(spark, rows, 600) == naive(rows)


def test_means_of_fractions_and_of_nothing(spark):
    rows = spark.createDataFrame(
        [("c", 0, 0.5, None), ("c", 10, 0.9, None), ("c", 20, float("nan"), None), ("d", 0, None, None)],
        "card string, second long, part double, none int",
    )
    specs = [Trailing("part_mean", "mean", "part", 60), Trailing("none_mean", "mean", "none", 60)]
    found = {(r.card, r.second): r for r in trailing_features(rows, "card", "second", specs).collect()}
    assert [round(found["c", s].part_mean, 9) for s in (0, 10, 20)] == [0.5, 0.7, 0.7]
    assert found["d", 0].part_mean is None and all(r.none_mean is None for r in found.values())
    with pytest.raises(ValueError, match="median"):
        Trailing("x", "median", "part", 60)
