from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from snapmart.quality import profiles as P

FIRST = date(2024, 1, 1)
ROWS = "day date, country long, item string, value double"


def loads(spark, counts):
    """Rows for {(day number, country): count}."""
    data = [
        (FIRST + timedelta(d), c, f"k{i}", float(i)) for (d, c), n in counts.items() for i in range(n)
    ]
    return P.profile(spark.createDataFrame(data, ROWS), ["country"], ["day"], "item", "value")


def statuses(df):
    return {r.country: r.status for r in df.collect()}


def test_a_drop_in_one_country_is_found_and_a_month_end_is_not(spark, path):
    """Month ends have ten times the rows; the last one lacks most rows of country 2."""
    ends = [d for d in range(182) if (FIRST + timedelta(d + 1)).day == 1]
    counts = {}
    for d in range(0, ends[-1] + 1):
        if d in ends or d % 9 == 0:
            for c in (1, 2, 3):
                counts[d, c] = (80 if d in ends else 8) + (d * c) % 3
    counts[ends[-1], 2] = 30
    whole = loads(spark, counts)
    days = sorted({d for d, _ in counts})
    for part in (days[:8], days[8:]):  # appended in two loads
        kept = [FIRST + timedelta(d) for d in part]
        P.append_profile(whole.filter(F.col("day").isin(kept)), path + "/p")
    stored = P.read_profiles(spark, path + "/p")
    season = P.month_end(F.col("day"), 1)
    assert statuses(P.count_anomalies(stored, ["country"], "day", season)) == {1: "PASS", 2: "LOW", 3: "PASS"}
    # Without the season the month end looks like a flood, except where rows are missing.
    assert statuses(P.count_anomalies(stored, ["country"], "day"))[1] == "HIGH"


def test_missing_and_new_partitions(spark):
    counts = {(d, 1): 10 for d in range(6)} | {(d, 2): 10 for d in range(5)} | {(5, 3): 10, (0, 4): 7}
    found = P.count_anomalies(loads(spark, counts), ["country"], "day")
    assert statuses(found) == {1: "PASS", 2: "LOW", 3: "NEW", 4: "PASS"}
    by = {r.country: r for r in found.collect()}
    assert by[2].n_rows == 0 and by[2].median_rows == 10
    assert by[4].n_loads == 5 and by[4].median_rows == 0  # seen once, then always 0
    earlier = P.count_anomalies(loads(spark, counts), ["country"], "day", newest=FIRST + timedelta(4))
    assert statuses(earlier) == {1: "PASS", 2: "PASS", 4: "PASS"}


def test_limits_do_not_follow_one_odd_load(spark):
    counts = {(d, 1): 100 + d for d in range(9)} | {(3, 1): 5000, (9, 1): 60}
    assert statuses(P.count_anomalies(loads(spark, counts), ["country"], "day")) == {1: "LOW"}


def test_sketches_merge_over_loads(spark):
    data = [(FIRST + timedelta(d), 1, f"k{i}", float(i)) for d in range(5) for i in range(2000)]
    data += [(FIRST + timedelta(5), 1, f"k{i}", 1e6 + i) for i in range(500)]
    data += [(FIRST + timedelta(5), 2, None, None), (FIRST, 3, "a", 1.0)]
    made = P.profile(spark.createDataFrame(data, ROWS), ["country"], ["day"], "item", "value")
    found = {r.country: r for r in P.value_shifts(made, ["country"], "day").collect()}
    assert found[1].status == "SHIFTED"
    assert found[1].known_keys == pytest.approx(2000, rel=0.05)
    assert found[1].n_keys == pytest.approx(500, rel=0.05)
    assert found[1].low_value == pytest.approx(100, abs=60)
    assert found[1].high_value == pytest.approx(1900, abs=60)
    assert (found[2].status, found[2].n_keys, found[2].median_value) == ("NEW", 0, None)
    assert found[3].status == "GONE"


def test_no_loads(spark, path):
    assert P.read_profiles(spark, path + "/none") is None
    empty = loads(spark, {(0, 1): 1}).limit(0)
    assert P.count_anomalies(empty, ["country"], "day").count() == 0
    assert P.value_shifts(empty, ["country"], "day").count() == 0
