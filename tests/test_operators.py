import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from quotelake import operators as op
from tests.conftest import one, rows


def brute_percent_rank(values):
    """PERCENT_RANK with NULL above everything and NaN just below."""

    def key(v):
        return (2, 0) if v is None else (1, 0) if math.isnan(v) else (0, v)

    n = len(values)
    return [0.0 if n == 1 else sum(key(o) < key(v) for o in values) / (n - 1) for v in values]


def test_peer_percentile_against_brute_force(spark):
    random.seed(3)
    data = []
    for i in range(600):
        group = "hot" if i % 3 else random.choice(["a", None, "b"])
        # A third of the rows share one value; the rest spans many magnitudes.
        x = 0.0 if i % 3 == 1 else random.choice([1, -1]) * 10 ** random.uniform(-6, 9)
        x = None if i % 17 == 0 else x
        x = float("nan") if i % 101 == 0 else x
        x = random.choice([float("inf"), -float("inf")]) if i % 97 == 0 else x
        data.append((i, group, x, float(i % 7)))
    df = spark.createDataFrame(data, "id int, g string, x double, y double")
    got = {r["id"]: r for r in rows(op.peer_percentile(df, {"px": "x", "py": "y"}, ["g"], ["id"], digits=9))}
    for group in {d[1] for d in data}:
        members = [d for d in data if d[1] == group]
        for column, out in ((2, "px"), (3, "py")):
            for d, expected in zip(members, brute_percent_rank([m[column] for m in members])):
                assert got[d[0]][out] == pytest.approx(expected, abs=1e-9)
    assert len(got) == len(data)


def test_peer_percentile_ignoring_nulls(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 7.0), (4, None)], "id int, x double").withColumn("g", F.lit(1))
    got = {r["id"]: r["p"] for r in rows(op.peer_percentile(df, {"p": "x"}, ["g"], ["id"], null_metric="ignore"))}
    assert got == {1: 0.0, 2: None, 3: 1.0, 4: None}
    last = {r["id"]: r["p"] for r in rows(op.peer_percentile(df, {"p": "x"}, ["g"], ["id"]))}
    assert last == {1: 0.0, 2: 0.6667, 3: 0.3333, 4: 0.6667}


@pytest.mark.parametrize("small", [True, False])
def test_zscore(spark, small):
    data = [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 9.0), ("c", 4.0), ("c", 4.0), (None, 1.0), (None, 3.0)]
    df = spark.createDataFrame(data, "g string, x double")
    got = {(r["g"], r["x"]): r["z"] for r in rows(op.zscore(df, {"z": "x"}, ["g"], small_groups=small))}
    assert got[("a", 1.0)] == -1.0 and got[("a", 2.0)] == 0.0 and got[("a", 3.0)] == 1.0
    assert got[("b", 9.0)] is None  # one row
    assert got[("c", 4.0)] is None  # no deviation
    assert got[(None, 1.0)] == -0.71


def test_cube_total_is_sum_of_leaves(spark):
    data = [("k", "a", "x", 1, 2.0), ("k", "b", "x", 2, 3.0), ("k", None, "y", 3, None), ("k", "a", "y", 0, 1.0)]
    df = spark.createDataFrame(data, "k string, a string, b string, w long, v double")
    cubed = op.cube_agg(
        df,
        ["k"],
        ["a", "b"],
        [op.count_rows("n"), op.total("w", F.col("w"))],
        [op.WeightedAverage("avg", F.col("v"), F.col("w"), "w", 4)],
        grouping_col="gid",
    )
    got = {(r["gid"], r["a"], r["b"]): r for r in rows(cubed)}
    assert got[(3, None, None)]["n"] == 4 and got[(3, None, None)]["w"] == 6
    leaves = [r for (gid, _, _), r in got.items() if gid == 0]
    assert sum(r["n"] for r in leaves) == 4
    # The NULL value leaves the numerator, not the denominator.
    assert got[(3, None, None)]["avg"] == round((1 * 2 + 2 * 3) / 6, 4)
    assert got[(0, "a", "y")]["avg"] is None  # weight 0
    # A NULL leaf and a subtotal are different rows.
    assert got[(1, None, None)]["w"] == 3 and got[(2, None, "y")]["w"] == 3


def test_first_record_orders_nulls_last(spark):
    data = [
        ("s", 1, None, "i", "n1"),
        ("s", 1, "sec", None, "n2"),
        ("s", 1, "sec", "ind", "n3"),
        ("s", 1, "sec", "ind", "n4"),
        ("s", 2, "aaa", "aaa", "zz"),
        ("t", 3, None, None, None),
    ]
    df = spark.createDataFrame(data, "symbol string, priority int, sector string, industry string, name string")
    got = {r["symbol"]: r for r in rows(op.first_record(df, "symbol", ["priority", "sector", "industry"], "name", "top"))}
    assert (got["s"]["sector"], got["s"]["industry"], got["s"]["name"], got["s"]["top"]) == ("sec", "ind", "n4", "zz")
    assert got["t"]["name"] is None


def test_attribute_pivot_does_not_shift(spark):
    df = spark.createDataFrame([("A", "x", "1"), ("A", "y", "2"), ("B", "y", "3")], "s string, a string, v string")
    got = {r["s"]: r for r in rows(op.attribute_pivot(df, "s", "a", "v", ["x", "y"]))}
    assert got["B"]["x"] is None and got["B"]["y"] == "3"


def test_conform_and_stack(spark):
    df = spark.createDataFrame([("1", "2")], ["Old", "extra"])
    assert op.conform(df, rename={"Old": "new", "absent": "z"}).columns == ["new", "extra"]
    fitted = one(op.conform(df, ["new", "more"], {"Old": "new"}, missing=""))
    assert fitted == {"new": "1", "more": ""}
    assert op.conform(df, ["extra", "more"], keep_available_only=True).columns == ["extra"]
    stacked = op.stack_frames([df, df.select("Old")])
    assert [r["extra"] for r in rows(stacked, "extra")] == ["2", None]


def test_full_outer_merge(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "k string, l int")
    right = spark.createDataFrame([("b", 3), ("c", 4)], "k string, r int")
    got = {r["k"]: (r["l"], r["r"]) for r in rows(op.full_outer_merge(left, right, "k"))}
    assert got == {"a": (1, None), "b": (2, 3), "c": (None, 4)}


def test_value_neighbours_across_a_year_end(spark):
    days = [dt.date(2024, 12, 30), dt.date(2025, 1, 2), dt.date(2025, 1, 3)]
    df = spark.createDataFrame([("k", d, i) for i, d in enumerate(days)], "k string, d date, v int")
    got = rows(op.value_neighbours(df, ["k"], ["d"], "v"), "d")
    assert [(r["prev"], r["next"], r["last"]) for r in got] == [(None, 1, 2), (0, 2, 2), (1, None, 2)]


def test_share_of_partition(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("b", "x", 0)], "k string, f string, v int")
    out = op.share_of_partition(df, ["k"], {"s": (F.col("f") == "x", F.col("v"))})
    assert {(r["k"], r["f"]): r["s"] for r in rows(out)} == {("a", "x"): 0.25, ("a", "y"): 0.25, ("b", "x"): 0.0}


def test_dense_rank_of_distinct(spark):
    df = spark.createDataFrame([("a", 5), ("a", 5), ("a", 2), ("a", None)], "k string, v int")
    got = rows(op.dense_rank_of_distinct(df, ["k"], "v", "r"))
    assert sorted((str(r["v"]), r["r"]) for r in got) == [("2", 1), ("5", 2), ("5", 2), ("None", 3)]


def test_latest(spark):
    df = spark.createDataFrame([("20250101", 1), ("20250103", 2), ("20250103", 3)], "d string, v int")
    assert sorted(r["v"] for r in rows(op.latest_snapshot(df, "d"))) == [2, 3]
    assert [r["f"] for r in rows(op.latest_flag(df, "d", "f"), "v")] == ["N", "Y", "Y"]


def test_date_windows(spark):
    data = [(1, "2023-03-06", "2025-03-05"), (2, "2025-01-01", "2025-03-11"), (3, "2025-01-01", "2025-03-12")]
    df = spark.createDataFrame(data, "id int, start string, end string")
    got = rows(op.date_windows(df, keep=["id"]), "id", "window_start")
    first = [r for r in got if r["id"] == 1]
    sizes = [(r["window_end"] - r["window_start"]).days + 1 for r in first]
    assert len(first) == 11 and set(sizes) == {66, 67} and sizes == sorted(sizes, reverse=True)
    assert first[0]["window_start"] == dt.date(2023, 3, 6) and first[-1]["window_end"] == dt.date(2025, 3, 5)
    for a, b in zip(first, first[1:]):
        assert b["window_start"] - a["window_end"] == dt.timedelta(days=1)
    assert [len([r for r in got if r["id"] == i]) for i in (2, 3)] == [1, 2]


def test_whole_calendar(spark):
    dim = op.date_dimension(op.day_series(spark))
    assert dim.count() == 29220 and len(dim.columns) == 29
    assert dim.agg(F.max("actualdate")).first()[0] == dt.date(2089, 12, 31)
    day = one(dim.where("actualdate = DATE '2021-01-01'"))
    assert (day["week_of_year"], day["year_actual"], day["week_of_year_iso"]) == (53, 2020, "2020-W53-5")
    assert day["daysuffix"] == "1st" and day["quarter_name"] == "First" and not day["weekend_indr"]
    python = op.date_dimension(op.day_series(spark, "2024-02-28", 3))
    for r in rows(python):
        d = r["actualdate"]
        assert r["day_of_week"] == d.isoweekday() and r["day_of_year"] == d.timetuple().tm_yday
        assert r["week_of_year"] == d.isocalendar()[1] and r["week_of_month"] == (d.day - 1) // 7 + 1


def test_cube_count_distinct(spark):
    data = [(g, a, b, n) for g in ("x", "y") for a in ("p", None) for b in ("q", "r") for n in (1, 1, 7, 40_000, -5, 90_001)]
    data += [("x", "p", "q", None), ("z", "p", None, None), ("x", "p", "r", 2**40), ("y", None, "q", 8)]
    df = spark.createDataFrame(data, "g string, a string, b string, n bigint")
    got = op.cube_count_distinct(df, ["g"], ["a", "b"], "n", "distinct_n")
    df.createOrReplaceTempView("distinct_rows")
    plain = spark.sql(
        "SELECT g, a, b, count(DISTINCT n) AS distinct_n, count(*) AS rows_seen FROM distinct_rows GROUP BY g, CUBE(a, b)"
    )
    order = ["g", "a", "b", "distinct_n", "rows_seen"]
    assert rows(got, *order) == rows(plain, *order)
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    assert op.cube_count_distinct(df.limit(0), ["g"], ["a", "b"], "n", "distinct_n").count() == 0
