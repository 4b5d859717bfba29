"""Bit sets, next dates, array baskets, published views and rejected export lines on hand-made rows."""

import datetime as dt
import itertools
import os

import pytest

from tests.conftest import F, line, order_lines
from tillroll import plans
from tillroll.operators import bitsets
from tillroll.operators.cooccurrence import basket_sets, set_pairs
from tillroll.operators.gaps import next_dates
from tillroll.sources import exports, sinks


def test_packed_sets_count_distinct_numbers(spark):
    numbers = [("a", n) for n in (-130, -64, -1, 0, 63, 64, 64, 6400)] + [("b", 5)] * 3
    got = bitsets.packed(spark.createDataFrame(numbers, "k string, n long"), ["k"], "n")
    assert {(r.k, r.word) for r in got.collect()} == {("a", -3), ("a", -1), ("a", 0), ("a", 1), ("a", 100), ("b", 0)}
    counts = got.groupBy("k").agg(F.sum(F.bit_count("bits")).alias("n"))
    assert {tuple(r) for r in counts.collect()} == {("a", 7), ("b", 1)}


def test_habit_bits_count_each_weekday_and_slot_once(spark):
    rows = [(d, s) for d in range(1, 8) for s in (0, 10, 22, None) if (d, s) != (3, 10)]
    df = spark.createDataFrame(rows + rows[:5], "weekday int, slot int")
    words = df.select(*bitsets.habit_words(F.col("weekday"), F.col("slot"))).agg(*[F.bit_or(c).alias(c) for c in bitsets.HABIT_COLUMNS])
    got = words.agg(*bitsets.habit_counts()).first().asDict()
    assert [got[d] for d in ("sunday", "monday", "tuesday", "saturday")] == [4, 4, 3, 4]
    assert {k: v for k, v in got.items() if k.startswith("h") and v} == {"h00": 7, "h10": 6, "h22": 7}


def test_profile_counts_an_order_on_several_days_once(spark):
    lines = order_lines(spark, [line("#1", created="2015-01-01"), line("#1", created="2015-01-08"), line("#1", created="2016-05-05"), line("#2", created="2015-01-02")])
    r = plans.customers.customer_rollup(lines).first()
    assert (r.n_orders, r.n_dates, str(r.first_date), str(r.last_date), r.thursday, r.friday, r.units) == (2, 4, "2015-01-01", "2016-05-05", 1, 1, 4_000_000)


def test_next_dates_follow_each_other(spark):
    days = {"a": ["1969-12-30", "1970-01-01", "2015-02-28", "2015-03-01", "2015-03-01", "9999-12-31"], "b": ["2015-01-01"], "": ["2015-01-05", "2015-01-04"]}
    rows = [(k, dt.date.fromisoformat(d)) for k, ds in days.items() for d in ds] + [("a", None), ("c", None)]
    got = {(r.k, str(r.d)): (r.next_date and str(r.next_date), r.days) for r in next_dates(spark.createDataFrame(rows, "k string, d date"), "k", "d").collect()}
    expect = {}
    for k, ds in days.items():
        ds = sorted(set(ds))
        for x, y in zip(ds, [*ds[1:], None]):
            expect[k, x] = (y, (dt.date.fromisoformat(y) - dt.date.fromisoformat(x)).days if y else 0)
    assert got == expect


def test_a_hot_customer_crosses_the_shuffle_as_words(spark):
    hot = spark.range(30_000).selectExpr("if(id % 3 = 0, 'hot', concat('c', id % 4000)) AS email", "date_add(date'2000-01-01', cast(id % 3000 as int)) AS d")
    out = next_dates(hot.repartition(4), "email", "d")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan and "Window" not in plan
    words = bitsets.packed(hot.select("email", bitsets.day_number(F.col("d")).alias("day")), ["email"], "day").where("email = 'hot'")
    assert words.count() <= 3000 // 64 + 2
    rows = out.where("email = 'hot'").collect()
    assert len(rows) == 1000 and {r.days for r in rows} == {3, 0}


def test_array_baskets_are_bounded_and_lose_no_pair(spark):
    rows = [("hot", f"p{i:03d}") for i in range(120)] + [("b", "p001"), ("b", "p050"), ("b", "p050"), ("c", "p001"), (None, "p001"), ("c", None)]
    df = spark.createDataFrame(rows, "o string, p string")
    for block in (1, 7, 40, 500):
        sets = basket_sets(df, ["o"], "p", block)
        assert sets.selectExpr("max(size(items))").first()[0] <= block
        got = [tuple(r) for r in set_pairs(sets, ["o"], ["o"], "x", "y").collect()]
        expect = {("hot", x, y) for x, y in itertools.combinations([f"p{i:03d}" for i in range(120)], 2)} | {("b", "p001", "p050")}
        assert len(got) == len(expect) and set(got) == expect


def test_shared_orders_of_given_pairs(spark):
    lines = order_lines(spark, [line(f"#{i}", p) for i in range(300) for p in ("A", "B", "C") if i % {"A": 2, "B": 3, "C": 299}[p] == 0] + [line("#0", "A")])
    wanted = spark.createDataFrame([("A", "B"), ("B", "A"), ("A", "C"), ("A", "none"), ("A", "B")], "product_1 string, product_2 string")
    assert sorted(map(tuple, plans.shared_orders(lines, wanted).collect())) == [("A", "B", 50), ("A", "C", 1), ("A", "none", 0), ("B", "A", 50)]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_view_is_published_whole_or_not_at_all(spark, tmp_dir, fmt, monkeypatch):
    rows = [("a,b", 1, 0.1, ["x", "y"]), ('say "hi"', 2, None, []), (None, 3, 1e300, ["z"]), ("", 4, -0.5, None), ("two\nlines ", 5, 2.0, [" w"])]
    df = spark.createDataFrame(rows, "name string, n long, v double, tags array<string>").repartition(3).orderBy(F.desc("n"))
    path = f"{tmp_dir}/view"
    assert sinks.publish_view(df, path, fmt) == 5 and os.listdir(tmp_dir) == ["view"]
    if fmt == "csv":
        back = spark.read.csv(path, header=True, escape='"', multiLine=True, schema="name string, n long, v double, tags string")
        assert sorted(map(tuple, back.select("name", "n", "v").collect()), key=lambda r: r[1]) == [(r[0] or None, *r[1:3]) for r in rows]
        assert {r.n: r.tags for r in back.collect()} == {1: "x|y", 2: None, 3: "z", 4: None, 5: " w"}
        cells = "".join(open(f"{path}/{f}").read() for f in os.listdir(path) if f.endswith(".csv"))
        assert '\n"",4,' in cells and "\n,3," in cells  # an empty text is quoted, a null is not
    else:
        back = spark.read.parquet(path)
        assert sorted(map(tuple, back.collect()), key=lambda r: r[1]) == rows
        files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
        assert [r.n for f in files for r in spark.read.parquet(f"{path}/{f}").collect()] == [5, 4, 3, 2, 1]
    with pytest.raises(FileExistsError):
        sinks.publish_view(df, path, fmt)
    # a writer that loses rows: nothing gets the final name
    whole = sinks.write_view
    monkeypatch.setattr(sinks, "write_view", lambda d, p, f: (whole(d, p + "-x", f), whole(spark.read.format("parquet").load(p + "-x").where("n > 1") if f == "parquet"
                                                              else spark.read.csv(p + "-x", header=True, escape='"', multiLine=True).where("n > 1"), p, f)))
    with pytest.raises(RuntimeError, match="nothing was published"):
        sinks.publish_view(df, f"{tmp_dir}/other", fmt)
    assert not os.path.exists(f"{tmp_dir}/other")
    monkeypatch.setattr(sinks, "write_view", whole)
    assert sinks.publish_view(df.limit(0), f"{tmp_dir}/none", fmt) == 0


def test_bad_export_lines_are_put_aside(spark):
    def text(order, created, qty, price):
        return f'{order},a@x,,,"ful, filled",' + "," * 10 + f'{created},{qty},"P, 1",{price},,S'

    lines = ["Name,Email", text("#1", "2015-01-01 10:00:00 -0500", "2", "1.50"), text("#2", "2015-01-01 10:00:00 -0500", "two", "1.50"),
             text("#3", "2015-01-01 10:00:00 -0500", "2", "1.50001"), text("#4", "yesterday", "2", "1.50"), text("#5", "", "", ""),
             text("#6", "2015-01-01 10:00:00 -0500", "12345678901", "x"), "note #7", "#8", None]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    kept, rejects = exports.split_order_export(df)
    assert sorted((r.order_id, str(r.qty), str(r.price), str(r.order_date)) for r in kept.collect()) == [
        ("#1", "2.000", "1.500", "2015-01-01"), ("#5", "None", "None", "None"), ("#8", "None", "None", "None")]
    assert sorted((r.line, r.reason) for r in rejects.collect()) == [(lines[2], "qty"), (lines[3], "price"), (lines[4], "created_at"), (lines[6], "qty")]
    good = df.where("value like '#1,%' or value like '#5,%'")
    assert sorted(map(str, exports.split_order_export(good)[0].collect())) == sorted(map(str, exports.parse_order_export(good).collect()))
    assert exports.split_order_export(good)[1].count() == 0
