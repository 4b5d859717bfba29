"""Readers and sinks on real files."""

import os

import pytest

from tests.conftest import rows_of
from tillroll.sources import exports, reports, sinks


def _write(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_numbered_lines_across_splits(spark, tmp_dir):
    # Force many small file splits so that several tasks read each file.
    a = [f"a line {i:04d} " + "x" * (i % 37) for i in range(700)]
    b = [f"b line {i:04d}" for i in range(333)]
    _write(os.path.join(tmp_dir, "a.txt"), a)
    _write(os.path.join(tmp_dir, "b.txt"), b)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = reports.read_numbered_lines(spark, tmp_dir)
        assert df.rdd.getNumPartitions() > 1
        got = {}
        for r in df.collect():
            got.setdefault(os.path.basename(r.file), {})[r.line_no] = r.line
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got["a.txt"] == dict(enumerate(a))
    assert got["b.txt"] == dict(enumerate(b))


def test_body_lines_trims_each_file(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "r1.csv"), ["h"] + [f"r1-{i}" for i in range(4)] + ["f"] * 6)
    _write(os.path.join(tmp_dir, "r2.csv"), ["h"] + ["r2-0"] + ["f"] * 6)
    body = reports.body_lines(reports.read_numbered_lines(spark, tmp_dir), 1, 6)
    assert sorted(r.line for r in body.collect()) == ["r1-0", "r1-1", "r1-2", "r1-3", "r2-0"]


def test_order_export_file(spark, tmp_dir):
    header = "Name,Email,Financial Status,Paid at,Fulfillment Status" + ",c" * 16
    row1 = ("#1001,a@x.com,paid,\"12, Main\",unfulfilled" + "," * 11
            + "2015-03-01 10:15:00 -0500,2,Blue Mug,7.50,,MUG-1,extra,cols")
    row2 = "#1002,b@x.com,paid,,fulfilled" + "," * 11 + "2015-03-02 23:00:00 -0500,1,\"Red, Cup\",3.25,,CUP-2"
    junk = "not an order,1,2"
    path = os.path.join(tmp_dir, "orders_export.csv")
    _write(path, [header, row1, row2, junk])
    got = rows_of(exports.read_order_export(spark, path))
    assert [r[0] for r in got] == ["#1001", "#1002"]
    r = {x[0]: x for x in got}
    assert r["#1002"][5] == "Red, Cup" and float(r["#1002"][6]) == 3.25
    assert r["#1001"][2] == "unfulfilled" and r["#1001"][4] == 2


def test_customers_segments_scores(spark, tmp_dir):
    cpath = os.path.join(tmp_dir, "customers.csv")
    _write(cpath, ["First,Last,Email,Co,Addr,City,Prov,a,b,c,d,e,Attr",
                   "Ann,Lee,a@x,Co,1 Road,Town,ST,,,,,,vip"])
    det = exports.customer_details(exports.read_customers_export(spark, cpath)).collect()[0]
    assert (det.email, det.name, det.location, det.attr12) == ("a@x", "Ann Lee", "1 Road Town ST", "vip")
    spath = os.path.join(tmp_dir, "segments.csv")
    _write(spath, ["email,segment", "a@x,gold"])
    assert rows_of(exports.read_segments(spark, spath)) == [("a@x", "gold")]
    sc_dir = os.path.join(tmp_dir, "scores")
    os.makedirs(sc_dir)
    _write(os.path.join(sc_dir, "cust_score.csv"), ["email,s1,s2,s3", "a@x,1,2,3", "b@x,9"])
    got = {r.email: r.scores for r in exports.read_scores(spark, sc_dir).collect()}
    assert got == {"a@x": ["1", "2", "3"], "b@x": ["9"]}


def test_sink_parquet_and_csv(spark, tmp_dir):
    df = spark.createDataFrame([("a", ["1", "2"], 1.5)], "email string, scores array<string>, v double")
    sinks.write_view(df, os.path.join(tmp_dir, "p"))
    assert spark.read.parquet(os.path.join(tmp_dir, "p")).collect()[0].scores == ["1", "2"]
    sinks.write_view(df, os.path.join(tmp_dir, "c"), fmt="csv")
    back = spark.read.option("header", "true").csv(os.path.join(tmp_dir, "c")).collect()[0]
    assert (back.email, back.scores, back.v) == ("a", "1|2", "1.5")


def test_order_export_many_files(spark, tmp_dir):
    header = "Name,Email,Financial Status,Paid at,Fulfillment Status" + ",c" * 16
    for f in range(3):
        rows = [header]
        for o in range(5):
            rows.append(f"#{f}{o},u{o}@x,paid,,fulfilled" + "," * 11
                        + f"2015-0{f + 1}-0{o + 1} 09:00:00 -0500,{o + 1},P{o},1.00,,S{o}")
        rows.append("")  # blank trailing line
        _write(os.path.join(tmp_dir, f"export_{f}.csv"), rows)
    got = exports.read_order_export(spark, tmp_dir).collect()
    assert len(got) == 15
    assert sorted({r.order_id[:2] for r in got}) == ["#0", "#1", "#2"]
    assert sum(r.qty for r in got) == 3 * 15


def test_csv_sink_round_trip(spark, tmp_dir):
    rows = [(1, 'say "hi", ok'), (2, "a,b"), (3, '"'), (4, "plain é")]
    sinks.write_view(spark.createDataFrame(rows, "i int, t string"), os.path.join(tmp_dir, "q"), fmt="csv")
    back = spark.read.csv(os.path.join(tmp_dir, "q"), header=True, schema="i int, t string", escape='"')
    assert sorted(tuple(r) for r in back.collect()) == rows


def test_values_that_do_not_fit_stop_the_query(spark):
    from tests.conftest import line, order_lines
    good = [line("#1", qty="2.0"), line("#2", qty="1.5", price="1.005"), line("#3", price="12345678901.00")]
    kept = {r.order_id: (float(r.qty), str(r.price)) for r in order_lines(spark, good).collect()}
    assert kept == {"#1": (2.0, "1.000"), "#2": (1.5, "1.005"), "#3": (1.0, "12345678901.000")}
    for bad in (line("#1", qty="x"), line("#1", qty="0.1234"), line("#1", price="1.0005"), line("#1", price="1234567890123.00")):
        with pytest.raises(Exception, match="cannot be kept exactly"):
            order_lines(spark, [bad]).collect()


def test_positional_reports_of_two_files_stop_the_query(spark):
    from tillroll.plans.reports import daily_sales_summary
    from tests.conftest import report_df
    two = report_df(spark, ["a"], "x").union(report_df(spark, ["a"], "y"))
    with pytest.raises(Exception, match="must be one file"):
        daily_sales_summary(two).collect()


def test_checkpoint_dir_without_the_setting():
    from tillroll.session import checkpoint_dir

    class Unset:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.master": "local[2]"}.get(key, default))

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.master": "spark://host:7077"}.get(key, default))
    assert os.path.isdir(checkpoint_dir(Unset, allow_local_default=True))
    with pytest.raises(RuntimeError):
        checkpoint_dir(Unset)
    with pytest.raises(RuntimeError):  # a folder of one machine is no use to a cluster
        checkpoint_dir(Cluster, allow_local_default=True)
