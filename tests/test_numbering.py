"""Global row numbering across many partitions."""

from tillroll.operators.numbering import number_rows


def test_number_rows_is_consecutive_in_order(spark):
    df = spark.range(0, 5000, numPartitions=7).selectExpr("id", "(id * 7919) % 5000 AS k")
    out = number_rows(df, ["k"], "n", start=1, count_col="total").collect()
    assert {r.total for r in out} == {5000}
    got = sorted((r.n, r.k) for r in out)
    assert [n for n, _ in got] == list(range(1, 5001))
    assert [k for _, k in got] == sorted(r.k for r in out)


def test_numbers_hold_with_more_columns_than_the_order(spark):
    # more rows than the range sampler looks at: two sorts would differ in their bounds
    df = spark.range(0, 200_000, numPartitions=9).selectExpr("id", "hash(id) AS k", "cast(id AS string) AS s", "id % 7 AS z")
    out = number_rows(df, ["k", "id"], "n", count_col="t")
    bad = out.selectExpr("count(*) AS rows", "count(DISTINCT n) AS different", "min(n) AS least", "max(n) AS most", "max(t) AS total").first()
    assert tuple(bad) == (200_000, 200_000, 0, 199_999, 200_000)
    by_number = [r.id for r in out.orderBy("n").select("id").collect()]
    assert by_number == [r.id for r in df.orderBy("k", "id").select("id").collect()]


def test_numbering_an_empty_table(spark):
    assert number_rows(spark.range(0).selectExpr("id AS k"), ["k"]).count() == 0
