"""The quote-aware field split agrees with Python's csv module."""

import csv
import io
import random

from tillroll.functions.text import csv_fields, naive_fields


def _random_rows(n, seed=7):
    rnd = random.Random(seed)
    alphabet = ['a', 'b', 'Z', '0', '9', ' ', ',', '"', '-', '.', '#', '@']
    rows = []
    for _ in range(n):
        width = rnd.randint(1, 12)
        rows.append(["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 8)))
                     for _ in range(width)])
    return rows


def test_csv_fields_matches_python_csv(spark):
    rows = _random_rows(400)
    lines = []
    for r in rows:
        buf = io.StringIO()
        csv.writer(buf, lineterminator="").writerow(r)
        lines.append(buf.getvalue())
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, line string")
    got = {r.i: r.f for r in df.select("i", csv_fields("line").alias("f")).collect()}
    for i, line in enumerate(lines):
        expect = next(csv.reader(io.StringIO(line)))
        assert got[i] == expect, (line, got[i], expect)


def test_naive_split_is_plain_split(spark):
    lines = ['a,"b,c",d', ",,", "x"]
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    got = [r[0] for r in df.select(naive_fields("line")).collect()]
    assert got == [line.split(",") for line in lines]


def test_long_quoted_field_needs_no_deep_stack(spark):
    long = "x" * 1_000_000
    rows = [(f'a,"{long}",b',), ('a,"' + '""' * 100_000 + '",b',)]
    got = spark.createDataFrame(rows, "line string").select(csv_fields("line").alias("f")).collect()
    assert [len(r.f) for r in got] == [3, 3]
    assert got[0].f[1] == long and got[1].f[1] == '"' * 100_000
