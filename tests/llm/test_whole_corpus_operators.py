"""Exact duplicates, importance resampling and the manifest against plain Python, on fixtures and on awkward
tables, and their registered queries on the smallest tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks.compare import digest, duck
from tests.llm.test_operators import SF, awkward, docs_df
from tillroll.llm import exactdedup, merkle, queries, resampling
from tillroll.llm.common import written
from tillroll.llm.ranking import numbered


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("name", ["op11_exact_dedup", "op12_resampling", "op13_manifest"])
def test_registered_query_equals_its_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    cur = duck(SF).execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(columns, cur.fetchall())


def test_places_in_groups(spark):
    rows = written(spark.range(5000).selectExpr("cast(id % 3 = 0 as string) AS grp", "(id * 7919) % 1000 AS v", "id"), "ranked")
    got = numbered(rows.repartition(7), ["grp"], ["v"], "ranked").collect()
    for grp in ("true", "false"):
        mine = sorted((r.idx, r.v) for r in got if r.grp == grp)
        assert [i for i, _ in mine] == list(range(len(mine))) and all(r.n == len(mine) for r in got if r.grp == grp)
        assert [v for _, v in mine] == sorted(v for _, v in mine)


# 11 exact dedup

def expected_duplicates(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[lowered(text)].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        keep = max(ids, key=lambda i: (i is not None, i or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        kept = Counter([keep])
        for i in ids:
            out[i, keep, len(ids), kept[i] > 0, sha] += 1
            kept[i] -= kept[i] > 0
    return out


@pytest.mark.parametrize("hash_bits", [64, 3, 0])
def test_exact_duplicates_against_grouping(spark, hash_bits):
    rng = np.random.default_rng(4)
    stock = ["".join(rng.choice(list("abAB é"), int(n))) for n in rng.integers(0, 70, 40)]
    texts = [*stock, *[str(t) for t in rng.choice(stock, 200)], *[stock[0]] * 150, None, "", "A" * 64, "a" * 64, "a" * 63, "a" * 65, "É", "é",
             stock[5] + stock[6], stock[6] + stock[5], stock[5][:16] * 5, stock[5][:16] * 6]
    docs = docs_df(spark, texts)
    docs = docs.union(docs.where("doc_id < 20")).union(docs.where("doc_id in (3, 4)").withColumn("doc_id", F.lit(None).cast("long"))).repartition(5)
    got = exactdedup.exact_duplicates(docs, block_bytes=16, hash_bits=hash_bits)
    assert Counter(tuple(r) for r in got.collect()) == expected_duplicates([(r.doc_id, r.text) for r in docs.collect()])


def test_exact_duplicates_awkward(spark):
    docs = awkward(spark)
    got = Counter(tuple(r) for r in exactdedup.exact_duplicates(docs).collect())
    assert got == expected_duplicates([(r.doc_id, r.text) for r in docs.collect()])
    assert exactdedup.exact_duplicates(docs.limit(0)).count() == 0


def test_exact_duplicates_stay_in_the_jvm(spark):
    plan = exactdedup.exact_duplicates(awkward(spark))._jdf.queryExecution().toString()
    assert not re.search(r"Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


def test_hot_names_are_broadcast_and_bounded(spark):
    keys = written(spark.range(50_000).selectExpr("if(id % 3 = 0, -1, id) AS k"), "keys")
    table = exactdedup.named(keys, ["k"], "key-names")
    assert table.where(f"n * {exactdedup.HEAVY} > 50000").count() == 1
    got = exactdedup.looked_up(keys, table, ["k"], ["name"])
    assert got.count() == 50_000 and got.select("k", "name").distinct().count() == table.count() == table.select("name").distinct().count()


# 12 resampling

def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    return words, [f"{a} {b}" for a, b in zip(words, words[1:])]


def test_array_hashes_equal_crc32():
    rng = np.random.default_rng(5)
    texts = [None, "", "Hello, World-2 foo", "é" * 100 + " x " + "y" * 300 + " z " + "q" * 64 + " " + "w" * 65, "--", "one",
             " ".join("abcdeféß"[: rng.integers(1, 9)] for _ in range(2000))]
    d1, one, d2, two = resampling.feature_hashes(pa.array(["cut off"] + texts)[1:])
    expect = [features(t) for t in texts]
    assert list(zip(d1.tolist(), one.tolist())) == [(i, zlib.crc32(w.encode())) for i, (ws, _) in enumerate(expect) for w in ws]
    assert list(zip(d2.tolist(), two.tolist())) == [(i, zlib.crc32(p.encode())) for i, (_, ps) in enumerate(expect) for p in ps]


def expected_draw(docs, target, percent, min_words, buckets, seed):
    count = lambda ts: Counter(zlib.crc32(f.encode()) % buckets for t in ts for fs in features(t) for f in fs)
    s, t = count([x for _, x in docs]), count(target)
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets)))) for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        words, pairs = features(text)
        all_ = [gain[zlib.crc32(f.encode()) % buckets] for f in words + pairs]
        weight = sum(all_) // len(all_) if all_ else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(words), len(all_), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = able[: percent * len(able) // 100]
    return rows, [(r[0], r[4]) for r in drawn]


def test_resampling_against_plain_python(spark):
    rng = np.random.default_rng(6)
    texts = [" ".join(rng.choice(["Alpha", "beta", "gamma", "délta", "x9"], int(n))) for n in rng.integers(0, 60, 300)] + [None, ""]
    docs = docs_df(spark, texts).repartition(4)
    docs = docs.union(docs.where("doc_id = 7")).union(docs.where("doc_id in (8, 9)").withColumn("doc_id", F.lit(None).cast("long")))
    target = ["beta beta gamma", None, "BETA délta"]
    got = resampling.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent=30, min_words=10, buckets=500).collect()
    rows, drawn = expected_draw([(r.doc_id, r.text) for r in docs.collect()], target, 30, 10, 500, 7)
    assert Counter(tuple(r)[:5] for r in got) == Counter(rows)
    assert [(r.doc_id, r.score) for r in sorted((r for r in got if r.rank), key=lambda r: r.rank)] == drawn
    assert sorted(r.rank for r in got if r.rank) == list(range(1, len(drawn) + 1))


def test_cutoff_is_exact_in_many_rounds(spark):
    rng = np.random.default_rng(7)
    keys = [(int(a), int(b), c) for c, (a, b) in enumerate(zip(rng.integers(-3, 4, 4000), rng.integers(0, 9, 4000)))]
    table = written(spark.createDataFrame(keys, "a long, b long, c long").repartition(6), "cutoff")
    for k in (1, 2, 1000, 2017, 3999, 4000):
        assert resampling.cutoff(table, k, chunk=90, finish=20) == sorted(keys)[k - 1]
    assert resampling.cutoff(table, 0) is None and resampling.cutoff(table, 4001) is None


def test_resampling_awkward(spark):
    docs, empty = awkward(spark), spark.createDataFrame([], "text string")
    got = resampling.resample(docs, empty, min_words=4, percent=50).collect()
    assert len(got) == 11 and sum(r.rank is not None for r in got) == 2  # 5 rows have four words or more
    assert resampling.resample(docs.limit(0), empty).count() == 0


# 13 manifest

def H(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(level, fanout):
    """(root, [siblings on the left and right from the leaf up] of each leaf)"""
    proofs, place = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for leaf, at in enumerate(place):
            run = at // fanout * fanout
            proofs[leaf].append(("".join(level[run:at]), "".join(level[at + 1: run + fanout])))
            place[leaf] = at // fanout
        level = [H(*level[i: i + fanout]) for i in range(0, len(level), fanout)]
    return level[0], proofs


def expected_manifest(rows, fanout):
    groups = defaultdict(list)
    for group, order, leaf, name in rows:
        groups[group].append((order is not None, order or 0, leaf, name))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g])], fanout) for g in names}
    root, upper = tree([trees[g][0] for g in names], fanout)
    return Counter((x[3], x[2], trees[g][0], root, tuple(p + up)) for g, up in zip(names, upper) for x, p in zip(sorted(groups[g]), trees[g][1]))


@pytest.mark.parametrize("fanout", [2, 3, 5, 20])
def test_manifest_against_plain_python(spark, fanout):
    sizes = {None: 1, "": 2, "de": 3, "en": 137, "é": 17, "fr": 16, "zz": 1}
    rows = [(g, (k * 31) % n if n < 100 or k else None, H(f"{g}{k}"), f"{g}-{k}") for g, n in sizes.items() for k in range(n)]
    leaves = written(spark.createDataFrame(rows, "lang string, at long, leaf string, name string").repartition(6), "leaves")
    out = merkle.proofs(leaves, "lang", "at", "leaf", ["name"], fanout)
    got = out.withColumn("folded", merkle.folded(F.col("leaf"))).withColumn("s", merkle.siblings()).collect()
    assert Counter((r.name, r.leaf, r.subroot, r.root, tuple(tuple(s) for s in r.proof)) for r in got) == expected_manifest(rows, fanout)
    assert all(r.folded == r.root and r.s == "".join(a + b for a, b in r.proof) for r in got)
    changed = out.withColumn("folded", merkle.folded(F.sha2("leaf", 256)))
    assert changed.where("folded = root").count() == 0


def test_manifest_awkward(spark):
    docs = awkward(spark).withColumn("lang", F.when(F.col("doc_id") != 3, F.col("lang")))
    leaf = merkle.leaf_hash([F.col("doc_id"), F.col("lang"), F.col("text")])
    leaves = written(docs.select("doc_id", "lang", leaf.alias("leaf")), "leaves")
    got = merkle.proofs(leaves, "lang", "doc_id", "leaf", ["doc_id"]).withColumn("folded", merkle.folded(F.col("leaf"))).collect()
    plain = [(r.lang, r.doc_id, H(field(r.doc_id), field(r.lang), field(r.text)), r.doc_id) for r in docs.collect()]
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, tuple(tuple(s) for s in r.proof)) for r in got) == expected_manifest(plain, 2)
    assert len(got) == 11 and all(r.folded == r.root for r in got)
    assert merkle.proofs(leaves.limit(0), "lang", "doc_id", "leaf", ["doc_id"]).count() == 0
    one = written(leaves.where("doc_id = 0"), "leaves")  # a lone leaf is the root
    assert [(r.leaf == r.subroot == r.root, r.proof) for r in merkle.proofs(one, "lang", "doc_id", "leaf", ["doc_id"]).collect()] == [(True, [])]
