"""Each operator against brute force, a round trip or held-out accuracy, and on awkward tables:
nulls, empty and very long texts, ties, repeated rows, empty tables, clashing extra columns."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tillroll.llm import ann, bpe, chat, decontam, langid, licenses, lm, quality, queries, simhash, urls
from tillroll.llm.common import components, held_out

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, keep string, block long"


def docs_df(spark, texts, langs=None):
    """Documents with extra columns whose names the operators use themselves."""
    langs = langs or ["en"] * len(texts)
    return spark.createDataFrame([(i, t, g, "s", None, 1.0, "x", 7) for i, (t, g) in enumerate(zip(texts, langs))], DOCS)


def awkward(spark):
    texts = [None, "", "  \n\t ", "word", "same text here now", "same text here now", "é " * 40_000, "x" * 200_000, "the end <|endoftext|> of it"]
    rows = docs_df(spark, texts)
    return rows.union(rows.where("doc_id = 4")).union(rows.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long")))


def words_en(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "house", "water", "green", "running", "with", "this", "that"]) + ("s" if rng.random() < .2 else "")
                    for _ in range(n))


@pytest.fixture(scope="module")
def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# 1 quality

def test_cumulative_link_probabilities_and_fit():
    p = quality.grade_probabilities(np.array([-3.0, 0.0, 9.0]), np.array([-1.0, 2.0]))
    assert np.allclose(p.sum(1), 1) and (p >= 0).all() and np.allclose(p[1, 0], 1 / (1 + math.e))
    rng = np.random.default_rng(0)
    grade = rng.integers(0, 3, 600)
    row = np.repeat(np.arange(600), 2)
    bucket = np.stack((grade, np.full(600, 50)), 1).ravel()
    model = quality.fit(row, bucket, grade, 3)
    assert (np.diff(model["theta"]) > 0).all()
    weight = np.zeros(quality.BUCKETS)
    weight[model["bucket"]] = model["weight"]
    got = quality.grade_probabilities(np.bincount(row, weight[bucket]), model["theta"]).argmax(1)
    assert (got == grade).mean() > 0.99


def test_quality_separates_held_out_documents(spark):
    rng = np.random.default_rng(1)
    texts, grades = [], []
    for i in range(600):
        t = words_en(rng, 40)
        grades.append(i % 3)
        texts.append(t.upper().replace(" ", "!! ") if i % 3 == 0 else t + " idiot scum" if i % 3 == 1 else t)
    docs = docs_df(spark, texts)
    ratings = spark.createDataFrame([(i, g) for i, g in enumerate(grades) if i < 400], "doc_id long, grade int")
    got = {r.doc_id: r for r in quality.grade(docs, quality.train(docs, ratings, 3)).collect()}
    assert np.mean([got[i].keep == (grades[i] == 2) for i in range(400, 600)]) > 0.97
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.tail_probability <= 1 for r in got.values())
    kept = quality.selected(docs, quality.train(docs, ratings, 3))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.keep}


def test_quality_awkward(spark):
    model = quality.train(awkward(spark), spark.createDataFrame([], "doc_id long, grade int"), 3)
    assert quality.grade(awkward(spark), model).count() == 11
    assert quality.grade(awkward(spark).limit(0), model).count() == 0


def test_registered_quality_equals_one_text_at_a_time(spark, sf_docs):
    labels = quality.graded(spark.read.parquet(f"{SF}/labels.parquet"))
    model = quality.train(sf_docs, labels, 3)
    weight = dict(zip(model["bucket"].tolist(), model["weight"].tolist()))
    got = {r.doc_id: r for r in queries.op1_quality(spark, SF).collect()}
    assert len(got) == sf_docs.count()
    for r in sf_docs.collect():
        _, buckets = quality.features(pa.array([r.text], pa.string()))
        score = sum(weight.get(b, 0.0) for b in buckets.tolist())
        below = [0.0, *[1 / (1 + math.exp(score - t)) for t in model["theta"]], 1.0]
        p = [b - a for a, b in zip(below, below[1:])]
        assert got[r.doc_id].expected_grade == pytest.approx(p[1] + 2 * p[2], abs=1e-4) and got[r.doc_id].tail_probability == pytest.approx(p[2], abs=1e-4)


def test_the_fit_takes_one_row_of_each_rated_id(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda row, bucket, grade, *a, **k: seen.append(grade.tolist()))
    docs = spark.range(300).selectExpr("id % 3 AS doc_id", "concat('word', id % 2) AS text")
    quality.train(docs, spark.createDataFrame([(0, 0), (1, 1), (2, 0), (2, 1), (None, 1), (9, 0)], "doc_id long, grade int"), 3, fit_rows=6)
    assert [sorted(s) for s in seen] == [[0, 0, 1]]


def test_the_fit_takes_8000_documents_of_a_grade(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda row, bucket, grade, *a, **k: seen.append(np.bincount(grade)))
    docs = spark.range(18_000).selectExpr("id AS doc_id", "concat('word', id % 3) AS text")
    quality.train(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 AS int) AS grade"), 3)
    assert seen[0].tolist() == [8000, 8000]


# 2 decontamination

def test_wand_finds_all_items_above_the_threshold():
    rng = np.random.default_rng(2)
    vocab = [f"w{i}" for i in range(60)]
    items = [((i,), [str(w) for w in rng.choice(vocab, 12)], []) for i in range(50)]
    index = decontam.Index(items, block=4)
    names = {i: t for t, i in index.terms.items()}
    for _ in range(40):
        text = [str(w) for w in rng.choice(vocab, 40)]
        rows = np.array([index.terms.get(w, -1) + 1 for w in text])
        got = index.search(rows, np.zeros(len(rows), np.int64), 40, 0.6)
        expect = {}
        for item in range(len(index.items)):
            score = sum(v for t, (at, value) in enumerate(index.postings) for a, v in zip(at, value) if a == item and names[t] in set(text))
            if score >= 0.6:
                expect[item] = score
        assert {k[1] for k in got} == set(expect)
        assert all(abs(got[(0, i)][0] - s) < 1e-4 for i, s in expect.items())


def test_decontamination_planted(spark):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    items = [" ".join(word() for _ in range(n)) for n in (3, 20, 35, 90)]
    clean = [" ".join(word() for _ in range(400)) for _ in range(6)]
    dirty = [f"{clean[0]} {items[3].upper()}, {clean[1]}", items[0] + ".", clean[2].replace(" ", f" {items[1]} ", 1), "\n".join(items[2].split())]
    half = " ".join(items[3].split()[:30])  # a third of a question is no leak
    docs = docs_df(spark, [*clean, *dirty, clean[4] + " " + half])
    bench = spark.createDataFrame([*enumerate(items), (9, items[1]), (10, None), (11, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()}
    assert got == {(6, 3), (7, 0), (8, 1), (8, 9), (9, 2)}
    assert got == {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench, max_items=2).collect()}
    kept = decontam.clean(docs, bench, max_items=3)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {0, 1, 2, 3, 4, 5, 10}
    assert decontam.contaminated(awkward(spark), bench.limit(0)).count() == 0
    # a very long item has its own index and windows; the short ones keep theirs
    long = " ".join(word() for _ in range(30_000))
    more = bench.union(spark.createDataFrame([(20, long)], "item_id long, text string"))
    shards = list(decontam._items(more, 4000, 128))
    assert [len(s) for s in shards] == [3, 1, 1] and shards[-1][0][0] == (20,)
    texts = docs.union(docs_df(spark, [f"{clean[0]} {long} {clean[1]}"]).withColumn("doc_id", F.lit(50).cast("long")))
    assert {(r.doc_id, r.item_id) for r in decontam.contaminated(texts, more).collect()} == got | {(50, 20)}
    assert decontam.clean(awkward(spark), bench).count() == 11


def test_answers_are_looked_for_where_search_found_the_item(spark):
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("klmnopqrst"), 5))
    fill = [" ".join(word() for _ in range(n)) for n in (700, 50, 900)]
    asked, answer = " ".join(word() for _ in range(18)), " ".join(word() for _ in range(7))
    bench = spark.createDataFrame([(0, None, answer), (1, asked, answer), (2, asked, None), (3, None, None), (4, "", " ")],
                                  "item_id long, question string, answer string")
    parts = [(f"{fill[0]} {answer}", {0}), (f"{asked} {answer} {fill[0]}", {0, 1, 2}), (f"{fill[2]} {asked} {fill[1]}", {2}),
             (f"{fill[0]} {asked} {asked} {asked} {fill[1]} {asked} {answer}", {0, 1, 2}), (f"{asked} {fill[2]} {answer}", {0, 2}), (fill[0], set())]
    docs = docs_df(spark, [t for t, _ in parts])
    got = defaultdict(set)
    for r in decontam.contaminated(docs, bench).collect():
        got[r.doc_id].add(r.item_id)
    assert [got[i] for i in range(len(parts))] == [want for _, want in parts]


def test_one_lower_casing_for_texts_and_items(spark):
    items = ["ΟΔΟΣ ΚΑΙ ΝΟΜΟΣ ΤΗΣ ΠΟΛΗΣ ΜΑΣ", "οδός και λόγος της νέας πόλης", "İSTANBUL'DA BİR İYİ GÜN İÇİN KÜÇÜK BİR ŞİİR", "GROẞE STRAẞE UND GROẞER PLATZ"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = docs_df(spark, [*items, *[f"x {decontam.lowered(pa.array([t]))[0].as_py()}".replace("'", "").replace(",", "") for t in items],
                           items[0].lower(), items[1].upper().replace("Ό", "ό"), "nothing of the kind here at all"])
    got = {(r.doc_id, r.item_id): r.score for r in decontam.contaminated(docs, bench).collect()}
    assert all(got[i, i] == pytest.approx(1) for i in range(4)) and got[8, 0] == pytest.approx(1) and (9, 1) not in got or got[9, 1] > 0.6
    assert not any(d == 10 for d, _ in got)


def brute_matches(docs, bench, window=128, threshold=0.6, least=0.5):
    """(doc, item) by scoring every half-overlapping passage against every item with plain sums."""
    items = [((i,), *(lambda w: (w[: len(w) - len(w) // 5], w[len(w) - len(w) // 5:]))(decontam.tokens(t))) for i, t in bench if t]
    index = decontam.Index([x for x in items if x[1]])
    width = max(window, 2 * index.longest)
    impact = [{} for _ in index.items]
    for term, i in index.terms.items():
        for item, value in zip(*index.postings[i]):
            impact[item][term] = value
    out = set()
    for doc, text in docs:
        words = decontam.tokens(text)
        shingles = {n: {tuple(words[i: i + n]) for i in range(len(words) - n + 1)} for n in range(1, decontam.SHINGLE + 1)}
        for k, (ids, question, answer) in enumerate(index.items):
            n = min(decontam.SHINGLE, len(question))
            want = {tuple(question[i: i + n]) for i in range(len(question) - n + 1)}
            if len(want & shingles[n]) < least * len(want):
                continue
            for lo in range(0, max(1, len(words) - width // 2), width // 2):
                passage = words[lo: lo + width]
                span = 2 * (len(question) + len(answer))
                if sum(v for t, v in impact[k].items() if t in set(passage)) >= threshold and (not answer or max(
                        sum((Counter(answer) & Counter(passage[i: i + span])).values()) for i in range(max(1, len(passage) - span + 1))) >= least * len(answer)):
                    out |= {(doc, i) for i in ids}
    return out


def test_registered_decontamination_equals_brute_force(spark, sf_docs):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in queries.op2_decontamination(spark, SF).collect()}
    assert got and got == brute_matches([(r.doc_id, r.text) for r in sf_docs.collect()], bench)


# 3 URLs

RULES = queries.URL_RULES


def brute_host_path(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def test_rules_and_parts(spark):
    cases = ["http://a.example.net/en/1?x", "https://EXAMPLE.net/fr/2", "http://example.com/de/", "http://example.com/de", "http://xexample.com/de/1",
             "http://b.org/fr/9#t", "nothing", None, "", "http://net", "x://y://net/a", "ftp://É.net/?q/en/", "http://a.net\n/b"]
    pages = spark.createDataFrame([(i, u, "z") for i, u in enumerate(cases)] + [(3, cases[3], "z")], "page_id long, url string, host string")
    rows = urls.judge(pages, RULES).collect()
    assert len(rows) == len(cases) + 1
    for r in rows:
        host, path = brute_host_path(cases[r.page_id])
        fits = [(len(h + p), h + p, a) for a, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r.host, r.path, r.rule) == (host, path, max(fits)[1] if fits else None)
        assert r.verdict == max(fits)[2] if fits else r.verdict in ("allow", "block")


def test_trees_learn_lexical_features():
    rng = np.random.default_rng(4)
    x = rng.random((2000, 4))
    y = ((x[:, 1] > 0.6) ^ (x[:, 2] < 0.3)).astype(float)
    model = urls.Trees().fit(x[:1500], y[:1500])
    assert ((model.blocked(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95
    assert urls.Trees().fit(x[:0], y[:0]).blocked(x[:2]).max() < 0.5
    assert urls.lexical("http://ab-1.c/d/e?x=1&y#z?w=2", "ab-1.c", "/d/e")[3:6] == (2, 2, 3 / 29)


def test_a_url_does_not_see_labels_of_its_own_fold(spark):
    rng = np.random.default_rng(3)
    rows = [(i, f"h{rng.integers(9)}.{rng.choice(['a', 'b'])}.{rng.choice(['x', 'y'])}", float(rng.integers(2)) if i % 3 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "page_id long, host string, label double")
    got = urls.with_statistics(df.unionByName(df.where("page_id < 20"))).collect()
    folds = {r.host: r.f for r in df.select("host", urls.fold(F.col("host")).alias("f")).collect()}
    rows += rows[:20]
    assert len(got) == len(rows)
    for r in got:
        for n, value in ((1, r.suffix_blocked), (2, r.domain_blocked)):
            seen = [y for _, h, y in rows if y is not None and h.split(".")[-n:] == r.host.split(".")[-n:]
                    and (r.label is None or folds[h] != folds[r.host])]
            assert value == pytest.approx((sum(seen) + 2.5) / (len(seen) + 5))


def test_registered_url_filter_equals_one_url_at_a_time(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: r for r in queries.op3_url_filter(spark, SF).collect()}
    assert set(got) == {r.page_id for r in pages} and len(got) == len(pages)
    for r in pages:
        host, path = brute_host_path(r.url)
        fits = [(len(h + p), h + p, a) for a, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        mine = got[r.page_id]
        assert (mine.host, mine.path, mine.rule) == (host, path, max(fits)[1] if fits else None)
        assert mine.verdict == (max(fits)[2] if fits else "block" if mine.blocked >= 0.5 else "allow")


def test_long_urls_and_held_out_hosts(spark):
    rows = [(i, f"http://h{i % 40}.{'net' if i % 2 else 'org'}/{'fr' if i % 4 else 'x'}/{i}") for i in range(400)] + [(999, "http://h1.net/" + "ab/9?" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    assert {r.page_id: r.verdict for r in urls.judge(pages, RULES).collect()}[999] == "block"
    out = [urls.held_out(pages, RULES, hidden_fold=f).collect() for f in range(urls.FOLDS)]
    assert sum(r.n for rows in out for r in rows) == urls.judge(pages, RULES).where("rule is not null").count()
    assert all(r.right <= r.n and r.blocked in (0, r.n) for rows in out for r in rows)


def test_urls_empty(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string"), RULES).count() == 0


# 4 SimHash

def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits=3):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in itertools.combinations(ids, 2):
        if (fps[a] ^ fps[b]).bit_count() <= bits:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: find(i) for i in ids}


def test_simhash_equals_brute_force(spark, sf_docs):
    fps = {r.doc_id: brute_fingerprint(r.text) for r in sf_docs.collect()}
    expect = brute_components(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op4_simhash(spark, SF).collect()}
    assert got == {i: (f"{fps[i]:016x}", expect[i]) for i in fps}


@pytest.mark.parametrize("bits,block", [(0, 8), (2, 1024), (3, 4), (5, 16)])
def test_links_keep_every_component(spark, bits, block):
    rng = np.random.default_rng(5)
    fps = {}
    for i in range(300):  # chains and balls around a few centres
        base = int(rng.integers(0, 2 ** 63)) if i < 12 else fps[int(rng.integers(0, i))]
        for b in rng.choice(64, int(rng.integers(0, 5)), replace=False):
            base ^= 1 << int(b)
        fps[i] = base
    first = {}
    for i, f in fps.items():
        first.setdefault(f, i)
    points = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for f, i in first.items()], "fp long, node long")
    got = {r.node: r.component for r in components(simhash.links(points, bits, block)).collect()}
    expect = brute_components({i: f for f, i in first.items()}, bits)
    assert {i: got.get(i, i) for i in expect} == expect


def test_simhash_awkward(spark):
    near = simhash.near_duplicates(awkward(spark))
    rows = near.collect()
    assert len(rows) == 11
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[0].fingerprint == "0" * 16 and {by[i].component_id for i in (0, 1, 2)} == {0}
    assert by[5].component_id == 4 and by[6].fingerprint == f"{brute_fingerprint('é ' * 40_000):016x}"
    kept = simhash.one_of_each(awkward(spark))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 4, 6, 7, 8] and kept.columns == awkward(spark).columns
    assert simhash.near_duplicates(awkward(spark).limit(0)).count() == 0
    named = awkward(spark).withColumn("gone_id", F.lit("x")).withColumn("Gone_ID_", F.lit(1)).withColumn("fp", F.lit(2))
    named = named.withColumn("row", F.lit(3)).withColumn("Row_", F.lit("y"))
    kept = simhash.one_of_each(named)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 4, 6, 7, 8] and kept.columns == named.columns
    assert simhash.one_of_each(named.limit(0)).count() == 0


def test_one_row_of_each_component_stays(spark):
    a, b = "the quick brown fox jumps over it", "quite another text with words of its own"
    docs = spark.createDataFrame([(1, a), (2, a), (1, a), (2, b), (None, a), (None, a), (None, "a third one, alone")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in simhash.one_of_each(docs.repartition(3)).collect()), key=str)
    assert got == [(1, a), (2, b), (None, "a third one, alone")]


# 5 neighbours

def test_neighbours_recall_and_exactness(spark):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(1500, 16)).round(2)
    v[700:760] = v[5]  # a very common vector
    rows = [(i, x.tolist(), 0) for i, x in enumerate(v)]
    bad = [(5000, None, 0), (5100, [0.0] * 16, 0), (5200, [1.0, None] * 8, 0), (5300, [float("nan")] * 16, 0), (5400, [1.0] * 3, 0), (None, [1.0] * 16, 0)]
    df = spark.createDataFrame([*rows, *bad, rows[300]], "id long, embedding array<double>, key int").withColumnRenamed("id", "vec_id")
    got = defaultdict(list)
    for r in ann.nearest(df, F.col("id") % 100 == 0, k=10, block=50).collect():
        got[r.query_id].append((r["rank"], r.id, r.score))
    assert set(got) == set(range(0, 1500, 100))
    hits = []
    for q, near in got.items():
        d = np.sqrt(((v - v[q]) ** 2).sum(1))
        order = [i for i in np.lexsort((np.arange(len(v)), d)) if i != q][:10]
        near.sort()
        assert [r for r, _, _ in near] == list(range(1, 11)) and all(s == d[i] for _, i, s in near)
        assert [(s, i) for _, i, s in near] == sorted((s, i) for _, i, s in near)
        hits.append(len(set(order) & {i for _, i, _ in near}) / 10)
    assert np.mean(hits) >= 0.9
    assert [i for _, i, _ in got[700]] == [5, *range(701, 710)]


def test_probes_come_in_order_of_cost():
    x = np.array([0.1, 0.45, 0.8])
    sets = ann.perturbations(x, 27)
    cost = [sum((x[i] if d < 0 else 1 - x[i]) ** 2 for i, d in s) for s in sets]
    assert sets[0] == [] and cost == sorted(cost) and len({tuple(sorted(s)) for s in sets}) == 27


def test_codes_bound_the_distances_of_their_vectors():
    rng = np.random.default_rng(12)
    for dim, size in ((1, 1.0), (64, 1e-200), (64, 1.0), (64, 1e150), (64, 1e300), (1500, 3.0)):
        v = rng.normal(size=(60, dim)) * size
        v[0], v[1], v[2] = v[3], v[3] * 1000 if size < 1e300 else v[3], v[3] / 1e9
        v[10:20] = v[3] + v[10:20] / 1e3  # a cluster around an anchor
        anchors = np.stack([v[3] * 0, v[3], v[4]])
        codes = ann.Codes(ann.coded(v, anchors), anchors)
        least, most = codes.bounds(codes)
        with np.errstate(over="ignore"):
            exact = np.sqrt(((v[:, None] - v) ** 2).sum(2))
        assert (least <= exact).all() and (exact <= most).all() and not np.isnan(least).any()
        if size == 1.0 and dim == 64:
            assert np.median(most - least) < 0.02 * np.median(exact)
            assert np.median((most - least)[10:20, 10:20]) < 0.02 * np.median(exact[10:20, 10:20])


def test_only_surely_beaten_pairs_are_dropped():
    rng = np.random.default_rng(13)
    qid, pid = rng.integers(0, 6, 400), rng.integers(0, 90, 400)
    least = (qid * 31 + pid * 17) % 23 / 4.0  # a pair has the same bounds wherever it is found
    most = least + 0.5 + (pid % 3) / 4
    for k in (1, 5, 80):
        got = {(q, p) for q, p, _, _ in zip(*ann.unbeaten(qid, pid, least, most, k))}
        want = set()
        for q in set(qid):
            own = {(m, p): lo for q2, p, lo, m in zip(qid, pid, least, most) if q2 == q}
            limit = sorted(m for m, _ in own)[k] if len(own) > k else np.inf
            want |= {(q, p) for (_, p), lo in own.items() if lo <= limit}
        assert got == want
    assert all(len(c) == 0 for c in ann.unbeaten(qid[:0], pid[:0], least[:0], most[:0], 3))


def test_neighbours_small_tables(spark):
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.id) for r in ann.nearest(two, F.col("id") == 0).collect()] == [(0, 1)]
    assert ann.nearest(two.limit(0), F.col("id") == 0).count() == 0
    wide = spark.createDataFrame([(0, [1e300, 0.0]), (1, [-1e300, 1.0]), (2, [1e300, 1e290])], "vec_id long, embedding array<double>")
    assert [r.id for r in ann.nearest(wide, F.col("id") == 0).orderBy("rank").collect()] == [1, 2]  # both distances overflow: ties
    single = spark.createDataFrame([(0, [0.1, 0.2]), (1, [0.3, 0.4])], "vec_id long, embedding array<float>")
    f = np.array([0.1, 0.2, 0.3, 0.4], np.float32).astype(float)
    assert ann.nearest(single, F.col("id") == 0).first().score == np.sqrt(((f[:2] - f[2:]) ** 2).sum())


def test_neighbours_of_mixed_norms_and_isolated_queries(spark):
    rng = np.random.default_rng(8)
    data = rng.normal(size=(2000, 16))
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    data[::100] *= rng.choice([2.0, 3.0, 5.0], 20)[:, None]
    data[500] *= 1000  # meets no other vector in any bucket
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in ann.nearest(df, F.col("id") % 100 == 0, k=10, block=300).collect():
        got[r.query_id].append(r.id)
    hits = []
    for q in range(0, 2000, 100):
        order = np.argsort(np.linalg.norm(data - data[q], axis=1))
        assert len(got[q]) == 10
        hits.append(len(set(got[q]) & set(order[order != q][:10].tolist())))
    assert np.mean(hits) >= 9 and set(got[500]) == set(np.argsort(np.linalg.norm(data - data[500], axis=1))[1:11].tolist())


# 6 language

def brute_phrases(piece_texts, text):
    sample, at, n = [langid.symbols(t) for t in piece_texts], 0, 0
    held = ["".join(map(chr, p)) for p in sample]
    text = "".join(map(chr, langid.symbols(text)))
    for lo in range(0, len(text), langid.BLOCK):
        block, at = text[lo:lo + langid.BLOCK], 0
        while at < len(block):
            size = 1
            while at + size < len(block) and any(block[at:at + size + 1] in h for h in held):
                size += 1
            at, n = at + size, n + 1
    return n


def test_phrases_equal_brute_force():
    rng = np.random.default_rng(7)
    pieces = [words_en(rng, 30), words_en(rng, 25), "Ünïcode straße"]
    nxt = langid.suffix_automaton([langid.symbols(p) for p in pieces])
    edges = [(s, c, t) for s, out in enumerate(nxt) for c, t in out.items()]
    model = dict(zip(("state", "symbol", "next"), map(list, zip(*edges))), lang="en", n_symbols=400, n_states=len(nxt))
    texts = [words_en(rng, n) for n in (1, 7, 60, 700)] + ["ÜNÏCODE zzz 漢字 house", "!!", "a"]
    got = langid.Parser([model]).phrases([langid.symbols(t) for t in texts])[:, 0].tolist()
    assert got == [brute_phrases(pieces, t) for t in texts]


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.op6_language(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97 and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_language_awkward(spark):
    model = langid.learn(docs_df(spark, ["the house and the water", "das Haus und das Wasser", None, ""], ["en", "de", "en", None]))
    rows = {r.doc_id: r for r in langid.identify(awkward(spark), model).collect()}
    assert rows[0].lang_pred == rows[1].lang_pred == rows[2].lang_pred == "und" and rows[0].score == 0
    assert langid.identify(awkward(spark), model).count() == 11
    nothing = langid.learn(awkward(spark).limit(0))
    assert {r.lang_pred for r in langid.identify(awkward(spark), nothing).collect()} == {"und"}
    assert langid.accepted(awkward(spark), model).columns == awkward(spark).columns


# 7 chat

EVENTS = "conv_id long, seq long, turn long, kind string, role string, text string, piece string"


def brute_fold(events):
    live = {}
    for _, turn, kind, role, text in sorted(events, key=lambda e: (e[0], e[1], e[2], e[3] or "", e[4] or "")):
        text = text or ""
        if kind == "open":
            live[turn] = [role or "", text]
        elif kind == "delta" and turn in live:
            live[turn][1] += text
        elif kind == "edit" and turn in live:
            live[turn][1] = text
        elif kind == "regenerate":
            live = {t: m for t, m in live.items() if t < turn}
    return [(t, *m) for t, m in sorted(live.items())]


def test_fold_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = []
    for conv in range(30):
        for seq in range(int(rng.integers(1, 40))):
            kind = str(rng.choice(["open", "delta", "delta", "delta", "edit", "regenerate"], p=[.3, .2, .2, .1, .1, .1]))
            rows.append((conv, seq, int(rng.integers(0, 4)), kind, [None, "user", "assistant"][rng.integers(0, 3)], [None, "a", "b<|c", ""][rng.integers(0, 4)], "x"))
    df = spark.createDataFrame([*rows, (None, 1, 1, "open", "user", "x", ""), (99, None, 1, "open", "user", "x", "")], EVENTS)
    got = defaultdict(list)
    for r in chat.messages(df).collect():
        got[r.conv_id].append((r.turn, r.role, r.text))
    expect = {c: m for c in range(30) if (m := brute_fold([r[1:6] for r in rows if r[0] == c]))}
    assert {c: sorted(m) for c, m in got.items()} == expect


def test_the_log_of_the_query_regenerates_and_edits(spark):
    rows = [(1, t, ["user", "assistant"][t % 2], f"text {t} " * 40) for t in range(7)]
    log = chat.events_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), piece_chars=50)
    events = [(tuple(r.seq), r.turn, r.kind, r.role, r.text) for r in log.collect()]
    assert brute_fold(events) == [(t + 1, role, text) for _, t, role, text in rows]
    order = sorted(events)
    again = [k for k, e in enumerate(order) if e[2] == "regenerate" and any(x[1] > e[1] for x in order[:k])]
    late = [k for k, e in enumerate(order) if e[2] == "edit" and any(x[1] > e[1] + 1 for x in order[:k])]
    assert again and late  # several turns back, and under later turns
    plan = chat.messages(log)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(conv_id") <= 2 and "Join" not in plan


def test_placed_pieces_need_no_second_exchange(spark):
    rows = [(c, t, ["user", "assistant"][t % 2], f"text {c} {t} <|end|>" * (1 + c % 5)) for c in range(300) for t in range(1 + c % 9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    pieces = chat.rendered(chat.messages(chat.events_of(df)))
    placed = chat.read_back(pieces, placed=True)
    other = chat.read_back(pieces)
    assert [x._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(conv_id") for x in (placed, other)] == [1, 2]
    assert sorted(placed.collect()) == sorted(other.collect()) and placed.count() == 300


def test_chat_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", chat.END, chat.ROLE + "user\n", "<\\|x <\\\\| <", "", None, "a\\", "<" * 5 + "|", "é\U0001f600" * 500, chat.NEWLINE]
    rows = [(c, t, ["user", "assistant", "we\nird", None][(c + t) % 4], texts[(c * 3 + t) % len(texts)]) for c in range(12) for t in range(c)]
    df = spark.createDataFrame([*rows, rows[0]], "conv_id long, turn long, role string, text string")
    pieces = chat.rendered(chat.messages(chat.events_of(df, piece_chars=7)))
    got = {r.conv_id: r for r in chat.read_back(pieces).collect()}
    by = defaultdict(list)
    for c, t, role, text in [*rows, rows[0]]:
        by[c].append((t, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        learnt = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[c].n_turns, got[c].loss_chars, got[c].loss_sha256) == (len(turns), len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    whole = {r.conv_id: r.formatted for r in chat.conversations(pieces).collect()}
    assert {c: len(t) for c, t in whole.items()} == {c: r.formatted_chars for c, r in got.items()}
    assert chat.read_back(chat.rendered(chat.messages(chat.events_of(df.limit(0))))).count() == 0


def test_chat_equals_its_sql(spark):
    from checks.compare import digest, duck
    con = duck(SF)
    got = queries.op7_chat(spark, SF)
    cur = con.execute(queries.ORACLE_SQL["op7_chat"])
    assert digest(got.columns, [tuple(r) for r in got.collect()]) == digest([c[0] for c in cur.description], cur.fetchall())
    assert [str(t) for t in con.sql(queries.ORACLE_SQL["op7_chat"]).types] == ["BIGINT", "BIGINT", "VARCHAR", "BIGINT", "VARCHAR", "BIGINT"]
    cases = ["<|x", "<\\|x", "a<\\\\|<|", "\\<|\n"]
    sql = "SELECT regexp_replace(?, '<(\\\\*)\\|', '<\\1\\\\|', 'g')"
    for r in spark.createDataFrame([(c,) for c in cases], "t string").select("t", chat.escaped(F.col("t")).alias("e")).collect():
        assert chat.unescaped(r.e) == r.t and con.execute(sql, [r.t]).fetchall()[0][0] == r.e


# 8 language model

def test_base_scores_equal_brute_force(spark, sf_docs):
    docs = {r.doc_id: re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in r.text or "")) for r in sf_docs.collect()}
    count, ends = Counter(), 0
    for i, words in docs.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            count.update(words)
            ends += 1
    n, v = sum(count.values()) + ends, len(count) + 1
    rows = queries.op8_lm_scores(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = sum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in [*(count[w] for w in docs[r.doc_id]), ends])
        assert abs(base - r.base_score) < 1e-6 and r.train_tokens == n and r.n_tokens == len(docs[r.doc_id]) + 1
        assert r.n_known == sum(count[w] > 0 for w in docs[r.doc_id]) + 1
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_model_probabilities_are_normalised():
    rng = np.random.default_rng(9)
    model = lm.train([rng.integers(0, 9, 30) for _ in range(20)], 9, np.ones(9), dim=4, epochs=1)
    ctx = np.repeat(rng.integers(0, 10, (15, lm.CONTEXT)), 9, axis=0)
    p = np.exp(lm.log_probabilities(model, ctx, np.tile(np.arange(9), 15), chunk=4)).reshape(15, 9)
    assert np.allclose(p.sum(1), 1, atol=1e-5)


def test_steps_and_scores_equal_plain_formulas(monkeypatch):
    rng = np.random.default_rng(8)
    text = rng.integers(0, 9, 400)
    whole = lm.train([text], 9, np.ones(9), dim=4, epochs=1, batch=64, noise=16)
    monkeypatch.setattr(lm, "STEP_ROWS", 7)  # rows in pieces give the same step
    pieces = lm.train([text], 9, np.ones(9), dim=4, epochs=1, batch=64, noise=16)
    assert all(np.allclose(whole[x], pieces[x], atol=1e-5) for x in lm.NAMES)
    ctx, word = lm.contexts([text], 9)
    for big in (1, 200):  # scores that need no shift, and scores that overflow without one
        model = whole | {"b": whole["b"] * np.float32(big)}
        h = sum(model["r"][ctx[:, i]].astype(float) @ model["m"][i] for i in range(lm.CONTEXT))
        logits = h @ model["q"].T + model["b"]
        logits -= logits.max(1, keepdims=True)
        want = logits[np.arange(len(word)), word] - np.log(np.exp(logits).sum(1))
        assert np.allclose(lm.log_probabilities(model, ctx, word), want, rtol=1e-4, atol=1e-3)


def test_model_learns_order():
    text = np.tile([0, 1, 2, 3], 500)
    model = lm.train([text], 5, np.bincount(text, minlength=5), dim=8, epochs=20, batch=64)
    ctx, word = lm.contexts([text[:40]], 5)
    assert lm.log_probabilities(model, ctx, word)[4:].mean() > math.log(0.6)


def test_the_fit_draws_pieces_from_anywhere_in_long_texts(spark):
    text = " ".join(f"w{i}" for i in range(60_000))
    rows = spark.createDataFrame([(text + f" t{i}",) for i in range(8)], "text string")
    place = {f"w{i}": i for i in range(60_000)}
    got = lm._sample(rows, place, 60_000, 4, 60_005, 8, 10**6)
    first = [[c for c in seq.tolist() if c < 60_000][1] for seq in got]  # a cut word may stand first
    assert len(got) == 8 and len(set(first)) == 8 and max(first) > 3_000
    assert all(len(seq) < lm.PIECE_CHARS for seq in got)


def test_the_model_learns_from_texts_outside_its_sample(spark):
    rows = docs_df(spark, [" ".join("abcde"[(i + j) % 5] for j in range(200)) for i in range(100)])
    got = lm.scores(rows, held_out("doc_id", 5, 1), fit_tokens=5).where("held_out").collect()
    assert sum(r.score for r in got) / sum(r.n_tokens for r in got) > math.log10(0.6)


def test_registered_scores_equal_one_token_at_a_time(spark, sf_docs, monkeypatch):
    caught, refine = {}, lm.refine
    monkeypatch.setattr(lm, "refine", lambda *a: caught.setdefault("model", refine(*a)))
    got = {r.doc_id: r for r in queries.op8_lm_scores(spark, SF).collect()}
    docs = {r.doc_id: [w.translate(str.maketrans(urls.UPPER, urls.LOWER)) for w in re.findall(r"[^\x20\x09-\x0D]+", r.text or "")] for r in sf_docs.collect()}
    train = [words for i, words in docs.items() if zlib.crc32(str(i).encode()) % 5 != 1]
    counts = Counter(w for words in train for w in words)
    head = sorted(counts, key=lambda w: (-counts[w], w))[:lm.HEAD]
    place = {w: i for i, w in enumerate(head)}
    mass, size = Counter(), Counter()
    for w in counts:
        if w not in place:
            mass[lm.tail_class(w)] += counts[w]
            size[lm.tail_class(w)] += 1
    m, end = caught["model"], len(head) + lm.TAILS
    assert set(got) == set(docs) and len(m["b"]) == end + 1
    for i, words in docs.items():
        if len(words) > 600:
            continue
        before, total = [end + 1] * lm.CONTEXT, 0.0
        for w in [*words, None]:
            c = end if w is None else place.get(w, len(head) + lm.tail_class(w))
            vec = sum(m["r"][before[-1 - k]].astype(float) @ m["m"][k] for k in range(lm.CONTEXT))
            odds = m["q"].astype(float) @ vec + m["b"]
            total += (odds[c] - np.log(np.exp(odds).sum())) / math.log(10)
            if w is not None and w not in place:
                t = lm.tail_class(w)
                total += math.log10((counts[w] + 0.5) / (mass[t] + 0.5 * (size[t] + 1)))
            before.append(c)
        assert got[i].score == pytest.approx(total, abs=1e-3 + 1e-5 * abs(total)) and got[i].n_tokens == len(words) + 1


def test_language_model_awkward(spark):
    rows = lm.scores(awkward(spark), held_out("doc_id", 5, 1)).collect()
    assert len(rows) == 11 and all(np.isfinite(r.score) and np.isfinite(r.base_score) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {1}
    assert lm.scores(awkward(spark).limit(0), held_out("doc_id", 5, 1)).count() == 0
    assert lm.tail_class("straße") == spark.range(1).select(F.pmod(F.xxhash64(F.lit("ße")), F.lit(lm.TAILS))).first()[0]


# 9 licences

def test_wrapped_licence_notices(spark, sf_docs):
    wrapped = {
        "BSD-3-Clause": "some words here\n * Redistribution and use in source and\n * binary forms, with or without\n * modification, are permitted\nother words",
        "GPL-3.0": "# plain\n# you may use it under the terms\n# of the GNU General Public License\n# as published by the Free Software Foundation,\n"
                   "# either version 3 of the License\n",
        "ISC": "Permission to use, copy, modify, and/or\ndistribute this software for any purpose\nwith or without fee is hereby granted",
        "MIT": "\n\n" + "\n".join("Permission is hereby granted, free of charge, to any person obtaining a copy of this software".split())}
    first = {"BSD-3-Clause": (1, 3), "GPL-3.0": (1, 4), "ISC": (0, 3), "MIT": (2, 16)}
    two = "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.\nReleased under the MIT License."
    cut = "Redistribution and use in source and\n\nbinary forms, with or without modification, are permitted"
    long = "x y " * 50_000 + "\nReleased under\nthe MIT License.\n" + "x y " * 50_000
    more = docs_df(spark, [*wrapped.values(), two, cut, long]).withColumn("doc_id", F.col("doc_id") + 10_000_000)
    more = more.unionByName(more.where("doc_id = 10000004"))
    got = licenses.scan(sf_docs.unionByName(more.select(sf_docs.columns))).where("doc_id >= 10000000 and confirmed").collect()
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id - 10_000_000].append((r.family, r.paragraph, r.n_lines))
    for i, family in enumerate(wrapped):
        assert [f for f, _, _ in by_doc[i]] == [family], (family, by_doc[i])
        assert by_doc[i][0][1] >= first[family][0] and by_doc[i][0][1] + by_doc[i][0][2] <= sum(first[family])
    lines = [("CC-BY-NC-4.0", 0, 1), ("MIT", 1, 1), ("MIT", 2, 1)]
    assert sorted(by_doc[4]) == sorted(lines + lines)  # a repeated row has findings of its own
    assert all(n == 1 for _, _, n in by_doc[5]) and by_doc[6] == [("MIT", 1, 2)]


def test_windows_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    longest, single = 5, ["k", "m"]
    texts = ["\n".join(" ".join(rng.choice(["k", "m", "a", "b"], rng.choice([0, 1, 2, 4, 9], p=[.1, .4, .2, .2, .1]))) for _ in range(12)) for _ in range(30)]
    got = sorted((r.doc_id, r.paragraph, r.n_lines, tuple(r.w)) for r in licenses.windows(
        licenses.bodies(docs_df(spark, [*texts, None, "", "\n"])), single, longest).collect())
    want = []
    for d, text in enumerate(texts):
        lw = [x.split() for x in text.split("\n")]
        held = [bool(set(x) & set(single)) for x in lw]
        for i in range(len(lw)):
            for j in range(i, len(lw)):
                if held[i] and held[j] and all(lw[i: j + 1]) and sum(map(len, lw[i + 1: j])) <= longest:
                    parts = [lw[i]] if i == j else [lw[i][-longest:], *lw[i + 1: j], lw[j][:longest]]
                    want.append((d, i, j - i + 1, tuple(w for p in parts for w in p)))
    assert got == sorted(want)


def test_licences_found_and_confirmed(spark, sf_docs):
    lines = ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.",
             "This work is licensed under the GNU General Public License, version 3."]
    plain = ["the licensed driver went home", "general version of the work"]
    more = docs_df(spark, [f"some words\n{x}\nother words" for x in lines + plain] + [None, "", "\n\n"]).withColumn("doc_id", F.col("doc_id") + 10_000_000)
    docs = sf_docs.unionByName(more.select(sf_docs.columns))
    got = {(r.doc_id, r.paragraph): r for r in licenses.scan(docs).collect()}
    want = {10_000_000 + i: f for i, f in enumerate(["Apache-2.0", "MIT", "CC-BY-NC-4.0", "GPL-3.0"])}
    assert {k[0]: r.family for k, r in got.items() if k[0] >= 10_000_000 and r.confirmed} == want
    for r in sf_docs.collect():
        for k, line in enumerate((r.text or "").split("\n")):
            assert ((r.doc_id, k) in got and got[(r.doc_id, k)].confirmed) == (line in lines), line
    assert licenses.scan(docs.limit(0)).count() == 0


def test_licences_learnt_from_all_lines(spark):
    """Counts, model and threshold come from every distinct line: the threshold is the percentile over all of them."""
    rng = np.random.default_rng(5)
    held = [sorted(set(re.findall("[a-z0-9]+", " ".join(x).lower()))) for x in licenses.NOTICES.values()]
    texts = [f"plain n{i} the end" for i in range(9000)] + [
        " q ".join(rng.permutation(held[i % 16])[: 8 + i % 17]) + f" n{i}" for i in range(60)]  # words of a notice, no pair of it
    lines = spark.createDataFrame([(t,) for t in texts + texts[-40:] * 30], "text string")  # copies count once
    model = licenses.train(lines, licenses.NOTICES)
    assert model["learnt"] == len(texts)
    rows = spark.createDataFrame([(i, 0, 0, 1, t.split()) for i, t in enumerate(texts)], "doc_id long, row long, paragraph int, n_lines int, w array<string>")
    got = {r.doc_id: r for r in licenses.scored(rows, model).collect()}
    near = [i for i, t in enumerate(texts) if set(t.split()) & set(model["single"])]
    sure = [0 if got[i].family == licenses.UNKNOWN else got[i].probability for i in near]
    want = float(np.percentile(sure, 99.9))
    assert 0.5 < want < 1 and abs(model["threshold"] - want) < 2e-6


def test_line_grams_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    grams = ["a", "b", "a b", "b a", "a b a", "c d"]
    texts = [" ".join(rng.choice(list("abcdx"), rng.integers(0, 7))) for _ in range(200)]
    want = []
    for t in sorted(set(texts)):
        w = t.split()
        want.append(sorted({" ".join(w[i: i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)} & set(grams)))
    got = licenses.line_grams(spark.createDataFrame([(t,) for t in texts], "text string"), grams).collect()
    assert sorted(r.g for r in got) == sorted(want)


# 10 BPE

def test_bpe_equals_the_library(spark, sf_docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(queries.tokenizer_file())
    text = {r.doc_id: r.text or "" for r in sf_docs.collect()}
    got = {r.doc_id: r for r in queries.op10_bpe(spark, SF).collect()}
    odd = docs_df(spark, [None, "", " ", "a  b \n\n c\t", "it's I'LL we've 12½ ²", "<|endoftext|>x<|endoftext|>", "漢字 ١٢ \u3000 \u00a0x", "😀é", "x\u2028y\u0085z",
                          "\u1e9e\U0001f1e6 a", "<|endoftext", "a" * 3000])
    more = {r.doc_id: r for r in bpe.round_trip(odd, queries.tokenizer_file(), queries.word_pattern(), block_bytes=64).collect()}
    for rows, texts in ((got, text), (more, {r.doc_id: r.text or "" for r in odd.collect()})):
        assert set(rows) == set(texts)
        for i, t in texts.items():
            ids = tok.encode(t, add_special_tokens=False).ids
            assert (rows[i].n_tokens, rows[i].ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()), t
            assert rows[i].decoded_sha256 == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest(), t


def test_bpe_encode_decode(spark):
    rows = awkward(spark)
    ids = bpe.encode(rows, queries.tokenizer_file(), queries.word_pattern())
    back = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in bpe.decode(ids, queries.tokenizer_file(), queries.word_pattern()).collect())
    assert back == sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in rows.collect())
    assert bpe.encode(rows.limit(0), queries.tokenizer_file(), queries.word_pattern()).count() == 0


# pipeline and registration

def test_queries_are_registered():
    names = entry.queries()
    assert all(any(re.match(rf"op{n}_", k) for k in names) for n in range(1, 14)) and "pipeline" in names


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = {r.item_id: decontam.tokens(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        before, at = at, stage(spark, at, SF).cache()
        if name != "bpe":
            assert at.columns == docs.columns
            kept = {r.doc_id: r.text for r in at.collect()}
            had = {r.doc_id: r.text for r in before.collect()}
            assert kept.items() <= had.items()
        if name == "near duplicates":
            comp = brute_components({i: brute_fingerprint(t) for i, t in had.items()})
            assert set(kept) == {i for i, c in comp.items() if i == c}
        if name == "decontamination":
            holds = {i for i, t in had.items() for b in bench.values() if b and f" {' '.join(b)} " in f" {' '.join(decontam.tokens(t))} "}
            assert holds and not holds & set(kept)
    assert {r.doc_id for r in at.collect()} == {r.doc_id for r in before.collect()}
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, whole.collect())) == sorted(map(str, at.select(whole.columns).collect()))
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(queries.tokenizer_file())
    left = {r.doc_id: r.text or "" for r in before.collect()}
    for r in whole.collect():
        ids = tok.encode(left[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


def test_registered_neighbours_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    ids, v = np.array([i for i, _ in rows]), np.array([x for _, x in rows], float)
    got = defaultdict(list)
    for r in sorted(queries.op5_neighbours(spark, SF).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == {i for i in ids.tolist() if i % 100 == 0}
    hits = 0
    for q, found in got.items():
        exact = np.sqrt(((v - v[ids == q][0]) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, exact)) if ids[i] != q][:10]
        hits += len({i for i, _ in found} & set(ids[order].tolist()))
        assert len(found) == 10 and all(s == pytest.approx(exact[ids == i][0]) for i, s in found)
    assert hits >= 0.9 * 10 * len(got)
