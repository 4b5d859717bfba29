"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Model: P(grade <= k) = sigmoid(theta_k - w . x) with one weight vector shared by all grades and
ordered thresholds theta_0 < theta_1 < ...; x is the hashed text of a document: its distinct words
(lower-cased, edge punctuation stripped) and their first PREFIX letters, the shapes of its tokens (letter case and trailing
punctuation) with their rounded share, and its rounded share of repeated tokens.  Only hash buckets that at
least ``min_docs`` rated documents of the fit hold, and whose share of documents differs between a
grade and the others by ``min_errors`` standard errors, keep a weight.

Fit: at most ``fit_rows`` rated documents (drawn by a hash of the text, evenly from each grade) are
featurised by Spark and fitted in numpy by full-batch Adam.  Scoring reads all of every text.

Result: expected grade and the tail probability P(grade >= keep_grade) for selection.  Null or empty
text: no features, so the thresholds alone decide.  Rating rows with a null id or grade are left
out; several ratings of one document count as its smallest.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import slices, small_batches, texts

BUCKETS = 1 << 18
PREFIX = 5
EDGE = "".join(chr(c) for c in range(33, 128) if not chr(c).isalnum()) + "¿¡«»“”‘’„–—…"


def shape(core: str, tail: str) -> str:
    """Letter case of a token and its trailing punctuation."""
    if not core:
        kind = "-"
    elif core.islower():
        kind = "a"
    elif core.isupper():
        kind = "A" if len(core) > 1 else "I"
    elif core.istitle():
        kind = "T"
    else:
        kind = "9" if core[:1].isdigit() else "m"
    return kind + tail[:3]


def hashed(values: list[str]) -> np.ndarray:
    """Bucket of every string, equal in every process."""
    if not values:
        return np.empty(0, np.int64)
    return (pd.util.hash_array(np.array(values, dtype=object), categorize=False) % BUCKETS).astype(np.int64)


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct integers and how often each occurs."""
    values = np.sort(values)
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.empty(0, np.int64)
    return values[first], np.diff(np.r_[first, len(values)])


def features(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row of a text, bucket) pairs, each once; rows in order.  ``wanted``: mask of buckets."""
    words = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    flat = words.flatten().dictionary_encode()
    code = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    known = flat.dictionary.to_pylist()
    if not known:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    real = np.array([bool(t) for t in known])[code]
    code, row = code[real], row[real]
    total = np.bincount(row, minlength=len(texts))
    cores = [t.rstrip(EDGE) for t in known]
    numbers: dict[str, int] = {}
    kind = np.array([numbers.setdefault(shape(c, t[len(c):]), len(numbers)) for c, t in zip(cores, known)])
    kinds = list(numbers)
    plain = [c.lstrip(EDGE).lower() for c in cores]
    word, begins = hashed(plain), hashed([t[:PREFIX] + "~" for t in plain])
    pair, _ = distinct(row * len(known) + code)  # distinct tokens of each text
    once, token = pair // len(known), pair % len(known)
    # shares of the token shapes and of repeated tokens, rounded to powers of two
    share, n = distinct(row * len(kinds) + kind[code])
    level = np.floor(np.log2(n / total[share // len(kinds)])).astype(int)
    spelled = hashed([f"s {kinds[s % len(kinds)]} {v}" for s, v in zip(share.tolist(), level.tolist())])
    single = np.bincount(once, minlength=len(texts))
    some = np.flatnonzero(total)
    again = hashed([f"r {int(10 * (1 - single[i] / total[i]))} {int(np.log2(total[i]) // 2)}" for i in some])
    at = np.concatenate((once, once, share // len(kinds), some))
    bucket = np.concatenate((word[token], begins[token], spelled, again))
    if wanted is not None:
        at, bucket = at[wanted[bucket]], bucket[wanted[bucket]]
    both, _ = distinct(at * BUCKETS + bucket)
    return both // BUCKETS, both % BUCKETS


def grade_probabilities(score: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """(rows, grades) of the cumulative-link model."""
    below = 1 / (1 + np.exp(-np.clip(theta[None] - score[:, None], -60, 60)))
    return np.diff(below, axis=1, prepend=0.0, append=1.0)


def clear_buckets(docs: np.ndarray, per: np.ndarray, min_docs: int, min_errors: float) -> np.ndarray:
    """The buckets that keep a weight; ``docs``: (grades, buckets) documents, ``per``: documents of each grade."""
    n, clear = per.sum(), np.zeros(BUCKETS)
    for k in range(len(per)):  # each grade against the others: difference of shares in standard errors
        a, b = docs[k], docs.sum(0) - docs[k]
        if 0 < per[k] < n:
            share = (a + b) / n
            gap = np.abs(a / per[k] - b / (n - per[k]))
            clear = np.maximum(clear, gap / np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / per[k] + 1 / (n - per[k]))))
    return np.flatnonzero((docs.sum(0) >= min_docs) & (clear >= min_errors))


def fit(row: np.ndarray, bucket: np.ndarray, grade: np.ndarray, grades: int, min_docs: int = 6, epochs: int = 300,
        rate: float = 0.05, l2: float = 3e-4, power: float = 0.5, min_errors: float = 5.0) -> dict:
    """Weights and thresholds.  A grade weighs as its number of documents to the power 1 - ``power``."""
    n = len(grade)
    per = np.bincount(grade, minlength=grades)
    held = clear_buckets(np.stack([np.bincount(bucket[grade[row] == k], minlength=BUCKETS) for k in range(grades)]), per, min_docs, min_errors)
    place = np.full(BUCKETS, -1, np.int32)
    place[held] = np.arange(len(held))
    used = place[bucket] >= 0
    row, at = row[used], place[bucket[used]]
    del bucket
    weight = (np.maximum(per, 1) / n) ** -power
    weight = (weight / weight[grade].mean())[grade]
    w, first, gaps = np.zeros(len(held)), -1.0, np.zeros(max(0, grades - 2))
    params = [w, np.array([first]), gaps]
    moment = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, epochs + 1):
        w, first, gaps = params
        theta = np.cumsum(np.concatenate((first, np.exp(gaps))))
        score = np.bincount(row, w[at], n)
        edge = 1 / (1 + np.exp(-np.clip(np.concatenate(([-1e3], theta, [1e3]))[None] - score[:, None], -60, 60)))
        hi, lo = edge[np.arange(n), grade + 1], edge[np.arange(n), grade]
        p = np.maximum(hi - lo, 1e-12)
        up, down = hi * (1 - hi) / p * weight, lo * (1 - lo) / p * weight  # d log p / d theta, upper and lower
        by_score = (up - down) / n
        by_theta = np.array([(down[grade == k + 1].sum() - up[grade == k].sum()) / n for k in range(grades - 1)])
        tails = np.cumsum(by_theta[::-1])[::-1]
        grads = [np.bincount(at, by_score[row], len(held)) + l2 * w / len(per), tails[:1], tails[1:] * np.exp(gaps)]
        for i, g in enumerate(grads):
            m, v = moment[i]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            params[i] = params[i] - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    w, first, gaps = params
    return {"bucket": held.astype(np.int32), "weight": w.astype(np.float32),
            "theta": np.cumsum(np.concatenate((first, np.exp(gaps))))}


def train(docs: DataFrame, ratings: DataFrame, grades: int, id_col: str = "doc_id", text_col: str = "text",
          fit_rows: int = 24000, min_docs: int = 6, min_errors: float = 5.0) -> dict:
    """The model from ``ratings`` (doc_id, grade 0 .. grades - 1).  ``fit_rows`` bounds the fit: that many ids, each
    with its lowest grade and, where it has several texts, the first of them in order."""
    rated = (ratings.where(f"doc_id is not null and grade between 0 and {grades - 1}").groupBy(F.col("doc_id").alias("rated_id"))
             .agg(F.min("grade").cast("int").alias("grade")))
    # the rows of the fit are chosen among the ratings, so that texts are joined with a bounded table
    each = -(-fit_rows // grades)
    rated = rated.withColumn("h", F.xxhash64("rated_id")).withColumn("part", F.shiftright("h", 56))
    # the smallest hashes of each grade: whole ranges of hashes, and the range that holds the limit in part
    sizes = rated.groupBy("grade", "part").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("grade").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sizes = sizes.select("grade", "part", (upto - F.col("n")).alias("before")).where(f"before < {each}")
    chosen = (rated.join(sizes, ["grade", "part"]).withColumn("r", F.row_number().over(Window.partitionBy("grade", "part").orderBy("h")))
              .where(f"before + r <= {each}").select("rated_id", "grade"))
    # one row for each rated id, whose copies are combined before the shuffle
    rows = (docs.select(F.col(id_col).cast("long").alias("rated_id"), F.col(text_col).cast("string").alias("text"))
            .join(F.broadcast(chosen), "rated_id").groupBy("rated_id").agg(F.min("text").alias("text"), F.min("grade").alias("grade")))

    def run(batches):
        for part in slices(batches, "text"):
            row, bucket = features(part.column("text"))
            cut = np.searchsorted(row, np.arange(len(part) + 1))
            lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(bucket, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column("grade"), lists], ["grade", "buckets"])

    got = rows.select("grade", "text").mapInArrow(run, "grade int, buckets array<int>").toArrow()
    if not got.num_rows:
        return {"bucket": np.empty(0, np.int32), "weight": np.empty(0, np.float32), "theta": np.arange(grades - 1, dtype=float)}
    # batch by batch, so that the pairs of buckets without a weight are never copied
    docs_of, per = np.zeros((grades, BUCKETS), np.int64), np.zeros(grades, np.int64)
    for grade, row, bucket in _pairs(got):
        per += np.bincount(grade, minlength=grades)
        for k in range(grades):
            docs_of[k] += np.bincount(bucket[grade[row] == k], minlength=BUCKETS)
    wanted = np.zeros(BUCKETS, bool)
    wanted[clear_buckets(docs_of, per, min_docs, min_errors)] = True
    parts, n = [], 0
    for grade, row, bucket in _pairs(got):
        keep = wanted[bucket]
        parts.append((grade, (row[keep] + n).astype(np.int32), bucket[keep]))
        n += len(grade)
    del got
    grade, row, bucket = (np.concatenate(x) for x in zip(*parts))
    return fit(row, bucket, grade, grades, min_docs, min_errors=min_errors)


def _pairs(got: pa.Table):
    """(grades, row, bucket) of each batch."""
    for batch in got.to_batches():
        lists = batch.column("buckets")
        row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        yield batch.column("grade").to_numpy().astype(np.int64), row, lists.flatten().to_numpy()


def _judge(model: dict):
    """A function from texts to (rows, grades) probabilities."""
    weight = np.zeros(BUCKETS)
    weight[model["bucket"]] = model["weight"]

    def judge(texts: pa.Array) -> np.ndarray:
        row, bucket = features(texts, weight != 0)
        return grade_probabilities(np.bincount(row, weight[bucket], len(texts)), model["theta"])
    return judge


def grade(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", keep_grade: int | None = None,
          keep_at: float = 0.5) -> DataFrame:
    """(doc_id, expected_grade, tail_probability, keep): one row for each row of ``docs``; ``keep_grade``
    defaults to the top grade."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    top = len(model["theta"]) if keep_grade is None else keep_grade

    def run(batches):
        judge = _judge(shared.value)
        for part in slices(batches, "text"):
            p = judge(part.column("text"))
            tail = p[:, top:].sum(1)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(p @ np.arange(p.shape[1])), pa.array(tail), pa.array(tail >= keep_at)],
                ["doc_id", "expected_grade", "tail_probability", "keep"])

    rows = texts(docs, id_col, text_col)
    return rows.mapInArrow(run, "doc_id long, expected_grade double, tail_probability double, keep boolean")


def selected(docs: DataFrame, model: dict, text_col: str = "text", keep_grade: int | None = None,
             keep_at: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose tail probability reaches ``keep_at``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    top = len(model["theta"]) if keep_grade is None else keep_grade

    def run(batches):
        judge = _judge(shared.value)
        for part in slices(batches, text_col):
            yield part.filter(pa.array(judge(part.column(text_col).cast(pa.string()))[:, top:].sum(1) >= keep_at))

    return small_batches(docs).mapInArrow(run, docs.schema)


def graded(labels: DataFrame) -> DataFrame:
    """Ratings of the ``labels`` table: 0 poor text, 1 toxic, 2 good."""
    return labels.select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1)
                         .when((F.col("quality") == 1), 2).alias("grade")).where("grade is not null")
