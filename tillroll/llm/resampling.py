"""Importance resampling towards a target distribution, drawn by weighted median-of-medians selection.

Weights: words are runs of letters, digits and non-ASCII characters of the whole text, A-Z lower-cased; features are all
runs of one and of two words, hashed by CRC-32 into ``buckets``.  Counts over all source and all target texts give each
bucket a gain in thousandths of a log ratio (add-one smoothed), and a document weighs the floored mean gain of
its features.  Texts are scored as arrays: one pass over the bytes of a slice finds the words, their
CRCs advance together byte by byte, and a pair's CRC follows from those of its words, since CRC-32 is linear.

Draw: score = weight + Gumbel noise from a hash of ``seed`` and id, so the highest scores are a draw without
replacement in proportion to the importance.  The cutoff is found exactly, without a sort of all rows: in
each round every chunk of at most ``chunk`` remaining keys reports its median and size, the weighted
median of those medians is the pivot, and the side that cannot hold the cutoff, at least a quarter of the
keys, is discarded; when few keys remain they are looked at directly.  Only the winners are sorted.

The driver gets the gains (``buckets`` numbers), one median per chunk and at most ``FINISH`` keys.  Keys are (score down, id
up, null ids last, row), so ties and repeated rows have one order.  Null and empty texts have no features and weight 0, and
are below any minimum of words; an empty table or target gives no error.  A task holds some 30 bytes for each byte of the
longest text.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import slices, texts, written
from tillroll.llm.ranking import numbered

FINISH = 4096  # remaining keys that the driver looks at directly
SHORT = 64  # words up to so many bytes are hashed together

_BYTE = np.arange(256)
_LOW = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
# Word bytes are 0-9, a-z and all bytes of non-ASCII characters.
_WORD = ((_BYTE >= 0x30) & (_BYTE <= 0x39)) | ((_BYTE >= 0x61) & (_BYTE <= 0x7A)) | (_BYTE >= 0x80)
_CRC = np.array([zlib.crc32(bytes([b])) ^ 0xFF000000 for b in range(256)], np.uint32)
_CRC = _CRC ^ _CRC[0]  # what one byte contributes to the remainder


def _advance(state: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    return _CRC[(state ^ byte) & 255] ^ (state >> 8)


# _SHIFT[m, k, b]: byte b at place k of a CRC, after m zero bytes
_SHIFT = np.empty((SHORT + 1, 4, 256), np.uint32)
_SHIFT[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
for _m in range(SHORT):
    _SHIFT[_m + 1] = _advance(_SHIFT[_m], 0)


def feature_hashes(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, CRC-32) of every word and (text number, CRC-32) of every pair of adjacent words."""
    raw = pc.fill_null(text, "").cast(pa.large_binary())
    ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset: raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[ends[0]: ends[-1]]
    data, ends = _LOW[data], ends - ends[0]
    inside, new = _WORD[data], np.zeros(len(data) + 1, bool)
    new[ends] = True  # a word does not cross texts
    edge = np.r_[False, inside, False]
    starts = np.flatnonzero(inside & (~edge[:-2] | new[:-1]))
    stops = np.flatnonzero(inside & (~edge[2:] | new[1:])) + 1
    doc, size = np.searchsorted(ends, starts, side="right") - 1, stops - starts

    short = np.minimum(size, SHORT)
    order = np.argsort((SHORT - short).astype(np.uint8), kind="stable")  # long ones first
    state, at = np.full(len(order), 0xFFFFFFFF, np.uint32), starts[order]
    more = len(order) - np.cumsum(np.bincount(short, minlength=SHORT + 1))  # words longer than m
    for m in range(int(short.max(initial=0))):
        state[:more[m]] = _advance(state[:more[m]], data[at[:more[m]] + m])
    crc = np.empty(len(order), np.uint32)
    crc[order] = ~state
    for i in np.flatnonzero(size > SHORT):
        crc[i] = zlib.crc32(data[starts[i] + SHORT: stops[i]].tobytes(), int(crc[i]))

    first = np.flatnonzero(doc[1:] == doc[:-1])
    head, tail = ~_advance(~crc[first], 32), crc[first + 1]  # the first word and a space
    length = short[first + 1]
    pair = tail.copy()
    for k in range(4):
        pair ^= _SHIFT[length, k, (head >> (8 * k)) & 255]
    for i in np.flatnonzero(size[first + 1] > SHORT):
        j = first[i] + 1
        pair[i] = zlib.crc32(data[starts[j]: stops[j]].tobytes(), int(head[i]))
    return doc, crc, doc[first], pair


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket over all ``rows`` (doc_id, text)."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for part in slices(batches, "text"):
            _, one, _, two = feature_hashes(part.column("text"))
            total += np.bincount(one % buckets, minlength=buckets) + np.bincount(two % buckets, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in rows.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to source, floored, of each bucket."""
    all_s, all_t, m = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((float(t + 1) * float(all_s + m)) / (float(s + 1) * float(all_t + m))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(key: str) -> int:
    """Gumbel noise in thousandths, from 32 bits of the key's SHA-256."""
    h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(rows: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every one of ``rows`` (doc_id, text)."""
    shared = rows.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        gain = shared.value
        for part in slices(batches, "text"):
            n = len(part)
            d1, one, d2, two = feature_hashes(part.column("text"))
            words = np.bincount(d1, minlength=n)
            features = words + np.bincount(d2, minlength=n)
            total = np.zeros(n, np.int64)
            for d, h in ((d1, one), (d2, two)):
                upto = np.r_[0, np.cumsum(gain[h % len(gain)])]
                total += upto[np.searchsorted(d, np.arange(n), side="right")] - upto[np.searchsorted(d, np.arange(n), side="left")]
            weight = np.where(features > 0, total // np.maximum(features, 1), 0)
            drawn = np.array([noise(f"{seed}:{'' if i is None else i}") for i in part.column("doc_id").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(c, pa.int64()) for c in (words, features, weight, weight + drawn)]],
                                             ["doc_id", "n_words", "n_features", "weight", "score"])

    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


KEY = ["a", "b", "c"]


def cutoff(keys: DataFrame, k: int, chunk: int = 1_000_000, finish: int = FINISH) -> tuple[int, int, int] | None:
    """The ``k``-th smallest of ``keys`` (a written table of longs a, b, c, all different), exactly."""
    def medians(batches):
        def middle(held):
            cols = [np.concatenate(c) for c in zip(*held)]
            order = np.lexsort(cols[::-1])
            return [*(c[order[(len(order) - 1) // 2]] for c in cols), len(order)]

        held, size, out = [], 0, []
        for batch in batches:
            for lo in range(0, len(batch), chunk):
                part = batch.slice(lo, chunk)
                if held and size + len(part) > chunk:
                    out.append(middle(held))
                    held, size = [], 0
                held.append([part.column(c).to_numpy() for c in KEY])
                size += len(part)
        if size:
            out.append(middle(held))
        yield pa.RecordBatch.from_arrays([pa.array([int(r[i]) for r in out], pa.int64()) for i in range(4)], [*KEY, "n"])

    def at_most(key):
        return F.struct(*KEY) <= F.struct(*[F.lit(x).cast("long").alias(c) for c, x in zip(KEY, key)])

    table, left = keys, keys.count()
    table_rows, live = left, F.lit(True)
    if not 0 < k <= left:
        return None
    while left > finish:
        found = sorted((tuple(r)[:3], r["n"]) for r in table.where(live).mapInArrow(medians, "a long, b long, c long, n long").collect())
        half, run = left / 2, 0
        for pivot, n in found:
            run += n
            if run >= half:
                break
        below = table.where(live & at_most(pivot)).count()
        if below == k:
            return pivot
        if below > k:
            live, left = live & at_most(pivot), below
        else:
            live, left, k = live & ~at_most(pivot), left - below, k - below
        if left * 4 < table_rows:  # the rest is written, so that later rounds do not reread what is discarded
            table = written(table.where(live), "selection")
            table_rows, live = left, F.lit(True)
    return sorted(tuple(r) for r in table.where(live).select(*KEY).collect())[k - 1]


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, buckets: int = 10_000, seed: int = 7,
             id_col: str = "doc_id", text_col: str = "text", target_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank): every row of ``docs``; rank (from 1) is null for
    rows that are not drawn.  Drawn: floor(percent * N / 100) of the N rows with ``min_words`` words."""
    rows = texts(docs, id_col, text_col)
    aim = texts(target.select(F.lit(0).alias("doc_id"), F.col(target_text).alias("text")), "doc_id", "text")
    gain = gains(bucket_counts(rows, buckets), bucket_counts(aim, buckets))
    # the highest score first: the smallest key
    table = written(scored(rows, gain, seed).withColumn("row", F.monotonically_increasing_id()), "scores")
    enough = F.col("n_words") >= min_words
    key = [-F.col("score"), F.coalesce("doc_id", F.lit((1 << 63) - 1)), F.col("row")]
    keys = written(table.where(enough).select(*[k.alias(c) for k, c in zip(key, KEY)]), "selection")
    last = cutoff(keys, percent * keys.count() // 100)
    out = ["doc_id", "n_words", "n_features", "weight", "score"]
    if last is None:
        return table.select(*out, F.lit(None).cast("long").alias("rank"))
    drawn: Column = enough & (F.struct(*[k.alias(c) for k, c in zip(key, KEY)]) <= F.struct(*[F.lit(x).cast("long").alias(c) for c, x in zip(KEY, last)]))
    winners = numbered(table.where(drawn), [], key, "winners")
    return winners.select(*out, (F.col("idx") + 1).alias("rank")).unionByName(table.where(~drawn).select(*out, F.lit(None).cast("long").alias("rank")))
