"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Fingerprint: texts lower-cased (A-Z), words split at ASCII white space, shingles of ``n`` words
joined by one space (repeats count; fewer words: the whole sequence; none: fingerprint 0), each
hashed by XXH64 with seed 42; a bit is 1 if it is set in more than half of the hashes.

Search: two fingerprints that differ in at most k bits share at least 8 - k of their 8 positional
bytes, so one half of the positions holds ceil((8 - k) / 2) shared ones.  The index posts every
distinct fingerprint under each such choice of positions inside a half together with the bytes
there (k = 3: 8 postings of 3 positional bytes).  Inside a posting each pair's shared positional
bytes are tallied, pairs below the guaranteed minimum 8 - k are dropped, and the rest is verified
by Hamming distance.  Copies collapse to one fingerprint before the index; a long posting is cut
into blocks and every pair of blocks is its own group of at most 2 x ``block`` rows, so no posting
meets in one task and nothing is capped.  A group returns a spanning forest of its links (at most
one row for each fingerprint), never its pairs; the forests keep every component whole.

Null or empty text: fingerprint 0, linked like any other.  A null id keeps its row; it names no
component (component null if no copy has an id).  Repeated rows keep their rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import components, looked_up, slices, small_batches, texts, written

SEED = 42


def fingerprint(text: bytes, n: int = 3) -> int:
    """The 64-bit fingerprint of one UTF-8 text."""
    words = text.lower().split()
    if not words:
        return 0
    joined, m = b" ".join(words), len(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, m) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if m > n:
        starts, ends = starts[: m - n + 1], ends[n - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())), "<u8", len(starts))
    total = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        part = hashes[lo: lo + (1 << 16)].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3) -> DataFrame:
    """(doc_id, fp long) of every row."""
    def run(batches):
        for part in slices(batches, "text"):
            texts = part.column("text").cast(pa.binary()).to_pylist()
            fps = np.fromiter((fingerprint(t or b"", n) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    rows = texts(docs, id_col, text_col)
    return rows.mapInArrow(run, "doc_id long, fp long")


def position_choices(max_bits: int) -> list[tuple[int, ...]]:
    """Byte positions of the postings: any pair within ``max_bits`` shares one of them whole."""
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits must be 0 to 7")
    size = (8 - max_bits + 1) // 2
    return [*combinations(range(4), size), *combinations(range(4, 8), size)]


def link_forest(fp: np.ndarray, node: np.ndarray, group: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smaller node of the same component) inside runs of equal ``group``.  Rows at
    each distance along the run are compared as arrays, for all groups at once."""
    m = len(fp)
    label = np.arange(m)
    left, right = [], []
    at = np.arange(m - 1) if m > 1 else np.empty(0, np.int64)
    lag = 1
    while len(at):
        at = at[at + lag < m]
        at = at[group[at] == group[at + lag]]
        x = fp[at] ^ fp[at + lag]
        shared = (x.view(np.uint8).reshape(-1, 8) == 0).sum(1)
        near = (shared >= 8 - max_bits) & (np.bitwise_count(x) <= max_bits)
        left.append(at[near])
        right.append(at[near] + lag)
        if lag % 64 == 0 and sum(map(len, left)) > (1 << 20):
            left, right = _settle(label, left, right)
        lag += 1
    _settle(label, left, right)
    low = np.full(m, np.iinfo(np.int64).max)
    np.minimum.at(low, label, node)
    ends = low[label]
    out = ends != node
    return node[out], ends[out]


def _settle(label, left, right):
    """Merges the links into ``label`` (row -> smallest row of its component), in place."""
    if left:
        a, b = np.concatenate(left), np.concatenate(right)
        while len(a):
            la, lb = label[a], label[b]
            open_ = la != lb
            a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up
    return [], []


def links(points: DataFrame, max_bits: int = 3, block: int = 1024) -> DataFrame:
    """(a, b): forests of links among distinct fingerprints ``points`` (fp long, node long)."""
    choices = position_choices(max_bits)

    def key(i: int, at: tuple[int, ...]):
        parts = [F.shiftright(F.col("fp"), 8 * p).bitwiseAND(255) * (1 << (8 * j)) for j, p in enumerate(at)]
        total = F.lit(i << 32)
        for p in parts:
            total = total + p
        return total

    index = points.select("fp", "node", F.explode(F.array(*[key(i, at) for i, at in enumerate(choices)])).alias("key"))
    size = index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = (index.join(size, "key")
             .withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
             .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
             .select("key", "fp", "node", "own", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"))
             .select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp", "node"))

    def run(batches):
        kept = None
        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "lo", "hi", "fp", "node")]
            if kept is not None:
                cols = [np.concatenate(x) for x in zip(kept, cols)]
            key_, lo, hi = cols[:3]
            new = np.flatnonzero((key_[1:] != key_[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
            cut = int(new[-1]) if len(new) else 0  # the last group may go on in the next batch
            kept = [c[cut:] for c in cols]
            if cut:
                yield forest([c[:cut] for c in cols], new[:-1])
        if kept is not None and len(kept[0]):
            yield forest(kept, np.empty(0, np.int64))

    def forest(cols, new):
        group = np.zeros(len(cols[0]), np.int64)
        group[new] = 1
        a, b = link_forest(np.ascontiguousarray(cols[3]).view(np.uint64), cols[4], np.cumsum(group), max_bits)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return (dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
            .mapInArrow(run, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3,
                    max_bits: int = 3, block: int = 1024) -> DataFrame:
    """(doc_id, fingerprint string, component_id): one row for each row of ``docs``."""
    fps = written(fingerprints(docs, id_col, text_col, n), "fingerprints")
    points = fps.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node"))
    near = components(links(points, max_bits, block))
    of = (points.join(near, "node", "left")
          .select(F.col("fp").alias("of_fp"), F.coalesce("component", "node").alias("component_id")))
    return (fps.join(of, F.col("fp") == F.col("of_fp"), "left")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def one_of_each(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", n: int = 3, max_bits: int = 3, block: int = 1024) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: exactly one of each component, the one with the smallest id (null
    ids last; of rows that repeat that id, one).  Rows are told apart by a number of their own, so null and
    repeated ids go and stay like any others.  The numbers that go are a written table, so the planner knows its size: a
    small one is broadcast, another joined by a shuffle."""
    fp, row = (_free(name, docs.columns) for name in ("fp", "row"))

    def run(batches):
        for part in slices(batches, text_col):
            found = part.column(text_col).cast(pa.string()).cast(pa.binary()).to_pylist()
            fps = np.fromiter((fingerprint(t or b"", n) for t in found), np.uint64, len(found))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(fps.view(np.int64))], [*part.schema.names, fp])

    schema = T.StructType([*docs.schema.fields, T.StructField(fp, T.LongType())])
    tagged = written(small_batches(docs).mapInArrow(run, schema).withColumn(row, F.monotonically_increasing_id()), "fingerprints")
    rows = tagged.select(F.col(row).alias("row"), F.col(fp).alias("fp"), F.col(id_col).cast("long").alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")
    points = written(rows.groupBy("fp").agg(first, F.count(F.lit(1)).alias("n")).select("fp", "n", "first", F.col("first.row").alias("node")), "points")
    near = components(links(points.select("fp", "node"), max_bits, block))
    joined = points.join(near, "node", "left").select("fp", "n", "first", F.coalesce("component", "node").alias("component"))
    keep = joined.groupBy("component").agg(F.min("first").alias("keep")).select("component", F.col("keep.row").alias("keep"))
    of = written(joined.join(keep, "component").select("fp", "n", "keep"), "kept")
    gone = written(looked_up(rows, of, ["fp"], ["keep"]).where("row != keep").select(F.col("row").alias(row)), "gone")
    return tagged.join(gone, row, "left_anti").drop(fp, row)


def _free(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column has it."""
    while name in {c.lower() for c in taken}:
        name += "_"
    return name
