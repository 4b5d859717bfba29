"""Approximate nearest neighbours by multiprobe p-stable hashing.

Index: every distinct vector is posted in ``tables`` tables under floor((a . x + b) / width) of
``hashes`` Gaussian (2-stable) projections; ``width`` is in units of the vectors' root mean square
norm, from a bounded sample.  Query: in each table the query's own bucket and the perturbed buckets
(-1, 0, +1 per projection) are visited in the order of estimated success, the sum of squared
distances to the boundaries crossed (shift and expand on a heap), ``probes`` in all.  The candidates of
all tables are merged and ranked by exact Euclidean distance in double precision.

A query is ranked exactly against all vectors, in blocks, where its list stays short, or where a
vector at the distance of the last one listed would lie in a visited bucket with a probability under
``cover`` (from the query's places in its buckets, over the Gaussian projections): queries far from
the others, or of a larger norm.  So a list is short only if there are fewer candidates than k.

Postings and visits carry no vector but a code: the nearest of ``anchors`` sampled vectors or zero, one
byte a component for the difference, its scale, and the length of what the rounding left out.  The error
follows the distance to the anchor, so a dense cluster of a few percent of the rows is told apart as finely
as the whole table.  Two codes bound the distance from both sides, so a task returns those candidates of
a query that can be among its k + 1 nearest, and drops only those that k + 1 others surely beat.  The
vectors themselves join the few pairs that are left, for the exact distance.

A bucket with more than ``block`` vectors is cut into blocks that are searched apart, so no bucket
meets in one task and no candidate is dropped.  Blocks grow with the input where more than ``LARGE`` buckets
would need cutting: only that many are ever broadcast.  Equal vectors are one posting with their k + 1
smallest ids, which is all that a list of k needs, and equal queries are searched once.

Vectors that are null, empty, zero, hold null or non-finite components or have another length
than most take no part, as neither queries nor candidates; neither do null ids.  Ties go to the smaller
id; repeated (id, vector) rows count once; fewer candidates than k give shorter lists.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import written

# Most buckets that are cut into blocks: their keys and sizes go to every task (16 MB).
LARGE = 1_000_000
# Distances bounded at a time, and pairs held before a task drops the beaten ones.
CELLS, HELD_PAIRS = 1 << 19, 1 << 18


def perturbations(x: np.ndarray, probes: int) -> list[list[tuple[int, int]]]:
    """Sets of (projection, -1 or +1) in estimated success order, the empty set first; ``x``: the
    query's place inside its bucket (0 to 1) on each projection."""
    moves = sorted([(v * v, i, -1) for i, v in enumerate(x)] + [((1 - v) ** 2, i, 1) for i, v in enumerate(x)])
    cost = [m[0] for m in moves]
    out: list[list[tuple[int, int]]] = [[]]
    heap = [(cost[0], (0,))]
    while heap and len(out) < probes:
        total, chosen = heapq.heappop(heap)
        if len({moves[j][1] for j in chosen}) == len(chosen):
            out.append([(moves[j][1], moves[j][2]) for j in chosen])
        last = chosen[-1]
        if last + 1 < len(moves):
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*chosen, last + 1)))
    return out


def chance(place: np.ndarray, far: float, probes: int) -> float:
    """Probability that a vector ``far`` away (in bucket widths) lies in a visited bucket of some table;
    ``place``: (tables, projections) of the query inside its buckets."""
    missed = 1.0
    for x in place:
        edges = np.stack((-1 - x, -x, 1 - x, 2 - x))  # of the buckets -1, 0, +1
        below = 0.5 * (1 + np.array([[math.erf(e / (far * math.sqrt(2))) for e in row] for row in edges])) if far > 0 else (edges > 0).astype(float)
        lands = np.diff(below, axis=0)
        stay = lands[1].prod()
        missed *= max(0.0, 1 - sum(stay if not moves else math.prod(lands[1 + d][j] for j, d in moves)
                                   * math.prod(lands[1][j] for j in range(len(x)) if j not in {m[0] for m in moves})
                                   for moves in perturbations(x, probes)))
    return 1 - missed


def bucket_keys(table: int, at: np.ndarray) -> np.ndarray:
    """A 63-bit key for each row of ``at`` (bucket numbers on the table's projections)."""
    def mixed(h):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))

    key = mixed(np.full(len(at), table + 1, np.uint64))
    for column in at.astype(np.int64).view(np.uint64).T:
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return (key >> np.uint64(1)).astype(np.int64)


def coded(vec: np.ndarray, anchors: np.ndarray) -> pa.Array:
    """For each row: scale, length of the rounding error (doubles), number of the anchor, then one signed byte a component."""
    with np.errstate(all="ignore"):
        far = (anchors ** 2).sum(1) - 2 * (vec @ anchors.T)  # less the row's own squared length
        anchor = np.where(np.isfinite(far), far, np.inf).argmin(1)
        rest = vec - anchors[anchor]
        scale = np.maximum(np.abs(rest).max(1, initial=0.0) / 127, np.finfo(float).tiny)
        code = np.clip(np.rint(rest / scale[:, None]), -127, 127).astype(np.int8)
        left = np.sqrt(((rest - scale[:, None] * code) ** 2).sum(1)) * (1 + 1e-9)
    raw = np.concatenate([np.stack([scale, left], 1).astype("<f8").view(np.uint8).reshape(len(vec), 16),
                          anchor.astype("<u2").view(np.uint8).reshape(len(vec), 2), code.view(np.uint8)], 1)
    return pa.array([r.tobytes() for r in raw], pa.binary())


class Codes:
    """Vectors as their codes tell them, with squared lengths and rounding errors."""

    def __init__(self, codes: pa.Array, anchors: np.ndarray):
        raw = np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(-1, 18 + anchors.shape[1])
        scale, self.left = np.ascontiguousarray(raw[:, :16]).view("<f8").T
        with np.errstate(all="ignore"):
            self.vec = anchors[np.ascontiguousarray(raw[:, 16:18]).view("<u2").ravel()] + scale[:, None] * raw[:, 18:].view(np.int8)
            self.square = (self.vec ** 2).sum(1)

    def part(self, lo: int, hi: int) -> Codes:
        out = object.__new__(Codes)
        out.vec, out.left, out.square = self.vec[lo:hi], self.left[lo:hi], self.square[lo:hi]
        return out

    @staticmethod
    def joined(parts: list[Codes]) -> Codes:
        out = object.__new__(Codes)
        out.vec, out.left, out.square = (np.concatenate([getattr(p, c) for p in parts]) for c in ("vec", "left", "square"))
        return out

    def bounds(self, points: Codes) -> tuple[np.ndarray, np.ndarray]:
        """(least, greatest) distance of every row to every one of ``points``; 0 and infinity where numbers overflow."""
        with np.errstate(all="ignore"):
            both = self.square[:, None] + points.square
            far = np.sqrt(np.maximum(both - 2 * (self.vec @ points.vec.T), 0))
            slack = self.left[:, None] + points.left + 1e-7 * np.sqrt(both)  # the last term: rounding of doubles
            least, most = far - slack, far + slack
        bad = ~np.isfinite(most)
        least[bad], most[bad] = 0, np.inf
        return least, most


def unbeaten(qid: np.ndarray, pid: np.ndarray, least: np.ndarray, most: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The pairs, once each and by (qid, most, pid), that can be among a query's k + 1 nearest of those given."""
    order = np.lexsort((pid, qid))
    order = order[np.r_[True, (np.diff(qid[order]) != 0) | (np.diff(pid[order]) != 0)][: len(order)]]
    order = order[np.lexsort((pid[order], most[order], qid[order]))]
    qid, pid, least, most = qid[order], pid[order], least[order], most[order]
    first = np.flatnonzero(np.r_[True, qid[1:] != qid[:-1]][: len(qid)])
    size = np.diff(np.r_[first, len(qid)])
    limit = np.where(size > k, most[np.minimum(first + k, len(qid) - 1)], np.inf) if len(qid) else np.empty(0)
    keep = least <= np.repeat(limit, size)
    return qid[keep], pid[keep], least[keep], most[keep]


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows that take part; vectors of floats stay so, others are doubles."""
    single = vectors.schema[vec_col].dataType.simpleString() == "array<float>"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<float>" if single else "array<double>").alias("vec"))
    rows = rows.where("id is not null and vec is not null and size(vec) > 0 "
                      "and forall(vec, x -> coalesce(not isnan(x) and abs(x) < double('infinity'), false)) and exists(vec, x -> x != 0)")
    most = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("vec") == (most[0]["n"] if most else 0))


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", tables: int = 7,
            hashes: int = 5, width: float = 1.5, probes: int = 40, block: int = 4096, sample_rows: int = 2000, anchors: int = 256,
            seed: int = 11, cover: float = 0.9) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest found of every row for which ``is_query`` (of
    the column ``id``) holds, its own id left out."""
    rows = usable(vectors, id_col, vec_col)
    # repeated (id, vector) rows go first, so that the k + 1 ids are different ones
    points = written(rows.distinct().withColumn("r", F.row_number().over(Window.partitionBy("vec").orderBy("id")))
                     .where(f"r <= {k + 1}").groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
                     .select(F.col("ids")[0].alias("pid"), "ids", "vec"), "ann-points")
    asked = written(rows.where(is_query).distinct(), "ann-queries")
    wanted = asked.groupBy("vec").agg(F.min("id").alias("qid"))

    sample = points.orderBy(F.xxhash64("vec")).limit(sample_rows).select("vec").collect()
    data = np.array([r["vec"] for r in sample]) if sample else np.ones((1, 1))
    unit = float(np.sqrt((data ** 2).sum(1).mean()))
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(tables, data.shape[1], hashes)) / unit
    b = rng.uniform(0, width, (tables, hashes))
    shared = vectors.sparkSession.sparkContext.broadcast((a, b, np.concatenate([np.zeros((1, data.shape[1])), data[:anchors]])))

    dim = data.shape[1]
    n_points = points.count()
    block = max(block, -(-tables * n_points // LARGE))  # at most LARGE buckets hold more

    def places(vec):
        a, b, _ = shared.value
        for t in range(tables):
            place = (vec @ a[t] + b[t]) / width
            base = np.floor(place)
            yield t, base.astype(np.int64), place - base

    def keys_only(batches):
        for batch in batches:
            for t, base, _ in places(matrix(batch.column("vec"), dim)):
                yield pa.RecordBatch.from_arrays([pa.array(bucket_keys(t, base))], ["key"])

    cut = (points.select("vec").mapInArrow(keys_only, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
           .where(F.col("n") > block).select("key", F.ceil(F.col("n") / block).cast("long").alias("blocks")).orderBy("key").toArrow())
    large = vectors.sparkSession.sparkContext.broadcast(tuple(cut.column(c).to_numpy() for c in ("key", "blocks")))

    def blocks_of(key):
        name, blocks = large.value
        if not len(name):
            return np.ones(len(key), np.int64)
        i = np.minimum(np.searchsorted(name, key), len(name) - 1)
        return np.where(name[i] == key, blocks[i], 1)

    def post(batches):
        for batch in batches:
            vec, own = matrix(batch.column("vec"), dim), batch.column("id")
            code, salt = coded(vec, shared.value[2]), bucket_keys(0, own.to_numpy(zero_copy_only=False).reshape(-1, 1))
            for t, base, _ in places(vec):
                key = bucket_keys(t, base)
                yield posting(key, salt % blocks_of(key), 0, own, code)

    def visit(batches):
        for batch in batches:
            for lo in range(0, len(batch), 64):
                part = batch.slice(lo, 64)
                vec = matrix(part.column("vec"), dim)
                own, code = part.column("id"), coded(vec, shared.value[2])
                for t, base, place in places(vec):
                    moves = [(i, m) for i in range(len(part)) for m in perturbations(place[i], probes)]
                    of = np.array([i for i, _ in moves], np.int64)
                    at = base[of]
                    for row, (_, m) in zip(at, moves):
                        for j, d in m:
                            row[j] += d
                    key = bucket_keys(t, at)
                    blocks = blocks_of(key)
                    blk = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                    take = pa.array(np.repeat(of, blocks))
                    yield posting(np.repeat(key, blocks), blk, 1, own.take(take), code.take(take))

    def posting(key, blk, kind, own, code):
        return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(blk, pa.int32()), pa.array(np.full(len(key), kind, np.int32)), own, code],
                                          ["key", "blk", "kind", "id", "code"])

    def only_coded(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), coded(matrix(batch.column("vec"), dim), shared.value[2])], ["id", "code"])

    schema = "key long, blk int, kind int, id long, code binary"

    def search(batches):
        at, ids, codes = None, [], []  # the points of the block at hand
        held, size = [], 0
        for batch in batches:
            key, blk, kind, own = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "blk", "kind", "id"))
            code = Codes(batch.column("code"), shared.value[2])
            new = np.flatnonzero((key[1:] != key[:-1]) | (blk[1:] != blk[:-1]) | (kind[1:] != kind[:-1])) + 1
            for lo, hi in zip(np.r_[0, new], np.r_[new, len(key)]):
                if hi == lo:
                    continue
                if at != (at := (key[lo], blk[lo])):
                    ids, codes = [], []
                if kind[lo] == 0:
                    ids.append(own[lo:hi])
                    codes.append(code.part(lo, hi))
                elif ids:
                    ids, codes = [np.concatenate(ids)], [Codes.joined(codes)]
                    step = max(1, CELLS // len(ids[0]))
                    for i in range(lo, hi, step):
                        j = min(i + step, hi)
                        least, most = code.part(i, j).bounds(codes[0])
                        limit = np.partition(most, k, axis=1)[:, k] if most.shape[1] > k else np.full(j - i, np.inf)
                        q, p = np.nonzero(least <= limit[:, None])
                        held.append((own[i:j][q], ids[0][p], least[q, p], most[q, p]))
                        size += len(q)
                        if size > HELD_PAIRS:
                            held = [unbeaten(*map(np.concatenate, zip(*held)), k)]
                            size = len(held[0][0])
                            if size > HELD_PAIRS // 2:
                                yield pairs(held.pop())
                                size = 0
        if held:
            yield pairs(unbeaten(*map(np.concatenate, zip(*held)), k))

    def pairs(columns):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["qid", "pid", "least", "most"])

    def settle(batches):  # sorted by query and bound; of the last query only what is still unbeaten is held
        last = None
        for batch in batches:
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("qid", "pid", "least", "most")]
            if not len(batch):
                continue
            now = unbeaten(*(map(np.concatenate, zip(last, now)) if last else now), k)
            done = np.searchsorted(now[0], now[0][-1])
            yield pairs([c[:done] for c in now]).select(["qid", "pid"])
            last = [c[done:] for c in now]
        if last:
            yield pairs(last).select(["qid", "pid"])

    def distance(batches):
        for batch in batches:
            score = np.sqrt(((matrix(batch.column("vec"), dim) - matrix(batch.column("of_vec"), dim)) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([batch.column("qid"), batch.column("pid"), pa.array(score)], ["qid", "pid", "score"])

    def ranked(held: DataFrame, visits: DataFrame) -> DataFrame:
        found = (held.unionByName(visits).repartition("key", "blk").sortWithinPartitions("key", "blk", "kind")
                 .mapInArrow(search, "qid long, pid long, least double, most double"))
        # a written table: its size on disk decides whether the vectors' joins may broadcast it
        near = written(found.repartition("qid").sortWithinPartitions("qid", "most", "pid").mapInArrow(settle, "qid long, pid long"), "ann-pairs")
        exact = near.join(points.select("pid", "vec"), "pid").join(wanted.withColumnRenamed("vec", "of_vec"), "qid")
        return (exact.select("qid", "pid", "vec", "of_vec").mapInArrow(distance, "qid long, pid long, score double")
                .withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy("score", "pid"))).where(f"r <= {k + 1}"))

    def uncovered(batches):
        for batch in batches:
            vec = matrix(batch.column("vec"), dim)
            n, far = batch.column("n").to_numpy(zero_copy_only=False), batch.column("far").to_numpy(zero_copy_only=False)
            place = np.stack([p for _, _, p in places(vec)], 1)
            keep = [n[i] <= k or chance(place[i], far[i] / unit / width, probes) < cover for i in range(len(batch))]
            yield batch.select(["qid", "vec"]).filter(pa.array(keep, pa.bool_()))

    held = points.select(F.col("pid").alias("id"), "vec").mapInArrow(post, schema)
    visits = wanted.select(F.col("qid").alias("id"), "vec").mapInArrow(visit, schema)
    best = written(ranked(held, visits), "ann-found")
    # a query's own vector is always found: a list of k other ids has k + 1
    lengths = (best.join(points.select("pid", F.size("ids").alias("n")), "pid").groupBy("qid")
               .agg(F.sum("n").alias("n"), F.max("score").alias("far")))
    failed = written(wanted.join(lengths, "qid", "left").select("qid", "vec", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("far", F.lit(0.0)).alias("far"))
                     .mapInArrow(uncovered, wanted.select("qid", "vec").schema), "ann-failed")
    n_failed = failed.count()
    if n_failed:  # groups of queries against all points in blocks
        groups, blocks = -(-n_failed // block), -(-n_points // block)
        every = (points.select(F.col("pid").alias("id"), "vec").mapInArrow(only_coded, "id long, code binary")
                 .select(F.explode(F.expr(f"sequence(0L, {groups - 1}L)")).alias("key"),
                         F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("blk"), F.lit(0).alias("kind"), "id", "code"))
        each = (failed.select(F.col("qid").alias("id"), "vec").mapInArrow(only_coded, "id long, code binary")
                .select(F.pmod(F.xxhash64("id"), F.lit(groups)).cast("long").alias("key"),
                        F.explode(F.expr(f"sequence(0, {blocks - 1})")).alias("blk"), F.lit(1).alias("kind"), "id", "code"))
        best = best.join(failed.select("qid"), "qid", "left_anti").unionByName(ranked(every, each))
    named = best.join(points.select("pid", F.explode("ids").alias("found_id")), "pid")
    # the list of each distinct query vector serves every query that has it
    lists = (named.withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy("score", "found_id"))).where(f"r <= {k + 1}")
             .groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("score", "found_id"))).alias("near")))
    # the same vector again: equal arrays are compared by the smallest id that has them
    same = asked.join(wanted.withColumnRenamed("vec", "of_vec"), F.col("vec") == F.col("of_vec")).select("id", "qid")
    return (same.join(lists, "qid").select(F.col("id").alias("query_id"), F.expr(f"slice(filter(near, x -> x.found_id != id), 1, {k})").alias("near"))
            .select("query_id", F.posexplode("near").alias("rank", "hit"))
            .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("hit.found_id").alias("id"), F.col("hit.score").alias("score")))


def matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
