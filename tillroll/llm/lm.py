"""Log-bilinear language model with noise-contrastive estimation; unigram base scores.

Tokens: texts lower-cased (A-Z), words split at ASCII white space, then one end token per text.

Counts cover every training text: each block of texts sends its distinct words with their counts once
to the word's partition, and the corpus counts come back to the blocks (blocks.py).  The base score of
a token is log10((c + 0.5) / (N + 0.5 (V + 1))).

Model: the ``head`` most frequent words, the end token and ``tails`` classes of the other words
(by a hash of their last two letters) are the classes of a log-bilinear model: the vectors of the
two classes before, each times its position's matrix, predict a vector, and a class scores by its
product with that vector plus a bias.  It starts from noise-contrastive estimation in numpy on at most
``fit_tokens`` tokens of training texts drawn by a hash (a text of more than ``PIECE_CHARS`` characters gives a
piece of that length from a place drawn by a hash), and is then trained on every token of every training
text: in each of ``ROUNDS`` rounds every block goes on from the shared parameters over its part of
the round, and the blocks' changes are averaged by tokens.  The parts of all rounds hold each token once,
whatever the size of the corpus.  A token's probability is the class's softmax
over all classes (batched matrix products over the distinct contexts of a block), times, for
a tail class, the word's share (c + 0.5) / (N_class + 0.5 (V_class + 1)) in it; so the
probabilities are normalised.

Null text counts as empty: one end token.  Repeated rows keep their rows; ties between head words go to
the smaller word; with no training text all counts are 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.blocks import BLOCK_BYTES, packed, unpack
from tillroll.llm.common import small_batches, written

HEAD, TAILS, DIM, CONTEXT = 959, 64, 24, 2
PIECE_CHARS = 20_000
ROUNDS = 6
NOISE = 256
STEP_ROWS = 512  # rows of a step whose noise scores are computed at a time
NAMES = ("r", "q", "m", "b")
FIXED = float(1 << 40)  # changes are summed as integers, so in any order


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """(text of every word, words) in order."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = lists.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    code = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if pc.index(flat.dictionary, pa.scalar("", flat.dictionary.type)).as_py() >= 0:
        empty = code == pc.index(flat.dictionary, pa.scalar("", flat.dictionary.type)).as_py()
        row, code = row[~empty], code[~empty]
    return row, pa.DictionaryArray.from_arrays(pa.array(code, pa.int32()), flat.dictionary)


def tail_class(word: str, tails: int = TAILS) -> int:
    """The class of a word outside the head: Spark's xxhash64 of its last two letters."""
    h = xxhash.xxh64_intdigest(word[-2:].encode(), 42)
    return (h - (1 << 64) if h >> 63 else h) % tails


def word_counts(blocks: DataFrame, tails: int) -> DataFrame:
    """(block, word, c, tail, first): corpus count of every distinct word of every block; ``first``
    holds for one row of each word."""
    def run(batches):
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload").to_pylist()):
                part = unpack(payload)
                row, words = words_of(part.column("text"))
                train = ~part.column("held_out").to_numpy(zero_copy_only=False)
                code = words.indices.to_numpy()
                n = np.bincount(code[train[row]], minlength=len(words.dictionary))
                seen = np.bincount(code, minlength=len(words.dictionary)) > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(int(seen.sum()), block)), words.dictionary.filter(pa.array(seen)).cast(pa.string()), pa.array(n[seen])],
                    ["block", "word", "n"])

    rows = blocks.mapInArrow(run, "block long, word string, n long")
    of_word = Window.partitionBy("word").orderBy("block")
    whole = of_word.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.select("block", "word", F.sum("n").over(whole).alias("c"),
                       F.pmod(F.xxhash64(F.expr("right(word, 2)")), F.lit(tails)).cast("int").alias("tail"),
                       (F.row_number().over(of_word) == 1).alias("first"))


def train(tokens: list[np.ndarray], classes: int, counts: np.ndarray, dim: int = DIM, epochs: int = 6, batch: int = 512,
          noise: int = 256, rate: float = 0.15, seed: int = 7) -> dict:
    """Parameters from sequences of class numbers (each ends with the end class, the last one).
    ``counts``: corpus counts of the classes, which are the noise distribution and the first bias."""
    rng = np.random.default_rng(seed)
    start = classes  # context before a text
    share = (counts + 0.5) / (counts + 0.5).sum()
    r = rng.normal(0, 0.1, (classes + 1, dim)).astype(np.float32)
    q = rng.normal(0, 0.1, (classes, dim)).astype(np.float32)
    m = np.stack([np.eye(dim) / (i + 1) for i in range(CONTEXT)]).astype(np.float32)
    b = np.log(share).astype(np.float32)
    seen = [np.full(x.shape, 1e-3, np.float32) for x in (r, q, m, b)]
    if tokens:
        ctx, word = contexts(tokens, start)
        for _ in range(epochs):
            descend([r, q, m, b], seen, ctx, word, (rng.integers(0, len(word), batch) for _ in range(0, len(word), batch)), share, rng, noise, rate)
    return {"r": r, "q": q, "m": m, "b": b, "seen": seen}


def descend(params: list[np.ndarray], seen: list[np.ndarray], ctx: np.ndarray, word: np.ndarray, picks, share: np.ndarray,
            rng: np.random.Generator, noise: int = 256, rate: float = 0.15) -> None:
    """One Adagrad step on ``params`` and their squared gradients ``seen``, in place, for each set of positions in ``picks``."""
    r, q, m, b = params
    log_noise = (np.log(share) + np.log(noise)).astype(np.float32)
    below = np.cumsum(share)

    def step(which, grads, at):
        order = np.argsort(at.astype(np.min_scalar_type(len(params[which[0]]))), kind="stable")  # short integers sort faster
        at = at[order]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        rows = at[first]
        for k, grad in zip(which, grads):
            g = np.add.reduceat(grad[order], first, axis=0)
            now = seen[k][rows] + g * g
            seen[k][rows] = now
            params[k][rows] += rate * g / np.sqrt(now)

    dim, ones = r.shape[1], np.ones((STEP_ROWS, 1), np.float32)
    fake = np.empty((STEP_ROWS, noise), np.float32)
    for pick in picks:
        c, w, batch = ctx[pick], word[pick], len(pick)
        other = np.minimum(np.searchsorted(below, rng.random(noise) * below[-1], side="right"), len(share) - 1)
        vec = [r[c[:, i]] for i in range(CONTEXT)]
        h = sum(v @ m[i] for i, v in enumerate(vec))
        qw, qo = q[w], q[other]
        true = 1 / (1 + np.exp(np.clip(np.einsum("ij,ij->i", h, qw) + b[w] - log_noise[w], -30, 30)))  # 1 - P(data)
        true = (true / batch).astype(np.float32)
        back = true[:, None] * qw
        # P(data) of the noise, in place, from the negated odds; the exponent's overflow is a probability of 0.  Some
        # rows at a time, which stay in the processor's cache; a column of ones adds the bias and sums the rows
        odds = np.concatenate((-qo, (log_noise[other] - b[other])[:, None]), 1).T
        down = np.zeros((noise, dim + 1), np.float32)
        for lo in range(0, batch, STEP_ROWS):
            some = np.concatenate((h[lo: lo + STEP_ROWS], ones[: batch - lo]), 1)
            f = np.matmul(some, odds, out=fake[: len(some)])
            with np.errstate(over="ignore"):
                np.exp(f, out=f)
            f += 1
            np.divide(np.float32(1 / batch), f, out=f)
            back[lo: lo + STEP_ROWS] -= f @ qo
            down += f.T @ some
        both = np.concatenate((w, other))
        grad = np.concatenate((true[:, None] * h, -down[:, :dim]))
        step((1, 3), (grad, np.concatenate((true, -down[:, dim]))), both)
        step((0,), (np.concatenate([back @ m[i].T for i in range(CONTEXT)]),), np.concatenate([c[:, i] for i in range(CONTEXT)]))
        grad = np.stack([v.T @ back for v in vec])
        seen[2] += grad * grad
        m += rate * grad / np.sqrt(seen[2])


def classed(blocks: DataFrame, known: list[str], tails: int) -> DataFrame:
    """(block, payload): the class numbers of all training texts of every block, each text with its end."""
    shared = blocks.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        head = pa.array(shared.value, pa.string())
        end = len(head) + tails
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload").to_pylist()):
                part = unpack(payload)
                part = part.filter(pc.invert(part.column("held_out")))
                row, words = words_of(part.column("text"))
                known = words.dictionary.cast(pa.string())
                last = pc.utf8_slice_codeunits(known, -2).dictionary_encode()
                tail = np.array([tail_class(x, tails) for x in last.dictionary.to_pylist()], np.int64)
                spot = pc.fill_null(pc.index_in(known, value_set=head), -1).to_numpy(zero_copy_only=False)
                cls = np.where(spot >= 0, spot, len(head) + tail[last.indices.to_numpy()]) if len(known) else np.empty(0, np.int64)
                line = np.insert(cls[words.indices.to_numpy()], np.searchsorted(row, np.arange(len(part)), side="right"), end)
                packed_line = zstandard.ZstdCompressor(level=1).compress(line.astype("<i4").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([packed_line], pa.binary())], ["block", "payload"])

    return blocks.mapInArrow(run, "block long, payload binary")


def refine(lines: DataFrame, model: dict, counts: np.ndarray, n_tokens: int, noise: int) -> dict:
    """``model`` trained once on every token of ``lines``, a ``ROUNDS``-th of every block in each round."""
    sc, classes, parts = lines.sparkSession.sparkContext, len(counts), ROUNDS
    share = (counts + 0.5) / (counts + 0.5).sum()
    now = [model[x] for x in NAMES] + model["seen"]
    usual = n_tokens / parts
    learnt = 0
    for number in range(ROUNDS):
        shared = sc.broadcast((now, share))

        def change(batches, shared=shared, turn=number):
            start, share = shared.value
            total, n = np.zeros(sum(x.size for x in start), np.int64), 0
            for batch in batches:
                for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload").to_pylist()):
                    line = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), "<i4").astype(np.int64)
                    if not len(line):
                        continue
                    lo, hi = len(line) * turn // parts, len(line) * (turn + 1) // parts
                    ctx, word = part_contexts(line, lo, hi, classes)
                    rng = np.random.default_rng([block, turn])
                    order = rng.permutation(hi - lo)
                    size = int(np.clip((hi - lo) // 64, 64, 2048))
                    x = [p.copy() for p in start]
                    descend(x[:4], x[4:], ctx, word, (order[i: i + size] for i in range(0, len(order), size)), share, rng, noise)
                    total += np.rint(np.concatenate([(p.astype(float) - q).ravel() for p, q in zip(x, start)])
                                     * ((hi - lo) / usual * FIXED)).astype(np.int64)
                    n += hi - lo
            yield summed(total, n)

        def add(batches):
            total, n = 0, 0
            for batch in batches:
                for payload, m in zip(batch.column("payload").to_pylist(), batch.column("n").to_pylist()):
                    total, n = total + np.frombuffer(payload, "<i8"), n + m
            if n:
                yield summed(total, n)

        total, n = 0, 0
        for row in lines.mapInArrow(change, "payload binary, n long").repartition(8).mapInArrow(add, "payload binary, n long").toLocalIterator():
            total, n = total + np.frombuffer(row["payload"], "<i8"), n + row["n"]
        learnt += n
        if n:
            cuts = np.cumsum([x.size for x in now])[:-1]
            now = [(x + d.reshape(x.shape) / FIXED * (usual / n)).astype(np.float32) for x, d in zip(now, np.split(total, cuts))]
        shared.unpersist()
    if learnt != n_tokens:
        raise RuntimeError(f"the model learnt from {learnt} tokens, not from {n_tokens}")
    return dict(zip(NAMES, now))


def summed(total: np.ndarray, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([total.astype("<i8").tobytes()], pa.binary()), pa.array([n], pa.int64())], ["payload", "n"])


def contexts(tokens: list[np.ndarray], start: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, CONTEXT) classes before each position, and the class there."""
    pad = np.full(CONTEXT, start, np.int64)
    line = np.concatenate([x for t in tokens for x in (pad, t)]) if tokens else np.empty(0, np.int64)
    size = np.array([len(t) for t in tokens], np.int64)
    at = np.arange(size.sum()) + np.repeat(CONTEXT * np.arange(1, len(size) + 1), size)
    return np.stack([line[at - 1 - i] for i in range(CONTEXT)], 1), line[at]


def part_contexts(line: np.ndarray, lo: int, hi: int, start: int) -> tuple[np.ndarray, np.ndarray]:
    """``contexts`` of the positions ``lo`` to ``hi`` of ``line``, in which every text ends with the class ``start`` - 1."""
    head = np.concatenate((np.full(CONTEXT, start - 1, np.int64), line[max(0, lo - CONTEXT): hi]))[-(hi - lo + CONTEXT):]
    out, inside = np.empty((hi - lo, CONTEXT), np.int64), np.ones(hi - lo, bool)
    for i in range(CONTEXT):
        before = head[CONTEXT - 1 - i: len(head) - 1 - i]
        inside &= before != start - 1  # an end before here: another text
        out[:, i] = np.where(inside, before, start)
    return out, line[lo:hi]


def log_probabilities(model: dict, ctx: np.ndarray, word: np.ndarray, chunk: int = 256) -> np.ndarray:
    """Natural log of the normalised probability of each class after its context."""
    classes = len(model["b"])
    # vectors with a last 1 for the bias; where no score can overflow, none has to be shifted by the largest one
    weights = np.concatenate((model["q"], model["b"][:, None]), 1).T.astype(np.float32)
    reach = sum(np.linalg.norm(model["r"] @ m, axis=1).max() for m in model["m"]) * np.linalg.norm(model["q"], axis=1).max() + np.abs(model["b"]).max()
    small = reach < 60
    key = ctx[:, 0]
    for i in range(1, CONTEXT):
        key = key * (classes + 1) + ctx[:, i]
    order = np.argsort(key, kind="stable")
    new = np.r_[True, key[order][1:] != key[order][:-1]] if len(key) else np.empty(0, bool)
    first = order[new]
    group = np.cumsum(new) - 1
    out = np.empty(len(word))
    cuts = np.searchsorted(group, np.arange(0, len(first) + chunk, chunk))
    for k, lo in enumerate(range(0, len(first), chunk)):
        c = ctx[first[lo: lo + chunk]]
        h = sum(model["r"][c[:, i]] @ model["m"][i] for i in range(CONTEXT))
        logits = np.concatenate((h, np.ones((len(h), 1), np.float32)), 1) @ weights
        if not small:
            logits -= logits.max(1, keepdims=True)
        mine = order[cuts[k]: cuts[k + 1]]
        at = group[cuts[k]: cuts[k + 1]] - lo
        out[mine] = logits[at, word[mine]]
        np.exp(logits, out=logits)
        out[mine] -= np.log(logits.sum(1))[at]
    return out


def scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD, tails: int = TAILS,
           fit_tokens: int = 400_000, block_bytes: int = BLOCK_BYTES, noise: int = NOISE) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; rows for which
    ``held_out`` holds are not learnt from.  ``noise``: noise words a step in the rounds over the corpus."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), held_out.alias("held_out"))
    blocks = written(packed(small_batches(rows), "text", block_bytes), "lm-blocks")
    counts = written(word_counts(blocks, tails), "lm-counts")

    texts = rows.where(~F.col("held_out"))
    n_texts = texts.count()
    once = counts.where("first and c > 0")
    top = once.orderBy(F.desc("c"), "word").limit(head).select("word", "c", "tail").collect()
    mass, size = np.zeros(tails), np.zeros(tails)
    for r in once.groupBy("tail").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect():
        mass[r["tail"]], size[r["tail"]] = r["c"], r["v"]
    n_tokens, v_tokens = int(mass.sum()) + n_texts, int(size.sum()) + (n_texts > 0)
    for r in top:  # what is left in the tail classes
        mass[r["tail"]] -= r["c"]
        size[r["tail"]] -= 1
    known = [r["word"] for r in top]
    place = {w: i for i, w in enumerate(known)}
    classes = len(known) + tails + 1  # head, tails, end
    corpus = np.concatenate(([r["c"] for r in top], mass, [n_texts]))

    model = train(_sample(texts, place, len(known), tails, classes, n_texts, fit_tokens), classes, corpus)
    model = refine(written(classed(blocks, known, tails), "lm-classes"), model, corpus, n_tokens, noise) if n_tokens else {x: model[x] for x in NAMES}
    model |= {"known": known, "mass": mass, "size": size, "n": n_tokens, "v": v_tokens, "ends": n_texts, "tails": tails}
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def run(words: pa.Table, texts: pa.Table):
        out = [_score(unpack(p), words, shared.value) for p in texts.column("payload").to_pylist()]
        return pa.concat_tables(out) if out else _score(None, words, shared.value)

    return counts.select("block", "word", "c", "tail").groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(run, schema)


def _sample(texts: DataFrame, place: dict, n_head: int, tails: int, classes: int, n_texts: int, fit_tokens: int) -> list[np.ndarray]:
    """Sequences of class numbers of training texts drawn by a hash: at most ``fit_tokens`` tokens."""
    parts = 1 << 20
    want = min(parts, max(1, round(parts * 3000 / max(1, n_texts))))
    few = texts.select(F.xxhash64("text").alias("h"), "text").where(F.pmod("h", F.lit(parts)) < want).where("text is not null")
    place_at = F.pmod(F.xxhash64("h"), F.greatest(F.lit(1), F.length("text") - PIECE_CHARS + 1)).cast("int") + 1
    few = few.dropDuplicates(["h"]).withColumn("text", F.substring("text", place_at, F.lit(PIECE_CHARS))).orderBy("h").limit(4000)
    out, total = [], 0
    for r in few.toLocalIterator():
        words = [w.decode() for w in r["text"].encode().lower().split()]
        seq = np.array([place[w] if w in place else n_head + tail_class(w, tails) for w in words] + [classes - 1], np.int64)
        out.append(seq[: max(1, fit_tokens - total)])
        total += len(out[-1])
        if total >= fit_tokens:
            break
    return out


def _score(part: pa.RecordBatch | None, words: pa.Table, model: dict) -> pa.Table:
    """Scores of the texts of one block; ``words``: its distinct words with corpus counts."""
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    if part is None:
        types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table([pa.array([], t) for t in types], names=names)
    n, v, ends, tails, n_head = model["n"], model["v"], model["ends"], model["tails"], len(model["known"])
    classes = n_head + tails + 1
    row, tokens = words_of(part.column("text"))
    known = tokens.dictionary.cast(pa.string())
    at = pc.index_in(known, value_set=words.column("word").combine_chunks())
    if at.null_count and len(np.unique(tokens.indices.to_numpy())) > len(known) - at.null_count:
        raise RuntimeError("a block lost words")
    at = pc.fill_null(at, 0).to_numpy(zero_copy_only=False)
    count = words.column("c").to_numpy()[at] if len(words) else np.empty(0, np.int64)
    tail = words.column("tail").to_numpy()[at] if len(words) else np.empty(0, np.int64)
    spot = pc.fill_null(pc.index_in(known, value_set=pa.array(model["known"], pa.string())), -1).to_numpy(zero_copy_only=False)
    cls = np.where(spot >= 0, spot, n_head + tail).astype(np.int64)
    inner = np.where(spot >= 0, 0.0, np.log10((count + 0.5) / (model["mass"][tail] + 0.5 * (model["size"][tail] + 1))))
    base = np.log10((count + 0.5) / (n + 0.5 * (v + 1)))
    code = tokens.indices.to_numpy()
    m = len(part)
    size = np.bincount(row, minlength=m)
    seqs = np.split(cls[code], np.cumsum(size)[:-1]) if m else []
    ctx, word = contexts([np.append(s, classes - 1) for s in seqs], classes)
    log_p = log_probabilities(model, ctx, word) / np.log(10)
    by_text = np.bincount(np.repeat(np.arange(m), size + 1), log_p, m) + np.bincount(row, inner[code], m)
    return pa.table([part.column("doc_id"), part.column("held_out"), pa.array(size + 1, pa.int64()),
                     pa.array(np.bincount(row, (count > 0)[code], m).astype(np.int64) + (ends > 0)),
                     pa.array(np.full(m, n, np.int64)),
                     pa.array(np.bincount(row, base[code], m) + np.log10((ends + 0.5) / (n + 0.5 * (v + 1)))),
                     pa.array(by_text)], names=names)
