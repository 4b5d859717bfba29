"""Benchmark decontamination: BM25 inverted index of test items searched with block-max WAND.

Index: the test items' words (lower-cased, edge punctuation stripped) in postings with BM25 impacts,
each divided by the item's own score, so a passage that holds a whole item scores 1.  Items
are ordered by length and cut into blocks; a term keeps its largest impact per block and overall.

Queries: every training text is cut into passages of ``window`` words that overlap by half.  A
passage whose sum of term maxima stays below the threshold can match no item; the others
descend to the blocks by the sums of block maxima; in a block that is left, block-max WAND moves
pivots over the postings and scores each item in full.  Every item at or above ``threshold`` is
retrieved: the bounds are true upper bounds, so nothing above it is lost.

Verification: the item's question (its own column, or all but the last fifth of the words) must share at
least ``min_question`` of its five-word shingles with the whole text, and the answer (its own column, or the last
fifth) at least ``min_answer`` of its words with one stretch, twice as long as the item, of a passage that the
search returned; every such passage and every stretch of it is looked at.  Items of fewer words than a shingle use
the whole question as one.  Texts and items are lower-cased by the same function, in which a Greek final sigma is a sigma.

The items are read in shards of at most about ``max_items`` distinct texts and ``max_words`` words (one item
at least); each shard's index is bounded and sent to the tasks, and a larger benchmark makes further
passes, never a larger broadcast.  Items too long for half a window have shards of their own with wider
windows, so one long item does not widen the passages that the others are held against.  Null or
empty texts and items match nothing; repeated rows give repeated results; ties need no rule, since
all items above the threshold are returned.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import slices, small_batches, texts

EDGE = "".join(chr(c) for c in range(33, 128) if not chr(c).isalnum()) + "¿¡«»“”‘’„–—…"
SHINGLE = 5


def lowered(text: pa.Array) -> pa.Array:
    """Lists of the lower-case words between white space; the one lower-casing of texts and items."""
    return pc.utf8_split_whitespace(pc.replace_substring(pc.utf8_lower(pc.fill_null(text.cast(pa.string()), "")), "ς", "σ"))


def tokens(text: str | None) -> list[str]:
    """Words of a text as the index knows them."""
    return [w for w in (t.strip(EDGE) for t in lowered(pa.array([text], pa.string()))[0].as_py()) if w]


class Index:
    """BM25 postings of some items: (item, impact / own score), sorted by item, with block maxima."""

    def __init__(self, items: list[tuple], block: int = 8, k1: float = 1.2, b: float = 0.75):
        # (ids, question words, answer words); short items first: items of a block have like scores
        self.items = sorted(items, key=lambda x: (len(x[1]) + len(x[2]), x[0]))
        self.block = block
        self.n_blocks = -(-len(self.items) // block)
        words = [q + a for _, q, a in self.items]
        freq = [Counter(w) for w in words]
        df = Counter(t for f in freq for t in f)
        mean = sum(map(len, words)) / max(1, len(words))
        self.terms = {t: i for i, t in enumerate(sorted(df))}
        self.postings: list[tuple[list, list]] = [([], []) for _ in self.terms]
        for i, f in enumerate(freq):
            impact = {t: np.log(1 + (len(words) - df[t] + 0.5) / (df[t] + 0.5)) * c * (k1 + 1)
                      / (c + k1 * (1 - b + b * len(words[i]) / mean)) for t, c in f.items()}
            own = sum(impact.values())
            for t, v in impact.items():
                self.postings[self.terms[t]][0].append(i)
                self.postings[self.terms[t]][1].append(v / own)
        # row 0: a word the index lacks
        self.block_max = np.zeros((len(self.terms) + 1, self.n_blocks), np.float32)
        for t, (at, value) in enumerate(self.postings):
            np.maximum.at(self.block_max[t + 1], np.array(at) // block, np.array(value, np.float32))
        self.top = self.block_max.max(1, initial=0)
        self.longest = max(map(len, words), default=0)
        self.shingles = [self._shingles(q) for _, q, _ in self.items]

    @staticmethod
    def _shingles(words: list[str]) -> list[tuple]:
        n = min(SHINGLE, len(words))
        return list(dict.fromkeys(tuple(words[i: i + n]) for i in range(len(words) - n + 1))) if n else []

    def wand(self, terms: list[int], block: int, threshold: float) -> list[tuple[int, float]]:
        """Items of one block at or above ``threshold`` for the distinct terms (rows of block_max)."""
        lo, hi = block * self.block, (block + 1) * self.block
        lists = []
        for t in terms:
            if self.block_max[t, block] > 0:
                at, value = self.postings[t - 1]
                i = bisect_left(at, lo)
                lists.append([i, at, value, float(self.block_max[t, block])])
        found, near = [], threshold * (1 - 1e-6)
        while True:
            lists = [x for x in lists if x[0] < len(x[1]) and x[1][x[0]] < hi]
            lists.sort(key=lambda x: x[1][x[0]])
            bound, pivot = 0.0, None
            for k, x in enumerate(lists):
                bound += x[3]
                if bound >= near:
                    pivot = x[1][x[0]]
                    break
            if pivot is None:
                return found
            if lists[0][1][lists[0][0]] == pivot:
                score = sum(x[2][x[0]] for x in lists if x[1][x[0]] == pivot)
                if score >= near:
                    found.append((pivot, score))
                for x in lists:
                    x[0] += x[1][x[0]] == pivot
            else:
                for x in lists[:k]:
                    while x[0] < len(x[1]) and x[1][x[0]] < pivot:
                        x[0] += 1

    def search(self, rows: np.ndarray, doc: np.ndarray, window: int, threshold: float) -> dict[tuple[int, int], tuple[float, list[tuple[int, int]]]]:
        """(doc, item) -> best score over the doc's passages, and the passages (first word, end) that reach the
        threshold.  rows: block_max row of every word in order; doc: non-decreasing number of its text."""
        half = window // 2
        first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.empty(0, np.int64)
        size = np.diff(np.r_[first, len(doc)])
        per = np.maximum(1, -(-(size - half) // half))  # windows at every half, the last one reaches the end
        start = np.repeat(first, per) + (np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)) * half
        end = np.minimum(start + window, np.repeat(first + size, per))
        near, best = threshold * (1 - 1e-4), {}
        step = max(1, (1 << 16) // window)  # passages handled at a time
        for lo in range(0, len(start), step):
            at = start[lo: lo + step, None] + np.arange(window)
            inside = at < end[lo: lo + step, None]
            terms = np.sort(np.where(inside, rows[np.where(inside, at, 0)], 0), axis=1)
            terms[:, 1:][terms[:, 1:] == terms[:, :-1]] = 0  # each distinct term once
            left = np.flatnonzero(self.top[terms].sum(1) >= near)
            bounds = self.block_max[terms[left]].sum(1)
            for p, blk in zip(*np.nonzero(bounds >= near)):
                mine = terms[left[p]]
                for item, score in self.wand(mine[mine > 0].tolist(), int(blk), threshold):
                    p0 = int(start[lo + left[p]])
                    key, origin = (int(doc[p0]), item), int(first[np.searchsorted(first, p0, side="right") - 1])
                    top, where = best.get(key, (0.0, []))
                    best[key] = max(top, float(score)), [*where, (p0 - origin, int(end[lo + left[p]]) - origin)]
        return best

    def verify(self, words: list[str], item: int, passages: list[tuple[int, int]], min_question: float, min_answer: float):
        """(question overlap, answer overlap) of a whole text in which search found the item in ``passages``, or None."""
        _, question, answer = self.items[item]
        want = self.shingles[item]
        n = len(want[0]) if want else 0
        have = set(want)
        seen = {s for i in range(len(words) - n + 1) if (s := tuple(words[i: i + n])) in have} if n else set()
        asked = len(seen) / len(want) if want else 1.0
        if asked < min_question:
            return None
        need, span = Counter(answer), 2 * (len(question) + len(answer))
        answered = 0.0 if need else 1.0
        for lo, hi in passages:
            if answered == 1.0:
                break
            near, shared = Counter(), 0  # answer words in the stretch that ends at i
            for i in range(lo, hi):
                if i - span >= lo and (w := words[i - span]) in need:
                    near[w] -= 1
                    shared -= near[w] < need[w]
                if (w := words[i]) in need:
                    shared += near[w] < need[w]
                    near[w] += 1
                    answered = max(answered, shared / len(answer))
        return (asked, answered) if answered >= min_answer else None


def _items(benchmark: DataFrame, max_items: int, window: int, max_words: int = 100_000):
    """Shards of distinct items of like length as lists of (ids, question words, answer words)."""
    text = "text" if "text" in benchmark.columns else None
    q = F.col("question") if "question" in benchmark.columns else (F.col(text) if text else None)
    a = F.col("answer") if "question" in benchmark.columns and "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), q.cast("string").alias("q"), a.cast("string").alias("a"))
    one = rows.where("item_id is not null and (q is not null or a is not null)").groupBy("q", "a").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    one = one.withColumn("words", F.size(F.split(F.concat_ws(" ", "q", "a"), r"\s+")))
    # windows of the first class hold its items twice, those of each further class are four times as wide
    one = one.withColumn("span", F.ceil(F.greatest(F.lit(0.0), F.log2(F.col("words") * 2 / window) / 2)).cast("int"))
    sizes = one.groupBy("span").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("words")).orderBy("span").collect()
    for span, shards, k in [(s["span"], m, k) for s in sizes for m in [max(-(-s["n"] // max_items), -(-s["words"] // max_words))] for k in range(m)]:
        out = []
        for r in one.where((F.col("span") == span) & (F.pmod(F.xxhash64("q", "a"), F.lit(shards)) == k)).toLocalIterator():
            question, answer = tokens(r["q"]), tokens(r["a"])
            if r["a"] is None:
                cut = len(question) - len(question) // 5
                question, answer = question[:cut], question[cut:]
            if question or answer:
                out.append((tuple(r["ids"]), question, answer))
        if out:
            yield out


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 128,
                 threshold: float = 0.6, min_question: float = 0.5, min_answer: float = 0.5,
                 max_items: int = 4000) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): one row for each confirmed match."""
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    spark = docs.sparkSession
    rows = texts(docs, id_col, text_col).where("text is not null")
    found = spark.createDataFrame([], schema)
    for items in _items(benchmark, max_items, window):
        index = Index(items)
        # an item must lie whole inside one window
        found = found.unionByName(rows.mapInArrow(_task(spark.sparkContext.broadcast(index), max(window, 2 * index.longest),
                                                        threshold, min_question, min_answer), schema))
    return found


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = 128, threshold: float = 0.6,
          min_question: float = 0.5, min_answer: float = 0.5, max_items: int = 4000) -> DataFrame:
    """The rows of ``docs``, all columns, without a confirmed match."""
    for items in _items(benchmark, max_items, window):
        index = Index(items)
        shared = docs.sparkSession.sparkContext.broadcast(index)
        width = max(window, 2 * index.longest)

        def run(batches, shared=shared, width=width):
            for part in slices(batches, text_col):
                dirty = {d for d, _, _, _, _ in _matches(shared.value, part.column(text_col), width, threshold, min_question, min_answer)}
                yield part.filter(pa.array([d not in dirty for d in range(len(part))]))

        docs = small_batches(docs).mapInArrow(run, docs.schema)
    return docs


def _matches(index: Index, text: pa.Array, window, threshold, min_question, min_answer):
    """(row, item, score, question overlap, answer overlap) of every confirmed match of some texts."""
    words = lowered(text)
    flat = words.flatten().dictionary_encode()
    bare = [t.strip(EDGE) for t in flat.dictionary.to_pylist()]
    row_of = np.fromiter((-1 if not w else index.terms.get(w, -2) for w in bare), np.int64, len(bare)) + 1
    doc = np.repeat(np.arange(len(text)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    word = flat.indices.to_numpy(zero_copy_only=False)
    real = row_of[word] != 0  # nothing but punctuation is no word
    doc, word = doc[real], word[real]
    at, known = -1, []
    for (d, item), (score, passages) in sorted(index.search(np.maximum(row_of[word], 0), doc, window, threshold).items()):
        if d != at:
            at, known = d, [bare[i] for i in word[np.searchsorted(doc, d): np.searchsorted(doc, d, side="right")].tolist()]
        if (got := index.verify(known, item, passages, min_question, min_answer)):
            yield d, item, min(1.0, score), *got


def _task(shared, window, threshold, min_question, min_answer):
    def run(batches):
        for part in slices(batches, "text"):
            ids = part.column("doc_id")
            out = [(ids[d].as_py(), i, *rest) for d, item, *rest in _matches(shared.value, part.column("text"), window, threshold,
                                                                           min_question, min_answer) for i in shared.value.items[item][0]]
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                              *[pa.array(c, pa.float64()) for c in cols[2:]]],
                                             ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])
    return run
