"""Language identification by cross-parsing entropy (suffix automata, longest matches).

Learning: labelled texts are reduced to their letters (lower-cased, every other run one space).
For each language a bounded sample of at most ``sample_chars`` symbols (pieces of at most
``piece_chars`` symbols of distinct texts, drawn by a hash of the text) is made into a suffix
automaton by one Spark task per language.

Prediction: a text is parsed greedily against each automaton: the longest match with any substring
of the language's sample, then the next phrase from there (a symbol the sample lacks is a phrase
of its own).  A language's normalised phrases are phrases x log2(sample size) / symbols, the
cross-parsing estimate of bits per symbol; the fewest wins, ties to the smaller label.  Parsing
starts anew every ``BLOCK`` symbols, so any number of blocks of long and short texts is parsed side
by side as arrays.  All of a text is parsed.

Null text, or text with no letter: ``und``, score 0.  A language with no learnt letter is not a
candidate; with no candidate at all every text is ``und``.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import slices, small_batches, texts

BLOCK = 1024
SAMPLE_CHARS = 32768
PIECE_CHARS = 1024
FLAG = np.int32(1 << 30)
UND = "und"


def letter_table() -> np.ndarray:
    """Code point -> lower-case letter's code point; 32 (space) where it is no letter."""
    table = np.full(sys.maxunicode + 1, 32, np.int32)
    for cp in range(sys.maxunicode + 1):
        ch = chr(cp)
        if unicodedata.category(ch)[0] == "L":
            low = ch.lower()
            table[cp] = ord(low) if len(low) == 1 else cp
    return table


_TABLES: dict = {}


def letters() -> np.ndarray:
    if "letters" not in _TABLES:
        _TABLES["letters"] = letter_table()
    return _TABLES["letters"]


def symbols(text: str) -> np.ndarray:
    """Lower-case letters of ``text``; every other run is one space, none at the ends."""
    cps = letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    space = cps == 32
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    cps = cps[keep]
    if len(cps) and cps[0] == 32:
        cps = cps[1:]
    return cps[:-1] if len(cps) and cps[-1] == 32 else cps


def suffix_automaton(pieces: list[np.ndarray]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings of ``pieces`` (state 0 is the root)."""
    nxt, link, length = [{}], [-1], [0]
    for piece in pieces:
        last = 0
        for c in piece.tolist():
            if c in nxt[last]:
                q = nxt[last][c]
                if length[q] == length[last] + 1:
                    last = q
                    continue
                clone = len(nxt)
                nxt.append(dict(nxt[q])), link.append(link[q]), length.append(length[last] + 1)
                link[q], p = clone, last
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                last = clone
                continue
            cur = len(nxt)
            nxt.append({}), link.append(0), length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                if length[q] == length[p] + 1:
                    link[cur] = q
                else:
                    clone = len(nxt)
                    nxt.append(dict(nxt[q])), link.append(link[q]), length.append(length[p] + 1)
                    while p >= 0 and nxt[p].get(c) == q:
                        nxt[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
    return nxt


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
          sample_chars: int = SAMPLE_CHARS, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """(lang, n_symbols, n_states, state[], symbol[], next[]): one automaton per language.

    The sample is bounded: per language distinct texts enter by the smallest hash of the text
    until about four times the pieces needed are at hand, and the first ``sample_chars`` symbols
    of pieces are learnt.  Rows with null text or language are left out."""
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where("lang is not null and text rlike '\\\\p{L}'")
    want = 4 * (sample_chars // piece_chars)
    # hashes only: the texts themselves are read again for the few rows that are drawn
    drawn = (rows.select("lang", F.xxhash64("text").alias("h")).distinct()
             .withColumn("bucket", F.pmod("h", F.lit(16)).cast("int"))
             .withColumn("r", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy("h"))).where(f"r <= {want}")
             .withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(f"r <= {want}")
             .groupBy("lang").agg(F.max("h").alias("most")))
    few = rows.withColumn("h", F.xxhash64("text")).join(F.broadcast(drawn), "lang").where("h <= most")
    # a fixed piece from the middle of each drawn text bounds what a group holds
    piece = (few.withColumn("at", F.greatest(F.lit(1), F.floor(F.length("text") / 2) - piece_chars).cast("int"))
             .select("lang", "h", F.substring("text", F.col("at"), F.lit(2 * piece_chars)).alias("text"))
             .dropDuplicates(["lang", "h"]))

    def build(pdf):
        pieces, total = [], 0
        for text in pdf.sort_values("h")["text"]:
            piece = symbols(text)[: min(piece_chars, sample_chars - total)]
            if len(piece):
                pieces.append(piece)
                total += len(piece)
            if total >= sample_chars:
                break
        nxt = suffix_automaton(pieces)
        edges = [(s, c, t) for s, out in enumerate(nxt) for c, t in out.items()]
        s, c, t = (list(x) for x in zip(*edges)) if edges else ([], [], [])
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "n_symbols": [total], "n_states": [len(nxt)],
                             "state": [s], "symbol": [c], "next": [t]})

    import pandas as pd
    return piece.groupBy("lang").applyInPandas(
        build, "lang string, n_symbols long, n_states long, state array<int>, symbol array<int>, next array<int>")


class Parser:
    """Dense transition tables of some automata over their common alphabet.

    An entry holds the next state's row offset; FLAG marks the start of a phrase.  Symbol 0 is
    padding (back to the root, no phrase), symbol 1 any symbol outside the alphabet."""

    def __init__(self, models: list[dict]):
        self.langs = [m["lang"] for m in models]
        self.bits = [float(np.log2(max(2, m["n_symbols"]))) for m in models]
        alphabet = np.unique(np.concatenate([m["symbol"] for m in models] or [np.empty(0, np.int32)])).tolist()
        self.code = np.full(sys.maxunicode + 1, 1, np.uint8 if len(alphabet) < 250 else np.int32)
        self.code[alphabet] = np.arange(2, len(alphabet) + 2)
        self.width = w = len(alphabet) + 2
        self.tables = []
        for m in models:
            if m["n_states"] * w >= int(FLAG):
                raise ValueError("the sample and its alphabet are too large for one table")
            state, nxt = np.asarray(m["state"], np.int64), np.asarray(m["next"], np.int64)
            sym = self.code[np.asarray(m["symbol"], np.int64)].astype(np.int64)
            root = np.full(w, FLAG, np.int32)
            first = state == 0
            root[sym[first]] = (nxt[first] * w).astype(np.int32) | FLAG
            root[0] = 0
            table = np.tile(root, (m["n_states"], 1))
            inner = ~first
            table[state[inner], sym[inner]] = (nxt[inner] * w).astype(np.int32)
            self.tables.append(table.ravel())

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """(texts, languages): phrases of each text's symbols."""
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        sizes = np.array([len(t) for t in texts], np.int64)
        if not sizes.sum():
            return out
        # lanes of at most BLOCK symbols, longest first, so that those still running are a prefix
        per = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), per)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
        start = np.repeat(np.cumsum(sizes) - sizes, per) + nth * BLOCK
        run = np.minimum(BLOCK, sizes[owner] - nth * BLOCK)
        order = np.argsort(-run, kind="stable")
        owner, start, run = owner[order], start[order], run[order]
        codes = self.code[np.concatenate(texts)]
        alive = np.searchsorted(-run, -np.arange(1, run[0] + 1), side="right")
        for k, table in enumerate(self.tables):
            state = np.zeros(len(run), np.int32)
            count = np.zeros(len(run), np.int32)
            for step in range(run[0]):
                m = alive[step]
                got = table[state[:m] + codes[start[:m] + step]]
                count[:m] += got >> 30
                state[:m] = got & (FLAG - 1)
            out[:, k] = np.bincount(owner, count, len(texts))
        return out

    def judge(self, texts: list[str | None]):
        """Per text: label, score, normalised phrases (bits per symbol) of the winner."""
        parts = [symbols(t) if t else np.empty(0, np.int32) for t in texts]
        size = np.array([len(p) for p in parts], float)
        if not self.langs:
            return [UND] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        rate = self.phrases(parts) * np.array(self.bits) / np.maximum(size, 1)[:, None]
        best = rate.argmin(1)
        low = rate[np.arange(len(best)), best]
        share = 1 / np.exp2(low[:, None] - rate).sum(1)
        known = size > 0
        return [self.langs[b] if k else UND for b, k in zip(best, known)], np.where(known, share, 0.0), np.where(known, low, 0.0)


def _collected(model: DataFrame) -> list[dict]:
    out = []
    for r in model.toArrow().to_pylist():
        if r["n_symbols"]:
            arrays = {c: np.array(r[c], np.int32) for c in ("state", "symbol", "next")}
            key = hash((r["lang"], *(a.tobytes() for a in arrays.values())))
            out.append({"lang": r["lang"], "n_symbols": r["n_symbols"], "n_states": r["n_states"], "key": key, **arrays})
    return sorted(out, key=lambda m: m["lang"])


def _parser(models: list[dict]) -> Parser:
    key = [m["key"] for m in models]
    if _TABLES.get("of") != key:
        _TABLES.update(of=key, parser=Parser(models))
    return _TABLES["parser"]


def identify(docs: DataFrame, model: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, bits): one row for each row of ``docs``.  ``score`` is the winner's
    share of 2^-bits over the languages.  The model is one bounded row for each language."""
    shared = docs.sparkSession.sparkContext.broadcast(_collected(model))

    def run(batches):
        parser = _parser(shared.value)
        for part in slices(batches, "text"):
            lang, score, bits = parser.judge(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score), pa.array(bits)],
                ["doc_id", "lang_pred", "score", "bits"])

    rows = texts(docs, id_col, text_col)
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, bits double")


def accepted(docs: DataFrame, model: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language: rejected are ``und`` and texts
    that no learnt language's sample describes better than its bare alphabet does (normalised
    phrases above log2 of the alphabet's size, by more than one phrase)."""
    shared = docs.sparkSession.sparkContext.broadcast(_collected(model))

    def run(batches):
        parser = _parser(shared.value)
        ceiling = np.log2(parser.width)
        for part in slices(batches, text_col):
            texts = part.column(text_col).to_pylist()
            lang, _, bits = parser.judge(texts)
            slack = np.array([max(parser.bits, default=0.0) / max(1, len(t or "")) for t in texts])
            yield part.filter(pa.array(np.array([x != UND for x in lang], bool) & (bits <= ceiling + slack)))

    return small_batches(docs).mapInArrow(run, docs.schema)
