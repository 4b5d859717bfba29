"""BPE encoding and decoding through a distinct-word table.

Split: texts are cut into the tokenizer's words (special-token strings whole), as its pre-tokenizer
cuts them.  Every block of texts numbers its distinct words and sends each once to the word's partition (one
partition holds all rows of a word, sorted), where each distinct word of the whole corpus is
encoded exactly once.  The ids return to the blocks and are joined by word number to the texts, which
travel as word numbers by position.  Decoding joins each id of a text with the id-to-piece table and reads the bytes as UTF-8.

Merges never cross words, so a word's ids do not depend on its text.  The only table that is sent
to all tasks is the tokenizer's own fixed vocabulary.  Null text counts as empty: no ids, empty
decoded text.  Repeated rows keep their rows.  Blocks are read twice and must hold the same
rows each time, as blocks of files and written tables do; if they do not, the query stops with an error.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.blocks import block_id, gathered
from tillroll.llm.common import texts

BLOCK_BYTES = 16 << 20
_LOADED: dict = {}


def byte_of_char() -> dict[str, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return table | {chr(256 + i): b for i, b in enumerate(rest)}


def _ranges(chars: list[str]) -> str:
    """The characters as ranges of a regular expression's class."""
    out: list[list[int]] = []
    for c in sorted(map(ord, chars)):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in out)


class Vocabulary:
    """A byte-level BPE tokenizer file: splitting, one word's ids, the piece of an id."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        chars = byte_of_char()
        self.pieces = {i: bytes(chars[c] for c in t) for t, i in spec["model"]["vocab"].items()}
        self.pieces |= {i: t.encode() for t, i in self.special.items()}
        self.names = {i: str(i) for i in self.pieces}
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # in these ranges every Unicode version has the same letters, numbers and spaces, so the pattern's classes can
        # be written out and the standard library's faster matcher cuts the words
        plain = [chr(c) for c in (*range(0x250), *range(0x2010, 0x2028), 0x20AC)]
        letter, number, space = (_ranges([c for c in plain if regex.match(x, c)]) for x in (r"\p{L}", r"\p{N}", r"\s"))
        spelled = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letter}{number}]").replace(r"\p{L}", f"[{letter}]")
        spelled = spelled.replace(r"\p{N}", f"[{number}]").replace(r"\s", f"[{space}]").replace(r"\S", f"[^{space}]")
        self.split = re.compile(spelled).findall
        self.settled = re.compile(f"[{_ranges(plain)}]*").fullmatch

    def words(self, text: str) -> list[str]:
        """The words of a text, in order; together they are the text."""
        if self.marks and any(m in text for m in self.special):
            return [w for part in self.marks.split(text) if part for w in ([part] if part in self.special else self._words(part))]
        return self._words(text)

    def _words(self, text: str) -> list[str]:
        if self.settled(text):
            return self.split(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def encode(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]


def vocabulary(path: str, pattern: str) -> Vocabulary:
    if _LOADED.get("path") != path:
        _LOADED.update(path=path, of=Vocabulary(path, pattern))
    return _LOADED["of"]


def numbered(part: pa.RecordBatch, vocab: Vocabulary) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words in order of appearance, number of the word at every position, words per text)."""
    number: dict[str, int] = {}
    at, sizes = [], []
    for text in part.column("text").to_pylist():
        words = vocab.words(text or "")
        sizes.append(len(words))
        at += [number.setdefault(w, len(number)) for w in words]
    return list(number), np.array(at, "<u4"), np.array(sizes, "<u4")


def squeezed(values: np.ndarray) -> bytes:
    """Unsigned integers as compressed byte planes."""
    return zstandard.ZstdCompressor(level=3).compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def opened(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def block_words(rows: DataFrame, path: str, pattern: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, number, word): the distinct words of every block."""
    def run(batches):
        vocab = vocabulary(path, pattern)
        for part in gathered(batches, "text", block_bytes):
            seen: dict[str, None] = {}
            for text in part.column("text").to_pylist():
                seen.update(dict.fromkeys(vocab.words(text or "")))
            words = list(seen)  # in the order in which ``numbered`` numbers them
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(words), block_id(part))), pa.array(np.arange(len(words), dtype=np.int32)),
                                              pa.array(words, pa.string())], ["block", "number", "word"])

    return rows.mapInArrow(run, "block long, number int, word string")


def block_positions(rows: DataFrame, path: str, pattern: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, docs, sizes, at): the texts of every block as word numbers by position."""
    def run(batches):
        vocab = vocabulary(path, pattern)
        for part in gathered(batches, "text", block_bytes):
            _, at, sizes = numbered(part, vocab)
            yield pa.RecordBatch.from_arrays([pa.array([block_id(part)], pa.int64()), pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                                              pa.array([squeezed(sizes)]), pa.array([squeezed(at)])], ["block", "docs", "sizes", "at"])

    return rows.mapInArrow(run, "block long, docs array<long>, sizes binary, at binary")


def word_ids(words: DataFrame, path: str, pattern: str, rows_at_once: int = 150_000) -> DataFrame:
    """(block, number[], n_ids[], ids[]), packed: each distinct word is encoded once, where all its rows meet;
    the ids go back in one row for each block and stretch of rows."""
    def run(batches):
        vocab = vocabulary(path, pattern)
        last: list = [None, None]  # a word's rows may go on in the next stretch
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= rows_at_once:
                yield encoded(pa.Table.from_batches(held).combine_chunks(), vocab, last)
                held, size = [], 0
        if size:
            yield encoded(pa.Table.from_batches(held).combine_chunks(), vocab, last)

    def encoded(table, vocab, last):
        word = table.column("word").combine_chunks().dictionary_encode()
        word = word.chunk(0) if isinstance(word, pa.ChunkedArray) else word
        known = word.dictionary.to_pylist()
        ids = ([last[1]] + vocab.encode(known[1:])) if known[0] == last[0] else vocab.encode(known)
        last[:] = known[-1], ids[-1]
        n_of = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for x in ids for i in x), np.int64, int(n_of.sum()))
        start_of = np.cumsum(n_of) - n_of
        block, number = (table.column(c).to_numpy() for c in ("block", "number"))
        order = np.lexsort((number, block))
        code = word.indices.to_numpy()[order]
        block, number = block[order], number[order]
        first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        out = [(int(block[lo]), squeezed(number[lo:hi]), squeezed(n_of[code[lo:hi]]), squeezed(flat[ragged(start_of[code[lo:hi]], n_of[code[lo:hi]])]))
               for lo, hi in zip(first, np.r_[first[1:], len(block)])]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["block", "number", "n_ids", "ids"])

    return (words.repartition("word").sortWithinPartitions("word")
            .mapInArrow(run, "block long, number binary, n_ids binary, ids binary"))


def ragged(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Indices start[0], start[0] + 1, ... (n[0] of them), start[1], ..."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, ids array<int>) of every row."""
    return _joined(docs, path, pattern, id_col, text_col, block_bytes, "doc_id long, ids array<int>", _ids)


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: encoded, then decoded from the ids."""
    return _joined(docs, path, pattern, id_col, text_col, block_bytes,
                   "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", _digests)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids): an id-to-piece join in the tasks (the table is the fixed
    vocabulary).  Null ids give empty text; an unknown id is an error."""
    def run(batches):
        pieces = vocabulary(path, pattern).pieces
        for part in batches:
            texts = [b"".join(map(pieces.__getitem__, ids or [])).decode("utf-8", "replace") for ids in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def _joined(docs, path, pattern, id_col, text_col, block_bytes, schema, result):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    out_schema = to_arrow_schema(StructType.fromDDL(schema))
    rows = texts(docs, id_col, text_col)
    table = word_ids(block_words(rows, path, pattern, block_bytes), path, pattern)
    positions = block_positions(rows, path, pattern, block_bytes)

    def join(words: pa.Table, rows: pa.Table):
        vocab = vocabulary(path, pattern)
        number, n, ids = (np.concatenate([opened(x) for x in words.column(c).to_pylist()] or [np.empty(0, "<u4")]).astype(np.int64)
                          for c in ("number", "n_ids", "ids"))
        # equal blocks (repeated rows) send the same words more than once
        number, order = np.unique(number, return_index=True)
        start, n = (np.cumsum(n) - n)[order], n[order]
        out = []
        for row in rows.to_pylist():
            at, sizes = opened(row["at"]), opened(row["sizes"])
            if len(at) and int(at.max()) + 1 != len(number):
                raise RuntimeError("a block and its words differ: the source deals its rows anew when it is read again")
            ends = np.cumsum(sizes, dtype=np.int64)
            for doc, lo, hi in zip(row["docs"], np.r_[0, ends[:-1]], ends):
                words = at[lo:hi]
                out.append((doc, *result(ids[ragged(start[words], n[words])], vocab)))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), out_schema.types)] if out else [pa.array([], t) for t in out_schema.types],
                        schema=out_schema)

    return table.groupBy("block").cogroup(positions.groupBy("block")).applyInArrow(join, schema)


def _ids(ids, vocab):
    return (ids.tolist(),)


def _digests(ids, vocab):
    ids = ids.tolist()
    text = b"".join(map(vocab.pieces.__getitem__, ids)).decode("utf-8", "replace")
    return (len(ids), hashlib.sha256(",".join(map(vocab.names.__getitem__, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
