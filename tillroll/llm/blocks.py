"""Blocks of texts and their distinct words.

Looking a value up for every token of a corpus by a join would move every token.  Instead
the texts are packed into blocks (some MB of text each, one row, compressed); a block sends each of its
distinct words once to the word's partition, where the value of a word is found once for all blocks,
and the values return to their block.  Work and traffic follow the distinct words of blocks, a word
that every document holds is one row per block, and no group is larger than one block or the blocks of a word.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame

from tillroll.llm.common import slices

BLOCK_BYTES = 8 << 20
PACKED = "block long, payload binary"


def serial(part: pa.RecordBatch) -> pa.Buffer:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, part.schema) as out:
        out.write_batch(part)
    return sink.getvalue()


def block_id(part: pa.RecordBatch) -> int:
    """A hash of the rows: the same rows get the same block however often a task runs."""
    return xxhash.xxh64_intdigest(serial(part), 7) >> 1


def pack(part: pa.RecordBatch) -> tuple[int, bytes]:
    """(block id, compressed rows)."""
    return block_id(part), zstandard.ZstdCompressor(level=3).compress(serial(part))


def unpack(payload: bytes) -> pa.RecordBatch:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    with pa.ipc.open_stream(raw) as rows:
        return pa.concat_batches(list(rows))


def compact(part: pa.RecordBatch) -> pa.RecordBatch:
    """A copy without the rows outside a slice."""
    return part.take(pa.array(range(len(part)), pa.int64()))


def packed(rows: DataFrame, text: str = "text", limit: int = BLOCK_BYTES) -> DataFrame:
    """(block, payload): the rows of each partition in blocks of at most ``limit`` bytes of text."""
    def run(batches):
        for part in gathered(batches, text, limit):
            block, payload = pack(part)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([payload], pa.binary())], ["block", "payload"])

    return rows.mapInArrow(run, PACKED)


def gathered(batches, text: str, limit: int):
    """Slices of a task's rows put together up to ``limit`` bytes of text, so that small batches
    make no small blocks."""
    held, size = [], 0
    for part in slices(batches, text, limit):
        n = pa.compute.sum(pa.compute.binary_length(part.column(text))).as_py() or 0
        if held and size + n > limit:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(compact(part))
        size += n
    if held:
        yield pa.concat_batches(held)
