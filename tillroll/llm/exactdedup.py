"""Exact duplicates by deterministic block naming, in DataFrame operations only.

Texts are normalised (A-Z lower-cased, nothing else; null counts as empty) and cut into blocks of
``block_bytes`` bytes.  The distinct blocks are sorted and get integer names: equal blocks one name, different
blocks different names.  Then, level by level, each document's adjacent names are paired (a last one without a partner
pairs with nothing), the distinct pairs are sorted and get integer names, until each document has one
name.  (level, name) is the document's identity: two documents share it if and only if their
normalised texts are equal byte by byte.  No hash decides: blocks are told apart by their content.

Work: the distinct blocks are found with a map-side combine, so a text or passage with any number of copies crosses
the shuffle once a task, and the whole corpus crosses once.  A block's occurrences find its name by the
block's hash, which is exact because the table of names holds all blocks: where a hash belongs to two blocks, its
occurrences carry the content and are matched by it.  From then on a document is 8 bytes a block, and a
level halves that.

Hot names (a third of all documents may be copies): a table of names knows how often each is used.
Names with more than 1 / ``HEAVY`` of all uses number less than ``HEAVY``, so they are broadcast; the others are joined
by a shuffle, in which no key has more than that share.

Of equal texts the row with the largest id stays, a null id being smaller than any; of repeated rows of
that id one stays.  Every row is returned, also rows with a null or repeated id.  Texts of any length take
log2(length / block_bytes) levels.  An empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import HEAVY, looked_up, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A-Z lower-cased.  Where all characters are ASCII, lower() does the same and is faster."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def named(keys: DataFrame, by: list[str], purpose: str) -> DataFrame:
    """(by..., n, name): each distinct key, how often it stands in ``keys``, and its name, an integer that
    follows the sorted order of the keys inside each partition of keys."""
    distinct = keys.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return written(distinct.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id()), purpose)


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 4096, hash_bits: int = 64) -> DataFrame:
    """(row, doc_id, text_sha256, level, name): the identity of every row's text; ``row`` numbers the rows of
    the result.  ``hash_bits``: bits of the block hash that are used (fewer make collisions, for tests)."""
    mask = (1 << hash_bits) - 1 if hash_bits < 64 else -1
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("text"))
    starts, cut = f"sequence(0, greatest(octet_length(text) - 1, 0), {block_bytes})", f"substring(cast(text as binary), at + 1, {block_bytes})"
    blocks = rows.select(F.explode(F.expr(f"transform({starts}, at -> {cut})")).alias("block"))
    names = named(blocks.select(F.expr(f"xxhash64(block) & {mask}L").alias("hash"), "block"), ["hash", "block"], "block-names")

    shared = [r["hash"] for r in names.groupBy("hash").count().where("count > 1").select("hash").limit(HEAVY + 1).collect()]
    if len(shared) <= HEAVY:
        ambiguous = "array_contains(array(" + ", ".join(f"{h}L" if h > -(1 << 63) else f"{h + 1}L - 1L" for h in shared) + "), {})" if shared else "false"
    else:  # every block carries its content
        ambiguous = "true"
    content = lambda h, block: f"if({ambiguous.format(h)}, {block}, cast('' as binary))"
    names = names.select("hash", F.expr(content("hash", "block")).alias("content"), "n", "name")
    keyed = (f"transform(transform({starts}, at -> {cut}), b -> struct(xxhash64(b) & {mask}L as hash, "
             f"{content(f'(xxhash64(b) & {mask}L)', 'b')} as content))")
    base = written(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.sha2("text", 256).alias("text_sha256"),
                               F.expr(keyed).alias("blocks")), "block-rows")
    used = base.select("row", F.size("blocks").alias("left"), F.posexplode("blocks").alias("pos", "b")).select("row", "left", "pos", "b.hash", "b.content")
    now = written(looked_up(used, names, ["hash", "content"], ["name"]).select("row", "left", "pos", "name"), "block-level")
    level, done = 0, []
    while True:
        done.append(now.where("left = 1").select("row", F.lit(level).alias("level"), "name"))
        going = now.where("left > 1")
        if going.isEmpty():
            break
        pairs = written(going.groupBy("row", F.expr("pos div 2").cast("int").alias("pos"))
                        .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                             F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
                             F.max(F.expr("(left + 1) div 2")).cast("int").alias("left")), "block-pairs")
        level += 1
        now = written(looked_up(pairs, named(pairs.select("a", "b"), ["a", "b"], "pair-names"), ["a", "b"], ["name"])
                      .select("row", "left", "pos", "name"), "block-level")
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return base.select("row", "doc_id", "text_sha256").join(found, "row")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 4096, hash_bits: int = 64) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row for each row of ``docs``."""
    rows = written(identities(docs, id_col, text_col, block_bytes, hash_bits), "identities")
    groups = written(rows.groupBy("level", "name").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "row")).alias("keep")), "identity-groups")
    return (looked_up(rows, groups.withColumn("group_size", F.col("n")), ["level", "name"], ["group_size", "keep"])
            .select("doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256"))
