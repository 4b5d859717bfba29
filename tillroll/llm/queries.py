"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import ann, bpe, chat, decontam, exactdedup, langid, licenses, lm, merkle, quality, resampling, simhash, urls
from tillroll.llm.common import held_out, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Where the public tokenizer files are: the same path on every machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def word_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probability of every document, from the graded ratings of ``labels``."""
    docs = table(spark, sf_dir, "documents")
    return quality.grade(docs, quality.train(docs, quality.graded(table(spark, sf_dir, "labels")), 3))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every confirmed (document, benchmark item) match."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# The rule list of the query (action, host, path).
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (3-word shingles, 3 bits)."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), n=3, max_bits=3)


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors found of every vector whose id is divisible by 100."""
    return (ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)
            .select("query_id", "rank", F.col("id").alias("vec_id"), "score"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a quarter of the documents is held out of the learning."""
    docs = table(spark, sf_dir, "documents")
    out = held_out("doc_id", 4, 2)
    return (langid.identify(docs, langid.learn(docs.where(~out)))
            .select("doc_id", out.alias("held_out"), "lang_pred", "score", "bits"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one full of control strings, rebuilt from its event log, rendered and read back."""
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.read_back(chat.rendered(chat.messages(chat.events_of(rows))), placed=True)


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram base score and log-bilinear model score of every document; a fifth is held out."""
    return lm.scores(table(spark, sf_dir, "documents"), held_out("doc_id", 5, 1))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph of every document in which a licence family is recognised."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_file(), word_pattern())


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copy that stays and the group size of every document."""
    return exactdedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document towards the benchmark's texts; a quarter is drawn."""
    return (resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=25, min_words=20, buckets=10_000, seed=7)
            .select("doc_id", "n_features", "weight", "score", "rank"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof digest of every document, and the root that its leaf, tampered with for one id in seven, gives."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.col("n_chars").cast("decimal(38,0)").alias("n_chars"), "text")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    leaf = merkle.leaf_hash([F.col(c) for c in docs.columns])
    other = merkle.leaf_hash([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in docs.columns])
    leaves = written(docs.select("doc_id", "lang", leaf.alias("leaf"), F.when(tampered, other).alias("claim")), "leaves")
    out = merkle.proofs(leaves, group="lang", order="doc_id", leaf="leaf", carry=["doc_id", "claim"])
    out = out.withColumn("folded_root", merkle.folded(F.coalesce("claim", "leaf")))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(), 256).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {f.__name__: f for f in (op1_quality, op2_decontamination, op3_url_filter, op4_simhash, op5_neighbours, op6_language,
                                  op7_chat, op8_lm_scores, op9_licenses, op10_bpe, op11_exact_dedup, op12_resampling, op13_manifest)}
# The other queries rest on learnt models, XXH64 or a tokenizer, which SQL cannot express; tests/llm holds
# their brute-force versions.
ORACLE_SQL: dict[str, str] = {"op7_chat": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(8 + length(replace(regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g'), chr(10), '<|nl|>')) + 1
                + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + 8) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id""",
    "op11_exact_dedup": r"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size,
       row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(text) AS text_sha256
FROM t""",
    "op12_resampling": r"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], [0, 0, 0, 0, 0, 0, 0, 0]),
           lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
texts AS (
  SELECT doc_id, false AS aim, text FROM documents UNION ALL SELECT NULL, true, text FROM benchmark),
worded AS (
  SELECT doc_id, aim, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts),
features AS (
  SELECT doc_id, aim, f, count(*) AS n FROM (
    SELECT doc_id, aim, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM worded)
  GROUP BY ALL),
hashed AS (
  SELECT f, xor(list_reduce(list_concat([4294967295], list_transform(range(len(hex(encode(f))) // 2),
                  lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS BIGINT))),
                  lambda c, b: xor(t[xor(c, b) % 256 + 1], c >> 8)), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM features), crc_table),
counts AS (
  SELECT bucket, coalesce(sum(n) FILTER (NOT aim), 0) AS s, coalesce(sum(n) FILTER (aim), 0) AS t
  FROM features JOIN hashed USING (f) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(CAST(t + 1 AS DOUBLE) * (sum(s) OVER () + 10000) / (CAST(s + 1 AS DOUBLE) * (sum(t) OVER () + 10000)))) AS gain
  FROM counts),
weights AS (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight
  FROM features JOIN hashed USING (f) JOIN gains USING (bucket) WHERE NOT aim GROUP BY doc_id),
noisy AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM worded LEFT JOIN weights USING (doc_id) WHERE NOT aim),
ordered AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM noisy WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank
FROM noisy LEFT JOIN ordered USING (doc_id)""",
    "op13_manifest": r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], [0, 0, 0, 0, 0, 0, 0, 0]),
           lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
fields AS (
  SELECT doc_id, lang, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') AS front,
         coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS chars, coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS more,
         coalesce(strlen(text) || ':' || text, '-') AS body,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                         lambda c, b: xor(t[xor(c, b) % 256 + 1], c >> 8)), 4294967295) % 7 = 0 AS tampered
  FROM documents, crc_table),
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS grp, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n,
         sha256(front || chars || body) AS leaf, CASE WHEN tampered THEN sha256(front || more || body) ELSE sha256(front || chars || body) END AS claim
  FROM fields),
nodes AS (
  SELECT grp, 0 AS lvl, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT grp, lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY grp, lvl, idx // 2, n),
subroots AS (
  SELECT grp, lvl AS depth, h, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
upper AS (
  SELECT 0 AS lvl, idx, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM upper WHERE n > 1 GROUP BY lvl, idx // 2, n),
proof AS (
  SELECT doc_id, string_agg(h, '' ORDER BY lvl) AS p FROM (
    SELECT l.doc_id, x.lvl, coalesce(y.h, '') AS h
    FROM leaves l JOIN nodes x ON x.grp = l.grp AND x.n > 1 AND x.idx = l.idx >> x.lvl
         LEFT JOIN nodes y ON y.grp = x.grp AND y.lvl = x.lvl AND y.idx = xor(x.idx, 1)
    UNION ALL
    SELECT l.doc_id, 1000 + x.lvl, coalesce(y.h, '')
    FROM leaves l JOIN subroots s USING (grp) JOIN upper x ON x.n > 1 AND x.idx = s.idx >> x.lvl
         LEFT JOIN upper y ON y.lvl = x.lvl AND y.idx = xor(x.idx, 1))
  GROUP BY doc_id),
fold AS (
  SELECT doc_id, grp, idx, 0 AS lvl, claim AS acc FROM leaves
  UNION ALL
  SELECT f.doc_id, f.grp, f.idx // 2, f.lvl + 1,
         sha256(CASE WHEN f.idx % 2 = 1 THEN y.h || f.acc ELSE f.acc || coalesce(y.h, '') END)
  FROM fold f JOIN subroots s ON s.grp = f.grp AND f.lvl < s.depth
       LEFT JOIN nodes y ON y.grp = f.grp AND y.lvl = f.lvl AND y.idx = xor(f.idx, 1)),
over AS (
  SELECT f.doc_id, s.idx, 0 AS lvl, f.acc FROM fold f JOIN subroots s ON s.grp = f.grp AND f.lvl = s.depth
  UNION ALL
  SELECT o.doc_id, o.idx // 2, o.lvl + 1, sha256(CASE WHEN o.idx % 2 = 1 THEN y.h || o.acc ELSE o.acc || coalesce(y.h, '') END)
  FROM over o JOIN upper x ON x.lvl = o.lvl AND x.idx = o.idx AND x.n > 1
       LEFT JOIN upper y ON y.lvl = o.lvl AND y.idx = xor(o.idx, 1))
SELECT l.doc_id, l.leaf, s.h AS subroot, r.h AS root, sha256(coalesce(p.p, '')) AS proof_sha256, o.acc AS folded_root, o.acc = r.h AS verified
FROM leaves l JOIN subroots s USING (grp) JOIN upper r ON r.n = 1 LEFT JOIN proof p USING (doc_id)
     JOIN over o ON o.doc_id = l.doc_id AND o.lvl = r.lvl"""}
