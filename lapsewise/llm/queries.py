"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, collocations, decontamination, language_model, neighbours, packing, quality, sharding, simhash, substrings, token_files, toxicity
from .labelled import fold

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: End id of the token files and packed sequences.
END_ID = 2


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; no SQL (model): tested by held-out accuracy."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.toxic_scores(docs, labels, fold("doc_id", 5) != 0)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, exactly or nearly; no SQL (XXH64): tested against brute force."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of all documents; no SQL (XXH64): tested against all pairs."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of control strings, formatted and read back."""
    odd = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(spark.createDataFrame(
        [(-1, 0, "user", odd), (-1, 1, "assistant", odd)], "conv_id long, turn long, role string, text string"))
    return chat.read_back(chat.format_conversations(rows))


@query
def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 35 words that occur more than once, removed from all documents."""
    cleaned = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed pieces of all documents; no SQL (tokenizer): tested against a brute-force reading."""
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids, written to the file format and read back; no SQL (tokenizer): tested as a round trip."""
    read = token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents; no SQL (model): tested by held-out accuracy."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.quality_scores(docs, labels, fold("doc_id", 3) != 1)
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


@query
def op9_pair_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff scores as below, with one word of context."""
    scored = language_model.score_documents(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_words", "n_backoff", F.round("log_score", 6).alias("log_score"),
                         F.round("mean_log_score", 6).alias("mean_log_score"))


@query
def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff scores of all documents under the counts of all documents: two words of context, two backoff steps."""
    scored = language_model.score_documents(table(spark, sf_dir, "documents"), order=3)
    return scored.select("doc_id", "n_words", "n_backoff", F.round("log_score", 6).alias("log_score"),
                         F.round("mean_log_score", 6).alias("mean_log_score"))


@query
def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest rows of every hundredth vector; approximate, so tested against brute force instead of SQL."""
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest phrases of every language over all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLE["op12_collocations"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
p AS (SELECT lang, row_number() OVER () AS p, piece FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
w AS (SELECT lang, p, unnest(x) AS word, generate_subscripts(x, 1) AS i
      FROM (SELECT lang, p, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS x FROM p)),
m AS (SELECT lang, word, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c, lead(word, 3) OVER o AS d FROM w WINDOW o AS (PARTITION BY p ORDER BY i)),
f AS MATERIALIZED (
  SELECT lang, 1 AS size, word AS phrase, count(*) AS n FROM m GROUP BY ALL
  UNION ALL SELECT lang, 2, word || ' ' || b, count(*) FROM m WHERE b IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, word || ' ' || b || ' ' || c, count(*) FROM m WHERE c IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 4, word || ' ' || b || ' ' || c || ' ' || d, count(*) FROM m WHERE d IS NOT NULL GROUP BY ALL),
t AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS words, n AS a FROM f WHERE size > 1 AND n >= 30),
cut AS (
  SELECT c.lang, c.size, c.phrase, c.a, x.n AS l, y.n AS r, k,
         (2000000::HUGEINT * c.a) // (x.n::HUGEINT + y.n) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c) c
  JOIN f x ON x.lang = c.lang AND x.size = k AND x.phrase = array_to_string(words[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.size = c.size - k AND y.phrase = array_to_string(words[k + 1:], ' ')),
s AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, size, phrase ORDER BY score, k) = 1),
inner_of AS (
  SELECT lang, short, array_to_string(words[i:i + short - 1], ' ') AS phrase, a
  FROM (SELECT *, unnest(range(1, size - short + 2)) AS i
        FROM (SELECT *, unnest(range(2, size)) AS short FROM c))),
gone AS (SELECT DISTINCT c.lang, c.size, c.phrase FROM c JOIN inner_of o ON o.lang = c.lang AND o.short = c.size AND o.phrase = c.phrase
         WHERE 100::HUGEINT * o.a >= 80::HUGEINT * c.a),
k AS (SELECT * FROM s ANTI JOIN gone USING (lang, size, phrase))
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, t.n AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM k) JOIN t USING (lang)
WHERE rank <= 2000
"""

@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers on all documents, aligned; no SQL (tokenizers): tested against a direct alignment."""
    aligned = alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256)).alias("groups_sha256")
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest)


#: Shards and metadata dimensions of the sharded documents.
SHARDS, SHARD_DIMENSIONS = 8, ["lang", "source", "n_chars"]


@query
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight runs of a Hilbert curve over language, source and length."""
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), SHARD_DIMENSIONS, SHARDS, tie=["doc_id"])
    utf8 = F.coalesce("text", F.lit("")).cast("binary")
    return placed.select("doc_id", (F.octet_length(utf8) + 1).cast("long").alias("size"), F.crc32(utf8).alias("text_crc32"),
                         F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _hilbert_sql() -> str:
    """DuckDB SQL of the shards: equal-depth cells by counts below, the curve by one table of orientations per bit level."""
    dims, bits = len(SHARD_DIMENSIONS), sharding.BITS
    cells = (1 << bits) - 1
    _, steps = sharding._states(dims)
    table = ", ".join(f"({s}, {label}, {w}, {after})" for s, row in enumerate(steps) for label, (w, after) in enumerate(row))
    key = {c: f"left({c}, {sharding.PREFIX})" if c != "n_chars" else c for c in SHARD_DIMENSIONS}
    cell = ", ".join(
        f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 + (rank() OVER (PARTITION BY {c} IS NULL ORDER BY {key[c]}) - 1) * {cells} "
        f"// count(*) OVER (PARTITION BY {c} IS NULL) END AS c{i}" for i, c in enumerate(SHARD_DIMENSIONS))
    label = " + ".join(f"((c{i} >> {{level}}) & 1) * {1 << (dims - 1 - i)}" for i in range(dims))
    levels = "".join(
        f",\nl{k} AS (SELECT p.* EXCLUDE (place, state), p.place * {1 << dims} + t.w AS place, t.after AS state "
        f"FROM {f'l{k - 1}' if k else 'cells'} p JOIN curve t ON t.state = p.state AND t.label = {label.format(level=bits - 1 - k)})" for k in range(bits))
    crc = []
    for c in range(256):  # the table of the reflected polynomial
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        crc.append(c)
    return f"""
WITH curve(state, label, w, after) AS (VALUES {table}),
crc AS (SELECT {crc}::BIGINT[] AS t),
cells AS (SELECT doc_id, coalesce(text, '') AS text, {cell}, 0::BIGINT AS place, 0 AS state FROM documents){levels},
r AS (SELECT *, row_number() OVER (ORDER BY place, doc_id NULLS FIRST) - 1 AS r, count(*) OVER () AS total FROM l{bits - 1}),
s AS (SELECT *, r * {SHARDS} // total AS shard FROM r)
SELECT doc_id, (strlen(text) + 1)::BIGINT AS size,
       xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda b: ('0x' || b)::BIGINT)),
                       lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)::BIGINT AS text_crc32, 'rows' AS law, shard::INT AS shard,
       (r - (total * shard + {SHARDS - 1}) // {SHARDS})::BIGINT AS slot, NULL::INT AS grown_shard
FROM s, crc"""


ORACLE["op11_sharding"] = _hilbert_sql()


ORACLE["op5_substrings"] = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
p AS (
  SELECT r, i, md5(array_to_string(words[i:i + 34], ' ')) AS h
  FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS i FROM w)),
d AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY h) AS n FROM p) WHERE n > 1),
g AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM d),
k AS (SELECT r, list(i) AS gone FROM g GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(
         CASE WHEN gone IS NULL THEN words
              ELSE list_transform(list_filter(range(1, len(words) + 1), lambda i: NOT list_contains(gone, i)), lambda i: words[i]) END,
         ' ')) AS kept_sha256
FROM w LEFT JOIN k USING (r)
"""

ORACLE["op9_pair_model"] = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
w AS (SELECT r, i, words[i] AS word, words[i - 1] AS before FROM (SELECT r, words, unnest(range(1, len(words) + 1)) AS i FROM t)),
one AS (SELECT word, count(*) AS n FROM w GROUP BY word),
two AS (SELECT before, word, count(*) AS n FROM w WHERE i > 1 GROUP BY before, word),
s AS (
  SELECT r, i > 1 AND two.n < 2 AS backed,
         CASE WHEN i > 1 AND two.n >= 2 THEN ln(two.n) - ln(b.n)
              ELSE ln(o.n) - ln((SELECT count(*) FROM w)) + CASE WHEN i > 1 THEN ln(0.4) ELSE 0 END END AS score
  FROM w JOIN one o ON o.word = w.word LEFT JOIN one b ON b.word = w.before
         LEFT JOIN two ON two.before = w.before AND two.word = w.word AND w.i > 1),
d AS (SELECT r, count(*) AS n, count(*) FILTER (backed) AS n_backoff, sum(score) AS log_score FROM s GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_backoff, 0)::BIGINT AS n_backoff,
       round(coalesce(log_score, 0), 6) AS log_score, round(log_score / n, 6) AS mean_log_score
FROM t LEFT JOIN d USING (r)
"""

ORACLE["op9_language_model"] = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
w AS (SELECT r, i, words[i] AS word, words[i - 1] AS before, words[i - 2] AS earlier
      FROM (SELECT r, words, unnest(range(1, len(words) + 1)) AS i FROM t)),
one AS (SELECT word, count(*) AS n FROM w GROUP BY word),
two AS (SELECT before, word, count(*) AS n FROM w WHERE i > 1 GROUP BY before, word),
three AS (SELECT earlier, before, word, count(*) AS n FROM w WHERE i > 2 GROUP BY earlier, before, word),
s AS (
  SELECT w.r,
         CASE WHEN i > 2 AND three.n >= 2 THEN 0 ELSE CASE WHEN i > 2 THEN 1 ELSE 0 END + CASE WHEN i > 1 AND two.n < 2 THEN 1 ELSE 0 END END AS steps,
         CASE WHEN i > 2 AND three.n >= 2 THEN ln(three.n) - ln(ab.n)
              ELSE CASE WHEN i > 2 THEN ln(0.4) ELSE 0 END
                   + CASE WHEN i > 1 AND two.n >= 2 THEN ln(two.n) - ln(b.n)
                          ELSE ln(o.n) - ln((SELECT count(*) FROM w)) + CASE WHEN i > 1 THEN ln(0.4) ELSE 0 END END END AS score
  FROM w JOIN one o ON o.word = w.word LEFT JOIN one b ON b.word = w.before
         LEFT JOIN two ON two.before = w.before AND two.word = w.word AND w.i > 1
         LEFT JOIN two ab ON ab.before = w.earlier AND ab.word = w.before AND w.i > 2
         LEFT JOIN three ON three.earlier = w.earlier AND three.before = w.before AND three.word = w.word AND w.i > 2),
d AS (SELECT r, count(*) AS n, sum(steps)::BIGINT AS n_backoff, sum(score) AS log_score FROM s GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_backoff, 0)::BIGINT AS n_backoff,
       round(coalesce(log_score, 0), 6) AS log_score, round(log_score / n, 6) AS mean_log_score
FROM t LEFT JOIN d USING (r)
"""

ORACLE["op4_chat"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
           '\\', '\\\\', 'g'), '<(/?s>)', '<\\\1', 'g'), '\[(/?INST\])', '[\\\1', 'g'),
           '<\|', '<\\|', 'g'), '<(</?SYS>>)', '<\\\1', 'g') AS escaped
  FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<s>') + length(role) + 1 + length(escaped) + length('</s>') + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
