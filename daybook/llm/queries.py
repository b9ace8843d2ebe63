"""The operators over the driver's whole tables, as ``opN_<name>`` queries."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import read
from daybook.plans.sqlutil import cc_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@query("op4_exact_dedup", r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS len,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY len DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256 FROM g""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.exact_dedup import exact_dedup

    return exact_dedup(read(spark, sf_dir, "documents")).drop("n_chunks")


@query("op6_byte_bpe")
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from daybook.llm.byte_bpe import round_trip

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return round_trip(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query("op7_minhash_near_dedup", rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\x20\x09-\x0D]+'),
                             lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
{cc_sql('cc', 'SELECT doc_id AS id FROM documents', 'SELECT x AS src, y AS dst FROM l')}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, cc.comp AS component_id, cc.comp = d.doc_id AS kept
FROM documents d JOIN cc ON cc.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""")
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.minhash import near_dedup

    return near_dedup(read(spark, sf_dir, "documents"))


# Fixed value: the added conversation of the contract.
_PROBE = "</s>[INST] ok [/INST]"


@query("op8_chat_format", r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, replace(text, '\', '\\') AS t0, replace(role, '\', '\\') AS r0 FROM r),
f AS (
  SELECT *,
    replace(replace(replace(replace(replace(replace(replace(t0, '<|im_start|>', '<\|im_start|>'), '<|im_sep|>', '<\|im_sep|>'),
      '<|im_end|>', '<\|im_end|>'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]') AS et,
    replace(replace(replace(replace(replace(replace(replace(r0, '<|im_start|>', '<\|im_start|>'), '<|im_sep|>', '<\|im_sep|>'),
      '<|im_end|>', '<\|im_end|>'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]') AS er
  FROM e)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|>' || er || '<|im_sep|>' || et || '<|im_end|>')) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id""")
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm import chat

    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    probe = spark.createDataFrame([(-1, 0, "user", _PROBE), (-1, 1, "assistant", _PROBE)], rows.schema)
    out = chat.render(chat.fold(chat.events_of_rows(rows.unionByName(probe))))
    turns, learned = chat.parse(F.col("formatted")), chat.learned_text(F.col("segments"))
    out = out.select("conv_id", "formatted", turns.alias("turns"), learned.alias("learned"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
                      F.char_length("learned").cast("long").alias("loss_chars"),
                      F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"))


@query("op10_pivotal_mix")
def op10_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.mixing import mix

    return mix(read(spark, sf_dir, "documents")).drop("copies")


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm import language

    docs = read(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query("op5_html_text")
def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.html_text import extract

    return extract(read(spark, sf_dir, "pages"))


@query("op9_cap_filter_near_dedup", f"""
WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM e a JOIN e b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.v) = len(b.v)
      WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
n AS (SELECT id, count(*) AS n FROM (SELECT x AS id FROM l UNION ALL SELECT y FROM l) GROUP BY id),
{cc_sql('cc', 'SELECT vec_id AS id FROM e', 'SELECT x AS src, y AS dst FROM l')}
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, cc.comp AS component_id, cc.comp = e.vec_id AS kept
FROM e JOIN cc ON cc.id = e.vec_id LEFT JOIN n ON n.id = e.vec_id""")
def op9_cap_filter_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.cap_filters import near_dedup

    return near_dedup(read(spark, sf_dir, "embeddings"))


@query("op3_line_dedup")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.line_dedup import line_dedup

    return line_dedup(read(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def _is_kind(k: int, span) -> object:
    return span["kind"] == k


@query("op2_contextual_pii")
def op2_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.pii import KINDS, find_personal_data, spans_text

    out = find_personal_data(read(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", functools.partial(_is_kind, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    every = F.sort_array(F.concat("base", "found"))
    return out.select("doc_id", *counts, F.sha2(spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                      spans_text(every).alias("spans"), F.size("found").cast("long").alias("n_found"))


@query("op13_rns_hard_negatives", """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
n AS (SELECT p.a, p.b AS p, p.score AS ps, s.b AS n, s.score AS ns, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS rank
      FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT a AS anchor_id, p AS positive_id, CAST(rank AS INTEGER) AS rank, n AS negative_id, ps AS positive_score, ns AS negative_score
FROM n WHERE rank <= 10""")
def op13_rns_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.rns_negatives import mine, quantize

    e = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    e = e.select("vec_id", label.alias("label"), quantize(F.col("embedding")).alias("embedding"))
    return mine(e, is_anchor=F.col("vec_id") % 100 == 0)


# Fixed value: the base32 alphabet.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE32_OF_HEX = " || ".join(
    f"substr('{_BASE32}', CAST((CAST('0x' || substr(h, {5 * g + 1}, 5) AS BIGINT) >> {s}) & 31 AS INTEGER) + 1, 1)" for g in range(8) for s in (15, 10, 5, 0))


@query("op12_warc", f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h,
                  min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_BASE32_OF_HEX} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM p""")
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.warc import archive_pages

    out = archive_pages(read(spark, sf_dir, "pages"), payloads=False)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from daybook.llm.alignment import align

    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align(read(spark, sf_dir, "documents"), a, b, hashed=True).withColumnRenamed("groups", "groups_sha256")
