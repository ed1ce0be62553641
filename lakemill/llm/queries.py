"""The registered queries of this subpackage: thin digests of each operator's output."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemill.llm.byte_bpe import bpe
from lakemill.llm.chat_format import format_chats, read_back
from lakemill.llm.exact_dedup import exact_dedup
from lakemill.llm.html_text import extract
from lakemill.llm.id_store import id_store
from lakemill.llm.minhash import near_dedup
from lakemill.llm.ngram_join import ngram_join
from lakemill.llm.packing import pack
from lakemill.llm.quality import quality
from lakemill.llm.secret_scan import secrets
from lakemill.llm.token_align import Vocabularies, token_align
from lakemill.llm.token_counts import token_counts
from lakemill.llm.vector_codes import vector_codes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


DEDUP_SQL = r"""
WITH bare AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY body ORDER BY n_chars DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY body ORDER BY n_chars DESC, doc_id) AS kept,
       sha256(body) AS text_sha256
FROM bare
"""


@query("op1_exact_dedup", DEDUP_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op2_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).drop("ids")


@query("op3_html_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


@query("op4_byte_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, ids=False)


@query("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op6_minhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


@query("op7_id_store")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_store(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ids=False)


QUALITY_SQL = r"""
WITH split AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
         row_number() OVER () AS r
  FROM documents
), windows AS (
  SELECT r, p, array_to_string(w[p:p + 7], ' ') AS body
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS p FROM split WHERE len(w) >= 8)
), twice AS (
  SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, body) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(p, p + 8)) AS q FROM twice) GROUP BY r
), counted AS (
  SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered c USING (r)
), based AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         n_symbols * 1000 // nullif(n_words, 0) AS symbols, n_dup_lines * 1000 // nullif(n_lines, 0) AS dup_lines,
         word_chars * 100 // nullif(n_words, 0) AS word_length
  FROM counted
), measured AS (
  UNPIVOT (SELECT lang, source, symbols, dup_lines, word_length FROM based WHERE NOT base_failed)
  ON symbols, dup_lines, word_length INTO NAME rule VALUE v
), sketched AS (
  SELECT lang, source, rule, (v >> greatest(length(bin(v)) - 7, 0)) << greatest(length(bin(v)) - 7, 0) AS bucket
  FROM measured
), ranked AS (
  SELECT lang, source, grouping(lang, source) AS level, rule, bucket, count(*) AS n
  FROM sketched GROUP BY GROUPING SETS ((lang, source, rule, bucket), (lang, rule, bucket), (rule, bucket))
), summed AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, rule ORDER BY bucket) AS upto,
         sum(n) OVER (PARTITION BY level, lang, source, rule) AS total
  FROM ranked
), quartiles AS (
  SELECT level, lang, source, rule, min(bucket) FILTER (upto * 100 >= total * 25) AS low,
         min(bucket) FILTER (upto * 100 >= total * 50) AS mid
  FROM summed WHERE total >= 200 OR level = 3 GROUP BY ALL
), fence AS (
  SELECT level, lang, source, rule,
         mid + 3 * greatest(mid - low, CASE rule WHEN 'symbols' THEN 50 WHEN 'dup_lines' THEN 120 ELSE 250 END) AS most
  FROM quartiles
), wide AS (
  SELECT level, lang, source, max(most) FILTER (rule = 'symbols') AS symbols,
         max(most) FILTER (rule = 'dup_lines') AS dup_lines, max(most) FILTER (rule = 'word_length') AS word_length
  FROM fence GROUP BY ALL
)
SELECT b.doc_id, b.n_words, b.word_chars, b.n_symbols, b.n_dup_lines, b.n_repeat_words, b.base_failed,
       NOT b.base_failed
       AND coalesce(b.symbols <= coalesce(g.symbols, x.symbols, a.symbols), true)
       AND coalesce(b.dup_lines <= coalesce(g.dup_lines, x.dup_lines, a.dup_lines), true)
       AND coalesce(b.word_length <= coalesce(g.word_length, x.word_length, a.word_length), true) AS kept
FROM based b
LEFT JOIN wide g ON g.level = 0 AND g.lang = b.lang AND g.source = b.source
LEFT JOIN wide x ON x.level = 1 AND x.lang = b.lang
LEFT JOIN wide a ON a.level = 3
"""


@query("op8_quality", QUALITY_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


@query("op9_chat_format")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more, whose texts are nothing but control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], turns.schema)
    out = read_back(format_chats(turns.unionByName(planted)))
    return out.withColumn("conv_id", F.col("conv_id").cast("long"))


@query("op10_secrets")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(table(spark, sf_dir, "documents"))


@query("op11_token_align")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = Vocabularies(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return token_align(table(spark, sf_dir, "documents"), files)


@query("op12_ngram_join")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))


def assigned(entries: str) -> str:
    """SQL for the nearest entry of every part and its squared distance, ties to the lower index."""
    gap = "list_sum(list_transform(range(1, len(e.v) + 1), lambda i: (p.v[i] - e.v[i]) * (p.v[i] - e.v[i])))::BIGINT"
    return f"""(
  SELECT r, part, min(s).k AS k, min(s).gap AS gap
  FROM (SELECT p.r, p.part, struct_pack(gap := {gap}, k := e.k) AS s FROM parts p JOIN {entries} e USING (part))
  GROUP BY r, part
)"""


def averaged(entries: str, nearest: str) -> str:
    """SQL for entries replaced by the floored mean of their parts; unused ones stay."""
    return f"""(
  SELECT e.part, e.k, coalesce(m.v, e.v) AS v FROM {entries} e LEFT JOIN (
    SELECT part, k, list((s - ((s % n + n) % n)) // n ORDER BY i) AS v
    FROM (SELECT p.part, a.k, i, sum(p.v[i])::BIGINT AS s, count(*) AS n
          FROM parts p JOIN {nearest} a USING (r, part), unnest(range(1, len(p.v) + 1)) u(i) GROUP BY p.part, a.k, i)
    GROUP BY part, k) m USING (part, k)
)"""


VECTOR_SQL = f"""
WITH RECURSIVE kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT r, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS v FROM kept, unnest(range(16)) u(part)
), book0 AS MATERIALIZED (SELECT part, r - 1 AS k, v FROM parts WHERE r <= 64),
near0 AS MATERIALIZED {assigned("book0")},
book1 AS MATERIALIZED {averaged("book0", "near0")},
near1 AS MATERIALIZED {assigned("book1")},
book2 AS MATERIALIZED {averaged("book1", "near1")},
near2 AS MATERIALIZED {assigned("book2")},
codes AS (
  SELECT r, string_agg(printf('%02x', k), '' ORDER BY part) AS code, sum(gap)::BIGINT AS error FROM near2 GROUP BY r
), digest AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, k)) AS codebooks_sha256 FROM book2
)
SELECT vec_id, label, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN codes USING (r), digest
"""


@query("op13_vector_codes", VECTOR_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))
