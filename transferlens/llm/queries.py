"""One query per corpus operator, with production parameters over its whole table, and reference SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlens.llm import (
    anchors, content_sort, decontamination, fill_in_middle, language, mixing, prefix_trie, probminhash, suffixes, toxicity, url_trees, warc, wavelet,
)
from transferlens.llm.common import held_out, staged, table

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
VOCABULARY = "word_bpe_49k.json"


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_id"), "toxic")
    fold = held_out("doc_id", 5, 0)
    # The sample is drawn from the labels alone, so that only its texts are looked up.
    drawn = staged(toxicity.draw(labels.filter(~held_out("_id", 5, 0))), "toxicity_labels")
    labelled = docs.join(drawn, F.col("doc_id") == F.col("_id")).select("text", "toxic", "weight")
    model = toxicity.learn(labelled, weight="weight")
    return toxicity.score(docs.select("doc_id", fold.alias("held_out"), "text"), model)


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = decontamination.judged(docs, table(spark, sf_dir, "benchmark"))
    return rows.withColumnsRenamed({"key": "doc_id", "item": "item_id"})


def word_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = anchors.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.withColumnRenamed("key", "doc_id")


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = probminhash.near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(F.col("key").alias("doc_id"), "class_id", (F.col("key") == F.col("class_id")).alias("kept"))


def byte_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.withColumnRenamed("key", "doc_id")


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = content_sort.exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.withColumnsRenamed({"key": "doc_id", "keep": "keep_id"})


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return rows.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = url_trees.judge(table(spark, sf_dir, "pages").select("page_id", "url"), RULES)
    return rows.withColumnRenamed("key", "page_id")


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return wavelet.encode_documents(docs, public_tokenizers.path(VOCABULARY)).withColumnRenamed("key", "doc_id")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = held_out("doc_id", 4, 2)
    langs, matrix = language.learn(docs, ~fold)
    judged = language.predict(docs.select("doc_id", "text", fold.alias("held_out")), langs, matrix)
    return judged.select("doc_id", "held_out", "lang_pred", "score")


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations")).drop("turn_conv", "turn_pos")


def middle_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return rows.select(F.col("key").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(back, 256).alias("restored_sha256"))


def warc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).withColumnRenamed("key", "page_id")


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": toxic,
        "op2_template_leaks": benchmark_leaks,
        "op3_fixed_blocks": word_repeats,
        "op4_exact_dedup": exact_dedup,
        "op5_source_mix": source_mix,
        "op6_url_filter": url_filter,
        "op7_token_wavelet": tokens,
        "op8_language": languages,
        "op9_probminhash": near_dedup,
        "op10_suffixes": byte_repeats,
        "op11_prefix_trie": conversation_trie,
        "op12_fill_in_middle": middle_filling,
        "op13_warc": warc_pages,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_dedup": EXACT_DEDUP, "op5_source_mix": SOURCE_MIX, "op11_prefix_trie": PREFIX_TRIE,
            "op12_fill_in_middle": FILL_IN_MIDDLE, "op13_warc": WARC}


EXACT_DEDUP = r"""
WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM normal WINDOW g AS (PARTITION BY norm)
"""

SOURCE_MIX = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
by_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS nth
  FROM sized GROUP BY source),
weighted AS (
  SELECT *, CAST([5, 2, 1][CAST(nth % 3 AS INTEGER) + 1] AS DOUBLE) AS weight, source_size * CAST(2 AS DOUBLE) AS cap FROM by_source),
levelled AS (
  SELECT *, (sum(source_size) OVER () * CAST(1.5 AS DOUBLE)
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
targets AS (
  SELECT source, source_size,
    CASE WHEN cap <= level * weight THEN cap
         ELSE max(CASE WHEN NOT cap <= level * weight THEN level END) OVER () * weight END AS target
  FROM levelled),
classed AS (
  SELECT *, length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 4, 0)) AS class,
    ('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), ''))[1:8])::BIGINT AS hash FROM sized),
grouped AS (
  SELECT *, hash % CAST(ceil(count(*) OVER (PARTITION BY source, class) / 256) AS BIGINT) AS part FROM classed),
numbered AS (
  SELECT g.doc_id, g.size, t.source_size, t.target,
    row_number() OVER (PARTITION BY g.source ORDER BY class, part, g.size, g.doc_id ASC NULLS LAST) AS n,
    ('0x' || md5(coalesce('mix:' || g.source, 'mix'))[1:8])::BIGINT % 65536 / CAST(65536 AS DOUBLE) AS first,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate
  FROM grouped g JOIN targets t ON g.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST((floor(first + n * rate) - floor(first + (n - 1) * rate)) * size AS BIGINT) AS taken
FROM numbered
"""

PREFIX_TRIE = r"""
WITH own AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn ASC NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
headed AS (
  SELECT conv_id, turns, xor(list_reduce(
      list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
      lambda crc, byte: list_reduce(
        list_concat([xor(crc, byte)], [CAST(0 AS BIGINT) FOR x IN range(8)]), lambda c, x: xor(c >> 1, CAST(3988292384 AS BIGINT) * (c & 1)))),
    4294967295) % 4 AS h
  FROM own),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS seq
  FROM headed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
prefixes AS (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS depth FROM rebuilt),
nodes AS (
  SELECT depth, seq[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n,
         (count(*) - 1) * coalesce(len(regexp_extract_all(any_value(seq[depth].text), '[^\x20\x09-\x0D]+')), 0) AS cost,
         bool_and(len(seq) = depth) AS childless,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(seq) = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, path),
subtrees AS (
  SELECT above AS depth, path[1:above] AS path, sum(cost) AS saved, count(*) FILTER (WHERE childless) AS leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS above FROM nodes) GROUP BY 1, 2),
children AS (SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS children FROM nodes WHERE depth > 0 GROUP BY 1, 2)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n AS n_convs, coalesce(c.children, 0) AS n_children, s.leaves AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, v.ends_sha256
FROM nodes v JOIN subtrees s ON s.depth = v.depth AND s.path = v.path
LEFT JOIN nodes p ON p.depth = v.depth - 1 AND p.path = v.path[1:v.depth - 1]
LEFT JOIN children c ON c.depth = v.depth AND c.path = v.path
"""

FILL_IN_MIDDLE = r"""
WITH keyed AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
drawn AS (
  SELECT *, ('0x' || digest[1:8])::BIGINT % (n + 1) AS c1, ('0x' || digest[9:16])::BIGINT % (n + 1) AS c2,
         ('0x' || digest[17:24])::BIGINT % 100 AS h3, ('0x' || digest[25:32])::BIGINT % 100 AS h4 FROM keyed),
formed AS (
  SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
cut AS (SELECT *, '<P>' || substr(t, 1, a) AS prefix, '<M>' || substr(t, a + 1, b - a) AS middle, '<S>' || substr(t, b + 1) AS suffix FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN prefix || suffix || middle WHEN 'spm' THEN suffix || prefix || middle ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
"""

WARC = r"""
WITH hashed AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM hashed)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN coalesce(page_id > first, first IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN coalesce(page_id > first, first IS NOT NULL) THEN first END AS refers_to
FROM firsts
"""
