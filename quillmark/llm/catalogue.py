"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm.common import PIECE_MODEL, read_table
from quillmark.llm.oracle import OP3_SQL, OP11_SQL, OP12_SQL, OP13_SQL


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmark.llm.exact_dedup import exact_dedup

    return exact_dedup(read_table(spark, sf_dir, "documents")).drop("_row")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmark.llm import language

    langs, table = language.fit(read_table(spark, sf_dir, "documents"))
    return language.identify(read_table(spark, sf_dir, "pages"), langs, table).drop("_row")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmark.llm.suffix_dedup import suffix_dedup, with_digest

    return with_digest(suffix_dedup(read_table(spark, sf_dir, "documents"))).drop("_row")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmark.llm.substring_dedup import substring_dedup, with_digest

    return with_digest(substring_dedup(read_table(spark, sf_dir, "documents"))).drop("_row")


def op5_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str = PIECE_MODEL) -> DataFrame:
    from quillmark.llm.pieces import encode

    return encode(read_table(spark, sf_dir, "documents"), model_path).drop("_row")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmark.llm.simhash import near_groups

    return near_groups(read_table(spark, sf_dir, "documents")).drop("_row")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmark.llm.decontamination import find_passages, with_digest

    found = find_passages(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return with_digest(found).drop("_row")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmark.llm import quality

    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmark.llm.licenses import known_licenses, scan

    found = scan(read_table(spark, sf_dir, "documents"), known_licenses(spark))
    return found.withColumn("licenses", F.array_join("licenses", ",")).drop("_row")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmark.llm.sharding import assign_shards

    return assign_shards(read_table(spark, sf_dir, "documents")).drop("_row")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmark.llm.prefix_trie import rebuilt, trie, turn_rows

    return trie(rebuilt(turn_rows(read_table(spark, sf_dir, "conversations"))))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmark.llm.spelling import MUTATE, spelling_variants

    return spelling_variants(read_table(spark, sf_dir, "documents"), mutate=MUTATE)


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmark.llm.mixing import Mix

    return Mix(read_table(spark, sf_dir, "documents")).documents().drop("_row", "source")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_exact_dedup, op2_language_id, op3_suffix_array_dedup, op4_substring_dedup, op5_sentencepiece, op6_simhash, op7_decontamination, op8_quality, op9_license_scan, op10_sharding, op11_prefix_trie, op12_spelling, op13_mixing)}


OP1_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM t
"""


# Windows of twenty words whose sequence was seen in an earlier row or place.
OP4_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
win AS (SELECT doc_id, i, count(*) OVER nxt AS n, md5(string_agg(word, ' ') OVER nxt) AS h FROM w
        WINDOW nxt AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM win WHERE n = 20) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(words)::bigint AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def _words_sql(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"list_filter(regexp_split_to_array({lower}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"


# Windows of ten words of an item, or a shorter item as a whole, wherever they occur.
OP7_SQL = f"""
WITH b AS (SELECT item_id::varchar AS item, {_words_sql('text')} AS words FROM benchmark),
p AS (SELECT DISTINCT item, least(len(words), 10) AS size, array_to_string(list_slice(words, s, s + 9), ' ') AS phrase
      FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS s FROM b WHERE len(words) > 0)),
d AS (SELECT doc_id, {_words_sql('text')} AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
win AS (SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS ahead FROM w),
sized AS (SELECT doc_id, i, size, array_to_string(list_slice(ahead, 1, size), ' ') AS phrase
          FROM win, (SELECT DISTINCT size FROM p) WHERE len(ahead) >= size),
hits AS (SELECT doc_id, i, size, item FROM sized JOIN p USING (size, phrase)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id)
SELECT doc_id, len(words)::bigint AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def all_sql() -> dict[str, str]:
    from quillmark.llm.licenses import scan_sql

    return {"op1_exact_dedup": OP1_SQL, "op3_suffix_array_dedup": OP3_SQL, "op4_substring_dedup": OP4_SQL, "op7_decontamination": OP7_SQL, "op9_license_scan": scan_sql(), "op11_prefix_trie": OP11_SQL, "op12_spelling": OP12_SQL, "op13_mixing": OP13_SQL}
