"""Registered queries of the operators: thin digests over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysignal.llm import (
    html_extraction, huffman_ids, language_id, ngram_join, packing, piece_scan, pivot_index, quality, sharding, spelling, substring_dedup, toxicity,
    whitening,
)
from paysignal.llm.rows import bounded_batches, remainder, vocabulary_path
from paysignal.session import fresh_path


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bounded_batches(spark).read.parquet(f"{sf_dir}/documents.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = language_id.train(docs, remainder("doc_id", 5) != 0)
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return language_id.predict(docs.select("doc_id", "text", held_out), model).drop("text")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    kept = substring_dedup.remove_repeats(docs, normalise=True)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), vocabulary_path("word_bpe_49k.json"), with_ids=False)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, remainder("doc_id", 4) != 2)
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    scored = toxicity.score(docs.select("doc_id", "text", held_out), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op5_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_index.embedding_groups(bounded_batches(spark).read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_groups(_documents(spark, sf_dir)).select("doc_id", "class_id", "n_links", "kept")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_documents(spark, sf_dir).select("doc_id", "text", "lang", "source"))
    return judged.select("doc_id", *(f"_quality.{c}" for c in [*quality.COUNTS, "base_failed", "kept"]))


def op8_piece_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every whole text (count and crc32 of the little-endian 32-bit ids), and whether they decode to it."""
    path = vocabulary_path("piece_bpe_32k.model")
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return piece_scan.encode(docs, path, with_decoded=True).select(
        "doc_id", "n_pieces", "n_chunks", F.crc32("ids").alias("ids_crc32"),
        F.coalesce(F.col("decoded") == F.col("text"), F.col("text").isNull()).alias("same_text"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = bounded_batches(spark).read.parquet(f"{sf_dir}/pages.parquet")
    found = html_extraction.extract(pages.select("page_id", "url", "html"), html_extraction.train(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token_files")
    huffman_ids.write_ids(_documents(spark, sf_dir), path, vocabulary_path("byte_bpe_50k.json"))
    return huffman_ids.read_ids(spark, path, with_ids=False).withColumnRenamed("id", "doc_id")


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = sharding.shard_table(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return table.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bounded_batches(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    return whitening.component_rows(rows, whitening.fit(rows))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_packing": op3_packing,
    "op4_toxicity": op4_toxicity,
    "op5_pivot_index": op5_pivot_index,
    "op6_ngram_join": op6_ngram_join,
    "op7_quality": op7_quality,
    "op8_piece_scan": op8_piece_scan,
    "op9_html_extraction": op9_html_extraction,
    "op10_huffman_ids": op10_huffman_ids,
    "op11_sharding": op11_sharding,
    "op12_whitening": op12_whitening,
    "op13_spelling": op13_spelling,
}

# crc32 of the UTF-8 bytes of a text, from the remainders of the 256 bytes
_CRC = """
    step(b, k, c) AS (
        SELECT b, 0, b::BIGINT FROM range(256) r(b)
        UNION ALL
        SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE k < 8),
    remainders AS (SELECT list(c ORDER BY b) AS t FROM step WHERE k = 8)"""


def _crc_of(text: str) -> str:
    return f"""xor(4294967295::BIGINT, list_reduce(
        list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda p: ('0x' || p)::BIGINT),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT))"""


ORACLE_SQL: dict[str, str] = {
    "op2_substring_dedup": """
        WITH numbered AS (
            SELECT row_number() OVER () AS d, doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []::VARCHAR[]) AS words
            FROM documents),
        placed AS (SELECT d, words, unnest(range(1, len(words) + 1)) AS i FROM numbered),
        windows AS (
            SELECT d, i, words[i] AS word, CASE WHEN i + 34 <= len(words) THEN sha256(array_to_string(words[i : i + 34], ' ')) END AS w
            FROM placed),
        judged AS (SELECT d, i, word, w IS NOT NULL AND count(*) OVER (PARTITION BY w) > 1 AS again FROM windows),
        covered AS (
            SELECT d, i, word, bool_or(again) OVER (PARTITION BY d ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS cut
            FROM judged),
        kept AS (
            SELECT d, count(*) FILTER (WHERE cut) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT cut) AS text
            FROM covered GROUP BY d)
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
            sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM numbered LEFT JOIN kept USING (d)""",
    "op11_sharding": f"""
        WITH RECURSIVE {_CRC},
        sized AS (
            SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, {_crc_of("coalesce(text, '')")} AS text_crc32
            FROM documents, remainders),
        placed AS (
            SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS UNBOUNDED PRECEDING) - size AS start,
                row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) AS place, sum(size) OVER () AS total
            FROM sized),
        sharded AS (SELECT *, ((2 * start + size) * 16 // (2 * total))::INT AS shard FROM placed)
        SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
            (place - min(place) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INT AS grown_shard
        FROM sharded""",
    "op13_spelling": f"""
        WITH RECURSIVE {_CRC},
        runs AS (
            SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run,
                count(*) AS times
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
            WHERE length(run) >= 6 GROUP BY ALL),
        hashed AS (SELECT run, times, {_crc_of("id || ':' || run")} AS h FROM runs, remainders),
        words AS (
            SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
                sum(times)::BIGINT AS n
            FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(times) >= 5),
        shorter AS (
            SELECT DISTINCT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
            FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
        pairs AS (
            SELECT a.word AS word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
            UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word),
        best AS (
            SELECT word, count(*) AS n_near, max(near_n) AS most,
                first(near ORDER BY near_n DESC, encode(near)) AS near FROM pairs GROUP BY word),
        formed AS (
            SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN most >= 5 * w.n THEN near END AS form,
                CASE WHEN most >= 5 * w.n THEN most END AS form_n
            FROM words w LEFT JOIN best USING (word)),
        followed AS (
            SELECT word, word AS at, form AS next FROM formed
            UNION ALL SELECT f.word, f.next, g.form FROM followed f JOIN formed g ON f.next = g.word)
        SELECT f.word, f.form, r.at AS root, f.n, f.n_near, f.form_n::BIGINT AS form_n
        FROM formed f JOIN followed r ON f.word = r.word AND r.next IS NULL""",
}
