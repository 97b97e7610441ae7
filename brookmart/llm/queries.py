"""Registered queries of the training-data operators, and the SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmart.llm.bpe import decode_ids, encode_texts
from brookmart.llm.common import importable, table
from brookmart.llm.decontamination import find_leaks, leak_rows
from brookmart.llm.exact_dedup import exact_dedup
from brookmart.llm.extraction import extract_text
from brookmart.llm.hard_negatives import hard_negatives
from brookmart.llm.jaccard_join import near_duplicates
from brookmart.llm.language import held_out, identify, learn
from brookmart.llm.mixing import mix_sources
from brookmart.llm.phrases import mine_phrases
from brookmart.llm.quality import score_quality
from brookmart.llm.secret_scan import scan_secrets
from brookmart.llm.token_files import tokenise
from brookmart.llm.warc import archive


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    mixed = mix_sources(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


def op2_extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    return extract_text(table(spark, sf_dir, "pages"))


def op3_score_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each document."""
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_scan_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document."""
    return scan_secrets(table(spark, sf_dir, "documents"))


def op5_find_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, a row for each document and item."""
    return leak_rows(find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"]))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near copies of each document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_identify_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of each document."""
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 3, 1)
    found = identify(docs.select("doc_id", "text"), learn(docs.where(~out)))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document of each text stays."""
    importable(spark)
    return exact_dedup(spark, f"{sf_dir}/documents.parquet")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's place in the token files, and a checksum of its ids as read back."""
    import public_tokenizers

    return tokenise(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page as read back from its archive."""
    importable(spark)
    pages = archive(spark, f"{sf_dir}/pages.parquet")
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_mine_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language."""
    return mine_phrases(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh label is made wrong first."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op13_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of each document, and of the text that they decode to."""
    import public_tokenizers

    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    ids = encode_texts(table(spark, sf_dir, "documents"), tokenizer)
    digested = ids.select("doc_id", "ids", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"))
    texts = decode_ids(digested, tokenizer, keep=["doc_id", "n_tokens", "ids_sha256"])
    return texts.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_extract_text, op3_score_quality, op4_scan_secrets, op5_find_leaks, op6_jaccard_join, op7_identify_language, op8_exact_dedup, op9_token_files, op10_warc,
    op11_mine_phrases, op12_hard_negatives, op13_bpe_trie,
)}

SQL = {
    "op1_mix_sources": r"""
        WITH sized AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                length(coalesce(text, '')) AS chars, length(regexp_replace(coalesce(text, ''), '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) AS letters,
                (('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
            FROM documents),
        keyed AS (
            SELECT doc_id, source, size,
                -ln(u) / (0.05::DOUBLE + 0.95::DOUBLE * least(letters::DOUBLE / greatest(chars - size, 1)::DOUBLE, 1.0::DOUBLE)) AS key
            FROM sized),
        sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM keyed GROUP BY source),
        ranked AS (
            SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
                [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM sizes),
        levels AS (
            SELECT *, sum(source_size) OVER () AS all_size, sum(w) OVER () AS all_w,
                coalesce(sum(cap) OVER before, 0) AS capped, coalesce(sum(w) OVER before, 0) AS capped_w
            FROM ranked WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        goals AS (
            SELECT source, source_size,
                least(cap, w * max((1.5::DOUBLE * all_size::DOUBLE - capped) / (all_w - capped_w)) OVER ()) AS target FROM levels),
        placed AS (
            SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs,
                coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS LAST, size
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM keyed k JOIN goals g ON k.source IS NOT DISTINCT FROM g.source)
        SELECT doc_id, size, source_size, target, (epochs * size + greatest(0,
            least(size, floor(target - (epochs * source_size)::DOUBLE + 0.5)::BIGINT - before)))::BIGINT AS taken
        FROM placed""",
    "op8_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
            row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
        FROM t""",
    "op10_warc": """
        WITH t AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex,
                min(page_id) OVER (PARTITION BY payload) AS first_id,
                row_number() OVER (PARTITION BY payload ORDER BY page_id NULLS LAST) AS n FROM t)
        SELECT page_id, payload_bytes,
            array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((('0x' || substr(hex, (i // 4 * 5 + 1)::INTEGER, 5))::BIGINT >> (15 - i % 4 * 5)::INTEGER) & 31)::INTEGER + 1, 1) FOR i IN range(32)], '') AS payload_digest,
            CASE WHEN n = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN n > 1 THEN first_id END AS refers_to
        FROM d""",
    "op11_mine_phrases": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
        grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*)::BIGINT AS f
            FROM places, range(1, 6) sizes(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
        totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
        found AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f FROM grams WHERE f >= 100),
        parts AS (SELECT lang, k, phrase, w, f AS a, unnest(range(1, k)) AS cut FROM found WHERE k >= 2),
        cuts AS (
            SELECT p.lang, p.k, p.phrase, p.a, x.f AS l, y.f AS r, n, cut,
                ((1000::HUGEINT * p.a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
            FROM parts p JOIN totals USING (lang)
            JOIN found x ON x.lang = p.lang AND x.phrase = array_to_string(p.w[1:cut], ' ')
            JOIN found y ON y.lang = p.lang AND y.phrase = array_to_string(p.w[cut + 1:], ' ')),
        best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        inside AS (SELECT DISTINCT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, f
            FROM found, range(2, 5) shorter(m), range(1, 5) starts(i) WHERE m < k AND i + m - 1 <= k)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
        FROM best b WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.phrase = b.phrase AND i.f >= b.a)
        QUALIFY rank <= 2000""",
    "op12_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                [floor(256 * x::DOUBLE) FOR x IN embedding] AS vec
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same, list_dot_product(a.vec, x.vec)::BIGINT AS score
            FROM v a JOIN v x ON a.vec_id <> x.vec_id WHERE a.vec_id % 100 = 0),
        positive AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
            vec_id AS negative_id, positive_score, score AS negative_score
        FROM positive JOIN scored USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score QUALIFY rank <= 5""",
}
