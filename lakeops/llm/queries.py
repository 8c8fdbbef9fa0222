"""One named query for each operator, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import (
    bpe, collocations, language, mixing, near_vectors, ngram_join, packing, quality, resampling, secrets, token_counts,
    topk, toxicity,
)
from lakeops.llm.common import fold, small_batches, table
from lakeops.workspace import new_folder, stored

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose four-word shingles are 85 % alike."""
    small_batches(spark)
    how = ngram_join.Similarity(words=4, percent=85)
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"), how)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every document, and its round trip."""
    docs = table(spark, sf_dir, "documents")
    coded = bpe.encode_documents(docs, public_tokenizers.path(BYTE_BPE))
    return coded.select(
        F.col("id").alias("doc_id"),
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, each distinct text scanned once."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secrets.BlobLedger(spark, new_folder(spark, "secrets"))
    return secret_digest(secrets.scan_versions(ledger, "documents", docs))


def secret_digest(found: DataFrame) -> DataFrame:
    """Counts and digest of the base kinds, and all spans."""
    kinds = [r.kind for r in secrets.BASE]

    def of(*which):
        return F.filter("spans", lambda s: s.kind.isin(*which))

    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secrets.joined(of(*kinds)), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals of all documents after loading, revising, withdrawing and restoring them.

    Documents are loaded with their number of words; batches by fold of the id replace it by
    the number of tokens. A fold is deleted and inserted again, and one batch is sent twice.
    """
    docs = table(spark, sf_dir, "documents")
    words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w != ""))
    counts = stored(token_counts.counted(docs, public_tokenizers.path(WORD_BPE), "word_bpe_49k"), "counts")
    totals = token_counts.TokenTotals(spark, new_folder(spark, "totals"))
    first = stored(
        docs.select("doc_id", "source", "lang", F.lit("words").alias("tokenizer"), words.cast("long").alias("n_tokens")),
        "words",
    )
    totals.commit("load", token_counts.inserts(first))
    part = F.coalesce(fold("doc_id", 4), F.lit(0))
    for i in (0, 1, 2, 3, 2):
        old, new = first.filter(part == i), counts.filter(part == i)
        totals.commit(f"revise-{i}", token_counts.revisions(old, new))
    totals.commit("withdraw", token_counts.deletes(counts.filter(part == 0)))
    totals.commit("restore", token_counts.inserts(counts.filter(part == 0)))
    return totals.totals()


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best embeddings for every fiftieth, by integer inner product."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token pieces in sequences of at most 2048."""
    docs = table(spark, sf_dir, "documents")
    pieces = packing.pack(docs, public_tokenizers.path(WORD_BPE), capacity=2048, end_id=1)
    return packed_digest(pieces)


def packed_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum of their ids in place of them."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
        "offset",
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels of four folds of five."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.learn(docs, labels, fold("id", 5) != 0)
    return judged(docs, quality.quality_score(model, F.col("text")), fold("doc_id", 5) == 0)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels of three folds of four."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels, fold("id", 4) != 2)
    return judged(docs, toxicity.toxicity_score(model, F.col("text")), fold("doc_id", 4) == 2)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two folds of three."""
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.learn(docs, fold("id", 3) != 1))
    held_out = F.coalesce(fold("id", 3) == 1, F.lit(True))
    return found.select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score")


def judged(docs: DataFrame, score, held_out) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; NULL ids were never learned from."""
    return docs.select(
        "doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates among all embeddings of a label, at a cosine of 0.98."""
    found = near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)
    return found.withColumnRenamed("id", "vec_id")


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources, weighed 5, 2, 1 in turn, takes from every document."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"), pattern=[5, 2, 1], limit=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents, drawn by their likeness to the benchmark texts."""
    return resampling.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=25, buckets=10_000, least_words=20, seed=7
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 phrases of each language whose words occur together most."""
    return collocations.collocations(
        table(spark, sf_dir, "documents"), least=30, most_words=4, share=80, top=2000, scale=2_000_000
    )


QUERIES = {f.__name__: f for f in (op1_ngram_join, op2_bpe, op3_secret_scans, op4_token_counts, op5_top_k, op6_packing, op7_quality, op8_toxicity, op9_language, op10_near_vectors, op11_source_mix, op12_resampling, op13_collocations)}
ORACLES: dict[str, str] = {
    "op5_top_k": """
        WITH v AS (
            SELECT vec_id,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
            FROM (SELECT DISTINCT * FROM v WHERE vec_id % 50 = 0) q
            JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)),
        ranked AS (
            SELECT query_id,
                   CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                   vec_id, score
            FROM scored)
        SELECT * FROM ranked WHERE rank <= 5""",
    "op12_resampling": """
        WITH texts AS (
            SELECT doc_id AS id, true AS own, text FROM documents
            UNION ALL SELECT item_id, false, text FROM benchmark),
        split AS (
            SELECT row_number() OVER () AS row, id, own,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
            FROM texts),
        features AS (
            SELECT row, own, unnest(w) AS feature FROM split
            UNION ALL
            SELECT row, own, w[i] || ' ' || w[i + 1]
            FROM (SELECT row, own, w, unnest(range(1, len(w))) AS i FROM split)),
        steps AS (  -- each byte, then seven zeros: one element for every bit
            SELECT feature, h, list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, len(h) * 4),
                     lambda i: CASE WHEN i % 8 = 0 THEN
                       (instr('0123456789ABCDEF', h[i // 4 + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[i // 4 + 2]) - 1
                       ELSE 0 END)) AS x
            FROM (SELECT feature, hex(feature) AS h FROM (SELECT DISTINCT feature FROM features))),
        crc AS (
            SELECT feature, xor(list_reduce(x, lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384)), 4294967295)
                     % 10000 AS bucket
            FROM steps),
        counts AS (
            SELECT bucket, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t
            FROM features JOIN crc USING (feature) GROUP BY bucket),
        gain AS (
            SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST((SELECT sum(s) FROM counts) + 10000 AS DOUBLE)
                     / (CAST(s + 1 AS DOUBLE) * CAST((SELECT sum(t) FROM counts) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
            FROM counts),
        weighed AS (
            SELECT row, count(*) AS n, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
            FROM features JOIN crc USING (feature) JOIN gain USING (bucket) WHERE own GROUP BY row),
        scored AS (
            SELECT id AS doc_id, len(w) AS words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(id AS VARCHAR), '')), 1, 8)
                     AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
            FROM split LEFT JOIN weighed USING (row) WHERE own),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored)
        SELECT doc_id, n_features, weight, score,
               CASE WHEN words >= 20 AND place <= 25 * (SELECT count(*) FROM scored WHERE words >= 20) // 100
                    THEN place END AS rank
        FROM ranked""",
    "op13_collocations": """
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents),
        words AS (
            SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
        starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
        f AS (
            SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
            FROM starts CROSS JOIN (VALUES (1), (2), (3), (4)) lengths(k)
            WHERE i + k - 1 <= len(w) GROUP BY ALL),
        totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
        found AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 30),
        cuts AS (
            SELECT c.lang, c.phrase, c.a, c.k, j, l.a AS l, r.a AS r,
                   CAST(CAST(2000000 AS HUGEINT) * c.a // (l.a + r.a) AS BIGINT) AS score
            FROM (SELECT *, unnest(range(1, k)) AS j FROM found) c
            JOIN f l ON l.lang = c.lang AND l.k = j AND l.phrase = array_to_string(c.w[1:j], ' ')
            JOIN f r ON r.lang = c.lang AND r.k = c.k - j AND r.phrase = array_to_string(c.w[j + 1:c.k], ' ')),
        best AS (
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS place FROM cuts)
            WHERE place = 1),
        inside AS (
            SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
            FROM (SELECT lang, w, k, a, m, unnest(range(1, k - m + 2)) AS i
                  FROM found CROSS JOIN (VALUES (2), (3)) sizes(m) WHERE m < k) GROUP BY ALL),
        kept AS (
            SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase)
            WHERE longer IS NULL OR 100 * longer < 80 * a),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}
