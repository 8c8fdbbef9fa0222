"""Every query of the training-data operators: columns, SQL, and the pipeline step by step."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakeops.llm import queries
from lakeops.workspace import stored

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_ngram_join": ["doc_id", "n_shingles", "component_id"],
    "op2_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op3_secret_scans": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op4_token_counts": ["source", "lang", "tokenizer", "n_docs", "n_tokens"],
    "op5_top_k": ["query_id", "rank", "vec_id", "score"],
    "op6_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op7_quality": ["doc_id", "held_out", "score", "predicted"],
    "op8_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op9_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op10_near_vectors": ["vec_id", "n_links", "component_id", "kept"],
    "op11_source_mix": ["doc_id", "size", "source_size", "target", "taken", "source", "copies"],
    "op12_resampling": ["doc_id", "n_features", "weight", "score", "rank"],
    "op13_collocations": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, name):
    got = queries.QUERIES[name](spark, SF_DIR)
    assert got.columns == COLUMNS[name]
    wanted = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    if name not in ("op4_token_counts", "op5_top_k", "op6_packing", "op10_near_vectors", "op13_collocations"):
        assert got.count() == wanted
    else:
        assert got.count() > 0


@pytest.mark.parametrize("name", queries.ORACLES)
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    got = queries.QUERIES[name](spark, SF_DIR)
    want = con.execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    ordered = lambda rows: sorted(map(tuple, rows), key=lambda r: [(v is None, v) for v in r])
    assert ordered(got.select(names).collect()) == ordered(want.fetchall())


def test_totals_are_those_of_the_documents(spark, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path(queries.WORD_BPE))
    want = {}
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        n, tokens = want.get((r.source, r.lang, "word_bpe_49k"), (0, 0))
        found = len(coder.encode(r.text or "", add_special_tokens=False).ids)
        want[r.source, r.lang, "word_bpe_49k"] = (n + 1, tokens + found)
    got = queries.QUERIES["op4_token_counts"](spark, SF_DIR).collect()
    assert {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in got} == want


def test_pipeline(spark):
    """Each stage on what the one before kept, against its operator's own result."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_copies", "secrets", "packing"]
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stored(stage(spark, seen[-1], SF_DIR), f"test-{name}"))
    good, civil, single, masked, packed = seen[1:]
    for frame in seen[1:5]:
        assert frame.columns == docs.columns
    assert good.exceptAll(docs).count() == civil.exceptAll(good).count() == single.exceptAll(civil).count() == 0
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    lost = docs.join(labels, "doc_id").filter("quality = 1").join(good, "doc_id", "left_anti").count()
    assert lost <= 0.05 * labels.filter("quality = 1").count()

    from tests.llm.test_ngram_join import brute

    group = brute([(r.doc_id, r.text) for r in civil.collect()], 5, 80)
    assert {r.doc_id for r in single.collect()} == {low for i, (n, low) in group.items() if n or low == i}

    from tests.llm.test_secrets import brute as found

    before = {r.doc_id: r.text for r in single.collect()}
    after = {r.doc_id: (r.text, r.n_chars) for r in masked.collect()}
    assert before.keys() == after.keys()
    for i, text in before.items():
        assert (after[i][0] != text) == bool(found(text)) and not found(after[i][0])
        assert after[i][1] == len(after[i][0])
    ids = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    assert ids.filter("n <> all").count() == 0 and ids.count() == masked.count()
    assert corpus_pipeline.run(spark, SF_DIR).count() == packed.count()
