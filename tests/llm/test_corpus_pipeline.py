import corpus_pipeline
from tillwise.llm import queries, quality


def test_stages_take_effect(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, small)
        assert found.columns == columns
        rows = found.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        if name != "mixing":
            assert 0 < len(rows) <= before
            before = len(rows)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
    assert len(last) == docs.count() and last[0].n_tokens > 0


def test_clean_documents_pass_the_rules(spark, small):
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.assess(docs, labels).join(labels, "doc_id")
    clean = judged.where("quality = 1 AND NOT base_failed").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    junk = judged.where("quality = 0").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert clean == 1.0 and junk < 0.2


def test_stages_take_odd_documents(spark, clashing, nothing, small):
    for frame in (clashing, nothing.select("*")):
        docs = frame
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, small)
            if name != "tokens":
                assert found.columns == frame.columns
            assert found.count() <= 2 * max(1, frame.count())


def test_registered_queries_have_their_columns(spark, small):
    columns = {
        "op1_simhash": "doc_id fingerprint component_id",
        "op3_html": "page_id url text n_chars",
        "op4_mixing": "doc_id size source_size target taken",
        "op5_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op6_repeats": "doc_id n_bytes n_removed n_spans kept_sha256",
        "op7_tokens": "doc_id start n_tokens ids_crc32",
        "op8_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
        "op9_toxicity": "doc_id held_out score predicted",
        "op11_manifest": "doc_id leaf subroot root proof_sha256 folded_root verified",
        "op12_whitening": "vec_id component n deviation whitened explained identity_error",
        "op13_warc": "page_id payload_bytes payload_digest record_type refers_to",
        "pipeline": "doc_id start n_tokens ids_crc32",
    }
    for name, wanted in columns.items():
        assert set(wanted.split()) <= set(queries.queries()[name](spark, small).columns)
