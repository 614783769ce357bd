"""The pipeline: columns of any name, scraps, empty tables, and what each stage leaves."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from .test_operators import WORD, table


def test_stages_keep_columns_of_clashing_names(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(5)
    texts = [" ".join(f"{chr(97 + rng.randrange(26))}{rng.randrange(10**6)}a" for _ in range(40)) for _ in range(40)]
    docs = table(spark, texts, lang=["en"] * 40, source=[f"s{i % 2}" for i in range(40)])
    for name in ("copy", "mix", "row", "size", "words", "runs", "d", "text_hash", "kept", "nth", "a.b"):
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} of "), F.col("doc_id")))
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs_after = stage(spark, docs, str(tmp_path))
        assert docs_after.columns == docs.columns
        rows = docs_after.collect()
        assert rows and all(r[name] == f"{name} of {r.doc_id}" for r in rows for name in ("copy", "mix", "row", "size", "nth", "a.b"))


def test_line_stage_drops_scraps_and_keeps_short_clean_documents(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(6)
    block = "\n".join(" ".join(f"w{rng.randrange(10**6)}" for _ in range(12)) for _ in range(6))
    texts = [block, block + "\nfour words of rest", "short but clean", block + "\n" + " ".join(f"kept{i}" for i in range(20)), None, ""]
    docs = table(spark, texts, lang=["en"] * 6, source=["s"] * 6)
    got = {r.doc_id: r.text for r in corpus_pipeline.line_stage(spark, docs, str(tmp_path)).collect()}
    assert got == {0: block, 2: "short but clean", 3: " ".join(f"kept{i}" for i in range(20)), 4: None, 5: ""}


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_packs_no_blank_document(spark):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        docs = stage(spark, docs, sf_dir)
        assert docs.filter(~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")).isEmpty(), k
        if k:
            assert docs.filter(F.regexp_count("text", F.lit(WORD.pattern)) < 10).isEmpty()
    assert re.fullmatch(r"[a-z ]+", " ".join(name for name, _ in corpus_pipeline.STAGES))


def test_batches_for_python_are_bounded_by_bytes(spark):
    from cartwheel.llm.scratch import Scratch

    def measure(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "size": [batch.nbytes]})

    rows = spark.range(3000, numPartitions=1).select(F.repeat(F.lit("x"), 8000).alias("text"))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    got = Scratch(spark, "batches").table(rows.mapInArrow(measure, "n long, size long"), "sizes").collect()
    assert sum(r.n for r in got) == 3000
    assert max(r.size for r in got) < 8 << 20
    assert spark.conf.get(key) == before


def test_words_of_the_tokenizer_go_with_the_task():
    import public_tokenizers
    import pyarrow as pa

    from cartwheel.llm.packing import _pieces
    from cartwheel.llm.scratch import worker_state

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [f"alpha beta w{i} once more" for i in range(500)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(500)), "text": texts})
    out = pa.Table.from_batches(_pieces(path, 1024, 2, False)(iter([batch])))
    assert out.num_rows == 500
    assert not [k for k, v in worker_state()[f"encoder {path}"].items() if isinstance(v, dict) and (" once" in v or k in ("new", "old"))]
