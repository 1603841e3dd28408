"""The pipeline against a plain version of every stage on the small awkward table."""

import hashlib

from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from eventloom.llm import langid, queries, secrets
from tests.llm.conftest import PASSAGE
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_minhash import brute as near


def test_stages(spark, docs, tmp_path):
    docs = docs.withColumns({"score": F.lit("mine"), "ids": F.lit("mine"), "kept": F.lit(1), "_hash": F.lit(2)})
    folder = str(tmp_path / "t")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, PASSAGE), (2, None), (3, "nowhere")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "")
    rows = sorted(docs.collect(), key=key)
    with_languages = langid.learned(docs).compressors()
    rows = [r for r in rows if not langid.decide(r.text, with_languages)[3]]
    components = {}
    for doc, size, component in near([(r.doc_id, r.text) for r in rows]):
        components[doc] = component if size else doc
    kept, seen = [], set()
    for r in rows:
        if r.doc_id is None:
            twin = next((o for o in rows if o.doc_id is not None and o.text == r.text), None)
            if twin is None:
                kept.append(r)
        elif components[r.doc_id] == r.doc_id and (r.doc_id, r.text) not in seen:
            seen.add((r.doc_id, r.text))
            kept.append(r)
    gone = {k for k, _ in leaks([(i, r.text) for i, r in enumerate(kept)], [(1, PASSAGE), (2, None), (3, "nowhere")])}
    kept = [r for i, r in enumerate(kept) if i not in gone]
    formats = secrets.learned(spark.createDataFrame(kept, docs.schema))
    texts = [secrets.redact(r.text, secrets.spans(r.text, formats)) for r in kept]
    library = Tokenizer.from_file(queries.tokenizer_path())
    expected = []
    for r, t in zip(kept, texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((r.doc_id, None if r.n_chars is None else len(t), len(ids), hashlib.sha256((t or "").encode()).hexdigest(), ids))

    result = corpus_pipeline.run(spark, folder)
    found = [(r.doc_id, r.n_chars, r.n_tokens, r.decoded_sha256, r.ids) for r in result.collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert any("secret]" in (t or "") for t in texts) and 11 not in {r[0] for r in found}


def test_stage_columns_and_empty_tables(spark, docs, no_docs, tmp_path):
    folder = str(tmp_path / "t")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for data in (no_docs, docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, data, folder)
            assert out.columns == data.columns and out.schema == data.schema, name
        assert corpus_pipeline.STAGES[-1][1](spark, data, folder).count() == data.count()
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]
