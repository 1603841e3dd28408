"""The encoder against the tokenizers library, and the round trip."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventloom.llm import bpe, queries
from eventloom.llm.common import table
from tests.conftest import SF

PATH = queries.tokenizer_path()


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60) | st.text("ab ", max_size=40) | st.sampled_from(["aaaaaaaaaa", "<|endoftext|>", "  x\n\n ", "'s't I'll"]), max_size=6))
def test_encoder_equals_library(library, texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    found = bpe.Encoder(PATH).encode(texts)
    assert [f.tolist() for f in found] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_awkward_rows(spark, docs, no_docs, library):
    clashing = docs.withColumns({"ids": F.lit("mine"), "n_tokens": F.lit(1), "_text": F.lit(2)})
    rows = bpe.round_trip(clashing, PATH, carry=("doc_id", "ids", "_text"), outputs=("n_tokens", "ids_sha256", "decoded_sha256"), prefix="p_")
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(expected(library, r.text))
    found = {}
    for r in rows.collect():
        assert (r.ids, r._text) == ("mine", 2)
        found.setdefault(r.doc_id, []).append((r.p_n_tokens, r.p_ids_sha256, r.p_decoded_sha256))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in texts.items()}
    assert bpe.round_trip(no_docs, PATH).count() == 0


def test_query_and_decoding(spark, library):
    docs = table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = queries.QUERIES["op3_bpe_round_trip"](spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == {i: expected(library, t) for i, t in texts.items()}
    encoded = bpe.round_trip(docs, PATH, outputs=("ids",))
    assert {r.doc_id: r.text for r in bpe.decoded(encoded, PATH).collect()} == {i: t or "" for i, t in texts.items()}


def test_blocks_bound_the_text_held():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 5, None, "b" * 50, "", "c" * 3])], names=["t"])
    assert [b.num_rows for b in bpe.blocks([batch], "t", 10)] == [2, 1, 2]
