"""The histogram's answers against the lengths themselves."""

from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventloom.llm import queries
from eventloom.llm import token_counts as t
from eventloom.llm.common import table
from tests.conftest import SF

PATH = queries.tokenizer_path("byte_bpe_50k.tiktoken")


def test_every_limit(spark):
    library = Tokenizer.from_file(queries.tokenizer_path())
    library.encode_special_tokens = True
    lengths = [len(library.encode(r.text or "", add_special_tokens=False).ids) for r in table(spark, SF, "documents").collect()]
    rows = queries.QUERIES["op9_token_counts"](spark, SF).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(set(lengths))
    for r in rows:
        n = r.n_tokens
        assert r.docs == lengths.count(n) and r.docs_over == sum(x > n for x in lengths) and r.tokens_over == sum(x for x in lengths if x > n)
        assert r.truncated_tokens == sum(min(x, n) for x in lengths)
        assert (r.total_docs, r.total_tokens) == (len(lengths), sum(lengths))
        assert abs(r.quantile - sum(x <= n for x in lengths) / len(lengths)) < 1e-12


def test_limits_and_quantiles_over_buckets(spark):
    lengths = [0, 0, 3, 9, 10, 11, 25, 100, 100, 4095]
    histo = spark.createDataFrame([(n, lengths.count(n)) for n in sorted(set(lengths))], "n_tokens long, docs long")
    sums = t.suffix_sums(histo, bucket=8)
    for r in t.at_limits(sums, [0, 2, 10, 99, 100, 5000]).collect():
        assert r.truncated_tokens == sum(min(x, r.context_limit) for x in lengths) and r.docs_over == sum(x > r.context_limit for x in lengths)
    found = {r.share: r.n_tokens for r in t.quantiles(sums, [0.1, 0.5, 0.55, 1.0]).collect()}
    assert found == {0.1: 0, 0.5: 10, 0.55: 11, 1.0: 4095}


def test_awkward_rows(spark, docs, no_docs):
    clashing = docs.withColumns({"n_tokens": F.lit(7), "docs": F.lit(8)})
    rows = t.histogram(clashing, PATH).collect()
    assert sum(r.docs for r in rows) == docs.count()
    assert next(r.docs for r in rows if r.n_tokens == 0) == 2  # NULL and empty
    empty = t.suffix_sums(t.histogram(no_docs, PATH))
    assert empty.count() == 0
    assert [tuple(r) for r in t.at_limits(empty, [5]).collect()] == [(5, 0, 0)]
    assert [tuple(r) for r in t.quantiles(empty, [0.5]).collect()] == [(0.5, None)]
