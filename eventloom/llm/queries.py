"""The registered queries of this subpackage: name -> (spark, folder) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import bpe, chat, decontaminate, embedding_dedup, langid, minhash, neighbours, quality, runs, secrets, spelling, token_counts, toxicity
from eventloom.llm.common import held_out, ship, stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(fn):
    @wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return fn(spark, folder)

    QUERIES[fn.__name__] = run
    return run


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    return public_tokenizers.path(name)


@query
def op1_toxic_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The probabilities of the chain for every document, and whether the last model finds it toxic."""
    docs = table(spark, folder, "documents")
    chain = toxicity.learned(docs, table(spark, folder, "labels"))
    found = toxicity.scored(docs, chain)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "p_quality", "p_toxic", (F.col("p_toxic") >= chain.threshold).alias("toxic"))


@query
def op2_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all embeddings."""
    return embedding_dedup.near_vectors(table(spark, folder, "embeddings"))


ORACLES["op2_near_vectors"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND list_inner_product(embedding, embedding) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
), reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a
), least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id
), counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least USING (vec_id) LEFT JOIN counts USING (vec_id)
"""


@query
def op3_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Every whole document encoded by the pair occurrence index and decoded again."""
    return bpe.round_trip(table(spark, folder, "documents"), tokenizer_path(), outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


@query
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality of every document by its nearest labelled documents; learned on the training folds."""
    docs = table(spark, folder, "documents")
    found = quality.scored(docs, quality.learned(docs, table(spark, folder, "labels")))
    predicted = F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


@query
def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Near-copy groups of all documents."""
    return minhash.near_duplicates(table(spark, folder, "documents")).drop("text_hash", "group_id")


ORACLES["op5_near_duplicates"] = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM words
), shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS sh FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, p.b FROM reach r JOIN pairs p ON r.other = p.a
)
SELECT d.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.c AS component_id, d.doc_id = r.c AS kept
FROM documents d JOIN sets s USING (doc_id) JOIN (SELECT doc_id, min(other) AS c FROM reach GROUP BY doc_id) r USING (doc_id)
"""


@query
def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations that are no logged prefix of a longer one, rendered."""
    return chat.formatted(table(spark, folder, "conversations"))


ORACLES["op6_chat_format"] = f"""
WITH r AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
said AS (
  SELECT conv_id, turn, string_agg(concat('<', coalesce('r' || role, 'n'), '><', coalesce('t' || text, 'n'), '>'), '|' ORDER BY role NULLS FIRST, text NULLS FIRST) AS s
  FROM r GROUP BY conv_id, turn
), prefixes AS (
  SELECT conv_id, turn, md5(string_agg(concat(turn, ':', s), chr(30)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST)) AS h,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST) = 1 AS last FROM said
), kept AS (
  SELECT min(conv_id) AS conv_id, count(*) AS copies FROM prefixes
  WHERE last AND h NOT IN (SELECT h FROM prefixes WHERE NOT last) GROUP BY h
)
SELECT conv_id, CAST(floor(coalesce(turn, 0) / {chat.BLOCK}) AS BIGINT) AS part, copies, count(*) AS n_turns,
  string_agg(concat('<|', role, '|>', chr(10), text, chr(10), '<|end|>', chr(10)), '' ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS chat
FROM kept JOIN r USING (conv_id) GROUP BY ALL
"""


@query
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document by its smallest compressed size; learned on the training folds."""
    docs = table(spark, folder, "documents")
    found = langid.identify(docs, langid.learned(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "margin", "rejected")


@query
def op8_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a passage of a test item, substitutions tolerated."""
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def leak_sql() -> str:
    """Masked windows as text keys, joined; then the best aligned stretch around each hit."""
    d = decontaminate

    def windows(words: str, rows: str) -> str:
        keys = ", ".join("concat_ws(' ', " + f"'{i}', " + ", ".join(f"w[p + {k}]" for k in m) + ")" for i, m in enumerate(d.MASKS))
        return f"SELECT *, unnest([{keys}]) AS k FROM (SELECT *, unnest(range(1, len(w) - {d.SPAN - 2})) AS p FROM {rows})"

    same = " + ".join(f"(coalesce(dw[dp + o + {k}] = iw[ip + o + {k}] AND ip + o + {k} > 0 AND dp + o + {k} > 0, false))::INT" for k in range(d.REACH))
    token = f"regexp_extract_all(lower(coalesce(text, '')), '{d.TOKEN}')"
    return f"""
WITH docs AS (SELECT doc_id, {token} AS w FROM documents),
items AS (SELECT min(item_id) AS item_id, w FROM (SELECT item_id, {token} AS w FROM benchmark) GROUP BY w),
dk AS ({windows('w', 'docs')}), ik AS ({windows('w', 'items')}),
hits AS (SELECT dk.doc_id, ik.item_id, dk.p AS dp, ik.p AS ip, dk.w AS dw, ik.w AS iw, unnest(range(-{d.BEFORE}, 1)) AS o, dk.k AS k FROM dk JOIN ik USING (k)),
counted AS (SELECT doc_id, item_id, dp, ip, k, {same} AS m, ceil(least(len(iw), {d.REACH}) * {d.SHARE}) AS need FROM hits)
SELECT doc_id, item_id, CAST(max(m) AS BIGINT) AS matched_tokens, count(DISTINCT (dp, ip, k)) AS n_hits
FROM counted GROUP BY doc_id, item_id, need HAVING max(m) >= need
"""


ORACLES["op8_benchmark_leaks"] = leak_sql()


@query
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Exact totals and truncated totals of encoded lengths, for every length as a context limit."""
    histo = stored(token_counts.histogram(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.tiktoken")), "lengths")
    return token_counts.suffix_sums(histo)


@query
def op10_secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document: fixed patterns, and formats learned from what those label."""
    docs = table(spark, folder, "documents")
    found = secrets.scan(docs, secrets.learned(docs)).withColumn("_base", F.filter("found", lambda s: s["kind"] != "grammar"))

    def joined(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(joined("_base"), 256).alias("base_sha256"), joined("found").alias("spans"),
    )


@query
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """The words of all documents with the commoner word that each is a misspelling of."""
    return spelling.variants(spelling.vocabulary(table(spark, folder, "documents"), typos=True))


@query
def op12_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest rows of every embedding whose id is divisible by 20."""
    found = neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.select(F.col("query").alias("query_id"), "rank", "vec_id", "score")


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words of every whole document, after the tails of some are repeated."""
    return runs.digest(runs.periodic_runs(table(spark, folder, "documents"), echo=True))
