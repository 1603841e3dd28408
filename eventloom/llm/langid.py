"""Language identification by compression.

Each language has a raw-content zstandard dictionary of training text up to a fixed size.  Of a
text all letters count, in lower case, everything between them as one blank.  It is cut into
chunks, every chunk of it is compressed with every dictionary, and the language with the smallest
total wins.  Where the runner-up is hardly larger, the prediction is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import held_out, numbered

UNKNOWN = "und"
CHUNK = 1024  # bytes compressed at a time; short, so that a text does not become its own dictionary
LEVEL = 3  # with optimal parsing and matches of three bytes: syllables decide here, not phrases
DICTIONARY_BYTES = 64 * 1024
TRAIN_TEXTS = 400  # per language, the bound of the training sample
MIN_MARGIN = 0.002  # share of the smallest size by which the runner-up must be larger
_LETTER = regex.compile(r"\p{L}")
_BETWEEN = regex.compile(r"[^\p{L}]+")


def letters(text: str) -> bytes:
    return _BETWEEN.sub(" ", text.lower()).encode("utf-8", "replace")


def training_rows(docs: DataFrame, train: Column, text: str = "text", lang: str = "lang", per_lang: int = TRAIN_TEXTS) -> DataFrame:
    """(lang, text): up to ``per_lang`` different texts of each language, chosen by hash.

    Ranked on hashes alone; the texts are fetched for the chosen hashes only.
    """
    rows = docs.where(train & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    marked = rows.withColumn("_h", F.xxhash64("text"))
    order = Window.partitionBy("lang").orderBy("_h")
    chosen = marked.select("lang", "_h").distinct().withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_lang).select("lang", "_h")
    return marked.join(F.broadcast(chosen), ["lang", "_h"]).groupBy("lang", "_h").agg(F.min("text").alias("text")).drop("_h")


@dataclass(frozen=True)
class Languages:
    """The dictionaries, by language."""

    content: dict[str, bytes]
    level: int = LEVEL

    @classmethod
    def learn(cls, rows: list[tuple[str, str]], size: int = DICTIONARY_BYTES) -> Languages:
        """Texts in a fixed order, the same share of the dictionary for each, so that long texts do not fill it."""
        by: dict[str, list[bytes]] = {}
        for lang, text in sorted(rows):
            if _LETTER.search(text):
                by.setdefault(lang, []).append(letters(text))
        content = {}
        for lang, texts in by.items():
            share = max(64, size // len(texts))
            joined = b" ".join(t[:share] for t in texts)
            if len(joined) < size:  # short texts left room
                joined += b" " + b" ".join(t[share:] for t in texts if len(t) > share)
            content[lang] = joined[:size]
        return cls(content)

    def compressors(self) -> dict[str, zstandard.ZstdCompressor]:
        how = zstandard.ZstdCompressionParameters.from_level(
            self.level, source_size=CHUNK, dict_size=DICTIONARY_BYTES, min_match=3, strategy=zstandard.STRATEGY_BTOPT,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        out = {}
        for lang in sorted(self.content):
            d = zstandard.ZstdCompressionDict(self.content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=how)
            out[lang] = zstandard.ZstdCompressor(dict_data=d, compression_params=how)
        return out


def sizes(text: str, compressors: dict[str, zstandard.ZstdCompressor]) -> dict[str, int]:
    data = letters(text)
    chunks = [data[i : i + CHUNK] for i in range(0, len(data), CHUNK)]
    return {lang: sum(len(c.compress(x)) for x in chunks) for lang, c in compressors.items()}


def decide(text: str | None, compressors: dict[str, zstandard.ZstdCompressor], min_margin: float = MIN_MARGIN) -> tuple[str, float, float | None, bool]:
    """(language, score, margin, rejected).

    The score reads sizes as code lengths: the winner's share of 2^-size over all languages.  The
    margin is the runner-up's excess as a share of the smallest size; with one language it is NULL.
    Ties go to the first name and are rejected.  A text that is NULL or has no letter is ``und``,
    score 0, rejected; so is everything when nothing was learned.
    """
    if not compressors or not text or not _LETTER.search(text):
        return UNKNOWN, 0.0, None, True
    by = sizes(text, compressors)
    ranked = sorted(by, key=lambda lang: (by[lang], lang))
    best = by[ranked[0]]
    score = 1.0 / sum(2.0 ** (8 * max(best - s, -100)) for s in by.values())
    if len(ranked) == 1:
        return ranked[0], score, None, False
    margin = (by[ranked[1]] - best) / best
    return ranked[0], score, margin, margin <= min_margin


def identify(docs: DataFrame, languages: Languages, text: str = "text", carry: tuple[str, ...] = ("doc_id",), min_margin: float = MIN_MARGIN, prefix: str = "") -> DataFrame:
    """The ``carry`` columns with lang_pred, score, margin and rejected, for every row.

    ``prefix`` is put before the new names where carried columns may have them already.
    """
    names = [f"{prefix}{n}" for n in ("lang_pred", "score", "margin", "rejected")]
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    out = ", ".join([f"`{c}` {fields[c]}" for c in carry] + [f"`{n}` {t}" for n, t in zip(names, ("string", "double", "double", "boolean"), strict=True)])

    def run(batches):
        compressors = languages.compressors()
        for batch in batches:
            found = [decide(t, compressors, min_margin) for t in batch.column("_text").to_pylist()]
            lang, score, margin, rejected = zip(*found, strict=True) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(1, batch.num_columns)]
                + [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[*carry, *names],
            )

    return numbered(docs, text, carry).mapInArrow(run, out)


def learned(docs: DataFrame, train: Column | None = None) -> Languages:
    """Dictionaries from the training fold of documents; the collected sample is bounded by TRAIN_TEXTS."""
    train = ~held_out(F.col("doc_id")) if train is None else train
    return Languages.learn([tuple(r) for r in training_rows(docs, train).collect()])
