"""Spelling variants by a bit-sliced position index.

For each position and letter the index holds a bitset over the vocabulary: which words have that
letter there.  A word is compared with all of them at once.  Letter by letter two sets are carried
on, the words that agree so far and those that agree but for one error: a replaced letter keeps the
position, an inserted one reads the position after, a deleted one the position before.  The words
left in the second set at the end are one edit away.

The vocabulary is laid out so that no index grows with it.  Two words of one edit share the first or
the last half of their letters, so a word is indexed under both halves and looked up among words of
its own and the neighbouring lengths; groups of equal halves are cut and packed into indexes of
about BLOCK_WORDS words.  What is found under the last half counts only where the first halves
differ, which the set of words that agree so far tells, so every pair is found once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import starts, stored, whole_groups

LETTERS = "[a-zÀ-ÿ]+"  # after A-Z are lower-cased
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LETTERS = 7
LEAST_COUNT = 2
RARER = 10  # how much rarer than its form a word must be
TYPO = 31
BLOCK_WORDS = 1024
BLOCK_LETTERS = 2_000_000


def with_typo(key: Column, word: Column) -> Column:
    """The word, or for one in TYPO (by key and word) the word without one letter; a NULL key is empty."""
    h = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    cut = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(h % TYPO == 0, cut).otherwise(word)


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", typos: bool = False) -> DataFrame:
    """(word, n): the words of LEAST_LETTERS letters or more that occur LEAST_COUNT times or more.

    Words are maximal runs of LETTERS.  NULL and empty texts have none, repeated rows count as often
    as they stand, texts of any length are read whole.  ``typos`` first removes a letter of some
    occurrences (see ``with_typo``).  Occurrences are counted before they are shuffled.
    """
    rows = docs.select(F.col(key).alias("_key"), F.explode(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(LETTERS), F.lit(0))).alias("word"))
    rows = rows.where(F.length("word") >= LEAST_LETTERS)
    if typos:
        rows = rows.select(with_typo(F.col("_key"), F.col("word")).alias("word")).where(F.length("word") >= LEAST_LETTERS)
    return rows.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def letters_of(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1)


class PositionIndex:
    """Bitsets over words of one length, one for every position and letter."""

    def __init__(self, words: list[str]):
        self.codes = letters_of(words)
        self.alphabet, self.numbers = np.unique(self.codes, return_inverse=True)
        self.numbers = self.numbers.reshape(self.codes.shape)
        self.width = -(-len(words) // 64)
        self.held: dict[int, np.ndarray] = {}

    def at(self, position: int) -> np.ndarray:
        """The bitsets of all letters at a position, then an empty one; few positions are held at a time."""
        if position not in self.held:
            bits = np.zeros((len(self.alphabet) + 1, self.width * 64), dtype=bool)
            bits[self.numbers[:, position], np.arange(len(self.numbers))] = True
            if len(self.held) > 256:
                self.held.clear()
            self.held[position] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
        return self.held[position]

    def numbered(self, words: list[str]) -> np.ndarray:
        """The letters of the words by their number here; a letter no word has gets the empty bitset."""
        codes = letters_of(words)
        n = np.searchsorted(self.alphabet, codes)
        n[n == len(self.alphabet)] = 0
        return np.where(self.alphabet[n] == codes, n, len(self.alphabet))

    def one_error(self, words: list[str], half: int) -> tuple[np.ndarray, np.ndarray]:
        """Per word (of one length) two bitsets: the words one edit away, and those that share the first
        ``half`` letters."""
        length, asked = self.codes.shape[1], self.numbered(words)
        size = asked.shape[1]
        shape = (len(words), self.width)
        zero = np.full(shape, np.uint64(0xFFFFFFFFFFFFFFFF))
        one = np.zeros(shape, np.uint64) if length <= size else zero.copy()
        same = zero
        for i in range(size):
            letter = asked[:, i]
            if length < size:  # the word has one letter more, left out here or before
                one = (one & self.at(i - 1)[letter]) | zero if i else zero.copy()
                zero = zero & self.at(i)[letter] if i < length else zero
            elif length == size:
                has = self.at(i)[letter]
                one = (one & has) | (zero & ~has)
                zero = zero & has
            else:  # the word has one letter less, which these have after this letter or had before
                zero = zero & self.at(i)[letter]
                one = (one & self.at(i + 1)[letter]) | zero
            if i + 1 == half:
                same = zero
        spare = self.width * 64 - len(self.codes)
        if spare:
            one[:, -1] &= np.uint64(0xFFFFFFFFFFFFFFFF) >> np.uint64(spare)
        return one, same


def members(bitsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bit) of every set bit."""
    rows = np.flatnonzero(bitsets.any(axis=1))
    bits = np.unpackbits(np.ascontiguousarray(bitsets[rows]).view(np.uint8), axis=1, bitorder="little")
    r, b = np.nonzero(bits)
    return rows[r], b


def _block(words: list[str], n: list[int], asked: list[str], last: bool):
    """(word, near words, the commonest of them and its n) of the words that have any here."""
    index, length = PositionIndex(words), len(words[0])
    count = np.array(n, dtype=np.int64)
    rank = np.empty(len(words), dtype=np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    for size in (length - 1, length, length + 1):
        mine = list(dict.fromkeys(w for w in asked if len(w) == size))
        for at in range(0, len(mine), BLOCK_WORDS):
            part = mine[at : at + BLOCK_WORDS]
            one, same = index.one_error(part, length // 2)
            q, v = members(one & ~same if last else one & same)
            order = np.lexsort((rank[v], -count[v], q))
            q, v = q[order], v[order]
            first = np.flatnonzero(np.diff(q, prepend=-1))
            for i, j in zip(first.tolist(), [*first[1:].tolist(), len(q)], strict=False):
                yield part[q[i]], j - i, words[v[i]], n[v[i]]


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best: (rarity, word)) for the rows of ``words`` (word, n) with near words: how many words
    differ by exactly one inserted, deleted or replaced code point, and the commonest (ties: the smallest)."""
    size, half = F.length("word"), F.expr("span div 2")

    def sides(rows: DataFrame) -> DataFrame:
        ends = F.array(F.struct(F.lit(False).alias("last"), F.left("word", half).alias("part")), F.struct(F.lit(True).alias("last"), F.right("word", half).alias("part")))
        return rows.withColumn("_end", F.explode(ends)).select("span", "_end.last", "_end.part", "word", "n")

    group = ["span", "last", "part"]
    indexed = sides(words.withColumn("span", size))
    lookups = sides(words.select("word", F.lit(None).cast("long").alias("n"), F.explode(F.array(size - 1, size, size + 1)).alias("span")))
    weight = F.greatest(F.ceil(F.count("*") / BLOCK_WORDS), F.ceil(F.sum(size) / BLOCK_LETTERS)).cast("int")
    sizes = stored(indexed.groupBy(*group).agg(F.count("*").alias("rows"), weight.alias("cuts")), "spelling-sizes")
    # A word alone in its group meets nobody of its own length there.
    lookups = lookups.join(sizes, group).where("rows > 1 or length(word) <> span")
    mine, every = F.pmod(F.xxhash64("word"), F.col("cuts")).cast("int"), F.sequence(F.lit(0), F.col("cuts") - 1)
    indexed = indexed.join(sizes, group).select(*group, mine.alias("i"), F.explode(every).alias("j"), "word", "n")
    lookups = lookups.select(*group, F.explode(every).alias("i"), mine.alias("j"), "word", "n")
    cell = [*group, "i", "j"]

    def compared(rows: pa.Table):
        n, word = rows.column("n").to_pylist(), rows.column("word").to_pylist()
        have = [k for k, x in enumerate(n) if x is not None]
        asked = [w for w, x in zip(word, n, strict=True) if x is None]
        if have and asked:
            found = list(_block([word[k] for k in have], [n[k] for k in have], asked, rows.column("last")[0].as_py()))
            if found:
                w, k, best, m = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(k, pa.int64()), pa.array(best, pa.string()), pa.array(m, pa.int64())], names=["word", "near", "best", "m"])

    def packed(batches):
        """Consecutive whole cells of one length and side, about an index full at a time; two cells of one
        group never, because they share words."""
        for table in whole_groups(batches, cell):
            marks = table.column("n").to_pylist()
            groups = list(zip(*(table.column(c).to_pylist() for c in group), strict=True))
            edges, begin, held = [*starts(table, cell), table.num_rows], 0, 0
            for a, b in zip(edges, edges[1:], strict=False):
                new = sum(x is not None for x in marks[a:b])
                span = groups[a][0]
                if a > begin and (held + new > BLOCK_WORDS or (held + new) * span > BLOCK_LETTERS or groups[a][:2] != groups[begin][:2] or groups[a] == groups[a - 1]):
                    yield from compared(table.slice(begin, a - begin))
                    begin, held = a, 0
                held += new
            if table.num_rows > begin:
                yield from compared(table.slice(begin))

    met = indexed.unionAll(lookups).repartition(*cell).sortWithinPartitions(*cell)
    found = met.mapInArrow(packed, "word string, near long, best string, m long")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("m")).alias("rarity"), F.col("best").alias("word"))).alias("best"))


def rooted(forms: DataFrame, most: int) -> DataFrame:
    """(word, root) of the words that have a form: the end of their chain of forms.

    Each form is RARER times as common as its word, so chains are as short as the logarithm of ``most``, the
    largest count; every round doubles what a word has followed.
    """
    roots = forms.select("word", F.col("form").alias("root"))
    longest, count = 1, RARER * RARER
    while count <= most:
        longest, count = longest + 1, count * RARER
    for _ in range(math.ceil(math.log2(longest))):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = stored(roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    return roots


def variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of ``words`` (word, n), each word once.

    ``form`` is the commonest near word, if RARER times as common as the word, ``root`` the end of the chain
    of forms (the word itself without one).  Ties go to the smallest word in code-point order.  An
    empty vocabulary gives an empty table.  Words of any length and script are compared whole.
    """
    words = stored(words.select("word", "n"), "spelling-words")
    best, n = F.col("best"), F.col("n")
    form = F.when(-best["rarity"] >= RARER * n, best["word"])
    found = words.join(near_words(words), "word", "left").select(
        "word", form.alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(form.isNotNull(), -best["rarity"]).alias("form_n")
    )
    found = stored(found, "spelling-forms")
    formed = found.where("form is not null")
    most = found.agg(F.max("n")).first()[0] or 0
    return found.join(rooted(formed, most), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
