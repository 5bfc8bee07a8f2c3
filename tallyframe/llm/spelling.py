"""Spelling variants by blocked Gram matrices (operator 12).

1. Words are counted over whole texts; those that are long and frequent enough are the vocabulary.
2. The alphabet is split into groups of letters.  A block holds words with equal numbers of letters
   of each group, so of equal length; one edit leads from a block to itself, to blocks with a letter
   more of one group (adjacent lengths), or with one letter of a group exchanged for another's.
   Blocks meet these neighbours, and no others, by an equality join.
3. For two blocks the squared distances of the words' letter counts come from one product of their
   count matrices.  One edit changes them by at most 2 (1 between adjacent lengths), so pairs
   within that are verified letter by letter, and the others are at least two edits apart.
4. A word's form is its most frequent near word, if that is frequent enough; forms are followed to
   their root by pointer jumping.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written

#: Runs of these letters are words.
LETTERS = "[A-Za-zÀ-ÿ]+"
#: Letter groups of about equal frequency; all other letters are the last group.
GROUPS = ("eqx", "anj", "itz", "osk", "rlv")
#: Letters of all words of a block, at most (or one word).
BLOCK_LETTERS = 4096
#: Blocks that a task keeps in working form.
MET_BLOCKS = 256
_G = [f"g{i}" for i in range(len(GROUPS) + 1)]


def fold(c: Column) -> Column:
    """A-Z to lower case, other letters as they are."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 1) -> DataFrame:
    """``(id, word)``: every run of letters of at least ``least`` letters, folded."""
    found = docs.select(F.col(f"`{id_col}`").alias("id"), F.explode(F.regexp_extract_all(
        F.col(f"`{text_col}`"), F.lit(LETTERS), F.lit(0))).alias("word"))
    return found.filter(F.char_length("word") >= least).select("id", fold(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, letters: int = 6, occurrences: int = 5) -> DataFrame:
    """``(word, n)`` of the words with at least so many letters and occurrences.  Counts are summed
    before they are shuffled, so a frequent word costs no more than a rare one."""
    return words.filter(F.char_length("word") >= letters).groupBy("word").agg(
        F.count("*").alias("n")).filter(F.col("n") >= occurrences)


# Blocks --------------------------------------------------------------------------------
def _moves() -> list[tuple[int, ...]]:
    """Changes of the group counts by one edit, one of each two that are opposite."""
    n = len(_G)
    unit = [tuple(int(i == g) for i in range(n)) for g in range(n)]
    swaps = [tuple(a - b for a, b in zip(unit[g], unit[h])) for g in range(n) for h in range(g)]
    return [(0,) * n, *unit, *swaps]


def _cells(words: DataFrame) -> DataFrame:
    size = F.char_length("word")
    counts = [(size - F.char_length(F.translate("word", g, ""))).alias(c) for g, c in zip(GROUPS, _G)]
    return words.select("word", "n", size.alias("size"), *counts).withColumn(
        _G[-1], F.col("size") - sum((F.col(c) for c in _G[1:-1]), F.col(_G[0])))


def _block_batches(batches) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell and word to blocks: a cell's words joined by blanks, and their counts."""
    cell, words, counts, size, out = None, [], [], 0, []
    schema = pa.schema([*[(c, pa.int32()) for c in _G], ("first", pa.string()), ("words", pa.string()),
                        ("counts", pa.list_(pa.int64()))])

    def close():
        nonlocal words, counts, size
        if words:
            out.append((*cell, words[0], " ".join(words), counts))
            words, counts, size = [], [], 0

    for batch in batches:
        for *key, word, n in zip(*[batch.column(c).to_pylist() for c in (*_G, "word", "n")]):
            if key != cell or size + len(word) > BLOCK_LETTERS:
                close()
            cell = key
            words.append(word)
            counts.append(n)
            size += len(word)
        if len(out) > 200:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out = []
    close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _blocks(words: DataFrame) -> DataFrame:
    """Blocks of the vocabulary; a range of (cell, word) is a task's, so large cells are many tasks'."""
    cells = _cells(words)
    ranged = cells.repartitionByRange(*_G, "word").sortWithinPartitions(*_G, "word").select(*_G, "word", "n")
    return ranged.mapInArrow(_block_batches, (
        f"{', '.join(f'{c} int' for c in _G)}, first string, words string, counts array<bigint>"))


# Pairs ---------------------------------------------------------------------------------
class _Block:
    """Words of one length as a matrix of code points, and how often each letter of the block's
    alphabet is in each word."""

    def __init__(self, words: str, counts: np.ndarray):
        self.words, self.counts = words.split(" "), counts
        n, size = len(self.words), len(self.words[0])
        self.letters = np.frombuffer("".join(self.words).encode("utf-32-le"), "<u4").reshape(n, size).astype(np.int32)
        self.alphabet, place = np.unique(self.letters, return_inverse=True)
        width = len(self.alphabet)
        place = place.reshape(n, size) + np.arange(n)[:, None] * width
        self.counted = np.bincount(place.ravel(), minlength=n * width).reshape(n, width).astype(np.float32)
        self.norm = (self.counted ** 2).sum(axis=1)


def _one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def _one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether b is a with one letter more: what agrees from the left and the right covers a."""
    n = a.shape[1]
    left = np.cumprod(a == b[:, :n], axis=1).sum(axis=1)
    right = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return left + right >= n


def near_in_blocks(a: _Block, b: _Block, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of words one edit apart, of blocks of equal length or b's one letter longer; ``same``: a
    and b are one block, whose pairs come once."""
    longer = b.letters.shape[1] - a.letters.shape[1]
    _, x, y = np.intersect1d(a.alphabet, b.alphabet, assume_unique=True, return_indices=True)
    # |x - y|^2 <= 2 (or 1), as a bound on the Gram matrix; exact, as all numbers are small integers
    far = (a.norm - (1 if longer else 2))[:, None] + b.norm
    i, j = np.nonzero(2 * (a.counted[:, x] @ b.counted[:, y].T) >= far)
    if same:
        i, j = i[i < j], j[i < j]
    ok = np.zeros(len(i), bool)
    step = max(1, (1 << 20) // a.letters.shape[1])
    for lo in range(0, len(i), step):  # bounded memory
        part = slice(lo, lo + step)
        ok[part] = (_one_inserted if longer else _one_replaced)(a.letters[i[part]], b.letters[j[part]])
    return i[ok], j[ok]


def _pair_batches(batches) -> Iterator[pa.RecordBatch]:
    names = ["a", "a_n", "b", "b_n"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
    met: dict[str, _Block] = {}  # a block meets several in turn

    def block(words: str, counts: pa.Scalar) -> _Block:
        if words not in met:
            if len(met) >= MET_BLOCKS:
                met.clear()
            met[words] = _Block(words, counts.values.to_numpy())
        return met[words]

    for batch in batches:
        cols: list[list] = [[], [], [], []]
        texts_ = [batch.column(c).to_pylist() for c in ("words", "other_words", "same")]
        for r, (words, others, same) in enumerate(zip(*texts_)):
            a = block(words, batch.column("counts")[r])
            b = block(others, batch.column("other_counts")[r])
            i, j = near_in_blocks(a, b, same)
            if len(i):
                for col, values in zip(cols, ([a.words[k] for k in i], a.counts[i], [b.words[k] for k in j], b.counts[j])):
                    col.extend(values)
            if len(cols[0]) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)
                cols = [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)


def near_words(words: DataFrame) -> DataFrame:
    """``(a, a_n, b, b_n)``: each pair of different words of ``(word, n)`` that differ by exactly one
    inserted, deleted or replaced letter, once.  ``words`` has each word once, without blanks."""
    blocks = written(_blocks(words), "blocks")
    keys = [f"to_{c}" for c in _G]
    moves = F.array(*[F.struct(*[(F.col(c) + d).alias(k) for c, k, d in zip(_G, keys, move)],
                               F.lit(any(move)).alias("moved")) for move in _moves()])
    left = blocks.select("first", "words", "counts", F.explode(moves).alias("m")).select("first", "words", "counts", "m.*")
    right = blocks.select(*[F.col(c).alias(k) for c, k in zip(_G, keys)], F.col("first").alias("other_first"),
                          F.col("words").alias("other_words"), F.col("counts").alias("other_counts"))
    # within a cell, a pair of blocks once
    pairs = left.join(right, keys).filter("moved or first <= other_first")
    return pairs.select("words", "counts", "other_words", "other_counts", (
        ~F.col("moved") & (F.col("first") == F.col("other_first"))).alias("same")).mapInArrow(
        _pair_batches, "a string, a_n bigint, b string, b_n bigint")


# Forms ---------------------------------------------------------------------------------
def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``(word, form)``: forms followed to the last, by pointer jumping.  A form is
    several times as frequent as its word, so there is no cycle and few steps do."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(now.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return now


def variants(words: DataFrame, factor: int = 5) -> DataFrame:
    """One row per word of a vocabulary ``(word, n)``: ``word, form, root, n, n_near, form_n``.

    Near words are one edit apart.  A word's form is its near word of largest n (of equal ones the
    smallest by code points), if that n is at least ``factor`` (2 or more) times its own; its root is
    the last form met by following forms, itself without one.

    Defined results: a word without near words has 0 of them and no form; an empty vocabulary gives
    no row; other columns are ignored; null words or counts, and words that come twice, are summed
    or left out before (``vocabulary`` gives none).
    """
    if factor < 2:
        raise ValueError("factor must be at least 2")
    words = written(words.select("word", F.col("n").cast("bigint").alias("n")), "vocabulary")
    pairs = near_words(words)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"),
                                          F.col("a_n").alias("b_n")))
    best = both.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("near"))).alias("top"))
    frequent = -F.col("top.less") >= factor * F.col("n")
    found = written(words.join(best, "word", "left").select(
        "word", F.when(frequent, F.col("top.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(frequent, -F.col("top.less")).alias("form_n")), "forms")
    roots = _roots(found.filter("form is not null"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
