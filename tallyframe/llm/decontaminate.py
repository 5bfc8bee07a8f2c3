"""Benchmark decontamination with SimHash windows (operator 4).

1. A window is as many words of a document as a benchmark item has.  Every window that shares a
   shingle with the benchmark (others have similarity 0) gets a fingerprint: the signs of FINGER sums of
   its shingles' weights, each with a random sign per bit.
2. What similarity implies for the distance depends on the weights, so each item has a radius of its
   own: the distance that two bags at the threshold exceed with a probability of about MISS, for the
   least favourable way to share the item's weights (``_Items._radius``).
3. Fingerprints of one size are cut into blocks, one more than the largest radius: within it, some
   block of window and item is equal (multi-index hashing), so looking the blocks up finds all
   fingerprints within the radius.
4. Windows found are verified by the exact weighted similarity of the two bags of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import Words, byte_table, mix64, slices, texts
from .tables import written

#: Items held by a task at once; a larger benchmark is gone through block by block.
ITEM_BLOCK = 5000
#: Bits of a fingerprint; probability that a pair at the threshold lies outside of its item's radius, in
#: standard deviations of the distance (of independent bits, by the normal curve: 3e-5).
FINGER, MISS_SIGMAS = 128, 4.0
MOST_BLOCK_BITS = 32
#: Windows that are looked up at a time.
WINDOWS = 2048


class _Items:
    """One block of items ``(item, text, df)``: shingle weights and the items that hold each shingle.
    df: by distinct shingle, in order of its hash, the items of the benchmark that hold it; count:
    the benchmark's items with a shingle."""

    def __init__(self, items: Sequence[tuple], count: int, k: int, threshold: float):
        words = Words(*texts(pa.array([r[1] for r in items], pa.large_string())), byte_table("space"))
        grams, inside = words.grams(k)
        self.k, bags, self.ids, self.size, dfs = k, [], [], [], []
        for (key, _, df), lo, hi in zip(items, words.first[:-1], words.first[1:]):
            if hi - lo >= k:
                self.ids.append(key)
                self.size.append(int(hi - lo))
                bags.append(np.unique(grams[lo:hi - k + 1], return_counts=True))
                dfs.append(df)
        self.known, some = np.unique(np.concatenate([b[0] for b in bags]) if bags else np.zeros(0, np.uint64),
                                     return_index=True)
        self.rare = float(np.log1p(count))  # weight of a shingle of no or one item
        self.weight = np.log1p(count / (np.concatenate(dfs)[some] if bags else np.zeros(0)))
        self.bags = [(np.searchsorted(self.known, g), c) for g, c in bags]
        self.total = np.array([(self.weight[g] * c).sum() for g, c in self.bags])
        # items that hold each known shingle and how often: places first[x] to first[x + 1]
        held = np.concatenate([g for g, _ in self.bags]) if bags else np.zeros(0, np.int64)
        order = np.argsort(held, kind="stable")
        self.first = np.searchsorted(held[order], np.arange(len(self.known) + 1))
        self.holder = np.repeat(np.arange(len(bags)), np.array([len(g) for g, _ in self.bags], np.int64))[order]
        self.times = np.concatenate([c for _, c in self.bags])[order] if bags else held

        self.threshold = threshold
        grams_of = [(self.known[g], self.weight[g] * c) for g, c in self.bags]
        self.finger = np.stack([self.fingerprint(g, w) for g, w in grams_of]) if bags else np.zeros((0, FINGER), bool)
        self.radius = np.array([self._radius(w) for _, w in grams_of], np.int64)
        # by size of the items: their numbers and the values of each of their blocks
        self.groups: dict[int, tuple[np.ndarray, list[np.ndarray], np.ndarray]] = {}
        for size in sorted(set(self.size)):
            own = np.flatnonzero(np.array(self.size) == size)
            n_blocks = min(FINGER, max(FINGER // MOST_BLOCK_BITS, int(self.radius[own].max()) + 1))
            cuts = np.linspace(0, FINGER, n_blocks + 1).astype(int)
            self.groups[size] = own, cuts, self._block_values(self.finger[own], cuts)

    @staticmethod
    def signs(grams: np.ndarray) -> np.ndarray:
        """FINGER random signs of each shingle."""
        words = np.stack([mix64(grams + np.uint64(i + 1)) for i in range(FINGER // 64)], axis=1)
        return np.unpackbits(words.view(np.uint8), axis=1).astype(np.float64) * 2 - 1

    def fingerprint(self, grams: np.ndarray, weight: np.ndarray) -> np.ndarray:
        return (self.signs(grams) * weight[:, None]).sum(axis=0) > 1e-9

    def _radius(self, weight: np.ndarray) -> int:
        """Largest distance to look for.  A bit differs if sums over the common shingles (variance c) and
        those of one side (a, b) have other signs, with probability arccos(c / sqrt((c + a)(c + b))) / pi.
        At the threshold t the item lacks some weight and the window has other: lacking x of the item's
        weight T leaves room for ((1 - t) T - x) / t; the heaviest shingles and the rarest words are the
        least favourable."""
        t, total = self.threshold, float(weight.sum())
        heavy = np.sort(weight)[::-1]
        lacking, squares, worst = np.cumsum(heavy), np.cumsum(heavy ** 2), 0.0
        for x in np.linspace(0, (1 - t) * total, 21):
            n = int(np.searchsorted(lacking, x, side="right"))
            a = (squares[n - 1] if n else 0.0) + (heavy[n] * (x - (lacking[n - 1] if n else 0.0)) if n < len(heavy) else 0.0)
            b = ((1 - t) * total - x) / t * self.rare
            c = max(0.0, squares[-1] - a)
            worst = max(worst, float(np.arccos(min(1.0, c / np.sqrt((c + a) * (c + b)) if c else 0.0)) / np.pi))
        return min(FINGER, int(np.ceil(FINGER * worst + MISS_SIGMAS * np.sqrt(FINGER * worst * (1 - worst)))))

    @staticmethod
    def _block_values(finger: np.ndarray, cuts: np.ndarray) -> list[np.ndarray]:
        """The value of each block of each fingerprint."""
        return [finger[:, lo:hi] @ (1 << np.arange(hi - lo, dtype=np.int64)) for lo, hi in zip(cuts[:-1], cuts[1:])]

    def _within(self, finger: np.ndarray, size: int) -> Iterator[tuple[int, int, int]]:
        """(window, item, distance) of all fingerprints within the items' radii."""
        own, cuts, values = self.groups[size]
        met = np.zeros((len(finger), len(own)), bool)
        for mine, theirs in zip(self._block_values(finger, cuts), values):
            order = np.argsort(theirs, kind="stable")
            first = np.searchsorted(theirs[order], mine, side="left")
            n = np.searchsorted(theirs[order], mine, side="right") - first
            window = np.repeat(np.arange(len(mine)), n)
            place = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
            met[window, order[place]] = True
        window, item = np.nonzero(met)
        distance = (finger[window] != self.finger[own[item]]).sum(axis=1)
        near = distance <= self.radius[own[item]]
        yield from zip(window[near].tolist(), own[item[near]].tolist(), distance[near].tolist())

    def matches(self, grams: np.ndarray, at: np.ndarray, n_words: int) -> Iterator[tuple]:
        """(item, start, words, distance, similarity) of the best window of each item in one text;
        at: the shingles' places among the known ones, or -1."""
        found = np.unique(at[at >= 0])
        holders = {self.size[i] for x in found.tolist() for i in self.holder[self.first[x]:self.first[x + 1]].tolist()}
        weight = np.where(at >= 0, self.weight[at], self.rare)
        sums = np.concatenate([[0], np.cumsum(weight)])
        known = np.concatenate([[0], np.cumsum(at >= 0)])
        best: dict[int, tuple] = {}
        for size in sorted(holders):
            width = min(size, n_words) - self.k + 1  # shingles of a window
            starts = np.flatnonzero(known[width:] > known[:-width])
            for lo in range(0, len(starts), WINDOWS):
                part = starts[lo:lo + WINDOWS]
                begin, end = int(part[0]), int(part[-1]) + width
                for window, item, distance in self._within(self._windows(grams, weight, part, width, begin, end), size):
                    start = int(part[window])
                    similarity = self._similarity(item, at[start:start + width], sums[start + width] - sums[start])
                    if similarity > best.get(item, (self.threshold - 1e-6,))[0] + (1e-9 if item in best else -1e-12):
                        best[item] = (similarity, start, width + self.k - 1, distance)
        for item in sorted(best):
            similarity, start, n, distance = best[item]
            yield item, start, n, distance, similarity

    def _windows(self, grams, weight, starts, width: int, begin: int, end: int) -> np.ndarray:
        """Fingerprints of windows, from running sums over the stretch that holds them."""
        out, lo = np.empty((len(starts), FINGER), bool), 0
        while lo < len(starts):  # windows far apart need not be summed over what is between
            gaps = np.flatnonzero(np.diff(starts[lo:]) > width)
            hi = lo + (int(gaps[0]) + 1 if len(gaps) else len(starts) - lo)
            a, b = int(starts[lo]), int(starts[hi - 1]) + width
            total = np.concatenate([np.zeros((1, FINGER)), np.cumsum(self.signs(grams[a:b]) * weight[a:b, None], axis=0)])
            out[lo:hi] = total[starts[lo:hi] - a + width] - total[starts[lo:hi] - a] > 1e-9
            lo = hi
        return out

    def _similarity(self, item: int, window: np.ndarray, whole: float) -> float:
        own, times = self.bags[item]
        place = np.minimum(np.searchsorted(own, window), len(own) - 1)
        hit = place[own[place] == window]
        common = float(self.weight[own[hit]].sum())
        least = self.threshold - 1e-5
        if common < least / (1 + least) * (whole + self.total[item]):
            return 0.0  # below the threshold, even before what is counted too often is taken off
        both = float((self.weight[own] * np.minimum(times, np.bincount(hit, minlength=len(own)))).sum())
        return min(1.0, both / (whole + self.total[item] - both))


def _found(batches, items: tuple[Sequence[tuple], int], k: int, threshold: float, text_col: str):
    """(part of a batch, [(row, item, start, words, distance, similarity)]) with the best window of
    each item in each text."""
    index, table = _Items(*items, k, threshold), byte_table("space")
    for whole in batches:
        for batch in slices(whole, text_col):
            words = Words(*texts(batch.column(text_col)), table)
            grams, _ = words.grams(k)
            at = np.searchsorted(index.known, grams)
            at[at == len(index.known)] = 0
            at = np.where(index.known[at] == grams, at, -1) if len(index.known) else np.full(len(grams), -1)
            of = np.searchsorted(words.first, np.flatnonzero(at >= 0), side="right") - 1
            rows = []
            for d in np.unique(of):
                lo, hi = words.first[d], words.first[d + 1]
                if hi - lo < k:
                    continue
                rows += [(int(d), index.ids[m[0]], *m[1:]) for m in index.matches(
                    grams[lo:hi - k + 1], at[lo:hi - k + 1], int(hi - lo))]
            yield batch, rows


def _matches(batches, items, k, threshold, item_type):
    kinds = [item_type, pa.int64(), pa.int64(), pa.int32(), pa.float64()]
    for batch, rows in _found(batches, items, k, threshold, "text"):
        at, *cols = list(zip(*rows)) if rows else [()] * 6
        yield pa.RecordBatch.from_arrays([
            batch.column("id").take(pa.array(at, pa.int64())), *[pa.array(c, kind) for c, kind in zip(cols, kinds)]],
            ["id", "item", "start_word", "n_words", "distance", "similarity"])


def _clean(batches, items, k, threshold, text_col):
    for batch, rows in _found(batches, items, k, threshold, text_col):
        keep = np.ones(batch.num_rows, bool)
        keep[[r[0] for r in rows]] = False
        yield batch.filter(pa.array(keep))


def _shingles(batches, k: int):
    for whole in batches:
        for batch in slices(whole, "text"):
            words = Words(*texts(batch.column("text")), byte_table("space"))
            grams, _ = words.grams(k)
            sets = [np.unique(grams[lo:max(lo, hi - k + 1)]) for lo, hi in zip(words.first[:-1], words.first[1:])]
            yield pa.RecordBatch.from_arrays([
                batch.column("row").take(pa.array(np.repeat(np.arange(len(sets)), [len(x) for x in sets]), pa.int64())),
                pa.array(np.concatenate(sets).view(np.int64))], ["row", "shingle"])


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, k: int) -> Iterator[tuple[list[tuple], int]]:
    """The benchmark's items, ITEM_BLOCK at a time, and the count of all; one empty block if there
    are none.  The items that hold each shingle are counted over the whole benchmark."""
    items = written(benchmark.select(
        F.monotonically_increasing_id().alias("row"), F.col(item_col).cast(_item_type(benchmark, item_col)).alias("item"),
        F.col(text_col).alias("text")).filter("text is not null"), "items")
    held = written(items.select("row", "text").mapInArrow(
        lambda it: _shingles(it, k), "row bigint, shingle bigint"), "shingles")
    count = held.select("row").distinct().count()
    of = held.join(held.groupBy("shingle").agg(F.count("*").alias("df")), "shingle").groupBy("row").agg(
        F.collect_list(F.struct("shingle", "df")).alias("df"))
    rows = (_item(r) for r in items.join(of, "row").select("item", "text", "df").toLocalIterator())
    yield list(islice(rows, ITEM_BLOCK)), count
    while block := list(islice(rows, ITEM_BLOCK)):
        yield block, count


def _item_type(benchmark: DataFrame, item_col: str) -> str:
    """Item ids that are no whole numbers are kept as text."""
    whole = benchmark.select(item_col).schema[0].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    return "bigint" if whole else "string"


def _item(row) -> tuple:
    shingles, df = np.array(row["df"], np.int64).reshape(-1, 2).T
    return row["item"], row["text"], df[np.argsort(shingles.view(np.uint64))]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", words: int = 5,
                 threshold: float = 0.8) -> DataFrame:
    """One row per document and benchmark item found in it, with the best window: ``id_col,
    item_col, start_word, n_words, distance, similarity`` (the first of the highest similarity; distance is
    that of the fingerprints, of FINGER bits).  Item ids that are no whole numbers are kept as text.

    Similarity is the weighted Jaccard similarity of the bags of ``words``-word shingles of window
    and item; a shingle weighs log(1 + items / items that hold it), over the whole benchmark.  Words are runs of anything but
    ASCII white space with A-Z folded.

    Defined results: null, empty or short texts match nothing; a document shorter than an item is
    one window; items without ``words`` words match nothing; repeated items and documents are
    reported each; empty tables give no row; other columns are ignored.  The benchmark is gone
    through in blocks of ITEM_BLOCK items, so what a task holds has a fixed bound.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = narrow.schema["id"].dataType.simpleString()
    item_type = _item_type(benchmark, item_col)
    arrow_type = pa.int64() if item_type == "bigint" else pa.string()
    schema = f"id {id_type}, item {item_type}, start_word bigint, n_words bigint, distance int, similarity double"
    found = None
    for block in _blocks(benchmark, item_col, item_text_col, words):
        one = narrow.mapInArrow(lambda it, b=block: _matches(it, b, words, threshold, arrow_type), schema)
        found = one if found is None else found.unionByName(one)
    return found.withColumnsRenamed({"id": id_col, "item": item_col})


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", words: int = 5, threshold: float = 0.8) -> DataFrame:
    """``docs`` without the documents in which ``contaminated`` finds an item; no shuffle."""
    for block in _blocks(benchmark, item_col, item_text_col, words):
        docs = docs.mapInArrow(lambda it, b=block: _clean(it, b, words, threshold, text_col), docs.schema)
    return docs
