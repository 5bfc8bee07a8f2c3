"""Token ids as directly addressable codes (operator 2).

An id is split into chunks of CHUNK bits, lowest first.  Level 0 holds the first chunk of every
id, level 1 the second chunk of those that go on, and so forth; a level's continuation bitmap says
which ids go on, and its rank directory counts the set bits before every block of RANK_BITS bits.
The position of an id's next chunk is the rank of its bit, so any id is read with a few array
accesses and nothing around it is decoded.

File format: Parquet files whose rows are segments, each a run of whole documents in ascending id
order with the codes of all their ids.  Shards are ranges of document ids, segments are numbered
inside a shard and carry the count of the shard's ids before them, so an id's place in the whole
corpus is known from the segments' small columns.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .hashing import Words, byte_table, slices, texts

CHUNK = 8
RANK_BITS = 512
#: Ids after which a segment is closed (at the next document's end).
SEGMENT_IDS = 1 << 20
#: Distinct words whose ids a worker keeps.
CACHE_WORDS = 1 << 19
END_ID = 1


# Codes ---------------------------------------------------------------------------------
def encode(ids: np.ndarray) -> list[dict[str, bytes]]:
    """Levels of ``chunks``, ``more`` (continuation bitmap) and ``ranks`` (directory)."""
    levels, left = [], ids.astype(np.uint32)
    while True:
        rest = left >> np.uint32(CHUNK)
        more = rest > 0
        bits = np.packbits(more, bitorder="little")
        padded = np.pad(more, (0, -len(more) % RANK_BITS)).reshape(-1, RANK_BITS)
        ranks = np.concatenate([[0], np.cumsum(padded.sum(axis=1))]).astype("<u4")
        levels.append({"chunks": (left & np.uint32((1 << CHUNK) - 1)).astype(np.uint8).tobytes(),
                       "more": bits.tobytes(), "ranks": ranks.tobytes()})
        if not more.any():
            return levels
        left = rest[more]


def decode(levels: list[dict[str, bytes]]) -> np.ndarray:
    """All ids of a segment."""
    ids = None
    for level in reversed(levels):
        chunks = np.frombuffer(level["chunks"], np.uint8).astype(np.uint32)
        if ids is not None:
            more = np.unpackbits(np.frombuffer(level["more"], np.uint8), count=len(chunks), bitorder="little").astype(bool)
            chunks[more] |= ids << np.uint32(CHUNK)
        ids = chunks
    return ids


def id_at(levels: list[dict[str, bytes]], i: int) -> int:
    """One id, by rank only."""
    value = 0
    for depth, level in enumerate(levels):
        value |= level["chunks"][i] << (CHUNK * depth)
        if not level["more"][i >> 3] >> (i & 7) & 1:
            break
        block = i // RANK_BITS
        bits = int.from_bytes(level["more"][block * RANK_BITS // 8:(i >> 3) + 1], "little")
        i = int.from_bytes(level["ranks"][4 * block:4 * block + 4], "little") + (
            bits & ((1 << (i - block * RANK_BITS)) - 1)).bit_count()
    return value


# Encoding texts ------------------------------------------------------------------------
class WordEncoder:
    """A tokenizer's ids of whole texts, each distinct word encoded once.

    For tokenizers that drop white space, never join across it and fold case, such as the default
    one: the ids of a text are then those of its words in order.  Words are found and looked up by
    a 64-bit hash, a slice of texts at a time.
    """

    #: A word of this shape falls apart after its letters: no token crosses the border.
    _TAIL = re.compile(r"(.*[0-9a-z])([!-&(-/:-@\[-`{-~]+)", re.DOTALL)
    #: Letters that the normaliser leaves as they are and that make one word of the model.
    _PLAIN = re.compile("[a-z\u00e0-\u00f6\u00f8-\u00ff]+")

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        letters = [chr(c) for c in (*range(0x61, 0x7B), *range(0xE0, 0x100)) if c != 0xF7]
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.to_model = {ord(c): split(c)[0][0] for c in letters}
        trial = "".join(letters)
        self.direct = self._direct(trial) == self.tokenizer.encode(trial, add_special_tokens=False).ids
        self.table = byte_table("space")
        self.clear()

    def clear(self) -> None:
        self.keys, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # by ascending hash
        self.flat, self.at = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _direct(self, word: str) -> list[int]:
        return [t.id for t in self.model.tokenize(word.translate(self.to_model))]

    def _learn(self, words: list[str]) -> None:
        """Append the ids of words to the store."""
        parts = [(m[1], m[2]) if (m := self._TAIL.fullmatch(w)) else (w,) for w in words]
        stems = dict.fromkeys(x for p in parts for x in p)
        plain = [s for s in stems if self.direct and self._PLAIN.fullmatch(s)]
        for s in plain:
            stems[s] = self._direct(s)
        others = [s for s, ids in stems.items() if ids is None]
        for s, e in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False)):
            stems[s] = e.ids
        ids = [stems[p[0]] if len(p) == 1 else stems[p[0]] + stems[p[1]] for p in parts]
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum([len(x) for x in ids])]).astype(np.int64)
        self.flat = np.concatenate([self.flat, np.array([i for x in ids for i in x], np.uint32)])

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a string column."""
        if len(self.keys) > CACHE_WORDS:
            self.clear()
        data, offsets = texts(column)
        words = Words(data, offsets, self.table)
        distinct, sample, which = np.unique(words.hash, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, distinct)
        new = np.append(self.keys, np.uint64(0))[place] != distinct
        new |= place == len(self.keys)
        first = sample[new]
        slot = np.empty(len(distinct), np.int64)
        slot[~new] = self.slot[place[~new]]
        slot[new] = np.arange(len(first)) + len(self.at) - 1
        self._learn([data[a:b].tobytes().lower().decode() for a, b in zip(words.start[first], words.end[first])])
        self.keys = np.insert(self.keys, place[new], distinct[new])
        self.slot = np.insert(self.slot, place[new], slot[new])
        index = slot[which]
        length = self.at[index + 1] - self.at[index]
        ends = np.concatenate([[0], np.cumsum(length)])
        ids = self.flat[np.repeat(self.at[index] - ends[:-1], length) + np.arange(ends[-1])]
        out = [ids[a:b] for a, b in zip(ends[words.first[:-1]], ends[words.first[1:]])]
        # special tokens may hold or touch anything: such texts go through the library whole
        if any(s in memoryview(data).tobytes() for s in self.special):
            for i, t in enumerate(column.to_pylist()):
                if t and any(s.decode() in t for s in self.special):
                    out[i] = np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32)
        return out


_ENCODERS: dict[str, WordEncoder] = {}


def _encoded(batches, path: str, end_id: int) -> Iterator[tuple[object, np.ndarray]]:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    for batch in batches:
        for part in slices(batch, "text"):
            for key, ids in zip(part.column("id").to_pylist(), _ENCODERS[path].encode(part.column("text"))):
                yield key, np.append(ids, np.uint32(end_id))


LEVELS = "array<struct<chunks: binary, more: binary, ranks: binary>>"
_LEVELS = pa.list_(pa.struct([(c, pa.binary()) for c in ("chunks", "more", "ranks")]))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, shards: int | None = None) -> None:
    """Encode all documents in ascending ``id_col`` order and write their segments to ``path``.

    Documents are range-partitioned by id, so a shard is a task; rows of one id keep the order of
    their text.  Document ids that are no whole numbers are kept as text.  Defined results: null text is
    empty (its only id is the end id); a null id sorts first; repeated ids and rows are documents of
    their own; an empty table writes no segment; other columns are ignored.  A document's ids fit a
    segment, whatever its length.
    """
    n = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    whole = narrow.schema["id"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    id_type, arrow_type = ("bigint", pa.int64()) if whole else ("string", pa.string())

    def segments(batches):
        number, before, docs_, runs, size = 0, 0, [], [], 0

        def segment():
            ids = np.concatenate(runs)
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int32()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()),
                pa.array([docs_], pa.list_(arrow_type)),
                pa.array([np.cumsum([0] + [len(r) for r in runs])], pa.list_(pa.int64())),
                pa.array([encode(ids)], _LEVELS)], ["segment", "ids_before", "n_ids", "ids", "starts", "levels"])

        for key, ids in _encoded(batches, tokenizer, end_id):
            docs_.append(key)
            runs.append(ids)
            size += len(ids)
            if size >= SEGMENT_IDS:
                yield segment()
                number, before, docs_, runs, size = number + 1, before + size, [], [], 0
        if runs:
            yield segment()

    narrow = narrow.withColumn("id", F.col("id").cast(id_type))
    (narrow.repartitionByRange(n, "id").sortWithinPartitions("id", "text").mapInArrow(
        segments, f"segment int, ids_before bigint, n_ids bigint, ids array<{id_type}>, starts array<bigint>, levels {LEVELS}")
     .withColumn("shard", F.spark_partition_id()).write.parquet(path))


def _bases(segments: DataFrame) -> DataFrame:
    """Ids before each shard; one row per shard, so the window's table is as small as a task list."""
    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return shards.select("shard", (F.sum("n").over(order) - F.col("n")).alias("base"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of each document, decoded from the files."""
    segments = spark.read.parquet(path)
    id_type = segments.schema["ids"].dataType.elementType.simpleString()
    arrow_type = pa.int64() if id_type == "bigint" else pa.string()

    def rows(batches):
        for batch in batches:
            for s in range(batch.num_rows):
                ids = decode(batch.column("levels")[s].as_py()).astype("<u4")
                starts = batch.column("starts")[s].values.to_numpy()
                before = batch.column("ids_before")[s].as_py()
                keys = batch.column("ids")[s].values
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column("shard")[s].as_py()] * len(keys), pa.int32()), keys.cast(arrow_type),
                    pa.array(before + starts[:-1]), pa.array(np.diff(starts)),
                    pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts[:-1], starts[1:])], pa.int64())],
                    ["shard", "doc_id", "at", "n_tokens", "ids_crc32"])

    found = segments.select("shard", "ids_before", "ids", "starts", "levels").mapInArrow(
        rows, f"shard int, doc_id {id_type}, at bigint, n_tokens bigint, ids_crc32 bigint")
    return found.join(_bases(segments), "shard").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """``(position)`` to ``(position, id)``: the ids at places of the whole corpus, by rank.

    Positions meet their segment by a bucketed equality join (buckets of SEGMENT_IDS places), and
    only the segments asked for are opened.
    """
    segments = spark.read.parquet(path)
    spans = segments.select("shard", "segment", "ids_before", "n_ids").join(_bases(segments), "shard").withColumn(
        "first", F.col("base") + F.col("ids_before")).withColumn("last", F.col("first") + F.col("n_ids") - 1)
    bucket = lambda c: F.floor(F.col(c) / SEGMENT_IDS)
    spans = spans.withColumn("bucket", F.explode(F.sequence(bucket("first"), bucket("last"))))
    asked = positions.select("position").withColumn("bucket", bucket("position")).join(spans, "bucket").filter(
        "position between first and last").select("shard", "segment", "position", (F.col("position") - F.col("first")).alias("i"))
    opened = asked.join(segments.select("shard", "segment", "levels"), ["shard", "segment"])

    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("position"), pa.array(
                [id_at(x.as_py(), i.as_py()) for x, i in zip(batch.column("levels"), batch.column("i"))], pa.int64())],
                ["position", "id"])

    return opened.select("position", "i", "levels").mapInArrow(rows, "position bigint, id bigint")
