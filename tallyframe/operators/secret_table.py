"""Masking by a table of secrets (T13 for lists that do not fit a plan).

Secrets of equal length are told by one rolling hash, so every length of the list is one pass over a
text's bytes.  A Bloom filter for each length, as large as the list has secrets of that length, keeps nearly
all windows that are no secret from leaving their task; the others, once a text, meet the table of
secrets by an equality join on (length, hash).  What a text may hold comes back to it as a short list,
and the masks are applied in the order of the list by the same fold that a literal list gets, so a
window that only looked like a secret changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import mask_secrets
from ..session import materialise

#: Bits of the filters that windows are tested against: this many a secret at least, which lets less than one
#: window of 1,000 pass that is none, and never more than 32 MB in all: filters of lists of more than some
#: 8 million secrets let more pass, and stay right.
BITS_A_SECRET = 32
MOST_FILTER_BITS = 1 << 28
#: Probes of a filter: the hash shifted by so many bits.
_PROBES = (0, 18, 36)
#: Bytes of text worked on at a time (or one text).
SLICE_BYTES = 1 << 20
_BUCKET = 32_768
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out)


def rolling_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` bytes from each place on: a polynomial of the bytes, by doubling, so the
    cost is about log2(length) passes over whole arrays."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # parts[i]: hash of 2 ** i bytes from each place on
    part, size = data.astype(np.uint64) + np.uint64(1), 1
    out, done = np.zeros(len(data), np.uint64), 0
    while True:
        if length & size:
            grown = np.zeros(len(data), np.uint64)
            room = len(data) - done
            grown[:room] = out[:room] * np.uint64(pow(int(_BASE), size, 1 << 64)) + part[done:done + room]
            out, done = grown, done + size
        if size * 2 > length:
            break
        longer = np.zeros(len(data), np.uint64)
        longer[:len(data) - size] = part[:len(data) - size] * np.uint64(pow(int(_BASE), size, 1 << 64)) + part[size:]
        part, size = longer, size * 2
    return _mixed(out[:n] + np.uint64(length))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column without nulls."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _hashed(batches) -> Iterator[pa.RecordBatch]:
    """Length in bytes and hash of each secret."""
    for batch in batches:
        data, offsets = _bytes(batch.column("secret"))
        sizes = np.diff(offsets)
        hashes = np.array([rolling_hashes(data[a:b], int(b - a))[0] for a, b in zip(offsets[:-1], offsets[1:])], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("pos"), batch.column("secret"), pa.array(sizes, pa.int64()),
                                          pa.array(hashes.view(np.int64), pa.int64())], ["pos", "secret", "size", "hash"])


def _filter_sizes(counts: dict[int, int]) -> dict[int, tuple[int, int]]:
    """First bit and bits (a power of two) of the filter of each length, from its number of secrets."""
    bits = {size: max(_BUCKET, 1 << (n * BITS_A_SECRET - 1).bit_length()) for size, n in counts.items()}
    while sum(bits.values()) > MOST_FILTER_BITS and max(bits.values()) > _BUCKET:
        most = max(bits.values())
        bits = {size: n // 2 if n == most else n for size, n in bits.items()}
    out, first = {}, 0
    for size, n in bits.items():
        out[size] = (first, n)
        first += n
    return out


def _windows(batches, filters: dict[int, tuple[int, int]], bitmap: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``(key, found)``: the ``(size, hash)`` of the windows of each text that the filters let through, once a text."""
    for whole in batches:
        _, offsets = _bytes(whole.column("text"))
        lo = 0
        while lo < whole.num_rows:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE_BYTES, side="right")) - 1)
            batch = whole.slice(lo, hi - lo)
            lo = hi
            data, at = _bytes(batch.column("text"))
            rows, lengths, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for size, (first, bits) in filters.items():
                hashes = rolling_hashes(data, size)
                hit = None
                for shift in _PROBES:
                    place = ((hashes if hit is None else hashes[hit]) >> np.uint64(shift) & np.uint64(bits - 1)) + np.uint64(first)
                    passed = np.flatnonzero(bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
                    hit = passed if hit is None else hit[passed]
                text = np.searchsorted(at, hit, side="right") - 1
                inside = hit + size <= at[text + 1]  # not across texts
                pairs = np.unique(np.stack([text[inside].astype(np.uint64), hashes[hit[inside]]], axis=1), axis=0)
                rows.append(pairs[:, 0].astype(np.int64))
                found.append(pairs[:, 1])
                lengths.append(np.full(len(pairs), size, np.int64))
            row = np.concatenate(rows)
            order = np.argsort(row, kind="stable")
            texts, starts = np.unique(row[order], return_index=True)
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(row)), pa.int32()), pa.StructArray.from_arrays(
                [pa.array(np.concatenate(lengths)[order]), pa.array(np.concatenate(found)[order].view(np.int64))], ["size", "hash"]))
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(texts)), lists], ["key", "found"])


def _bitmap(hashed: DataFrame, filters: dict[int, tuple[int, int]]) -> np.ndarray:
    """The filters' bits, put together by Spark's bitmaps; MOST_FILTER_BITS of them at most come to the driver."""
    if not filters:
        return np.zeros(0, np.uint8)
    of = F.create_map(*[F.lit(x) for size, (first, bits) in filters.items() for x in (
        size, F.struct(F.lit(first).cast("long").alias("first"), F.lit(bits - 1).cast("long").alias("mask")))])
    probes = F.array(*[F.shiftrightunsigned("hash", shift).bitwiseAND(F.col("of.mask")) + F.col("of.first") + 1 for shift in _PROBES])
    place = F.col("place")
    rows = hashed.withColumn("of", of[F.col("size").cast("int")]).select(F.explode(probes).alias("place")).groupBy(
        (F.bitmap_bucket_number(place) - 1).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(sum(bits for _, bits in filters.values()) // 8, np.uint8)
    for r in rows.toLocalIterator():
        out[r["bucket"] * _BUCKET // 8:(r["bucket"] + 1) * _BUCKET // 8] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def _late(secrets: DataFrame) -> Column:
    """Secrets that only masking may bring about, as ``(pos, secret)``: those with a star, and those that hold
    twice a letter that is a secret itself (its mask doubles it)."""
    letters = secrets.filter(F.char_length("secret") == 1).select(F.concat("secret", "secret").alias("twice")).distinct()
    doubled = secrets.withColumn("twice", F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(F.char_length("secret") - 1, F.lit(1))), lambda i: F.substring("secret", i, F.lit(2)))))).join(
        letters, "twice", "left_semi").select("pos", "secret")
    rows = secrets.filter(F.contains("secret", F.lit("*"))).select("pos", "secret").unionByName(doubled).distinct()
    return rows.agg(F.collect_list(F.struct("pos", "secret"))).scalar()


def mask_by_table(docs: DataFrame, secrets: DataFrame, text_col: str = "text", pos_col: str = "pos",
                  secret_col: str = "secret") -> DataFrame:
    """``docs`` with the secrets of a table masked in ``text_col``, as ``mask_secrets`` does it with the list of
    ``secret_col`` in the order of ``pos_col``.

    Secrets that only a mask can bring about (with a star, or with a doubled one-letter secret) are tried
    on every text in which something is masked; their list is one value.

    Defined results: null and empty secrets mask nothing, repeated ones count at each place of the list;
    ties of position go by the secret; null texts stay null; rows keep their columns.
    """
    known = secrets.select(F.col(f"`{pos_col}`").alias("pos"), F.col(f"`{secret_col}`").alias("secret")).filter(
        F.char_length("secret") > 0)
    pos_type = known.schema["pos"].dataType.simpleString()
    known = materialise(known.mapInArrow(_hashed, f"pos {pos_type}, secret string, size bigint, hash bigint"), "secrets")
    filters = _filter_sizes({r["size"]: r["n"] for r in known.groupBy("size").agg(F.count("*").alias("n")).orderBy("size").collect()})
    bitmap = _bitmap(known, filters)
    key = F.unhex(F.md5(F.col(f"`{text_col}`")))
    texts = docs.select(key.alias("key"), F.col(f"`{text_col}`").alias("text")).filter("text is not null")
    # one row of the copies of a text
    windows = texts.mapInArrow(lambda it: _windows(it, filters, bitmap), "key binary, found array<struct<size:bigint,hash:bigint>>") \
        .dropDuplicates(["key"]).select("key", F.inline("found"))
    # a text's secrets: few, as each stands in it
    held = windows.join(known, ["size", "hash"]).groupBy("key").agg(F.collect_set(F.struct("pos", "secret")).alias("found"))
    both = held.withColumn("late", _late(known)).select("key", F.array_sort(F.array_union("found", "late")).alias("all"))
    masks = both.select(F.col("key").alias("__key"), F.transform("all", lambda x: x["secret"]).alias("__secrets"))
    text = F.col(f"`{text_col}`")
    masked = F.when(F.col("__secrets").isNull(), text).otherwise(mask_secrets(text, F.col("__secrets")))
    return docs.join(masks, key == F.col("__key"), "left").select(
        *[masked.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
