"""SentencePiece encoding and decoding with byte spans of the source (operator 13).

1. Normalisation: at each character the longest key of the model's compiled character map that
   begins there is replaced by its value; spaces become U+2581, with one before the text.  Every
   byte of the result records the source byte it comes from.
2. The normalised text is cut where no piece of the model reaches across, so no merge does either.
   Each distinct unit between cuts is encoded once: its characters' pairs are merged by the score of
   the piece they form, the best first, the leftmost of equals; characters without a piece become
   their bytes.
3. Pieces are laid end to end over the normalised bytes, and the record of 1. projects each of them
   to its span in the source.

Whole slices of texts are worked on with numpy; only a unit that is new costs more than a look up.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import mix64, slices, span_hashes, texts

#: Bytes of text worked on at a time (or one text), and units whose pieces a worker keeps.
SLICE_BYTES, CACHE_UNITS = 1 << 20, 1 << 19
#: Symbols of a unit up to which units are merged side by side; longer ones go through a heap.
SIDE_BY_SIDE = 48

# Fixed values of the model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
BPE = 2
SPACE = "▁".encode()
_NONE = np.iinfo(np.int64).max


# Model file ----------------------------------------------------------------------------
def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at, value, shift = at + 1, value | (byte & 0x7F) << shift, shift + 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = varint()
        kind, width = key & 7, {1: 8, 5: 4}
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else width[kind]
        yield key >> 3, data[at:at + size]
        at += size


class CharacterMap:
    """A compiled character map: a double-array trie over UTF-8 keys, and their replacements.

    Each unit of the array holds a label (low byte), whether a key ends here (bit 8) and the offset
    of its children (from bit 10 on, in steps of 256 if bit 9 is set); the child at label 0 of a key's
    end holds the place of its value.
    """

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        self.units = np.frombuffer(compiled[4:4 + size], "<u4").tolist()
        self.values = compiled[4 + size:]
        #: Whether some key begins with two bytes (the second 256: or is the first alone).
        self.begins = np.zeros((256, 256), bool)
        for a in range(256) if self.units else ():
            place, ends = self._child(self._offset(0), a)
            if place is not None:
                self.begins[a] |= ends
                for b in range(256):
                    self.begins[a, b] |= self._child(place, b)[0] is not None

    def _offset(self, at: int) -> int:
        unit = self.units[at]
        return at ^ (unit >> 10) << ((unit & 1 << 9) >> 6)

    def _child(self, place: int, byte: int) -> tuple[int | None, bool]:
        """Place of a child's children, and whether a key ends at the child."""
        at = place ^ byte
        if at >= len(self.units) or self.units[at] & 0x800000FF != byte:
            return None, False
        return self._offset(at), bool(self.units[at] >> 8 & 1)

    def longest(self, data: bytes, at: int, end: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key at a place."""
        place, found = self._offset(0), None
        for i in range(at, end):
            place, ends = self._child(place, data[i])
            if place is None:
                break
            if ends:
                start = self.units[place] & 0x7FFFFFFF
                found = i + 1 - at, start
        return found and (found[0], self.values[found[1]:self.values.index(b"\0", found[1])])


class Model:
    """Pieces, merges and normalisation of a BPE model with byte fallback."""

    def __init__(self, data: bytes):
        pieces, trainer, normalizer = [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                f = dict(_fields(value))
                pieces.append((f[1], float(np.frombuffer(f.get(2, bytes(4)), "<f4")[0]), f.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        kinds = {k for _, _, k in pieces}
        if trainer.get(3) != BPE or not trainer.get(35) or trainer.get(24) or kinds & {USER_DEFINED, UNUSED}:
            raise ValueError("only BPE models with byte fallback, without user-defined or unused pieces")
        self.map = CharacterMap(normalizer.get(2, b""))
        self.add_prefix, self.remove_extra, self.escape = (bool(normalizer.get(i, 1)) for i in (3, 4, 5))
        self.names = [p for p, _, _ in pieces]
        self.kinds = [k for _, _, k in pieces]
        self.bytes = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        normal = {p.decode(): i for i, (p, _, k) in enumerate(pieces) if k == NORMAL}
        # symbols: the pieces, then the characters of pieces that are no piece themselves
        self.symbols = dict(normal)
        for p in normal:
            for c in p:
                self.symbols.setdefault(c, len(pieces) + len(self.symbols))
        self.others = {i: s for s, i in self.symbols.items() if i >= len(pieces)}
        order = {s: i for i, s in enumerate(sorted({pieces[i][1] for i in normal.values()}, reverse=True))}
        merges = {}
        for p, i in normal.items():
            for cut in range(1, len(p)):
                a, b = self.symbols.get(p[:cut]), self.symbols.get(p[cut:])
                if a is not None and b is not None:
                    merges[a << 32 | b] = order[pieces[i][1]] << 32 | i
        self.merges = merges
        self.keys = np.array(sorted(merges), np.int64)
        #: rank of the score of what a pair forms, and the piece
        self.forms = np.append(np.array([merges[k] for k in self.keys.tolist()], np.int64), _NONE)
        #: whether some piece holds two bytes at a border of characters, or anything before a space
        self.joined, self.before_space = np.zeros((256, 256), bool), False
        space = SPACE.decode()
        for p in normal:
            for a, b in zip(p, p[1:]):
                if b == space:
                    self.before_space |= a != space
                else:
                    self.joined[a.encode()[-1], b.encode()[0]] = True


# Encoding ------------------------------------------------------------------------------
def _joined_spans(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers first[i], first[i] + 1, ... (n[i] of them), one span after another."""
    ends = np.cumsum(n)
    return np.repeat(first - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)


@dataclass
class Encoded:
    """Pieces of a slice of texts: text i has pieces first[i] to first[i + 1], with their ids and the
    bytes of the text they stand for (begin to end)."""

    first: np.ndarray
    ids: np.ndarray
    begin: np.ndarray
    end: np.ndarray


@dataclass
class Encoder:
    """A model with the pieces of the units met so far: their ids, and bytes of the normalised text."""

    model: Model
    keys: np.ndarray = field(init=False)

    def __post_init__(self):
        self.table = mix64(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
        self.clear()

    def clear(self) -> None:
        self.keys, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # by ascending hash
        self.ids, self.size, self.at = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(1, np.int64)

    # 1
    def _mapped(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes after the character map, the source byte of each, and the texts' offsets."""
        source = np.arange(len(data))
        if not self.model.map.units or not len(data):
            return data, source, offsets
        raw, texts_end = data.tobytes(), offsets[1:]
        after = np.append(data[1:], 0)
        parts, origins, done = [], [], 0
        for at in np.flatnonzero(self.model.map.begins[data, after] & (data & 0xC0 != 0x80)).tolist():
            if at < done:
                continue
            end = int(texts_end[np.searchsorted(texts_end, at, side="right")])
            found = self.model.map.longest(raw, at, end)
            if found:
                parts += [data[done:at], np.frombuffer(found[1], np.uint8)]
                origins += [source[done:at], np.full(len(found[1]), at)]
                done = at + found[0]
        origin = np.concatenate([*origins, source[done:]])
        return np.concatenate([*parts, data[done:]]), origin, np.searchsorted(origin, offsets)

    def normalise(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Normalised bytes, the source byte of each, the texts' offsets among them, and the source
        byte after the last of each text."""
        out, origin, first = self._mapped(data, offsets)
        over = offsets[1:].copy()
        space = out == 0x20
        if self.model.remove_extra and len(out):
            starts = np.zeros(len(out), bool)
            starts[first[:-1][first[:-1] < first[1:]]] = True
            gone = space & (starts | np.append(False, space[:-1]))
            for i in np.flatnonzero(first[:-1] < first[1:]).tolist() if space.any() else ():
                last = int(first[i + 1])
                while last > first[i] and space[last - 1]:
                    last -= 1
                if last < first[i + 1]:
                    gone[last:first[i + 1]] = True
                    over[i] = origin[last]
            kept = np.append(0, np.cumsum(~gone))
            out, origin, space, first = out[~gone], origin[~gone], space[~gone], kept[first]
        if self.model.add_prefix:
            known = first if self.model.remove_extra else offsets
            some = known[:-1] < known[1:]
            at = first[:-1][some]
            begin = origin[at] if self.model.remove_extra else offsets[:-1][some]
            out, origin, space = np.insert(out, at, 0x20), np.insert(origin, at, begin), np.insert(space, at, True)
            first = first + np.append(0, np.cumsum(some))
        if self.model.escape:
            width = np.where(space, len(SPACE), 1)
            ends = np.append(0, np.cumsum(width))
            at = ends[:-1][space]
            out, origin, first = np.repeat(out, width), np.repeat(origin, width), ends[first]
            for i, byte in enumerate(SPACE):
                out[at + i] = byte
        return out, origin, first, over

    # 2
    def _cuts(self, out: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where units begin."""
        is_space = np.zeros(len(out), bool)
        is_space[:-2] = (out[:-2] == SPACE[0]) & (out[1:-1] == SPACE[1]) & (out[2:] == SPACE[2])
        cut = np.zeros(len(out), bool)
        cut[1:] = (out[1:] & 0xC0 != 0x80) & ~self.model.joined[out[:-1], out[1:]]
        cut[is_space] = False
        if not self.model.before_space:
            after_space = np.append(np.zeros(3, bool), is_space)[:len(out)]
            cut |= is_space & ~after_space
        cut[first[:-1][first[:-1] < first[1:]]] = True
        return np.flatnonzero(cut)

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """One unit by a heap of its pairs; merged symbols leave a -1 behind."""
        forms, n = self.model.merges, len(symbols)
        ahead, behind = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(a: int) -> None:
            b = ahead[a]
            if b < n and (form := forms.get(symbols[a] << 32 | symbols[b])) is not None:
                heapq.heappush(heap, (form >> 32, a, symbols[a], symbols[b], form & 0xFFFFFFFF))

        for a in range(n - 1):
            offer(a)
        while heap:
            _, a, x, y, piece = heapq.heappop(heap)
            b = ahead[a]
            if symbols[a] != x or b >= n or symbols[b] != y:
                continue
            symbols[a], symbols[b], ahead[a] = piece, -1, ahead[b]
            if ahead[a] < n:
                behind[ahead[a]] = a
            offer(a)
            if behind[a] >= 0:
                offer(behind[a])
        return [s for s in symbols if s >= 0]

    def _merged(self, symbols: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All units at once, a merge in each a round; units come in any order."""
        done = []
        while len(symbols):
            pair = symbols[:-1] << 32 | symbols[1:]
            at = np.searchsorted(self.model.keys, pair)
            hit = (unit[:-1] == unit[1:]) & (np.append(self.model.keys, -1)[at] == pair)
            rank = np.full(len(symbols), _NONE)
            rank[:-1][hit] = (self.model.forms[at[hit]] >> 32) << 32 | np.flatnonzero(hit)
            first = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            best = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(symbols)))
            over = np.repeat(best == _NONE, size)
            if over.any():
                done.append((symbols[over], unit[over]))
            place = best[best != _NONE] & 0xFFFFFFFF
            symbols = symbols.copy()
            symbols[place] = self.model.forms[at[place]] & 0xFFFFFFFF
            keep = ~over
            keep[place + 1] = False
            symbols, unit = symbols[keep], unit[keep]
        return tuple(np.concatenate(x) for x in zip(*done)) if done else (symbols, unit)

    def _learn(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        """Append the pieces of new units, spans of ``data``, to the store."""
        raw = data[_joined_spans(start, end - start)].tobytes().decode()
        points = np.frombuffer(raw.encode("utf-32-le"), "<u4").astype(np.int64)
        width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        unit = np.searchsorted(np.cumsum(end - start), np.cumsum(width) - 1, side="right")
        distinct, which = np.unique(points, return_inverse=True)
        # characters of no piece are numbered above all symbols
        symbol = np.array([self.model.symbols.get(chr(c), 1 << 30 | c) for c in distinct.tolist()], np.int64)
        symbols = symbol[which]
        count = np.bincount(unit, minlength=len(start))
        long = count[unit] > SIDE_BY_SIDE
        parts = [self._merged(symbols[~long], unit[~long])]
        for u in np.flatnonzero(count > SIDE_BY_SIDE).tolist():
            lo, hi = np.searchsorted(unit, [u, u + 1])
            own = self._merge_long(symbols[lo:hi].tolist())
            parts.append((np.array(own, np.int64), np.full(len(own), u)))
        merged, of = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(of, kind="stable")
        merged, of = merged[order], of[order]
        distinct, which = np.unique(merged, return_inverse=True)
        ids, sizes = zip(*[self._pieces(s) for s in distinct.tolist()]) if len(distinct) else ((), ())
        n = np.array([len(x) for x in ids], np.int64)
        flat = _joined_spans((np.cumsum(n) - n)[which], n[which])
        self.ids = np.concatenate([self.ids, np.array([i for x in ids for i in x], np.int32)[flat]])
        self.size = np.concatenate([self.size, np.array([i for x in sizes for i in x], np.int32)[flat]])
        per_unit = np.bincount(of, n[which], len(start)).astype(np.int64)
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(per_unit)])

    def _pieces(self, symbol: int) -> tuple[list[int], list[int]]:
        """Ids of a symbol and the bytes each stands for; of a character's bytes, the last has all."""
        if symbol < len(self.model.names):
            return [symbol], [len(self.model.names[symbol])]
        raw = (chr(symbol ^ 1 << 30) if symbol >= 1 << 30 else self.model.others[symbol]).encode()
        return [self.model.bytes[b] for b in raw], [0] * (len(raw) - 1) + [len(raw)]

    # 3
    def encode(self, column: pa.Array) -> Encoded:
        """Pieces of each text of a string column."""
        if len(self.keys) > CACHE_UNITS:
            self.clear()
        data, offsets = texts(column)
        out, origin, first, over = self.normalise(data, offsets)
        if not len(out):
            none = np.zeros(0, np.int64)
            return Encoded(np.zeros(len(column) + 1, np.int64), none, none, none)
        start = self._cuts(out, first)
        end = np.append(start[1:], len(out))
        hashes = span_hashes(out, start, end, self.table)
        distinct, some, which = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, distinct)
        new = np.append(self.keys, np.uint64(0))[place] != distinct
        new |= place == len(self.keys)
        slot = np.empty(len(distinct), np.int64)
        slot[~new] = self.slot[place[~new]]
        slot[new] = np.arange(new.sum()) + len(self.at) - 1
        if new.any():
            self._learn(out, start[some[new]], end[some[new]])
            self.keys = np.insert(self.keys, place[new], distinct[new])
            self.slot = np.insert(self.slot, place[new], slot[new])
        index = slot[which]
        n = self.at[index + 1] - self.at[index]
        flat = _joined_spans(self.at[index], n)
        ids, ends = self.ids[flat], np.cumsum(self.size[flat], dtype=np.int64)
        begins = ends - self.size[flat]
        # text of each piece, and where its bytes are in the source
        of_text = np.append(0, np.cumsum(n))[np.searchsorted(start, first)]
        text = np.repeat(np.arange(len(column)), np.diff(of_text))
        last = first[text + 1]
        source = np.append(origin, 0)
        spans = [np.where(x < last, source[x], over[text]) - offsets[text] for x in (begins, ends)]
        return Encoded(of_text, ids, *spans)


# Decoding ------------------------------------------------------------------------------
codecs.register_error("one_byte", lambda e: ("�", e.start + 1))


class Decoder:
    """Text of ids: spaces for U+2581 but for the one before the text, bytes joined to characters
    (one U+FFFD for each byte that is part of none), nothing for control ids."""

    def __init__(self, model: Model):
        self.strip = model.add_prefix or model.remove_extra
        self.all_leading = model.remove_extra
        back = {i: b for b, i in model.bytes.items()}
        self.single = set(back)
        self.controls = {i for i, k in enumerate(model.kinds) if k == CONTROL}
        self.surface = []
        for i, (name, kind) in enumerate(zip(model.names, model.kinds)):
            self.surface.append(bytes([back[i]]) if kind == BYTE else b"" if kind == CONTROL
                                else " ⁇ ".encode() if kind == UNKNOWN else name.replace(SPACE, b" "))
        self.spaced = [k == NORMAL and n.startswith(SPACE) for n, k in zip(model.names, model.kinds)]

    def decode(self, ids: list[int]) -> bytes:
        parts = list(map(self.surface.__getitem__, ids))
        if self.strip:
            for i, part in enumerate(parts):
                if part and self.spaced[ids[i]]:
                    parts[i] = part[1:]
                    if not self.all_leading or parts[i]:
                        break
                elif part:
                    break
        if self.controls.isdisjoint(ids):
            raw = b"".join(parts)
            try:
                raw.decode()
                return raw
            except UnicodeDecodeError:
                pass
        # bytes make characters with their neighbours only
        runs = (b"".join(part for _, part in run) for _, run in groupby(zip(ids, parts), lambda x: x[0] in self.single))
        return b"".join(run.decode(errors="one_byte").encode() for run in runs)


# Tables --------------------------------------------------------------------------------
_ENCODERS: dict[str, tuple[Encoder, Decoder]] = {}


def _coders(path: str) -> tuple[Encoder, Decoder]:
    """One of each for a worker; what they keep is bounded (CACHE_UNITS)."""
    if path not in _ENCODERS:
        with open(path, "rb") as f:
            model = Model(f.read())
        _ENCODERS[path] = Encoder(model), Decoder(model)
    return _ENCODERS[path]


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return narrow, narrow.schema["id"].dataType.simpleString()


def _encoded(batches, path: str) -> Iterator[tuple[pa.RecordBatch, Encoded]]:
    encoder, _ = _coders(path)
    for whole in batches:
        for batch in slices(whole, "text", SLICE_BYTES):
            yield batch, encoder.encode(batch.column("text"))


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, ids, begins, ends``, arrays with each piece's id and the bytes
    of the UTF-8 text that it stands for (ends exclusive).

    ``model`` is the path of a model file that every executor can read.  A character without a piece
    becomes one piece a byte; the last of them has the character's span, the others an empty one.

    Defined results: null and empty texts have no piece; repeated rows are encoded each; an empty
    table gives no row; other columns are ignored.  Texts are encoded whole, and what a task holds
    beside its bounded cache follows the longest text.
    """
    narrow, id_type = _narrow(docs, id_col, text_col)

    def rows(batches):
        for batch, e in _encoded(batches, model):
            yield pa.RecordBatch.from_arrays([batch.column("id"), *[
                pa.ListArray.from_arrays(pa.array(e.first, pa.int32()), pa.array(x, kind))
                for x, kind in ((e.ids, pa.int32()), (e.begin, pa.int64()), (e.end, pa.int64()))]],
                ["id", "ids", "begins", "ends"])

    return narrow.mapInArrow(rows, f"id {id_type}, ids array<int>, begins array<bigint>, ends array<bigint>"
                             ).withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id_col, text)`` of documents' ids.  Null or no ids: empty text; a null id counts as none."""
    narrow = encoded.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").alias("ids"))
    id_type = narrow.schema["id"].dataType.simpleString()

    def rows(batches):
        _, decoder = _coders(model)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                out = [decoder.decode([i for i in ids.as_py() or () if i is not None]).decode() for ids in part.column("ids")]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(out, pa.string())], ["id", "text"])

    return narrow.mapInArrow(rows, f"id {id_type}, text string").withColumnRenamed("id", id_col)


def piece_digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, n_tokens, ids_sha256`` (decimal ids joined by commas),
    ``decoded_sha256`` (of what the ids decode to) and ``span_bytes`` (bytes of the text that the
    pieces' spans cover).  As ``encode_documents``, but the pieces stay in the task."""
    narrow, id_type = _narrow(docs, id_col, text_col)

    def rows(batches):
        _, decoder = _coders(model)
        decimal = [str(i) for i in range(len(decoder.surface))]
        for batch, e in _encoded(batches, model):
            ids_sha, text_sha = [], []
            for lo, hi in zip(e.first[:-1], e.first[1:]):
                ids = e.ids[lo:hi].tolist()
                ids_sha.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                text_sha.append(hashlib.sha256(decoder.decode(ids)).hexdigest())
            covered = np.append(0, np.cumsum(e.end - e.begin))[e.first]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(np.diff(e.first), pa.int64()), pa.array(ids_sha, pa.string()),
                pa.array(text_sha, pa.string()), pa.array(np.diff(covered), pa.int64())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256", "span_bytes"])

    return narrow.mapInArrow(
        rows, f"id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, span_bytes bigint"
    ).withColumnRenamed("id", id_col)
