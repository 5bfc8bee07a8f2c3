"""Operator 13 against the library: ids, spans, decoding, and normalisation with character maps."""
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tallyframe.llm import pieces, queries

from ..conftest import SF_SMALL

PATH = str(public_tokenizers.path(queries.PIECES))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as f:
        return pieces.Model(f.read())


def hostile(n, seed=1, most=60):
    rng = random.Random(seed)
    letters = "ab cd  é▁　日本😀\n\t́ <s>{}()',.0\x00�​"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, most))) for _ in range(n)]


FIXED = ["", " ", "  ", " a", "a ", "a  b", "<s> </s> <unk> <0x41>", "▁▁a ▁ b", "日本語のテキスト" * 40, "a" * 500,
         "x" * 49 + "=" * 200, "the " * 3000, "\x00", "😀" * 70, "words,with.punctuation;and\nlines\r\n"]


def test_ids_spans_and_text_equal_the_library(library, model):
    texts = FIXED + hostile(1500)
    encoder, decoder = pieces.Encoder(model), pieces.Decoder(model)
    got = encoder.encode(pa.array(texts))
    again = encoder.encode(pa.array(texts[::-1]))  # all units known by now
    for i, text in enumerate(texts):
        part = slice(got.first[i], got.first[i + 1])
        ids = got.ids[part].tolist()
        assert ids == library.encode(text)
        j = len(texts) - 1 - i
        assert again.ids[again.first[j]:again.first[j + 1]].tolist() == ids
        assert decoder.decode(ids).decode() == library.decode(ids)
        want = [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
        place = np.append(0, np.cumsum([len(c.encode()) for c in text], dtype=int)).tolist()
        spans = list(zip(got.begin[part].tolist(), got.end[part].tolist()))
        assert spans in (want, [(place[a], place[b]) for a, b in want if b < len(place)])


def test_units_are_bounded_and_relearned(monkeypatch, library, model):
    monkeypatch.setattr(pieces, "CACHE_UNITS", 20)
    encoder = pieces.Encoder(model)
    for text in hostile(300, seed=5):
        assert encoder.encode(pa.array([text])).ids.tolist() == library.encode(text)


def test_decoding_any_ids(library, model):
    decoder, rng = pieces.Decoder(model), random.Random(7)
    for _ in range(500):
        ids = [rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(3, 31999), 29871, 259]) for _ in range(rng.randint(0, 12))]
        assert decoder.decode(ids).decode() == library.decode(ids)


def fake_model(charsmap, add_prefix, remove_extra, escape):
    m = pieces.Model.__new__(pieces.Model)
    m.map = pieces.CharacterMap(charsmap)
    m.add_prefix, m.remove_extra, m.escape = add_prefix, remove_extra, escape
    return m


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("options", [(False, False, False), (True, True, True), (False, True, True), (True, False, True)])
def test_normalisation_records_its_source(rule, options):
    add_prefix, remove_extra, escape = options
    library = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=add_prefix, remove_extra_whitespaces=remove_extra, escape_whitespaces=escape)
    spec = dict(pieces._fields(dict(pieces._fields(library.serialized_model_proto()))[3]))
    encoder = pieces.Encoder.__new__(pieces.Encoder)
    encoder.model = fake_model(spec.get(2, b""), *options)
    rng, letters = random.Random(3), "ab Cé Ａｂ①㍿  ́​ﬁΩ日ｶﾞ\t\n´ǆ가가"
    texts = ["", "  ", " a ", "a  "] + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 25))) for _ in range(500)]
    out, origin, first, over = encoder.normalise(*(args := pieces.texts(pa.array(texts))))
    for i, text in enumerate(texts):
        want, offsets = library.normalize(text, with_offsets=True)
        own = out[first[i]:first[i + 1]].tobytes().decode()
        assert own == want
        # the library counts characters
        place = np.append(0, np.cumsum([len(c.encode()) for c in text], dtype=int)).tolist()
        begins = np.append(0, np.cumsum([len(c.encode()) for c in own], dtype=int))
        source = np.append(origin[first[i]:first[i + 1]], over[i]) - args[1][i]
        assert [place.index(x) for x in source[begins].tolist()] == list(offsets)


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        pieces.Model(b"")


def test_documents(spark, library):
    long = " ".join(f"word{i % 700}," for i in range(40000))
    rows = [(1, None, 5), (2, "", 5), (3, long, 5), (3, long, 5), (None, "no id é", 5), (4, "日本\u0000😀 x", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(3)
    encoded = pieces.encode_documents(df, PATH)
    want = sorted(((k, library.encode(t or "")) for k, t, _ in rows), key=repr)
    assert sorted(((r[0], r[1]) for r in encoded.select("doc_id", "ids").collect()), key=repr) == want
    decoded = sorted(((r[0], r[1]) for r in pieces.decode_documents(encoded, PATH).collect()), key=repr)
    assert decoded == sorted(((k, t or "") for k, t, _ in rows), key=repr)
    for r in encoded.filter("doc_id = 4").collect():
        raw = rows[-1][1].encode()
        assert b"".join(raw[a:b] for a, b in zip(r["begins"], r["ends"])) == raw
    assert pieces.encode_documents(df.limit(0), PATH).count() == 0
    none = spark.createDataFrame([("k", None), ("l", [])], "doc_id string, ids array<int>")
    assert sorted(map(tuple, pieces.decode_documents(none, PATH).collect())) == [("k", ""), ("l", "")]


def test_query_equals_the_library(spark, library):
    got = {r["doc_id"]: r for r in queries.op13_sentence_pieces(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", F.coalesce("text", F.lit(""))).collect()
    assert len(got) == len(docs)
    for key, text in docs:
        ids = library.encode(text)
        row = got[key]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert row["span_bytes"] == len(text.encode())
