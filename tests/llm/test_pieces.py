"""The codec against the sentencepiece library and its own round trips."""

import dataclasses
import hashlib
import random
import struct

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from farelens.llm import pieces, queries
from farelens.llm.common import documents
from tests.conftest import SF_SMALL
from tests.llm.fixtures import no_docs, odd_docs

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    model = pieces.Model.parse(pieces.read_model(PATH))
    return pieces.Codec(model), sentencepiece.SentencePieceProcessor(model_file=PATH)


def _texts():
    rnd = random.Random(1)
    chars = list(" \t\n▁abceé漢😀\x00<0x41>​́Ωﬁ")
    texts = ["", " ", "a", "  a  b ", "é\tb\n\nc", "▁x", "<s> hi </s>", "   ", "a" * 5000, "ab " * 3000, "▁" * 70 + "x" * 40]
    return texts + ["".join(rnd.choice(chars) for _ in range(rnd.randrange(60))) for _ in range(800)]


def test_encode_decode_and_spans_equal_the_library(both):
    codec, library = both
    for t in _texts():
        ids = codec.encode(t)
        assert ids == library.encode(t)
        assert codec.decode(ids) == library.decode(ids)
        spans = codec.spans(t)
        assert [i for i, *_ in spans] == ids
        if t:
            proto = library.encode(t, return_type="proto")
            for (_, piece, begin, end), p in zip(spans, proto.pieces):
                if not piece.startswith("<0x"):
                    assert (begin, end) == (p.begin, p.end)


def test_decode_of_any_ids_equals_the_library(both):
    codec, library = both
    rnd = random.Random(3)
    for _ in range(500):
        ids = [rnd.randrange(32000) if rnd.random() < 0.5 else rnd.randrange(300) for _ in range(rnd.randrange(12))]
        assert codec.decode(ids) == library.decode(ids)


def test_memory_starts_anew(both, monkeypatch):
    codec, library = both
    monkeypatch.setattr(pieces, "MEMORY", 5)
    texts = _texts()[:200]
    assert list(codec.encode_all(texts)) == library.encode(texts)


def _array(entries: dict[bytes, int]) -> bytes:
    """A double array with the given values, built by trying every offset."""
    units, used = [0] * 4096, {0}

    def place(at: int, keys: list[tuple[bytes, int]]) -> None:
        labels = sorted({k[0] if k else 0 for k, _ in keys})
        base = next(b for b in range(1, 4096) if not any((b ^ c) in used for c in labels))
        used.update(b for b in (base ^ c for c in labels))
        units[at] |= (at ^ base) << 10
        for c in labels:
            if c == 0:
                units[at] |= 1 << 8
                units[base] = 1 << 31 | next(v for k, v in keys if not k)
            else:
                units[base ^ c] |= c
                place(base ^ c, [(k[1:], v) for k, v in keys if k and k[0] == c])

    place(0, sorted(entries.items()))
    return struct.pack("<4096I", *units)


def test_longest_prefix_normalisation_keeps_offsets():
    """'ﬁ' -> 'fi', 'ab' -> 'X', 'abc' -> 'YY', ideographic blank -> ' '."""
    text = b"fi\0X\0YY\0 \0"
    trie = _array({"ﬁ".encode(): 0, b"ab": 3, b"abc": 5, "　".encode(): 8})
    charmap = pieces.CharacterMap(struct.pack("<I", len(trie)) + trie + text)
    assert charmap.longest(b"abcd", 0) == (3, b"YY") and charmap.longest(b"abd", 0) == (2, b"X")
    assert charmap.longest(b"xab", 0) is None and charmap.longest(b"a", 0) is None
    model = pieces.Model(pieces=["<unk>"], scores=[0.0], kinds=[2], charmap=charmap, add_dummy_prefix=True, remove_extra_whitespaces=True)
    norm, source = pieces.normalise(model, "　 ﬁ　abc")
    assert norm.decode() == "▁fi▁YY"
    # the mark and both letters of the ligature come from byte 4, the blank from 7, YY from 10
    assert source == [4, 4, 4, 4, 4, 7, 7, 7, 10, 10, 13]


def test_query_tables(spark, both):
    codec, library = both
    docs = odd_docs(spark)
    model = pieces.read_model(PATH)
    texts = sorted((r.doc_id or 0, r.text or "") for r in docs.collect())
    coded = pieces.encode(docs, model)
    assert sorted((r.doc_id or 0, r.ids) for r in coded.collect()) == sorted((i, library.encode(t) + [2]) for i, t in texts)
    back = sorted((r.doc_id or 0, r.decoded) for r in pieces.decode(coded, model).collect())
    assert back == sorted((i, library.decode(library.encode(t))) for i, t in texts)
    for r in pieces.encode_spans(docs, model).collect():
        assert len(r.ids) == len(r.pieces) == len(r.begins) == len(r.ends)
    assert pieces.encode(no_docs(spark), model).count() == 0 == pieces.encode_spans(no_docs(spark), model).count()


def test_ranges_equal_the_walk(both):
    """Ranges by added lengths against the walk over each byte and each merge, for the
    model as it is, with a map, without extra blanks and without byte pieces."""
    charmap = pieces.CharacterMap(struct.pack("<I", 4 * 4096) + _array({"漢".encode(): 0, b"ab": 3}) + b"fi\0X\0")
    assert charmap.starts[[ord("a"), "漢".encode()[0]]].all() and not charmap.starts[ord("c")]
    plain = both[0].model
    for change in ({}, {"charmap": charmap}, {"remove_extra_whitespaces": True}, {"add_dummy_prefix": False}, {"kinds": [k if k != pieces.BYTE else pieces.CONTROL for k in plain.kinds]}):
        model = dataclasses.replace(plain, **change)
        codec = pieces.Codec(model)
        texts = _texts()[:300]
        for t, (ids, begins, ends) in zip(texts, codec.code_all(texts)):
            norm, source = pieces.normalise(model, t)
            found, at = [], 0
            for s in codec.stretches(norm.decode()):
                for piece in pieces.merge(model, s):
                    end = at + len(piece.encode())
                    found += [(i, source[at], source[end]) for i in codec.piece_ids(piece)]
                    at = end
            assert list(zip(ids, begins.tolist(), ends.tolist())) == found, (change, t)


def test_registered_query_and_stage_give_pieces_and_byte_ranges(spark, both):
    _, library = both
    rows = {r.doc_id: r.text for r in documents(spark, SF_SMALL).collect()}
    stage = dict(corpus_pipeline.STAGES)["sentencepiece_encoding"](spark, documents(spark, SF_SMALL), SF_SMALL)
    coded = {r.doc_id: r for r in stage.collect()}
    digests = {r.doc_id: r for r in queries.op7_sentencepiece(spark, SF_SMALL).collect()}
    assert coded.keys() == rows.keys() == digests.keys()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for i, t in rows.items():
        proto, r, size = library.encode(t or "", return_type="proto").pieces, coded[i], len((t or "").encode())
        assert r.ids == [p.id for p in proto] + [2] and r.pieces == [p.piece for p in proto] + ["</s>"]
        for p, b, e in zip(proto, r.begins, r.ends):
            assert p.piece.startswith("<0x") or (b, e) == (p.begin, p.end)
        assert (r.begins[-1], r.ends[-1]) == (size, size)
        # nothing of the text is without a piece
        assert [0, *r.ends][: len(r.begins)] == r.begins or any(p.piece.startswith("<0x") for p in proto)
        assert digests[i].ids_sha256 == sha(" ".join(map(str, r.ids))) and digests[i].decoded_sha256 == sha(library.decode(r.ids))
    spans = {r.doc_id: r.h for r in stage.select("doc_id", F.xxhash64("begins", "ends").alias("h")).collect()}
    assert spans == {i: r.spans_hash for i, r in digests.items()}


def test_end_id_is_an_empty_range_after_the_text(spark, both):
    model = pieces.read_model(PATH)
    for r in pieces.encode_spans(odd_docs(spark), model, end=True).join(odd_docs(spark).select("doc_id", "text"), "doc_id").collect():
        size = len((r.text or "").encode())
        assert (r.ids[-1], r.pieces[-1], r.begins[-1], r.ends[-1]) == (2, "</s>", size, size)
        assert size == 0 or (r.begins[0], max(r.ends)) == (0, size)
