import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from stayvalue.llm import pieces
from stayvalue.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "   a  b ", "a\nb\r\n\tc", "▁x ▁▁ y", "日本語 \x00x é é", "�￾😀👩‍👩‍👧", "<s></s><unk><0x41>",
    "a" * 5000, " " * 3000, "the " * 2000, "x" * 70 + "日" * 70, "1234567890 12.5%",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def encoder():
    with open(MODEL, "rb") as file:
        return pieces.Encoder(pieces.Vocabulary.parse(file.read()))


def test_odd_texts(encoder, library):
    for text in ODD:
        ids = encoder.encode([text])[0].tolist()
        assert ids == library.encode(text, add_eos=True), text
        assert encoder.decode(ids) == library.decode(ids)


def test_random_texts(encoder, library):
    chance = random.Random(11)
    letters = "abc  ▁é日本\n\t\x00😀ñtheing01　​�."
    texts = ["".join(chance.choices(letters, k=chance.randint(0, 60))) for _ in range(6000)]
    for at in range(0, len(texts), 700):
        part = texts[at : at + 700]
        encoded = [ids.tolist() for ids in encoder.encode(part)]
        assert encoded == library.encode(part, add_eos=True)
        assert [encoder.decode(ids) for ids in encoded] == library.decode(encoded)


def test_any_ids_decode_as_in_the_library(encoder, library):
    chance = random.Random(12)
    for _ in range(5000):
        ids = [
            chance.choice([0, 1, 2, 259, 264, chance.randrange(3, 259), chance.randrange(32000)])
            for _ in range(chance.randint(0, 8))
        ]
        assert encoder.decode(ids) == library.decode(ids), ids


def test_both_agendas_give_the_same_symbols(encoder):
    chance = random.Random(13)
    texts = ["".join(chance.choices("▁▁ttheinagaaab日", k=chance.randint(1, 60))) for _ in range(2000)]
    pieces_of = encoder.vocabulary.pieces
    numbers, ends = encoder.side_by_side(texts)
    for text, begin, end in zip(texts, [0, *ends], ends):
        names = [
            pieces_of[n] if n < len(pieces_of) else chr(n - len(pieces_of)) for n in numbers[begin:end]
        ]
        assert names == encoder.heaped(text)


def test_memory_of_stretches_is_bounded(encoder, library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    monkeypatch.setattr(pieces, "TOGETHER", 2)
    encoder.known.clear()
    text = "one two three four five six one two " + "x" * 100
    for _ in range(3):
        assert encoder.encode([text])[0].tolist() == library.encode(text, add_eos=True)
        assert len(encoder.known) <= 7  # of the last slice


def test_every_stretch_is_looked_up_once(encoder, library):
    class Counted(pieces._Numbers):
        count = 0

        def __getitem__(self, stretch):
            self.count += 1
            return super().__getitem__(stretch)

    encoder._forget()
    encoder.known = Counted()
    texts = ["one two one three", "", "two three"]
    for _ in range(2):
        assert [ids.tolist() for ids in encoder.encode(texts)] == library.encode(texts, add_eos=True)
    assert encoder.known.count == 2 * (6 + len(texts))  # the stretches, and the end of each text
    encoder._forget()


def test_long_stretches_are_not_kept(encoder, library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    encoder._forget()
    for i in range(20):
        text = chr(97 + i) * 500
        assert encoder.encode([text])[0].tolist() == library.encode(text, add_eos=True)
        assert len(encoder.known) <= 3 and len(encoder.pool) <= 4 * 501
    encoder._forget()


def test_pairs_are_found_in_few_steps(encoder):
    chance = random.Random(14)
    ids = encoder.ids
    pairs = {}
    for piece in ids:
        for cut in range(1, len(piece)):
            if piece[:cut] in ids and piece[cut:] in ids:
                pairs[ids[piece[:cut]], ids[piece[cut:]]] = piece
    others = {(chance.randrange(32000), chance.randrange(32000)) for _ in range(50_000)} - set(pairs)
    others.add((32000 + 0x65E5, 32000 + 0x672C))  # characters as if they were without a piece
    left, right = np.array([*pairs, *others]).T
    costs, found = encoder._price(left, right)
    named = [encoder.vocabulary.pieces[n] for n in found[: len(pairs)]]
    assert named == list(pairs.values())
    assert costs[: len(pairs)].tolist() == [encoder.costs[piece] for piece in named]
    assert np.isinf(costs[len(pairs) :]).all()
    held = np.flatnonzero(encoder.pair_keys >= 0)
    assert len(held) == len(pairs)
    assert (held - encoder._slots(encoder.pair_keys[held])).mean() < 1


def test_other_vocabularies_are_refused(spark, documents, tmp_path):
    # A trainer message of unigram type (field 3 = 1) behind one piece.
    path = tmp_path / "other.model"
    path.write_bytes(b"\x0a\x03\x0a\x01a" + b"\x12\x02\x18\x01")
    with pytest.raises(ValueError, match="merges"):
        pieces.encode(documents(["a"]), str(path))


def test_frame(documents, library):
    rows = [(i, text, None, None, 0) for i, text in enumerate([*ODD, None, "again", "again"])]
    rows += [(None, "no id", None, None, 0), (3, "twice", None, None, 0), (3, "twice", None, None, 0)]
    docs = documents(rows).withColumnsRenamed({"lang": "ids", "source": "decoded"})
    found = pieces.encode(docs, MODEL).collect()
    expected = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_eos=True)
        expected.append((doc_id, ids, library.decode(ids)))
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in found), key=repr) == sorted(expected, key=repr)
    assert all(r.agrees for r in found)
    for r in found:
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()


def test_decode_frame(documents):
    docs = documents(["one two", None, "日本\n"])
    encoded = pieces.encode(docs, MODEL, check=False).drop("decoded")
    assert encoded.filter("agrees is not null").count() == 0
    back = pieces.decode(encoded, MODEL)
    assert {r.doc_id: r.decoded for r in back.collect()} == {0: "one two", 1: "", 2: "日本\n"}


def test_slices_are_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "SLICE", 10)
    texts = ["abc"] * 7 + ["x" * 50] + [""]
    parts = list(pieces._slices(texts))
    assert [t for part in parts for t in part] == texts
    assert max(map(len, parts)) <= 4


def test_empty_table(documents):
    assert pieces.encode(documents([("x",)][:0]), MODEL).collect() == []


def test_query_agrees_with_the_library(spark, sf_dir, library):
    found = {r.doc_id: r for r in QUERIES["op11_sentencepiece"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(found) == len(docs)
    for doc in docs:
        ids = library.encode(doc.text or "", add_eos=True)
        row = found[doc.doc_id]
        assert (row.n_tokens, row.agrees) == (len(ids), True)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
