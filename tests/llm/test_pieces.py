import hashlib
import random
import struct

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from oncallmart.llm import pieces, queries

FILE = pieces.default_file()
MODEL = pieces.pieces_by(FILE)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=FILE)


def numbers(ids):
    return list(struct.unpack(f"<{len(ids) // 4}I", ids))


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def agrees(text):
    want = LIBRARY.encode(text, add_bos=True, add_eos=True)
    got = MODEL.encode(text)
    assert numbers(got) == want, text
    assert MODEL.decode(got) == LIBRARY.decode(want), text


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text(text):
    agrees(text)


def test_spaces_controls_and_markers():
    for n in range(60):
        agrees(" " * n)
        agrees(" " * n + "x" + " " * (n * 7 % 31) + "y")
    for text in ("▁", "▁▁ a", "<s> </s> <0x0A> <unk>", "\x00\n\t\r", "�", "a" * 3000, "0123 45", "é é"):
        agrees(text)


def test_rows_of_random_pieces():
    """Pieces next to each other try the pair test at every border."""
    pick = random.Random(5)
    every = list(MODEL.piece)
    for _ in range(4000):
        agrees("".join(pick.choice(every) for _ in range(pick.randint(2, 8))))


def test_any_ids_decode():
    pick = random.Random(6)
    for _ in range(20000):
        ids = [pick.choice([pick.randrange(32000), pick.randrange(3), pick.randrange(190, 259), 28705]) for _ in range(pick.randint(0, 6))]
        assert MODEL.decode(packed(ids)) == LIBRARY.decode(ids), ids


def test_each_piece_encodes_to_itself():
    for text, k in random.Random(7).sample(sorted(MODEL.piece.items()), 500):
        assert numbers(MODEL.stretch(text)) == [k]
        assert pieces.merged(text, {t: MODEL.score[p] for t, p in MODEL.piece.items()}) == [text]


def test_other_models_are_refused():
    def field(number, value):
        return bytes([number << 3, value])

    piece = b"\x0a\x05" + b"\x0a\x01a" + b"\x18\x01"
    for trainer in (field(3, 1), field(3, 2)):
        with pytest.raises(ValueError):
            pieces.Pieces(piece + bytes([0x12, len(trainer)]) + trainer)


def test_whole_texts(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    want = {}
    for r in documents.select("doc_id", "text").collect():
        ids = LIBRARY.encode(r.text or "", add_bos=True, add_eos=True)
        want[r.doc_id] = (
            len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest(),
        )
    rows = queries.QUERIES["op13_pieces"](spark, small).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want
    assert len(rows) == documents.count()


def test_hard_rows_and_round_trip(spark, hard, empty):
    coded = pieces.encode(hard)
    decoded = pieces.decode(coded).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.decoded) for r in decoded) == sorted(
        (r.doc_id is None, r.doc_id or 0, r.text or "") for r in hard.collect()
    )
    null_text = [r for r in pieces.encode_decode(hard).collect() if r.doc_id == 0]
    assert [(numbers(r.ids), r.decoded) for r in null_text] == [([1, 2], "")]
    assert pieces.digests(empty).collect() == []
    assert pieces.digests(empty).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
