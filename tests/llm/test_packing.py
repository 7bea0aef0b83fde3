import random
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from oncallmart.llm import packing


def ids_of(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [x.ids + [1] for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(rows, texts):
    """`texts` holds (doc_id, text); every piece, checksum and place is as stated."""
    want = defaultdict(int)
    for (doc_id, _), ids in zip(texts, ids_of([t for _, t in texts])):
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[(doc_id, k, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)))] += 1
    got, sequences = defaultdict(int), defaultdict(list)
    for r in rows:
        got[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 4096
    return len(sequences), -(-sum(r.length for r in rows) // 4096)


def test_pieces_and_places(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    texts = [tuple(r) for r in documents.collect()]
    n, least = check(packing.pack_documents(documents).collect(), texts)
    assert n == least


def test_many_blocks_meet_again(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    texts = [tuple(r) for r in documents.collect()]
    n, least = check(packing.pack_documents(documents, block=50).collect(), texts)
    assert n <= least + 2


def test_hard_rows(hard, empty):
    texts = [(r.doc_id, r.text) for r in hard.collect()]
    check(packing.pack_documents(hard).collect(), texts)
    assert packing.pack_documents(empty).collect() == []


def test_special_strings_as_the_tokenizer_reads_them():
    texts = ["a<|endoftext|>b <|ENDOFTEXT|> c", "It'S 'S x.y, .z é É", "1.5, 2.", "a\x1cb c\u0085d"]
    found = packing.Ids(public_tokenizers.path("word_bpe_49k.json"))([t.encode() for t in texts])
    assert [list(struct.unpack(f"<{len(x) // 4}I", x)) for x in found] == ids_of(texts)


def brute(lengths):
    best = len(lengths)

    def place(k, free):
        nonlocal best
        if len(free) >= best:
            return
        if k == len(lengths):
            best = len(free)
            return
        for i in range(len(free)):
            if free[i] >= lengths[k]:
                free[i] -= lengths[k]
                place(k + 1, free)
                free[i] += lengths[k]
        place(k + 1, [*free, 4096 - lengths[k]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(12))
def test_fewest_sequences(seed):
    dice = random.Random(seed)
    lengths = [dice.randint(300, 2500) for _ in range(8)]
    made = packing.pack(lengths)
    assert sorted(x for s in made for x in s) == sorted(lengths)
    assert max(map(sum, made)) <= 4096
    assert len(made) == brute(lengths)


@pytest.mark.parametrize("lengths", [[], [4096], [1] * 9000, [2] * 4000 + [4095] * 3, [3000] * 100])
def test_extreme_lengths(lengths):
    made = packing.pack(lengths)
    assert sorted(x for s in made for x in s) == sorted(lengths)
    assert len(made) == max(-(-sum(lengths) // 4096), sum(x > 2048 for x in lengths))
