import struct
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from adsieve.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, ids int, sequence_id string"


def rebuilt(pieces, window):
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) // 4 > 0
        docs[p.doc_id].append((p.start, list(struct.unpack(f"<{p.length}I", p.ids)), p.doc_tokens))
        sequences[p.sequence_id].append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return docs, sequences


def joined(parts):
    out = []
    for start, ids, total in sorted(parts):
        assert start == len(out)
        out += ids
    assert len(out) == parts[0][2]
    return out


def test_round_trip(spark):
    texts = ["", None, "Hello, World!", "don't STOP " * 900, "ǅ é İ ́x", "a b c\td\x0be\x0c\r\nf", "x" * 5000,
             "<|endoftext|> kept <|startoftext|>s", "  ", "日本語 тест ' s 're", "10 000̊"]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts * 1)], SCHEMA)
    pieces = packing.pack(df, PATH, window=256, open_windows=4).collect()
    docs, _ = rebuilt(pieces, 256)
    coder = Tokenizer.from_file(PATH)
    for i, t in enumerate(texts):
        assert joined(docs[i]) == coder.encode(t or "", add_special_tokens=False).ids + [1]


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a b"), (7, "a b"), (7, "a b")], "doc_id long, text string")
    pieces = packing.pack(df, PATH).collect()
    assert sorted((p.doc_id is None, p.length) for p in pieces) == [(False, 3), (False, 3), (True, 3)]


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), PATH).count() == 0


@pytest.mark.parametrize("count", [1, 16])
def test_little_padding(spark, count):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    pieces = packing.pack(docs, PATH, open_windows=count).collect()
    found, sequences = rebuilt(pieces, 2048)
    for parts in found.values():
        joined(parts)
    used = sum(p.length for p in pieces)
    if count > 1:
        assert len(sequences) * 2048 <= 1.03 * used + 2048
