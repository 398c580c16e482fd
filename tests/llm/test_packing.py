import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from quern.llm import packing
from quern.sources.tables import table
from tests.llm.helpers import none, odd

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(text):
    tokenizer = Tokenizer.from_file(PATH)
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_pieces_are_the_binary_digits():
    assert packing.pieces(1024 * 2 + 5, 1024) == [(0, 1024), (1024, 1024), (2048, 4), (2052, 1)]
    assert packing.pieces(1, 1024) == [(0, 1)]


def test_ids_are_those_of_the_tokenizer():
    encode = packing.encoder(PATH)
    for text in ["", "a  b\n\n c\t", "it's 123 <|endoftext|> é日本 \x1c\x85\xa0 x", "<|endoftext|><|endoftext", " " * 1_200_000]:
        assert [*encode(text).tolist(), 0] == expected(text)


def test_every_document_is_whole(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = packing.pack(docs, PATH).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    by = {}
    for r in sorted(rows, key=lambda r: r.start):
        assert r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 1024
        by.setdefault(r.doc_id, []).append(r)
    assert set(by) == set(texts)
    for doc, parts in list(by.items())[:40]:
        ids = expected(texts[doc])
        assert b"".join(p.ids for p in parts) == np.array(ids, "<u4").tobytes()
        assert all(p.doc_tokens == len(ids) for p in parts)
        assert zlib.crc32(parts[0].ids) == spark.range(1).selectExpr(f"crc32(X'{parts[0].ids.hex()}') c").first().c


def test_odd_rows(spark):
    rows = packing.pack(odd(spark), PATH).collect()
    one = [r for r in rows if r.doc_id in (2, 3)]
    assert [(r.start, r.length, r.doc_tokens) for r in one] == [(0, 1, 1)] * 2
    assert len([r for r in rows if r.doc_id == 5 and r.start == 0]) == 2
    assert any(r.doc_id is None for r in rows)
    assert sum(r.length for r in rows if r.doc_id == 7) == len(expected("word " * 3000))
    assert packing.pack(none(spark), PATH).count() == 0


def test_ranges_of_sequences_are_buckets(spark, sf_dir):
    rows = packing.pack(table(spark, sf_dir, "documents").repartition(5), PATH).orderBy("sequence_id").collect()
    lengths = [r.length for r in rows]
    assert lengths == sorted(lengths) and len({r.sequence_id for r in rows}) == len(rows) and rows[0].sequence_id >= 0
