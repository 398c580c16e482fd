import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm import byte_bpe
from quern.sources.tables import table
from tests.llm.helpers import none, odd

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
BPE = byte_bpe.ByteBpe(PATH)
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
REAL = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_the_pattern_is_the_files_own():
    assert byte_bpe.SPLIT_PATTERN == public_tokenizers.PATTERN


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=60), max_size=5))
def test_ids_are_those_of_the_library(texts):
    ids, sizes = BPE.encode(texts)
    ends = np.cumsum(sizes)
    parts = [ids[e - n : e] for n, e in zip(sizes, ends)]
    assert [p.tolist() for p in parts] == [REAL.encode_ordinary(t) for t in texts]
    assert [BPE.decode(p) for p in parts] == [t.encode() for t in texts]


@pytest.mark.parametrize("text", ["x" * 4000, "lorem" * 500, "abé" * 300, "a" * 256, "a" * 257])
def test_long_pieces(text):
    assert BPE.encode([text])[0].tolist() == REAL.encode_ordinary(text)


def test_a_full_table_of_pieces_starts_anew():
    small = byte_bpe.ByteBpe(PATH, kept=3)
    for text in ["one two three four five", "six seven eight nine ten", "one two"]:
        assert small.encode([text])[0].tolist() == REAL.encode_ordinary(text)


def test_documents_round_trip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    told = {r.doc_id: r for r in byte_bpe.round_trip(docs, PATH).collect()}
    for r in docs.collect():
        ids = REAL.encode_ordinary(r.text or "")
        assert told[r.doc_id].n_tokens == len(ids)
        assert told[r.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert told[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_odd_rows(spark):
    encoded = byte_bpe.encode(odd(spark), PATH)
    rows = byte_bpe.decode(encoded, PATH).collect()
    assert len(rows) == 8 and [r.ids for r in rows if r.doc_id in (2, 3)] == [[], []]
    assert {bytes(r.decoded) for r in rows if r.doc_id == 7} == {b"word " * 3000}
    assert byte_bpe.encode(none(spark), PATH).count() == 0
    assert byte_bpe.round_trip(none(spark), PATH).count() == 0
