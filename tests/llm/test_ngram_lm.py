import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.llm import ngram_lm, queries
from quern.llm.elias_fano import MonotoneSequence, mapped
from quern.llm.packed import packed, unpacked
from quern.sources.tables import table
from tests.llm.helpers import LOW, none, odd, words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**40)), st.lists(st.integers(0, 2**40)))
def test_monotone_sequences_find_their_values(values, others):
    kept = np.unique(np.array(values, np.uint64))
    level = MonotoneSequence(mapped({"a": MonotoneSequence.of(kept, 2**40 + 1).arrays})["a"])
    assert (level.all() == kept).all()
    asked = np.array([*values, *others], np.uint64)
    at = {int(v): k for k, v in enumerate(kept)}
    assert level.find(asked).tolist() == [at.get(int(v), -1) for v in asked]


def test_pointers_may_repeat():
    values = np.array([0, 0, 3, 3, 3, 9])
    assert MonotoneSequence.of(values, 10).all().tolist() == values.tolist()


def test_packed_arrays_come_back():
    arrays = [np.arange(5, dtype=np.uint64), np.empty(0, np.uint32), np.array([7], np.uint8)]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, unpacked(packed(arrays))))


def brute(texts, train):
    """id -> (tokens, known tokens, base score, score), N; the model's smoothing without rounding."""
    split = {i: words((t or "").translate(LOW)) for i, t in texts.items()}
    c = Counter(w for i in split if train(i) for w in [*split[i], None])
    one, two, three = Counter(), Counter(), Counter()
    for i in filter(train, split):
        x = ["<s>", *split[i], None]
        one.update(x[:-1])
        two.update(zip(x, x[1:]))
        three.update(zip(x, x[1:], x[2:]))
    total, distinct = sum(c.values()), len(c)
    size = lambda n: int(math.log2(n)) + 1

    def back(contexts, children, of):
        events, new, once = Counter(), Counter(), Counter(of(k) for k, n in children.items() if n == 1)
        for k, n in contexts.items():
            if n > 1:
                events[size(n - 1)] += n
                new[size(n - 1)] += once[k]
        return lambda n: (new[size(n)] + 1) / (events[size(n)] + 2)

    back2 = back(one, two, lambda k: k[0])
    back3 = back({k: n for k, n in two.items() if k[1] is not None}, three, lambda k: k[:2])
    p1 = lambda w: (c[w] + 1) / (total + distinct + 1)

    def p2(a, b):
        return p1(b) if not one[a] else (1 - back2(one[a])) * two[a, b] / one[a] + back2(one[a]) * p1(b)

    def p3(a, b, d):
        n = two[a, b]
        return p2(b, d) if not n else (1 - back3(n)) * three[a, b, d] / n + back3(n) * p2(b, d)

    out = {}
    for i, w in split.items():
        x = ["<s>", *w, None]
        score = math.log10(p2(*x[:2])) + sum(math.log10(p3(*x[k : k + 3])) for k in range(len(x) - 2))
        out[i] = (len(w) + 1, sum(c[t] > 0 for t in x[1:]), sum(math.log10(p1(t)) for t in x[1:]), score)
    return out, total


@pytest.mark.parametrize("shard_bytes", [12 << 20, 40_000])
def test_scores_are_those_of_brute_force(spark, sf_dir, monkeypatch, shard_bytes):
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", shard_bytes)
    docs = table(spark, sf_dir, "documents")
    want, total = brute({r.doc_id: r.text for r in docs.collect()}, lambda i: zlib.crc32(str(i).encode()) % 7 != 2)
    rows = queries.QUERIES["op9_ngram_lm"](spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(want)
    for r in rows:
        tokens, known, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (tokens, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert abs(r.score - score) < 0.03 * tokens
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_small_chunks_know_the_whole_counts_of_split_words(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 10_000)
    monkeypatch.setattr(ngram_lm, "CHUNK_BYTES", 3_000)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    want, _ = brute({r.doc_id: r.text for r in docs.collect()}, lambda i: zlib.crc32(str(i).encode()) % 7 != 2)
    for r in queries.QUERIES["op9_ngram_lm"](spark, sf_dir).collect():
        tokens, known, base, score = want[r.doc_id]
        assert r.n_known == known
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert abs(r.score - score) < 0.03 * tokens


def test_third_words_stay_apart():
    n = 20_000
    chunk = ngram_lm.Chunk.of(pa.array([f"a b w{k}" for k in range(n)]), np.ones(n, bool))
    paths = ngram_lm.Paths(chunk, ngram_lm.Plan(1, np.empty(0, np.uint64), np.empty(0, np.uint64)))
    [(_, message)] = paths.messages(chunk.train, chunk.counts)
    assert ngram_lm.Trie([unpacked(message)]).contexts2[1].max() == n


def test_odd_rows(spark):
    rows = ngram_lm.score_corpus(odd(spark), F.lit(True)).collect()
    want, total = brute({k: t for k, t in enumerate([x.text for x in odd(spark).collect()])}, lambda i: True)
    assert sorted((r.n_tokens, r.n_known) for r in rows) == sorted(v[:2] for v in want.values())
    assert {r.train_tokens for r in rows} == {total} and {r.n_tokens for r in rows if r.doc_id in (2, 3, 4)} == {1}
    untaught = ngram_lm.score_corpus(odd(spark), F.lit(None).cast("boolean")).collect()
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in untaught} == {(0, 0, 0.0, 0.0)}
    assert ngram_lm.score_corpus(none(spark), F.lit(True)).count() == 0
