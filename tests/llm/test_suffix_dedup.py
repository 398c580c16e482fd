"""Bytes under repeated windows against a count of all windows."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import suffix_dedup
from quern.llm.queries import QUERIES
from quern.sources.tables import table
from tests.llm.helpers import none, odd


def by_windows(texts, window):
    """(kept, spans) of every text."""
    raws = [(t or "").encode() for t in texts]
    times = Counter(raw[k : k + window] for raw in raws for k in range(len(raw) - window + 1))
    out = []
    for raw in raws:
        gone = np.zeros(len(raw) + 1, bool)
        for k in range(len(raw) - window + 1):
            if times[raw[k : k + window]] > 1:
                gone[k : k + window] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone])))
        spans = [(int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2])]
        out.append((bytes(b for b, g in zip(raw, gone) if not g), spans))
    return out


def told(docs, window):
    rows = suffix_dedup.without_repeats(docs, window).collect()
    return sorted((r.row.text or "", bytes(r.kept), [(s.start, s.length) for s in r.spans]) for r in rows)


def same(spark, texts, window, parts=3):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(parts)
    want = sorted((t or "", *w) for t, w in zip(texts, by_windows(texts, window)))
    return told(docs, window) == want


def made(seed, count=60, letters="abcdé "):
    draw = random.Random(seed)
    shared = ["".join(draw.choice(letters) for _ in range(draw.randrange(5, 90))) for _ in range(8)]
    out = []
    for _ in range(count):
        parts = []
        for _ in range(draw.randrange(0, 6)):
            parts.append(draw.choice(shared)[draw.randrange(6) :] if draw.random() < 0.5 else "".join(draw.choice(letters) for _ in range(draw.randrange(40))))
        out.append("".join(parts))
    return out


@pytest.mark.parametrize("seed, window", [(1, 20), (2, 33), (3, 7), (4, 1), (5, 60)])
def test_as_by_counting_windows(spark, seed, window):
    assert same(spark, made(seed), window)


def test_short_periods_and_small_batches(spark, monkeypatch):
    texts = ["ab" * 200, "x" + "ab" * 50, "abc" * 70, "x" * 300, "q" + "x" * 40, "", None, "word " * 100, "the word " * 60]
    assert same(spark, texts, 25)
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 100)
    draws = [run for seed in range(3) for run in made(seed, 15)]
    assert same(spark, texts + draws, 25)


@pytest.mark.parametrize("segment", [1, 37, 1 << 18])
def test_runs_hold_every_window_once(monkeypatch, segment):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
    raws = [t.encode() for t in made(8)]
    data, ends = np.frombuffer(b"".join(raws), np.uint8), np.cumsum([len(r) for r in raws])
    start, count, gram = suffix_dedup.runs(data, ends, 30)
    got = {int(s) + k: int(g) for s, n, g in zip(start, count, gram) for k in range(n)}
    least = suffix_dedup.minimizers(data, 30)
    inside = [int(e - len(r)) + k for e, r in zip(ends, raws) for k in range(len(r) - 29)]
    assert got == {k: least[k] for k in inside} and count.sum() == len(inside)


def test_common_line_in_other_surroundings(spark):
    draw = random.Random(9)
    line = "".join(draw.choice("abcdefgh ") for _ in range(70))
    texts = ["".join(draw.choice("xyz ") for _ in range(50)) + line + "".join(draw.choice("xyz ") for _ in range(50)) for _ in range(300)]
    assert same(spark, texts, 64) and same(spark, texts, 80)


def test_minimizers_are_the_first_least_grams():
    data = np.frombuffer("".join(made(2)).encode(), np.uint8)
    for window in (1, 6, 40, 100):
        gram = suffix_dedup.gram_length(window)
        hashes = [int(suffix_dedup.gram_hashes(data[k : k + gram], gram)[0]) for k in range(len(data) - gram + 1)]
        want = [min(range(k, k + window - gram + 1), key=lambda i: (hashes[i], i)) for k in range(len(data) - window + 1)]
        assert suffix_dedup.minimizers(data, window).tolist() == want


def test_odd_tables(spark):
    docs = odd(spark)
    assert told(docs, 12) == sorted((t or "", *w) for t, w in zip([r.text for r in docs.collect()], by_windows([r.text for r in docs.collect()], 12)))
    assert suffix_dedup.without_repeats(docs, 12).first().row.asDict().keys() == set(docs.columns)
    assert told(none(spark), 400) == []


def test_another_order_fails(spark):
    rows = spark.createDataFrame([(k, k, "a" * 30) for k in range(3)], "place long, mark long, text string")
    asked = spark.createDataFrame([(0, 7, 0, 3, 1, False)], "place long, mark long, start long, windows int, at int, sure boolean")
    with pytest.raises(Exception, match="another order"):
        suffix_dedup.strings(rows, asked, 10).collect()


def test_documents_as_by_counting_windows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    want = {r.doc_id: w for r, w in zip(docs, by_windows([r.text for r in docs], 400))}
    got = QUERIES["op12_suffix_dedup"](spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        kept, spans = want[r.doc_id]
        assert (r.kept_sha256, r.n_spans, r.n_removed) == (sha256(kept).hexdigest(), len(spans), sum(n for _, n in spans))
    assert sum(r.n_removed for r in got) > 0
