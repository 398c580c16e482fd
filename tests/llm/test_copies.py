"""Jaccard join, components, repeated passages, near-equal vectors."""

import random

import numpy as np
import pytest

from quern.llm import jaccard_join, near_vectors, substrings
from quern.llm.components import connected
from quern.sources.tables import table
from tests.llm.helpers import components, jaccard_components, none, odd


def test_components_of_random_graphs(spark):
    draw = random.Random(3)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(160)] + [(k, k + 1) for k in range(1000, 1120)]
    want = components({n for link in links for n in link}, links)
    got = {r.node: r.root for r in connected(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {n: r for n, r in want.items() if n in got} and all(want[n] == n for n in want if n not in got)
    assert connected(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_subset_sizes_cover_every_partner():
    for n in range(1, 30):
        for m in range(1, 40):
            common = jaccard_join.needed(n, m)
            assert (100 * common >= 80 * (n + m - common)) and (100 * (common - 1) < 80 * (n + m - common + 1))
            if common <= min(n, m):
                assert common in jaccard_join.subset_sizes(n) and common in jaccard_join.subset_sizes(m)


def variants(count, seed):
    draw = random.Random(seed)
    texts = {}
    for group in range(count):
        base = [f"w{draw.randrange(60)}" for _ in range(draw.randrange(1, 60))]
        for k in range(6):
            w = list(base)
            for _ in range(draw.randrange(0, 3)):
                w[draw.randrange(len(w))] = f"v{draw.randrange(9)}"
            texts[group * 10 + k] = " ".join(w[: len(w) - draw.randrange(0, 2)])
    return texts


@pytest.mark.parametrize("largest", [0, 6, 24])
def test_links_do_not_depend_on_the_boundary(spark, monkeypatch, largest):
    texts = variants(40, 5)
    monkeypatch.setattr(jaccard_join, "boundary", lambda sizes, length: largest)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    want, sets = jaccard_components(texts)
    rows = jaccard_join.classes(docs).collect()
    assert {r.doc_id: r.component_id for r in rows} == want
    assert {r.doc_id: r.n_shingles for r in rows} == {i: len(s) for i, s in sets.items()}


def test_documents_as_by_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    want, sets = jaccard_components({r.doc_id: r.text for r in docs.collect()})
    rows = jaccard_join.classes(docs).collect()
    assert {r.doc_id: (r.component_id, r.n_shingles) for r in rows} == {i: (want[i], len(sets[i])) for i in want}


def test_jaccard_of_odd_rows(spark):
    rows = jaccard_join.classes(odd(spark)).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in rows) == [
        (-1, 1, -1), (1, 2, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 2, 1), (5, 2, 1), (7, 1, 7),
    ]
    docs = odd(spark)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 3, 4, 7]
    assert jaccard_join.classes(none(spark)).count() == jaccard_join.keep_one(none(spark)).count() == 0


def prose(seed, words):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randrange(2, 9))) for _ in range(words))


def test_shared_passages_go_and_the_rest_stays(spark):
    passage = prose(1, 60)
    rows = [(k, f"{prose(10 + k, 80 + k)} {passage} {prose(50 + k, 70)}") for k in range(12)] + [(99, prose(99, 400)), (100, rows_copy := prose(7, 200)), (101, rows_copy)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    told = {r.row.doc_id: r for r in substrings.without_repeats(docs).collect()}
    assert told[0].kept == rows[0][1] and told[99].kept == rows[12][1] and told[100].kept == rows_copy and told[101].kept == ""
    for doc, text in rows[1:12]:
        assert len(told[doc].spans) == 1
        start, length = told[doc].spans[0]
        assert text[start : start + length] in passage + " " or length > 0.5 * len(passage)
        assert told[doc].kept == text[:start] + text[start + length :]
        assert abs(text.index(passage) - start) < 150 and length > 0.4 * len(passage)


def test_chunks_resist_insertions():
    text = prose(3, 2000).encode()
    one = {bytes(d) for d in substrings.chunks([text])[3]}
    two = {bytes(d) for d in substrings.chunks([text[:500] + b"new words here " + text[500:]])[3]}
    assert len(one - two) <= 3


@pytest.mark.parametrize("text", ["", "a", "日本語" * 4000, "x" * 20000, "é " * 3000, "\x00\x00 a \x00" * 900])
def test_chunks_are_the_whole_text(text):
    raw = text.encode()
    owner, start, length, digests = substrings.chunks([b"before this", raw, b"", b"after it"])
    mine = owner == 1
    assert b"".join(raw[s : s + n] for s, n in zip(start[mine], length[mine])) == raw
    assert all(raw[s : s + n].decode() is not None for s, n in zip(start[mine], length[mine]))


def test_repeats_of_odd_rows(spark):
    docs = odd(spark)
    told = substrings.without_repeats(docs).collect()
    assert len(told) == 8 and [r.kept for r in told if r.row.doc_id == 2] == [None] and [r.kept for r in told if r.row.doc_id == 3] == [""]
    assert all(r.spans == [] for r in told if r.row.doc_id in (1, 2, 3, 4))
    assert substrings.without_repeats(none(spark)).count() == 0


def brute_vectors(rows):
    ok = [(i, np.array(v, float), k) for i, v, k in rows if k is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)]
    links = [(a, b) for i, (a, x, k) in enumerate(ok) for b, y, m in ok[i + 1 :] if k == m and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98]
    count = {i: sum(i in link for link in links) for i, _, _ in rows}
    return count, components([i for i, _, _ in rows], links)


@pytest.mark.parametrize("most,block", [(1 << 14, 4096), (1 << 14, 16), (9, 16), (0, 16)])
def test_vectors_as_by_brute_force(spark, monkeypatch, most, block):
    draw = np.random.default_rng(2)
    centers = draw.normal(size=(12, 8))
    rows = [(k, (centers[k % 12] + draw.normal(size=8) * 0.12).tolist(), int(k % 3 == 0)) for k in range(300)]
    rows += [(300 + k, rows[5][1], 1) for k in range(20)] + [(400, [0.0] * 8, 1), (401, None, 1), (402, rows[0][1], None), (403, [float("nan")] * 8, 1), (404, [None] + [1.0] * 7, 0), (405, [float("inf")] * 8, 0)]
    monkeypatch.setattr(near_vectors, "MOST_PIVOTS", most)
    monkeypatch.setattr(near_vectors, "BLOCK", block)
    count, least = brute_vectors(rows)
    got = near_vectors.near_classes(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (count[i], least[i], least[i] == i) for i in count}


def test_vectors_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, label int, node string, home string"
    rows = [(1, [1.0, 0.0], 1, "x", "y"), (1, [1.0, 0.0], 1, "x", "y"), (None, [1.0, 0.001], 1, "x", "y"), (4, [0.0, 1.0], 1, None, None)]
    got = near_vectors.near_classes(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in got) == [(-1, 2, 1, False), (1, 2, 1, True), (1, 2, 1, True), (4, 0, 4, True)]
    assert near_vectors.near_classes(spark.createDataFrame([], schema)).count() == 0


def test_vectors_of_given_labels_are_cut_into_cells(spark):
    rows = table(spark, "/root/testdata/sf0.01", "embeddings").where("label is not null and embedding is not null")
    classes = rows.selectExpr("cast(label as long) as kind", "xxhash64(label, embedding) as node", "1L as times", "cast(embedding as array<double>) as vector")
    points = near_vectors.pivots(classes)
    assert len(points) > 1 and min(len(p) for p in points.values()) > 3
    copies = near_vectors.dealt(classes, 0.2).collect()
    assert sum(c.home for c in copies) == classes.count() < len(copies) < classes.count() * 5


def test_vectors_of_many_labels_and_lengths(spark):
    draw = np.random.default_rng(4)
    rows = [(3 * k + j, (v * (j + 1)).tolist(), f"label {k}") for k in range(400) for v in [draw.normal(size=4)] for j in range(3)]
    rows += [(2000, [1.0, 0.0], "two"), (2001, [2.0, 0.0, 0.0], "two"), (2002, [1.0, 0.01], "two"), (2003, [], "two")]
    got = near_vectors.near_classes(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()
    told = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    assert all(told[i] == (2, i - i % 3, i % 3 == 0) for i in range(1200))
    assert [told[2000 + k] for k in range(4)] == [(1, 2000, True), (0, 2001, True), (1, 2000, False), (0, 2003, True)]
