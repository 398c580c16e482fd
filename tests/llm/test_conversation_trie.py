"""The trie of conversations against a dictionary of all prefixes."""

import random
from collections import defaultdict
from hashlib import md5, sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from quern.llm import conversation_trie
from quern.llm.zfast import ZFastTrie, two_fattest
from tests.llm.helpers import words

SCHEMA = "conv_id long, turn long, role string, text string"


def by_prefixes(rows, twenty=20, four=4):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", md5((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in turns.items()}
    full = {}
    for c, mine in own.items():
        h = crc32(str(c).encode()) % four
        source = c - (c % twenty if c >= 0 else -(-c % twenty))
        full[c] = own.get(source, [])[:h] + mine[h:]
    members = defaultdict(list)
    for c, v in full.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(words(p[-1][1])) if p else 0
    ends = {p: ",".join(str(c) for c in sorted(m) if len(full[c]) == len(p)) for p, m in members.items()}
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), kids.get(p, 0), leaves[p], saved[p], sha256(ends[p].encode()).hexdigest())
        for p, m in members.items()
    )


def told(spark, rows, parts=3):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    for name in ("conv", "key", "n", "a", "depth", "position", "segment"):
        frame = frame.withColumn(name, F.lit("x"))
    heads = F.crc32(F.col("conv").cast("string").cast("binary")) % 4
    found = conversation_trie.prefix_trie(frame, F.expr("conv - conv % 20"), heads).collect()
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in found)


def made(seed, count, texts=3, most=9):
    draw = random.Random(seed)
    return [(c * 3, t, draw.choice(["user", "assistant"]), "w " * draw.randrange(texts)) for c in range(count) for t in range(draw.randrange(1, most))]


@pytest.mark.parametrize("seed, count, texts", [(1, 120, 2), (2, 60, 4)])
def test_as_by_prefixes(spark, seed, count, texts):
    rows = made(seed, count, texts)
    assert told(spark, rows) == by_prefixes(rows)


def test_paths_below_paths_and_segments(spark, monkeypatch):
    # Conversation k + 1 leaves conversation k at depth k: paths hang one below the other.
    rows = [(k, t, "user", "same words" if t < k else f"own {k}") for k in range(1, 14) for t in range(max(k + 1, 30 if k == 5 else 0))]
    monkeypatch.setattr(conversation_trie, "SEGMENT", 4)
    monkeypatch.setattr(conversation_trie, "CHUNK_TURNS", 20)
    monkeypatch.setattr(conversation_trie, "END_BYTES", 60)
    copies = [(c, t, "user", "copy") for c in range(100, 160) for t in range(8)]
    assert told(spark, rows + copies) == by_prefixes(rows + copies)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "x"), (1, None, None, None), (1, 2, "user", ""), (1, 2, "user", ""), (1, 2, "assistant", "b"), (-3, -5000, "user", "a b"), (-3, -1, "user", "c"), (-3, 9000, "user", "c")]
    rows += [(20, 0, "user", "w " * 50000), (21, 0, None, "x"), (22, 0, "user", "a\x0bb\x1cc"), (45, 1, "user", "y"), (46, 1, "user", "y"), (2, 7, "user", None)]
    assert told(spark, rows) == by_prefixes(rows)
    assert told(spark, []) == []
    assert told(spark, [(None, 1, "user", "x")]) == []
    # No conversation 20 to begin with: what is left has no turns at all.
    bare = next(c for c in range(21, 40) if crc32(str(c).encode()) % 4 == 3)
    assert told(spark, [(bare, 0, "user", "x")]) == by_prefixes([(bare, 0, "user", "x")]) == [(bare, 0, -1, 1, 0, 1, 0, sha256(str(bare).encode()).hexdigest())]


def test_two_fattest():
    for low in range(70):
        for high in range(low + 1, 70):
            assert two_fattest(low, high) == max(range(low + 1, high + 1), key=lambda x: x & -x)


@pytest.mark.parametrize("seed", range(6))
def test_zfast_trie_of_random_strings(seed):
    draw = random.Random(seed)
    strings = [tuple(draw.choice("ab") for _ in range(draw.randrange(0, 12))) for _ in range(200)]
    hashes = [[hash((d, s[:d])) for d in range(len(s) + 1)] for s in strings]
    trie = ZFastTrie()
    for k in range(0, 200, 30):
        trie.insert(hashes[k : k + 30])
    prefixes = {s[:d] for s in strings for d in range(len(s) + 1)}
    nodes = [p for p in prefixes if not p or p in strings or sum((*p, c) in prefixes for c in "ab") > 1]
    assert len(trie.low) == len(nodes) and sum(d - low for d, low in zip(trie.deep, trie.low)) == len(prefixes)
    for s, h, node in zip(strings, hashes, trie.ends):
        assert trie.deep[node] == len(s) and (not s or trie.strings[trie.string[node]][len(s)] == h[-1]) and trie.locate(h) == node
    for node in range(1, len(trie.low)):
        assert trie.deep[trie.up[node]] == trie.low[node]
        assert trie.handles[trie.strings[trie.string[node]][two_fattest(trie.low[node], trie.deep[node])]] == node
