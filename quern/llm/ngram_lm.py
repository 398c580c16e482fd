"""Trigram language model in Elias-Fano tries, trained on a part of the documents and applied to all of them.

The trie has three levels: words, words after a word, words after two words. Each level is a monotone sequence in
Elias-Fano form: a child is its parent's place followed by 32 bits of the child's hash, so a search for a
successor runs among the children of one context only; a second monotone sequence points to where a context's children
begin. Nodes carry one byte for their probability in the context and one for the size class of their own count, in
steps of an eighth of a binary digit. The arrays of a trie lie in a memory-mapped file.

The data never meet in one place. Texts are handled in chunks of some megabytes; a chunk sends its distinct trigram
paths with their training counts to the shards of their first words, once each however often they occur. A shard builds
the trie of its words and answers the same paths; the chunk's answers come back in the order of its questions. Words so
frequent that they would overfill a shard are split into parts by the hash of the next word.

Smoothing: P(w | context) = (1 - b) c(context w) / c(context) + b P(w | shorter context), down to (c(w) + 1) / (N + V + 1).
b depends on the context's count class and level: the share of events that are new to their context when one occurrence
is left out. All counts come from all training texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from quern.llm.elias_fano import MonotoneSequence, mapped
from quern.llm.frames import split_words, word_hashes
from quern.llm.packed import packed, unpacked
from quern.sources.staging import staged

CHUNK_BYTES = 8 << 20
SHARD_BYTES = 12 << 20
SAMPLE_BYTES = 40 << 20
SAMPLE_PART = 1e-4
# Hashes of the marks around a text: the largest ones, so that they come last in any order by hash.
START, END = np.uint64(2**64 - 2), np.uint64(2**64 - 1)
CLASSES = 64
STEPS = 8
HALF = np.uint64(32)


# -- where paths go ----------------------------------------------------------------------------------------------------


@dataclass
class Plan:
    """Number of shards, and the frequent words with their numbers of parts (words: ascending hashes)."""

    shards: int
    words: np.ndarray
    parts: np.ndarray

    def entry_keys(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Key of the trie entry of each pair of word hashes: the first word, or its part."""
        at = np.minimum(np.searchsorted(self.words, first), max(len(self.words) - 1, 0))
        split = np.flatnonzero(self.words[at] == first) if len(self.words) else np.empty(0, np.int64)
        keys = first.copy()
        keys[split] = part_key(first[split], second[split] % self.parts[at[split]])
        return keys

    def split_entries(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of all parts, ascending, and the index of each one's word."""
        owner = np.repeat(np.arange(len(self.words)), self.parts.astype(np.int64))
        number = np.arange(len(owner)) - np.repeat(np.cumsum(self.parts.astype(np.int64)) - self.parts.astype(np.int64), self.parts.astype(np.int64))
        keys = part_key(self.words[owner], number.astype(np.uint64))
        order = np.argsort(keys)
        return keys[order], owner[order]

    def shard(self, keys: np.ndarray) -> np.ndarray:
        return (((keys >> HALF) * np.uint64(self.shards)) >> HALF).astype(np.int64)


def part_key(word: np.ndarray, part: np.ndarray) -> np.ndarray:
    mixed = (word + (part + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


def planned(rows: DataFrame) -> Plan:
    """Shards by the size of all texts; frequent words from a sample, which only decides where work is done."""
    total = rows.agg(F.sum(F.octet_length("text")).alias("bytes")).first().bytes or 0
    shards = max(1, math.ceil(total / SHARD_BYTES))
    part = min(1.0, max(SAMPLE_BYTES / max(total, 1), SAMPLE_PART))
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, codes, counts = split_words(batch.column("text"))
            hashes = np.append(word_hashes(words), START)
            times = np.append(np.bincount(codes, minlength=len(words)), len(counts))
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(times)], names=["word", "n"])

    counts = staged(rows.where(draw < part).select("text").mapInArrow(tally, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    sampled = counts.agg(F.sum("n").alias("n")).first().n or 1
    heavy = counts.where(F.col("n") * 2 * shards >= sampled).toArrow() if shards > 1 else counts.limit(0).toArrow()
    words = heavy["word"].to_numpy().view(np.uint64)
    order = np.argsort(words)
    share = heavy["n"].to_numpy()[order] / sampled
    parts = np.exp2(np.ceil(np.log2(np.maximum(2, share * 4 * shards)))).astype(np.uint64)
    return Plan(shards, words[order], parts)


# -- a chunk of texts --------------------------------------------------------------------------------------------------


@dataclass
class Chunk:
    """Texts as word numbers (in the order of hashes), the number of words of each, the hashes, which ones train."""

    codes: np.ndarray
    counts: np.ndarray
    hashes: np.ndarray
    train: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array, train: np.ndarray) -> Chunk:
        words, codes, counts = split_words(texts)
        hashes = word_hashes(words)
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        return cls(rank[codes], counts, hashes[order], train)

    def to_bytes(self) -> bytes:
        return packed([self.codes.astype(np.uint32), self.counts.astype(np.uint32), self.hashes, self.train.astype(np.uint8)])

    @classmethod
    def from_bytes(cls, data: bytes) -> Chunk:
        codes, counts, hashes, train = unpacked(data)
        return cls(codes, counts.astype(np.int64), hashes, train.astype(bool))

    def sequence(self) -> tuple[np.ndarray, np.ndarray]:
        """All texts with marks before and after, and where each begins."""
        sizes = self.counts + 2
        starts = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), np.uint64)
        inner = np.ones(len(out), bool)
        inner[starts] = inner[starts + sizes - 1] = False
        out[inner] = self.codes
        out[starts], out[starts + sizes - 1] = len(self.hashes), len(self.hashes) + 1
        return out, starts


class Paths:
    """Distinct paths of a chunk, level by level, in ascending order of their keys."""

    def __init__(self, chunk: Chunk, plan: Plan):
        self.hash_of = np.concatenate([chunk.hashes, [START, END]])
        self.sequence, self.starts = chunk.sequence()
        x, end = self.sequence, len(chunk.hashes) + 1
        self.at = np.flatnonzero(x[:-1] != end)
        distinct, place = np.unique((x[self.at] << HALF) | x[self.at + 1], return_inverse=True)
        first, second = (distinct >> HALF).astype(np.int64), (distinct & np.uint64(2**32 - 1)).astype(np.int64)
        keys = plan.entry_keys(self.hash_of[first], self.hash_of[second])
        order = np.argsort(keys, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        self.pair = rank[place]
        keys, self.first = keys[order], first[order]
        self.pair_key = (self.hash_of[second[order]] >> HALF).astype(np.uint32)
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        self.entry = np.cumsum(new) - 1
        self.entry_key, self.entry_word = keys[new], self.first[new]
        self.longer = np.flatnonzero(x[self.at + 1] != end)
        path = (self.pair[self.longer].astype(np.uint64) << HALF) | x[self.at[self.longer] + 2]
        distinct, triple = np.unique(path, return_inverse=True)
        self.triple = triple.astype(np.int32)
        self.triple_pair = (distinct >> HALF).astype(np.int64)
        self.triple_key = (self.hash_of[(distinct & np.uint64(2**32 - 1)).astype(np.int64)] >> HALF).astype(np.uint32)
        self.shard = plan.shard(self.entry_key)

    def messages(self, train: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(shard, paths that go there with their training counts)."""
        weight = np.repeat(train, sizes + 2)[self.at].astype(np.float64)
        pair_count = np.bincount(self.pair, weight, len(self.pair_key)).astype(np.uint32)
        triple_count = np.bincount(self.triple, weight[self.longer], len(self.triple_key)).astype(np.uint32)
        entry_children = np.bincount(self.entry, minlength=len(self.entry_key)).astype(np.uint32)
        pair_children = np.bincount(self.triple_pair, minlength=len(self.pair_key)).astype(np.uint32)
        pair_ends = np.concatenate([[0], np.cumsum(entry_children, dtype=np.int64)])
        triple_ends = np.concatenate([[0], np.cumsum(pair_children, dtype=np.int64)])
        shards = np.unique(self.shard)
        for shard, a, b in zip(shards, np.searchsorted(self.shard, shards), np.searchsorted(self.shard, shards, "right"), strict=True):
            c, d = pair_ends[a], pair_ends[b]
            e, f = triple_ends[c], triple_ends[d]
            yield int(shard), packed([
                self.entry_key[a:b], entry_children[a:b], self.pair_key[c:d], pair_children[c:d], pair_count[c:d],
                self.triple_key[e:f], triple_count[e:f],
            ])


# -- a shard of the trie -----------------------------------------------------------------------------------------------


def quantised(chance: np.ndarray) -> np.ndarray:
    """One byte for a probability above 0: 1 + steps of an eighth of a binary digit below 1."""
    return np.minimum(255, 1 + np.rint(-np.log2(chance) * STEPS)).astype(np.uint8)


DECODED = np.concatenate([[0.0], np.exp2(-np.arange(255) / STEPS)])


def size_class(count: np.ndarray) -> np.ndarray:
    """Binary digits of a count: 0 for 0."""
    return np.where(count > 0, np.floor(np.log2(np.maximum(count, 1))) + 1, 0).astype(np.uint8)


class Trie:
    """Levels of one shard."""

    def __init__(self, messages: list[list[np.ndarray]]):
        entry_key, entry_children, pair_key, pair_children, pair_count, triple_key, triple_count = (np.concatenate(x) for x in zip(*messages, strict=True))
        messages.clear()
        pair_entry = np.repeat(np.arange(len(entry_key)), entry_children)
        seen = np.flatnonzero(pair_count)
        keys, entry = np.unique(entry_key[pair_entry[seen]], return_inverse=True)
        pairs, pair = np.unique((entry.astype(np.uint64) << HALF) | pair_key[seen], return_inverse=True)
        place = np.full(len(pair_key), -1, np.int64)
        place[seen] = pair
        triple_pair = place[np.repeat(np.arange(len(pair_key)), pair_children)]
        seen3 = np.flatnonzero(triple_count)
        del pair_entry, entry_key, entry_children
        triples, triple = np.unique((triple_pair[seen3].astype(np.uint64) << HALF) | triple_key[seen3], return_inverse=True)
        pair_owner, triple_owner = (pairs >> HALF).astype(np.int64), (triples >> HALF).astype(np.int64)
        c2 = np.bincount(pair, pair_count[seen], len(pairs))
        c3 = np.bincount(triple, triple_count[seen3], len(triples))
        c1 = np.bincount(pair_owner, c2, len(keys))
        children2 = np.bincount(triple_owner, minlength=len(pairs))
        starts1 = np.concatenate([[0], np.cumsum(np.bincount(pair_owner, minlength=len(keys)))])
        starts2 = np.concatenate([[0], np.cumsum(children2)])
        levels = mapped({
            "words": MonotoneSequence.of(keys, 2**64).arrays,
            "pairs": MonotoneSequence.of(pairs, max(1, len(keys)) << 32).arrays,
            "triples": MonotoneSequence.of(triples, max(1, len(pairs)) << 32).arrays,
            "to_pairs": MonotoneSequence.of(starts1, len(pairs) + 1).arrays,
            "to_triples": MonotoneSequence.of(starts2, len(triples) + 1).arrays,
            "codes": {
                "count": c1.astype(np.int64), "pair": quantised(c2 / c1[pair_owner]), "pair_class": size_class(c2),
                "triple": quantised(c3 / c2[triple_owner]),
            },
        })
        self.codes = levels.pop("codes")
        self.words, self.pairs, self.triples, to_pairs, to_triples = (MonotoneSequence(a) for a in levels.values())
        self.to_pairs, self.to_triples = to_pairs.all().astype(np.int64), to_triples.all().astype(np.int64)
        # What leaving one occurrence out says about each context: its key, count and number of children met once.
        self.contexts1 = (keys, c1.astype(np.int64), np.bincount(pair_owner, c2 == 1, len(keys)).astype(np.int64))
        inner = children2 > 0
        self.contexts2 = (c2[inner].astype(np.int64), np.bincount(triple_owner, c3 == 1, len(pairs))[inner].astype(np.int64))

    def below(self, level: MonotoneSequence, pointers: np.ndarray, parent: np.ndarray, key: np.ndarray, bits: np.uint64) -> np.ndarray:
        """Places of children under their parents' places, -1 where parent or child is absent."""
        out = np.full(len(key), -1, np.int64)
        known = np.flatnonzero(parent >= 0)
        up = parent[known]
        out[known] = level.find((up.astype(np.uint64) << bits) | key[known], pointers[up], pointers[up + 1])
        return out

    def answer(self, message: list[np.ndarray]) -> bytes:
        """Count of each entry, code and size class of each pair, code of each triple; 0 where not in training."""
        entry_key, entry_children, pair_key, pair_children, _, triple_key, _ = message
        entry = self.words.find(entry_key)
        pair = self.below(self.pairs, self.to_pairs, np.repeat(entry, entry_children), pair_key, HALF)
        triple = self.below(self.triples, self.to_triples, np.repeat(pair, pair_children), triple_key, HALF)

        def of(codes: np.ndarray, place: np.ndarray) -> np.ndarray:
            return np.where(place >= 0, codes[place], 0).astype(codes.dtype) if len(codes) else np.zeros(len(place), codes.dtype)

        c = self.codes
        return packed([of(c["count"], entry).astype(np.uint64), of(c["pair"], pair), of(c["pair_class"], pair), of(c["triple"], triple)])


def left_out(level: int, count: np.ndarray, new: np.ndarray) -> list[tuple[str, int, int, int]]:
    """Events and new ones by the class that the context's count has without one of its occurrences."""
    use = count > 1
    group = size_class(count[use] - 1)
    events, novel = np.bincount(group, count[use], CLASSES), np.bincount(group, new[use], CLASSES)
    return [(f"level{level}", int(k), int(events[k]), int(novel[k])) for k in np.flatnonzero(events)]


ANSWERS = "chunk long, check long, shard int, payload binary, what string, key long, a long, b long"


def answers(messages: pa.Table, plan: Plan) -> pa.Table:
    """Of one shard: an answer for every chunk's message, and rows of statistics (chunk null)."""
    payloads = messages["payload"].to_pylist()
    trie = Trie([unpacked(p) for p in payloads])
    split_key, split_owner = plan.split_entries()
    keys, count, new = trie.contexts1
    at = np.minimum(np.searchsorted(split_key, keys), max(len(split_key) - 1, 0))
    split = split_key[at] == keys if len(split_key) else np.zeros(len(keys), bool)
    whole = ~split & (keys != START)
    stats = left_out(2, count[~split], new[~split]) + left_out(3, *trie.contexts2)
    stats += [("words", 0, int(whole.sum()), int(count[whole].sum())), ("texts", 0, int(count[~split & (keys == START)].sum()), 0)]
    stats += [("split", int(o), int(c), int(n)) for o, c, n in zip(split_owner[at[split]], count[split], new[split], strict=True)]
    told = [trie.answer(unpacked(p)) for p in payloads]
    n, m = len(told), len(stats)
    what, key, a, b = (list(x) for x in zip(*stats, strict=True))
    return pa.table({
        "chunk": pa.concat_arrays([*messages["chunk"].chunks, pa.nulls(m, pa.int64())]),
        "check": pa.concat_arrays([*messages["check"].chunks, pa.nulls(m, pa.int64())]),
        "shard": pa.concat_arrays([*messages["shard"].chunks, pa.nulls(m, pa.int32())]),
        "payload": pa.array([*told, *[None] * m], pa.binary()),
        "what": pa.array([None] * n + what, pa.string()), "key": pa.array([None] * n + key, pa.int64()),
        "a": pa.array([None] * n + a, pa.int64()), "b": pa.array([None] * n + b, pa.int64()),
    })


# -- scores ------------------------------------------------------------------------------------------------------------


@dataclass
class Totals:
    """What all shards found together: tokens, distinct tokens, training texts, the whole counts of the plan's frequent
    words, backing-off shares by level and class.
    """

    tokens: int
    distinct: int
    texts: int
    frequent: np.ndarray
    back2: np.ndarray
    back3: np.ndarray

    @classmethod
    def of(cls, rows: list, plan: Plan) -> Totals:
        by = {(r.what, r.key): (r.a, r.b) for r in rows}
        split = {k: v for (what, k), v in by.items() if what == "split" and v[0]}
        distinct, tokens = by.get(("words", 0), (0, 0))
        texts = by.get(("texts", 0), (0, 0))[0]
        frequent = np.zeros(len(plan.words))
        events, new = np.zeros((2, CLASSES)), np.zeros((2, CLASSES))
        for (what, k), (a, b) in by.items():
            if what.startswith("level"):
                events[int(what[-1]) - 2, k] += a
                new[int(what[-1]) - 2, k] += b
        for k, (count, novel) in split.items():
            frequent[k] = count
            if plan.words[k] == START:
                texts += count
            else:
                distinct, tokens = distinct + 1, tokens + count
            if count > 1:
                events[0, size_class(np.array([count - 1]))[0]] += count
                new[0, size_class(np.array([count - 1]))[0]] += novel
        back = np.clip((new + 1) / (events + 2), 1e-3, 1 - 1e-3)
        return cls(tokens + texts, distinct + (texts > 0), texts, frequent, back[0], back[1])


def scores(chunk: Chunk, plan: Plan, told: list[list[np.ndarray]], totals: Totals) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of known tokens, base score, score) of each text of a chunk; ``told``: its answers in order of shards."""
    paths = Paths(chunk, plan)
    entry_count, pair_code, pair_class, triple_code = (np.concatenate(x) for x in zip(*told, strict=True))
    entry_count = entry_count.astype(np.float64)
    count = np.bincount(paths.entry_word, entry_count, len(paths.hash_of))
    # A chunk asks only for those parts of a frequent word that hold its own next words.
    _, at, word = np.intersect1d(paths.hash_of, plan.words, assume_unique=True, return_indices=True)
    count[at] = totals.frequent[word]
    count[-1] = totals.texts
    x = paths.sequence.astype(np.int64)
    unigram = (count + 1) / (totals.tokens + totals.distinct + 1)
    context, pair = x[paths.at], paths.pair
    in_context = np.maximum(count[context], 1)
    back = np.where(count[context] > 0, totals.back2[size_class(count[context])], 1.0)
    ratio = DECODED[pair_code[pair]] * entry_count[paths.entry[pair]] / in_context
    by_pair = np.zeros(len(x))
    by_pair[paths.at + 1] = (1 - back) * ratio + back * unigram[x[paths.at + 1]]
    chance = by_pair.copy()
    group = pair_class[pair[paths.longer]]
    back = np.where(group > 0, totals.back3[group], 1.0)
    there = paths.at[paths.longer] + 2
    chance[there] = (1 - back) * DECODED[triple_code[paths.triple]] + back * by_pair[there]
    token = np.ones(len(x), bool)
    token[paths.starts] = False
    known = np.add.reduceat((count[x] > 0) & token, paths.starts, dtype=np.int64)
    base = np.add.reduceat(np.where(token, np.log10(unigram[x]), 0.0), paths.starts)
    return known, base, np.add.reduceat(np.log10(np.where(token, chance, 1.0)), paths.starts)


def chunks(rows: DataFrame, plan: Plan | None) -> DataFrame:
    """Chunks of the texts: their messages to shards under a plan, or the chunks themselves without one.

    A chunk is known by task and number, and by a check value of its ids and sizes: both uses must cut alike.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def emit(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held).combine_chunks()
            chunk = Chunk.of(whole["text"].chunk(0), whole["train"].to_numpy())
            ids = whole["id"].cast(pa.int64())
            check = xxh3_64_intdigest(ids.fill_null(0).to_numpy().tobytes() + chunk.counts.tobytes()) >> 1
            name = (task << 24) | number
            if plan is None:
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([check]), pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([chunk.to_bytes()])], names=["chunk", "check", "ids", "payload"])
                return
            for shard, message in Paths(chunk, plan).messages(chunk.train, chunk.counts):
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([check]), pa.array([shard], pa.int32()), pa.array([message])], names=["chunk", "check", "shard", "payload"])

        for batch in batches:
            rows_bytes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
            start = 0
            for row, n in enumerate(rows_bytes):
                size += int(n) + 8
                if size >= CHUNK_BYTES:
                    yield from emit([*held, batch.slice(start, row + 1 - start)])
                    held, size, start, number = [], 0, row + 1, number + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield from emit(held)

    kind = "ids array<long>" if plan is None else "shard int"
    return rows.mapInArrow(run, f"chunk long, check long, {kind}, payload binary")


def score_corpus(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score and score of every text; the model learns where ``training`` holds.

    Tokens are the words between ASCII blanks with A-Z in lower case, and one end. ``base_score`` is the sum of
    log10((c + 1) / (N + V + 1)) over tokens, ``score`` the model's log10 probability; both exact in their counts, the
    score's conditional probabilities rounded to a byte. A null text counts as empty and has the end alone. A null
    ``training`` counts as false; without training texts every token has probability 1. Null and repeated ids stay row
    by row, an empty table gives no rows, other columns are ignored. ``docs`` is read three times and must come in the
    same order each time, as tables do; otherwise the job fails.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(training, F.lit(False)).alias("train"))
    plan = planned(rows)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(plan)
    told = staged(chunks(rows, plan).groupBy("shard").applyInArrow(lambda t: answers(t, shared.value), ANSWERS), "lm-answers")
    stats = told.where("chunk is null").groupBy("what", "key").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect()
    totals = Totals.of(stats, plan)

    def scored(group: pa.Table) -> pa.Table:
        own = group.filter(pc.is_valid(group["ids"]))
        replies = group.filter(pc.is_null(group["ids"])).sort_by("shard")
        if own.num_rows != 1 or len(set(group["check"].to_pylist())) != 1:
            raise ValueError("the documents came in another order when they were read again")
        chunk = Chunk.from_bytes(own["payload"][0].as_py())
        known, base, score = scores(chunk, shared.value, [unpacked(p.as_py()) for p in replies["payload"]], totals)
        n = len(known)
        return pa.table({
            "id": pa.array(own["ids"][0].as_py(), pa.int64()), "n_tokens": pa.array(chunk.counts + 1), "n_known": pa.array(known),
            "train_tokens": pa.array(np.full(n, totals.tokens)), "base_score": pa.array(base), "score": pa.array(score),
        })

    own = chunks(rows, None).withColumn("shard", F.lit(None).cast("int"))
    replies = told.where("chunk is not null").select("chunk", "check", F.lit(None).cast("array<long>").alias("ids"), "payload", "shard")
    both = own.unionByName(replies).groupBy("chunk")
    result = both.applyInArrow(scored, "id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return result.withColumnRenamed("id", id_col)
