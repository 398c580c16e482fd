"""Join of near-equal word-shingle sets by Jaccard similarity: small sets by subsets, large ones by inverted lists.

Equal sets are one class. Two sets of n and m shingles link if they share c(n, m) = ceil(4 (n + m) / 9) of them, which
is a similarity of 0.8.

* Small sets (up to a boundary) list their subsets of every size c(n, m) that a partner may need; sets with a common
  subset of that size link, without any comparison.
* Large sets are looked up in inverted lists. Shingles that no other class has cannot be shared: a set keeps only the
  others, and falls out if these are less than 0.8 of it. The rest is ordered from rare to frequent shingles over the
  whole corpus; linked sets meet in a list among the first n - ceil(0.8 n) + 1. In a list each set first meets one
  leader, so a large group of near copies hangs together after as many comparisons as it has members; what the leaders
  leave apart is compared pair by pair, where sizes and places in the lists allow a link at all.
* The boundary is where listing subsets gets dearer than sending and scanning shingles, by the sizes and list lengths
  of a sample. It decides how links are found, never which.

Shingles travel as hashes, packed by chunk of texts and shard of hashes. The number of bytes of a hash grows with the
corpus: five at least, so that two sets of hundreds of shingles are told apart, and more so that chance meetings of
different shingles stay rare.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.components import connected
from quern.llm.frames import split_words, word_hashes
from quern.llm.packed import packed, unpacked
from quern.sources.staging import staged

CHUNK_BYTES = 8 << 20
SHARD_BYTES = 16 << 20
SAMPLE_BYTES = 20 << 20
WORDS = 5
LARGEST_BOUNDARY = 24
DRAWS = 8
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * ODD[3]
    x = (x ^ (x >> np.uint64(29))) * ODD[1]
    return x ^ (x >> np.uint64(32))


def needed(n: int, m: int) -> int:
    """Common shingles that sets of n and m need for a similarity of 0.8."""
    return -(-4 * (n + m) // 9)


def subset_sizes(n: int) -> list[int]:
    """Sizes of the subsets that a set of n lists, over all sizes a partner may have."""
    return sorted({needed(n, m) for m in range(-(-4 * n // 5), 5 * n // 4 + 1)})


def least_partner(n: int) -> int:
    return -(-4 * n // 5)


@dataclass
class Sets:
    """Shingle sets of some texts: sizes, distinct hashes set after set in ascending order, and the class of each."""

    sizes: np.ndarray
    hashes: np.ndarray
    node: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Sets:
        words, codes, counts = split_words(texts)
        word = mixed(word_hashes(words))[codes]
        n = len(word)
        run = np.zeros(n, np.uint64)
        for k in range(WORDS):
            run[: n - k] = (run[: n - k] ^ word[k:]) * ODD[k] if k else word * ODD[0]
            run[: n - k] ^= run[: n - k] >> np.uint64(31)
        run = mixed(run)
        ends = np.cumsum(counts)
        sets = []
        for end, count in zip(ends.tolist(), counts.tolist(), strict=True):
            if count >= WORDS:
                sets.append(np.unique(run[end - count : end - WORDS + 1]))
            elif count:
                short = np.uint64(count)
                for w in word[end - count : end].tolist():
                    short = mixed(np.array([(int(short) * 31 + w) % 2**64], np.uint64))[0]
                sets.append(np.array([short], np.uint64))
            else:
                sets.append(np.empty(0, np.uint64))
        sizes = np.array([len(s) for s in sets], np.int64)
        hashes = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), sizes)
        total = np.zeros(len(sets), np.uint64)
        np.add.at(total, owner, mixed(hashes * ODD[2]))
        return cls(sizes, hashes, mixed(total + sizes.astype(np.uint64) * ODD[4]))

    def only(self, index: np.ndarray) -> Sets:
        starts = np.cumsum(self.sizes) - self.sizes
        keep = [self.hashes[s : s + n] for s, n in zip(starts[index].tolist(), self.sizes[index].tolist(), strict=True)]
        return Sets(self.sizes[index], np.concatenate(keep) if keep else np.empty(0, np.uint64), self.node[index])


@dataclass
class Plan:
    """shards of hashes, bytes of a hash, the largest small set."""

    shards: int
    width: int
    boundary: int


def subsets_cost(n: int) -> int:
    return sum(math.comb(n, c) for c in subset_sizes(n))


def boundary(sizes: dict[int, int], list_length: float) -> int:
    """The size up to which listing subsets costs no more than sending n shingles and scanning the first ones' lists."""
    best, saved, most = 0, 0.0, 0.0
    for n in range(1, LARGEST_BOUNDARY + 1):
        scan = n + (n - least_partner(n) + 1) * list_length
        saved += sizes.get(n, 0) * (scan - subsets_cost(n))
        if saved >= most:
            best, most = n, saved
    return best


def planned(rows: DataFrame) -> Plan:
    total = rows.agg(F.sum(F.octet_length("text")).alias("bytes")).first().bytes or 0
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = Sets.of(batch.column("text"))
            small = np.bincount(np.minimum(sets.sizes, LARGEST_BOUNDARY + 1), minlength=LARGEST_BOUNDARY + 2)
            distinct = len(np.unique(sets.hashes))
            key = [*range(len(small)), -1, -2]
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array([*small.tolist(), len(sets.hashes), distinct])], names=["size", "n"])

    part = min(1.0, SAMPLE_BYTES / max(total, 1))
    found = dict(rows.where(draw < part).select("text").mapInArrow(sizes, "size long, n long").groupBy("size").agg(F.sum("n")).collect())
    width = min(8, max(5, math.ceil((math.log2(max(total, 1)) + 9) / 8)))
    return Plan(max(1, math.ceil(total / SHARD_BYTES)), width, boundary(found, found.get(-1, 0) / max(1, found.get(-2, 1))))


# -- chunks, shards and buckets ----------------------------------------------------------------------------------------

ROUTED = "place long, payload binary"
FOUND = "kind string, node long, n int, id long, c int, key long, before int, shared array<long>"


def chunk_messages(ids: pa.Array, sets: Sets, plan: Plan, name: int) -> Iterator[tuple[int, bytes]]:
    """Rows (place, payload): places from 0 on are shards of hashes, others only pass documents and subsets on."""
    valid = pc.is_valid(ids).to_numpy(zero_copy_only=False)
    number = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    distinct = sets.only(np.unique(sets.node, return_index=True)[1])
    starts = np.cumsum(distinct.sizes) - distinct.sizes
    subset_rows: list[tuple[int, int, int, int]] = []
    for i in np.flatnonzero((distinct.sizes > 0) & (distinct.sizes <= plan.boundary)):
        own = mixed(distinct.hashes[starts[i] : starts[i] + distinct.sizes[i]]).tolist()
        for c in subset_sizes(len(own)):
            subset_rows += [(i, c, sum(chosen) % 2**64, len(own)) for chosen in combinations(own, c)]
    small = np.array([r[0] for r in subset_rows], np.int64)
    yield -1 - name, packed([
        number, valid.astype(np.uint8), sets.sizes.astype(np.uint32), sets.node,
        distinct.node[small], np.array([r[3] for r in subset_rows], np.uint32), np.array([r[1] for r in subset_rows], np.uint32),
        np.array([r[2] for r in subset_rows], np.uint64),
    ])
    listed = distinct.only(np.flatnonzero(distinct.sizes >= max(1, least_partner(plan.boundary + 1))))
    owner = np.repeat(np.arange(len(listed.sizes)), listed.sizes)
    shard = ((listed.hashes >> np.uint64(32)) * np.uint64(plan.shards)) >> np.uint64(32)
    order = np.argsort(shard.astype(np.uint32), kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(shard.astype(np.int64), minlength=plan.shards))])
    hashes, owner = (listed.hashes >> np.uint64(64 - 8 * plan.width))[order], owner[order]
    for s in range(plan.shards):
        a, b = ends[s], ends[s + 1]
        if a < b:
            counts = np.bincount(owner[a:b], minlength=len(listed.sizes))
            has = np.flatnonzero(counts)
            yield s, packed([listed.node[has], listed.sizes[has].astype(np.uint32), counts[has].astype(np.uint32), hashes[a:b]])


def bucket_of(node: np.ndarray, plan: Plan) -> np.ndarray:
    return (((node >> np.uint64(32)) * np.uint64(plan.shards)) >> np.uint64(32)).astype(np.int64)


def by_hash(hashes: np.ndarray, owner: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (hash, owner) pairs in that order; sorted as one number where both fit into one."""
    if not len(hashes):
        return hashes, owner
    least, bits = hashes.min(), np.uint64(max(1, owners.bit_length()))
    if int(hashes.max() - least).bit_length() + int(bits) <= 64:
        both = ((hashes - least) << bits) | owner
        both.sort()
        new = np.ones(len(both), bool)
        new[1:] = both[1:] != both[:-1]
        both = both[new]
        return (both >> bits) + least, (both & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.uint32)
    order = np.lexsort((owner, hashes))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]


def shared_only(payloads: list[bytes], plan: Plan) -> Iterator[tuple[int, bytes]]:
    """Of one shard's lists, those with two classes or more, with their lengths: to the buckets of the classes."""
    parts = [unpacked(p) for p in payloads]
    node, size, count, hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts
    nodes, first, place = np.unique(node, return_index=True, return_inverse=True)
    size = size[first]
    owner = np.repeat(place.astype(np.uint32), count)
    hashes, owner = by_hash(hashes, owner, len(nodes))
    head = np.ones(len(hashes), bool)
    head[1:] = hashes[1:] != hashes[:-1]
    ends = np.append(np.flatnonzero(head)[1:], len(hashes))
    length = np.diff(ends, prepend=0)
    keep = np.repeat(length > 1, length)
    owner, hashes = owner[keep], hashes[keep]
    length = length[length > 1]
    rarity = np.repeat(np.minimum(255, np.floor(8 * np.log2(length))).astype(np.uint8), length)
    order = np.argsort(owner, kind="stable")
    owner, hashes, rarity = owner[order], hashes[order], rarity[order]
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(nodes)))])
    bucket = bucket_of(nodes, plan)
    for b in range(plan.shards):
        i, j = np.searchsorted(bucket, [b, b + 1])
        counts = np.diff(ends[i : j + 1])
        has = np.flatnonzero(counts)
        if len(has):
            x, y = ends[i], ends[j]
            yield b, packed([nodes[i:j][has], size[i:j][has], counts[has].astype(np.uint32), hashes[x:y], rarity[x:y]])


def candidates(payloads: list[bytes]) -> pa.Table:
    """Of one bucket, the classes that share 0.8 of their shingles: these in global order, and how many come before."""
    parts = [unpacked(p) for p in payloads]
    node, size, count, hashes, rarity = (np.concatenate(x) for x in zip(*parts, strict=True))
    nodes, first, place = np.unique(node, return_index=True, return_inverse=True)
    size = size[first].astype(np.int64)
    owner = np.repeat(place, count)
    order = np.lexsort((hashes, rarity, owner))
    owner, hashes = owner[order], hashes[order]
    shared = np.bincount(owner, minlength=len(nodes))
    ends = np.cumsum(shared)
    keep = np.flatnonzero(5 * shared >= 4 * size)
    lists = [hashes[ends[k] - shared[k] : ends[k]].view(np.int64) for k in keep]
    return found("set", len(keep), node=nodes[keep].view(np.int64), n=size[keep].astype(np.int32), before=(size - shared)[keep].astype(np.int32), shared=pa.array(lists, pa.list_(pa.int64())))


def found(kind: str, rows: int, **columns) -> pa.Table:
    fields = {"node": pa.int64(), "n": pa.int32(), "id": pa.int64(), "c": pa.int32(), "key": pa.int64(), "before": pa.int32(), "shared": pa.list_(pa.int64())}
    arrays = [pa.array([kind] * rows, pa.string())]
    for name, kind_ in fields.items():
        value = columns.get(name)
        arrays.append(pa.nulls(rows, kind_) if value is None else value if isinstance(value, pa.Array) else pa.array(value, kind_))
    return pa.Table.from_arrays(arrays, names=["kind", *fields])


def passed_on(payload: bytes) -> pa.Table:
    """The documents and subsets of one chunk, as rows."""
    number, valid, size, node, small, small_n, c, key = unpacked(payload)
    ids = pa.array(number.view(np.int64), mask=valid == 0)
    docs = found("doc", len(node), node=node.view(np.int64), n=size.astype(np.int32), id=ids)
    subsets = found("subset", len(small), node=small.view(np.int64), n=small_n.astype(np.int32), c=c.astype(np.int32), key=key.view(np.int64))
    return pa.concat_tables([docs, subsets])


def gathered(rows: DataFrame, plan: Plan) -> DataFrame:
    """FOUND rows: every document (doc), subsets of small sets (subset), large sets that may link (set)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0

        def emit(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held).combine_chunks()
            for place, payload in chunk_messages(whole["id"].chunk(0).cast(pa.int64()), Sets.of(whole["text"].chunk(0)), plan, (task << 24) | number):
                yield pa.RecordBatch.from_arrays([pa.array([place]), pa.array([payload], pa.binary())], names=["place", "payload"])

        held, size = [], 0
        for batch in batches:
            start = 0
            for row, n in enumerate(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)):
                size += int(n) + 8
                if size >= CHUNK_BYTES:
                    yield from emit([*held, batch.slice(start, row + 1 - start)])
                    held, size, start, number = [], 0, row + 1, number + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield from emit(held)

    def at_shard(group: pa.Table) -> pa.Table:
        payloads, place = [p.as_py() for p in group["payload"]], group["place"][0].as_py()
        out = list(shared_only(payloads, plan)) if place >= 0 else [(place, p) for p in payloads]
        return pa.table({"place": pa.array([p for p, _ in out], pa.int64()), "payload": pa.array([b for _, b in out], pa.binary())})

    def at_bucket(group: pa.Table) -> pa.Table:
        payloads, place = [p.as_py() for p in group["payload"]], group["place"][0].as_py()
        return candidates(payloads) if place >= 0 else pa.concat_tables([passed_on(p) for p in payloads])

    sent = rows.mapInArrow(cut, ROUTED).groupBy("place").applyInArrow(at_shard, ROUTED)
    return staged(sent.groupBy("place").applyInArrow(at_bucket, FOUND), "jaccard-sets")


# -- links -------------------------------------------------------------------------------------------------------------


def subset_links(subsets: DataFrame) -> DataFrame:
    """a, b: in every group of small sets with a common subset, each set linked with the group's smallest one.

    A set that links with any other of the group links with the smallest, so no connection is lost.
    """
    least = subsets.groupBy("c", "key").agg(F.min(F.struct("n", "node")).alias("least"))
    met = subsets.join(least, ["c", "key"]).where("node <> least.node and 9 * c >= 4 * (n + least.n)")
    return met.select(F.col("node").alias("a"), F.col("least.node").alias("b")).distinct()


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs a, b whose sets have a similarity of 0.8 or more, counted exactly."""
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("shared").alias("s_a"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("shared").alias("s_b"))
    common = F.size(F.array_intersect("s_a", "s_b"))
    return pairs.join(one, "a").join(two, "b").where(9 * common >= 4 * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def list_entries(sets: DataFrame) -> DataFrame:
    """node, n, key, own, rest of the first shingles of each set that another set has among its first ones.

    ``own`` is the percentage of the set's shingles that no other set has. ``rest`` counts the set's shingles from this one on: no more than that can be shared if it is the first shared one.
    """
    first = F.expr("slice(shared, 1, n - cast(ceil(n * 4 / 5.0) as int) + 1 - before)")
    entries = sets.select("node", "n", "before", F.posexplode(first).alias("at", "key"))
    own = F.floor(F.col("before") * 100 / F.col("n")).cast("int").alias("own")
    entries = entries.select("node", "n", "key", own, (F.col("n") - F.col("before") - F.col("at")).alias("rest"))
    several = entries.groupBy("key").agg(F.count("*").alias("n_list")).where("n_list > 1").select("key")
    return staged(entries.join(several, "key"), "jaccard-lists")


def star_links(entries: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: each set linked, if it is one, with the leader that most of its lists name.

    A list's leader is the set with the least of its own: the one nearest to what the list's sets are copies of.
    """
    drawn = F.struct("own", F.xxhash64("node").alias("draw"), F.col("node").alias("leader"), F.col("n").alias("leader_n"))
    leader = entries.groupBy("key").agg(F.min(drawn).alias("l"))
    met = entries.join(leader, "key").where((F.col("node") != F.col("l.leader")) & (5 * F.least("n", "l.leader_n") >= 4 * F.greatest("n", "l.leader_n")))
    votes = met.groupBy("node", F.col("l.leader").alias("leader")).agg(F.count("*").alias("votes"))
    pairs = votes.groupBy("node").agg(F.max(F.struct("votes", "leader")).alias("best"))
    return staged(verified(pairs.select(F.col("node").alias("a"), F.col("best.leader").alias("b")), sets), "jaccard-links")


def drawn_links(entries: DataFrame, sets: DataFrame, roots: DataFrame, turn: int) -> DataFrame:
    """a, b: links of sets with DRAWS sets of each of their lists, drawn by hashes among those with little of their own.

    Only the sets of the smaller root ask, so a large group that hangs together already asks for nothing.
    """
    sizes = roots.groupBy("root").agg(F.count("*").alias("size"))
    here = with_roots(entries, roots).join(sizes, "root", "left").withColumn("size", F.coalesce("size", F.lit(1)))

    def draw(k: int) -> Column:
        order = [F.floor(F.col("own") / 10).alias("near"), F.xxhash64("node", F.lit(turn), F.lit(k)).alias("draw")]
        return F.min(F.struct(*order, "node", "n", "rest", "root", "size"))

    leader = here.groupBy("key").agg(F.array(*[draw(k) for k in range(DRAWS)]).alias("l"))
    met = here.join(leader, "key").withColumn("l", F.explode(F.array_distinct(F.transform("l", lambda x: x.dropFields("near", "draw")))))
    asks = "l.root <> root and (l.size > size or l.size = size and l.root < root) and 9 * least(rest, l.rest) >= 4 * (n + l.n)"
    pairs = met.where(asks).select(F.col("node").alias("a"), F.col("l.node").alias("b")).distinct()
    return staged(verified(pairs, sets), "jaccard-links")


def leaders(links: DataFrame) -> DataFrame:
    """node, root: two steps along the links, each of which leads to a set drawn earlier. Not yet a component."""
    one = links.select(F.col("a").alias("node"), F.col("b").alias("step"))
    two = links.select(F.col("a").alias("step"), F.col("b").alias("root"))
    return one.join(two, "step", "left").select("node", F.coalesce("root", "step").alias("root"))


def pair_links(entries: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """a, b: all links between sets with different roots."""
    here = with_roots(entries, roots)
    apart = here.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key")
    here = here.join(apart, "key")
    other = here.select("key", *[F.col(c).alias(f"{c}_b") for c in ("node", "n", "rest", "root")])
    may = "node < node_b and root <> root_b and 9 * least(rest, rest_b) >= 4 * (n + n_b)"
    pairs = here.join(other, "key").where(may).select(F.col("node").alias("a"), F.col("node_b").alias("b")).distinct()
    return staged(verified(pairs, sets), "jaccard-links")


def linked_roots(subsets: DataFrame, sets: DataFrame) -> DataFrame:
    """node, root of all classes that link with another."""
    entries = list_entries(sets)
    first = star_links(entries, sets)
    links = staged(subset_links(subsets).union(first).union(drawn_links(entries, sets, leaders(first), 0)), "jaccard-links")
    roots = connected(links, "a", "b")
    rest = pair_links(entries, sets, roots)
    return roots if rest.isEmpty() else connected(links.union(rest), "a", "b")


def with_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, node and component_id of every document.

    Words are what stands between ASCII blanks, A-Z in lower case; a set holds the distinct runs of five words, of
    fewer words the whole sequence. ``node`` is the class of equal sets, ``component_id`` the least id that links reach,
    the document's own included (null ids are passed over; null if there is no other).

    A null text, an empty one or one without words has an empty set, links with nothing and is its own component.
    Repeated rows are equal sets. Texts are used whole; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    plan = planned(rows)
    parts = gathered(rows, plan)
    sets = parts.where("kind = 'set'").select("node", "n", "before", "shared")
    roots = linked_roots(parts.where("kind = 'subset'").select("node", "n", "c", "key"), sets)
    own = with_roots(parts.where("kind = 'doc'").select("id", F.col("n").cast("long").alias("n_shingles"), "node"), roots)
    least = own.where("n_shingles > 0").groupBy("root").agg(F.min("id").alias("least"))
    told = own.withColumn("root", F.when(F.col("n_shingles") > 0, F.col("root"))).join(least, "root", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("id"))
    return told.select(F.col("id").alias(id_col), "n_shingles", "node", component.alias("component_id"))


def keep_one(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with one row of every component, the first in the table; rows without words all stay.

    Rows are known by their place in the table, so repeated ids do no harm. Columns as they are, whatever their names.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("place"))
    told = classes(whole, "place", "text").where("place <> component_id").select("place")
    # One plan at every size: the table of copies grows with the corpus, so it is never broadcast.
    return whole.join(told.hint("merge"), "place", "left_anti").select("row.*")
