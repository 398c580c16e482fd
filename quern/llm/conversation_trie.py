"""The trie of all conversations: which prefixes of turns they share, and what sharing saves.

A conversation is the string of its turns; a turn's key is a hash of its number, role and text, and a prefix is known by
the exclusive or of the keys so far, 128 bits. Conversations are dealt to tasks by id. A task builds z-fast tries of its
conversations batch by batch (``zfast``), counts members in the compacted nodes and expands their edges into one row per
prefix: a prefix that a third of all conversations begin with leaves a task as one row, and rows of one prefix are
summed.

Conversations are cut every SEGMENT turns, and there is one trie for each prefix at a cut, so no row or task holds more
of a long one. What is summed over subtrees never walks the trie node by node: nodes with one least member are a path, a
path's total goes to all paths above it by pointer doubling, and inside a path totals are running sums, in slots.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.zfast import ZFastTrie
from quern.operators.prefix import positions
from quern.sources.staging import staged

SEGMENT = 4096
CHUNK_TURNS = 1 << 17
END_BYTES = 1 << 20
PARTS = "a long, b long, depth long, up_a long, up_b long, words long, n long, least long, first long, ends string"
PART_NAMES = [part.split()[0] for part in PARTS.split(", ")]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turns_of(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, position (from 1), role, digest of the text, words."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.size(F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).cast("long")
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv"), F.struct(F.col(turn_col).cast("long").alias("turn"), role.alias("role"), F.md5(text).alias("digest")).alias("key"), words.alias("words")
    ).where("conv is not null")
    numbered = positions(rows, "key", ("conv",), slot=F.expr("key.turn div 4096"))
    return numbered.select("conv", F.col("position").cast("long").alias("position"), "key.role", "key.digest", "words")


def rebuilt(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv, d, role, digest, words: ``convs`` (conv, source, heads) begin with the first turns of their source.

    A conversation's first ``heads`` turns give way to as many of ``source``'s, fewer if it has fewer.
    """
    most = convs.agg(F.max("heads")).first()[0] or 0
    heads = turns.where(F.col("position") <= most).withColumnRenamed("conv", "source")
    heads = heads.join(convs.select("source").distinct(), "source", "left_semi")
    taken = convs.join(heads, "source").where("position <= heads").select("conv", F.col("position").alias("d"), "role", "digest", "words")
    sizes = convs.join(heads.groupBy("source").agg(F.count("*").alias("has")), "source", "left")
    shift = sizes.select("conv", "heads", (F.least("heads", F.coalesce("has", F.lit(0))) - F.col("heads")).alias("shift"))
    own = turns.join(shift, "conv").where("position > heads")
    return taken.union(own.select("conv", (F.col("position") + F.col("shift")).alias("d"), "role", "digest", "words"))


def segments(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv, segment, from_a, from_b (prefix before it), last, turns (a, b, words in order); turnless ones have none."""
    keyed = turns.select("conv", "d", F.xxhash64("d", "role", "digest").alias("a"), F.xxhash64("digest", "role", "d").alias("b"), "words")
    keyed = keyed.withColumn("segment", F.expr(f"(d - 1) div {SEGMENT}"))
    rows = keyed.groupBy("conv", "segment").agg(
        F.sort_array(F.collect_list(F.struct("d", "a", "b", "words"))).alias("turns"), F.expr("bit_xor(a)").alias("a"), F.expr("bit_xor(b)").alias("b")
    )
    rows = convs.select("conv").join(rows, "conv", "left").withColumn("segment", F.coalesce("segment", F.lit(0).cast("long")))
    # One row per SEGMENT turns.
    of_conv = Window.partitionBy("conv")
    before = of_conv.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)

    def xor(name: str) -> Column:
        return F.coalesce(F.expr(f"bit_xor({name})").over(before), F.lit(0).cast("long"))

    last = F.col("segment") == F.max("segment").over(of_conv)
    return rows.select("conv", "segment", xor("a").alias("from_a"), xor("b").alias("from_b"), last.alias("last"), F.coalesce("turns", F.expr("cast(array() as array<struct<d: long, a: long, b: long, words: long>>)")).alias("turns"))


def expanded(rows: list[pa.RecordBatch], cut: int, end_bytes: int) -> Iterator[pa.RecordBatch]:
    """PARTS rows of a chunk of segments of ``cut`` turns: its prefixes, their members, and the ids that end there, ascending."""
    table = pa.Table.from_batches(rows).combine_chunks()
    conv, segment, last = (table[c].to_numpy() for c in ("conv", "segment", "last"))
    lists = table["turns"].chunk(0)
    edges = lists.offsets.to_numpy().astype(np.int64)
    a, b, words = (lists.values.field(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "words"))
    # Hashes of all prefixes of every string, the one before its first turn included.
    length = np.diff(edges)
    begin = edges[:-1] - edges[0] + np.arange(len(conv))
    at = np.arange(length.sum()) + np.repeat(np.arange(len(conv)), length) + 1
    base = [table[c].to_numpy() for c in ("from_a", "from_b")]
    prefix = []
    for start, step in zip(base, (a, b), strict=True):
        full = np.zeros(length.sum() + len(conv), np.int64)
        full[at] = step[edges[0] : edges[-1]]
        full = np.bitwise_xor.accumulate(full)
        before = full[begin] if len(full) else full  # everything up to the string's start, undone below
        prefix.append(full ^ np.repeat(before ^ start, length + 1))
    weight = np.zeros(len(prefix[0]), np.int64)
    weight[at] = words[edges[0] : edges[-1]]

    groups: dict[tuple, list[int]] = {}
    for row, key in enumerate(zip(segment.tolist(), *(x.tolist() for x in base), strict=True)):
        groups.setdefault(key, []).append(row)
    names = prefix[0].tolist()
    for (number, _, _), members in groups.items():
        trie = ZFastTrie()
        for start in range(0, len(members), 1024):
            trie.insert([names[begin[m] : begin[m] + length[m] + 1] for m in members[start : start + 1024]])
        members_ = np.array(members)
        ends = np.array(trie.ends)
        count = np.bincount(ends, minlength=len(trie.low))
        least = np.full(len(trie.low), np.iinfo(np.int64).max)
        np.minimum.at(least, ends, conv[members_])
        order = trie.order()
        up = np.array(trie.up)
        for node in order[:0:-1].tolist():
            count[up[node]] += count[node]
            least[up[node]] = min(least[up[node]], least[node])
        low, deep, string = np.array(trie.low), np.array(trie.deep), np.array(trie.string)
        string[0] = 0
        # Edges expanded; the prefix at a cut belongs to the trie above, the root to the first one.
        nodes = order if number == 0 else order[1:]
        size = deep[nodes] - low[nodes]
        owner = np.repeat(nodes, size)
        depth = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + low[owner] + 1
        place = begin[members_[string[owner]]] + depth
        above = np.maximum(place - 1, 0)
        none = np.zeros(len(owner), np.int64)
        columns = [prefix[0][place], prefix[1][place], depth + number * cut, prefix[0][above], prefix[1][above], weight[place], count[owner], least[owner], none]
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.nulls(len(owner), pa.string())], names=PART_NAMES)
        yield from _ended(conv[members_], ends, last[members_], begin[members_] + length[members_], prefix, end_bytes)


def _ended(conv: np.ndarray, ends: np.ndarray, last: np.ndarray, place: np.ndarray, prefix: list[np.ndarray], end_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows with the ids that end at each prefix, in pieces of about ``end_bytes``; they count no members."""
    conv, ends, place = conv[last], ends[last], place[last]
    order = np.lexsort((conv, ends))
    conv, ends, place = conv[order], ends[order], place[order]
    edges = np.append(np.flatnonzero(np.append(True, ends[1:] != ends[:-1])), len(ends)) if len(ends) else [0]
    out: list[tuple] = []
    step = max(1, end_bytes // 20)
    for start, end in zip(edges[:-1], edges[1:]):
        for low in range(start, end, step):
            ids = conv[low : min(end, low + step)].tolist()
            out.append((prefix[0][place[low]], prefix[1][place[low]], ids[0], ",".join(map(str, ids))))
    if out:
        a, b, first, text = zip(*out, strict=True)
        empty = pa.nulls(len(out), pa.int64())
        columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), *[empty] * 6, pa.array(first, pa.int64()), pa.array(text)]
        yield pa.RecordBatch.from_arrays(columns, names=PART_NAMES)


def prefixes(rows: DataFrame) -> DataFrame:
    """PARTS rows of the segments ``rows``, chunk by chunk; ids ascend from chunk to chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += len(batch.column("turns").flatten()) + batch.num_rows
            if size >= CHUNK_TURNS:
                yield from expanded(held, SEGMENT, END_BYTES)
                held, size = [], 0
        if held:
            yield from expanded(held, SEGMENT, END_BYTES)

    return rows.repartitionByRange("conv", "segment").sortWithinPartitions("conv", "segment").mapInArrow(run, PARTS)


def digests(parts: DataFrame) -> DataFrame:
    """a, b, ends: SHA-256 of the ids that end at a prefix, comma-joined in their order; a stream, whatever its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for a, b, text in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ends")), strict=True):
                if (a, b) != key:
                    if key:
                        out.append((*key, state.hexdigest()))
                    key, state = (a, b), hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield rows(out)
        yield rows([(*key, state.hexdigest())] if key else [])

    def rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)], names=["a", "b", "ends"])

    sorted_ = parts.select("a", "b", "first", "ends").repartition("a", "b").sortWithinPartitions("a", "b", "first")
    return sorted_.mapInArrow(run, "a long, b long, ends string")


def subtree_totals(paths: DataFrame) -> DataFrame:
    """conv, leaves, saved: of each path and all below it; ``paths`` has conv, parent, leaves, saved.

    In round k a path hands its sum over 2^k generations to the path 2^k generations above.
    """
    now = staged(paths.select("conv", "parent", "leaves", "saved"), "paths")
    while not now.where("parent is not null").isEmpty():
        below = now.where("parent is not null").groupBy(F.col("parent").alias("conv")).agg(F.sum("leaves").alias("more"), F.sum("saved").alias("most"))
        jump = now.where("parent is not null").select(F.col("conv").alias("parent"), F.col("parent").alias("next"))
        moved = now.join(below, "conv", "left").join(jump, "parent", "left")
        now = staged(
            moved.select("conv", F.col("next").alias("parent"), (F.col("leaves") + F.coalesce("more", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("most", F.lit(0))).alias("saved")),
            "paths",
        )
    return now.select("conv", "leaves", "saved")


def sums_from(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, depth, leaves, saved, ...) with both columns summed over the rows of a path from this depth down."""
    slotted = rows.withColumn("slot", F.expr(f"depth div {SEGMENT}"))
    totals = slotted.groupBy("conv", "slot").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
    later = Window.partitionBy("conv").orderBy("slot").rowsBetween(1, Window.unboundedFollowing)
    totals = totals.select("conv", "slot", F.coalesce(F.sum("l").over(later), F.lit(0)).alias("l"), F.coalesce(F.sum("s").over(later), F.lit(0)).alias("s"))
    here = Window.partitionBy("conv", "slot").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    told = slotted.join(totals, ["conv", "slot"])
    return told.withColumn("leaves", F.sum("leaves").over(here) + F.col("l")).withColumn("saved", F.sum("saved").over(here) + F.col("s")).drop("slot", "l", "s")


def prefix_trie(
    conversations: DataFrame,
    source: Column,
    heads: Column,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per distinct prefix of turns (role, text) of the rebuilt conversations, the empty one included.

    Every conversation begins with the first turns of another: ``heads`` of those of ``source``, columns of ``conv``, in
    place of as many of its own (all that there are, none of an absent one). Columns: conv_id (least member), depth,
    parent_conv_id (of the prefix a turn shorter; null for the empty one), n_convs (conversations that begin so),
    n_children, n_leaves (prefixes at or below this one that no conversation goes beyond), saved_tokens (over this prefix
    and all below, words of its last text for every member but one), ends_sha256 (SHA-256 of the ids of the
    conversations that are this prefix, ascending, comma-joined).

    Turns are ordered by ``turn_col``, a whole number, null first; equal ones by role, then by the MD5 of their text;
    repeated rows are turns like others. Null roles and texts count as empty, rows with a null id take no part. Texts of
    any length count whole; other columns are ignored. An empty table gives no rows.
    """
    turns = staged(turns_of(conversations, conv_col, turn_col, role_col, text_col), "turns")
    convs = turns.select("conv").distinct().select("conv", source.alias("source"), heads.cast("long").alias("heads"))
    rows = staged(segments(rebuilt(turns, convs), convs), "segments")
    parts = staged(prefixes(rows), "prefixes")
    summed = parts.where("n is not null").groupBy("a", "b").agg(
        F.min("least").alias("conv"), F.max("depth").alias("depth"), F.sum("n").alias("n"), F.max("words").alias("words"), F.max("up_a").alias("up_a"), F.max("up_b").alias("up_b")
    )
    nodes = staged(summed.join(digests(parts.where("ends is not null")), ["a", "b"], "left"), "nodes")
    saved = F.expr("(n - 1) * words")

    # Prefixes with one least member are a path: the last turns of that conversation.
    top = F.min(F.struct("depth", "up_a", "up_b")).alias("top")
    paths = nodes.groupBy("conv").agg(top, F.max("depth").alias("bottom"), F.sum(saved).alias("saved"))
    paths = paths.select("conv", "bottom", "saved", F.col("top.depth").alias("top"), F.col("top.up_a").alias("a"), F.col("top.up_b").alias("b"))
    root = nodes.where("depth = 0").select("conv").first()
    above = nodes.select("a", "b", F.col("conv").alias("parent"))
    hung = paths.where("top > 1").join(above, ["a", "b"]).select("conv", "bottom", "saved", "top", "parent")
    first = paths.where("top <= 1").withColumn("parent", F.when(F.col("top") == 1, F.lit(root.conv if root else None).cast("long")))
    paths = staged(hung.union(first.select(hung.columns)), "paths")
    kids = paths.where("parent is not null").groupBy(F.col("parent").alias("conv"), (F.col("top") - 1).alias("depth")).agg(F.count("*").alias("kids"))
    ends = paths.select("conv", F.col("bottom").alias("depth"), "parent", "saved").join(kids, ["conv", "depth"], "left")
    leaves = F.when(F.col("kids").isNull(), 1).otherwise(0).cast("long").alias("leaves")
    totals = subtree_totals(ends.select("conv", "parent", "saved", leaves))

    # What a path adds where it hangs, and where it begins and ends.
    zero = F.lit(0).cast("long")
    nothing = F.lit(None).cast("long")
    hanging = paths.where("parent is not null").join(totals.withColumnRenamed("saved", "all_saved"), "conv")
    marks = hanging.groupBy(F.col("parent").alias("conv"), (F.col("top") - 1).alias("depth")).agg(
        F.count("*").alias("kids"), F.sum("leaves").alias("leaves"), F.sum("all_saved").alias("saved"), F.lit(0).cast("long").alias("bottom"), F.max(nothing).alias("parent"), F.lit(0).cast("long").alias("begins")
    )
    marks = marks.union(ends.select("conv", "depth", zero, leaves, zero, F.lit(1).cast("long"), nothing, zero))
    marks = marks.union(paths.select("conv", F.col("top").alias("depth"), zero, zero, zero, zero, "parent", F.lit(1).cast("long")))
    names = ("kids", "leaves", "saved", "bottom", "begins")
    marks = marks.groupBy("conv", "depth").agg(*[F.sum(c).alias(c) for c in names], F.max("parent").alias("parent"))
    marks = marks.select("conv", "depth", "kids", "leaves", F.col("saved").alias("below"), "bottom", "begins", "parent")

    met = nodes.select("conv", "depth", "n", "ends", saved.alias("own")).join(marks, ["conv", "depth"], "left")
    met = met.select(
        "conv",
        "depth",
        F.when(F.coalesce("begins", zero) == 1, F.col("parent")).otherwise(F.col("conv")).alias("parent"),
        "n",
        (F.coalesce("kids", zero) + 1 - F.coalesce("bottom", zero)).alias("children"),
        F.coalesce("leaves", zero).alias("leaves"),
        (F.col("own") + F.coalesce("below", zero)).alias("saved"),
        "ends",
    )
    told = sums_from(met)
    return told.select(
        F.col("conv").alias(conv_col),
        "depth",
        F.col("parent").alias(f"parent_{conv_col}"),
        F.col("n").alias("n_convs"),
        F.col("children").cast("long").alias("n_children"),
        F.col("leaves").cast("long").alias("n_leaves"),
        F.col("saved").cast("long").alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
