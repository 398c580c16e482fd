"""Packing by power-of-two decomposition.

A document of n token ids (its last one is the separator) is cut into n // 1024 pieces of 1024 ids and one piece for
every binary digit 1 of the rest, the longest first. Pieces of one length form a bucket, and each piece is a sequence
of its own: no sequence crosses documents and none is padded. Sequences are numbered bucket by bucket: a range of
numbers is a bucket, from which a training job draws batches.

A document is cut where it is read: no shuffle, nothing is collected, and a lost task is simply read again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quern.llm.frames import id_and_text, slices

PIECES = "id long, start long, length long, ids binary, doc_tokens long"
BUCKET_BITS = 58  # below them, the place of the piece in the input


def _byte_of_sign() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a visible sign: itself, or the next free one from U+0100 on."""
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


@lru_cache(maxsize=4)
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """text -> ids of the ``tokenizers`` file at ``path``, called with ``add_special_tokens=False``.

    The library's own rules hold: an added token that stands in a text is that token. Where ids follow the order of
    merges, the same vocabulary is handed to ``tiktoken``, which gives the same ids in a quarter of the time; other
    files, and texts that hold an added token, are encoded by ``tokenizers`` itself.
    """
    slow = Tokenizer.from_file(path)

    def by_tokenizers(text: str) -> np.ndarray:
        return np.array(slow.encode(text, add_special_tokens=False).ids, "<u4")

    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    signs, added = _byte_of_sign(), sorted({t["content"] for t in parts.get("added_tokens") or []})
    vocabulary = {t: i for t, i in slow.get_vocab(with_added_tokens=True).items() if t not in added}
    merges = [m if isinstance(m, str) else " ".join(m) for m in parts["model"]["merges"]]
    merged = [vocabulary[m.replace(" ", "")] for m in merges]
    plain = (parts.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and not parts["pre_tokenizer"].get("add_prefix_space")
    if not plain or merged != sorted(merged) or any(sign not in signs for t in vocabulary for sign in t):
        return by_tokenizers
    ranks = {bytes(signs[s] for s in t): i for t, i in vocabulary.items()}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def by_ranks(text: str) -> np.ndarray:
        if any(token in text for token in added):
            return by_tokenizers(text)
        try:
            return np.asarray(fast.encode_to_numpy(text, disallowed_special=())).astype("<u4")
        except ValueError:  # its pattern has a limit of about a million blanks in a row
            return by_tokenizers(text)

    return by_ranks


def pieces(tokens: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``tokens`` ids; ``longest`` is a power of two."""
    whole, rest = divmod(tokens, longest)
    found = [(k * longest, longest) for k in range(whole)]
    start = whole * longest
    while rest:
        length = 1 << (rest.bit_length() - 1)
        found.append((start, length))
        start, rest = start + length, rest - length
    return found


def pack(
    docs: DataFrame,
    tokenizer: str,
    longest: int = 1024,
    separator: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents: id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers. ``sequence_id`` is unique, ascends with the
    length first and is fixed by the place of the row in the input; ``offset`` is 0. ``tokenizer`` is a file that every executor finds at that path.

    A null text counts as empty; an empty text is one piece of the separator alone. Null and repeated ids are packed
    like others, row by row. A text of any length is read whole. An empty table gives no rows. Other columns of
    ``docs`` are ignored, whatever their names.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in slices(batches):
            owner, starts, lengths, sizes, ids = [], [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                numbers = np.append(encode(text), np.uint32(separator)).astype("<u4")
                for start, length in pieces(len(numbers), longest):
                    owner.append(row)
                    starts.append(start)
                    lengths.append(length)
                    sizes.append(len(numbers))
                    ids.append(numbers[start : start + length].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pc.take(batch.column("id").cast(pa.int64()), pa.array(owner, pa.int64())),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array(sizes, pa.int64()),
                ],
                names=["id", "start", "length", "ids", "doc_tokens"],
            )

    cut_docs = id_and_text(docs, id_col, text_col).mapInArrow(cut, PIECES)
    return cut_docs.select(
        F.col("id").alias(id_col),
        "start",
        "length",
        "ids",
        "doc_tokens",
        (F.shiftleft(F.round(F.log2("length")).cast("long"), BUCKET_BITS) + F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )

