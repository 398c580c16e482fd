"""Repeatable pseudo-random numbers from a row key and a seed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyed_md5(key: Column, seed: int) -> Column:
    """md5 text of ``key:seed``; its text order is a repeatable shuffle."""
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))


def _hex_number(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("bigint")


def hash_number(key: Column, seed: int, start: int = 1) -> Column:
    """A number in [0, 2^32) from eight hex digits of the hash."""
    return _hex_number(F.substring(keyed_md5(key, seed), start, 8))


def hash_bucket(key: Column, seed: int, buckets: int) -> Column:
    return F.pmod(hash_number(key, seed), F.lit(buckets))


def hash_unit(key: Column, seed: int, start: int = 1) -> Column:
    """A number in [0, 1)."""
    return hash_number(key, seed, start) / F.lit(4294967296.0)


def hash_slot(md5_text: Column, digits: int = 3) -> Column:
    """Number of the first ``digits`` hex digits: 16^digits even slots in text order."""
    return _hex_number(F.substring(md5_text, 1, digits))
