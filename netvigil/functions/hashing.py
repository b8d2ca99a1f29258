"""md5 as a 128-bit number, in 64-bit arithmetic only.

md5 (rather than a Spark-only hash) lets any other engine reproduce the same
buckets from the same text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_CHUNK_VALUES = 2**32


def hex_chunk(digest: Column, index: int) -> Column:
    """Hex digits 8*index .. 8*index+7 of a digest, as a long."""
    return F.conv(F.substring(digest, 1 + 8 * index, 8), 16, 10).cast("long")


def md5_mod(text: Column, modulus: int) -> Column:
    """md5 of ``text``, read as a 128-bit number, modulo ``modulus`` (below 2**31)."""
    if not 0 < modulus < 2**31:
        raise ValueError("modulus must lie in 1 .. 2**31-1")
    carry = _CHUNK_VALUES % modulus
    digest = F.md5(text)
    residue = hex_chunk(digest, 0) % modulus
    for index in (1, 2, 3):
        residue = (residue * carry + hex_chunk(digest, index)) % modulus
    return residue


def md5_prefix(text: Column, digits: int = 6) -> Column:
    return F.substring(F.md5(text), 1, digits)
