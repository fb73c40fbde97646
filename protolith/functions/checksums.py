"""Digests and short ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASE = 36


def _base64_of_hex(hex_digest: Column) -> Column:
    return F.rtrim(F.base64(F.unhex(hex_digest)), F.lit("="))


def sequence_checksum(seq: Column) -> Column:
    """SEGUID: unpadded base64 of the SHA-1 of the upper-cased sequence."""
    return _base64_of_hex(F.sha1(F.upper(seq)))


def sequence_md5(seq: Column) -> Column:
    return F.md5(seq)


def record_checksum(payload: Column) -> Column:
    """Unpadded base64 of the SHA-256 of a compact JSON payload."""
    return _base64_of_hex(F.sha2(payload, 256))


def encode_id(number: Column, prefix: str = "SR", length: int = 5) -> Column:
    """Prefix plus base-36 number, zero-padded to ``length`` and allowed to outgrow it."""
    digits = F.conv(number.cast("string"), 10, BASE)
    padded = F.when(F.length(digits) < length, F.lpad(digits, length, "0")).otherwise(digits)
    return F.concat(F.lit(prefix), padded)


def decode_id(code: Column, prefix: str = "SR") -> Column:
    return F.conv(F.substring(code, len(prefix) + 1, 64), BASE, 10).cast("bigint")
