"""Deterministic ids (G1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamper.functions.lookups import NAMESPACE_DNS_HEX


def uuid5(c, namespace_hex: str = NAMESPACE_DNS_HEX) -> Column:
    """RFC 4122 version-5 UUID of a string, built from ``sha1`` and substrings:
    SHA-1 over namespace bytes + UTF-8 name, first 16 bytes, version nibble 5,
    variant bits ``10``. NULL in, NULL out."""
    c = F.col(c) if isinstance(c, str) else c
    h = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), F.encode(c, "UTF-8")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"),
        F.substring(h, 9, 4), F.lit("-5"),
        F.substring(h, 14, 3), F.lit("-"),
        variant, F.substring(h, 18, 3), F.lit("-"),
        F.substring(h, 21, 12),
    )


def uuid5_dns(c) -> Column:
    return uuid5(c, NAMESPACE_DNS_HEX)
