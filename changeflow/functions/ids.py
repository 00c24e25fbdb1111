"""Deterministic identifiers and pseudo-random choices from digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the URL namespace of RFC 4122, as 32 hex digits.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(name: Column, namespace: str = URL_NAMESPACE) -> Column:
    """Name-based (version 5) UUID as text."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "utf-8")))
    # Two bits of the variant field are set, two of the digest kept.
    variant = F.substring(
        F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab"), 1, 1
    )
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def point_id(key: Column, suffix: Column) -> Column:
    """Id of a point: of the key alone, or of `key#suffix` where there is one."""
    return uuid5(F.when(suffix == "", key).otherwise(F.concat(key, F.lit("#"), suffix)))


def digest_int(*parts: Column | str) -> Column:
    """32 bits of an md5 over the parts joined by `:`, as a bigint >= 0."""
    columns = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *columns)), 1, 8), 16, 10).cast("bigint")
