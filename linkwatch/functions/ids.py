"""Name-based identifiers and privacy transforms as SQL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkwatch.functions.numeric import col

# Fixed value (RFC 4122): namespace for names that are URLs.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"

PSEUDONYM_NAMESPACE = "linkwatch-agent-v1"
PRIVACY_MODES = ("omit", "hash", "plain")


def uuid5(name: Column, namespace_hex: str = URL_NAMESPACE) -> Column:
    """RFC 4122 version 5 UUID text of a name column."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), name.cast("binary")))
    variant = F.translate(
        F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab"
    )
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def pseudonym(value: Column | str, namespace: str = PSEUDONYM_NAMESPACE) -> Column:
    """``agent_`` and the first twelve hex digits of SHA-256(namespace, NUL, id)."""
    salted = F.concat(F.lit(namespace.encode() + b"\0"), col(value).cast("binary"))
    return F.concat(F.lit("agent_"), F.substring(F.sha2(salted, 256), 1, 12))


def protect(value: Column | str, mode: str, salt: str = "") -> Column:
    """Omit an identifier, replace it by its salted hash, or keep it."""
    if mode == "omit":
        return F.lit(None).cast("string")
    if mode == "plain":
        return col(value)
    if mode == "hash":
        hashed = F.sha2(F.concat(F.lit(f"{salt}:"), col(value)).cast("binary"), 256)
        return F.concat(F.lit("sha256:"), hashed)
    raise ValueError(f"privacy mode must be one of {PRIVACY_MODES}")
