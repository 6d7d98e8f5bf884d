"""Hashing, masking and encryption of columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
MASK = "****"
HASH_SEPARATOR = "||"


def row_hash(columns: Iterable[str]) -> Column:
    """Hex SHA-256 over the joined values. NULLs are skipped, so rows may collide when a NULL changes its column:
    use it as a stored fingerprint and compare columns null-safely to detect changes."""
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *[F.col(c).cast("string") for c in columns]), 256)


def mask_constant(mask: str = MASK) -> Column:
    """The same text for every row, also where the value is NULL."""
    return F.lit(mask)


def hash_column(c: Column, salt: str | None = None) -> Column:
    """Hex SHA-256 of the value as text; NULL stays NULL. Without a salt short values can be found by trying them."""
    text = c.cast("string")
    return F.sha2(text if salt is None else F.concat(F.lit(salt), text), 256)


def encrypt(c: Column, key: Column) -> Column:
    """AES-GCM with a random vector, as base64 text."""
    return F.base64(F.aes_encrypt(c.cast("string"), key))


def decrypt(c: Column, key: Column) -> Column:
    """The text behind :func:`encrypt`; NULL for a wrong key or damaged value."""
    return F.try_aes_decrypt(F.unbase64(c), key).cast("string")
