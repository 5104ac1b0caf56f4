"""Surrogate keys, references and coded values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

KeyFunction = Callable[[Column], Column]

KEY_MODULUS = 1_000_000_000
PIECE_DIGITS = 15
REFERENCE_PREFIXES = ("urn:uuid:", "Patient/", "Encounter/")


def hash_mod_key(value: Column, modulus: int = KEY_MODULUS) -> Column:
    """The SHA-256 digest of ``value`` as a number, modulo ``modulus``; null stays null.

    The digest is folded in pieces of at most 15 hex digits. Each is reduced before it
    is combined, so no step leaves the bigint range.
    """
    if modulus > 2**31:
        raise ValueError("modulus must fit in 31 bits")
    digest = F.sha2(value.cast("string"), 256)
    rest = F.lit(0).cast("bigint")
    for start in range(0, 64, PIECE_DIGITS):
        digits = min(PIECE_DIGITS, 64 - start)
        piece = F.conv(F.substring(digest, start + 1, digits), 16, 10).cast("bigint") % F.lit(modulus)
        rest = (rest * F.lit(16**digits % modulus) + piece) % F.lit(modulus)
    return rest


def wide_hash_key(value: Column) -> Column:
    """A 60-bit key from the same digest, for volumes where 10^9 values collide."""
    return F.conv(F.left(F.sha2(value.cast("string"), 256), F.lit(15)), 16, 10).cast("bigint")


def strip_reference(reference: Column) -> Column:
    """Drop the known reference prefixes wherever they stand; empty becomes null."""
    for prefix in REFERENCE_PREFIXES:
        reference = F.replace(reference, F.lit(prefix), F.lit(""))
    return F.nullif(reference, F.lit(""))


def person_token(identifier: Column, salt: str) -> Column:
    """SHA-256 pseudonym; one salt for all tables of a build makes their tokens join."""
    return F.sha2(F.concat(F.lit(salt), identifier.cast("string")), 256)
