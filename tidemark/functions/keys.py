"""Surrogate keys as native column expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX = "[0-9a-fA-F]"
CANONICAL = f"{HEX}{{8}}-{HEX}{{4}}-{HEX}{{4}}-{HEX}{{4}}-{HEX}{{12}}"
UUID_FORMS = rf"\A(?:(?:[uU][rR][nN]:[uU][uU][iI][dD]:)?{CANONICAL}|\{{{CANONICAL}\}}|{HEX}{{32}})\z"


def uuid5(name: Column, namespace: uuid.UUID) -> Column:
    """RFC 4122 version 5 UUID of ``name`` as 36 lower-case characters.

    The digest appears several times in the expression but generated code evaluates it once a row.
    """
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), name.cast("string").cast("binary")))
    variant = F.translate(
        F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4
    )
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-5"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )


def random_uuid() -> Column:
    """Version 4 UUID. Store the result: every evaluation of the plan draws a new one."""
    return F.expr("uuid()")


def is_uuid(column: Column) -> Column:
    """True for the 8-4-4-4-12 form, with ``urn:uuid:`` or braces, and for 32 plain digits."""
    return column.rlike(UUID_FORMS)
