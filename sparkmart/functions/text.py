"""Text functions and hash keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import cast_text

KEY_SEPARATOR = "|"
PHONE_NOISE = ("/", "-")


def coalesce_empty(c: Column | str) -> Column:
    """Text form, with NULL as the empty string."""
    return F.coalesce(cast_text(c), F.lit(""))


def full_name(first: Column | str, last: Column | str) -> Column:
    """Both names around one space; a missing name counts as empty, the space stays."""
    return F.concat(coalesce_empty(first), F.lit(" "), coalesce_empty(last))


def clean_phone(c: Column | str) -> Column:
    return reduce(lambda text, noise: F.replace(text, F.lit(noise), F.lit("")), PHONE_NOISE, cast_text(c))


def md5_key(c: Column | str) -> Column:
    return F.md5(coalesce_empty(c))


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the text of all parts; NULL and the empty string give the same key."""
    return F.md5(F.concat_ws(KEY_SEPARATOR, *[coalesce_empty(c) for c in cols]))


# The first byte of a packed key.
_HEX, _TEXT = "X'01'", "X'00'"


def pack_key(c: Column | str) -> Column:
    """A key's bytes: one that is lower-case hex, as hash keys are, takes half its length; :func:`unpack_key` gives it back."""
    key = F.col(c) if isinstance(c, str) else c
    packed = F.concat(F.expr(_HEX), F.unhex(key))
    return F.when(F.lower(F.hex(F.unhex(key))) == key, packed).otherwise(F.concat(F.expr(_TEXT), key.cast("binary")))


def unpack_key(c: Column | str) -> Column:
    """The text that :func:`pack_key` has packed."""
    packed = F.col(c) if isinstance(c, str) else c
    rest = F.substr(packed, F.lit(2))
    return F.when(F.substr(packed, F.lit(1), F.lit(1)) == F.expr(_HEX), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
