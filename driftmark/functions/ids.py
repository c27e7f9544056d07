"""UUID spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Whitespace of any Unicode kind, and the invisible marks that pad identifiers.
PADDING = r"[\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200f}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]"
CANONICAL = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def canonical_uuid(c: Column) -> Column:
    """The canonical spelling (lower case, hyphens) of a UUID in any spelling, else null.

    Taken as spellings: any case, padding, braces, a ``urn:uuid:`` prefix, hyphens left out. Null stays null.
    """
    digits = F.regexp_replace(F.regexp_replace(F.lower(c), f"^{PADDING}+|{PADDING}+$", ""), r"^urn:uuid:|^urn:|^uuid:|[{}\-]", "")
    spelled = F.regexp_replace(digits, r"^([0-9a-f]{8})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{12})$", "$1-$2-$3-$4-$5")
    return F.when(c.rlike(CANONICAL), c).otherwise(F.when(spelled.rlike(CANONICAL), spelled))


def identity(c: Column) -> Column:
    """The canonical UUID where ``c`` spells one, else the trimmed text itself; null stays null."""
    return F.coalesce(canonical_uuid(c), F.regexp_replace(c, f"^{PADDING}+|{PADDING}+$", ""))
