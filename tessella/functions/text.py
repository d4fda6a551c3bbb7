"""Text folding as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters with marks and their plain forms, place by place.
MARKED = "ıçğöşüâäàáãåéèêëíìîïóòôõúùûñýćčšž"
PLAIN = "icgosuaaaaaaeeeeiiiioooouuunyccsz"

# Stand-ins for a missing value, in lower case.
MISSING = ("", "unknown", "none", "nan", "n/a", "na", "[]")


def squeeze(c: Column) -> Column:
    """Any run of blanks (no-break ones too) to one blank; ends trimmed; zero-width characters dropped."""
    c = F.regexp_replace(c, "[\\u200b-\\u200d\\ufeff\\u2060]", "")
    return F.trim(F.regexp_replace(c, "[\\s\\u00a0\\u2000-\\u200a\\u202f\\u3000]+", " "))


def fold(c: Column) -> Column:
    """Lower case without accents; the dotted and the dotless i become i."""
    return F.translate(F.lower(F.translate(c, "İ", "i")), MARKED, PLAIN)


def is_missing(c: Column) -> Column:
    """Null, blank or one of the stand-ins in any letter case. Never null itself."""
    return c.isNull() | F.lower(squeeze(c)).isin(*MISSING)
