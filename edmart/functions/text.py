"""Text comparison and the derived name / host columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The markers that are cut out of names and web addresses.
SOURCE_SUFFIX = " src_"
NAME_NOISE = ("undergraduate", "graduate")
NAME_EDGES = "_ "
SCHEMES = ("http://", "https://")
HOST_PREFIX = "www."


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_eq(left: Column | str, right: Column | str, case_insensitive: bool = False) -> Column:
    """Equality of two texts; bare comparisons are case-sensitive by decision."""
    left, right = as_col(left), as_col(right)
    if case_insensitive:
        left, right = F.lower(left), F.lower(right)
    return left == right


def text_contains(text: Column | str, part: Column | str, case_insensitive: bool = False) -> Column:
    """``part`` occurs in ``text``. Wildcard characters in the data are plain characters.

    ``part`` is a column (or column name); wrap constants in ``F.lit``.
    """
    text, part = as_col(text), as_col(part)
    if case_insensitive:
        text, part = F.lower(text), F.lower(part)
    return F.contains(text, part)


def cleaned_name(source_name: Column | str) -> Column:
    """School name behind a source name, e.g. ``Foo_Undergraduate SRC_12`` -> ``foo``."""
    name = F.substring_index(F.lower(as_col(source_name)), SOURCE_SUFFIX, 1)
    for word in NAME_NOISE:
        name = F.replace(name, F.lit(word), F.lit(""))
    return F.replace(F.btrim(name, F.lit(NAME_EDGES)), F.lit("_"), F.lit(" "))


def host_key(address: Column | str) -> Column:
    """Comparable host of a web address, always ending in ``/``; NULL stays NULL.

    Schemes go before lowering, so an upper-case scheme survives as text.
    """
    host = as_col(address)
    for scheme in SCHEMES:
        host = F.replace(host, F.lit(scheme), F.lit(""))
    host = F.concat(F.substring_index(host, "/", 1), F.lit("/"))
    return F.lower(F.replace(host, F.lit(HOST_PREFIX), F.lit("")))


src_host = host_key
uni_host = host_key


def concat_nulls_empty(*columns: Column | str, sep: str = "") -> Column:
    """Concatenation that reads NULL as the empty text (plain ``concat`` gives NULL)."""
    parts: list[Column] = []
    for i, c in enumerate(columns):
        if i and sep:
            parts.append(F.lit(sep))
        parts.append(F.coalesce(as_col(c).cast("string"), F.lit("")))
    return F.concat(*parts)


def row_digest(*columns: Column | str) -> Column:
    """256-bit digest of several texts; NULL differs from empty, lengths keep fields apart.

    Stands for the texts themselves in DISTINCT, so shuffles carry 64 characters
    per row in place of whole descriptions.
    """
    parts: list[Column] = []
    for c in columns:
        text = as_col(c).cast("string")
        parts += [
            F.coalesce(F.length(text), F.lit(-1)).cast("string"),
            F.lit(":"),
            F.coalesce(text, F.lit("")),
        ]
    return F.sha2(F.concat(*parts), 256)
