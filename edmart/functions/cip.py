"""Program (CIP) codes: text with spreadsheet quoting, decimal in the tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from edmart.functions.text import as_col

CIP_TYPE = "decimal(10,4)"
# As many integer digits as CIP_TYPE and far more decimals: membership is tested
# before rounding, a code with a fifth decimal is not the code it rounds to.
CIP_EXACT_TYPE = "decimal(38,32)"


def strip_quoting(code: Column | str) -> Column:
    """``="11.0101"`` -> ``11.0101``."""
    return F.replace(F.replace(as_col(code), F.lit('="'), F.lit("")), F.lit('"'), F.lit(""))


def clean_cip(code: Column | str) -> Column:
    """Code as stored in the tables; unreadable text gives NULL."""
    return strip_quoting(code).try_cast(CIP_TYPE)


def exact_cip(code: Column | str) -> Column:
    """Code for comparison with stored codes; unreadable text gives NULL."""
    return strip_quoting(code).try_cast(CIP_EXACT_TYPE)


def repaired_cip(code: Column | str) -> Column:
    """Two-pass repair of a stored text code: the quoted form first, plain text second."""
    code = as_col(code)
    quoted = F.when(F.startswith(code, F.lit('="')) & F.endswith(code, F.lit('"')), clean_cip(code))
    return F.coalesce(quoted, code.try_cast(CIP_TYPE))
