"""Text helpers used by profiling and cleansing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlight import schemas as S


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sentence_case(x) -> Column:
    """Upper first letter, lower the rest, of the trimmed text ('TI' -> 'Ti').

    Not ``initcap``: only the first character of the whole text is raised.
    """
    t = F.trim(_c(x))
    return F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 1 << 30)))


def is_null_or_blank(x) -> Column:
    """NULL, empty or blank-only (a length that ignores trailing blanks is 0)."""
    x = _c(x)
    return x.isNull() | (F.length(F.rtrim(x)) == 0)


def has_extra_space(x, leading_only: bool = False) -> Column:
    """Leading or trailing blanks; ``leading_only`` mimics a length that
    ignores trailing blanks. NULL input counts as False."""
    x = _c(x)
    base = F.length(F.rtrim(x)) if leading_only else F.length(x)
    return F.coalesce(base > F.length(F.trim(x)), F.lit(False))


def float_text_to_int(x) -> Column:
    """'101.0' -> 101 (text -> double -> int, truncating); bad text -> NULL."""
    return _c(x).try_cast("double").try_cast("int")


def normalise_status(x, case_insensitive: bool = True) -> Column:
    """Map payment-status spellings to Pago / Aberto / Outros.

    By default the comparison is that of a case-insensitive collation
    (upper case, trailing blanks ignored): 'pago' and 'PAGO ' are Pago.
    ``case_insensitive=False`` compares the text exactly.
    """
    x = _c(x)
    if case_insensitive:
        key = F.upper(F.rtrim(x))
        paid = [s.upper() for s in S.PAID_SPELLINGS]
        open_ = [s.upper() for s in S.OPEN_SPELLINGS]
    else:
        key, paid, open_ = x, list(S.PAID_SPELLINGS), list(S.OPEN_SPELLINGS)
    return (F.when(key.isin(paid), F.lit(S.STATUS_PAID))
            .when(key.isin(open_), F.lit(S.STATUS_OPEN))
            .otherwise(F.lit(S.STATUS_OTHER)))
