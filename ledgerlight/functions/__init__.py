"""Column-expression helpers: all built-in Spark functions, no UDFs."""

from ledgerlight.functions.safe import safe_div, nullif, money, ratio  # noqa: F401
from ledgerlight.functions.text import (  # noqa: F401
    sentence_case, is_null_or_blank, has_extra_space, float_text_to_int, normalise_status,
)
from ledgerlight.functions.dates import (  # noqa: F401
    month_end, month_start, year_month, lookup_name,
)
