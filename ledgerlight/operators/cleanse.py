"""Cleansing and typing operators (bronze text -> typed silver columns).

All casts are ``try_cast``: under ANSI mode a plain cast of bad text raises
and would fail a whole job on one bad row; here bad text becomes NULL and
the row rules (``operators.rules``) route it to the reject set.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight import schemas as S
from ledgerlight.functions.dates import month_end
from ledgerlight.functions.text import float_text_to_int, normalise_status, sentence_case
from ledgerlight.operators.joins import runtime_sized, with_missing


def typed_projection(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Cast the listed text columns to the given types (try_cast)."""
    return df.select(*[F.col(c).try_cast(casts[c]).alias(c) if c in casts else F.col(c)
                       for c in df.columns])


def float_keys_to_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """S2: '101.0' -> 101 for each listed key column."""
    return df.select(*[float_text_to_int(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def sentence_case_names(df: DataFrame, cols: Sequence[str], keep_acronyms: Sequence[str] = ()) -> DataFrame:
    """S3: trimmed text with only its first letter upper-case.

    ``keep_acronyms``: names (compared trimmed, case-insensitively) kept as
    upper case, e.g. 'TI'. Empty by default, like the reference view.
    """
    def fix(c: str) -> Column:
        out = sentence_case(c)
        if keep_acronyms:
            out = F.when(F.upper(F.trim(c)).isin([a.upper() for a in keep_acronyms]),
                         F.upper(F.trim(c))).otherwise(out)
        return out
    return df.select(*[fix(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def drop_null_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows whose listed columns are all non-null."""
    return df.dropna(how="any", subset=list(cols))


def rekey_unknown(df: DataFrame, key: str, dim: DataFrame, dim_key: str,
                  default: int = S.DEFAULT_MEMBER_ID) -> DataFrame:
    """A key absent from the dimension becomes ``default``; NULL stays NULL.

    NULL keys of the dimension match nothing, so a bad dimension row cannot
    switch the re-keying off (a literal ``NOT IN`` would be unknown for all).
    """
    flagged = with_missing(df, key, dim, dim_key, "__unknown")
    fixed = F.when(F.col("__unknown"), F.lit(default)).otherwise(F.col(key))
    return flagged.select(*[fixed.cast(df.schema[key].dataType).alias(c) if c == key else F.col(c)
                            for c in df.columns])


def add_default_member(dim: DataFrame, key: str, name_col: str,
                       default_id: int = S.DEFAULT_MEMBER_ID,
                       default_name: str = S.DEFAULT_MEMBER_NAME) -> DataFrame:
    """Append the 'unknown' member row (idempotent: skipped if present)."""
    spark = dim.sparkSession
    row = spark.createDataFrame([(default_id, default_name)], dim.select(key, name_col).schema)
    extra = {c: F.lit(None).cast(dim.schema[c].dataType) for c in dim.columns if c not in (key, name_col)}
    row = row.select(*[F.col(c) if c in (key, name_col) else extra[c].alias(c) for c in dim.columns])
    return dim.filter(~F.col(key).eqNullSafe(F.lit(default_id))).unionByName(row)


def sign_repair(df: DataFrame, value: str, out: str, original: str) -> DataFrame:
    """``out`` = abs(value) and ``original`` keeps the signed value."""
    return df.withColumn(original, F.col(value)).withColumn(out, F.abs(F.col(value)))


def normalise_category(df: DataFrame, col: str, case_insensitive: bool = True) -> DataFrame:
    """Status spellings -> Pago / Aberto, anything else -> Outros."""
    return df.withColumn(col, normalise_status(col, case_insensitive))


def outlier_flag(df: DataFrame, value: str, group_cols: Sequence[str], out: str,
                 threshold: float = S.SUSPECT_RATIO_MINUS_ONE,
                 suspect: str = S.BUDGET_SUSPECT, trusted: str = S.BUDGET_TRUSTED, over: DataFrame | None = None) -> DataFrame:
    """Value / AVG(value) over the group - 1 > threshold -> suspect.

    The group mean comes from a partial aggregation joined back (no window,
    so a hot group is pre-aggregated, never gathered in one task). The mean
    includes the outlier itself, as in the reference; it is taken ``over``
    other rows if given (those without repeated keys).
    """
    means = (df if over is None else over).groupBy(*group_cols).agg(
        (F.sum(value).cast("double") / F.count(value)).alias("__mean"))
    side = means.select(*[F.col(c).alias(f"__m_{c}") for c in group_cols], "__mean")
    on = [F.col(c).eqNullSafe(F.col(f"__m_{c}")) for c in group_cols]
    j = df.join(runtime_sized(side), on, "left")
    ratio = F.try_divide(F.col(value).cast("double"), F.col("__mean"))
    flag = F.when(ratio - 1 > threshold, F.lit(suspect)).otherwise(F.lit(trusted))
    return j.select(*df.columns, flag.alias(out))


def month_end_anchor(df: DataFrame, year: str, month: str, out: str) -> DataFrame:
    """The last day of (year, month)."""
    return df.withColumn(out, month_end(year, month))


def fill_label(df: DataFrame, cols: Sequence[str], label: str = S.MISSING_LABEL) -> DataFrame:
    """NULL / blank descriptive text -> ``label``; other text trimmed."""
    def fix(c: str) -> Column:
        t = F.trim(F.col(c))
        return F.when(t.isNull() | (F.length(t) == 0), F.lit(label)).otherwise(t)
    return df.select(*[fix(c).alias(c) if c in cols else F.col(c) for c in df.columns])
