"""Data-quality profiling (Q1-Q17).

Each per-column rule is a conditional aggregate, so a whole table profile
is ONE scan with partial aggregation (map-side combine) and the long-form
report (tabela, coluna, regra, qtd) comes from ``unpivot`` of that single
row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.functions.safe import rnd

from ledgerlight import schemas as S
from ledgerlight.functions.text import has_extra_space, is_null_or_blank, sentence_case
from ledgerlight.operators.joins import anti_join, has_null, runtime_sized, with_missing

RULE_EXTRA_SPACE = "espacos_extras"
RULE_NULL_OR_EMPTY = "nulos_ou_vazios"
RULE_DECIMAL_POINT = "chave_com_ponto"
RULE_NOT_SENTENCE_CASE = "fora_do_padrao_de_caixa"
RULE_ALL_UPPER = "tudo_maiusculo"

Predicate = Callable[[str], Column]

STANDARD_RULES: dict[str, Predicate] = {
    RULE_EXTRA_SPACE: lambda c: has_extra_space(c),
    RULE_NULL_OR_EMPTY: lambda c: is_null_or_blank(c),
}


def count_per_column(df: DataFrame, cols: Sequence[str], predicate: Predicate) -> DataFrame:
    """One row, one count column per input column (one scan)."""
    return df.agg(*[F.count_if(predicate(c)).alias(c) for c in cols])


def extra_space_counts(df: DataFrame, cols: Sequence[str], leading_only: bool = False) -> DataFrame:
    """Q1: rows with leading/trailing blanks per column."""
    return count_per_column(df, cols, lambda c: has_extra_space(c, leading_only))


def null_or_empty_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q2: NULL, empty or blank-only per column."""
    return count_per_column(df, cols, is_null_or_blank)


def offending_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q3: rows where any listed column is NULL."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return df.filter(cond)


def duplicate_keys(df: DataFrame, key: str | Column, name: str = "chave") -> DataFrame:
    """Keys seen more than once. COUNT(key) skips NULL, so a NULL
    key is never reported. Partial aggregation keeps a hot key cheap."""
    k = F.col(key) if isinstance(key, str) else key
    return (df.groupBy(k.alias(name)).agg(F.count(k).alias("contagem"))
            .filter(F.col("contagem") > 1))


def duplicate_names(df: DataFrame, col: str, case_insensitive: bool = True) -> DataFrame:
    """Q5: names seen more than once after trimming; case-insensitive by
    default (a CI collation finds 'Building' = 'BUILDING')."""
    key = F.lower(F.trim(col)) if case_insensitive else F.trim(col)
    return duplicate_keys(df, key, "nome")


def not_sentence_case(df: DataFrame, col: str, min_len: int = 3) -> DataFrame:
    """Q6: names longer than ``min_len`` that differ (case-sensitively) from
    their sentence-case form."""
    t = F.trim(col)
    return df.filter((F.length(t) > min_len) & (t != sentence_case(col)))


def all_upper(df: DataFrame, col: str, min_len: int = 3) -> DataFrame:
    """Q7: names longer than ``min_len`` written all upper-case."""
    t = F.trim(col)
    return df.filter((F.length(t) > min_len) & (t == F.upper(t)))


def out_of_range(df: DataFrame, col: str, low: int, high: int) -> DataFrame:
    """Q8: one row: values outside [low, high] and values that are not numbers."""
    v = F.col(col).try_cast("int")
    return df.agg(
        F.count_if(v.isNotNull() & ~v.between(low, high)).alias("fora_do_intervalo"),
        F.count_if(F.col(col).isNotNull() & v.isNull()).alias("nao_numerico"))


def decimal_point_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q9: keys written with a decimal point ('101.0')."""
    return count_per_column(df, cols, lambda c: F.coalesce(F.col(c).contains("."), F.lit(False)))


def fk_violations(child: DataFrame, checks: Mapping[str, tuple[Column | str, DataFrame, str]]) -> DataFrame:
    """Per foreign key, rows whose non-null key is missing from the
    parent (NOT IN semantics: a NULL among the parent keys reports nothing).
    ``checks``: name -> (child key, parent, parent key). Returns (coluna, qtd).

    A parent that is proven small is broadcast, so the child is scanned once;
    of a larger one the child's distinct keys are looked up first
    (``with_missing``). A single conditional aggregate counts all misses."""
    probe = child
    counts = []
    for i, (name, (ck, parent, pk)) in enumerate(checks.items()):
        if has_null(parent, pk):
            counts.append(F.lit(0).cast("long").alias(f"__n{i}"))
            continue
        probe = with_missing(probe, ck, parent, pk, f"__m{i}")
        counts.append(F.count_if(f"__m{i}").alias(f"__n{i}"))
    wide = probe.agg(*counts)
    pairs = [F.struct(F.lit(name).alias("coluna"), F.col(f"__n{i}").alias("qtd")) for i, name in enumerate(checks)]
    return wide.select(F.explode(F.array(*pairs)).alias("__p")).select("__p.coluna", "__p.qtd")


def orphan_keys(child: DataFrame, child_key: Column | str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Q11: the distinct orphan key values."""
    ck = F.col(child_key) if isinstance(child_key, str) else child_key
    return anti_join(child.select(ck.alias("chave")), parent, "chave", parent_key).distinct()


def financial_impact(df: DataFrame, value: Column, defect: Column) -> DataFrame:
    """Q12: total, total of defective rows and their share (one pass)."""
    total = F.sum(value)
    bad = F.sum(F.when(defect, value))
    return df.agg(total.cast("double").alias("valor_total"),
                  F.coalesce(bad, F.lit(0)).cast("double").alias("valor_defeito"),
                  rnd(F.try_divide(F.coalesce(bad, F.lit(0)).cast("double"),
                                       total.cast("double")), 6).alias("impacto"))


def negative_profile(df: DataFrame, value: Column, by: str) -> DataFrame:
    """Q13: count and sum of negative values per ``by``."""
    return (df.filter(value < 0).groupBy(by)
            .agg(F.count(value).alias("qtd_registros"), F.sum(value).cast("double").alias("valor_por_status")))


def domain_values(df: DataFrame, col: str) -> DataFrame:
    """Q14: distinct values, case-sensitive."""
    return df.select(col).distinct()


def deviation_bands(df: DataFrame, value: Column, group_cols: Sequence[str],
                    bands=S.DEVIATION_BANDS) -> DataFrame:
    """Q15: value / group mean - 1 in labelled bands (first match wins,
    inclusive bounds); all bands listed, empty ones with 0. Rows matching no
    band are left out, as in the reference.

    The group mean is a partial aggregate joined back (no window over a
    possibly hot group); the band list is a bounded literal table.
    """
    spark = df.sparkSession
    base = df.select(*group_cols, value.alias("__v"))
    means = base.groupBy(*group_cols).agg((F.sum("__v").cast("double") / F.count("__v")).alias("__m"))
    v = base.join(runtime_sized(means), list(group_cols), "left")
    var = F.try_divide(F.col("__v").cast("double"), F.when(F.col("__m") != 0, F.col("__m"))) - 1
    label = F.lit(None).cast("string")
    for name, low, high in reversed(bands):
        if low is None:
            cond = var < high
        elif high is None:
            cond = var > low
        else:
            cond = var.between(low, high)
        label = F.when(cond, F.lit(name)).otherwise(label)
    banded = (v.select(label.alias("faixa"), F.col("__v"))
              .groupBy("faixa").agg(F.sum("__v").alias("valor"), F.count("faixa").alias("registros")))
    names = spark.createDataFrame([(b[0],) for b in bands], "faixa_nome string")
    # the band list is preserved; the banded aggregate has at most one row per
    # band (+ NULL), a fixed bound, so it is the broadcast build side
    out = F.broadcast(banded).join(names, F.col("faixa_nome") == F.col("faixa"), "right")
    return out.select("faixa_nome",
                      F.coalesce(F.col("valor"), F.lit(0)).cast("double").alias("valor_concentrado"),
                      F.coalesce(F.col("registros"), F.lit(0)).alias("registros"))


_SEP = "\u0001"
#: The fact that counts a table's rows.
ROWS = f"linhas{_SEP}*"


def profile_facts(cols: Sequence[str], rules: Mapping[str, Predicate] | None = None, rows: Column | None = None) -> dict[str, Column]:
    """The aggregates of a table's profile, for a scan (``profile``) or to be observed while the table is written;
    ``rows``: only rows for which it holds are counted."""
    rules = dict(rules or STANDARD_RULES)
    counted = (lambda c: c) if rows is None else (lambda c: rows & c)
    facts = {ROWS: F.count_if(counted(F.lit(True)))}
    return facts | {f"{r}{_SEP}{c}": F.count_if(counted(pred(c))) for r, pred in rules.items() for c in cols}


def profile_of(spark: SparkSession, seen: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """The profile (tabela, coluna, regra, qtd) of tables from the facts counted when they were written: no scan.
    The list is columns x rules long, never rows."""
    long = [(table, name.split(_SEP)[1], name.split(_SEP)[0], int(n)) for table, facts in seen.items() for name, n in facts.items() if _SEP in name]
    return spark.createDataFrame(long, "tabela string, coluna string, regra string, qtd long")


def profile(df: DataFrame, table: str, cols: Sequence[str] | None = None,
            rules: Mapping[str, Predicate] | None = None) -> DataFrame:
    """Q17: every rule on every column in ONE scan -> (tabela, coluna, regra, qtd)."""
    wide = df.agg(*[c.alias(name) for name, c in profile_facts(list(cols or df.columns), rules).items()])
    long = wide.unpivot([], wide.columns, "chave", "qtd")
    return long.select(F.lit(table).alias("tabela"),
                       F.split_part("chave", F.lit(_SEP), F.lit(2)).alias("coluna"),
                       F.split_part("chave", F.lit(_SEP), F.lit(1)).alias("regra"),
                       F.col("qtd").cast("long").alias("qtd"))
