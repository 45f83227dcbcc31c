"""Projections, filters and cleaning of booking-like frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staymill import schema as S


def drop_leakage(df: DataFrame) -> DataFrame:
    """Drop the columns that give the target away; absent ones are ignored."""
    return df.drop(*S.LEAKAGE_COLUMNS)


def _has(df: DataFrame, *cols: str) -> bool:
    return set(cols) <= set(df.columns)


def _zero(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(0))


def has_guests() -> Column:
    return _zero("adults") + _zero("children") + _zero("babies") > 0


def has_nights() -> Column:
    return _zero("stays_in_week_nights") + _zero("stays_in_weekend_nights") > 0


def sane_adr() -> Column:
    """A null rate is kept: only a known bad rate removes a row."""
    adr = F.col("adr")
    return F.coalesce(~((adr < 0) | (adr >= S.ADR_MAX)), F.lit(True))


def _rules(df: DataFrame) -> dict[str, Column]:
    rules = {
        "no_guests": (("adults", "children", "babies"), has_guests()),
        "no_nights": (("stays_in_week_nights", "stays_in_weekend_nights"), has_nights()),
        "bad_adr": (("adr",), sane_adr()),
    }
    return {name: keep for name, (cols, keep) in rules.items() if _has(df, *cols)}


def filter_guests(df: DataFrame) -> DataFrame:
    return df.where(has_guests())


def filter_nights(df: DataFrame) -> DataFrame:
    return df.where(has_nights())


def filter_adr(df: DataFrame) -> DataFrame:
    return df.where(sane_adr())


def clean(df: DataFrame) -> DataFrame:
    """Drop leakage columns, then keep rows that pass every rule whose columns exist."""
    out = drop_leakage(df)
    for keep in _rules(df).values():
        out = out.where(keep)
    return out


def clean_audit(df: DataFrame) -> DataFrame:
    """Rows hit per rule, rows removed by all rules together, share removed, rows left: one pass."""
    rules = _rules(df)
    kept = F.lit(True)
    for keep in rules.values():
        kept = kept & keep
    n, removed = F.count(F.lit(1)), F.count_if(~kept)
    return df.agg(
        *[F.count_if(~keep).alias(name) for name, keep in rules.items()],
        removed.alias("removed"),
        F.when(n > 0, removed / n).alias("removed_share"),
        (n - removed).alias("left"),
    )


def feature_target(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Target as int in front, every other column a feature."""
    return df.select(F.col(target).cast("int").alias(target), *[c for c in df.columns if c != target])


def inference_prep(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Never removes a row."""
    return df.drop(target)


def normalise_names(df: DataFrame) -> DataFrame:
    """Lower case, unit in brackets removed, runs of blanks to one underscore."""
    import re

    return df.toDF(*[re.sub(r"\s+", "_", re.sub(r"\s*[(\[].*?[)\]]", "", c).strip().lower()) for c in df.columns])


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(subset) if subset else None)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def select_kinds(df: DataFrame, kind: str) -> DataFrame:
    """Columns of one kind: number, text or bool."""
    kinds = {"number": T.NumericType, "text": T.StringType, "bool": T.BooleanType}
    return df.select(*[f.name for f in df.schema if isinstance(f.dataType, kinds[kind])])


def replace_values(df: DataFrame, mapping: Mapping, columns: Sequence[str]) -> DataFrame:
    return df.na.replace(dict(mapping), subset=list(columns))


def fill_nulls(df: DataFrame, values: Mapping) -> DataFrame:
    return df.na.fill(dict(values))


# --- Contract of one booking --------------------------------------------------


def violations() -> Column:
    """Codes of the rules that a booking breaks: missing:<column> or range:<column>."""
    codes = [F.when(F.col(c).isNull(), F.lit(f"missing:{c}")) for c in S.FEATURES]
    for c, low, high in S.RANGES:
        bad = F.lit(False)
        if low is not None:
            bad = bad | (F.col(c) < low)
        if high is not None:
            bad = bad | (F.col(c) > high)
        if low is not None or high is not None:
            codes.append(F.when(bad, F.lit(f"range:{c}")))
    return F.array_compact(F.array(*codes))


def validate_contract(df: DataFrame) -> DataFrame:
    """Append `violations`; a missing column counts as a missing value in every row."""
    for f in S.BOOKING_SCHEMA:
        if f.name in S.FEATURES and f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df.withColumn("violations", violations())


def payload_cast(df: DataFrame) -> DataFrame:
    """Cast each contract field to its type; a column that is not there takes the example value.

    A value that does not parse becomes null, which the contract check then reports."""
    out = {}
    for f in S.BOOKING_SCHEMA:
        if f.name in S.FEATURES:
            source = F.col(f.name) if f.name in df.columns else F.lit(S.EXAMPLE[f.name])
            present = df.schema[f.name].dataType if f.name in df.columns else None
            out[f.name] = source.try_cast(f.dataType) if isinstance(present, T.StringType) else source.cast(f.dataType)
    return df.withColumns(out)
