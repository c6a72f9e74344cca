"""Encoders and scalers. Fitting reads the data once; applying is a projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablework.functions import log1p_or_null
from gablework.operators.profile import skewness
from gablework.operators.quantile import quantile_rows
from gablework.shared import col, is_small, lookup_join, materialize, numeric_columns, quoted, string_columns

MAX_CATEGORIES = 10_000
MAX_LABELS = 1_000


# Skew

def skewed_columns(df: DataFrame, threshold: float = 0.75, columns: Sequence[str] | None = None) -> list[str]:
    """Numeric columns whose adjusted skewness lies above the threshold (right skew only), in table order."""
    columns = list(columns or numeric_columns(df))
    found = {r["column"] for r in skewness(df, columns).where(F.col("skew") > threshold).collect()}
    return [c for c in columns if c in found]


def log_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: log1p_or_null(col(c)) for c in columns})


def fix_skewness(df: DataFrame, threshold: float = 0.75, columns: Sequence[str] | None = None) -> DataFrame:
    return log_columns(df, skewed_columns(df, threshold, columns))


# Ordinal codes

def ordinal_code(x: Column, mapping: Mapping[str, float]) -> Column:
    """The mapped number; NULL for anything not in the mapping."""
    table = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    return F.try_element_at(table, x)


def ordinal_encode(df: DataFrame, columns: Sequence[str], mapping: Mapping[str, float]) -> DataFrame:
    return df.withColumns({c: ordinal_code(col(c), mapping) for c in columns})


# Label codes

def text_of(x: Column) -> Column:
    """Text of a value; a missing one becomes the text 'nan' and is a class of its own."""
    return F.coalesce(x.cast("string"), F.lit("nan"))


def value_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value): the distinct present texts of the columns, written."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns])
    return materialize(df.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct(), "values")


def sorted_texts(found: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """{column: texts in byte order} of a value table that is known to be small."""
    values: dict[str, list[str]] = {c: [] for c in columns}
    for r in found.where(F.col("column").isin(list(columns))).collect() if columns else ():
        values[r["column"]].append(r["value"])
    return {c: sorted(v, key=lambda s: s.encode()) for c, v in values.items()}


def distinct_values(df: DataFrame, columns: Sequence[str], limit: int) -> dict[str, list[str]] | None:
    """{column: sorted distinct present texts}, or ``None`` when they are more than ``limit`` in all, or too long."""
    found = value_table(df, columns)
    return sorted_texts(found, columns) if is_small(found, limit) else None


def label_classes(df: DataFrame, columns: Sequence[str], limit: int = MAX_LABELS) -> dict[str, list[str]] | None:
    return distinct_values(df.select(*[text_of(col(c)).alias(c) for c in columns]), columns, limit)


def rank_table(df: DataFrame, column: str) -> DataFrame:
    """(value, code) with code = position among the sorted distinct texts, for any number of them."""
    return ranked_values(df.select(text_of(col(column)).alias("value")).distinct())


def ranked_values(values: DataFrame) -> DataFrame:
    """(value, code) of distinct texts, in byte order.

    The sorted values are written once; a row's position is its place in its
    file part plus the sizes of the parts before, so nothing is gathered but
    one count per part.
    """
    marked = materialize(
        values.orderBy("value").withColumn("__id", F.monotonically_increasing_id()), "sorted"
    ).withColumn("__part", F.shiftright("__id", 33).cast("int"))
    sizes = marked.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).orderBy("__part").collect()
    offsets, total = [], 0
    for r in sizes:
        offsets.append((r["__part"], total))
        total += r["n"]
    starts = values.sparkSession.createDataFrame(offsets, "__part int, __start long")
    return marked.join(F.broadcast(starts), "__part").select(
        "value", (F.col("__start") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))).alias("code")
    )


def label_encode(df: DataFrame, columns: Sequence[str], limit: int = MAX_LABELS) -> DataFrame:
    """Code = rank among the sorted distinct texts (byte order), starting at 0."""
    classes = label_classes(df, columns, limit)
    if classes is not None:
        return apply_labels(df, classes)
    out = df
    for c in columns:
        keyed = out.withColumn("__text", text_of(col(c)))
        joined = lookup_join(keyed, rank_table(df, c).withColumnRenamed("value", "__text"), ["__text"])
        out = joined.withColumn(c, F.col("code").cast("int")).select(*map(quoted, df.columns))
    return out


def apply_labels(df: DataFrame, classes: Mapping[str, Sequence[str]]) -> DataFrame:
    """Codes from fixed classes; a text that was not seen when fitting becomes NULL."""

    def code(c: str) -> Column:
        if not classes[c]:
            return F.lit(None).cast("int")
        place = F.array_position(F.array(*[F.lit(v) for v in classes[c]]), text_of(col(c)))
        return F.nullif(place, F.lit(0)).cast("int") - 1

    return df.withColumns({c: code(c) for c in classes})


# One-hot

def categories(df: DataFrame, columns: Sequence[str] | None = None, limit: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """{column: sorted values} for one-hot encoding. More than ``limit`` new columns is an error, never a cut."""
    columns = list(columns or string_columns(df))
    if not columns:
        return {}
    found = distinct_values(df, columns, limit)
    if found is None:
        raise ValueError(f"more than {limit} categories in {columns}: not a one-hot case")
    return found


def one_hot_columns(cats: Mapping[str, Sequence[str]]) -> list[tuple[str, Column]]:
    return [(f"{c}_{v}", col(c).eqNullSafe(F.lit(v)).cast("int")) for c, values in cats.items() for v in values]


def apply_one_hot(df: DataFrame, cats: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace each text column by one 0/1 column per category; unseen and missing values give all zeros."""
    return df.select("*", *[e.alias(n) for n, e in one_hot_columns(cats)]).drop(*cats)


def one_hot(df: DataFrame, columns: Sequence[str] | None = None, limit: int = MAX_CATEGORIES) -> DataFrame:
    return apply_one_hot(df, categories(df, columns, limit))


# Robust scaling

def robust_params(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """{column: (median, IQR)}; an IQR of zero, or of an empty column, counts as one."""
    q = quantile_rows(df, columns, [0.25, 0.5, 0.75])
    return {
        c: (m if m is not None else 0.0, (b - a) if m is not None and b > a else 1.0) for c, (a, m, b) in q.items()
    }


def scaled(c: str, params: tuple[float, float]) -> Column:
    return (col(c).cast("double") - F.lit(float(params[0]))) / F.lit(float(params[1]))


def apply_scale(df: DataFrame, params: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: scaled(c, p) for c, p in params.items()})


def robust_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return apply_scale(df, robust_params(df, columns))
