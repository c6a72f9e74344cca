"""One-hot features of any number of categories as sparse rows: no wide projection, one look-up per text column."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablework.operators.encode import ranked_values, value_table
from gablework.shared import col, lookup_join, materialize, quoted

SPARSE = "struct<indices:array<int>,values:array<double>>"


@dataclass
class SparseEncoder:
    """Numbers come first, then one place per (text column, category), by column and category."""

    numbers: list[str]
    texts: list[str]
    places: DataFrame  # (column, value, place), written
    width: int

    @classmethod
    def fit(cls, df: DataFrame, texts: Sequence[str], numbers: Sequence[str] = ()) -> SparseEncoder:
        values = value_table(df, list(texts))
        offset, parts = len(numbers), []
        for c, n in ((c, values.where(F.col("column") == c).count()) for c in texts):
            own = ranked_values(values.where(F.col("column") == c).select("value"))
            parts.append(own.select(F.lit(c).alias("column"), "value", (F.col("code") + F.lit(offset)).cast("int").alias("place")))
            offset += n
        places = parts[0]
        for p in parts[1:]:
            places = places.unionByName(p)
        return cls(list(numbers), list(texts), materialize(places, "places"), offset)

    def names(self) -> DataFrame:
        """(place, name): what each place stands for."""
        hot = self.places.select("place", F.concat_ws("_", "column", "value").alias("name"))
        plain = self.places.sparkSession.createDataFrame(list(enumerate(self.numbers)), "place int, name string")
        return plain.unionByName(hot)

    def transform(self, df: DataFrame, name: str = "features") -> DataFrame:
        """Adds the sparse row. Unseen and missing categories have no entry."""
        out = df
        for i, c in enumerate(self.texts):
            own = self.places.where(F.col("column") == c).select(F.col("value").alias(f"__v{i}"), F.col("place").alias(f"__p{i}"))
            out = lookup_join(out.withColumn(f"__v{i}", col(c).cast("string")), own, [f"__v{i}"])
        numbers = [F.struct(F.lit(i).alias("i"), col(c).cast("double").alias("v")) for i, c in enumerate(self.numbers)]
        hot = [F.struct(F.col(f"__p{i}").alias("i"), F.lit(1.0).alias("v")) for i in range(len(self.texts))]
        there = F.filter(F.array(*numbers, *hot), lambda e: e["i"].isNotNull() & (e["v"] != 0))
        return out.select(*map(quoted, df.columns), _packed(there).alias(name))


def _packed(entries: Column) -> Column:
    return F.struct(F.transform(entries, lambda e: e["i"]).alias("indices"), F.transform(entries, lambda e: e["v"]).alias("values"))
