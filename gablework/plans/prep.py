"""A fitted preparation plan: fit reads the data, transform is projection.

``PrepRecipe`` says what to do, ``PrepPlan`` holds what was learnt: modes,
group statistics, the columns to log, classes and categories. A plan is plain
literals and, for very many groups, tables; it can be saved as a whole, gives the same output for any subset of rows,
and therefore applies to a stream as well.

The order is part of the meaning: fill, log the skewed columns, derive new
columns (from logged values), encode, cast.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.operators import encode, impute
from gablework.operators.quantile import group_medians
from gablework.operators.rows import remove_above, union_split
from gablework.shared import (
    BROADCAST_BYTES, BROADCAST_ROWS, col, is_small, local_frame, lookup_join, materialize, numeric_columns, quoted, safe_join, string_columns,
)

SPLIT = "split"


@dataclass
class PrepRecipe:
    key: str
    target: str | None = None
    drop: list[str] = field(default_factory=list)
    outlier_column: str | None = None
    outlier_threshold: float = 0.0
    fill_text: dict[str, str] = field(default_factory=dict)
    fill_number: dict[str, float] = field(default_factory=dict)
    group_median: dict[str, str] = field(default_factory=dict)  # value column -> group column
    group_mode: dict[str, str] = field(default_factory=dict)
    global_mode: list[str] = field(default_factory=list)
    skew_threshold: float | None = 0.75
    derive: list[tuple[str, str]] = field(default_factory=list)  # name, SQL expression
    ordinal: dict[str, dict[str, float]] = field(default_factory=dict)
    labels: list[str] = field(default_factory=list)
    one_hot: list[str] | None = None  # None: every text column that is left
    null_key: str = "keep"
    fit_scope: str = "union"  # or "train"


@dataclass
class PrepPlan:
    recipe: PrepRecipe
    modes: dict[str, str] = field(default_factory=dict)
    skewed: list[str] = field(default_factory=list)
    classes: dict[str, list[str]] = field(default_factory=dict)
    categories: dict[str, list[str]] = field(default_factory=dict)
    # per filled column: the rows (group, statistic), or the folder of a table too large for that
    stats: dict[str, dict] = field(default_factory=dict)
    # per label column with too many classes for literals: the folder of a table (value, code)
    ranks: dict[str, dict] = field(default_factory=dict)

    # Fitting

    @classmethod
    def fit(cls, df: DataFrame, recipe: PrepRecipe, literals: int = encode.MAX_CATEGORIES, groups: int = BROADCAST_ROWS) -> PrepPlan:
        """``literals``: most classes of a label column that are kept in the plan itself, ``groups``: most rows of a group
        table; beyond them a table is kept beside the plan. One-hot columns are bounded: ``operators.sparse`` takes any number."""
        if recipe.fit_scope not in ("union", "train"):
            raise ValueError("fit_scope is 'union' or 'train'")
        data = df.where(col(SPLIT) == "train") if recipe.fit_scope == "train" and SPLIT in df.columns else df
        plan = cls(recipe)
        modes = impute.global_modes(data, recipe.global_mode) if recipe.global_mode else {}
        plan.modes = {c: m for c, m in modes.items() if m is not None}
        for c, g in recipe.group_median.items():
            plan.stats[c] = _keep_table(group_medians(data, c, [g], "stat").where(F.col("stat").isNotNull()), groups)
        for c, g in recipe.group_mode.items():
            plan.stats[c] = _keep_table(impute.group_modes(data, c, [g], "stat").where(F.col("stat").isNotNull()), groups)
        filled = plan._fill(data)
        if recipe.skew_threshold is not None:
            plan.skewed = encode.skewed_columns(filled, recipe.skew_threshold, plan._features(numeric_columns(filled)))
        ready = plan._derive(plan._log(filled))
        hot = recipe.one_hot
        if hot is None:
            used = {*recipe.labels, *recipe.ordinal}
            hot = [c for c in plan._features(string_columns(ready)) if c not in used]
        texts = ready.select(*[encode.text_of(col(c)).alias(c) for c in recipe.labels], *[col(c) for c in hot])
        if not texts.columns:
            return plan
        values = encode.value_table(texts, texts.columns)
        sizes = {r["column"]: r for r in values.groupBy("column").agg(F.count("value").alias("n"), F.sum(F.octet_length("value")).alias("size")).collect()}
        small = [c for c in texts.columns if c not in sizes or (sizes[c]["n"] <= literals and sizes[c]["size"] <= BROADCAST_BYTES)]
        wide = [c for c in hot if c not in small]
        if wide:
            raise ValueError(f"more than {literals} categories in {wide}: encode them as sparse rows")
        found = encode.sorted_texts(values, small)
        plan.classes = {c: found[c] for c in recipe.labels if c in found}
        plan.categories = {c: found[c] for c in hot}
        for c in recipe.labels:
            if c not in found:
                plan.ranks[c] = _keep_table(encode.ranked_values(values.where(F.col("column") == c).select("value")), 0)
        return plan

    # Applying

    def transform(self, df: DataFrame) -> DataFrame:
        """key, split and target as they are, then every feature as double."""
        coded = self._encode(self._derive(self._log(self._fill(df))))
        kept = [quoted(c) for c in coded.columns if c in self._edges()]
        names = [quoted(c) for c in coded.columns if c not in self._edges()]
        return coded.selectExpr(*kept, *[f"CAST({c} AS DOUBLE) AS {c}" for c in names])

    def feature_names(self, df: DataFrame) -> list[str]:
        return [c for c in self.transform(df).columns if c not in self._edges()]

    def _edges(self) -> set[str]:
        return {c for c in (self.recipe.key, self.recipe.target, SPLIT) if c}

    def _features(self, columns: Sequence[str]) -> list[str]:
        return [c for c in columns if c not in self._edges()]

    def _fill(self, df: DataFrame) -> DataFrame:
        r = self.recipe
        touched = {*r.fill_text, *r.fill_number, *r.group_median, *r.group_mode, *self.modes}
        extra = [f"__stat_{c}" for c in (*r.group_median, *r.group_mode)]
        for c, g in {**r.group_median, **r.group_mode}.items():
            stats = _load_table(df, self.stats[c]).select(col(g), F.col("stat").alias(f"__stat_{c}"))
            small = self.stats[c].get("rows") is not None
            df = safe_join(df, F.broadcast(stats) if small else stats, [g], "left")

        def filled(c: str) -> Column:
            x = col(c)
            kind = df.schema[c].dataType
            if c in r.fill_text:
                x = F.coalesce(x, F.lit(r.fill_text[c]))
            if c in r.fill_number:
                x = F.coalesce(x, F.lit(r.fill_number[c]).cast(kind))
            for group in (r.group_median, r.group_mode):
                if c in group:
                    to = T.DoubleType() if group is r.group_median else kind
                    x = F.coalesce(x.cast(to), col(f"__stat_{c}").cast(to))
                    if r.null_key == "pandas":
                        x = F.when(col(group[c]).isNotNull(), x)
            if c in self.modes:
                x = F.coalesce(x, F.lit(self.modes[c]))
            return x

        return df.withColumns({c: filled(c) for c in df.columns if c in touched}).drop(*extra, *r.drop)

    def _log(self, df: DataFrame) -> DataFrame:
        return encode.log_columns(df, self.skewed) if self.skewed else df

    def _derive(self, df: DataFrame) -> DataFrame:
        return df.select("*", *[F.expr(e).alias(n) for n, e in self.recipe.derive]) if self.recipe.derive else df

    def _encode(self, df: DataFrame) -> DataFrame:
        maps = self.recipe.ordinal
        if maps:
            df = df.withColumns({c: encode.ordinal_code(col(c), m) for c, m in maps.items()})
        df = encode.apply_one_hot(encode.apply_labels(df, self.classes), self.categories)
        for c, kept in self.ranks.items():
            codes = _load_table(df, kept).select(F.col("value").alias("__text"), F.col("code").cast("int").alias("__code"))
            joined = lookup_join(df.withColumn("__text", encode.text_of(col(c))), codes, ["__text"], kept=True)
            df = joined.withColumn(c, F.col("__code")).select(*map(quoted, df.columns))
        return df

    # Keeping

    def to_json(self) -> str:
        """A plan of literals alone; one that has tables beside it is an error: ``save`` keeps them with it."""
        beside = [c for c, k in {**self.stats, **self.ranks}.items() if k["rows"] is None]
        if beside:
            raise ValueError(f"the tables of {beside} are no literals: save the plan")
        return self._json()

    def _json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> PrepPlan:
        data = json.loads(text)
        recipe = PrepRecipe(**data.pop("recipe"))
        recipe.derive = [tuple(d) for d in recipe.derive]
        return cls(recipe=recipe, **data)

    def save(self, spark, path: str) -> None:
        """One JSON row in a text table below ``path``, beside copies of the group tables that are no literals,
        so that the saved plan needs nothing else and any shared file system will do."""
        def copied(tables: dict[str, dict]) -> dict[str, dict]:
            out = dict(tables)
            for c, kept in tables.items():
                if kept["rows"] is None:
                    name = f"table-{uuid.uuid4().hex}"
                    spark.read.schema(T.StructType.fromJson(kept["schema"])).parquet(kept["path"]).write.parquet(f"{path}/{name}")
                    out[c] = {**kept, "path": name}
            return out

        text = replace(self, stats=copied(self.stats), ranks=copied(self.ranks))._json()
        local_frame(spark, [(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/plan")

    @classmethod
    def load(cls, spark, path: str) -> PrepPlan:
        plan = cls.from_json(spark.read.text(f"{path}/plan", wholetext=True).first()[0])
        for tables in (plan.stats, plan.ranks):
            tables.update({c: {**k, "path": f"{path}/{k['path']}"} for c, k in tables.items() if k["rows"] is None})
        return plan


def _keep_table(table: DataFrame, most: int) -> dict:
    """Literals while the table is small, else a table in the shared folder."""
    kept = materialize(table, "kept")
    schema = kept.schema.jsonValue()
    if is_small(kept, most):
        return {"schema": schema, "rows": [list(r) for r in kept.collect()]}
    return {"schema": schema, "rows": None, "path": kept.inputFiles()[0].rsplit("/", 1)[0]}


def _load_table(df: DataFrame, kept: dict) -> DataFrame:
    schema = T.StructType.fromJson(kept["schema"])
    if kept["rows"] is not None:
        return local_frame(df.sparkSession, [tuple(r) for r in kept["rows"]], schema)
    return df.sparkSession.read.schema(schema).parquet(kept["path"])


def prepare(train: DataFrame, test: DataFrame, recipe: PrepRecipe) -> tuple[DataFrame, PrepPlan]:
    """Outliers out of train, union, fit, transform: one table with a split column.

    Every fitting pass reads a few columns of the union, so it is written once
    in columns instead of parsing or joining the sources again each time.
    """
    if recipe.outlier_column:
        train = remove_above(train, recipe.outlier_column, recipe.outlier_threshold)
    both = materialize(union_split(train, test), "union")
    plan = PrepPlan.fit(both, recipe)
    return plan.transform(both), plan
