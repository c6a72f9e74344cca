"""Exact quantiles whose memory does not grow with the data.

A median per group looks harmless, but the built-in exact aggregate holds all
distinct values of one group in one task. Here the values are first counted
per (group, value), which spreads a hot group over all tasks; only groups with
a proven number of distinct values reach the built-in aggregate. For the
others the place of the wanted ranks is bracketed by mergeable sketches, the
rows below a bracket are counted exactly, and only the counts of the values
inside it go on, split further until they are few. The sketch only proposes: a bracket that does not hold its
ranks is widened and tried again, so that the result is always exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gablework.shared import col, lookup_join, materialize, quoted, safe_join

DISTINCT_LIMIT = 1_000_000
SKETCH_K = 4096
SKETCH_STEPS = 400
SPLIT_STEPS = 64
SKETCH_SALTS = 128


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, value): the present values of several columns, one per row; ``column`` is a position."""
    wide = df.select(*[col(c) for c in by], *[col(c).cast("double").alias(f"__v_{i}") for i, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(i).alias("column"), F.col(f"__v_{i}").alias("value")) for i in range(len(columns))])
    return wide.select(*[col(c) for c in by], F.inline(pairs)).where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    distinct_limit: int = DISTINCT_LIMIT,
) -> DataFrame:
    """(by..., column, quantiles array<double>): exact, linearly interpolated.

    Missing values are skipped; a (group, column) without any value has no row.
    """
    keys = [*by, "column"]
    values = long_values(df, columns, by)
    sizes = F.array(
        *[F.struct(F.lit(i).alias("column"), F.approx_count_distinct(col(c)).alias("d")) for i, c in enumerate(columns)]
    )
    crowded = df.groupBy(*[col(c) for c in by]).agg(sizes.alias("__sizes")).select(*[col(c) for c in by], F.inline("__sizes"))
    crowded = crowded.where(F.col("d") > distinct_limit).select(*map(quoted, keys))
    if not crowded.take(1):
        found = _by_counts(values, keys, probs)
    else:
        heavy = materialize(crowded.withColumn("__heavy", F.lit(True)), "heavy-groups")
        tagged = lookup_join(values, heavy, keys, kept=True)
        light = tagged.where(F.col("__heavy").isNull()).drop("__heavy")
        rest = tagged.where(F.col("__heavy")).drop("__heavy")
        found = _by_counts(light, keys, probs).unionByName(_by_brackets(rest, keys, probs, distinct_limit))
    names = F.array(*[F.lit(c) for c in columns])
    return found.withColumn("column", F.get(names, F.col("column")))


def _by_counts(values: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """One count per distinct value, then a weighted exact percentile over the counts."""
    counted = values.groupBy(*map(quoted, keys), "value").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(*map(quoted, keys)).agg(
        F.percentile("value", [float(p) for p in probs], F.col("n")).alias("quantiles")
    )


def _sketch(rows: DataFrame, keys: Sequence[str], steps: int = SKETCH_STEPS) -> DataFrame:
    """(keys..., n, grid): equally spaced quantiles of one mergeable sketch per key, merged in two steps so
    that the partial sketches of a hot key do not all meet in one task."""
    cols = [quoted(k) for k in keys]
    parts = rows.withColumn("__salt", F.spark_partition_id() % SKETCH_SALTS).groupBy(*cols, "__salt").agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", F.lit(SKETCH_K)).alias("s")
    )
    whole = parts.groupBy(*cols).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("s", F.lit(SKETCH_K)).alias("s"))
    grid = F.array(*[F.lit(i / steps) for i in range(steps + 1)])
    return whole.select(*cols, "n", F.kll_sketch_get_quantile_double("s", grid).alias("grid"))


def _by_brackets(values: DataFrame, keys: Sequence[str], probs: Sequence[float], limit: int) -> DataFrame:
    limit = max(limit, 2)  # the two neighbours of a rank are never split further
    kcols = [quoted(k) for k in keys]
    tkeys = [*keys, "__q"]
    tcols = [quoted(k) for k in tkeys]

    # Wanted 0-based ranks per (key, prob): the two neighbours and the weight of the upper.
    sketches = materialize(_sketch(values, keys), "sketches")
    wanted = [F.struct(F.lit(i).alias("__q"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)]
    place = F.col("p") * (F.col("n") - 1)
    targets = (
        sketches.select(*kcols, "n", "grid", F.inline(F.array(*wanted)))
        .withColumn("r0", F.floor(place))
        .withColumn("w", place - F.floor(place))
        .withColumn("r1", F.col("r0") + (F.col("w") > 0).cast("long"))
    )
    margin = 1
    while True:
        counted, state = _narrow(values, keys, targets, margin)
        holds = F.coalesce((F.col("below") <= F.col("r0")) & (F.col("r1") < F.col("below") + F.col("inside")), F.lit(False))
        if not state.where(~holds).take(1):
            break
        margin *= 4

    # One distinct value inside the bracket is the answer; the others go on with ranks local to their bracket.
    single = F.col("least") == F.col("most")
    found = state.where(single).select(*tcols, F.col("least").alias("value"))
    targets = state.where(~single).select(
        *tcols, (F.col("r0") - F.col("below")).alias("r0"), (F.col("r1") - F.col("below")).alias("r1"), "w"
    )
    while True:
        crowded = counted.groupBy(*tcols).agg(F.count(F.lit(1)).alias("d")).where(F.col("d") > limit)
        if not crowded.take(1):
            break
        counted, targets = _split(counted, tkeys, targets)
    found = found.unionByName(_pick(counted, tkeys, targets))
    per_key = found.groupBy(*kcols).agg(F.sort_array(F.collect_list(F.struct("__q", "value"))).alias("q"))
    return per_key.select(*kcols, F.col("q.value").alias("quantiles"))


def _narrow(values: DataFrame, keys: Sequence[str], targets: DataFrame, margin: int) -> tuple[DataFrame, DataFrame]:
    """(counts of the values inside each bracket, what was counted per target) in one pass.

    A row adds one to the number of brackets that lie wholly above it, and one
    to its own value in each bracket that holds it. Both are combined before
    the shuffle. Rows below a bracket are those under at least as many brackets
    as start at or after it.
    """
    kcols = [quoted(k) for k in keys]
    tcols = [*kcols, "__q"]
    last = F.greatest(F.col("n") - 1, F.lit(1))
    low = F.floor(F.col("r0") / last * SKETCH_STEPS).cast("int") - margin
    high = F.ceil(F.col("r1") / last * SKETCH_STEPS).cast("int") + margin
    brackets = targets.select(
        *tcols, "r0", "r1", "w",
        F.when(low <= 0, F.lit(-math.inf)).otherwise(F.get("grid", low)).alias("lo"),
        F.when(high >= SKETCH_STEPS, F.lit(math.inf)).otherwise(F.get("grid", high)).alias("hi"),
    )
    packed = materialize(
        brackets.groupBy(*kcols).agg(F.collect_list(F.struct("__q", "r0", "r1", "w", "lo", "hi")).alias("b")), "brackets"
    )
    v = F.col("value")
    nothing = F.lit(None).cast("double")
    under = F.struct(F.lit(-1).alias("__q"), F.size(F.filter("b", lambda x: x["lo"] > v)).alias("under"), nothing.alias("value"))
    held = F.transform(
        F.filter("b", lambda x: (x["lo"] <= v) & (v <= x["hi"])),
        lambda x: F.struct(x["__q"].alias("__q"), F.lit(-1).alias("under"), v.alias("value")),
    )
    marks = lookup_join(values, packed, list(keys), "inner", kept=True).select(*kcols, F.inline(F.concat(F.array(under), held)))
    counts = materialize(marks.groupBy(*tcols, "under", "value").agg(F.count(F.lit(1)).alias("n")), "counts")
    counted = counts.where(F.col("__q") >= 0).drop("under")
    inside = counted.groupBy(*tcols).agg(
        F.sum("n").alias("inside"), F.min("value").alias("least"), F.max("value").alias("most")
    )
    steps = counts.where(F.col("__q") < 0).groupBy(*kcols).agg(F.collect_list(F.struct("under", "n")).alias("steps"))
    after = F.size(F.filter("b", lambda x: x["lo"] >= F.col("lo")))
    opened = packed.select(*kcols, "b", F.inline("b")).withColumn("after", after).drop("b")
    below = F.aggregate(
        F.filter("steps", lambda s: s["under"] >= F.col("after")), F.lit(0).cast("long"), lambda acc, s: acc + s["n"]
    )
    sized = safe_join(opened, steps, list(keys)).withColumn("below", below)
    state = safe_join(sized, inside, [*keys, "__q"], "left")
    return counted, materialize(state.select(*tcols, "r0", "r1", "w", "below", "inside", "least", "most"), "state")


def _split(counted: DataFrame, tkeys: Sequence[str], targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keep, per target, the one or two of about 64 equal shares of its distinct
    values that hold the wanted ranks. Shares of distinct values shrink every
    round, however often a single value repeats."""
    tcols = [quoted(k) for k in tkeys]
    grids = materialize(_sketch(counted, tkeys, SPLIT_STEPS).drop("n"), "sketches")
    bucket = F.size(F.filter("grid", lambda g: g < F.col("value")))
    placed = lookup_join(counted, grids, list(tkeys), "inner", kept=True).withColumn("bucket", bucket).drop("grid")
    shares = placed.groupBy(*tcols, "bucket").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*tcols).orderBy("bucket"))
    shares = shares.withColumn("upto", upto).withColumn("below", F.col("upto") - F.col("n")).drop("n")
    holding = safe_join(shares, targets, list(tkeys)).where(
        (F.col("upto") > F.col("r0")) & (F.col("below") <= F.col("r1"))
    )
    kept = holding.groupBy(*tcols).agg(
        F.min("bucket").alias("b0"), F.max("bucket").alias("b1"),
        *[(F.first(r) - F.min("below")).alias(r) for r in ("r0", "r1")], F.first("w").alias("w"),
    )
    kept = materialize(kept, "kept")
    rest = lookup_join(placed, kept.select(*tcols, "b0", "b1"), list(tkeys), "inner", kept=True)
    rest = rest.where(F.col("bucket").between(F.col("b0"), F.col("b1"))).select(*tcols, "value", "n")
    return materialize(rest, "inside"), kept.select(*tcols, "r0", "r1", "w")


def _pick(counted: DataFrame, tkeys: Sequence[str], targets: DataFrame) -> DataFrame:
    """Few distinct values per target are left: accumulate their counts, take the ranks."""
    tcols = [quoted(k) for k in tkeys]
    upto = F.sum("n").over(Window.partitionBy(*tcols).orderBy("value"))
    placed = safe_join(counted.withColumn("upto", upto), targets, list(tkeys))
    lower = F.min(F.when(F.col("upto") > F.col("r0"), F.col("value")))
    upper = F.min(F.when(F.col("upto") > F.col("r1"), F.col("value")))
    picked = placed.groupBy(*tcols).agg(lower.alias("a"), upper.alias("b"), F.first("w").alias("w"))
    value = F.col("a") * (1 - F.col("w")) + F.col("b") * F.col("w")
    return picked.select(*tcols, F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(value).alias("value"))


def quantile_rows(df: DataFrame, columns: Sequence[str], probs: Sequence[float], **kw) -> dict[str, list[float]]:
    """The quantiles of whole columns on the driver: one short row per column."""
    found = {r["column"]: list(r["quantiles"]) for r in quantiles(df, columns, probs, **kw).collect()}
    return {c: found.get(c, [None] * len(probs)) for c in columns}


def group_medians(df: DataFrame, value: str, by: Sequence[str], name: str = "median", **kw) -> DataFrame:
    """(by..., median): exact median per group."""
    return quantiles(df, [value], [0.5], by=by, **kw).select(
        *[col(c) for c in by], F.col("quantiles")[0].alias(name)
    )


def union_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], cell: str, unions: Sequence[Sequence[int]], distinct_limit: int = DISTINCT_LIMIT,
) -> list[dict[str, list[float]]]:
    """For each union of cells (values of an int column) the quantiles of every column, as by ``quantiles`` over its rows.

    All unions come from one table of counts per (column, value, cell): a rank is found in the running sums of the cells
    of a union. A column with more distinct values than the limit is left to ``quantiles``, once per union."""
    columns = list(columns)
    sizes = df.agg(*[F.approx_count_distinct(col(c)).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    crowded = [c for c, d in zip(columns, sizes) if d > distinct_limit]
    out: list[dict[str, list[float]]] = [{} for _ in unions]
    for c in crowded:
        for found, union in zip(out, unions):
            found |= quantile_rows(df.where(col(cell).isin(list(union))), [c], probs, distinct_limit=distinct_limit)
    light = [c for c in columns if c not in crowded]
    cells = sorted({c for u in unions for c in u})
    if not light or not cells:
        return out
    counts = [F.count_if(col(cell) == c).alias(f"n{c}") for c in cells]
    counted = materialize(long_values(df, light, [cell]).groupBy("column", "value").agg(*counts), "counts")
    totals = {r["column"]: r for r in counted.groupBy("column").agg(*[F.sum(f"n{c}").alias(f"n{c}") for c in cells]).collect()}
    w = Window.partitionBy("column").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    running = counted.select("column", "value", *[F.sum(f"n{c}").over(w).alias(f"n{c}") for c in cells])
    places, picks = [], []
    for u, union in enumerate(unions):
        upto = sum((F.col(f"n{c}") for c in union), F.lit(0).cast("long"))
        for q, p in enumerate(probs):
            place = {i: p * (max(sum(t[f"n{c}"] for c in union), 1) - 1) for i, t in totals.items()}
            places.append((u, q, place))
            low = F.create_map(*[F.lit(v) for i, x in place.items() for v in (i, int(x))])[F.col("column")] if place else F.lit(0)
            high = F.create_map(*[F.lit(v) for i, x in place.items() for v in (i, math.ceil(x))])[F.col("column")] if place else F.lit(0)
            picks += [F.min(F.when(upto > low, F.col("value"))), F.min(F.when(upto > high, F.col("value")))]
    for r in running.groupBy("column").agg(*[p.alias(f"p{i}") for i, p in enumerate(picks)]).collect():
        for i, (u, _, place) in enumerate(places):
            a, b = r[f"p{2 * i}"], r[f"p{2 * i + 1}"]
            x = place[r["column"]] - int(place[r["column"]])
            out[u].setdefault(light[r["column"]], []).append(a if a == b or a is None else a * (1 - x) + b * x)
    for found in out:
        for c in columns:
            found.setdefault(c, [None] * len(probs))
    return out
