"""Linear models, stacking and attribution in SQL, written out for the models of the queries.

Like in ``tree_sql``, ``rows`` gives (f, k, y, fold, train, x0, x1, ...): one copy of the table per training set ``f``.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations
from math import factorial

Steps = list[tuple[str, str]]


def eliminated(name: str, n: int, source: str, key: str = "f") -> Steps:
    """Solves n equations a{i}_{j}, b{i} per key by elimination; the last step gives w0, w1, ..."""
    steps, at = [], source
    for p in range(n):
        rest = [i for i in range(n) if i != p]
        row = [f"a{p}_{j} / a{p}_{p} AS a{p}_{j}" for j in range(p + 1, n)] + [f"b{p} / a{p}_{p} AS b{p}"]
        others = [f"a{i}_{j} - a{i}_{p} * a{p}_{j} / a{p}_{p} AS a{i}_{j}" for i in rest for j in range(p + 1, n)]
        others += [f"b{i} - a{i}_{p} * b{p} / a{p}_{p} AS b{i}" for i in rest]
        steps.append((f"{name}_e{p}", f"SELECT * REPLACE ({', '.join(row + others)}) FROM {at}"))
        at = f"{name}_e{p}"
    return [*steps, (f"{name}_w", f"SELECT {key}, {', '.join(f'b{i} AS w{i}' for i in range(n))} FROM {at}")]


def ridge(name: str, rows: str, n: int, alpha: float, scale: bool = True) -> Steps:
    """The last step, ``name``, gives (f, k, pred)."""
    xs = range(n)
    iqr = [f"quantile_cont(x{i}, 0.75) - quantile_cont(x{i}, 0.25)" for i in xs]
    width = ", ".join(f"CASE WHEN {q} = 0 THEN 1 ELSE {q} END AS d{i}" if scale else f"1 AS d{i}" for i, q in enumerate(iqr))
    sums = [f"count(*) * covar_pop(x{i}, x{j}) / any_value(d{i}) / any_value(d{j}){f' + {alpha!r}' if i == j else ''} AS a{i}_{j}" for i in xs for j in xs]
    sums += [f"count(*) * covar_pop(x{i}, y) / any_value(d{i}) AS b{i}" for i in xs] + [f"avg(x{i}) AS m{i}, any_value(d{i}) AS d{i}" for i in xs]
    return [
        (f"{name}_d", f"SELECT f, {width} FROM {rows} WHERE train GROUP BY f"),
        (f"{name}_m", f"SELECT f, avg(y) AS my, {', '.join(sums)} FROM {rows} JOIN {name}_d USING (f) WHERE train GROUP BY f"),
        *eliminated(name, n, f"{name}_m"),
        (name, f"SELECT r.f, r.k, my + {' + '.join(f'w{i} / d{i} * (x{i} - m{i})' for i in xs)} AS pred FROM {rows} r JOIN {name}_m USING (f) JOIN {name}_w USING (f)"),
    ]


def one_feature(name: str, rows: str, alpha: float, l1_ratio: float) -> Steps:
    """Elastic net of x0 alone: a soft threshold."""
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    iqr = "quantile_cont(x0, 0.75) - quantile_cont(x0, 0.25)"
    return [
        (f"{name}_d", f"SELECT f, CASE WHEN {iqr} = 0 THEN 1 ELSE {iqr} END AS d FROM {rows} WHERE train GROUP BY f"),
        (f"{name}_m", f"SELECT f, any_value(d) AS d, avg(x0) AS mx, avg(y) AS my, var_pop(x0) / any_value(d) / any_value(d) AS a, covar_pop(x0, y) / any_value(d) AS b FROM {rows} JOIN {name}_d USING (f) WHERE train GROUP BY f"),
        (name, f"SELECT r.f, r.k, my + sign(b) * greatest(abs(b) - {l1!r}, 0) / (a + {l2!r}) / d * (x0 - mx) AS pred FROM {rows} r JOIN {name}_m USING (f)"),
    ]


# Training sets without an outer fold o and, but for j = -1, without an inner fold j as well.
NESTED = """SELECT o * 10 + j + 1 AS f, k, y, fold, inner_fold, o, fold <> o AND inner_fold <> j AS train, n AS x0, q AS x1, band AS x2
FROM (SELECT *, CAST('0x' || substr(md5('43:' || k), 1, 8) AS BIGINT) % 5 AS inner_fold FROM sales), range({lo}, {hi}) a(o), range(-1, 5) b(j)"""


def stacked(name: str, rows: str, bases: Sequence[str], alpha: float) -> Steps:
    """A ridge on the bases' predictions; gives (f, k, pred) for the sets with j = -1."""
    n = len(bases)
    inputs = ", ".join(f"p{i}.pred AS x{i}" for i in range(n))
    joins = " ".join(f"JOIN {b} p{i} ON p{i}.k = r.k AND p{i}.f = r.f" for i, b in enumerate(bases))
    mine = "r.f = o * 10 + CASE WHEN fold = o THEN 0 ELSE inner_fold + 1 END"
    return [
        (f"{name}_z", f"SELECT o * 10 AS f, r.k, y, fold, fold <> o AS train, {inputs} FROM {rows} r {joins} WHERE {mine}"),
        *ridge(name, f"{name}_z", n, alpha, scale=False),
    ]


# Attribution

def leaves(name: str, depth: int, trees: Sequence[str], features: int) -> Steps:
    """(f, t, leaf, value, lo0, hi0, c0, ...) of the trees grown as steps ``trees``: the leaf's limits and cover share by feature."""
    parts = []
    for t in trees:
        path = " UNION ALL ".join(
            f"SELECT l.f, l.t, l.node AS leaf, b.feature, b.v, (l.node >> (l.d - {i} - 1)) % 2 = 1 AS high, CASE WHEN (l.node >> (l.d - {i} - 1)) % 2 = 1 THEN (b.h - b.hl) / b.h ELSE b.hl / b.h END AS share "
            f"FROM (SELECT *, CAST(floor(log2(node)) AS INTEGER) AS d FROM {t}_leaf) l JOIN {t}_b{i} b ON b.f = l.f AND b.t = l.t AND l.d > {i} AND b.node = l.node >> (l.d - {i})"
            for i in range(depth)
        )
        sides = ", ".join(
            f"max(CASE WHEN feature = {j} AND high THEN v END) AS lo{j}, min(CASE WHEN feature = {j} AND NOT high THEN v END) AS hi{j}, coalesce(product(CASE WHEN feature = {j} THEN share END), 1) AS c{j}"
            for j in range(features)
        )
        parts.append(f"SELECT l.f, l.t, l.node AS leaf, l.value, p.* EXCLUDE (f, t, leaf) FROM {t}_leaf l JOIN (SELECT f, t, leaf, {sides} FROM ({path}) GROUP BY ALL) p ON p.f = l.f AND p.t = l.t AND p.leaf = l.node")
    return [(name, " UNION ALL ".join(parts))]


def met(j: int) -> str:
    return f"CASE WHEN x{j} > coalesce(lo{j}, -1e300) AND x{j} <= coalesce(hi{j}, 1e300) THEN 1.0 ELSE 0.0 END"


def attributed(name: str, rows: str, leaf_table: str, features: int, rate: float, background: bool) -> Steps:
    """(f, k, base, shap0, shap1, ...): every leaf's game over its features, summed. Without a condition a leaf is always met."""
    every = range(features)
    subsets = [s for n in range(features + 1) for s in combinations(every, n)]

    def unknown(known: Sequence[int]) -> str:
        rest = [j for j in every if j not in known]
        if background:
            return "p" + "".join(map(str, rest))
        return " * ".join(["1.0", *[f"c{j}" for j in rest]])

    def game(known: Sequence[int]) -> str:
        return " * ".join([unknown(known), *[f"m{j}" for j in known]])

    def value(i: int) -> str:
        terms = []
        for s in subsets:
            if i not in s:
                w = factorial(len(s)) * factorial(features - len(s) - 1) / factorial(features)
                terms.append(f"{w!r} * ({game(sorted({*s, i}))} - {game(s)})")
        return " + ".join(terms)

    marks = ", ".join(f"{met(j)} AS m{j}" for j in every)
    shares = ", ".join(f"avg({' * '.join(['1.0', *[f'm{j}' for j in s]])}) AS p{''.join(map(str, s))}" for s in subsets)
    steps: Steps = [(f"{name}_x", f"SELECT r.f, r.k, l.*, {marks} FROM {rows} r JOIN (SELECT * RENAME (f AS lf) FROM {leaf_table}) l ON l.lf = r.f")]
    source = f"{name}_x"
    if background:
        steps.append((f"{name}_s", f"SELECT f, t, leaf, {shares} FROM {name}_x GROUP BY ALL"))
        source = f"(SELECT * FROM {name}_x JOIN {name}_s USING (f, t, leaf))"
    columns = ", ".join(f"sum({rate!r} * value * ({value(i)})) AS shap{i}" for i in every)
    steps.append((name, f"SELECT f, k, sum({rate!r} * value * {unknown(())}) AS paid, {columns} FROM {source} GROUP BY ALL"))
    return steps
