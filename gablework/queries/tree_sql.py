"""Tree ensembles in SQL: the text is made level by level from a plan, for the tables whose features have few values.

``rows`` must give (f, k, y, fold, train, x0, x1, ...): one copy of the table per training set ``f``.
"""

from __future__ import annotations

from collections.abc import Sequence

from gablework.models.histogram import LEAST_GAIN, POISSON, Plan, columns_of, multiplier

# Fixed by the labels of ``sales``: they lie below 16, so the unit is 2 ** (4 - 30).
UNIT = 2.0 ** (4 - 30)
HASH = "CAST('0x' || substr(md5('rows:' || k), 1, 8) AS BIGINT)"


def uniform(plan: Plan, tree: int) -> str:
    return f"CAST((CAST(h AS HUGEINT) * {multiplier(plan.seed, tree)}) % 4294967296 AS DOUBLE) / 4294967296.0"


def weight(plan: Plan, tree: int) -> str:
    u = uniform(plan, tree)
    if plan.style == "forest":
        return "(" + " + ".join(f"CASE WHEN {u} >= {p!r} THEN 1 ELSE 0 END" for p in POISSON.tolist() if p < 1) + ")"
    return f"CASE WHEN {u} < {plan.row_share!r} THEN 1 ELSE 0 END" if plan.row_share < 1 else "1"


def score(g: str, h: str, plan: Plan) -> str:
    t = f"greatest(abs({g}) - {plan.l1 / UNIT!r}, 0.0)"
    return f"{t} * {t} / greatest({h} + {plan.l2!r}, 1e-300)"


def grown(name: str, plan: Plan, tree: str, columns: dict[int, list[int]], start: str) -> list[tuple[str, str]]:
    """The levels of trees that grow together; ``start`` gives (f, t, k, train, r, w, x...). Ends in ``<name>_end``."""
    everything = sorted({c for cs in columns.values() for c in cs})
    steps = [(f"{name}_0", f"SELECT *, 1 AS node, TRUE AS open FROM ({start})")]
    for level in range(plan.depth):
        at, of = f"{name}_{level}", f"{name}_b{level}"
        long = " UNION ALL ".join(
            f"SELECT f, t, node, {c} AS feature, x{c} AS v, r, w FROM {at} WHERE train AND open AND w > 0 AND t IN ({', '.join(str(t) for t, cs in columns.items() if c in cs)})"
            for c in everything
        )
        window = "OVER (PARTITION BY f, t, node, feature"
        steps.append((of, f"""SELECT * FROM (
  SELECT *, ({score('gl', 'hl', plan)} + {score('(g - gl)', '(h - hl)', plan)} - {score('g', 'h', plan)}) * {UNIT!r} * {UNIT!r} AS gain FROM (
    SELECT f, t, node, feature, v, {', '.join(f"sum({c}) {window} ORDER BY v) AS {c}l, sum({c}) {window}) AS {c}" for c in 'ghn')}
    FROM (SELECT f, t, node, feature, v, sum(r * w) AS g, CAST(sum(w) AS DOUBLE) AS h, CAST(count(*) AS DOUBLE) AS n FROM ({long}) GROUP BY ALL)))
WHERE gain > {LEAST_GAIN!r} AND n >= {plan.least_split} AND least(nl, n - nl) >= {max(plan.least_rows, 1)} AND least(hl, h - hl) >= {plan.least_weight!r}
QUALIFY row_number() OVER (PARTITION BY f, t, node ORDER BY gain DESC, feature, v) = 1"""))
        value = "CASE b.feature " + " ".join(f"WHEN {c} THEN x{c}" for c in everything) + " END"
        steps.append((f"{name}_{level + 1}", f"""SELECT a.* REPLACE (CASE WHEN b.node IS NULL THEN a.node ELSE 2 * a.node + CAST({value} > b.v AS INTEGER) END AS node,
  b.node IS NOT NULL AS open) FROM {at} a LEFT JOIN {of} b ON a.f = b.f AND a.t = b.t AND a.node = b.node AND a.open"""))
    leaves = f"SELECT f, t, node, sum(r * w) AS g, CAST(sum(w) AS DOUBLE) AS h FROM {name}_{plan.depth} WHERE train AND w > 0 GROUP BY ALL"
    steps.append((f"{name}_leaf", f"""SELECT f, t, node, h AS cover,
  sign(g) * greatest(abs(g) - {plan.l1 / UNIT!r}, 0.0) / greatest(h + {plan.l2!r}, 1e-300) * {UNIT!r} AS value FROM ({leaves})"""))
    steps.append((f"{name}_end", f"SELECT a.f, a.t, a.k, l.value FROM {name}_{plan.depth} a JOIN {name}_leaf l USING (f, t, node)"))
    return steps


def ensemble(name: str, plan: Plan, rows: str, features: int) -> list[tuple[str, str]]:
    """(name, text) of the steps; the last, ``name``, gives (f, k, pred)."""
    xs = ", ".join(f"x{c}" for c in range(features))
    whole = f"floor(y / {UNIT!r} + 0.5)"
    steps = [
        (f"{name}_base", f"SELECT f, CAST(sum(CAST({whole} AS HUGEINT)) AS DOUBLE) / count(*) * {UNIT!r} AS base FROM {rows} WHERE train GROUP BY f"),
        (f"{name}_p0", f"SELECT f, k, y, train, {HASH} AS h, {xs}, base AS pred FROM {rows} JOIN {name}_base USING (f)"),
    ]
    residual = f"floor((y - pred) / {UNIT!r} + 0.5) AS r"
    if plan.style == "forest":
        start = " UNION ALL ".join(f"SELECT f, {t} AS t, k, train, {residual}, {weight(plan, t)} AS w, {xs} FROM {name}_p0" for t in range(plan.trees))
        steps += grown(f"{name}_g", plan, "t", {t: columns_of(plan, t, features) for t in range(plan.trees)}, start)
        return [*steps, (name, f"SELECT e.f, e.k, sum((base + value) / {plan.trees}) AS pred FROM {name}_g_end e JOIN {name}_base USING (f) GROUP BY ALL")]
    for t in range(plan.trees):
        start = f"SELECT f, {t} AS t, k, train, {residual}, {weight(plan, t)} AS w, {xs} FROM {name}_p{t}"
        steps += grown(f"{name}_g{t}", plan, "t", {t: columns_of(plan, t, features)}, start)
        steps.append((f"{name}_p{t + 1}", f"SELECT p.* REPLACE (p.pred + {plan.rate!r} * e.value AS pred) FROM {name}_p{t} p JOIN {name}_g{t}_end e USING (f, k)"))
    return [*steps, (name, f"SELECT f, k, pred FROM {name}_p{plan.trees}")]


# Ensembles of any number of trees: a recursion over the rounds, whose text does not grow with them.

BATCH = 10  # trees of a forest that a round of the recursion grows


def hashed(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def spread(seed: str, tree: str) -> str:
    """``uniform`` for a tree's number in a column."""
    return f"CAST((CAST(h AS UBIGINT) * CAST({hashed(f"{seed} || ':' || {tree}")} | 1 AS UBIGINT)) & 4294967295 AS DOUBLE) / 4294967296.0"


def judged(rows: str, columns: Sequence[str], keys: str, rules: str) -> str:
    """The best split of each node. ``rows``: keys, node, x, r, w, of open nodes; ``columns``: where each feature may be used; ``rules``: a
    table by s with l1, l2, least_split, least_rows, least_weight."""
    window = f"OVER (PARTITION BY {keys}, node, feature"
    long = " UNION ALL ".join(f"SELECT {keys}, node, {c} AS feature, x{c} AS v, r, w FROM {rows} WHERE {used}" for c, used in enumerate(columns))

    def part(g: str, h: str) -> str:
        return f"power(greatest(abs({g}) - l1, 0.0), 2) / greatest({h} + l2, 1e-300)"

    return f"""SELECT * FROM (
  SELECT * EXCLUDE (l1, l2, least_split, least_rows, least_weight) FROM (
    SELECT *, ({part('gl', 'hl')} + {part('(g - gl)', '(h - hl)')} - {part('g', 'h')}) * {UNIT!r} * {UNIT!r} AS gain FROM (
      SELECT {keys}, node, feature, v, {', '.join(f"sum({c}) {window} ORDER BY v) AS {c}l, sum({c}) {window}) AS {c}" for c in 'ghn')}
      FROM (SELECT {keys}, node, feature, v, sum(r * w) AS g, CAST(sum(w) AS DOUBLE) AS h, CAST(count(*) AS DOUBLE) AS n FROM ({long}) GROUP BY ALL)) JOIN {rules} USING (s))
  WHERE gain > {LEAST_GAIN!r} AND n >= least_split AND least(nl, n - nl) >= least_rows AND least(hl, h - hl) >= least_weight)
QUALIFY row_number() OVER (PARTITION BY {keys}, node ORDER BY gain DESC, feature, v) = 1"""


def sent_on(rows: str, splits: str, keys: Sequence[str], features: int) -> str:
    value = "CASE b.feature " + " ".join(f"WHEN {c} THEN x{c}" for c in range(features)) + " END"
    same = " AND ".join(f"a.{k} = b.{k}" for k in [*keys, "node"])
    return f"SELECT a.* REPLACE (CASE WHEN b.node IS NULL THEN a.node ELSE 2 * a.node + CAST({value} > b.v AS INTEGER) END AS node) FROM {rows} a LEFT JOIN {splits} b ON {same}"


def best_first(depth: int) -> list[tuple[str, str]]:
    """``kept``: the node where each end of the trees lies once best-first growth has stopped at ``leaves`` leaves. The order in which it
    takes the nodes: by the least gain on the way from the root, then by the least one below that node, and so on."""
    steps = [("n0", "SELECT s, node, [-gain] AS way FROM b0")]
    steps += [
        (f"n{i}", f"SELECT b.s, b.node, list_append(list_filter(p.way, lambda x: x > -b.gain), -b.gain) AS way FROM b{i} b JOIN n{i - 1} p ON p.s = b.s AND p.node = b.node // 2")
        for i in range(1, depth)
    ]
    every = " UNION ALL ".join(f"SELECT * FROM n{i}" for i in range(depth))
    steps.append(("chosen", f"SELECT n.s, n.node FROM ({every}) n JOIN now USING (s) QUALIFY row_number() OVER (PARTITION BY n.s ORDER BY way, n.node) < any_value(leaves) OVER (PARTITION BY n.s)"))
    steps.append(("kept", f"""SELECT e.s, e.node, any_value(e.node >> CAST(d - taken AS INTEGER)) AS stop FROM (
  SELECT e.s, e.node, any_value(d) AS d, count(c.node) AS taken FROM (SELECT DISTINCT s, node, CAST(floor(log2(node)) AS INTEGER) AS d FROM a{depth}) e
  JOIN range({depth + 1}) l(i) ON l.i <= d LEFT JOIN chosen c ON c.s = e.s AND l.i < d AND c.node = e.node >> CAST(d - l.i AS INTEGER) GROUP BY e.s, e.node) e GROUP BY e.s, e.node"""))
    return steps


def boosted_together(name: str, plans: Sequence[Plan], rows: str, features: int) -> list[tuple[str, str]]:
    """Boosted ensembles of any number of trees; the last step, ``name``, gives (m, f, k, pred), m the plan's number."""
    every, depth = range(features), max(p.depth for p in plans)
    limited = any(p.leaves and p.leaves < 2**p.depth for p in plans)
    whole = f"floor(y / {UNIT!r} + 0.5)"
    xs = ", ".join(f"x{c}" for c in every)
    rules = ", ".join(
        f"({m}, {p.trees}, {p.depth}, {p.rate!r}, {p.l1 / UNIT!r}, {p.l2!r}, {p.least_split}, {max(p.least_rows, 1)}, {p.least_weight!r}, {p.row_share!r}, "
        f"{max(1, int(p.column_share * features + 1e-9))}, {p.leaves or 2**p.depth}, {p.seed})"
        for m, p in enumerate(plans)
    )
    rank = {j: " + ".join(f"CAST(md5({_tree(i)}) < md5({_tree(j)}) AS INTEGER)" for i in every if i != j) or "0" for j in every}
    out = [
        (f"{name}_par", f"""SELECT row_number() OVER (ORDER BY m, f) AS s, * FROM (VALUES {rules}) t(m, trees, depth, rate, l1, l2, least_split, least_rows, least_weight, row_share, take, leaves, seed),
  (SELECT f, CAST(sum(CAST({whole} AS HUGEINT)) AS DOUBLE) / count(*) * {UNIT!r} AS base FROM {rows} WHERE train GROUP BY f)"""),
        (f"{name}_p0", f"SELECT 0 AS t, s, k, y, train, {HASH} AS h, {xs}, base AS pred FROM {rows} JOIN {name}_par USING (f)"),
    ]
    inner = [
        ("now", f"SELECT p.*, l.t, {', '.join(f'{rank[j]} < take AS u{j}' for j in every)} FROM {name}_par p, (SELECT max(t) AS t FROM loop) l WHERE l.t < trees"),
        ("a0", f"""SELECT s, k, train AND (row_share >= 1 OR {spread('seed', 't')} < row_share) AS used, depth, {', '.join(f'u{j}' for j in every)},
  floor((y - pred) / {UNIT!r} + 0.5) AS r, 1 AS w, {xs}, CAST(1 AS INTEGER) AS node FROM (SELECT * EXCLUDE (t) FROM loop) JOIN now USING (s)"""),
    ]
    for level in range(depth):
        inner.append((f"b{level}", judged(f"a{level}", [f"used AND depth > {level} AND node >= {2**level} AND u{j}" for j in every], "s", "now")))
        inner.append((f"a{level + 1}", sent_on(f"a{level}", f"b{level}", ["s"], features)))
    end = f"a{depth}"
    if limited:
        inner += [*best_first(depth), ("cut", f"SELECT a.* REPLACE (stop AS node) FROM {end} a JOIN kept USING (s, node)")]
        end = "cut"
    inner.append(("leaf", f"""SELECT s, node, rate * (sign(g) * greatest(abs(g) - l1, 0.0) / greatest(h + l2, 1e-300) * {UNIT!r}) AS value
  FROM (SELECT s, node, sum(r) AS g, CAST(count(*) AS DOUBLE) AS h FROM {end} WHERE used GROUP BY ALL) JOIN now USING (s)"""))
    body = f"WITH {with_steps(inner)} SELECT loop.t + 1, loop.s, loop.k, loop.y, loop.train, loop.h, {', '.join(f'loop.x{c}' for c in every)}, loop.pred + leaf.value FROM loop JOIN {end} e ON e.s = loop.s AND e.k = loop.k JOIN leaf ON leaf.s = e.s AND leaf.node = e.node"
    loop = f"WITH RECURSIVE loop(t, s, k, y, train, h, {xs}, pred) USING KEY (s, k) AS (SELECT * FROM {name}_p0 UNION ({body}))"
    return [*out, (name, f"{loop} SELECT m, f, k, pred FROM loop JOIN {name}_par USING (s)")]


def _tree(feature: int) -> str:
    return f"seed || ':' || l.t || ':{feature}'"


def forest_of_any_size(name: str, plan: Plan, rows: str, features: int) -> list[tuple[str, str]]:
    """The last step, ``name``, gives (f, k, pred); every feature may be used by every tree."""
    xs = ", ".join(f"x{c}" for c in range(features))
    whole = f"floor(y / {UNIT!r} + 0.5)"
    u = spread(f"'{plan.seed}'", "t")
    out = [
        (f"{name}_base", f"""SELECT f AS s, CAST(sum(CAST({whole} AS HUGEINT)) AS DOUBLE) / count(*) * {UNIT!r} AS base, {plan.l1 / UNIT!r} AS l1, {plan.l2!r} AS l2, {plan.least_split} AS least_split,
  {max(plan.least_rows, 1)} AS least_rows, {plan.least_weight!r} AS least_weight FROM {rows} WHERE train GROUP BY f"""),
        (f"{name}_p0", f"SELECT f AS s, k, train, {HASH} AS h, {xs}, floor((y - base) / {UNIT!r} + 0.5) AS r, base FROM {rows} JOIN {name}_base ON s = f"),
    ]
    weight = " + ".join(f"CAST(u >= {p!r} AS INTEGER)" for p in POISSON.tolist() if p < 1)
    inner = [
        ("a0", f"""SELECT s, k, t, r, CASE WHEN train THEN {weight} ELSE 0 END AS w, {xs}, CAST(1 AS INTEGER) AS node
  FROM (SELECT p.*, t, {u} AS u FROM {name}_p0 p, (SELECT max(n) AS n FROM loop) l, range({BATCH}) o(i), (SELECT l.n + o.i AS t) WHERE t < {plan.trees})"""),
    ]
    for level in range(plan.depth):
        inner.append((f"b{level}", judged(f"a{level}", [f"w > 0 AND node >= {2**level}"] * features, "s, t", f"{name}_base")))
        inner.append((f"a{level + 1}", sent_on(f"a{level}", f"b{level}", ["s", "t"], features)))
    inner.append(("leaf", f"""SELECT s, t, node, base + sign(g) * greatest(abs(g) - l1, 0.0) / greatest(h + l2, 1e-300) * {UNIT!r} AS value
  FROM (SELECT s, t, node, sum(r * w) AS g, CAST(sum(w) AS DOUBLE) AS h FROM a{plan.depth} WHERE w > 0 GROUP BY ALL) JOIN {name}_base USING (s)"""))
    inner.append(("grown", f"SELECT a.s, a.k, sum(value / {plan.trees}) AS value FROM a{plan.depth} a JOIN leaf USING (s, t, node) GROUP BY ALL"))
    body = f"WITH {with_steps(inner)} SELECT loop.n + {BATCH}, loop.s, loop.k, loop.total + value FROM loop JOIN grown ON grown.s = loop.s AND grown.k = loop.k"
    loop = f"WITH RECURSIVE loop(n, s, k, total) USING KEY (s, k) AS (SELECT 0, s, k, CAST(0 AS DOUBLE) FROM {name}_p0 UNION ({body}))"
    return [*out, (name, f"{loop} SELECT s AS f, k, total AS pred FROM loop")]


def whole_ensemble(name: str, plan: Plan, rows: str, features: int) -> list[tuple[str, str]]:
    """Like ``ensemble``, for any number of trees."""
    if plan.style == "forest":
        return forest_of_any_size(name, plan, rows, features)
    return [*boosted_together(f"{name}_all", [plan], rows, features), (name, f"SELECT f, k, pred FROM {name}_all")]


def with_steps(steps: Sequence[tuple[str, str]]) -> str:
    return ",\n".join(f"{name} AS MATERIALIZED ({text})" for name, text in steps)
