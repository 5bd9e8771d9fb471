"""A small fact table per applicant and fixed ensembles on it, for the checks of the model operators, and their SQL.

All values are whole numbers, so that sums, thresholds and comparisons are the same in every engine.
"""

from riskloom.operators.extra_trees import MODULUS

COLUMNS = ("quota", "overdraft", "credit_score", "orders", "finished", "amount", "cards", "debit", "regions")

SQL = """
SELECT t.id, t.target, t.appl_sbm_tm, COALESCE(c.quota, CAST(0 AS DOUBLE)) AS quota,
  COALESCE(c.overdraft, CAST(0 AS DOUBLE)) AS overdraft, COALESCE(c.credit_score, CAST(0 AS DOUBLE)) AS credit_score,
  CAST(COALESCE(o.n, 0) AS DOUBLE) AS orders, CAST(COALESCE(o.finished, 0) AS DOUBLE) AS finished,
  CAST(COALESCE(o.amount, 0) AS DOUBLE) AS amount, CAST(COALESCE(b.n, 0) AS DOUBLE) AS cards,
  CAST(COALESCE(b.debit, 0) AS DOUBLE) AS debit, CAST(COALESCE(r.n, 0) AS DOUBLE) AS regions
FROM {target} t LEFT JOIN {credit_info} c ON c.id = t.id
LEFT JOIN (SELECT id, COUNT(*) AS n, SUM(CASE WHEN sts_order LIKE '%完成%' THEN 1 ELSE 0 END) AS finished,
    SUM(CASE WHEN amt_order <> 'null' THEN FLOOR(unit_price / 100000) END) AS amount FROM {order_info} GROUP BY id) o ON o.id = t.id
LEFT JOIN (SELECT id, COUNT(*) AS n, SUM(CASE WHEN card_type = '储蓄卡' THEN 1 ELSE 0 END) AS debit
    FROM {bankcard_info} GROUP BY id) b ON b.id = t.id
LEFT JOIN (SELECT id, COUNT(DISTINCT region) AS n FROM {recieve_addr_info} GROUP BY id) r ON r.id = t.id"""

_TABLES = ("target", "credit_info", "order_info", "bankcard_info", "recieve_addr_info")
ORACLE = SQL.format(**{t: t for t in _TABLES})

# (round, weight, node, feature, threshold, left, right, gain, prediction): two boosted trees and a root without splits.
ENSEMBLE = (
    (1, 1.0, 0, 0, 4000.0, 1, 4, 0.5, 0.0), (1, 1.0, 1, 3, 9.0, 2, 3, 0.25, 0.0), (1, 1.0, 2, None, None, None, None, None, -0.75),
    (1, 1.0, 3, None, None, None, None, None, 0.25), (1, 1.0, 4, None, None, None, None, None, 0.5),
    (2, 0.125, 0, 6, 30.0, 1, 2, 0.125, 0.0), (2, 0.125, 1, None, None, None, None, None, -1.0),
    (2, 0.125, 2, 2, 50.0, 3, 4, 0.0625, 0.0), (2, 0.125, 3, 5, 1000.0, 5, 6, 0.03125, 0.0),
    (2, 0.125, 4, None, None, None, None, None, 0.875), (2, 0.125, 5, None, None, None, None, None, -0.5),
    (2, 0.125, 6, None, None, None, None, None, 0.375), (3, 0.0625, 0, None, None, None, None, None, 1.5),
)


def facts(spark, tables):
    return spark.sql(SQL, **{t: tables[t] for t in _TABLES})


def _tree_case(rows, node=0):
    _, _, _, feature, threshold, left, right, _, prediction = rows[node]
    if feature is None:
        return f"CAST({prediction} AS DOUBLE)"
    return (f"CASE WHEN {COLUMNS[feature]} <= {threshold} THEN {_tree_case(rows, left)} ELSE {_tree_case(rows, right)} END")


def margin_sql(rounds):
    """The margin after ``rounds`` rounds as nested cases."""
    trees = ({n[2]: n for n in ENSEMBLE if n[0] == r} for r in range(1, rounds + 1))
    return " + ".join(f"CAST({rows[0][1]} AS DOUBLE) * {_tree_case(rows)}" for rows in trees)


def _draw(seed, names):
    """Named steps of the draw from three numbers; later ones use earlier ones."""
    tree, node, feature = names

    def mixed(v):
        return f"(({v} * (({v} * {v} + 7) % {MODULUS}) + 3) % {MODULUS})"

    return (f"CAST(({seed} * 48271 + {tree}) % {MODULUS} AS BIGINT) AS a{seed}, {mixed(f'a{seed}')} AS b{seed},"
            f" (b{seed} * 48271 + {node}) % {MODULUS} AS c{seed}, {mixed(f'c{seed}')} AS d{seed},"
            f" (d{seed} * 48271 + {feature}) % {MODULUS} AS e{seed}, {mixed(f'e{seed}')} AS draw{seed}")


def extra_trees_sql(trees, depth, per_node, seed=27):
    """Importances of a forest on the facts, level by level."""
    steps = []
    for k in range(depth):
        steps.append(f"""
f{k} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY t, node ORDER BY draw{seed}, f) AS place FROM
    (SELECT t, node, f, {_draw(seed, ("t", "node", "f"))}, {_draw(seed + 1, ("t", "node", "f"))}
     FROM (SELECT DISTINCT t, node FROM n{k}), range({len(COLUMNS)}) r(f))) WHERE place <= {per_node}),
r{k} AS (SELECT n.t, n.node, f.f, min(v) AS low, max(v) AS high, any_value((draw{seed + 1} + 0.5) / CAST({MODULUS} AS DOUBLE)) AS share
    FROM n{k} n JOIN f{k} f ON f.t = n.t AND f.node = n.node JOIN x ON x.id = n.id AND x.f = f.f GROUP BY n.t, n.node, f.f),
s{k} AS (SELECT n.t, n.node, r.f, any_value(low + share * (high - low)) AS cut, count(*) AS n, sum(y) AS p,
      count(*) FILTER (WHERE v <= low + share * (high - low)) AS nl, coalesce(sum(y) FILTER (WHERE v <= low + share * (high - low)), 0) AS pl
    FROM n{k} n JOIN r{k} r ON r.t = n.t AND r.node = n.node JOIN x ON x.id = n.id AND x.f = r.f GROUP BY n.t, n.node, r.f),
g{k} AS (SELECT *, CAST(2 AS DOUBLE) * p * (n - p) / n - CAST(2 AS DOUBLE) * pl * (nl - pl) / nl
      - CAST(2 AS DOUBLE) * (p - pl) * ((n - nl) - (p - pl)) / (n - nl) AS gain
    FROM s{k} WHERE nl > 0 AND nl < n AND p > 0 AND p < n),
b{k} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY t, node ORDER BY gain DESC, f) AS best FROM g{k}) WHERE best = 1),
n{k + 1} AS (SELECT n.t, n.id, n.y, 2 * n.node + CASE WHEN v > b.cut THEN 1 ELSE 0 END AS node
    FROM n{k} n JOIN b{k} b ON b.t = n.t AND b.node = n.node JOIN x ON x.id = n.id AND x.f = b.f)""")
    splits = " UNION ALL ".join(f"SELECT t, f, gain FROM b{k}" for k in range(depth))
    names = ", ".join(f"'{c}'" for c in COLUMNS)
    return f"""
SELECT * FROM (WITH facts AS MATERIALIZED ({ORACLE}),
x AS MATERIALIZED (SELECT id, unnest(range({len(COLUMNS)})) AS f, unnest([{", ".join(COLUMNS)}]) AS v FROM facts),
n0 AS (SELECT t, id, CAST(target AS BIGINT) AS y, CAST(1 AS BIGINT) AS node FROM facts, range({trees}) r(t)),{",".join(steps)},
u AS (SELECT t, f, sum(gain) AS gain FROM ({splits}) GROUP BY t, f),
h AS (SELECT f, gain / sum(gain) OVER (PARTITION BY t) AS share FROM u)
SELECT CAST(c.f AS INTEGER) AS position, ([{names}])[c.f + 1] AS feature,
  round(coalesce((SELECT sum(share) FROM h WHERE h.f = c.f), 0) / (SELECT count(DISTINCT t) FROM u), 9) AS score
FROM range({len(COLUMNS)}) c(f))"""


def moments_sql():
    names = (*COLUMNS, "target", "1")
    pairs = ", ".join(f"sum(CAST({a} AS DOUBLE) * {b})" for a in names for b in names)
    ones = ", ".join(f"'{a}'" for a in names for _ in names)
    others = ", ".join(f"'{b}'" for _ in names for b in names)
    return f"""
SELECT unnest([{ones}]) AS one, unnest([{others}]) AS other, unnest([{pairs}]) AS product FROM ({ORACLE})"""
