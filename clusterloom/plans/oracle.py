"""The registered queries as plain SQL over the same tables, for checking results."""

from __future__ import annotations

EMB = "x AS MATERIALIZED (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS f, label FROM embeddings)"
LINE_KEY = "concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR))"
MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def line(measures=MEASURES, extra="") -> str:
    bounds = ", ".join(f"min({m}) AS lo_{m}, max({m}) AS hi_{m}" for m in measures)
    vec = ", ".join(f"({m} - lo_{m}) / (hi_{m} - lo_{m})" for m in measures)
    return f"bounds AS (SELECT {bounds} FROM lineitem), x AS MATERIALIZED (SELECT {LINE_KEY} AS id, [{vec}] AS f{extra} FROM lineitem, bounds)"


def uniform(id_, slot, seed) -> str:
    return f"(CAST(concat('0x', substr(md5(concat(CAST({id_} AS VARCHAR), ':{slot}:{seed}')), 1, 12)) AS UBIGINT) / 281474976710656.0)"


def order_hash(id_, seed) -> str:
    return f"md5(concat(CAST({id_} AS VARCHAR), ':{seed}'))"


def rnd(expr, places=4) -> str:
    return f"round({expr}, {places}) + 0.0"


def dist(a, b, metric="euclidean") -> str:
    if metric == "manhattan":
        return f"list_sum(list_transform(list_zip({a}, {b}), lambda z: abs(z[1] - z[2])))"
    return f"list_distance({a}, {b})"


def assign(name, centres, metric="euclidean") -> str:
    return f"{name} AS MATERIALIZED (SELECT x.id, arg_min(c.cl, {dist('x.f', 'c.f', metric)}) AS cl FROM x CROSS JOIN {centres} c GROUP BY x.id)"


def means(name, groups) -> str:
    return (
        f"{name} AS MATERIALIZED (SELECT cl, list(m ORDER BY pos) AS f FROM (SELECT cl, pos, avg(v) AS m FROM "
        f"(SELECT g.cl, unnest(x.f) AS v, generate_subscripts(x.f, 1) AS pos FROM x JOIN {groups} g ON g.id = x.id) GROUP BY cl, pos) GROUP BY cl)"
    )


def random_centres(name, k, seed) -> str:
    return (
        f"{name} AS MATERIALIZED (SELECT CAST(rn - 1 AS INTEGER) AS cl, f, id FROM (SELECT id, f, row_number() OVER (ORDER BY {order_hash('id', seed)}, id) AS rn FROM x) WHERE rn <= {k})"
    )


def lloyd(iters, metric="euclidean", start="c0") -> tuple[list[str], str, str]:
    """CTEs of a fixed number of rounds; names of the last assignment and the last centres."""
    ctes, centres = [], start
    for i in range(iters):
        ctes += [assign(f"a{i}", centres, metric), means(f"c{i + 1}", f"a{i}")]
        centres = f"c{i + 1}"
    return [*ctes, assign(f"a{iters}", centres, metric)], f"a{iters}", centres


def with_(*ctes) -> str:
    flat = []
    for c in ctes:
        flat += c if isinstance(c, list) else [c]
    return "WITH " + ",\n".join(flat) + "\n"


def centre_rows(name, places=4) -> str:
    return (
        f"SELECT CAST(cl AS INTEGER) AS cluster, CAST(pos - 1 AS INTEGER) AS pos, {rnd('v', places)} AS value FROM "
        f"(SELECT cl, unnest(f) AS v, generate_subscripts(f, 1) AS pos FROM {name})"
    )


# -- preparation

GAPPED = """g AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 7 <> 0 THEN p_retailprice END AS p_retailprice,
  CASE WHEN p_partkey % 11 = 0 THEN '?' WHEN p_partkey % 13 = 0 THEN 'junk' ELSE CAST(p_size AS VARCHAR) END AS p_size, 5 AS five,
  CASE WHEN p_partkey % 5 = 0 THEN '.' WHEN p_partkey % 17 = 0 THEN '' ELSE p_brand END AS p_brand,
  CASE WHEN p_partkey % 19 <> 0 THEN p_type END AS p_type FROM part)"""


def null_markers(c):
    return f"CASE WHEN {c} NOT IN ('?', '.', '') THEN {c} END AS {c}"


def mode_of(c, source):
    return f"(SELECT {c} FROM (SELECT {c}, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}) ORDER BY n DESC, {c} LIMIT 1)"


JUNK = """j AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN '?' WHEN c_custkey % 11 = 0 THEN 'nan' ELSE CAST(c_nationkey AS VARCHAR) END AS a,
  CASE WHEN c_custkey % 2 = 0 THEN 'x' ELSE CAST(c_nationkey AS VARCHAR) END AS b, c_mktsegment AS c FROM customer)"""


def _share(c):
    return (
        f"SELECT '{c}' AS name, round(avg(CASE WHEN try_cast({c} AS DOUBLE) IS NOT NULL AND NOT isnan(try_cast({c} AS DOUBLE)) THEN 1.0 ELSE 0.0 END), 6) AS share, "
        f"avg(CASE WHEN try_cast({c} AS DOUBLE) IS NOT NULL AND NOT isnan(try_cast({c} AS DOUBLE)) THEN 1.0 ELSE 0.0 END) > 0.5 AS is_numeric FROM j"
    )


# gapped part after typing and filling; brands in sorted order after the two numeric columns and the constant
PREPARED = GAPPED + f""",
t AS (SELECT id, p_retailprice, try_cast(p_size AS DOUBLE) AS p_size, {null_markers('p_brand')}, coalesce(p_type, 'nan') AS cls FROM g),
fills AS (SELECT median(p_retailprice) AS price, median(p_size) AS size FROM t),
full_t AS (SELECT id, cls, coalesce(p_retailprice, price) AS p_retailprice, coalesce(p_size, size) AS p_size, coalesce(p_brand, {mode_of('p_brand', 't')}) AS p_brand FROM t, fills),
b AS (SELECT min(p_retailprice) AS lp, max(p_retailprice) AS hp, min(p_size) AS ls, max(p_size) AS hs FROM full_t),
brands AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) + 2 AS position FROM (SELECT DISTINCT p_brand FROM full_t)),
classes AS (SELECT cls, row_number() OVER (ORDER BY cls) - 1 AS label FROM (SELECT DISTINCT cls FROM full_t)),
feats AS (
  SELECT id, cls, 0 AS position, (p_retailprice - lp) / (hp - lp) AS value FROM full_t, b
  UNION ALL SELECT id, cls, 1, (p_size - ls) / (hs - ls) FROM full_t, b
  UNION ALL SELECT id, cls, 2, 0.0 FROM full_t
  UNION ALL SELECT f.id, f.cls, br.position, CASE WHEN f.p_brand = br.p_brand THEN 1.0 ELSE 0.0 END FROM full_t f CROSS JOIN brands br)"""

PREP = {
    "prep_numeric_share": f"WITH {JUNK} " + " UNION ALL ".join(_share(c) for c in "abc"),
    "prep_null_markers": f"WITH {GAPPED} SELECT id, {null_markers('p_size')}, {null_markers('p_brand')}, {null_markers('p_type')} FROM g",
    "prep_median_impute": f"""WITH t AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 7 <> 0 THEN p_retailprice END AS p, CASE WHEN p_partkey % 5 <> 0 THEN p_size END AS s FROM part),
 m AS (SELECT median(p) AS mp, median(s) AS ms FROM t)
 SELECT id, {rnd('coalesce(p, mp)')} AS p_retailprice, {rnd('coalesce(CAST(s AS DOUBLE), ms)')} AS p_size FROM t, m""",
    "prep_mode_impute": f"""WITH t AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS segment, CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS nation FROM customer)
 SELECT id, coalesce(segment, {mode_of('segment', 't')}) AS segment, coalesce(nation, {mode_of('nation', 't')}) AS nation FROM t""",
    "prep_all_null_fallback": "SELECT c_custkey AS id, 'Missing' AS gone FROM customer",
    "prep_label_encode": """WITH t AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment ELSE 'nan' END AS cls FROM customer),
 codes AS (SELECT cls, row_number() OVER (ORDER BY cls) - 1 AS label FROM (SELECT DISTINCT cls FROM t)) SELECT id, CAST(label AS INTEGER) AS label FROM t JOIN codes USING (cls)""",
    "prep_minmax": f"""WITH b AS (SELECT min(p_size) AS ls, max(p_size) AS hs, min(p_retailprice) AS lp, max(p_retailprice) AS hp FROM part)
 SELECT p_partkey AS id, 0.0 AS five, {rnd('(p_size - ls) / CAST(hs - ls AS DOUBLE)', 6)} AS p_size, {rnd('(p_retailprice - lp) / (hp - lp)', 6)} AS p_retailprice FROM part, b""",
    "prep_onehot": """WITH t AS (SELECT c_custkey AS id, concat('n', CAST(c_nationkey AS VARCHAR)) AS nation, c_mktsegment AS segment FROM customer),
 long AS (SELECT id, 0 AS c, nation AS v FROM t UNION ALL SELECT id, 1, segment FROM t),
 codes AS (SELECT c, v, row_number() OVER (ORDER BY c, v) - 1 AS position FROM (SELECT DISTINCT c, v FROM long))
 SELECT id, CAST(position AS INTEGER) AS position, 1.0 AS value FROM long JOIN codes USING (c, v)""",
    "prep_assemble": f"""WITH b AS (SELECT min(p_size) AS ls, max(p_size) AS hs, min(p_retailprice) AS lp, max(p_retailprice) AS hp FROM part),
 brands AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) + 1 AS position FROM (SELECT DISTINCT p_brand FROM part))
 SELECT p_partkey AS id, CAST(0 AS INTEGER) AS position, {rnd('(p_size - ls) / CAST(hs - ls AS DOUBLE)', 6)} AS value FROM part, b
 UNION ALL SELECT p_partkey, 1, {rnd('(p_retailprice - lp) / (hp - lp)', 6)} FROM part, b
 UNION ALL SELECT p_partkey, CAST(br.position AS INTEGER), CASE WHEN part.p_brand = br.p_brand THEN 1.0 ELSE 0.0 END FROM part CROSS JOIN brands br""",
    "prep_features": f"WITH {PREPARED} SELECT id, CAST(label AS INTEGER) AS label, CAST(position AS INTEGER) AS position, {rnd('value', 6)} AS value FROM feats JOIN classes USING (cls)",
    "prep_new_rows": f"""WITH b AS (SELECT min(p_size) AS ls, max(p_size) AS hs, median(p_size) AS ms FROM part),
 brands AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) AS position FROM (SELECT DISTINCT p_brand FROM part)),
 t AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 7 <> 0 THEN p_size END AS size, CASE WHEN p_partkey % 5 <> 0 THEN p_brand ELSE {mode_of('p_brand', 'part')} END AS brand FROM part)
 SELECT id, CAST(0 AS BIGINT) AS position, {rnd('(coalesce(CAST(size AS DOUBLE), ms) - ls) / CAST(hs - ls AS DOUBLE)', 6)} AS value FROM t, b
 UNION ALL SELECT id, CAST(br.position AS BIGINT), CASE WHEN brand = br.p_brand THEN 1.0 ELSE 0.0 END FROM t CROSS JOIN brands br""",
    "prep_drop_class": f"WITH {PREPARED} SELECT id, CAST(count(*) AS INTEGER) AS width, {rnd('sum(value)', 5)} AS total FROM feats GROUP BY id",
    "prep_nan_guard": "SELECT event_id AS id, CASE WHEN event_id % 7 = 0 THEN 0.0 ELSE value END AS a, value AS b FROM events",
    "sample_exact": f"SELECT id FROM (SELECT {LINE_KEY} AS id FROM lineitem) ORDER BY {order_hash('id', 42)}, id LIMIT 3000",
}

# lines as sparse rows: the number, then the flags, then the orders
GOODS = [
    f"t AS MATERIALIZED (SELECT {LINE_KEY} AS id, l_quantity AS q, l_returnflag AS flag, 'o' || l_orderkey AS goods, l_linestatus AS status FROM lineitem)",
    "b AS (SELECT min(q) AS lo, max(q) AS hi FROM t)",
    "flags AS (SELECT flag, row_number() OVER (ORDER BY flag) AS pos FROM (SELECT DISTINCT flag FROM t))",
    "orders_ AS (SELECT goods, row_number() OVER (ORDER BY goods) + (SELECT count(*) FROM flags) AS pos FROM (SELECT DISTINCT goods FROM t))",
    "states AS (SELECT status, row_number() OVER (ORDER BY status) - 1 AS label FROM (SELECT DISTINCT status FROM t))",
    "l AS MATERIALIZED (SELECT id, 0 AS pos, (q - lo) / (hi - lo) AS v FROM t, b WHERE q > lo UNION ALL SELECT id, pos, 1.0 FROM t JOIN flags USING (flag) UNION ALL SELECT id, pos, 1.0 FROM t JOIN orders_ USING (goods))",
]


def _sparse_rounds(k=3, seed=1, iters=2):
    out = [
        "nx AS MATERIALIZED (SELECT id, sum(v * v) AS xx FROM l GROUP BY id)",
        f"c0 AS MATERIALIZED (SELECT rn - 1 AS cl, pos, v FROM l JOIN (SELECT id, row_number() OVER (ORDER BY {order_hash('id', seed)}, id) AS rn FROM t) USING (id) WHERE rn <= {k})",
    ]
    for n in range(iters + 1):
        out += [
            f"cc{n} AS (SELECT cl, sum(v * v) AS cc FROM c{n} GROUP BY cl)",
            f"dp{n} AS (SELECT l.id, c.cl, sum(l.v * c.v) AS s FROM l JOIN c{n} c ON c.pos = l.pos GROUP BY l.id, c.cl)",
            f"d{n} AS (SELECT nx.id, cc.cl, xx + cc - 2 * coalesce(s, 0) AS d FROM nx CROSS JOIN cc{n} cc LEFT JOIN dp{n} dp ON dp.id = nx.id AND dp.cl = cc.cl)",
            f"a{n} AS MATERIALIZED (SELECT id, arg_min(cl, {{'d': round(d, 9), 'cl': cl}}) AS cl, min(d) AS d FROM d{n} GROUP BY id)",
            f"c{n + 1} AS MATERIALIZED (SELECT a.cl, l.pos, sum(l.v) / any_value(n) AS v FROM l JOIN a{n} a ON a.id = l.id JOIN (SELECT cl, count(*) AS n FROM a{n} GROUP BY cl) z ON z.cl = a.cl GROUP BY a.cl, l.pos)",
        ]
    return out


PREP |= {
    "prep_wide": with_(GOODS) + f"SELECT l.id, CAST(label AS INTEGER) AS label, CAST(pos AS BIGINT) AS position, {rnd('v', 6)} AS value FROM l JOIN t ON t.id = l.id JOIN states USING (status)",
    "prep_many_classes": with_(GOODS[:1]) + "SELECT id, CAST(dense_rank() OVER (ORDER BY cls) - 1 AS INTEGER) AS label FROM (SELECT id, CASE WHEN q > 2 THEN goods ELSE 'nan' END AS cls FROM t)",
    "kmeans_wide": with_(GOODS, _sparse_rounds()) + "SELECT CAST(cl AS INTEGER) AS cluster, count(*) AS n, (SELECT round(sum(d), 4) FROM a2) AS inertia FROM a2 GROUP BY cl",
}

# -- distances

OWN_MEAN = with_(
    EMB,
    "m AS (SELECT label, list(v ORDER BY pos) AS m FROM (SELECT label, pos, avg(v) AS v FROM (SELECT label, unnest(f) AS v, generate_subscripts(f, 1) AS pos FROM x) GROUP BY label, pos) GROUP BY label)",
)


def _own(expr):
    return OWN_MEAN + f"SELECT x.id, {rnd(expr, 6)} AS value FROM x JOIN m USING (label)"


_DOT = "list_inner_product(f, m)"
_SQ = "(list_inner_product(f, f) + list_inner_product(m, m) - 2 * list_inner_product(f, m))"
DISTANCES = {
    "dist_sq_euclid": _own("pow(list_distance(f, m), 2)"), "dist_manhattan": _own(dist("f", "m", "manhattan")),
    "dist_euclid": _own("list_distance(f, m)"), "dist_cosine": _own("list_cosine_distance(f, m)"), "kernel_linear": _own(_DOT),
    "kernel_rbf": _own(f"exp(-{_SQ} / 64)"), "kernel_distance": _own(f"2 - 2 * exp(-{_SQ} / 64)"),
}

# -- K-Means

_LINE3 = [line(), random_centres("c0", 3, 1)]


def _line_inertia(metric):
    ctes, last, centres = lloyd(3, metric)
    d = dist("x.f", "c.f", metric)
    cost = d if metric == "manhattan" else f"pow({d}, 2)"
    return (
        with_(_LINE3, ctes) + f"SELECT '{metric}' AS metric, CAST(g.cl AS INTEGER) AS cluster, count(*) AS n, sum(sum({cost})) OVER () AS inertia "
        f"FROM x JOIN {last} g ON g.id = x.id JOIN {centres} c ON c.cl = g.cl GROUP BY g.cl"
    )


def _emb_kmeans(k, iters, metric):
    ctes, last, _ = lloyd(iters, metric)
    return with_(EMB, random_centres("c0", k, 7), ctes) + f"SELECT id, CAST(cl AS INTEGER) AS cluster FROM {last}"


def _converged(k, rounds=60, seed=3, tol=1e-4):
    """Rounds on one feature until the squared movement of the centres is below tol; clusters by number, so that a pass is one aggregate."""
    out = [f"p0 AS (SELECT row_number() OVER (ORDER BY {order_hash('id', seed)}, id) - 1 AS cl, v AS c FROM x QUALIFY cl < {k})"]
    for n in range(rounds):
        nearest = f"SELECT v, arg_min(p.cl, {{'d': round(abs(v - c), 12), 'cl': p.cl}}) AS cl, min((v - c) * (v - c)) AS d FROM u CROSS JOIN p{n} p GROUP BY v"
        out.append(f"g{n} AS MATERIALIZED (SELECT n.cl, sum(w) AS w, sum(w * n.v) AS s, sum(w * n.d) AS d FROM ({nearest}) n JOIN u ON u.v = n.v GROUP BY n.cl)")
        out.append(f"p{n + 1} AS MATERIALIZED (SELECT cl, s / w AS c FROM g{n})")
    moves = " UNION ALL ".join(f"SELECT {n + 1} AS r, sum((a.c - b.c) * (a.c - b.c)) AS moved, (SELECT sum(d) FROM g{min(n + 1, rounds - 1)}) AS cost FROM p{n} a JOIN p{n + 1} b USING (cl)" for n in range(rounds))
    return with_("x AS MATERIALIZED (SELECT event_id AS id, value / 100.0 AS v FROM events)", "u AS MATERIALIZED (SELECT v, count(*) AS w FROM x GROUP BY v)", out) + f"SELECT {k} AS k, CAST(r AS INTEGER) AS iterations, round(cost, 3) AS inertia FROM ({moves}) WHERE moved < {tol} ORDER BY r LIMIT 1"


KMEANS = {
    "kmeans_converged": " UNION ALL ".join(f"SELECT * FROM ({_converged(k)})" for k in (2, 3)),
    "kmeans_init": with_(EMB, random_centres("c0", 10, 7)) + "SELECT cl AS cluster, id FROM c0",
    "kmeans_euclid": _emb_kmeans(10, 3, "euclidean"), "kmeans_manhattan": _emb_kmeans(5, 2, "manhattan"),
    "kmeans_centres": with_(_LINE3, lloyd(3)[0]) + centre_rows("c3"),
    "kmeans_inertia": f"SELECT metric, cluster, n, round(inertia, 4) AS inertia FROM ({_line_inertia('euclidean')}) UNION ALL SELECT metric, cluster, n, round(inertia, 4) FROM ({_line_inertia('manhattan')})",
    "kmeans_predict": OWN_MEAN + "SELECT x.id, CAST(arg_min(m.label, list_distance(x.f, m.m)) AS INTEGER) AS cluster FROM x CROSS JOIN m GROUP BY x.id",
}

# -- farthest-pair start, k = 4

PAIR = "pair AS MATERIALIZED (SELECT a.id AS ia, b.id AS ib, a.f AS fa, b.f AS fb, list_distance(a.f, b.f) AS d FROM x a JOIN x b ON a.id < b.id ORDER BY d DESC, ia, ib LIMIT 1)"
SIDES = """sides AS MATERIALIZED (SELECT id, f, CASE WHEN da <= db THEN 0 ELSE 1 END AS side, least(da, db) AS dist FROM (SELECT x.id, x.f, list_distance(x.f, fa) AS da, list_distance(x.f, fb) AS db FROM x, pair)),
kept AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY side ORDER BY dist, id) <= (SELECT count(*) FROM x) // 8 AS kept FROM sides)"""
SEEDS = """seedgroup AS (SELECT id, side AS cl FROM kept WHERE kept),
s0 AS MATERIALIZED (SELECT cl, list(m ORDER BY pos) AS f FROM (SELECT cl, pos, avg(v) AS m FROM (SELECT g.cl, unnest(x.f) AS v, generate_subscripts(x.f, 1) AS pos FROM x JOIN seedgroup g ON g.id = x.id) GROUP BY cl, pos) GROUP BY cl)"""


def _maxmin(src, dst, cl):
    return (
        f"{dst} AS MATERIALIZED (SELECT * FROM {src} UNION ALL SELECT * FROM (SELECT {cl} AS cl, any_value(r.f) AS f FROM kept r CROSS JOIN {src} c WHERE NOT r.kept "
        f"GROUP BY r.id ORDER BY min(list_distance(r.f, c.f)) DESC, r.id LIMIT 1))"
    )


_FEKM = [EMB, PAIR, SIDES, SEEDS, _maxmin("s0", "s1", 2), _maxmin("s1", "c0", 3)]
FEKM = {
    "fekm_farthest_pair": with_(EMB, PAIR) + "SELECT ia AS id_a, ib AS id_b, round(d, 6) AS distance FROM pair",
    "fekm_capped_groups": with_(EMB, PAIR, SIDES) + "SELECT id, CAST(side AS INTEGER) AS side, kept FROM kept",
    "fekm_remaining": with_(EMB, PAIR, SIDES) + "SELECT id FROM kept WHERE NOT kept",
    "fekm_seed_means": with_(EMB, PAIR, SIDES, SEEDS) + centre_rows("s0"),
    "fekm_maxmin": with_(_FEKM) + centre_rows("c0"),
    "fekm_cluster": with_(_FEKM, lloyd(2)[0]) + "SELECT id, CAST(cl AS INTEGER) AS cluster FROM a2",
}

# -- kernel K-Means, k = 3


def _kernel_ctes(kernel):
    k = "list_inner_product(a.f, b.f)" if kernel == "linear" else (
        "exp(-greatest(0, list_inner_product(a.f, a.f) + list_inner_product(b.f, b.f) - 2 * list_inner_product(a.f, b.f)) / 64)"
    )
    out = [EMB, f"km AS MATERIALIZED (SELECT a.id AS i, b.id AS j, {k} AS k FROM x a CROSS JOIN x b)", "dg AS (SELECT i, k AS kii FROM km WHERE i = j)"]
    out.append("com AS (SELECT i, max(kii) - 2 * avg(k) AS com FROM km JOIN dg USING (i) GROUP BY i)")
    out.append("p0 AS MATERIALIZED (SELECT 0 AS cl, i AS z FROM (SELECT i FROM com ORDER BY com DESC, i LIMIT 1))")
    for n in (1, 2):
        out.append(
            f"p{n} AS MATERIALIZED (SELECT * FROM p{n - 1} UNION ALL SELECT {n}, i FROM (SELECT km.i FROM km JOIN p{n - 1} p ON km.j = p.z "
            f"JOIN dg a ON a.i = km.i JOIN dg b ON b.i = p.z GROUP BY km.i ORDER BY min(a.kii + b.kii - 2 * k) DESC, km.i LIMIT 1))"
        )
    return out


def _kernel_rounds(kernel):
    out = _kernel_ctes(kernel)
    out.append("l0 AS MATERIALIZED (SELECT km.i AS id, arg_min(p.cl, a.kii + b.kii - 2 * k) AS cl FROM km JOIN p2 p ON km.j = p.z JOIN dg a ON a.i = km.i JOIN dg b ON b.i = p.z GROUP BY km.i)")
    for n in (1, 2):
        out += [
            f"s{n} AS MATERIALIZED (SELECT km.i, l.cl, sum(k) AS s FROM km JOIN l{n - 1} l ON l.id = km.j GROUP BY km.i, l.cl)",
            f"t{n} AS (SELECT s.cl, count(*) AS n, sum(s.s) AS t FROM s{n} s JOIN l{n - 1} l ON l.id = s.i AND l.cl = s.cl GROUP BY s.cl)",
            f"d{n} AS MATERIALIZED (SELECT s.i, s.cl, kii - 2 * s.s / n + t / (CAST(n AS DOUBLE) * n) AS d FROM s{n} s JOIN t{n} t ON t.cl = s.cl JOIN dg ON dg.i = s.i)",
            f"l{n} AS MATERIALIZED (SELECT i AS id, arg_min(cl, d) AS cl FROM d{n} GROUP BY i)",
        ]
    return out


def _kernel_cost(kernel):
    return with_(_kernel_rounds(kernel)) + f"SELECT '{kernel}' AS kernel, round(sum(m), 5) AS inertia FROM (SELECT min(d) AS m FROM d2 GROUP BY i)"


KERNEL = {
    "kernel_com_distance": with_(_kernel_ctes("rbf")) + f"SELECT i AS id, {rnd('com', 8)} AS com FROM com",
    "kernel_init": with_(_kernel_ctes("rbf")) + "SELECT CAST(cl AS INTEGER) AS cluster, z AS id FROM p2",
    "kernel_kmeans_rbf": with_(_kernel_rounds("rbf")) + "SELECT id, CAST(cl AS INTEGER) AS cluster FROM l2",
    "kernel_kmeans_blocks": with_(_kernel_rounds("rbf")) + "SELECT id, CAST(cl AS INTEGER) AS cluster FROM l2",
    "kernel_kmeans_linear": with_(_kernel_rounds("linear")) + "SELECT id, CAST(cl AS INTEGER) AS cluster FROM l2",
    "kernel_inertia": f"SELECT * FROM ({_kernel_cost('linear')}) UNION ALL SELECT * FROM ({_kernel_cost('rbf')})",
}

# -- fuzzy means, k = 3, seed 5


def _memberships0(k=3, seed=5):
    raw = " UNION ALL ".join(f"SELECT id, {j} AS cl, {uniform('id', j, seed)} AS r FROM x" for j in range(k))
    return f"u0 AS MATERIALIZED (SELECT id, cl, r / sum(r) OVER (PARTITION BY id) AS u FROM ({raw}))"


def fuzzy_rounds(m, alpha, rounds):
    """CTEs u0, v1, u1, ..., v<rounds>, u<rounds>."""
    out = [line(), _memberships0()]
    for n in range(1, rounds + 1):
        out.append(
            f"v{n} AS MATERIALIZED (SELECT cl, list(num / den ORDER BY pos) AS f FROM (SELECT cl, pos, sum(w * v) AS num, sum(w) AS den FROM "
            f"(SELECT u.cl, pow(u.u, {m}) AS w, unnest(x.f) AS v, generate_subscripts(x.f, 1) AS pos FROM u{n - 1} u JOIN x ON x.id = u.id) GROUP BY cl, pos) GROUP BY cl)"
        )
        plain = (
            f"SELECT id, cl, inv / sum(inv) OVER (PARTITION BY id) AS u FROM (SELECT x.id, v.cl, 1 / pow(greatest(list_distance(x.f, v.f), 1e-10), {2 / (m - 1)}) AS inv FROM x CROSS JOIN v{n} v)"
        )
        if alpha < 1:
            plain = f"SELECT id, cl, {alpha} * u + CASE WHEN row_number() OVER (PARTITION BY id ORDER BY u DESC, cl) = 1 THEN {1 - alpha} ELSE 0 END AS u FROM ({plain})"
        out.append(f"u{n} AS MATERIALIZED ({plain})")
    return out


def _fuzzy_change(m, alpha):
    return f"SELECT {m} AS m, {alpha} AS alpha, change FROM (" + with_(fuzzy_rounds(m, alpha, 3)) + "SELECT round(max(abs(a.u - b.u)), 6) AS change FROM u3 a JOIN u2 b ON a.id = b.id AND a.cl = b.cl)"


FUZZY = {
    "fcm_change": f"{_fuzzy_change(2.0, 1.0)} UNION ALL {_fuzzy_change(1.5, 0.5)}",
    "fcm_init": with_(line(), _memberships0()) + f"SELECT id, CAST(cl AS INTEGER) AS cluster, {rnd('u', 6)} AS u FROM u0",
    "fcm_centres": with_(fuzzy_rounds(2.0, 1.0, 3)) + centre_rows("v3", 6),
    "fcm_membership": with_(fuzzy_rounds(2.0, 1.0, 2)) + f"SELECT id, CAST(cl AS INTEGER) AS cluster, {rnd('u', 6)} AS u FROM u2",
    "fcm_suppressed": with_(fuzzy_rounds(1.5, 0.5, 2)) + f"SELECT id, CAST(cl AS INTEGER) AS cluster, {rnd('u', 6)} AS u FROM u2",
    "fcm_labels": with_(fuzzy_rounds(1.5, 0.5, 3)) + "SELECT id, CAST(arg_max(cl, u) AS INTEGER) AS cluster FROM u3 GROUP BY id",
}

# -- mixture of two one-dimensional components, random start with seed 3, three rounds


def _mixture_rounds(rounds=3, value="value / 100.0", reg="1e-4"):
    raw = " UNION ALL ".join(f"SELECT id, v, {j} AS cl, {uniform('id', j, 3)} AS r FROM x" for j in (0, 1))
    out = [f"x AS (SELECT event_id AS id, {value} AS v FROM events)", f"r0 AS MATERIALIZED (SELECT id, v, cl, r / sum(r) OVER (PARTITION BY id) AS r FROM ({raw}))"]
    for n in range(1, rounds + 2):
        out += [
            f"p{n} AS MATERIALIZED (SELECT cl, s / sum(s) OVER () AS w, mu, ss / s - mu * mu + {reg} AS var FROM (SELECT cl, sum(r) + 2.220446049250313e-15 AS s, sum(r * v) / (sum(r) + 2.220446049250313e-15) AS mu, sum(r * v * v) AS ss FROM r{n - 1} GROUP BY cl))",
            f"j{n} AS (SELECT x.id, x.v, p.cl, ln(p.w) - 0.5 * (ln(2 * pi() * var) + (v - mu) * (v - mu) / var) AS lj FROM x CROSS JOIN p{n} p)",
            f"r{n} AS MATERIALIZED (SELECT id, v, cl, exp(lj) / sum(exp(lj)) OVER (PARTITION BY id) AS r, ln(sum(exp(lj)) OVER (PARTITION BY id)) AS ld FROM j{n})",
        ]
    return out


MIXTURE = {
    "gmm_labels": with_(_mixture_rounds()) + "SELECT id, CAST(arg_max(cl, r) AS INTEGER) AS cluster FROM r4 GROUP BY id",
    "gmm_regularised": with_(_mixture_rounds(reg="0.1")) + "SELECT CAST(cl AS INTEGER) AS component, round(w, 6) AS weight, round(mu, 6) AS mean, round(var, 6) AS variance FROM p4",
    "gmm_failure": "SELECT failed, count(*) AS tasks, count(*) FILTER (NOT failed) AS with_bic FROM (SELECT k > n AS failed FROM (SELECT count(DISTINCT label) AS n FROM embeddings), unnest([2, n + 1]) u(k)) GROUP BY failed",
    "gmm_fit": with_(_mixture_rounds()) + "SELECT CAST(cl AS INTEGER) AS component, round(w, 6) AS weight, round(mu, 6) AS mean, round(var, 6) AS variance FROM p4",
    "gmm_gaps": with_(_mixture_rounds(value="CASE WHEN event_id % 7 = 0 THEN 0.0 ELSE value / 100.0 END")) + "SELECT CAST(cl AS INTEGER) AS component, round(w, 6) AS weight, round(mu, 6) AS mean, round(var, 6) AS variance FROM p4",
    "gmm_bic": with_(_mixture_rounds()) + "SELECT round(-2 * sum(ld) + 5 * ln(count(*)), 3) AS bic, round(avg(ld), 6) AS avg_log_likelihood FROM r4 WHERE cl = 0",
}

# -- agglomerative, k = 10: rounds of mutual merges (shortest edges for single linkage), then the cut

_PAIRS = {
    "euclidean": "list_distance(a.f, b.f)", "cosine": "list_cosine_distance(a.f, b.f)", "manhattan": dist("a.f", "b.f", "manhattan"),
}


def _linkage_sql(linkage, metric, k=10, rounds=60) -> str:
    if linkage == "ward":
        pair = "pow(list_distance(a.f, b.f), 2)"
    else:
        pair = _PAIRS[metric]
    out = [
        EMB, f"pd AS MATERIALIZED (SELECT a.id AS i, b.id AS j, {pair} AS d FROM x a CROSS JOIN x b)",
        "g0 AS MATERIALIZED (SELECT id, id AS cid FROM x)",
    ]
    for n in range(rounds):
        if linkage == "single":
            out += [
                f"e{n} AS MATERIALIZED (SELECT a.cid, arg_min({{'o': b.cid, 'd': d, 'a': least(i, j), 'b': greatest(i, j)}}, {{'d': d, 'a': least(i, j), 'b': greatest(i, j)}}) AS e FROM pd JOIN g{n} a ON a.id = pd.i JOIN g{n} b ON b.id = pd.j WHERE a.cid <> b.cid GROUP BY a.cid)",
                f"m{n} AS MATERIALIZED (SELECT DISTINCT e.a AS a, e.b AS b, e.d AS d, 0 AS rnd FROM e{n})",
                f"r{n} AS (SELECT cid AS u, e.o AS v FROM e{n} UNION SELECT e.o, cid FROM e{n})",
                f"q{n} AS MATERIALIZED (WITH RECURSIVE w AS (SELECT u AS s, u AS t FROM r{n} UNION SELECT w.s, r.v FROM w JOIN r{n} r ON r.u = w.t) SELECT s, min(t) AS root FROM w GROUP BY s)",
                f"g{n + 1} AS MATERIALIZED (SELECT id, coalesce(root, cid) AS cid FROM g{n} LEFT JOIN q{n} ON q{n}.s = cid)",
            ]
            continue
        if linkage == "ward":
            # from squared point distances: between-sum and the sums within each cluster
            out += [
                f"b{n} AS MATERIALIZED (SELECT a.cid AS p, b.cid AS q, sum(d) AS s FROM pd JOIN g{n} a ON a.id = pd.i JOIN g{n} b ON b.id = pd.j GROUP BY a.cid, b.cid)",
                f"z{n} AS MATERIALIZED (SELECT cid, count(*) AS m FROM g{n} GROUP BY cid)",
                f"c{n} AS MATERIALIZED (SELECT b.p, b.q, sqrt(greatest(0, 2.0 * zp.m * zq.m / (zp.m + zq.m) * (b.s / (zp.m * zq.m) - bp.s / (2.0 * zp.m * zp.m) - bq.s / (2.0 * zq.m * zq.m)))) AS d FROM b{n} b JOIN z{n} zp ON zp.cid = b.p JOIN z{n} zq ON zq.cid = b.q JOIN b{n} bp ON bp.p = b.p AND bp.q = b.p JOIN b{n} bq ON bq.p = b.q AND bq.q = b.q WHERE b.p <> b.q)",
            ]
        else:
            stat = "max(d)" if linkage == "complete" else "avg(d)"
            out.append(f"c{n} AS MATERIALIZED (SELECT a.cid AS p, b.cid AS q, {stat} AS d FROM pd JOIN g{n} a ON a.id = pd.i JOIN g{n} b ON b.id = pd.j WHERE a.cid <> b.cid GROUP BY a.cid, b.cid)")
        out += [
            f"e{n} AS MATERIALIZED (SELECT p, arg_min(q, {{'d': round(d, 12), 'a': least(p, q), 'b': greatest(p, q)}}) AS q, min(d) AS d FROM c{n} GROUP BY p)",
            f"m{n} AS MATERIALIZED (SELECT a.p AS a, a.q AS b, a.d AS d, {n} AS rnd FROM e{n} a JOIN e{n} b ON a.q = b.p AND b.q = a.p WHERE a.p < a.q)",
            f"g{n + 1} AS MATERIALIZED (SELECT id, coalesce(m.a, cid) AS cid FROM g{n} LEFT JOIN m{n} m ON m.b = cid)",
        ]
    union = " UNION ALL ".join(f"SELECT a, b, d, rnd FROM m{n}" for n in range(rounds))
    out += [
        f"kept AS MATERIALIZED (SELECT a, b FROM (SELECT *, row_number() OVER (ORDER BY d DESC, rnd DESC, a DESC, b DESC) AS rn FROM ({union})) WHERE rn >= {k})",
        "links AS MATERIALIZED (SELECT a AS u, b AS v FROM kept UNION SELECT b, a FROM kept)",
        "roots AS MATERIALIZED (WITH RECURSIVE w AS (SELECT id AS s, id AS t FROM x UNION SELECT w.s, l.v FROM w JOIN links l ON l.u = w.t) SELECT s AS id, min(t) AS root FROM w GROUP BY s)",
    ]
    return with_(out) + "SELECT id, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS cluster FROM roots"


LINKAGE = {
    "agg_complete_rounds": _linkage_sql("complete", "euclidean"), "agg_average_rounds": _linkage_sql("average", "cosine"),
    "agg_single_rounds": _linkage_sql("single", "euclidean", rounds=9),
    "agg_single": _linkage_sql("single", "euclidean", rounds=9), "agg_complete": _linkage_sql("complete", "euclidean"),
    "agg_average": _linkage_sql("average", "cosine"), "agg_manhattan": _linkage_sql("complete", "manhattan"), "agg_ward": _linkage_sql("ward", "euclidean"),
}

# -- projection

_PLANE = [
    line(MEASURES[:2]),
    "mc AS MATERIALIZED (SELECT avg(f[1]) AS m0, avg(f[2]) AS m1, covar_samp(f[1], f[1]) AS a, covar_samp(f[1], f[2]) AS b, covar_samp(f[2], f[2]) AS c FROM x)",
    "ev AS (SELECT *, (a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b) AS l0, (a + c) / 2 - sqrt(pow((a - c) / 2, 2) + b * b) AS l1 FROM mc)",
    # unit eigenvector of l0 signed by its largest entry; the other one is orthogonal
    "un AS (SELECT *, b / sqrt(b * b + (l0 - a) * (l0 - a)) AS e0, (l0 - a) / sqrt(b * b + (l0 - a) * (l0 - a)) AS e1 FROM ev)",
    "sg AS MATERIALIZED (SELECT m0, m1, l0, l1, e0 * s0 AS u0, e1 * s0 AS u1, -e1 * s1 AS w0, e0 * s1 AS w1 FROM (SELECT *, CASE WHEN (CASE WHEN abs(e0) >= abs(e1) THEN e0 ELSE e1 END) < 0 THEN -1 ELSE 1 END AS s0, CASE WHEN (CASE WHEN abs(e1) >= abs(e0) THEN -e1 ELSE e0 END) < 0 THEN -1 ELSE 1 END AS s1 FROM un))",
]
_EMB_PLANE = [
    "x0 AS MATERIALIZED (SELECT vec_id AS id, CAST(embedding[1:2] AS DOUBLE[]) AS f FROM embeddings)",
    *(c.replace("FROM x)", "FROM x0)") for c in _PLANE[1:]),
    "x AS MATERIALIZED (SELECT id, [(f[1] - m0) * u0 + (f[2] - m1) * u1, (f[1] - m0) * w0 + (f[2] - m1) * w1] AS f FROM x0, sg)",
]
_Z0 = "((f[1] - m0) * u0 + (f[2] - m1) * u1)"
PROJECTION = {
    "pca_plane_fekm": with_(_EMB_PLANE, _FEKM[1:], lloyd(2)[0]) + "SELECT id, CAST(cl AS INTEGER) AS cluster FROM a2",
    "pca_mean_cov": with_(
        EMB, "l AS MATERIALIZED (SELECT id, unnest(f) AS v, generate_subscripts(f, 1) - 1 AS pos FROM x)", "mu AS (SELECT pos, avg(v) AS m FROM l GROUP BY pos)"
    ) + f"SELECT CAST(a.pos AS INTEGER) AS i, CAST(b.pos AS INTEGER) AS j, {rnd('any_value(m)', 6)} AS mean, {rnd('covar_samp(a.v, b.v)', 6)} AS covariance FROM l a JOIN l b ON a.id = b.id JOIN mu ON mu.pos = a.pos GROUP BY a.pos, b.pos",
    "pca_components": with_(_PLANE) + "SELECT CAST(0 AS INTEGER) AS component, round(l0, 6) AS eigenvalue, round(l0 / (l0 + l1), 6) AS ratio, round(abs(u0), 5) AS loading FROM sg UNION ALL SELECT 1, round(l1, 6), round(l1 / (l0 + l1), 6), round(abs(w0), 5) FROM sg",
    "pca_transform": with_(_PLANE) + f"SELECT id, {rnd(_Z0, 5)} AS z0, {rnd('((f[1] - m0) * w0 + (f[2] - m1) * w1)', 5)} AS z1 FROM x, sg",
    "pca_reconstruct": with_(_PLANE) + f"SELECT id, {rnd('f[1]', 5)} AS x0, {rnd('f[2]', 5)} AS x1, {rnd(f'm0 + {_Z0} * u0', 5)} AS r0, {rnd(f'm1 + {_Z0} * u1', 5)} AS r1 FROM x, sg",
}

# -- evaluation

_HASHED = f"h AS MATERIALIZED (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS f, label, CAST(floor({uniform('vec_id', 0, 9)} * 6) AS INTEGER) AS cluster FROM embeddings)"
_LINES = "h AS (SELECT l_returnflag AS label, l_linenumber AS cluster FROM lineitem)"
def _flagged(clusters):
    return f"h AS MATERIALIZED (SELECT id, label, CAST(floor({uniform('id', 0, 4)} * {clusters}) AS INTEGER) AS cluster FROM (SELECT {LINE_KEY} AS id, l_returnflag AS label FROM lineitem))"


_CELLS = "t AS MATERIALIZED (SELECT label, cluster, count(*) AS n FROM h GROUP BY label, cluster)"
_TOTALS = "tt AS (SELECT *, sum(n) OVER (PARTITION BY label) AS a, sum(n) OVER (PARTITION BY cluster) AS b, sum(n) OVER () AS total FROM t)"
_PURITY = "(SELECT sum(top) / sum(size) FROM (SELECT CAST(max(n) AS DOUBLE) AS top, sum(n) AS size FROM t GROUP BY cluster))"
_FSCORE = "(SELECT sum(f1 * a) / sum(a) FROM (SELECT max(2.0 * n / (a + b)) AS f1, CAST(max(a) AS DOUBLE) AS a FROM tt GROUP BY label))"
_ARI = """(SELECT (cells - r * c / p) / ((r + c) / 2 - r * c / p) FROM (SELECT sum(CAST(n AS DOUBLE) * (n - 1)) / 2 AS cells,
 (SELECT sum(CAST(s AS DOUBLE) * (s - 1)) / 2 FROM (SELECT sum(n) AS s FROM t GROUP BY label)) AS r, (SELECT sum(CAST(s AS DOUBLE) * (s - 1)) / 2 FROM (SELECT sum(n) AS s FROM t GROUP BY cluster)) AS c,
 CAST(sum(n) AS DOUBLE) * (sum(n) - 1) / 2 AS p FROM t))"""
_DBI_CTES = [
    "cm AS MATERIALIZED (SELECT cluster, list(m ORDER BY pos) AS m FROM (SELECT cluster, pos, avg(v) AS m FROM (SELECT cluster, unnest(f) AS v, generate_subscripts(f, 1) AS pos FROM h) GROUP BY cluster, pos) GROUP BY cluster)",
    "sp AS MATERIALIZED (SELECT cluster, any_value(m) AS m, avg(list_distance(f, m)) AS s FROM h JOIN cm USING (cluster) GROUP BY cluster)",
]
_DBI = "(SELECT avg(w) FROM (SELECT max((a.s + b.s) / list_distance(a.m, b.m)) AS w FROM sp a JOIN sp b ON a.cluster <> b.cluster GROUP BY a.cluster))"


def _matching_ctes(clusters=5, classes=("A", "N", "R"), rows=None):
    """Best one-to-one choice: states over sets of used classes, one step per cluster. ``rows``: CTEs that end with h (id, label, cluster)."""
    out = [*(rows or [_flagged(clusters)]), _CELLS, "st0 AS (SELECT 0 AS mask, CAST(0 AS BIGINT) AS score, CAST([] AS INTEGER[]) AS picks)"]
    for j in range(clusters):
        moves = [f"SELECT mask, score, list_append(picks, -{len(classes)}) AS picks FROM st{j}"]
        for i, c in enumerate(classes):
            moves.append(
                f"SELECT mask | {1 << i}, score + coalesce((SELECT n FROM t WHERE cluster = {j} AND label = {c!r}), 0), list_append(picks, -{i}) FROM st{j} WHERE mask & {1 << i} = 0"
            )
        ranked = f"SELECT *, row_number() OVER (PARTITION BY mask ORDER BY score DESC, picks DESC) AS rn FROM ({' UNION ALL '.join(moves)})"
        out.append(f"st{j + 1} AS MATERIALIZED (SELECT mask, score, picks FROM ({ranked}) WHERE rn = 1)")
    names = "[" + ", ".join(f"'{c}'" if isinstance(c, str) else str(c) for c in classes) + "]"
    out.append(f"best AS (SELECT picks FROM st{clusters} ORDER BY score DESC, picks DESC LIMIT 1)")
    out.append(f"mt AS MATERIALIZED (SELECT CAST(c AS INTEGER) AS cluster, CASE WHEN -picks[c + 1] < {len(classes)} THEN {names}[1 - picks[c + 1]] END AS matched FROM best, range({clusters}) r(c))")
    return out


EVALUATION = {
    "contingency": with_(_LINES) + "SELECT label, cluster, count(*) AS n FROM h GROUP BY label, cluster",
    "confusion_normalized": with_(_HASHED, _CELLS) + f"SELECT l.label, c.cluster, coalesce(n, 0) AS n, {rnd('coalesce(n, 0) / CAST(l.total AS DOUBLE)', 6)} AS share FROM (SELECT label, sum(n) AS total FROM t GROUP BY label) l CROSS JOIN (SELECT DISTINCT cluster FROM t) c LEFT JOIN t ON t.label = l.label AND t.cluster = c.cluster",
    "purity": with_(_LINES, _CELLS) + f"SELECT {rnd(_PURITY, 8)} AS purity",
    "f_measure": with_(_LINES, _CELLS, _TOTALS) + f"SELECT {rnd(_FSCORE, 8)} AS f_measure",
    "ari": with_(_LINES, _CELLS) + f"SELECT {rnd(_ARI, 8)} AS ari",
    "davies_bouldin": with_(_HASHED, _DBI_CTES) + f"SELECT {rnd(_DBI, 4)} AS davies_bouldin",
    "metric_suite": with_(_HASHED, _CELLS, _TOTALS, _DBI_CTES) + f"SELECT {rnd(_ARI, 6)} AS ari, {rnd(_PURITY, 6)} AS purity, {rnd(_DBI, 4)} AS davies_bouldin, {rnd(_FSCORE, 6)} AS f_measure",
    "match_clusters": with_(_matching_ctes()) + "SELECT mt.cluster, matched, coalesce(n, 0) AS overlap FROM mt LEFT JOIN t ON t.cluster = mt.cluster AND t.label = mt.matched",
    "match_blocks": with_(_matching_ctes(40)) + "SELECT mt.cluster, matched, coalesce(n, 0) AS overlap FROM mt LEFT JOIN t ON t.cluster = mt.cluster AND t.label = mt.matched",
    "matched_fekm_rounds": with_(_matching_ctes(4, tuple(range(10)), [*_FEKM, *lloyd(2)[0], "h AS MATERIALIZED (SELECT x.id, x.label, CAST(cl AS INTEGER) AS cluster FROM x JOIN a2 ON a2.id = x.id)"])) + "SELECT label, matched, CAST(sum(n) AS BIGINT) AS n FROM t JOIN mt USING (cluster) GROUP BY label, matched",
    "relabel": with_(_matching_ctes()) + "SELECT id, matched FROM h JOIN mt USING (cluster)",
    "matched_confusion": with_(_matching_ctes()) + "SELECT label, matched, CAST(sum(n) AS BIGINT) AS n FROM t JOIN mt USING (cluster) GROUP BY label, matched",
}

# -- grid and reports

_ALGOS = "['KMeans_Standard', 'KMeans_FEKM', 'Kernel_KMeans', 'FCM_Standard', 'FCM_Suppressed_0.5', 'GaussianMixture', 'Agglomerative']"
RUNS = f"""runs AS (SELECT run_key, dataset, algorithm, CASE WHEN algorithm <> 'GaussianMixture' THEN k END AS n_clusters, CASE WHEN algorithm = 'GaussianMixture' THEN k END AS n_components,
 CASE WHEN algorithm = 'Agglomerative' THEN ['euclidean', 'manhattan', 'cosine'][s % 3 + 1] END AS metric, CASE WHEN algorithm = 'Agglomerative' THEN ['complete', 'average', 'single'][p % 3 + 1] END AS linkage,
 CASE WHEN algorithm LIKE 'FCM%' THEN 1.5 + 0.5 * (s % 3) END AS param_m, CASE WHEN algorithm = 'FCM_Standard' THEN 1.0 WHEN algorithm LIKE 'FCM%' THEN 0.5 END AS param_alpha, preprocessing, purity, inertia, inertia * 2 AS bic
 FROM (SELECT {LINE_KEY} AS run_key, l_returnflag AS dataset, {_ALGOS}[l_linenumber % 7 + 1] AS algorithm, CAST(l_partkey % 9 + 2 AS INTEGER) AS k, l_suppkey AS s, l_partkey AS p,
  CASE WHEN l_linestatus = 'F' THEN 'PCA_2D' END AS preprocessing, l_quantity / 64.0 AS purity, l_extendedprice AS inertia FROM lineitem))"""


def _curve(keys, value, where, places):
    k = ", ".join(keys)
    aliases = ", ".join(x.split(" AS ")[0] for x in keys)
    return f"WITH {RUNS} SELECT {k}, {rnd(f'avg({value})', places)} AS mean_{value}, {rnd(f'stddev_samp({value})', places)} AS std_{value}, count({value}) AS n FROM runs WHERE {where} GROUP BY {aliases}"


# fixed values: tasks per k by session and algorithm, the three PCA sizes apart
_TASKS = """tk AS (SELECT * FROM (VALUES ('S1', 'Agglomerative', 9, 0), ('S1', 'GaussianMixture', 30, 0), ('S2', 'KMeans_Standard', 20, 0), ('S2', 'KMeans_FEKM', 2, 0), ('S2', 'Kernel_KMeans', 1, 0),
 ('S2', 'FCM_Standard', 30, 0), ('S2', 'FCM_Suppressed_0.75', 30, 0), ('S2', 'FCM_Suppressed_0.5', 30, 0), ('S3', 'KMeans_FEKM', 1, 2), ('S3', 'KMeans_FEKM', 1, 3), ('S3', 'KMeans_FEKM', 1, 5),
 ('S3', 'Kernel_KMeans', 1, 2), ('S3', 'Kernel_KMeans', 1, 3), ('S3', 'Kernel_KMeans', 1, 5)) v(session, algorithm, per_k, p)), ds AS (SELECT DISTINCT source AS dataset FROM documents)"""

REPORTS = {
    "experiment_resume": """WITH w AS (SELECT CAST(1 + count(DISTINCT c_nationkey) AS INTEGER) AS width FROM customer), k AS (SELECT CAST(range AS INTEGER) AS k FROM range(2, 11)),
 t AS (SELECT 'S2' AS session, 'KMeans_FEKM' AS algorithm, m AS metric, 0 AS p, 1 AS n FROM (VALUES ('euclidean'), ('manhattan')) v(m)
  UNION ALL SELECT 'S2', 'KMeans_Standard', m, 0, 10 FROM (VALUES ('euclidean'), ('manhattan')) v(m)
  UNION ALL SELECT 'S3', 'KMeans_FEKM', 'euclidean', p, 1 FROM (VALUES (2), (3), (5)) v(p))
 SELECT 'customer' AS dataset, session, algorithm, k AS n_clusters, metric, CASE WHEN p = 0 THEN 'Original' ELSE 'PCA_' || p || 'D' END AS preprocessing, width AS n_features_orig,
 CAST(n AS BIGINT) AS rows, CAST(0 AS BIGINT) AS errors, CAST(n AS BIGINT) AS scored FROM t, k, w WHERE p < width""",
    "grid": f"WITH {_TASKS} SELECT dataset, session, algorithm, CAST(sum(per_k * 9) AS BIGINT) AS tasks FROM ds CROSS JOIN tk WHERE p < length(dataset) GROUP BY dataset, session, algorithm",
    "grid_resume": f"WITH {_TASKS} SELECT dataset, algorithm, CAST(k AS INTEGER) AS n_clusters, CAST(sum(per_k) AS BIGINT) AS tasks FROM ds CROSS JOIN tk CROSS JOIN range(3, 10, 2) r(k) GROUP BY dataset, algorithm, k",
    "compile_results": f"WITH {RUNS} SELECT run_key, dataset, algorithm, n_clusters, n_components, CASE WHEN algorithm = 'GaussianMixture' THEN 'Original' ELSE coalesce(preprocessing, 'Original') END AS preprocessing, purity FROM runs",
    "run_counts": f"WITH {RUNS} SELECT dataset, algorithm, coalesce(preprocessing, 'Original') AS preprocessing, count(*) AS runs FROM runs GROUP BY ALL",
    "distinct_values": f"WITH {RUNS} SELECT DISTINCT algorithm FROM runs",
    "results_numeric": f"WITH {RUNS} SELECT run_key, CASE WHEN length(run_key) % 5 <> 0 THEN CAST(n_clusters AS DOUBLE) END AS n_clusters FROM runs",
    "best_config": f"WITH {RUNS} SELECT dataset, algorithm, n_clusters, purity, metric, linkage, param_m, param_alpha, preprocessing FROM (SELECT *, row_number() OVER (PARTITION BY dataset, algorithm ORDER BY purity DESC, run_key) AS rn FROM runs) WHERE rn = 1",
    "elbow": _curve(["dataset", "n_clusters"], "inertia", "algorithm = 'KMeans_Standard'", 3),
    "bic_curve": _curve(["dataset", "coalesce(n_clusters, n_components) AS k"], "bic", "algorithm = 'GaussianMixture'", 3),
    "linkage_effect": _curve(["dataset", "linkage"], "purity", "algorithm = 'Agglomerative'", 6),
    "metric_effect": _curve(["dataset", "metric"], "purity", "algorithm = 'Agglomerative'", 6),
    "alpha_effect": _curve(["dataset", "n_clusters", "param_alpha"], "purity", "algorithm LIKE '%FCM%'", 6),
    "fuzzifier_effect": _curve(["dataset", "param_m", "param_alpha"], "purity", "algorithm LIKE '%FCM%'", 6),
    "arff_ingest": f"SELECT c_custkey, c_name, {rnd('c_acctbal', 2)} AS c_acctbal, c_mktsegment FROM customer",
    "results_csv_roundtrip": f"WITH {RUNS} SELECT algorithm, dataset, count(*) AS n, sum(purity) AS purity FROM runs GROUP BY ALL",
    "results_by_dataset": f"WITH {RUNS} SELECT dataset, count(*) AS n, sum(purity) AS purity FROM runs GROUP BY ALL UNION ALL SELECT 'A alone', count(*), sum(purity) FROM runs WHERE dataset = 'A'",
    "results_newest": f"WITH {RUNS} SELECT '20250301_080000' AS run_ts, algorithm, count(*) AS n FROM runs GROUP BY ALL",
    "results_scan": f"WITH {RUNS} SELECT dataset, coalesce(n_clusters, n_components) AS k, count(*) AS n, sum(purity) AS purity FROM runs GROUP BY ALL",
}

ORACLES = {**PREP, **DISTANCES, **KMEANS, **FEKM, **KERNEL, **FUZZY, **MIXTURE, **LINKAGE, **PROJECTION, **EVALUATION, **REPORTS}
