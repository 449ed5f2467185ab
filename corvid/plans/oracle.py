"""SQL texts equivalent to :mod:`corvid.plans.catalog`, for an independent SQL engine
(DuckDB) over the same Parquet tables registered as views. Iterative jobs are unrolled
into one CTE per round, generated from the round count."""

from __future__ import annotations

from corvid.plans import catalog as C

_S = "(SELECT max(s_suppkey) + 1 FROM supplier)"
_N = f"({_S} + (SELECT max(p_partkey) + 1 FROM part))"
_LINKS = (f"SELECT DISTINCT CAST(l_suppkey AS BIGINT) AS src, CAST({_S} + l_partkey AS BIGINT) AS dst "
          "FROM lineitem")


def _pagerank_ctes(rounds: int, d: float, rules: str = "mpi") -> list[str]:
    """CTEs ``r0 .. r{rounds}`` of (page, deg, rank); the dangling mass in closed form."""
    if rules == "mpi":
        start, tele = "1.0 / nn.n", "(1 - {d}) / nn.n"
        ddeg = lambda a: "(nn.n - 1)"
        gets = lambda a: "TRUE"
    else:  # sequential: pages 0..M with M = n - 1
        start, tele = "CAST(CAST(1.0 AS FLOAT) / CAST(nn.n AS FLOAT) AS DOUBLE)", "(1 - {d}) / (nn.n - 1)"
        ddeg = lambda a: f"(CASE WHEN {a}.page < nn.n - 1 THEN nn.n - 2 ELSE nn.n - 1 END)"
        gets = lambda a: f"({a}.page < nn.n - 1)"
    parts = [
        f"links AS MATERIALIZED ({_LINKS})",
        "deg AS MATERIALIZED (SELECT src, count(*) AS deg FROM links GROUP BY src)",
        f"nn AS MATERIALIZED (SELECT CAST({_N} AS DOUBLE) AS n)",
        f"r0 AS MATERIALIZED (SELECT CAST(g.range AS BIGINT) AS page, deg.deg, {start} AS rank "
        f"FROM nn, range(CAST({_N} AS BIGINT)) g LEFT JOIN deg ON deg.src = g.range)",
    ]
    for k in range(1, rounds + 1):
        p = f"r{k - 1}"
        parts.append(
            f"r{k} AS MATERIALIZED (SELECT p.page, p.deg, "
            f"{tele.format(d=d)} + {d} * (coalesce(c.s, 0) + CASE WHEN {gets('p')} THEN dw.v - "
            f"CASE WHEN p.deg IS NULL THEN p.rank / {ddeg('p')} ELSE 0 END ELSE 0 END) AS rank "
            f"FROM {p} p CROSS JOIN nn "
            f"LEFT JOIN (SELECT l.dst, sum(q.rank / q.deg) AS s FROM links l JOIN {p} q ON q.page = l.src GROUP BY l.dst) c "
            f"ON c.dst = p.page "
            f"CROSS JOIN (SELECT coalesce(sum(x.rank / {ddeg('x')}), 0) AS v FROM {p} x, nn WHERE x.deg IS NULL) dw)")
    return parts


def pagerank_sql(rounds: int = C.PR_ROUNDS, d: float = C.DAMPING, rules: str = "mpi") -> str:
    """Exactly ``rounds`` rounds under the MPI or the sequential rules."""
    return ("WITH " + ",\n".join(_pagerank_ctes(rounds, d, rules))
            + f"\nSELECT page, round(rank, 10) AS rank FROM r{rounds}")


def pagerank_in_place_sql(rounds: int = C.PR_ROUNDS, d: float = C.DAMPING) -> str:
    """``rounds`` in-place rounds on the supplier -> part graph, whose links all lead upwards:
    first the suppliers' new ranks, then the parts', which read them. Dangling pages feed every
    later page at once: with m dangling pages before a page, the new shares that it gets are
    g^(m-1) * sum(y g^-m) over them, where y is a dangling page's share without that feedback
    and g = 1 + d / (M - 1)."""
    parts = _pagerank_ctes(0, d, "sequential")
    tele, g = f"((1 - {d}) / (nn.n - 1))", f"(1 + {d} / (nn.n - 2))"
    for k in range(1, rounds + 1):
        parts.append(
            f"o{k} AS MATERIALIZED (SELECT page, deg, rank, coalesce(sum(give) OVER (ORDER BY page DESC ROWS BETWEEN UNBOUNDED PRECEDING "
            f"AND 1 PRECEDING), 0) AS later, coalesce(sum(CASE WHEN deg IS NULL THEN 1 ELSE 0 END) OVER (ORDER BY page ROWS BETWEEN "
            f"UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS m FROM (SELECT p.*, CASE WHEN p.deg IS NULL THEN p.rank / (CASE WHEN p.page < nn.n - 1 "
            f"THEN nn.n - 2 ELSE nn.n - 1 END) ELSE 0 END AS give FROM r{k - 1} p CROSS JOIN nn))")
        new = (f"SELECT page, deg, {tele} + {d} * (ext + CASE WHEN page < nn.n - 1 THEN later + pow({g}, m - 1) * coalesce(sum("
               f"CASE WHEN deg IS NULL THEN ({tele} + {d} * (ext + later)) / (nn.n - 2) * pow({g}, -m) ELSE 0 END) OVER (ORDER BY page "
               f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) ELSE 0 END) AS rank FROM ")
        parts.append(f"a{k} AS MATERIALIZED ({new}(SELECT *, 0 AS ext FROM o{k} WHERE page < {_S}) CROSS JOIN nn)")
        parts.append(f"x{k} AS MATERIALIZED (SELECT l.dst AS page, sum(a.rank / a.deg) AS ext FROM links l JOIN a{k} a ON a.page = l.src "
                     f"GROUP BY l.dst)")
        parts.append(f"r{k} AS MATERIALIZED ({new}(SELECT o.*, coalesce(x.ext, 0) AS ext FROM o{k} o LEFT JOIN x{k} x USING (page)) "
                     f"CROSS JOIN nn)")
    return "WITH " + ",\n".join(parts) + f"\nSELECT page, round(rank, 10) AS rank FROM r{rounds}"


def pagerank_converge_sql(delta: float = C.PR_DELTA, max_rounds: int = C.PR_MAX_ROUNDS, d: float = C.DAMPING) -> str:
    """MPI rules: the first round whose largest rank change is at most ``delta``."""
    parts = _pagerank_ctes(max_rounds, d)
    per_round = " UNION ALL ".join(
        f"SELECT {k} AS k, (SELECT max(abs(a.rank - b.rank)) FROM r{k} a JOIN r{k - 1} b USING (page)) AS ch, "
        f"(SELECT sum(rank) FROM r{k}) AS s" for k in range(1, max_rounds + 1))
    parts.append(f"chs AS MATERIALIZED ({per_round})")
    return ("WITH " + ",\n".join(parts) + "\nSELECT CAST(k AS INTEGER) AS rounds, round(ch, 13) AS max_change, "
            f"round(s, 12) AS rank_sum FROM chs WHERE ch <= {delta!r} ORDER BY k LIMIT 1")


def kmeans_rounds_sql(rounds: int = C.KM_ROUNDS) -> str:
    """``rounds`` K-means rounds from the ten lowest vec_id vectors, long form."""
    parts = [
        "e AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings)",
        "c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cid, vec AS center, "
        f"CAST(0 AS BIGINT) AS n FROM (SELECT * FROM e ORDER BY vec_id LIMIT {C.K_CENTRES}))",
    ]
    for k in range(1, rounds + 1):
        parts.append(
            f"a{k} AS MATERIALIZED (SELECT vec_id, vec, cid FROM (SELECT e.vec_id, e.vec, c.cid, row_number() OVER "
            f"(PARTITION BY e.vec_id ORDER BY list_distance(e.vec, c.center), c.cid) AS rn FROM e, c{k - 1} c) WHERE rn = 1)")
        parts.append(
            f"m{k} AS MATERIALIZED (SELECT cid, i, sum(v) / count(*) AS m, count(*) AS n FROM (SELECT cid, unnest(vec) AS v, "
            f"unnest(generate_series(1, len(vec))) AS i FROM a{k}) GROUP BY cid, i)")
        parts.append(f"c{k} AS MATERIALIZED (SELECT cid, list(m ORDER BY i) AS center, n FROM m{k} GROUP BY cid, n)")
    return ("WITH " + ",\n".join(parts) + f"\nSELECT cid, CAST(i - 1 AS INTEGER) AS pos, round(m, 6) AS value, "
            f"CAST(n AS BIGINT) AS n FROM m{rounds}")


def forest_sql(depth: int = C.FOREST_DEPTH, trees: int = C.FOREST_TREES, subset: int = C.FOREST_SUBSET,
               seed: int = C.FOREST_SEED) -> str:
    """Depth-limited trees, reference rules, set postings: per level node totals, per
    (tree, node, feature) posting counts, each node's draw, score, lowest (score, feature),
    leaf tests, routing. Then every document walks every tree, and the trees vote. Yields
    ``nodes``, ``preds(example, prediction)`` and ``tsize``."""
    parts = [
        "lab AS MATERIALIZED (SELECT doc_id AS example, quality AS label FROM labels)",
        "every AS MATERIALIZED (SELECT DISTINCT example, feature FROM ("
        "SELECT d.doc_id AS example, unnest(regexp_split_to_array(d.text, '[ \\t\\n\\r]+')) AS feature "
        "FROM documents d) t WHERE feature <> '')",
        "post AS MATERIALIZED (SELECT * FROM every WHERE example IN (SELECT example FROM lab))",
        f"a0 AS MATERIALIZED (SELECT CAST(t.range AS INTEGER) AS tree, example, label, CAST(1 AS BIGINT) AS node "
        f"FROM lab, range({trees}) t)",
    ]
    nodes = []
    for k in range(depth + 1):
        parts.append(f"ns{k} AS MATERIALIZED (SELECT tree, node, count(*) AS n, sum(label) AS pos FROM a{k} GROUP BY tree, node)")
        maj = "CASE WHEN s.n - s.pos > s.pos THEN 0 ELSE 1 END"
        if k == depth:
            nodes.append(f"SELECT tree, node, CAST(NULL AS VARCHAR) AS feature, true AS is_leaf, {maj} AS prediction FROM ns{k} s")
            break
        parts.append(
            f"fs{k} AS MATERIALIZED (SELECT a.tree, a.node, p.feature, count(*) AS m, sum(a.label) AS c "
            f"FROM post p JOIN a{k} a USING (example) GROUP BY a.tree, a.node, p.feature)")
        parts.append(
            f"rk{k} AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree, node ORDER BY substr(md5(feature), 1, 2), feature) - 1 "
            f"AS rank, count(*) OVER (PARTITION BY tree, node) AS many FROM fs{k})")
        parts.append(
            f"dr{k} AS MATERIALIZED (SELECT DISTINCT tree, node, least(CAST(floor(CAST('0x' || substr(md5(concat_ws('|', '{seed}', tree, node, "
            f"i.range)), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE * many) AS BIGINT), many - 1) AS rank "
            f"FROM (SELECT DISTINCT tree, node, many FROM rk{k}), range({subset}) i)")
        parts.append(
            f"sc{k} AS MATERIALIZED (SELECT f.tree, f.node, f.feature, CASE WHEN f.m = s.n THEN -1e30 ELSE "
            f"CAST(f.m AS DOUBLE) / s.n * ((f.c / CAST(f.m AS DOUBLE)) * (1.0 - f.c / CAST(f.m AS DOUBLE))) + "
            f"(CAST(s.n AS DOUBLE) - f.m) / s.n * ((CAST(s.pos - f.c AS DOUBLE) / (CAST(s.n AS DOUBLE) - f.m)) * "
            f"(1.0 - CAST(s.pos - f.c AS DOUBLE) / (CAST(s.n AS DOUBLE) - f.m))) END AS score "
            f"FROM rk{k} f JOIN ns{k} s USING (tree, node) JOIN dr{k} USING (tree, node, rank))")
        parts.append(
            f"b{k} AS MATERIALIZED (SELECT tree, node, feature, score FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY tree, node ORDER BY score, feature) AS rn FROM sc{k}) WHERE rn = 1)")
        parts.append(
            f"d{k} AS MATERIALIZED (SELECT s.tree, s.node, b.feature, "
            f"(s.pos = 0 OR s.pos = s.n OR b.feature IS NULL OR b.score <= 0) AS is_leaf, "
            f"{maj} AS maj FROM ns{k} s LEFT JOIN b{k} b USING (tree, node))")
        nodes.append(f"SELECT tree, node, CASE WHEN NOT is_leaf THEN feature END AS feature, is_leaf, "
                     f"CASE WHEN is_leaf THEN maj END AS prediction FROM d{k}")
        parts.append(
            f"a{k + 1} AS MATERIALIZED (SELECT a.tree, a.example, a.label, CASE WHEN h.example IS NOT NULL "
            f"THEN a.node * 2 ELSE a.node * 2 + 1 END AS node FROM a{k} a JOIN d{k} d USING (tree, node) "
            f"LEFT JOIN post h ON h.example = a.example AND h.feature = d.feature WHERE NOT d.is_leaf)")
        # A child that no example reached is a leaf that predicts 1.
        nodes.append(f"SELECT d.tree, d.node * 2 + t.b AS node, NULL AS feature, true AS is_leaf, 1 AS prediction FROM d{k} d, "
                     f"(VALUES (0), (1)) t(b) WHERE NOT d.is_leaf AND NOT EXISTS (SELECT 1 FROM a{k + 1} x "
                     f"WHERE x.tree = d.tree AND x.node = d.node * 2 + t.b)")
    parts.append("nodes AS MATERIALIZED (" + " UNION ALL ".join(nodes) + ")")
    parts.append(f"w0 AS MATERIALIZED (SELECT CAST(t.range AS INTEGER) AS tree, doc_id AS example, CAST(1 AS BIGINT) AS node "
                 f"FROM documents, range({trees}) t)")
    for k in range(depth):
        parts.append(
            f"w{k + 1} AS MATERIALIZED (SELECT w.tree, w.example, CASE WHEN n.is_leaf THEN w.node WHEN h.example IS NOT NULL "
            f"THEN w.node * 2 ELSE w.node * 2 + 1 END AS node FROM w{k} w JOIN nodes n USING (tree, node) "
            f"LEFT JOIN every h ON h.example = w.example AND h.feature = n.feature)")
    parts.append(f"preds AS MATERIALIZED (SELECT example, CASE WHEN count(*) - sum(prediction) > sum(prediction) THEN 0 ELSE 1 END "
                 f"AS prediction FROM w{depth} JOIN nodes USING (tree, node) GROUP BY example)")
    parts.append("tsize AS MATERIALIZED (SELECT avg(c) AS mean_size FROM (SELECT tree, count(*) AS c FROM nodes GROUP BY tree))")
    return "WITH " + ",\n".join(parts)


_ROOT = (
    "WITH lab AS (SELECT doc_id AS example, quality AS label FROM labels), "
    "post AS (SELECT example, feature, {k} AS k FROM (SELECT d.doc_id AS example, "
    "unnest(regexp_split_to_array(d.text, '[ \\t\\n\\r]+')) AS feature FROM documents d "
    "WHERE d.doc_id IN (SELECT example FROM lab)) t WHERE feature <> '' GROUP BY example, feature), "
    "ns AS (SELECT count(*) AS n, sum(label) AS pos FROM lab), "
    "fs AS (SELECT p.feature, CAST(sum(p.k) AS BIGINT) AS m, CAST(sum(p.k * l.label) AS BIGINT) AS c "
    "FROM post p JOIN lab l USING (example) "
    "GROUP BY p.feature), "
    "sc AS (SELECT f.feature, f.m, f.c, CASE WHEN f.m = s.n THEN -1e30 ELSE "
    "CAST(f.m AS DOUBLE) / s.n * ((f.c / CAST(f.m AS DOUBLE)) * (1.0 - f.c / CAST(f.m AS DOUBLE))) + "
    "(CAST(s.n AS DOUBLE) - f.m) / s.n * ((CAST(s.pos - f.c AS DOUBLE) / (CAST(s.n AS DOUBLE) - f.m)) * "
    "(1.0 - CAST(s.pos - f.c AS DOUBLE) / (CAST(s.n AS DOUBLE) - f.m))) END AS score FROM fs f, ns s) "
)

_KM = (
    "WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings), "
    "c AS (SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cid, vec AS center "
    f"FROM (SELECT * FROM e ORDER BY vec_id LIMIT {C.K_CENTRES})), "
    "dists AS (SELECT e.vec_id, e.vec, c.cid, list_distance(e.vec, c.center) AS dist FROM e, c), "
    "a AS (SELECT vec_id, vec, cid, dist FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cid) "
    "AS rn FROM dists) WHERE rn = 1) "
)

_KEY_TABLES = (
    "WITH w AS (SELECT 0 AS owner, o_custkey AS key FROM orders UNION ALL SELECT 1, user_id FROM events "
    "UNION ALL SELECT 2, c_custkey FROM customer) "
)

_USERS = ("u AS (SELECT CASE WHEN user_id % 3 = 0 THEN -user_id - 1 ELSE user_id END AS key, 1 AS val FROM events), "
          "l AS (SELECT key, CAST(count(*) AS BIGINT) AS val FROM u GROUP BY key)")

_EVENTS = (
    "WITH ev AS (SELECT event_id, ts, CASE WHEN event_type = 'view' THEN 'COLLECTIVE' WHEN event_type = 'purchase' "
    f"THEN 'LOCAL' ELSE 'MESSAGE' END AS type, CAST(user_id % {C.ROUTE_WORKERS} AS INTEGER) AS source_id, "
    f"CAST(event_id % {C.ROUTE_WORKERS} AS INTEGER) AS target_id, value FROM events) "
)

_ROUTED = (
    "SELECT event_id, type, source_id, target_id, target_id AS recipient, value, ts FROM ev "
    "WHERE type = 'MESSAGE' AND target_id <> source_id AND value IS NOT NULL "
    f"UNION ALL SELECT event_id, type, source_id, target_id, CAST(w.range AS INTEGER) AS recipient, value, ts "
    f"FROM ev, range({C.ROUTE_WORKERS}) w WHERE type = 'COLLECTIVE' AND w.range <> source_id AND value IS NOT NULL "
    "UNION ALL SELECT event_id, type, source_id, source_id AS target_id, source_id AS recipient, value, ts FROM ev "
    "WHERE type = 'LOCAL' AND value IS NOT NULL"
)

# A queue's rows in order: a = events so far, p = requests so far. Of polls, as many as the largest
# excess of requests over events found the queue empty; waits are served in turn.
_QUEUES = _EVENTS + (
    f", rows AS (SELECT recipient AS worker, ts, event_id AS id, 0 AS k FROM ({_ROUTED}) UNION ALL "
    f"SELECT CAST((event_id + j.range) % {C.ROUTE_WORKERS} AS INTEGER), ts, event_id, 1 FROM ev, range(3) j), "
    "sums AS (SELECT *, sum(1 - k) OVER w AS a, sum(k) OVER w AS p FROM rows WINDOW w AS (PARTITION BY worker ORDER BY ts, id, k "
    "ROWS UNBOUNDED PRECEDING)), "
    f"lost AS (SELECT *, CASE WHEN worker < {C.ROUTE_WORKERS // 2} THEN greatest(0, max(p - a) OVER (PARTITION BY worker ORDER BY ts, id, k "
    "ROWS UNBOUNDED PRECEDING)) ELSE 0 END AS f FROM sums), "
    "steps AS (SELECT *, lag(f, 1, 0) OVER (PARTITION BY worker ORDER BY ts, id, k) AS f0 FROM lost), "
    "e AS (SELECT worker, CAST(a AS BIGINT) AS number, id AS event_id FROM steps WHERE k = 0), "
    "r AS (SELECT worker, CAST(p - f AS BIGINT) AS number, id AS request_id FROM steps WHERE k = 1 AND f = f0) "
)


def _ent(p: str) -> str:
    return f"(CASE WHEN {p} <= 0 OR {p} >= 1 THEN 0 ELSE -({p} * ln({p}) + (1 - {p}) * ln(1 - {p})) END)"


def _array_sums_sql(kind: str) -> str:
    vec = ", ".join(f"CAST({x} AS {kind})" for x in ("l_linenumber", "floor(l_quantity)", "floor(l_extendedprice)"))
    return (f"SELECT l_returnflag, CAST(i - 1 AS INTEGER) AS pos, CAST(sum(v) AS BIGINT) AS total FROM (SELECT l_returnflag, "
            f"unnest([{vec}]) AS v, unnest([1, 2, 3]) AS i FROM lineitem) GROUP BY l_returnflag, i")


def oracle_sql() -> dict[str, str]:
    fsql = forest_sql()
    return {
        "pagerank_all": pagerank_sql(),
        "pagerank_top": pagerank_sql().replace(
            "\nSELECT page, round(rank, 10) AS rank FROM r10",
            "\nSELECT page, round(rank, 10) AS rank FROM r10 ORDER BY rank DESC, page LIMIT 10"),
        "pagerank_seq": pagerank_sql(rules="sequential"),
        "top_ranks": pagerank_sql(rules="sequential").replace(
            f"\nSELECT page, round(rank, 10) AS rank FROM r{C.PR_ROUNDS}",
            f"\nSELECT page, round(rank, 10) AS rank FROM r{C.PR_ROUNDS} ORDER BY rank DESC, page LIMIT 10"),
        "pagerank_in_place": pagerank_in_place_sql(),
        "pagerank_converge": pagerank_converge_sql(),
        "out_degree_bag_set": (
            "SELECT CAST(l_suppkey AS BIGINT) AS page, count(*) AS bag, count(DISTINCT l_partkey) AS set "
            "FROM lineitem GROUP BY 1"),
        "dangling_pages": (
            f"SELECT CAST(range AS BIGINT) AS page FROM range(CAST({_N} AS BIGINT)) "
            f"WHERE range NOT IN (SELECT src FROM ({_LINKS}))"),
        "in_degree": f"SELECT dst AS page, count(*) AS in_degree FROM ({_LINKS}) GROUP BY dst",
        "out_degree": f"SELECT src AS page, count(*) AS out_degree FROM ({_LINKS}) GROUP BY src",
        "graph_degrees": (
            f"WITH l AS ({_LINKS}), i AS (SELECT dst AS vertex, count(*) AS in_degree FROM l GROUP BY dst), "
            "o AS (SELECT src AS vertex, count(*) AS out_degree FROM l GROUP BY src) "
            "SELECT coalesce(i.vertex, o.vertex) AS vertex, i.in_degree, o.out_degree "
            "FROM i FULL OUTER JOIN o ON i.vertex = o.vertex"),
        "max_node": "SELECT max(l_suppkey) AS max_src, max(l_suppkey) + 1 AS n_sources FROM lineitem",
        "generate_links": (
            "WITH n AS (SELECT count(*) AS n FROM supplier) "
            "SELECT CAST(i.range AS INTEGER) AS src, CAST(j.range AS INTEGER) AS dst "
            "FROM n, range((SELECT n FROM n)) i, range((SELECT n FROM n)) j "
            # 32-bit arithmetic that wraps, as the generator's
            f"WHERE ((((-3 * i.range * i.range + {C.LINK_GROUP + 5} + i.range + 2147483648) % 4294967296) + 4294967296) % 4294967296 "
            "- 2147483648) % (j.range + 3) = 0"),
        "word_average": (
            "SELECT word, total, count, total // count AS average FROM (SELECT event_type AS word, "
            "CAST(sum(CAST(floor(abs(value)) AS INTEGER)) AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS count "
            "FROM events GROUP BY event_type)"),
        "combine_int": (
            "SELECT l_partkey AS key, CAST(sum(CAST(floor(l_quantity) AS INTEGER)) AS BIGINT) AS val "
            "FROM lineitem GROUP BY 1"),
        "combine_long": (
            "SELECT o_custkey AS key, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS val "
            "FROM orders GROUP BY 1"),
        "combine_double": (
            "SELECT l_orderkey AS key, round(sum(l_extendedprice * (1 - l_discount)), 4) AS val "
            "FROM lineitem GROUP BY 1"),
        "combine_object": (
            "SELECT c_mktsegment AS key, round(sum(c_acctbal), 2) AS bal, CAST(count(*) AS BIGINT) AS cnt "
            "FROM customer GROUP BY 1"),
        "array_sum": (
            "SELECT label, CAST(i - 1 AS INTEGER) AS pos, round(sum(v), 6) AS total FROM (SELECT label, "
            "unnest(CAST(embedding AS DOUBLE[])) AS v, unnest(generate_series(1, len(embedding))) AS i "
            "FROM embeddings) GROUP BY label, i"),
        "allreduce_arrays": (
            "WITH n AS (SELECT label, CAST(count(*) AS BIGINT) AS n FROM embeddings GROUP BY label) "
            "SELECT s.label, CAST(i - 1 AS INTEGER) AS pos, round(sum(v), 6) AS total, n.n FROM (SELECT label, "
            "unnest(CAST(embedding AS DOUBLE[])) AS v, unnest(generate_series(1, len(embedding))) AS i "
            "FROM embeddings) s JOIN n USING (label) GROUP BY s.label, i, n.n"),
        "push": (
            "WITH " + _USERS + " SELECT key, CAST(sum(val) AS BIGINT) AS val FROM (SELECT c_custkey AS key, "
            "CAST(floor(c_acctbal) AS BIGINT) AS val FROM customer UNION ALL SELECT key, val FROM u) GROUP BY key"),
        "pull": (
            "WITH " + _USERS + ", g AS (SELECT c_custkey AS key, CAST(floor(c_acctbal) AS BIGINT) AS val FROM customer) "
            "SELECT l.key, CAST(l.val + coalesce(g.val, 0) AS BIGINT) AS val FROM l LEFT JOIN g USING (key)"),
        "push_pull_sync": (
            "WITH l AS (SELECT o_custkey AS key, count(*) AS val FROM orders GROUP BY 1), "
            "g AS (SELECT key, sum(val) AS val FROM (SELECT c_custkey AS key, CAST(floor(c_acctbal) AS BIGINT) AS val "
            "FROM customer UNION ALL SELECT key, val FROM l) GROUP BY key) "
            "SELECT l.key, CAST(l.val + g.val AS BIGINT) AS val FROM l JOIN g USING (key)"),
        "join_to_static": (
            "WITH " + _USERS + " SELECT coalesce(c.c_custkey, l.key) AS key, c.c_nationkey, l.val AS total "
            "FROM customer c FULL OUTER JOIN l ON c.c_custkey = l.key"),
        "remove_val": (
            "WITH " + _USERS + " SELECT c_custkey AS key, c_name FROM customer WHERE c_custkey NOT IN (SELECT key FROM l)"),
        "remove_returned": (
            "SELECT o_orderkey AS key, o_custkey FROM orders o WHERE NOT EXISTS "
            "(SELECT 1 FROM lineitem l WHERE l.l_returnflag = 'R' AND l.l_orderkey = o.o_orderkey)"),
        "get_val": (
            "SELECT o.o_orderkey AS key, CAST(coalesce(l.val, 0) AS BIGINT) AS val FROM orders o LEFT JOIN "
            "(SELECT l_orderkey AS key, count(*) AS val FROM lineitem GROUP BY 1) l ON l.key = o.o_orderkey"),
        "allgather": _KEY_TABLES + "SELECT key, CAST(count(*) AS BIGINT) AS n FROM w GROUP BY key",
        "reduce": _KEY_TABLES + "SELECT key, CAST(count(*) AS BIGINT) AS n, CAST(0 AS INTEGER) AS owner FROM w GROUP BY key",
        "gather": _KEY_TABLES + "SELECT owner, key, CAST(count(*) AS BIGINT) AS n FROM w GROUP BY owner, key",
        "regroup_counts": (
            f"SELECT o_custkey AS key, CAST(count(*) AS BIGINT) AS val, CAST(abs(o_custkey % {C.REGROUP_N}) AS INTEGER) "
            "AS owner FROM orders GROUP BY o_custkey"),
        "rotate_owner": (
            f"SELECT o_orderkey, CAST((o_orderkey % {C.OWNERS} + 1) % {C.OWNERS} AS INTEGER) AS owner FROM orders"),
        "partition_ids": (
            f"SELECT l_orderkey, l_linenumber, CAST(abs(l_orderkey % {C.REGROUP_N}) AS INTEGER) AS part, "
            "CAST(CASE WHEN (l_orderkey * 4294967311) % 4294967296 >= 2147483648 "
            "THEN (l_orderkey * 4294967311) % 4294967296 - 4294967296 "
            "ELSE (l_orderkey * 4294967311) % 4294967296 END AS INTEGER) AS kv_part FROM lineitem"),
        "kmeans_assign": _KM + "SELECT vec_id, cid, round(dist, 6) AS dist FROM a",
        "kmeans_error": _KM + "SELECT round(sum(dist), 6) AS error FROM a",
        "kmeans_1": _KM + (
            ", n AS (SELECT cid, count(*) AS n FROM a GROUP BY cid) "
            "SELECT s.cid, CAST(i - 1 AS INTEGER) AS pos, round(sum(v) / n.n, 6) AS value, n.n FROM "
            "(SELECT cid, unnest(vec) AS v, unnest(generate_series(1, len(vec))) AS i FROM a) s JOIN n USING (cid) "
            "GROUP BY s.cid, i, n.n"),
        "read_adjacency_last": (
            f"SELECT l_orderkey * {C.WIDE} AS src, l_partkey * {C.WIDE} AS dst FROM lineitem l WHERE l_returnflag = "
            "(SELECT max(m.l_returnflag) FROM lineitem m WHERE m.l_orderkey = l.l_orderkey)"),
        "read_sparse_labeled_wide": (
            f"SELECT o_orderkey AS example, f AS feature, o_orderkey * {C.WIDE} AS label FROM orders, "
            f"unnest([o_custkey * {C.WIDE}, CAST(day(o_orderdate) AS BIGINT)]) AS t(f)"),
        "centroid_files": _KM + (
            ", n AS (SELECT cid, count(*) AS n, row_number() OVER (ORDER BY cid) - 1 AS line FROM a GROUP BY cid) "
            "SELECT CAST(n.line AS INTEGER) AS cid, CAST(i - 1 AS INTEGER) AS pos, round(sum(v) / n.n, 6) AS value FROM "
            "(SELECT cid, unnest(vec) AS v, unnest(generate_series(1, len(vec))) AS i FROM a) s JOIN n USING (cid) "
            "GROUP BY n.line, i, n.n"),
        "rank_files": (
            f"SELECT dst AS page, count(*) / 8.0::DOUBLE AS rank, row_number() OVER (ORDER BY dst) - 1 AS line_no FROM ({_LINKS}) GROUP BY dst"),
        "read_many": f"SELECT dst AS page, count(*) / 8.0::DOUBLE AS rank FROM ({_LINKS}) GROUP BY dst",
        "ordered_ranks": f"SELECT dst AS page, count(*) / 8.0::DOUBLE AS rank FROM ({_LINKS}) GROUP BY dst ORDER BY page",
        "table_ids": "SELECT DISTINCT o_custkey AS key, false AS is_empty, true AS none_left FROM orders",
        "broadcast_table": "SELECT c_custkey, c_nationkey, n_regionkey FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey",
        "lists_by_key": (
            "SELECT key, CAST(r // 7 AS INTEGER) AS chunk, CAST(r % 7 AS INTEGER) AS pos, val FROM (SELECT key, val, row_number() OVER "
            "(PARTITION BY key ORDER BY val) - 1 AS r FROM (SELECT o_custkey AS key, o_orderkey AS val FROM orders "
            "UNION ALL SELECT user_id, event_id FROM events))"),
        "user_combiner_gcd": (
            "SELECT l_partkey AS key, list_reduce(list(CAST(l_quantity AS BIGINT) * 6), lambda a, b: gcd(a, b)) AS val "
            "FROM lineitem GROUP BY l_partkey"),
        "kmeans_assign_many": _KM.replace(f"LIMIT {C.K_CENTRES}", f"LIMIT {C.MANY_CENTRES}") + (
            "SELECT vec_id, cid, round(dist, 6) AS dist FROM a"),
        "forest_files": fsql + (
            "\nSELECT tree, node, CAST(floor(log2(node)) AS INTEGER) AS depth, feature, is_leaf, prediction FROM nodes"),
        "push_stored": (
            "WITH " + _USERS + " SELECT key, CAST(sum(val) AS BIGINT) AS val FROM (SELECT c_custkey AS key, "
            "CAST(floor(c_acctbal) AS BIGINT) AS val FROM customer UNION ALL SELECT key, val FROM u) GROUP BY key"),
        "task_activity": (
            "WITH " + _USERS + ", o AS (SELECT o_custkey AS key, count(*) AS n FROM orders GROUP BY 1) "
            "SELECT coalesce(o.key, l.key) AS key, CASE WHEN l.key IS NULL THEN 'orders' WHEN o.key IS NULL THEN 'events' ELSE 'both' END "
            "AS kind, CAST(10 * coalesce(o.n, 0) + coalesce(l.val, 0) AS BIGINT) AS score FROM o FULL OUTER JOIN l ON o.key = l.key"),
        "array_sum_wide": (
            "SELECT label, CAST(i - 1 AS INTEGER) AS pos, round(sum(v), 6) AS total FROM (SELECT label, "
            "unnest(CAST(embedding AS DOUBLE[])) AS v, unnest(generate_series(1, len(embedding))) AS i "
            "FROM embeddings) GROUP BY label, i"),
        "kmeans_rounds": kmeans_rounds_sql(),
        "tree_size": fsql + "\nSELECT mean_size FROM tsize",
        "forest_nodes": fsql + "\nSELECT tree, node, feature, is_leaf, prediction FROM nodes",
        "split_scores_entropy": _ROOT.format(k="CAST(1 AS BIGINT)").replace(
            "CAST(f.m AS DOUBLE) / s.n * ((f.c / CAST(f.m AS DOUBLE)) * (1.0 - f.c / CAST(f.m AS DOUBLE))) + "
            "(CAST(s.n AS DOUBLE) - f.m) / s.n * ((CAST(s.pos - f.c AS DOUBLE) / (CAST(s.n AS DOUBLE) - f.m)) * "
            "(1.0 - CAST(s.pos - f.c AS DOUBLE) / (CAST(s.n AS DOUBLE) - f.m)))",
            "CAST(f.m AS DOUBLE) / s.n * ent(f.c / CAST(f.m AS DOUBLE)) + (CAST(s.n AS DOUBLE) - f.m) / s.n * "
            "ent(CAST(s.pos - f.c AS DOUBLE) / (CAST(s.n AS DOUBLE) - f.m))").replace(
            "ent(f.c / CAST(f.m AS DOUBLE))", _ent("(f.c / CAST(f.m AS DOUBLE))")).replace(
            "ent(CAST(s.pos - f.c AS DOUBLE) / (CAST(s.n AS DOUBLE) - f.m))",
            _ent("(CAST(s.pos - f.c AS DOUBLE) / (CAST(s.n AS DOUBLE) - f.m))")) + (
            "SELECT feature, m, c, CASE WHEN score = -1e30 THEN score ELSE round(score, 9) END AS score FROM sc"),
        "majority_toxic": (
            "SELECT lang, n, pos, CASE WHEN n - pos > pos THEN 0 ELSE 1 END AS majority, "
            "(pos = 0 OR pos = n) AS pure FROM (SELECT d.lang, count(*) AS n, CAST(sum(l.toxic) AS BIGINT) AS pos "
            "FROM labels l JOIN documents d USING (doc_id) GROUP BY d.lang)"),
        "read_adjacency": f"SELECT CAST(src AS INTEGER) AS src, CAST(dst AS INTEGER) AS dst FROM ({_LINKS})",
        "pagerank_adjacency": pagerank_sql(),
        "read_vectors": (
            "SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, round(v, 6) AS total FROM (SELECT vec_id, "
            "unnest(CAST(embedding AS DOUBLE[])) AS v, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)"),
        "combine_long_int": (
            "SELECT l_orderkey * 4294967311 AS key, CAST(sum(l_linenumber) AS BIGINT) AS val FROM lineitem GROUP BY 1"),
        "array_sum_int": _array_sums_sql("INTEGER"),
        "array_sum_long": _array_sums_sql("BIGINT"),
        "user_combiner": (
            "SELECT key, val FROM (SELECT o_custkey AS key, o_orderpriority AS val, row_number() OVER (PARTITION BY o_custkey "
            "ORDER BY length(o_orderpriority) DESC, o_orderpriority DESC) AS rn FROM orders) WHERE rn = 1"),
        "concat_lists": "SELECT o_custkey AS key, o_orderkey AS val FROM orders UNION ALL SELECT user_id, event_id FROM events",
        "regroup_finish": (
            "WITH " + _USERS + f" SELECT key, val // 2 AS val, CAST(abs(key % {C.REGROUP_N}) AS INTEGER) AS owner FROM l"),
        "reject_nulls": "WITH " + _USERS + " SELECT key, val FROM l WHERE key % 5 <> 0",
        "split_scores_set": _ROOT.format(k="CAST(1 AS BIGINT)") + (
            "SELECT feature, m, c, CASE WHEN score = -1e30 THEN score ELSE round(score, 9) END AS score FROM sc"),
        "split_scores": _ROOT.format(k="count(*)") + ("SELECT feature, m, c, CASE WHEN score = -1e30 THEN score ELSE round(score, 9) END "
                                 "AS score FROM sc"),
        "best_split": _ROOT.format(k="count(*)") + ("SELECT feature, CASE WHEN score = -1e30 THEN score ELSE round(score, 9) END AS score FROM "
                               "(SELECT * FROM sc ORDER BY score, feature LIMIT 1)"),
        "majority": (
            "SELECT lang, n, pos, CASE WHEN n - pos > pos THEN 0 ELSE 1 END AS majority, "
            "(pos = 0 OR pos = n) AS pure FROM (SELECT d.lang, count(*) AS n, CAST(sum(l.quality) AS BIGINT) AS pos "
            "FROM labels l JOIN documents d USING (doc_id) GROUP BY d.lang)"),
        "forest_predict": fsql + "\nSELECT example, prediction FROM preds",
        "accuracy": fsql + (
            "\nSELECT CAST(count_if(p.prediction = l.label) AS BIGINT) AS hits, count(*) AS total, "
            "round(count_if(p.prediction = l.label) / count(*), 9) AS accuracy, "
            "CAST(count_if(p.prediction = 1 AND l.label = 1) AS BIGINT) AS tp, "
            "CAST(count_if(p.prediction = 1 AND l.label = 0) AS BIGINT) AS fp, "
            "CAST(count_if(p.prediction = 0 AND l.label = 0) AS BIGINT) AS tn, "
            "CAST(count_if(p.prediction = 0 AND l.label = 1) AS BIGINT) AS fn "
            "FROM preds p JOIN lab l USING (example)"),
        "read_sparse_labeled": (
            "SELECT o_orderkey AS example, CAST(f AS INTEGER) AS feature, "
            "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label FROM orders, "
            "unnest([o_custkey, CAST(floor(o_totalprice) AS BIGINT), day(o_orderdate)]) AS t(f)"),
        "stream_route": _EVENTS + f"SELECT * EXCLUDE (ts) FROM ({_ROUTED})",
        "event_queue": _QUEUES + "SELECT worker, number, event_id, request_id FROM e LEFT JOIN r USING (worker, number)",
        "event_queue_empty": _QUEUES + (
            "SELECT worker, id AS request_id, 'empty' AS outcome FROM steps WHERE k = 1 AND f > f0 UNION ALL "
            f"SELECT worker, request_id, 'waiting' FROM r WHERE worker >= {C.ROUTE_WORKERS // 2} AND NOT EXISTS "
            "(SELECT 1 FROM e WHERE e.worker = r.worker AND e.number = r.number)"),
    }
