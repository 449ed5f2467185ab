import numpy as np
import pytest

from corvid.operators.graph import top_ranks
from corvid.plans.pagerank import pagerank, prepare_adjacency, prepare_edges
from corvid.sources.generate import generate_links
from corvid.sources.text import read_adjacency


#: An 11-page graph, a line a page, and its ranks under the sequential rules.
ELEVEN = """0
1 2
2 1
3 0 1
4 1 3 5
5 1 4
6 1 4
7 1 4
8 1 4
9 4
10 4
"""
ELEVEN_RANKS = [0.03327333490504069, 0.4255694609123263, 0.37987652340539785, 0.0429960821295075, 0.0877185899985423,
                0.0429960821295075, 0.018142481629920514, 0.018142481629920514, 0.018142481629920514, 0.018142481629920514,
                0.015000000000000003]
#: The ten highest (page, rank) of the 1000-page graph of the link rule, group 26, under the
#: MPI rules, stopped at delta 0.001.
TOP_TEN = [(10, 0.09486740923368685), (0, 0.07762038494622278), (28, 0.0756789150703395), (4, 0.07530036499362075),
           (34, 0.035330409976054834), (256, 0.027954805515867605), (134, 0.025562889602343323), (38, 0.02214731669166356),
           (14, 0.020386315713293673), (68, 0.01916566798476589)]


def test_mpi_rules_top10(spark):
    """I1 on the 1000-page graph stops after 9 rounds at delta 0.001 and gives the known top ten."""
    res = pagerank(prepare_adjacency(generate_links(spark, 1000, 26), "mpi"), delta=0.001, iterations=10)
    assert res.rounds == 9
    got = [(r.page, r.rank) for r in top_ranks(res.ranks, 10).collect()]
    assert [p for p, _ in got] == [p for p, _ in TOP_TEN]
    assert max(abs(a[1] - b[1]) for a, b in zip(got, TOP_TEN)) < 1e-12


def test_sequential_rules_fixed_point(spark, tmp_path):
    """I2 on 11 pages read from a file: the known ranks are the fixed point of the sequential rules."""
    (tmp_path / "links").write_text(ELEVEN)
    adj = read_adjacency(spark, str(tmp_path / "links"))
    res = pagerank(prepare_adjacency(adj, "sequential"), delta=1e-11, max_rounds=400)
    got = {r.page: r.rank for r in res.ranks.collect()}
    assert set(got) == set(range(11))
    assert max(abs(got[k] - v) for k, v in enumerate(ELEVEN_RANKS)) < 1e-9
    assert abs(sum(got.values()) - 1.1) < 1e-9


def test_salted_shuffle_path_matches_broadcast_path(spark):
    """Forcing the large-graph layout (rank side shuffled, every source salted, or none) changes nothing."""
    adj = generate_links(spark, 1000, 26)
    g = prepare_adjacency(adj, "mpi")
    a = pagerank(g, delta=-1, max_rounds=4)
    ra = {r.page: r.rank for r in a.ranks.collect()}
    for least in (1, 100_000):
        b = pagerank(g, delta=-1, max_rounds=4, broadcast_bytes=0, skew_min_rows=least, partitions=4)
        rb = {r.page: r.rank for r in b.ranks.collect()}
        assert ra.keys() == rb.keys()
        assert max(abs(ra[k] - rb[k]) for k in ra) < 1e-15


def test_edge_list_graph_mass_is_conserved(spark):
    """Every page is a node; dangling mass is spread in closed form, ranks sum to 1."""
    edges = spark.createDataFrame([(0, 1), (1, 2), (2, 0), (3, 0)], "src int, dst int")
    res = pagerank(prepare_edges(edges, 6), delta=-1, max_rounds=12)
    ranks = {r.page: r.rank for r in res.ranks.collect()}
    assert len(ranks) == 6 and res.rounds == 12
    assert abs(sum(ranks.values()) - 1.0) < 1e-12


def test_iterations_countdown_forces_one_round(spark):
    """The MPI countdown: round iterations+1 always continues, even when converged."""
    edges = spark.createDataFrame([(0, 1), (1, 0)], "src int, dst int")
    g = prepare_edges(edges, 2)
    assert pagerank(g, delta=0.5, iterations=5).rounds == 1
    assert pagerank(g, delta=0.5, iterations=0).rounds == 2


def test_missing_targets_rejected_under_mpi_rules(spark):
    adj = spark.createDataFrame([(0, [1, 7]), (1, [0])], "src int, dst array<int>")
    with pytest.raises(ValueError):
        prepare_adjacency(adj, "mpi")
    res = pagerank(prepare_adjacency(adj, "mpi", allow_missing=True), delta=-1, max_rounds=3)
    assert res.ranks.count() == 2


def _dense_mpi(n, edges, d=0.85, rounds=10):
    """Brute force: the MPI rules with dangling pages expanded to every other page."""
    import numpy as np
    out = {s: [] for s in range(n)}
    for s, t in edges:
        out[s].append(t)
    m = np.zeros((n, n))
    for s in range(n):
        targets = out[s] or [t for t in range(n) if t != s]
        for t in targets:
            m[t, s] += 1.0 / len(targets)
    r = np.full(n, 1.0 / n)
    for _ in range(rounds):
        r = (1 - d) / n + d * (m @ r)
    return r


def test_hot_source_and_hot_target_match_brute_force(spark):
    """A star: page 0 links to a third of the graph and a third links to page 1. Both
    layouts, with the hot keys salted, equal the dense computation."""
    n = 60
    edges = [(0, t) for t in range(2, 22)] + [(s, 1) for s in range(22, 42)] + [(s, (s * 7) % n) for s in range(42, 50)]
    edges = [(s, t) for s, t in edges if s != t]
    want = _dense_mpi(n, edges)
    df = spark.createDataFrame(edges, "src int, dst int")
    g = prepare_edges(df, n, distinct=False)
    for kw in ({}, {"skew_min_rows": 1, "partitions": 4},
               {"broadcast_bytes": 0, "skew_min_rows": 1, "partitions": 4}):
        got = {r.page: r.rank for r in pagerank(g, delta=-1, max_rounds=10, **kw).ranks.collect()}
        assert max(abs(got[p] - want[p]) for p in range(n)) < 1e-14, kw


def test_sequential_rules_1000_pages(spark):
    """I2 on the 1000-page graph (its last page is dangling) against a dense loop."""
    adj = generate_links(spark, 1000, 26)
    res = pagerank(prepare_adjacency(adj, "sequential"), delta=1e-10, max_rounds=400)
    want = _dense_sequential({r.src: r.dst for r in adj.collect()})
    got = {r.page: r.rank for r in res.ranks.collect()}
    assert set(got) == set(range(1000))
    assert max(abs(got[k] - want[k]) for k in got) < 1e-8


def _dense_sequential(adj, d=0.85, rounds=300):
    """Brute force of the sequential rules, parallel form: pages 0..M, teleport (1-d)/M,
    a dangling key lists 0..M-1 without itself, a repeated target counts once in the sum
    but fully in the degree; gap pages only receive."""
    import numpy as np
    m = max(adj)
    n = m + 1
    mat = np.zeros((n, n))
    for s, targets in adj.items():
        lst = targets or [i for i in range(m) if i != s]
        for t in set(lst):
            if 0 <= t <= m:
                mat[t, s] += 1.0 / len(lst)
    r = np.full(n, float(np.float32(1.0) / np.float32(n)))
    for _ in range(rounds):
        r = (1 - d) / m + d * (mat @ r)
    return r


def test_repeats_gaps_and_dangling_against_brute_force(spark):
    adj = {0: [1, 1, 2], 1: [], 2: [0, 5], 3: [2, 2, 2, 1], 5: []}   # 4 is a gap, 5 = M is dangling
    df = spark.createDataFrame(sorted(adj.items()), "src int, dst array<int>")
    want = _dense_sequential(adj)
    got = {r.page: r.rank for r in pagerank(prepare_adjacency(df, "sequential"), delta=1e-15, max_rounds=300).ranks.collect()}
    assert max(abs(got[p] - want[p]) for p in range(6)) < 1e-12
    # MPI rules with repeats counted each time: the dense form with bag contributions.
    edges = [(s, t) for s, ts in adj.items() for t in ts]
    mpi = {r.page: r.rank for r in pagerank(prepare_adjacency(df, "mpi", allow_missing=True), delta=-1,
                                            max_rounds=10).ranks.collect()}
    import numpy as np
    n = 6
    mat = np.zeros((n, n))
    for s, ts in adj.items():
        lst = ts or [t for t in range(n) if t != s]
        for t in lst:
            mat[t, s] += 1.0 / len(lst)
    r = np.full(n, 1.0 / n)
    for _ in range(10):
        r = 0.15 / n + 0.85 * (mat @ r)
    assert max(abs(mpi[p] - r[p]) for p in range(n)) < 1e-14 and len(edges) > 0


def test_loop_leaves_the_callers_session_alone(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        e = spark.createDataFrame([(0, 1), (1, 2), (2, 0), (3, 0)], "src bigint, dst bigint")
        before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
        got = pagerank(prepare_edges(e, 4), delta=1e-6)
        assert {k: spark.conf.get(k) for k in before} == before
        assert got.ranks.sparkSession is spark and not spark.catalog.listTables("global_temp")
        assert abs(got.ranks.agg({"rank": "sum"}).first()[0] - 1) < 1e-3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def _in_place_loop(adj, n, rounds, d=0.85):
    """The sequential program's rounds in plain Python."""
    m = n - 1
    lists = {k: (v if v else [i for i in range(m) if i != k]) for k, v in adj.items()}
    rank = {k: float(np.float32(1.0) / np.float32(n)) for k in adj}
    for _ in range(rounds):
        for p in range(n):
            rank[p] = (1 - d) / m + d * sum(rank[k] / len(v) for k, v in lists.items() if p in v)
    return rank


@pytest.mark.parametrize("block", [None, 3])
def test_in_place_rounds_equal_the_loop(spark, block):
    """Eleven pages: cycles, a self link, repeated targets, links up and down, two dangling
    pages (one of them the last), for blocks of any length and after each of three rounds."""
    from corvid.plans.inplace import pagerank_in_place

    adj = {0: [], 1: [2], 2: [1, 1, 5], 3: [0, 1], 4: [1, 3, 5], 5: [1, 4, 5], 6: [1, 4], 7: [1, 4], 8: [9, 4], 9: [4, 10], 10: []}
    df = spark.createDataFrame(list(adj.items()), "src int, dst array<int>")
    g = prepare_adjacency(df, "sequential")
    for rounds in (1, 3) if block in (None, 3) else (2,):
        want = _in_place_loop(adj, 11, rounds)
        got = {r.page: r.rank for r in pagerank_in_place(g, rounds, block_pages=block).collect()}
        assert got.keys() == want.keys() and max(abs(got[p] - want[p]) for p in want) < 1e-15
    jacobi = {r.page: r.rank for r in pagerank(g, delta=-1, max_rounds=rounds).ranks.collect()}
    assert max(abs(jacobi[p] - want[p]) for p in want) > 1e-4


def test_block_length_follows_inner_links(spark):
    from corvid.plans import inplace

    edges = spark.createDataFrame([(i, i + 1) for i in range(6000)] + [(0, i) for i in range(2, 6000)], "src bigint, dst bigint")
    assert inplace.block_length(edges) == inplace.BLOCK_PAGES
    assert inplace.block_length(edges, block_edges=9000) == 4096
    assert inplace.block_length(edges, block_edges=10) == inplace.LEAST_PAGES and inplace.block_length(edges, 8) == 8


def test_in_place_blocks_broadcast_nothing(spark, monkeypatch):
    """a block's job joins without a broadcast, which would pass the driver in every block of
    every round, and reads ranks of blocks that link into it only."""
    from pyspark.sql import DataFrameWriter

    from corvid.plans.inplace import pagerank_in_place

    plans, write = [], DataFrameWriter.parquet

    def noted(self, path, *a, **k):
        if "/block=" in path:
            plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    links = {0: [1, 4, 9], 1: [0, 8], 5: [2], 9: [0, 3]}
    e = spark.createDataFrame([(s, d) for s, ds in links.items() for d in ds], "src int, dst int")
    got = {r.page: r.rank for r in pagerank_in_place(prepare_edges(e, 11, rules="sequential"), 2, block_pages=4).collect()}
    want = _in_place_loop({**{p: [] for p in range(11)}, **links}, 11, 2)
    assert got == pytest.approx(dict(enumerate(want)) if isinstance(want, list) else want)
    assert len(plans) == 6 and not any("Broadcast" in p for p in plans)


def test_adjacency_lines_are_parsed_once(spark, monkeypatch):
    """degrees, links and pages come from one reading of the lines."""
    from corvid.plans import catalog

    seen = spark.sparkContext.accumulator(0)

    def noted(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    lines = spark.createDataFrame([("\t0 1 2",), ("\t1 2",), ("\t3 0",)], "value string").mapInPandas(noted, "value string")
    monkeypatch.setattr(catalog, "_adjacency_lines", lambda *_: (lines, 5))
    ranks = {r.page: r.rank for r in catalog.q_pagerank_adjacency(spark, "").collect()}
    assert len(ranks) == 5 and sum(ranks.values()) == pytest.approx(1) and seen.value == 3
