from corvid.sources.generate import generate_links, generate_points, generate_random_edges, links_text


def test_link_lines_against_a_loop(spark):
    """Every line of the rule's file, page after page, in 32-bit arithmetic."""
    def int32(x):
        return (x + 2**31) % 2**32 - 2**31

    for n, group in ((1000, 0), (1000, 26), (40, 13)):
        lines = [r.value for r in links_text(generate_links(spark, n, group).orderBy("src")).collect()]
        rule = [int32(int32(-3 * int32(i * i)) + group + 5 + i) for i in range(n)]
        assert lines == [" ".join(map(str, [i] + [j for j in range(n) if rule[i] % (j + 3) == 0])) for i in range(n)]


def test_points_and_random_edges(spark):
    pts = generate_points(spark, 103, 3, 4, seed=1)
    assert pts.rdd.getNumPartitions() == 4 and pts.count() == 103
    sizes = sorted((r.file, r["count"]) for r in pts.groupBy("file").count().collect())
    assert sizes == [(0, 26), (1, 26), (2, 26), (3, 25)]
    vals = [x for r in pts.collect() for x in r.features]
    assert min(vals) >= 0 and max(vals) < 10
    e = generate_random_edges(spark, 5, 200, seed=2).collect()
    assert all(r.src != r.dst and 0 <= r.dst < 5 for r in e)


def test_chunked_generator_equals_single_pass(spark):
    one = {r.src: r.dst for r in generate_links(spark, 300, 7).collect()}
    chunked = {r.src: r.dst for r in generate_links(spark, 300, 7, chunk=64).collect()}
    assert one == chunked and sum(len(d) for d in one.values()) > 0


def test_links_by_divisors_without_trying_every_page(spark, monkeypatch):
    """no list of n candidates per page is made (2,000 pages of 400,000 would be 800 million
    tests); the targets are the divisors in range, of values beyond and below the pages' number."""
    import numpy as np
    import pyspark.sql.functions as F

    from corvid.sources import generate

    monkeypatch.setattr(F, "sequence", None)  # what the candidates were made by
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.integers(1, 1 << 31, 40), [1, 2, 3, 4, 46337**2, 46349 * 46327, 2**31, 2**31 - 1, 2 * 715827881, 399989]])
    d = np.arange(1, 400_003)
    assert generate.divisors(values, 400_002) == [d[v % d == 0].tolist() for v in values]
    assert generate.divisors(values, 50) == [[k for k in range(1, 51) if v % k == 0] for v in values]
    got = {r.src: r.dst for r in generate_links(spark, 400_000, 26).filter("src % 20011 = 7").collect()}
    rule = {i: (-3 * i * i + 31 + i + 2**31) % 2**32 - 2**31 for i in got}
    assert len(got) == 20 and got == {i: (d[2:][rule[i] % d[2:] == 0] - 3).tolist() for i in got}
    # Group -5: page 0 has the value 0 and links to every page.
    assert {r.src: r.dst for r in generate_links(spark, 50, -5).collect()}[0] == list(range(50))
