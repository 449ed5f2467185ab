import pytest

from conftest import SF
from corvid.sources.text import labelled_postings, read_adjacency, read_sparse_labeled, read_vectors, with_line_index
from corvid.streaming.route import route, start_routing


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_adjacency_last_line_wins_and_cut_at_non_int(spark, tmp_path):
    p = _write(tmp_path, "adj.txt", "0 1 2\n1 0 x 2\n0 2\n2\n")
    got = {r.src: r.dst for r in read_adjacency(spark, p).collect()}
    assert got == {0: [2], 1: [0], 2: []}


def test_ids_beyond_32_bits_are_kept(spark, tmp_path):
    big = (1 << 31) + 5
    p = _write(tmp_path, "wide.txt", f"0 1 {big} 2\n{big} 0\n")
    assert {r.src: r.dst for r in read_adjacency(spark, p).collect()} == {0: [1, big, 2], big: [0]}
    p = _write(tmp_path, "wide_labelled.txt", f"1 3:{big} -{big} 4\n{big} 7\n")
    labels, post = read_sparse_labeled(spark, p)
    assert sorted((r.example, r.label) for r in labels.collect()) == [(0, 1), (1, big)]
    rows = [(0, 3), (0, 4), (0, big), (0, big), (1, 7)]
    assert sorted((r.example, r.feature) for r in post.collect()) == rows
    one = labelled_postings(with_line_index(spark.read.text(p))).collect()
    assert sorted((r.example, r.feature, r.label) for r in one) == [(e, f, big if e else 1) for e, f in rows]
    p = _write(tmp_path, "too_wide.txt", f"0 1 {1 << 63} 2\n")
    with pytest.raises(Exception, match="beyond 64 bits"):
        read_adjacency(spark, p).collect()


def test_adjacency_lines_are_bounded(spark, monkeypatch):
    from corvid.plans import catalog
    from corvid.plans.catalog import _adjacency_lines, _link_graph, q_read_adjacency
    monkeypatch.setattr(catalog, "LINE_TARGETS", 16)
    lines = [r.value.split() for r in _adjacency_lines(spark, f"{SF}/sf0.001")[0].collect()]
    assert max(map(len, lines)) <= 17 and len({x[0] for x in lines}) < len(lines)
    want = sorted((r.src, r.dst) for r in _link_graph(spark, f"{SF}/sf0.001")[0].collect())
    assert sorted((r.src, r.dst) for r in q_read_adjacency(spark, f"{SF}/sf0.001").collect()) == want


def test_adjacency_blank_line_fails(spark, tmp_path):
    p = _write(tmp_path, "bad.txt", "0 1\n\n1 0\n")
    with pytest.raises(Exception):
        read_adjacency(spark, p).collect()


def test_vectors_width_checked(spark, tmp_path):
    p = _write(tmp_path, "v.txt", "1 2 3\n4 5\n")
    with pytest.raises(Exception):
        read_vectors(spark, p, 3).collect()


def test_line_index_spans_files_in_order(spark, tmp_path):
    a = _write(tmp_path, "a.txt", "".join(f"{i}\n" for i in range(5)))
    b = _write(tmp_path, "b.txt", "".join(f"{i}\n" for i in range(5, 9)))
    rows = with_line_index(spark.read.text([b, a])).collect()
    assert sorted((r.line_no, int(r.value)) for r in rows) == [(i, i) for i in range(9)]


def test_sparse_labeled_colon_and_negative(spark, tmp_path):
    p = _write(tmp_path, "s.txt", "1 3:4 -5 3\n0\n")
    labels, post = read_sparse_labeled(spark, p)
    assert sorted((r.example, r.label) for r in labels.collect()) == [(0, 1), (1, 0)]
    assert sorted((r.example, r.feature) for r in post.collect()) == [(0, 3), (0, 3), (0, 4), (0, 5)]


def _events(spark, df):
    from pyspark.sql import functions as F
    t = (F.when(F.col("event_type") == "view", F.lit("COLLECTIVE"))
         .when(F.col("event_type") == "purchase", F.lit("LOCAL")).otherwise(F.lit("MESSAGE")))
    return df.select("event_id", t.alias("type"), F.col("event_type").alias("context"),
                     (F.col("user_id") % 4).cast("int").alias("source_id"),
                     (F.col("event_id") % 4).cast("int").alias("target_id"), F.array("value").alias("body"))


def test_route_rules(spark):
    ev = spark.createDataFrame(
        [(1, "MESSAGE", 0, 0, [1.0]), (2, "MESSAGE", 0, 1, [1.0]), (3, "MESSAGE", 0, 2, None),
         (4, "COLLECTIVE", 1, 0, [1.0]), (5, "LOCAL", 2, 3, [1.0])],
        "event_id int, type string, source_id int, target_id int, body array<double>")
    got = sorted((r.event_id, r.recipient, r.target_id) for r in route(ev, 3).collect())
    assert got == [(2, 1, 1), (4, 0, 0), (4, 2, 0), (5, 2, 2)]


def test_stream_and_batch_routing_agree(spark, tmp_path):
    src = f"{SF}/sf0.001/events.parquet"
    batch = sorted(tuple(r) for r in route(_events(spark, spark.read.parquet(src)), 4)
                   .select("event_id", "recipient").collect())
    schema = spark.read.parquet(src).schema
    # A file stream watches a folder: stage the table's rows as one.
    spark.read.parquet(src).write.parquet(str(tmp_path / "in"))
    stream = _events(spark, spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    q = start_routing(stream, 4, str(tmp_path / "ckpt"), str(tmp_path / "out"))
    q.awaitTermination(120)
    streamed = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("event_id", "recipient").collect())
    assert streamed == batch and len(batch) > 0
    # A restart from the same checkpoint resumes where it stopped: nothing is routed twice.
    q = start_routing(stream, 4, str(tmp_path / "ckpt"), str(tmp_path / "out"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(batch)


def test_rank_and_centroid_sinks(spark, tmp_path):
    from corvid.sources.sinks import centroid_lines, write_centroids, write_ranks
    ranks = spark.createDataFrame([(2, 0.25), (0, 0.5), (1, 0.25)], "page int, rank double")
    write_ranks(ranks, str(tmp_path / "ranks"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "ranks")).collect()]
    assert sorted(lines) == ["0\t0.5", "1\t0.25", "2\t0.25"]
    cen = spark.createDataFrame([(1, [3.0, 4.5]), (0, [1.0, 2.0])], "cid int, center array<double>")
    assert [r.value for r in centroid_lines(cen).collect()] == ["1.0\t2.0\t", "3.0\t4.5\t"]
    write_centroids(cen, str(tmp_path / "cen"))
    assert spark.read.text(str(tmp_path / "cen")).count() == 2


def test_poll_reads_one_workers_deliveries(spark, tmp_path):
    from corvid.streaming.route import poll
    ev = spark.createDataFrame([(1, "COLLECTIVE", 0, 0, [1.0])],
                               "event_id int, type string, source_id int, target_id int, body array<double>")
    route(ev, 3).createOrReplaceTempView("routed_events")
    assert [r.recipient for r in poll(spark, "routed_events", 2).collect()] == [2]


def test_tree_ranges(spark):
    from corvid.operators.forest import tree_ranges
    got = [(r.tree, r.split) for r in tree_ranges(spark, 5, 2).orderBy("tree").collect()]
    assert got == [(0, 0), (1, 0), (2, 0), (3, 1), (4, 1)]


def test_line_index_across_splits_of_one_file(spark, tmp_path):
    """Line numbers stay exact when one file is read as many splits."""
    p = _write(tmp_path, "big.txt", "".join(f"{i} {i + 1}\n" for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        df = spark.read.text(p)
        assert df.rdd.getNumPartitions() > 4
        rows = with_line_index(df).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.line_no, int(r.value.split()[0])) for r in rows) == [(i, i) for i in range(3000)]


def test_queues_deliver_once_across_a_restart(spark, tmp_path):
    """Files arrive one by one, the query is stopped between them: numbering goes on from
    the stored cursors and equals one run over plain Python queues."""
    import random
    from collections import deque

    from corvid.streaming import queue

    rng = random.Random(4)
    schema = "worker int, ts bigint, id bigint, kind string"
    rows = [(rng.randint(0, 2), t, t * 2 + 1, rng.choice(["event", "event", "poll", "wait", "poll"])) for t in range(90)]
    rows += [(0, 30, 900, "event"), (0, 30, 900, "poll"), (None, 31, 901, "event"), (7, 40, 902, "poll"), (8, 41, 903, "wait")]
    rows.sort(key=lambda r: (r[1], r[2]))
    parts = [[r for r in rows if a <= r[1] < a + 30] for a in (0, 30, 60)]
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run = lambda: queue.start_queues(stream(), str(tmp_path / "ck"), str(tmp_path / "out")).awaitTermination(120)
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        run()
    run()  # a restart without new rows adds nothing
    waits, polls, queues, taken, empty = {}, {}, {}, {}, []
    for w, _, i, kind in rows:
        if w is None:
            continue
        q, pending = queues.setdefault(w, deque()), waits.setdefault(w, deque())
        if kind == "event":
            if pending:
                taken[w, i] = pending.popleft()
            else:
                q.append(i)
        elif q:
            taken[w, q.popleft()] = i
        elif kind == "wait":
            pending.append(i)
        else:
            empty.append((w, i))
    want = {**{(w, i): None for w, q in queues.items() for i in q}, **taken}
    got = queue.deliveries(spark, str(tmp_path / "out")).collect()
    assert {(r.worker, r.event_id): r.request_id for r in got} == want and len(got) == len(want)
    assert sorted((r.worker, r.request_id) for r in queue.empty_polls(spark, str(tmp_path / "out")).collect()) == sorted(empty)
    assert sorted((r.worker, r.request_id) for r in queue.waiting(spark, str(tmp_path / "out")).collect()) == sorted(
        (w, i) for w, q in waits.items() for i in q)
    assert len(empty) > 3 and len(taken) > 20


def test_queue_numbering_holds_one_batch():
    """a worker's rows are numbered as they pass; two counters go from batch to batch."""
    import pyarrow as pa

    from corvid.streaming import queue

    E, P, W, H = queue._EVENT, queue._POLL, queue._WAIT, queue._HELD
    made = []

    def batches():
        for worker, kinds in (([1, 1, 1], [H, P, E]), ([1, 1, 2], [E, W, P]), ([2, 2, 2], [W, W, E]), ([3], [E])):
            made.append(len(worker))
            n = len(worker)
            yield pa.RecordBatch.from_pydict({"worker": pa.array(worker, pa.int32()), "kind": ["x"] * n, "id": list(range(n)), "_k": pa.array(kinds, pa.int32()),
                                              "_arrived": [10] * n, "_taken": [10] * n})

    out = queue._step(batches())
    got = []
    for k in range(1, 5):
        got.append(next(out).to_pydict())
        assert len(made) == k   # nothing is read ahead
    assert [g["number"] for g in got] == [[None, 11], [12, 11, None], [1, 2, 1], [1]]
    assert [g["worker"] for g in got] == [[1, 1], [1, 1, 2], [2, 2, 2], [3]]


def test_a_repeated_micro_batch_changes_nothing(spark, tmp_path):
    """the counters after a micro-batch come from the ones before it, so it can run twice."""
    from corvid.streaming import queue

    schema = "worker int, ts bigint, id bigint, kind string"
    one = spark.createDataFrame([(1, 1, 1, "event"), (1, 2, 2, "wait"), (1, 2, 3, "wait"), (2, 1, 4, "poll"), (None, 1, 5, "event")], schema)
    two = spark.createDataFrame([(1, 3, 6, "event"), (1, None, 7, "event"), (1, None, 8, "poll"), (3, 1, 9, "poll")], schema)
    for rows, k in ((one, 0), (two, 1), (two, 1)):
        queue._written(str(tmp_path / "c"), str(tmp_path / "out"), rows, k)
    assert sorted(map(tuple, queue.deliveries(spark, str(tmp_path / "out")).collect())) == [(1, 1, 1, 2), (1, 2, 6, 3), (1, 3, 7, 8)]
    assert sorted(map(tuple, queue.empty_polls(spark, str(tmp_path / "out")).collect())) == [(2, 4), (3, 9)]
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "c/1")).collect())) == [(1, 3, 3), (2, 0, 0), (3, 0, 0)]
