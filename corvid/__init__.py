"""corvid: link-graph ranking, clustering, forests and keyed tables as Spark DataFrame plans.

Entry points::

    from corvid import build_session, read_adjacency, prepare_adjacency, pagerank
    ranks = pagerank(prepare_adjacency(read_adjacency(spark, path), "mpi"), delta=0.001).ranks

See README.md for the module map and the design notes.
"""

from corvid.operators import forest, graph, keyed
from corvid.plans.collectives import graph_degrees, push_pull_sync, word_average
from corvid.plans.forest import load_forest, predict, save_forest, train_forest
from corvid.plans.kmeans import assign_nearest, kmeans
from corvid.plans.pagerank import pagerank, prepare_adjacency, prepare_edges
from corvid.session import build_session, checkpoint_dir
from corvid.sources.generate import generate_centroids, generate_links, generate_points, generate_random_edges
from corvid.sources.sinks import write_centroids, write_ranks
from corvid.sources.text import read_adjacency, read_centroids, read_many, read_sparse_labeled, read_vectors
from corvid.streaming.route import poll, route, start_routing

__all__ = [
    "assign_nearest", "build_session", "checkpoint_dir", "forest", "generate_centroids", "generate_links",
    "generate_points", "generate_random_edges", "graph", "graph_degrees", "keyed", "kmeans", "load_forest",
    "pagerank", "poll", "predict", "prepare_adjacency", "prepare_edges", "push_pull_sync", "read_adjacency",
    "read_centroids", "read_many", "read_sparse_labeled", "read_vectors", "route", "save_forest",
    "start_routing", "train_forest", "word_average", "write_centroids", "write_ranks",
]
