"""Time the headline jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and print one JSON line.

``load_*`` derives a graph from the tables and writes it to the checkpoint folder; the other jobs run on
the written graphs and take their whole result. Each job runs once to warm the JVM and is then timed;
``$BENCH_WARM=0`` times the first run.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import weftgraph as wg
from weftgraph.sources.tables import GRAPHS, busiest_source


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("weftgraph-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        # Python call sites of columns, kept for error messages, cost a few calls per column.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if "BENCH_CHECKPOINT_DIR" in os.environ:
        builder = builder.config("spark.checkpoint.dir", os.environ["BENCH_CHECKPOINT_DIR"])
    else:
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="weftgraph-bench-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def long_graphs(spark: SparkSession, sf_dir: str) -> dict[str, wg.Graph]:
    """Graphs with many levels: a path, a grid of 150 by 150, and the chain of all customers."""
    side = 150
    cell = spark.range(side * side)
    right = cell.where(F.col("id") % side < side - 1).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    down = cell.where(F.col("id") < side * (side - 1)).select(F.col("id").alias("src"), (F.col("id") + side).alias("dst"))
    path = spark.range(4999).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    return {
        "path_5000": wg.Graph.from_edges(path),
        "grid_150": wg.Graph.from_edges(right.unionByName(down), directed=False),
        "customer_chain": GRAPHS["customer_chain"](spark, sf_dir, True),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    warm = os.environ.get("BENCH_WARM", "1") != "0"
    seconds: dict[str, float] = {}

    def timed(name, job):
        if warm:
            job()
        start = time.perf_counter()
        result = job()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
        return result

    def taken(name, query):
        timed(name, lambda: query().write.format("noop").mode("overwrite").save())

    graphs = {}
    for kind, directed in (("order_lines", True), ("order_lines", False), ("copurchase", True), ("copurchase", False)):
        name = f"{kind}_{'directed' if directed else 'undirected'}"
        graphs[name] = timed(f"load_{name}", lambda: GRAPHS[kind](spark, sf_dir, directed).checkpoint())
    for name, graph in graphs.items():
        source = busiest_source(graph)
        taken(f"bfs_{name}", lambda: wg.bfs(graph, source))
        taken(f"sssp_{name}", lambda: wg.sssp(graph, source))
        taken(f"wcc_{name}", lambda: wg.wcc(graph))
        taken(f"cdlp5_{name}", lambda: wg.cdlp(graph, 5))
        taken(f"pagerank10_{name}", lambda: wg.pagerank(graph, 10))
        taken(f"lcc_{name}", lambda: wg.lcc(graph))
    taken("triangles_copurchase", lambda: wg.triangles(graphs["copurchase_undirected"]))
    taken("transition_prob_copurchase", lambda: wg.transition_probabilities(graphs["copurchase_directed"]))

    for name, graph in long_graphs(spark, sf_dir).items():
        graph = graph.checkpoint()
        taken(f"bfs_{name}", lambda: wg.bfs(graph, 0))
        if graph.weighted:
            taken(f"sssp_{name}", lambda: wg.sssp(graph, 0))

    line = {
        "metric": "load graphs and run six algorithms on each, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf") or 0),
    }
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
