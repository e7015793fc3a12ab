"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the median counts.
Building the plan, the small lookups and tables it needs and computing every row
of the result are inside the measured time. Short reports are fetched; the rows of
table-sized results go to Spark's noop sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

from vicinity.operators.approx import assign_cells, cell_search, train_centroids, write_cells
from vicinity.operators.cells import CellIndex
from vicinity.operators.topk import nearest
from vicinity.plans import QUERIES
from vicinity.plans.common import QUESTION
from vicinity.plans.texts import _encoded
from vicinity.search import search
from vicinity.session import materialize, scratch

HEADLINES = (
    "nearest_to_row",
    "more_like_this",
    "nearest_filtered",
    "nearest_postfiltered",
    "nearest_iterative",
    "rows_by_candidate_width",
    "nearest_for_every_row",
    "nearest_in_buckets_for_every_row",
    "nearest_in_probed_cells",
    "nearest_in_cells_for_every_row",
    "compare_row_pairs",
    "mean_vector_per_label",
    "encode_documents",
    "search_by_text",
    "search_by_text_and_attributes",
    "search_for_every_question",
    "stale_rows",
    "refresh_stale_rows",
    "first_row_per_key",
    "upsert_by_natural_key",
    "load_into_empty_catalog",
    "keep_vectors_fresh_from_feed",
    "last_value_per_key",
    "compose_scored_texts",
    "classify_requests",
    "readiness_checklist",
)


REPORTS = {
    "nearest_to_row",
    "more_like_this",
    "nearest_filtered",
    "nearest_postfiltered",
    "nearest_iterative",
    "rows_by_candidate_width",
    "nearest_in_probed_cells",
    "search_by_text",
    "search_by_text_and_attributes",
    "readiness_checklist",
}


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def stored(spark: SparkSession, sf_dir: str) -> dict:
    """Search over a stored corpus: its texts are encoded and its cells written here,
    once and outside the timing, as an index is."""
    rows = _encoded(spark, sf_dir).select("id", "beer_name", "brewery", "style", "embedding")
    table = materialize(rows, "bench-corpus")
    centroids = materialize(train_centroids(table, 64), "bench-centroids")
    cells = scratch(spark, "bench-cells")
    write_cells(assign_cells(table, centroids), cells)
    in_cells = spark.read.parquet(cells)
    point = [float(x) for x in table.orderBy("id").first()["embedding"]]
    index = CellIndex.build(table, scratch(spark, "bench-index"), cells=64, attributes=["style"])
    return {
        "stored_index_top5": lambda *_: index.search(point, 5, probes=4),
        "stored_index_filtered_top5": lambda *_: index.search_where(point, {"style": "en"}, 5),
        "stored_exact_top5": lambda *_: nearest(table, point, 5),
        "stored_cells_top5": lambda *_: cell_search(in_cells, centroids, point, 5, probes=4),
        "stored_text_search": lambda *_: search(table, QUESTION, 5),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = sys.argv[1:] or HEADLINES
    spark = session(cpus)
    seconds = {}
    plans = dict(QUERIES)
    if not sys.argv[1:] or any(w.startswith("stored") for w in wanted):
        extra = stored(spark, sf_dir)
        plans |= extra
        REPORTS.update(extra)
        wanted = [*wanted, *(() if sys.argv[1:] else extra)]
    for name in wanted:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            result = plans[name](spark, sf_dir)
            if name in REPORTS:
                result.collect()
            else:
                result.write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 4)
        print(f"{seconds[name]:9.4f}s (first {taken[0]:.2f}s) {name}", file=sys.stderr, flush=True)
    spark.stop()
    report = {
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
