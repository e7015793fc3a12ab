"""Filters over files in a space-filling order."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from vicinity.functions.vectors import rounded
from vicinity.operators.approx import assign_cells
from vicinity.operators.layout import LaidOut
from vicinity.operators.topk import row_vector
from vicinity.plans.cells import _CELLS, _D, _PROBES, _TARGET, ROW, _centroids, _rows
from vicinity.plans.registry import query
from vicinity.session import materialize, scratch, table

ROWS_PER_FILE = 50_000


@query("""SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_shipdate, l_returnflag FROM lineitem
WHERE l_shipdate BETWEEN TIMESTAMP '1994-01-01' AND TIMESTAMP '1995-06-30' AND l_discount BETWEEN 0.05 AND 0.07
  AND (l_quantity <= 10 OR l_quantity BETWEEN 40 AND 45) AND l_returnflag = 'R'""")
def rows_in_ranges_of_laid_out_files(spark, sf_dir):
    """Ranges of three columns, each of which rules files out; a fourth that no order knows."""
    rows = table(spark, sf_dir, "lineitem")
    by = ["l_shipdate", "l_discount", "l_quantity"]
    laid_out = LaidOut.write(rows, scratch(spark, "laid-out"), by, rows_per_file=ROWS_PER_FILE)
    found = laid_out.rows(
        {
            "l_shipdate": (dt.datetime(1994, 1, 1), dt.datetime(1995, 6, 30)),
            "l_discount": (0.05, 0.07),
            "l_quantity": [(None, 10.0), (40.0, 45.0)],
            "l_returnflag": "R",
        }
    )
    return found.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_shipdate", "l_returnflag")


@query(f"""WITH {_CELLS}, {_TARGET}
SELECT a.id, a.label, a.cell::INT AS cell, round({_D}, 4) + 0.0 AS distance FROM assigned a, q
WHERE a.cell IN {_PROBES.format(row=ROW, probes=4)} AND (a.label IN (1, 3) OR a.label BETWEEN 6 AND 8)
ORDER BY round({_D}, 12), a.id LIMIT 10""")
def nearest_filtered_in_laid_out_cells(spark, sf_dir):
    """Cells and an attribute in one order; part of the rows is appended later."""
    rows = _rows(spark, sf_dir)
    centroids = _centroids(rows)
    placed = materialize(assign_cells(rows, centroids), "placed")
    path = scratch(spark, "laid-out")
    LaidOut.write(placed.filter("id % 3 <> 0"), path, ["cell", "label"], rows_per_file=ROWS_PER_FILE)
    laid_out = LaidOut(spark, path).append(placed.filter("id % 3 = 0"), rows_per_file=ROWS_PER_FILE)
    hits = laid_out.search(
        row_vector(rows, ROW), 10, where={"label": [1, 3, (6, 8)]}, centroids=centroids, probes=4, columns=["label", "cell"]
    )
    return hits.withColumn("distance", rounded(F.col("distance")))


@query(f"""WITH {_TARGET}
SELECT a.vec_id AS id, a.label, round({_D}, 4) + 0.0 AS distance FROM embeddings a, q
WHERE a.label BETWEEN 2 AND 4 AND a.vec_id >= 100 ORDER BY round({_D}, 12), a.vec_id LIMIT 10""")
def nearest_filtered_from_laid_out_files(spark, sf_dir):
    """Exactly: the files that can't hold passing rows are not read, no cell is left out."""
    rows = _rows(spark, sf_dir)
    laid_out = LaidOut.write(rows, scratch(spark, "laid-out"), ["label", "id"], rows_per_file=ROWS_PER_FILE)
    hits = laid_out.search(row_vector(rows, ROW), 10, where={"label": (2, 4), "id": (100, None)}, columns=["label"])
    return hits.withColumn("distance", rounded(F.col("distance")))
