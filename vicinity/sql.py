"""Search as table functions of SQL.

``register(spark)`` makes these functions known to a session:

* ``nearest_rows(TABLE(t), question, n)``: the n rows of each part of a table nearest to a
  text, which is encoded once per task;
* ``nearest_to_vector(TABLE(t), vector, n)``: the same for a vector;
* ``encoder_settings()``: what the vectors were made with.

The table has the columns id, beer_name, brewery, style, embedding, in any order and with
others beside them, and its vectors are stored. Each task hands on n rows at most, so a question ends with
``ORDER BY distance, id LIMIT n``, and nothing is shuffled but these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vicinity.functions.encode import HashedWords
from vicinity.functions.vectors import row_distances, to_matrix

SHOWN = ("id", "beer_name", "brewery", "style")
RESULT = "id long, beer_name string, brewery string, style string, distance double"


class _Nearest:
    """The best rows of the batches of one task."""

    def __init__(self) -> None:
        self.best: pa.Table | None = None
        self.query: np.ndarray | None = None

    def look(self, rows: pa.RecordBatch, n: int) -> None:
        there = rows.filter(rows.column("embedding").is_valid())
        if not there.num_rows or n < 1:
            return
        matrix, _ = to_matrix(there.column("embedding"), len(self.query))
        distance = row_distances(matrix, self.query, "cosine")
        held = pa.table([*[there.column(c) for c in SHOWN], pa.array(distance)], names=[*SHOWN, "distance"])
        held = held.filter(pa.array(~np.isnan(distance)))
        held = held if self.best is None else pa.concat_tables([self.best, held])
        self.best = held.sort_by([("distance", "ascending"), ("id", "ascending")]).slice(0, n).combine_chunks()

    def terminate(self) -> Iterator[pa.Table]:
        if self.best is not None and self.best.num_rows:
            yield self.best


class NearestToVector(_Nearest):
    def eval(self, rows: pa.RecordBatch, vector: pa.Array, n: pa.Array) -> Iterator[pa.Table]:
        # without a vector there is nothing to be near to
        if rows.num_rows and vector[0].is_valid:
            if self.query is None:
                self.query = np.array(vector[0].as_py(), "float64")
            self.look(rows, n[0].as_py())
        return iter(())


def register(spark: SparkSession, encoder=None, prefix: str = "") -> None:
    """Make the functions known; questions are encoded by ``encoder`` with ``prefix``."""
    model = encoder or HashedWords()

    class NearestRows(_Nearest):
        def eval(self, rows: pa.RecordBatch, question: pa.Array, n: pa.Array) -> Iterator[pa.Table]:
            if rows.num_rows and question[0].is_valid:
                if self.query is None:
                    self.query = np.asarray(model.encode([prefix + question[0].as_py()]), "float64")[0]
                self.look(rows, n[0].as_py())
            return iter(())

    class EncoderSettings:
        def eval(self) -> Iterator[tuple[str, str]]:
            yield from model.info()

    spark.udtf.register("nearest_rows", F.arrow_udtf(NearestRows, returnType=RESULT))
    spark.udtf.register("nearest_to_vector", F.arrow_udtf(NearestToVector, returnType=RESULT))
    spark.udtf.register("encoder_settings", F.udtf(EncoderSettings, returnType="setting string, value string"))
