"""Distances and nearest-row plans on stored vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vicinity.functions.vectors import METRICS, dims, distance_to, format_vector, norm, normalize, parse_vector, rounded
from vicinity.operators.approx import mean_vectors
from vicinity.operators.many import nearest_many
from vicinity.operators.pruned import nearest_many_pruned
from vicinity.operators.topk import (
    candidate_sweep,
    compare_pairs,
    nearest,
    rank_results,
    row_vector,
    row_vectors,
    vector_by_name,
)
from vicinity.plans.common import CATALOG, catalog, cosine
from vicinity.plans.registry import query
from vicinity.search import more_like
from vicinity.session import table

ROW = 3  # the row whose neighbours are asked for

_METRIC_SQL = {
    "cosine": cosine("e.embedding", "q.v"),
    "l2": "list_distance(e.embedding::DOUBLE[], q.v::DOUBLE[])",
    "ip": "-list_inner_product(e.embedding::DOUBLE[], q.v::DOUBLE[])",
    "l1": "list_sum([abs(z[1] - z[2]) for z in list_zip(e.embedding::DOUBLE[], q.v::DOUBLE[])])",
}
_Q = f"q AS (SELECT embedding AS v FROM embeddings WHERE vec_id = {ROW})"


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "id")


@query("SELECT vec_id AS id, label, len(embedding)::INT AS dims FROM embeddings WHERE embedding IS NOT NULL")
def scan_embedded_corpus(spark, sf_dir):
    rows = _vectors(spark, sf_dir).filter(F.col("embedding").isNotNull())
    return rows.select("id", "label", dims(F.col("embedding")).alias("dims"))


@query(
    f"WITH {_Q} "
    + " UNION ALL ".join(
        f"SELECT e.vec_id AS id, '{m}' AS metric, round({sql}, 6) + 0.0 AS distance FROM embeddings e, q"
        for m, sql in _METRIC_SQL.items()
    )
)
def distances_in_every_metric(spark, sf_dir):
    rows = _vectors(spark, sf_dir)
    target = row_vector(rows, ROW)
    for metric in METRICS:
        rows = rows.withColumn(metric, rounded(distance_to(F.col("embedding"), target, metric), 6))
    values = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("distance")) for m in METRICS])
    return rows.select("id", F.inline(values))


@query(f"""WITH {_Q}
SELECT e.vec_id AS id, e.label, round({_METRIC_SQL['cosine']}, 4) + 0.0 AS distance
FROM embeddings e, q WHERE e.vec_id <> {ROW}
ORDER BY {_METRIC_SQL['cosine']}, e.vec_id LIMIT 5""")
def nearest_to_row(spark, sf_dir):
    rows = _vectors(spark, sf_dir)
    hits = nearest(rows, row_vector(rows, ROW), 5, where=F.col("id") != ROW, columns=["label"])
    return hits.withColumn("distance", rounded(F.col("distance")))


@query(
    f"WITH {_Q} "
    + " UNION ALL ".join(
        f"(SELECT '{m}' AS metric, e.vec_id AS id, round({sql}, 6) + 0.0 AS distance FROM embeddings e, q "
        f"WHERE e.vec_id <> {ROW} ORDER BY {sql}, e.vec_id LIMIT 5)"
        for m, sql in _METRIC_SQL.items()
    )
)
def nearest_in_every_metric(spark, sf_dir):
    rows = _vectors(spark, sf_dir)
    target = row_vector(rows, ROW)
    answers = None
    for metric in METRICS:
        hits = nearest(rows, target, 5, metric=metric, where=F.col("id") != ROW)
        hits = hits.select(F.lit(metric).alias("metric"), "id", rounded(F.col("distance"), 6).alias("distance"))
        answers = hits if answers is None else answers.unionByName(hits)
    return answers


@query(f"""WITH {CATALOG}, q AS (SELECT embedding AS v FROM catalog WHERE beer_name = 'doc-7')
SELECT e.id, e.beer_name, e.style, round({_METRIC_SQL['cosine']}, 4) + 0.0 AS distance
FROM catalog e, q WHERE e.beer_name <> 'doc-7' AND e.embedding IS NOT NULL
ORDER BY {_METRIC_SQL['cosine']}, e.id LIMIT 5""")
def nearest_by_name(spark, sf_dir):
    rows = catalog(spark, sf_dir)
    target = vector_by_name(rows, "doc-7", "beer_name")
    hits = nearest(rows, target, 5, where=F.col("beer_name") != "doc-7", columns=["beer_name", "style"])
    return hits.withColumn("distance", rounded(F.col("distance")))


@query(f"""WITH {CATALOG}, q AS (SELECT embedding AS v FROM catalog WHERE id = {ROW})
SELECT e.id, e.beer_name, e.brewery, e.style, round({_METRIC_SQL['cosine']}, 4) + 0.0 AS distance
FROM catalog e, q WHERE e.id <> {ROW} AND e.embedding IS NOT NULL
ORDER BY {_METRIC_SQL['cosine']}, e.id LIMIT 8""")
def more_like_this(spark, sf_dir):
    return more_like(catalog(spark, sf_dir), ROW, 8)


_LONG = 3000
_FILTERED = f"""WITH {CATALOG}, q AS (SELECT embedding AS v FROM catalog WHERE id = {ROW}),
ranked AS (
  SELECT e.id, e.n_chars, {_METRIC_SQL['cosine']} AS d, e.n_chars > {_LONG} AS keep,
         row_number() OVER (ORDER BY {_METRIC_SQL['cosine']}, e.id) AS rn
  FROM catalog e, q WHERE e.embedding IS NOT NULL)"""


def _filtered(spark, sf_dir, **options) -> DataFrame:
    rows = catalog(spark, sf_dir)
    long_text = F.col("n_chars") > _LONG
    hits = nearest(rows, row_vector(rows, ROW), 10, where=long_text, columns=["n_chars"], **options)
    return hits.withColumn("distance", rounded(F.col("distance"), 3))


@query(f"{_FILTERED} SELECT id, n_chars, round(d, 3) + 0.0 AS distance FROM ranked WHERE keep ORDER BY d, id LIMIT 10")
def nearest_filtered(spark, sf_dir):
    return _filtered(spark, sf_dir)


@query(
    f"{_FILTERED} SELECT id, n_chars, round(d, 3) + 0.0 AS distance FROM ranked "
    "WHERE keep AND rn <= 40 ORDER BY d, id LIMIT 10"
)
def nearest_postfiltered(spark, sf_dir):
    return _filtered(spark, sf_dir, mode="postfilter", ef=40)


@query(
    f"{_FILTERED} SELECT id, n_chars, round(d, 3) + 0.0 AS distance FROM ranked "
    "WHERE keep AND rn <= 25 ORDER BY d, id LIMIT 10"
)
def nearest_iterative_capped(spark, sf_dir):
    """Strict widening that reaches its scan limit before ten rows pass."""
    return _filtered(spark, sf_dir, mode="iterative", max_scan=25)


@query(
    f"{_FILTERED} SELECT id, n_chars, round(d, 3) + 0.0 AS distance FROM ranked "
    "WHERE keep AND rn <= 20000 ORDER BY d, id LIMIT 10"
)
def nearest_iterative(spark, sf_dir):
    return _filtered(spark, sf_dir, mode="iterative")


@query(f"""{_FILTERED}
SELECT w.ef::INT AS ef, least(10, count(*) FILTER (keep AND rn <= w.ef))::BIGINT AS rows_returned
FROM ranked, (VALUES (10), (20), (40), (100), (400), (1000)) w(ef) GROUP BY w.ef""")
def rows_by_candidate_width(spark, sf_dir):
    rows = catalog(spark, sf_dir)
    widths = [10, 20, 40, 100, 400, 1000]
    return candidate_sweep(rows, row_vector(rows, ROW), F.col("n_chars") > _LONG, 10, widths)


@query(f"""{_FILTERED}, hits AS (
  SELECT 'exact' AS mode, rn FROM ranked WHERE keep
  UNION ALL SELECT 'postfilter', rn FROM ranked WHERE keep AND rn <= 40
  UNION ALL SELECT 'iterative', rn FROM ranked WHERE keep AND rn <= 20000)
SELECT mode, least(10, count(*))::BIGINT AS rows_returned FROM hits GROUP BY mode""")
def rows_returned_by_mode(spark, sf_dir):
    counts = None
    for mode in ("exact", "postfilter", "iterative"):
        one = _filtered(spark, sf_dir, mode=mode).agg(F.count("*").alias("rows_returned"))
        one = one.select(F.lit(mode).alias("mode"), "rows_returned")
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query(f"""WITH pairs AS (SELECT DISTINCT l_partkey AS a, l_suppkey AS b FROM lineitem)
SELECT p.a, p.b, x.label AS label_a, y.label AS label_b, abs(x.label - y.label)::INT AS label_gap,
       round({cosine('x.embedding', 'y.embedding')}, 4) + 0.0 AS distance
FROM pairs p JOIN embeddings x ON x.vec_id = p.a JOIN embeddings y ON y.vec_id = p.b""")
def compare_row_pairs(spark, sf_dir):
    """Named pairs side by side; the pairs are the part/supplier pairs sold."""
    pairs = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"))
    found = compare_pairs(_vectors(spark, sf_dir), pairs.distinct(), attributes=["label"])
    gap = F.abs(F.col("label_a") - F.col("label_b")).alias("label_gap")
    return found.select("a", "b", "label_a", "label_b", gap, rounded(F.col("distance")).alias("distance"))


@query("""WITH n AS (SELECT vec_id AS id, embedding, sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS len
  FROM (SELECT vec_id, [x * (label + 1) for x in embedding::DOUBLE[]] AS embedding FROM embeddings))
SELECT id, round(len, 5) + 0.0 AS raw_length, 1.0::DOUBLE AS unit_length, round((embedding[1] / len)::FLOAT::DOUBLE, 5) + 0.0 AS first FROM n""")
def unit_vectors(spark, sf_dir):
    rows = _vectors(spark, sf_dir)
    longer = F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 1))
    unit = normalize(F.col("v"))
    return rows.select("id", longer.alias("v")).select(
        "id",
        rounded(norm(F.col("v")), 5).alias("raw_length"),
        rounded(norm(unit), 5).alias("unit_length"),
        rounded(unit[0].cast("double"), 5).alias("first"),
    )


@query("""SELECT vec_id AS id, len(embedding)::INT AS dims, round(list_sum(embedding::DOUBLE[]), 6) + 0.0 AS total,
  true AS bracketed FROM embeddings""")
def vector_literals(spark, sf_dir):
    """Vector to text and back."""
    text = _vectors(spark, sf_dir).select("id", format_vector(F.col("embedding")).alias("t"))
    back = text.select("id", "t", parse_vector(F.col("t")).alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double"))
    framed = F.col("t").startswith("[") & F.col("t").endswith("]")
    return back.select("id", F.size("v").alias("dims"), rounded(total, 6).alias("total"), framed.alias("bracketed"))


@query("""WITH x AS (SELECT label, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
SELECT label, (pos - 1)::INT AS pos, round(avg(x), 6) + 0.0 AS mean FROM x GROUP BY label, pos""")
def mean_vector_per_label(spark, sf_dir):
    means = mean_vectors(_vectors(spark, sf_dir), "label")
    return means.select("label", F.posexplode("centroid").alias("pos", "x")).select(
        "label", "pos", rounded(F.col("x"), 6).alias("mean")
    )


@query(f"""WITH {CATALOG}, x AS (SELECT style, n_chars, unnest(embedding::DOUBLE[]) AS x,
    generate_subscripts(embedding, 1) AS pos FROM catalog WHERE embedding IS NOT NULL)
SELECT style, (pos - 1)::INT AS pos, round(sum(x * n_chars) / sum(n_chars), 6) + 0.0 AS mean FROM x GROUP BY style, pos""")
def weighted_mean_per_style(spark, sf_dir):
    """Pooling with weights: long texts count for more."""
    means = mean_vectors(catalog(spark, sf_dir), "style", weight="n_chars")
    return means.select("style", F.posexplode("centroid").alias("pos", "x")).select(
        "style", "pos", rounded(F.col("x"), 6).alias("mean")
    )


_EVERY_ROW = f"""WITH d AS (
  SELECT q.vec_id AS qid, e.vec_id AS id, {cosine('e.embedding', 'q.embedding')} AS distance
  FROM embeddings q, embeddings e WHERE q.vec_id <> e.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(distance, 12), id) AS rank FROM d)
SELECT qid, id, round(round(distance, 12), 6) + 0.0 AS distance, rank::INT AS rank FROM r WHERE rank <= 5"""


def _every_row(spark, sf_dir, **options) -> DataFrame:
    rows = _vectors(spark, sf_dir).withColumnRenamed("embedding", "vector")
    queries = rows.select(F.col("id").alias("qid"), "vector")
    hits = nearest_many(queries, rows.select("id", "vector"), 5, exclude_self=True, **options)
    return hits.withColumn("distance", rounded(F.col("distance"), 6))


@query(_EVERY_ROW)
def nearest_for_every_row(spark, sf_dir):
    return _every_row(spark, sf_dir)


@query(_EVERY_ROW)
def nearest_for_every_row_by_blocks(spark, sf_dir):
    """The way taken when the queries are too many to send to every task."""
    return _every_row(spark, sf_dir, block_rows=256, query_block_rows=128)


@query(_EVERY_ROW)
def nearest_for_every_row_by_pruned_blocks(spark, sf_dir):
    """The same rows, without the pairs of blocks that are too far apart."""
    rows = _vectors(spark, sf_dir).select("id", F.col("embedding").alias("vector"))
    hits = nearest_many_pruned(rows.withColumnRenamed("id", "qid"), rows, 5, exclude_self=True, block_rows=64)
    return hits.withColumn("distance", rounded(F.col("distance"), 6))


@query(f"""WITH {CATALOG}, asked AS (SELECT p_partkey AS id FROM part)
SELECT a.id, CASE WHEN c.id IS NULL THEN 'not found' WHEN c.embedding IS NULL THEN 'no embedding' ELSE 'ok' END AS status,
       len(c.embedding)::INT AS dims
FROM asked a LEFT JOIN catalog c ON c.id = a.id""")
def row_vector_status(spark, sf_dir):
    asked = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
    found = row_vectors(catalog(spark, sf_dir), asked)
    return found.select("id", "status", dims(F.col("vector")).alias("dims"))


@query(f"""WITH {_Q}, hits AS (
  SELECT e.vec_id AS id, {_METRIC_SQL['cosine']} AS d FROM embeddings e, q ORDER BY 2, 1 LIMIT 50)
SELECT id, round(d, 4) + 0.0 AS distance, row_number() OVER (ORDER BY d, id)::INT AS rank FROM hits""")
def ranked_report(spark, sf_dir):
    rows = _vectors(spark, sf_dir)
    hits = rank_results(nearest(rows, row_vector(rows, ROW), 50))
    return hits.withColumn("distance", rounded(F.col("distance")))
