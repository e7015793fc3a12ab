"""Catalogue ingest plans: CSV scan, clean-up, dedupe, upsert, provenance.

The source file is written by Spark from ``part`` and ``documents``: part names,
brands and types are the natural key, document texts (line breaks, quotes and
all) the descriptions. Parts of size 50 stand for other package sizes.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vicinity.functions.encode import encoder_info
from vicinity.functions.text import (
    classify_request,
    clean,
    compose_info,
    default_if_blank,
    fold_description,
    is_keg,
    search_link,
    text_hash,
    to_number,
    to_whole,
    truncate,
)
from vicinity.functions.vectors import rounded
from vicinity.operators.changes import (
    append_text,
    assign_ids,
    delete_rows,
    first_wins,
    insert_rows,
    upsert,
)
from vicinity.operators.checks import fingerprint
from vicinity.operators.fresh import clear_vectors
from vicinity.operators.meta import load_meta, merge_meta, prefixed, resolve_alias, update_meta
from vicinity.operators.numbering import number_rows
from vicinity.plans.common import CATALOG, as_of, catalog
from vicinity.plans.registry import query
from vicinity.session import materialize, scratch, spread, state_of, table
from vicinity.sources.catalog import empty_catalog, is_usable, load_catalog, read_catalog, to_catalog

_FEED = """feed AS (
  SELECT p_partkey AS file_row, p_name || CASE p_size WHEN 50 THEN ' 1/6 Barrel' WHEN 49 THEN ' ½' || chr(160) || 'KEG' WHEN 48 THEN ' 1' || chr(8201) || '/6 barrel' ELSE '' END AS name,
         p_brand AS brand, p_type AS categories, CASE WHEN p_size % 2 = 0 THEN coalesce(lang, '') ELSE '' END AS country,
         CASE WHEN p_size > 25 THEN 'Oak, ' || p_brand ELSE '' END AS notes, p_size || '%' AS abv, p_size AS ibu,
         CASE WHEN p_size < 10 THEN p_type ELSE '' END AS pairing, p_retailprice,
         regexp_replace(regexp_replace(coalesce(text, ''), '^[\\s\\v\\p{Z}]+', ''), '[\\s\\v\\p{Z}]+$', '') AS description
  FROM part LEFT JOIN documents ON doc_id = p_partkey)"""
_USABLE = "usable AS (SELECT * FROM feed WHERE ibu < 48)"
_INFO = """name || ' Style: ' || categories || '.' || CASE WHEN description <> '' THEN ' ' || description ELSE '' END
  || CASE WHEN notes <> '' THEN ' Tasting notes: ' || notes || '.' ELSE '' END
  || CASE WHEN pairing <> '' THEN ' Pairs well with: ' || pairing || '.' ELSE '' END
  || CASE WHEN country <> '' THEN ' Brewed in ' || country || '.' ELSE '' END"""
_FIRST = f"""firsts AS (SELECT * FROM (
  SELECT *, {_INFO} AS info, row_number() OVER (PARTITION BY name, brand, categories ORDER BY file_row) AS rn FROM usable)
  WHERE rn = 1)"""


def _catalog_feed(spark, sf_dir) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rows = parts.join(documents, F.col("doc_id") == F.col("p_partkey"), "left")
    size = F.col("p_size")
    blank = F.lit("")
    feed = rows.select(
        F.col("p_partkey").alias(" "),
        F.concat(
            "p_name",
            F.when(size == 50, " 1/6 Barrel").when(size == 49, " ½\u00a0KEG").when(size == 48, " 1\u2009/6 barrel").otherwise(""),
        ).alias("Name"),
        F.when(size % 2 == 0, F.coalesce("lang", blank)).otherwise("").alias("Country"),
        F.col("p_brand").alias(" Brand "),
        F.col("p_type").alias("Categories"),
        F.lit("Craft").alias("Type"),
        F.when(size > 25, F.concat(F.lit("Oak, "), "p_brand")).otherwise("").alias("Tasting Notes"),
        F.concat(size.cast("string"), F.lit("%")).alias("ABV"),
        F.concat(F.lit(" "), size.cast("string")).alias("IBU"),
        F.when(size < 10, F.col("p_type")).otherwise("").alias("Food Pairing"),
        F.round(F.col("p_retailprice") / 400, 1).cast("string").alias("Rating"),
        F.concat(size.cast("string"), F.lit(".9")).alias("Rate Count"),
        F.concat(F.lit("$"), F.format_number("p_retailprice", 2)).alias("Price"),
        F.coalesce("text", blank).alias("Description"),
    )
    return feed


FILE_BYTES = 32 << 20  # of stored input behind one CSV file


def _write_csv(feed: DataFrame, path: str, line: str = " ") -> None:
    # Many files in row order, since one task reads a whole file: as many as the input has
    # pieces, so that neither they nor the tasks that write them grow with it.
    spark = feed.sparkSession
    cores = spark.sparkContext.defaultParallelism
    stored = sum(state_of(spark, unquote(f))[1] for f in feed.inputFiles())
    ordered = feed.repartitionByRange(max(cores, -(-stored // FILE_BYTES)), line).sortWithinPartitions(line)
    writer = ordered.write.option("maxRecordsPerFile", 100_000).option("header", True).option("escape", '"').option("quoteAll", True)
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.mode("append").csv(path)


def _catalog_file(spark, sf_dir) -> str:
    path = scratch(spark, "catalog-csv")
    _write_csv(_catalog_feed(spark, sf_dir), path)
    return path


@query(f"""WITH {_FEED} SELECT name AS "Name", brand AS "Brand", categories AS "Categories", country AS "Country",
  abv AS "ABV", ibu::VARCHAR AS "IBU", '$' || format('{{:,.2f}}', p_retailprice) AS "Price", sha256(description) AS description_hash,
  row_number() OVER (ORDER BY file_row) AS line FROM feed""")
def scan_catalog_file(spark, sf_dir):
    rows = read_catalog(spark, _catalog_file(spark, sf_dir))
    order = number_rows(rows, "file_row", "line")
    return order.select(
        "Name", "Brand", "Categories", "Country", "ABV", "IBU", "Price",
        text_hash(F.col("Description")).alias("description_hash"), "line",
    )


@query(f"""WITH {_FEED} SELECT name AS "Name", brand AS "Brand", categories AS "Categories", country AS "Country",
  abv AS "ABV", ibu::VARCHAR AS "IBU", sha256(description) AS description_hash,
  row_number() OVER (ORDER BY file_row) AS line FROM feed""")
def scan_catalog_file_in_ranges(spark, sf_dir):
    """The same file, its records found by many tasks."""
    rows = read_catalog(spark, _catalog_file(spark, sf_dir), in_ranges=True)
    order = number_rows(materialize(rows, "catalog-rows"), "file_row", "line")
    return order.select(
        "Name", "Brand", "Categories", "Country", "ABV", "IBU", text_hash(F.col("Description")).alias("description_hash"), "line"
    )


@query(f"""WITH {_FEED} SELECT file_row, name AS "Name", brand AS "Brand", categories AS "Categories", country AS "Country", abv AS "ABV",
  ibu::VARCHAR AS "IBU", sha256(description) AS description_hash FROM feed""")
def scan_files_by_their_headers(spark, sf_dir):
    """Files in three column orders, one with a byte-order mark, one with spaced headers."""
    feed, path = _catalog_feed(spark, sf_dir), scratch(spark, "catalog-csv")
    feed = feed.withColumnRenamed(" ", "No")
    part = F.col("No").cast("long") % 3
    _write_csv(feed.filter(part == 0), path, "No")
    names = [c for c in reversed(feed.columns) if c != "Name"]
    marked = feed.filter(part == 1).select(F.col("Name").alias("\ufeffName"), *[F.col(f"`{c}`") for c in names])
    _write_csv(marked, path, "No")
    spaced = [F.col(f"`{c}`").alias(f"  {c.strip()} ") for c in sorted(feed.columns)]
    _write_csv(feed.filter(part == 2).select(*spaced), path, "  No ")
    rows = read_catalog(spark, path)
    return rows.select(
        F.col("No").cast("long").alias("file_row"), "Name", "Brand", "Categories", "Country", "ABV", "IBU",
        text_hash(F.col("Description")).alias("description_hash"),
    )


@query(f"""WITH {_FEED} SELECT count(*) AS rows, count(*) FILTER (ibu >= 48) AS kegs,
  count(*) FILTER (ibu < 48) AS usable FROM feed""")
def count_usable_rows(spark, sf_dir):
    rows = read_catalog(spark, _catalog_file(spark, sf_dir))
    keg = is_keg(F.col("Name"), F.col("Description"))
    return rows.agg(
        F.count("*").alias("rows"),
        F.count_if(keg).alias("kegs"),
        F.count_if(is_usable()).alias("usable"),
    )


@query(f"""WITH {_FEED}, {_USABLE}
SELECT file_row AS line, name AS beer_name, brand AS brewery, categories AS style, ibu::DOUBLE AS abv, ibu::INT AS min_ibu,
  ibu::INT AS max_ibu, round(p_retailprice / 400, 1)::DOUBLE AS review_overall, ibu::INT AS number_of_reviews,
  NULL::INT AS hoppy, sha256({_INFO}) AS text_hash FROM usable""")
def map_catalog_rows(spark, sf_dir):
    rows = read_catalog(spark, _catalog_file(spark, sf_dir))
    mapped = to_catalog(rows.filter(is_usable()).withColumn("file_row", F.col("_c0").cast("long")))
    return mapped.select(
        F.col("file_row").alias("line"), "beer_name", "brewery", "style", F.col("abv").cast("double").alias("abv"),
        "min_ibu", "max_ibu", F.col("review_overall").cast("double").alias("review_overall"),
        "number_of_reviews", "hoppy", "text_hash",
    )


@query(f"""WITH {_FEED}, {_USABLE}, {_FIRST}
SELECT row_number() OVER (ORDER BY file_row) AS id, name AS beer_name, brand AS brewery, categories AS style,
       ibu::DOUBLE AS abv, sha256(info) AS text_hash, true AS stamped, true AS unembedded FROM firsts""")
def load_into_empty_catalog(spark, sf_dir):
    merged, _ = load_catalog(spark, _catalog_file(spark, sf_dir), empty_catalog(spark), as_of())
    return merged.select(
        "id", "beer_name", "brewery", "style", F.col("abv").cast("double").alias("abv"), "text_hash",
        (F.col("updated_at") == as_of()).alias("stamped"), F.col("embedding").isNull().alias("unembedded"),
    )


@query(f"""WITH {_FEED}, {_USABLE}, {_FIRST}, second AS (SELECT count(*) AS n FROM firsts)
SELECT (SELECT count(*) FROM feed) AS read, (SELECT count(*) FROM feed) - (SELECT count(*) FROM usable) AS skipped,
  (SELECT count(*) FROM usable) - n AS duplicates, n AS total, n AS inserted, 0::BIGINT AS updated FROM second""")
def report_first_load(spark, sf_dir):
    return load_catalog(spark, _catalog_file(spark, sf_dir), empty_catalog(spark), as_of())[1]


_KEYS = ["beer_name", "brewery", "style"]


def _parts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_name").alias("beer_name"),
        F.col("p_brand").alias("brewery"),
        F.col("p_type").alias("style"),
        F.col("p_retailprice").alias("price"),
        F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("info"),
        F.col("p_partkey").alias("file_row"),
        F.col("p_size").alias("size"),
    )


@query("""SELECT p_name AS beer_name, p_brand AS brewery, p_type AS style, p_retailprice AS price, file_row, copies FROM (
  SELECT *, p_partkey AS file_row, row_number() OVER (PARTITION BY p_name, p_brand, p_type ORDER BY p_partkey) AS rn,
         count(*) OVER (PARTITION BY p_name, p_brand, p_type) AS copies FROM part) WHERE rn = 1""")
def first_row_per_key(spark, sf_dir):
    kept = first_wins(_parts(spark, sf_dir), _KEYS, "file_row", copies="copies")
    return kept.select(*_KEYS, "price", "file_row", "copies")


def _two_feeds(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """A table made of the smaller parts, and a feed of the larger ones."""
    parts = _parts(spark, sf_dir)
    old = first_wins(parts.filter(F.col("size") <= 30), _KEYS, "file_row")
    target = old.select(
        (F.col("file_row") + 1).alias("id"), *_KEYS, "price", "info",
        text_hash(F.col("info")).alias("text_hash"),
        F.array(F.col("price").cast("float")).alias("embedding"),
        as_of("2024-01-01 00:00:00").alias("embedded_at"),
        as_of("2024-01-01 00:00:00").alias("updated_at"),
    )
    source = first_wins(parts.filter(F.col("size") >= 20), _KEYS, "file_row")
    source = source.withColumn("text_hash", text_hash(F.col("info")))
    return target, source


_FEEDS = """p AS (SELECT p_name AS beer_name, p_brand AS brewery, p_type AS style, p_retailprice AS price,
    p_name || ' ' || p_size AS info, p_partkey AS file_row, p_size AS size FROM part),
t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY beer_name, brewery, style ORDER BY file_row) AS rn
      FROM p WHERE size <= 30) WHERE rn = 1),
s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY beer_name, brewery, style ORDER BY file_row) AS rn
      FROM p WHERE size >= 20) WHERE rn = 1),
merged AS (
  SELECT t.file_row + 1 AS id, t.beer_name, t.brewery, t.style, coalesce(s.price, t.price) AS price,
         coalesce(s.info, t.info) AS info, CASE WHEN s.info IS NULL THEN 'keep' ELSE 'update' END AS change,
         s.info IS NOT NULL AND s.info <> t.info AS moved
  FROM t LEFT JOIN s USING (beer_name, brewery, style)
  UNION ALL
  SELECT (SELECT max(file_row) + 1 FROM t) + row_number() OVER (ORDER BY file_row), beer_name, brewery, style,
         price, info, 'insert', true
  FROM s ANTI JOIN t USING (beer_name, brewery, style))"""


@query(f"""WITH {_FEEDS} SELECT id, beer_name, brewery, style, price, sha256(info) AS text_hash, change,
  moved, moved AS unembedded FROM merged""")
def upsert_by_natural_key(spark, sf_dir):
    target, source = _two_feeds(spark, sf_dir)
    merged = upsert(target, source, _KEYS, as_of(), "file_row", change_col="change")
    return merged.select(
        "id", *_KEYS, "price", "text_hash", "change",
        (F.col("updated_at") == as_of()).alias("moved"), F.col("embedding").isNull().alias("unembedded"),
    )


@query(f"""WITH {_FEEDS} SELECT count(*) AS rows_once, count(*) AS rows_twice, true AS same,
  0::BIGINT AS inserted_again FROM merged""")
def upsert_twice_changes_nothing(spark, sf_dir):
    target, source = _two_feeds(spark, sf_dir)
    once = upsert(target, source, _KEYS, as_of(), "file_row")
    twice = upsert(once, source, _KEYS, as_of("2024-07-01 00:00:00"), "file_row", change_col="change")
    columns = ["id", *_KEYS, "price", "text_hash", "updated_at"]
    a, b = fingerprint(once, columns), fingerprint(twice, columns)
    again = twice.agg(F.count_if(F.col("change") == "insert").alias("n")).scalar()
    return a.select(
        F.col("rows").alias("rows_once"),
        b.select("rows").scalar().alias("rows_twice"),
        (F.col("hash") == b.select("hash").scalar()).alias("same"),
        again.alias("inserted_again"),
    )


@query("""SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY c_custkey) AS id, c_name AS beer_name FROM customer""")
def number_new_rows(spark, sf_dir):
    new = table(spark, sf_dir, "customer").select(F.col("c_name").alias("beer_name"), F.col("c_custkey").alias("file_row"))
    existing = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return assign_ids(new, existing, "file_row").select("id", "beer_name")


@query(f"""WITH {CATALOG} SELECT id, sha256(CASE WHEN style = 'de' THEN info || ' Now revised.' ELSE info END) AS text_hash FROM catalog""")
def append_to_texts(spark, sf_dir):
    changed = append_text(catalog(spark, sf_dir), F.col("style") == "de", " Now revised.")
    return changed.select("id", text_hash(F.col("info")).alias("text_hash"))


@query(f"""WITH {CATALOG} SELECT id, brewery FROM catalog WHERE NOT coalesce(n_chars > 2500 OR label = 4, false)""")
def delete_by_predicate(spark, sf_dir):
    kept = delete_rows(catalog(spark, sf_dir), (F.col("n_chars") > 2500) | (F.col("label") == 4))
    return kept.select("id", "brewery")


@query(f"""WITH {CATALOG} SELECT id, sha256(info) AS text_hash, embedding IS NULL AS unembedded FROM catalog
UNION ALL SELECT (SELECT max(id) FROM catalog) + row_number() OVER (ORDER BY item_id), sha256('Item ' || item_id || ' Style: new. ' || trim(text)), true FROM benchmark""")
def insert_composed_rows(spark, sf_dir):
    rows = catalog(spark, sf_dir)
    new = table(spark, sf_dir, "benchmark")
    name = F.concat(F.lit("Item "), F.col("item_id"))
    new = new.select(
        F.col("item_id").alias("file_row"), name.alias("beer_name"),
        compose_info(name, F.lit("new"), F.col("text")).alias("info"),
    )
    after = insert_rows(rows, new, "file_row")
    return after.select("id", text_hash(F.col("info")).alias("text_hash"), F.col("embedding").isNull().alias("unembedded"))


@query(f"""WITH {CATALOG} SELECT count(*) AS rows, count(embedding) AS had, 0::BIGINT AS left_over FROM catalog""")
def clear_all_vectors(spark, sf_dir):
    rows = catalog(spark, sf_dir)
    cleared = clear_vectors(rows).agg(F.count("embedding").alias("n")).scalar()
    return rows.agg(F.count("*").alias("rows"), F.count("embedding").alias("had")).withColumn("left_over", cleared)


@query("""SELECT event_type || ':' || user_id AS key, arg_max(props || '@' || event_id, (ts, event_id)) AS value
FROM events GROUP BY 1""")
def last_value_per_key(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    entries = events.select(
        F.concat_ws(":", "event_type", F.col("user_id").cast("string")).alias("key"),
        F.concat_ws("@", "props", F.col("event_id").cast("string")).alias("value"),
        "ts", "event_id",
    )
    return merge_meta(entries, ["ts", "event_id"])


@query("""WITH n AS (SELECT lang AS key, count(*)::VARCHAR AS value FROM documents GROUP BY lang)
SELECT key, value FROM n UNION ALL
SELECT * FROM (VALUES ('license', 'public'), ('load_timestamp', '2024-06-01T12:00:00+00:00'),
  ('embedding_model', 'hashed-words'), ('embedding_dimensions', '384'), ('embedding_max_seq_length', 'unlimited'))
UNION ALL SELECT 'row_count', count(*)::VARCHAR FROM documents""")
def provenance_of_load(spark, sf_dir):
    """Facts of the load over what was known, then the model's under a prefix."""
    documents = table(spark, sf_dir, "documents")
    known = documents.groupBy(F.col("lang").alias("key")).agg(F.count("*").cast("string").alias("value"))
    known = known.unionByName(spark.createDataFrame([("license", "unknown")], "key string, value string"))
    facts = load_meta(spark, {"license": "public"}, documents, "2024-06-01T12:00:00+00:00")
    return update_meta(update_meta(known, facts), prefixed(encoder_info(spark)))


@query("""WITH a AS (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'EUROPE')
SELECT s_suppkey AS id, n.n_name AS name, coalesce(a.r_name, n.n_name) AS resolved
FROM supplier JOIN nation n ON s_nationkey = n_nationkey LEFT JOIN a ON a.n_name = n.n_name""")
def resolve_names(spark, sf_dir):
    """Nations stand for spellings, regions for the canonical names; the nations
    of one region are missing from the list and keep their own name."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    aliases = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).filter(F.col("r_name") != "EUROPE")
    named = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    named = named.select(F.col("s_suppkey").alias("id"), F.col("n_name").alias("name"))
    return resolve_alias(named, F.col("name"), aliases, "n_name", "r_name", "resolved")


@query("""SELECT p_partkey AS id, round(p_retailprice, 2)::DOUBLE AS price, p_size::DOUBLE AS share, p_size::INT AS whole,
  (p_retailprice::DECIMAL(18,2) - 0.005)::BIGINT::INT AS cut, NULL::DOUBLE AS unreadable, NULL::INT AS unreadable_whole, p_name AS name,
  NULL::DOUBLE AS double_suffix, NULL::INT AS float_suffix, (p_size * 1000)::DOUBLE AS scaled, 'NaN'::DOUBLE AS no_number FROM part""".replace(
    "(p_retailprice::DECIMAL(18,2) - 0.005)::BIGINT::INT", "trunc(p_retailprice)::INT"))
def read_decorated_numbers(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    price = F.concat(F.lit(" $"), F.format_number("p_retailprice", 2))
    size = F.col("p_size").cast("string")
    return parts.select(
        F.col("p_partkey").alias("id"),
        to_number(price).alias("price"),
        to_number(F.concat(size, F.lit("%  "))).alias("share"),
        to_whole(F.concat(F.lit("\t"), size, F.lit(".75"))).alias("whole"),
        to_whole(F.format_string("%.2f", "p_retailprice")).alias("cut"),
        to_number(F.col("p_type")).alias("unreadable"),
        to_whole(F.concat(size, F.lit("%"))).alias("unreadable_whole"),
        clean(F.concat(F.lit("﻿  "), "p_name", F.lit("\r\n"))).alias("name"),
        to_number(F.concat(size, F.lit("d"))).alias("double_suffix"),
        to_whole(F.concat(size, F.lit("f"))).alias("float_suffix"),
        to_number(F.concat(size, F.lit("e3"))).alias("scaled"),
        to_number(F.concat(F.lit("NaN"), F.substring(size, 1, 0))).alias("no_number"),
    )


_SCORED = {
    "hoppy": "l_quantity * 2", "bitter": "l_discount * 1000", "malty": "l_tax * 1000", "sweet": "l_linenumber * 10",
    "sour": "l_quantity", "fruits": "l_linenumber * 8", "spices": "l_tax * 500", "salty": "l_discount * 600",
    "alcohol": "l_quantity + 10", "body": "l_linenumber * 6", "astringency": "l_tax * 700",
}
_SCORE_SQL = ", ".join(
    f"CASE WHEN round({expr})::INT >= 40 THEN '{word}' END"
    for word, expr in zip(
        ["hoppy", "bitter", "malty", "sweet", "sour", "fruity", "spiced", "salty", "strong", "full-bodied", "astringent"],
        _SCORED.values(),
    )
)


@query(f"""WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, concat_ws(', ', {_SCORE_SQL}) AS words FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'Line ' || l_orderkey || CASE WHEN l_returnflag = 'A' THEN '' ELSE ' Style: ' || l_returnflag || '.' END
  || CASE WHEN words = '' THEN '' ELSE ' Taste: ' || words || '.' END AS info FROM x""")
def compose_scored_texts(spark, sf_dir):
    lines = spread(table(spark, sf_dir, "lineitem"))
    scores = {k: F.round(F.expr(e)).cast("int") for k, e in _SCORED.items()}
    style = F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).otherwise(" ")
    name = F.concat(F.lit("  Line "), F.col("l_orderkey"))
    info = compose_info(name, style, F.lit(None).cast("string"), scores)
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", info.alias("info"))


@query("""WITH t AS (SELECT page_id, regexp_replace(regexp_replace(html, '^[\\s\\v\\p{Z}]+', ''), '[\\s\\v\\p{Z}]+$', '') AS html FROM pages),
f AS (SELECT page_id, html || ' Tasting notes: ' || page_id || '. Brewed in web.' AS body FROM t)
SELECT page_id AS id, sha256(body) AS hash, length(body) AS n FROM f""")
def fold_descriptions(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    body = fold_description(F.col("html"), F.col("page_id").cast("string"), F.lit(""), F.lit("web"))
    return pages.select(
        F.col("page_id").alias("id"), text_hash(body).alias("hash"), F.char_length(body).cast("long").alias("n")
    )


@query("""SELECT doc_id AS id, CASE WHEN length(line) <= 60 THEN line ELSE substr(line, 1, 59) || '…' END AS shown
FROM (SELECT doc_id, replace(text, chr(10), ' ') AS line FROM documents)""")
def truncate_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), truncate(F.col("text")).alias("shown"))


@query("""SELECT conv_id, turn, 'https://untappd.com/search?q=' || replace(url_encode(text), '%20', '+') AS link FROM conversations""")
def search_links(spark, sf_dir):
    talks = table(spark, sf_dir, "conversations")
    return talks.select("conv_id", "turn", search_link(F.col("text")).alias("link"))


@query("""WITH l AS (
  SELECT event_id AS qid, CASE event_type WHEN 'view' THEN '  :LIKE  ' || user_id || ' ' WHEN 'click' THEN ':top ' || floor(value)::INT
         WHEN 'purchase' THEN ':' || props WHEN 'signup' THEN ':like ' || event_type ELSE ':Quit' END AS line FROM events
  UNION ALL SELECT -1 - conv_id * 1000 - turn, text FROM conversations),
c AS (SELECT qid, regexp_replace(regexp_replace(line, '^[\\s\\v\\p{Z}]+', ''), '[\\s\\v\\p{Z}]+$', '') AS r FROM l),
w AS (SELECT qid, r, lower(regexp_split_to_array(r, '\\s+')[1]) AS cmd, regexp_split_to_array(r, '\\s+') AS ws FROM c),
e AS (SELECT *, CASE
    WHEN r = '' THEN 'Please enter a prompt or command (:help for help).'
    WHEN r NOT LIKE ':%' THEN CASE WHEN length(r) > 4000 THEN 'Prompt too long (' || length(r) || ' chars, max 4000).' END
    WHEN cmd = ':like' THEN CASE WHEN len(ws) <> 2 OR NOT regexp_full_match(ws[2], '[0-9]{1,9}') THEN 'Usage: :like <beer id>' END
    WHEN cmd = ':top' THEN CASE WHEN len(ws) <> 2 OR NOT regexp_full_match(ws[2], '-?[0-9]{1,9}') THEN 'Usage: :top <n>  (1-50)'
                                WHEN ws[2]::INT NOT BETWEEN 1 AND 50 THEN 'N must be between 1 and 50.' END
    WHEN cmd IN (':explain', ':help', ':cls', ':clear', ':quit', ':exit', ':q') THEN NULL
    ELSE 'Unknown command ' || cmd || '.  Type :help for help.' END AS error FROM w)
SELECT qid, CASE WHEN error IS NOT NULL THEN 'error' WHEN r NOT LIKE ':%' THEN 'search' WHEN cmd = ':like' THEN 'like'
    WHEN cmd = ':top' THEN 'top' WHEN cmd IN (':cls', ':clear') THEN 'clear' WHEN cmd IN (':quit', ':exit', ':q') THEN 'quit'
    ELSE substr(cmd, 2) END AS kind,
  CASE WHEN error IS NULL AND r NOT LIKE ':%' THEN sha256(r) END AS prompt_hash,
  CASE WHEN error IS NULL AND cmd = ':like' THEN ws[2]::BIGINT END AS like_id,
  CASE WHEN error IS NULL AND cmd = ':top' THEN ws[2]::INT END AS top, error FROM e""")
def classify_requests(spark, sf_dir):
    events, talks = table(spark, sf_dir, "events"), table(spark, sf_dir, "conversations")
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    line = (
        F.when(kind == "view", F.concat(F.lit("  :LIKE  "), user, F.lit(" ")))
        .when(kind == "click", F.concat(F.lit(":top "), F.floor("value").cast("string")))
        .when(kind == "purchase", F.concat(F.lit(":"), "props"))
        .when(kind == "signup", F.concat(F.lit(":like "), kind))
        .otherwise(":Quit")
    )
    lines = events.select(F.col("event_id").alias("qid"), line.alias("line")).unionByName(
        talks.select((-1 - F.col("conv_id") * 1000 - F.col("turn")).alias("qid"), F.col("text").alias("line"))
    )
    asked = lines.select("qid", classify_request("line").alias("r"))
    return asked.select(
        "qid", "r.kind", text_hash(F.col("r.prompt")).alias("prompt_hash"), "r.like_id", "r.top", "r.error"
    )


@query("""SELECT c_custkey AS id, coalesce(nullif(trim(CASE WHEN c_acctbal < 0 THEN '  ' ELSE c_mktsegment || ' ' END), ''), 'UNKNOWN') AS segment,
  CASE WHEN c_acctbal >= 0 THEN 'OK' ELSE 'MISSING' END AS status FROM customer""")
def fill_blank_fields(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    given = F.when(F.col("c_acctbal") < 0, "  ").otherwise(F.concat("c_mktsegment", F.lit(" ")))
    status = F.when(F.col("c_acctbal") >= 0, "OK").otherwise("MISSING")
    return rows.select(F.col("c_custkey").alias("id"), default_if_blank(given, "UNKNOWN").alias("segment"), status.alias("status"))


@query("""SELECT o_orderkey AS id, round(o_totalprice, 2)::DOUBLE AS price FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice > 300000""")
def filter_by_membership_and_range(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    wanted = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_totalprice") > 300000)
    return orders.filter(wanted).select(F.col("o_orderkey").alias("id"), rounded(F.col("o_totalprice"), 2).alias("price"))


@query("""SELECT 'prefix' AS rule, p_partkey AS id FROM part WHERE p_name LIKE 'red%'
UNION ALL SELECT 'name', p_partkey FROM part WHERE p_name = 'small ring'
UNION ALL SELECT 'id', p_partkey FROM part WHERE p_partkey = 7
UNION ALL SELECT 'substring', p_partkey FROM part WHERE p_name ILIKE '%WIDG%'""")
def look_up_rows(spark, sf_dir):
    parts, name = table(spark, sf_dir, "part"), F.col("p_name")
    rules = {
        "prefix": name.startswith("red"),
        "name": name == "small ring",
        "id": F.col("p_partkey") == 7,
        "substring": name.ilike("%WIDG%"),
    }
    met = F.array(*[F.when(rule, F.lit(label)) for label, rule in rules.items()])
    return parts.select(F.explode(F.array_compact(met)).alias("rule"), F.col("p_partkey").alias("id"))
