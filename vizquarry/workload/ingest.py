"""Queries over sources and sinks."""

from __future__ import annotations

import io
import os
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from vizquarry.functions.names import sanitize
from vizquarry.operators import metrics, score
from vizquarry.operators.elements import calc_fields
from vizquarry.session import cut_lineage, scratch_dir
from vizquarry.sources import archives, catalog, shred, sinks, tables as ingest
from vizquarry.workload import fixtures as fx
from vizquarry.workload.checks import METRIC_COLUMNS, PRODUCT, VENDOR, check, r1

# What stands wrong with some archives of the estate.
DAMAGED, BOOKLESS, DOUBLE = "workbook_id % 97 = 0", "workbook_id % 89 = 1", "workbook_id % 83 = 2"


def _pack(batches):
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                if r["books"] >= 1:
                    z.writestr("Book.TWB", r["xml"])
                if r["books"] == 2:
                    z.writestr("z/Other.twb", "<workbook/>")
                if r["has_extract"]:
                    z.writestr("Data/Extracts/data.hyper", b"")
            rows.append(
                {
                    "path": f"estate/{r['workbook_id']}.twbx",
                    "content": b"not an archive" if r["damaged"] else out.getvalue(),
                }
            )
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("path", pa.string()), ("content", pa.binary())]))


def archive_files(spark: SparkSession, sf: str) -> DataFrame:
    """(path, content) of the estate as packaged workbooks, some of them broken."""
    books = fx.workbook_xml(spark, sf).select(
        "workbook_id", "xml", "has_extract", F.expr(DAMAGED).alias("damaged"),
        F.expr(f"CASE WHEN {BOOKLESS} THEN 0 WHEN {DOUBLE} THEN 2 ELSE 1 END").alias("books"),
    )
    return books.mapInArrow(_pack, "path string, content binary")


def _corpus(spark, sf):
    # One pass over the archives; nobody comes back for the documents, so no copy of them is kept.
    scanned = archives.scan_archives(archive_files(spark, sf))
    return scanned.withColumn("workbook_id", F.regexp_extract("path", r"(\d+)\.twbx$", 1).cast("bigint"))


def corpus_scan(spark, sf):
    return _corpus(spark, sf).select(
        "workbook_id", "member", F.col("n_workbook_members").cast("bigint").alias("n_workbook_members"),
        F.size("extracts").cast("bigint").alias("n_extracts"), F.coalesce("error", F.lit("")).alias("error"),
    )


def xml_shred(spark, sf):
    rows = fx.stored(
        spark, sf, "shredded", lambda: shred.clustered(shred.elements(shred.shred(fx.workbook_xml(spark, sf))))
    )
    calcs = cut_lineage(calc_fields(rows))  # read for their number and for their references
    counted = calcs.groupBy("workbook_id").agg(F.count(F.lit(1)).alias("num_calc_fields"))
    return (
        metrics.data_model(rows)
        .join(metrics.structure(rows), "workbook_id")
        .join(metrics.interactivity(rows, calcs), "workbook_id")
        .join(counted, "workbook_id", "left")
        .withColumn("num_calc_fields", F.coalesce("num_calc_fields", F.lit(0)))
    )


def ingest_tables(spark, sf):
    source = ingest.TableSource(
        "Orders", f"{sf}/orders.parquet",
        schema="o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string",
    )
    return ingest.clean_columns(ingest.read_source(spark, source))


def ingest_temporal_cast(spark, sf):
    text = spark.read.parquet(f"{sf}/events.parquet").select(
        "event_id", F.col("ts").cast("string").alias("event_day"), F.col("ts").cast("string").alias("event_time")
    )
    return ingest.normalize_temporal(text, {"event_day": "date", "event_time": "timestamp"})


RAW_NAMES = """SELECT p_partkey AS part_id, CASE WHEN p_size = 1 THEN '-_-'
    ELSE ' ' || p_name || ' #' || p_type || ' é' || CAST(p_size AS VARCHAR(10)) || '%_' END AS raw_name FROM part"""


def sanitize_identifiers(spark, sf):
    return fx.query(spark, sf, RAW_NAMES).select("part_id", sanitize("raw_name").alias("clean_name"))


COLUMN_LISTS = """SELECT p_brand AS table_name, p_partkey AS column_ord,
    p_type || CASE WHEN p_size % 2 = 0 THEN ' ' ELSE '' END AS column_name FROM part"""


def dedupe_columns(spark, sf):
    return ingest.unique_names(
        fx.query(spark, sf, COLUMN_LISTS), "table_name", "column_ord", "column_name"
    ).select("table_name", "column_ord", "clean_name")


def sink_merge_append(spark, sf):
    fx.load(spark, sf)
    orders = fx.view(spark, sf, "sales_orders")
    name = f"merge_append_{uuid.uuid4().hex}"
    path = os.path.join(scratch_dir(spark), name)
    first = orders.where("order_status = 'O'").select("order_id", "total_price", "customer_id")
    second = orders.where("order_status <> 'O'").select("order_priority", "order_id", "total_price")
    sinks.write_table(first, name, "overwrite", path)
    return sinks.write_table(second, name, "append")


def sink_batches(spark, sf):
    """Orders by batches, one of them first short and then whole, another one twice."""
    orders = fx.view(spark, sf, "sales_orders").select("order_id", "total_price", "customer_id", "order_status")
    name = f"batches_{uuid.uuid4().hex}"
    path = os.path.join(scratch_dir(spark), name)
    short = orders.where("order_status = 'F' AND total_price > 0").select("order_id", "total_price")
    sinks.write_batch(short, name, "F", path)
    for status in ("O", "F", "P", "O"):
        sinks.write_batch(orders.where(F.col("order_status") == status).drop("order_status"), name, status)
    return spark.table(name)


def _loaded(spark, sf):
    found = fx.tables(spark, sf)
    found["rejected_orders"] = found["sales_orders"].where("total_price < 0")
    return found


def manifest(spark, sf):
    return ingest.manifest(_loaded(spark, sf), "main", "sales")


def workbooks_without_extract(spark, sf):
    return archives.without_extract(_corpus(spark, sf)).select("workbook_id")


def books(spark, sf):
    """(workbook_id, twb_file, workbook_name, table_paths) for the scorecard."""
    paths = archives.tables_of(
        fx.view(spark, sf, "wb_extract_tables"), "main", "sales", fx.view(spark, sf, "wb_workbooks")
    )
    return fx.view(spark, sf, "wb_workbooks").join(paths, "workbook_id").select(
        "workbook_id", F.concat("workbook_name", F.lit(".twb")).alias("twb_file"), "workbook_name", "table_paths"
    )


def table_paths(spark, sf):
    return books(spark, sf).select("workbook_id", F.array_join("table_paths", ", ").alias("table_paths"))


REQUESTS = """SELECT workbook_id AS request_id, CASE CAST(workbook_id % 4 AS INT)
    WHEN 0 THEN 'main.sales.lines, main.sales.`orders` ,,main.sales.lines'
    WHEN 1 THEN '["main.crm.people", "main.sales"]'
    WHEN 2 THEN 'main.sales, main.sales.orders' ELSE 'main.crm.people,orders' END AS source_tables
    FROM wb_workbooks"""
LISTING = """SELECT * FROM (VALUES ('main.sales', 'main.sales.orders', 'MANAGED', 1),
    ('main.sales', 'main.sales.lines', 'EXTERNAL', 2), ('main.sales', 'main.sales.recent', 'VIEW', 3),
    ('main.sales', 'main.sales.mv_total', 'MANAGED', 4), ('main.crm', 'main.crm.people', 'MANAGED', 1))
    AS t(schema_name, table_name, table_type, listing_ord)"""


def resolve_sources(spark, sf):
    return catalog.resolve_sources(fx.query(spark, sf, REQUESTS), spark.sql(LISTING)).select(
        "request_id",
        F.col("entry_ord").cast("bigint").alias("entry_ord"),
        F.col("listing_ord").cast("bigint").alias("listing_ord"),
        F.coalesce("table_name", F.lit("")).alias("table_name"),
        F.coalesce("error", F.lit("")).alias("error"),
    )


def column_catalog(spark, sf):
    found = fx.tables(spark, sf)
    rows = ingest.manifest(found, "main", "sales").select(
        F.substring_index("table_name", ".", -1).alias("table_name"), "row_count"
    )
    return catalog.column_catalog(spark, found).join(rows, "table_name").select(
        "table_name", F.col("column_ord").cast("bigint").alias("column_ord"), "column_name", "column_type",
        "norm_name", "row_count",
    )


def score_sink(spark, sf):
    name = f"complexity_scores_{uuid.uuid4().hex}"
    card = workbook_scorecard(spark, sf)
    written = sinks.write_table(card, name, "append", os.path.join(scratch_dir(spark), name))
    return written.select("workbook_id", "composite_score", "complexity_tier", "proceed")


def workbook_scorecard(spark, sf):
    return score.scorecard(
        fx.workbook_elements(spark, sf), books(spark, sf), score.STRICT_LINEAR, PRODUCT, VENDOR
    )


def workbook_scorecard_legacy(spark, sf):
    return score.scorecard(
        fx.workbook_elements(spark, sf), books(spark, sf), score.BROAD_LOG, PRODUCT, VENDOR
    )


QUERIES = {
    "corpus_scan": corpus_scan,
    "xml_shred": xml_shred,
    "ingest_tables": ingest_tables,
    "ingest_temporal_cast": ingest_temporal_cast,
    "sanitize_identifiers": sanitize_identifiers,
    "dedupe_columns": dedupe_columns,
    "sink_merge_append": sink_merge_append,
    "sink_batches": sink_batches,
    "ingest_manifest": manifest,
    "workbooks_without_extract": workbooks_without_extract,
    "table_paths": table_paths,
    "resolve_sources": resolve_sources,
    "column_catalog": column_catalog,
    "score_sink": score_sink,
}

_CLEAN = "lower(trim(regexp_replace({c}, '[^\\p{{L}}\\p{{N}}_]', '_', 'g'), '_'))"
_SHREDDED = [
    c for c in METRIC_COLUMNS
    if c not in ("num_lod_expressions", "num_table_calcs", "max_calc_nesting_depth")
]
_COUNTS = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in fx.TABLE_NAMES
)
_WIDTHS = {"sales_lines": 11, "sales_orders": 6, "sales_customers": 5, "sales_parts": 6,
           "sales_suppliers": 4, "sales_nations": 3}

CHECKS = {
    "corpus_scan": f"""SELECT workbook_id, CASE WHEN {DAMAGED} OR {BOOKLESS} THEN NULL ELSE 'Book.TWB' END AS member,
        CAST(CASE WHEN {DAMAGED} OR {BOOKLESS} THEN 0 WHEN {DOUBLE} THEN 2 ELSE 1 END AS BIGINT) AS n_workbook_members,
        CAST(CASE WHEN {DAMAGED} THEN 0 ELSE has_extract END AS BIGINT) AS n_extracts,
        CASE WHEN {DAMAGED} THEN 'BadZipFile: File is not a zip file'
             WHEN {BOOKLESS} THEN 'no .twb member in the archive' ELSE '' END AS error FROM wb_workbooks""",
    "xml_shred": f"SELECT workbook_id, {', '.join(_SHREDDED)} FROM metrics",
    "ingest_tables": "SELECT * FROM orders",
    "ingest_temporal_cast": "SELECT event_id, CAST(ts AS DATE) AS event_day, ts AS event_time FROM events",
    "sanitize_identifiers": f"""SELECT part_id, coalesce(nullif({_CLEAN.format(c='raw_name')}, ''), 'unnamed_table')
        AS clean_name FROM ({RAW_NAMES})""",
    "dedupe_columns": f"""SELECT table_name, column_ord, base || CASE WHEN n = 1 THEN '' ELSE '_' || (n - 1) END
        AS clean_name FROM (SELECT *, row_number() OVER (PARTITION BY table_name, base ORDER BY column_ord) AS n
        FROM (SELECT *, {_CLEAN.format(c='column_name')} AS base FROM ({COLUMN_LISTS})))""",
    "sink_batches": "SELECT order_id, total_price, customer_id, order_status AS batch_id FROM sales_orders",
    "sink_merge_append": """SELECT order_id, total_price,
        CASE WHEN order_status = 'O' THEN customer_id END AS customer_id,
        CASE WHEN order_status <> 'O' THEN order_priority END AS order_priority FROM sales_orders""",
    "ingest_manifest": " UNION ALL ".join(
        f"SELECT 'main.sales.{n}' AS table_name, (SELECT count(*) FROM {n}) AS row_count,"
        f" CAST({w} AS BIGINT) AS column_count" for n, w in _WIDTHS.items()
    ) + " UNION ALL SELECT 'main.sales.rejected_orders', (SELECT count(*) FROM sales_orders WHERE total_price < 0), 6",
    "workbooks_without_extract": f"""SELECT workbook_id FROM wb_workbooks WHERE has_extract = 0
        AND NOT ({DAMAGED}) AND NOT ({BOOKLESS})""",
    "table_paths": "SELECT workbook_id, table_paths FROM book_paths",
    "resolve_sources": f"""SELECT request_id, CAST(e AS BIGINT) AS entry_ord, CAST(l AS BIGINT) AS listing_ord,
        table_name, error FROM ({REQUESTS}) r JOIN (VALUES
        (0, 0, 0, 'main.sales.lines', ''), (0, 1, 0, 'main.sales.orders', ''),
        (1, 0, 0, 'main.crm.people', ''), (1, 1, 1, 'main.sales.orders', ''), (1, 1, 2, 'main.sales.lines', ''),
        (2, 0, 1, 'main.sales.orders', ''), (2, 0, 2, 'main.sales.lines', ''),
        (3, 0, 0, 'main.crm.people', ''),
        (3, 1, 0, '', 'Expected catalog.schema.table or catalog.schema, got ''orders'''))
        AS t(m, e, l, table_name, error) ON r.request_id % 4 = t.m""",
    "column_catalog": f"""SELECT c.table_name, CAST(column_ord AS BIGINT) AS column_ord, column_name, column_type,
        trim(regexp_replace(lower(column_name), '[^0-9a-z]+', '_', 'g'), '_') AS norm_name, row_count
        FROM table_columns c JOIN ({_COUNTS}) n ON n.table_name = c.table_name""",
    "score_sink": "SELECT workbook_id, " + r1("composite")
    + " AS composite_score, complexity_tier, proceed FROM decided",
}
CHECKS = {k: check(v) for k, v in CHECKS.items()}
