"""BI workbook estates as Spark tables: ingest, estate metrics, semantic layer, dashboard datasets."""
