"""Named queries over the given tables and the SQL that checks them."""

from vizquarry.workload import calc_functions, datasets, estate, ingest, semantic

MODULES = [ingest, estate, semantic, calc_functions, datasets]
