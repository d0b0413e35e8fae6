"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from vizquarry.session import get_session  # noqa: E402
from vizquarry.workload import MODULES, fixtures  # noqa: E402

HEADLINE = [
    "workbook_scorecard", "calc_nesting_depth", "inline_refs", "translate_corpus", "build_views",
    "mv_join_measure", "profile_columns", "xml_shred", "corpus_scan", "agg_structure", "dedupe_calcs",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    queries = {n: q for m in MODULES for n, q in m.QUERIES.items()}
    spark = get_session("bench", cpus)
    spent: dict[str, float] = {}

    def timed(name, run):
        start = time.time()
        run().write.format("noop").mode("overwrite").save()
        spent[name] = round(time.time() - start, 3)
        print(name, spent[name], file=sys.stderr, flush=True)

    # All element rows, made once on their own; a query makes those it looks at.
    timed("estate_elements", lambda: fixtures.workbook_elements(spark, sf_dir))
    for name in wanted:
        timed(name, lambda: queries[name](spark, sf_dir))
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(spent.values()), 3),
                "unit": "sec",
                "queries": spent,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
