"""Time the headline queries and print one JSON line.

Every query is computed in full into a sink that drops the rows.  Stored states
and snapshots are inputs, so writing them is timed once, on its own; plans and
next states are computed afresh inside each query that needs them.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from everkey.catalog import full_catalog
from everkey.plans import workload as w
from everkey.session import local_session

HEADLINE = [
    "resolve_keys", "migrate_keys", "resolve_names", "variant_detail", "entity_bundle", "search_variants",
    "set_contents", "coverage_check", "entity_bundle_variants",
    "canon_text", "parse_key", "flatten_variants", "duplicate_keys", "apply_corrections_variants",
    "plan_entity_renames", "plan_entity_cases", "plan_variant_renames", "plan_ownership_veto",
    "next_variants", "scd2_history", "initial_load", "build_history",
    "published_entities", "variants_named", "set_catalogue", "table_digest",
    "check_open_keys", "check_key_ownership", "check_write_rules", "check_published", "check_links", "violations",
]


def computed(df) -> int:
    """Runs the whole query; the number of exchanges in its plan."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") + plan.count("Exchange SinglePartition") + plan.count("Exchange RoundRobin")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    settings = {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="everkey-bench-")}
    spark = local_session(cores, "everkey-bench", **{**settings, "spark.sql.shuffle.partitions": cores})
    queries = full_catalog().queries
    wanted = sys.argv[1:] or HEADLINE

    times, exchanges = {}, {}
    start = time.perf_counter()
    for scenario in ("clean", "plain", "coarse"):
        w.state(spark, sf_dir, scenario)
        w.snapshot(spark, sf_dir, scenario)
    w.state(spark, sf_dir, "clean", corrupt=True)
    w.payload(spark, sf_dir)
    w.damaged_state(spark, sf_dir)
    times["write_inputs"] = time.perf_counter() - start
    for name in wanted:
        w.forget("plan")
        w.forget("after")
        start = time.perf_counter()
        exchanges[name] = computed(queries[name](spark, sf_dir))
        times[name] = time.perf_counter() - start
        print(f"{name} {times[name]:.2f}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": {name: round(seconds, 3) for name, seconds in times.items()}, "exchanges": exchanges, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
