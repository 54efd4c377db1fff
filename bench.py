"""Benchmark: the backfill pipeline (clean → stage → validate → load) and the
analytical and profiling queries over its output, at $BENCH_SF_DIR on
local[$BENCH_CPUS]. Prints one JSON line.

Stages are timed the way the reference reports them: the whole pipeline
(its logged total), then each analytical query against the loaded
warehouse, then profiling sections against the raw export."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from studylake.operators import clean as C  # noqa: E402
from studylake.operators import load as L  # noqa: E402
from studylake.operators import profile as P  # noqa: E402
from studylake.plans import analytics as A  # noqa: E402
from studylake.plans.pipeline import run_backfill  # noqa: E402
from studylake.session import build_session, staging_path  # noqa: E402
from studylake.sources import fixtures  # noqa: E402


def _force(df):
    """Run a query to completion without shipping rows to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    # Land the raw export once (the reference also reads its CSV once);
    # the pipeline and the profiling sections then read Parquet.
    land = staging_path(spark, "bench-landing")
    timed("land_raw", lambda: (
        fixtures.raw_studies(spark, sf_dir).write.parquet(os.path.join(land, "raw")),
        fixtures.raw_locations(spark, sf_dir).write.parquet(os.path.join(land, "locations"))))
    raw = spark.read.parquet(os.path.join(land, "raw"))
    locs = spark.read.parquet(os.path.join(land, "locations"))

    res = timed("pipeline_backfill", lambda: run_backfill(spark, raw, locs, run_id="bench"))
    if not res.ok:
        raise SystemExit(res.report)
    t = L.read_warehouse(spark, res.paths)
    st, org = t["studies"], t["organizations"]
    cond, itv = t["study_conditions"], t["study_interventions"]

    queries = {
        "q1_type_phase": lambda: A.q1_type_phase(st),
        "q2_top_conditions": lambda: A.q2_top_conditions(cond, st),
        "q3_interventions": lambda: A.q3_interventions(itv, st, 50),
        "q4a_orgs": lambda: A.q4a_orgs(org, st),
        "q4b_countries": lambda: A.q4b_countries(t["study_locations"]),
        "q5_timeline": lambda: A.q5_timeline(st),
        "b1_phase_funnel": lambda: A.b1_phase_funnel(st),
        "b2_org_class": lambda: A.b2_org_class(org, st),
        "b3_late_phase": lambda: A.b3_late_phase(cond, st),
        "s1_type_phase": lambda: A.s1_type_phase(st),
        "s2_conditions": lambda: A.s2_conditions(cond),
        "s3_years": lambda: A.s3_years(st),
        "clean_stats": lambda: C.clean_stats(raw),
        "prof_missing": lambda: P.missing(raw),
        "prof_categories": lambda: P.categories(raw),
        "prof_multi": lambda: P.multi_value(raw),
        "prof_multi_top": lambda: P.multi_value_top(raw),
        "prof_uniques": lambda: P.uniques(raw),
    }
    for name, q in queries.items():
        timed(name, lambda q=q: _force(q()))

    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
