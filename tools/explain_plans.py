"""Write PLANS.md: physical plans of the main operators, as large inputs get them.

usage: python tools/explain_plans.py [sf_dir]
Broadcast joins are disabled (static and AQE) so the plans show the
shuffle strategy a cluster uses once the inputs outgrow the threshold;
AQE may still switch a join to broadcast at run time after measuring it.
"""

from __future__ import annotations

import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shopfloor import session  # noqa: E402
from shopfloor.operators import load  # noqa: E402
from shopfloor.plans import catalog, checks, pipeline, reports  # noqa: E402

NOTES = {
    "forward_fill": "One `Exchange hashpartitioning(__bucket)` feeds the bucket window; the buckets come "
                    "from quantiles through a binary search (`UDF` of `Bucketizer`, in the JVM). The tails "
                    "come from a partial `HashAggregate` before their exchange, over a narrow scan. The only "
                    "`SinglePartition` exchange holds the bucket table (one row per bucket, at most 2^14). "
                    "The carry joins back on `__bucket` without re-shuffling the rows.",
    "join_sensor_quality": "Null-safe keys appear as `coalesce(k, ·), isnull(k)` plus `__salt` in the "
                           "`hashpartitioning` of both sides: NULL-key rows spread over the salts. "
                           "The quality-side record ids are pruned (no output uses them).",
    "hourly_summary": "One `HashAggregate` pair (partial before the exchange, final after), "
                      "no join.  The NULL-key filter is pushed below the join.",
    "machine_overview": "Both sides are reduced per machine (partial + final aggregate) before the join.",
    "temp_vs_defects": "Both sides are reduced per (machine, hour) before an equi-join on those keys.",
    "readings_with_checks": "NULL-key readings carry `__nk` in the join keys, spreading over tasks.",
    "validation_report": "One aggregate per table (three scans), unpivoted; shares use a window over "
                         "the few per-flag rows.",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = session.local_session(8, shuffle_partitions=16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    p = pipeline.from_sf_dir(spark, sf_dir)
    base = session.scratch_path(spark, f"shopfloor-plans-{uuid.uuid4().hex}")
    pipeline.run_pipeline(spark, p, base)          # reports and checks read published tables
    pub = load.published_tables(spark, base)
    t = reports.Tables(pub["sensor_readings"], pub["quality_checks"], pub["hourly_summary"])
    frames = {
        "forward_fill": catalog.REGISTRY["forward_fill"].run(spark, sf_dir),
        "join_sensor_quality": p.joined,
        "hourly_summary": p.hourly,
        "machine_overview": reports.machine_overview(t),
        "temp_vs_defects": reports.temp_vs_defects(t),
        "readings_with_checks": reports.readings_with_checks(t),
        "validation_report": checks.validation_report(t),
    }
    out = ["# Physical plans", "",
           f"Generated by `tools/explain_plans.py` on `{sf_dir}` with broadcast joins disabled, so "
           "the shuffle plans shown are the ones large inputs get. `AdaptiveSparkPlan` may still "
           "coalesce partitions, split skewed ones and turn a measured-small side into a broadcast "
           "at run time.", ""]
    for name, df in frames.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        out += [f"## {name}", "", NOTES.get(name, ""), "", "```", plan.rstrip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
