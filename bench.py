"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Stage tables (clean clients, register with its index, internal list, edges) are built first, under their own
names; each query then runs from the tables it reads, like the steps of the workflow. A query's
time is the median of ``BENCH_RUNS`` runs after one warm-up, results written to a null sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from namebridge.config import MatchConfig
from namebridge.operators import candidates as cand
from namebridge.operators import mapping
from namebridge.operators.best_candidates import best_candidates
from namebridge.operators.hierarchy import enrich_hierarchy
from namebridge.operators.ranking import match_results, review_queue
from namebridge.plans.stages import Stages, stages

SEQ = MatchConfig()

QUERIES = {
    "candidates_lei": lambda st: cand.lei_candidates(st.clients(), st.reference()),
    "candidates_registration": lambda st: cand.registration_candidates(st.clients(), st.reference()),
    "candidates_name_country": lambda st: cand.name_country_candidates(st.clients(), st.reference()),
    "candidates_name_only": lambda st: cand.name_only_candidates(st.clients(), st.reference()),
    "best_candidates": lambda st: best_candidates(st.clients(), st.reference(), SEQ, index=st.index()),
    "review_queue": lambda st: review_queue(st.ranked(SEQ), SEQ),
    "hierarchy_enrich": lambda st: enrich_hierarchy(
        match_results(st.ranked(SEQ), SEQ), st.edges(), st.entities(), SEQ
    ),
    "gold_fuzzy_mapping": lambda st: mapping.fuzzy_mappings(st.hierarchy(SEQ), st.internal(), SEQ),
    "gold_mapping": lambda st: mapping.map_to_internal(st.hierarchy(SEQ), st.internal(), SEQ),
}


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("namebridge-bench")
        .config("spark.sql.shuffle.partitions", os.environ.get("BENCH_PARTITIONS", cpus))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def run(df: DataFrame) -> None:
    df.write.mode("overwrite").format("noop").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = set(sys.argv[1:])
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    st: Stages = stages(spark, sf_dir)
    times["build_stages"] = timed(lambda: (st.clients(), st.index(), st.internal(), st.edges()))
    for name, query in QUERIES.items():
        if only and name not in only:
            continue
        timed(lambda: run(query(st)))
        times[name] = statistics.median(timed(lambda: run(query(st))) for _ in range(runs))
        print(name, times[name], file=sys.stderr)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
