"""Time the named queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Each query runs to the end
with its result thrown away; one query runs first, untimed, to start the session.
"""

from __future__ import annotations

import json
import os
import sys
import time

from thermoweave.plans.queries import registered
from thermoweave.session import build_session


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        conf={"spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        registered()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    names = names or list(registered())
    run("group_count")
    times = {name: round(run(name), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of all named queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
