"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) pick data and cores.
Each query runs once to warm the JVM, then BENCH_RUNS times (default 2); the best time counts.
Every run does all its work from the raw feeds; nothing is kept between runs.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ampline.plans.catalogue import QUERIES  # noqa: E402
from tests.session import make_session  # noqa: E402

HEADLINE = [
    "tlm_clean", "trg_mapped", "tlm_transitions", "fused_ignition", "battery_timeline",
    "ignition_with_battery", "charge_pairs", "charging_events", "dq_tlm", "viz_hour_heatmap",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = make_session(os.environ.get("BENCH_CPUS", "8"), os.environ.get("BENCH_MEMORY", "16g"))
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            begin = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.time() - begin)
        seconds[name] = round(min(times[1:] or times), 3)
    spark.stop()
    print(json.dumps({
        "metric": "sum of headline query times", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
