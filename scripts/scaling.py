"""Seconds of four queries on 1, 4 and 8 cores, over the driver's tables rewritten once into many files
(one file is one row group here, so a single file hides what more cores do).
Usage: python scripts/scaling.py [sf_dir] [files]"""

from __future__ import annotations

import json
import os
import subprocess
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES = ["daily_index", "silver_measurements", "day_stations", "question_routing"]
TABLES = ["events", "supplier", "nation", "conversations"]


def measure(folder: str, cores: int) -> dict[str, float]:
    from aeris.plans import catalog
    from aeris.session import build_session

    spark = build_session("scaling", master=f"local[{cores}]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    out = {}
    for name in QUERIES:
        for _ in range(2):  # the second run counts
            t = time.perf_counter()
            catalog.queries()[name](spark, folder).write.format("noop").mode("overwrite").save()
            out[name] = round(time.perf_counter() - t, 2)
    return out


def main() -> None:
    if sys.argv[1:2] == ["--one"]:
        print(json.dumps(measure(sys.argv[2], int(sys.argv[3]))))
        return
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    files = int(sys.argv[2]) if len(sys.argv) > 2 else 32
    from aeris.session import build_session

    folder = tempfile.mkdtemp(prefix="aeris-scaling-")
    spark = build_session("rewrite", master="local[8]")
    for t in TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").repartition(files).write.parquet(f"{folder}/{t}.parquet")
    spark.stop()
    for cores in (1, 4, 8):
        run = subprocess.run([sys.executable, os.path.abspath(__file__), "--one", folder, str(cores)], capture_output=True, text=True, check=True)
        print(cores, run.stdout.strip().splitlines()[-1], flush=True)


if __name__ == "__main__":
    main()
