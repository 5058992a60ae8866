"""Time the headline queries: prints one JSON line.

`BENCH_SF_DIR` and `BENCH_CPUS` choose data and cores; names on the command line choose queries.
The packed inputs (JSON records and flat rows made from the test tables) are written before the clock starts. Building a query,
with the small jobs that measure and keep entities, and running it to the end, into a sink that discards the rows, are
reported apart as well.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from flowspark.session import local_session
from workload import inputs
from workload.queries import QUERIES


def written_once(spark, sf_dir: str) -> None:
    """Replace every input of the workload by a table of it that has been written."""
    folder = tempfile.mkdtemp(prefix="bench-")
    for name in inputs.INPUTS:
        path = f"{folder}/{name}"
        getattr(inputs, name)(spark, sf_dir).write.parquet(path)
        setattr(inputs, name, lambda session, _, path=path: session.read.parquet(path))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or list(QUERIES)
    spark = local_session(cpus)
    written_once(spark, sf_dir)
    seconds: dict[str, float] = {}
    building: dict[str, float] = {}
    for name in chosen:
        began = time.perf_counter()
        query = QUERIES[name](spark, sf_dir)
        built = time.perf_counter()
        query.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
        building[name] = round(built - began, 3)
        print(f"{name}: {seconds[name]} s, of which building {building[name]} s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "building": building,
                "sf": float(Path(sf_dir).name.removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
