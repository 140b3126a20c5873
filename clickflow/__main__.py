"""Command line: python -m clickflow {list | run NAME SF_DIR [OUT] | job NAME EVENTS_DIR [key=value ...]}

``run`` executes a registered batch query over a folder of the driver's
tables and writes parquet to OUT (or shows 20 rows).  ``job`` starts one of
the streaming jobs of ``clickflow.jobs`` and waits for it; pass
``available_now=true`` to process what is in the folder and stop.
"""
from __future__ import annotations

import sys


def _value(v: str):
    if v.lower() in ("true", "false"):
        return v.lower() == "true"
    try:
        return int(v)
    except ValueError:
        return v


def main(argv: list[str]) -> int:
    from clickflow import jobs
    from clickflow.plans import QUERIES
    if not argv or argv[0] == "list":
        print("queries:", " ".join(QUERIES))
        print("jobs:", " ".join(jobs.STREAM_JOBS))
        return 0
    from clickflow.session import build_session
    spark = build_session()
    if argv[0] == "run":
        name, sf_dir = argv[1], argv[2]
        df = QUERIES[name](spark, sf_dir)
        if len(argv) > 3:
            df.write.mode("overwrite").parquet(argv[3])
        else:
            df.show(20, truncate=False)
        return 0
    if argv[0] == "job":
        name, events_dir = argv[1], argv[2]
        kwargs = dict(a.split("=", 1) for a in argv[3:])
        q = jobs.STREAM_JOBS[name](spark, events_dir, **{k: _value(v) for k, v in kwargs.items()})
        q.awaitTermination()
        return 0
    print(__doc__)
    return 2


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
