"""Inspect registered queries.

    python -m strata.plans list
    python -m strata.plans explain KEY [SF_DIR]     # formatted physical plan (after a run: final AQE plan)
    python -m strata.plans oracle KEY               # the DuckDB oracle text
"""

from __future__ import annotations

import sys

from strata.plans import ORACLES, QUERIES


def main(argv: list[str]) -> int:
    if not argv or argv[0] == "list":
        for k in sorted(QUERIES):
            print(k, "" if k in ORACLES else "(no oracle)")
        return 0
    cmd, key = argv[0], argv[1]
    if cmd == "oracle":
        print(ORACLES.get(key, "-- no oracle"))
        return 0
    if cmd == "explain":
        from strata.session import get_session

        sf = argv[2] if len(argv) > 2 else "/root/testdata/sf0.01"
        spark = get_session("local[*]")
        df = QUERIES[key](spark, sf)
        df.write.format("noop").mode("overwrite").save()   # run it, so AQE shows its final plan
        df.explain("formatted")
        return 0
    print(__doc__)
    return 2


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
