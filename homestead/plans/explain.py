"""Print the physical plan of registered queries.

    python -m homestead.plans.explain [--sf DIR] [--no-broadcast] QUERY [QUERY ...]

``--no-broadcast`` turns Spark's automatic broadcast off, which shows the
plan a query gets when every join side is far larger than the threshold (the
100 TB case); explicit, size-checked broadcasts still appear.
"""

from __future__ import annotations

import argparse


def main(argv=None) -> None:
    from ..session import build_session
    from .catalog import QUERIES

    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("queries", nargs="+", choices=sorted(QUERIES))
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--no-broadcast", action="store_true")
    ap.add_argument("--mode", default="formatted", choices=["simple", "extended", "formatted", "cost"])
    args = ap.parse_args(argv)
    extra = {}
    if args.no_broadcast:
        extra = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    spark = build_session("local[*]", app="homestead-explain", shuffle_partitions=8, extra=extra)
    for name in args.queries:
        print(f"===== {name}")
        QUERIES[name](spark, args.sf).explain(args.mode)
    spark.stop()


if __name__ == "__main__":
    main()
