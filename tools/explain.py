"""Print the physical plan outline of registered reports.

Usage: python tools/explain.py [--run] key [key ...]   (sf dir via SF_DIR)
With --run the query is executed first so the adaptive (final) plan is shown.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabula.plans.registry import QUERIES  # noqa: E402
from tabula.session import build_session  # noqa: E402


def main(args):
    run = "--run" in args
    keys = [a for a in args if a != "--run"]
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session()
    for key in keys:
        df = QUERIES[key](spark, sf)
        if run:
            df.write.format("noop").mode("overwrite").save()
        print(f"===== {key}")
        print(df._jdf.queryExecution().executedPlan().toString())


if __name__ == "__main__":
    main(sys.argv[1:])
