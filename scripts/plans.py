"""Print the physical plans of the headline queries as Markdown (the source
of PLANS.md). usage: python scripts/plans.py [sf_dir] > plans.md"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from terrascore import catalog  # noqa: E402
from terrascore.session import local_session  # noqa: E402

KEYS = ("mart_assessment", "job_rainfall", "ras_zonal_mean", "mart_dim_date")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(cores=8, shuffle_partitions=16)
    for k in KEYS:
        df = catalog.QUERIES[k](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        print(f"### {k}\n\n```\n{buf.getvalue().strip()}\n```\n")


if __name__ == "__main__":
    main()
