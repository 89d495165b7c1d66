"""Write PLANS.md: the physical plans of the key query shapes at one scale.

    python tools/show_plans.py [SF_DIR] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from roundstats.operators import numbers as N  # noqa: E402
from roundstats.operators import sampling as S  # noqa: E402
from roundstats.operators import vectors as V  # noqa: E402
from roundstats.operators import words as W  # noqa: E402
from roundstats.operators.parts import spread  # noqa: E402
from roundstats.plans import reports as R  # noqa: E402
from roundstats.plans.clustering import _as_parted  # noqa: E402
from roundstats.session import get_session  # noqa: E402
from roundstats.sources import documents_from, points_from, table  # noqa: E402


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().strip()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16)
    raw = documents_from(table(spark, sf, "documents"))
    docs = spread(raw, "doc_id")
    acct = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("v"))
    pts = spread(_as_parted(points_from(table(spark, sf, "embeddings"), "vec_id", "embedding")), "id")
    centers = V.Centers.from_rows([(0, i, r["v"]) for i, r in
                                   enumerate(pts.orderBy("id").limit(4).collect())])
    first = [(0, int(r["id"]), list(r["v"])) for r in S.pick_uniform(pts, 7, 0, by_part=True).collect()]
    shapes = [
        ("word_count (file as read: one exchange, by word)", W.word_count(raw)),
        ("word_count after spread (the spread is the first exchange)", W.word_count(docs)),
        ("doc_word_counts after spread (aggregate reuses the doc_id layout)", W.doc_word_counts(docs)),
        ("word_count_salted (two rounds)", W.word_count_salted(raw, 12, 7)),
        ("word_count_by_part, relayout=True (texts move once)", W.word_count_by_part(raw, 12, relayout=True)),
        ("nonneg filter (pushed to parquet)", N.nonneg(acct)),
        ("number_report final aggregate", R.number_report(acct, "v")),
        ("sort_with_index (after the checkpointed range sort)", N.sort_with_index(acct, ["v", "id"])),
        ("assign (Arrow kernel, centers broadcast)", V.assign(pts, centers, by_part=False)),
        ("Lloyd round: per-task partial sums merged by Spark", V.center_sums(pts, centers, "v", "w")),
        ("seeding step: kernel sends <= 2 candidates per part and task",
         S.draw_next(S.start_nearest(pts), first, [first[0][:2]], 7, 1)),
    ]
    print(f"# Physical plans ({sf}, local[8], AQE on)\n")
    print("Generated by `tools/show_plans.py`. AQE re-plans shuffles at run time;")
    print("these are the plans it starts from.\n")
    for title, df in shapes:
        print(f"## {title}\n\n```\n{plan(df)}\n```\n")


if __name__ == "__main__":
    main()
