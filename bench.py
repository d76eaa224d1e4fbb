"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from exprspark import catalog  # noqa: E402
from exprspark.session import local_session  # noqa: E402

HEADLINE = (
    "a1_library_size", "a3_cpm", "a4_tpm_log2", "a5_expressed_filter", "a6_tmm_factors", "a7_mean_log_cpm", "a8_variance_filter",
    "a9_sample_correlation", "a13_differential_expression", "a14_bh_adjust", "a20_ora", "a22_gsea", "a31_find_markers",
    "a33_residual_variance", "a34_transfer_labels", "a43_w5_coverage", "a44_average_tracks", "a45_mark_duplicates",
    "a47_position_quality", "a48_allele_fractions", "a49_five_numbers", "a53_similarity_network", "j15_count_overlaps",
    "j16_union_tracks", "p35_trim_reads", "w1_rank_by_order", "flagship_mean_log_cpm_top",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    registered = catalog.queries()
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # warm up
    times = {}
    for name in wanted:
        start = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
