"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import time

from harrier.plans import catalogue
from harrier.session import get_session

HEADLINE = ["coverage_matrix", "alert_register", "register_merge", "first_purchase_after", "bm25_search", "document_frequency", "facet_counts", "best_theme", "top_five", "period_summary"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    settings = {"spark.sql.shuffle.partitions": cpus, "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    spark = get_session("bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINE:
        began = time.time()
        catalogue.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
