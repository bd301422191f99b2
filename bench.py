"""Headline timings: prints one JSON line.

BENCH_SF_DIR names the folder of Parquet tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from checks.registry import QUERIES
from claimweave.operators import cleaning, profiling, vectors
from claimweave.plans import retrieval, verification, views
from claimweave.sources import index_store


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    scratch = tempfile.mkdtemp(prefix="claimweave-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, action):
        start = time.perf_counter()
        result = action()
        times[name] = round(time.perf_counter() - start, 3)
        return result

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    articles, own = views.articles(spark, directory), views.article_vectors(spark, directory)
    claims, claim_vectors = views.claims(spark, directory), views.claim_vectors(spark, directory)
    run(articles)  # starts executors and reads file footers

    timed("profile", lambda: [run(QUERIES[q](spark, directory)) for q in (
        "profile_label_distribution", "label_statistics", "profile_length_statistics", "profile_data_quality")])
    timed("longest_articles", lambda: run(profiling.longest_articles(articles)))
    timed("clean_articles", lambda: run(cleaning.clean_articles(views.raw_sheet(spark, directory))))
    timed("vector_topk", lambda: run(vectors.best_scores(
        own.selectExpr("article_id AS query_id", "embedding", "article_id AS exclude_article_id"), own, 10)))
    timed("index_build", lambda: index_store.save_index(articles, own, f"{scratch}/index", int(cpus)))
    index = index_store.load_index(spark, f"{scratch}/index")
    timed("retrieve", lambda: run(retrieval.retrieve(claims, claim_vectors, index)))
    timed("retrieve_one_claim", lambda: run(retrieval.retrieve(claims.where("claim_id = -1"), claim_vectors, index)))
    timed("verify", lambda: run(verification.verify(claims, claim_vectors, index).prompts))
    n_claims = claims.count()
    print(json.dumps({
        "metric": "total wall time of headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "claims": n_claims,
        "retrieve_sec_per_claim": round(times["retrieve"] / max(n_claims, 1), 4),
        "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
