"""Times the headline queries; prints one JSON line. The pool of candidates is computed once, timed as ``pool``, and shared."""

import json
import os
import time

from linkspan.plans import queries as resolution
from linkspan.session import session, ship

HEADLINES = ["doc_freq", "block_score", "block_top_k", "block_quota_top_k", "rerank_exact", "candidate_run", "num_features", "token_alignment", "exclusive_winner", "hybrid_candidates", "meta_context", "meta_decide", "macro_f05", "threshold_grid"]
CORPUS = ["op1_mixing", "op2_ngram_jaccard", "op3_pii", "op4_nearest", "op5_language_id", "op6_chat_format", "op7_token_files", "op8_quality_rules", "op9_byte_bpe", "op10_line_dedup"]


def main() -> None:
    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = ship(session("bench", **{"spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")}))
    spark.sparkContext.setLogLevel("ERROR")
    view = resolution.View(spark, folder)
    chosen = {"pool": lambda *_: view.pool} | {name: lambda *_, q=resolution.QUERIES[name]: q(view) for name in HEADLINES}
    try:
        from linkspan.llm import registry

        chosen |= {name: registry.QUERIES[name] for name in CORPUS}
    except ImportError:
        pass
    spark.read.parquet(f"{folder}/documents.parquet").count()
    took = {}
    for name, query in chosen.items():
        start = time.time()
        query(spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "note": "pool is computed once and shared by the queries that rank it", "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
