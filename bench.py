"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1) and BENCH_CPUS the local cores.
Each query runs in full into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.compare import session  # noqa: E402
from checks.queries import REGISTRY  # noqa: E402
from shelfmark.bindings import Tables  # noqa: E402

HEADLINES = [
    "c1_clean_catalog",
    "j1_reviews_with_catalog",
    "a7a_rating_per_author_year",
    "a7b_rating_per_title_year",
    "c5_books_with_most_ratings",
    "a17_top_shares_with_others",
    "c3_normalised_reviews",
    "c2_enriched_reviews",
    "c2_enriched_line_items",
    "t8_review_sentiment_joined",
    "t9_review_adjectives_joined",
    "a7c_sentiment_per_author_year",
    "c6_author_search",
    "a11_adjective_counts",
    "a10_adjectives_per_author_title_year",
    "c8_author_word_cloud",
    "t3_bag_of_words",
    "c11_top_sports_with_others",
    "c13_dataset_profile",
    "x2_each_batch_enriched_and_appended",
    "a7_live_rating_per_author_year",
    "a9_catalog_loaded_three_times",
    "q1_rows_admitted_at_load",
    "c6_author_search_by_trigrams",
    "j1_bucketed_tables",
    "t9_adjectives_by_sentence",
    "q4_surrogate_key",
    "t6_topic_words",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    tables = Tables(spark, folder)
    tables.table("lineitem").count()
    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        start = time.time()
        REGISTRY[name](tables).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    result = {
        "metric": "headline queries, total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
