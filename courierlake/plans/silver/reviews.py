"""Silver reviews: ratings, flags and sentiment checks, one row per review."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.functions import clean_title, try_boolean, try_date
from courierlake.operators.dedup import ROW_HASH, keep_latest, with_row_hash
from courierlake.plans.silver.common import loaded_at

RATINGS = ("overall", "food", "delivery", "driver", "packaging", "value")


def clean_reviews(bronze: DataFrame, as_of: date) -> DataFrame:
    response = F.trim("restaurant_response")
    typed = with_row_hash(bronze).filter(F.col("review_id").isNotNull()).select(
        *[
            F.trim(c).alias(c)
            for c in ("review_id", "order_id", "customer_id", "restaurant_id", "driver_id")
        ],
        *[
            F.col(f"{r}_rating").cast("string").try_cast("decimal(3,1)").alias(f"rating_{r}")
            for r in RATINGS
        ],
        F.trim("review_text").alias("review_content"),
        try_date("review_date").alias("review_date"),
        clean_title("sentiment").alias("sentiment"),
        try_boolean("is_verified").alias("is_verified_purchase"),
        F.coalesce("helpful_votes", F.lit(0)).alias("helpful_votes_count"),
        F.coalesce("report_count", F.lit(0)).alias("report_count"),
        F.coalesce(response, F.lit("No Response")).alias("restaurant_response_text"),
        F.coalesce(response != "", F.lit(False)).alias("has_restaurant_responded"),
        try_boolean("is_featured").alias("is_featured_review"),
        clean_title("platform").alias("source_platform"),
        try_boolean("images_attached").alias("has_images"),
        F.col("event_time").cast("timestamp").alias("_extracted_at"),
        ROW_HASH,
        loaded_at(as_of),
    )
    overall = F.col("rating_overall")
    flagged = typed.withColumns(
        {
            "is_positive_review": overall >= 4,
            "is_negative_review": overall <= 2,
            "is_conflicting_sentiment": (F.col("sentiment") == "Negative") & (overall >= 4),
        }
    )
    return keep_latest(flagged, "review_id", "_extracted_at")
