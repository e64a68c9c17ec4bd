"""Newest change per key, in all forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from showcase import feeds
from showcase.registry import query
from tidemark import keep_latest, max_seq_per_key

# The day is the sequence, so a user has ties at the newest one.
_DAILY = "SELECT user_id, (epoch_ms(ts) // 86400000)::BIGINT AS day, event_id, event_type, value FROM events"


def _daily(spark, sf_dir):
    day = F.floor(feeds.ntz_millis(F.col("ts")) / 86400000).alias("day")
    return feeds.table(spark, sf_dir, "events").select("user_id", day, "event_id", "event_type", "value")


@query("SELECT user_id::VARCHAR AS _id, max(event_id) AS max_seq FROM events GROUP BY user_id", name="max_seq_per_key")
def newest_seq(spark, sf_dir):
    return max_seq_per_key(feeds.event_feed(spark, sf_dir))


_TIES = f"WITH d AS ({_DAILY}) SELECT * FROM d QUALIFY rank() OVER (PARTITION BY user_id ORDER BY day DESC) = 1"
_ONE = f"""WITH d AS ({_DAILY}) SELECT * FROM d
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY day DESC, event_id DESC) = 1"""


@query(_TIES)
def keep_latest_join(spark, sf_dir):
    return keep_latest(_daily(spark, sf_dir), ["user_id"], "day", method="join")


@query(_TIES)
def keep_latest_window(spark, sf_dir):
    return keep_latest(_daily(spark, sf_dir), ["user_id"], "day", method="window")


@query(_ONE)
def keep_latest_one_row(spark, sf_dir):
    return keep_latest(_daily(spark, sf_dir), ["user_id"], "day", ties="one")


@query(_ONE)
def keep_latest_max_by(spark, sf_dir):
    return keep_latest(_daily(spark, sf_dir), ["user_id"], "day", ties="one", method="max_by")
