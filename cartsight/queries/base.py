"""Registry, shared views, and the shared parts of the SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartsight.operators.examples import training_examples
from cartsight.operators.sessions import sessions_by_gap
from cartsight.operators.split import ends_of, temporal_split
from cartsight.params import MINUTE_US, SessionParams
from cartsight.sources import fixtures
from cartsight.sources.tables import new_folder, settle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

GAP = 480  # minutes; the given events are sparse, so richer sessions than at the default 30


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"Duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# --- Spark views ----------------------------------------------------------------------------------


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.clickstream(spark, sf_dir)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.catalog(spark, sf_dir)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.users(spark, sf_dir)


def sessionized(spark: SparkSession, sf_dir: str, gap: int = GAP) -> DataFrame:
    return sessions_by_gap(clicks(spark, sf_dir), SessionParams(inactivity_minutes=gap))


def split_events(spark: SparkSession, sf_dir: str, gap: int = GAP) -> DataFrame:
    ev = sessionized(spark, sf_dir, gap)
    return temporal_split(ev, ends_of(clicks(spark, sf_dir)))


def scored_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled examples with a score that both engines compute exactly, ties included."""
    examples = training_examples(settle(sessionized(spark, sf_dir)))
    mixed = F.col("item_id") * 13 + F.col("session_seq") * 7 + F.col("user_id") * 3
    return settle(examples.withColumn("score", (mixed % 101) / F.lit(101.0)))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, on storage that all executors share."""
    return new_folder(spark, name)


# --- SQL parts ------------------------------------------------------------------------------------

SQL_CLICKS = """clickstream AS (
  SELECT event_id, user_id, epoch_us(ts) AS us,
    CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'scroll'
      WHEN 'signup' THEN 'add_to_cart' WHEN 'error' THEN 'remove_from_cart'
      WHEN 'purchase' THEN 'purchase' END AS event_type,
    CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS item_id,
    value AS duration_seconds
  FROM events)"""

SQL_CATALOG = """catalog AS (
  SELECT item_id, category, base_price, discount_pct,
    base_price * (1e0 - discount_pct / 100e0) AS current_price
  FROM (SELECT p_partkey AS item_id, p_type AS category, p_retailprice AS base_price,
          CAST((p_size % 5) * 10 AS DOUBLE) AS discount_pct FROM part) p)"""


def sql_name(user: str, seq: str, kind: str = "session") -> str:
    return (
        f"CAST({user} AS VARCHAR) || '_{kind}_' || CASE WHEN {seq} < 10000"
        f" THEN lpad(CAST({seq} AS VARCHAR), 4, '0') ELSE CAST({seq} AS VARCHAR) END"
    )


def sql_sessions(gap: int = GAP) -> str:
    """``sess``: events with session number, id, start and end."""
    return f"""{SQL_CLICKS},
gaps AS (
  SELECT *, us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) AS gap_us
  FROM clickstream),
numbered AS (
  SELECT *, CAST(sum(CASE WHEN gap_us IS NULL OR gap_us > {gap * MINUTE_US} THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
    AS session_seq
  FROM gaps),
sess AS (
  SELECT event_id, user_id, us, event_type, item_id, duration_seconds, session_seq,
    {sql_name('user_id', 'session_seq')} AS session_id,
    min(us) OVER (PARTITION BY user_id, session_seq) AS session_start_us,
    max(us) OVER (PARTITION BY user_id, session_seq) AS session_end_us
  FROM numbered)"""


SQL_CALENDAR = """calendar AS (
  SELECT n_days, train_days, val_days, n_days - train_days - val_days AS test_days,
    (first_day + train_days) * 86400000000 AS train_end_us,
    (first_day + train_days + val_days) * 86400000000 AS val_end_us,
    (first_day + n_days) * 86400000000 AS test_end_us
  FROM (SELECT *, CAST(floor(n_days * 0.7e0) AS BIGINT) AS train_days,
          CAST(floor(n_days * 0.15e0) AS BIGINT) AS val_days
        FROM (SELECT min(us) // 86400000000 AS first_day,
                max(us) // 86400000000 - min(us) // 86400000000 + 1 AS n_days
              FROM clickstream) a) b)"""


def sql_events(gap: int = GAP, split: bool = False) -> str:
    """``ev``: sessionized events with a ``split`` column ('all' when not split)."""
    if not split:
        return f"{sql_sessions(gap)},\nev AS (SELECT *, 'all' AS split FROM sess)"
    return f"""{sql_sessions(gap)},
{SQL_CALENDAR},
named AS (
  SELECT sess.*, CASE WHEN session_start_us <= train_end_us THEN 'train'
    WHEN session_start_us <= val_end_us THEN 'val'
    WHEN session_start_us <= test_end_us THEN 'test' END AS split
  FROM sess, calendar),
ev AS (SELECT * FROM named WHERE split IS NOT NULL)"""


def sql_examples(gap: int = GAP, split: bool = False) -> str:
    """``examples``: candidates with label; ``sessions``: one row per session."""
    return f"""{sql_events(gap, split)},
sessions AS (
  SELECT split, user_id, session_seq, min(session_id) AS session_id, min(us) AS start_us,
    max(us) AS end_us, count(*) AS n_events,
    count(*) FILTER (WHERE event_type = 'view') AS n_views
  FROM ev GROUP BY split, user_id, session_seq),
placed AS (
  SELECT *, count(*) OVER (PARTITION BY split, user_id) AS n,
    row_number() OVER (PARTITION BY split, user_id ORDER BY session_seq) AS rn
  FROM sessions),
cand AS (
  SELECT DISTINCT e.split, e.user_id, e.item_id, e.session_seq, e.session_id, e.session_end_us
  FROM ev e JOIN placed p USING (split, user_id, session_seq)
  WHERE e.event_type = 'view' AND p.rn <= p.n - 3),
examples AS (
  SELECT c.*, CASE WHEN EXISTS (
      SELECT 1 FROM ev p WHERE p.split = c.split AND p.user_id = c.user_id
        AND p.item_id = c.item_id AND p.event_type = 'purchase'
        AND p.session_seq BETWEEN c.session_seq + 1 AND c.session_seq + 3)
    THEN 1 ELSE 0 END AS label
  FROM cand c)"""


def sql_scored() -> str:
    return f"""{sql_examples()},
scored AS (
  SELECT user_id, item_id, session_seq, session_id, label,
    ((item_id * 13 + session_seq * 7 + user_id * 3) % 101) / 101e0 AS score
  FROM examples)"""


def with_sql(parts: str, select: str) -> str:
    return f"WITH {parts}\n{select}"
