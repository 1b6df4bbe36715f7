"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

RANK = "_rank"


def best_per_key(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[str | Column],
    where: Column | None = None,
) -> DataFrame:
    """Best row of each key by ``order``; pass a unique column last for a fixed answer.

    Spark plans the rank filter as a partial group limit before the shuffle, so a task sends at most one
    row per key and a key with very many rows does not fill one task. ``where`` filters the winners: a
    winner it removes is not replaced by the next row of its key.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    chosen = F.col(RANK) == 1 if where is None else (F.col(RANK) == 1) & where
    return df.withColumn(RANK, rank).where(chosen).drop(RANK)


# Without a ``tie_break`` the remaining columns settle ties, so that a recomputed task picks the same row.


def dedupe_employments(cleaned: DataFrame, where: Column | None = None, tie_break: Sequence[str] = ()) -> DataFrame:
    """Per contact, occupation and start date: a current job first, then the newest row."""
    order = [F.desc("is_current"), F.desc("processing_date"), *(tie_break or cleaned.columns)]
    return best_per_key(cleaned, ["contact_id", "occupation", "start_date"], order, where)


def dedupe_phones(cleaned: DataFrame, where: Column | None = None, tie_break: Sequence[str] = ()) -> DataFrame:
    """Per contact and number: the newest row."""
    order = [F.desc("processing_date"), *(tie_break or cleaned.columns)]
    return best_per_key(cleaned, ["contact_id", "number"], order, where)


def latest_log_per_referral(logs: DataFrame) -> DataFrame:
    return best_per_key(logs, ["user_referral_id"], [F.desc("created_at"), "id"])


def latest_user_record(users: DataFrame) -> DataFrame:
    return best_per_key(users, ["user_id"], [F.desc("membership_expired_date"), "id"])


def latest_lead_record(leads: DataFrame) -> DataFrame:
    return best_per_key(leads, ["lead_id"], [F.desc("created_at"), "id"])


def last_value_lookup(df: DataFrame, key: str, value: str, order: Sequence[str | Column]) -> DataFrame:
    """Key and value of a lookup in which the last row of a repeated key wins.

    ``order`` lists the sort that puts the last row first.
    """
    return best_per_key(df, [key], order).select(key, value)
