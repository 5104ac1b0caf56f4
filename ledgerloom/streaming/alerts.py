"""Balance alerts as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..plans.bank import is_low, low_balance_message
from .keyed import with_previous


def low_balances(updates: DataFrame) -> DataFrame:
    """A message for every update below the limit; needs no state."""
    low = updates.where(is_low(F.col("balance")))
    return low.select("account_number", "ts", "balance", low_balance_message(F.col("account_number")).alias("message"))


def crossings(updates: DataFrame) -> DataFrame:
    """Updates with which a balance falls below the limit (``kind`` is ``crossing``), and updates that came ``late``.

    ``updates(account_number, ts, update_id, balance)`` are ordered by time and number; the state
    store keeps the last one of each account. One that comes after a later one has been compared is
    no alert: it is returned as ``late``, to be written to an output of its own.
    """
    rows = updates.select("account_number", "ts", "update_id", "balance")
    compared = with_previous(rows, "account_number", ["ts", "update_id"], "balance")
    fell = ~F.col("late") & is_low(F.col("balance"), F.col("before"), on_crossing_only=True)
    message = F.when(~F.col("late"), low_balance_message(F.col("account_number")))
    return compared.where(F.col("late") | fell).select("account_number", "ts", "update_id", "balance", message.alias("message"), F.when(F.col("late"), "late").otherwise("crossing").alias("kind"))
