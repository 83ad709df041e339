"""Transfers between accounts: a batch is applied as a whole or not at all."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F


class Posted(NamedTuple):
    state: DataFrame
    reasons: DataFrame
    log: DataFrame


def post_batch(accounts: DataFrame, transfers: DataFrame, batch_id: str, as_of: Column) -> Posted:
    """Post ``transfers`` (from_id, to_id, amount) to ``accounts`` (account_id, balance).

    The batch is refused when an account would end below zero or is unknown; the
    state is then the old one, ``reasons`` names the accounts, and the log is
    empty. The check is on the balance after the whole batch: inside it an
    account may pass through a negative amount.
    """
    amount_type = dict(accounts.dtypes)["balance"]
    debits = transfers.select(F.col("from_id").alias("account_id"), (-F.col("amount")).alias("change"))
    credits = transfers.select(F.col("to_id").alias("account_id"), F.col("amount").alias("change"))
    changes = debits.unionByName(credits).groupBy("account_id").agg(F.sum("change").alias("change"))

    joined = accounts.join(changes, "account_id", "left").withColumn(
        "_after", (F.col("balance") + F.coalesce("change", F.lit(0))).cast(amount_type)
    )
    overdrawn = joined.where((F.col("change") < 0) & (F.col("_after") < 0)).select(
        "account_id", F.lit("insufficient balance").alias("reason"), F.col("_after").alias("balance_after")
    )
    unknown = changes.join(accounts, "account_id", "left_anti").select(
        "account_id",
        F.lit("unknown account").alias("reason"),
        F.lit(None).cast(amount_type).alias("balance_after"),
    )
    reasons = overdrawn.unionByName(unknown)
    accepted = reasons.agg(F.count(F.lit(1)) == 0).scalar()
    state = joined.select(
        *[
            F.when(accepted, F.col("_after")).otherwise(F.col("balance")).alias("balance") if c == "balance" else F.col(c)
            for c in accounts.columns
        ]
    )
    log = (
        transfers.agg(F.count(F.lit(1)).alias("n_transfers"), F.sum("amount").alias("amount"))
        .where(accepted)
        .select(F.lit(batch_id).alias("batch_id"), "n_transfers", "amount", as_of.alias("posted_at"))
    )
    return Posted(state, reasons, log)
