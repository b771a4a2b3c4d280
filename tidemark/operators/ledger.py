"""Transfers between accounts as a set operation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import running_total, sequence_block


def postings(transfers: DataFrame) -> DataFrame:
    """Two postings per transfer ``(seq, sender, receiver, amount)``: debit, then credit."""
    legs = F.array(
        F.struct(F.col("sender").alias("account"), (-F.col("amount")).alias("delta"), F.lit(0).alias("leg")),
        F.struct(F.col("receiver").alias("account"), F.col("amount").alias("delta"), F.lit(1).alias("leg")),
    )
    return transfers.select("seq", F.explode(legs).alias("p")).select("seq", "p.*")


def balances(transfers: DataFrame) -> DataFrame:
    """End balance, lowest running balance and first overdraft per account.

    ``seq`` is unique per transfer. A busy account is summed in blocks of the
    sequence, so none of its tasks sees more than one block.
    """
    running = running_total(
        postings(transfers), ["account"], [("_block", sequence_block("seq"))],
        ["seq", "leg"], F.col("delta"), "balance",
    )
    return running.groupBy("account").agg(
        F.count("*").alias("postings"),
        F.sum("delta").alias("end_balance"),
        F.min("balance").alias("lowest_balance"),
        F.min(F.when(F.col("balance") < 0, F.col("seq"))).alias("first_overdraft"),
    )
