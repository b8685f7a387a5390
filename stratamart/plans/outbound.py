"""Outbound transaction analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.clock import RunClock
from stratamart.functions.text import text_profile
from stratamart.operators.predicates import of_run_day
from stratamart.operators.ranking import rank_within
from stratamart.operators.skew import HotKeys, find_hot_keys
from stratamart.sinks.files import export_csv

# The report's search word, letter and pad width.
SEARCH_WORD, SEARCH_LETTER, PAD_WIDTH, NTH = "Outdoor", "R", 30, 3


def transaction_report(pos: DataFrame, clock: RunClock, hot: HotKeys | None = None, ranges: int | None = None) -> DataFrame:
    """Category text views and amount ranking per customer, for the run day's rows."""
    today = of_run_day(pos, clock)
    if hot is None:
        hot = find_hot_keys(today, "custno")
    # Rank narrow rows; the text views are derived after the shuffle.
    ranked = rank_within(today.select("custno", "txnno", "category", "amount"), "custno", "amount", "txnno", NTH, hot=hot, ranges=ranges)
    views = text_profile(F.col("category"), SEARCH_WORD, SEARCH_LETTER, PAD_WIDTH)
    return ranked.select(
        "custno", "txnno",
        views["has_token"].alias("outdoor_cat"),
        "category",
        views["position"].alias("strpos_cat"),
        views["padded"].alias("rpad_cat"),
        views["reversed"].alias("rev_cat"),
        views["n_chars"].alias("len_cat"),
        "amount",
        "rownum_amt", "rnk_amt", "densernk_amt", "cumedist_amt",
        "first_trans_amt", "third_highest_trans", "next_trans", "prev_trans",
    )


def export_report(pos: DataFrame, clock: RunClock, path: str, hot: HotKeys | None = None) -> str:
    """Write the report as sharded CSV with a header."""
    return export_csv(transaction_report(pos, clock, hot), path)
