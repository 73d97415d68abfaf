"""Chat histories: the last pairs, and a rolling summary of what went before."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROLES = ["user", "assistant"]
BLANKS = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]+"  # all that str.split() takes for blank


def usable_turns(turns: DataFrame) -> DataFrame:
    """Turns of users and assistants with text; other roles and blank texts are dropped."""
    return turns.where(F.lower("role").isin(ROLES) & (F.trim(F.coalesce("text", F.lit(""))) != ""))


def recent_pairs(turns: DataFrame, pairs: int = 5) -> DataFrame:
    """The last ``2 * pairs`` usable turns of each conversation, in order."""
    w = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    return usable_turns(turns).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= 2 * pairs).drop("_r")


def complete_pairs(turns: DataFrame) -> DataFrame:
    """Number of user turns that an assistant answers next, per conversation."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = usable_turns(turns).withColumn("_next", F.lead("role").over(w))
    return t.groupBy("conv_id").agg(F.count_if((F.col("role") == "user") & (F.col("_next") == "assistant")).alias("pairs"))


def compact(turns: DataFrame, pairs: int = 5, max_chars: int = 4_000, summary_chars: int = 1_200) -> DataFrame:
    """``(conv_id, summary, kept_turns, kept_chars)``: more pairs than allowed, or more characters, fold the oldest into a
    rolling summary. A fold with state, hence Python per conversation; turns are bounded first by the characters of those after
    them: one that is folded for sure goes only where later ones of this kind fill ``summary_chars``."""
    back = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    on = back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    users, chars = F.sum((F.col("role") == "user").cast("long")).over(on), F.sum(F.length("text").cast("long")).over(on)
    shown = F.length("role") + 3 + F.length(F.regexp_replace("text", BLANKS, ""))  # in the summary, at least
    t = usable_turns(turns).select("conv_id", "turn", "role", "text").withColumn("_folded", (users > pairs) | (chars > max_chars))
    later = F.sum(F.when(F.col("_folded"), shown).otherwise(0).cast("long")).over(back.rowsBetween(Window.unboundedPreceding, -1))
    bounded = t.withColumn("_later", F.coalesce(later, F.lit(0))).where(F.col("_later") <= summary_chars).drop("_folded", "_later")

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        kept = list(rows.sort_values("turn")[["role", "text"]].itertuples(index=False, name=None))
        summary: list[str] = []

        def oldest() -> list[tuple[str, str]]:
            n = 2 if len(kept) > 1 and kept[0][0] == "user" and kept[1][0] == "assistant" else 1
            out = kept[:n]
            del kept[:n]
            return out

        while sum(r == "user" for r, _ in kept) > pairs or sum(len(t) for _, t in kept) > max_chars:
            summary += [f"{r}: {' '.join(t.split())}" for r, t in oldest()]
            if not kept:
                break
        text = "\n".join(summary)[-summary_chars:]
        return pd.DataFrame({"conv_id": [rows["conv_id"].iloc[0]], "summary": [text], "kept_turns": [len(kept)], "kept_chars": [sum(len(t) for _, t in kept)]})

    return bounded.groupBy("conv_id").applyInPandas(fold, "conv_id long, summary string, kept_turns int, kept_chars int")
