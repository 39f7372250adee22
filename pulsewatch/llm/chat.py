"""Chat formatting by perspective rotation, in DataFrame functions only.

For every participant of a dialogue, the dialogue is rendered with that speaker as assistant and
the others as named users; system turns stay system turns for all. The mask lists the code points
to train on: what the speaker of the perspective says, with the end marker.

Each dialogue is one row for every participant, however long one is silent; the row, and so the task
that makes it, holds the dialogue whatever its length. What moves is a dialogue's turns once; they are
copied for the participants after that.

Edge cases: equal rows of a dialogue are one turn, but each row without a number is a turn of its own; turns with one number are ordered by role, then text; a null turn number comes before all
others; a null or empty role is "unknown"; a null text is empty; each row without conv_id, also an
equal one, is a dialogue of its own; dialogues in
which only the system speaks give no row, and an empty table none; very long texts and dialogues are
rendered whole; other columns of the turns are not read. Markers in texts or names are broken up by a blank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsewatch.llm.pii import running

END = "<|end|>\n"


def plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def head(role: Column, speaker: Column) -> Column:
    return (
        F.when(role == "system", F.lit("<|system|>\n"))
        .when(role == speaker, F.lit("<|assistant|>\n"))
        .otherwise(F.concat(F.lit("<|user name="), role, F.lit("|>\n")))
    )


def rotated(turns: DataFrame) -> DataFrame:
    """conv_id, speaker, text, mask (array of start, end), n_turns, n_trained: a row for each participant of a dialogue."""
    role = F.when(F.coalesce("role", F.lit("")) == "", F.lit("unknown")).otherwise(plain(F.col("role")))
    said = turns.select("conv_id", F.struct("turn", role.alias("role"), plain(F.coalesce("text", F.lit(""))).alias("text")).alias("said"))
    numbered = F.when(F.col("said")["turn"].isNotNull(), F.col("said"))
    other = F.when(F.col("said")["turn"].isNull(), F.col("said"))
    # a number tells that equal rows are one turn; without one each row is a turn
    held = (
        said.where("conv_id is not null")
        .groupBy("conv_id")
        .agg(F.concat(F.sort_array(F.collect_list(other)), F.sort_array(F.collect_set(numbered))).alias("said"))
    )
    lone = said.where("conv_id is null").select("conv_id", F.array("said").alias("said"))
    return _rendered(held.unionByName(lone), "conv_id")


def _rendered(held: DataFrame, *keys: str) -> DataFrame:
    """A rendering of ``said``, the turns in order, for everybody who speaks in it."""
    speakers = F.array_distinct(F.filter(F.transform("said", lambda s: s["role"]), lambda r: r != "system"))
    each = held.select(*keys, "said", F.explode(speakers).alias("speaker"))
    speaker = F.col("speaker")
    each = each.withColumn("heads", F.transform("said", lambda s: head(s["role"], speaker)))
    bodies = F.transform("said", lambda s: F.concat(s["text"], F.lit(END)))
    each = each.withColumn("bodies", bodies)
    widths = F.zip_with("heads", "bodies", lambda h, b: (F.length(h) + F.length(b)).cast("long"))
    each = each.withColumn("at", running(widths))

    def span(s: Column, i: Column) -> Column:
        start = F.get("at", i) + F.length(F.get("heads", i))
        return F.struct(
            (s["role"] == speaker).alias("own"), start.alias("start"), (start + F.length(F.get("bodies", i))).alias("end")
        )

    trained = F.filter(F.transform("said", span), lambda x: x["own"])
    return each.select(
        *keys,
        "speaker",
        F.array_join(F.zip_with("heads", "bodies", lambda h, b: F.concat(h, b)), "").alias("text"),
        F.transform(trained, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("mask"),
        F.size("said").cast("long").alias("n_turns"),
        F.size(trained).cast("long").alias("n_trained"),
    )
