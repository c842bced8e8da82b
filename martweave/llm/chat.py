"""Chat formatting: a dialogue rendered once from every participant's point of view.

For each participant of a conversation the whole dialogue is rendered with that participant as
`assistant` and all others as `user`s under their own names; system turns stay `system`.  What
the assistant says, with the mark that ends it, is learned from; everything else is masked.

The rendering is a table of its turns in order: `segment` is the rendered turn, `start` its
first character within the rendered dialogue (from 0), `learn_from` and `learn_to` the learned
characters within the dialogue (null where the turn is masked).  Joining the segments in order
gives the dialogue; no task ever holds a whole one, so its length is not bounded.  Turns are sorted
once, before they are rendered; their places come from running sums over blocks of the sorted
rows (`places.py`), so neither a null conversation nor many turns of one number are one task.
Only DataFrame functions are used.

Nulls and ties: a turn without role is said by a user named `unknown`, who is no participant to
learn from; a null text is empty; a null conversation is one conversation; turns of the same
number follow by role and text, null turns come first.  A conversation without participants has
no rendering.  Marks of the template inside a text are broken up, so no turn can fake another.
Columns other than the four named ones take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .places import in_order, running
from .store import forget, kept

SYSTEM = "system"
UNKNOWN = "unknown"
# the usual chat marks, with a name after the role
_BEGIN, _END = "<|im_start|>", "<|im_end|>"


def _unmarked(text: Column) -> Column:
    """The text with no mark left in it."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def rotated(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per turn and participant: the turn as it stands in that participant's rendering."""
    said = F.col(role)
    rows = turns.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.when(F.trim(said) != "", said).alias("speaker"),
        _unmarked(F.coalesce(F.col(text), F.lit(""))).alias("content"),
    )
    rows = in_order(rows, ["conv_id", "turn", "speaker", "content"], "turns")
    people = rows.where(F.col("speaker").isNotNull() & (F.col("speaker") != SYSTEM)).select(
        F.col("conv_id").alias("_conv"), F.col("speaker").alias("participant")
    ).distinct()
    both = rows.join(people, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    own = F.coalesce(F.col("speaker") == F.col("participant"), F.lit(False))
    as_role = F.when(F.col("speaker") == SYSTEM, SYSTEM).when(own, "assistant").otherwise("user")
    name = F.when(F.col("as_role") == "user", F.coalesce("speaker", F.lit(UNKNOWN)))
    named = F.coalesce(F.concat(F.lit(" name="), _unmarked(F.col("name"))), F.lit(""))
    head = F.concat(F.lit(_BEGIN), F.col("as_role"), named, F.lit("\n"))
    rendered = (
        both.withColumn("as_role", as_role)
        .withColumn("name", name)
        .withColumn("_head", F.length(head))
        .withColumn("segment", F.concat(head, F.col("content"), F.lit(f"{_END}\n")))
    )
    renderings = kept(rendered, "rendered")
    forget(rows)
    places = running(renderings, ["conv_id", "participant"], F.length("segment").cast("long"), "_stop")
    start = F.col("_stop") - F.length("segment")
    learned = F.col("as_role") == "assistant"
    return places.select(
        "conv_id",
        "participant",
        "turn",
        "as_role",
        "name",
        "segment",
        start.alias("start"),
        F.when(learned, start + F.col("_head")).alias("learn_from"),
        # the end mark is learned, the line break after it is not
        F.when(learned, F.col("_stop") - 1).alias("learn_to"),
    )
