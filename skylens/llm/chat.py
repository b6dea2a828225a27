"""Preference formatting of chosen and rejected conversations, in DataFrame functions only.

The longest common prefix of turns is the prompt, rendered once; what follows in either
conversation is its completion, of which only the assistant's words (and the mark that ends them)
are to be learned. Spans of those are given in code points of the completion.

Scale: one shuffle on the pair's id; a group is the turns of two conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Marks of the chat template.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
LEARNED_ROLE = "assistant"


def _turns(df: DataFrame, name: str) -> DataFrame:
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return (df.where("pair_id is not null").groupBy("pair_id").agg(F.array_sort(F.collect_set(turn)).alias("t"), F.min("conv_id").alias(f"{name}_id"))
            .select("pair_id", f"{name}_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias(name)))


def _rendered(turns: Column) -> Column:
    """Each turn under the template; marks inside texts and roles are broken by a zero-width space."""
    safe = lambda x: F.replace(x, F.lit(OPEN), F.lit("<​|"))
    return F.transform(turns, lambda t: F.concat(F.lit(OPEN), safe(t["role"]), F.lit(CLOSE), safe(t["text"]), F.lit(END)))


def _learned(turns: Column, rendered: Column) -> Column:
    """``start:end`` of the learned part of each assistant turn, comma-joined."""
    ends = F.transform(rendered, lambda x, i: F.length(F.array_join(F.slice(rendered, F.lit(1), i + 1), "")))
    spans = F.transform(F.arrays_zip(turns.alias("t"), rendered.alias("r"), ends.alias("e")), lambda x: F.when(
        x["t"]["role"] == LEARNED_ROLE,
        F.concat_ws(":", x["e"] - F.length(x["r"]) + F.length(F.lit(OPEN + LEARNED_ROLE + CLOSE)), x["e"])))
    return F.array_join(F.filter(spans, lambda s: s.isNotNull()), ",")


def preference_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row per pair_id of either side: pair_id, chosen_id, rejected_id, prompt_turns, prompt, chosen,
    rejected, chosen_learned, rejected_learned, status.

    Inputs have pair_id, conv_id, turn, role, text. Turns are ordered by turn (null first), role and
    text; exact repeats of a turn count once; null role and text count as empty. Rows without a
    pair_id belong to no conversation and are left out. status is ``pair``, ``equal`` (the whole is
    prompt, both completions are empty) or ``single`` (the other side is null, and nothing is
    common). Texts of any length are kept whole; other columns are ignored; empty tables give no rows.
    """
    both = _turns(chosen, "chosen").join(_turns(rejected, "rejected"), "pair_id", "full")
    least = F.least(F.size("chosen"), F.size("rejected"))
    same = F.zip_with(F.slice("chosen", F.lit(1), least), F.slice("rejected", F.lit(1), least), lambda x, y: x.eqNullSafe(y))
    first = F.array_position(same, False)
    common = F.when(F.col("chosen").isNull() | F.col("rejected").isNull(), F.lit(0)).when(first > 0, first - 1).otherwise(least).cast("int")
    both = both.withColumn("prompt_turns", common)
    rest = lambda c: F.slice(F.col(c), F.col("prompt_turns") + 1, F.size(c))
    prompt = F.slice(F.coalesce("chosen", "rejected"), F.lit(1), F.col("prompt_turns"))
    cut = both.select("pair_id", "chosen_id", "rejected_id", "prompt_turns", _rendered(prompt).alias("prompt"),
                      F.when(F.col("chosen_id").isNull() | F.col("rejected_id").isNull(), "single")
                      .when((F.col("prompt_turns") == F.size("chosen")) & (F.col("prompt_turns") == F.size("rejected")), "equal").otherwise("pair").alias("status"),
                      *[x for c in ("chosen", "rejected") for x in (rest(c).alias(c), _rendered(rest(c)).alias(f"{c}_text"))])
    return cut.select("pair_id", "chosen_id", "rejected_id", F.col("prompt_turns").cast("long").alias("prompt_turns"), F.array_join("prompt", "").alias("prompt"),
                      F.array_join("chosen_text", "").alias("chosen"), F.array_join("rejected_text", "").alias("rejected"),
                      _learned(F.col("chosen"), F.col("chosen_text")).alias("chosen_learned"),
                      _learned(F.col("rejected"), F.col("rejected_text")).alias("rejected_learned"), "status")


def neighbouring_pairs(conversations: DataFrame) -> DataFrame:
    """Pairs of a table without preferences: conversation 2k counts as chosen, 2k + 1 as rejected."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text").withColumn("pair_id", F.expr("floor(conv_id / 2)").cast("long"))
    return preference_pairs(rows.where("conv_id % 2 = 0"), rows.where("conv_id % 2 <> 0"))
