"""Chat formatting by perspective rotation.

Every participant of a dialogue gets a rendering of the whole dialogue in
which that speaker is the assistant and all others are named users.  Loss
spans cover what the assistant says and nothing else.

A dialogue is rendered in parts of at most ``turns_per_part`` turn numbers,
and a part of more than ``rows_per_piece`` rows (turns without a number, or
many of one number) in pieces of so many, so a dialogue of any length is
spread over tasks; its participants are found over the whole dialogue.
DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Name shown for a turn without a speaker.
NOBODY = "unknown"


def _clean(text: Column) -> Column:
    """Text that can't hold a control marker: ``<|`` is written ``< |``."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _head(speaker: Column, perspective: Column, context: Sequence[str]) -> Column:
    name = _clean(F.coalesce(speaker, F.lit(NOBODY)))
    return (F.when(speaker.isin(*context), F.concat(F.lit(OPEN), name, F.lit("\n")))
             .when(speaker == perspective, F.lit(f"{OPEN}assistant\n"))
             .otherwise(F.concat(F.lit(f"{OPEN}user name="), name, F.lit("\n"))))


def _mark(speaker: Column, said: Column) -> Column:
    """What orders the rows of one turn number: a hash, so that its prefixes cut them evenly."""
    return F.md5(F.concat(F.coalesce(F.concat(F.lit("+"), speaker), F.lit("-")), F.lit("\n"),
                          F.coalesce(F.concat(F.lit("+"), said), F.lit("-"))))


def _same(pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality of the named columns."""
    out = F.lit(True)
    for a, b in pairs:
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def _pieces(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` of crowded parts with ``piece`` (rank in the part div ``limit``) and ``copies``; equal rows of a piece are one.

    Equal rows are counted before they are shuffled.  Ranks are offsets of
    (turn, hash prefix) buckets plus places in a bucket, so no part is
    sorted in one task.
    """
    group = ["conv_id", "part", "turn", "bucket"]
    counted = (rows.groupBy("conv_id", "part", "turn", "speaker", "said", "mark").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("bucket", F.substring("mark", 1, 3)))
    # a part has at most turns_per_part * 4096 buckets
    before = Window.partitionBy("conv_id", "part").orderBy("turn", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counted.groupBy(*group).agg(F.sum("n").alias("n"))
               .select(*[F.col(c).alias(f"o_{c}") for c in group], F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off")))
    inside = Window.partitionBy(*group).orderBy("mark", "speaker", "said").rowsBetween(Window.unboundedPreceding, 0)
    placed = (counted.withColumn("upto", F.sum("n").over(inside)).join(offsets, _same([(c, f"o_{c}") for c in group]))
              .select("conv_id", "part", "turn", "speaker", "said", "mark",
                      (F.col("off") + F.col("upto") - F.col("n")).alias("lo"), (F.col("off") + F.col("upto")).alias("hi")))
    cut = placed.withColumn("piece", F.explode(F.sequence(F.expr(f"lo div {limit}"), F.expr(f"(hi - 1) div {limit}"))))
    copies = F.least("hi", (F.col("piece") + 1) * limit) - F.greatest("lo", F.col("piece") * limit)
    return cut.withColumn("copies", copies.cast("int")).drop("lo", "hi")


def rotate(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", speaker: str = "role",
           text: str = "text", context: Sequence[str] = ("system",), turns_per_part: int = 256,
           rows_per_piece: int = 256) -> DataFrame:
    """One row per dialogue, participant, part and piece.

    Columns: ``conv_id``, ``perspective`` (the participant who is the
    assistant), ``part`` (turn number div ``turns_per_part``), ``piece``
    (the row's rank in the part div ``rows_per_piece``), ``n_turns``,
    ``text`` and ``segments``, an array of ``(turn, speaker, start, end,
    loss)`` with the content's character offsets in ``text``.

    Speakers in ``context`` keep their role and have no perspective.  A turn
    without a speaker is shown as a user named ``unknown`` and gives no
    perspective; a dialogue without participants gives no row.  Null text is
    empty.  Turns without a number follow in one part whose ``part`` is
    null.  A null dialogue id is a dialogue of its own.  Turns with equal
    numbers are ordered by a hash of speaker and text; repeated rows are all
    shown.
    Other columns are ignored; an empty table gives no rows.
    """
    rows = turns.select(F.col(conversation).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                        F.col(speaker).cast("string").alias("speaker"), F.col(text).cast("string").alias("said"))
    rows = rows.withColumn("part", F.floor(F.col("turn") / turns_per_part).cast("long"))
    rows = rows.withColumn("mark", _mark(F.col("speaker"), F.col("said")))
    taking_part = F.col("speaker").isNotNull() & ~F.col("speaker").isin(*context)
    who = rows.filter(taking_part).select(F.col("conv_id").alias("w_conv"), F.col("speaker").alias("perspective")).distinct()
    sizes = rows.groupBy(F.col("conv_id").alias("s_conv"), F.col("part").alias("s_part")).agg(F.count(F.lit(1)).alias("n"))
    # ids only: (dialogue, part, piece) x participant
    wanted = (sizes.select("s_conv", "s_part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {rows_per_piece}"))).alias("s_piece"))
              .join(who, _same([("s_conv", "w_conv")])).select("s_conv", "s_part", "s_piece", "perspective"))
    crowded, there = sizes.filter(F.col("n") > rows_per_piece), _same([("conv_id", "s_conv"), ("part", "s_part")])
    few = rows.join(crowded, there, "left_anti").withColumns({"piece": F.lit(0).cast("long"), "copies": F.lit(1)})
    rows = few.unionByName(_pieces(rows.join(crowded, there, "left_semi"), rows_per_piece))

    order = F.struct(F.coalesce("turn", F.lit(0)).alias("t"), F.col("mark"), F.col("speaker").isNull().alias("a"),
                     F.coalesce("speaker", F.lit("")).alias("b"), F.col("said").isNull().alias("c"),
                     F.coalesce("said", F.lit("")).alias("d"), F.col("turn").alias("turn"), F.col("copies"))
    blocks = rows.groupBy("conv_id", "part", "piece").agg(F.array_sort(F.collect_list(order)).alias("turns"))
    blocks = blocks.withColumn("turns", F.flatten(F.transform("turns", lambda t: F.array_repeat(t, t["copies"]))))
    joined = blocks.join(wanted, _same([("conv_id", "s_conv"), ("part", "s_part"), ("piece", "s_piece")]))

    person = lambda t: F.when(~t["a"], t["b"])
    shown = F.transform("turns", lambda t: F.struct(
        t["turn"].alias("turn"), person(t).alias("speaker"),
        _head(person(t), F.col("perspective"), context).alias("head"), _clean(t["d"]).alias("body"),
        F.coalesce(person(t) == F.col("perspective"), F.lit(False)).alias("loss")))
    tail = f"{CLOSE}\n"
    whole = lambda t: F.length(t["head"]) + F.length(t["body"]) + F.lit(len(tail))
    out = joined.select("conv_id", "perspective", "part", "piece", shown.alias("shown"))
    out = out.withColumn("sizes", F.transform("shown", whole))
    out = out.withColumn("starts", F.transform("sizes", lambda _, i: F.aggregate(
        F.slice("sizes", F.lit(1), i), F.lit(0), lambda a, b: a + b)))
    segments = F.transform(F.arrays_zip("shown", "starts"), lambda z: F.struct(
        z["shown"]["turn"].alias("turn"), z["shown"]["speaker"].alias("speaker"),
        (z["starts"] + F.length(z["shown"]["head"])).alias("start"),
        (z["starts"] + F.length(z["shown"]["head"]) + F.length(z["shown"]["body"])).alias("end"),
        z["shown"]["loss"].alias("loss")))
    rendered = F.array_join(F.transform("shown", lambda t: F.concat(t["head"], t["body"], F.lit(tail))), "")
    return out.select("conv_id", "perspective", "part", "piece", F.size("shown").cast("long").alias("n_turns"),
                      rendered.alias("text"), segments.alias("segments"))
