"""Mixing sources to target weights by a low-discrepancy schedule.

Every slot of the schedule takes one block of equally many words from one source.
Slot ``i`` maps the van der Corput point ``reversed bits of i / 2^k`` through the cumulative targets,
so any stretch of the mix holds the sources in nearly their target proportions, and all ``2^k`` slots
together, whose points are an even grid, give each source its target to less than one block.
Points behind the last target belong to no source; those slots are left out.

A source takes the blocks of its slots and nothing else.  Its documents are laid in hash order on a line; its slot
of rank ``r`` takes words ``[r * block, (r + 1) * block)`` of that line, which repeats
for as many epochs as the cap allows.

Sources: one row per source passes through one task and the driver (their number is
taken to be bounded, some 10^5 at most).  Documents, slots and blocks never do: a
source with a third of all rows is cut into hash bins whose sums are added up.

Null text counts 0 words and is never taken, null source is a source of its own
(last in order), repeated rows are rows of their own, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinary.sources.scratch import materialize

WORD = r"[^\x20\x09-\x0D]+"
BIN_BITS = 12  # hash bins of a source
_CHUNK = 1 << 16  # slots made at once


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """(number, source, source_size, target) per source.

    The words of all sources are shared by weight; no target passes ``cap`` times its
    source's size, and what it would have more goes to the others by weight.  Sources in
    order of size by weight are capped from the front, so running sums give the rest's share.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = per_source.withColumn("number", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("number") % len(weights) + 1)
    bounded = numbered.withColumns({"weight": weight, "most": F.col("source_size") * float(cap)})
    by_cap = Window.orderBy(F.col("most") / F.col("weight"), "number")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    level = (total - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    capped = bounded.withColumn("is_capped", F.col("most") <= F.col("weight") * level)
    # the first source below its cap fixes the level of all that follow
    shared = F.first(F.when(~F.col("is_capped"), level), ignorenulls=True).over(
        by_cap.rowsBetween(Window.unboundedPreceding, 0)
    )
    leveled = capped.withColumn("shared", shared)
    target = F.when(F.col("shared").isNull(), F.col("most")).otherwise(F.col("weight") * F.col("shared"))
    return leveled.select("number", "source", "source_size", target.alias("target"))


def van_der_corput(slot: np.ndarray, bits: int) -> np.ndarray:
    """The slots' ``bits`` low bits in reverse, as a fraction."""
    left, point = slot.astype(np.uint64), np.zeros(len(slot), dtype=np.uint64)
    for _ in range(bits):
        point = (point << np.uint64(1)) | (left & np.uint64(1))
        left = left >> np.uint64(1)
    return point / float(1 << bits)


def schedule(spark, targets: Sequence[float], block_words: int) -> DataFrame:
    """(slot, number, rank): the source of every slot and how many slots it had before."""
    edges = np.cumsum(np.asarray(targets, dtype=float))
    bits = max(0, ceil(log2(max(1.0, edges[-1] / block_words))))
    edges /= block_words * float(1 << bits)

    def deal(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in chunks:
            for chunk in frame["id"]:
                slot = np.arange(chunk * _CHUNK, min((chunk + 1) * _CHUNK, 1 << bits), dtype=np.int64)
                number = np.searchsorted(edges, van_der_corput(slot, bits), side="right")
                slot, number = slot[number < len(edges)], number[number < len(edges)]
                rank = pd.Series(number).groupby(number).cumcount().to_numpy()
                yield pd.DataFrame({"chunk": chunk, "slot": slot, "number": number.astype(np.int32), "local": rank})

    chunks = -(-(1 << bits) // _CHUNK)
    parts = min(chunks, max(1, spark.sparkContext.defaultParallelism)) if chunks < 10_000 else chunks // 64
    dealt = spark.range(0, chunks, 1, parts).mapInPandas(deal, "chunk bigint, slot bigint, number int, local bigint")
    # written, so that the planner knows its size: from a few chunks it would expect a few rows and broadcast them
    dealt = materialize(dealt, "mix-slots")
    counts = dealt.groupBy("number", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("number").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("number", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return dealt.join(offsets, ["number", "chunk"]).select("slot", "number", (F.col("offset") + F.col("local")).alias("rank"))


@dataclass(frozen=True)
class Mix:
    """What ``mix`` returns.

    ``placed``: the given rows with number, source_size, target and start (their place on
    the source's line).  ``pieces``: (slot, number, start, epoch, words) for every stretch
    of a document that a slot takes; (number, start) names the document.
    """

    placed: DataFrame
    pieces: DataFrame


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    cap: int = 3,
    block_words: int = 64,
    seed: int = 7,
    carry: Sequence[str] = ("doc_id",),
) -> Mix:
    """Deal the documents' words into slots; ``carry`` names the columns to keep in ``placed``."""
    spark = docs.sparkSession
    order = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    kept = F.struct(*[F.col(f"`{name}`") for name in carry]).alias("kept")
    sized = docs.select("source", word_count(F.col("text")).alias("size"), order.alias("place"), kept)
    targets = materialize(source_targets(sized, weights, cap), "mix-targets").orderBy("number").collect()
    columns = "number int, source string, source_size bigint, target double"
    table = spark.createDataFrame([tuple(row) for row in targets], columns)

    slim = sized.withColumn("bin", F.shiftrightunsigned("place", 64 - BIN_BITS).cast("int"))
    sums = slim.groupBy("source", "bin").agg(F.sum("size").alias("words"))
    lower = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("of"), F.col("bin").alias("in_bin"), F.coalesce(F.sum("words").over(lower), F.lit(0)).alias("from")
    )
    # one document never exceeds cap times its size, so a line repeats cap times at most
    inside = Window.partitionBy("source", "bin").orderBy("place", "size", "kept").rowsBetween(Window.unboundedPreceding, -1)
    running = slim.withColumn("above", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = running.join(starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("bin") == F.col("in_bin")))
    placed = (
        joined.drop("of", "in_bin")
        .join(F.broadcast(table.withColumnRenamed("source", "of")), F.col("source").eqNullSafe(F.col("of")))
        .select("number", "source", "size", "source_size", "target", (F.col("from") + F.col("above")).alias("start"), "kept")
    )
    placed = materialize(placed, "mix-placed")

    if not sum(row.target for row in targets):
        return Mix(placed, spark.createDataFrame([], "slot bigint, number int, start bigint, epoch int, words bigint"))
    seats = materialize(schedule(spark, [row.target for row in targets], block_words), "mix-seats")

    epochs = F.explode(F.sequence(F.lit(0), F.lit(cap - 1))).alias("epoch")
    copies = placed.filter("size > 0").select("number", "start", "size", "target", "source_size", epochs)
    low = F.col("epoch") * F.col("source_size") + F.col("start")
    spans = copies.select("number", "start", "epoch", low.alias("low"), (low + F.col("size")).alias("high"), "target")
    # a source's slots end less than a block behind its target: copies beyond have none, and need not look for one
    spans = spans.filter(F.col("low") < F.col("target") + block_words)
    touched = F.sequence(F.floor(F.col("low") / block_words), F.floor((F.col("high") - 1) / block_words))
    parts = spans.select("*", F.explode(touched).alias("rank"))
    words = F.least(F.col("high"), (F.col("rank") + 1) * block_words) - F.greatest(F.col("low"), F.col("rank") * block_words)
    pieces = parts.join(seats, ["number", "rank"])
    return Mix(placed, pieces.select("slot", "number", "start", "epoch", words.alias("words")))


def taken_words(mixed: Mix) -> DataFrame:
    """``placed`` with the words that the mix takes of every document, repeats counted, and the first slot that takes any."""
    pieces = mixed.pieces.groupBy(F.col("number").alias("n"), F.col("start").alias("s"))
    sums = pieces.agg(F.sum("words").alias("got"), F.min("slot").alias("slot"))
    # documents without words share their start with the next one
    same = (F.col("number") == F.col("n")) & (F.col("start") == F.col("s")) & (F.col("size") > 0)
    return mixed.placed.join(sums, same, "left").withColumn("taken", F.coalesce("got", F.lit(0)).cast("bigint")).drop("n", "s", "got")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, whole: one copy per epoch in which the mix takes at least half of the words."""
    mixed = mix(docs, carry=docs.columns, **options)
    by_epoch = mixed.pieces.groupBy(F.col("number").alias("n"), F.col("start").alias("s"), "epoch").agg(F.sum("words").alias("got"))
    same = (F.col("number") == F.col("n")) & (F.col("start") == F.col("s")) & (F.col("size") > 0)
    copies = mixed.placed.join(by_epoch, same).filter(F.col("got") * 2 >= F.col("size"))
    return copies.select("kept.*")
