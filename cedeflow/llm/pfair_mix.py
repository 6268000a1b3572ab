"""Mixing sources to target weights by Pfair scheduling of their blocks.

Everything is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cedeflow.llm.storage import written

#: Documents of one source in a block.
BLOCK_DOCS = 16
#: Blocks of all sources in a round; a source's weight is a whole number of them.
ROUND_BLOCKS = 512
#: Documents of all sources in a hash range; each range is numbered apart.
RANGE_DOCS = 8192


def _key(source: Column) -> Column:
    """A source as a string that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def tempered_shares(
    counts: DataFrame, power: float = 0.5, round_blocks: int = ROUND_BLOCKS
) -> DataFrame:
    """``key, share`` from ``key, n``: weights from sizes, small sources raised.

    A source of n documents weighs ``n ** power``; its share is that in whole
    blocks of a round, rounded, and one at least.
    """
    weighed = counts.withColumn("w", F.pow(F.col("n"), power))
    total = F.sum("w").over(Window.partitionBy(F.lit(0)))
    share = F.round(round_blocks * F.col("w") / total).cast("long")
    return weighed.select("key", F.greatest(F.lit(1), share).alias("share"))


def _numbered(rows: DataFrame, sources: DataFrame, range_docs: int) -> DataFrame:
    """``row, key, nth`` from ``row, key, h, tie``: each row's place in its source,
    with the other columns of ``sources``.

    Hash ranges of a bounded number of rows are numbered apart and then offset
    by the source's rows before, so a hot source is spread over its ranges. What
    is known of a source comes with its ranges too, not by a join on the source.
    """
    bits = max(0, rows.count() // range_docs).bit_length()
    ranged = rows.withColumn("range", F.shiftright("h", 64 - bits) if bits else F.lit(0).cast("long"))
    sizes = ranged.groupBy("key", "range").agg(F.count(F.lit(1)).alias("k"))
    upto = F.sum("k").over(Window.partitionBy("key").orderBy("range"))
    starts = sizes.select("key", "range", (upto - F.col("k")).alias("before")).join(sources, "key")
    within = F.row_number().over(Window.partitionBy("key", "range").orderBy("h", "tie"))
    return (
        ranged.withColumn("within", within)
        .join(starts, ["key", "range"])
        .withColumn("nth", F.col("before") + F.col("within") - 1)
        .drop("h", "tie", "range", "within", "before")
    )


def _round_order(counts: Column) -> Column:
    """Source indexes of one round's slots, from the blocks of each source in it.

    Block ``i`` of a source with ``c`` of the round's ``C`` blocks is released at
    slot ``floor(i C / c)`` and due by ``ceil((i + 1) C / c)``. Every slot takes
    the released block that is due first. As the blocks fill the round, each one
    meets its window, so a source is never a whole block ahead or behind.
    """
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, c: a + c)

    def fill(size: Column) -> Column:
        def slot(state: Column, t: Column) -> Column:
            def due(c: Column, s: Column) -> Column:
                done = F.get(state["done"], s)
                released = F.floor(done * size / c) <= t
                last = F.ceil((done + 1) * size / c)
                return F.when(
                    (done < c) & released, F.struct(last.alias("last"), s.alias("source"))
                )

            def taken(first: Column) -> Column:
                done = F.transform(
                    state["done"],
                    lambda d, s: d + F.when(s == first["source"], F.lit(1).cast("long")).otherwise(0),
                )
                return F.struct(
                    done.alias("done"), F.array_append(state["order"], first["source"]).alias("order")
                )

            first = F.array_min(F.transform(counts, due))
            return F.transform(F.array(first), taken)[0]

        start = F.struct(
            F.transform(counts, lambda c: F.lit(0).cast("long")).alias("done"),
            F.array().cast("array<int>").alias("order"),
        )
        slots = F.sequence(F.lit(0).cast("long"), size - 1)
        return F.aggregate(slots, start, slot, lambda state: state["order"])

    return F.transform(F.array(total), fill)[0]


def schedule(sources: DataFrame) -> DataFrame:
    """``key, at, nth_in_round, first_round, first_slot, size, slot``.

    ``sources`` has ``key, share, blocks``. A round takes ``share`` blocks of
    every source, or what a source has left. Rounds are equal until a source
    ends, so they have at most two forms for each source, and one more; each
    form is scheduled once (``at``) and holds from ``first_round`` on. The table
    has as many rows as those forms have slots and does not grow with the
    documents; its lists hold one entry for each source.
    """
    whole = F.floor(F.col("blocks") / F.col("share"))
    entry = F.struct(
        "key", "share", whole.alias("whole"), (F.col("blocks") % F.col("share")).alias("rest")
    )
    all_sources = sources.agg(F.array_sort(F.collect_list(entry)).alias("sources")).select(
        "sources",
        F.array_sort(
            F.array_distinct(
                F.flatten(
                    F.concat(
                        F.array(F.array(F.lit(0).cast("long"))),
                        F.transform("sources", lambda s: F.array(s["whole"], s["whole"] + 1)),
                    )
                )
            )
        ).alias("points"),
    )

    def counts_at(first: Column) -> Column:
        return F.transform(
            "sources",
            lambda s: F.when(first < s["whole"], s["share"])
            .when(first == s["whole"], s["rest"])
            .otherwise(F.lit(0).cast("long")),
        )

    forms = all_sources.select(
        "sources", "points", F.posexplode("points").alias("at", "first_round")
    ).select(
        "*",
        counts_at(F.col("first_round")).alias("counts"),
        F.coalesce(F.get("points", F.col("at") + 1) - F.col("first_round"), F.lit(1)).alias("rounds"),
    )
    sized = written(
        forms.withColumn("size", F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c))
        .filter("size > 0")
        .repartition("at")
    )
    upto = F.sum(F.col("size") * F.col("rounds")).over(
        Window.partitionBy(F.lit(0)).orderBy("first_round")
    )
    ordered = (
        sized.withColumn("first_slot", upto - F.col("size") * F.col("rounds"))
        .repartition("at")
        .withColumn("order", _round_order(F.col("counts")))
    )
    slots = ordered.select(
        "sources", "points", "at", "first_round", "first_slot", "size",
        F.posexplode("order").alias("slot", "s"),
    )
    nth = F.row_number().over(Window.partitionBy("at", "s").orderBy("slot")) - 1
    return slots.select(
        F.get("sources", F.col("s"))["key"].alias("key"),
        "at",
        nth.alias("nth_in_round"),
        "first_round",
        "first_slot",
        "size",
        "slot",
    )


def mixed(
    docs: DataFrame,
    shares: DataFrame | None = None,
    block_docs: int = BLOCK_DOCS,
    range_docs: int = RANGE_DOCS,
    seed: str = "mix",
) -> DataFrame:
    """``row, block, slot, position`` of every row of ``docs``, as struct ``row``.

    Sorted by ``position``, the sources are interleaved so that after any number
    of slots each one has less than one block more or less than its target. A
    source's documents come in the order of a hash of their ids, in blocks of
    ``block_docs``; its last block may be smaller. Once a source ends, the rest
    keep their proportions. All rows stay, once.

    ``shares`` has ``key`` (``=`` and the source, or the empty string for a null
    one) and ``share``, blocks in a round; a source it lacks, or has without a
    positive share, gets one. Without ``shares`` they follow the sources' sizes,
    tempered. Null ids are ordered like any other, rows that repeat an id by
    their other columns, and equal rows are interchangeable. An empty table
    gives an empty one. Names of further columns can't clash.
    """
    rows = docs.select(
        F.struct("*").alias("row"),
        _key(F.col("source")).alias("key"),
        F.xxhash64(F.lit(seed), F.col("doc_id")).alias("h"),
        F.xxhash64(*docs.columns).alias("tie"),
    )
    counts = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    given = tempered_shares(counts) if shares is None else shares
    share = F.when(F.col("share") > 0, F.col("share").cast("long")).otherwise(1)
    sources = written(
        counts.join(given, "key", "left").select(
            "key", share.alias("share"), F.ceil(F.col("n") / block_docs).alias("blocks")
        )
    )
    slots = written(schedule(sources))
    firsts = slots.groupBy("key").agg(
        F.array_sort(F.collect_set(F.struct("first_round", "at"))).alias("forms")
    )
    placed = (
        _numbered(rows, sources.join(firsts, "key").select("key", "share", "forms"), range_docs)
        .withColumn("block", F.floor(F.col("nth") / block_docs))
        .withColumn("round", F.floor(F.col("block") / F.col("share")))
        .withColumn("nth_in_round", F.col("block") % F.col("share"))
    )
    form = F.element_at(F.filter("forms", lambda f: f["first_round"] <= F.col("round")), -1)
    slot = F.col("first_slot") + (F.col("round") - F.col("first_round")) * F.col("size") + F.col("slot")
    return (
        placed.withColumn("at", form["at"])
        .join(slots, ["key", "at", "nth_in_round"])
        .select("row", "block", slot.alias("slot"), "nth")
        .select(
            "row",
            "block",
            "slot",
            (F.col("slot") * block_docs + F.col("nth") % block_docs).alias("position"),
        )
    )


def in_mixed_order(docs: DataFrame, shares: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs``, all of them, range by range in the order of the mix."""
    return (
        mixed(docs, shares)
        .repartitionByRange("position")
        .sortWithinPartitions("position")
        .select("row.*")
    )


def written_position() -> Column:
    """The place of a row that is read from the written files of ``in_mixed_order``.

    Files are numbered by the range that they hold, then in it; how Spark splits
    or orders them when it reads has no part in it.
    """
    name = F.col("_metadata.file_name")
    part = F.regexp_extract(name, r"^part-(\d+)", 1).cast("long")
    nth = F.regexp_extract(name, r"-c(\d+)", 1).cast("long")
    return F.shiftleft(part, 44) + F.shiftleft(nth, 34) + F.col("_metadata.row_index")
