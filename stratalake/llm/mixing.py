"""Mixing sources to target weights with a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.common import WORD, shuffle_join
from stratalake.session import work_folder

# The golden ratio's fraction gives the points; ranks and cells are counted in parts of these sizes.
GOLDEN = 0.6180339887498949
ORDER_BITS, BUCKET_BITS = 62, 12
CHUNK_SLOTS = 65_536
CELLS = 65_536


class Mix(NamedTuple):
    """``documents``: id, source, size, source_size, target, taken, n_slots (of the source) and first_position (null if none is
    taken). ``pieces``: the mix itself, in order of position: source_no, mix_row, id, pass_no, from_word, length."""

    documents: DataFrame
    pieces: DataFrame


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple, share: float, cap: float) -> DataFrame:
    """One row per source: source, source_no, source_size, weight, target, quota (the target in whole words).

    Sources take the weights in turn by code point, null last. The share of all words is dealt by weight; a source stops at ``cap`` times
    its size and the excess is dealt again. Sorted by cap over weight, exactly a prefix of the sources stops, so windows
    over this table (one row per source) find the level at once.
    """
    everything = Window.orderBy("ratio", "source_no").rowsBetween(Window.unboundedPreceding, -1)
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    totals = totals.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    totals = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") - 1) % len(weights) + 1).cast("double"))
    totals = totals.withColumn("most", F.col("source_size") * cap).withColumn("ratio", F.col("most") / F.col("weight"))
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) * share - F.coalesce(F.sum("most").over(everything), F.lit(0.0))
    level = left / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(everything), F.lit(0.0)))
    totals = totals.withColumn("level", level)
    reached = F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(whole)
    target = F.least(F.col("most"), F.coalesce(reached * F.col("weight"), F.col("most")))
    totals = totals.withColumn("target", target).withColumn("quota", F.round("target").cast("long"))
    return totals.select("source", "source_no", "source_size", "weight", "target", "quota")


def schedule(sources: DataFrame, slots: int) -> DataFrame:
    """slot, source_no and block (the slot's rank among its source's slots) for golden-ratio points.

    The points go through the cumulative targets by an equi-join on cells of the unit interval. Ranks are counted inside chunks of
    slots and carried over by the chunks' totals, so no source's slots come together in one task.
    """
    spark = sources.sparkSession
    running = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("quota").over(Window.partitionBy())
    bounds = sources.where("quota > 0").select("source_no", (F.sum("quota").over(running) / total).alias("high"), ((F.sum("quota").over(running) - F.col("quota")) / total).alias("low"))
    cells = bounds.withColumn("cell", F.explode(F.sequence((F.col("low") * CELLS).cast("int"), F.least((F.col("high") * CELLS).cast("int"), F.lit(CELLS - 1)))))
    points = spark.range(slots).select(F.col("id").alias("slot"), ((F.col("id") + 0.5) * GOLDEN % 1.0).alias("point"))
    points = points.withColumn("cell", F.least((F.col("point") * CELLS).cast("int"), F.lit(CELLS - 1)))
    dealt = points.join(cells, "cell").where("point >= low and point < high").select("slot", "source_no", (F.col("slot") / CHUNK_SLOTS).cast("long").alias("chunk"))
    inside = dealt.withColumn("place", F.row_number().over(Window.partitionBy("source_no", "chunk").orderBy("slot")))
    earlier = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = dealt.groupBy("source_no", "chunk").count().select("source_no", "chunk", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    return inside.join(chunks, ["source_no", "chunk"]).select("slot", "source_no", (F.col("before") + F.col("place") - 1).alias("block"))


def full_schedule(spark: SparkSession, sources: DataFrame, block_words: int, folder: str) -> DataFrame:
    """slot, source_no and block for every block of every source, by as many rounds of ``schedule`` as it takes.

    A round has one slot per block that is left. The points give some sources a few slots more than they have blocks, which stay
    empty, and others a few less, whose blocks are left to the next round. The first point of a round always meets a source with a
    block left, and what is left shrinks to a few blocks in the first round, so a handful of rounds follow.
    """
    schema = "slot long, source_no int, block long"
    left = sources.select("source_no", F.ceil(F.col("quota") / block_words).alias("blocks"), F.lit(0).cast("long").alias("dealt"))
    start = step = 0
    while True:
        left.write.parquet(f"{folder}/left/step={step}")
        left = spark.read.schema("source_no int, blocks long, dealt long").parquet(f"{folder}/left/step={step}")
        slots = left.agg(F.sum(F.col("blocks") - F.col("dealt"))).first()[0] or 0
        if not slots:
            break
        waiting = left.select("source_no", "blocks", "dealt", (F.col("blocks") - F.col("dealt")).alias("quota"))
        dealt = schedule(waiting.select("source_no", "quota"), int(slots)).withColumnRenamed("source_no", "to_source")
        placed = dealt.join(waiting, F.col("to_source") == F.col("source_no")).where(F.col("block") < F.col("quota"))
        placed.select((F.col("slot") + start).alias("slot"), "source_no", (F.col("block") + F.col("dealt")).alias("block")).write.parquet(f"{folder}/slots/step={step}")
        counted = spark.read.schema(schema).parquet(f"{folder}/slots/step={step}").groupBy("source_no").agg(F.count(F.lit(1)).alias("more"))
        after = left.join(counted, "source_no", "left").select("source_no", "blocks", (F.col("dealt") + F.coalesce("more", F.lit(0))).alias("dealt"))
        start, step, left = start + int(slots), step + 1, after
    if not step:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema + ", step int").parquet(f"{folder}/slots").drop("step")


def mix(docs: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, cap: float = 2.0, block_words: int = 1024, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text") -> Mix:
    """Mix the documents so that every source's words come to its target (see ``source_targets``).

    A source's documents are shuffled by a hash of their id into one line of words, read at most ceil(cap) times, and cut into blocks of
    ``block_words``; the last block ends at the quota. Its n-th slot of the schedule takes its n-th block, and a block is in the mix only
    by its slot. Slots are dealt until every block has one (``full_schedule``), so taken words differ from a target by rounding only.

    Null text: size 0, never taken; nor are documents of a source of size 0. A null source is a source. Repeated rows count
    each; equal ids are ordered by row. No rows give no rows; other columns are not read. Sizes, source tables, slots and pieces are
    joins and windows over (source, bucket) or (source, chunk), so that a source with a third of all words is spread.
    """
    if cap < 0 or share < 0 or not weights or min(weights) <= 0 or block_words < 1:
        raise ValueError("weights and block size must be positive, share and cap not negative")
    spark = docs.sparkSession
    folder = work_folder(spark, "mix")
    given = docs.select(docs[id_column].alias("id"), docs[source_column].cast("string").alias("source"), word_count(docs[text_column].cast("string")).alias("size"))
    placed = given.withColumn("mix_row", F.monotonically_increasing_id()).withColumn("place", F.xxhash64(F.lit("mix"), "id", "mix_row").bitwiseAND((1 << ORDER_BITS) - 1))
    placed.write.parquet(folder + "/sizes")
    sizes = spark.read.schema(placed.schema).parquet(folder + "/sizes")
    source_targets(sizes, weights, share, cap).write.parquet(folder + "/sources")
    sources = spark.read.schema("source string, source_no int, source_size long, weight double, target double, quota long").parquet(folder + "/sources")
    planned = full_schedule(spark, sources, block_words, folder)

    known = sizes.withColumnRenamed("source", "given").join(sources, F.col("given").eqNullSafe(sources["source"])).drop("given")
    line = known.withColumn("bucket", F.shiftright("place", ORDER_BITS - BUCKET_BITS))
    before = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = line.groupBy("source_no", "bucket").agg(F.sum("size").alias("words")).select("source_no", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source_no", "bucket").orderBy("place", "id", "mix_row").rowsBetween(Window.unboundedPreceding, 0)
    line = line.withColumn("running", F.sum("size").over(inside)).join(buckets, ["source_no", "bucket"])
    line = line.withColumn("start", F.col("offset") + F.col("running") - F.col("size")).where("size > 0")
    passes = F.sequence(F.lit(0), F.lit(max(0, -int(-cap // 1) - 1)))
    line = line.withColumn("pass_no", F.explode(passes)).withColumn("low", F.col("pass_no") * F.col("source_size") + F.col("start"))
    line = line.withColumn("high", F.least(F.col("low") + F.col("size"), F.col("quota"))).where("low < high")
    blocks = F.sequence((F.col("low") / block_words).cast("long"), ((F.col("high") - 1) / block_words).cast("long"))
    cut = line.withColumn("block", F.explode(blocks)).select(
        "mix_row", "id", "source_no", "block", "pass_no", (F.greatest("low", F.col("block") * block_words) - F.col("low")).alias("from_word"),
        (F.least("high", (F.col("block") + 1) * block_words) - F.greatest("low", F.col("block") * block_words)).alias("length"),
    )
    pieces = shuffle_join(cut, planned, ["source_no", "block"]).select(F.col("slot").alias("position"), "source_no", "mix_row", "id", "pass_no", "from_word", "length")
    pieces.write.parquet(folder + "/pieces")
    pieces = spark.read.schema(pieces.schema).parquet(folder + "/pieces")
    taken = pieces.groupBy("mix_row").agg(F.sum("length").alias("taken"), F.min("position").alias("first_position"))
    dealt = planned.groupBy(F.col("source_no").alias("dealt_to")).agg(F.count(F.lit(1)).alias("n_slots"))
    known = known.join(dealt, F.col("source_no") == F.col("dealt_to"), "left")
    documents = known.join(taken, "mix_row", "left").select(
        F.col("id").alias(id_column), "source", "size", "source_size", "target", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("taken", "n_slots")], "first_position"
    )
    return Mix(documents, pieces)
