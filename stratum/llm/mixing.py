"""Mixing sources to target weights by a low-discrepancy schedule, with DataFrame functions only.

Each source's documents are shuffled (by a hash of their id) into a line of words, which is repeated up to ``epochs`` times
and cut into equal blocks. The schedule has ``2**bits`` slots; slot ``i`` holds the van der Corput point of ``i`` (its bits
reversed), and the source whose part of the cumulative targets the point falls into. Bit reversal is its own inverse, so
every source lists its points and reverses them to slots. The slots of a source are ranked, and rank ``r`` takes block ``r``.
Any stretch of the schedule holds the sources in their target shares to within a few slots.

Targets: sources by code point, null last, weigh 1, 2, 3, 1, 2, 3, ...; they share the words of all documents, but no
source gives more than ``epochs`` times its words. What exceeds that is shared again by weight until nothing does. A
source's target, rounded to words, is cut into as many blocks as it has slots (sizes differ by one word at most), so it is
met to the word; a target too small for any point gets one slot.

Defined results: a null text has no words; documents without words are in no block; rows of one id follow each other,
equal rows are told apart by their place in the table; an empty table gives no rows; without any word nothing is taken.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import same_key, settled
from .lines import in_line

EPOCHS = 3
#: Words of an average block.
BLOCK_WORDS = 256
WEIGHTS = (1, 2, 3)
#: Points listed by one row of the first of two steps.
CHUNK = 4096
WORD = r"[^\x20\x09-\x0D]+"
MASKS = ((1, 0x5555555555555555), (2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F), (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF))


def reversed_bits(value: Column, bits: int) -> Column:
    """The lowest ``bits`` bits of a non-negative long in reverse order."""
    for width, mask in MASKS:
        keep = F.lit(mask)
        value = F.shiftrightunsigned(value, width).bitwiseAND(keep).bitwiseOR(F.shiftleft(value.bitwiseAND(keep), width))
    value = F.shiftrightunsigned(value, 32).bitwiseOR(F.shiftleft(value, 32))
    return F.shiftrightunsigned(value, 64 - bits)


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``row, doc_id, size, source_key, shuffle`` of every document; keys sort by code point, null last."""
    shuffle = F.substring(F.sha2(F.concat(F.lit("mix:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256), 1, 16)
    return settled(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.coalesce(F.concat(F.lit("0"), F.col(source_col).cast("string")), F.lit("1")).alias("source_key"),
        shuffle.alias("shuffle"),
    ), "mix-rows")


def with_targets(sources: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """``source_key, source_size`` with ``weight, target`` (double) and ``goal``, the target in whole words.

    Each round is one aggregate over the sources; two numbers reach the driver: what is left to share, and by how many
    weights.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.pmod("place", F.lit(len(WEIGHTS))) + 1).cast("int"))
    ranked = in_line(sources, [], ["source_key"], "mix-sources").withColumn("weight", weight.cast("long"))
    cap = F.col("source_size").cast("decimal(20,0)") * epochs
    whole = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    words, left, weights = int(whole[0] or 0), int(whole[0] or 0), int(whole[1] or 1)
    full_before = 0
    while True:
        full = cap * F.lit(Decimal(weights)) < F.col("weight").cast("decimal(10,0)") * F.lit(Decimal(left))
        state = ranked.agg(
            F.count(F.when(full, 1)), F.coalesce(F.sum(F.when(full, cap)), F.lit(Decimal(0))),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        if state[0] == full_before or not state[2]:
            break
        full_before, left, weights = state[0], words - int(state[1]), int(state[2])
    share = F.lit(float(left)) * F.col("weight").cast("double") / F.lit(float(weights))
    target = F.least(share, (F.col("source_size") * epochs).cast("double"))
    goal = F.least(F.floor(target + 0.5), F.col("source_size") * epochs).cast("long")
    return settled(ranked.select("source_key", "source_size", "weight", target.alias("target"), goal.alias("goal")), "mix-targets")


def schedule(targets: DataFrame, bits: int) -> DataFrame:
    """``source_key, slot, rank``: which source's next block every slot of the schedule takes."""
    points = 1 << bits
    line = in_line(targets.filter("goal > 0"), [], ["source_key"], "mix-shares", weight="goal")
    edge = "CAST(({}) AS DECIMAL(20,0)) * {} div total"
    first, end = F.expr(edge.format("before", points)), F.expr(edge.format("before + goal", points))
    spans = line.select("source_key", first.alias("first"), F.greatest(end - first, F.lit(1)).alias("slots"))
    chunks = spans.withColumn("chunk", F.explode(F.expr(f"sequence(0L, (slots - 1) div {CHUNK})")))
    chunks = chunks.repartition("source_key", "chunk")
    low = F.col("first") + F.col("chunk") * CHUNK
    high = F.least(low + (CHUNK - 1), F.col("first") + F.col("slots") - 1)
    listed = chunks.select("source_key", F.explode(F.sequence(low, high)).alias("point"))
    slots = settled(listed.select("source_key", reversed_bits(F.least("point", F.lit(points - 1)), bits).alias("slot")), "mix-slots")
    return in_line(slots, ["source_key"], ["slot"], "mix-ranks").select(
        "source_key", "slot", F.col("place").alias("rank"), F.col("members").alias("slots"),
    )


def block_of(word: Column, base: Column, longer: Column) -> Column:
    """Number of the block that holds ``word``: the first ``longer`` blocks have ``base + 1`` words, the others ``base``."""
    edge = longer * (base + 1)
    first = F.call_function("div", word, base + 1)
    return F.when(word < edge, first).otherwise(longer + F.call_function("div", word - edge, F.greatest(base, F.lit(1))))


def mixture(docs: DataFrame, epochs: int = EPOCHS, block_words: int = BLOCK_WORDS, **columns: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(rows, targets, mix)``: the sized documents, the sources with their targets, and the mix itself.

    ``mix`` has a row per slot and document in its block: ``slot, source_key, rank, row, doc_id, epoch, first_word, words``.
    Ordered by ``slot, source_key, place`` it is the training order.
    """
    rows = sized(docs, **columns)
    targets = with_targets(rows.groupBy("source_key").agg(F.sum("size").alias("source_size")), epochs)
    words = int(targets.agg(F.sum("goal")).first()[0] or 0)
    bits = max(4, (words // block_words).bit_length())
    slots = schedule(targets, bits)
    shares = slots.groupBy(F.col("source_key").alias("of_source")).agg(F.max("slots").alias("slots"))
    named = targets.select(F.col("source_key").alias("of_target"), "source_size", "goal")
    cuts = shares.join(named, F.col("of_source") == F.col("of_target")).select(
        "of_source", "source_size", "goal", F.expr("goal div slots").alias("base"), F.expr("goal % slots").alias("longer"),
    )
    line = in_line(rows.filter("size > 0"), ["source_key"], ["shuffle", "doc_id", "size", "row"], "mix-line", weight="size")
    laid = line.join(settled(cuts, "mix-cuts"), same_key("source_key", "of_source", "mix"))
    laid = laid.withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in range(epochs)])))
    laid = laid.withColumn("start", F.col("before") + F.col("epoch") * F.col("source_size")).filter("start < goal")
    laid = laid.withColumn("end", F.least(F.col("start") + F.col("size"), F.col("goal")))
    base, longer = F.col("base"), F.col("longer")
    touched = F.sequence(block_of(F.col("start"), base, longer), block_of(F.col("end") - 1, base, longer))
    laid = laid.withColumn("block", F.explode(touched))
    block_start = F.col("block") * base + F.least("block", longer)
    block_end = block_start + base + F.when(F.col("block") < longer, 1).otherwise(0)
    low, high = F.greatest("start", block_start), F.least("end", block_end)
    pieces = laid.select(
        "row", "doc_id", "epoch", "place", F.col("source_key").alias("of_source"), "block",
        (low - F.col("start")).alias("first_word"), (high - low).alias("words"),
    )
    mix = slots.drop("slots").join(pieces, (F.col("source_key") == F.col("of_source")) & (F.col("rank") == F.col("block")))
    return rows, targets, mix.select("slot", "source_key", "rank", "row", "doc_id", "epoch", "place", "first_word", "words")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document: how many of its words the mix takes."""
    rows, targets, mix = mixture(docs)
    taken = mix.groupBy(F.col("row").alias("of_row")).agg(F.sum("words").alias("words"))
    named = targets.select(F.col("source_key").alias("of_source"), "source_size", "target")
    found = rows.join(taken, F.col("row") == F.col("of_row"), "left").join(named, same_key("source_key", "of_source", "mixed"))
    return found.select("doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken"))
