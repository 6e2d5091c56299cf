"""Mixing sources to target weights, cut at each source's budget by distributed prefix sums.

Every document gets a hash-random key. Within its source the key range is cut into ranges; sizes per range are summed,
running sums over the ranges tell where each begins, and a running sum inside the range places every document. No
step sorts a whole source in one task. A document is taken once per full epoch of the budget, and once more if its
middle lies before the cut of the last, partial epoch: the nearest whole document to the exact budget. Documents of equal
key, id and size are counted first and placed together, so a repeated or missing id is one row wherever rows are ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from courtside.session import settle

# The weights of the sources in order of name, repeating, and the most epochs.
WEIGHTS = (1, 2, 3)
EPOCHS = 3
# key ranges of each source: 2^12
RANGE_BITS = 12
# rows that one task gives back of documents placed together, or of a row that is repeated
PIECE = 1 << 16


def words_in(text: Column) -> Column:
    """Number of words `[^\\x20\\x09-\\x0D]+`; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def random_key(doc_id: Column) -> Column:
    """60 bits of md5, equal on every engine and in every run."""
    return F.coalesce(F.conv(F.substring(F.md5(doc_id.cast("string").cast("binary")), 1, 15), 16, 10).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """``source, source_size, target`` from (source, source_size): one row per source, filled up by weight.

    The whole size is shared by weight. A source whose share is above ``epochs`` times its size stops there, and the
    excess goes to the others by weight. Sources in order of capacity per weight give the level at once: as long as a
    source is below the level that those before it leave over, it is full.
    """
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    listed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (number % len(weights) + 1).cast("int")).cast("long"))
    order = Window.orderBy("per_weight", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    levels = (
        listed.withColumn("room", F.col("source_size") * epochs)
        .withColumn("per_weight", F.col("room").cast("double") / F.col("weight").cast("double"))
        .withColumn("rest", F.sum("source_size").over(whole) - F.coalesce(F.sum("room").over(before), F.lit(0)))
        .withColumn("shares", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", F.col("rest").cast("double") / F.col("shares").cast("double"))
        .withColumn("open", F.col("per_weight") >= F.col("level"))
        .withColumn("at", F.row_number().over(order))
    )
    level = F.min_by("level", F.when(F.col("open"), F.col("at"))).over(whole)
    return levels.withColumn("cut", level).select(
        "source", "source_size",
        F.least(F.col("room").cast("double"), F.coalesce(F.col("cut") * F.col("weight"), F.col("room").cast("double"))).alias("target"),
    )


def mix_sources(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, range_bits: int = RANGE_BITS) -> DataFrame:
    """How often each document enters the mix: ``doc_id, size, source_size, target, copies, taken``, one row per row.

    Only ``doc_id``, ``text`` and ``source`` are read; other columns, whatever their names, play no part. Sizes are
    words. Results depend on the rows alone, not on their order or partitions.

    * null and empty texts have size 0 and give nothing to the mix; long texts count whole;
    * a null source is a source of its own, last in order; a null ``doc_id`` has key 0;
    * repeated rows are documents of their own; equal keys are ordered by id, then size; of documents equal in all three
      as many are taken once more as the budget holds;
    * an empty table gives an empty result.
    """
    groups = settle(_taken(settle(_measured(documents, range_bits), "sizes"), weights, epochs), "groups")
    result = ("doc_id", "size", "source_size", "target", "copies")
    alone = groups.where("n = 1").withColumn("copies", F.col("_full") + F.col("_more")).select(*result)
    # a group of many is given back by many tasks
    pieces = groups.where("n > 1").withColumn("_piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / F.lit(PIECE)))))
    last = F.least("n", (F.col("_piece") + 1) * F.lit(PIECE))
    several = (
        pieces.repartition("_name", "_none", "_key", "doc_id", "size", "_piece")
        .withColumn("_at", F.explode(F.sequence(F.col("_piece") * F.lit(PIECE) + 1, last)))
        .withColumn("copies", F.col("_full") + (F.col("_at") <= F.col("_more")).cast("long"))
        .select(*result)
    )
    return alone.unionByName(several).withColumn("taken", F.col("size") * F.col("copies"))


def mixture(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, range_bits: int = RANGE_BITS) -> DataFrame:
    """The mix itself: every row of ``documents`` as often as ``mix_sources`` takes it, with all its columns.

    Texts are not moved: the last documents that a source takes once more mark its cut, and every row is compared with the
    cut of its source. There is one cut per source; Spark measures the table before it chooses how to join it. Where only
    some of the rows of equal key, id and size at the cut are taken once more, those of the smallest hashes of the whole row
    are. Of rows that are equal altogether, one stands for all that are still wanted.

    * null and empty texts have size 0 and do not enter the mix; long texts enter whole;
    * a null source is a source of its own; a null ``doc_id`` has key 0; repeated rows are documents of their own;
    * all columns are returned, whatever their names; their types must be ones that Spark can hash;
    * an empty table gives an empty result.
    """
    groups = _taken(settle(_measured(documents, range_bits), "sizes"), weights, epochs)
    last = F.max(F.when(F.col("_more") > 0, F.struct(*_place("_key", "doc_id", "size"), F.col("_more").alias("more"), F.col("n").alias("n"))))
    cuts = settle(groups.groupBy("_name", "_none").agg(F.max("_full").alias("_full"), last.alias("_cut")), "cuts")
    key = random_key(F.col("doc_id"))
    whole = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), "doc_id", "text", "source")
    size = words_in(F.col("text"))
    at = F.struct(key.alias("k"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("d"), size.alias("s"))
    cut = F.struct("_cut.k", "_cut.d", "_cut.s")
    source = (F.coalesce("source", F.lit("")) == F.col("_name")) & (F.col("source").isNull() == F.col("_none"))
    hash_ = F.xxhash64("row")
    # sources whose cut goes through rows of one place, most often none: then the rows are not read for them
    parted = settle(cuts.where("_cut.more < _cut.n"), "parted")
    tied = whole.join(parted, source).where((key == F.col("_cut.k")) & (size > 0)).where(at == cut)
    marks = settle(_last_marks(tied.select("_name", "_none", hash_.alias("_hash"), F.col("_cut.more").alias("_more"))), "marks")
    ends = settle(cuts.join(marks, ["_name", "_none"], "left"), "ends")
    more = F.when((at == cut) & F.col("_mark").isNotNull(), hash_ < F.col("_mark")).otherwise(F.coalesce(at <= cut, F.lit(False)))
    copies = F.when(size > 0, F.col("_full") + more.cast("long")).otherwise(0)
    plain = (
        whole.join(ends, source)
        .withColumn("copies", copies)
        .where("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        .select("row.*")
    )
    # one row per source at most, as often as it is still wanted
    equal = tied.select("_name", "_none", "row").join(marks.where("_still > 0"), ["_name", "_none"]).where(hash_ == F.col("_mark"))
    equal = equal.groupBy("_name", "_none").agg(F.first("row").alias("row"), F.first("_still").alias("_still"))
    pieces = equal.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("_still") - 1) / F.lit(PIECE)))))
    wanted = F.least(F.col("_still") - F.col("_piece") * F.lit(PIECE), F.lit(PIECE))
    again = pieces.repartition("_name", "_none", "_piece").select("row", F.explode(F.sequence(F.lit(1).cast("long"), wanted))).select("row.*")
    return plain.unionByName(again)


def _last_marks(tied: DataFrame) -> DataFrame:
    """``_name, _none, _mark, _still``: which hashes of tied rows make up the ``_more`` smallest of a source.

    All rows of hashes under the mark belong to them, and ``_still`` rows of the mark itself. Rows are counted per hash and
    the counts per range of hashes, so that only the hashes of the range with the mark are put in order.
    """
    by = ["_name", "_none"]
    counts = settle(tied.groupBy(*by, "_hash", F.shiftright("_hash", 64 - RANGE_BITS).alias("_range")).agg(
        F.count(F.lit(1)).alias("n"), F.first("_more").alias("_more")
    ), "ties")

    def reached(rows: DataFrame, order: str, least: str) -> DataFrame:
        before = F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        return rows.withColumn("_before", before).where((F.col("_before") < F.col(least)) & (F.col(least) <= F.col("_before") + F.col("n")))

    ranges = reached(counts.groupBy(*by, "_range").agg(F.sum("n").alias("n"), F.first("_more").alias("_more")), "_range", "_more")
    inside = counts.drop("_more").join(ranges.select(*by, "_range", (F.col("_more") - F.col("_before")).alias("_more")), [*by, "_range"])
    marks = reached(inside, "_hash", "_more")
    return marks.select(*by, F.col("_hash").alias("_mark"), (F.col("_more") - F.col("_before")).alias("_still"))


_LEAST = -(1 << 63)


def _place(key: str, doc_id: str, size: str) -> list[Column]:
    return [F.col(key).alias("k"), F.coalesce(F.col(doc_id), F.lit(_LEAST)).alias("d"), F.col(size).alias("s")]


def _measured(documents: DataFrame, range_bits: int) -> DataFrame:
    key = random_key(F.col("doc_id"))
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        words_in(F.col("text")).alias("size"), key.alias("_key"), F.shiftright(key, 60 - range_bits).alias("_range"),
    )


def _taken(rows: DataFrame, weights: tuple[int, ...], epochs: int) -> DataFrame:
    """Documents of equal source, key, id and size as one row: their number ``n``, taken ``_full`` times, and ``_more`` of them once more."""
    # a source by two columns that are never null, so that joins find the null source
    rows = rows.withColumn("_name", F.coalesce("source", F.lit(""))).withColumn("_none", F.col("source").isNull())
    named = ["_name", "_none"]
    ranges = settle(rows.groupBy(*named, "_range").agg(F.sum("size").alias("in_range")), "ranges")
    goals = targets(
        ranges.groupBy(*named).agg(F.sum("in_range").alias("source_size"))
        .select(F.when(~F.col("_none"), F.col("_name")).alias("source"), "source_size"),
        weights, epochs,
    ).select(F.coalesce("source", F.lit("")).alias("_name"), F.col("source").isNull().alias("_none"), "source_size", "target")
    earlier = Window.partitionBy(*named).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    full = F.floor(F.col("target") / F.col("source_size"))
    starts = (
        ranges.withColumn("_start", F.coalesce(F.sum("in_range").over(earlier), F.lit(0)))
        .join(goals, named)
        .withColumn("_full", F.when(F.col("source_size") > 0, full).otherwise(0).cast("long"))
        .select(*named, "_range", "_start", "source_size", "target", "_full", (F.col("target") - F.col("_full") * F.col("source_size")).alias("_rest"))
    )
    # counted before rows of a range meet, so that the copies of an id are one row there
    groups = rows.groupBy(*named, "_range", "_key", "doc_id", "size").agg(F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy(*named, "_range").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    place = F.col("_start") + F.coalesce(F.col("_before"), F.lit(0))
    # row i of a group, from 0, lies before the cut while 2 * (place + i * size) + size <= 2 * rest
    room = (2 * F.col("_rest") - (2 * place + F.col("size")).cast("double")) / (2 * F.col("size")).cast("double")
    more = F.greatest(F.least(F.floor(room) + 1, F.col("n")), F.lit(0))
    # the explicit partitioning keeps the window from reusing a coarser one
    return (
        groups.repartition(*named, "_range")
        .withColumn("_before", F.sum(F.col("size") * F.col("n")).over(inside))
        .join(starts, [*named, "_range"])
        .withColumn("_full", F.when(F.col("size") > 0, F.col("_full")).otherwise(0).cast("long"))
        .withColumn("_more", F.when(F.col("size") > 0, more).otherwise(0).cast("long"))
    )
