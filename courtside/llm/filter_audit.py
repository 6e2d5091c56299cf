"""What every filter of a cleaning run removes, in every order of the filters, with DataFrame functions only.

Each document becomes a 32-bit word: bit s is set if the document survives the subset s of the filters, that is if it fails
none of them. Words are added up by position in carry-save form: fifteen words become four planes, whose bit s are the
binary digits of how many of the fifteen have bit s set, by eleven full adders of bitwise operations. Planes are read out
as counts per subset and summed. Every figure of every order is a difference of these subset survivors.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

from courtside.session import settle

# The filters and their order.
FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
# words of one row of a block, and words of a block: a block is what one group ever holds
LANE = 15
BLOCK = 4096

# A word, and characters that a clean text does not hold.
WORD_BREAK = r"[\x20\x09-\x0D]+"
MARKS = r"[#$%&*|]"


def failures(text: Column) -> dict[str, Column]:
    """The failure conditions that a text decides by itself."""
    words = F.array_remove(F.split(text, WORD_BREAK), "")
    capitals = F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals.cast("long") > 2 * F.length(text).cast("long"),
        "D": text.rlike(MARKS),
    }


def survival_word(fails: Column) -> Column:
    """32-bit word of the subsets that a document survives, from the bits of the filters it fails."""
    return sum((F.when(fails.bitwiseAND(F.lit(s)) == 0, F.lit(1 << s).cast("long")).otherwise(F.lit(0).cast("long")) for s in range(1, SUBSETS)), F.lit(1).cast("long"))


def documents_words(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, good, toxic, word``, one row per row of ``documents``, written to the shared folder.

    A text is a copy if a smaller ``doc_id`` has the same text anywhere in the table.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = failures(F.col("text"))
    bits = sum((F.when(own[f], 1 << i).otherwise(0) for i, f in enumerate(FILTERS) if f in own), F.lit(0))
    rows = settle(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text")
        ).select("doc_id", "part", F.sha2("text", 256).alias("content"), bits.alias("own")),
        "facts",
    )
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality") == 1, F.col("toxic") == 1).toDF("doc_id", "good", "toxic")
    marks = marks.where("doc_id is not null").groupBy("doc_id").agg(
        F.coalesce(F.max("good"), F.lit(False)).alias("good"), F.coalesce(F.max("toxic"), F.lit(False)).alias("toxic")
    )
    # one row for each text that occurs more than once
    firsts = rows.groupBy("content").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    copied = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    fails = F.col("own") + F.when(copied, 1 << FILTERS.index("E")).otherwise(0)
    return settle(
        rows.join(firsts, "content", "left").join(marks, "doc_id", "left").select(
            "part", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), fails.alias("fails")
        ).select("part", "good", "toxic", survival_word(F.col("fails")).alias("word")),
        "words",
    )


def _adder(a: Column, b: Column, c: Column) -> tuple[Column, Column]:
    """Sum and carry of three words, bit by bit."""
    half = a.bitwiseXOR(b)
    return half.bitwiseXOR(c), a.bitwiseAND(b).bitwiseOR(half.bitwiseAND(c))


def planes(lanes: DataFrame, words: str, keep: list[str]) -> DataFrame:
    """``*keep, p0..p3``: bit s of plane i is digit i of the number of the row's words with bit s set.

    ``words`` is an array of at most ``LANE`` words; missing ones count as none. Each level of adders is a projection of
    its own, so no expression is worked out twice.
    """
    nothing = F.lit(0).cast("long")
    rows = lanes.select(*keep, *[F.coalesce(F.get(words, F.lit(i)), nothing).alias(f"r0_{i}") for i in range(LANE)])
    weights = [[f"r0_{i}" for i in range(LANE)], [], [], []]
    level = 0
    while any(len(w) >= 3 for w in weights[:3]):
        level += 1
        out, after = [], [[] for _ in weights]
        for i, names in enumerate(weights):
            full = len(names) // 3 * 3 if i < 3 else 0
            for j in range(0, full, 3):
                total, carry = _adder(*map(F.col, names[j : j + 3]))
                out += [total.alias(f"s{level}_{i}_{j}"), carry.alias(f"c{level}_{i}_{j}")]
                after[i].append(f"s{level}_{i}_{j}")
                after[i + 1].append(f"c{level}_{i}_{j}")
            after[i] += names[full:]
            out += map(F.col, names[full:])
        rows, weights = rows.select(*keep, *out), after
    # fifteen words leave one word per plane
    return rows.select(*keep, *[F.col(names[0]).alias(f"p{i}") for i, names in enumerate(weights)])


def subset_survivors(words: DataFrame) -> DataFrame:
    """``part, good, toxic, n`` with ``n`` the number of survivors of each subset, from ``part, good, toxic, word``.

    Rows are taken in blocks by their place in the written table, so that a run repeated after a loss forms the same blocks,
    and no group ever holds more than a block.
    """
    key = ["part", "good", "toxic"]
    # the upper bits of the id tell the file range, the lower ones the place in it
    block = F.shiftright(F.monotonically_increasing_id(), BLOCK.bit_length() - 1)
    blocks = words.withColumn("block", block).groupBy(*key, "block").agg(F.collect_list("word").alias("words"))
    starts = F.sequence(F.lit(1), F.size("words"), F.lit(LANE))
    lanes = blocks.select(*key, F.explode(F.transform(starts, lambda i: F.slice("words", i, LANE))).alias("lane"))
    digits = planes(lanes, "lane", key)

    def count(s):
        return sum((F.shiftright(F.col(f"p{i}"), s).bitwiseAND(F.lit(1).cast("long")) * (1 << i) for i in range(4)), F.lit(0).cast("long"))

    counts = digits.groupBy(*key).agg(*[F.sum(count(s)).alias(f"n{s}") for s in range(SUBSETS)])
    return counts.select(*key, F.array(*[f"n{s}" for s in range(SUBSETS)]).alias("n"))


def audit(survivors: DataFrame) -> DataFrame:
    """The figures of every part, order and step from the survivors of every subset; see ``filter_interactions``."""
    by_label = survivors.groupBy("part").agg(*[
        F.sum(F.when(chosen, F.get("n", F.lit(s))).otherwise(0)).alias(f"{name}{s}")
        for name, chosen in (("all", F.lit(True)), ("good", F.col("good")), ("toxic", F.col("toxic"))) for s in range(SUBSETS)
    ])
    parts = by_label.select("part", *[F.array(*[f"{name}{s}" for s in range(SUBSETS)]).alias(name) for name in ("all", "good", "toxic")])
    orders = ["".join(p) for p in permutations(FILTERS)]
    steps = [
        (order, step + 1, sum(1 << FILTERS.index(f) for f in order[:step]), FILTERS.index(order[step])) for order in orders for step in range(len(FILTERS))
    ]
    # what a filter removes beyond a set of others, and in how many orders that set is what stands before it
    removals = {f: {} for f in range(len(FILTERS))}
    for _, _, before, f in steps:
        removals[f][before] = removals[f].get(before, 0) + 1

    def at(name, mask):
        return F.get(F.col(name), mask)

    shapley = F.array(*[
        sum(((at("all", F.lit(before)) - at("all", F.lit(before | 1 << f))) * times for before, times in removals[f].items()), F.lit(0).cast("long"))
        for f in range(len(FILTERS))
    ])
    listed = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("before"), F.lit(f).alias("f")) for o, s, b, f in steps])
    rows = parts.withColumn("sums", shapley).select("*", F.explode(listed).alias("c")).select("part", "all", "good", "toxic", "sums", "c.*")
    own = F.element_at(F.array(*[F.lit(1 << f) for f in range(len(FILTERS))]), F.col("f") + 1)
    rows = rows.withColumn("own", own).withColumn("after", F.col("before").bitwiseOR(F.col("own")))
    everything = F.lit(SUBSETS - 1)
    removed = at("all", F.col("before")) - at("all", F.col("after"))
    return rows.select(
        "part", "filter_order", "step", at("all", F.col("after")).alias("kept"), removed.alias("removed"),
        (at("all", F.lit(0)) - at("all", F.col("own")) - removed).alias("redundant"),
        (at("all", everything.bitwiseXOR(F.col("own"))) - at("all", everything)).alias("unique_fails"),
        (at("good", F.col("before")) - at("good", F.col("after"))).alias("good_lost"),
        (at("toxic", F.col("before")) - at("toxic", F.col("after"))).alias("toxic_lost"),
        F.get("sums", F.col("f")).alias("shapley"),
    )


def filter_interactions(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.

    One row per part (source), order of the five filters and step. Of ``documents`` only ``doc_id``, ``text`` and ``source``
    are read, of ``labels`` only ``doc_id``, ``quality`` and ``toxic``; other columns, whatever their names, play no part.

    * null texts are empty; an empty text has no words, few enough for the first filter; long texts are judged whole;
    * a null source is the part of the empty name, together with a source of that name;
    * a row without ``doc_id`` is no copy and has no label; rows that share an id and a text are no copies of each other;
    * repeated rows count each; a document with several labels is good (toxic) if one of them says so;
    * an empty table gives an empty result.
    """
    return audit(subset_survivors(documents_words(documents, labels)))
