"""Benchmark decontamination by winnowing, with DataFrame functions only.

Every rolling gram of k words is hashed. Of each sliding run of ``window - k + 1`` grams the smallest hash is kept (the last
of equal ones), in documents and in benchmark items alike. Both keep the same gram of any passage of ``window`` words, so
every shared passage of that length meets in a join of the kept grams. A meeting is extended word by word to both sides,
``window - k`` words at most, since what lies beyond belongs to another passage with a kept gram of its own; it is a hit
if the words in common make a whole window. Items shorter than a window are one gram of their own length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from courtside.session import settle

WINDOW = 10
# words of a gram; a long gram meets little else by chance, a short one keeps fewer grams
GRAM = 6

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Array of the words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` that a text has once A-Z are a-z, in their own case; null has none."""
    # only the first and the last part can be empty
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), "")


def _lower(words: Column) -> Column:
    return F.translate(words, UPPER, LOWER)


def _joined(words: Column) -> Column:
    """The words in a-z as one text; no word holds a space."""
    return _lower(F.array_join(words, " "))


def _placed(texts: DataFrame, *columns: str) -> DataFrame:
    """``*columns, w, h, at``: a row per word of ``w`` with its place, after a row of place -1 that every text has.

    ``h`` holds the hashes of all words. ``lower`` changes more than A-Z: it may bring other words together, which are told
    apart where grams meet.
    """
    return texts.select(*columns, "w", F.transform("w", lambda word: F.xxhash64(F.lower(word))).alias("h")).select(
        *columns, "w", "h", F.explode(F.sequence(F.lit(-1), F.size("w") - 1)).alias("at")
    )


def _winnowed(placed: DataFrame, n: int, k: int) -> DataFrame:
    """With ``kept`` and ``gram``: place and hash of the gram that the run of ``n`` grams beginning here keeps.

    Null without such a run, or if it is the one that the run before keeps.
    """
    at, last = F.col("at"), F.col(f"g{n - 1}")
    names = [f"g{i}" for i in range(-1, n)]
    # the window's words and the one before; each gram is a few of them
    near = [F.when(at >= 0, F.get("h", at + i)).alias(f"x{i}") for i in range(-1, n + k - 1)]
    runs = placed.select("*", *near)
    runs = runs.select(
        *placed.columns,
        *[F.when(F.isnotnull(f"x{i}") & F.isnotnull(f"x{i + k - 1}"), F.xxhash64(*[f"x{j}" for j in range(i, i + k)])).alias(f"g{i}") for i in range(-1, n)],
    )
    whole = (at >= 0) & last.isNotNull()
    if n == 1:
        kept, gram = F.when(whole, at), last
    else:
        others = F.least(*names[1:-1]) if n > 2 else F.col("g0")
        # the last of the smallest, looked for from the end; new if it is the run's last gram or the run before kept one that is lost
        inner = F.lit(0)
        for i in range(1, n - 1):
            inner = F.when(F.col(f"g{i}") == others, i).otherwise(inner)
        new = (at == 0) | F.coalesce(F.col("g-1") < others, F.lit(False))
        kept = F.when(whole & (last <= others), at + n - 1).when(whole & new, at + inner)
        gram = F.least(others, last)
    # always true, and not known before a task runs: so a condition on the result is not moved up and worked out twice
    return runs.withColumn("kept", F.when(F.spark_partition_id() >= 0, kept)).withColumn("gram", F.when(F.isnotnull("kept"), gram)).drop(*names)


def _grams(texts: DataFrame, columns: list[str], window: int, k: int, short: list[int]) -> DataFrame:
    """``*columns, length, at, gram, before, words``: grams kept of windows, and all grams of the short lengths.

    ``words`` are those that the gram's windows may hold, ``before`` of them before the gram. The row of place -1 stays,
    with length and gram 0.
    """
    rows = _winnowed(_placed(texts, *columns), window - k + 1, k)
    at, kept, length = F.col("at"), F.col("kept"), F.col("length")
    rows = rows.withColumn("length", F.explode(F.array(*map(F.lit, [window, *short])))) if short else rows.withColumn("length", F.lit(window))
    rows = rows.where(
        ((length == window) & (kept.isNotNull() | (at == -1))) | ((length < window) & (at >= 0) & (at + length <= F.size("w")))
    ).select(
        *columns, "w", "gram", F.when(at >= 0, length).otherwise(0).alias("length"), F.coalesce(F.when(length == window, kept), at).alias("at"),
        F.when(length == window, k).otherwise(length).alias("n"), F.when(length == window, window - k).otherwise(0).alias("reach"),
    )
    before = F.least(F.greatest(at, F.lit(0)), F.col("reach"))
    whole = F.xxhash64(F.lower(F.array_join(F.slice("w", at + 1, F.col("n")), " ")))
    gram = F.when(length == window, F.col("gram")).when(length > 0, whole).otherwise(0) if short else F.coalesce("gram", F.lit(0))
    return rows.select(
        *columns, "length", "at", gram.cast("long").alias("gram"), before.alias("before"),
        F.when(at >= 0, F.slice("w", at - before + 1, before + F.col("n") + F.col("reach"))).alias("words"),
    )


def _common(most: int, words: Column, start: Column, others: Column, others_start: Column, step: int) -> Column:
    """Words that two arrays have in common from their starts on, up to ``most``."""
    out = F.lit(most)
    for i in reversed(range(most)):
        same = _lower(F.get(words, start + i * step)) == F.get(others, others_start + i * step)
        out = F.when(F.coalesce(same, F.lit(False)), out).otherwise(F.lit(i))
    return out


def find_passages(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = GRAM) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Texts, hits and owners.

    Texts: ``doc_id, print, n_words``, one row per row of ``documents``. Hits: ``doc_id, print, passage, first_word,
    last_word``: words that a document shares with a passage of the benchmark, a whole window at least. Owners:
    ``passage, item_id`` (as text). ``print`` tells rows that share an id apart.

    Only ``doc_id`` and ``text``, ``item_id`` and ``text`` are read; other columns, whatever their names, play no part.

    * null and empty texts have no words, are never hit and, as items, hit nothing; long texts are scanned whole;
    * an item of fewer words than a window is one window; repeated items are one, and items with equal texts own the same
      passages; an item without id goes by the empty name;
    * repeated documents have rows of their own and share their hits;
    * empty tables give empty results, an empty benchmark gives texts without hits.

    Documents are scanned in place. What the benchmark keeps is written once, and Spark broadcasts it if it is small; if
    it is not, the kept grams of the documents are shuffled with the few words around them, never the texts.
    """
    if not 1 <= k <= window:
        raise ValueError("a gram has at least one word and at most a window's")
    spark = documents.sparkSession
    items = settle(
        benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.transform(words_of(F.col("text")), _lower).alias("w"))
        .where(F.size("w") > 0).groupBy("w").agg(F.collect_set("item_id").alias("items")),
        "items",
    )
    # at most window - 1 lengths
    short = sorted(r[0] for r in items.select(F.size("w")).where(F.size("w") < window).distinct().collect())
    short_item = F.size("w") < window
    rows = items.withColumn("size", F.size("w"))
    kept = _grams(rows.where(~short_item), ["items"], window, k, []).where("length > 0")
    for m in short:
        whole = _grams(rows.where(F.col("size") == m), ["items"], window, k, [m]).where((F.col("length") == m) & (F.col("at") == 0))
        kept = kept.unionByName(whole)
    passage = F.sha2(F.to_json(F.struct("length", "before", "words")), 256)
    kept = settle(kept.select(passage.alias("passage"), "items", "length", "gram", "before", "words"), "passages")
    owners = kept.select("passage", F.explode("items").alias("item_id")).distinct()
    passages = kept.drop("items").dropDuplicates(["passage"]).select(
        "passage", "length", "gram", F.col("before").alias("item_before"), F.col("words").alias("item_words")
    )
    # the row that every text has meets a row that is no passage
    passages = settle(passages.unionByName(spark.createDataFrame([(None, 0, 0, 0, None)], passages.schema)), "grams")
    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("print"), words_of(F.col("text")).alias("w"))
    key = ["doc_id", "print"]
    grams = _grams(read.withColumn("n_words", F.size("w").cast("long")), [*key, "n_words"], window, k, short)
    words, before, others, others_before = F.col("words"), F.col("before"), F.col("item_words"), F.col("item_before")
    # what meets is few rows; they are compared word by word after writing, which keeps the scan's generated code small
    met = settle(grams.join(passages, ["length", "gram"]).drop("gram"), "met")
    windowed = F.col("length") == window
    same = F.when(windowed, _joined(F.slice(words, before + 1, k)) == F.array_join(F.slice(others, others_before + 1, k), " ")).otherwise(
        _joined(words) == F.array_join(others, " ")
    )
    extended = (
        met.where("passage is not null").where(same)
        .withColumn("left", _common(window - k, words, before - 1, others, others_before - 1, -1))
        .withColumn("right", _common(window - k, words, before + k, others, others_before + k, 1))
    )
    # short items have no words around them, and nothing to extend
    span = F.when(windowed, F.col("left") + k + F.col("right")).otherwise(F.col("length"))
    first = F.when(windowed, F.col("at") - F.col("left")).otherwise(F.col("at"))
    hits = extended.where(span >= F.col("length")).select(
        *key, "passage", first.cast("long").alias("first_word"), (first + span - 1).cast("long").alias("last_word")
    )
    return met.where("passage is null").select(*key, "n_words"), hits.distinct(), owners


def merged(hits: DataFrame) -> DataFrame:
    """``doc_id, print, first_word, last_word``: hits that overlap or touch made one span each. A text's hits fit in a task."""
    key = ["doc_id", "print"]
    longest = hits.groupBy(*key, "first_word").agg(F.max("last_word").alias("last_word"))
    order = Window.partitionBy(*key).orderBy("first_word")
    before = F.max("last_word").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return (
        longest.withColumn("begins", F.coalesce(F.col("first_word") > before + 1, F.lit(True)).cast("int"))
        .withColumn("span", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*key, "span").agg(F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word")).drop("span")
    )


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = GRAM) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``, one row per row of ``documents``.

    ``n_hit`` counts the words inside any shared window, ``n_items`` the items with such a window; ``items_sha256`` is the
    hash of their ids, sorted as strings and joined by commas. See ``find_passages`` for nulls, empty and long texts, ties,
    repeated rows and empty tables; a null ``doc_id`` keeps its row.
    """
    texts, hits, owners = find_passages(documents, benchmark, window, k)
    key = ["doc_id", "print"]
    covered = merged(hits).groupBy(*key).agg(F.sum(F.col("last_word") - F.col("first_word") + 1).alias("n_hit"))
    items = (
        hits.select(*key, "passage").distinct().join(owners, "passage").select(*key, "item_id").distinct()
        .groupBy(*key).agg(F.count(F.lit(1)).alias("n_items"), F.array_join(F.array_sort(F.collect_list("item_id")), ",").alias("items"))
    )
    found = covered.withColumnsRenamed({c: f"_{c}" for c in key})
    owned = items.withColumnsRenamed({c: f"its_{c}" for c in key})
    return (
        texts.join(found, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("print") == F.col("_print")), "left")
        .join(owned, F.col("doc_id").eqNullSafe(F.col("its_doc_id")) & (F.col("print") == F.col("its_print")), "left")
        .select(
            "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )
