"""Near copies of texts: SuperMinHash signatures, bands, checked links, groups.

1. A text's set holds its distinct k-word shingles. Equal sets are one class, known by their fingerprint, with a number
   of its own; only one text of a class goes on. Ids play no part until the groups are known.
2. SuperMinHash: every element takes the m slots in an order of its own and writes round + uniform value
   there, so slots are filled without repetition (the ranks of one element are a permutation, which lowers the
   variance against independent minima). Rounds stop once every slot is filled: later values cannot be smaller.
3. ``rows`` slots make a band; classes with an equal band meet in a bucket. With 30 bands of 5 slots a pair
   of similarity 0.8 misses all buckets with probability 7e-6.
4. In every bucket the smallest class is compared with all others: on signatures, then, if those do not place the
   pair far below the threshold, on full sets. Linked classes are joined.
5. Buckets that still hold several groups are compared block by block on signatures. That gives clusters of what
   may be linked; a cluster with several groups is compared block by block on full sets.
6. Groups are connected components of the links.

No bucket is gathered as a whole. Blocks return one row per class at most, never their pairs, and classes of the
group that most of a block belongs to are not compared with each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from courtside.llm.components import components, joined, tiles
from courtside.llm.words import find_words, mix, pieces, shingles, text_bytes
from courtside.session import settle

BANDS, ROWS = 30, 5
# signature estimates this far below the threshold are not checked: over 4 standard deviations at 150 slots
MARGIN = 0.14
BLOCK = 2048
# classes whose full sets meet in one task, twice
SET_BLOCK = 512
# bits of the summary of texts that are read again (4 MB); the more texts, the less it spares, but none is lost
BLOOM_BITS = 1 << 25


def super_min_hash(doc: np.ndarray, value: np.ndarray, docs: int, slots: int) -> np.ndarray:
    """SuperMinHash signatures (docs x slots) of sets given as sorted (doc, value); no element: all ones."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    flat = np.full(docs * slots, full, np.uint64)
    perm = None
    for turn in range(slots):
        draw = mix(value + np.uint64(0x9E3779B97F4A7C15 * (turn + 1) & 0xFFFFFFFFFFFFFFFF))
        pick = turn + ((draw >> np.uint64(40)) % np.uint64(slots - turn)).astype(np.int64)
        if perm is None:
            slot = pick
        else:
            row = np.arange(len(pick))
            slot = perm[row, pick].astype(np.int64)
            perm[row, pick] = perm[:, turn]
        # round in the top bits, 40 random bits below
        mark = (np.uint64(turn) << np.uint64(40)) | (draw & np.uint64(0xFFFFFFFFFF))
        at = doc * slots + slot
        free = flat[at] >= np.uint64(turn) << np.uint64(40)
        np.minimum.at(flat, at[free], mark[free])
        open_docs = (flat.reshape(docs, slots) == full).any(axis=1)
        stay = open_docs[doc]
        if not stay.any():
            break
        if perm is None:
            doc, value, pick = doc[stay], value[stay], pick[stay]
            perm = np.tile(np.arange(slots, dtype=np.int16), (len(doc), 1))
            perm[np.arange(len(doc)), pick] = 0
        elif not stay.all():
            doc, value, perm = doc[stay], value[stay], perm[stay]
    return flat.reshape(docs, slots)


def _sets(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per piece of a batch: first and last text, and the sorted (text, shingle hash)."""
    data, bounds = text_bytes(column)
    for i, j in pieces(bounds):
        words = find_words(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
        yield i, j, *shingles(words, k)


def _signer(k: int, bands: int, rows: int):
    """Arrow batches of (doc_id, text, mark, twin) to set sizes, set fingerprints, band keys and one byte of each slot."""

    def sign(batches):
        for batch in batches:
            for i, j, doc, value in _sets(batch.column(1), k):
                n = np.bincount(doc, minlength=j - i)
                sig = super_min_hash(doc, value, j - i, bands * rows)
                keys = np.zeros((j - i, bands), np.uint64)
                for r in range(rows):
                    keys = mix(keys * np.uint64(0x9DDFEA08EB382D69) + sig[:, r::rows])
                keys = mix(keys + np.arange(bands, dtype=np.uint64))
                low = mix(sig).astype(np.uint8)
                flat = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, (j - i) * bands + 1, bands, dtype=np.int32)), pa.array(keys.ravel().view(np.int64))
                )
                yield pa.record_batch(
                    [*(batch.column(c).slice(i, j - i) for c in (0, 2, 3)), pa.array(n), pa.array(_prints(value, n), pa.binary()), flat,
                     pa.array([x.tobytes() for x in low], pa.binary())],
                    ["doc_id", "mark", "twin", "n_shingles", "print", "keys", "sig"],
                )

    return sign


def _prints(value: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Fingerprint of each set of ``n`` values."""
    raw = value.tobytes()
    return [hashlib.blake2b(raw[8 * (e - c) : 8 * e], digest_size=16).digest() for e, c in zip(np.cumsum(n), n)]


def _marks() -> list[Column]:
    """Two hashes of a row's id and text, by which it is found again."""
    return [F.xxhash64("doc_id", "text").alias("mark"), F.xxhash64(F.lit("twin"), "doc_id", "text").alias("twin")]


def _spots(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of each mark in the summary."""
    h = mix(ids.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return (h % np.uint64(BLOOM_BITS)).astype(np.int64), ((h >> np.uint64(32)) % np.uint64(BLOOM_BITS)).astype(np.int64)


def _summary(marks: DataFrame) -> bytes:
    """Bit table in which both bits of every mark are set. Tasks send set words, 64 bits each: BLOOM_BITS in all."""

    def words(batches):
        for batch in batches:
            spot = np.concatenate(_spots(batch.column(0).to_numpy()))
            yield pa.record_batch([pa.array(spot >> 6), pa.array((np.uint64(1) << (spot & 63).astype(np.uint64)).view(np.int64))], ["word", "bits"])

    found = marks.mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(BLOOM_BITS // 64, np.int64)
    table[found["word"].to_numpy()] = found["bits"].to_numpy()
    return table.tobytes()


def _sets_of(nodes: DataFrame, classes: DataFrame, documents: DataFrame, k: int, label: str) -> DataFrame:
    """``node, items``: sorted full sets of the named classes, written once. No text is shuffled.

    The summary of the marks of one text per class travels to the scan, which skips other texts; those it lets through
    besides are dropped. A task sends a text once however often it is repeated.
    """
    wanted = settle(nodes.join(classes.select("node", "mark", "print").hint("merge"), "node"), f"{label}-ids")
    bits = documents.sparkSession.sparkContext.broadcast(_summary(wanted.select("mark")))

    def make(batches):
        table = np.unpackbits(np.frombuffer(bits.value, np.uint8), bitorder="little").view(bool)
        sent: set[tuple[int, bytes]] = set()
        for batch in batches:
            a, b = _spots(batch.column(0).to_numpy())
            batch = batch.filter(pa.array(table[a] & table[b]))
            for i, j, doc, value in _sets(batch.column(1), k):
                n = np.bincount(doc, minlength=j - i)
                ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                names = list(zip(batch.column(0).slice(i, j - i).to_pylist(), _prints(value, n)))
                part = pa.record_batch(
                    [pa.array([m for m, _ in names], pa.int64()), pa.array([p for _, p in names], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(value.view(np.int64)))],
                    ["mark", "print", "items"],
                )
                yield part.filter(pa.array([not (x in sent or sent.add(x)) for x in names], pa.bool_()))

    sets = documents.select("mark", "text").mapInArrow(make, "mark long, print binary, items array<long>")
    # shuffled first: a sort beside the Python workers takes memory
    sets = sets.repartition("mark", "print").groupBy("mark", "print").agg(F.first("items").alias("items"))
    return settle(sets.join(wanted.hint("merge"), ["mark", "print"]).select("node", "items"), label)


def _overlaps(percent: int):
    """Pairs whose full sets share at least ``percent`` of their union. Sets arrive sorted and distinct."""

    def check(batches):
        for batch in batches:
            keep = []
            left, right = batch.column("x"), batch.column("y")
            lv, rv = left.values.to_numpy(), right.values.to_numpy()
            lo, ro = left.offsets.to_numpy(), right.offsets.to_numpy()
            for i in range(batch.num_rows):
                x, y = lv[lo[i] : lo[i + 1]], rv[ro[i] : ro[i + 1]]
                if _linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return check


def _linked(both, n, m, percent):
    return 100 * both >= percent * (n + m - both)


def _alike(least: float):
    """Pairs whose signatures agree in at least ``least`` of the slots."""

    def check(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("x", "y"))
            near = (x == y).sum(axis=1) >= least * x.shape[1] if batch.num_rows else np.zeros(0, bool)
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return check


def _stars(node: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    """Links inside a tile as stars: each place that has one, with the first place of its group."""
    i, j = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    first = joined(i, j, len(node))
    away = np.flatnonzero(first != np.arange(len(node)))
    return pa.table({"a": node[away].astype(np.int64), "b": node[first[away]].astype(np.int64)})


def _thin(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """As few links with the same groups."""
    first = joined(i, j, n)
    met = np.unique(np.concatenate([i, j]))
    return met, first[met]


def _likely(least: float):
    """In a tile: classes of different groups whose signatures agree in at least ``least`` of the slots, as stars."""

    def find(table: pa.Table) -> pa.Table:
        node, group = table["node"].to_numpy(), table["component"].to_numpy()
        sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint8).reshape(len(node), -1)
        found = []
        for part, others in zip(*_pairs_of(table)):
            same = np.zeros((len(part), len(others)), np.int16)
            for slot in range(sig.shape[1]):
                same += sig[part, slot][:, None] == sig[others, slot][None, :]
            near = (same >= least * sig.shape[1]) & (group[part][:, None] != group[others][None, :])
            i, j = np.nonzero(near)
            if len(i):
                found.append(_thin(part[i], others[j], len(node)))
        return _stars(node, found)

    return find


def _pairs_of(table: pa.Table, stripe: int = 128) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Stripes of places of a tile and, for each, the places to compare it with.

    All pairs of different groups across the tile's two blocks are among them. Members of the group that most of the
    tile belongs to are compared with the other groups only.
    """
    group, side = table["component"].to_numpy(), table["side"].to_numpy()
    names, counts = np.unique(group, return_counts=True)
    major = group == names[np.argmax(counts)]
    here = np.arange(len(group))
    if table["tile_i"][0].as_py() == table["tile_j"][0].as_py():
        sides = [(here[~major], here)]
    else:
        one, two = here[side == 0], here[side == 1]
        sides = [(one[~major[one]], two), (one[major[one]], two[~major[two]])]
    left, right = [], []
    for a, b in sides:
        for s in range(0, len(a), stripe):
            if len(b):
                left.append(a[s : s + stripe])
                right.append(b)
    return left, right


def _overlapping(percent: int):
    """In a tile: classes of different groups that are linked on full sets, as stars."""

    def find(table: pa.Table) -> pa.Table:
        node, group = table["node"].to_numpy(), table["component"].to_numpy()
        items = table["items"].combine_chunks()
        starts = items.offsets.to_numpy()
        _, code = np.unique(items.flatten().to_numpy(), return_inverse=True)
        starts = starts - starts[0]
        size = np.diff(starts)
        has = np.zeros(code.max(initial=-1) + 1, np.int32)
        found = []
        for part, others in zip(*_pairs_of(table, 1)):
            x = part[0]
            others = others[group[others] != group[x]]
            # sets of too different sizes cannot be linked
            others = others[(100 * size[others] >= percent * size[x]) & (100 * size[x] >= percent * size[others])]
            if not len(others):
                continue
            has[code[starts[x] : starts[x + 1]]] = 1
            sums = np.concatenate([[0], np.cumsum(has[np.concatenate([code[starts[y] : starts[y + 1]] for y in others])])])
            ends = np.cumsum(size[others])
            both = sums[ends] - sums[ends - size[others]]
            has[code[starts[x] : starts[x + 1]]] = 0
            hit = others[_linked(both, size[x], size[others], percent)]
            if len(hit):
                found.append((np.full(len(hit), x), hit))
        return _stars(node, found)

    return find


def _mixed(rows: DataFrame, by: str) -> DataFrame:
    """Sizes of the groups ``by`` that hold more than one component."""
    return (
        rows.groupBy(by)
        .agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("c0"), F.max("component").alias("c1"))
        .where("c0 < c1")
        .select(by, "n")
    )


def _groups(
    documents: DataFrame, k: int, percent: int, bands: int, rows: int, block: int, set_block: int
) -> tuple[DataFrame, DataFrame]:
    """Rows of documents (``doc_id, mark, twin, n_shingles, print``) and classes (``print, least, component``).

    ``least`` is the smallest id of a class, null if its rows have none.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select("doc_id", "text", *_marks())
    signed = settle(
        documents.mapInArrow(
            _signer(k, bands, rows),
            "doc_id long, mark long, twin long, n_shingles long, print binary, keys array<long>, sig binary",
        ),
        "signed",
    )
    # rows of a class have the same keys
    first = settle(
        signed.where("n_shingles > 0").groupBy("print")
        .agg(F.min("doc_id").alias("least"), F.min("mark").alias("mark"), F.first("keys").alias("keys"), F.first("sig").alias("sig"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    # the sort-merge hints keep one plan at every size
    placed = first.select("node", F.explode("keys").alias("key"))
    shared = placed.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most")
    met = settle(placed.join(shared.drop("most").hint("merge"), "key"), "met")
    least = percent / 100 - MARGIN
    signs = first.select("node", "sig").hint("merge")
    stars = (
        met.where("node > least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
        .join(signs.select(F.col("node").alias("a"), F.col("sig").alias("x")), "a")
        .join(signs.select(F.col("node").alias("b"), F.col("sig").alias("y")), "b")
        .select("a", "b", "x", "y").mapInArrow(_alike(least), "a long, b long")
    )
    stars = settle(stars, "stars")
    sets = _sets_of(stars.select(F.explode(F.array("a", "b")).alias("node")).distinct(), first, documents, k, "sets").hint("merge")
    links = settle(
        stars.join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("items").alias("y")), "b")
        .select("a", "b", "x", "y").mapInArrow(_overlaps(percent), "a long, b long"),
        "links",
    )

    def grouped(rows: DataFrame, groups: DataFrame) -> DataFrame:
        return rows.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))

    groups = settle(components(links), "groups")
    within = settle(grouped(met.select("key", "node"), groups), "within")
    mixed = _mixed(within, "key").where("n > 2")
    maybe = tiles(within.join(mixed.select("key"), "key", "left_semi").join(signs, "node"), "key", mixed, "node", block)
    maybe = settle(maybe.groupBy("key", "tile_i", "tile_j").applyInArrow(_likely(least), "a long, b long"), "maybe")
    clusters = components(maybe.unionByName(links)).withColumnRenamed("component", "cluster")
    clusters = settle(grouped(clusters, groups), "clusters")
    mixed = _mixed(clusters, "cluster")
    unsure = settle(clusters.join(mixed.select("cluster"), "cluster", "left_semi"), "unsure")
    items = _sets_of(unsure.select("node").distinct(), first, documents, k, "more-sets").hint("merge")
    more = tiles(unsure.join(items, "node"), "cluster", mixed, "node", set_block)
    more = settle(more.groupBy("cluster", "tile_i", "tile_j").applyInArrow(_overlapping(percent), "a long, b long"), "more")

    groups = components(links.unionByName(more))
    return signed.drop("keys", "sig"), settle(grouped(first.select("node", "print", "least"), groups).drop("node"), "grouped")


def near_documents(
    documents: DataFrame, k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK,
    set_block: int = SET_BLOCK,
) -> DataFrame:
    """Groups of near copies: ``doc_id, n_shingles, component_id, kept``, one row per row of ``documents``.

    Only ``doc_id`` and ``text`` are read; other columns, whatever their names, play no part. Two texts
    are linked when 100 * shared shingles >= ``percent`` * all shingles of both, counted on full sets.

    * null and empty texts, and texts without words: empty set, linked with nothing, kept;
    * a text of fewer than ``k`` words: one shingle, its whole sequence;
    * very long texts: whole, one at a time;
    * a null ``doc_id``: set size given, ``component_id`` null, not kept; its text links others like any text;
    * repeated rows of an id: each gives a row, and the id is one node; if its texts differ, near copies are found for
      each of them;
    * ties do not arise: the smallest id of a group stays; an empty table gives an empty result.
    """
    signed, classes = _groups(documents, k, percent, bands, rows, block, set_block)
    heads = classes.groupBy("component").agg(F.min("least").alias("head")).where("head is not null")
    headed = classes.join(heads.hint("merge"), "component").select("print", "head")
    of = settle(
        signed.where("n_shingles > 0 and doc_id is not null").select("doc_id", "print").join(headed.hint("merge"), "print")
        .select("doc_id", "head").distinct(),
        "heads",
    )
    # ids whose texts are in several groups join these
    ids = of.groupBy("doc_id").agg(F.min("head").alias("head"), F.max("head").alias("most"))
    again = of.join(ids.where("head < most").select("doc_id"), "doc_id", "left_semi")
    over = components(again.select(F.col("doc_id").alias("a"), F.col("head").alias("b")))
    ends = ids.select(F.col("doc_id").alias("id"), "head").join(over, F.col("head") == F.col("node"), "left").select(
        "id", F.coalesce("component", "head").alias("component")
    )
    return signed.select("doc_id", "n_shingles").join(ends, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(False)).alias("kept"),
    )


def one_of_each(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``documents`` without near copies, whole.

    Of every group of texts the row of the smallest id stays, and one of its rows without id. An id that stands for
    different texts plays no part in what is a group. Texts without words are copies of nothing; of equal rows with an id
    one stays.
    """
    documents = documents.withColumn("doc_id", F.col("doc_id").cast("long"))
    signed, classes = _groups(documents, k, percent, BANDS, ROWS, BLOCK, SET_BLOCK)
    name = F.struct("doc_id", "mark", "twin")
    full = signed.where("n_shingles > 0").join(classes.select("print", "component").hint("merge"), "print")
    best = full.groupBy("component", F.col("doc_id").isNull().alias("bare")).agg(F.min(name).alias("name")).select("name.*")
    stay = best.unionByName(signed.where("n_shingles = 0 and doc_id is not null").select("doc_id", "mark", "twin").distinct())
    stay = settle(stay, "stay").select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.col("twin").alias("_twin"))
    rows = documents.select(F.struct(*documents.columns).alias("row"), "doc_id", *_marks())
    found = rows.join(
        stay.hint("merge"), (F.col("mark") == F.col("_mark")) & (F.col("twin") == F.col("_twin")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi"
    )
    one = found.groupBy("mark", "twin", "doc_id").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    wordless = signed.where("n_shingles = 0 and doc_id is null").select(F.col("mark").alias("_mark"), F.col("twin").alias("_twin")).distinct()
    bare = rows.where("doc_id is null").join(
        wordless.hint("merge"), (F.col("mark") == F.col("_mark")) & (F.col("twin") == F.col("_twin")), "left_semi"
    )
    return one.select("row.*").unionByName(bare.select("row.*"))
