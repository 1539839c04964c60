"""Benchmark decontamination by SimHash over windows as long as an item, in DataFrame functions only.

A text leaks an item if one of its windows of as many words, or the whole of a text with fewer words, has
a weighted shingle similarity of 0.8 or more with it: shingles are 5 words in lower case (all words of a shorter item), weighted by how
often they occur, and similarity is the sum of the lesser over the sum of the larger weights.

1. Candidates: a window that similar shares at least ``need`` shingles with the item (0.889 of the mean of
   their numbers; a window has 0.8 of the item's at least), so at least as many of its places hold a shingle of the item, wherever the item has it. All texts'
   shingles meet the items' shingles in a broadcast join; starts are dealt to tiles as long as the item,
   and a sliding count of the places that a tile's windows cover keeps the starts with enough of them. Order
   plays no part, so swapped halves or sentences are found too. This step loses nothing.
2. SimHash: the windows at those starts get 64-bit fingerprints of their shingles, which are numbered by
   occurrence, so that none weighs more than another. Equal windows are fingerprinted once. Fingerprints are cut
   into RADIUS + 1 blocks, and a window meets an item that step 1 proposed for it where they agree on one block;
   two fingerprints within RADIUS bits agree on one at least. At similarity 0.8 (cosine 0.889) 9.7 of 64 bits differ in the mean with a
   standard deviation of 2.9, so a radius of 23 misses about one in a million.
3. Exact weighted similarity decides. Verdicts go back to the places of their windows in a join of two written
   tables, so a passage that a third of all texts hold is a skewed key that Spark can split, and no list.

Items are broadcast in blocks of at most ITEM_SHINGLES shingles, however many there are.

Defined cases: null texts and items have no words; an item without words matches nothing; a text
shorter than an item is one window, and an item of up to 5 words needs all of them; repeated rows leak alike; equal items match alike; empty tables give no
rows; further columns are ignored by ``leaks`` and kept by ``drop_leaking``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtrust.sources.workspace import Workspace

SHINGLE, RADIUS = 5, 23
ITEM_SHINGLES = 400_000
SHORT = 16_383  # shingles that a 16-bit counter can count


def word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingles(hashes: str, size: int) -> Column:
    """Hashes of all runs of ``size`` words."""
    runs = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (size - 1), F.lit(0)))
    return F.transform(runs, lambda h, i: F.xxhash64(h, *[F.get(F.col(hashes), i + k) for k in range(1, size)]))


def _majority(grams: str, width: int) -> Column:
    """64 bits: bit b is set where more than half of the hashes have it set, for up to 2**(width - 2) - 1 hashes.

    A long holds 64 / width counters, of the bits j, j + width and so on. Adding one less than a quarter of the
    field's range, less half the number of hashes, lifts the counters above half to that quarter.
    """
    top = width - 2
    ones = F.lit(sum(1 << i for i in range(0, 64, width)))
    lift = ones * (F.lit((1 << top) - 1) - F.floor(F.size(grams) / 2)).cast("long")

    def lane(j: int) -> Column:
        return F.aggregate(grams, F.lit(0).cast("long"), lambda a, h: a + F.shiftrightunsigned(h, j).bitwiseAND(ones))

    bits = [F.shiftleft(F.shiftrightunsigned(lane(j) + lift, top).bitwiseAND(ones), j) for j in range(width)]
    return reduce(Column.bitwiseOR, bits)


def simhash(grams: str) -> Column:
    """Majority bits, with counters as wide as the number of hashes needs (up to 2**30)."""
    return F.when(F.size(grams) <= SHORT, _majority(grams, 16)).otherwise(_majority(grams, 32))


CUTS = [64 * i // (RADIUS + 1) for i in range(RADIUS + 2)]


def indexed(rows: DataFrame, fingerprint: str) -> DataFrame:
    """A row for each of RADIUS + 1 blocks (block, value) that cut the 64 bits."""
    at, size = (F.array(*map(F.lit, x)) for x in (CUTS[:-1], [2 ** (b - a) - 1 for a, b in zip(CUTS[:-1], CUTS[1:], strict=True)]))
    numbered = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(RADIUS))))
    value = F.call_function("shiftrightunsigned", F.col(fingerprint), F.get(at, F.col("block"))).bitwiseAND(F.get(size, F.col("block")).cast("long"))
    return numbered.withColumn("value", value)


def tagged(grams: str) -> Column:
    """Shingles numbered by occurrence, so that sets of them stand for weighted shingles."""
    earlier = F.transform(grams, lambda g, i: F.xxhash64(g, F.size(F.filter(F.slice(grams, F.lit(1), i), lambda x: x == g))))
    distinct = F.size(F.array_distinct(grams)) == F.size(grams)
    return F.when(distinct, F.transform(grams, lambda g: F.xxhash64(g, F.lit(0)))).otherwise(earlier)


def needed(width: Column, m: Column) -> Column:
    """Least number of shingles that a window of ``width`` shares with an item of ``m`` at similarity 0.8: 0.8 / 1.8 of both."""
    return F.ceil(4 * (width + m) / 9).cast("int")


def item_shingles(benchmark: DataFrame) -> DataFrame:
    """item (a key of id and words), item_id, m (shingles), words, size of a shingle, grams; equal items are one."""
    hashed = benchmark.select("item_id", word_hashes(F.col("text")).alias("hashes")).where(F.size("hashes") > 0)
    items = hashed.withColumn("item", F.xxhash64("item_id", "hashes")).dropDuplicates(["item"])
    # An item of fewer words than a shingle is one shingle of all its words.
    by_size = [F.when(F.size("hashes") == k, shingles("hashes", k)) for k in range(1, SHINGLE)]
    grams = F.coalesce(*by_size, shingles("hashes", SHINGLE))
    sized = items.select("item", "item_id", F.size("hashes").alias("words"), F.least(F.size("hashes"), F.lit(SHINGLE)).alias("size"), grams.alias("grams"))
    return sized.withColumn("m", F.size("grams"))


def _tiles(documents: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """Of every text, item and tile of starts: the places in reach that hold a shingle of the item, and the text's shingles there.

    A tile is as many starts from ``low`` as its windows are wide: ``m``, or all of a shorter text that has 0.8 of
    ``m``. Its windows reach 2 * width - 1 places, so a place counts in two tiles.
    """
    grams = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), word_hashes(F.col("text")).alias("hashes")).select(
        "doc_id", "text_hash", shingles("hashes", size).alias("own")
    )
    known = items.where(F.col("size") == size).select("item", "m", F.explode_outer(F.array_distinct("grams")).alias("gram"))
    found = grams.select("doc_id", "text_hash", "own", F.posexplode_outer("own").alias("p", "gram")).join(F.broadcast(known), "gram")
    width, p = F.col("width"), F.col("p")
    here = p - p % width
    lows = F.when((here > 0) & (p - here < width - 1), F.array(here, here - width)).otherwise(F.array(here))
    last = F.size("own") - width
    wide = found.withColumn("width", F.least(F.col("m"), F.size("own"))).where(5 * width >= 4 * F.col("m"))
    reached = wide.select("doc_id", "text_hash", "own", "item", "m", "width", "p", last.alias("last"), F.explode(lows).alias("low")).where("low <= last")
    around = F.slice("own", F.col("low") + 1, 2 * width - 1)
    tiles = reached.select("doc_id", "text_hash", "item", "m", "width", "low", "last", "p", around.alias("around"))
    return tiles.groupBy("doc_id", "text_hash", "item", "m", "width", "low", "last").agg(F.array_sort(F.collect_set("p")).alias("places"), F.first("around").alias("around"))


def _starts(places: Column, need: Column, width: Column, low: Column, high: Column) -> Column:
    """Starts from ``low`` to ``high`` of the windows of ``width`` that hold at least ``need`` of the ordered places.

    A window whose first place is number j holds enough if place j + need - 1 is in it.
    """

    def of_first(j: Column) -> Column:
        begin = F.greatest(low, F.coalesce(F.get(places, j - 1) + 1, low), F.get(places, j + need - 1) - width + 1)
        end = F.least(high, F.get(places, j))
        return F.when(begin <= end, F.sequence(begin, end)).otherwise(F.array().cast("array<int>"))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(places) - need), of_first))


def candidates(documents: DataFrame, items: DataFrame) -> DataFrame | None:
    """Windows with enough places of an item: doc_id, text_hash, item, m, size, start, grams."""
    sizes = items.groupBy("size").agg(F.sum("m").alias("n")).collect()  # a row for each of 1 to 5
    text, out = ["doc_id", "text_hash"], None
    for size, n in sorted((r["size"], r["n"]) for r in sizes):
        parts = -(-n // ITEM_SHINGLES)
        for part in range(parts):
            some = items.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part)
            tiles = _tiles(documents, some, size).withColumn("need", needed(F.col("width"), F.col("m"))).where(F.size("places") >= F.col("need"))
            high = F.least(F.col("low") + F.col("width") - 1, F.col("last"))
            starts = _starts(F.col("places"), F.col("need"), F.col("width"), F.col("low"), high)
            windows = tiles.select(*text, "item", "m", "width", "low", "around", F.explode(starts).alias("start")).select(
                *text, "item", "m", F.lit(size).alias("size"), "start", F.slice("around", F.col("start") - F.col("low") + 1, F.col("width")).alias("grams")
            )
            out = windows if out is None else out.unionByName(windows)
    return out


def similar_windows(windows: DataFrame, items: DataFrame, workspace: Workspace) -> DataFrame:
    """window, item, item_id and similarity of the distinct windows that are similar to the item proposed for them."""
    distinct = windows.groupBy("window", "item", "size").agg(F.first("grams").alias("grams"))
    # Written before the join: its filters on the keys would repeat the whole fingerprint in the plan.
    tagged_windows = workspace.stage(distinct.select("window", "item", tagged("grams").alias("tags")).withColumn("fingerprint", simhash("tags")), "windows")
    difference = F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint"))
    met = (
        indexed(tagged_windows, "fingerprint")
        .join(indexed(items.select("item", "item_id", "m", "item_tags", "item_fingerprint"), "item_fingerprint"), ["item", "block", "value"])
        # Of the blocks on which a pair agrees, the first one counts.
        .where((F.bit_count(difference) <= RADIUS) & (F.col("block") == _first_block(difference)))
    )
    shared = F.size(F.array_intersect("tags", "item_tags"))
    both = F.size("tags") + F.col("m")
    scored = met.select("window", "item", "item_id", (shared / (both - shared)).alias("similarity"), shared.alias("shared"), both.alias("both"))
    return scored.where(9 * F.col("shared") >= 4 * F.col("both")).drop("shared", "both")


def leaks(documents: DataFrame, benchmark: DataFrame, workspace: Workspace) -> DataFrame:
    """doc_id, text_hash, item_id, the first most similar window's begin and its similarity."""
    items = item_shingles(benchmark).withColumn("item_tags", tagged("grams")).withColumn("item_fingerprint", simhash("item_tags"))
    items = workspace.stage(items, "items")
    found = candidates(documents, items.select("item", "m", "size", "grams"))
    if found is None:
        return documents.sparkSession.createDataFrame([], f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, text_hash long, item_id long, start int, similarity double")
    windows = workspace.stage(found.withColumn("window", F.xxhash64("grams")), "candidates")
    verdicts = workspace.stage(similar_windows(windows, items, workspace), "verdicts")
    similar = windows.select("doc_id", "text_hash", "item", "start", "window").join(verdicts, ["window", "item"])
    best = F.max_by(F.struct("similarity", "start"), F.struct("similarity", -F.col("start")))
    return (
        similar.groupBy("doc_id", "text_hash", "item_id")
        .agg(best.alias("best"))
        .select("doc_id", "text_hash", "item_id", F.col("best.start").alias("start"), F.col("best.similarity").alias("similarity"))
    )


def _first_block(difference: Column) -> Column:
    spans = enumerate(zip(CUTS[:-1], CUTS[1:], strict=True))
    return F.coalesce(*[F.when(F.shiftrightunsigned(difference, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) == 0, i) for i, (a, b) in spans])


def drop_leaking(documents: DataFrame, benchmark: DataFrame, workspace: Workspace) -> DataFrame:
    """Documents that leak no item."""
    found = leaks(documents, benchmark, workspace).select(F.col("doc_id").alias("__doc_id"), F.col("text_hash").alias("__text_hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.xxhash64("text") == F.col("__text_hash"))
    return documents.join(found, same, "left_anti")
