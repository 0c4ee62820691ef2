"""Benchmark decontamination: document windows looked up in a broadcast set of benchmark n-grams.

Only DataFrame functions. One scan of the documents hashes every window of words, looks the hashes up in the broadcast
set and confirms a hit on the words themselves. For a set above the broadcast bound only the hashes are sent, and the words of the hits
are confirmed afterwards, each different one once; a set of hashes above the bound is worked off in blocks, one scan each. Only
hits and one row per document leave the scan.

Texts of any length are read whole. The order of windows with equal words, and of items that share a window, has no effect.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridvoice.llm.common import BROADCAST_BYTES, broadcast_within, free_names, kept

#: Everything in ASCII that is neither a digit nor a lower-case letter.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WIDTH = 10
#: Memory of one n-gram in the broadcast set, with its words and as a hash alone.
GRAM_BYTES = 400
HASH_BYTES = 48


def lower_az(text: Column) -> Column:
    """A-Z in lower case; ``lower`` does the same, faster, where all characters are ASCII."""
    other = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(other)


def words(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.array_remove(F.split(lower_az(F.coalesce(text.cast("string"), F.lit(""))), SEPARATORS), "")


def grams(items: DataFrame, width: int = WIDTH, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(gram, size, item_id)``: windows of each item; a shorter item that has words is one window."""
    split = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w")).withColumn("n", F.size("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.col("n") - width + 1, F.lit(1)))
    return (
        split.filter("n > 0")
        .withColumn("at", F.explode(starts))
        .select(
            F.array_join(F.slice("w", F.col("at"), F.lit(width)), " ").alias("gram"),
            F.least(F.col("n"), F.lit(width)).alias("size"),
            "item_id",
        )
        .distinct()
    )


def _hash(array: str, first: Column | int, size: int) -> Column:
    """Hash of ``size`` words from position ``first``, which counts from 0."""
    return F.xxhash64(*[F.get(array, F.lit(first) + k) for k in range(size)])


def scan(docs: DataFrame, found: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, doc_id, text_hash, n_words, start, size, gram)``: each occurrence of a gram; ``start`` counts words from 1.

    A document whose first window is no gram has a row without a gram besides, so every document is there.
    """
    shape = found.select("gram", "size").distinct().groupBy("size").count().collect()  # at most ``width`` rows
    sizes, total = sorted((r["size"] for r in shape), reverse=True), sum(r["count"] for r in shape)
    with_words = total * GRAM_BYTES <= BROADCAST_BYTES
    blocks = max(1, math.ceil(total * HASH_BYTES / BROADCAST_BYTES))
    split = found.select("gram", "size").distinct().withColumn("w", F.split("gram", " "))
    hashed = [split.filter(F.col("size") == s).select("gram", "size", _hash("w", 0, s).alias("hash")) for s in sizes]

    text = F.col(text_col)
    each = (
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("doc_id"),
            F.xxhash64(text).alias("text_hash"),
            words(text).alias("w"),
        )
        .withColumn("n_words", F.size("w"))
        .select("row", "doc_id", "text_hash", "n_words", "w", F.posexplode_outer("w").alias("at", "word"))
    )
    own = [F.struct(F.lit(s).alias("size"), F.when(F.col("at") + s <= F.col("n_words"), _hash("w", F.col("at"), s)).alias("hash")) for s in sizes]
    if len(sizes) == 1:
        each = each.withColumn("own", own[0]["size"]).withColumn("own_hash", own[0]["hash"])
    elif sizes:
        each = each.withColumn("_own", F.explode(F.array(*own))).withColumns(
            {"own": F.col("_own.size"), "own_hash": F.col("_own.hash")}
        )
    # the row that stands for the document
    itself = F.coalesce(F.col("at"), F.lit(0)) == 0
    if not sizes:
        nothing = {"start": F.lit(None).cast("int"), "size": F.lit(None).cast("int"), "gram": F.lit(None).cast("string")}
        return each.filter(itself).select("row", "doc_id", "text_hash", "n_words", *[c.alias(n) for n, c in nothing.items()])
    grams_of = kept(reduce(DataFrame.unionByName, hashed), "grams")

    own_gram = F.array_join(F.slice("w", F.col("at") + 1, F.col("own")), " ")
    in_set = (F.col("own_hash") == F.col("hash")) & (F.col("own") == F.col("size"))
    columns = ["row", "doc_id", "text_hash", "n_words", "start", "size", "gram"]

    def found_in(rows: DataFrame, k: int) -> DataFrame:
        first = F.lit(k == 0) & itself & (F.col("own") == sizes[0])
        start = F.when(F.col("gram").isNotNull(), F.col("at") + 1)
        return rows.filter(F.col("gram").isNotNull() | first).withColumn("start", start).select(*columns)

    if with_words:
        return found_in(each.join(F.broadcast(grams_of), in_set & (own_gram == F.col("gram")), "left"), 0)

    def against(k: int) -> DataFrame:
        hashes = grams_of.filter(F.pmod("hash", F.lit(blocks)) == k).select("hash", "size").distinct()
        rows = each.join(F.broadcast(hashes), in_set, "left")
        return found_in(rows.withColumn("gram", F.when(F.col("hash").isNotNull(), own_gram)), k)

    candidates = kept(reduce(DataFrame.unionByName, [against(k) for k in range(blocks)]), "candidates")
    # windows that have the hash of a gram without being one, next to none: found on the different words of the candidates
    alike = candidates.filter("gram IS NOT NULL").select("gram").distinct().join(grams_of.select("gram"), "gram", "left_anti")
    alike = kept(alike.withColumn("alike", F.lit(True)), "alike")
    rows = candidates.join(broadcast_within(alike, alike.count(), GRAM_BYTES), "gram", "left")
    confirmed = [F.when(F.col("alike").isNull(), F.col(c)).alias(c) for c in columns[4:]]
    return rows.select(*columns[:4], *confirmed)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    width: int = WIDTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
) -> DataFrame:
    """Per document: words, words inside any benchmark window, the items concerned.

    ``doc_id, text_hash, n_words, n_hit, spans (start, size in words), items (ids as sorted strings), n_items, contaminated``

    A null or empty text has no words and is clean. An empty benchmark leaves every document clean. Items that repeat
    an id count once. Every row of ``docs`` gives one row, also rows that repeat an id or have a null one. Other columns are
    ignored.
    """
    windows = kept(grams(items, width, item_col), "windows")
    rows = kept(scan(docs, windows, width, id_col, text_col), "hits")
    base = rows.select("row", "doc_id", "text_hash", "n_words").distinct()
    hits = rows.filter("start IS NOT NULL")
    spans = (
        hits.groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("start", "size"))).alias("spans"))
        .withColumn(
            "n_hit",
            F.aggregate(
                "spans",
                F.struct(F.lit(0).alias("covered"), F.lit(0).alias("upto")),
                lambda a, s: F.struct(
                    (
                        a["covered"]
                        + F.greatest(F.lit(0), s["start"] + s["size"] - F.greatest(s["start"], a["upto"]))
                    ).alias("covered"),
                    F.greatest(a["upto"], s["start"] + s["size"]).alias("upto"),
                ),
                lambda a: a["covered"],
            ),
        )
    )
    concerned = (
        hits.select("row", "gram")
        .distinct()
        .join(windows.select("gram", "item_id"), "gram")
        .select("row", F.col("item_id").cast("string").alias("item"))
        .distinct()
        .groupBy("row")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    none = F.array().cast("array<string>")
    return (
        base.join(spans, "row", "left")
        .join(concerned, "row", "left")
        .select(
            "doc_id",
            "text_hash",
            F.col("n_words").cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            "spans",
            F.coalesce("items", none).alias("items"),
        )
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def without_contaminated(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """Documents, with all their columns, that hold no benchmark window."""
    flagged = kept(
        contamination(docs, items, width).filter("contaminated").select("doc_id", "text_hash").distinct(), "flagged"
    )
    flagged = broadcast_within(flagged, flagged.count(), 64)
    same = docs["doc_id"].eqNullSafe(flagged["doc_id"]) & (F.xxhash64(docs["text"]) == flagged["text_hash"])
    return docs.join(flagged, same, "left_anti")


def without_spans(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """All documents with the words inside benchmark windows taken out of ``text``; separators stay. Other columns may have any name."""
    own_id, own_hash, spans, split, first = free_names(docs, "own_id", "own_hash", "spans", "split", "first")
    flagged = kept(
        contamination(docs, items, width)
        .filter("contaminated")
        .select(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash), F.col("spans").alias(spans))
        .dropDuplicates([own_id, own_hash]),
        "flagged",
    )
    flagged = broadcast_within(flagged, flagged.count(), 1024)
    same = docs["doc_id"].eqNullSafe(F.col(own_id)) & (F.xxhash64(docs["text"]) == F.col(own_hash))
    both_cases = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    pieces = F.regexp_extract_all("text", F.lit(f"{both_cases}|[^{both_cases[1:-2]}]+"), F.lit(0))
    # a piece is a word or a separator; words are numbered by what came before
    first_is_word = F.when(F.col("text").rlike(f"^{both_cases}"), F.lit(0)).otherwise(F.lit(1))
    rebuilt = F.array_join(
        F.transform(
            split,
            lambda piece, i: F.when(
                ((i + F.col(first)) % 2 == 1)
                & F.exists(
                    spans,
                    lambda s: ((i + F.col(first) + 1) / 2 >= s["start"])
                    & ((i + F.col(first) + 1) / 2 < s["start"] + s["size"]),
                ),
                F.lit(""),
            ).otherwise(piece),
        ),
        "",
    )
    joined = docs.join(flagged, same, "left").withColumn(split, F.when(F.col(spans).isNotNull(), pieces))
    joined = joined.withColumn(first, first_is_word)
    return joined.withColumn("text", F.when(F.col(spans).isNotNull(), rebuilt).otherwise(F.col("text"))).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
