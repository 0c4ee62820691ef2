"""Line dedup by log templates. Only DataFrame functions.

A line falls into a leaf of a tree of fixed depth: the number of its tokens, then its leading tokens; runs of digits are
variable from the start. In a leaf, a token that stands at its position in few documents is variable. What remains is
the line's template. Templates that recur across documents are dropped, except from the first document that has them.

Lines are cut into tokens once and written with their leaf. Only the lines of leaves that recur, one row per different line, go
through the token counts, so copies cost one row each and prose that does not recur costs none. "In few documents" and "across documents" mean
different documents: a document with several lines of a template counts once.

With ``long_words`` set, a line of so many words also recurs if it stands, character by character, in two documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridvoice.llm.common import broadcast_within, free_names, kept

WHITE = r"[\x20\x09-\x0D]+"
VARIABLE = "<*>"


@dataclass(frozen=True)
class Settings:
    """Leading tokens of a leaf, documents that make a template recur, constant share of a template in per cent.

    Identical lines of ``long_words`` words or more recur from two documents on; None leaves that to templates.
    """

    depth: int = 3
    min_docs: int = 5
    constant_percent: int = 80
    long_words: int | None = None


def _lines(docs: DataFrame, settings: Settings) -> DataFrame:
    """``doc_id, text_hash, line_no, size, exact, leaf, masked``: lines that have tokens."""
    each = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )
    tokens = F.array_remove(F.split(F.regexp_replace("line", "[0-9]+", VARIABLE), WHITE), "")
    return (
        each.withColumn("tokens", tokens)
        .withColumn("size", F.size("tokens"))
        .filter("size > 0")
        .select(
            "doc_id",
            "text_hash",
            "line_no",
            "size",
            F.xxhash64("line").alias("exact"),
            F.xxhash64("size", F.slice("tokens", 1, settings.depth)).alias("leaf"),
            F.array_join("tokens", " ").alias("masked"),
        )
    )


def _across(rows: DataFrame, by: list[str], index: DataFrame, min_docs: int) -> DataFrame:
    """The groups whose lines stand in at least ``min_docs`` different documents; ``rows`` has ``leaf, line, docs, first_doc``.

    Different first documents, and the documents of one line, are different documents, which settles nearly all groups. Only for groups
    that have enough lines without that are the documents themselves listed.
    """
    bounds = kept(
        rows.groupBy(*by, "first_doc")
        .agg(F.max("docs").alias("most"), F.sum("docs").alias("docs"))
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("firsts"), F.max("most").alias("most"), F.sum("docs").alias("docs"))
        .filter(F.col("docs") >= min_docs),
        "bounds",
    )
    settled = (F.col("firsts") >= min_docs) | (F.col("most") >= min_docs)
    open_ = bounds.filter(~settled).select(*by)
    open_ = broadcast_within(open_, open_.count(), 16 * len(by) + 16)
    listed = (
        rows.join(open_, by)
        .select(*{*by, "leaf", "line"})
        .join(index.select("leaf", "line", "doc_id"), ["leaf", "line"])
        .select(*by, "doc_id")
        .distinct()
    )
    counted = listed.groupBy(*by).agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") >= min_docs)
    return bounds.filter(settled).select(*by).unionByName(counted.select(*by))


def _recurring(index: DataFrame, settings: Settings) -> DataFrame:
    """``leaf, line, keeper`` of the lines whose template recurs; the keeper is the smallest document that has the template."""
    leaves = kept(
        index.select("leaf", "doc_id")
        .distinct()
        .groupBy("leaf")
        .agg(F.count(F.lit(1)).alias("docs"))
        .filter(F.col("docs") >= settings.min_docs)
        .select("leaf"),
        "leaves",
    )
    leaves = broadcast_within(leaves, leaves.count(), 32)
    different = kept(
        index.join(leaves, "leaf")
        .select("leaf", "line", "masked", "size", "doc_id")
        .distinct()
        .groupBy("leaf", "line", "masked", "size")
        .agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first_doc")),
        "different",
    )
    each = different.select(
        "leaf", "line", "docs", "first_doc", F.posexplode(F.split("masked", " ")).alias("at", "token")
    ).withColumn("token", F.xxhash64("token"))
    constant = _across(each, ["leaf", "at", "token"], index, settings.min_docs)
    # the template of a line: its constant tokens with their positions, whatever stands elsewhere
    templates = (
        each.select("leaf", "line", "at", "token")
        .join(constant, ["leaf", "at", "token"])
        .groupBy("leaf", "line")
        .agg(
            F.count(F.lit(1)).alias("constants"),
            F.sum(F.xxhash64("at", "token").cast("decimal(38,0)")).alias("sum"),
            F.bit_xor(F.xxhash64("token", "at")).alias("xor"),
        )
    )
    known = kept(
        different.select("leaf", "line", "size", "docs", "first_doc")
        .join(templates, ["leaf", "line"])
        .filter(F.col("constants") * 100 >= F.col("size") * settings.constant_percent)
        .drop("constants", "size"),
        "known",
    )
    template = ["leaf", "sum", "xor"]
    keepers = known.groupBy(*template).agg(F.min("first_doc").alias("keeper"))
    recurring = _across(known, template, index, settings.min_docs).join(keepers, template)
    return known.select(*template, "line").join(recurring, template).select("leaf", "line", "keeper")


def _identical(index: DataFrame) -> DataFrame:
    """``exact, keeper`` of the long lines that stand in two documents or more."""
    return (
        index.filter("exact IS NOT NULL")
        .select("exact", "doc_id")
        .distinct()
        .groupBy("exact")
        .agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("keeper"))
        .filter("docs > 1")
        .select("exact", "keeper")
    )


def with_dropped(docs: DataFrame, settings: Settings = Settings(), into: str = "dropped") -> DataFrame:
    """All columns of ``docs``, with ``into``: the line numbers, from 0, of recurring lines; null if there are none."""
    own_id, own_hash = free_names(docs, "own_id", "own_hash")
    each = _lines(docs, settings)
    columns = ["doc_id", "text_hash", "line_no", "leaf", F.xxhash64("masked").alias("line"), "size", "masked"]
    if settings.long_words is not None:
        columns.append(F.when(F.col("size") >= settings.long_words, F.col("exact")).alias("exact"))
    index = kept(each.select(*columns), "lines")
    recurring = kept(_recurring(index, settings), "recurring")
    recurring = broadcast_within(recurring, recurring.count(), 48)
    found = index.join(recurring, ["leaf", "line"]).select("doc_id", "text_hash", "line_no", "keeper")
    if settings.long_words is not None:
        identical = kept(_identical(index), "identical")
        identical = broadcast_within(identical, identical.count(), 32)
        found = found.unionByName(index.join(identical, "exact").select("doc_id", "text_hash", "line_no", "keeper"))
    gone = (
        found.filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash))
        .agg(F.sort_array(F.collect_set("line_no")).alias(into))
    )
    gone = kept(gone, "dropped")
    sized = gone.agg(F.count(F.lit(1)), F.sum(F.size(into))).first()
    gone = broadcast_within(gone, sized[0] + (sized[1] or 0), 64)
    same = docs["doc_id"].eqNullSafe(F.col(own_id)) & (F.xxhash64(docs["text"]) == F.col(own_hash))
    return docs.join(gone, same, "left").drop(own_id, own_hash)


def _left_over(text: Column, dropped: str) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(dropped, i))
    return F.when(F.col(dropped).isNull(), text).otherwise(F.array_join(lines, "\n"))


def dedup(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row: ``doc_id, n_lines, n_dropped, text_left``.

    A template recurs if at least ``min_docs`` different documents have a line of it, an identical line of ``long_words`` words if two
    have. It stays in the document with the smallest id of those that have it, in all lines there. Texts and lines of any length are read
    whole. Lines without tokens are never dropped. A null text has no lines and stays null. Rows that repeat an id are one
    document when documents are counted. Rows with a null id are one document together, never the first. Other columns are
    ignored. An empty table gives an empty table.
    """
    plain = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return with_dropped(plain, settings).select(
        "doc_id",
        F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        _left_over(F.col("text"), "dropped").alias("text_left"),
    )


def without_recurring(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Documents, with all their columns, without recurring lines; those left without any word go.

    ``n_chars`` follows the text. Documents that had no words before stay as they are. Other columns may have any name.
    """
    (dropped,) = free_names(docs, "dropped")
    marked = with_dropped(docs, settings, dropped).withColumn("text", _left_over(F.col("text"), dropped))
    stays = F.col(dropped).isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    changed = F.when(F.col(dropped).isNull(), F.col("n_chars")).otherwise(F.length("text"))
    columns = [
        changed.cast(f.dataType).alias("n_chars") if f.name == "n_chars" else F.col(f"`{f.name}`") for f in docs.schema.fields
    ]
    return marked.filter(stays).select(*columns)
