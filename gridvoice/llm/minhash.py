"""Near-duplicate documents: universal-hash minima, banding, verification, connected components.

1. Each text becomes a set of word shingles (64-bit hashes) and, per hash function, the set's minimum.
2. Texts with equal sets are one class; only the class with the smallest id goes on.
3. Bands of minima are bucket keys. Every member of a bucket is paired with the bucket's smallest id, the
   signatures of a pair must agree nearly enough, and the pair is confirmed on the full sets.
4. Members of one bucket that are not yet in one component are compared with each other, in blocks of a bounded
   number of members inside tasks; only confirmed links leave the task.
5. Components by alternating large-star and small-star steps.

The minima per band follow from the similarity, so that a pair exactly at it shares no bucket with a probability of
1e-6 at most: 7 at 0.85, 5 at 0.8, of 36 bands. The signature check refuses a pair only if fewer than ``similarity - 0.15`` of its minima agree, five standard
deviations or more below the expected share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridvoice.llm import shingles as S
from gridvoice.llm.common import broadcast_within, free_names, kept, slices, small_batches
from gridvoice.llm.components import components


@dataclass(frozen=True)
class Settings:
    """Words per shingle, similarity in per cent, bands, chance to miss a pair at the similarity, members per block, seed.

    Buckets of more than ``hot`` unsettled members are compared in blocks inside tasks.
    """

    words: int = 5
    percent: int = 80
    bands: int = 36
    miss: float = 1e-6
    block: int = 512
    hot: int = 16
    seed: int = 11

    def family(self) -> tuple[np.ndarray, np.ndarray]:
        """Multipliers (odd) and offsets of the hash functions x -> (a x + b) mod 2**32."""
        rng = np.random.default_rng(self.seed)
        size = self.bands * self.rows
        return (
            rng.integers(0, 2**32, size, dtype=np.uint32) | np.uint32(1),
            rng.integers(0, 2**32, size, dtype=np.uint32),
        )

    @property
    def rows(self) -> int:
        """Minima per band: as many as the chance to miss a pair allows."""
        share = self.percent / 100
        return max(r for r in range(1, 33) if r == 1 or (1 - share**r) ** self.bands <= self.miss)

    @property
    def least_agreeing(self) -> int:
        return int((self.percent / 100 - 0.15) * self.bands * self.rows)


def minima(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over the set."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(a), 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(x), 4096):
            np.minimum(least, (a[:, None] * x[None, at : at + 4096] + b[:, None]).min(axis=1), out=least)
    return least


def _digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _sets(piece: pa.RecordBatch, column: str, words: int) -> Iterator[np.ndarray]:
    raw, offsets = S.text_bytes(piece.column(column))
    raw = S.lowered(raw)
    starts, ends, first = S.words(raw, offsets)
    hashes = S.word_hashes(raw, starts, ends)
    for i in range(piece.num_rows):
        yield np.unique(S.shingle_hashes(hashes[first[i] : first[i + 1]], words))


SKETCH = "id long, text_hash long, n_shingles long, same binary, sig binary, keys array<long>"


def sketches(docs: DataFrame, settings: Settings, id_col: str, text_col: str) -> DataFrame:
    """Set size, set digest, low bytes of the minima and band keys of each text; keys are null for an empty set."""

    def run(batches):
        a, b = settings.family()
        for batch in batches:
            for piece in slices(batch, "text"):
                rows = []
                ids, hashes = piece.column("id").to_pylist(), piece.column("text_hash").to_pylist()
                for doc, text, found in zip(ids, hashes, _sets(piece, "text", settings.words)):
                    if not len(found) or doc is None:
                        rows.append((doc, text, len(found), None, None, None))
                        continue
                    least = minima(found, a, b)
                    with np.errstate(over="ignore"):
                        folded = np.zeros(settings.bands, np.uint64)
                        for column in least.reshape(settings.bands, settings.rows).T:
                            folded = S.mix(folded + column.astype(np.uint64) + np.uint64(1))
                        folded = S.mix(folded + np.arange(settings.bands, dtype=np.uint64))
                    rows.append((doc, text, len(found), _digest(found), least.astype(np.uint8).tobytes(), folded.view(np.int64)))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.int64()),
                        pa.array(columns[2], pa.int64()),
                        pa.array(columns[3], pa.binary()),
                        pa.array(columns[4], pa.binary()),
                        pa.array(columns[5], pa.list_(pa.int64())),
                    ],
                    names=["id", "text_hash", "n_shingles", "same", "sig", "keys"],
                )

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return small_batches(plain.withColumn("text_hash", F.xxhash64("text"))).mapInArrow(run, SKETCH)


def _repeated(sketch: DataFrame) -> DataFrame | None:
    """``(doc, same, node)`` for ids that stand for different sets, or None: each of their sets gets a number of its own, above all ids."""
    filled = sketch.filter("same IS NOT NULL").select("id", "same", F.xxhash64("same").alias("mark"))
    several = filled.groupBy("id").agg(F.min("mark").alias("low"), F.max("mark").alias("high")).filter("low <> high").select("id")
    several = kept(several, "several")
    n = several.count()
    if not n:
        return None
    top = sketch.agg(F.max("id")).first()[0]
    found = filled.join(broadcast_within(several, n, 32), "id").select(F.col("id").alias("doc"), "same").distinct()
    return kept(found.withColumn("node", F.monotonically_increasing_id() + F.lit(top + 1)), "nodes")


def _as_nodes(rows: DataFrame, repeated: DataFrame | None) -> DataFrame:
    """``id`` becomes the node of ``(id, same)``, and ``doc`` the id."""
    rows = rows.withColumnRenamed("id", "doc")
    if repeated is None:
        return rows.withColumn("id", F.col("doc"))
    return rows.join(repeated, ["doc", "same"], "left").withColumn("id", F.coalesce("node", "doc")).drop("node")


def _full_sets(
    docs: DataFrame, wanted: DataFrame, settings: Settings, id_col: str, text_col: str, repeated: DataFrame | None
) -> DataFrame:
    """``(id, members)``: the sorted shingle hashes, as bytes, of the wanted nodes.

    Their ids are sent to the scan if they are within the bound, so that texts are not shuffled.
    """
    wanted = kept(wanted, "wanted")
    n = wanted.count()
    asked = wanted
    if repeated is not None:
        own = repeated.select(F.col("node").alias("id"), "doc")
        asked = kept(wanted.join(own, "id", "left").select(F.coalesce("doc", "id").alias("id")).distinct(), "asked")
    asked = broadcast_within(asked, n, 32)

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                found = list(_sets(piece, "text", settings.words))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("id"),
                        pa.array([_digest(s) if len(s) else None for s in found], pa.binary()),
                        pa.array([s.tobytes() for s in found], pa.binary()),
                    ],
                    names=["id", "same", "members"],
                )

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sets = plain.join(asked, "id", "left_semi").mapInArrow(run, "id long, same binary, members binary").filter("same IS NOT NULL")
    if repeated is None:
        return sets.select("id", "members")
    return _as_nodes(sets, repeated).join(wanted, "id", "left_semi").select("id", "members")


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _signature_filter(pairs: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """Pairs whose sizes allow the similarity and whose signatures agree nearly enough."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8) for c in ("sig_a", "sig_b"))
            agreeing = (x == y).reshape(batch.num_rows, -1).sum(axis=1)
            yield batch.select(["a", "b"]).filter(pa.array(agreeing >= settings.least_agreeing))

    sides = [
        classes.select(F.col("id").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("sig").alias(f"sig_{c}"))
        for c in ("a", "b")
    ]
    sized = pairs.join(sides[0], "a").join(sides[1], "b")
    near = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * settings.percent
    return sized.filter(near).select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that reach the similarity on the full sets."""

    def run(batches):
        for batch in batches:
            left, right = batch.column("members_a"), batch.column("members_b")
            keep = [
                _similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                for x, y in zip(left, right)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sides = [sets.select(F.col("id").alias(c), F.col("members").alias(f"members_{c}")) for c in ("a", "b")]
    return pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(run, "a long, b long")


def _within_blocks(rows: DataFrame, settings: Settings) -> DataFrame:
    """Links between members of one bucket in different components, compared block by block.

    ``rows(key, band, id, component, sig, keys, members)`` of unsettled buckets. A pair is only verified in the first
    band whose bucket it shares. A bucket is cut into blocks by a hash of
    the id, each pair of blocks is one group, so no group holds more than about two blocks.
    """
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    blocked = (
        rows.join(sizes, "key")
        .withColumn("blocks", F.ceil(F.col("size") / settings.block).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "key",
            "band",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            "own",
            "id",
            "component",
            "sig",
            "keys",
            "members",
        )
    )

    def compare(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        own, component = table.column("own").to_numpy(), table.column("component").to_numpy()
        diagonal = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(len(ids), -1)
        keys = np.array(table.column("keys").to_pylist(), np.int64)
        band = table.column("band")[0].as_py()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("members").to_pylist()]
        sizes = np.array([len(x) for x in sets])
        out = []
        for k in range(len(ids)):
            rivals = (ids > ids[k]) & (component != component[k]) & (diagonal | (own != own[k]))
            rivals &= 100 * np.minimum(sizes, sizes[k]) >= settings.percent * np.maximum(sizes, sizes[k])
            at = np.flatnonzero(rivals)
            if len(at):
                at = at[(sig[at] == sig[k]).sum(axis=1) >= settings.least_agreeing]
                at = at[(keys[at] == keys[k]).argmax(axis=1) == band]
            out += [(ids[k], ids[m]) for m in at if _similar(sets[k], sets[m], settings.percent)]
        return pa.table(
            {"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())}
        )

    return blocked.groupBy("key", "i", "j").applyInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Words are runs of characters other than ASCII white space, A-Z lower-cased. Documents are linked if
    100 * common shingles >= percent * all shingles. The component is the smallest id reachable; a document is kept
    if it is that one.

    Null, empty and blank texts have no shingles, are linked with nothing and are kept. A text of fewer words
    than a shingle is one shingle; texts of any length are read whole. A row with a null id has no component and is kept. Rows that
    repeat an id with other words are documents of their own: each is linked by its own text. Of equally similar documents none is
    preferred, all links count. Other columns of ``docs`` are ignored. An empty table gives an empty table.
    """
    return _labelled(docs, settings, id_col, text_col).drop("text_hash")


def _labelled(docs: DataFrame, settings: Settings, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``near_duplicates`` with ``text_hash``, which tells rows of one id apart."""
    sketch = kept(sketches(docs, settings, id_col, text_col), "sketch")
    repeated = _repeated(sketch)
    sketch = _as_nodes(sketch, repeated)
    filled = sketch.filter("same IS NOT NULL")
    heads = filled.groupBy("same").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("copies"))
    shared = kept(heads.filter("copies > 1").select("same", "head"), "copies")
    # one document of each set goes on
    classes = (
        filled.join(shared, "same", "left").filter("head IS NULL OR head = id").select("id", "n_shingles", "sig", "keys")
    )

    banded = classes.select("id", F.posexplode("keys").alias("band", "key"))
    buckets = banded.groupBy("key").agg(F.min("id").alias("head"), F.max("id").alias("last")).filter("head < last")
    members = kept(banded.join(buckets.select("key", "head"), "key").distinct(), "members")
    active = kept(classes.join(members.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"]), "active")

    stars = members.filter("head < id").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    probable = kept(_signature_filter(stars, active, settings), "probable")
    wanted = probable.select(F.col("a").alias("id")).unionByName(probable.select(F.col("b").alias("id"))).distinct()
    sets = kept(_full_sets(docs, wanted, settings, id_col, text_col, repeated).dropDuplicates(["id"]), "sets")
    links = kept(_confirm(probable, sets, settings.percent), "confirmed")
    grouped = components(links)

    # buckets whose members are still in several components
    placed = members.join(grouped.withColumnRenamed("node", "id"), "id", "left").select(
        "key", "band", "id", F.coalesce("component", "id").alias("component")
    )
    unsettled = placed.groupBy("key").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("size")
    ).filter("least < most")
    # a pair was compared already if it is the whole bucket
    unsettled = unsettled.filter("size > 2").select("key", "size")
    open_rows = kept(placed.join(unsettled, "key"), "open")
    small = open_rows.filter(F.col("size") <= settings.hot)
    left = small.select("key", F.col("id").alias("a"), F.col("component").alias("ca"))
    right = small.select("key", F.col("id").alias("b"), F.col("component").alias("cb"))
    across = left.join(right, "key").filter("a < b AND ca <> cb").select("a", "b").distinct()
    maybe = kept(_signature_filter(across, active, settings), "maybe")
    hot_rows = open_rows.filter(F.col("size") > settings.hot).select("key", "band", "id", "component")
    more = (
        maybe.select(F.col("a").alias("id"))
        .unionByName(maybe.select(F.col("b").alias("id")))
        .unionByName(hot_rows.select("id"))
        .distinct()
    )
    more_sets = kept(_full_sets(docs, more, settings, id_col, text_col, repeated).dropDuplicates(["id"]), "sets")
    hot = hot_rows.join(active, "id").join(more_sets, "id")
    extra = _confirm(maybe, more_sets, settings.percent).unionByName(_within_blocks(hot, settings).distinct())
    labels = components(grouped.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(extra))

    result = (
        sketch.select("id", "doc", "text_hash", "n_shingles", "same")
        .join(shared, "same", "left")
        .withColumn("node", F.coalesce("head", "id"))
        .join(labels, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    if repeated is None:
        result = result.withColumn("component_id", F.col("component"))
    else:
        # numbers of sets are not ids: the smallest id among the rows of a component
        result = kept(result.select("doc", "text_hash", "n_shingles", "component"), "labelled")
        least = result.groupBy("component").agg(F.min("doc").alias("component_id"))
        result = result.join(least, result["component"].eqNullSafe(least["component"]))
    return result.select(
        F.col("doc").alias("doc_id"),
        "text_hash",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def without_copies(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Documents, with all their columns: one of each group of near duplicates, that with the smallest id.

    Of rows that repeat an id and a text one stays; rows of one id with other texts are judged each by its own. Rows with a null id stay.
    """
    found = kept(_labelled(docs, settings, "doc_id", "text"), "duplicates")
    own_id, own_hash = free_names(docs, "own_id", "own_hash")
    named = [F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash)]
    gone = kept(found.filter("NOT kept").select(*named).distinct(), "gone")
    gone = broadcast_within(gone, gone.count(), 40)
    again = found.filter("doc_id IS NOT NULL").groupBy(*named).count().filter("count > 1").select(own_id, own_hash)
    again = kept(again, "again")
    same = (docs["doc_id"] == F.col(own_id)) & (F.xxhash64(docs["text"]) == F.col(own_hash))
    left = docs.join(gone, same, "left_anti")
    repeated = again.count()
    if not repeated:
        return left
    again = broadcast_within(again, repeated, 40)
    twice = left.withColumn(own_hash, F.xxhash64("text")).withColumn(own_id, F.col("doc_id"))
    once = twice.join(again, [own_id, own_hash], "left_semi").dropDuplicates([own_id, own_hash]).drop(own_id, own_hash)
    return left.join(again, same, "left_anti").unionByName(once)
