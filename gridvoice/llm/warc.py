"""Web archives: records written and read by Spark, and an index merged from sorted runs.

Records are joined by empty lines, as the format asks for, into archives of a bounded number of bytes, and Spark's text writer makes a
file of each. The archives are read as whole files. Each archive gives a run of index entries in the
order of URL key and time. Ranges of the key, of a bounded number of entries, then merge their parts of all runs with a loser tree.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridvoice.llm.common import broadcast_within, kept, slices
from gridvoice.sources import scratch

VERSION = "WARC/1.1"
END = "\r\n\r\n"
#: Bytes of an archive; a larger record is an archive of its own.
ARCHIVE_BYTES = 32 << 20
#: Index entries of a range that one task merges.
RANGE_ROWS = 250_000
#: Entries of a run that are taken out of the columns at once.
AHEAD = 64
FIRST_CAPTURE = datetime(2024, 1, 1, tzinfo=timezone.utc)
INDEX = (
    "urlkey string, timestamp string, page_id long, payload_bytes long, payload_digest string, record_type string,"
    " refers_to long, archive string, offset long"
)
COLUMNS = [part.split()[0] for part in INDEX.split(",")]
_TYPES = {"string": pa.string(), "long": pa.int64()}
KINDS = [_TYPES[part.split()[1]] for part in INDEX.split(",")]


def url_key(url: str | None) -> str:
    """Key that puts pages of one host together: host parts reversed, then port, path and query, in lower case."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url.lower()
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "")
    return (key + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")).lower()


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _field(value: str) -> str:
    """A header value: control characters are escaped, so a value never ends its line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, html: str | None, refers_to: int | None) -> str:
    """One record without the empty line after it."""
    payload = (html or "").encode("utf-8", "replace")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}{END}"
    size = len(http) + (0 if refers_to is not None else len(payload))
    when = FIRST_CAPTURE + timedelta(seconds=(page_id or 0) % 10**9)
    head = [
        VERSION,
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {when:%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {size}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_field(url)}")
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(head) + END + http + (payload.decode("utf-8") if refers_to is None else "")


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def entries(content: bytes, archive: str) -> Iterator[tuple]:
    """Index entries of one archive; a payload that does not match its digest raises."""
    at = 0
    while at < len(content):
        stop = content.index(END.encode(), at)
        lines = content[at:stop].decode("utf-8").split("\r\n")
        if lines[0] != VERSION:
            raise ValueError(f"{archive}: no record at {at}")
        head = dict(line.split(": ", 1) for line in lines[1:])
        begin = stop + 4
        body = content[begin : begin + int(head["Content-Length"])]
        http, _, payload = body.partition(END.encode())
        size = int(http.rpartition(b"Content-Length: ")[2])
        own = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if head["WARC-Type"] == "response" and (len(payload) != size or digest(payload) != own):
            raise ValueError(f"{archive}: damaged payload at {at}")
        moment = head["WARC-Date"].translate(str.maketrans("", "", "-:TZ"))
        page, first = _page(head["WARC-Record-ID"]), _page(head.get("WARC-Refers-To"))
        yield url_key(head.get("WARC-Target-URI")), moment, page, size, own, head["WARC-Type"], first, archive, at
        at = begin + len(body) + 4


def order_key(entry: tuple) -> tuple:
    """Order of the index: URL key, time, page; entries without a page first."""
    return entry[0], entry[1], entry[2] is not None, entry[2] or 0


class LoserTree:
    """Merge of k sorted runs: each inner node keeps the loser of its match, so the next winner needs log k matches.

    Of each run only the next entry is held.
    """

    def __init__(self, runs: Iterable[Iterable[tuple]]):
        self.runs = [iter(run) for run in runs]
        k = len(self.runs)
        self.heads, self.keys = [None] * k, [None] * k
        for leaf in range(k):
            self._advance(leaf)
        self.losers = [-1] * max(k, 1)
        for leaf in range(k):
            self._climb(leaf, build=True)

    def _advance(self, leaf: int) -> None:
        self.heads[leaf] = entry = next(self.runs[leaf], None)
        self.keys[leaf] = None if entry is None else order_key(entry)

    def _wins(self, a: int, b: int) -> bool:
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[b] is None and (self.keys[a] is not None or a < b)
        return (self.keys[a], a) < (self.keys[b], b)

    def _climb(self, leaf: int, build: bool = False) -> None:
        winner, node = leaf, (leaf + len(self.runs)) // 2
        while node > 0:
            other = self.losers[node]
            if build and other < 0:
                self.losers[node] = winner
                return
            if other >= 0 and self._wins(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        if not self.runs:
            return
        while self.keys[winner := self.losers[0]] is not None:
            yield self.heads[winner]
            self._advance(winner)
            self._climb(winner)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write a record per row of ``pages(page_id, url, html)``.

    Of records with equal payloads of at least ``least_bytes`` bytes, that with the largest id is the response and the others revisit it.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    plain = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("html")
    ).withColumn("sha", F.when(F.octet_length("html") >= least_bytes, F.sha1(F.col("html").cast("binary"))))
    owners = kept(
        plain.filter("sha IS NOT NULL")
        .groupBy("sha")
        .agg(F.max("page_id").alias("owner"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND owner IS NOT NULL")
        .select("sha", "owner"),
        "owners",
    )
    owners = broadcast_within(owners, owners.count(), 120)
    first = F.when(~F.col("owner").eqNullSafe(F.col("page_id")), F.col("owner"))

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for piece in slices(batch, "html"):
                for row in zip(*(piece.column(c).to_pylist() for c in piece.schema.names)):
                    made = record(*row)
                    own = len(made.encode("utf-8")) + len(END)
                    if held and size + own > limit:
                        yield pa.RecordBatch.from_arrays([pa.array([END.join(held)], pa.string())], names=["value"])
                        held, size = [], 0
                    held.append(made)
                    size += own
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([END.join(held)], pa.string())], names=["value"])

    limit = ARCHIVE_BYTES
    rows = plain.join(owners, "sha", "left").select("page_id", "url", "html", first.alias("refers_to"))
    rows.mapInArrow(run, "value string").write.option("lineSep", END).option("maxRecordsPerFile", 1).text(path)


def runs_of(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all archives under ``path``; those of one archive are in order."""

    def run(batches):
        for batch in batches:
            for archive, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                own = sorted(entries(content.as_buffer().to_pybytes(), archive.rsplit("/", 1)[-1]), key=order_key)
                yield _batch(own)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, INDEX)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(COLUMNS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, KINDS)], names=COLUMNS)


def merged(runs: DataFrame) -> DataFrame:
    """All index entries in the order of URL key, time and page, across partitions.

    A range of keys is one partition, of ``RANGE_ROWS`` entries or so. There the entries of each archive arrive as a sorted run. A task holds
    its range as columns, and the entries that come next of each run.
    """

    def run(batches):
        held = list(batches)
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        if not rows.num_rows:
            return
        of = rows.column("archive").chunk(0).dictionary_encode().indices.to_numpy()
        bounds = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]])).tolist()

        def entries_of(start: int, stop: int) -> Iterator[tuple]:
            for at in range(start, stop, AHEAD):
                some = rows.slice(at, min(AHEAD, stop - at))
                yield from zip(*(some.column(c).to_pylist() for c in COLUMNS))

        out: list[tuple] = []
        for row in LoserTree(entries_of(a, b) for a, b in zip(bounds, bounds[1:])):
            out.append(row)
            if len(out) == 8192:
                yield _batch(out)
                out = []
        yield _batch(out)

    least = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(least, math.ceil(runs.count() / RANGE_ROWS))
    order = ["urlkey", "timestamp", "page_id"]
    ranged = runs.repartitionByRange(ranges, *order)
    return ranged.sortWithinPartitions("archive", *order).mapInArrow(run, INDEX)


def captures(pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives under ``path``, read them back, and return the merged index.

    ``urlkey, timestamp, page_id, payload_bytes, payload_digest, record_type, refers_to, archive, offset``

    A null payload is an empty one. A null url has an empty key and no target in its record. Rows that repeat an id are records
    of their own; if theirs is the largest id of the payload, all of them are responses. A null id is never referred to. Other columns are ignored. An
    empty table gives an empty index.
    """
    spark = pages.sparkSession
    path = path or scratch.new_path(spark, "archives")
    write_archives(pages, path, least_bytes)
    return merged(kept(runs_of(spark, path), "index"))
