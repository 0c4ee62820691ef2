"""Archives are written, read back and merged."""

import base64
import hashlib
import random

from gridvoice.llm import warc

PAGES = "page_id long, url string, html string, sha string, owner string, value string, path string, refers_to string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], PAGES)


def brute(rows, least=0):
    best = {}
    for page, _, html in rows:
        payload = (html or "").encode()
        if len(payload) >= least and page is not None:
            best[payload] = max(best.get(payload, page), page)
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        first = best.get(payload) if len(payload) >= least else None
        first = None if first == page else first
        sha = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page, len(payload), sha, "response" if first is None else "revisit", first))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a.org/x", "<p>é</p>"),
    (2, "https://www.a.org:443/X?q=1#top", "<p>é</p>"),
    (3, None, None),
    (4, "http://b.org", ""),
    (5, "bad\r\nWARC-Type: fake", "line\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (6, "http://[broken", "\r\n"),
    (7, "", "x" * 200_000),
    (7, "http://a.org/again", "x" * 200_000),
    (None, "http://c.org", "<p>é</p>"),
    (None, "http://c.org", "only here"),
]


def test_round_trip(few):
    got = warc.captures(frame(few, ROWS)).collect()
    keys = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[k] for k in keys) for r in got), key=repr) == brute(ROWS)
    assert [warc.order_key(tuple(r)) for r in got] == sorted(warc.order_key(tuple(r)) for r in got)


def test_archives_are_bounded_by_bytes(few, tmp_path, monkeypatch):
    """Pages of up to 3 MB, in few partitions; many runs meet in ranges of few entries."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1 << 20)
    monkeypatch.setattr(warc, "RANGE_ROWS", 40)
    rng = random.Random(4)
    sizes = [3_000_000, 2_000_000, 900_000] + [rng.randrange(200_000) for _ in range(60)]
    rows = [(n, f"http://h{n % 3}.org/{n % 7}", chr(97 + n % 26) * size) for n, size in enumerate(sizes)]
    rows += [(200 + n, "http://hot.org", "é" * 1000) for n in range(300)]
    got = warc.captures(frame(few, rows).coalesce(2), str(tmp_path / "archives")).collect()
    keys = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[k] for k in keys) for r in got), key=repr) == brute(rows)
    assert [warc.order_key(tuple(r)) for r in got] == sorted(warc.order_key(tuple(r)) for r in got)
    files = [p for p in (tmp_path / "archives").glob("*.txt")]
    assert len(files) > 5 and len({r["archive"] for r in got}) == len(files)
    large = [p for p in files if p.stat().st_size > 1 << 20]
    assert len(large) == 2 and all(p.read_bytes().count(b"WARC-Type: ") == 1 for p in large)


def test_small_payloads_do_not_revisit(few):
    got = warc.captures(frame(few, ROWS), least_bytes=9).collect()
    assert sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in got), key=repr) == sorted(
        ((r[0], r[3], r[4]) for r in brute(ROWS, 9)), key=repr
    )


def test_empty_table(few):
    assert warc.captures(frame(few, [])).count() == 0


def test_url_keys():
    assert warc.url_key("http://www.Blog.Example.com:80/A/b?C=d#f") == "com,example,blog)/a/b?c=d"
    assert warc.url_key("https://example.com:8080") == "com,example:8080)/"
    assert warc.url_key(None) == warc.url_key("") == ""


def test_loser_tree():
    rng = random.Random(2)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = []
        for name in range(k):
            own = [(rng.choice("abc"), str(rng.randrange(5)), rng.choice([None, 1, 2]), name) for _ in range(rng.randrange(9))]
            runs.append(sorted(own, key=warc.order_key))
        merged = list(warc.LoserTree(runs))
        assert [warc.order_key(r) for r in merged] == sorted(warc.order_key(r) for run in runs for r in run)
        assert len(merged) == sum(map(len, runs))


def test_loser_tree_holds_one_entry_of_a_run():
    taken = []

    def run(name):
        for n in range(5):
            taken.append(name)
            yield ("a", str(n), name)

    tree = iter(warc.LoserTree(run(name) for name in range(4)))
    next(tree)
    assert len(taken) == 4
    assert len(list(tree)) == 19


def test_damage_is_found():
    good = (warc.record(1, "http://a.org", "abc", None) + warc.END).encode()
    assert [e[2] for e in warc.entries(good, "x")] == [1]
    try:
        list(warc.entries(good.replace(b"abc", b"abd"), "x"))
    except ValueError:
        return
    raise AssertionError("a changed payload was accepted")
