"""Web archives: the files, the merge and the index, against plain Python."""

from __future__ import annotations

import gzip
import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from veilmark.llm import warc
from veilmark.llm.scratch import stored

PAGE = "page_id long, url string, html string, captured string, same string, kept string, file string, part string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], PAGE)


def odd_pages():
    long = "<p>" + "é" * 600_000 + "</p>"
    twin = "<html>" + "same words " * 120 + "</html>"
    return [
        (1, "http://www.Example.com/b?z=1&a=2#part", twin),
        (2, "http://example.com/a", twin),
        (7, "https://example.com:8443/a", twin),
        (7, "https://example.com:8443/a", twin),
        (None, "http://example.com/a", twin),
        (3, None, None),
        (4, "", ""),
        (5, "http://x.org/ a\r\nb\tc", "short"),
        (6, "http://x.org/", "short"),
        (8, "http://[broken", long),
        (9, "http://x.org/", long),
        (10, "http://x.org/", "WARC/1.1\r\n\r\nContent-Length: 4\r\n\r\n" * 40),
        (None, None, "z" * 1000),
        (None, None, "z" * 1000),
        (11, "http://x.org/", "z" * 999),
        (12, "http://x.org/", "z" * 999),
    ]


def expected(rows):
    groups = {}
    for page, _, html in rows:
        if len((html or "").encode()) >= 1000 and page is not None:
            groups[html] = max(page, groups.get(html, page))
    found = []
    for page, _, html in rows:
        data = (html or "").encode()
        kept = groups.get(html)
        revisit = kept is not None and kept != page
        found.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", kept if revisit else None))
    return Counter(found)


def test_index_matches_the_definition(spark):
    rows = odd_pages()
    index = warc.capture_index(pages_of(spark, rows), warc.stand_in_time(F.col("page_id")))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(map(tuple, index.select(columns).collect())) == expected(rows)
    assert warc.capture_index(pages_of(spark, []), F.current_timestamp()).count() == 0


def test_archives_are_gzip_members_at_the_listed_places(spark, tmp_path):
    rows = odd_pages()
    files = warc.write_archives(pages_of(spark, rows), warc.stand_in_time(F.col("page_id")), f"file:{tmp_path}", file_records=3)
    listed = {r["file"]: r for r in files.collect()}
    assert all(r["records"] <= 3 for r in listed.values()) and sum(r["records"] for r in listed.values()) == len(rows)
    payloads = {hashlib.sha1((html or "").encode()).hexdigest(): (html or "").encode() for _, _, html in rows}
    for capture in warc.read_runs(files).collect():
        with open(capture["file"].replace("file:", ""), "rb") as f:
            f.seek(capture["offset"])
            text = gzip.decompress(f.read(capture["length"]))
        head, block, payload = text[:-4].split(b"\r\n\r\n", 2)
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
        assert f"Content-Length: {len(block) + 4 + len(payload)}".encode() in head.split(b"\r\n")
        whole = payloads[capture["payload_digest"]]
        assert payload == (whole if capture["record_type"] == "response" else b"") and len(whole) == capture["payload_bytes"]
        assert (b"WARC-Refers-To:" in head) == (capture["record_type"] == "revisit")


def test_damaged_archives_are_refused(spark, tmp_path):
    files = warc.write_archives(pages_of(spark, odd_pages()[:2]), F.lit("2024-01-01").cast("timestamp"), str(tmp_path))
    path = files.first()["file"].replace("file:", "")
    data = open(path, "rb").read()
    stream = iter([data[:40]])
    with pytest.raises(ValueError, match="within a record"):
        list(warc.members(lambda n: next(stream, b"")))
    records = [content for _, _, content in warc.members(_reader(data))]
    response = next(r for r in records if b"WARC-Type: response" in r)
    with pytest.raises(ValueError, match="another payload"):
        warc.parse(response.replace(b"same words", b"some words", 1))
    with pytest.raises(ValueError, match="wrong length"):
        warc.parse(response[:-40])


def _reader(data, step=7):
    place = 0

    def read(_):
        nonlocal place
        place += step
        return data[place - step : place]

    return read


def test_members_in_any_chunks():
    texts = [b"", b"a" * 100_000, bytes(range(256)) * 30]
    data = b"".join(warc._member(t) for t in texts)
    for step in (1, 7, len(data)):
        found = list(warc.members(_reader(data, step)))
        assert [c for _, _, c in found] == texts
        assert [o for o, _, _ in found] == [sum(n for _, n, _ in found[:i]) for i in range(3)]


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 8, 40])
def test_loser_tree_merges_like_sorting(k):
    rng = random.Random(k)
    runs = [sorted((rng.randrange(20), r, i) for i in range(rng.randrange(0, 30))) for r in range(k)]
    assert list(warc.LoserTree(runs)) == sorted(x for run in runs for x in run)


def test_histories_in_one_order_over_many_ranges(spark):
    rng = random.Random(5)
    rows = [(i, "http://www.hot.org/p" if i % 3 == 0 else f"http://h{rng.randrange(40)}.org/{rng.randrange(3)}", f"t{i}") for i in range(900)]
    rng.shuffle(rows)
    pages = pages_of(spark, rows).repartition(6)
    files = warc.write_archives(pages, warc.stand_in_time(F.pmod(F.col("page_id") * 7919, F.lit(500))), file_records=50)
    index = stored(warc.merged_index(warc.read_runs(files), range_rows=60), "index")
    found = sorted(index.collect(), key=lambda r: (r["part"], r["place"]))
    keys = [(r["url_key"], r["captured"], r["page_id"]) for r in found]
    assert keys == sorted(keys) and len({r["page_id"] for r in found}) == 900
    assert len({r["part"] for r in found if r["url_key"] == "org,hot)/p"}) > 3
    seen = Counter()
    for r in found:
        seen[r["url_key"]] += 1
        assert r["capture"] == seen[r["url_key"]]


def test_url_keys():
    assert warc.url_key("HTTP://www2.Sub.Example.com:80/A?b=2&a=1#x") == "com,example,sub)/a?a=1&b=2"
    assert warc.url_key("https://example.com:8443") == "com,example:8443)/"
    assert warc.url_key(None) == warc.url_key("") == "" and warc.url_key("http://[broken") == "http://[broken"
