"""Web archives: WARC files written by tasks, read back, and one capture index merged from sorted runs.

``write_archives`` writes a response per page, or a revisit where an equal payload of at least ``REVISIT_FROM`` bytes
stands under a larger ``page_id``.  Every record is a gzip member of its own.  A task names its files at random and lists
them in a table that Spark commits, so files of failed or repeated attempts are never read.

``read_runs`` reads the listed files back record by record, checks lengths and digests, and sorts each file's captures
by URL key and time: one run per file, bounded by ``FILE_RECORDS``.

``merged_index`` deals the runs out by ranges of (URL key, time, ...); a task merges its parts of the runs with a loser
tree.  ``part`` and ``place`` give the global order; ``capture`` numbers the captures of a URL key.  A key with very many
captures spreads over several ranges, as time and record are part of the order; what carries over between ranges is one
row per range and key.

Nulls: a null html is an empty payload.  A null url is left out of the record and comes back null, with the key ''.  A
row without ``page_id`` is never revisited while its group has an id; rows of a group without any id are all responses.
Ties: rows that repeat the largest ``page_id`` of a group are all responses.  Repeated rows write their record again under
the same record id.  Control characters and spaces in a url are written as %XX and come back so.  A payload of any length
is one record; it is held whole by the task, as it is in its row.  An empty table gives an empty index.  Columns other
than ``page_id, url, html`` and the given time are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import folder, stored
from .words import slices

#: Payloads of fewer bytes are always written out.
REVISIT_FROM = 1000
#: A file is closed after this many bytes or records.
FILE_BYTES, FILE_RECORDS = 64 << 20, 20_000
#: Captures that a range of the index is meant to hold.
RANGE_ROWS = 100_000
#: Bytes read at once from an archive.
READ = 1 << 20

VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = "file string, records long, bytes long"
CAPTURES = (
    "url_key string, captured timestamp, url string, page_id long, record_type string, payload_bytes long, "
    "payload_digest string, refers_to long, file string, offset long, length long, position long"
)


def decided(pages: DataFrame, captured: Column) -> DataFrame:
    """``page_id, url, captured, payload, kept_id, kept_url, kept_at``; the last three say what a revisit refers to."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", captured.alias("captured"), payload.alias("payload"))
    rows = rows.withColumn("same", F.unhex(F.sha2("payload", 256)))
    large = rows.filter(F.octet_length("payload") >= REVISIT_FROM)
    kept = F.max(F.struct("page_id", "url", "captured")).alias("kept")
    groups = large.groupBy("same").agg(kept, F.count(F.lit(1)).alias("n")).filter("n > 1 AND kept.page_id IS NOT NULL")
    groups = stored(groups.select("same", "kept"), "equal-payloads")
    joined = rows.join(groups, "same", "left")
    revisit = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept.page_id"))
    refers = [F.when(revisit, F.col(f"kept.{c}")).alias(a) for c, a in (("page_id", "kept_id"), ("url", "kept_url"), ("captured", "kept_at"))]
    return joined.select("page_id", "url", "captured", "payload", *refers)


def _open(location: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a folder or file, local paths and file: with one slash included."""
    return arrow_fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", location))


def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)


def _date(at: datetime) -> str:
    return at.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def _record_id(page_id: int | None, digest: bytes) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest.hex()}>"


def _headers(fields: list[tuple[str, str | None]], first: str) -> bytes:
    lines = [first, *(f"{name}: {value}" for name, value in fields if value is not None)]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def record(page: dict) -> bytes:
    """The WARC record of a row of ``decided``."""
    payload = page["payload"]
    digest = hashlib.sha1(payload).digest()
    revisit = page["kept_id"] is not None
    block = _headers([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))], "HTTP/1.1 200 OK")
    if not revisit:
        block += payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page["page_id"], digest)),
        ("WARC-Date", _date(page["captured"])),
        ("WARC-Target-URI", None if page["url"] is None else _uri(page["url"])),
        ("WARC-Payload-Digest", f"sha1:{base64.b32encode(digest).decode()}"),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", _record_id(page["kept_id"], digest) if revisit else None),
        ("WARC-Refers-To-Target-URI", _uri(page["kept_url"]) if revisit and page["kept_url"] is not None else None),
        ("WARC-Refers-To-Date", _date(page["kept_at"]) if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return _headers(fields, VERSION) + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    return zlib.compress(data, 6, 31)


def _write(location: str, file_bytes: int, file_records: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(location)
        system.create_dir(base, recursive=True)
        out, name, records, size, done = None, "", 0, 0, []
        try:
            for batch in slices(batches, 64):
                for page in batch.to_pylist():
                    if out is None:
                        name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = system.open_output_stream(f"{base}/{name}", compression=None)
                    member = _member(record(page))
                    out.write(member)
                    records, size = records + 1, size + len(member)
                    if size >= file_bytes or records >= file_records:
                        out.close()
                        out = None
                        done.append({"file": name, "records": records, "bytes": size})
        finally:
            if out is not None:
                out.close()
                done.append({"file": name, "records": records, "bytes": size})
        if done:
            yield pa.RecordBatch.from_pylist(done)

    return run


def write_archives(
    pages: DataFrame, captured: Column, location: str | None = None, file_bytes: int = FILE_BYTES, file_records: int = FILE_RECORDS
) -> DataFrame:
    """Write the archives of ``pages`` (``page_id, url, html``) and return the list of files, ``file, records, bytes``.

    ``location`` is a folder that every executor can write to (local, hdfs, s3 or gs as Arrow knows them); by default one
    below the shared folder, deleted with the other intermediate tables.
    """
    location = location or folder(pages.sparkSession, "archives")
    written = decided(pages, captured).mapInArrow(_write(location, file_bytes, file_records), FILES)
    return stored(written.withColumn("file", F.concat(F.lit(location.rstrip("/") + "/"), "file")), "archive-files")


def members(read: Callable[[int], bytes]) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of each gzip member of a stream."""
    offset, rest = 0, b""
    while True:
        rest = rest or read(READ)
        if not rest:
            return
        unpack, content, length = zlib.decompressobj(31), [], 0
        while not unpack.eof:
            if not rest:
                rest = read(READ)
                if not rest:
                    raise ValueError("an archive ends within a record")
            content.append(unpack.decompress(rest))
            length += len(rest) - len(unpack.unused_data)
            rest = unpack.unused_data
        yield offset, length, b"".join(content)
        offset += length


def _fields(head: bytes, first: str) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith(first):
        raise ValueError(f"a record starts with {lines[0][:40]!r}")
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}


def _page_of(record_id: str) -> int | None:
    page = record_id.split(":")[2]
    return int(page) if page else None


def url_key(url: str | None) -> str:
    """Sort-friendly key: host names reversed, without scheme, www, user, default port and fragment, lower case."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.lower()
    host = re.sub(r"^www\d*\.", "", host)
    shown = "" if port in (None, 80, 443) else f":{port}"
    query = f"?{'&'.join(sorted(parts.query.split('&')))}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{shown}){parts.path or '/'}{query}".lower()


def parse(content: bytes) -> dict:
    """A capture from one record, its length and digest checked."""
    head, _, body = content.partition(b"\r\n\r\n")
    fields = _fields(head, "WARC/")
    size = int(fields["content-length"])
    block, tail = body[:size], body[size:]
    if len(block) != size or tail != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('warc-record-id')} has a wrong length")
    inner, _, payload = block.partition(b"\r\n\r\n")
    told = int(_fields(inner, "HTTP/")["content-length"])
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:"))
    if fields["warc-type"] == "response" and (len(payload) != told or hashlib.sha1(payload).digest() != digest):
        raise ValueError(f"record {fields['warc-record-id']} has another payload than its digest says")
    url = fields.get("warc-target-uri")
    refers = fields.get("warc-refers-to")
    return {
        "url_key": url_key(url),
        "captured": datetime.fromisoformat(fields["warc-date"]),
        "url": url,
        "page_id": _page_of(fields["warc-record-id"]),
        "record_type": fields["warc-type"],
        "payload_bytes": told,
        "payload_digest": digest.hex(),
        "refers_to": None if refers is None else _page_of(refers),
    }


_RUN = pa.schema(
    [
        ("url_key", pa.string()), ("captured", pa.timestamp("us", "UTC")), ("url", pa.string()), ("page_id", pa.int64()),
        ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("refers_to", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
        ("position", pa.int64()),
    ]
)


def _order(capture: dict) -> tuple:
    page = capture["page_id"]
    # UTF-8 bytes compare like code points, as Spark's strings do; a null id comes first, as in Spark.
    return capture["url_key"], capture["captured"], page is not None, page or 0, capture["file"], capture["offset"]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for listed in batch.to_pylist():
            system, path = _open(listed["file"])
            with system.open_input_stream(path, compression=None) as stream:
                found = [
                    {**parse(content), "file": listed["file"], "offset": offset, "length": length}
                    for offset, length, content in members(stream.read)
                ]
            if len(found) != listed["records"]:
                raise ValueError(f"{listed['file']} holds {len(found)} of {listed['records']} records")
            found.sort(key=_order)
            for position, capture in enumerate(found):
                capture["position"] = position
            for start in range(0, len(found), 4096):
                yield pa.RecordBatch.from_pylist(found[start : start + 4096], _RUN)


def read_runs(files: DataFrame) -> DataFrame:
    """Captures of the listed archives, each file's in order of URL key and time (``position``)."""
    spread = files.repartition(max(1, min(files.count(), 10_000)), "file")
    return stored(spread.mapInArrow(_read, CAPTURES), "capture-runs")


class LoserTree:
    """Merge of k sorted runs: inner nodes keep the losers, so each step replays one path of log2 k matches."""

    _END = object()

    def __init__(self, runs: list):
        self.runs = [iter(run) for run in runs]
        self.heads = [next(run, self._END) for run in self.runs]
        k = len(runs)
        self.losers = [0] * k
        winners = [0] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            left, right = winners[2 * node], winners[2 * node + 1]
            won = self._before(left, right)
            winners[node], self.losers[node] = (left, right) if won else (right, left)
        self.winner = winners[1] if k else None

    def _before(self, a: int, b: int) -> bool:
        if self.heads[a] is self._END:
            return False
        return self.heads[b] is self._END or self.heads[a] < self.heads[b]

    def __iter__(self):
        k = len(self.runs)
        while self.winner is not None and self.heads[self.winner] is not self._END:
            winner = self.winner
            yield self.heads[winner]
            self.heads[winner] = next(self.runs[winner], self._END)
            node = (winner + k) // 2
            while node:
                if self._before(self.losers[node], winner):
                    self.losers[node], winner = winner, self.losers[node]
                node //= 2
            self.winner = winner


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    held = list(batches)
    if not sum(b.num_rows for b in held):
        return
    rows = pa.Table.from_batches(held)
    # Runs as slices of one permutation; a run's rows may have come in several blocks.
    codes = rows.column("file").combine_chunks().dictionary_encode().indices.to_numpy()
    by_run = np.lexsort((rows.column("position").to_numpy(), codes))
    edges = np.concatenate([[0], np.flatnonzero(np.diff(codes[by_run])) + 1, [len(by_run)]])
    keys, times, pages, files, offsets = (
        rows.column(c).to_pylist() for c in ("url_key", "captured", "page_id", "file", "offset")
    )

    def run(a: int, b: int):
        for i in by_run[a:b].tolist():
            yield keys[i], times[i], pages[i] is not None, pages[i] or 0, files[i], offsets[i], i

    order = np.fromiter((head[-1] for head in LoserTree([run(a, b) for a, b in zip(edges, edges[1:])])), np.int64, len(rows))
    nth, last, seen = np.zeros(len(order), np.int64), None, 0
    for place, i in enumerate(order.tolist()):
        seen, last = (seen + 1 if keys[i] == last else 1), keys[i]
        nth[place] = seen
    part = TaskContext.get().partitionId()
    merged = rows.take(pa.array(order)).drop_columns(["position"])
    merged = merged.append_column("part", pa.array(np.full(len(order), part, np.int32)))
    merged = merged.append_column("place", pa.array(np.arange(len(order)))).append_column("nth", pa.array(nth))
    yield from merged.combine_chunks().to_batches(4096)


def merged_index(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Captures of all runs in one order by URL key and time.

    ``url_key, captured, url, page_id, record_type, payload_bytes, payload_digest, refers_to, file, offset, length, part,
    place, capture``: order by ``part, place``; ``capture`` counts a key's captures from 1.
    """
    spark = runs.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // range_rows))
    dealt = runs.repartitionByRange(ranges, "url_key", "captured", "page_id", "file", "offset")
    schema = CAPTURES.replace(", position long", "") + ", part int, place long, nth long"
    merged = stored(dealt.mapInArrow(_merge, schema), "capture-index")
    counts = merged.groupBy("url_key", "part").agg(F.max("nth").alias("n"))
    # A key with one range only has nothing to carry.
    spread = counts.groupBy("url_key").agg(F.array_sort(F.collect_list(F.struct("part", "n"))).alias("parts")).filter(F.size("parts") > 1)
    spread = spread.select("url_key", F.posexplode("parts").alias("i", "own"), "parts")
    before = F.aggregate(F.slice("parts", 1, F.col("i")), F.lit(0).cast("long"), lambda total, p: total + p["n"])
    carried = spread.select("url_key", F.col("own.part").alias("part"), before.alias("carried"))
    numbered = merged.join(carried, ["url_key", "part"], "left")
    columns = [f.name for f in merged.schema if f.name != "nth"]
    return numbered.select(*columns, (F.col("nth") + F.coalesce("carried", F.lit(0))).alias("capture"))


def capture_index(pages: DataFrame, captured: Column) -> DataFrame:
    """Write ``pages`` to archives, read them back and merge their index."""
    return merged_index(read_runs(write_archives(pages, captured)))


def stand_in_time(page_id: Column) -> Column:
    """A capture time for tables that have none: a second per ``page_id`` from 2020 on, repeating after three years."""
    return F.timestamp_seconds(F.lit(1_577_836_800) + F.coalesce(F.pmod(page_id.cast("long"), F.lit(100_000_000)), F.lit(0)))
