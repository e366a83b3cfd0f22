"""WARC archives: writing, reading back, and capture histories by an external merge of sorted index runs.

Writing: each capture becomes one WARC/1.1 record. Of captures with equal payloads that with the largest id is a
``response``, the others are ``revisit`` records without payload that name it. Each record is a gzip member of its own (several for a record of
``MEMBER_BYTES`` or more), so a record can be fetched by its offset and length in the file. The files, of about ``FILE_BYTES`` payload, are written by
Spark's own writer: any store that Spark writes to will do, and a lost task is simply repeated. That writer ends each row with a byte, here zero: the last byte of a
gzip member, the top of its length.

Reading: the files are parsed member by member. A task sorts index entries by URL key and timestamp, ``RUN_ROWS`` at a time; such a *run* is written to the shared folder.
The entries are then dealt by key range (URL key, timestamp, id, place in the archive, so one hot URL is split too) to as many ranges as there are ``RANGE_ROWS``. A range takes its part of every run as
blocks and merges them by a loser tree, which reads the keys of a run some rows at a time. The ranges in order are the globally ordered capture histories.

Defined results: null html is an empty payload; null url is the empty key; payloads of equal bytes count as equal from
``min_revisit`` bytes; equal ids with equal payloads are ordered by URL, timestamp and place in the input, so that exactly one row is the response; repeated rows
are each written; only page_id, url, captured and payload (or html) are read, whatever other columns there are; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uelumen.llm.common import map_texts, scratch_path, stage_table

FILE_BYTES = 16 << 20
MEMBER_BYTES = 8 << 20
LEVEL = 3
READ_BYTES = 16 << 10
RUN_ROWS = 100_000
RANGE_ROWS = 200_000
MERGE_KEYS = 1 << 16
OUT_ROWS = 10_000
EPOCH = 1_577_836_800  # 2020-01-01: captures without a time are one second apart by id
ENTRY = (
    "url_key string, captured string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, file string, offset long, length long"
)
RUN_ENTRY = ENTRY + ", run long"


def url_key(url: Column) -> Column:
    """Sort key of a URL: host labels reversed, then path and query, lower case, without scheme, ``www.``, port or fragment."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"#.*$", ""), r"^[a-z][a-z0-9+.-]*://(www\d*\.)?", "")
    host = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*", 0), r":\d+$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_replace(bare, r"^[^/?]*", ""))


def _base32(hex_digest: Column) -> Column:
    """Upper-case base32 of a SHA-1 in hex: 40 hex digits are 8 groups of 5, each 4 base32 digits."""
    groups = [F.lpad(F.conv(F.substring(hex_digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(captures: DataFrame, *, min_revisit: int = 0) -> DataFrame:
    """``record`` (binary) of each capture; columns page_id, url, captured (timestamp), payload (binary) are read."""
    named = captures.select("page_id", "url", "captured", "payload", F.monotonically_increasing_id().alias("place")).withColumn("hex", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    named = named.withColumn("digest", _base32(F.upper("hex")))
    rank = F.struct(F.col("page_id"), F.col("url"), F.col("captured"), F.col("place"))
    groups = named.filter(F.col("size") >= min_revisit).groupBy("digest").agg(F.max(rank).alias("first"), F.count("*").alias("n")).filter("n > 1")
    judged = named.join(groups.select("digest", "first"), "digest", "left")
    revisit = F.col("first").isNotNull() & (F.col("place") != F.col("first.place"))
    uri, first_uri = _clean(F.col("url")), _clean(F.col("first.url"))
    stamp = F.date_format("captured", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit("\r\n\r\n"))
    body = F.when(revisit, http.cast("binary")).otherwise(F.concat(http.cast("binary"), F.col("payload")))
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("WARC-Date: "), stamp),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"), F.coalesce(F.col("first.page_id").cast("string"), F.lit("")), F.lit(">\r\nWARC-Refers-To-Target-URI: "), first_uri)),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("X-URL-Key: "), url_key(uri)),
        F.concat(F.lit("Content-Length: "), F.octet_length(body), F.lit("\r\n\r\n")),
    )
    return judged.select(F.concat(head.cast("binary"), body, F.lit("\r\n\r\n").cast("binary")).alias("record"))


def _clean(url: Column) -> Column:
    """A URL without characters that would end a header line."""
    return F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]", "")


def members(record: bytes) -> bytes:
    """A record as gzip."""
    out = []
    for i in range(0, len(record), MEMBER_BYTES):
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        out += [packer.compress(record[i : i + MEMBER_BYTES]), packer.flush()]
    return b"".join(out)


def write(captures: DataFrame, path: str, *, min_revisit: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """Write the archive files. The writer ends each row with a zero byte, that which a member of less than 16 MB ends with."""
    mean = captures.agg(F.avg(F.octet_length("payload"))).first()[0] or 0.0
    rows = max(1, int(file_bytes / (mean + 600)))

    def kernel(batch: pa.RecordBatch) -> dict:
        return {"member": pa.array([members(r.as_py())[:-1] for r in batch.column("record")], pa.binary())}

    made = map_texts(records(captures, min_revisit=min_revisit), kernel, "member binary")
    made.select(F.col("member").cast("string").alias("value")).write.option("maxRecordsPerFile", rows).option("lineSep", "\0").text(path)


def _member(view: memoryview, at: int) -> tuple[bytes, int]:
    """The content of the gzip member that starts at ``at``, and where it ends."""
    packed, parts = zlib.decompressobj(31), []
    while not packed.eof:
        chunk = view[at : at + READ_BYTES]
        if not len(chunk):
            raise ValueError("the archive ends inside a member")
        parts.append(packed.decompress(chunk))
        at += len(chunk) - len(packed.unused_data)
    return b"".join(parts), at


def unpack(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record whose first gzip member starts at ``at``, and where the next record starts."""
    view = memoryview(data)
    part, after = _member(view, at)
    parts, held, end = [part], len(part), part.index(b"\r\n\r\n")
    head = dict(line.split(": ", 1) for line in part[:end].decode().split("\r\n")[1:])
    size = end + 8 + int(head["Content-Length"])
    while held < size:
        part, after = _member(view, after)
        parts.append(part)
        held += len(part)
    record = b"".join(parts)
    if held != size or record[-4:] != b"\r\n\r\n":
        raise ValueError(f"the record at {at} does not end as it should")
    return head, record[end + 4 : -4], after


def parse(file: str, data: bytes) -> Iterator[tuple]:
    """Index entries of an archive file, in file order."""
    at = 0
    while at < len(data):
        head, body, after = unpack(data, at)
        http_end = body.index(b"\r\n\r\n")
        told = int(next(line for line in body[:http_end].split(b"\r\n") if line.startswith(b"Content-Length: "))[16:])
        kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response":
            verify(file, at, body[http_end + 4 :], told, digest)
        yield (
            head["X-URL-Key"], head["WARC-Date"], _page(head["WARC-Record-ID"]), head["WARC-Target-URI"], kind, told, digest,
            _page(head["WARC-Refers-To"]) if kind == "revisit" else None, file, at, after - at,
        )
        at = after


def verify(file: str, at: int, payload: bytes, told: int, digest: str) -> None:
    """A response must hold the payload that its headers describe."""
    if len(payload) != told or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"{file}: the payload at {at} is not what its headers say")


def _page(urn: str) -> int | None:
    text = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def _order(entry: tuple) -> tuple:
    return entry[0], entry[1], entry[2] is not None, entry[2] or 0, entry[8], entry[9]


class LoserTree:
    """K-way merge: inner nodes hold the loser of each match, the winner goes on; a step replays one path."""

    def __init__(self, runs: list[Iterable[tuple]], key: Callable[[tuple], tuple]):
        self.runs, self.key = [iter(r) for r in runs], key
        self.heads = [next(r, None) for r in self.runs]
        self.keys = [None if h is None else key(h) for h in self.heads]
        k = len(runs)
        self.loser = [0] * max(1, k)
        winners = [0] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.loser[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1] if k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        if self.keys[b] is None:
            return True
        return self.keys[a] is not None and self.keys[a] <= self.keys[b]

    def __iter__(self) -> Iterator[tuple]:
        k = len(self.runs)
        while k and (head := self.heads[self.winner]) is not None:
            yield head
            w = self.winner
            self.heads[w] = next(self.runs[w], None)
            self.keys[w] = None if self.heads[w] is None else self.key(self.heads[w])
            node = (w + k) // 2
            while node:
                if not self._before(w, self.loser[node]):
                    w, self.loser[node] = self.loser[node], w
                node //= 2
            self.winner = w


_ARROW = pa.schema([(n, pa.int64() if k == "long" else pa.string()) for n, k in (c.split() for c in RUN_ENTRY.split(", "))])
_KEY = ["url_key", "captured", "page_id", "file", "offset"]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs of the entries of a task, each with a number of its own."""
    number = TaskContext.get().partitionId() << 20
    entries: list[tuple] = []

    def run() -> Iterator[pa.RecordBatch]:
        nonlocal number
        entries.sort(key=_order)
        for i in range(0, len(entries), OUT_ROWS):
            columns = zip(*((*e, number) for e in entries[i : i + OUT_ROWS]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)
        number += 1
        entries.clear()

    for batch in batches:
        for file, data in zip(batch.column("path").to_pylist(), batch.column("content")):
            for entry in parse(file.rsplit("/", 1)[-1], data.as_py()):
                entries.append(entry)
                if len(entries) == RUN_ROWS:
                    yield from run()
    yield from run()


def _keys(run: pa.Table, first: int, rows: int) -> Iterator[tuple]:
    """Key and place of each row of a run, read ``rows`` at a time."""
    for at in range(0, run.num_rows, rows):
        part = run.slice(at, rows)
        url, stamp, page, file, offset = (part.column(n).to_pylist() for n in _KEY)
        yield from zip(url, stamp, [p is not None for p in page], [p or 0 for p in page], file, offset, range(first + at, first + at + len(url)))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge one key range."""
    runs: dict[int, list[pa.RecordBatch]] = {}
    for batch in batches:
        number = batch.column("run").to_numpy()
        cuts = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(number)]
        for i, j in zip(cuts, cuts[1:]):
            if i < j:
                runs.setdefault(int(number[i]), []).append(batch.slice(i, j - i))
    sorting = [(n, "ascending") for n in _KEY]
    tables = []
    for parts in runs.values():
        table = pa.Table.from_batches(parts)
        tables.append(table if len(parts) == 1 else table.sort_by(sorting, null_placement="at_start"))  # of one run the shuffle hands on blocks in any order
    if not tables:
        return
    whole, firsts = pa.concat_tables(tables).combine_chunks(), np.cumsum([0] + [t.num_rows for t in tables])
    rows = max(16, MERGE_KEYS // len(tables))
    places: list[int] = []
    kept = whole.drop_columns(["run"])

    def taken() -> Iterator[pa.RecordBatch]:
        yield from kept.take(pa.array(places, pa.int64())).combine_chunks().to_batches()
        places.clear()

    for entry in LoserTree([_keys(t, int(f), rows) for t, f in zip(tables, firsts)], key=lambda e: e[:-1]):
        places.append(entry[-1])
        if len(places) == OUT_ROWS:
            yield from taken()
    if places:
        yield from taken()


def read_index(spark, path: str) -> DataFrame:
    """Index entries of all archive files, in sorted runs."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_runs, RUN_ENTRY)


def histories(index: DataFrame) -> DataFrame:
    """The entries of a table of runs in global order of (url_key, captured, page_id), range by range."""
    ranges = max(1, -(-index.count() // RANGE_ROWS))
    return index.repartitionByRange(ranges, *_KEY).mapInArrow(_merge, ENTRY)


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as an archive in the shared folder and read its histories back."""
    spark = pages.sparkSession
    captures = pages.select(
        "page_id", "url", F.timestamp_seconds(F.lit(EPOCH) + F.coalesce("page_id", F.lit(0)) % (1 << 31)).alias("captured"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")
    )
    path = scratch_path(spark, "warc")
    write(captures, path)
    index = stage_table(read_index(spark, path), "runs")
    return histories(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "file", "offset", "length")


_GROUPS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(h, {1 + 5 * i}, 5))::INT >> {shift}) % 32 + 1, 1)" for i in range(8) for shift in (15, 10, 5, 0))

#: What the records of ``pages`` say, in DuckDB; 5 hex digits of a SHA-1 are 4 base32 digits.
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload, row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS r, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages),
d AS (SELECT *, sha1(payload) AS h FROM p)
SELECT page_id, octet_length(payload) AS payload_bytes, {_GROUPS} AS payload_digest, CASE WHEN r = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN r > 1 THEN top END AS refers_to FROM d
"""
