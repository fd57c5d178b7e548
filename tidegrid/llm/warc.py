"""WARC archives of pages: writing with revisit records, reading back, and the merged capture index.

Every record is a gzip member of its own, so that a record can be read from its offset alone, and a file is a plain gzipped
WARC file. Spark's text sink writes the members: each ends in a zero byte, which is the sink's line separator. Files are
bounded in bytes and read back one by one, record by record.

The index is an external merge. Every task sorts the captures it reads into runs and cuts each run at common splitters;
every range of keys then merges its pieces of all runs with a loser tree. Ranges in order, and positions in a range, give
the captures of the whole archive by URL key and time.
"""

from __future__ import annotations

import bisect
import hashlib
import io
import zlib
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.batches import with_id
from tidegrid.session import scratch_path, stored

#: Payloads shorter than this are always stored in full.
REVISIT_BYTES = 1000
#: Compressed bytes after which a task begins another archive file (a larger record has a file of its own), and bytes that are
#: handed to the decompressor at once.
FILE_BYTES, STEP_BYTES = 32_000_000, 16_384
#: Captures of a sorted run and of a merged range, and sampled keys for each range the splitters come from.
RUN_ROWS, RANGE_ROWS, RANGE_KEYS = 50_000, 50_000, 10
#: Places that pages too short to be revisits spread over when pages meet by digest.
SPREAD = 65_536

# Fixed values of the format.
_END = "\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD_ID = "urn:x-page:"


# ---- writing ------------------------------------------------------------------------------------------------------


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, payload, payload_bytes, payload_digest, refers_to)``; ``refers_to`` is missing for responses.

    Of the pages with one payload of at least 1000 bytes, those with the largest id are responses and the others revisit
    them. A page without id revisits if one with an id has its payload. A missing payload counts as empty.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("payload"))
    rows = (rows.withColumn("payload_bytes", F.octet_length("payload").cast("bigint"))
            .withColumn("payload_digest", F.sha1(F.encode("payload", "UTF-8"))))
    long = F.col("payload_bytes") >= REVISIT_BYTES
    again = (rows.filter(long).groupBy(F.col("payload_digest").alias("meet")).agg(F.max("id").alias("largest"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").drop("n"))
    # Short payloads meet nothing, and would all meet in few places by their digests.
    apart = F.concat(F.lit("short "), F.pmod(F.xxhash64("id", "url", "payload_digest"), F.lit(SPREAD)).cast("string"))
    return (rows.withColumn("meet", F.when(long, F.col("payload_digest")).otherwise(apart)).join(again, "meet", "left")
            .withColumn("refers_to", F.when(long & ~F.col("id").eqNullSafe(F.col("largest")), F.col("largest")))
            .drop("largest", "meet"))


def packed_record(record: bytes) -> bytes:
    """A record as gzip member without its last byte, which is zero."""
    member = zlib.compress(record, 6, 31)
    if member[-1]:  # 16 MB or more: the length ends in another byte; an empty member after it ends in zeros
        member += zlib.compress(b"", 6, 31)
    return member[:-1]


def _pack(file_bytes: int):
    """Members of a task's records, with the number of the file each is for."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        volume = size = 0
        for rows in batches:
            volumes, members, waiting = [], [], 0
            for record in rows["record"]:
                member = packed_record(record)
                if size and size + len(member) > file_bytes:
                    volume, size = volume + 1, 0
                size, waiting = size + len(member) + 1, waiting + len(member)
                volumes.append(volume)
                members.append(member)
                if waiting > file_bytes:
                    yield pd.DataFrame({"volume": volumes, "member": members})
                    volumes, members, waiting = [], [], 0
            yield pd.DataFrame({"volume": volumes, "member": members})

    return run


def write_archives(records: DataFrame, path: str, first_date: str = "2024-01-01 00:00:00") -> None:
    """Write the rows of :func:`plan_records` as gzipped WARC files of about ``FILE_BYTES`` at most.

    Files are called ``volume=<n>/part-*.txt``; the ending is the text sink's. A record has to fit a task's memory.
    Pages carry no capture time; the page with id n counts as captured n seconds after ``first_date`` (one without id, or
    with an id that is no number, at that time).
    """
    urn = F.lit(f"<{_RECORD_ID}")
    seconds = F.coalesce(F.try_to_number(F.col("id").cast("string"), F.lit("9" * 18)).cast("bigint"), F.lit(0))
    when = F.date_format(F.timestamp_seconds(F.unix_timestamp(F.lit(first_date)) + F.pmod(seconds, F.lit(10**10))),
                         "yyyy-MM-dd'T'HH:mm:ss'Z'")
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(_END * 2))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    fields = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), urn, F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">")),
        F.concat(F.lit("WARC-Date: "), when),
        # concat_ws leaves out missing fields
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("WARC-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn, F.col("refers_to").cast("string"), F.lit(">"))),
        F.when(revisit, F.lit(f"WARC-Profile: {_PROFILE}")),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    record = F.encode(F.concat(F.concat_ws(_END, *fields), F.lit(_END * 2), block, F.lit(_END * 2)), "UTF-8")
    members = records.select(record.alias("record")).mapInPandas(_pack(FILE_BYTES), "volume int, member binary")
    # The sink writes the bytes of a text as they are, valid or not.
    (members.select("volume", F.col("member").cast("string").alias("value"))
     .write.partitionBy("volume").option("lineSep", "\0").text(path, compression="none"))


# ---- reading ------------------------------------------------------------------------------------------------------


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels from the top-level one down, then path and query; ``-`` without a URL.

    Scheme, user, default port, a leading ``www.`` and the fragment do not count.
    """
    if not url:
        return "-"
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:  # not a URL by the rules: its own text is the key
        return url
    port = "" if port in (None, {"http": 80, "https": 443}.get(parts.scheme)) else f":{port}"
    return ",".join(reversed(host.split("."))) + port + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def read_record(read: Callable[[int], bytes]) -> tuple[bytes, int]:
    """The record of the member that ``read`` (so many next bytes of a file) is about to give, and the member's length."""
    inflate, parts, taken = zlib.decompressobj(31), [], 0
    while not inflate.eof:
        piece = read(STEP_BYTES)
        if not piece:
            raise ValueError("the archive ends within a record")
        parts.append(inflate.decompress(piece))
        taken += len(piece)
    return b"".join(parts), taken - len(inflate.unused_data)


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Fields with lower-case names, and block."""
    stop = record.index(b"\r\n\r\n")
    lines = record[:stop].decode().split(_END)
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    return fields, record[stop + 4:stop + 4 + int(fields["content-length"])]


def parse_records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """``(offset, fields with lower-case names, block)`` of every record of an archive file."""
    source, at = io.BytesIO(data), 0
    while at < len(data):
        source.seek(at)
        record, length = read_record(source.read)
        if record:  # else the empty member behind a large one
            yield at, *parse_record(record)
        at += length


_ENTRY = ("url_key string, captured string, id string, record_type string, payload_bytes bigint, payload_digest string, "
          "refers_to string, file string, offset bigint")
_COLUMNS = [c.split()[0] for c in _ENTRY.split(", ")]


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``: its place, and length and digest of its full payload.

    A response's are computed from what the file holds and compared with its fields; a mismatch is an error. A revisit's
    are its fields. Ids are text. A task holds a file as written and one of its records unpacked.
    """

    def entry(name: str, offset: int, fields: dict[str, str], block: bytes) -> tuple:
        size, digest = int(fields["warc-payload-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
        if fields["warc-type"] == "response":
            payload = block[block.index(b"\r\n\r\n") + 4:]
            if (len(payload), hashlib.sha1(payload).hexdigest()) != (size, digest):
                raise ValueError(f"{name}: the record at {offset} does not hold its payload")
        refers_to = fields.get("warc-refers-to")
        return (url_key(fields.get("warc-target-uri")), fields["warc-date"], _page(fields["warc-record-id"]),
                fields["warc-type"], size, digest, _page(refers_to) if refers_to else None,
                "/".join(name.split("/")[-2:]), offset)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for name, content in zip(files["path"], files["content"]):
                yield pd.DataFrame([entry(name, *found) for found in parse_records(content)], columns=_COLUMNS)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInPandas(run, _ENTRY)


def _page(record_id: str) -> str | None:
    return record_id[1 + len(_RECORD_ID):-1] or None


# ---- the merged index ---------------------------------------------------------------------------------------------


class LoserTree:
    """Merges sorted runs: every inner node keeps the loser of its match, and only the winner's path is replayed."""

    def __init__(self, runs: Iterable[Iterable[tuple]]):
        self._runs = [iter(r) for r in runs]
        self._heads = [next(r, None) for r in self._runs]
        k = len(self._runs)
        self._losers = [-1] * max(1, k)
        self._winner = -1
        for run in range(k):
            self._play(run, building=True)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self._heads[a], self._heads[b]
        return y is None if x is None or y is None else (x, a) < (y, b)

    def _play(self, run: int, building: bool = False) -> None:
        node = (run + len(self._runs)) // 2
        while node:
            other = self._losers[node]
            if building and other < 0:  # the first to come waits for its opponent
                self._losers[node] = run
                return
            if self._beats(other, run):
                self._losers[node], run = run, other
            node //= 2
        self._winner = run

    def __iter__(self) -> Iterator[tuple]:
        while self._winner >= 0 and (head := self._heads[self._winner]) is not None:
            yield head
            self._heads[self._winner] = next(self._runs[self._winner], None)
            self._play(self._winner)


def _key(row: tuple) -> tuple:
    """URL key, time, id, then file and offset, which no two records share."""
    return (*row[:2], row[2] or "", *row[-2:])


def _packed(rows: list[tuple]) -> bytes:
    sink = io.BytesIO()
    batch = pa.RecordBatch.from_pylist([dict(zip(_COLUMNS, r)) for r in rows])
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    return sink.getvalue()


def _unpacked(data: bytes) -> Iterator[tuple[tuple, tuple]]:
    for batch in pa.ipc.open_stream(data):
        columns = [batch.column(c).to_pylist() for c in _COLUMNS]
        for row in zip(*columns):
            yield _key(row), row


def _sorted_runs(splitters: list[tuple], run_rows: int):
    """Sorts the captures of a task in runs; a row for each run and range that has some of it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[tuple] = []

        def flush() -> pd.DataFrame:
            waiting.sort(key=_key)
            keys = [_key(r) for r in waiting]
            cuts = [0, *(bisect.bisect_left(keys, s) for s in splitters), len(keys)]
            pieces = [(part, _packed(waiting[a:b])) for part, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
            waiting.clear()
            return pd.DataFrame(pieces, columns=["part", "run"])

        for rows in batches:
            waiting += rows.astype(object).where(rows.notna(), None).itertuples(index=False, name=None)
            if len(waiting) >= run_rows:
                yield flush()
        if waiting:
            yield flush()

    return run


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    merged = [row for _, row in LoserTree(_unpacked(r) for r in rows["run"])]
    out = pd.DataFrame(merged, columns=_COLUMNS)
    out.insert(0, "position", range(len(out)))
    out.insert(0, "part", int(rows["part"].iloc[0]))
    return out


def merge_index(captures: DataFrame) -> DataFrame:
    """The captures with ``part`` and ``position``: ordered by both, they are in order of URL key, then time, then id.

    Splitters come from a random sample of about ``RANGE_KEYS`` keys for each range (one capture of 5000), so ranges hold about
    ``RANGE_ROWS`` captures however many there are; it only decides how even they are. Keys are unique by their place in the
    archive, so captures of one URL, however many, spread over as many ranges as they fill.
    """
    captures = captures.select(*_COLUMNS)
    rows = captures.count()
    parts = rows // RANGE_ROWS + 1
    splitters: list[tuple] = []
    if parts > 1:
        drawn = captures.sample(min(1.0, RANGE_KEYS * parts / rows), seed=7).select(*_COLUMNS[:3], *_COLUMNS[-2:])
        sample = sorted(_key(tuple(r)) for r in drawn.collect())
        splitters = [sample[len(sample) * k // parts] for k in range(1, parts)] if sample else []
    runs = captures.mapInPandas(_sorted_runs(splitters, RUN_ROWS), "part bigint, run binary")
    return runs.groupBy("part").applyInPandas(_merge, f"part bigint, position bigint, {_ENTRY}")


def archive(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """Write pages as WARC archives, read them back and return their merged index.

    Returns ``id_col, payload_bytes, payload_digest, record_type, refers_to, url_key, captured, file, offset, part,
    position``, one row per page. ``path`` defaults to a new scratch folder. Missing and repeated ids, missing URLs and
    equal pages are records like others; other columns are not read.
    """
    path = path or scratch_path(pages.sparkSession, "archives")
    write_archives(plan_records(pages, id_col, url_col, html_col), path)
    merged = merge_index(stored(read_captures(pages.sparkSession, path)))
    kind = pages.schema[id_col].dataType
    return with_id(merged.withColumn("refers_to", F.col("refers_to").cast(kind)), pages, id_col)
