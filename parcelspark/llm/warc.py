"""WARC archives from pages, and their capture index merged from sorted runs."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelspark.llm.common import stored

CRLF = "\r\n"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_INDEX = (
    "url_key string, captured string, page_id long, run string, offset long, length long, record_type string, "
    "payload_bytes long, payload_digest string, refers_to long"
)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a string's UTF-8 bytes: five hex digits at a time are four base32 digits."""
    digest = F.sha1(payload.cast("binary"))
    digits = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _BASE32)


def write_archives(
    pages: DataFrame,
    path: str,
    captured: Column,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
) -> None:
    """One WARC record per row, into gzip files under ``path``, one per task. Other columns are left out.

    Of rows with equal payloads of at least ``least_bytes`` bytes, the one with the largest id becomes a ``response``
    record, the others ``revisit`` records that name it and hold no payload. Only (digest, id) is shuffled to find
    these groups, reduced on the map side; payloads move only if so many repeat that the list of repeated digests is
    too large for Spark to broadcast by its own size check. A null payload is an empty one; a null address is
    ``urn:x-none``; a null id never becomes the response of a group that has other ids. Where an id is repeated with
    the same payload, each such row is a response.
    """
    rows = pages.select(
        F.col(page_id).cast("long").alias("id"),
        F.coalesce(F.regexp_replace(url, r"[\x00-\x20\x7f]+", "%20"), F.lit("urn:x-none")).alias("url"),
        F.coalesce(payload, F.lit("")).alias("payload"),
        F.date_format(captured, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
    ).withColumns({"size": F.octet_length("payload").cast("long"), "digest": base32_sha1(F.col("payload"))})
    repeated = (
        rows.where(F.col("size") >= least_bytes)
        .groupBy(F.col("digest").alias("same"), F.col("size").alias("same_size"))
        .agg(F.max("id").alias("response"), F.count("*").alias("n"))
        .where("n > 1 AND response IS NOT NULL")
    )
    joined = rows.join(
        repeated.drop("n"), (F.col("digest") == F.col("same")) & (F.col("size") == F.col("same_size")), "left"
    )
    revisit = F.col("response").isNotNull() & ~F.col("id").eqNullSafe(F.col("response"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), "size", F.lit(CRLF * 2)
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: <urn:x-page:"),
        F.coalesce(F.col("id").cast("string"), F.lit("none")),
        F.lit(">\r\nWARC-Date: "),
        F.coalesce("date", F.lit("1970-01-01T00:00:00Z")),
        F.lit("\r\nWARC-Target-URI: "),
        "url",
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        "digest",
        F.when(
            revisit,
            F.concat(
                F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                F.lit("\r\nWARC-Refers-To: <urn:x-page:"),
                F.col("response").cast("string"),
                F.lit(">"),
            ),
        ).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length("block").cast("string"),
        F.lit(CRLF * 2),
        "block",
    )
    joined.withColumn("block", block).select(record.alias("value")).write.option("lineSep", CRLF * 2).option(
        "compression", "gzip"
    ).text(path)


def url_key(url: str) -> str:
    """The sort key of an address: host labels from the right, then path and query, in lower case."""
    parts = urlsplit(url.lower()) if "[" not in url and "]" not in url else None
    if parts is None or not parts.netloc:
        return url.lower()
    host = parts.netloc.rsplit("@", 1)[-1].removeprefix("www.")
    name, _, port = host.partition(":")
    key = ",".join(reversed(name.split("."))) + (f":{port}" if port and port not in ("80", "443") else "")
    return f"{key}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def _records(lines: Iterator[tuple[str, str]]) -> Iterator[tuple[str, int, int, dict[str, str], bytes]]:
    """(file, offset, length, headers, block) of each record, from (file, line) with lines split at CRLF.

    Offsets count bytes of the uncompressed archive. A block may hold CRLF itself; Content-Length tells its end.
    """
    file, at = None, 0
    begin, headers, block, need, state = 0, {}, bytearray(), 0, "between"
    for name, line in lines:
        if name != file:
            if state != "between":
                raise ValueError(f"{file} ends inside a record")
            file, at = name, 0
        data = line.encode()
        if state == "between":
            if data.startswith(b"WARC/"):
                begin, headers, block, state = at, {}, bytearray(), "headers"
            elif data:
                raise ValueError(f"{file}: no record starts at byte {at}")
        elif state == "headers":
            if data:
                field, _, value = line.partition(":")
                headers[field.lower()] = value.strip()
            else:
                need, state = int(headers["content-length"]), "block"
        else:
            block += data
            if len(block) < need:
                block += b"\r\n"
            if len(block) >= need:
                if len(block) > need:
                    raise ValueError(f"{file}: record at byte {begin} is longer than it says")
                yield file, begin, at + len(data) - begin, headers, bytes(block)
                state = "between"
        at += len(data) + 2
    if state != "between":
        raise ValueError(f"{file} ends inside a record")


def _id(text: str | None) -> int | None:
    number = (text or "").removeprefix("<urn:x-page:").removesuffix(">")
    return None if number in ("", "none") else int(number)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The capture index of the archives under ``path``, a row per record, in no order: one run per archive file.

    Lines are streamed, so a task holds one record at a time. Each response's payload is hashed again, and a digest
    or length that disagrees with the record's own stops the job.
    """
    lines = spark.read.option("lineSep", CRLF).text(path).select(F.col("_metadata.file_name").alias("file"), "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple[str, str]]:
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

        rows = []
        for file, offset, length, headers, block in _records(each()):
            http, _, payload = block.partition(b"\r\n\r\n")
            size = int(http.rpartition(b":")[2])
            digest = headers["warc-payload-digest"].removeprefix("sha1:")
            if headers["warc-type"] == "response":
                own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                if (own, len(payload)) != (digest, size):
                    raise ValueError(f"{file}: payload at byte {offset} is not what its record says")
                size, digest = len(payload), own
            rows.append(
                (
                    url_key(headers["warc-target-uri"]),
                    headers["warc-date"],
                    _id(headers["warc-record-id"]),
                    file,
                    offset,
                    length,
                    headers["warc-type"],
                    size,
                    digest,
                    _id(headers.get("warc-refers-to")),
                )
            )
            if len(rows) >= 5_000:
                yield _table(rows)
                rows = []
        if rows:
            yield _table(rows)

    return lines.mapInArrow(run, _INDEX)


_TYPES = [pa.int64() if part.split()[1] == "long" else pa.string() for part in _INDEX.split(", ")]
_NAMES = [part.split()[0] for part in _INDEX.split(", ")]


def _table(rows: list[tuple], extra: tuple[str, ...] = ()) -> pa.RecordBatch:
    types = _TYPES + [pa.int64() for _ in extra]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[*_NAMES, *extra])


def loser_tree(runs: list[Iterator[tuple]], key) -> Iterator[tuple]:
    """The items of sorted ``runs`` in one order, read as they are needed: one item of each run is held. Each inner node
    keeps the run that lost there, so taking an item replays one path from its run's leaf to the root; equal items
    come in the order of their runs."""
    k = len(runs)
    runs = [iter(run) for run in runs]
    heads: list[tuple | None] = [next(run, None) for run in runs]
    end = (1,)

    def front(run: int) -> tuple:
        return end if heads[run] is None else (0, key(heads[run]), run)

    fronts = [front(run) for run in range(k)]
    losers, winner = [-1] * k, -1
    for run in range(k):
        best, node = run, (run + k) // 2
        while node > 0:
            if losers[node] == -1:
                losers[node], best = best, -1
                break
            if fronts[losers[node]] < fronts[best]:
                losers[node], best = best, losers[node]
            node //= 2
        if best != -1:
            winner = best
    while k and fronts[winner] != end:
        yield heads[winner]
        heads[winner] = next(runs[winner], None)
        fronts[winner] = front(winner)
        node = (winner + k) // 2
        while node > 0:
            if fronts[losers[node]] < fronts[winner]:
                losers[node], winner = winner, losers[node]
            node //= 2


def _rows(batches: list[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def merged_index(index: DataFrame, rows_per_range: int = 100_000) -> DataFrame:
    """The index in one global order by address key, time and page, so that an address's captures are neighbours, oldest
    first. ``position`` numbers all rows without a gap, ``range`` the key ranges.

    The index is written to the shared folder first. Its rows are dealt to key ranges of about ``rows_per_range``
    (the page id, run and offset are part of the range key, so one address, and one page stored many times, may span
    ranges) and sorted per run by Spark, which spills. A range's task holds its rows as Arrow batches per run, which a
    loser tree merges as a stream. The rows written are counted per range, and these counts, one per range, are
    added up and joined, so that the position is global. Nulls come first, repeated
    records in the order of their archives. An empty index stays empty; columns other than those of ``read_archives``
    are left out.
    """
    index = stored(index.select(*_NAMES), "index")
    ranges = max(1, -(-index.count() // rows_per_range))
    keys = ["url_key", "captured", "page_id", "run", "offset"]
    dealt = index.repartitionByRange(ranges, *keys).sortWithinPartitions(
        "run", *(F.col(k).asc_nulls_first() for k in keys[:3]), "offset"
    )

    def order(row: tuple) -> tuple:
        return row[0], row[1], row[2] is not None, row[2] or 0, row[3], row[4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows = TaskContext.get().partitionId(), []
        for place, row in enumerate(loser_tree([_rows(run) for run in _runs(batches)], order)):
            rows.append((*row, number, place))
            if len(rows) >= 5_000:
                yield _table(rows, ("range", "place"))
                rows = []
        if rows:
            yield _table(rows, ("range", "place"))

    merged = stored(dealt.mapInArrow(run, f"{_INDEX}, range long, place long"), "merged")
    before = Window.orderBy("range")
    starts = (
        merged.groupBy("range")
        .agg(F.count("*").alias("n"))
        .select("range", (F.sum("n").over(before) - F.col("n")).alias("start"))
    )
    return merged.join(starts, "range").select(*_NAMES, "range", (F.col("start") + F.col("place")).alias("position"))


def _runs(batches: Iterator[pa.RecordBatch]) -> list[list[pa.RecordBatch]]:
    """The Arrow batches of each run; they come run by run."""
    runs: list[list[pa.RecordBatch]] = []
    last = object()
    for batch in batches:
        names = batch.column(_NAMES.index("run")).to_pylist()
        begin = 0
        for at in range(1, len(names) + 1):
            if at == len(names) or names[at] != names[begin]:
                if names[begin] != last:
                    last = names[begin]
                    runs.append([])
                runs[-1].append(batch.slice(begin, at - begin))
                begin = at
    return runs
