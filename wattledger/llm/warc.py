"""WARC archives: writing with revisit records, and reading in byte ranges with boundary-chain verification.

Reading: every byte range of an archive is searched for the record magic on its own. Each hit whose header parses
is a candidate that points to its successor, where its declared length ends; inside a range candidates are followed
at once, so that a candidate keeps only the place where its chain leaves the range. Pointer jumping over these exits,
from the start of each file and doubling with every round, then finds the one true entry of each range. Magic inside
a payload starts a chain too, but no chain from a file's start reaches it, so it gives no record.

Writing: of records with equal payloads the one with the smallest page_id is a response and the others are revisits.

Defined results: null html is an empty payload; an empty payload is revisited like any other unless
``least_bytes`` says more; rows that repeat the smallest page_id of a payload are all responses; a null page_id is
written as a response and never referred to; a null url leaves the target header out, and one of any length is
written and read whole; an empty table writes no archive and reads as no rows. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, keep, scratch_path

MAGIC = b"WARC/1.1\r\n"
HEAD_BYTES = 1 << 12  # what is read at first of a header; more follows until it ends
ARCHIVE_BYTES = 32 << 20
RANGE_BYTES = 8 << 20
TASK_BYTES = 64 << 20  # what a task reads back, about
BROADCAST_ROWS = 200_000  # revisit rows of at most about 60 bytes that are sent to every task
_SPACE = uuid.UUID(int=0)
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One whole record. A revisit has no payload but keeps its digest and length."""
    block = b"" if refers_to is not None else _HTTP + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_SPACE, str(page_id))}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else quote(url, safe="%/:?#[]@!$&'()*+,;=~-._")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Page-Id", page_id),
        ("X-Payload-Length", len(payload)),
        ("WARC-Refers-To", None if refers_to is None else f"<urn:uuid:{uuid.uuid5(_SPACE, str(refers_to))}>"),
        ("X-Refers-To-Page-Id", refers_to),
        ("WARC-Profile", None if refers_to is None else "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", len(block)),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return MAGIC + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, refers_to) of every page whose payload an earlier page_id has; written in the shared folder."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digests = keep(pages.select(F.col("page_id").cast("long").alias("page_id"), F.unhex(F.sha1(payload)).alias("digest"), F.octet_length(payload).alias("size")), "digests")
    first = digests.where(F.col("size") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    # read from a table, so that a payload with very many copies can be split over tasks where it meets its first page
    first = keep(first.select("digest", "refers_to"), "first-pages")
    found = keep(digests.join(first, "digest").where("page_id > refers_to").select("page_id", F.hex("digest").alias("sha1"), "refers_to").distinct(), "revisits")
    forget(digests)
    forget(first)
    return found


def write_warc(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for each page (page_id, url, html); returns (path, size, records) of each archive.

    Each task closes an archive when it has ``archive_bytes``; a file is written under a hidden name and then moved
    to the name of its task and number, so that a repeated task leaves the same files.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    repeated = revisits(pages, least_bytes)
    if repeated.count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"), F.hex(F.unhex(F.sha1(payload))).alias("sha1"))
    typed = given.join(repeated, ["page_id", "sha1"], "left").select("page_id", "url", "payload", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        task, number = TaskContext.get().partitionId(), 0
        parts: list[bytes] = []
        held = 0

        def close() -> dict:
            name, hidden = f"part-{task:06d}-{number:04d}.warc", f"{root}/.{uuid.uuid4().hex}"
            with files.open_output_stream(hidden) as out:
                out.writelines(parts)
            files.move(hidden, f"{root}/{name}")
            return {"path": f"{folder}/{name}", "size": held, "records": len(parts)}

        done = []
        for batch in batches:
            for page_id, url, body, refers_to in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "payload", "refers_to")), strict=True):
                record = record_bytes(page_id, url, body, payload_digest(body), refers_to, date)
                if parts and held + len(record) > archive_bytes:
                    done.append(close())
                    number, parts, held = number + 1, [], 0
                parts.append(record)
                held += len(record)
        if parts:
            done.append(close())
        if done:
            yield pa.RecordBatch.from_pylist(done, pa.schema([("path", pa.string()), ("size", pa.int64()), ("records", pa.int64())]))

    return keep(typed.mapInArrow(run, "path string, size long, records long"), "warc-manifest")


_NAME = re.compile(rb"[A-Za-z0-9-]+:")


class _More:
    """The header may go on behind the bytes at hand."""


MORE = _More()


def parse_head(data: bytes, at: int = 0) -> tuple[dict[str, str], int] | _More | None:
    """The header fields of a record at ``at``, and where its block begins; None if no header stands there.

    A header ends at its first blank line, however long it is; the first line that isn't a field tells that there is none.
    """
    if not data.startswith(MAGIC, at):
        return MORE if MAGIC.startswith(data[at:]) else None
    fields = {}
    line = at + len(MAGIC)
    while True:
        end = data.find(b"\r\n", line)
        if end == line:
            break
        named = _NAME.match(data, line, len(data) if end < 0 else end)
        if named is None:
            return MORE if end < 0 and re.fullmatch(rb"[A-Za-z0-9-]*|\r", data[line:]) else None
        if end < 0:
            return MORE
        fields[data[line : named.end() - 1].decode().lower()] = data[named.end() : end].strip().decode("utf-8", "replace")
        line = end + 2
    return (fields, end + 2) if fields.get("content-length", "").isdecimal() else None


def read_head(source, at: int, size: int, data: bytes = b"") -> tuple[dict[str, str], int] | None:
    """``parse_head`` at byte ``at`` of an open archive of ``size`` bytes, of which ``data`` has been read from there."""
    while isinstance(found := parse_head(data), _More):
        if at + len(data) >= size:
            return None
        source.seek(at + len(data))
        data += source.read(max(HEAD_BYTES, len(data)))
    return found


def ranges(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, size, first, last): byte ranges of the archives, dealt out over the tasks."""
    start = F.explode(F.sequence(F.lit(0), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(range_bytes)).cast("array<long>"))
    cut = archives.select("path", "size", start.alias("first"))
    return cut.withColumn("last", F.least(F.col("first") + range_bytes, "size"))


def _tasks(archives: DataFrame, range_bytes: int) -> int:
    """In how many tasks the archives are read: rows here are tiny, so that Spark would gather them all in one."""
    found = archives.agg(F.sum("size").alias("bytes"), F.sum(F.ceil(F.col("size") / range_bytes)).alias("ranges")).first()
    many = max(4 * archives.sparkSession.sparkContext.defaultParallelism, -(-(found["bytes"] or 0) // TASK_BYTES))
    return max(1, min(found["ranges"] or 1, many))


def candidates(cut: DataFrame) -> DataFrame:
    """(path, at, exit): every record-like place of each range, and where its chain leaves that range.

    A chain that meets a place without a record header ends there; that place is its exit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, name = pafs.FileSystem.from_uri(row["path"])
                first, last = row["first"], row["last"]
                with files.open_input_file(name) as source:
                    source.seek(first)
                    data = source.read(min(row["size"], last + HEAD_BYTES) - first)
                    after: dict[int, int] = {}
                    at = data.find(MAGIC)
                    while 0 <= at < last - first:
                        if isinstance(found := parse_head(data, at), _More):
                            found = read_head(source, first + at, row["size"], data[at:])
                            found = found and (found[0], at + found[1])
                        if found is not None:
                            after[at] = found[1] + int(found[0]["content-length"]) + 4
                        at = data.find(MAGIC, at + 1)
                leaves: dict[int, int] = {}
                for at in sorted(after, reverse=True):  # a successor lies behind, so its exit is known
                    leaves[at] = leaves.get(after[at], after[at])
                yield pa.RecordBatch.from_pydict({"path": pa.array([row["path"]] * len(leaves), pa.string()), "at": pa.array([first + x for x in leaves], pa.int64()), "exit": pa.array([first + x for x in leaves.values()], pa.int64())})

    return cut.mapInArrow(run, "path string, at long, exit long")


def reachable(links: DataFrame, rounds: int) -> DataFrame:
    """(path, at): the candidates that a chain from the start of their file reaches, by ``rounds`` of pointer jumping.

    After k rounds the first 2^k entries of each file are known.
    """
    found, jump = links.where("at = 0").select("path", "at"), links
    for k in range(rounds):
        onward = found.join(jump, ["path", "at"]).select("path", F.col("exit").alias("at"))
        found = keep(found.unionByName(onward).distinct(), "chain")
        if k + 1 < rounds:
            twice = (F.col("a.path") == F.col("b.path")) & (F.col("a.exit") == F.col("b.at"))
            jump = keep(jump.alias("a").join(jump.alias("b"), twice).select("a.path", "a.at", "b.exit"), "jump")
    return found


def read_records(archives: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """(path, at, fields, payload_bytes, payload_digest, payload) of each true record; ``fields`` is the header.

    Size and digest are computed from a response's payload, and read from the header of a revisit. The payload is
    null for revisits, and for all records without ``payloads``. An archive whose chain breaks raises an error.
    """
    tasks = _tasks(archives, range_bytes)
    cut = ranges(archives, range_bytes)
    links = keep(candidates(cut.repartition(tasks, "path", "first")), "warc-links")
    # a number that is given isn't coalesced
    entries = _entries(cut, links, range_bytes).repartition(tasks, "path", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, name = pafs.FileSystem.from_uri(row["path"])
                rows, held, at = [], 0, row["at"]
                with files.open_input_file(name) as source:
                    size = source.size()
                    while at < row["last"]:
                        if (found := read_head(source, at, size)) is None:
                            raise ValueError(f"{row['path']}: no record at byte {at}, where one must begin")
                        fields, begin = found
                        length = int(fields["content-length"])
                        source.seek(at + begin)
                        block = source.read(length)
                        if len(block) < length:
                            raise ValueError(f"{row['path']}: the record at byte {at} is cut off")
                        rows.append(_row(row["path"], at, fields, block, payloads))
                        held += length
                        at += begin + length + 4
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _RECORD)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, _RECORD)

    return entries.mapInArrow(run, "path string, at long, fields map<string,string>, payload_bytes long, payload_digest string, payload binary")


_RECORD = pa.schema([("path", pa.string()), ("at", pa.int64()), ("fields", pa.map_(pa.string(), pa.string())), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def _row(path: str, at: int, fields: dict[str, str], block: bytes, payloads: bool) -> dict:
    row = {"path": path, "at": at, "fields": list(fields.items())}
    if fields.get("warc-type") == "revisit":
        return row | {"payload_bytes": int(fields.get("x-payload-length", 0)), "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:"), "payload": None}
    payload = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
    return row | {"payload_bytes": len(payload), "payload_digest": payload_digest(payload), "payload": payload if payloads else None}


def _entries(cut: DataFrame, links: DataFrame, range_bytes: int) -> DataFrame:
    """(path, at, last): where the first true record of each range begins; ranges inside one record have none."""
    met = links.select("path", F.col("exit").alias("at")).distinct()
    doors = keep(links.join(met, ["path", "at"], "left_semi").unionByName(links.where("at = 0")).distinct(), "warc-doors")
    longest = cut.groupBy("path").count().agg(F.max("count")).first()[0] or 0
    found = keep(reachable(doors, max(0, longest - 1).bit_length()), "warc-entries")
    whole = found.join(doors, ["path", "at"]).select("path", F.col("exit").alias("size"))
    if broken := cut.where("size > 0").select("path", "size").distinct().join(whole, ["path", "size"], "left_anti").first():
        raise ValueError(f"{broken['path']}: no chain of records leads from its start to its end")
    return found.withColumn("first", F.col("at") - F.col("at") % range_bytes).join(cut, ["path", "first"]).select("path", "at", "last")


def page_records(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every page record in the archives."""
    number = lambda name: F.col("fields")[name].cast("long")
    return read_records(archives, range_bytes, payloads=False).select(number("x-page-id").alias("page_id"), "payload_bytes", "payload_digest", F.col("fields")["warc-type"].alias("record_type"), number("x-refers-to-page-id").alias("refers_to"))
