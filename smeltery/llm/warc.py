"""WARC archives: writer with revisit records, and a splittable reader.

The reader gives every task a byte range of an archive. The task looks for gzip
magic, checks each candidate by decoding the member and its headers, and reads
the records that start inside its range, however far they reach beyond it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from smeltery.llm.common import stored
from smeltery.workspace import new_folder

MAGIC = b"\x1f\x8b\x08"
FILE_BYTES = 64 << 20
SPLIT_BYTES = 16 << 20
BUFFER = 1 << 20
MANIFEST = "path string, bytes long, records long"
RECORD = ("path string, start long, record_type string, record_id string, target_uri string, payload_bytes long, "
          "payload_digest string, refers_to string, payload binary")


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value or "")


def _member(kind: str, record_id: str, uri, payload: bytes, refers_to) -> bytes:
    """One record as a gzip member of its own; a revisit carries no payload, only its size and digest."""
    block = b"" if kind == "revisit" else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", "WARC-Date: 2024-01-01T00:00:00Z",
            f"WARC-Target-URI: {_line(uri)}", f"WARC-Payload-Digest: sha1:{digest32(payload)}",
            f"X-Payload-Bytes: {len(payload)}", "Content-Type: application/http;msgtype=response"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <{refers_to}>"]
    raw = "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gz.compress(raw) + gz.flush()


def write_warc(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``records(kind, record_id, uri, payload, refers_to)``; the manifest of the files that count.

    Each attempt of a task writes files of its own; only those of attempts that
    ended are in the manifest, so a retried task leaves no record twice.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        done, out, name, size, n = [], None, "", 0, 0
        for batch in batches:
            for r in batch.itertuples(index=False):
                if out is None:
                    name, size, n = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                member = _member(r.kind, r.record_id, r.uri, r.payload or b"", r.refers_to)
                out.write(member)
                size, n = size + len(member), n + 1
                if size >= file_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", size, n))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", size, n))
        if done:
            yield pd.DataFrame(done, columns=["path", "bytes", "records"])

    return stored(records.select("kind", "record_id", "uri", "payload", "refers_to").mapInPandas(write, MANIFEST),
                  "warc-manifest")


class _Ranges:
    """Buffered reads at any place of a file."""

    def __init__(self, file):
        self.file, self.size, self.base, self.data = file, file.size(), 0, b""

    def at(self, place: int, n: int) -> bytes:
        if place < self.base or place + n > self.base + len(self.data):
            self.file.seek(place)
            self.base, self.data = place, self.file.read(max(n, BUFFER))
        return self.data[place - self.base:place - self.base + n]


def _decode(data: _Ranges, start: int, keep: bool) -> dict | None:
    """The record whose gzip member begins at ``start``, or None if there is none."""
    gz, place, head, total = zlib.decompressobj(31), start, b"", 0
    fields, sha, http, body, length = None, hashlib.sha1(), b"", [], 0
    try:
        while not gz.eof:
            raw = data.at(place, min(65536, data.size - place))
            if not raw:
                return None
            place += len(raw)
            while raw and not gz.eof:
                text = gz.decompress(raw, BUFFER)
                raw = gz.unconsumed_tail
                total += len(text)
                if fields is None:
                    head += text
                    if not b"WARC/".startswith(head[:5]):
                        return None
                    cut = head.find(b"\r\n\r\n", max(0, len(head) - len(text) - 3))
                    if cut < 0:
                        continue
                    lines = head[:cut].decode().split("\r\n")
                    fields = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
                    length, text, total = int(fields["Content-Length"]), head[cut + 4:], len(head) - cut - 4
                    http = None if fields["WARC-Type"] != "response" else b""
                    left = length
                if http is None:
                    continue
                text, left = text[:left], left - len(text[:left])
                if not isinstance(http, bool):
                    http += text
                    cut = http.find(b"\r\n\r\n")
                    if cut < 0:
                        continue
                    text, http = http[cut + 4:], True
                sha.update(text)
                fields["n"] = fields.get("n", 0) + len(text)
                if keep:
                    body.append(text)
        end = place - len(gz.unused_data)
    except (zlib.error, ValueError, KeyError, UnicodeDecodeError):
        return None
    if fields is None or total != length + 4:
        return None
    if end < data.size and data.at(end, 3) != MAGIC:
        return None
    response = http is True
    digest = base64.b32encode(sha.digest()).decode() if response else fields.get("WARC-Payload-Digest", "").partition(":")[2]
    return {"end": end, "row": (
        fields["WARC-Type"], fields.get("WARC-Record-ID", "")[1:-1], fields.get("WARC-Target-URI"),
        fields.get("n", 0) if response else int(fields.get("X-Payload-Bytes", 0)), digest,
        fields["WARC-Refers-To"][1:-1] if "WARC-Refers-To" in fields else None,
        b"".join(body) if keep and response else None)}


def records_in(data: _Ranges, begin: int, stop: int, keep: bool) -> Iterator[tuple]:
    """``(start, *record)`` of the records that start in ``[begin, stop)``."""
    place = begin
    while place < stop:
        window = data.at(place, min(65536 + len(MAGIC) - 1, data.size - place))
        at = window.find(MAGIC)
        if at < 0:
            place += max(1, len(window) - len(MAGIC) + 1)
            continue
        place += at
        if place >= stop:
            return
        record = _decode(data, place, keep)
        if record is None:
            place += 1
            continue
        yield (place, *record["row"])
        place = record["end"]


def read_warc(manifest: DataFrame, split_bytes: int = SPLIT_BYTES, keep_payload: bool = False) -> DataFrame:
    """All records of the archives in ``manifest(path, bytes)``, see ``RECORD``.

    Digest and size are those of the decoded payload for responses and those of
    the headers for revisits. ``payload`` is filled only if asked for; without
    it a record of any size is read in pieces. An empty manifest has no
    records; bytes that belong to no valid record are passed over. A candidate
    counts as a record if its whole member decodes, with the length its header
    states, and another member or the end of the file follows.
    """
    splits = manifest.where("bytes > 0").select("path", F.explode(F.expr(f"sequence(0L, bytes - 1, {split_bytes}L)")).alias("begin"))
    width = max(1, manifest.select(F.coalesce(F.sum(F.ceil(F.col("bytes") / split_bytes)), F.lit(0))).first()[0])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in RECORD.split(", ")]
        for batch in batches:
            for path, begin in zip(batch["path"], batch["begin"], strict=True):
                fs, inner = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(inner) as file:
                    data, rows, held = _Ranges(file), [], 0
                    for row in records_in(data, begin, min(begin + split_bytes, data.size), keep_payload):
                        rows.append((path, *row))
                        held += len(row[-1] or b"") + 256
                        if held > 8 << 20:
                            yield pd.DataFrame(rows, columns=names)
                            rows, held = [], 0
                    if rows:
                        yield pd.DataFrame(rows, columns=names)

    return splits.repartition(min(int(width), 100_000), "path", "begin").mapInPandas(read, RECORD)


def checked(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """``records``, stored; an error if an archive in ``manifest(path, records)`` has not as many as it says."""
    kept = stored(records, "warc-records")
    found = kept.groupBy("path").agg(F.count("*").alias("found"))
    wrong = (manifest.select("path", "records").join(found, "path", "left")
             .where(F.col("records") != F.coalesce("found", F.lit(0))).take(3))
    if wrong:
        raise ValueError("records read differ from those written: "
                         + ", ".join(f"{r['path']} has {r['found'] or 0} of {r['records']}" for r in wrong))
    return kept


def with_revisits(pages: DataFrame, min_bytes: int = 0, key: str = "page_id") -> DataFrame:
    """Records of ``pages(page_id, url, html)``: equal payloads are stored once.

    Of records with equal payloads of at least ``min_bytes`` bytes the smallest
    key is the response, others revisit it; rows that repeat that key are
    responses too. A null html is an empty payload. A row without a key is
    never referred to unless all rows of its payload have none.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select(F.col(key).alias("id"), F.col("url").alias("uri"), payload.alias("payload"),
                        F.sha2(payload, 256).alias("content"))
    groups = stored(rows.groupBy("content").agg(F.min("id").alias("first"), F.count("*").alias("n"))
                    .where("n > 1").select("content", "first"), "warc-payloads")
    joined = rows.join(groups, "content", "left")
    revisit = (F.octet_length("payload") >= min_bytes) & F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("")))
    return joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("kind"), name(F.col("id")).alias("record_id"), "uri",
        "payload", F.when(revisit, name(F.col("first"))).alias("refers_to"))


def pages_through_warc(spark: SparkSession, pages: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read every record back; an error if one is missing."""
    manifest = write_warc(with_revisits(pages), new_folder(spark, "warc"))
    number = lambda c: F.nullif(F.substring_index(c, ":", -1), F.lit("")).cast("long")
    records = read_warc(manifest, split_bytes).select(
        "path", number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number(F.col("refers_to")).alias("refers_to"))
    return checked(records, manifest).drop("path")
