"""WARC archives with individually compressed records and an embedded Zstandard dictionary.

Each task writes archives of about ARCHIVE_BYTES of records. An archive begins with a skippable frame that holds a
dictionary trained on records of this archive (a spread of SAMPLE_BYTES of them); then each record is one frame. Of rows
with equal payloads of at least REVISIT_BYTES the one with the smallest page identifier is written as a response, the
others as revisits that refer to it.

Archives are written by the executors to a folder in any file system that pyarrow can open (file, hdfs, s3, gs) and that
all executors share. File names are unique to a task attempt, and only those that a finished task reports are in the
returned table, so retried, repeated and lost tasks leave no record twice: read archives through that table.

Null html is an empty payload, a null url no target. Rows that repeat identifier and payload are all written as they
are; those with the smallest identifier are all responses. Null identifiers never serve as originals unless no row of
the payload has one; then all its rows are responses. Other columns are not archived.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.common import bounded_batches
from pitpanel.session import stable

ARCHIVE_BYTES = 32 << 20
#: Bytes of records that a dictionary is trained on, and its size.
SAMPLE_BYTES, DICTIONARY_BYTES = 2 << 20, 32 << 10
REVISIT_BYTES = 100
LEVEL = 3
#: Fixed values of the format: magic numbers of a skippable dictionary frame and of a dictionary, revisit profile.
SKIPPABLE, DICTIONARY = 0x184D2A5D, 0xEC30A437
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, intact boolean"


def _name(page) -> str:
    return "<urn:x-page:%s>" % ("" if page is None else page)


def _record(kind: str, fields: list[tuple[str, str]], block: bytes, date: str) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Date", date), *fields, ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode("utf-8") + b"\r\n" + block + b"\r\n\r\n"


def page_record(page, url, payload: bytes, size: int, digest: str, original, date: str) -> bytes:
    """A response, or a revisit of page ``original``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode("ascii")
    fields = [("WARC-Record-ID", _name(page)), ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~")))
    if original is None:
        return _record("response", fields, http + payload, date)
    return _record("revisit", [*fields, ("WARC-Profile", PROFILE), ("WARC-Refers-To", _name(original))], http, date)


def pack(records: list[bytes]) -> bytes:
    """An archive: dictionary frame, then a frame for each record. Too few records to train on: no dictionary."""
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, records[::step], level=LEVEL)
    except zstandard.ZstdError:
        trained = None
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
    head = b""
    if trained is not None:
        body = zstandard.ZstdCompressor(level=LEVEL).compress(trained.as_bytes())
        head = struct.pack("<II", SKIPPABLE, len(body)) + body
    return head + b"".join(compressor.compress(r) for r in records)


def unpack(archive: bytes) -> Iterator[bytes]:
    """Records of an archive, one after another."""
    view, at, trained = memoryview(archive), 0, None
    if len(archive) >= 8 and (frame := struct.unpack("<II", view[:8]))[0] == SKIPPABLE:
        at = 8 + frame[1]
        body = bytes(view[8:at])
        if struct.unpack("<I", body[:4])[0] != DICTIONARY:
            body = zstandard.ZstdDecompressor().decompress(body)
        trained = zstandard.ZstdCompressionDict(body)
    decompressor = zstandard.ZstdDecompressor(dict_data=trained)
    while at < len(archive):
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if at >= len(archive):
                raise ValueError("the archive ends inside a record")
            part = view[at : at + (1 << 14)]
            parts.append(frame.decompress(part))
            at += len(part)
        at -= len(frame.unused_data)
        yield b"".join(parts)


def parse(record: bytes) -> dict:
    """Header fields of a record in lower case, and its block."""
    head, _, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    return fields | {"block": rest[: int(fields["content-length"])]}


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def _writer(folder: str, date: str):
    def write(batches):
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        records: list[bytes] = []
        size = 0

        def close():
            name = f"{uuid.uuid4().hex}.warc.zst"
            data = pack([info, *records])
            with system.open_output_stream(f"{base}/{name}") as out:
                out.write(data)
            return pd.DataFrame({"file": [f"{folder}/{name}"], "records": [len(records)], "raw_bytes": [size], "bytes": [len(data)]})

        info = _record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("Content-Type", "application/warc-fields")], b"format: WARC file version 1.1\r\n", date)
        for pdf in batches:
            for page, url, html, length, digest, original in pdf.itertuples(index=False):
                page, original = (None if pd.isna(x) else int(x) for x in (page, original))
                payload = b"" if html is None or original is not None else html.encode("utf-8")
                records.append(page_record(page, url, payload, int(length), digest, original, date))
                size += len(records[-1])
                if size >= ARCHIVE_BYTES:
                    yield close()
                    records, size = [], 0
        if records:
            yield close()

    return write


def write(pages: DataFrame, folder: str, page: str = "page_id", url: str = "url", html: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Archive ``pages`` below ``folder``; returns the table of archives (file, records, raw_bytes, bytes), already written."""
    bounded_batches(pages.sparkSession)
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(page).cast("long").alias("page"), F.col(url).alias("url"), F.col(html).alias("html"),
        F.octet_length(body).cast("long").alias("size"), F.sha2(body, 256).alias("digest"))
    named = pages.select(F.col(page).cast("long").alias("page"), F.octet_length(body).alias("size"), F.sha2(body, 256).alias("digest"))
    repeated = named.where(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page").alias("original"), F.count("*").alias("copies"))
    # a table of its own, so that the join can be split where one payload has very many pages
    repeated = stable(repeated.where((F.col("copies") > 1) & F.col("original").isNotNull()).select("digest", "original"))
    rows = rows.join(repeated, "digest", "left")
    refers = F.when(~F.col("original").eqNullSafe(F.col("page")), F.col("original"))
    rows = rows.select("page", "url", F.when(refers.isNull(), F.col("html")).alias("html"), "size", "digest", refers.alias("original"))
    return stable(rows.mapInPandas(_writer(folder, date), "file string, records long, raw_bytes long, bytes long"))


def _read(batches):
    for pdf in batches:
        for file in pdf["file"]:
            system, path = fs.FileSystem.from_uri(file)
            with system.open_input_stream(path) as source:
                archive = source.read()
            rows = []
            for record in unpack(archive):
                found = parse(record)
                if found["warc-type"] == "warcinfo":
                    continue
                head, _, payload = found["block"].partition(b"\r\n\r\n")
                size = int(re.search(rb"(?i)content-length: *(\d+)", head)[1])
                stated = found["warc-payload-digest"].removeprefix("sha256:")
                whole = found["warc-type"] == "response"
                digest = hashlib.sha256(payload).hexdigest() if whole else stated
                rows.append((
                    _page(found["warc-record-id"]), len(payload) if whole else size, digest, found["warc-type"], _page(found.get("warc-refers-to")),
                    found.get("warc-target-uri"), digest == stated and (not whole or len(payload) == size)))
            columns = [c.split()[0] for c in RECORD.split(", ")]
            yield pd.DataFrame(rows, columns=columns).astype({"page_id": "Int64", "refers_to": "Int64"})


def read(archives: DataFrame) -> DataFrame:
    """One row for each page record of the archives in column ``file``; digests of responses are computed anew."""
    return archives.select("file").mapInPandas(_read, RECORD)
