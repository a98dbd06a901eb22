"""WARC archives: write, normalise, index and read back.

Records are first written as whole-file gzip streams, as crawlers and
rewriters often leave them: nothing in such a file can be read without
inflating all that stands before it. The normaliser inflates each stream once
and writes every record as a gzip member of its own, with a sidecar index of
offsets; reading back then seeks to each member.

Equal payloads of at least ``min_revisit_bytes`` are stored once: the record
with the smallest id is the response, the others are revisits that name it.
Rows that share that smallest id are all responses; rows without an id are
responses only if no row with that payload has one.

Null payloads count as empty, null URLs leave the header out, and URLs are
escaped where they would break a header line. Repeated rows give repeated
records; other columns are ignored; an empty table gives no archive and no row.

Files get names of their own in every attempt of a task, and a file counts
only if its name is in the table that Spark commits. So a task that runs again
after a lost executor leaves nothing half-written in the results. Paths go
through the file system that the folder's URI names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import scratch_folder, ship, written

# Plain bytes of records in one archive, at most unless one record is larger.
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 20
SALTS = 16
TASKS = 20_000
GZIP = 31  # zlib's window setting for gzip framing
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(path: str, mode: str):
    """A binary file on any file system that the URI names; plain paths are local."""
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    if mode == "r":
        return system.open_input_file(place)
    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(place, compression=None)


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(number) -> str:
    return "<urn:page:null>" if number is None else f"<urn:page:{number}>"


def _number(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def record(number, url: str | None, payload: bytes, first, revisit: bool, date: str = DATE) -> bytes:
    """One record with its trailing blank lines; a revisit has the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(number)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {_urn(first)}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest_of(payload)}", "Content-Type: application/http;msgtype=response"]
    lines += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def headers_of(head: bytes) -> dict[str, str]:
    """Header names in lower case; the first line is under an empty name."""
    first, *rest = head.decode("utf-8", "replace").split("\r\n")
    pairs = (line.split(":", 1) for line in rest if ":" in line)
    return {"": first} | {k.strip().lower(): v.strip() for k, v in pairs}


def mark_revisits(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_revisit_bytes: int) -> DataFrame:
    """id, url, html, ``first`` (smallest id of the payload) and ``revisit``.

    The payloads' copies are counted as digests before the join, and the join
    is salted, so a payload that a third of the pages share is spread.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    firsts = rows.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    firsts = firsts.drop("n").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = rows.join(firsts, ["digest", "salt"], "left")
    stored = F.octet_length("html") >= min_revisit_bytes
    revisit = stored & F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return found.select("id", "url", "html", "first", revisit.alias("revisit"))


def write_streams(marked: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the records as whole-file gzip streams; returns ``file``, ``n_records``, one row for each archive."""
    ship(marked.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = path = None
        plain = n = 0
        for batch in batches:
            for number, url, html, first, revisit in zip(
                batch["id"], batch["url"], batch["html"], batch["first"], batch["revisit"], strict=True
            ):
                if out is None:
                    path = f"{folder}/stream-{uuid.uuid4().hex}.warc.gz"
                    out, squeeze, plain, n = _open(path, "w"), zlib.compressobj(1, wbits=GZIP), 0, 0
                body = record(number, url, html.encode("utf-8", "surrogatepass"), first, bool(revisit))
                out.write(squeeze.compress(body))
                plain, n = plain + len(body), n + 1
                if plain >= archive_bytes:
                    out.write(squeeze.flush())
                    out.close()
                    yield pd.DataFrame({"file": [path], "n_records": [n]})
                    out = None
        if out is not None:
            out.write(squeeze.flush())
            out.close()
            yield pd.DataFrame({"file": [path], "n_records": [n]})

    texts = marked.withColumns({c: F.col(c).cast("string") for c in ("id", "first")})
    return texts.mapInPandas(run, "file string, n_records long")


def inflated(path: str) -> Iterator[bytes]:
    """The plain bytes of a gzip file, member after member, in bounded chunks."""
    with _open(path, "r") as f:
        inflate, data = zlib.decompressobj(GZIP), f.read(CHUNK)
        while data:
            yield inflate.decompress(data, CHUNK)
            data = inflate.unconsumed_tail
            if inflate.eof:
                data = inflate.unused_data or f.read(CHUNK)
                inflate = zlib.decompressobj(GZIP)
            elif not data:
                data = f.read(CHUNK)
        if not inflate.eof:
            yield inflate.flush()


def records_in(chunks: Iterator[bytes]) -> Iterator[tuple[bytes, Iterator[bytes]]]:
    """Each record's header block, with its blank line, and its content in pieces; contents must be read in order."""
    held = bytearray()

    def more() -> bool:
        for chunk in chunks:
            if chunk:
                held.extend(chunk)
                return True
        return False

    def content(size: int) -> Iterator[bytes]:
        while size:
            if not held and not more():
                raise ValueError("the archive ends inside a record")
            part = bytes(held[:size])
            del held[: len(part)]
            size -= len(part)
            yield part

    while True:
        while held[:2] != b"WA":  # blank lines between records
            if held[:1] in (b"\r", b"\n"):
                del held[:1]
            elif len(held) >= 2:
                raise ValueError("no record begins here")
            elif not more():
                return
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                raise ValueError("the archive ends inside a header")
        head = bytes(held[: end + 4])
        del held[: end + 4]
        body = content(int(headers_of(head[:-4])["content-length"]))
        yield head, body
        for _ in body:  # what the caller left
            pass


INDEX = "file string, offset long, length long, record_id string, record_type string, target_uri string, sidecar string"


def normalise(streams: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Rewrite archives with a gzip member for each record; returns the index, which also lies beside each file.

    One archive is one row and is worked through as a stream, so memory does
    not depend on its size.
    """
    spark = ship(streams.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source in batch["file"]:
                path = f"{folder}/members-{uuid.uuid4().hex}.warc.gz"
                at, rows = 0, []
                with _open(path, "w") as out:
                    for head, body in records_in(inflated(source)):
                        squeeze, start = zlib.compressobj(level, wbits=GZIP), at
                        parts = [squeeze.compress(head)]
                        for piece in body:
                            parts.append(squeeze.compress(piece))
                        parts += [squeeze.compress(b"\r\n\r\n"), squeeze.flush()]
                        for part in parts:
                            out.write(part)
                            at += len(part)
                        h = headers_of(head[:-4])
                        rows.append((path, start, at - start, h.get("warc-record-id"), h.get("warc-type"), h.get("warc-target-uri"), f"{path}.idx"))
                with _open(f"{path}.idx", "w") as side:
                    side.write("".join(f"{r[1]} {r[2]} {r[3]} {r[4]} {r[5] or '-'}\n" for r in rows).encode())
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in INDEX.split(", ")])

    tasks = max(1, min(streams.count(), TASKS))
    return streams.select("file").repartition(tasks).mapInPandas(run, INDEX)


def read_back(index: DataFrame, tasks: int) -> DataFrame:
    """Every indexed record: page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    The payload of a response is measured as it is read, and must agree with
    its header; a revisit has the figures of the full payload in its headers.
    """
    ship(index.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path = f = None
        for batch in batches:
            out = []
            for file, offset, length in zip(batch["file"], batch["offset"], batch["length"], strict=True):
                if file != path:
                    if f is not None:
                        f.close()
                    path, f = file, _open(file, "r")
                f.seek(int(offset))
                plain = zlib.decompress(f.read(int(length)), GZIP)
                head, _, rest = plain.partition(b"\r\n\r\n")
                h = headers_of(head)
                http, _, payload = rest[: int(h["content-length"])].partition(b"\r\n\r\n")
                told = h["warc-payload-digest"].removeprefix("sha1:")
                revisit = h["warc-type"] == "revisit"
                size = int(headers_of(http)["content-length"]) if revisit else len(payload)
                if not revisit and digest_of(payload) != told:
                    raise ValueError(f"{file} at {offset}: the payload is not the one that was written")
                out.append(
                    (
                        _number(h["warc-record-id"]), h.get("warc-target-uri"), None if revisit else payload, size, told,
                        h["warc-type"], _number(h.get("warc-refers-to")),
                    )
                )
            names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            yield pd.DataFrame(out, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})
        if f is not None:
            f.close()

    spread = index.select("file", "offset", "length").repartition(tasks, "file").sortWithinPartitions("file", "offset")
    schema = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return spread.mapInPandas(run, schema)


def archive(
    pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_revisit_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Write, normalise and index the pages; returns the index and the records read back."""
    spark = pages.sparkSession
    folder = folder or scratch_folder(spark, "warc")
    marked = mark_revisits(pages, id_col, url_col, html_col, min_revisit_bytes)
    streams = written(write_streams(marked, f"{folder}/streams", archive_bytes), "warc-streams")
    index = written(normalise(streams, f"{folder}/members"), "warc-index")
    files = max(1, min(index.select("file").distinct().count(), TASKS))
    return index, read_back(index, files)
