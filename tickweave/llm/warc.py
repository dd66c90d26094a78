"""WARC archives in Zstandard frames: written from pages, read back and validated."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.llm.common import cut, lowest, own_dir, store_of

# Fixed values of the formats.
WARC_VERSION = b"WARC/1.1"
VERSIONS = (WARC_VERSION, b"WARC/1.0")
DICTIONARY_MAGIC = 0x184D2A5D  # skippable frame that holds an archive's dictionary
FRAME_MAGIC = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads with fewer bytes are always stored.
REVISIT_BYTES = 1000
#: Groups of equal payloads that are broadcast, of about 80 bytes each.
BROADCAST = 200_000
#: Compressed bytes after which a task begins another archive.
ARCHIVE_BYTES = 32_000_000
#: The dictionary: its bytes, and the pages (those with the smallest hashes of their ids) and the bytes of each that it is made from.
DICTIONARY_BYTES, DICTIONARY_PAGES, PAGE_BYTES = 16_384, 256, 8_192
#: Tasks that read archives at most; beyond it a task reads several.
READERS = 100_000
DATE = "2024-01-01T00:00:00Z"
CHUNK = 1 << 16

MANIFEST = T.StructType([T.StructField("path", T.StringType()), T.StructField("records", T.LongType()), T.StructField("bytes", T.LongType())])
RECORDS = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("html", T.StringType()),
    ]
)


class BadArchive(ValueError):
    """An archive that breaks its format, with the place where it does."""


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_of(name: str) -> int | None:
    kind, _, number = name.strip("<>").rpartition(":")
    if kind != "urn:page":
        raise BadArchive(f"not a page's record: {name}")
    return None if number == "none" else int(number)


def _uri(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url)


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [WARC_VERSION, b"WARC-Type: " + kind.encode(), *(f"{k}: {v}".encode() for k, v in headers), b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit that has the response's HTTP headers alone."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    headers = [("WARC-Record-ID", _name(page_id)), ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if url is not None:
        headers.append(("WARC-Target-URI", _uri(url)))
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if refers_to is None:
        return record("response", headers, http + payload)
    return record("revisit", [*headers, ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _name(refers_to))], http)


def _headers(data: bytes, where: str, repeats: bool = False) -> tuple[bytes, dict[str, str], bytes]:
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap:
        raise BadArchive(f"{where}: headers do not end")
    first, *lines = head.split(b"\r\n")
    found: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        name = name.lower()
        if not colon or not name.strip() or (name in found and not repeats):
            raise BadArchive(f"{where}: bad or repeated header {name!r}")
        found[name] = f"{found[name]}, {value.strip()}" if name in found else value.strip()
    return first, found, rest


def _length(headers: dict[str, str], where: str) -> int:
    value = headers.get("content-length", "")
    if not value.isdecimal():
        raise BadArchive(f"{where}: Content-Length {value!r}")
    return int(value)


def parse_any(data: bytes, where: str = "record") -> dict:
    """A frame's record of any kind, its headers, length and, where it has any, SHA-1 digests checked.

    ``payload`` is the block, or what follows the headers of an HTTP message.
    """
    first, headers, block = _headers(data, where)
    if first not in VERSIONS:
        raise BadArchive(f"{where}: begins with {first[:20]!r}")
    missing = {"warc-type", "warc-record-id", "warc-date"} - headers.keys()
    if missing:
        raise BadArchive(f"{where}: no {sorted(missing)}")
    n = _length(headers, where)
    if len(block) != n + 4 or block[n:] != b"\r\n\r\n":
        raise BadArchive(f"{where}: Content-Length {n}, but {len(block) - 4} bytes")
    block, kind = block[:n], headers["warc-type"]
    status, http, payload = b"", {}, block
    if headers.get("content-type", "").startswith("application/http"):
        status, http, payload = _headers(block, where, repeats=True)
        if kind in ("response", "revisit") and not status.startswith(b"HTTP/"):
            raise BadArchive(f"{where}: no HTTP status line")
        if kind == "response" and "content-length" in http and len(payload) != _length(http, where):
            raise BadArchive(f"{where}: the payload is not that of its length")
        if kind == "revisit" and payload:
            raise BadArchive(f"{where}: a revisit with a payload")
    for name, covered in (("warc-block-digest", block), ("warc-payload-digest", payload)):
        scheme, _, digest = headers.get(name, "").partition(":")
        if scheme == "sha1" and not (kind == "revisit" and covered is payload) and base64.b32decode(digest) != hashlib.sha1(covered).digest():
            raise BadArchive(f"{where}: {name} is not that of the content")
    return {"record_id": headers["warc-record-id"], "record_type": kind, "date": headers["warc-date"], "target_uri": headers.get("warc-target-uri"), "headers": headers, "status": status.decode("latin-1"), "http": http, "payload": payload}


def parse(data: bytes, where: str = "record") -> dict | None:
    """A frame's record of a page; None for records that hold no page.  A page's record must have its length and SHA-1."""
    got = parse_any(data, where)
    kind, headers = got["record_type"], got["headers"]
    if kind not in ("response", "revisit"):
        return None
    scheme, _, digest = headers.get("warc-payload-digest", "").partition(":")
    if scheme != "sha1":
        raise BadArchive(f"{where}: no sha1 payload digest")
    refers = _page_of(headers["warc-refers-to"]) if kind == "revisit" else None
    return {
        "page_id": _page_of(got["record_id"]), "url": got["target_uri"], "payload_bytes": _length(got["http"], where), "payload_digest": base64.b32decode(digest).hex(),
        "record_type": kind, "refers_to": refers, "html": got["payload"].decode() if kind == "response" else None,
    }


def frames(stream, where: str = "archive") -> Iterator[bytes]:
    """The records of an archive, one for each frame after the dictionary's; no more than one is held at a time."""
    buffer, decoder, number = b"", zstandard.ZstdDecompressor(), 0

    def more(n: int) -> bool:
        nonlocal buffer
        while len(buffer) < n and (got := stream.read(CHUNK)):
            buffer += got
        return len(buffer) >= n

    while more(1):
        if not more(8):
            raise BadArchive(f"{where}: frame {number} is cut short")
        magic, size = struct.unpack("<II", buffer[:8])
        if magic == DICTIONARY_MAGIC and number == 0:
            if not more(8 + size):
                raise BadArchive(f"{where}: the dictionary is cut short")
            content, buffer = buffer[8 : 8 + size], buffer[8 + size :]
            if content[:4] == struct.pack("<I", FRAME_MAGIC):
                content = zstandard.ZstdDecompressor().decompress(content, max_output_size=1 << 27)
            decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
        elif magic == FRAME_MAGIC:
            frame, parts = decoder.decompressobj(), []
            try:
                while not frame.eof:
                    if not buffer and not more(1):
                        raise BadArchive(f"{where}: frame {number} is cut short")
                    parts.append(frame.decompress(buffer))
                    buffer = frame.unused_data if frame.eof else b""
            except zstandard.ZstdError as error:
                raise BadArchive(f"{where}: frame {number}: {error}") from error
            yield b"".join(parts)
        else:
            raise BadArchive(f"{where}: frame {number} has magic {magic:#x}")
        number += 1


def dictionary(pages: DataFrame) -> bytes:
    """A dictionary from a bounded, stated sample of pages; it bears on sizes alone, never on what is read back."""
    ids = lowest(pages.where("html is not null and html <> ''").select("page_id").dropna().distinct(), DICTIONARY_PAGES, "page_id")
    heads = pages.join(F.broadcast(ids), "page_id").groupBy("page_id").agg(F.min(F.substring("html", 1, PAGE_BYTES)).alias("html"))
    texts = [page_record(0, "http://example.org/", (x.html or "").encode(), None) for x in heads.orderBy("page_id").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except zstandard.ZstdError:  # too few samples: their own bytes serve
        return (page_record(0, "http://example.org/", b"", None) + b"".join(texts))[-DICTIONARY_BYTES:]


def classified(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, payload, refers_to): refers_to names the response of equal payloads, null for responses.

    Payloads are told apart by SHA-256 and length.  Only groups of two and more
    pages are joined: all by broadcast up to ``BROADCAST`` of them, so pages are
    read once and not shuffled; if there are more, digests that more than a
    1024th of the pages share, at most 1024, are broadcast, and no other is hot.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.when(F.length("payload") >= REVISIT_BYTES, F.sha2("payload", 256)))
    groups = rows.where("sha is not null").groupBy("sha").agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("same"))
    groups = cut(groups.where("same > 1 and top is not null"))
    names = ["page_id", "url", "payload", "top"]
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("top")), F.col("top")).alias("refers_to")
    if groups.count() <= BROADCAST:
        return rows.join(F.broadcast(groups), "sha", "left").select("page_id", "url", "payload", refers)
    total = pages.count()
    hot, cold = groups.where(F.col("same") * 1024 > total), groups.where(F.col("same") * 1024 <= total)
    often = rows.join(F.broadcast(hot), "sha")
    rest = rows.join(F.broadcast(hot.select("sha")), "sha", "left_anti")
    once = rest.where("sha is null").select("page_id", "url", "payload", F.lit(None).cast("long").alias("top"))
    seldom = rest.where("sha is not null").join(cold, "sha", "left")
    both = often.select(names).unionByName(seldom.select(names)).unionByName(once)
    return both.select("page_id", "url", "payload", refers)


def write(pages: DataFrame, folder: str, rows: DataFrame | None = None) -> DataFrame:
    """Writes every page into archives in a shared folder; returns the manifest of those that are whole.

    A task writes archives of its own under new names and then lists them, so
    one that is run again or lost leaves at most a file that no manifest has.
    """
    content = dictionary(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(folder)
        store.create_dir(base, recursive=True)
        press = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(content), write_content_size=True)
        opened, done = None, []

        def close() -> None:
            nonlocal opened
            if opened:
                opened["stream"].close()
                done.append((f"{folder}/{opened['name']}", opened["records"], opened["bytes"]))
                opened = None

        def put(data: bytes) -> None:
            opened["stream"].write(data)
            opened["bytes"] += len(data)

        for batch in batches:
            for page_id, url, payload, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to")), strict=True):
                if opened is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    opened = {"name": name, "stream": store.open_output_stream(f"{base}/{name}", compression=None), "records": 0, "bytes": 0}
                    put(struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content)
                    info = record("warcinfo", [("WARC-Record-ID", f"<urn:archive:{name}>"), ("WARC-Date", DATE)], b"format: WARC File Format 1.1\r\n")
                    put(press.compress(info))
                put(press.compress(page_record(page_id, url, payload, refers)))
                opened["records"] += 1
                if opened["bytes"] >= ARCHIVE_BYTES:
                    close()
        close()
        if done:
            columns = zip(*done, strict=True)
            yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], MANIFEST.names)

    return cut((classified(pages) if rows is None else rows).mapInArrow(run, MANIFEST))


def read(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the archives, validated; an archive is read by one task as a stream.

    Without ``payloads`` the column html is null.  A record that breaks the
    format, or an archive with other than its listed number of pages, is an
    error that names the archive.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, expected in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True):
                store, inner = store_of(path)
                found, seen = [], 0
                with store.open_input_stream(inner, compression=None) as stream:
                    for number, data in enumerate(frames(stream, path)):
                        row = parse(data, f"{path}, record {number}")
                        if row is None:
                            continue
                        seen += 1
                        found.append(row if payloads else row | {"html": None})
                        if len(found) == 500:
                            yield _rows(found)
                            found = []
                if found:
                    yield _rows(found)
                if seen != expected:
                    raise BadArchive(f"{path}: {seen} pages, {expected} listed")

    tasks = min(max(manifest.count(), 1), READERS)  # a number, as the few bytes of a manifest would else be put into one task
    return manifest.repartition(tasks).mapInArrow(run, RECORDS)


#: Any record: HTTP headers have their names in lower case.
ANY = T.StructType(
    [T.StructField(x, T.StringType()) for x in ("record_id", "record_type", "date", "target_uri", "status")]
    + [T.StructField(x, T.MapType(T.StringType(), T.StringType())) for x in ("headers", "http")]
    + [T.StructField("payload", T.BinaryType())]
)


def records(paths: DataFrame) -> DataFrame:
    """Every record of the archives at ``path``, of any kind, whoever wrote them; see ``parse_any``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, inner = store_of(path)
                with store.open_input_stream(inner, compression=None) as stream:
                    for number, data in enumerate(frames(stream, path)):
                        got = parse_any(data, f"{path}, record {number}")
                        maps = [pa.array([list(got[x].items())], pa.map_(pa.string(), pa.string())) for x in ("headers", "http")]
                        yield pa.record_batch([*[pa.array([got[x]], pa.string()) for x in ANY.names[:5]], *maps, pa.array([got["payload"]], pa.binary())], ANY.names)

    tasks = min(max(paths.count(), 1), READERS)
    return paths.select("path").repartition(tasks).mapInArrow(run, ANY)


def _rows(found: list[dict]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    return pa.record_batch([pa.array([x[n] for x in found], k) for n, k in zip(RECORDS.names, kinds, strict=True)], RECORDS.names)


def round_trip(pages: DataFrame, payloads: bool = False) -> DataFrame:
    """Writes every page into archives in the shared folder and reads them back.

    Of pages with equal payloads of at least 1000 bytes the one with the
    largest id is the response and the others revisit it; rows that repeat
    this id are responses too.  Pages without an id are kept; they revisit if
    some equal page has an id.  Null html is empty.  No pages, no archives.
    """
    folder = f"{own_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    return read(write(pages, folder), payloads)


def sql() -> str:
    """The digests of ``round_trip`` over the table pages in DuckDB."""
    return (
        f"WITH p AS (SELECT page_id, url, coalesce(html, '') AS x, octet_length(encode(coalesce(html, ''))) AS n FROM pages), t AS (SELECT *, CASE WHEN n >= {REVISIT_BYTES} THEN max(page_id) OVER (PARTITION BY x) END AS top FROM p) "
        "SELECT page_id, url, CAST(n AS BIGINT) AS payload_bytes, sha1(x) AS payload_digest, CASE WHEN top IS NOT NULL AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type, "
        "CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to FROM t"
    )
