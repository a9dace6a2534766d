"""WARC archives of pages in Zstandard frames, written and read back.

An archive begins with a skippable frame (magic 0x184D2A5D) that holds the
dictionary, itself compressed; each record is one frame compressed with that
dictionary.  The reader loads the dictionary from the leading frame, decodes
frame by frame, and checks version line, required headers, block length,
closing line ends and payload digest of every record.

Writing: payloads are grouped by SHA-1 digest and length (aggregated before the
shuffle); the page with the greatest id is the response, equal payloads become
revisits that name it.  Tasks write archives of at most ``ARCHIVE_BYTES`` of
payload to the shared folder under names of their own; the manifest lists only
what successful attempts returned, so a retried task leaves no double records.

Archives are read by as many tasks as there are archives.

Defined results: a null payload is empty; a null url is left out; an id of any
text is escaped in its header; an empty table writes and reads nothing; other
columns than the three are not read; a null page
id is never the greatest, and equal payloads without any id are all responses;
rows repeated with the greatest id are all responses.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shared_folder, stored

DICTIONARY_MAGIC = 0x184D2A5D
ARCHIVE_BYTES = 32 << 20
#: Bytes of an archive's first records that its dictionary is trained on, and
#: the dictionary's size.
SAMPLE_BYTES, DICTIONARY_BYTES = 2 << 20, 32 << 10
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
_FALLBACK = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Type: application/http; msgtype=response\r\n" * 4


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: str | None, url: str | None, payload: bytes, response: str | None, date: str = DATE) -> bytes:
    """One record; a revisit of page ``response`` if that is given."""
    revisit = response is not None
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", f"<urn:page:{quote(page, safe='')}>" if page is not None else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, base32_sha1(payload))}>"),
            ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")))
    head.append(("WARC-Payload-Digest", "sha1:" + base32_sha1(payload)))
    if revisit:
        head += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<urn:page:{quote(response, safe='')}>")]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"


def train(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:                 # too few or too small samples
        return zstandard.ZstdCompressionDict(_FALLBACK, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def parse(raw: bytes) -> dict:
    """Headers, HTTP headers and payload of one record; raises ValueError."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not mark or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError(f"no WARC version line: {lines[0][:40]!r}")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"malformed header line {line[:80]!r}")
        headers[name.strip()] = value.strip()
    if missing := [k for k in _REQUIRED if k not in headers]:
        raise ValueError(f"headers missing: {missing}")
    size = int(headers["Content-Length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"block of {len(rest) - 4} bytes, Content-Length {size}")
    http, mark, payload = rest[:size].partition(b"\r\n\r\n")
    if not mark:
        raise ValueError("no HTTP header end")
    fields = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
    kind = headers["WARC-Type"]
    if kind == "response":
        if int(fields["Content-Length"]) != len(payload):
            raise ValueError("payload length differs from the HTTP header")
        if headers.get("WARC-Payload-Digest") != "sha1:" + base32_sha1(payload):
            raise ValueError("payload digest differs")
    elif kind != "revisit" or payload or "WARC-Refers-To" not in headers:
        raise ValueError(f"bad record of type {kind!r}")
    return {"headers": headers, "http": fields, "payload": payload}


def read_archive(stream, chunk: int = 1 << 20) -> Iterator[dict]:
    """Records of one archive, frame by frame."""
    head = stream.read(8)
    magic, size = struct.unpack("<II", head) if len(head) == 8 else (0, 0)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no leading dictionary frame")
    packed = stream.read(size)
    if len(packed) != size:
        raise ValueError("dictionary frame cut short")
    raw = zstandard.ZstdDecompressor().decompress(packed) if packed[:4] == b"\x28\xb5\x2f\xfd" else packed
    kind = zstandard.DICT_TYPE_FULLDICT if raw[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw, dict_type=kind))
    data = b""
    while True:
        data = data or stream.read(chunk)
        if not data:
            return
        frame, out = decoder.decompressobj(), []
        while True:
            out.append(frame.decompress(data))
            if frame.eof:
                data = frame.unused_data
                break
            data = stream.read(chunk)
            if not data:
                raise ValueError("last frame cut short")
        yield parse(b"".join(out))


class ArchiveWriter:
    """Writes rolling archives below one folder."""

    def __init__(self, folder: str, archive_bytes: int, sample_bytes: int):
        self.folder, self.limit, self.sample = folder, archive_bytes, sample_bytes
        self.held, self.held_bytes, self.out, self.done = [], 0, None, []

    def add(self, raw: bytes) -> None:
        if self.out is not None:
            self._put(raw)
            return
        self.held.append(raw)
        self.held_bytes += len(raw)
        if self.held_bytes >= self.sample:
            self._open()

    def _open(self) -> None:
        dictionary = train(self.held)
        self.coder = zstandard.ZstdCompressor(level=6, dict_data=dictionary)
        self.path = f"{self.folder}/pages-{uuid.uuid4().hex}.warc.zst"
        store, where = fs.FileSystem.from_uri(self.path)
        store.create_dir(where.rsplit("/", 1)[0], recursive=True)
        self.out = store.open_output_stream(where, compression=None)
        packed = zstandard.ZstdCompressor(level=6).compress(dictionary.as_bytes())
        self.out.write(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
        self.n = self.bytes = 0
        held, self.held, self.held_bytes = self.held, [], 0
        for raw in held:
            self._put(raw)

    def _put(self, raw: bytes) -> None:
        if self.out is None:
            self.add(raw)
            return
        self.out.write(self.coder.compress(raw))
        self.n, self.bytes = self.n + 1, self.bytes + len(raw)
        if self.bytes >= self.limit:
            self._close()

    def _close(self) -> None:
        self.out.close()
        self.done.append((self.path, self.n))
        self.out = None

    def finish(self) -> list[tuple[str, int]]:
        while self.held or self.out is not None:
            if self.out is None:
                self._open()
            if self.out is not None:
                self._close()
        return self.done


def as_uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else "file://" + folder


def write_archives(pages: DataFrame, folder: str, *, page_id: str = "page_id", url: str = "url", html: str = "html",
                   min_revisit_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES,
                   sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """Write all pages; the manifest (path, records) as a stored table."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    base = pages.select(F.col(page_id).cast("string").alias("page"), F.col(page_id).alias("id"), F.col(url).alias("url"),
                        payload.alias("payload"), F.unhex(F.sha1(payload)).alias("digest"))
    heads = (base.filter(F.octet_length("payload") >= min_revisit_bytes)
             .groupBy("digest", F.octet_length("payload").alias("size")).agg(F.max("id").alias("head"), F.count("*").alias("n"))
             .filter("n > 1").select("digest", "size", "head"))
    marked = (base.withColumn("size", F.octet_length("payload")).join(heads, ["digest", "size"], "left")
              .select("page", "url", "payload", F.when(F.col("id").eqNullSafe(F.col("head")), F.lit(None))
                      .otherwise(F.col("head")).cast("string").alias("response")))
    target = as_uri(folder)
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("records", T.LongType())])

    def run(batches):
        writer = ArchiveWriter(target, archive_bytes, sample_bytes)
        for batch in batches:
            columns = [batch.column(i) for i in range(4)]
            for i in range(batch.num_rows):
                page, link, body, response = (c[i].as_py() for c in columns)
                writer.add(record(page, link, body, response))
        done = writer.finish()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())],
                                         names=["path", "records"])

    return stored(marked.mapInArrow(run, schema), "warc-manifest")


def read_archives(manifest: DataFrame, *, with_payload: bool = True) -> DataFrame:
    """(page, url, record_type, refers_to, payload_bytes, payload_digest,
    payload) of every record of the listed archives."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("page", "url", "record_type", "refers_to")]
                          + [T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
                             T.StructField("payload", T.BinaryType())])

    def id_of(urn):
        return unquote(urn[len("<urn:page:"):-1]) if urn and urn.startswith("<urn:page:") else None

    def run(batches):
        for batch in batches:
            for path, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, where = fs.FileSystem.from_uri(path)
                rows, n, held = [], 0, 0
                with store.open_input_stream(where, compression=None) as stream:
                    for r in read_archive(stream):
                        h = r["headers"]
                        rows.append((id_of(h["WARC-Record-ID"]), h.get("WARC-Target-URI"), h["WARC-Type"], id_of(h.get("WARC-Refers-To")),
                                     int(r["http"]["Content-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:"),
                                     r["payload"] if with_payload else None))
                        n, held = n + 1, held + len(r["payload"])
                        if len(rows) >= 5_000 or held >= 8 << 20:
                            yield _batch(rows, schema)
                            rows, held = [], 0
                if n != expected:
                    raise ValueError(f"{path} has {n} records, the manifest {expected}")
                if rows:
                    yield _batch(rows, schema)

    # a partition count of its own: the manifest is far smaller than what it lists
    return manifest.repartition(max(1, manifest.count()), "path").mapInArrow(run, schema)


def _batch(rows, schema):
    kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(7)], names=schema.names)


def round_trip(pages: DataFrame, *, page_id: str = "page_id", **options) -> DataFrame:
    """Write all pages to a new shared folder and read every record back."""
    folder = shared_folder(pages.sparkSession, "warc")
    read = read_archives(write_archives(pages, folder, page_id=page_id, **options), with_payload=False)
    kind = pages.schema[page_id].dataType
    return read.select(F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast(kind).alias("refers_to"), "url")
