"""WARC archives: written by tasks, read back sequentially.

Every record is a gzip member of its own. Of pages with equal payloads (of at least `min_bytes`)
the one with the largest id is a response and the others are revisits that refer to it and hold
HTTP headers only. Archives are files below the shared folder, of bounded size; a task names each
of its files anew and reports it when it is closed, so that what a lost attempt left is never read.

The reader streams a file through one zlib object per member, takes a record's headers up to the
empty line and its block by Content-Length, checks block and payload digests, the length that the
HTTP headers state, and that the member ends where the record does. Nothing beyond one record is held.

Defined cases: a null html is an empty payload. Rows that share the largest id of a payload are all
responses. A null id is smaller than any other; where all ids are null, all are responses and there
is nothing to refer to. Texts are written in UTF-8, so html with unpaired surrogates cannot occur.
An empty table gives no archive and no rows. Only the id, url and html columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.joins import fits_broadcast
from stratalake.sources.staging import Staging


@dataclass(frozen=True)
class WarcParams:
    min_bytes: int = 0
    # A file is closed after the record that takes it beyond this.
    file_bytes: int = 1 << 30
    # Tasks that read archives, for each core.
    readers_per_core: int = 4
    level: int = 5
    chunk_bytes: int = 1 << 16
    # Fixed, so that archives of equal pages are equal.
    date: str = "2024-01-01T00:00:00Z"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---- records ----

_ID, _NO_ID = "urn:x-page:", "null"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _page_uri(page_id: int | None) -> str:
    return f"<{_ID}{_NO_ID if page_id is None else page_id}>"


def page_of(uri: str) -> int | None:
    name = uri.removeprefix(f"<{_ID}").removesuffix(">")
    return None if name == _NO_ID else int(name)


def encode_record(
    page_id: int | None, url: str | None, payload: bytes, revisit: bool, refers_to: int | None,
    params: WarcParams = WarcParams(),
) -> bytes:
    """One record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    # White space cannot stand in a header's URI.
    target = "".join((url or "").split())
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_page_uri(page_id)}",
        f"WARC-Date: {params.date}", f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_page_uri(refers_to)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(params.level, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


class WarcError(ValueError):
    pass


class _Stream:
    """Inflated bytes of a file, member by member."""

    def __init__(self, source, chunk_bytes: int):
        self.source, self.chunk_bytes = source, chunk_bytes
        self.rest = b""
        self.inflater = None
        self.ready = bytearray()

    def next_member(self) -> bool:
        """Start the next member; false at the end of the file."""
        if self.inflater is not None:
            if self.ready or self._more():
                raise WarcError("data after the record in its member")
            self.rest = self.inflater.unused_data
        if not self.rest:
            self.rest = self.source.read(self.chunk_bytes)
        if not self.rest:
            return False
        self.inflater = zlib.decompressobj(31)
        return True

    def _more(self) -> bool:
        """Inflate on; false at the end of the member."""
        while not self.inflater.eof:
            compressed = self.inflater.unconsumed_tail or self.rest or self.source.read(self.chunk_bytes)
            self.rest = b""
            if not compressed:
                raise WarcError("the file ends within a member")
            got = self.inflater.decompress(compressed, self.chunk_bytes)
            if got:
                self.ready += got
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        at, seen = self.ready.find(mark), 0
        while at < 0:
            seen = max(0, len(self.ready) - len(mark) + 1)
            if not self._more():
                raise WarcError("a record without an end of headers")
            at = self.ready.find(mark, seen)
        out = bytes(self.ready[:at])
        del self.ready[: at + len(mark)]
        return out

    def exactly(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self._more():
                raise WarcError("a record shorter than its Content-Length")
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out


def _headers(raw: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = raw.decode().split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


@dataclass
class WarcRecord:
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes


def read_records(source, params: WarcParams = WarcParams()) -> Iterator[WarcRecord]:
    """Records of an open archive, in order, verified."""
    stream = _Stream(source, params.chunk_bytes)
    while stream.next_member():
        version, headers = _headers(stream.until(b"\r\n\r\n"))
        if not version.startswith("WARC/"):
            raise WarcError(f"not a WARC record: {version[:20]!r}")
        block = stream.exactly(int(headers["content-length"]))
        if stream.exactly(4) != b"\r\n\r\n":
            raise WarcError("a block longer than its Content-Length")
        if headers["warc-block-digest"] != f"sha1:{sha1_base32(block)}":
            raise WarcError(f"block digest of {headers['warc-record-id']}")
        head, _, payload = block.partition(b"\r\n\r\n")
        if headers["warc-type"] == "response" and headers["warc-payload-digest"] != f"sha1:{sha1_base32(payload)}":
            raise WarcError(f"payload digest of {headers['warc-record-id']}")
        http = _headers(head)[1]
        if headers["warc-type"] == "response" and int(http["content-length"]) != len(payload):
            raise WarcError(f"HTTP length of {headers['warc-record-id']}")
        yield WarcRecord(headers, http, payload)


# ---- files ----

def plain_uri(uri: str) -> str:
    """A folder's URI as Arrow names it: Spark may write file:/x for file:///x, and s3a for s3."""
    scheme, _, rest = uri.partition(":")
    if scheme == "file" and not rest.startswith("//"):
        return rest
    return f"s3:{rest}" if scheme in ("s3a", "s3n") else uri


def open_path(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or of an absolute path."""
    return pafs.FileSystem.from_uri(plain_uri(uri))


def _with_roles(pages: DataFrame, params: WarcParams, staging: Staging) -> DataFrame:
    """page_id, url, html, revisit and refers_to."""
    html = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select(
        "page_id", "url", "html", F.sha1(html.cast("binary")).alias("_digest"), F.octet_length(html).alias("_bytes")
    )
    shared = staging.table(
        keyed.where(F.col("_bytes") >= params.min_bytes).groupBy("_digest")
        .agg(F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1 and _last is not null").select(F.col("_digest").alias("_shared"), "_last")
    )
    # Payloads that occur once need no partner: usually a short list. Otherwise the pages are
    # shuffled, and adaptive execution splits a payload that many pages share.
    side = F.broadcast(shared) if fits_broadcast(shared) else shared
    revisit = F.coalesce(F.col("_last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_last")), F.lit(False))
    return keyed.join(side, F.col("_digest") == F.col("_shared"), "left").select(
        "page_id", "url", "html", revisit.alias("revisit"), F.when(revisit, F.col("_last")).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str, params: WarcParams, staging: Staging) -> DataFrame:
    """Write archives below `folder`; returns path and records of each file that is complete."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_path(folder)
        system.create_dir(base, recursive=True)
        out, name, records, size = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [records]})

        for batch in batches:
            for page_id, url, html, revisit, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, records, size = system.open_output_stream(f"{base}/{name}", compression=None), 0, 0
                raw = encode_record(page_id, url, (html or "").encode(), revisit, refers_to, params)
                out.write(raw)
                records, size = records + 1, size + len(raw)
                if size >= params.file_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    rows = _with_roles(pages, params, staging)
    return staging.table(rows.mapInArrow(run, "path string, records long"))


def read_archives(files: DataFrame, id_type: T.DataType, params: WarcParams) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record."""
    schema = T.StructType([
        T.StructField("page_id", id_type), T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", id_type),
    ])
    names, width = [f.name for f in schema.fields], 4096
    arrow_id = pa.int64() if isinstance(id_type, T.LongType) else pa.int32()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [arrow_id, pa.int64(), pa.string(), pa.string(), arrow_id]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, records in zip(*(batch.column(n).to_pylist() for n in ("path", "records"))):
                system, place = open_path(path)
                rows, n = [], 0
                with system.open_input_stream(place, compression=None) as source:
                    for record in read_records(source, params):
                        kind, n = record.headers["warc-type"], n + 1
                        refers = record.headers.get("warc-refers-to")
                        # A revisit has no payload of its own: its HTTP headers state the length.
                        size = int(record.http["content-length"]) if kind == "revisit" else len(record.payload)
                        rows.append((
                            page_of(record.headers["warc-record-id"]), size,
                            record.headers["warc-payload-digest"].removeprefix("sha1:"), kind,
                            page_of(refers) if refers else None,
                        ))
                        if len(rows) == width:
                            yield batch_of(rows)
                            rows = []
                if n != records:
                    raise WarcError(f"{path} holds {n} records instead of {records}")
                if rows:
                    yield batch_of(rows)

    # Dealt evenly, over no more tasks than keep every core busy: a task streams its files.
    most = params.readers_per_core * files.sparkSession.sparkContext.defaultParallelism
    return files.repartition(max(1, min(files.count(), most))).mapInArrow(run, schema)


def round_trip(pages: DataFrame, params: WarcParams = WarcParams()) -> DataFrame:
    """Write all pages to archives and read them back."""
    staging = Staging(pages.sparkSession)
    files = write_archives(pages.select("page_id", "url", "html"), staging.folder(), params, staging)
    return read_archives(files, pages.schema["page_id"].dataType, params)
