"""WARC archives of crawled pages: written as one gzip stream each, then normalised to one member per record.

`classify` finds equal payloads, `write` stores records in monolithic archives, `normalise` inflates each archive once as
a stream, rewrites every record as a gzip member of its own and writes an offset index beside it, and `read` fetches the
records back through that index. Archives live in a folder that all executors share; their names carry the partition and
the attempt, and later steps use only those names that a finished task has returned, so lost or repeated tasks do no harm.

Null html is an empty payload, a null url has no target header, and a null page_id never is the record that others refer
to. Of records with equal payloads of `least` bytes or more, that with the smallest page_id is the response and the rest
revisit it; repeated rows with that id are all responses. An empty table gives no archives and no rows.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sundial.llm.shared import saved, shared_folder

GZIP = 31
CHUNK = 1 << 20
ROLL = 256 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVES = "archive string, records long"
NORMALISED = "archive string, index string, records long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def classify(pages: DataFrame, least: int = 100) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, record_type and refers_to of every page.

    Equal payloads are found on their digests with combined minima; only digests that occur twice are joined back.
    """
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    own = own.select("*", F.octet_length("html").cast("long").alias("payload_bytes"), F.sha2(F.encode("html", "UTF-8"), 256).alias("payload_digest"))
    first = (own.where(F.col("payload_bytes") >= least).groupBy("payload_digest")
             .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1 AND first_id IS NOT NULL").drop("n"))
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return (own.join(first, "payload_digest", "left")
            .select("page_id", "url", "html", "payload_bytes", "payload_digest",
                    F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first_id")).alias("refers_to")))


def _record(page_id: int | None, url: str | None, html: str, size: int, digest: str, kind: str, refers_to: int | None) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=SAFE)}")
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {size}"]
    body = html.encode()
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
        body = b""
    lines += ["Content-Type: text/html", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


#: Kept in a target address; all else is percent-encoded, so that no address can break a header.
SAFE = "!#$&'()*+,/:;=?@[]~%-._"


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    files, path = fs.FileSystem.from_uri(folder)
    return files, path


def write(classified: DataFrame, folder: str, level: int = 3) -> DataFrame:
    """Records into monolithic archives, one gzip stream each; a row per archive."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = _open(folder)
        files.create_dir(top, recursive=True)
        context = TaskContext.get()
        stem = f"{context.partitionId()}-{context.taskAttemptId()}"
        names, counts, sink = [], [], None
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if sink is None:
                        names.append(f"raw-{stem}-{len(names)}.warc.gz")
                        counts.append(0)
                        sink, pack, size = files.open_output_stream(f"{top}/{names[-1]}", compression=None), zlib.compressobj(level, wbits=GZIP), 0
                    record = _record(*row)
                    sink.write(pack.compress(record))
                    counts[-1] += 1
                    size += len(record)
                    if size >= ROLL:
                        sink.write(pack.flush())
                        sink.close()
                        sink = None
        if sink is not None:
            sink.write(pack.flush())
            sink.close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["archive", "records"])

    return classified.select("page_id", "url", "html", "payload_bytes", "payload_digest", "record_type", "refers_to").mapInArrow(run, ARCHIVES)


class Inflated:
    """Bytes of a gzip file, inflated once in bounded pieces; members that follow one another count as one stream."""

    def __init__(self, source):
        self.source, self.packed, self.held, self.at = source, b"", b"", 0
        self.inflater, self.begun = zlib.decompressobj(GZIP), False

    def _more(self) -> bool:
        while True:
            if not self.packed:
                self.packed = self.source.read(CHUNK)
                if not self.packed:
                    if self.begun and not self.inflater.eof:
                        raise ValueError("the archive ends inside a gzip stream")
                    return False
            if self.inflater.eof:
                self.inflater = zlib.decompressobj(GZIP)
            self.begun = True
            out = self.inflater.decompress(self.packed, CHUNK)
            self.packed = self.inflater.unused_data if self.inflater.eof else self.inflater.unconsumed_tail
            if out:
                self.held = self.held[self.at:] + out
                self.at = 0
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with the mark; None at the end."""
        while (end := self.held.find(mark, self.at)) < 0:
            if not self._more():
                if self.at < len(self.held):
                    raise ValueError("the archive ends inside a header")
                return None
        out = self.held[self.at:end + len(mark)]
        self.at = end + len(mark)
        return out

    def exactly(self, count: int) -> bytes:
        pieces = []
        while count:
            if self.at == len(self.held) and not self._more():
                raise ValueError("the archive ends inside a record")
            piece = self.held[self.at:self.at + count]
            pieces.append(piece)
            self.at += len(piece)
            count -= len(piece)
        return b"".join(pieces)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return dict(line.split(": ", 1) for line in lines[1:] if line)


def normalise(archives: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Every record as a gzip member of its own, and an index of their offsets; a row per archive."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = _open(folder)
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                out = f"{name.removeprefix('raw-').removesuffix('.warc.gz')}-{attempt}"
                offset = count = 0
                with files.open_input_stream(f"{top}/{name}", compression=None) as source, files.open_output_stream(f"{top}/{out}.warc.gz", compression=None) as sink, \
                        files.open_output_stream(f"{top}/{out}.idx", compression=None) as index:
                    stream = Inflated(source)
                    while (head := stream.until(b"\r\n\r\n")) is not None:
                        fields = _fields(head)
                        pack = zlib.compressobj(level, wbits=GZIP)
                        member = pack.compress(head + stream.exactly(int(fields["Content-Length"]) + 4)) + pack.flush()
                        sink.write(member)
                        index.write(json.dumps([fields["WARC-Record-ID"], offset, len(member)]).encode() + b"\n")
                        offset += len(member)
                        count += 1
                yield pa.RecordBatch.from_arrays([pa.array([f"{out}.warc.gz"]), pa.array([f"{out}.idx"]), pa.array([count])], ["archive", "index", "records"])

    return archives.repartition(max(1, archives.count()), "archive").mapInArrow(run, NORMALISED)


def _page(mark: str) -> int | None:
    number = mark.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def read(normalised: DataFrame, folder: str) -> DataFrame:
    """Records through the index; the payload of a response is digested anew and held against its header."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = _open(folder)
        for batch in batches:
            for archive, index in zip(batch.column("archive").to_pylist(), batch.column("index").to_pylist(), strict=True):
                rows: list[tuple] = []
                held = 0
                with files.open_input_file(f"{top}/{archive}") as source, files.open_input_stream(f"{top}/{index}", compression=None, buffer_size=CHUNK) as entries:
                    for entry in _lines(entries):
                        _, offset, length = json.loads(entry)
                        if source.tell() != offset:
                            source.seek(offset)
                        record = zlib.decompress(source.read(length), GZIP)
                        cut = record.index(b"\r\n\r\n") + 4
                        fields, payload = _fields(record[:cut]), record[cut:-4]
                        digest, size = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["WARC-Payload-Length"])
                        kind, refers_to = fields["WARC-Type"], fields.get("WARC-Refers-To")
                        if kind == "response" and (hashlib.sha256(payload).hexdigest(), len(payload)) != (digest, size):
                            raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
                        rows.append((_page(fields["WARC-Record-ID"]), size, digest, kind, refers_to and _page(refers_to), fields.get("WARC-Target-URI"), payload))
                        held += len(payload)
                        if held >= 4 * CHUNK or len(rows) >= 1000:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return normalised.repartition(max(1, normalised.count()), "archive").mapInArrow(run, RECORDS)


def _lines(stream) -> Iterator[bytes]:
    rest = b""
    while chunk := stream.read(CHUNK):
        *whole, rest = (rest + chunk).split(b"\n")
        yield from whole


NAMES = [c.split()[0] for c in RECORDS.split(", ")]
TYPES = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]] for c in RECORDS.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)], NAMES)


def round_trip(pages: DataFrame, least: int = 100) -> DataFrame:
    """Write all pages, normalise the archives and read every record back."""
    folder = f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    archives = saved(write(classify(pages, least), folder), "archives")
    normalised = saved(normalise(archives, folder), "normalised")
    return read(normalised, folder)
