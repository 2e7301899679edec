"""WARC archives: written as one gzip stream a file, normalised to one member a record.

``write_archives`` lets every task write its pages as WARC records into whole-file gzip
streams, a new file whenever one is full. ``normalise`` then goes through each such file
once: it inflates the stream piece by piece, rewrites every record as a gzip member of its
own, and writes beside the archive an index with the offset and length of every member. On
the way records whose payload another record already holds become revisit records without
a payload. Which record that is, is settled before, by a merge tree over the records'
digests, so equal payloads may lie in any files and make up any share of all records.
``read_archives`` gets the records back by the index, each from its own member.

Tasks write through ``pyarrow.fs`` to the folder they are given, which must be shared
(a file, hdfs, s3 or gs address); pages are only ever read by Spark. File names hold the
attempt, and only files named in a table that Spark has committed are read on, so lost
executors and repeated attempts leave files behind but change nothing. A task holds one
record at a time and one file's list of revisits, of which ``MAX_RECORDS`` is the bound.

Defined results: a null payload is empty; empty payloads are equal to each other like any
others. A null page number loses against others as the record that others refer to. Rows
with equal number and payload are one response and revisits. A null address is written as no
address and read as null. An empty table gives no archives and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrank.llm.exact_dedup import merge_tree
from tallyrank.sources.scratch import materialize

MAX_BYTES = 128 << 20  # of uncompressed records in one archive
MAX_RECORDS = 20_000
_CHUNK = 1 << 20
_GZIP = 16 + zlib.MAX_WBITS
_IDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the namespace for addresses
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = (
    "page_id string, file string, seq int, payload_bytes long, digest binary"
)


def _open(root: str):
    return pafs.FileSystem.from_uri(root)


def digest_text(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(file: str, seq: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_IDS, f'{file}#{seq}')}>"


def record_bytes(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [*fields, ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _http(payload_bytes: int) -> bytes:
    return (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {payload_bytes}\r\n\r\n"
    ).encode()


def _response(file, seq, page_id, url, payload: bytes, digest: bytes, date: str) -> bytes:
    block = _http(len(payload)) + payload
    fields = [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", record_id(file, seq)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest_text(digest)}"),
        ("WARC-Block-Digest", f"sha1:{digest_text(hashlib.sha1(block).digest())}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("X-Payload-Bytes", str(len(payload))),
    ]
    if url is not None:
        # Only what would break a header line is coded, and the sign that codes it.
        safe = "".join(quote(c, safe="") if c in "%\r\n\0" or c.isspace() else c for c in url)
        fields.append(("WARC-Target-URI", safe))
    if page_id is not None:
        fields.append(("X-Page-Id", quote(page_id, safe="")))
    return record_bytes(fields, block)


def _revisit(fields: dict[str, str], refers_to: dict) -> bytes:
    changed = dict(fields)
    changed["WARC-Type"] = "revisit"
    block = _http(int(fields["X-Payload-Bytes"]))
    changed["WARC-Block-Digest"] = f"sha1:{digest_text(hashlib.sha1(block).digest())}"
    changed["WARC-Profile"] = _PROFILE
    changed["WARC-Refers-To"] = record_id(refers_to["file"], refers_to["seq"])
    if refers_to["page_id"] is not None:
        changed["X-Refers-To-Page-Id"] = quote(refers_to["page_id"], safe="")
    changed.pop("Content-Length")
    return record_bytes(list(changed.items()), block)


def split_records(stream: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record in a stream of inflated bytes."""
    held = bytearray()

    def fill(size: int) -> bool:
        while len(held) < size:
            more = next(stream, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while fill(1):
        searched = 0
        while (end := held.find(b"\r\n\r\n", searched)) < 0:
            searched = max(0, len(held) - 3)
            if not fill(len(held) + 1):
                raise ValueError("a record's header is cut short")
        lines = bytes(held[:end]).decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        size = int(fields["Content-Length"])
        if not fill(end + 4 + size + 4):
            raise ValueError("a record's block is cut short")
        yield fields, bytes(held[end + 4 : end + 4 + size])
        del held[: end + 4 + size + 4]


def inflate(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The bytes of a gzip stream of one or more members."""
    member = zlib.decompressobj(_GZIP)
    for chunk in chunks:
        while chunk:
            out = member.decompress(chunk, _CHUNK)
            if out:
                yield out
            if member.eof:
                chunk, member = member.unused_data, zlib.decompressobj(_GZIP)
            else:
                chunk = member.unconsumed_tail
    if rest := member.flush():
        yield rest


def _chunks(source) -> Iterator[bytes]:
    while chunk := source.read(_CHUNK):
        yield chunk


class _Writer:
    """Archives of one task, each a single gzip stream."""

    def __init__(self, root: str):
        self.fs, self.root = _open(root)
        self.fs.create_dir(self.root, recursive=True)
        task = TaskContext.get()
        self.prefix = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        self.number, self.out = 0, None

    def place(self) -> tuple[str, int]:
        if self.out is not None and (self.bytes >= MAX_BYTES or self.records >= MAX_RECORDS):
            self.close()
        if self.out is None:
            self.file = f"{self.prefix}-{self.number}.warc.gz"
            self.out = self.fs.open_output_stream(f"{self.root}/{self.file}", compression=None)
            self.gzip = zlib.compressobj(1, zlib.DEFLATED, _GZIP)
            self.bytes = self.records = 0
        return self.file, self.records

    def add(self, record: bytes) -> None:
        self.out.write(self.gzip.compress(record))
        self.bytes += len(record)
        self.records += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.write(self.gzip.flush())
            self.out.close()
            self.out, self.number = None, self.number + 1


def write_archives(
    pages: DataFrame,
    root: str,
    html_col: str = "html",
    id_col: str = "page_id",
    url_col: str = "url",
    date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Writes all pages; returns the committed list of records, one row per row of ``pages``."""
    id_type = pages.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(root)
        for batch in batches:
            rows = []
            for page_id, url, html in zip(*batch.columns):
                file, seq = writer.place()
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                digest = hashlib.sha1(payload).digest()
                number = page_id.as_py()
                writer.add(_response(file, seq, number, url.as_py(), payload, digest, date))
                rows.append((number, file, seq, len(payload), digest))
            types = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.binary())
            columns = zip(*rows) if rows else [()] * len(types)
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(
                arrays, names=["page_id", "file", "seq", "payload_bytes", "digest"]
            )
        writer.close()

    picked = pages.select(
        F.col(f"`{id_col}`").cast("string"), F.col(f"`{url_col}`"), F.col(f"`{html_col}`")
    )
    listed = materialize(picked.mapInArrow(run, _MANIFEST), "warc-records")
    return listed.withColumn("page_id", F.col("page_id").cast(id_type))


def find_revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``records`` with ``refers_to`` (page_id, file, seq), null for responses."""
    numbered = materialize(
        records.withColumn("row_id", F.monotonically_increasing_id()), "warc-numbered"
    )
    first = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "file", "seq", "row_id")
    merged = merge_tree(numbered, ["digest", "payload_bytes"], first)
    again = (F.col("row_id") != F.col("best.row_id")) & (F.col("payload_bytes") >= min_bytes)
    target = F.struct(
        F.col("best.page_id").cast("string").alias("page_id"), "best.file", "best.seq"
    )
    return merged.select("page_id", "file", "seq", F.when(again, target).alias("refers_to"))


def normalise(decided: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrites every archive of ``decided`` from ``source`` to ``target``; lists the new ones.

    An archive ``x.warc.gz`` gets the index ``x.warc.gz.index``, a JSON line per record.
    """

    def rewrite(file: str, revisits: dict[int, dict], attempt: int) -> tuple[str, int]:
        fs, base = _open(source)
        out_fs, out_base = _open(target)
        out_fs.create_dir(out_base, recursive=True)
        name = f"{file.removesuffix('.warc.gz')}-{attempt}.warc.gz"
        offset = n = 0
        with (
            fs.open_input_stream(f"{base}/{file}", compression=None) as raw,
            out_fs.open_output_stream(f"{out_base}/{name}", compression=None) as out,
            out_fs.open_output_stream(f"{out_base}/{name}.index", compression=None) as index,
        ):
            for n, (fields, block) in enumerate(split_records(inflate(_chunks(raw))), 1):
                if (to := revisits.get(n - 1)) is not None:
                    record = _revisit(fields, to)
                else:
                    record = record_bytes(
                        [(k, v) for k, v in fields.items() if k != "Content-Length"], block
                    )
                gzip = zlib.compressobj(6, zlib.DEFLATED, _GZIP)
                member = gzip.compress(record) + gzip.flush()
                out.write(member)
                line = {"offset": offset, "length": len(member), "id": fields["WARC-Record-ID"]}
                index.write(json.dumps(line).encode() + b"\n")
                offset += len(member)
        return name, n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for row in batch.to_pylist():
                revisits = {r["seq"]: r["refers_to"] for r in row["revisits"]}
                name, n = rewrite(row["file"], revisits, attempt)
                yield pa.RecordBatch.from_pylist([{"file": name, "records": n}])

    again = F.when(F.col("refers_to").isNotNull(), F.struct("seq", "refers_to"))
    files = decided.groupBy("file").agg(F.collect_list(again).alias("revisits"))
    return materialize(_dealt(files).mapInArrow(run, "file string, records long"), "warc-files")


def _dealt(files: DataFrame) -> DataFrame:
    """One task for about one file: the rows are small, the files behind them are not."""
    files = materialize(files, "warc-work")
    return files.repartition(max(1, min(files.count(), 100_000)), "file")


_RECORD = (
    "page_id string, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to string, payload binary"
)


def read_archives(files: DataFrame, root: str, payloads: bool = True) -> DataFrame:
    """A row per record of the archives that ``files`` lists, each read from its own member.

    Payloads are checked against their digests; revisit records have a null payload.
    """

    def one(member: bytes) -> dict:
        fields, block = next(split_records(iter([zlib.decompress(member, _GZIP)])))
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        payload = None
        if fields["WARC-Type"] == "response":
            payload = block[block.index(b"\r\n\r\n") + 4 :]
            if digest_text(hashlib.sha1(payload).digest()) != digest:
                raise ValueError(f"digest of {fields['WARC-Record-ID']} does not match")
        plain = {k: unquote(v) for k, v in fields.items() if k.startswith(("X-", "WARC-Target"))}
        return {
            "page_id": plain.get("X-Page-Id"),
            "url": plain.get("WARC-Target-URI"),
            "payload_bytes": int(fields["X-Payload-Bytes"]),
            "payload_digest": digest,
            "record_type": fields["WARC-Type"],
            "refers_to": plain.get("X-Refers-To-Page-Id"),
            "payload": payload if payloads else None,
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("page_id", pa.string()),
                ("url", pa.string()),
                ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()),
                ("record_type", pa.string()),
                ("refers_to", pa.string()),
                ("payload", pa.binary()),
            ]
        )
        fs, base = _open(root)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                with (
                    fs.open_input_stream(f"{base}/{file}.index", compression=None) as index,
                    fs.open_input_file(f"{base}/{file}") as archive,
                ):
                    rows, held = [], 0
                    for line in index.read().decode().splitlines():
                        entry = json.loads(line)
                        archive.seek(entry["offset"])
                        rows.append(one(archive.read(entry["length"])))
                        held += len(rows[-1]["payload"] or b"")
                        if len(rows) >= 5_000 or held > _CHUNK * 16:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return _dealt(files.select("file")).mapInArrow(run, _RECORD)


def archive_pages(pages: DataFrame, root: str, min_bytes: int = 0, **columns) -> DataFrame:
    """Writes, normalises and lists the archives of ``pages``; they are in ``root``/records."""
    records = write_archives(pages, f"{root}/streams", **columns)
    decided = find_revisits(records, min_bytes)
    return normalise(decided, f"{root}/streams", f"{root}/records")


def delete_streams(spark: SparkSession, root: str) -> None:
    """Deletes the archives as first written, once the normalised ones are listed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/streams")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
