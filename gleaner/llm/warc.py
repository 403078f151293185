"""WARC archives: a deterministic sharded writer with revisit records, and a reader.

The shard of a record is a range of ids, a function of the data alone; inside a shard records are
sorted and files roll by compressed size, so the same rows give the same bytes whatever the number
of tasks. A file is written under a temporary name and renamed when whole; it counts once the
manifest, written last, lists it. A task that runs twice replaces files by equal ones.
"""

from __future__ import annotations

import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.text import small_batches
from gleaner.sources.files import staged

#: Bytes of payload that a shard should hold, compressed bytes after which a file is closed, and
#: bytes from which a payload that was seen before is replaced by a revisit record.
SHARD_BYTES, ROLL_BYTES, REVISIT_BYTES = 32 << 20, 32 << 20, 100

# Names that the format prescribes.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"  # the tables have no dates; a clock would make every run differ

FILES = "shard long, path string, records long, bytes long, sha256 string"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member without time stamp."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id, url, html, digest, payload_bytes, refers_to) -> bytes:
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    block = http if revisit else http + (html or "").encode()
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", DATE),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", "".join(c if c > " " else f"%{ord(c):02X}" for c in url)))
    if page_id is not None:
        headers.append(("WARC-Page-ID", str(page_id)))
    if revisit:
        headers += [
            ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)),
            ("WARC-Refers-To-Page-ID", str(refers_to)),
        ]
    headers += [
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return member(headers, block)


def shard_span(sizes: DataFrame, shard_bytes: int) -> int:
    """How many ids make a shard: few enough that the fullest shard holds under four times the aim.

    Where ids lie far apart in one place and close in another, the close ones decide.
    """
    low, high, total = sizes.agg(F.min("page_id"), F.max("page_id"), F.sum("payload_bytes")).first()
    if low is None:
        return 1
    span = max(1, math.ceil((high - low + 1) * min(1.0, shard_bytes / max(1, total))))
    while span > 1:
        held = sizes.groupBy(F.floor(F.col("page_id") / span)).agg(F.sum("payload_bytes").alias("n"))
        if held.agg(F.max("n")).first()[0] <= 4 * shard_bytes:
            break
        span = max(1, span // 4)
    return span


def digested(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    df = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    return df.withColumns({"digest": F.sha2("html", 256), "payload_bytes": F.octet_length("html").cast("long")})


def revisits(sizes: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload a page of smaller id has."""
    first = (
        sizes.filter(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
        .filter("n > 1 AND refers_to IS NOT NULL").drop("n")
    )
    again = sizes.join(first, "digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return again.select("page_id", "digest", "refers_to").distinct()


def write(
    pages: DataFrame, out_dir: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """Write a record per row below ``out_dir``, a folder that all executors share, and return the
    manifest (shard, path, records, bytes, sha256), itself written last as Parquet.

    Of records with equal payloads of at least ``REVISIT_BYTES``, that with the smallest id is a
    response; rows that share this id are all responses; the others are revisits. A null html is
    empty; a null id or url leaves its header out, and null ids make a shard of their own.
    """
    spark = pages.sparkSession
    small_batches(spark, 500)
    records = digested(pages, id_col, url_col, html_col)
    sizes = staged(records.select("page_id", "digest", "payload_bytes"), "warc-sizes")
    span = shard_span(sizes, shard_bytes)
    # a row without html ahead of the pages it is about: so the html is shuffled once
    none = F.lit(None)
    told = revisits(sizes).select(
        "page_id", none.cast("string").alias("url"), none.cast("string").alias("html"), "digest",
        none.cast("long").alias("payload_bytes"), "refers_to",
    )
    records = records.withColumn("refers_to", none.cast("long")).unionByName(told)
    records = records.withColumn("shard", F.floor(F.col("page_id") / span)).repartition("shard")
    records = records.sortWithinPartitions(
        "shard", "page_id", "digest", F.col("refers_to").asc_nulls_last(), F.col("url").asc_nulls_first()
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(out_dir)
        store.create_dir(root, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        shard, serial, file = None, 0, None

        def close() -> pa.RecordBatch:
            stream, name, records, size, digest = file
            stream.close()
            store.move(f"{root}/.{name}.{attempt}", f"{root}/{name}")
            row = [[shard], [f"{out_dir}/{name}"], [records], [size], [digest.hexdigest()]]
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(row, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                ["shard", "path", "records", "bytes", "sha256"],
            )

        about = told_to = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["payload_bytes"] is None:
                    about, told_to = (row["page_id"], row["digest"]), row["refers_to"]
                    continue
                row["refers_to"] = told_to if about == (row["page_id"], row["digest"]) else None
                if file and (row["shard"] != shard or file[3] >= roll_bytes):
                    yield close()
                    file, serial = None, serial + 1 if row["shard"] == shard else 0
                if not file:
                    shard = row.pop("shard")
                    name = f"pages-{'none' if shard is None else f'{shard:012d}'}-{serial:05d}.warc.gz"
                    file = [store.open_output_stream(f"{root}/.{name}.{attempt}", compression=None), name, 0, 0, hashlib.sha256()]
                    info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, name)), ("WARC-Date", DATE), ("WARC-Filename", name)]
                    put(file, member([*info, ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                row.pop("shard", None)
                put(file, page_record(**row))
                file[2] += 1
        if file:
            yield close()

    def put(file: list, raw: bytes) -> None:
        file[0].write(raw)
        file[3] += len(raw)
        file[4].update(raw)

    columns = ["page_id", "url", "html", "digest", "payload_bytes", "refers_to", "shard"]
    manifest = f"{out_dir.rstrip('/')}/_manifest"
    records.select(columns).mapInArrow(run, FILES).write.parquet(manifest)
    return spark.read.schema(FILES).parquet(manifest)


def records_of(raw: bytes, step: int = 1 << 14) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each gzip member. Bytes are passed on in steps, since what is left over
    at the end of a member is copied."""
    view, at = memoryview(raw), 0
    while at < len(raw):
        opener, parts = zlib.decompressobj(31), []
        while not opener.eof and at < len(raw):
            chunk = view[at : at + step]
            parts.append(opener.decompress(chunk))
            at += len(chunk) - len(opener.unused_data)
        head, _, body = b"".join(parts).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not opener.eof or not lines[0].startswith("WARC/"):
            raise ValueError("damaged: no whole record")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        yield headers, body[: int(headers["Content-Length"])]


def read(spark: SparkSession, manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """page_id, url, record_type, payload_bytes, payload_digest, refers_to and payload of every
    record in the manifest's files. Bytes that differ from their digests end the job."""
    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"

    def parse(raw: bytes) -> Iterator[tuple]:
        for headers, block in records_of(raw):
            if headers["WARC-Type"] == "warcinfo":
                continue
            if f"sha256:{hashlib.sha256(block).hexdigest()}" != headers["WARC-Block-Digest"]:
                raise ValueError("damaged record " + headers["WARC-Record-ID"])
            http, _, payload = block.partition(b"\r\n\r\n")
            size = int(http.rpartition(b"Content-Length: ")[2])
            digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
            revisit = headers["WARC-Type"] == "revisit"
            if not revisit and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                raise ValueError("damaged payload " + headers["WARC-Record-ID"])
            number = lambda name: int(headers[name]) if name in headers else None
            yield (
                number("WARC-Page-ID"), headers.get("WARC-Target-URI"), headers["WARC-Type"], size, digest,
                number("WARC-Refers-To-Page-ID"), None if revisit or not payloads else payload,
            )

    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, digest in zip(batch["path"].to_pylist(), batch["sha256"].to_pylist(), strict=True):
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_stream(name, compression=None) as stream:
                    raw = stream.readall()
                if hashlib.sha256(raw).hexdigest() != digest:
                    raise ValueError(f"damaged file {path}")
                rows = []
                for row in parse(raw):
                    rows.append(row)
                    if len(rows) == 500:
                        yield batch_of(rows)
                        rows = []
                yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

    files = manifest.count()
    return manifest.select("path", "sha256").repartition(max(1, files), "path").mapInArrow(run, schema)
