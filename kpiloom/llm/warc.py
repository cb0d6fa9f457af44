"""Web archives written in shards and read back.

Records are put in the order of their keys by a range shuffle. A shard takes the records that begin in a fixed
range of bytes of that order, so that shards are of even size and depend on the records alone, not on how the
cluster parted them. Each record is a gzip member of its own, named by its key, address and payload. A shard's records go to files that are closed when their compressed size is reached, under
temporary names; the rows that name them are kept by Spark only from attempts that succeeded. These are then
renamed, which may be repeated, and a manifest is written last: readers see what the manifest names.

Of records with equal payloads the first is a response and the others revisit it, if the payload is not
too short; they hold no payload, but its size and digest.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.store import stored

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

MANIFEST = "shard BIGINT, roll BIGINT, temporary STRING, name STRING, records BIGINT, bytes BIGINT, sha256 STRING"
# Bits of a row's number inside its partition.
ROW_BITS = 33
# Bytes that a record counts beside its payload, and bytes of records that a task sorts or writes.
HEAD_BYTES, TASK_BYTES = 512, 256 << 20


@dataclass(frozen=True)
class Layout:
    """Bytes of a shard before compression, compressed bytes after which a file is closed, least payload not repeated."""

    shard_bytes: int = 64 << 20
    file_bytes: int = 8 << 20
    least_revisited: int = 100
    date: str = "1970-01-01T00:00:00Z"
    prefix: str = "pages"
    level: int = 6


def written(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", layout: Layout = Layout()
) -> DataFrame:
    """Write all rows to ``folder`` and return the manifest, a row for each file. No rows make no file.

    A null payload is empty; a null key or address is left out of its record, and null keys come last. Repeated
    keys are records of their own, in the order of their payloads' digests. Other columns are not written.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(key).cast("string").alias("key"),
        F.col(key).alias("order"),
        F.col(url).alias("url"),
        F.coalesce(F.col(payload), F.lit("")).alias("payload"),
    )
    size = F.octet_length("payload").cast("long")
    total = rows.agg(F.sum(size + HEAD_BYTES)).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // TASK_BYTES + 1)
    by = [F.col("order").asc_nulls_last(), F.col("digest"), F.col("url").asc_nulls_last()]
    dealt = rows.withColumn("digest", F.sha2("payload", 256)).repartitionByRange(tasks, *by[:2])
    in_order = dealt.sortWithinPartitions(*by).select("key", "url", "digest", size.alias("bytes"), "payload")
    numbered = in_order.mapInArrow(_numbered, f"{COLUMNS}, payload STRING, {NUMBERS}")
    # Payloads of many rows together are smaller on disk than records compressed one by one.
    ranked = _ranked(stored(numbered.withColumn("part", F.spark_partition_id()), "numbered", "zstd"), layout)
    repeated = ranked.where(F.col("bytes") >= layout.least_revisited).select("shard", "rank", "key", "url", "digest")
    firsts = repeated.groupBy(F.col("digest").alias("same")).agg(
        F.min("rank").alias("first"), F.min_by(F.struct("key", "url"), "rank").alias("of"), F.count("*").alias("n")
    )
    revisits = repeated.join(firsts.where("n > 1"), (F.col("digest") == F.col("same")) & (F.col("rank") > F.col("first")))
    marks = revisits.select("shard", "rank", F.lit(0).alias("kind"), F.col("of.key").alias("key"), F.col("of.url").alias("url"), "digest")
    responses = ranked.mapInArrow(lambda batches: _members(batches, layout), RESPONSES)
    records = responses.withColumn("kind", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    shards = records.repartition(tasks, "shard").sortWithinPartitions("shard", "rank", "kind")
    files = stored(shards.mapInArrow(lambda batches: _write(batches, folder, layout), MANIFEST), "files")
    return _committed(spark, files, folder)


def _ranked(made: DataFrame, layout: Layout) -> DataFrame:
    """``made`` with rank, which gives a row's place in the whole order, and its shard.

    What goes through the driver is a row for each task of the range shuffle.
    """
    ends = made.groupBy("part").agg(F.max(F.col("before") + F.col("bytes") + HEAD_BYTES).alias("end")).collect()
    starts, total = [], 0
    for row in sorted(ends):
        starts.append((row["part"], total))
        total += row["end"]
    joined = made.join(F.broadcast(made.sparkSession.createDataFrame(starts, "part INT, start BIGINT")), "part")
    return joined.select(
        F.expr(f"(start + before) div {layout.shard_bytes}").alias("shard"),
        (F.shiftleft(F.col("part").cast("long"), ROW_BITS) + F.col("row")).alias("rank"),
        *(c for c in made.columns if c not in ("part", "row", "before")),
    )


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", lambda c: f"%{ord(c[0]):02X}", value)


def _id(row: dict, repeat: int) -> str:
    """The name of a record; ``repeat`` counts the records before it of the same key, address and payload."""
    named = repr((row["key"], row["url"], row["digest"], repeat))
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(named.encode()).digest()[:16], version=5)}>"


def record(row: dict, payload: bytes, mark: dict | None, layout: Layout) -> bytes:
    """One record; ``mark`` has the first record of the same payload, if this one revisits it."""
    head = HTTP.format(row["bytes"]).encode()
    block = head if mark else head + payload
    fields = [
        ("WARC-Type", "revisit" if mark else "response"),
        ("WARC-Record-ID", _id(row, row["repeat"])),
        ("WARC-Date", layout.date),
        ("WARC-Target-URI", row["url"]),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("WARC-Payload-Digest", f"sha256:{row['digest']}"),
        ("X-Page-ID", row["key"]),
    ]
    if mark:
        fields += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", _id(mark, 0)),
            ("WARC-Refers-To-Target-URI", mark["url"]),
            ("X-Refers-To-Page-ID", mark["key"]),
        ]
    lines = "".join(f"{name}: {_clean(value)}\r\n" for name, value in fields if value is not None)
    return f"{VERSION}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


COLUMNS = "key STRING, url STRING, digest STRING, bytes BIGINT"
NUMBERS = "row BIGINT, before BIGINT, repeat BIGINT"
RESPONSES = f"shard BIGINT, rank BIGINT, {COLUMNS}, repeat BIGINT, member BINARY"


def _member(data: bytes, layout: Layout) -> bytes:
    pack = zlib.compressobj(layout.level, wbits=31)
    return pack.compress(data) + pack.flush()


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order with their numbers, the bytes before each, and how many before it have its key, address and payload."""
    at = before = repeat = 0
    last = None
    for batch in batches:
        numbers: dict[str, list[int]] = {"row": [], "before": [], "repeat": []}
        for row in batch.select(["key", "url", "digest", "bytes"]).to_pylist():
            same = (row["key"], row["url"], row["digest"])
            repeat, last = repeat + 1 if same == last else 0, same
            for name, value in zip(numbers, (at, before, repeat), strict=True):
                numbers[name].append(value)
            at, before = at + 1, before + row["bytes"] + HEAD_BYTES
        for name, values in numbers.items():
            batch = batch.append_column(name, pa.array(values, pa.int64()))
        yield batch


def _members(batches: Iterator[pa.RecordBatch], layout: Layout) -> Iterator[pa.RecordBatch]:
    """Rows with the payload replaced by the whole response record, compressed, which is what moves to the shards."""
    for batch in batches:
        kept = batch.drop_columns("payload")
        made = [
            _member(record(row, payload.as_py().encode(), None, layout), layout)
            for row, payload in zip(kept.to_pylist(), batch.column("payload"), strict=True)
        ]
        yield kept.append_column("member", pa.array(made, pa.binary()))


def _write(batches: Iterator[pa.RecordBatch], folder: str, layout: Layout) -> Iterator[pa.RecordBatch]:
    """Write rows that come shard by shard, and yield a row of the manifest for each file."""
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(f"{root}/_temporary", recursive=True)
    out, entry, mark = None, None, None

    def close() -> Iterator[pa.RecordBatch]:
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([entry | {"sha256": hasher.hexdigest()}])

    for batch in batches:
        for i in range(len(batch)):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            if row["kind"] == 0:
                mark = row
                continue
            if out is None or entry["shard"] != row["shard"] or entry["bytes"] >= layout.file_bytes:
                yield from close()
                roll = entry["roll"] + 1 if out is not None and entry["shard"] == row["shard"] else 0
                name = f"{layout.prefix}-{row['shard']:08d}-{roll:04d}.warc.gz"
                temporary = f"_temporary/{name}.{uuid.uuid4().hex}"
                entry = {"shard": row["shard"], "roll": roll, "temporary": temporary, "name": name, "records": 0, "bytes": 0}
                out, hasher = system.open_output_stream(f"{root}/{temporary}", compression=None), hashlib.sha256()
            revisits = mark is not None and mark["rank"] == row["rank"]
            member = _member(record(row, b"", mark, layout), layout) if revisits else row["member"]
            out.write(member)
            hasher.update(member)
            entry["records"] += 1
            entry["bytes"] += len(member)
    yield from close()


def _committed(spark: SparkSession, made: DataFrame, folder: str) -> DataFrame:
    """Rename the files to their names, then write the manifest."""

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                source, target = system.get_file_info([f"{root}/{row['temporary']}", f"{root}/{row['name']}"])
                if source.type == fs.FileType.File:
                    system.move(source.path, target.path)
                elif target.type != fs.FileType.File or target.size != row["bytes"]:
                    raise FileNotFoundError(f"neither {source.path} nor {target.path} is whole")
            yield batch

    made.mapInArrow(rename, MANIFEST).write.mode("overwrite").parquet(f"{folder}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


RECORDS = (
    "key STRING, url STRING, record_type STRING, payload_bytes BIGINT, payload_digest STRING, refers_to STRING, "
    "file STRING, payload STRING"
)


def read_back(manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """One row for each record of the files of a manifest; digests are checked. Keys are text, as in the archive.

    payload_bytes and payload_digest of a revisit are those of the payload that it doesn't hold; its payload is null.
    """
    names = manifest.select("name")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with system.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for data in members(stream):
                        row = parsed(data) | {"file": name}
                        size += len(data)
                        rows.append(row if with_payload else row | {"payload": None})
                        if size > 1 << 20:
                            yield pa.RecordBatch.from_pylist(rows, ROWS)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, ROWS)

    return names.repartition(max(1, names.count())).mapInArrow(read, RECORDS)


ROWS = pa.schema(
    [(c, pa.int64() if c == "payload_bytes" else pa.string()) for c in re.findall(r"(\w+) (?:STRING|BIGINT)", RECORDS)]
)


def members(stream: pa.NativeFile) -> Iterator[bytes]:
    """The contents of each gzip member of a file, one at a time."""
    pending = b""
    while True:
        unpack, parts = zlib.decompressobj(wbits=31), []
        while not unpack.eof:
            pending = pending or stream.read(1 << 16)
            if not pending:
                if parts:
                    raise EOFError("a member isn't whole")
                return
            parts.append(unpack.decompress(pending))
            pending = unpack.unused_data
        yield b"".join(parts)


def parsed(data: bytes) -> dict:
    """The columns of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    response = fields["WARC-Type"] == "response"
    whole = not response or hashlib.sha256(payload).hexdigest() == digest
    if version != VERSION or fields["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}" or not whole:
        raise ValueError(f"record {fields.get('WARC-Record-ID')} is damaged")
    return {
        "key": fields.get("X-Page-ID"),
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "payload_bytes": int(re.search(rb"Content-Length: (\d+)", http)[1]),
        "payload_digest": digest,
        "refers_to": fields.get("X-Refers-To-Page-ID"),
        "payload": payload.decode() if response else None,
    }
