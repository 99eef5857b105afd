"""WARC archives: a deterministic sharded writer, and a reader that verifies what it reads.

One scan of the pages finds equal payloads by narrow rows (id, url, SHA-256, size). A second one builds each record where its
page is read: headers are made anew, block and payload digests are taken, and the record becomes a gzip member of its own.
Only compressed members are shuffled, to shards that are ranges of (page_id, digest, copy), and sorted there. A shard's task
appends members to a file and starts the next file when the compressed size would pass ``FILE_BYTES``. Bounds of the shards come from a
hashed sample of the keys and their number from the bytes alone, so equal input gives equal files on any cluster.

Commit: a task writes under a temporary name that no other attempt uses and reports its files as rows. The rows of the
attempts that Spark accepted are stored; then those files, and only those, are moved to their names, which a retry may repeat, and
the manifest (name, records, bytes, SHA-256) is written last. What is not in the manifest is not in the archive.
``root`` is any location that ``pyarrow.fs`` opens: a shared folder, S3, HDFS, GCS.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the largest page_id is the response (of equal
ids the one with the largest url, of wholly equal rows the first copy); the others are revisits, which carry the digest and
the length, name the response and hold no payload. Wholly equal rows are folded into one with a count and unfolded
in blocks, so that a crowd of them is neither shuffled with its payloads nor kept in one task.

Defined cases: null html is empty, a null url leaves the target out, a null page_id is smaller than any other and is read back as
null; control characters and blanks of a url are percent-encoded; an empty table makes an archive without files.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import bounded, stored
from barloom.session import scratch_path

REVISIT_BYTES = 1000
#: A file holds so many compressed bytes, if its first record is not larger.
FILE_BYTES = 1 << 30
#: Shards hold about so many bytes of payload; from 4,096 shards on up to the second number.
SHARD_BYTES, LARGE_SHARD_BYTES, SHARDS = 1 << 25, 1 << 32, 4096
#: Sampled keys per shard, and equal rows unfolded by one task.
SAMPLE, BLOCK = 16, 10_000
LEVEL = 6
#: Pages carry no fetch time; headers need one.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "name string, temporary string, shard int, records long, bytes long, sha256 string"
RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


# ---- one record --------------------------------------------------------------------------------

def sha1_name(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, payload_sha1: str, url: str | None, copy: int) -> str:
    """An id made of what tells records apart; the page's own id can be read from it."""
    of_url = "-" if url is None else hashlib.sha1(url.encode()).hexdigest()[:16]
    return f"<urn:page:{'' if page_id is None else page_id}:{payload_sha1}:{of_url}:{copy}>"


def page_of(identifier: str) -> int | None:
    part = identifier.split(":")[2]
    return int(part) if part else None


def _member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    fields = fields + [("WARC-Block-Digest", sha1_name(block)), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id, url, payload: bytes | None, size: int, payload_sha1: bytes, copy: int, refers_to=None) -> bytes:
    """The gzip member of a response, or of a revisit to ``refers_to`` = (page_id, url)."""
    name = payload_sha1.hex()
    fields = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", record_id(page_id, name, url, copy)),
              ("WARC-Date", DATE), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(payload_sha1).decode()),
              ("Content-Type", "application/http;msgtype=response")]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to:
        fields += [("WARC-Refers-To", record_id(refers_to[0], name, refers_to[1], 0)), ("WARC-Profile", PROFILE)]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    return _member(fields, http + (b"" if refers_to else payload))


def info_record(file_name: str) -> bytes:
    return _member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:warcinfo:{file_name}>"), ("WARC-Date", DATE),
                    ("WARC-Filename", file_name), ("Content-Type", "application/warc-fields")],
                   b"format: WARC File Format 1.1\r\n")


def members(stream, chunk: int = 1 << 16):
    """The gzip members of a binary stream, unpacked, one at a time."""
    packed, unpacker, out = b"", zlib.decompressobj(31), []
    while True:
        packed = packed or stream.read(chunk)
        if not packed:
            break
        out.append(unpacker.decompress(packed))
        packed = unpacker.unused_data
        if unpacker.eof:
            yield b"".join(out)
            unpacker, out = zlib.decompressobj(31), []
    if any(out):
        raise ValueError("the archive ends within a record")


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record, its block digest verified."""
    head, _, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    if first != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a record")
    block = rest[:size]
    if sha1_name(block) != fields["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {fields['WARC-Record-ID']}")
    return fields, block


def judged(fields: dict[str, str], block: bytes) -> tuple | None:
    """A row of ``RESULT`` from a page's record, its payload digest verified; None for other records."""
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", head)[1])
    if kind == "response" and (len(payload) != size or sha1_name(payload) != fields["WARC-Payload-Digest"]):
        raise ValueError(f"payload digest of {fields['WARC-Record-ID']}")
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    refers = page_of(fields["WARC-Refers-To"]) if kind == "revisit" else None
    return page_of(fields["WARC-Record-ID"]), size, digest, kind, refers


# ---- locations ------------------------------------------------------------------------------------

def located(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a location, and the path in it."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/*", "/", re.sub(r"^s3[an]:", "s3:", root)))


# ---- plan ------------------------------------------------------------------------------------------

def same_page(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on (page_id, url, key), nulls equal; ``right`` gives its other columns."""
    right = right.select([F.col(c).alias(f"_{c}") if c in ("page_id", "url", "key") else F.col(c) for c in right.columns])
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("page_id", "url", "key")]
    out = left.join(bounded(right), on, how)
    return out.drop("_page_id", "_url", "_key")


def unfolded(rows: DataFrame) -> DataFrame:
    """Each row ``n`` times, numbered by ``copy`` from 0; large counts are spread over tasks first."""
    blocks = rows.withColumn("block", F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / BLOCK).cast("int"))))
    blocks = blocks.repartition("page_id", "key", "block")
    last = F.least(F.col("n"), (F.col("block") + 1) * BLOCK) - 1
    return blocks.withColumn("copy", F.explode(F.sequence((F.col("block") * BLOCK).cast("long"), last))).drop("block", "n")


def shards_for(size: int, shard_bytes: int = SHARD_BYTES) -> int:
    return max(1, min(-(-size // shard_bytes), max(SHARDS, -(-size // LARGE_SHARD_BYTES))))


def _order(page_id, key, copy) -> tuple:
    return (page_id is not None, page_id or 0, bytes(key), copy)


def shard_bounds(places: DataFrame, shards: int, rows: int) -> list[tuple]:
    """First keys of all shards but the first: even steps through the keys whose hashes are smallest."""
    if shards < 2:
        return []
    hashed, want = F.xxhash64("page_id", "key", "copy"), SAMPLE * shards
    if rows > 4 * want:
        places = places.where(F.pmod(hashed, F.lit(1 << 40)) < int((1 << 40) * 2 * want / rows))
    chosen = places.orderBy(F.pmod(hashed, F.lit(1 << 40)), "page_id", "key", "copy").limit(want).collect()
    keys = sorted(_order(r.page_id, r.key, r.copy) for r in chosen)
    return sorted({keys[len(keys) * i // shards] for i in range(1, shards)}) if keys else []


def _builder(bounds: list[tuple]):
    def run(batches):
        for batch in batches:
            out = []
            for page_id, url, key, size, sha1, payload, copy, revisit, *top in zip(
                    *(batch.column(c).to_pylist() for c in (
                        "page_id", "url", "key", "size", "sha1", "payload", "copy", "revisit", "top_page", "top_url"))):
                member = page_record(page_id, url, payload, size, bytes.fromhex(sha1), copy, top if revisit else None)
                out.append((page_id, key, url, copy, bisect.bisect_right(bounds, _order(page_id, key, copy)), member))
            columns = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (
                    pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.int32(), pa.binary()))],
                ["page_id", "key", "url", "copy", "shard", "member"])

    return run


def _writer(root: str, file_bytes: int):
    def run(batches):
        system, base = located(root)
        open_, done = None, []

        class File:
            def __init__(self, shard: int, number: int):
                self.shard, self.number = shard, number
                self.name = f"pages-{shard:06d}-{number:04d}.warc.gz"
                self.temporary = f"_temporary/{self.name}.{uuid.uuid4().hex}"
                self.stream = system.open_output_stream(f"{base}/{self.temporary}", compression=None)
                self.size, self.records, self.hash = 0, 0, hashlib.sha256()
                self.add(info_record(self.name))
                self.records = 0

            def add(self, member: bytes):
                self.stream.write(member)
                self.hash.update(member)
                self.size += len(member)
                self.records += 1

            def close(self):
                self.stream.close()
                done.append((self.name, self.temporary, self.shard, self.records, self.size, self.hash.hexdigest()))

        for batch in batches:
            for shard, member in zip(batch.column("shard").to_pylist(), batch.column("member")):
                member = member.as_buffer().to_pybytes()
                if open_ and (open_.shard != shard or (open_.records and open_.size + len(member) > file_bytes)):
                    number = open_.number + 1 if open_.shard == shard else 0
                    open_.close()
                    open_ = File(shard, number)
                open_ = open_ or File(shard, 0)
                open_.add(member)
        if open_:
            open_.close()
        columns = list(zip(*done)) or [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (
                pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()))],
            ["name", "temporary", "shard", "records", "bytes", "sha256"])

    return run


def _mover(root: str):
    def run(batches):
        system, base = located(root)
        for batch in batches:
            for name, temporary in zip(batch.column("name").to_pylist(), batch.column("temporary").to_pylist()):
                source, target = f"{base}/{temporary}", f"{base}/{name}"
                if system.get_file_info(source).type != fs.FileType.NotFound:
                    system.move(source, target)
                elif system.get_file_info(target).type == fs.FileType.NotFound:
                    raise FileNotFoundError(target)  # neither written nor moved by an attempt before
            yield batch

    return run


def marked(pages: DataFrame) -> tuple[DataFrame, DataFrame, int, int]:
    """Records to be (page_id, url, key, size, sha1, payload, copy, revisit, top_page, top_url), their keys
    (page_id, key, copy), and the numbers of records and payload bytes."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("key", F.unhex(F.sha2("payload", 256))).withColumn("size", F.octet_length("payload").cast("long"))
    keys = stored(rows.select("page_id", "url", "key", "size"), "payloads")
    count, size = keys.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    folded = stored(keys.groupBy("page_id", "url", "key").agg(F.count("*").alias("n")).where("n > 1"), "folded")
    top = (keys.where(F.col("size") >= REVISIT_BYTES).groupBy("key")
           .agg(F.count("*").alias("n"), F.max(F.struct("page_id", "url")).alias("top")).where("n > 1"))
    top = stored(top.select("key", F.col("top.page_id").alias("top_page"), F.col("top.url").alias("top_url"),
                            F.lit(True).alias("found")), "repeated")
    rows = rows.withColumn("sha1", F.sha1("payload"))
    places = keys.select("page_id", "url", "key")
    if folded.isEmpty():
        rows, places = rows.withColumn("copy", F.lit(0).cast("long")), places.withColumn("copy", F.lit(0).cast("long"))
    else:
        one = same_page(rows, folded, "left_anti").withColumn("copy", F.lit(0).cast("long"))
        many = same_page(rows, folded, "left_semi").groupBy("page_id", "url", "key").agg(
            F.first("payload").alias("payload"), F.first("size").alias("size"), F.first("sha1").alias("sha1"),
            F.count("*").alias("n"))
        first = many.withColumn("copy", F.lit(0).cast("long")).drop("n")
        others = unfolded(many.withColumn("payload", F.when(F.col("size") < REVISIT_BYTES, F.col("payload")))).where("copy > 0")
        rows = one.unionByName(first).unionByName(others)
        places = same_page(places, folded, "left_anti").withColumn("copy", F.lit(0).cast("long")).unionByName(
            unfolded(folded))
    rows = rows.join(bounded(top), "key", "left")
    is_top = F.col("page_id").eqNullSafe(F.col("top_page")) & F.col("url").eqNullSafe(F.col("top_url")) & (F.col("copy") == 0)
    revisit = F.coalesce(F.col("found"), F.lit(False)) & (F.col("size") >= REVISIT_BYTES) & ~is_top
    rows = rows.withColumn("revisit", revisit).withColumn("payload", F.when(~F.col("revisit"), F.col("payload")))
    return rows.drop("found"), places.select("page_id", "key", "copy"), count, size


def write_archive(pages: DataFrame, root: str, file_bytes: int = FILE_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write (page_id, url, html) under ``root``, a location that all machines share; the manifest, also stored there."""
    spark = pages.sparkSession
    rows, places, count, size = marked(pages)
    bounds = shard_bounds(places, shards_for(size, shard_bytes), count)
    built = rows.mapInArrow(
        _builder(bounds), "page_id long, key binary, url string, copy long, shard int, member binary")
    sorted_ = built.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions(
        "shard", "page_id", "key", "copy", "url")
    system, base = located(root)
    system.create_dir(f"{base}/_temporary", recursive=True)
    written = stored(sorted_.select("shard", "member").mapInArrow(_writer(root, file_bytes), MANIFEST), "written")
    moved = written.repartition(max(1, len(bounds) + 1), "name").mapInArrow(_mover(root), MANIFEST)
    moved.drop("temporary").write.parquet(f"{root}/manifest")
    system.delete_dir(f"{base}/_temporary")
    return read_manifest(spark, root)


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("name string, shard int, records long, bytes long, sha256 string").parquet(f"{root}/manifest")


def read_archive(spark: SparkSession, root: str) -> DataFrame:
    """The pages' records of the files in the manifest, every digest verified, as ``RESULT``."""
    def run(batches):
        system, base = located(root)
        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        names = [part.split()[0] for part in RESULT.split(", ")]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            for name, expected in zip(batch.column("name").to_pylist(), batch.column("records").to_pylist()):
                rows, read = [], 0
                with system.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for record in members(stream):
                        row = judged(*parse(record))
                        if row:
                            rows.append(row)
                            read += 1
                        if len(rows) == 10_000:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)
                if read != expected:
                    raise ValueError(f"{name} holds {read} records, the manifest says {expected}")

    files = read_manifest(spark, root)
    n = max(1, files.count())
    return files.select("name", "records").repartition(n, "name").mapInArrow(run, RESULT)


def archived(
    pages: DataFrame, root: str | None = None, file_bytes: int = FILE_BYTES, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Write the pages and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    root = root or scratch_path(pages.sparkSession, "warc")
    write_archive(pages, root, file_bytes, shard_bytes)
    return read_archive(pages.sparkSession, root)
