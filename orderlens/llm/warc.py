"""Web archives: a deterministic sharded WARC writer and its reader (operator 13).

Method. Records are sorted by (id, url, payload digest) over shards whose bounds
are drawn from the rows themselves, so that the same rows give the same files,
byte for byte, on any cluster. A shard rolls its files by compressed size; every
record is a gzip member of its own with regenerated headers and digests, and the
first record of a file is its ``warcinfo``. Of records with equal payloads the
first is a ``response``, the others ``revisit`` it.

Commit. Tasks write under temporary names that carry the attempt; the rows they
return (name, size, SHA-256, records) become the staging manifest, in which Spark
keeps one attempt of each task. A second job moves those files to their final
names and writes the manifest, whose own commit is the commit of the archive: a
folder without it isn't read, and files it doesn't list are ignored. The reader
checks sizes, file digests, block digests, payload digests and record counts.

Scale. Payloads are shuffled once, by shard; digests, sizes and the choice of the
response travel beside them as narrow rows. The choice is one row a payload that
occurs more than once; payloads with at least 1/HOT_SHARE of all rows (so at most
HOT_SHARE of them) are broadcast, the others meet in a join by digest. Bounds come
from at most about SAMPLED * MOST_SHARDS hashed rows. A task holds one record and
an Arrow batch. The folder must be one that ``pyarrow.fs`` opens on the executors.

Results in odd cases. Null html: an empty payload. Payloads of fewer than
``least_bytes`` are always responses. Null ids come first in the files, but a
payload is a response under its smallest non-null id, if any; at equal ids the
smaller url decides (null last), and of rows equal in all of these one is the
response, the others revisit it; such rows stand in one shard. A null url gives
a URN of the id; blanks, control characters and what isn't ASCII are percent-encoded.
An empty table gives a committed archive without files. Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import uuid
import zlib
from collections.abc import Iterator
from hashlib import sha256
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType

from orderlens.llm import textbatch as tb
from orderlens.llm.scratch import scratch_dir, table

#: Smaller payloads are stored again rather than revisited.
LEAST_BYTES = 100
#: Payload bytes of a shard; beyond MOST_SHARDS of them shards grow instead.
SHARD_BYTES = 8 << 20
MOST_SHARDS = 10_000
#: Hashed rows a shard whose keys give the bounds.
SAMPLED = 16
HOT_SHARE = 256
FILE_BYTES = 256 << 20
LEVEL = 6
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_KEEP = "!#$%&'()*+,/:;=?@[]~-._"
_CRLF = b"\r\n"


# --------------------------------------------------------------------------
# Records
# --------------------------------------------------------------------------

def record(kind: str, number: str, block: bytes, fields: list[tuple[str, str]], date: str) -> bytes:
    """One record: version line, headers, block, two line ends. Its id is a digest of kind, number and block."""
    digest = sha256(block).hexdigest()
    name = uuid.UUID(bytes=sha256(f"{kind}\n{number}\n{digest}".encode()).digest()[:16], version=4)
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", date), *fields]
    head += [("WARC-Block-Digest", f"sha256:{digest}"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + _CRLF + block + _CRLF + _CRLF


def target_uri(url: str | None, page_id) -> str:
    return quote(url, safe=_KEEP) if url else f"urn:page:{'' if page_id is None else page_id}"


def page_record(number: str, page_id, url: str | None, payload: bytes, digest: str, revisits: tuple | None, date: str) -> bytes:
    """A response with its payload, or a revisit of the page in ``revisits`` (a 1-tuple of its id) without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Target-URI", target_uri(url, page_id)), ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    fields += [] if page_id is None else [("X-Page-Id", str(page_id))]
    if revisits is None:
        return record("response", number, http + payload, fields, date)
    fields += [("WARC-Profile", PROFILE), ("X-Payload-Length", str(len(payload)))]
    fields += [] if revisits[0] is None else [("X-Refers-To-Page-Id", str(revisits[0]))]
    return record("revisit", number, http, fields, date)


def parse(raw: bytes, where: str) -> tuple[dict[str, str], bytes]:
    """(headers, block) of one record; damage is an error that names ``where``."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
    length = int(fields.get("Content-Length", -1))
    block = rest[:length] if length >= 0 else b""
    if not found or not lines[0].startswith("WARC/1.") or len(block) != length or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"{where}: no whole record")
    if fields.get("WARC-Block-Digest") != f"sha256:{sha256(block).hexdigest()}":
        raise ValueError(f"{where}: the block's digest differs")
    return fields, block


# --------------------------------------------------------------------------
# Files
# --------------------------------------------------------------------------

def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path) of a folder as Spark names it."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


class _File:
    """A growing archive file under a temporary name."""

    def __init__(self, fs: pafs.FileSystem, folder: str, shard: int, number: int, attempt: str, level: int, date: str):
        self.shard, self.number, self.level = shard, number, level
        self.name = f"part-{shard:06d}-{number:05d}.warc.gz"
        self.temporary = f".{self.name}.{attempt}.tmp"
        fs.create_dir(folder, recursive=True)
        self.out = fs.open_output_stream(f"{folder}/{self.temporary}")
        self.digest, self.bytes, self.records = sha256(), 0, 0
        info = f"software: orderlens\r\nformat: WARC File Format 1.1\r\nfilename: {self.name}\r\n".encode()
        self.add(record("warcinfo", self.name, info, [("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], date))

    def add(self, raw: bytes) -> None:
        packer = zlib.compressobj(self.level, zlib.DEFLATED, 31)  # a gzip member; its header holds no time
        packed = packer.compress(raw) + packer.flush()
        self.out.write(packed)
        self.digest.update(packed)
        self.bytes += len(packed)
        self.records += 1

    def row(self) -> tuple:
        self.out.close()
        return self.shard, self.number, self.name, self.temporary, self.bytes, self.records, self.digest.hexdigest()


MANIFEST = StructType(
    [
        StructField("shard", LongType()),
        StructField("number", LongType()),
        StructField("name", StringType()),
        StructField("temporary", StringType()),
        StructField("bytes", LongType()),
        StructField("records", LongType()),
        StructField("sha256", StringType()),
    ]
)


def _manifest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64() if isinstance(f.dataType, LongType) else pa.string() for f in MANIFEST]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=MANIFEST.names)


# --------------------------------------------------------------------------
# Writing
# --------------------------------------------------------------------------

def _order() -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in ("_id", "_url", "_digest")]


def _named(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    html = F.coalesce(F.col(html_col), F.lit(""))
    return pages.select(
        F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"), F.sha2(html, 256).alias("_digest"), html.cast("binary").alias("_payload")
    )


def first_records(slim: DataFrame, least_bytes: int) -> DataFrame:
    """(_id, _url, _digest, _first) of the different keys that share a payload: the id that the payload is a response under, and its url."""
    keys = slim.where(F.col("_bytes") >= least_bytes).groupBy("_id", "_url", "_digest").agg(F.count(F.lit(1)).alias("_copies"))
    keys = table(keys.drop("_copies"), "warc-keys")
    least = F.min(F.struct(F.col("_id").isNull().alias("_no_id"), "_id", F.col("_url").isNull().alias("_no_url"), "_url")).alias("_least")
    shared = keys.groupBy("_digest").agg(least, F.count(F.lit(1)).alias("_keys")).where("_keys > 1")
    shared = table(shared.select("_digest", F.struct("_least._id", "_least._url").alias("_first"), "_keys"), "warc-shared")
    hot = shared.where(F.col("_keys") * HOT_SHARE >= F.lit(max(1, keys.count()))).drop("_keys")  # at most HOT_SHARE rows
    few = keys.join(F.broadcast(hot), "_digest")
    rest = keys.join(F.broadcast(hot.select("_digest")), "_digest", "left_anti").join(shared.drop("_keys").hint("merge"), "_digest")
    names = ["_id", "_url", "_digest", "_first"]
    return few.select(*names).unionByName(rest.select(*names))


def bounds(slim: DataFrame, shard_bytes: int = SHARD_BYTES) -> list[tuple]:
    """Keys at which shards after the first begin, from the rows alone: about equal payload bytes a shard.

    At most about SAMPLED * MOST_SHARDS hashed rows reach the driver.
    """
    whole = slim.agg(F.count(F.lit(1)).alias("n"), F.sum("_bytes").alias("b")).first()
    shards = min(MOST_SHARDS, -(-(whole["b"] or 0) // shard_bytes))
    if shards < 2:
        return []
    drawn = F.pmod(F.xxhash64("_id", "_url", "_digest"), F.lit(whole["n"])) < SAMPLED * shards
    rows = slim.where(drawn).orderBy(*_order()).select("_id", "_url", "_digest", "_bytes").collect()
    each, seen, out = sum(r["_bytes"] for r in rows) / shards, 0, []
    for r in rows:
        if seen >= each * (len(out) + 1) and len(out) + 1 < shards:
            out.append(_key(r["_id"], r["_url"], r["_digest"]))
        seen += r["_bytes"]
    return sorted(set(out))


def _key(page_id, url, digest) -> tuple:
    """Sorts as the shards do: nulls first, text by code point."""
    return (page_id is not None, page_id if page_id is not None else 0, url is not None, url or "", digest)


def write(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = LEAST_BYTES,
    shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
    level: int = LEVEL,
    date: str = DATE,
) -> DataFrame:
    """Write every row of ``pages`` as a record into archives under ``path``; returns the committed manifest."""
    spark = pages.sparkSession
    rows = _named(pages, id_col, url_col, html_col)
    slim = table(rows.select("_id", "_url", "_digest", F.length("_payload").cast("long").alias("_bytes")), "warc-slim")
    starts = bounds(slim, shard_bytes)
    nothing = F.lit(None)
    first = first_records(slim, least_bytes).select("_id", "_url", "_digest", nothing.cast("binary").alias("_payload"), F.lit(0).alias("_kind"), "_first")
    kind = StructType([StructField("_id", rows.schema["_id"].dataType), StructField("_url", StringType())])
    both = rows.withColumns({"_kind": F.lit(1), "_first": nothing.cast(kind)}).unionByName(first)

    @F.arrow_udf("int")
    def shard(page_id: pa.Array, url: pa.Array, digest: pa.Array) -> pa.Array:
        keys = zip(page_id.to_pylist(), url.to_pylist(), digest.to_pylist(), strict=True)
        return pa.array([bisect.bisect_right(starts, _key(*k)) for k in keys], pa.int32())

    both = both.withColumn("_shard", shard("_id", "_url", "_digest") if starts else F.lit(0))
    both = both.repartitionById(len(starts) + 1, F.col("_shard")).sortWithinPartitions("_shard", *_order(), "_kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = filesystem(path)
        context = TaskContext.get()
        attempt = f"{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        file, done, decided, last, place, at = None, [], None, None, 0, -1
        for batch in batches:
            for part in tb.slices(batch, "_payload"):
                columns = [part.column(part.schema.get_field_index(n)).to_pylist() for n in ("_id", "_url", "_digest", "_payload", "_kind", "_first", "_shard")]
                for page_id, url, digest, payload, kind_, first_, shard_ in zip(*columns, strict=True):
                    key = (page_id, url, digest)
                    if kind_ == 0:
                        decided = (key, first_)
                        continue
                    if shard_ != at:
                        if file:
                            done.append(file.row())
                        file, last, place, at = None, None, 0, shard_
                    if file is not None and file.bytes >= file_bytes:
                        done.append(file.row())
                        file = _File(fs, folder, at, file.number + 1, attempt, level, date)
                    file = file or _File(fs, folder, at, 0, attempt, level, date)
                    owner = decided[1] if decided and decided[0] == key else {"_id": page_id, "_url": url}
                    own = (owner["_id"], owner["_url"]) == (page_id, url) and key != last
                    revisits = None if own or len(payload) < least_bytes else (owner["_id"],)
                    file.add(page_record(f"{at}/{place}", page_id, url, payload, digest, revisits, date))
                    last, place = key, place + 1
            if done:
                yield _manifest_batch(done)
                done = []
        if file:
            yield _manifest_batch([file.row()])

    both.mapInArrow(run, MANIFEST).write.mode("overwrite").parquet(f"{path}/staging")
    return commit(spark, path)


def commit(spark: SparkSession, path: str) -> DataFrame:
    """Move the staged files to their final names, then write the manifest. May be repeated after a failure."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = filesystem(path)
        for batch in batches:
            for row in batch.to_pylist():
                old, new = f"{folder}/{row['temporary']}", f"{folder}/{row['name']}"
                if fs.get_file_info(old).type == pafs.FileType.File:
                    fs.move(old, new)
                elif fs.get_file_info(new).size != row["bytes"]:
                    raise ValueError(f"{row['name']} was neither staged nor moved")
            yield batch

    staged = spark.read.schema(MANIFEST).parquet(f"{path}/staging")
    staged.mapInArrow(move, MANIFEST).write.mode("overwrite").parquet(f"{path}/manifest")
    return manifest(spark, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The files of a committed archive (an error where there is none)."""
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


# --------------------------------------------------------------------------
# Reading
# --------------------------------------------------------------------------

def members(stream, chunk: int = 1 << 20) -> Iterator[tuple[bytes, bytes]]:
    """(packed chunk, nothing) and (nothing, one member) by turns: the file is read forward once."""
    unpacker, held = zlib.decompressobj(31), []
    while data := stream.read(chunk):
        yield data, b""
        while data:
            held.append(unpacker.decompress(data))
            data = unpacker.unused_data
            if unpacker.eof:
                yield b"", b"".join(held)
                unpacker, held = zlib.decompressobj(31), []
    if held:
        raise ValueError("the last member is cut off")


def records(file: dict, fs: pafs.FileSystem, folder: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of all records of a file of the manifest, checked against it."""
    digest, n, size = sha256(), 0, 0
    with fs.open_input_stream(f"{folder}/{file['name']}", compression=None) as stream:
        for packed, raw in members(stream):
            digest.update(packed)
            size += len(packed)
            if raw:
                n += 1
                yield parse(raw, f"{file['name']}, record {n}")
    if (size, n, digest.hexdigest()) != (file["bytes"], file["records"], file["sha256"]):
        raise ValueError(f"{file['name']} is not the file of the manifest")


def read(spark: SparkSession, path: str, id_type: DataType | str = "long", payloads: bool = False) -> DataFrame:
    """(page_id, target_uri, record_type, refers_to, payload_bytes, payload_digest) of every page record, with ``payloads`` also payload (null in a revisit)."""
    schema = "page_id string, target_uri string, record_type string, refers_to string, payload_bytes long, payload_digest string"
    schema += ", payload binary" if payloads else ""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = filesystem(path)
        kinds = [pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string() for n in names]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        for batch in batches:
            for file in batch.to_pylist():
                rows, held = [], 0
                for fields, block in records(file, fs, folder):
                    kind = fields["WARC-Type"]
                    if kind not in ("response", "revisit"):
                        continue
                    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    if payload is not None and sha256(payload).hexdigest() != digest:
                        raise ValueError(f"{file['name']}: the payload's digest differs")
                    size = len(payload) if payload is not None else int(fields["X-Payload-Length"])
                    row = (fields.get("X-Page-Id"), fields["WARC-Target-URI"], kind, fields.get("X-Refers-To-Page-Id"), size, digest)
                    rows.append((*row, payload) if payloads else row)
                    held += size if payloads else 200
                    if held >= 1 << 22:
                        yield pack(rows)
                        rows, held = [], 0
                if rows:
                    yield pack(rows)

    files = manifest(spark, path)
    # a task for each file: adaptive execution would put the few rows of the manifest together
    found = files.repartition(max(1, files.count()), "name").mapInArrow(run, schema)
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def write_and_read(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of all ``pages``, from the archives written for them."""
    path = f"{scratch_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    write(pages, path)
    back = read(pages.sparkSession, path, pages.schema["page_id"].dataType)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
