"""Web pages as WARC archives, written in shards whose bytes depend on the rows alone.

Rows are sorted by id and payload digest and dealt into shards at borders taken
from a sample by hash, so the same rows and number of shards give the same
files, whatever the input's partitions and however often tasks are repeated. A
shard is a run of files; a file is closed by the record that brings its
compressed size to ``roll_bytes``. Headers, record ids and digests are made anew
from id and payload.

Of records with equal payloads of ``shared_bytes`` and more, the one with the
smallest id is a ``response``; the others are ``revisit`` records that refer to it
and keep its HTTP headers, hence the payload's length, but no payload.

A task writes below ``_temporary`` under a name of its own attempt and returns a
row for each file. Spark keeps the rows of one attempt a task, and only these
files are renamed. The ``manifest`` table is written last; readers open what it
lists and nothing else, and check each record's and file's digest.

Files are written and read by pyarrow's file systems, so the path has to be in a
store that pyarrow reaches (local or shared folders, HDFS, S3, GS). A record is
held in memory, a file is not.

Defined results: a null payload is empty; a null id comes before others, has no
id field and is the smallest of a group only if it has no other; rows that share
id and payload are ordered by url, nulls first, and the first of them is the
response; they lie in one shard, which streams them; a null url has no target
field; control characters and blanks in a url are percent-encoded; an empty table
gives a manifest without rows; other columns are not looked at.
"""

import hashlib
import posixpath
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnrisk.llm.tables import for_tasks, stored
from txnrisk.operators.joins import Limits, split_key_left_join
from txnrisk.plans.workdir import new_folder

ROLL_BYTES = 1 << 30
#: Shorter payloads are all stored.
SHARED_BYTES = 100
#: Sampled keys for each border between shards.
SAMPLED = 16
#: When the copies of one payload are spread over several tasks.
COPIES = Limits(smallest_share=100_000)
DATE = "1970-01-01T00:00:00Z"
#: Bytes of records that a reader hands on at once.
STEP_BYTES = 4 << 20

# Names and forms of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_FIELD = "X-Page-ID"
REFERS_FIELD = "X-Refers-To-Page-ID"

_MANIFEST = (
    "shard int, number int, temporary string, name string, bytes long, sha256 string, records long"
)


def _store(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path)


def _in_uri(url: str) -> str:
    return "".join(quote(c) if c <= " " or c == "\x7f" else c for c in url)


def record_id(page: object, digest: str, copy: int) -> str:
    """The URI of the ``copy``-th record, from 0, with this id and payload."""
    name = hashlib.sha256(f"{page}/{digest}/{copy}".encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=name[:16])}>"


def _block(headers: list[tuple[str, str]], content: bytes) -> bytes:
    lines = [VERSION, *[f"{name}: {value}".encode() for name, value in headers]]
    lines.append(b"Content-Length: %d" % len(content))
    return b"\r\n".join(lines) + b"\r\n\r\n" + content + b"\r\n\r\n"


def record(page: object, digest: str, copy: int, url: str | None, payload: bytes, refers: tuple | None) -> bytes:
    """One record. ``refers`` is the id of the response that a revisit refers to, in a tuple."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
    content = http % len(payload) + (payload if refers is None else b"")
    headers = [
        ("WARC-Type", "response" if refers is None else "revisit"),
        ("WARC-Record-ID", record_id(page, digest, copy)),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(content).hexdigest()}"),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", _in_uri(url)))
    if page is not None:
        headers.append((ID_FIELD, quote(str(page))))
    if refers is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers[0], digest, 0))]
        if refers[0] is not None:
            headers.append((REFERS_FIELD, quote(str(refers[0]))))
    return _block(headers, content)


def _member(data: bytes) -> bytes:
    """A gzip member without a time in it."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


@dataclass
class _File:
    """An archive being written under its attempt's name."""

    store: pa.fs.FileSystem
    folder: str
    attempt: str
    shard: int
    number: int
    size: int = 0
    records: int = 0
    sha: object = field(default_factory=hashlib.sha256)

    def __post_init__(self):
        self.name = f"shard-{self.shard:06}-{self.number:05}.warc.gz"
        self.temporary = f"_temporary/{self.attempt}/{self.name}"
        self.store.create_dir(f"{self.folder}/_temporary/{self.attempt}")
        self.out = self.store.open_output_stream(f"{self.folder}/{self.temporary}", compression=None)
        headers = [
            ("WARC-Type", "warcinfo"),
            ("WARC-Record-ID", record_id(self.name, "warcinfo", 0)),
            ("WARC-Date", DATE),
            ("WARC-Filename", self.name),
            ("Content-Type", "application/warc-fields"),
        ]
        self._write(_block(headers, b"format: WARC File Format 1.1\r\n"))

    def _write(self, data: bytes) -> None:
        member = _member(data)
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)

    def add(self, data: bytes) -> None:
        self._write(data)
        self.records += 1

    def close(self) -> pa.RecordBatch:
        self.out.close()
        row = {
            "shard": pa.array([self.shard], pa.int32()),
            "number": pa.array([self.number], pa.int32()),
            "temporary": [self.temporary],
            "name": [self.name],
            "bytes": [self.size],
            "sha256": [self.sha.hexdigest()],
            "records": [self.records],
        }
        return pa.record_batch(row)


def _keyed(pages: DataFrame, id_column: str, url_column: str, payload_column: str) -> DataFrame:
    payload = F.coalesce(F.col(payload_column).cast("binary"), F.lit(b""))
    chosen = pages.select(
        F.col(id_column).alias("page"), F.col(url_column).alias("url"), payload.alias("payload")
    )
    return chosen.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload")})


def _shared(keyed: DataFrame, shared_bytes: int) -> DataFrame:
    """(page, digest, refers) of every id whose payload occurs more than once.

    Payloads are counted before they are shuffled, by digest. The copies of a
    frequent payload find their group in pieces.
    """
    slim = keyed.filter(F.col("size") >= shared_bytes).select("page", "digest")
    groups = slim.groupBy("digest").agg(F.count("*").alias("n"), F.min("page").alias("refers"))
    groups = stored(groups.filter("n > 1"), "warc-groups")
    share = F.greatest(
        F.lit(float(COPIES.smallest_share)),
        groups.agg((F.coalesce(F.sum("n"), F.lit(0)) / COPIES.shares).alias("share")).scalar(),
    )
    frequent = groups.filter(F.col("n") > share).select(
        "digest", F.ceil(F.col("n") / share).alias("pieces")
    )
    found = split_key_left_join(slim, groups, "digest", "page", frequent)
    return found.filter("n > 1").select("page", "digest", "refers").distinct()


def _order(value: object) -> tuple:
    """A key that sorts in Python as Spark sorts the value, nulls first."""
    return (value is not None, value.encode() if isinstance(value, str) else value)


def _borders(keyed: DataFrame, shards: int) -> list[tuple]:
    """The first keys (page, digest) of all shards but the first; fewer where keys are few.

    The sample is drawn by a hash of the key, so it is a function of the rows. It
    has some ``SAMPLED`` keys a shard.
    """
    total = keyed.count()
    if shards < 2 or not total:
        return []
    limit = min(1.0, SAMPLED * shards / total) * 2**62
    drawn = F.pmod(F.xxhash64("page", "digest"), F.lit(2**62)) < F.lit(limit)
    sample = keyed.filter(drawn).groupBy("page", "digest").agg(F.count("*").alias("n"))
    key = Window.orderBy("page", "digest")
    share = F.sum("n").over(Window.partitionBy()) / shards
    at = F.floor((F.sum("n").over(key) - F.col("n")) / share)
    placed = sample.select("page", "digest", at.alias("at"))
    first = placed.withColumn("new", ~F.col("at").eqNullSafe(F.lag("at").over(key)))
    rows = first.filter("new AND at > 0").orderBy("page", "digest").collect()
    return [(_order(r.page), r.digest) for r in rows]


def _shard_of(borders: list[tuple]) -> Column:
    @F.arrow_udf("int")
    def shard(page: pa.Array, digest: pa.Array) -> pa.Array:
        keys = zip(map(_order, page.to_pylist()), digest.to_pylist(), strict=True)
        return pa.array([bisect_right(borders, key) for key in keys], pa.int32())

    return shard("page", "digest") if borders else F.lit(0)


def write(
    pages: DataFrame,
    path: str,
    shards: int | None = None,
    roll_bytes: int = ROLL_BYTES,
    shared_bytes: int = SHARED_BYTES,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
) -> None:
    """Write all rows as records of archives below ``path``, which must have no manifest yet.

    ``shards`` is by default ``spark.sql.shuffle.partitions``. Payloads are
    shuffled once; the groups of copies travel to their records as rows of ids
    and digests. A run that failed can be started again with the same path.
    """
    spark = pages.sparkSession
    for_tasks(spark)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = _keyed(pages, id_column, url_column, payload_column)
    borders = _borders(keyed, shards)
    notes = _shared(keyed, shared_bytes).withColumns(
        {"kind": F.lit(0), "url": F.lit(None).cast("string"), "payload": F.lit(None).cast("binary")}
    )
    rows = keyed.drop("size").withColumns({"kind": F.lit(1), "refers": F.lit(None).cast(notes.schema["refers"].dataType)})
    sort = ["shard", "page", "digest", "kind", "url"]
    both = notes.unionByName(rows).withColumn("shard", _shard_of(borders))
    dealt = both.repartitionById(len(borders) + 1, "shard").sortWithinPartitions(*sort)

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _store(path)
        attempt, file, note, last, copy = uuid.uuid4().hex, None, None, None, 0
        for batch in batches:
            columns = (batch.column(c) for c in ("shard", "kind", "page", "digest", "refers", "url", "payload"))
            for shard, kind, page, digest, refers, url, payload in zip(*columns, strict=True):
                shard, page, digest = shard.as_py(), page.as_py(), digest.as_py()
                if kind.as_py() == 0:
                    note = (page, digest, refers.as_py())
                    continue
                if file and file.shard != shard:
                    yield file.close()
                    file = None
                if file and file.size >= roll_bytes:
                    number = file.number + 1
                    yield file.close()
                    file = _File(store, folder, attempt, shard, number)
                file = file or _File(store, folder, attempt, shard, 0)
                copy = copy + 1 if (page, digest) == last else 0
                last, to = (page, digest), None
                if note and note[:2] == last and (copy or note[2] != page):
                    to = (note[2],)
                file.add(record(page, digest, copy, url.as_py(), payload.as_py(), to))
        if file:
            yield file.close()

    planned = stored(dealt.select(*sort, "refers", "payload").mapInArrow(files, _MANIFEST), "warc-plan")
    _commit(planned, path)


def _commit(planned: DataFrame, path: str) -> None:
    """Rename the planned files, then write the manifest; both can be done again."""

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _store(path)
        for batch in batches:
            for row in batch.to_pylist():
                old, new = f"{folder}/{row['temporary']}", f"{folder}/{row['name']}"
                if store.get_file_info(old).type == pa.fs.FileType.File:
                    if store.get_file_info(new).type == pa.fs.FileType.File:
                        store.delete_file(new)
                    store.move(old, new)
                elif store.get_file_info(new).size != row["bytes"]:
                    raise FileNotFoundError(f"{old} is gone and {new} is not the file planned")
            yield batch

    planned.mapInArrow(renamed, _MANIFEST).drop("temporary").write.parquet(posixpath.join(path, "manifest"))
    store, folder = _store(path)
    if store.get_file_info(f"{folder}/_temporary").type == pa.fs.FileType.Directory:
        store.delete_dir(f"{folder}/_temporary")


def _members(stream, sha, step: int = 1 << 20) -> Iterator[bytes]:
    """The contents of a file's gzip members, one by one; ``sha`` gets the bytes read."""
    left = b""
    while data := left or stream.read(step):
        unpacker, parts = zlib.decompressobj(31), []
        fresh = not left
        while not unpacker.eof:
            if not data:
                raise EOFError("the archive ends inside a record")
            if fresh:
                sha.update(data)
            parts.append(unpacker.decompress(data))
            data, fresh = b"" if unpacker.eof else stream.read(step), True
        left = unpacker.unused_data
        yield b"".join(parts)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields, and the content, whose length and block digest are checked."""
    head, _, rest = member.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    content = rest[: int(fields["Content-Length"])]
    if version.encode() != VERSION or rest[len(content) :] != b"\r\n\r\n":
        raise ValueError(f"not one whole record: {fields}")
    digest = fields.get("WARC-Block-Digest")
    if digest and digest != f"sha256:{hashlib.sha256(content).hexdigest()}":
        raise ValueError(f"wrong block digest: {fields}")
    return fields, content


def _page_of(fields: dict[str, str], content: bytes) -> tuple:
    http, _, payload = content.partition(b"\r\n\r\n")
    http_fields = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    kind, size = fields["WARC-Type"], int(http_fields["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
        raise ValueError(f"wrong payload: {fields}")
    named = [unquote(fields[f]) if f in fields else None for f in (ID_FIELD, REFERS_FIELD)]
    kept = payload if kind == "response" else None
    return (named[0], fields.get("WARC-Target-URI"), kind, kept, size, digest, named[1])


_PAGE = pa.schema(
    [
        ("page_id", pa.string()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.string()),
    ]
)


def read(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """Every record of the archives that the manifest lists.

    page_id, url, record_type, payload (null for a revisit), payload_bytes and
    payload_digest of the full payload, refers_to (a revisit's response). A file
    is one task's, read as a stream; what does not fit its digests is an error.
    """
    for_tasks(spark)
    manifest = spark.read.parquet(posixpath.join(path, "manifest")).select("name", "sha256", "records")
    wide = manifest.repartition(max(1, manifest.count()))

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _store(path)
        for row in (r for batch in batches for r in batch.to_pylist()):
            sha, found, size, rows = hashlib.sha256(), 0, 0, []
            with store.open_input_stream(f"{folder}/{row['name']}", compression=None) as stream:
                for member in _members(stream, sha):
                    fields, content = parse(member)
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    rows.append(_page_of(fields, content))
                    found, size = found + 1, size + len(content)
                    if size >= STEP_BYTES:
                        yield pa.record_batch(list(map(list, zip(*rows, strict=True))), schema=_PAGE)
                        size, rows = 0, []
            if (sha.hexdigest(), found) != (row["sha256"], row["records"]):
                raise ValueError(f"{row['name']} is not as its manifest says")
            if rows:
                yield pa.record_batch(list(map(list, zip(*rows, strict=True))), schema=_PAGE)

    schema = (
        "page_id string, url string, record_type string, payload binary, payload_bytes long,"
        " payload_digest string, refers_to string"
    )
    found = wide.mapInArrow(pages, schema)
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def round_trip(pages: DataFrame, shards: int | None = None) -> DataFrame:
    """Write the pages to a new shared folder and read them back."""
    spark, path = pages.sparkSession, new_folder(pages.sparkSession, "llm-warc")
    write(pages, path, shards)
    return read(spark, path, pages.schema["page_id"].dataType.simpleString())


def digest(records: DataFrame) -> DataFrame:
    """The records without urls and payloads."""
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
