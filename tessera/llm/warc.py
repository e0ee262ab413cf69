"""WARC archives: written as monolithic gzip files, normalised to one member a record with an offset index, read back.

1. Pages are judged by payload: of records with equal payloads the one with the largest page_id is the response and the
   others are revisits that refer to it. Only (payload digest, page_id) is aggregated, combined before its shuffle.
2. Each task writes its pages as one WARC file under a single gzip stream, as many crawlers do.
3. The normaliser inflates each such file once, as a stream, rewrites every record as a gzip member of its own and
   writes a sidecar index (offset, length, type, digest, record id), so that any record can be read by one seek.
4. Reading goes by the index, member by member, and parses the records.

Files lie in the shared folder and are opened through pyarrow's file systems by the scheme of the store that holds it (file,
hdfs, s3 and its names s3a and s3n, gs, abfss). Every file is written under
an attempt's own name and then moved to its final one, so tasks may run again or twice. Records and file order follow
the partitioning, but the rows read back do not depend on it.

Defined cases: a null or empty html is a payload of no bytes; pages with equal ids and payloads all are responses when
their id is the largest; a null page_id is never the largest unless all are null, and then all are responses; a page
with a null url has an empty target; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import new_path, prepare, staged, table

#: Payloads of fewer bytes are responses without comparison.
LEAST_BYTES = 0
#: Compressed bytes that are read at a time; and the date of every record, so that archives are reproducible.
PIECE, DATE = 1 << 18, "2024-01-01T00:00:00Z"
_HEADER_END = b"\r\n\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC/1.0 record of an HTTP response; a revisit holds only the HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = "".join((url or "").split())
    name = "" if page_id is None else str(page_id)
    seed = f"{name}\0{target}\0{digest(payload)}\0{revisit}"
    lines = [
        "WARC/1.0", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, seed)}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Page-ID: {name}", f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}", "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest", f"WARC-Refers-To-Page-ID: {refers_to}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + _HEADER_END + block + _HEADER_END


def headers(raw: bytes) -> dict[str, str]:
    """Header fields by lower-case name; raw is a header block without its final blank line."""
    pairs = (line.split(b":", 1) for line in raw.split(b"\r\n")[1:] if b":" in line)
    return {k.strip().lower().decode(): v.strip().decode("utf-8", "replace") for k, v in pairs}


def inflated(file) -> Iterator[bytes]:
    """The content of a gzip stream, whatever its members, in pieces."""
    engine = zlib.decompressobj(31)
    while piece := file.read(PIECE):
        while piece:
            yield engine.decompress(piece)
            piece = engine.unused_data
            if engine.eof:
                engine = zlib.decompressobj(31)


def records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, whole record) of each record; memory is bounded by the largest record."""
    held = bytearray()
    pieces = iter(pieces)

    def more() -> bool:
        for piece in pieces:
            if piece:
                held.extend(piece)
                return True
        return False

    while True:
        while (end := held.find(_HEADER_END)) < 0:
            if not more():
                if held.strip():
                    raise ValueError("the archive ends within a header")
                return
        fields = headers(bytes(held[:end]))
        size = end + len(_HEADER_END) + int(fields["content-length"]) + len(_HEADER_END)
        while len(held) < size:
            if not more():
                raise ValueError("the archive ends within a record")
        yield fields, bytes(held[:size])
        del held[:size]


def parse(raw: bytes) -> tuple[int | None, int, str, str, int | None]:
    """(page_id, payload bytes, payload digest, record type, refers_to) of one record, checked where it has its payload."""
    head, _, rest = raw.partition(_HEADER_END)
    fields = headers(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(_HEADER_END)
    size = int(headers(http)["content-length"])
    found = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != size or digest(payload) != found):
        raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
    number = lambda x: int(x) if x else None
    return number(fields["warc-page-id"]), size, found, kind, number(fields.get("warc-refers-to-page-id", ""))


# --- files in the shared folder


#: Schemes that clusters use for stores which pyarrow knows by another name.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}


def resolved(spark: SparkSession, folder: str) -> str:
    """A folder by the store that holds it, behind mount tables and links; it is made if need be."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(path)
    scheme, _, rest = store.resolvePath(path).toString().partition(":")
    return f"{scheme}:{rest}" if rest.startswith("//") else f"{scheme}://{rest}"


def _filesystem(uri: str):
    from pyarrow import fs

    scheme, _, rest = uri.partition("://")
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")


class _Output:
    """A file that appears under its name only when whole."""

    def __init__(self, uri: str):
        self.fs, self.path = _filesystem(uri)
        self.own = f"{self.path}.{uuid.uuid4().hex}.part"
        self.fs.create_dir(posixpath.dirname(self.path), recursive=True)
        self.file = self.fs.open_output_stream(self.own, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.file.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.file.close()
        self.fs.move(self.own, self.path)


def _input(uri: str):
    where, path = _filesystem(uri)
    return where.open_input_file(path)


def _batch(names: list[str], rows: list[tuple], schema):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], names=names)


_RAW = "archive string, records long, bytes long"
_INDEX = "archive string, offset long, length long, record_type string, payload_digest string, record_id string"
_PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _arrow(ddl: str):
    """An Arrow schema of columns that are strings or longs."""
    import pyarrow as pa

    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(name, kinds[kind]) for name, kind in map(str.split, ddl.split(","))])


def write_archives(judged: DataFrame, folder: str) -> DataFrame:
    """Write (page_id, url, html, refers_to, revisit) as one monolithic gzip WARC a task; returns the files."""

    def run(batches):
        from pyspark import TaskContext

        context, out, engine, count = TaskContext.get(), None, None, 0
        for batch in batches:
            for page_id, url, html, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    uri = f"{folder}/raw/part-{context.partitionId():06d}.warc.gz"
                    out, engine = _Output(uri), zlib.compressobj(6, zlib.DEFLATED, 31)
                out.write(engine.compress(record(page_id, url, (html or "").encode(), refers_to, revisit)))
                count += 1
        if out is not None:
            out.write(engine.flush())
            out.close()
            yield _batch(["archive", "records", "bytes"], [(uri, count, out.size)], _arrow(_RAW))

    return judged.select("page_id", "url", "html", "refers_to", "revisit").mapInArrow(run, _RAW)


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive with one gzip member a record and a sidecar index; returns the index."""
    names = [f.name for f in _arrow(_INDEX)]

    def run(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                name = posixpath.basename(uri).removesuffix(".warc.gz")
                target = f"{folder}/records/{name}.warc.gz"
                out, index = _Output(target), _Output(f"{folder}/records/{name}.idx")
                rows: list[tuple] = []
                with _input(uri) as file:
                    for fields, raw in records(inflated(file)):
                        engine = zlib.compressobj(6, zlib.DEFLATED, 31)
                        at = out.size
                        out.write(engine.compress(raw) + engine.flush())
                        shown = (fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-record-id"])
                        index.write(" ".join(map(str, (at, out.size - at, *shown))).encode() + b"\n")
                        rows.append((target, at, out.size - at, *shown))
                        if len(rows) == 1000:
                            yield _batch(names, rows, _arrow(_INDEX))
                            rows = []
                out.close()
                index.close()
                if rows:
                    yield _batch(names, rows, _arrow(_INDEX))

    return archives.select("archive").mapInArrow(run, _INDEX)


def read_records(archives: DataFrame) -> DataFrame:
    """Read normalised archives back, each member by its place in the sidecar index."""
    names = [f.name for f in _arrow(_PAGES)]

    def run(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows: list[tuple] = []
                with _input(uri) as file, _input(uri.removesuffix(".warc.gz") + ".idx") as index:
                    rest = b""
                    while piece := index.read(PIECE):
                        *lines, rest = (rest + piece).split(b"\n")
                        for line in lines:
                            at, size = map(int, line.split(b" ", 2)[:2])
                            file.seek(at)
                            rows.append(parse(zlib.decompress(file.read(size), 31)))
                            if len(rows) == 1000:
                                yield _batch(names, rows, _arrow(_PAGES))
                                rows = []
                if rows:
                    yield _batch(names, rows, _arrow(_PAGES))

    return archives.select("archive").mapInArrow(run, _PAGES)


def judge(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, html, refers_to, revisit: the payload's owner is the largest page_id that has it."""
    payload = F.coalesce("html", F.lit(""))
    key = F.unhex(F.sha2(payload.cast("binary"), 256))
    pages = pages.select("page_id", "url", payload.alias("html"), key.alias("key"))
    owners = pages.where(F.octet_length("html") >= least_bytes).groupBy("key").agg(F.max("page_id").alias("owner"), F.count(F.lit(1)).alias("n"))
    # only payloads that occur twice or more; written, so that the join may split a payload that many pages share
    owners = staged(owners.where("n > 1 and owner is not null").select(F.col("key").alias("of_key"), "owner"), "payload-owners")
    joined = pages.join(owners, F.col("key") == F.col("of_key"), "left")
    revisit = F.coalesce(F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner")), F.lit(False))
    return joined.select("page_id", "url", "html", F.when(revisit, F.col("owner")).alias("refers_to"), revisit.alias("revisit"))


def archive(pages: DataFrame, least_bytes: int = LEAST_BYTES, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(files of the normalised archives with their monolithic sources, index of all records)."""
    spark = pages.sparkSession
    prepare(spark)
    folder = resolved(spark, folder or new_path(spark, "warc"))
    raw = staged(write_archives(judge(pages, least_bytes), folder), "warc-raw")
    spread = raw.repartition(max(1, min(raw.count(), 10_000)), "archive")
    return raw, staged(normalise(spread, folder), "warc-index")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, index = archive(table(spark, sf_dir, "pages"))
    files = index.select("archive").distinct()
    return read_records(files.repartition(max(1, min(raw.count(), 10_000)), "archive"))


ORACLE_SQL = f"""
with own as (select page_id, coalesce(html, '') as html from pages),
sized as (select page_id, html, octet_length(encode(html)) as payload_bytes, max(page_id) over (partition by html) as owner, sha1(encode(html)) as hex from own),
digits as (
  select *, list_transform(generate_series(0, 31), lambda k: (
    (('0x' || substr(hex, 10 * (k // 8) + 1, 10))::bigint >> (35 - 5 * (k % 8))) & 31)) as five from sized)
select page_id, payload_bytes, list_aggregate(list_transform(five, lambda d: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', d::int + 1, 1)), 'string_agg', '') as payload_digest,
  case when page_id < owner and payload_bytes >= {LEAST_BYTES} then 'revisit' else 'response' end as record_type,
  case when page_id < owner and payload_bytes >= {LEAST_BYTES} then owner end as refers_to
from digits
"""
