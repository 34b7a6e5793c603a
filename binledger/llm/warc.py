"""WARC archives: writing, and a sequential reader.

Every record is a gzip member of its own. The reader streams an archive in fixed blocks through ``zlib``: it inflates
one member at a time, parses the record header as soon as it is there, takes exactly Content-Length bytes as the block,
digests while it goes and compares with the stated digests at the end; it never holds more than one record. Whole
archives are the units of parallel work: the writer closes a file at ``FILE_BYTES`` and lists every finished file in a
manifest table. A file that a lost or repeated task left behind is in no manifest and is never read.

Archives live in the folder named by ``spark.checkpoint.dir`` (or one that is given) and are opened by its URI, so that
any store that Arrow or Spark's executors can reach will do.

Of records with equal payloads the one with the smallest id carries the payload (response), the others refer to it
(revisit). Defined results: a NULL payload is the empty payload. A row without an id gets a record id made of its content;
it is read back with a NULL id, and is a revisit where a row with an id has its payload. Repeated ids give one record each;
rows that repeat an id and its payload are all responses or all revisits. A damaged archive raises ValueError.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from binledger.llm.registry import query, table
from binledger.session import new_stage_path

#: Bytes after which an archive is closed and the next one begun.
FILE_BYTES = 256 << 20
#: Bytes that are read from an archive at a time.
BLOCK = 1 << 16
#: Payloads of fewer bytes are always stored (0: all may be revisits).
SMALLEST_REVISIT = 0

_DATE = "2020-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        """What follows the HTTP header of a response."""
        if self.headers.get("content-type", "").startswith("application/http"):
            return self.block.partition(b"\r\n\r\n")[2]
        return self.block


def member(headers: dict[str, str], block: bytes, level: int = 6) -> bytes:
    """One record as one gzip member."""
    lines = ["WARC/1.0", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode()) + packer.compress(block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    name = f"page:{page_id}" if page_id is not None else f"sha1:{digest((url or '').encode() + payload)}:{uuid4().hex}"
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:{name}>",
        "WARC-Date": _DATE,
        # header lines end at a line break: an address never brings its own
        "WARC-Target-URI": " ".join((url or "").split()),
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "Content-Type": "application/http; msgtype=response",
    }
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        block += payload
    else:
        headers |= {"WARC-Refers-To": f"<urn:page:{refers_to}>", "WARC-Profile": _REVISIT}
    headers["WARC-Block-Digest"] = f"sha1:{digest(block)}"
    return member(headers, block)


def records(chunks: Iterable[bytes]) -> Iterator[Record]:
    """The records of one archive, in order, from its bytes in pieces of any size."""
    waiting = iter(chunks)
    rest = b""
    while True:
        while not rest:
            rest = next(waiting, None)
            if rest is None:
                return
        unpack = zlib.decompressobj(31)
        head, headers, block, length = b"", None, bytearray(), 0
        while not unpack.eof:
            try:
                got = unpack.decompress(rest, BLOCK)
            except zlib.error as e:
                raise ValueError(f"damaged archive: {e}") from e
            rest = unpack.unconsumed_tail or unpack.unused_data
            if headers is None:
                head += got
                top, found, tail = head.partition(b"\r\n\r\n")
                if found:
                    headers = _headers(top)
                    length = int(headers["content-length"])
                    block += tail
            else:
                block += got
            if not unpack.eof and not rest and not got:
                rest = next(waiting, None)
                if rest is None:
                    raise ValueError("archive ends inside a record")
        if headers is None or len(block) != length + 4 or block[length:] != b"\r\n\r\n":
            raise ValueError("a record's length is not its Content-Length")
        del block[length:]
        record = Record(headers, bytes(block))
        _verify(record)
        yield record


def _headers(top: bytes) -> dict[str, str]:
    first, *lines = top.decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _verify(record: Record) -> None:
    stated = record.headers.get("warc-block-digest", "")
    if stated and stated != f"sha1:{digest(record.block)}":
        raise ValueError(f"block digest of {record.headers.get('warc-record-id')}")
    if record.headers["warc-type"] != "revisit":
        stated = record.headers.get("warc-payload-digest", "")
        if stated and stated != f"sha1:{digest(record.payload)}":
            raise ValueError(f"payload digest of {record.headers.get('warc-record-id')}")


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith(("file:", "hdfs:")) else f"file://{uri}")


def _uri(folder: str) -> str:
    return folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder


def revisits(pages: DataFrame, key: str, payload: str, smallest: int = SMALLEST_REVISIT) -> DataFrame:
    """Add ``refers_to``: the smallest id with the same payload where that is another row, else NULL.

    The digests are counted before the shuffle (one row per digest and task), and only they are grouped; the pages
    then meet their digest's row in a join whose small side is hashed, so a digest of a third of all pages is split
    over tasks by the adaptive plan.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    marked = pages.withColumn("_digest", F.sha2(body, 256))
    firsts = marked.groupBy("_digest").agg(F.min(key).alias("_first"))
    joined = marked.join(firsts.hint("shuffle_hash"), "_digest")
    other = ~F.col("_first").eqNullSafe(F.col(key)) & (F.octet_length(body) >= smallest)
    return joined.withColumn("refers_to", F.when(other, F.col("_first"))).drop("_digest", "_first")


def write_warc(df: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write a record per row (with ``refers_to`` a revisit) and return the manifest: path, records, bytes."""
    folder = _uri(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        out, path, n, size, done = None, "", 0, 0, []

        def close() -> None:
            nonlocal out
            out.close()
            done.append({"path": path, "records": n, "bytes": size})
            out = None

        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if out is None:
                    name = f"{uuid4().hex}.warc.gz"  # of this attempt alone
                    store.create_dir(root, recursive=True)
                    out, path, n, size = store.open_output_stream(f"{root}/{name}", compression=None), f"{folder}/{name}", 0, 0
                packed = page_record(row[key], row[url], (row[payload] or "").encode(), row["refers_to"])
                out.write(packed)
                n, size = n + 1, size + len(packed)
                if size >= FILE_BYTES:
                    close()
        if out is not None:
            close()
        yield pa.RecordBatch.from_pylist(
            done, schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
        )

    chosen = df.select(key, url, payload, "refers_to")
    return chosen.mapInArrow(run, "path string, records long, bytes long")


def read_warc(manifest: DataFrame) -> DataFrame:
    """Every record of the listed archives: type, id, target, digest, payload, payload length, refers_to.

    The stated length of a revisit's payload is that of its HTTP header; its payload is NULL.
    """
    fields = [("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
              ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.string()),
              ("refers_to", pa.string())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                store, path = _store(uri)
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as source:
                    for record in records(iter(lambda s=source: s.read(BLOCK), b"")):
                        rows.append(_row(record))
                        held += len(record.block)
                        if held >= 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    ddl = "record_type string, record_id string, target_uri string, payload_digest string, payload_bytes long, " \
          "payload string, refers_to string"
    return manifest.select("path").mapInArrow(run, ddl)


def _row(record: Record) -> dict:
    h = record.headers
    revisit = h["warc-type"] == "revisit"
    http = record.block.partition(b"\r\n\r\n")[0].decode("utf-8").split("\r\n")
    stated = next((int(x.partition(":")[2]) for x in http if x.lower().startswith("content-length:")), None)
    return {
        "record_type": h["warc-type"], "record_id": h["warc-record-id"], "target_uri": h.get("warc-target-uri"),
        "payload_digest": h.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "payload_bytes": stated if revisit else len(record.payload),
        "payload": None if revisit else record.payload.decode("utf-8", "replace"),
        "refers_to": h.get("warc-refers-to"),
    }


def archive(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives under the shared folder, until ``clear_stage``; the manifest, a table of its own."""
    folder = new_stage_path(spark, "warc")
    listed = f"{folder}/manifest"
    write_warc(revisits(pages.select("page_id", "url", "html"), "page_id", "html"), f"{folder}/data").write.parquet(listed)
    return spark.read.schema("path string, records long, bytes long").parquet(listed)


_ORACLE = """
with p as (
  select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as hex from pages
), g as (
  select *, min(page_id) over (partition by body) as first_id,
         array_to_string([lpad(bin(('0x' || hex[i + 1])::int), 4, '0') for i in range(40)], '') as bits
  from p
)
select page_id, strlen(body)::bigint as payload_bytes,
       array_to_string(['ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[list_sum([
         bits[i * 5 + j + 1]::int * (16 >> j) for j in range(5)])::int + 1] for i in range(32)], '') as payload_digest,
       case when first_id = page_id then 'response' else 'revisit' end as record_type,
       case when first_id = page_id then null else first_id end as refers_to
from g
"""


@query("op1_warc", _ORACLE)
def op1(spark, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    number = lambda c: F.regexp_extract(c, r"page:(-?\d+)", 1).try_cast("long")
    # one archive is one task: spread the paths, whatever file of the manifest they stand in
    paths = archive(spark, pages)
    return read_warc(paths.repartition(spark.sparkContext.defaultParallelism * 4, "path")).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"),
    )
