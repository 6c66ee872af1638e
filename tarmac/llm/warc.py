"""WARC archives: written by tasks in parallel, read back sequentially record by record.

Every record is a gzip member of its own. The reader walks a file from its start: it inflates one
member after another in small steps, finds the block by its Content-Length and checks the digests
while the bytes pass, so memory holds one record and not a file.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import folder_on
from tarmac.session import shared_folder

#: Bytes read and inflated at a time, and payload bytes of a row batch.
STEP, BATCH = 1 << 16, 16 << 20
#: Payloads below this size are always written in full.
LEAST = 100
_END = b"\r\n\r\n"


class Damaged(ValueError):
    """A file that is no series of whole WARC records."""


# --- records -------------------------------------------------------------------------------------

def _head(first: str, fields: dict[str, str]) -> bytes:
    lines = [first, *(f"{k}: {v}" for k, v in fields.items())]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass")


def _digest(data: bytes) -> str:
    return "sha256:" + base64.b32encode(hashlib.sha256(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member: a response with its payload, or a revisit with the headers alone."""
    revisit = refers_to is not None
    http = _head("HTTP/1.1 200 OK", {"Content-Type": "text/html; charset=utf-8",
                                     "Content-Length": str(len(payload))})
    block = http if revisit else http + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Target-URI": quote(url or "", safe="/:?&=#%+,;@!$'()*~[]").replace("%25", "%"),
        "X-URL": "" if url is None else "=" + quote(url, safe="", errors="surrogatepass"),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": _digest(payload), "WARC-Block-Digest": _digest(block),
        "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    if revisit:
        fields["WARC-Refers-To"] = f"<urn:page:{refers_to}>"
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(_head("WARC/1.1", fields) + block + _END) + packer.flush()


def _members(stream) -> Iterator[Iterator[bytes]]:
    """For each gzip member of a stream an iterator over its inflated pieces, to be used in order."""
    rest = stream.read(STEP)
    while rest:
        inflate = zlib.decompressobj(31)

        def pieces():
            nonlocal rest
            while not inflate.eof:
                data = rest or stream.read(STEP)
                if not data:
                    raise Damaged("a gzip member ends early")
                rest = b""
                piece = inflate.decompress(data, STEP)
                while piece:
                    yield piece
                    piece = b"" if inflate.eof else inflate.decompress(inflate.unconsumed_tail, STEP)
                if inflate.unconsumed_tail:
                    rest = inflate.unconsumed_tail
            rest = inflate.unused_data

        own = pieces()
        yield own
        for _ in own:  # what the reader of the member left
            pass
        rest = rest or stream.read(STEP)


def _fields(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged(f"no header field: {line[:80]}")
        fields[name.strip().lower()] = value.strip()
    return first, fields


def records(stream) -> Iterator[dict]:
    """The records of an archive: headers, payload and whether both digests hold."""
    for pieces in _members(stream):
        data = b""
        for piece in pieces:
            data += piece
            if _END in data:
                break
        head, found, body = data.partition(_END)
        first, fields = _fields(head)
        if not found or not first.startswith("WARC/"):
            raise Damaged("a member does not begin with a WARC header")
        size = int(fields["content-length"])
        block = io.BytesIO()
        block.write(body)
        for piece in pieces:
            block.write(piece)
        whole = block.getvalue()
        if len(whole) != size + len(_END) or whole[size:] != _END:
            raise Damaged("a block is not as long as its Content-Length")
        whole = whole[:size]
        http, _, payload = whole.partition(_END)
        http_size = int(_fields(http)[1]["content-length"])
        kind = fields["warc-type"]
        good = _digest(whole) == fields["warc-block-digest"]
        if kind == "response":
            good = good and len(payload) == http_size and _digest(payload) == fields["warc-payload-digest"]
        name, _, digest = fields["warc-payload-digest"].partition(":")
        digest = base64.b32decode(digest).hex()
        if kind == "response":  # what was read, whatever the headers say
            http_size, digest = len(payload), hashlib.sha256(payload).hexdigest()
        yield {
            "page_id": _page(fields["warc-record-id"]),
            "url": unquote(fields["x-url"][1:], errors="surrogatepass") if fields.get("x-url") else None,
            "record_type": kind, "refers_to": _page(fields.get("warc-refers-to", "")),
            "payload_bytes": http_size, "payload_digest": digest,
            "payload": payload if kind == "response" else None, "valid": good and name == "sha256"}


def _page(uri: str) -> int | None:
    number = uri.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


# --- Spark ---------------------------------------------------------------------------------------

def _references(pages: DataFrame, key: str, payload: str, digest: str) -> DataFrame:
    """``pages`` with ``_first``: the smallest key of those with an equal payload, if there are more.

    Only digests of more than one key are joined, so the rows of one very frequent payload meet a
    single row; the shuffle may split them.
    """
    first = pages.filter(F.octet_length(payload) >= LEAST).groupBy(F.col(digest).alias("_same")).agg(
        F.min(key).alias("_first"), F.max(key).alias("_other")).filter(
        F.col("_first") != F.col("_other")).drop("_other")
    return pages.join(first, F.col(digest) == F.col("_same"), "left").drop("_same")


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url",
                   html: str = "html") -> DataFrame:
    """Write a record for each row into ``folder`` and return ``path, records`` of the archives.

    A null html is an empty payload. Of records with equal payloads of LEAST bytes or more, the one
    with the smallest key is the response and the others revisit it. Rows that repeat that smallest
    key are all responses; a null key never is the smallest and revisits. A task writes one file,
    under a name of its own that it takes on when it is whole, so a task that runs again, or twice,
    leaves the same archive. The folder must be one that every executor reaches.
    """
    from pyarrow import fs

    narrow = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"),
                          F.coalesce(html, F.lit("")).alias("html"))
    dealt = _references(narrow.withColumn("digest", F.sha2("html", 256)), "page_id", "html", "digest")
    system, root = folder_on(folder)
    system.create_dir(root)

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = folder_on(folder)
        task = TaskContext.get()
        final = f"{base}/part-{task.partitionId():06d}.warc.gz"
        draft = f"{base}/.{uuid.uuid4().hex}"
        count = 0
        with store.open_output_stream(draft, compression=None) as out:
            for part in parts:
                for page, link, text, first in zip(part["page_id"], part["url"], part["html"], part["_first"]):
                    page = None if pd.isna(page) else int(page)
                    first = None if pd.isna(first) or first == page else int(first)
                    out.write(record(page, link, text.encode("utf-8", "surrogatepass"), first))
                    count += 1
        if not count:
            store.delete_file(draft)
            return
        if store.get_file_info(final).type != fs.FileType.NotFound:
            store.delete_file(final)
        store.move(draft, final)
        yield pd.DataFrame({"path": [final], "records": [count]})

    return dealt.select("page_id", "url", "html", "_first").mapInPandas(write, "path string, records long")


def read_archives(spark: SparkSession, folder: str, names: list[str] | None = None,
                  payload: bool = True) -> DataFrame:
    """The records of the archives in ``folder``, a task for each few files.

    ``page_id, url, record_type, refers_to, payload_bytes, payload_digest`` (of the full payload: as
    read for responses, by the headers for revisits), ``valid`` (both digests hold) and, unless ``payload`` is false, ``payload`` (null
    for revisits). A file that is cut off or not framed as its headers say raises an error.
    """
    paths = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    files = paths.select(F.regexp_extract("path", r"[^/]+\z", 0).alias("name"))
    columns = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, valid boolean"
    columns += ", payload binary" if payload else ""
    wanted = [c.split()[0] for c in columns.split(", ")]

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = folder_on(folder)
        for part in parts:
            for name in part["name"]:
                rows, size = [], 0
                with store.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for row in records(stream):
                        rows.append([row[c] for c in wanted])
                        size += row["payload_bytes"] if payload else 256
                        if size > BATCH:
                            yield _frame(rows, wanted)
                            rows, size = [], 0
                if rows:
                    yield _frame(rows, wanted)

    return files.mapInPandas(read, columns)


def _frame(rows: list, wanted: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=wanted).astype({"page_id": "Int64", "refers_to": "Int64"})


def archive_round_trip(pages: DataFrame, key: str = "page_id", url: str = "url",
                       html: str = "html", payload: bool = False) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back.

    A record whose digests do not hold raises an error. Other columns of ``pages`` are left out. An empty table gives no archive and no rows.
    """
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, folder, key, url, html).write.format("noop").mode("overwrite").save()
    return checked(read_archives(spark, folder, payload=payload))


def checked(rows: DataFrame) -> DataFrame:
    """``rows`` of archives; one that is not ``valid`` raises an error when it is read.

    The check hangs on ``page_id``, ``payload_bytes`` and ``payload_digest``, so that a query that
    takes some columns only still makes it.
    """
    def held(name):
        return F.when(F.col("valid"), F.col(name)).otherwise(F.raise_error(
            F.concat(F.lit("damaged record of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("null")))
        ).cast(rows.schema[name].dataType)).alias(name)

    return rows.select(*(held(c) if c in ("page_id", "payload_bytes", "payload_digest") else F.col(c)
                         for c in rows.columns))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p GROUP BY html)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN octet_length(encode(html)) >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN octet_length(encode(html)) >= 100 AND page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (html)"""
