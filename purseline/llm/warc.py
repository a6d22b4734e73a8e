"""WARC archives whose records are compressed one by one with a dictionary of their own.

An archive begins with a skippable frame that holds a Zstandard dictionary built from the
archive's records; each record follows as a frame of its own, so a reader can start at any
record once it has the dictionary. Payloads that were archived before are revisit records.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from purseline.llm.common import MemberFilter, column_of
from purseline.staging import stage, staging_path

# Fixed values of the formats: the skippable frame of a dictionary, the revisit profile.
DICTIONARY_FRAME = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Record bytes in one archive; it is what a task holds before it writes.
ARCHIVE_BYTES = 16_000_000
#: Archives that a reading task takes where there are more of them than cores.
READ_ARCHIVES = 8
#: Dictionary bytes, at most; a hundredth of the records where that is less.
DICTIONARY_BYTES = 65_536
#: Smaller payloads are archived again rather than revisited.
LEAST_REVISIT = 0
#: The tables hold no time of capture.
DATE = "1970-01-01T00:00:00Z"

READ = "id string, payload_bytes long, payload_digest string, record_type string, refers_to string"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(
    id: str | None, url: str | None, payload: bytes, digest: str, first: str | None, revisit: bool, size: int | None = None
) -> bytes:
    """One WARC record. Ids and addresses are escaped, so they cannot break the header.

    A revisit has no payload; its ``size`` is that of the payload it stands for.
    """

    def urn(name: str | None) -> str:
        return f"<urn:x-page:{'' if name is None else '=' + quote(name, safe='')}>"

    size = len(payload) if size is None else size
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {urn(id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._')}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {urn(first)}"]
    else:
        block += payload
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """None where the records are too few or too small to learn from."""
    size = min(DICTIONARY_BYTES, sum(map(len, records)) // 100)
    if size < 1_024 or len(records) < 8:
        return None
    try:
        return zstandard.train_dictionary(size, records, k=256, d=8)
    except zstandard.ZstdError:
        return None


def write_archive(folder: str, records: list[bytes]) -> str:
    """Write one archive under a name nobody used; a repeated task leaves an unlisted file."""
    files, root = pyarrow.fs.FileSystem.from_uri(folder)
    name = f"{uuid.uuid4().hex}.warc.zst"
    learned = _dictionary(records)
    squeeze = zstandard.ZstdCompressor(level=6, dict_data=learned, write_checksum=True)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/{name}", compression=None) as out:
        if learned is not None:
            data = learned.as_bytes()
            out.write(struct.pack("<II", DICTIONARY_FRAME, len(data)) + data)
        for one in records:
            out.write(squeeze.compress(one))
    return name


def frames(stream, step: int = 1 << 16) -> Iterator[bytes]:
    """The records of an archive, one at a time."""
    held, learned = stream.read(8), None
    if len(held) == 8 and struct.unpack("<I", held[:4])[0] == DICTIONARY_FRAME:
        learned = zstandard.ZstdCompressionDict(stream.read(struct.unpack("<I", held[4:])[0]))
        held = b""
    expand = zstandard.ZstdDecompressor(dict_data=learned)
    held = held or stream.read(step)
    while held:
        one, parts = expand.decompressobj(), []
        while not one.eof:
            if not held:
                raise ValueError("the archive ends within a record")
            parts.append(one.decompress(held))
            held = one.unused_data if one.eof else stream.read(step)
        held = held or stream.read(step)
        yield b"".join(parts)


def parse(data: bytes) -> tuple:
    """Back from a record to ``READ``; the payload of a response is checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(http.decode().rsplit("Content-Length: ", 1)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def name(field: str) -> str | None:
        text = fields.get(field, "<urn:x-page:>").removeprefix("<urn:x-page:").removesuffix(">")
        return unquote(text[1:]) if text else None

    return name("WARC-Record-ID"), size, digest, fields["WARC-Type"], name("WARC-Refers-To")


def write_archives(
    pages: DataFrame,
    folder: str,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    archive_bytes: int = ARCHIVE_BYTES,
    least: int = LEAST_REVISIT,
) -> DataFrame:
    """Write all pages; returns ``(archive, records, bytes)``, one row per archive.

    Of equal payloads of at least ``least`` bytes the row with the least id is the response
    and the others revisit it. Rows that share that id are all responses. A NULL id is larger
    than any other, a NULL payload is empty, a NULL address is left out. Columns of any other
    name are not read; without pages there are no archives.

    Digests and ids are grouped, map side first. Pages whose digest certainly does not repeat
    are written by the task that read them. Of the others a row without the body goes to the
    copies of its digest; only those that turn out to be responses move with their bodies, one
    per repeated payload and not one per copy.
    """
    body = F.coalesce(column_of(html), F.lit(""))
    sha = F.sha1(body)
    rows = pages.select(
        column_of(id).alias("id"),
        column_of(url).cast("string").alias("url"),
        body.alias("body"),
        sha.alias("sha"),
        F.octet_length(body).cast("long").alias("size"),
        F.xxhash64(sha).alias("hash"),
        F.xxhash64(sha, column_of(id)).alias("row_hash"),
    )
    digests = rows.select("id", "sha", "hash").groupBy(F.col("sha").alias("of"), F.col("hash").alias("of_hash"))
    repeated = digests.agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    repeated = stage(repeated, "warc-repeated")
    seen = MemberFilter(repeated, "of_hash")
    alone = seen.split(rows, "hash", passing=False)
    copies = seen.split(rows.drop("body"), "hash").join(repeated, F.col("sha") == F.col("of"), "left")
    response = F.col("of").isNull() | F.col("id").eqNullSafe(F.col("first")) | (F.col("size") < least)
    copies = stage(copies.withColumn("response", response), "warc-copies")
    firsts = copies.where("response").select(F.col("sha").alias("first_sha"), F.col("id").alias("first_id"), F.col("row_hash").alias("of_row"))
    firsts = stage(firsts.distinct(), "warc-responses")
    held = MemberFilter(firsts, "of_row").split(seen.split(rows, "hash"), "row_hash")
    same = (F.col("sha") == F.col("first_sha")) & F.col("id").eqNullSafe(F.col("first_id"))
    held = held.join(firsts, same, "left_semi")

    def typed(some: DataFrame, body: Column, first: Column, revisit: bool) -> DataFrame:
        text = F.col("id").cast("string").alias("id")
        return some.select(text, "url", body.alias("body"), "size", first.cast("string").alias("first"), F.lit(revisit).alias("revisit"), "sha")

    revisits = typed(copies.where("not response"), F.lit(None).cast("string"), F.col("first"), True)
    responses = typed(alone.unionByName(held), F.col("body"), F.col("id"), False)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def flush() -> pd.DataFrame:
            return pd.DataFrame({"archive": [write_archive(folder, held)], "records": [len(held)], "bytes": [size]})

        for batch in batches:
            for x in batch.itertuples(index=False):
                payload = (x.body or "").encode("utf-8", "surrogatepass")
                digest = base64.b32encode(bytes.fromhex(x.sha)).decode()
                one = record(x.id, x.url, payload, digest, x.first, bool(x.revisit), int(x.size))
                held.append(one)
                size += len(one)
                if size >= archive_bytes:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    written = responses.unionByName(revisits).mapInPandas(write, "archive string, records long, bytes long")
    return stage(written, "warc-archives")


def read_archives(spark: SparkSession, archives: DataFrame, folder: str) -> DataFrame:
    """The records of the listed archives, as ``READ``; one task reads one archive at a time."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch["archive"]:
                with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    rows = [parse(data) for data in frames(stream)]
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in READ.split(", ")])

    number = archives.count()
    spread = archives.repartition(max(1, min(number, spark.sparkContext.defaultParallelism), -(-number // READ_ARCHIVES)))
    return spread.select("archive").mapInPandas(read, READ)


def archive_report(pages: DataFrame) -> DataFrame:
    """The columns of the contract, read back from the archives."""
    spark = pages.sparkSession
    folder = staging_path(spark, "warc")
    read = read_archives(spark, write_archives(pages, folder), folder)
    kind = dict(pages.dtypes)["page_id"]
    return read.select(
        F.col("id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


SQL = """
with p as (select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as h from pages),
letters as (
    select distinct h, (('0x' || substr(h, 1 + 10 * (i // 8), 10))::bigint >> (35 - 5 * (i % 8))) & 31 as v, i
    from (select h, unnest(generate_series(0, 31)) as i from p)),
base32 as (
    select h, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v + 1)::integer, 1), '' order by i) as digest
    from letters group by h),
firsts as (select h, min(page_id) as first from p group by h)
select page_id, octet_length(encode(body))::bigint as payload_bytes, digest as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to
from p join firsts using (h) join base32 using (h)
"""
