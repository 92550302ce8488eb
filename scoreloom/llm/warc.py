"""WARC archives: writing, reading back, and a store that keeps equal payloads once.

Files hold WARC/1.1 records. A payload that many records share is written with one of them, the
response; the others are revisits that refer to it. The store goes further: it keeps the bytes of
each payload once under its SHA-256, whatever the record, and the exact headers of every record in a table of
their own. Joining the two gives back the records byte by byte.
"""

from __future__ import annotations

import gzip
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.session import materialize, shared_dir

END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads below this size are always written out.
REVISIT_FROM = 1000
#: Records of a file; a file is read back as a whole.
FILE_RECORDS = 4096
_ID = "urn:page:"
GZIP = b"\x1f\x8b"


def plan_records(pages: DataFrame, key: str, url: str, html: str, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Rows ``(key, url, html, digest, refers_to)``; ``refers_to`` is set on revisits.

    Among equal payloads of at least ``revisit_from`` bytes the one with the largest key is the response. Rows that
    share that largest key, or have no key, are responses too.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.encode("html", "UTF-8"), 256))
    large = rows.where(F.octet_length("html") >= revisit_from).groupBy("digest")
    shared = large.agg(F.max("key").alias("holder"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    # only digests that occur twice; written so that Spark knows its size when it picks the join
    shared = materialize(shared.select("digest", "holder"), "shared-payloads")
    joined = rows.join(shared, "digest", "left")
    return joined.select("key", "url", "html", "digest", F.when(F.col("key") < F.col("holder"), F.col("holder")).alias("refers_to"))


def record_text(date: str) -> Column:
    """A record of ``plan_records`` without the four closing bytes."""
    urn = F.concat(F.lit(f"<{_ID}"), F.coalesce(F.col("key").cast("string"), F.lit("null")), F.lit(">"))
    refers = F.concat(F.lit(f"\r\nWARC-Refers-To: <{_ID}"), F.col("refers_to").cast("string"), F.lit(">\r\nWARC-Profile: " + REVISIT_PROFILE))
    target = F.concat(F.lit("\r\nWARC-Target-URI: "), F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("html").cast("string"),
        F.lit(END),
    )
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "),
        urn,
        F.lit(f"\r\nWARC-Date: {date}"),
        F.coalesce(target, F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha256:"),
        F.col("digest"),
        F.coalesce(refers, F.lit("")),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END),
        block,
    )


def write_warc(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    revisit_from: int = REVISIT_FROM,
    file_records: int = FILE_RECORDS,
) -> None:
    """Write a record per row into gzip files under ``folder``.

    A null text is an empty payload, a null url gives a record without target address, line breaks in
    a url are percent-encoded, and a null key is written as ``null``. An empty table writes no
    record. Further columns are not looked at.
    """
    records = plan_records(pages, key, url, html, revisit_from).select(record_text(date).alias("value"))
    # the writer closes each row with this separator: the end of a record
    writer = records.write.option("lineSep", END).option("maxRecordsPerFile", file_records)
    writer.option("compression", "gzip").text(folder)


def _headers(text: str) -> dict[str, str]:
    lines = (line.partition(":") for line in text.split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in lines}


def _parse(batches):
    end = END.encode()
    for batch in batches:
        for content in batch.column("content"):
            data, at = content.as_buffer().to_pybytes(), 0
            if data[:2] == GZIP:
                data = gzip.decompress(data)
            rows: dict[str, list] = {n: [] for n in ("record_id", "record_type", "refers_to", "digest", "header", "payload")}
            while at < len(data):
                stop = data.index(end, at) + len(end)
                header = data[at:stop]
                fields = _headers(header[: -len(end)].decode())
                size = int(fields["content-length"])
                block = data[stop : stop + size]
                if len(block) < size or data[stop + size : stop + size + len(end)] != end:
                    raise ValueError("a record does not end where its length says")
                http = block.index(end) + len(end)
                response = fields["warc-type"] == "response"
                rows["record_id"].append(fields["warc-record-id"][1:-1])
                rows["record_type"].append(fields["warc-type"])
                rows["refers_to"].append(fields["warc-refers-to"][1:-1] if "warc-refers-to" in fields else None)
                rows["digest"].append(fields["warc-payload-digest"].partition(":")[2])
                rows["header"].append(header + block[:http])
                rows["payload"].append(block[http:] if response else None)
                at = stop + size + len(end)
            binary = ("header", "payload")
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.binary() if n in binary else pa.string()) for n, v in rows.items()], names=list(rows)
            )


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The records under ``folder``: record_id, record_type, refers_to, digest, header, payload.

    ``header`` has the exact bytes of the WARC and HTTP headers; ``payload`` is null on revisits.
    Plain and gzip files are read alike. A record cut short or with a wrong length is an error.
    """
    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(
        _parse, "record_id string, record_type string, refers_to string, digest string, header binary, payload binary"
    )


@dataclass(frozen=True)
class Store:
    """Exact headers of all records, and each payload once under its SHA-256."""

    headers: DataFrame
    payloads: DataFrame

    def records(self) -> DataFrame:
        """The records as they were: record_id and the bytes, closing bytes included."""
        joined = self.headers.join(self.payloads, "digest", "left")
        kept = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
        return joined.select("record_id", F.concat("header", kept, F.lit(END.encode())).alias("record"))


def store_records(records: DataFrame) -> Store:
    """Write what ``read_warc`` gives into a store in the shared folder.

    A payload is kept under the SHA-256 of its bytes. One that does not have the digest its record declares, and two
    that share a digest but not a SHA-1, stop the job.
    """
    headers = materialize(records.select("record_id", "record_type", "refers_to", "digest", "header"), "warc-headers")
    found = records.where("record_type = 'response'").select("digest", "payload")
    wrong = F.sha2("payload", 256) != F.col("digest")
    checked = found.withColumn("payload", F.when(wrong, F.raise_error(F.lit("payload and digest differ"))).otherwise(F.col("payload")))
    other = F.sha1("payload")
    once = checked.groupBy("digest").agg(F.first("payload").alias("payload"), F.min(other).alias("low"), F.max(other).alias("high"))
    clash = F.col("low") != F.col("high")
    payload = F.when(clash, F.raise_error(F.lit("two payloads share a digest"))).otherwise(F.col("payload"))
    return Store(headers, materialize(once.select("digest", payload.alias("payload")), "warc-payloads"))


def archive_folder(spark: SparkSession) -> str:
    """A new folder for an archive, reachable by all executors."""
    return f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"


def key_of(record_id: Column, kind: str = "bigint") -> Column:
    """The key written into a record address; null for ``null``."""
    return F.nullif(F.substring(record_id, len(_ID) + 1, F.length(record_id)), F.lit("null")).cast(kind)
