"""A content-addressed web archive: payload bytes once per digest, exact record headers apart, records by joins.

``stored`` writes two tables. ``payloads`` has the bytes of each distinct payload once, under their SHA-256; ``headers``
has the exact header block of each record and the digest of its payload. ``records`` joins them back to the records as
they stand in a WARC file: of records with equal payloads the one with the largest page id is the response and the
others revisit it. ``exported`` writes them as gzip-compressed WARC files and ``imported`` reads such files back.
"""

from __future__ import annotations

import base64
import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.shared import mapped, new_folder

_END = "\r\n"
_HTTP = f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}{_END}"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records of one WARC file.
FILE_RECORDS = 2_000


def base32(digest: Column) -> Column:
    """Upper-case base32 of the hex digits of a SHA-1: five hex digits are four base-32 digits."""
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(_END))


def stored(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", least: int = 0) -> None:
    """Archive ``pages`` (page_id, url, html) below ``folder``.

    A null html is an empty payload. A null url has no header line and one with blanks or control characters is
    percent-encoded, which its header says. Payloads of fewer than ``least`` bytes are never revisited. Of repeated
    rows with the largest page_id of a payload any one is the response: they are equal. A null page_id comes first.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("payload", 256))).withColumn("n_bytes", F.octet_length("payload").cast("long"))
    slim = rows.select("page_id", "url", "row", "digest", "n_bytes", F.sha1("payload").alias("sha1"))
    slim.write.parquet(f"{folder}/rows")
    spark = pages.sparkSession
    slim = spark.read.parquet(f"{folder}/rows")
    best = F.max(F.struct("page_id", "row")).alias("best")
    heads = slim.groupBy("digest").agg(best, F.min("n_bytes").alias("low"), F.max("n_bytes").alias("high"), F.min("sha1").alias("one"), F.max("sha1").alias("other"))
    same = F.assert_true((F.col("low") == F.col("high")) & (F.col("one") == F.col("other")), F.lit("payloads differ under one digest"))
    # The assertion is null where it holds: payloads under one digest have one length and one SHA-1.
    heads = heads.select("digest", "best", F.coalesce(same.cast("string"), F.lit("")).alias("checked"))
    heads.write.parquet(f"{folder}/heads")
    heads = spark.read.parquet(f"{folder}/heads").select("digest", "best")
    joined = slim.join(heads, "digest")
    first = (F.col("row") == F.col("best.row")) | (F.col("n_bytes") < least)
    kind = F.when(first, F.lit("response")).otherwise(F.lit("revisit"))
    id_ = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    of = F.coalesce(F.col("best.page_id").cast("string"), F.lit(""))
    dirty = F.col("url").rlike(r"[\x00-\x20\x7F]")
    url = F.when(F.col("url").isNull(), F.lit("")).otherwise(
        F.concat(
            _line("WARC-Target-URI", F.when(dirty, F.url_encode("url")).otherwise(F.col("url"))),
            F.when(dirty, _line("X-Target-URI-Encoded", F.lit("percent"))).otherwise(F.lit("")),
        )
    )
    refers = F.when(first, F.lit("")).otherwise(
        F.concat(_line("WARC-Refers-To", F.concat(F.lit("<urn:x-page:"), of, F.lit(">"))), _line("WARC-Profile", F.lit(_PROFILE)))
    )
    length = F.lit(len(_HTTP)) + F.when(first, F.col("n_bytes")).otherwise(0)
    header = F.concat(
        F.lit(f"WARC/1.1{_END}"), _line("WARC-Type", kind), _line("WARC-Record-ID", F.concat(F.lit("<urn:x-page:"), id_, F.lit(">"))),
        _line("WARC-Date", F.lit(date)), url, _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))), refers,
        _line("Content-Type", F.lit("application/http; msgtype=response")), _line("Content-Length", length.cast("string")), F.lit(_END + _HTTP),
    )
    joined.select("page_id", kind.alias("record_type"), header.alias("header"), "digest").write.parquet(f"{folder}/headers")
    # The bytes themselves: one of each digest leaves a map task, and one is kept.
    keep = rows.groupBy("digest").agg(F.any_value("payload").alias("payload"))
    keep.write.option("compression", "zstd").parquet(f"{folder}/payloads")


def records(spark: SparkSession, folder: str) -> DataFrame:
    """The records of an archive: page_id, record_type, header (exact) and payload (binary, null for revisits).

    Every payload is checked against the digest that it is stored under.
    """
    payloads = spark.read.parquet(f"{folder}/payloads")
    sound = F.assert_true(F.unhex(F.sha2("payload", 256)) == F.col("digest"), F.lit("a stored payload does not match its digest"))
    payloads = payloads.select("digest", F.when(sound.isNull(), F.col("payload")).alias("payload"))
    headers = spark.read.parquet(f"{folder}/headers")
    full = headers.where("record_type = 'response'").join(payloads, "digest", "left")
    return full.select("page_id", "record_type", "header", "payload").unionByName(
        headers.where("record_type = 'revisit'").select("page_id", "record_type", "header", F.lit(None).cast("binary").alias("payload"))
    )


def exported(found: DataFrame, folder: str) -> None:
    """Write records as WARC files of ``FILE_RECORDS`` records: the line end of Spark's text files ends each record."""
    line = F.concat(F.encode("header", "UTF-8"), F.coalesce("payload", F.lit(b"")))
    text = found.select(line.cast("string").alias("value"))
    writer = text.write.option("lineSep", _END * 2).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS)
    writer.text(folder)


def parsed(data: bytes):
    """(fields, payload) of each record of a WARC file's bytes, cut by Content-Length alone."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode().split(_END)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        begin = stop + 4
        at = begin + int(fields["Content-Length"])
        block = data[begin:at]
        yield fields, block[block.index(b"\r\n\r\n") + 4 :]
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"a record does not end at byte {at}")
        at += 4


def _page(name: str) -> int | None:
    text = name.removeprefix("<urn:x-page:").removesuffix(">")
    return int(text) if text else None


def _read(batch: pa.RecordBatch):
    for content in batch["content"]:
        rows = []
        for fields, payload in parsed(gzip.decompress(content.as_buffer())):
            digest = base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()
            said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
            if fields["WARC-Type"] == "response" and digest != said:
                raise ValueError(f"the payload of {fields['WARC-Record-ID']} does not match its digest")
            refers = fields.get("WARC-Refers-To")
            rows.append(
                {
                    "page_id": _page(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"], "payload_digest": said,
                    "payload_bytes": len(payload), "refers_to": _page(refers) if refers else None, "url": fields.get("WARC-Target-URI"),
                    "encoded": "X-Target-URI-Encoded" in fields, "payload": payload if fields["WARC-Type"] == "response" else None,
                }
            )
        for first in range(0, len(rows), 500):
            yield pa.RecordBatch.from_pylist(rows[first : first + 500], _RECORD)


_RECORD = pa.schema(
    [
        ("page_id", pa.int64()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
        ("refers_to", pa.int64()), ("url", pa.string()), ("encoded", pa.bool_()), ("payload", pa.binary()),
    ]
)


def imported(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Records of the WARC files below ``folder``, each checked against its digest.

    page_id, record_type, payload_digest, payload_bytes (of what stands in the record), refers_to, url and, if asked
    for, payload.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(folder).select("content")
    kind = "page_id long, record_type string, payload_digest string, payload_bytes long, refers_to long, url string, encoded boolean, payload binary"
    found = mapped(files, _read, kind).withColumn("url", F.when(F.col("encoded"), F.url_decode("url")).otherwise(F.col("url"))).drop("encoded")
    return found if payloads else found.drop("payload")


def resolved(found: DataFrame) -> DataFrame:
    """``imported`` records in which a revisit has the payload_bytes of the response that it refers to."""
    responses = found.where("record_type = 'response'")
    whole = responses.groupBy("payload_digest").agg(F.max("payload_bytes").alias("bytes"))
    revisits = found.where("record_type = 'revisit'").drop("payload_bytes").join(whole, "payload_digest")
    return responses.unionByName(revisits.withColumnRenamed("bytes", "payload_bytes"))


def archived(pages: DataFrame) -> str:
    """Archive ``pages`` in a folder of its own in the shared one and export it; the folder.

    An empty table makes an empty archive. A payload is held whole where its record is written or read, and so is the
    file it is read from.
    """
    folder = new_folder(pages.sparkSession)
    stored(pages, folder)
    exported(records(pages.sparkSession, folder), f"{folder}/warc")
    return folder
