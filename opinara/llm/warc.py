"""A content-addressed web archive: payload bytes once, record headers apart, WARC files from both.

`store` reads pages twice. The first pass keeps a small row per page: digest, length and a second digest of the payload.
The second groups payloads by SHA-256, reduced per task before anything is shuffled, so a payload with very many copies is
no burden for one task. A digest is trusted only if the second digest (SHA-512) of all its payloads is the same.

An archive folder holds
  payloads  a row per distinct payload: its address (SHA-256), its bytes and the record that is the response
  headers   a row per record: the exact WARC and HTTP headers and the address of the payload
  warc      standard WARC files: responses with payload, revisits of equal payloads without
  boundary  the line that opens every record of these files

Every record names the same random WARC-Warcinfo-ID in its first field. No older payload can hold that line, so Spark's own
line reader cuts the files into records at any split, and Content-Length proves each cut. All of it runs on columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm.common import stored
from opinara.session import shared_dir

#: Payloads below this are stored in every record: a revisit would not be shorter.
LEAST_REVISIT = 100
CRLF = "\r\n"
END = CRLF + CRLF
#: Fixed values of the WARC 1.1 standard.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_RECORD = "application/http; msgtype=response"
#: Pages come without a time of capture.
CAPTURED = "2000-01-01T00:00:00Z"


def opening(archive: str) -> str:
    """The first two lines of every record of an archive."""
    return f"{VERSION}{CRLF}WARC-Warcinfo-ID: <urn:uuid:{archive}>{CRLF}"


def record_id(archive: str, number: Column) -> Column:
    digest = F.sha2(F.concat_ws("/", F.lit(archive), number.cast("string")).cast("binary"), 256)
    parts = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts))


def payload_of(html: Column) -> Column:
    return F.coalesce(html.cast("string"), F.lit("")).cast("binary")


def one_line(url: Column) -> Column:
    """White space and control bytes of ASCII are escaped, so an address cannot break a header; null stays null."""
    odd = [chr(c) for c in (*range(33), 127)]
    text = url.cast("string")
    escaped = F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")
    for c in odd:
        escaped = F.replace(escaped, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return F.when(text.rlike("[\\x00-\\x20\\x7F]"), escaped).otherwise(text)


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def http_header(length: Column) -> Column:
    """The HTTP header of a page, without the empty line that ends it."""
    return F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    length.cast("string"))


def with_headers(records: DataFrame, archive: str, date: str) -> DataFrame:
    """Adds record_id, http and header (exact texts). records: number, page_id, url, digest, bytes, first (null or its number)."""
    revisit = F.col("first").isNotNull()
    http = http_header(F.col("bytes"))
    block = F.octet_length(http) + len(END) + F.when(revisit, 0).otherwise(F.col("bytes"))
    header = F.concat(
        F.lit(opening(archive)),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.concat(F.lit("<"), record_id(archive, F.col("number")), F.lit(">"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.when(revisit, F.concat(_line("WARC-Refers-To", F.concat(F.lit("<"), record_id(archive, F.col("first")), F.lit(">"))),
                                 _line("WARC-Profile", F.lit(SAME_PAYLOAD)))).otherwise(""),
        _line("Page-ID", F.col("page_id").cast("string")),
        _line("Content-Type", F.lit(HTTP_RECORD)),
        F.lit("Content-Length: "), block.cast("string"))
    return (records.withColumn("record_id", record_id(archive, F.col("number")))
            .withColumn("http", http).withColumn("header", header))


def store(pages: DataFrame, root: str, least: int = LEAST_REVISIT, date: str = CAPTURED) -> str:
    """Write `payloads` and `headers` of an archive; returns its identifier.

    pages: page_id, url, html; other columns are left behind. Of records with the same payload of at least `least` bytes, the
    one with the smallest page_id (of repeated ones, one of them) is the response; the others revisit it. A null page_id
    comes last, a null html is empty, a null url leaves its header line out. An empty table gives an empty archive.
    """
    spark, archive = pages.sparkSession, str(uuid.uuid4())
    payload = payload_of(F.col("html"))
    digest, second = F.sha2(payload, 256), F.sha2(payload, 512)
    entries = stored(pages.select(F.col("page_id").cast("long").alias("page_id"), one_line(F.col("url")).alias("url"),
                                  digest.alias("digest"), second.alias("second"),
                                  F.octet_length(payload).cast("long").alias("bytes"),
                                  F.monotonically_increasing_id().alias("number")))
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "number", "url")
    groups = (entries.groupBy("digest")
              .agg(F.min(order).alias("keeper"), F.count("*").alias("records"), F.max("bytes").alias("bytes"),
                   (F.min(F.struct("second", "bytes")) == F.max(F.struct("second", "bytes"))).alias("same")))
    bodies = pages.select(digest.alias("digest"), payload.alias("payload")).groupBy("digest").agg(F.any_value("payload").alias("payload"))
    proven = F.when(F.col("same"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("different payloads share the digest "), "digest")))
    (bodies.join(groups, "digest")
     .select("digest", "bytes", "records", proven.alias("payload"), F.col("keeper.page_id").alias("page_id"),
             F.col("keeper.number").alias("number"), F.col("keeper.url").alias("url"))
     .write.option("compression", "zstd").parquet(f"{root}/payloads"))

    copied = (spark.read.parquet(f"{root}/payloads").where((F.col("records") > 1) & (F.col("bytes") >= least))
              .select("digest", F.col("number").alias("first")))
    linked = (entries.join(copied, "digest", "left")
              .withColumn("first", F.when(F.col("first") != F.col("number"), F.col("first"))))
    (with_headers(linked, archive, date)
     .select("number", "record_id", "page_id", "digest", "bytes", F.col("first").isNotNull().alias("revisit"), "header", "http")
     .write.option("compression", "zstd").parquet(f"{root}/headers"))
    return archive


def originals(spark: SparkSession, root: str) -> DataFrame:
    """Every record as it was captured: number, record_id, page_id, header, http, payload, revisits with their payload too."""
    payloads = spark.read.parquet(f"{root}/payloads").select("digest", "payload")
    return (spark.read.parquet(f"{root}/headers").join(payloads, "digest")
            .select("number", "record_id", "page_id", "header", "http", "payload"))


def _record(header: Column, http: Column, payload: Column) -> Column:
    """The bytes of a record up to the two line ends that close it, as a string that Spark never decodes."""
    end = F.lit(END.encode())
    return F.concat(header.cast("binary"), end, http.cast("binary"), end, payload).cast("string").alias("value")


def write_warc(spark: SparkSession, root: str, archive: str, least: int = LEAST_REVISIT, date: str = CAPTURED,
               compression: str = "gzip") -> None:
    """The archive as WARC files under `root`/warc.

    Payloads are not shuffled: the store's row of a payload of `least` bytes or more knows its response. Smaller ones go to
    each of their records; they are joined, and are below `least` bytes each.
    """
    payloads = spark.read.parquet(f"{root}/payloads")
    headers = spark.read.parquet(f"{root}/headers")
    info = f"{opening(archive)}WARC-Type: warcinfo{CRLF}WARC-Record-ID: <urn:uuid:{archive}>{CRLF}WARC-Date: {date}{CRLF}" \
           f"Content-Type: application/warc-fields{CRLF}Content-Length: 0{END}"
    large = (with_headers(payloads.where(F.col("bytes") >= least).withColumn("first", F.lit(None).cast("long")), archive, date)
             .select(_record(F.col("header"), F.col("http"), F.col("payload"))))
    small = (headers.where((F.col("bytes") < least) & ~F.col("revisit"))
             .join(payloads.where(F.col("bytes") < least).select("digest", "payload"), "digest")
             .select(_record(F.col("header"), F.col("http"), F.col("payload"))))
    revisits = headers.where("revisit").select(_record(F.col("header"), F.col("http"), F.lit(b"")))
    parts = spark.createDataFrame([(info,)], "value string"), large, small, revisits
    for part in parts:
        (part.write.mode("append").option("lineSep", END).option("compression", compression).text(f"{root}/warc"))
    spark.createDataFrame([(opening(archive),)], "value string").coalesce(1).write.parquet(f"{root}/boundary")


def field(name: str) -> Column:
    """A header field of a record, null if absent."""
    found = F.regexp_extract("header", f"(?mi)^{name}: *([^\\r\\n]*)", 1)
    return F.when(found != "", found)


def read_warc(spark: SparkSession, path: str, boundary: str) -> DataFrame:
    """Records of WARC files: header, type, record_id, refers_to, page_id, stated digest, http, payload, intact.

    boundary: the text that opens every record, `VERSION` and a line end for files of other tools. A record is intact if its
    block has the stated length and two line ends follow; a boundary inside a payload would cut it, and shows here.
    Records of other types than response and revisit have their whole block as payload.
    """
    lines = spark.read.option("lineSep", boundary).text(path).where(F.octet_length("value") > 0)
    raw = lines.select(F.col("value").cast("binary").alias("raw"), F.substring_index("value", END, 1).alias("header"))
    length, at = field("Content-Length").cast("long"), F.octet_length("header") + len(END)
    rest = F.octet_length("raw") - at
    cut = raw.select("header", "raw", field("WARC-Type").alias("type"), F.substring("raw", at + 1, length.cast("int")).alias("block"),
                     ((rest == length + len(END)) & (F.substring("raw", at + length.cast("int") + 1, F.lit(len(END))) == F.lit(END.encode())))
                     .alias("intact"))
    http = F.when(F.col("type").isin("response", "revisit"), F.substring_index(F.col("block").cast("string"), END, 1))
    skip = F.coalesce(F.octet_length("http") + len(END), F.lit(0))
    address = lambda name: F.regexp_extract(field(name), "^<(.*)>$", 1)
    return (cut.withColumn("http", http)
            .select("header", "type", address("WARC-Record-ID").alias("record_id"), address("WARC-Refers-To").alias("refers_to"),
                    field("Page-ID").cast("long").alias("page_id"),
                    F.regexp_extract(field("WARC-Payload-Digest"), "^sha256:(.*)$", 1).alias("stated"), "http",
                    F.substring("block", skip + 1, F.octet_length("block")).alias("payload"),
                    F.coalesce("intact", F.lit(False)).alias("intact")))


def read_back(spark: SparkSession, root: str) -> DataFrame:
    """Every page of an archive's WARC files, its payload's length and digest taken from the bytes that were read.

    page_id, payload_bytes, payload_digest, record_type, refers_to (page_id of the response for revisits). A revisit gets
    both of the response it refers to. A record that is cut, a payload that has not the stated digest, or a
    revisit without its response ends the job with an error.
    """
    boundary = spark.read.parquet(f"{root}/boundary").first()[0]
    records = read_warc(spark, f"{root}/warc", boundary).where(F.col("type").isin("response", "revisit"))
    found = F.sha2("payload", 256)
    sound = F.col("intact") & ((F.col("type") == "revisit") | (found == F.col("stated")))
    seen = stored(records.select(
        "page_id", "type", "record_id", "refers_to", "stated", F.octet_length("payload").cast("long").alias("bytes"),
        F.when(sound, found).otherwise(F.raise_error(F.concat(F.lit("damaged record "), "record_id"))).alias("digest")))
    heads = seen.where("type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("head"),
                                                   F.col("bytes").alias("head_bytes"), F.col("digest").alias("head_digest"))
    own = seen.where("type = 'response'").select("page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                                                 F.col("type").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    same = F.when(F.col("head_digest") == F.col("stated"), F.col("head_digest")).otherwise(
        F.raise_error(F.concat(F.lit("no response for "), "record_id")))
    again = (seen.where("type = 'revisit'").join(heads, "refers_to", "left")
             .select("page_id", F.col("head_bytes").alias("payload_bytes"), same.alias("payload_digest"),
                     F.col("type").alias("record_type"), F.col("head").alias("refers_to")))
    return own.unionByName(again)


def archived(pages: DataFrame, root: str | None = None) -> DataFrame:
    """Store pages as an archive, write its WARC files and read them back; see `store` and `read_back`."""
    spark = pages.sparkSession
    root = root or f"{shared_dir(spark)}/archive-{uuid.uuid4().hex}"
    write_warc(spark, root, store(pages, root))
    return read_back(spark, root)
