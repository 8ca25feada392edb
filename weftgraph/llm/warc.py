"""WARC archives: a request, a response or revisit, and a metadata record per capture, and the assembly of
captures from records through their concurrent-to identifiers.

Archives are written by Spark's text writer: the bytes after every record are its line separator, so a file
is a sequence of plain WARC records. Of captures with equal payloads of at least ``LEAST_BYTES`` bytes, the
one with the smallest key (then address) is stored as a response, the others are revisits that refer to it.

A null payload is empty; a null key comes after all others; rows with equal key, address and payload are
captures of their own with equal records, but if they are the first of their payload, one of them is the response
and the others refer to it; an empty table leaves archives without records, which read as no
captures. The key and the address are kept exactly in the metadata record, so any value survives; the
headers hold the address with white space and control characters encoded. Other columns are not archived.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.plans import skew
from weftgraph.session import stage_table

LEAST_BYTES = 100
#: Bytes of records in one archive file, about.
ARCHIVE_BYTES = 32 << 20
#: So many equal captures are dealt out together.
STRETCH = 10_000
DATE = "1970-01-01T00:00:00Z"
RECORD = (
    "record_id string, type string, concurrent_to string, refers_to string, target string, "
    "payload_digest string, block binary"
)
END = "\r\n\r\n"
HEAD_END = "X'0D0A0D0A'"


def _uuid(*parts: Column) -> Column:
    named = F.to_json(F.array(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    d = F.md5(named.cast("binary"))
    cut = [F.substring(d, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _header(value: Column) -> Column:
    """A value on one line: blanks, controls and angle brackets become percent codes of what they are."""
    out = value
    for c in [*range(33), 60, 62, 127]:
        out = F.replace(out, F.lit(chr(c)), F.lit(f"%{c:02X}"))
    return out


def _record(kind: str, headers: dict[str, Column], block: Column) -> Column:
    lines = [F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\n")]
    for name, value in {**headers, "Content-Length": F.octet_length(block).cast("string")}.items():
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")))
    return F.concat(*lines, F.lit("\r\n"), block)


def write_archives(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", date: str = DATE
) -> None:
    """Write the records of every capture to ``path``.

    Digests alone are grouped, with partial sums, to find the response of every payload; the join that
    brings it back spreads payloads with very many captures.
    """
    captures = pages.select(
        pages[f"`{key}`"].alias("key"),
        pages[f"`{url}`"].cast("string").alias("url"),
        F.coalesce(pages[f"`{payload}`"], F.lit("")).alias("payload"),
    )
    captures = captures.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256)).withColumn(
        "size", F.octet_length("payload")
    )
    rank = F.struct(F.col("key").isNull().alias("no_key"), "key", F.col("url").isNull().alias("no_url"), "url")
    firsts = stage_table(
        captures.where(F.col("size") >= LEAST_BYTES)
        .groupBy(F.col("digest").alias("of"), "key", "url")
        .agg(F.count("*").alias("n"))
        .groupBy("of")
        .agg(F.min(rank).alias("first"), F.min_by("n", rank).alias("equal_firsts"), F.sum("n").alias("captures"))
        .where("captures > 1"),
        "first-captures",
    )
    # Small payloads meet nothing, so they stay together by the partition they are read in.
    alone = F.concat(F.lit("small "), F.spark_partition_id())
    captures = captures.withColumn("part", F.spark_partition_id()).withColumn(
        "of", F.when(F.col("size") >= LEAST_BYTES, F.col("digest")).otherwise(alone)
    )
    hot = skew.hot_of(firsts, ("of",), n="captures")
    captures = skew.salted_join(captures, firsts, ("of",), "left", hot, ["key", "url", "part"])
    first = F.col("first")
    is_first = F.col("key").eqNullSafe(first.key) & F.col("url").eqNullSafe(first.url)
    of_many = F.col("captures").isNotNull()
    columns = ["key", "url", "payload", "digest", "size", "first"]
    if firsts.where("equal_firsts > 1").first() is None:
        captures = captures.select(*columns, (of_many & ~is_first).alias("revisit"), F.lit("capture").alias("kind"))
    else:
        several = of_many & is_first & (F.col("equal_firsts") > 1)
        kind = F.when(F.col("nr") > 0, F.lit("again")).otherwise(F.lit("capture")).alias("kind")
        captures = (
            captures.where(~several)
            .select(*columns, (of_many & ~is_first).alias("revisit"), F.lit("capture").alias("kind"))
            .unionByName(_numbered(captures.where(several)).select(*columns, (F.col("nr") > 0).alias("revisit"), kind))
        )
    size, revisit, own = F.col("size"), F.col("revisit"), F.col("record_id")
    captures = captures.withColumn("record_id", _uuid(F.col("key"), F.col("url"), F.col("digest"), F.col("kind")))
    target = _header(F.col("url"))
    common = {"WARC-Date": F.lit(date), "WARC-Target-URI": target}
    digest = {"WARC-Payload-Digest": F.concat(F.lit("sha256:"), F.col("digest"))}
    http = {"Content-Type": F.lit("application/http; msgtype=response")}
    status = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        size.cast("string"),
        F.lit(END),
    )
    response = _record(
        "response", {"WARC-Record-ID": own, **common, **digest, **http}, F.concat(status, F.col("payload"))
    )
    repeat = {
        "WARC-Record-ID": own,
        **common,
        **digest,
        "WARC-Profile": F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        "WARC-Refers-To": _uuid(first.key, first.url, F.col("digest"), F.lit("capture")),
        "WARC-Refers-To-Target-URI": _header(first.url),
        **http,
    }
    request = _record(
        "request",
        {
            "WARC-Record-ID": _uuid(own, F.lit("request")),
            **common,
            "WARC-Concurrent-To": own,
            "Content-Type": F.lit("application/http; msgtype=request"),
        },
        F.concat(F.lit("GET "), F.coalesce(target, F.lit("/")), F.lit(" HTTP/1.1" + END)),
    )
    metadata = _record(
        "metadata",
        {
            "WARC-Record-ID": _uuid(own, F.lit("metadata")),
            **common,
            "WARC-Concurrent-To": own,
            "Content-Type": F.lit("application/json"),
        },
        F.to_json(F.struct("key", "url")),
    )
    records = captures.select(
        F.explode(F.array(request, F.when(revisit, _record("revisit", repeat, status)).otherwise(response), metadata))
    )
    bytes_each = pages.select(F.avg(F.coalesce(F.octet_length(payload), F.lit(0))).alias("n")).first().n or 0
    in_file = max(3, int(ARCHIVE_BYTES // (bytes_each / 3 + 500)))
    (
        records.write.option("lineSep", END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", in_file)
        .text(path)
    )


def _numbered(equal: DataFrame) -> DataFrame:
    """Captures that are equal to the response of their payload, numbered from 0. They meet as one row with their
    count, which partial sums make small, and are dealt out again in stretches; the payload goes with number 0 alone."""
    last = F.col("equal_firsts") - 1
    stretches = (
        equal.groupBy("of", "key", "url")
        .agg(*[F.first(c).alias(c) for c in ("payload", "digest", "size", "first", "equal_firsts")])
        .withColumn("start", F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(STRETCH).cast("bigint"))))
        .withColumn("payload", F.when(F.col("start") == 0, F.col("payload")).otherwise(""))
    )
    end = F.least(F.col("start") + (STRETCH - 1), last)
    dealt = stretches.repartition("of", "start").withColumn("nr", F.explode(F.sequence("start", end)))
    return dealt.withColumn("payload", F.when(F.col("nr") == 0, F.col("payload")).otherwise(""))


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record of a file; broken files are an error."""
    file = gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    while True:
        version = file.readline()
        if not version:
            return
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no record where one should begin: {version[:60]!r}")
        headers = {}
        while (line := file.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            headers[name.decode().strip().lower()] = value.decode().strip()
        length = int(headers["content-length"])
        block = file.read(length)
        if len(block) != length or file.read(len(END)) != END.encode():
            raise ValueError("a record is cut short")
        yield headers, block


def read_records(spark: SparkSession, path: str, kinds: tuple[str, ...]) -> DataFrame:
    """Records of some kinds, one row each; a task holds one archive file at a time."""
    names = ("warc-record-id", "warc-type", "warc-concurrent-to", "warc-refers-to", "warc-target-uri",
             "warc-payload-digest")
    kept = frozenset(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows):
            columns = [pa.array(c, pa.string()) for c in zip(*[r[:-1] for r in rows])]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array([r[-1] for r in rows], pa.binary())], names=fields
            )

        for files in batches:
            for file in files.column("content"):
                rows, held = [], 0
                for headers, block in parse_archive(file.as_py()):
                    if headers["warc-type"] in kept:
                        rows.append((*[headers.get(n) for n in names], block))
                        held += len(block)
                    if held > 4 << 20 or len(rows) >= 5000:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    fields = [f.split()[0] for f in RECORD.split(", ")]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def assemble(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One nested row per capture: its main record, its request and its metadata.

    ``payload_bytes`` and ``payload_sha256`` are measured on the stored payload (null for a revisit, which has
    none) before anything is joined; without ``payload`` only they go on. Requests and metadata are first
    reduced to one row per transaction, so equal records don't multiply; transactions of very many equal records
    are spread.
    """
    stored = F.when(F.col("type") == "response", F.substring("block", F.expr(f"position({HEAD_END} in block) + 4"), F.length("block")))
    response = {
        "type": F.col("type"),
        "refers_to": F.col("refers_to"),
        "payload_digest": F.regexp_replace("payload_digest", "^sha256:", ""),
        "http_headers": F.expr(f"cast(substring(block, 1, position({HEAD_END} in block) - 1) as string)"),
        "payload_bytes": F.length("payload").cast("long"),
        "payload_sha256": F.sha2("payload", 256),
    } | ({"payload": F.col("payload")} if payload else {})
    main = (
        read_records(spark, path, ("response", "revisit"))
        .withColumn("payload", stored)
        .select("record_id", "target", F.struct(*[v.alias(k) for k, v in response.items()]).alias("response"))
    )

    def beside(kind: str) -> DataFrame:
        found = F.min(F.struct("record_id", F.col("block").cast("string").alias("block"))).alias(kind)
        rows = read_records(spark, path, (kind,)).groupBy("concurrent_to").agg(found, F.count("*").alias("n"))
        return stage_table(rows.withColumnRenamed("concurrent_to", "record_id"), f"warc-{kind}")

    requests, about = beside("request"), beside("metadata")
    hot, whole = skew.hot_of(requests, ("record_id",)), main.withColumn("part", F.spark_partition_id())
    whole = skew.salted_join(whole, requests.drop("n"), ("record_id",), "left", hot, ["part"])
    whole = skew.salted_join(whole, about.drop("n"), ("record_id",), "left", hot, ["part"])
    return whole.select("record_id", "target", "request", "response", "metadata")


def resolve(captures: DataFrame, key_type: str = "bigint") -> DataFrame:
    """(key, url, record_type, payload_bytes, payload_digest, refers_to) per assembled capture: a revisit has
    the size of the response it refers to, the digest of its own header, and that response's key."""
    rows = stage_table(
        captures.select(
            "record_id",
            F.from_json("metadata.block", f"key {key_type}, url string").alias("of"),
            F.col("response.type").alias("record_type"),
            # A response stands for itself, so that responses are spread as well.
            F.coalesce("response.refers_to", "record_id").alias("to"),
            F.col("response.payload_digest").alias("said"),
            F.col("response.payload_bytes").alias("bytes"),
            F.col("response.payload_sha256").alias("digest"),
        ),
        "captures",
    )
    stored = stage_table(
        rows.where("record_type = 'response'")
        .groupBy(F.col("record_id").alias("to"))
        .agg(F.min(F.struct("of.key", "bytes", "digest")).alias("at")),
        "warc-stored",
    )
    rows = rows.withColumn("part", F.spark_partition_id())
    hot = skew.find_hot(rows, ("to",))
    return skew.salted_join(rows, stored, ("to",), "left", hot, ["record_id", "part"]).select(
        F.col("of.key").alias("key"),
        F.col("of.url").alias("url"),
        "record_type",
        F.coalesce("bytes", F.col("at.bytes")).alias("payload_bytes"),
        F.coalesce("digest", "said").alias("payload_digest"),
        F.when(F.col("record_type") == "revisit", F.col("at.key")).alias("refers_to"),
    )
