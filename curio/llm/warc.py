"""Content-addressed WARC archive.

Payload bytes are stored once per SHA-256 (with SHA-1 for the WARC-Payload-Digest field), compressed, in a payload table; the
exact header block of every record goes to a header table. Original records are rebuilt by joining the two on the digest.
On reading, digests are computed anew from the stored bytes, so a damaged or mismatched payload fails the read.

Record types: of the records with equal payloads of at least `least` bytes, that with the smallest page_id is `response`, the
others are `revisit` records (identical-payload-digest) without a body that refer to it; smaller payloads are all `response`, and so
are payloads that only rows without page_id hold, as nothing could refer to them.

Decisions are made on (digest, page_id) pairs alone: one partial aggregation per digest, then joins that adaptive execution
may split where a digest is hot. Payload bytes move once to the store, one body per digest from each task, and once to be read back.

Defined results: null payload is the empty one. Null url gives no WARC-Target-URI field. Repeated and null page_ids: the
store is keyed by the digest alone, so every row keeps its own payload; rows keep their number. Of several rows of the smallest
page_id with equal payloads one, whichever, is the response, the others revisit it; every record has an id of its own. Extra columns are ignored. An empty table gives empty archives.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curio.llm.common import map_arrow, materialise

CRLF = b"\r\n"
STAMP = "1970-01-01T00:00:00Z"  # archives are a function of their input alone
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(binary: Column) -> Column:
    """Bare upper-case base32 SHA-1, within the JVM: five hex digits make four of base 32."""
    h = F.sha1(binary)
    quads = [F.lpad(F.conv(F.substring(h, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.upper(F.concat(*quads)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_id(page_id, digest: str, tag: str = "") -> str:
    h = hashlib.md5(f"page:{page_id}:{digest}{tag}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def header_block(page_id, url, kind: str, digest: str, size: int, refers_to, row: int | None = None) -> bytes:
    """The exact bytes before a record's body. row tells records apart that page and payload do not."""
    tag = ("" if kind == "response" else ":revisit") + ("" if row is None else f":{row}")
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id, digest, tag)), ("WARC-Date", STAMP)]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page", str(refers_to))]
    fields += [("X-Page-Id", str(page_id)), ("X-Payload-Bytes", str(size)), ("Content-Type", "text/html; charset=utf-8")]
    fields.append(("Content-Length", str(0 if kind == "revisit" else size)))
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + CRLF


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and body of one record, with its framing checked."""
    head, sep, rest = raw.partition(CRLF + CRLF)
    lines = head.split(CRLF)
    if not sep or lines[0] != b"WARC/1.1":
        raise ValueError("not a WARC/1.1 record")
    fields = dict(x.decode().split(": ", 1) for x in lines[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != CRLF + CRLF:
        raise ValueError("record length does not match Content-Length")
    return fields, rest[:n]


def write_archive(pages: DataFrame, key: str = "page_id", payload: str = "html", url: str = "url", least: int = 0) -> tuple[DataFrame, DataFrame]:
    """(payload table, header table), both written to the shared folder.

    Payload table: sha256, digest (base32 SHA-1), size, codec bytes. Header table: page_id, sha256, header.
    """
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    src = pages.select(F.col(key).alias("page_id"), F.col(url).cast("string").alias("url") if url in pages.columns else F.lit(None).cast("string").alias("url"), body.alias("body"))
    names = [F.unhex(F.sha2("body", 256)).alias("sha256"), base32_sha1(F.col("body")).alias("digest"), F.octet_length("body").cast("bigint").alias("size")]
    slim = materialise(src.select("page_id", "url", *names, F.monotonically_increasing_id().alias("row")), "warc-digests")
    least_row = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row"))
    first = slim.groupBy("sha256").agg(least_row.alias("own"), F.count_distinct("digest", "size").alias("kinds"))
    checked = F.when(F.col("kinds") == 1, F.col("own.page_id")).otherwise(F.raise_error(F.lit("payload digests disagree")).cast("bigint"))
    owners = materialise(first.select("sha256", checked.alias("first"), F.col("own.row").alias("first_row")), "warc-owners")  # so that hot payloads can be split in the join
    again = F.col("page_id").eqNullSafe(F.col("first"))  # a further row of the response's page
    typed = slim.join(owners, "sha256").withColumn("kind", F.when((F.col("size") >= least) & F.col("first").isNotNull() & (F.col("row") != F.col("first_row")), "revisit").otherwise("response"))
    typed = typed.withColumn("row", F.when(F.col("page_id").isNull() | again & (F.col("row") != F.col("first_row")), F.col("row")))

    def heads(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = b.to_pydict()
            rows = [header_block(*x) for x in zip(d["page_id"], d["url"], d["kind"], d["digest"], d["size"], d["first"], d["row"], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(1).cast(schema.field(1).type), pa.array(rows, type=schema.field(2).type)], schema=schema)

    headers = materialise(map_arrow(typed.select("page_id", "sha256", "url", "kind", "digest", "size", "first", "row"), heads, "page_id bigint, sha256 binary, header binary"), "warc-headers")

    def squeeze(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        import zstandard

        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            packed = [z.compress(x) for x in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(b.columns[:3], schema)), pa.array(packed, type=schema.field(3).type)], schema=schema)

    small = map_arrow(src.select(*names, "body"), squeeze, "sha256 binary, digest string, size bigint, bytes binary")
    payloads = materialise(small.dropDuplicates(["sha256"]), "warc-payloads", codec="uncompressed")
    return payloads, headers


def _digests(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """SHA-256, SHA-1 in base32 and size of each stored payload, from its bytes; a damaged one fails the read."""
    import zstandard

    z = zstandard.ZstdDecompressor()
    for b in batches:
        rows = []
        for sha, size, packed in zip(*(c.to_pylist() for c in b.columns), strict=True):
            body = z.decompress(packed, max_output_size=max(1, size))
            if len(body) != size or hashlib.sha256(body).digest() != sha:
                raise ValueError(f"stored payload of {sha.hex()} is damaged")
            rows.append((sha, base64.b32encode(hashlib.sha1(body).digest()).decode(), len(body)))
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t.type) for c, t in zip(list(zip(*rows, strict=True)) or [()] * 3, schema, strict=True)], schema=schema)


def read_records(payloads: DataFrame, headers: DataFrame, parse: bool = True) -> DataFrame:
    """Rebuilds every record by a join on the digest and verifies its payload.

    With parse: page_id, payload_bytes, payload_digest, record_type, refers_to, url. Otherwise page_id and the record's bytes.
    Revisit records need no payload bytes, so hot payloads are not multiplied: those rows join the size and digests that were
    computed from the stored bytes, once for each payload.
    """
    is_revisit = F.col("header").substr(F.lit(1), F.lit(29)).cast("string").contains("WARC-Type: revisit")
    full = headers.where(~is_revisit).join(payloads, "sha256").select("page_id", "header", "sha256", "digest", "size", "bytes")
    found = materialise(map_arrow(payloads.select("sha256", "size", "bytes"), _digests, "sha256 binary, digest string, size bigint"), "warc-verified")
    bare = headers.where(is_revisit).join(found, "sha256").select("page_id", "header", "sha256", "digest", "size", F.lit(None).cast("binary").alias("bytes"))

    def rebuild(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        import zstandard

        z = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for page, head, sha, digest, size, packed in zip(*(c.to_pylist() for c in b.columns), strict=True):
                body = b"" if packed is None else z.decompress(packed, max_output_size=max(1, size))
                if packed is not None and (len(body) != size or hashlib.sha256(body).digest() != sha):
                    raise ValueError(f"stored payload of {sha.hex()} is damaged")
                raw = head + body + CRLF + CRLF
                if not parse:
                    out.append((page, raw))
                    continue
                f, got = parse_record(raw)
                kind, named = f["WARC-Type"], f["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response":
                    n, real = len(got), base64.b32encode(hashlib.sha1(got).digest()).decode()
                else:
                    n, real = size, digest
                if real != named or n != int(f["X-Payload-Bytes"]):
                    raise ValueError(f"record of page {page} does not match its payload")
                refers = f.get("X-Refers-To-Page")
                page_id = None if f["X-Page-Id"] == "None" else int(f["X-Page-Id"])
                out.append((page_id, n, real, kind, int(refers) if refers else None, f.get("WARC-Target-URI")))
            cols = list(zip(*out, strict=True)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t.type) for c, t in zip(cols, schema, strict=True)], schema=schema)

    ddl = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string" if parse else "page_id bigint, record binary"
    return map_arrow(full, rebuild, ddl).unionByName(map_arrow(bare, rebuild, ddl))


def round_trip(pages: DataFrame) -> DataFrame:
    payloads, headers = write_archive(pages)
    return read_records(payloads, headers).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, sha1(h) AS s FROM p),
t AS (SELECT page_id, n, array_to_string(list_transform(range(8), lambda i: lpad(to_base(('0x' || substr(s, 5 * i + 1, 5))::BIGINT, 32), 4, '0')), '') AS q,
             min(page_id) OVER (PARTITION BY s, n) AS first, row_number() OVER (PARTITION BY s, n ORDER BY page_id) AS k FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       translate(upper(q), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k = 1 THEN NULL ELSE first END AS refers_to
FROM t
"""
