"""WARC archives: writing captures, reading records, assembling transactions.

Every page becomes three records: a request, a capture (response, or revisit of
an equal payload) and a metadata record. Request and metadata name the capture
in ``WARC-Concurrent-To``; a revisit names the response in ``WARC-Refers-To``.
Reading gives one row per record, and assembly joins the records through these
identifiers into one nested row per capture.

Of equal payloads (same SHA-1 and length) of at least ``min_bytes`` bytes the
page with the largest id is the response. Only groups of two or more are joined
back to the pages, from a stored table, so adaptive execution can split a payload
that a third of all pages share.

* NULL html is an empty payload; empty payloads equal each other.
* NULL ids rank below all others; NULL or broken addresses are written as a URN
  or percent-encoded, so no value can end a header early.
* Rows that agree in id, address and payload are captures of their own: the record
  ids of all but the first carry a number. Rows of the largest id are all responses,
  and revisits refer to the first of them.
* Records that point at no capture are left out of the assembly. Of several
  requests or metadata records of a capture, the one with the least record id is
  nested and all are counted.
* No rows give no archives and no rows.

An archive belongs to one task. It is written under a scratch name and moved in
place when complete, and its name is recorded in a stored list, so a repeated
task leaves no second copy behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstrata.llm.common import new_folder, stored

NAMESPACE = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"  # the public namespace of URLs
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = (
    "file string, record_id string, record_type string, concurrent_to string, refers_to string, "
    "target_uri string, warc_date string, declared_digest string, fields map<string,string>, "
    "payload binary, payload_bytes long, payload_digest string"
)


def _record_id(kind: str, page_id, url: str, digest: str, again: int = 0) -> str:
    """The id of a record; ``again`` tells rows that repeat all of the rest apart."""
    import uuid

    kind = f"{kind} again {again}" if again else kind
    return f"<urn:uuid:{uuid.uuid5(uuid.UUID(NAMESPACE), f'{kind} {page_id} {digest} {url}')}>"


def _digest(payload: bytes) -> str:
    import base64
    import hashlib

    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One gzip member that holds one record."""
    import zlib

    head = "".join(f"{name}: {value}\r\n" for name, value in headers)
    data = f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(5, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _transaction(page_id, url, payload: bytes, sha1: str, again: int, original, date: str):
    """The three records of a page; ``original`` is (id, address) of the response, or None."""
    import base64
    from urllib.parse import quote

    uri = quote(url, safe="%/:=&?~#+!$,;'@()*[]|") if url else f"urn:page:{page_id}"
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    capture = _record_id("capture", page_id, url or "", sha1, again)

    def headers(kind: str, record_id: str, content: str, *more):
        return [
            ("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", date),
            ("WARC-Target-URI", uri), ("Content-Type", content), *more,
        ]

    linked = ("WARC-Concurrent-To", capture)
    host, _, path = uri.partition("://")[2].partition("/")
    yield _record(
        headers("request", _record_id("request", page_id, url or "", sha1, again),
                "application/http;msgtype=request", linked),
        f"GET /{path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode(),
    )
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    named = ("WARC-Payload-Digest", f"sha1:{digest}")
    if original is None:
        yield _record(
            headers("response", capture, "application/http;msgtype=response", named), head + payload
        )
    else:
        yield _record(
            headers("revisit", capture, "application/http;msgtype=response", named,
                    ("WARC-Profile", PROFILE),
                    ("WARC-Refers-To", _record_id("capture", original[0], original[1] or "", sha1))),
            head,
        )
    fields = "" if page_id is None else f"page-id: {page_id}\r\n"
    yield _record(
        headers("metadata", _record_id("metadata", page_id, url or "", sha1, again),
                "application/warc-fields", linked),
        fields.encode(),
    )


def write_captures(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write one archive per task into ``folder``; returns the list of archives."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).select(
        "*", F.sha1("payload").alias("sha1"), F.octet_length("payload").alias("size")
    )
    keys = ["page_id", "url", "sha1", "size"]
    copies = stored(
        rows.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .groupBy("sha1", "size")
        .agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max(F.struct("page_id", "url")).alias("original"))
        .where("n > 1"),
        "warc-copies",
    )
    # The pages always move by digest, so small and large tables have the same plan.
    shared = F.col("original").isNotNull() & (F.col("size") >= min_bytes)
    revisits = shared & ~F.col("page_id").eqNullSafe(F.col("original.page_id"))
    joined = rows.join(copies.drop("n").hint("merge"), ["sha1", "size"], "left")

    def plan(some: DataFrame, again: Column) -> DataFrame:
        return some.select(
            "page_id", "url", "payload", "sha1", again.cast("long").alias("again"), revisits.alias("revisits"),
            F.col("original.page_id").alias("original_id"), F.col("original.url").alias("original_url"),
        )

    planned = plan(joined.where("most IS NULL OR most = 1"), F.lit(0))
    if not copies.where("most > 1").isEmpty():
        # Rows equal in everything are counted, not sorted, and then dealt out in runs.
        counted = (
            joined.where("most > 1")
            .groupBy(*keys)
            .agg(F.first("payload").alias("payload"), F.first("original").alias("original"), F.count("*").alias("n"))
        )
        runs = counted.withColumn("run", F.explode(F.sequence(F.lit(0), F.expr("(n - 1) div 1000").cast("long"))))
        again = F.explode(F.sequence(F.col("run") * 1000, F.least(F.col("n"), (F.col("run") + 1) * 1000) - 1))
        dealt = runs.repartition(*keys, "run").withColumn("again", again)
        planned = planned.unionByName(plan(dealt, F.col("again")))

    def run(batches):
        import uuid

        import pyarrow as pa
        from pyarrow import fs

        batch = next((b for b in batches if b.num_rows), None)
        if batch is None:
            return
        filesystem, root = fs.FileSystem.from_uri(folder)
        filesystem.create_dir(root, recursive=True)
        name = uuid.uuid4().hex
        captures = 0
        with filesystem.open_output_stream(f"{root}/.{name}") as out:
            info = [
                ("WARC-Type", "warcinfo"), ("WARC-Date", date),
                ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                ("Content-Type", "application/warc-fields"),
            ]
            out.write(_record(info, b"format: WARC File Format 1.1\r\n"))
            while batch is not None:
                # Row by row, so that one payload at a time is a Python object.
                for row in range(batch.num_rows):
                    page_id, url, payload, sha1, again, revisit, *original = (
                        column[row].as_py() for column in batch.columns
                    )
                    parts = _transaction(
                        page_id, url, payload, sha1, again, original if revisit else None, date
                    )
                    for part in parts:
                        out.write(part)
                    captures += 1
                batch = next(batches, None)
        filesystem.move(f"{root}/.{name}", f"{root}/{name}.warc.gz")
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{folder}/{name}.warc.gz"]), pa.array([captures], pa.int64())],
            names=["file", "captures"],
        )

    return stored(planned.mapInArrow(run, "file string, captures long"), "warc-files")


def read_archive_records(path: str):
    """The records of one archive as dictionaries, one at a time; gzip or plain."""
    import gzip

    from pyarrow import fs

    filesystem, name = fs.FileSystem.from_uri(path)
    with filesystem.open_input_file(name) as handle:
        source = gzip.GzipFile(fileobj=handle) if path.endswith(".gz") else handle
        while True:
            line = source.readline()
            if not line:
                return
            if not line.startswith(b"WARC/"):
                continue
            headers = {}
            while (line := source.readline().rstrip(b"\r\n")):
                key, _, value = line.decode("utf-8", "replace").partition(":")
                headers[key.strip().lower()] = value.strip()
            block = source.read(int(headers.get("content-length", 0)))
            yield headers, block


def read_records(spark: SparkSession, files: DataFrame, file_col: str = "file") -> DataFrame:
    """One row per record of the archives named in ``files``.

    ``payload`` is the body of a response; its length and SHA-1 (bare base32) are
    taken from the bytes read. Other records have a NULL payload; the fields of
    metadata records are a map.
    """

    def run(batches):
        import pyarrow as pa

        schema = pa.schema(
            [(name, pa.string()) for name in (
                "file", "record_id", "record_type", "concurrent_to", "refers_to", "target_uri",
                "warc_date", "declared_digest")]
            + [("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()),
               ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
        )

        def flush(rows):
            columns = [pa.array(list(c), field.type) for c, field in zip(zip(*rows), schema)]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        rows, size = [], 0
        for batch in batches:
            for file in batch.column(0).to_pylist():
                for headers, block in read_archive_records(file):
                    kind = headers.get("warc-type")
                    payload, fields = None, None
                    if kind == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                    elif kind == "metadata":
                        lines = block.decode("utf-8", "replace").split("\r\n")
                        fields = [tuple(x.strip() for x in one.split(":", 1)) for one in lines if ":" in one]
                        fields = list(dict(fields).items())
                    declared = headers.get("warc-payload-digest")
                    rows.append((
                        file, headers.get("warc-record-id"), kind, headers.get("warc-concurrent-to"),
                        headers.get("warc-refers-to"), headers.get("warc-target-uri"),
                        headers.get("warc-date"), declared and declared.removeprefix("sha1:"), fields,
                        payload, None if payload is None else len(payload),
                        None if payload is None else _digest(payload),
                    ))
                    size += len(block)
                    if size >= 8 << 20 or len(rows) >= 10_000:
                        yield flush(rows)
                        rows, size = [], 0
        if rows:
            yield flush(rows)

    names = files.select(F.col(file_col).alias("file"))
    return names.repartition(max(1, names.count())).mapInArrow(run, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture``, ``request``, ``metadata`` and their counts.

    ``records`` is read three times and should be a stored table. Request and
    metadata are joined through ``concurrent_to``.
    """

    def beside(kind: str, *columns: str) -> DataFrame:
        return (
            records.where((F.col("record_type") == kind) & F.col("concurrent_to").isNotNull())
            .groupBy("concurrent_to")
            .agg(
                F.min_by(F.struct("record_id", *columns), "record_id").alias(kind),
                F.count_distinct("record_id").alias(f"n_{kind}"),
            )
        )

    captures = (
        records.where(F.col("record_type").isin("response", "revisit"))
        .drop("concurrent_to", "fields")
        .dropDuplicates(["record_id"])
    )
    request = beside("request", "target_uri", "warc_date")
    metadata = beside("metadata", "fields")
    return (
        captures.join(request, captures["record_id"] == request["concurrent_to"], "left")
        .drop("concurrent_to")
        .join(metadata, captures["record_id"] == metadata["concurrent_to"], "left")
        .select(
            F.struct(*[captures[c] for c in captures.columns]).alias("capture"),
            "request",
            "metadata",
            F.coalesce("n_request", F.lit(0)).alias("n_request"),
            F.coalesce("n_metadata", F.lit(0)).alias("n_metadata"),
        )
    )


def capture_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives in a fresh shared folder, read and assemble them."""
    spark = pages.sparkSession
    files = write_captures(pages, new_folder(spark, "warc"), min_bytes=min_bytes)
    return assemble(stored(read_records(spark, files), "warc-records"))


def capture_digests(transactions: DataFrame) -> DataFrame:
    """Per capture: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Length, digest and page of a revisit are those of the response it refers to.
    """
    flat = stored(
        transactions.select(
            F.col("metadata.fields").getItem("page-id").cast("long").alias("page_id"),
            F.col("capture.record_id").alias("record_id"),
            F.col("capture.record_type").alias("record_type"),
            F.col("capture.refers_to").alias("original"),
            F.col("capture.payload_bytes").alias("payload_bytes"),
            F.col("capture.payload_digest").alias("payload_digest"),
        ),
        "warc-captures",
    )
    responses = flat.where("record_type = 'response'").select(
        F.col("record_id").alias("original"),
        F.col("page_id").alias("original_page"),
        F.col("payload_bytes").alias("original_bytes"),
        F.col("payload_digest").alias("original_digest"),
    )
    return flat.join(responses, "original", "left").select(
        "page_id",
        F.coalesce("payload_bytes", "original_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "original_digest").alias("payload_digest"),
        "record_type",
        F.col("original_page").alias("refers_to"),
    )
