"""WARC archives: pages written as capture transactions, and transactions assembled again.

Writing. A capture is a request, a response (or a revisit) and a metadata record, linked by
WARC-Concurrent-To. Of captures with equal payloads of a least size one is the
response, the others are revisits of it (identical-payload-digest, WARC-Refers-To). Spark's
text writer puts the records into files: a record ends with two line breaks, which
are the writer's separator.

Reading. Spark's text reader cuts archives before ``WARC/1.`` at the start of a record, one
task a file, as for any compressed archive (about 1 GB by custom). A payload that holds
such a cut itself shows by its Content-Length; only the files that have one are put
together anew, from the lengths of their pieces. Records then meet in joins: requests and metadata
through their concurrent-to identifiers, revisits with the response they refer to. One
nested row per capture comes out.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from herald.llm.common import Scratch, rebalanced, split_join

VERSION = "WARC/1.1"
END = "\r\n\r\n"
#: Where the reader cuts: the end of a record and the start of the next one.
CUT = END + "WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


# ---------------------------------------------------------------- writing

def _urn(run: str, nr: Column, kind: str) -> Column:
    """A record id from the run, the capture's number in it and the kind of record."""
    digest = F.md5(F.concat(F.lit(f"{run}/{kind}/"), nr.cast("string")))
    parts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(headers: list[tuple[str, Column | str]], block: Column) -> Column:
    """A record without its final line breaks; headers with a null value are left out."""
    lines = [F.concat(F.lit(f"{name}: "), v if isinstance(v, Column) else F.lit(v)) for name, v in headers]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws("\r\n", F.lit(VERSION), *lines), F.lit(END), block)


def _header_value(col: Column) -> Column:
    """A text that may stand in a header: line breaks and tabs percent-encoded."""
    for char, code in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09")):
        col = F.replace(col, F.lit(char), F.lit(code))
    return col


def numbered_pages(pages: DataFrame, scratch: Scratch, id_col: str, url_col: str, text_col: str) -> DataFrame:
    """``nr, page_id, url, payload, bytes, digest``, written once so that ``nr`` stays the same."""
    payload = F.coalesce(F.col(text_col), F.lit(""))
    return scratch.write(pages.select(
        F.monotonically_increasing_id().alias("nr"), F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("bytes"), F.sha2(payload, 256).alias("digest")))


def revisits(pages: DataFrame, scratch: Scratch, least_bytes: int) -> DataFrame:
    """``nr, first_nr, first_url`` of the pages whose payload another page already has.

    A payload is known by its SHA-256; the smallest page id comes first, null last, ties
    by number. One payload may stand on a third of all pages.
    """
    slim = scratch.write(rebalanced(pages.filter(F.col("bytes") >= least_bytes)
                                    .select("nr", "page_id", "url", "digest")))
    first = F.min(F.struct(F.col("page_id").isNull(), "page_id", "nr", "url"))
    groups = slim.groupBy("digest").agg(first.alias("first"), F.count("*").alias("n")).filter("n > 1") \
        .select("digest", F.col("first.nr").alias("first_nr"), F.col("first.url").alias("first_url"))
    found = split_join(slim.select("nr", "digest"), scratch.write(rebalanced(groups)), "digest", scratch)
    return scratch.write(rebalanced(found.filter(F.col("first_nr") != F.col("nr"))
                                    .select("nr", "first_nr", "first_url")))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
               text_col: str = "html", least_bytes: int = 100, date: str | None = None,
               compression: str = "gzip") -> None:
    """One transaction a row of ``pages`` into archives under ``path``.

    The payload is the text in UTF-8, a null one is empty. Payloads of ``least_bytes`` bytes and
    more are stored once: with the smallest id (null last; of repeated rows, one). ``date`` is
    the WARC-Date, the time of writing by default. A null url has no WARC-Target-URI. The
    page's id is a field of the metadata record, left out if null. Very long texts are single
    records; an empty table gives an empty folder. Other columns are not read.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc-write")
    date = date or spark.sql("SELECT date_format(to_utc_timestamp(now(), current_timezone()), "
                             "\"yyyy-MM-dd'T'HH:mm:ss'Z'\")").first()[0]
    run = uuid.uuid4().hex
    rows = numbered_pages(pages, scratch, id_col, url_col, text_col)
    rows = rows.join(revisits(rows, scratch, least_bytes), "nr", "left")

    target, size = _header_value(F.col("url")), F.col("bytes").cast("string")
    capture = _urn(run, F.col("nr"), "capture")
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#\s]*)", 1)
    place = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]*([^#\s]*)", 1)
    place = F.when(place.startswith("/"), place).otherwise(F.concat(F.lit("/"), place))
    ask = F.concat(F.lit("GET "), F.coalesce(place, F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "),
                   F.coalesce(host, F.lit("")), F.lit(END))
    head = F.concat(F.lit(HTTP_HEAD), size, F.lit(END))
    field = F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n"))

    def common(kind: str, urn: Column) -> list:
        return [("WARC-Type", kind), ("WARC-Record-ID", urn), ("WARC-Date", date), ("WARC-Target-URI", target)]

    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    http = "application/http; msgtype="
    request = _record([*common("request", _urn(run, F.col("nr"), "request")), ("WARC-Concurrent-To", capture),
                       ("Content-Type", http + "request")], ask)
    response = _record([*common("response", capture), digest, ("Content-Type", http + "response")],
                       F.concat(head, F.col("payload")))
    revisit = _record([*common("revisit", capture), digest, ("Content-Type", http + "response"),
                       ("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(run, F.col("first_nr"), "capture")),
                       ("WARC-Refers-To-Target-URI", _header_value(F.col("first_url"))),
                       ("WARC-Refers-To-Date", date)], head)
    metadata = _record([*common("metadata", _urn(run, F.col("nr"), "metadata")), ("WARC-Concurrent-To", capture),
                        ("Content-Type", "application/warc-fields")], F.coalesce(field, F.lit("")))
    records = F.array(request, F.when(F.col("first_nr").isNull(), response).otherwise(revisit), metadata)
    rows.select(F.explode(records).alias("value")) \
        .write.option("lineSep", END).option("compression", compression).text(path)


# ---------------------------------------------------------------- reading

def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``value, file, nr``: the text between two cuts, numbered in the order of the file.

    Read through a session of its own that leaves files whole: where a split ends close to
    line breaks, the reader loses separators that begin with line breaks. Where one of its
    buffers ends there it misses a cut; such texts are cut here once more.
    """
    whole = spark.newSession()
    for setting in ("maxPartitionBytes", "openCostInBytes"):
        whole.conf.set(f"spark.sql.files.{setting}", str(1 << 50))
    raw = whole.read.option("lineSep", CUT).text(path)
    missed = F.when(F.contains("value", F.lit(CUT)), F.split("value", CUT.replace(".", r"\."))) \
        .otherwise(F.array("value"))
    return raw.select(F.explode(missed).alias("value"), F.col("_metadata.file_path").alias("file")) \
        .withColumn("nr", F.monotonically_increasing_id())


def _field(head: Column, name: str) -> Column:
    """A header's value, null if the header is missing."""
    found = F.regexp_extract(head, rf"(?im)^{name}:[ \t]*(.*?)[ \t]*$", 1)
    return F.when(found != "", found)


def _parse(pieces: DataFrame) -> DataFrame:
    """Columns of a record from its text ``value``; ``need`` and ``have`` are the block's bytes."""
    head = F.col("head")
    x = pieces.withColumn("head", F.substring_index("value", END, 1))
    x = x.withColumn("rest", F.substring(F.col("value").cast("binary"), F.octet_length("head") + F.lit(5), 2 ** 31 - 1)) \
        .withColumn("need", F.expr(r"try_cast(regexp_extract(head, '(?im)^content-length:[ \\t]*([0-9]+)', 1) as bigint)"))
    x = x.withColumn("block_bytes", F.substring(F.col("rest"), F.lit(1), F.least(F.col("need"), F.lit(2 ** 31 - 1)).cast("int")))
    http = F.coalesce(_field(head, "content-type"), F.lit("")).startswith("application/http")
    x = x.withColumn("block_text", F.col("block_bytes").cast("string")) \
        .withColumn("http_head", F.when(http, F.substring_index("block_text", END, 1)))
    payload = F.when(http, F.substring(F.col("block_bytes"), F.octet_length("http_head") + F.lit(5), 2 ** 31 - 1)) \
        .otherwise(F.col("block_bytes"))
    x = x.withColumn("payload", payload)
    kind = F.lower(_field(head, "warc-type"))
    linked = F.regexp_extract_all("head", F.lit(r"(?im)^warc-concurrent-to:[ \t]*(.*?)[ \t]*$"), F.lit(1))
    # what follows the block may only be the line breaks at the end of a file
    over = F.substring(F.col("rest"), F.col("need").cast("int") + 1, 5).cast("string")
    return x.select(
        *[c for c in pieces.columns if c != "value"], kind.alias("record_type"),
        _field(head, "warc-record-id").alias("record_id"), _field(head, "warc-date").alias("date"),
        _field(head, "warc-target-uri").alias("target_uri"), _field(head, "warc-refers-to").alias("refers_to"),
        F.regexp_replace(_field(head, "warc-payload-digest"), "^[^:]*:", "").alias("stated_digest"),
        linked.alias("concurrent_to"), F.col("http_head").alias("http_head"),
        F.when(kind == "metadata", F.col("block_text")).alias("fields"),
        F.when(kind.isin("response", "resource"), F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(kind.isin("response", "resource"), F.sha2(F.col("payload"), 256)).alias("payload_digest"),
        F.col("payload"), "need", F.octet_length("rest").cast("long").alias("have"),
        F.coalesce(F.col("need").isNotNull() & (F.octet_length("rest") >= F.col("need"))
                   & over.isin("", "\r\n", END), F.lit(False)).alias("whole"),
        (F.octet_length("head") + 4).cast("long").alias("head_bytes"),
        F.octet_length("value").cast("long").alias("bytes"))


SLIM = ["record_type", "record_id", "date", "target_uri", "refers_to", "stated_digest", "concurrent_to",
        "http_head", "fields", "payload_bytes", "payload_digest", "whole"]
CHAIN = "file string, nr long, starts long, many boolean"


def _chain(group: pa.Table) -> pa.Table:
    """For the pieces of one file (lengths only): the piece its record starts with."""
    group = group.sort_by("nr")
    starts, sizes, offset, end = [], [], 0, -len(CUT)
    for size, head, need in zip(*(group[c].to_pylist() for c in ("bytes", "head_bytes", "need"))):
        if offset - len(CUT) >= end:
            starts.append(offset)
            sizes.append(0)
            end = offset + (size if need is None else head + need)
        else:
            starts.append(starts[-1])
        sizes[-1] += 1
        offset += size + len(CUT)
    count = {s: n for s, n in zip(dict.fromkeys(starts), sizes)}
    return pa.table({**{c: group[c] for c in ("file", "nr")}, "starts": pa.array(starts, pa.int64()),
                     "many": pa.array([count[s] > 1 for s in starts], pa.bool_())})


def _rejoined(pieces: DataFrame, scratch: Scratch) -> DataFrame:
    """Pieces of some files, those of one record put together (and with the cut between them)."""
    raw = scratch.write(pieces)
    lengths = _parse(raw).select("file", "nr", "bytes", "head_bytes", "need")
    chain = lengths.groupBy("file").applyInArrow(_chain, CHAIN)
    x = scratch.write(raw.join(chain, ["file", "nr"]))
    parts = F.array_sort(F.collect_list(F.struct("nr", "value")))
    put = x.filter("many").groupBy("file", "starts").agg(parts.alias("parts")).select(
        F.array_join(F.transform("parts", lambda p: p["value"]), CUT).alias("value"), "file")
    return x.filter("not many").select("value", "file").unionByName(put)


def read_warc(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """The records under ``path``, written to the scratch folder; with their payloads if asked.

    ``record_type, record_id, date, target_uri, refers_to, stated_digest, concurrent_to, http_head, fields
    (of metadata records), payload_bytes and payload_digest (SHA-256, of responses and
    resources), whole``. A record cut short keeps what is there, ``whole`` false. A task reads a
    file and holds one record at a time. Where a payload holds a cut, the files
    concerned are read once more.
    """
    scratch = Scratch(spark, "warc-read")
    columns = [*SLIM, *(["payload"] if payload else [])]
    table = scratch.write(_parse(_pieces(spark, path)).select("file", *columns))
    broken = scratch.write(table.filter("not whole").select("file").distinct())
    if not broken.limit(1).count():
        return table.select(columns)
    again = _parse(_rejoined(_pieces(spark, path).join(broken, "file"), scratch))
    return scratch.write(table.join(broken, "file", "left_anti").select(columns)
                         .unionByName(again.select(columns)))


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture (response, revisit or resource) of ``records``.

    ``requests`` and ``metadata`` are arrays of the records that name the capture in their
    concurrent-to headers, or that it names, ordered by id; they are empty where there is none. A capture's
    row holds all its records by definition. Records that no capture is linked with
    have no row; records without an id can't be linked.
    """
    side = records.filter(F.col("record_type").isin("request", "metadata") & F.col("record_id").isNotNull())
    what = F.struct("record_id", "record_type", "date", "target_uri", "http_head", "fields")
    from_side = side.select(F.explode("concurrent_to").alias("capture_id"), what.alias("r"))
    main = records.filter(F.col("record_type").isin("response", "revisit", "resource"))
    named = main.select(F.col("record_id").alias("capture_id"), F.explode("concurrent_to").alias("other"))
    from_main = named.join(side.select(F.col("record_id").alias("other"), what.alias("r")), "other") \
        .select("capture_id", "r")

    def of(kind: str) -> Column:
        return F.array_sort(F.collect_set(F.when(F.col("r.record_type") == kind, F.col("r"))))

    linked = from_side.unionByName(from_main).groupBy("capture_id").agg(
        of("request").alias("requests"), of("metadata").alias("metadata"))
    kept = [c for c in main.columns if c not in ("concurrent_to", "fields")]
    none = F.array().cast(linked.schema["requests"].dataType)
    return main.join(linked, main["record_id"] == linked["capture_id"], "left").select(
        *[main[c] for c in kept], F.coalesce("requests", none).alias("requests"),
        F.coalesce("metadata", none).alias("metadata"))


def with_originals(found: DataFrame, columns: list[str]) -> DataFrame:
    """Captures with ``original``: ``columns`` of the response that a revisit refers to.

    Null for others and where the response is not among the captures. One response may be
    referred to by a third of all captures.
    """
    scratch = Scratch(found.sparkSession, "warc-originals")
    found = scratch.write(found)
    original = found.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.struct(*columns).alias("original")).dropDuplicates(["refers_to"])
    return split_join(found, original, "refers_to", scratch)


def page_id(metadata: str = "metadata") -> Column:
    """The page's id from the first metadata record that has one."""
    ids = F.transform(F.col(metadata), lambda m: F.regexp_extract(m["fields"], r"(?m)^page-id: (-?\d+)", 1))
    return F.get(F.filter(ids, lambda x: x != ""), F.lit(0)).cast("long")


def archived_pages(pages: DataFrame, path: str, least_bytes: int = 100) -> DataFrame:
    """``pages`` written to archives under ``path`` and read back, a row per page.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to`` (the response's page_id): for
    a revisit, size and digest are those of the payload it stands for. Repeated rows each have
    a row; nulls, empty and very long texts and other columns as in :func:`write_warc`.
    """
    write_warc(pages, path, least_bytes=least_bytes)
    found = captures(read_warc(pages.sparkSession, path)).withColumn("page_id", page_id())
    found = with_originals(found.select("page_id", "record_type", "record_id", "refers_to", "payload_bytes",
                                        "payload_digest", "stated_digest"),
                           ["page_id", "payload_bytes", "payload_digest"])
    return found.select("page_id", F.coalesce("payload_bytes", "original.payload_bytes").alias("payload_bytes"),
                        F.coalesce("payload_digest", "original.payload_digest").alias("payload_digest"),
                        "record_type", F.col("original.page_id").alias("refers_to"))
