"""WARC archives: written with revisit records, read back through verified chains of records.

The mark that begins a record may stand in a payload too. Each task lists the marks of its split with the
place where a record starting there would end; these successors are followed within a split at once, from
split to split by pointer jumping, and only what is reached from the start of a file is a record.
"""

from __future__ import annotations

from functools import reduce

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from jobmeld.functions.binding import detached
from jobmeld.llm.common import row_keys, stored
from jobmeld.session import scratch_path

MARK = "WARC/1.1\r\n"
_GAP = "\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(hex_digest: Column) -> Column:
    """The upper-case base32 form of a SHA-1 given in hexadecimal digits: 40 bits at a time."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    parts = [F.conv(F.substring(hex_digest, 1 + 10 * k, 10), 16, 32) for k in range(4)]
    return F.concat(*[F.translate(F.lpad(p, 8, "0"), digits, letters) for p in parts])


def _one_line(col: Column) -> Column:
    """A header value: control characters and blanks become %20."""
    return F.regexp_replace(F.coalesce(col, F.lit("")), r"[\x00-\x20\x7F]", "%20")


def write(pages: DataFrame, out: str, date: str = "2024-01-01T00:00:00Z", least: int = 0) -> None:
    """One record per row of `pages` (page_id, url, html) in plain files below `out`, which readers can split; a null
    html is empty.

    Of rows with equal payloads of `least` bytes or more, those with the largest page_id are written as response, the
    others as revisit without the payload; a row without a page_id counts as smaller than any. Payloads are grouped by
    digest in narrow rows; the repeated digests are stored, so that Spark knows their size: few are broadcast, for
    many the pages are shuffled once, hot digests split by adaptive execution. Very long pages are records like
    others, repeated rows give records of their own, an empty table gives no record; other columns, whatever their
    names, are not read.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        "page_id", "url", payload.alias("payload"), F.sha1(payload.cast("binary")).alias("sha1"),
        F.octet_length(payload).alias("size"),
    )
    copies = rows.filter(F.col("size") >= least).groupBy("sha1", "size").agg(
        F.max("page_id").alias("chosen"), F.count(F.lit(1)).alias("n")
    )
    copies = stored(copies.filter("n > 1"), "copies").select(
        detached(F.col("sha1")).alias("of"), F.col("size").alias("of_size"), "chosen"
    )
    rows = rows.join(copies, (F.col("sha1") == F.col("of")) & (F.col("size") == F.col("of_size")), "left")
    again = F.coalesce(
        F.col("chosen").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("chosen"))), F.lit(False)
    )
    block = F.concat(F.lit(_HTTP), F.when(again, "").otherwise(F.col("payload")))

    def name(col: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(col.cast("string"), F.lit("none")), F.lit(">"))

    lines = [
        ("WARC-Type", F.when(again, "revisit").otherwise("response")),
        ("WARC-Record-ID", name(F.col("page_id"))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", _one_line(F.col("url"))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("sha1")))),
        ("WARC-Profile", F.when(again, PROFILE)),
        ("WARC-Refers-To", F.when(again, name(F.col("chosen")))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", F.octet_length(block).cast("string")),
    ]
    head = [F.coalesce(F.concat(F.lit(f"{k}: "), v, F.lit("\r\n")), F.lit("")) for k, v in lines]
    record = F.concat(F.lit(MARK), *head, F.lit("\r\n"), block)
    rows.select(record.alias("value")).write.option("lineSep", _GAP).text(out)


def _raw(spark: SparkSession, path: str) -> DataFrame:
    """Stretches between marks, in order within each split."""
    return spark.read.option("lineSep", MARK).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("seq"), "value",
    )


def _header(name: str) -> Column:
    return F.nullif(F.regexp_extract("head", rf"(?im)^{name}: *([^\r\n]*)", 1), F.lit(""))


def _stretches(spark: SparkSession, path: str) -> DataFrame:
    """One narrow row per stretch: its place in the file, and what it says if it is a record.

    Payloads are hashed here where the stretch holds them whole. Offsets are running sums, within a split and
    over the splits of a file.
    """
    raw = _raw(spark, path).withColumn("head", F.substring_index("value", _GAP, 1))
    raw = raw.withColumn("size", F.octet_length("value").cast("long"))
    ends = F.octet_length("head") + 4
    raw = raw.withColumn("length", F.try_to_number(_header("Content-Length"), F.lit("9" * 15)).cast("long"))
    raw = raw.withColumn("type", _header("WARC-Type"))
    is_head = (F.octet_length("head") < F.col("size")) & F.col("length").isNotNull() & F.col("type").isNotNull()
    body = F.expr("substring(cast(value as binary), octet_length(head) + 5, cast(least(length, 2147483647) as int))")
    raw = raw.withColumn("body", F.when(is_head, body))
    whole = is_head & (F.octet_length("body") == F.col("length"))
    http = F.octet_length(F.substring_index(F.col("body").cast("string"), _GAP, 1)) + 4
    payload = F.when(whole, F.expr(f"substring(body, octet_length(substring_index(cast(body as string), '{_GAP}', 1)) + 5)"))
    rows = raw.select(
        "file", "split", "seq", *row_keys("value"), "size", "type", is_head.alias("is_head"), whole.alias("whole"),
        (F.lit(len(MARK)) + ends + F.col("length") + 4).alias("step"),
        _header("WARC-Record-ID").alias("record_id"), _header("WARC-Refers-To").alias("refers_to"),
        _header("WARC-Payload-Digest").alias("declared"),
        F.when(whole, F.greatest(F.col("length") - http, F.lit(0))).alias("payload_bytes"),
        F.sha1(payload).alias("payload_sha1"),
    )
    rows = stored(rows, "stretches")
    step = F.col("size") + len(MARK)
    totals = rows.groupBy("file", "split").agg(F.sum(step).alias("total"))
    before = F.sum("total").over(Window.partitionBy("file").orderBy("split")) - F.col("total")
    totals = totals.select("file", "split", before.alias("base"), (before + F.col("total")).alias("end"))
    inner = F.sum(step).over(Window.partitionBy("file", "split").orderBy("seq")) - step
    placed = rows.withColumn("inner", inner).join(totals, ["file", "split"])
    placed = placed.withColumn("at", F.col("base") + F.col("inner") - len(MARK))
    return stored(placed.withColumn("next", F.when(F.col("is_head"), F.col("at") + F.col("step"))).drop("inner"), "marks")


_LINKS = "file string, split bigint, at bigint, next bigint, end bigint"


def _exits(group: pa.Table) -> pa.Table:
    """For each candidate of a split, the first place beyond the split that its chain reaches; null if it breaks."""
    group = group.sort_by("at")
    at, next_ = group["at"].to_numpy(), group["next"].to_numpy()
    inside = next_ + len(MARK) < group["end"].to_numpy()
    to = np.minimum(np.searchsorted(at, next_), len(at) - 1)
    leads = inside & (at[to] == next_)
    to = np.where(leads, to, np.arange(len(at)))
    for _ in range(len(at).bit_length()):
        to = to[to]
    exits = pa.array(next_[to], mask=inside[to])
    return group.select(["file", "split", "at"]).append_column("exit", exits)


def _reached(group: pa.Table, entries: pa.Table) -> pa.Table:
    """The candidates of a split on the chain from where it is entered."""
    if not entries.num_rows or not group.num_rows:
        return group.select(["file", "at"]).slice(0, 0)
    follow = dict(zip(group["at"].to_pylist(), group["next"].to_pylist()))
    found = []
    for at in entries["at"].to_pylist():
        while at in follow:
            found.append(at)
            at = follow.pop(at)
    kept = pa.array(sorted(found), pa.int64())
    return pa.table({"file": pa.array([group["file"][0].as_py()] * len(kept), pa.string()), "at": kept})


def chained(marks: DataFrame) -> DataFrame:
    """(file, at) of the records reached from place 0 of their file.

    `marks` has (file, split, at, next, end) for all candidates. Rounds are logarithmic in the splits of a file.
    """
    links = marks.filter("next is not null").select("file", "split", "at", "next", "end")
    exits = links.groupBy("file", "split").applyInArrow(_exits, "file string, split bigint, at bigint, exit bigint")
    exits = stored(exits, "exits")
    reached = [exits.filter("at = 0").select("file", "split", "at")]
    here = exits.select(F.col("file").alias("f"), F.col("at").alias("a"), F.col("split").alias("s"))
    # candidates whose exit is a candidate again, jump by jump twice as far
    jump = exits.filter("exit is not null").join(here, (F.col("file") == F.col("f")) & (F.col("exit") == F.col("a")))
    jump = stored(jump.select("file", "at", F.col("exit").alias("to"), F.col("s").alias("to_split")), "jumps")
    while jump.limit(1).count():
        known = reduce(DataFrame.union, reached).distinct()
        more = known.join(jump, ["file", "at"]).select("file", F.col("to_split").alias("split"), F.col("to").alias("at"))
        reached = [stored(known.union(more).distinct(), "reached")]
        far = jump.select(F.col("file").alias("f"), F.col("at").alias("a"), F.col("to").alias("t"), F.col("to_split").alias("ts"))
        jump = jump.join(far, (F.col("file") == F.col("f")) & (F.col("to") == F.col("a")))
        jump = stored(jump.select("file", "at", F.col("t").alias("to"), F.col("ts").alias("to_split")), "jumps")
    entries = reduce(DataFrame.union, reached)
    return links.groupBy("file", "split").cogroup(entries.groupBy("file", "split")).applyInArrow(
        _reached, "file string, at bigint"
    )


def _rejoined(spark: SparkSession, path: str, marks: DataFrame, records: DataFrame) -> DataFrame:
    """(file, at, payload_bytes, payload_sha1) of records whose payload holds marks: their stretches put together."""
    owner = F.last(F.when(F.col("is_record"), F.col("at")), ignorenulls=True).over(
        Window.partitionBy("file").orderBy("at")
    )
    torn = records.filter("not whole").select("file", F.col("at").alias("owner"))
    keyed = records.select("file", "at", F.lit(True).alias("is_record"))
    parts = marks.join(keyed, ["file", "at"], "left").select("file", "at", "r1", "r2", "size", owner.alias("owner"))
    parts = stored(parts.join(torn, ["file", "owner"]), "parts")
    # found again by content: splits and their order may differ between two scans
    wanted = parts.select("file", "r1", "r2", "size").distinct()
    again = _raw(spark, path).select("file", *row_keys("value"), F.octet_length("value").cast("long").alias("size"), "value")
    key = ["file", "r1", "r2", "size"]
    again = again.join(wanted, key, "left_semi").dropDuplicates(key)
    again = again.select(*[detached(F.col(c)).alias(c) for c in key], "value")
    bodies = parts.join(again, key, "left")
    bodies = bodies.select("file", "owner", "at", F.col("value").cast("binary").alias("value"))

    def glue(group: pa.Table) -> pa.Table:
        group = group.sort_by("at")
        if group["value"].null_count:
            raise ValueError(f"{group['file'][0]} has changed: a part of the record at {group['owner'][0]} is missing")
        whole = MARK.encode().join(group["value"].to_pylist())
        head, _, rest = whole.partition(b"\r\n\r\n")
        length = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        if len(rest) < length:
            raise ValueError(f"{group['file'][0]}: the record at {group['owner'][0]} has {len(rest)} of {length} bytes")
        payload = rest[:length].partition(b"\r\n\r\n")[2]
        row = {"file": group["file"][0].as_py(), "at": group["owner"][0].as_py()}
        row |= {"payload_bytes": len(payload), "payload_sha1": hashlib.sha1(payload).hexdigest()}
        return pa.Table.from_pylist([row])

    return bodies.groupBy("file", "owner").applyInArrow(
        glue, "file string, at bigint, payload_bytes bigint, payload_sha1 string"
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, intact) of every record below `path`.

    Digest and size of a response are those of its payload; `intact` says whether the digest is the declared one.
    A revisit has its declared digest and the size of the response with that digest.
    """
    marks = _stretches(spark, path)
    records = stored(chained(marks).join(marks, ["file", "at"]), "records")
    torn = _rejoined(spark, path, marks, records) if records.filter("not whole").limit(1).count() else None
    good = records.select("file", "at", "type", "record_id", "refers_to", "declared", "whole", "payload_bytes", "payload_sha1")
    if torn is not None:
        rest = good.filter("not whole").drop("payload_bytes", "payload_sha1").join(torn, ["file", "at"])
        good = good.filter("whole").unionByName(rest)
    page = F.nullif(F.regexp_extract("record_id", r"page:(-?\d+)>", 1), F.lit("")).cast("long")
    refers = F.nullif(F.regexp_extract("refers_to", r"page:(-?\d+)>", 1), F.lit("")).cast("long")
    declared = F.regexp_replace("declared", "^sha1:", "")
    good = good.select(
        page.alias("page_id"), F.col("type").alias("record_type"), refers.alias("refers_to"), declared.alias("declared"),
        base32_sha1(F.upper("payload_sha1")).alias("computed"), "payload_bytes",
    )
    good = stored(good, "records")
    responses = good.filter("record_type = 'response'")
    sizes = responses.groupBy("computed").agg(F.max("payload_bytes").alias("size"))
    sizes = sizes.select(detached(F.col("computed")).alias("of"), "size")
    revisits = good.filter("record_type = 'revisit'").join(sizes, F.col("declared") == F.col("of"), "left")
    return responses.select(
        "page_id", "payload_bytes", F.col("computed").alias("payload_digest"), "record_type", "refers_to",
        (F.col("computed") == F.col("declared")).alias("intact"),
    ).union(
        revisits.select("page_id", "size", "declared", "record_type", "refers_to", F.col("size").isNotNull())
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """What `read` gives for archives that `write` makes from `pages`, one row per row of `pages`."""
    out = scratch_path(pages.sparkSession, "warc")
    write(pages, out)
    return read(pages.sparkSession, out)
