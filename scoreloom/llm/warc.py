"""WARC archives: written by Spark's text writer, read back by boundary-chain verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.llm.common import stage
from scoreloom.session import stage_path

MAGIC = "WARC/1."
END = "\r\n\r\n"


def _header(name: str, value: Column | str) -> Column:
    value = F.lit(value) if isinstance(value, str) else value
    return F.when(value.isNotNull(), F.concat(F.lit(f"\r\n{name}: "), value)).otherwise("")


def revisits(pages: DataFrame, key: str = "page_id", html: str = "html", least: int = 100) -> DataFrame:
    """``id, refers_to`` of pages whose payload of at least ``least`` bytes is that of a page with a smaller id."""
    payload = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    thin = pages.select(F.col(f"`{key}`").alias("id"), F.octet_length(payload).alias("n"),
                        F.sha2(payload.cast("binary"), 256).alias("digest")).filter(F.col("n") >= least).drop("n")
    first = thin.groupBy("digest").agg(F.min("id").alias("refers_to"), F.max("id").alias("last"))
    first = first.filter("refers_to < last").drop("last")
    return thin.join(first, "digest").filter("id > refers_to").select("id", "refers_to").distinct()


def write_warc(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = 100,
    date: str = "1970-01-01T00:00:00Z", records_per_file: int = 4096,
) -> None:
    """One record per page under ``path``, in archives of at most ``records_per_file`` records.

    The payload is the html in UTF-8, null counting as empty.  Of equal payloads of at least ``least`` bytes the page with
    the smallest id is a response and the others are revisits without a block; rows that repeat that id, rows without an
    id and smaller payloads are responses.  Control characters and spaces in a url are written as %20, and the slash of the
    magic as %2F.
    """
    payload = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    # Stored, so that the join knows its size: where few pages are copies, the html is not shuffled.
    known = stage(revisits(pages, key, html, least).select(F.col("id").alias("_revisit_id"), "refers_to"), "warc-revisits")
    rows = pages.select(
        F.col(f"`{key}`").alias("id"),
        F.replace(F.regexp_replace(F.col(f"`{url}`"), r"[\x00-\x20\x7f]", "%20"), F.lit(MAGIC), F.lit("WARC%2F1.")).alias("url"),
        payload.alias("payload"),
    ).join(known, F.col("id") == F.col("_revisit_id"), "left")
    again = F.col("refers_to").isNotNull()
    block = F.when(again, "").otherwise(F.col("payload"))
    record = F.concat(
        F.lit(f"{MAGIC}1"),
        _header("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("id").cast("string"), F.lit(">"))),
        _header("WARC-Date", date),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        _header("WARC-Profile", F.when(again, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.sha2(F.col("payload").cast("binary"), 256))),
        _header("WARC-Payload-Length", F.octet_length("payload").cast("string")),
        _header("Content-Type", "text/html; charset=utf-8"),
        _header("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END), block,
    )
    rows.select(record.alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(path)


def _field(head: Column, name: str, pattern: str) -> Column:
    found = F.regexp_extract(head, rf"(?i)\r\n{name}:[ \t]*{pattern}", 1)
    return F.when(found != "", found)


def magic_lines(spark: SparkSession, path: str) -> DataFrame:
    """The archives cut at the magic instead of at line breaks: ``file, block, nth, value``.

    Spark reads files in splits, so a large archive is many tasks' work; ``block`` is the split's first byte.
    """
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"), "value",
    )


def candidates(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines, stored, and every place where the magic occurs, with its offset ``start`` and would-be successor ``next``.

    ``nth`` is given once, by the scan that is stored, so it holds however later scans are split.  A line that is not
    ``whole`` is stored with its ``value``, a whole one with the value's hash as ``key``.  Offsets come from running sums inside a split and one sum per split.  A candidate whose bytes up to the next magic are
    just its record is ``whole`` and has its payload's digest taken here.  A header that holds the magic goes on in the
    following lines up to the first that has a header end: each line names the header end and the content length it holds,
    and running values from the back, inside a split and over splits, give every candidate the nearest of each.
    """
    head = F.substring_index("value", END, 1)
    lines = lines.withColumn("n", F.octet_length("value")).withColumn("ends", F.octet_length(head) < F.col("n"))
    lines = lines.withColumn("opens", F.col("value").rlike(r"\A[01]\r\n")).withColumn("part", head)
    # Where the magic cuts a line short, its digits are not the end of a field.
    says = _field(F.when(F.col("ends"), F.col("part")).otherwise(F.concat("part", F.lit(MAGIC))), "Content-Length",
                  r"(\d{1,15})(?=[ \t]*(?:\r\n|\z))").cast("long")
    lines = lines.withColumn("body", says).withColumn("body_at", F.when(F.col("ends"), F.octet_length("part") + 4))
    alone = F.col("opens") & F.col("ends")
    whole = F.coalesce(alone & (F.col("n") == F.col("body_at") + F.col("body") + 4), F.lit(False))
    payload = F.substring(F.col("value").cast("binary"), F.col("body_at") + 1, F.col("body").cast("int"))
    lines = stage(
        lines.select(
            "file", "block", "nth", "n", "opens", "body_at", "body", whole.alias("whole"),
            F.when(whole, F.col("part")).alias("head"), F.when(whole, F.sha2(payload, 256)).alias("digest"),
            F.when(whole, F.sha2(F.col("value").cast("binary"), 256)).alias("key"), F.when(~whole, F.col("value")).alias("value"),
        ),
        "warc-lines",
    )
    stored = lines
    lines = lines.select("file", "block", "nth", "n", "opens", "body_at", "body", "whole")
    step = len(MAGIC)
    within = W.partitionBy("file", "block").orderBy("nth").rowsBetween(W.unboundedPreceding, -1)
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    bases = lines.groupBy("file", "block").agg(F.sum(F.col("n") + step).alias("all")).select(
        "file", "block", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("base"),
        (F.sum("all").over(W.partitionBy("file")) - step).alias("bytes"),
    )
    start = F.col("base") + F.coalesce(F.sum(F.col("n") + step).over(within), F.lit(0)) - step
    placed = stage(lines.join(bases, ["file", "block"]).withColumn("start", start).withColumn(
        # The part of a header in a line: where the header ends, if it does, and the length stated.
        "stop", F.col("start") + step + F.col("body_at")
    ), "warc-placed")
    # The nearest line at or after a line with a header end; the first stated length from a line to that one.
    onward = W.partitionBy("file", "block").orderBy(F.desc("start")).rowsBetween(W.unboundedPreceding, 0)
    later = W.partitionBy("file").orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, -1)
    stop = F.struct("start", "stop")
    size = F.struct("start", "body")
    edges = placed.groupBy("file", "block").agg(
        F.min(F.when(F.col("stop").isNotNull(), stop)).alias("stop_at"), F.min(F.when(F.col("body").isNotNull(), size)).alias("body_in")
    ).select("file", "block", F.last("stop_at", True).over(later).alias("stop_on"), F.last("body_in", True).over(later).alias("body_on"))
    seen = placed.withColumn("stop_at", F.last(F.when(F.col("stop").isNotNull(), stop), True).over(onward)).withColumn(
        "body_in", F.last(F.when(F.col("body").isNotNull(), size), True).over(onward)
    ).join(edges, ["file", "block"])
    stop, size = F.coalesce("stop_at", "stop_on"), F.coalesce("body_in", "body_on")
    held = F.col("opens") & (size["start"] <= stop["start"])
    seen = seen.withColumn("body_at", F.when(held, stop["stop"] - F.col("start") - step)).withColumn("body", F.when(held, size["body"]))
    return stored, stage(
        seen.select(
            "file", "block", "nth", "start", (F.col("start") + step + F.col("body_at") + F.col("body") + 4).alias("next"),
            "body_at", "body", "whole", "bytes",
        ),
        "warc-candidates",
    )


def reachable(marks: DataFrame) -> DataFrame:
    """``file, start`` of the records on the chain from offset 0 of each file, by pointer jumping.

    ``marks`` has ``file, start, next``.  Each round every pointer skips twice as far and every reached record marks the one
    that its pointer names; a file of R candidates takes log2 R rounds over these narrow rows.
    """
    step = marks.filter("start >= 0").select("file", "start", "next", (F.col("start") == 0).alias("on"))
    longest = step.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    for _ in range(longest.bit_length()):
        a, b = step.alias("a"), step.select(F.col("file").alias("f"), F.col("start").alias("s"), F.col("next").alias("far"))
        jumped = a.join(b, (F.col("file") == F.col("f")) & (F.col("next") == F.col("s")), "left")
        both = F.array(
            F.struct("start", F.col("far").alias("next"), "on"),
            F.when(F.col("on") & F.col("s").isNotNull(),
                   F.struct(F.col("s").alias("start"), F.lit(None).cast("long").alias("next"), F.lit(True).alias("on"))),
        )
        out = jumped.select("file", F.explode(both).alias("x")).filter("x is not null").select("file", "x.*")
        step = stage(
            out.groupBy("file", "start").agg(F.max("next").alias("next"), F.max("on").alias("on")), "warc-jump"
        )
    return step.filter("on").select("file", "start")


def _unsettled(lines: DataFrame) -> DataFrame:
    """Lines of records that hold the magic in payload or header, with the ``owner`` (start of the record) each belongs to.

    The owner is the last record on the chain at or before a line: a running maximum inside the split, and the maximum of
    earlier splits for lines before the split's first record.  Lines past the owner's end and records that the file cuts
    off are left out, so that damage collects nothing.
    """
    mine = F.when(F.col("on"), F.struct("start", "next", (F.col("next") - 4 <= F.col("bytes")).alias("fits")))
    within = W.partitionBy("file", "block").orderBy("start")
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carried = lines.groupBy("file", "block").agg(F.max(mine).alias("top")).select(
        "file", "block", F.max("top").over(earlier).alias("carry")
    )
    owned = lines.withColumn("owner", F.max(mine).over(within)).join(carried, ["file", "block"])
    owned = owned.filter("not (coalesce(on, false) and whole)").withColumn("owner", F.coalesce("owner", "carry"))
    return owned.filter("owner.fits and start < owner.next").select(
        "file", "start", "nth", "whole", F.col("owner.start").alias("owner"),
        F.when(F.col("on"), F.struct("body_at", "body")).alias("record"),
    )


def _glue(raw: DataFrame, stored: DataFrame, rest: DataFrame) -> DataFrame:
    """``head, length, digest`` of the records that ``rest`` lists.

    Values come from the stored lines; only those of whole records inside a payload are looked up in the archives again, by
    their hash, which no split or lost executor changes.
    """
    lines = stored.filter("not whole").select("nth", "value").join(rest, "nth")
    inner = rest.filter("whole")
    if not inner.isEmpty():
        inner = stage(inner.join(stored.filter("whole").select("nth", "key"), "nth"), "warc-inner")
        hashed = raw.select("value", F.sha2(F.col("value").cast("binary"), 256).alias("key"))
        again = hashed.join(inner.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.first("value").alias("value"))
        lines = lines.unionByName(inner.join(again, "key").select(*lines.columns))
    joined = lines.groupBy("file", "owner").agg(
        F.array_sort(F.collect_list(F.struct("start", "value"))).alias("parts"), F.max("record").alias("r")
    )
    glued = F.array_join(F.col("parts.value"), MAGIC)
    whole = joined.filter("r.body is not null").withColumn("head", F.substring_index(glued, END, 1)).withColumn(
        "payload", F.substring(glued.cast("binary"), (F.col("r.body_at") + 1).cast("int"), F.col("r.body").cast("int"))
    )
    return whole.filter(F.octet_length("payload") == F.col("r.body")).select(
        "head", F.col("r.body").alias("length"), F.sha2("payload", 256).alias("digest")
    )


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``record_id, record_type, url, refers_to, digest, length`` of each record of the archives under ``path``.

    Only records on the chain from a file's start count; the magic inside a payload, even before a well-formed header, is
    no record.  For a response, digest and length are those of the payload bytes read; a revisit has no block and gives
    those its header states.  A cut or damaged file gives the records before the damage.  No file, no rows.
    """
    raw = magic_lines(spark, path)
    stored, found = candidates(raw)
    chain = stage(reachable(found.select("file", "start", "next")), "warc-chain")
    lines = found.join(chain.withColumn("on", F.lit(True)), ["file", "start"], "left")
    known = lines.filter("on and whole").select("nth")
    records = stored.filter("whole").join(known, "nth", "left_semi").select("head", F.col("body").alias("length"), "digest")
    rest = stage(_unsettled(lines), "warc-rest")
    if not rest.isEmpty():
        records = records.unionByName(_glue(raw, stored, rest))
    kind = _field(F.col("head"), "WARC-Type", r"([^\s]+)")
    named = r"<urn:page:([^>]*)>"
    again = kind == "revisit"
    return records.select(
        _field(F.col("head"), "WARC-Record-ID", named).alias("record_id"), kind.alias("record_type"),
        _field(F.col("head"), "WARC-Target-URI", r"([^\r\n]*)").alias("url"),
        _field(F.col("head"), "WARC-Refers-To", named).alias("refers_to"),
        F.when(again, _field(F.col("head"), "WARC-Payload-Digest", r"sha256:([0-9a-f]{64})")).otherwise(F.col("digest")).alias("digest"),
        F.when(again, _field(F.col("head"), "WARC-Payload-Length", r"(\d+)").cast("long")).otherwise(F.col("length")).alias("length"),
    )


def warc_round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write ``pages`` as archives in the shared folder, read them back: one row per page.

    ``key, payload_bytes, payload_digest, record_type, refers_to``; null html counts as empty, null ids come back null,
    other columns are ignored, and an empty table gives an empty result.
    """
    spark = pages.sparkSession
    path = stage_path(spark, "llm-warc")
    write_warc(pages, path, key, url, html)
    kind = pages.schema[key].dataType
    return read_warc(spark, path).select(
        F.col("record_id").cast(kind).alias(key), F.col("length").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), "record_type", F.col("refers_to").cast(kind).alias("refers_to"),
    )
