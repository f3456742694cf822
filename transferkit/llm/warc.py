"""WARC archives: written record by record, read back along a verified chain of boundaries.

Reading splits a file wherever the magic line stands, so tasks emit every candidate record with the offset at
which its own length says the next one begins; a payload may hold such lines too.  Candidates that follow each
other without a gap are one run.  Pointer jumping from the start of each file finds the runs that the chain of
records reaches, and with them the records; all else is payload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transferkit.llm.tables import sized, stored
from transferkit.llm.words import text_of
from transferkit.session import workspace

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
LEAST_REVISIT = 1000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _uuid(of: Column) -> Column:
    digest = F.md5(of)
    parts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_warc(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    least: int = LEAST_REVISIT,
) -> None:
    """One record per row, in one archive file per task.

    Of equal payloads of at least ``least`` bytes that of the largest id is a response, the others are
    revisits of it without a block.  Rows that share that id are all responses; a null id is the smallest.
    A null payload is empty.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.regexp_replace(text_of(url_col), r"[\r\n]", "").alias("url"),
        text_of(payload_col).alias("payload"),
    )
    rows = rows.select("*", F.octet_length("payload").alias("n"), F.sha2("payload", 256).alias("same"))
    groups = rows.where(F.col("n") >= least).groupBy("same").agg(F.max("id").alias("first"), F.count("*").alias("k"))
    groups = sized(groups.where("k > 1").select("same", "first"), "warc_copies")
    rows = rows.join(groups, "same", "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    head = {
        "WARC-Type": F.when(revisit, "revisit").otherwise("response"),
        "WARC-Record-ID": _uuid(F.concat_ws("|", F.lit("page"), "id", "url", "same")),
        "WARC-Date": F.lit(date),
        "WARC-Target-URI": F.col("url"),
        "WARC-Payload-Digest": F.concat(F.lit("sha1:"), F.sha1("payload")),
        "WARC-Profile": F.when(revisit, REVISIT_PROFILE),
        "X-Refers-To-Page": F.when(revisit, F.col("first").cast("string")),
        "X-Page": F.col("id").cast("string"),
        "X-Payload-Length": F.col("n").cast("string"),
        "Content-Type": F.lit("text/html; charset=utf-8"),
        "Content-Length": F.octet_length(block).cast("string"),
    }
    lines = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v)) for k, v in head.items()]
    record = F.concat(F.lit(MAGIC), F.concat_ws("\r\n", *lines), F.lit(END), block)
    rows.select(record.alias("value")).write.option("lineSep", END).text(path)


def _candidates(segments: DataFrame) -> DataFrame:
    """Segments with their offset and, where they can be a record, that of its successor, and their run."""
    order = Window.partitionBy("file").orderBy("block", "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ahead = segments.select(
        "file", "block", "place", "head", "n",
        (F.coalesce(F.sum(F.col("n") + len(MAGIC)).over(before), F.lit(0)) - len(MAGIC)).alias("start"),
    ).where("start >= 0")
    length = F.regexp_extract("head", r"(?i)(?:^|\r\n)Content-Length:[ \t]*([0-9]{1,18})(?:\r\n|$)", 1)
    after = F.octet_length("head") + len(END) + F.when(length != "", length.cast("long")) + len(END)
    ahead = ahead.select("file", "block", "place", "start", (F.col("start") + len(MAGIC) + after).alias("next"))
    order = Window.partitionBy("file").orderBy("start")
    tight = F.coalesce(F.lag("next").over(order) == F.col("start"), F.lit(False))
    ahead = ahead.select("*", (~tight).cast("int").alias("opens"))
    return ahead.select("*", F.sum("opens").over(order).alias("run"))


def _reached(candidates: DataFrame) -> DataFrame:
    """``file, run, entry``: the runs on each file's chain, and the offset at which the chain enters them."""
    runs = candidates.groupBy("file", "run").agg(F.min("start").alias("first"), F.max_by("next", "start").alias("next"))
    runs = stored(runs, "warc_runs")
    at = candidates.select("file", F.col("start").alias("next"), F.col("run").alias("to"))
    links = stored(runs.join(at, ["file", "next"]).select("file", "run", "to", "next"), "warc_links")
    reached = runs.where("run = 1").select("file", "run")
    jump = links.select("file", "run", "to")
    while not jump.isEmpty():  # after k rounds: all runs up to 2^k links from the start
        onward = reached.join(jump, ["file", "run"]).select("file", F.col("to").alias("run"))
        reached = stored(reached.unionByName(onward).distinct(), "warc_reached")
        more = jump.select("file", F.col("run").alias("to"), F.col("to").alias("beyond"))
        jump = stored(jump.join(more, ["file", "to"]).select("file", "run", F.col("beyond").alias("to")), "warc_jump")
    first = runs.where("run = 1").select("file", "run", F.col("first").alias("entry"))
    entered = links.join(reached, ["file", "run"]).select("file", F.col("to").alias("run"), F.col("next").alias("entry"))
    return first.unionByName(entered)


def _field(name: str) -> Column:
    found = F.regexp_extract("head", rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of all archives under a path: file, offset, header fields, and the payload's bytes.

    What stands before the first magic line of a file, or after a record that is cut short, is no record.
    """
    lines = spark.read.option("lineSep", MAGIC).text(path)
    lines = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").cast("binary").alias("bytes"),
        F.substring_index("value", END, 1).alias("head"),
    )
    segments = stored(lines.select("*", F.octet_length("bytes").alias("n")), "warc_segments", compression="zstd")
    candidates = stored(_candidates(segments), "warc_candidates")
    reached = _reached(candidates)
    marked = candidates.join(reached, ["file", "run"], "left")
    real = F.coalesce(F.col("start") >= F.col("entry"), F.lit(False))
    order = Window.partitionBy("file").orderBy("start")
    marked = marked.select(
        "file", "block", "place", "start",
        F.last(F.when(real, F.col("start")), True).over(order).alias("record"),
    )
    parts = F.count("*").over(Window.partitionBy("file", "record"))
    marked = sized(marked.where("record is not null").select("*", parts.alias("parts")), "warc_records")
    rows = segments.join(marked, ["file", "block", "place"])
    single = rows.where("parts = 1").select("file", "record", "head", "bytes")
    # magic inside a payload: its segments are one record again
    pieces = F.sort_array(F.collect_list(F.struct("start", "bytes", "head")))
    several = rows.where("parts > 1").groupBy("file", "record").agg(pieces.alias("p"))
    joined = F.aggregate(
        F.slice("p", 2, F.size("p")), F.get("p", F.lit(0))["bytes"],
        lambda a, x: F.concat(a, F.lit(MAGIC.encode()), x["bytes"]),
    )
    several = several.select("file", "record", F.get("p", F.lit(0))["head"].alias("head"), joined.alias("bytes"))
    whole = single.unionByName(several)
    length = _field("Content-Length").cast("int")
    payload = F.substring("bytes", F.octet_length("head") + len(END) + 1, length)
    return whole.select(
        "file",
        F.col("record").alias("offset"),
        _field("WARC-Type").alias("type"),
        _field("WARC-Record-ID").alias("record_id"),
        _field("WARC-Target-URI").alias("url"),
        _field("WARC-Payload-Digest").alias("digest"),
        _field("X-Page").cast("long").alias("page"),
        _field("X-Refers-To-Page").cast("long").alias("refers_to"),
        _field("X-Payload-Length").cast("long").alias("payload_length"),
        payload.alias("payload"),
    )


def archived(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST_REVISIT
) -> DataFrame:
    """What the archives of all rows hold, one row for each input row.

    A response's size and digest are those of the payload read back, a revisit's those its record names.
    Other columns are not read; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    path = workspace(spark, "warc")
    write_warc(pages, path, id_col, url_col, payload_col, least=least)
    rows = read_warc(spark, path)
    whole = F.col("type") == "response"
    return rows.select(
        F.col("page").alias(id_col),
        F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(whole, F.sha1("payload")).otherwise(F.substring_index("digest", ":", -1)).alias("payload_digest"),
        F.col("type").alias("record_type"),
        "refers_to",
    )
