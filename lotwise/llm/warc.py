"""WARC archives: a writer with identical-payload revisits, and a reader that proves each record boundary.

Both are DataFrame operations: Spark's text sink ends each record by the format's blank lines, and its text source cuts
archives at the magic line, so a file of any size is read in splits by many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Staged

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2026-01-01T00:00:00Z"
#: Groups of equal payloads (some 100 bytes each) that are broadcast at most; with more, pages are shuffled to them.
MAX_BROADCAST_GROUPS = 500_000


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 15 hexadecimal digits are 12 digits of base 32."""
    h = F.sha1(payload)
    digits = F.concat(*[F.lpad(F.conv(F.substring(h, at, n), 16, 32), n * 4 // 5, "0") for at, n in ((1, 15), (16, 15), (31, 10))])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """(page_id, record): the text of each page's record without the blank lines that end it.

    Of pages with equal payloads of at least `min_revisit_bytes` bytes the one with the smallest page_id is a response and
    the others are revisits of it, without a payload of their own. Null html is an empty payload and a null url an empty
    one; rows that repeat the smallest page_id are responses too; a null page_id never is the smallest where there is
    another. Groups are found from digests with partial sums; only groups of several pages are joined back."""
    staged = Staged(pages.sparkSession, "warc")
    full = pages.select("page_id", F.regexp_replace(F.coalesce("url", F.lit("")), "[\r\n]", "").alias("url"), F.coalesce("html", F.lit("")).alias("payload"))
    full = full.withColumns({"bytes": F.octet_length("payload"), "digest": base32_sha1(F.col("payload"))})
    groups = full.filter(F.col("bytes") >= min_revisit_bytes).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
    first = staged.write("first", groups.filter("copies > 1 and first_id is not null").select("digest", "first_id"))
    small = first.count() <= MAX_BROADCAST_GROUPS
    joined = full.join(F.broadcast(first) if small else first.hint("merge"), "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "),
        F.when(revisit, F.lit("revisit\r\nWARC-Profile: " + PROFILE + "\r\nWARC-Refers-To: ")).otherwise(F.lit("response\r\n")),
        F.when(revisit, urn(F.col("first_id"))).otherwise(F.lit("")),
        F.lit("WARC-Record-ID: "), urn(F.col("page_id")),
        F.lit("WARC-Target-URI: "), F.col("url"),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END),
    )
    return joined.select("page_id", F.concat(head, block).alias("record"))


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = 0) -> None:
    """One archive for each partition."""
    records(pages, min_revisit_bytes).select("record").write.option("lineSep", END).text(path)


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """What lies between occurrences of the magic line, with each chunk's file and split, numbered in a row inside a split."""
    raw = spark.read.option("lineSep", MAGIC).text(path)
    return raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("nth"))


def _placed(chunks: DataFrame) -> DataFrame:
    """Chunks with their `place` in the split, from 1; payloads are not shuffled for it."""
    first = chunks.groupBy("file", "split").agg(F.min("nth").alias("first"))
    return chunks.join(first, ["file", "split"]).withColumn("place", F.col("nth") - F.col("first") + 1).drop("nth", "first")


def _with_offsets(chunks: DataFrame, staged: Staged) -> DataFrame:
    """Chunks (file, split, place, bytes) with `offset`, where the magic line before each stands. Nothing stands before a
    file's first chunk, which is dropped.

    Sums run inside splits, and over the splits of a file, which are a row each."""
    ends = [F.count("*").alias("chunks"), F.sum("bytes").alias("size")]
    sizes = staged.write("splits", chunks.groupBy("file", "split").agg(*ends))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    sums = sizes.select("file", "split", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("chunks", "size")])
    inside = Window.partitionBy("file", "split").orderBy("place")
    placed = chunks.withColumn("inside", F.sum("bytes").over(inside) - F.col("bytes")).join(sums, ["file", "split"])
    nth = F.col("chunks_before") + F.col("place")
    offset = F.col("size_before") + F.col("inside") + (nth - 2) * len(MAGIC)
    return placed.filter(nth > 1).withColumn("offset", offset).drop("inside", "chunks_before", "size_before")


def _field(head: Column, name: str, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(head, rf"(?:^|\r\n){name}: *{pattern}", 1), F.lit(""))


def _parsed(df: DataFrame) -> DataFrame:
    """Record fields of chunks. Where a chunk is exactly one record, its payload's size and digest are measured."""
    head = F.substring_index("value", END, 1)
    df = df.withColumns({"bytes": F.octet_length("value").cast("long"), "head": head})
    df = df.withColumns({"head_bytes": F.octet_length("head").cast("long"), "length": F.expr("try_cast(regexp_extract(head, '(?:^|\\r\\n)Content-Length: *([0-9]+)', 1) as bigint)")})
    whole = F.col("bytes") == F.col("head_bytes") + F.col("length") + 2 * len(END)
    block = F.expr(f"substring(value, length(head) + {len(END) + 1}, length(value) - length(head) - {2 * len(END)})")
    df = df.withColumn("block", F.when(whole, block)).withColumn("http", F.substring_index("block", END, 1))
    payload = F.expr(f"substring(block, length(http) + {len(END) + 1})")
    page = lambda name: F.expr(f"try_cast(regexp_extract(head, '(?:^|\\r\\n){name}: *<urn:page:([0-9-]*)>', 1) as bigint)")
    return df.select(
        *[c for c in df.columns if c not in ("value", "head", "block", "http")],
        whole.alias("whole"),
        page("WARC-Record-ID").alias("page_id"),
        _field(F.col("head"), "WARC-Type", "([a-z]+)").alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"),
        _field(F.col("head"), "WARC-Payload-Digest", "sha1:([A-Z2-7]+)").alias("declared_digest"),
        F.expr("try_cast(regexp_extract(http, '(?:^|\\r\\n)Content-Length: *([0-9]+)', 1) as bigint)").alias("declared_bytes"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.when(whole, base32_sha1(payload)).alias("payload_digest"),
    )


def reachable(links: DataFrame, staged: Staged) -> DataFrame:
    """(file, node) of all nodes that the chain from node 0 of each file reaches, by pointer jumping over (file, node, next):
    each round doubles the length of every pointer, and with it the part of the chain that is known."""
    found = links.filter("node = 0").select("file", "node")
    known, jumps = -1, links
    for k in range(64):
        found = staged.write(f"found{k}", found)
        if (n := found.count()) == known:
            break
        known = n
        ahead = found.join(jumps, ["file", "node"]).select("file", F.col("next").alias("node"))
        found = found.unionByName(ahead).distinct()
        far = jumps.select("file", F.col("node").alias("next"), F.col("next").alias("beyond"))
        jumps = staged.write(f"jumps{k}", jumps.join(far, ["file", "next"]).select("file", "node", F.col("beyond").alias("next")))
    return found


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, page_id, record_type, refers_to, payload_bytes, payload_digest) of every record that the chain of
    lengths from its file's start reaches.

    Tasks cut the archives at the magic line and emit candidates: where each begins and, by its own Content-Length, where
    its successor begins. Inside each split of a file, candidates that follow each other without a gap are one node, so an
    archive of any size has a node for each split and for each break; pointer jumping over the nodes, across the splits,
    keeps what is reachable from the file's start, so magic lines inside payloads, whole records among them, are rejected.
    A record whose payload holds magic lines is put together from its chunks again. Sizes and digests of responses are
    measured on the payload read; those of revisits are the ones that the record declares.

    A last record that is cut short or followed by other bytes keeps its row, with null size and digest. An empty folder
    and a file with no record at its start give no rows. Null and repeated page ids and urls are read as they were written."""
    staged = Staged(spark, "warc-read")
    parsed = staged.write("parsed", _parsed(_chunks(spark, path)))
    candidates = staged.write("candidates", _with_offsets(_placed(parsed), staged))
    order = Window.partitionBy("file", "split").orderBy("offset")
    successor = F.col("offset") + len(MAGIC) + F.col("head_bytes") + F.col("length") + 2 * len(END)
    linked = candidates.select("file", "split", "offset", successor.alias("successor"))
    linked = linked.withColumn("follows", F.coalesce(F.lag("successor").over(order) == F.col("offset"), F.lit(False)))
    linked = linked.withColumn("steady", F.coalesce(F.lead("offset").over(order) == F.col("successor"), F.lit(False)))
    landings = linked.filter("not steady and successor is not null").select("file", F.col("successor").alias("offset"), F.lit(True).alias("landing")).distinct()
    linked = linked.join(landings, ["file", "offset"], "left")
    new_run = F.when(F.col("follows") & F.col("landing").isNull(), 0).otherwise(1)
    runs = staged.write("runs", linked.withColumn("run", F.sum(new_run).over(order)).select("file", "split", "offset", "successor", "run"))
    heads = staged.write("heads", runs.groupBy("file", "split", "run").agg(F.min("offset").alias("node"), F.coalesce(F.max_by("successor", "offset"), F.lit(-1)).alias("next")))
    good = reachable(staged.write("links", heads.select("file", "node", "next")), staged)
    reached_runs = staged.write("reached", heads.join(good, ["file", "node"]).select("file", "split", "run", F.lit(True).alias("reached")))
    kept = staged.write("kept", runs.join(reached_runs, ["file", "split", "run"], "left").select("file", "offset", F.coalesce("reached", F.lit(False)).alias("kept")))
    marked = staged.write("marked", candidates.join(kept.hint("merge"), ["file", "offset"]))
    named = ["file", "offset", "page_id", "record_type", "refers_to", "declared_bytes", "payload_bytes", "declared_digest", "payload_digest"]
    single = marked.filter("kept and whole").select(*named)

    # Of each chunk the record that it belongs to: the last kept one, in its split or else in the splits before.
    own = F.when(F.col("kept"), F.col("offset"))
    last = marked.groupBy("file", "split").agg(F.max(own).alias("last"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("file", "split", F.max("last").over(before).alias("carried"))
    owner = F.coalesce(F.max(own).over(order.rowsBetween(Window.unboundedPreceding, 0)), "carried")
    parts = marked.select("file", "split", "place", "offset", "kept").join(carried, ["file", "split"]).withColumn("owner", owner)
    broken = marked.filter("kept and not whole").select("file", F.col("offset").alias("owner"))
    pieces = staged.write("pieces", parts.join(broken, ["file", "owner"], "left_semi").select("file", "split", "place", "offset", "owner"))
    torn = staged.write("torn", pieces.select("file", "split").distinct())
    again = _placed(_chunks(spark, path).join(torn, ["file", "split"], "left_semi")).join(pieces, ["file", "split", "place"])
    ordered = F.sort_array(F.collect_list(F.struct("offset", "value")))
    whole = again.groupBy("file", F.col("owner").alias("offset")).agg(F.array_join(F.transform(ordered, lambda x: x["value"]), MAGIC).alias("value"))
    several = _parsed(whole).select(*named)
    is_revisit = F.col("record_type") == "revisit"
    out = single.unionByName(several).select(
        "file", "offset", "page_id", "record_type", "refers_to",
        F.when(is_revisit, F.col("declared_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(is_revisit, F.col("declared_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
    )
    out = staged.write("result", out)
    staged.drop(*[name for name in staged.paths if name != "result"])
    return out
