"""Web archives: written record by record, read back by boundary-chain verification.

Writing uses the text sink with the record terminator as line separator, so every task writes valid
archive files wherever the file system is. Reading splits the files at the record magic by byte
ranges. A piece after a magic is only a candidate: tasks emit its offset and the offset its declared
length leads to. Records that fill their pieces follow each other in a run; pointer jumping over the
other records, from the start of each file, marks what is reachable. A magic inside a payload is
never reached, and the pieces it cut are joined to their record again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakeops.llm.common import discard, query, stored, table
from lakeops.session import scratch_path

# Fixed values of the archive format.
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
BASE32HEX, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(text: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a text in UTF-8: eight groups of 20 bits."""
    digest = F.sha1(text)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), BASE32HEX, BASE32)


def _print(payload: Column) -> Column:
    return F.concat(F.sha2(payload, 256), F.lit("-"), F.octet_length(payload).cast("string"))


def revisits(pages: DataFrame, key: str = "page_id", payload: str = "html", min_bytes: int = 0) -> DataFrame:
    """(page_id, print, refers_to) of the rows that repeat the payload of a larger key.

    Payloads are equal when their SHA-256 and length are. Those under ``min_bytes`` never refer.
    """
    whole = F.coalesce(F.col(payload), F.lit(""))
    prints = pages.filter(F.octet_length(whole) >= min_bytes).select(F.col(key).cast("long").alias("page_id"), _print(whole).alias("print"))
    prints = stored(prints, "prints")
    shared = prints.groupBy("print").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies"))
    pairs = prints.join(shared.filter("copies > 1"), "print")
    return stored(pairs.filter("page_id <> refers_to").select("page_id", "print", "refers_to").distinct(), "revisits")


def write_warc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0) -> None:
    """One record per row: the payload as a response, or a revisit that names the response it repeats.

    A null payload is empty, a null url an empty target, a row with a null key always a response.
    Rows that repeat key and payload are of one kind. Line ends inside a url become %0D and %0A.
    Other columns are ignored.
    """
    again = revisits(pages, key, payload, min_bytes)
    target = F.coalesce(F.col(url).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.replace(F.replace(target, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("url"),
        F.coalesce(F.col(payload), F.lit("")).alias("payload"),
    )
    rows = rows.withColumn("print", _print(F.col("payload"))).join(again, ["page_id", "print"], "left")
    repeats = F.col("refers_to").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda column: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))
    record = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(repeats, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn("page_id")),
        line("WARC-Target-URI", F.col("url")),
        F.when(repeats, line("WARC-Refers-To", urn("refers_to"))).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))),
        line("Content-Length", F.when(repeats, F.lit("0")).otherwise(F.octet_length("payload").cast("string"))),
        F.lit("\r\n"),
        F.when(repeats, F.lit("")).otherwise(F.col("payload")),
    )
    rows.select(record.alias("value")).write.option("lineSep", END).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Every piece of the archives between two magics, in the byte range where it starts."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"),
        F.octet_length("value").cast("long").alias("n_bytes"),
        F.col("value").cast("binary").alias("piece"),
        F.substring_index("value", END, 1).alias("head"),
    )


def _headed(pieces: DataFrame) -> DataFrame:
    """Header fields; whole: the declared payload and the record end lie inside the piece."""
    field = lambda name: F.regexp_extract("head", rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    head_bytes = F.octet_length("head").cast("long")
    declared = field("Content-Length")
    shaped = (head_bytes + len(END) <= F.col("n_bytes")) & declared.rlike("^[0-9]{1,18}$")
    return (
        pieces.withColumn("length", F.when(shaped, declared.cast("long")))
        .withColumn("body_at", head_bytes + len(END))
        .withColumn("whole", F.coalesce(F.col("n_bytes") >= F.col("body_at") + F.col("length") + len(END), F.lit(False)))
        .withColumns({
            "kind": field("WARC-Type"),
            "record_id": field("WARC-Record-ID"),
            "url": field("WARC-Target-URI"),
            "refers": field("WARC-Refers-To"),
            "declared_digest": F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", ""),
        })
    )


def _part(piece: str, start: str, length: str) -> Column:
    return F.expr(f"substring({piece}, CAST({start} + 1 AS INT), CAST({length} AS INT))")


def _placed(pieces: DataFrame) -> DataFrame:
    """Adds at: the offset of the magic before the piece (-10 for what precedes the first one); and run: the
    pieces before it in the file that no record fills, if there is a column filled.

    Running sums of piece lengths: by order inside a byte range, over the totals of the ranges before.
    """
    sums = {"at": F.col("n_bytes") + len(MAGIC)}
    if "filled" in pieces.columns:
        sums["run"] = F.when(F.col("filled"), 0).otherwise(1).cast("long")
    totals = pieces.groupBy("file", "block").agg(*[F.sum(step).alias(name) for name, step in sums.items()])
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file", "block", *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"{name}_start") for name in sums])
    inside = Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumns({name: F.coalesce(F.sum(step).over(inside), F.lit(0)) for name, step in sums.items()}).join(starts, ["file", "block"])
    placed = placed.withColumns({name: F.col(name) + F.col(f"{name}_start") for name in sums}).withColumn("at", F.col("at") - len(MAGIC))
    return placed.drop(*[f"{name}_start" for name in sums])


def reachable(links: DataFrame) -> DataFrame:
    """(file, at) reachable from offset 0 of each file over (file, at, goes_to), by pointer jumping.

    Each round follows jumps twice as long from all that is reached, so the rounds are the logarithm
    of the records in the longest file.
    """
    known = links.select("file", "at")
    onto = known.withColumnRenamed("at", "goes_to")
    jumps = stored(links.select("file", "at", "goes_to").join(onto, ["file", "goes_to"], "left_semi"), "jumps")
    reached = stored(known.filter("at = 0"), "reached")
    while not jumps.isEmpty():
        step = reached.join(jumps, ["file", "at"]).select("file", F.col("goes_to").alias("at"))
        onward = jumps.select("file", F.col("at").alias("goes_to"), F.col("goes_to").alias("then"))
        longer = jumps.join(onward, ["file", "goes_to"]).select("file", "at", F.col("then").alias("goes_to"))
        wider, longer = stored(reached.unionAll(step).distinct(), "reached"), stored(longer, "jumps")
        discard(reached)
        discard(jumps)
        reached, jumps = wider, longer
    return reached


def chained(found: DataFrame) -> DataFrame:
    """The rows (file, at, run, filled, length, goes_to, ...) that the chain from offset 0 of each file reaches.

    A filled piece leads to the next one, so a chain that enters a run goes on to its end. Only entries are
    followed by pointer jumping: offset 0, and where pieces that are not filled lead to. A run is entered once.
    """
    candidates = found.filter("length IS NOT NULL")
    exits = stored(candidates.filter("NOT filled").select("file", "run", "goes_to"), "exits")
    entries = found.filter("at = 0").select("file", "run", "at", "length")
    if not exits.isEmpty():
        led = exits.select("file", F.col("goes_to").alias("at")).distinct()
        entries = entries.unionAll(found.join(led, ["file", "at"], "left_semi").filter("at <> 0").select("file", "run", "at", "length"))
    entries = entries.filter("length IS NOT NULL").join(exits, ["file", "run"], "left").select("file", "run", "at", "goes_to")
    entries = stored(entries, "entries")
    entered = entries.join(reachable(entries), ["file", "at"]).select("file", "run", F.col("at").alias("entry"))
    return candidates.join(entered, ["file", "run"]).filter("at >= entry").drop("entry")


HEADER = ("kind", "record_id", "url", "refers", "declared_digest")


def read_warc(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of the archives under a path: file, at, kind, record_id, url, refers, declared_digest,
    payload_bytes, payload_digest and, if asked for, payload.

    Only pieces the chain reaches are records. Digests of records that lie in one piece are taken
    where the piece is read; files with a record that a magic cuts in pieces are read a second time
    and its pieces joined. Unknown headers are ignored; archives without records give no rows.
    """
    head = _headed(_pieces(spark, path))
    body = F.when(F.col("whole"), _part("piece", "body_at", "length"))
    ends = F.col("body_at") + F.col("length") + len(END)
    filled = F.coalesce(ends == F.col("n_bytes"), F.lit(False)).alias("filled")
    light = head.select("file", "block", "n", "n_bytes", "body_at", "length", "whole", filled, *HEADER, base32_sha1(body).alias("payload_digest"))
    found = stored(_placed(stored(light, "pieces")), "candidates")
    reached = chained(found.withColumn("goes_to", F.col("at") + len(MAGIC) + ends)).drop("run", "filled", "goes_to")
    records = stored(reached.withColumnRenamed("length", "payload_bytes"), "records")
    keep = ("file", "at", *HEADER, "payload_bytes", "payload_digest")
    cut = records.filter("NOT whole")
    if not payloads and cut.isEmpty():
        return records.select(*keep)
    again = records if payloads else cut
    texts = _placed(_pieces(spark, path).join(again.select("file").distinct(), "file", "left_semi"))
    starts = records.select(F.col("file").alias("in_file"), F.col("at").alias("record_at"), F.struct("body_at", "payload_bytes", "whole").alias("r"))
    marked = texts.join(starts, (F.col("file") == F.col("in_file")) & (F.col("at") == F.col("record_at")), "left")
    owner = F.last(F.when(F.col("r").isNotNull(), F.struct("record_at", "r")), ignorenulls=True)
    owned = marked.withColumn("o", owner.over(Window.partitionBy("file").orderBy("at"))).filter("o IS NOT NULL")
    if not payloads:
        owned = owned.filter("NOT o.r.whole")
    joined = owned.groupBy("file", F.col("o.record_at").alias("at"), F.col("o.r.body_at").alias("body_at"), F.col("o.r.payload_bytes").alias("length")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("at").alias("piece_at"), "piece"))).alias("pieces")
    )
    # The last piece ends before the next magic, the others are followed by the magic that cut them.
    whole = F.expr(f"aggregate(pieces, CAST('' AS BINARY), (a, p) -> concat(a, IF(length(a) = 0, CAST('' AS BINARY), CAST('{MAGIC[:-2]}' AS BINARY) || unhex('0D0A')), p.piece))")
    bodies = joined.withColumn("whole_piece", whole).select("file", "at", _part("whole_piece", "body_at", "length").alias("body"))
    bodies = bodies.select("file", "at", F.col("body").cast("string").alias("payload"), base32_sha1(F.col("body")).alias("body_digest"))
    out = records.join(bodies, ["file", "at"], "left").withColumn("payload_digest", F.coalesce("payload_digest", "body_digest"))
    return out.select(*keep, *["payload"] * payloads)


def archived(pages: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Write the pages, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Size and digest of a revisit are those of the response it names, as read from the archive.
    """
    spark = pages.sparkSession
    write_warc(pages, path, min_bytes=min_bytes)
    records = read_warc(spark, path)
    responses = records.filter("kind = 'response'").select(
        F.col("record_id").alias("refers"), F.col("payload_digest").alias("declared_digest"), F.col("payload_bytes").alias("full_bytes")
    ).distinct()
    number = lambda column: F.regexp_extract(column, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    joined = records.join(responses, ["refers", "declared_digest"], "left")
    again = F.col("kind") == "revisit"
    return joined.select(
        number("record_id").alias("page_id"),
        F.when(again, F.col("full_bytes")).otherwise(F.col("payload_bytes")).cast("long").alias("payload_bytes"),
        F.when(again, F.col("declared_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        number("refers").alias("refers_to"),
    )


@query("op10_warc")
def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archived(table(spark, folder, "pages"), scratch_path(spark, "warc"))
