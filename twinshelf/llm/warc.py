"""WARC files: written by Spark's text sink, read back by a verified chain of record boundaries.

**Writing.** A WARC record ends in two line breaks, so a text sink whose line separator is just
that writes records as rows: through Spark's committers, into any file system Spark knows, with
nothing on an executor's own disk. Payloads of ``least_bytes`` bytes or more that are equal (by
SHA-256) are written once, for the largest id; the others are ``revisit`` records that name it.
Groups are found on narrow rows, combined before the shuffle. Digests of more than a thousandth
of all rows, of which there are fewer than a thousand, are joined by broadcast, so a payload that
a third of the pages share makes no large task.

**Reading.** Files are split wherever Spark splits them. A task cuts its part at each magic
``WARC/1.`` and emits, for each one that heads a parsable record, a candidate: its place and the
place where by its own length the next record must begin, with the payload's length and SHA-1 but
not the payload. Places inside a part become places in the file by the lengths of the parts
before it. A magic inside a payload makes a false candidate, so only the chain that starts at the
file's first byte counts: pointer jumping doubles, round by round, the records known to be on it
and the length of every jump, and what it does not reach is dropped. Every chain must end
at the end of its file, or the file is refused by name.

A record whose payload holds a magic was cut there. Its pieces are read once more and put
together in order; they meet their record over stretches of ``STRETCH`` bytes that both name.

Cases: a null payload is empty; a null id is less than any other and is read back as null; rows
with equal id and payload are records of their own and all of one type; a null address is left
out; characters that would end or fake a header are written as %XX; an empty table gives no
record; other columns are ignored. Compressed files are read in one part. A header that holds the
magic itself, which no file written here has, is read unless a part ends inside it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import islice
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from twinshelf.llm.common import partitions, stored, table
from twinshelf.session import scratch_path

LEAST_BYTES = 1_000
MAGIC = b"WARC/1."
CRLF = "\r\n"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records and their later pieces meet over stretches of so many bytes of a file.
STRETCH = 1 << 16
#: A header longer than this is none.
LONGEST_HEADER = 1 << 20
#: Fixed values of the format: names of header fields, in lower case.
TYPE, LENGTH, RECORD, REFERS, PAGE = (
    "warc-type", "content-length", "warc-record-id", "warc-refers-to", "warc-page-id",
)
CANDIDATE = (
    "path string, part long, at long, end long, cut long, type string, record string, refers string,"
    " id string, payload_at long, n_bytes long, sha1 string"
)


def escaped(value: Column) -> Column:
    """Without what would end a header line, or look like the start of a record."""
    for raw, code in (("%", "%25"), ("\r", "%0D"), ("\n", "%0A"), (" ", "%20"), ("\t", "%09"), ("WARC/", "WARC%2F")):
        value = F.replace(value, F.lit(raw), F.lit(code))
    return value


def matched(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of their group; ``groups`` has one row for each key, ``n`` rows of it.

    Keys of more than a thousandth of all rows are fewer than a thousand, so they may be sent to
    every task; the rest make no large group and are joined by shuffle.
    """
    total = rows.count()
    hot = F.col("n") * 1_000 > total
    common, rare = F.broadcast(groups.filter(hot).drop("n")), groups.filter(~hot).drop("n")
    return rows.join(common, key).union(rows.join(common, key, "left_anti").join(rare, key))


def labelled(pages: DataFrame, id_col: str, payload_col: str, least_bytes: int) -> DataFrame:
    """``key`` and ``refers`` of each page whose payload another page stands for."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    narrow = pages.select(
        F.col(id_col).alias("id"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("n_bytes"),
    ).filter(F.col("n_bytes") >= least_bytes).select("digest", "id")
    narrow = stored(narrow, "payload-digests")
    groups = narrow.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("stays"))
    met = matched(narrow, stored(groups.filter("n > 1"), "payload-groups"), "digest")
    others = met.filter(~F.col("id").eqNullSafe(F.col("stays")))
    return others.select(page_key("id", "digest").alias("key"), page_key("stays", "digest").alias("refers")).distinct()


def page_key(row_id: str, digest: str) -> Column:
    """A name for a page: a hash of its id and its payload's digest, as 32 hex digits."""
    given = F.when(F.col(row_id).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col(row_id).cast("string")))
    return F.substring(F.sha2(F.concat(given, F.lit(" "), F.col(digest)), 256), 1, 32)


def urn(key: Column) -> Column:
    """A record's address: the key as a UUID."""
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(key, a, n) for a, n in cuts]), F.lit(">"))


def write_warc(
    pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least_bytes: int = LEAST_BYTES, date: str = DATE, content_type: str = "text/html; charset=utf-8",
) -> None:
    """Write each row of ``pages`` as a record of the WARC files in the folder ``path``."""
    refers = stored(labelled(pages, id_col, payload_col, least_bytes), "revisits")
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    rows = rows.withColumn("key", page_key("id", "digest")).join(refers, "key", "left")
    again = F.col("refers").isNotNull()

    def line(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit(CRLF))

    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}"), line("Content-Type", content_type),
        line("Content-Length", F.octet_length("payload").cast("string")), F.lit(CRLF),
    )
    block = F.concat("http", F.when(again, F.lit("")).otherwise(F.col("payload")))
    nothing = F.lit("")
    record = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("key"))),
        line("WARC-Date", date),
        F.when(F.col("url").isNull(), nothing).otherwise(line("WARC-Target-URI", escaped(F.col("url")))),
        F.when(F.col("id").isNull(), nothing).otherwise(line("WARC-Page-ID", escaped(F.col("id").cast("string")))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("payload"))),
        F.when(again, F.concat(line("WARC-Refers-To", urn(F.col("refers"))), line("WARC-Profile", PROFILE))).otherwise(nothing),
        line("Content-Type", "application/http; msgtype=response"),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit(CRLF),
        "block",
    )
    rows = rows.withColumn("http", http).withColumn("block", block)
    rows.select(record.alias("value")).write.option("lineSep", CRLF * 2).text(path)


def chunks(spark: SparkSession, path: str) -> DataFrame:
    """The bytes between the magics of the files in ``path``, and the part each lies in."""
    lines = spark.read.option("lineSep", MAGIC.decode()).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("part"),
        F.col("value").cast("binary").alias("value"),
    )


def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """Path, part, place in the part and bytes of each chunk; parts come one after the other."""
    here, at = None, 0
    for batch in batches:
        for path, part, value in zip(*(c.to_pylist() for c in batch.columns[:2]), batch.column(2)):
            if (path, part) != here:
                here, at = (path, part), 0
            data = value.as_py()
            yield path, part, at, data
            at += len(data) + len(MAGIC)


def parsed(header: bytes) -> dict[str, str] | None:
    """The named fields of a record's header, or None if it is none; the magic is cut off."""
    lines = header.split(b"\r\n")
    if not lines[0].isdigit():
        return None
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return fields if fields.get(LENGTH, "").isdigit() else None


def payload_start(block: bytes, fields: dict[str, str]) -> int:
    """Where the payload begins in a block: after the HTTP header, where there is one."""
    if not fields.get("content-type", "").startswith("application/http"):
        return 0
    end = block.find(b"\r\n\r\n")
    return end + 4 if end >= 0 else 0


def candidate(data: bytes, at: int, cut: int) -> list | None:
    """(at, end, cut, type, record, refers, id, payload_at, n_bytes, sha1) of a possible record.

    ``data`` follows the magic at ``at``, and another magic follows at ``cut``. A payload that goes
    beyond ``cut`` has no digest yet.
    """
    stop = data.find(b"\r\n\r\n")
    fields = parsed(data[:stop]) if stop >= 0 else None
    if fields is None:
        return None
    begin, size = stop + 4, int(fields[LENGTH])
    block = data[begin : begin + size]
    skip = payload_start(block, fields)
    end = at + len(MAGIC) + begin + size + 4
    n_bytes, digest = size - skip, hashlib.sha1(block[skip:]).hexdigest()
    if len(block) < size:
        digest = None
    page = fields.get(PAGE)
    return [at, end, cut, fields.get(TYPE), fields.get(RECORD), fields.get(REFERS),
            None if page is None else unquote_to_bytes(page).decode("utf-8", "replace"),
            at + len(MAGIC) + begin + skip, n_bytes, digest]


def found_in(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    """Candidates of the chunks, and for each part a row with its length as ``end``."""
    held: tuple | None = None  # path, part, place of the magic, what follows it
    here, size = None, 0

    def flush() -> Iterator[list]:
        if held and (row := candidate(held[3], held[2], held[2] + len(MAGIC) + len(held[3]))):
            yield [*held[:2], *row]

    for path, part, at, data in placed(batches):
        if (path, part) != here:
            yield from flush()
            if here:
                yield [*here, None, size, *[None] * 8]
            held, here = None, (path, part)
        size = at + len(data) + len(MAGIC)
        if held and b"\r\n\r\n" not in held[3] and len(held[3]) < LONGEST_HEADER:
            held = (path, part, held[2], held[3] + MAGIC + data)  # a magic inside a header
            continue
        yield from flush()
        # no magic stands before what a file begins with
        held = (path, part, at - len(MAGIC), data) if part or at else None
    yield from flush()
    if here:
        yield [*here, None, size, *[None] * 8]


def candidates(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Every possible record of the files, by its place in its file, and the files' parts:
    ``path``, ``part``, ``base`` (where it starts) and ``file_end``."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), *[pa.int64()] * 4, *[pa.string()] * 4, *[pa.int64()] * 2, pa.string()]
        names = [field.split()[0] for field in CANDIDATE.split(",")]
        for rows in some(found_in(batches), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    rows = stored(chunks(spark, path).mapInArrow(find, CANDIDATE), "warc-candidates")
    by_file = Window.partitionBy("path")
    ahead = by_file.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.filter("at IS NULL").select(
        "path", "part", F.coalesce(F.sum("end").over(ahead), F.lit(0)).alias("base"),
        # every chunk but a file's last is followed by a magic
        (F.sum("end").over(by_file) - len(MAGIC)).alias("file_end"),
    )
    parts = stored(parts, "warc-parts")
    moved = {c: F.col(c) + F.col("base") for c in ("at", "end", "cut", "payload_at")}
    whole = rows.filter("at IS NOT NULL").join(parts, ["path", "part"]).withColumns(moved)
    return stored(whole.filter("at >= 0").drop("part", "base"), "warc-places"), parts


def some(rows: Iterator[list], n: int) -> Iterator[list[list]]:
    while held := list(islice(rows, n)):
        yield held


def reached(places: DataFrame) -> DataFrame:
    """``path`` and ``at`` of the records that a chain from the start of their file leads to.

    After round i, the first 2^i records of each file are known and every jump skips as many.
    """
    starts = places.select("path", "at")
    jumps = stored(
        places.select("path", "at", F.col("end").alias("to")).join(
            starts.withColumnRenamed("at", "to"), ["path", "to"], "left_semi"
        ).select("path", "at", "to"),
        "warc-jumps",
    )
    known = stored(starts.filter("at = 0"), "warc-known")
    while True:
        new = stored(known.join(jumps, ["path", "at"]).select("path", F.col("to").alias("at")), "warc-known")
        if new.isEmpty():
            return known
        known = known.union(new)
        further = jumps.select("path", F.col("at").alias("to"), F.col("to").alias("then"))
        jumps = stored(jumps.join(further, ["path", "to"]).select("path", "at", F.col("then").alias("to")), "warc-jumps")


def chained(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The records of all files in ``path``, and the files' parts; a file with a gap is refused."""
    places, parts = candidates(spark, path)
    records = stored(places.join(reached(places), ["path", "at"], "left_semi"), "warc-records")
    ended = records.filter("end = file_end").select("path")
    torn = parts.filter("file_end > 0").select("path").distinct().join(ended, "path", "left_anti").take(3)
    if torn:
        raise ValueError(f"records do not lead to the end of {', '.join(r.path for r in torn)}")
    return records.drop("file_end"), parts


def assembled(spark: SparkSession, path: str, wanted: DataFrame, parts: DataFrame, payload: bool) -> DataFrame:
    """``path``, ``at`` and ``sha1`` or, if asked for, ``payload`` of the records ``wanted``, read once more.

    Pieces of a record come to one task in order; without payloads only one is held at a time.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in some(placed(batches), 200):
            columns = list(zip(*((p, q, at - len(MAGIC), MAGIC + data) for p, q, at, data in rows)))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "part", "piece_at", "data"]
            )

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, digest, held, done = None, None, [], []

        def out() -> pa.RecordBatch:
            columns = list(zip(*done)) or [()] * 3
            kinds = [pa.string(), pa.int64(), pa.binary() if payload else pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "at", "made"]
            )

        for batch in batches:
            for name, at, start, n_bytes, piece_at, data in zip(*(c.to_pylist() for c in batch.columns)):
                if (name, at) != here:
                    if here:
                        done.append((*here, b"".join(held) if payload else digest.hexdigest()))
                    here, digest, held = (name, at), hashlib.sha1(), []
                part = data[max(start - piece_at, 0) : max(start + n_bytes - piece_at, 0)]
                if payload:
                    held.append(part)
                else:
                    digest.update(part)
            yield out()
            done = []
        if here:
            done.append((*here, b"".join(held) if payload else digest.hexdigest()))
            yield out()

    read = chunks(spark, path).mapInArrow(pieces, "path string, part long, piece_at long, data binary")
    read = read.join(parts.select("path", "part", "base"), ["path", "part"])
    read = read.withColumn("piece_at", F.col("piece_at") + F.col("base"))
    read = read.withColumn("stretch", F.floor(F.col("piece_at") / STRETCH))
    asked = wanted.select("path", "at", "end", "payload_at", "n_bytes").withColumn(
        "stretch", F.explode(F.sequence(F.floor(F.col("at") / STRETCH), F.floor((F.col("end") - 1) / STRETCH)))
    )
    met = read.join(asked, ["path", "stretch"]).filter("piece_at >= at AND piece_at < end")
    met = met.select("path", "at", "payload_at", "n_bytes", "piece_at", "data")
    met = met.repartition(partitions(spark), "path", "at").sortWithinPartitions("path", "at", "piece_at")
    made = met.mapInArrow(put_together, f"path string, at long, made {'binary' if payload else 'string'}")
    return made.withColumnRenamed("made", "payload" if payload else "sha1")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of the WARC files in ``path``: ``path``, ``at``, ``end``, ``type``, ``record``,
    ``refers``, ``id``, ``payload_at``, ``n_bytes`` and the ``sha1`` of the payload in the file."""
    records, parts = chained(spark, path)
    columns = ["path", "at", "end", "type", "record", "refers", "id", "payload_at", "n_bytes", "sha1"]
    cut = records.filter("sha1 IS NULL")
    if cut.isEmpty():
        return records.select(*columns)
    made = stored(assembled(spark, path, cut, parts, payload=False), "warc-assembled")
    mended = cut.drop("sha1").join(made, ["path", "at"]).select(*columns)
    return records.filter("sha1 IS NOT NULL").select(*columns).union(mended)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The records of the WARC files in ``path`` with their ``payload`` (bytes), false starts left out."""
    records, parts = chained(spark, path)
    made = assembled(spark, path, records, parts, payload=True)
    return records.select("path", "at", "type", "record", "refers", "id").join(made, ["path", "at"])


def resolved(records: DataFrame) -> DataFrame:
    """``id``, ``n_bytes``, ``sha1``, ``type`` and ``refers_to``; a revisit has those of the payload that it
    refers to, null if that is in no file."""
    first = records.filter("type = 'response'").groupBy(F.col("record").alias("refers")).agg(
        F.min(F.struct("id", "n_bytes", "sha1")).alias("first")
    )
    again = records.filter("type = 'revisit'").select("refers", "id")
    sizes = again.groupBy("refers").agg(F.count(F.lit(1)).alias("n")).join(first, "refers", "left")
    met = matched(again, stored(sizes, "warc-referred"), "refers")
    return records.filter("type = 'response'").select(
        "id", "n_bytes", "sha1", "type", F.lit(None).cast("string").alias("refers_to")
    ).union(met.select("id", "first.n_bytes", "first.sha1", F.lit("revisit"), F.col("first.id")))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back from the files."""
    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    found = resolved(stored(read_records(spark, path), "warc-read"))
    return found.select(
        F.col("id").cast("long").alias("page_id"), F.col("n_bytes").alias("payload_bytes"),
        F.col("sha1").alias("payload_digest"), F.col("type").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"),
    )


QUERIES: list[Callable] = [op13_warc]

ORACLES = {
    "op13_warc": """
        WITH p AS (
          SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages
        ), g AS (
          SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
                 CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS stays
          FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = stays THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> stays THEN stays END AS refers_to
        FROM g
    """,
}
