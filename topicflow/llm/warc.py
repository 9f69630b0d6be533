"""WARC archives, written by Spark's text writer and read back by verified boundaries.

Reading cannot trust the magic at a record's start, as a payload may hold it too.  Spark
splits the archives at every occurrence, so each piece but a file's first is a candidate
record.  A candidate's header says how long it is, and so where its successor starts.
Real records are those reached from the file's start by going from record to successor.

The archives are read once, into a table of candidates: how Spark cuts them may change from one
reading to the next.  Each split resolves its own candidates: for each one, where its chain leaves the split.
What remains is one pointer for each place where a split can be entered.  Pointer jumping
over these marks the places reached from the files' starts: each round doubles how far a
pointer goes, so a file of n splits takes log2(n) rounds.  Then each split walks its chain
from its entry.  Chains that end anywhere but at the end of their file are an error.

A record whose payload holds the magic is put together from its pieces; all others are
one piece and never leave the task that reads them unless their content is asked for.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from topicflow.llm.common import utf8, written

VERSION = "1.1"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: About as much as a record's headers take.
HEADER_BYTES = 700
# Fixed value: the letters of base32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


# --- writing ----------------------------------------------------------------------


def base32(sha1: Column) -> Column:
    """A SHA-1 in hexadecimal digits as 32 letters."""
    digits = F.upper(sha1)
    letters = []
    for at in range(0, 40, 5):  # five hexadecimal digits are four letters
        bits = F.conv(F.substring(digits, at + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*letters)


def _uuid(*parts: Column) -> Column:
    digits = F.md5(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(digits, a, n) for a, n in cuts]), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for null; line ends in the value are escaped."""
    value = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def records(
    df: DataFrame,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str = "2020-01-01T00:00:00Z",
    min_revisit_bytes: int = 0,
) -> DataFrame:
    """The text of a WARC record for each row, as column ``record``.

    Of the rows with equal payloads of at least ``min_revisit_bytes`` those with the largest
    id are responses (rows that repeat it too) and the others revisit them.  Null ids are
    smaller than all others; a null payload is empty; a null URL is left out.
    """
    rows = df.select(
        F.col(id).cast("long").alias("id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
    ).withColumn("sha1", F.sha1(utf8("html")))
    # only digests that several rows have are joined; Spark broadcasts them if they are few and else splits the skewed side
    copies = rows.groupBy("sha1").agg(F.max("id").alias("latest"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = written(copies.select("sha1", "latest"), "copies")
    joined = rows.join(copies, "sha1", "left").withColumn("digest", base32(F.col("sha1")))
    size = F.octet_length("html").cast("long")
    revisit = (size >= min_revisit_bytes) & F.col("latest").isNotNull() & ~F.col("id").eqNullSafe(F.col("latest"))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"), F.lit(END)
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    refers = F.when(revisit, F.col("latest"))

    def name(which: Column) -> Column:
        return _uuid(which.cast("string"), F.col("digest"))

    header = F.concat(
        F.lit(f"WARC/{VERSION}\r\n"),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", F.when(revisit, _uuid(F.lit("revisit"), F.col("id").cast("string"), F.col("digest"))).otherwise(name(F.col("id")))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("WARC-Refers-To", F.when(revisit, name(refers))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("X-Page-ID", F.col("id").cast("string")),
        _line("X-Refers-To-Page-ID", refers.cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return joined.select(F.concat(header, block).alias("record"))


def split_bytes(spark: SparkSession) -> int:
    """The size of the splits in which Spark reads large files."""
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", spark.conf.get("spark.sql.files.maxPartitionBytes").lower()).groups()
    return int(number) << 10 * " kmgt".index(unit or " ")


def write_archives(records: DataFrame, path: str, compression: str = "none", archives: int | None = None) -> None:
    """Write the column ``record`` as archives, one for each partition or at most ``archives`` of them.

    ``none`` leaves archives that are read in splits; a ``gzip`` archive takes a quarter of
    the room and is read by one task, so it wants partitions of no more than a task's size.
    """
    rows = records.select("record")
    rows = rows.coalesce(archives) if archives else rows
    rows.write.option("lineSep", END).option("compression", compression).text(path)


# --- reading ----------------------------------------------------------------------


def _pieces(spark: SparkSession, path: str, version: str) -> DataFrame:
    """(file, block, value): what lies between two magics, in file order within a split."""
    text = spark.read.option("lineSep", f"WARC/{version}\r\n").option("recursiveFileLookup", "true").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"),
    )


def _header(piece: bytes) -> tuple[dict[str, str], int] | None:
    """The header's fields (names in lower case) and length, if the piece begins with a whole one."""
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in piece[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    size = fields.get("content-length", "")
    if not (size.isascii() and size.isdigit() and len(size) < 19):
        return None
    return fields, end + 4


def _placed(batches: Iterator[pa.RecordBatch], magic: int) -> Iterator[tuple[tuple[str, int], int, bytes]]:
    """((file, block), offset within the block, piece); the offset is that of the magic before the piece."""
    here, at = None, 0
    for batch in batches:
        for file, block, piece in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, block) != here:
                here, at = (file, block), 0
            yield here, at - magic, piece
            at += len(piece) + magic


STORED = (
    "file string, block long, start long, value binary, "
    "bytes long, starts array<long>, nexts array<long>, exits array<long>"
)
_STORED = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("start", pa.int64()), ("value", pa.binary()), ("bytes", pa.int64())]
    + [(name, pa.list_(pa.int64())) for name in ("starts", "nexts", "exits")]
)
#: Bytes and pieces of a batch that a task hands on.
HELD_BYTES, HELD_PIECES = 1 << 24, 10_000


def _chain(here: tuple[str, int], end: int, starts: list[int], nexts: list[int], magic: int) -> pa.RecordBatch:
    """The row of a split: its length, and of each candidate where it starts, ends and leaves the split."""
    place = {s: i for i, s in enumerate(starts)}
    exits: list[int | None] = [None] * len(starts)
    for i in range(len(starts) - 1, -1, -1):
        to = nexts[i]
        if to is None:
            continue
        if to >= end - magic:
            exits[i] = to
        elif to in place:
            exits[i] = exits[place[to]]
    values = [[here[0]], [here[1]], [None], [None], [end], [starts], [nexts], [exits]]
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, _STORED)], schema=_STORED)


def _split(batches: Iterator[pa.RecordBatch], magic: int) -> Iterator[pa.RecordBatch]:
    """The candidates of each split with their places, and after them the split's own row."""
    held: list[list] = [[], [], [], []]
    size = 0

    def candidates() -> pa.RecordBatch:
        n = len(held[0])
        columns = [*held, *[[None] * n] * 4]
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, _STORED)], schema=_STORED)

    open_, end, starts, nexts = None, 0, [], []
    for here, start, piece in _placed(batches, magic):
        if here != open_:
            if open_:
                yield _chain(open_, end, starts, nexts, magic)
            open_, starts, nexts = here, [], []
        end = start + magic + len(piece) + magic
        if here[1] > 0 or start >= 0:  # what comes before a file's first magic is no candidate
            found = _header(piece)
            starts.append(start)
            nexts.append(start + magic + found[1] + int(found[0]["content-length"]) + len(END) if found else None)
            for column, value in zip(held, (*here, start, piece)):
                column.append(value)
            size += len(piece)
        if size > HELD_BYTES or len(held[0]) == HELD_PIECES:
            yield candidates()
            held, size = [[], [], [], []], 0
    if held[0]:
        yield candidates()
    if open_:
        yield _chain(open_, end, starts, nexts, magic)


def _stored(spark: SparkSession, path: str, version: str) -> DataFrame:
    """The archives' candidates and splits as a table (``STORED``).

    Spark cuts files into splits anew whenever it reads them, and by settings and the number of cores that
    may change meanwhile.  So they are read once, and all that follows works on what that reading found.
    """
    magic = len(f"WARC/{version}\r\n")
    pieces = _pieces(spark, path, version).mapInArrow(lambda batches: _split(batches, magic), STORED)
    return written(pieces, "pieces", compression="zstd")  # it holds all payloads beside the archives


def verified(stored: DataFrame, path: str, version: str = VERSION) -> DataFrame:
    """(file, block, start, offset, whole, owner) of all candidates that are records or parts of one.

    ``start``: within the block; ``offset``: within the file.  ``owner``: the offset of the
    record that a candidate is or lies in.  Raises an error if a chain breaks off.
    """
    magic = len(f"WARC/{version}\r\n")
    blocks = stored.where("bytes IS NOT NULL").select("file", "block", "bytes", "starts", "nexts", "exits")
    in_file = Window.partitionBy("file").orderBy("block")  # a row for each split
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    after = in_file.rowsBetween(1, Window.unboundedFollowing)
    blocks = written(blocks.withColumn("base", F.coalesce(F.sum("bytes").over(before), F.lit(0))), "based")
    candidates = blocks.select(
        "file", "block", "base", F.explode(F.arrays_zip("starts", "exits")).alias("c")
    ).select("file", "block", (F.col("base") + F.col("c.starts")).alias("at"), (F.col("base") + F.col("c.exits")).alias("to"))
    # the end of what the last split read is one magic past the end of the file
    ends = blocks.groupBy("file").agg((F.max(F.col("base") + F.col("bytes")) - magic).alias("end")).where("end > 0")

    targets = candidates.select("file", F.col("to").alias("at")).where("at IS NOT NULL").distinct()
    jumps = candidates.join(targets, ["file", "at"], "left_semi").unionByName(candidates.where("at = 0"))
    jumps = written(jumps.distinct(), "jumps")
    reached = written(jumps.where("at = 0").select("file", "at"), "reached")
    while True:
        hop = jumps.select("file", "at", "to")
        onward = reached.join(hop, ["file", "at"]).select("file", F.col("to").alias("at")).where("at IS NOT NULL")
        onward = onward.join(jumps.select("file", "at"), ["file", "at"], "left_semi")
        more = written(reached.unionByName(onward).distinct(), "reached")
        if more.count() == reached.count():
            break
        reached = more
        # a pointer goes on to where its target points; one that points nowhere further ends
        second = hop.select("file", F.col("at").alias("to"), F.col("to").alias("after"))
        jumps = jumps.join(second, ["file", "to"], "left").select("file", "block", "at", F.col("after").alias("to"))
        jumps = written(jumps, "jumps")

    last = reached.join(candidates, ["file", "at"]).groupBy("file").agg(F.max("to").alias("last"))
    broken = ends.join(last, "file", "left").where("last IS NULL OR last != end").count()
    if broken:
        raise ValueError(f"{broken} archives under {path} have a chain of records that breaks off")

    entries = reached.join(candidates.select("file", "block", "at"), ["file", "at"]).select("file", "block", F.col("at").alias("entry"))

    @F.arrow_udf("array<struct<start: long, real: boolean, owner: long, alone: boolean>>")
    def walked(starts: pa.Array, nexts: pa.Array, entry: pa.Array) -> pa.Array:
        """Which candidates of a split are records, the last record up to each, and whether one follows it at once."""
        rows = []
        for s, n, e in zip(starts.to_pylist(), nexts.to_pylist(), entry.to_pylist()):
            place, real = {x: i for i, x in enumerate(s)}, [False] * len(s)
            while e in place:
                real[place[e]] = True
                e = n[place[e]]
            owner, row = None, []
            for i, (start, is_real) in enumerate(zip(s, real)):
                owner = start if is_real else owner
                row.append({"start": start, "real": is_real, "owner": owner, "alone": real[i + 1] if i + 1 < len(s) else None})
            rows.append(row)
        kind = pa.struct([("start", pa.int64()), ("real", pa.bool_()), ("owner", pa.int64()), ("alone", pa.bool_())])
        return pa.array(rows, pa.list_(kind))

    entry = F.col("entry") - F.col("base")
    found = blocks.join(entries, ["file", "block"], "left").select("file", "block", "base", walked("starts", "nexts", entry).alias("found"))
    found = written(found, "walked")
    # what a split hands to those after it, and gets from them
    ends_with, begins_with = F.get("found", F.size("found") - 1)["owner"] + F.col("base"), F.get("found", F.lit(0))["real"]
    found = found.withColumns(
        {
            "carried": F.last(ends_with, ignorenulls=True).over(before),
            "begins": F.coalesce(F.first(begins_with, ignorenulls=True).over(after), F.lit(True)),
        }
    )
    rows = found.select("file", "block", "base", "carried", "begins", F.inline("found"))
    whole = F.col("real") & F.coalesce("alone", "begins")
    owner = F.coalesce(F.col("base") + F.col("owner"), F.col("carried"))
    rows = rows.select("file", "block", "start", (F.col("base") + F.col("start")).alias("offset"), whole.alias("whole"), owner.alias("owner"))
    return rows.where("owner IS NOT NULL")


RECORD = (
    "file string, offset long, record_type string, headers map<string,string>, http_headers string, "
    "payload binary, payload_bytes long, payload_digest string"
)


def _record(record: bytes) -> tuple:
    """The columns of a record from its bytes after the magic."""
    fields, start = _header(record)
    block = record[start : start + int(fields["content-length"])]
    head, payload = "", block
    if fields.get("content-type", "").startswith("application/http"):
        cut = block.find(b"\r\n\r\n")
        cut = len(block) if cut < 0 else cut
        head, payload = block[:cut].decode("utf-8", "replace"), block[cut + 4 :]
    return fields, head, payload


def _parsed(values: list[bytes], content: bool) -> list[list]:
    columns: list[list] = [[] for _ in range(6)]
    for value in values:
        fields, head, payload = _record(value)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        row = (fields.get("warc-type"), list(fields.items()), head, payload if content else None, len(payload), digest)
        for column, x in zip(columns, row):
            column.append(x)
    return columns


_PARSED_TYPES = [pa.string(), pa.map_(pa.string(), pa.string()), pa.string(), pa.binary(), pa.int64(), pa.string()]


def read_archives(spark: SparkSession, path: str, content: bool = True, version: str = VERSION) -> DataFrame:
    """The records of all archives under ``path``, in the columns of ``RECORD``.

    ``payload`` is null unless ``content``; its size and digest are computed from it either
    way.  Header names are in lower case.  Empty files have no records.
    """
    stored = _stored(spark, path, version)
    found = written(verified(stored, path, version), "verified")
    pieces = stored.where("value IS NOT NULL").select("file", "block", "start", "value")
    names = ["record_type", "headers", "http_headers", "payload", "payload_bytes", "payload_digest"]
    types = RECORD.split(", ", 2)[2]

    def one_piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, kept = [], []
            for i, piece in enumerate(batch.column(3).to_pylist()):
                header = _header(piece)
                if header and header[1] + int(header[0]["content-length"]) + len(END) == len(piece):
                    kept.append(i)
                    values.append(piece)
            place = batch.select([0, 1, 2]).take(pa.array(kept, pa.int64()))
            arrays = [pa.array(c, t) for c, t in zip(_parsed(values, content), _PARSED_TYPES)]
            yield pa.RecordBatch.from_arrays([*place.columns, *arrays], names=["file", "block", "start", *names])

    whole = pieces.mapInArrow(one_piece, f"file string, block long, start long, {types}")
    whole = whole.join(found.where("whole").select("file", "block", "start", "offset"), ["file", "block", "start"])
    whole = whole.select("file", "offset", *names)

    parts = found.where("NOT whole")
    if parts.isEmpty():
        return whole

    # one record's pieces are one row in the end, as its content is
    mark = F.lit(f"WARC/{version}\r\n".encode())
    text = F.transform(F.array_sort(F.collect_list(F.struct("start_in_file", "value"))), lambda p: p["value"])
    joined = pieces.join(parts.withColumn("start_in_file", F.col("offset")).drop("offset"), ["file", "block", "start"])
    joined = joined.groupBy("file", F.col("owner").alias("offset")).agg(text.alias("values"))
    joined = joined.select("file", "offset", F.aggregate(F.slice("values", 2, F.lit(1 << 30)), F.get("values", F.lit(0)), lambda done, p: F.concat(done, mark, p)).alias("value"))

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = [pa.array(c, t) for c, t in zip(_parsed(batch.column(2).to_pylist(), content), _PARSED_TYPES)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=["file", "offset", *names])

    return whole.unionByName(joined.mapInArrow(several, RECORD))
