"""WARC archives: written as text, and read back in parallel by chains of record boundaries.

The line that opens a record may also stand inside a payload. So tasks, which read blocks of a file, only
propose records: every opening line whose header names a length is a candidate, and its successor is where that
length ends. Within a block each candidate is followed to where its chain leaves the block, and pointer jumping over
these places, from the start of each file on, finds where the chain of true records enters each block. Only what that
chain reaches is a record; an opening line inside a payload is never reached. The rounds grow with the logarithm of
the blocks of a file.

A block's candidates are one row of positions and header fields, bounded by the size of a block
(spark.sql.files.maxPartitionBytes). Payloads that hold an opening line lie in several pieces; their pieces alone are
read again and put together by record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerspan.llm.common import shared_folder, stored
from ledgerspan.operators.skew import join_unique

# Fixed values of the format.
OPENING = "WARC/1.0\r\n"
BREAK = "\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

DATE = "2026-01-01T00:00:00Z"
LEAST_BYTES = 0
RECORDS_PER_FILE = 1_000_000
ID = "urn:page:"


def base32(hex_digits: Column) -> Column:
    """Base 32 of 40 hexadecimal digits: four characters from every five of them."""
    characters = []
    for i in range(0, 40, 5):
        bits = F.conv(F.substring(hex_digits, i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            characters.append(F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)))
    return F.concat(*characters)


def _one_line(value: Column) -> Column:
    for found, code in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09"), (" ", "%20")):
        value = F.replace(value, F.lit(found), F.lit(code))
    return value


def record_texts(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """One column `value`: the record of every page, without the blank lines that end it.

    Of pages with equal payloads of at least `least_bytes` bytes, that with the largest page_id is written
    whole, and the others as revisits of it, without payload.
    """
    payload = F.coalesce("html", F.lit(""))
    marked = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload.cast("binary")).alias("hex"), F.octet_length(payload).cast("long").alias("bytes"))
    several = marked.where(F.col("bytes") >= least_bytes).groupBy(F.col("hex").alias("its_hex"), F.col("bytes").alias("its_bytes")).agg(F.count("*").alias("n"), F.max("page_id").alias("keeper"))
    # most payloads stand alone, so this table is small beside the pages, and its size is known to the join
    several = stored(several.where("n > 1").drop("n"), "warc-repeated")
    met = marked.join(several, (F.col("hex") == F.col("its_hex")) & (F.col("bytes") == F.col("its_bytes")), "left")
    revisit = F.col("its_hex").isNotNull() & ~F.col("keeper").eqNullSafe(F.col("page_id"))
    name = lambda c: F.concat(F.lit(f"<{ID}"), F.coalesce(_one_line(F.col(c).cast("string")), F.lit("")), F.lit(">"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "), F.col("bytes").cast("string"), F.lit(END))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit(BREAK))
    header = F.concat(
        F.lit(OPENING),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", name("page_id")),
        line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", _one_line(F.col("url"))), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("hex")))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", name("keeper")))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", length.cast("string")),
        F.lit(BREAK),
    )
    return met.select(F.concat(header, http, F.when(revisit, "").otherwise(F.col("payload"))).alias("value"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write the records of `pages` (page_id, url, html) to uncompressed archives in a new folder. A null html is empty; a null url has no line."""
    record_texts(pages, least_bytes).write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(folder)


def _header(piece: bytes) -> tuple[dict[bytes, bytes], int] | None:
    """Fields (lower-case names) and size of the header that `piece` begins with, or None."""
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in piece[:end].split(b"\r\n"):
        key, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[key.strip().lower()] = value.strip()
    if not fields.get(b"content-length", b"").isdigit() or b"warc-type" not in fields:
        return None
    return fields, end + 4


def _payload(block: bytes, kind: bytes) -> bytes:
    """The payload of a record block: what follows the HTTP header, where there is one."""
    if kind in (b"response", b"revisit") and block.startswith(b"HTTP/"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[bytes]] | tuple[tuple[str, int], bytes]]:
    """((path, block), piece) in the order of the pieces."""
    for batch in batches:
        for path, block, piece in zip(*(batch.column(i) for i in range(3))):
            yield (path.as_py(), block.as_py()), piece.as_py()


FIELDS = ("at", "next", "exit", "number", "kind", "id", "refers_to", "uri", "declared", "payload_bytes", "digest")
CANDIDATE = pa.struct(
    [(f, pa.int64()) for f in FIELDS[:3]] + [("number", pa.int32())] + [(f, pa.string()) for f in FIELDS[4:9]] + [("payload_bytes", pa.int64()), ("digest", pa.string())]
)
CANDIDATES = "array<struct<at:long,next:long,exit:long,number:int,kind:string,id:string,refers_to:string,uri:string,declared:string,payload_bytes:long,digest:string>>"


def _candidate(piece: bytes, at: int, number: int) -> dict | None:
    """The record that `piece`, the text after an opening line at `at`, may begin."""
    found = _header(piece)
    if found is None:
        return None
    fields, size = found
    length = int(fields[b"content-length"])
    kind = fields[b"warc-type"]
    text = lambda key: fields[key].decode("utf-8", "replace") if key in fields else None
    name = lambda key: (text(key) or "").strip("<>").removeprefix(ID) or None
    out = {
        "at": at, "next": at + len(OPENING) + size + length + len(END), "exit": None, "number": number, "kind": kind.decode("utf-8", "replace"), "id": name(b"warc-record-id"),
        "refers_to": name(b"warc-refers-to"), "uri": text(b"warc-target-uri"), "declared": (text(b"warc-payload-digest") or "").partition(":")[2] or None,
        "payload_bytes": None, "digest": None,
    }
    if len(piece) >= size + length:
        payload = _payload(piece[size : size + length], kind)
        out |= {"payload_bytes": len(payload), "digest": _digest(payload)}
    return out


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per block of a file: its size in pieces and opening lines, where its pieces' opening lines stand, and its candidates.

    Places count from the end of the block before. `exit` is where a candidate's chain leaves the block; null if it breaks in it.
    """
    names, opening = ["path", "block", "size", "marks", "candidates"], len(OPENING)

    def row(key: tuple[str, int], size: int, marks: list[int], found: list[dict]) -> pa.RecordBatch:
        exits: dict[int, int | None] = {}
        for c in reversed(found):
            exits[c["at"]] = c["exit"] = c["next"] if c["next"] >= size - opening else exits.get(c["next"])
        columns = [[key[0]], [key[1]], [size], [marks], [found]]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(CANDIDATE)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    key, size, marks, found = None, 0, [], []
    for here, piece in _blocks(batches):
        if here != key:
            if key is not None:
                yield row(key, size, marks, found)
            key, size, marks, found = here, 0, [], []
        # what stands before the first opening line of a file follows none
        if size or here[1]:
            if (c := _candidate(piece, size - opening, len(marks))) is not None:
                found.append(c)
        marks.append(size - opening)
        size += len(piece) + opening
    if key is not None:
        yield row(key, size, marks, found)


def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    """(path, block, value): what stands between opening lines, in order, whatever bytes it holds."""
    text = spark.read.option("lineSep", OPENING).text(folder)
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def entries(blocks: DataFrame) -> DataFrame:
    """(path, block, base, entry): where the chain from the start of a file first meets each block that it meets.

    `blocks` are stored rows of path, block, size and candidates. Nodes are only the places where chains leave
    blocks; a round doubles the length of the known jumps.
    """
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per block
    based = blocks.select("path", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"), F.transform("candidates", lambda c: F.struct(c["at"].alias("at"), c["exit"].alias("exit"))).alias("chains"))
    steps = based.select("path", "block", "base", F.inline("chains")).select("path", "block", "base", (F.col("base") + F.col("at")).alias("at"), (F.col("base") + F.col("exit")).alias("to"))
    steps = stored(steps, "warc-steps")
    starts = steps.select("path").distinct().select("path", F.lit(0).cast("long").alias("at"))
    nodes = steps.where("to IS NOT NULL").select("path", F.col("to").alias("at")).unionByName(starts).distinct()
    links = stored(steps.join(nodes, ["path", "at"], "left_semi"), "warc-links")
    reached = stored(links.join(starts, ["path", "at"], "left_semi").select("path", "at"), "warc-reached")
    jumps = stored(links.where("to IS NOT NULL").select("path", "at", "to"), "warc-jumps")
    while not jumps.isEmpty():
        on = jumps.select("path", F.col("at").alias("to"), F.col("to").alias("beyond"))
        more = reached.join(jumps, ["path", "at"]).select("path", F.col("to").alias("at"))
        reached = stored(reached.unionByName(more).distinct(), "warc-reached")
        jumps = stored(jumps.join(on, ["path", "to"]).select("path", "at", F.col("beyond").alias("to")), "warc-jumps")
    return links.join(reached, ["path", "at"], "left_semi").select("path", "block", "base", (F.col("at") - F.col("base")).alias("entry"))


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records on the chain from each block's entry, with places counted from the start of the file."""
    names = ["path", "block", "base", *FIELDS]
    for batch in batches:
        for path, block, base, entry, found in zip(*(batch.column(i) for i in range(5))):
            base, at, by_place, rows = base.as_py(), entry.as_py(), {}, []
            by_place = {c["at"]: c for c in found.as_py()}
            while (c := by_place.get(at)) is not None:
                at = c["next"]
                rows.append(c | {"at": base + c["at"], "next": base + c["next"]})
            columns = [pa.array([x.as_py()] * len(rows), k) for x, k in ((path, pa.string()), (block, pa.int64()))] + [pa.array([base] * len(rows), pa.int64())]
            flat = pa.array(rows, CANDIDATE)
            yield pa.RecordBatch.from_arrays([*columns, *[flat.field(f) for f in FIELDS]], names)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["path", "block", "number", "value"]
    key, number = None, 0
    for batch in batches:
        numbers = []
        for here in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            number = number + 1 if here == key else 0
            key = here
            numbers.append(number)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(numbers, pa.int32()), batch.column(2)], names)


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, at, payload) from records with their pieces."""
    for batch in batches:
        paths, places, payloads = [], [], []
        for path, at, pieces in zip(*(batch.column(i) for i in range(3))):
            whole = OPENING.encode().join(p["value"] for p in sorted(pieces.as_py(), key=lambda p: (p["block"], p["number"])))
            fields, size = _header(whole)
            paths.append(path.as_py())
            places.append(at.as_py())
            payloads.append(_payload(whole[size : size + int(fields[b"content-length"])], fields[b"warc-type"]))
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(places, pa.int64()), pa.array(payloads, pa.binary())], ["path", "at", "payload"])


def payloads(spark: SparkSession, folder: str, blocks: DataFrame, records: DataFrame) -> DataFrame:
    """(path, at, payload) of the given records (path, at, next) of an archive folder.

    Records know their bytes and blocks their pieces, so pieces meet records by number; what no record asks for is
    not shuffled while the list of numbers is small, and once otherwise.
    """
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    based = blocks.select("path", "block", "marks", "size", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    places = stored(based, "warc-places")
    spans = places.groupBy("path").agg(F.collect_list(F.struct("block", "base", "size")).alias("spans"))  # a file's blocks
    touched = records.select("path", "at", "next").join(spans, "path")
    mine = F.filter("spans", lambda s: (s["base"] - len(OPENING) < F.col("next")) & (s["base"] + s["size"] > F.col("at")))
    each = touched.select("path", "at", "next", F.inline(mine)).drop("base", "size")
    marks = F.transform("marks", lambda m, i: F.struct((F.col("base") + m).alias("place"), i.alias("number")))
    inside = F.filter(marks, lambda m: (m["place"] >= F.col("at")) & (m["place"] < F.col("next")))
    wanted = each.join(places, ["path", "block"]).select("path", "block", "at", F.inline(inside)).drop("place")
    wanted = stored(wanted, "warc-wanted")
    numbered = _pieces(spark, folder).mapInArrow(_numbered, "path string, block long, number int, value binary")
    met = numbered.join(wanted, ["path", "block", "number"])
    whole = met.groupBy("path", "at").agg(F.collect_list(F.struct("block", "number", "value")).alias("pieces"))
    return whole.mapInArrow(_put_together, "path string, at long, payload binary")


def scan_archives(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(blocks, records): a stored row per block, and the records that the chains from the starts of the files reach.

    Records have path, at, next, kind, id, refers_to, uri, declared (digest), and payload_bytes and digest of the payload
    that they hold themselves. Behind a broken boundary the rest of a file is left out.
    """
    blocks = stored(_pieces(spark, folder).mapInArrow(_scanned, f"path string, block long, size long, marks array<long>, candidates {CANDIDATES}"), "warc-blocks")
    met = blocks.join(stored(entries(blocks), "warc-entries"), ["path", "block"]).select("path", "block", "base", "entry", "candidates")
    fields = "at long, next long, exit long, number int, kind string, id string, refers_to string, uri string, declared string, payload_bytes long, digest string"
    records = stored(met.mapInArrow(_walked, f"path string, block long, base long, {fields}").drop("block", "base", "exit", "number"), "warc-records")
    long = records.where("digest IS NULL")
    if long.isEmpty():
        return blocks, records

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [x.as_py() for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([len(v) for v in values], pa.int64()), pa.array([_digest(v) for v in values])], ["its_path", "its_at", "its_bytes", "its_digest"])

    found = stored(payloads(spark, folder, blocks, long).mapInArrow(digested, "its_path string, its_at long, its_bytes long, its_digest string"), "warc-long")
    met = records.join(found, (F.col("path") == F.col("its_path")) & (F.col("at") == F.col("its_at")), "left")
    whole = met.withColumns({"payload_bytes": F.coalesce("payload_bytes", "its_bytes"), "digest": F.coalesce("digest", "its_digest")})
    return blocks, stored(whole.select(*records.columns), "warc-whole")


def resolved(records: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Records with record_type, refers_to, payload_bytes and payload_digest of the full payload.

    A revisit takes its payload from the response of its digest. Of responses with one digest (rows
    alike in id and payload) the first place is the response, and the others count as its revisits.
    """
    own = records.withColumn("key", F.when(F.col("kind") == "revisit", F.col("declared")).otherwise(F.col("digest")))
    whole = own.where("kind = 'response'")
    first = whole.groupBy("key").agg(F.min(F.struct("path", "at", "id", "payload_bytes")).alias("response"))
    met = join_unique(own, stored(first, "warc-responses"), ["key"], ["key"])
    is_first = (F.col("response.path") == F.col("path")) & (F.col("response.at") == F.col("at"))
    response = (F.col("kind") == "response") & (is_first | (F.col("payload_bytes") < least_bytes))
    return met.select(
        "path",
        "at",
        "id",
        "uri",
        F.when(F.col("kind") == "response", F.col("payload_bytes")).otherwise(F.col("response.payload_bytes")).alias("payload_bytes"),
        F.col("key").alias("payload_digest"),
        F.when(response, "response").otherwise("revisit").alias("record_type"),
        F.when(~response, F.col("response.id")).alias("refers_to"),
    )


def report(pages: DataFrame, least_bytes: int = LEAST_BYTES, folder: str | None = None) -> DataFrame:
    """Write the archives of `pages` and read them back: page_id, payload_bytes, payload_digest, record_type and refers_to of every record.

    A null html is an empty payload, and empty payloads count as equal ones. A null page_id is smaller than any other. Rows alike
    in id and html have a record each, of which one is the response. An empty table gives no rows.
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, folder, least_bytes)
    kind = pages.schema["page_id"].dataType
    found = resolved(scan_archives(spark, folder)[1], least_bytes)
    return found.select(F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
