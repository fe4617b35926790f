"""WARC archives: a writer with one gzip member per record, and a splittable reader."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom.llm.common import new_path, small, written

#: Gzip magic and the only compression method there is; also the record delimiter of the reader.
MAGIC = b"\x1f\x8b\x08"
#: Equal payloads of at least so many bytes are stored once.
MIN_REVISIT_BYTES = 100
_MEMBER_HEADER = MAGIC + b"\x00" + b"\x00" * 4 + b"\x00\xff"
_LEVEL = 3
_FIELD = re.compile(rb"^([^:\r\n]+):[ \t]*(.*?)[ \t]*\r?$", re.M)
RECORD = "page_id long, target_uri string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, error string"
_FOUND = RECORD + ", kind string, file string, block long, part long, body binary"
_ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
_BATCH_BYTES = 8 << 20


def member(body: bytes) -> bytes:
    """``body`` as one gzip member. It always ends with a zero byte, as :func:`write` needs.

    The last byte of a member is the highest of its length, zero below 16 MiB; to a longer one
    an empty member is added, which readers skip.
    """
    deflate = zlib.compressobj(_LEVEL, zlib.DEFLATED, -15)
    packed = _MEMBER_HEADER + deflate.compress(body) + deflate.flush()
    packed += struct.pack("<II", zlib.crc32(body), len(body) & 0xFFFFFFFF)
    return packed if packed.endswith(b"\x00") else packed + member(b"")


def record(page_id: int | None, uri: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """The bytes of one WARC/1.1 record; a revisit has an empty block."""
    name = "null" if page_id is None else str(page_id)
    block = b"" if revisit else payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
        f"Content-Length: {len(block)}",
    ]
    if uri is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20%\x7f]", lambda m: f"%{ord(m[0]):02X}", uri))
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """One record per row, archives in the folder ``path``.

    The payload is the text in UTF-8, null text is empty. Of the rows with equal payloads of at
    least ``MIN_REVISIT_BYTES`` those with the smallest page_id are responses, the others revisit
    it; shorter payloads are always responses. Rows repeated with the smallest id are all
    responses; a null id is never the smallest, and payloads under null ids only are all
    responses. Extra columns are ignored.

    Payloads are counted by digest before anything meets, so a payload under a third of all rows
    is one row of the table of repeated payloads; that table is broadcast if it was counted small.
    The text sink writes raw bytes here: members end with a zero byte, which serves as separator.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long_enough = rows.filter(F.octet_length("payload") >= MIN_REVISIT_BYTES)
    firsts = long_enough.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").drop("n")
    firsts = small(written(firsts, "payloads"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, url, payload, digest, first in zip(*(c.to_pylist() for c in batch.columns)):
                revisit = first is not None and page_id != first
                out.append(member(record(page_id, url, payload, digest, first, revisit))[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])

    joined = rows.join(firsts, "digest", "left").select("page_id", "url", "payload", "digest", "first_id")
    members = joined.mapInArrow(run, "member binary").select(F.col("member").cast("string").alias("value"))
    members.write.option("lineSep", "\u0000").option("compression", "none").text(path)


def _number(value: str | None) -> int | None:
    return int(value) if value is not None and re.fullmatch("[0-9]{1,18}", value) else None


def parse(body: bytes) -> tuple | None:
    """The columns of RECORD from the bytes of a record; None if they are none.

    ``error`` names what is wrong, else it is null: a header without end, a WARC-Type that is missing, a
    Content-Length that is no number (the payload then is the whole block) or not that of the block (it is
    what there is of it), a digest that is not that of the payload, a stated length of a revisit that is no number.
    """
    head, gap, block = body.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        return None
    fields = {k.strip().lower().decode("latin-1"): v.decode("utf-8", "replace") for k, v in _FIELD.findall(head)}
    errors = [] if gap else ["header without end"]

    def page(field: str) -> int | None:
        digits = re.fullmatch(r"<urn:page:(-?[0-9]{1,18})>", fields.get(field, ""))
        return int(digits[1]) if digits else None

    kind, length = fields.get("warc-type"), _number(fields.get("content-length"))
    if kind is None:
        errors.append("no WARC-Type")
    if length is None:
        errors.append("Content-Length is no number")
        block = block.removesuffix(b"\r\n\r\n")
    elif length > len(block):
        errors.append("short block")
    elif block[length:].strip(b"\r\n"):
        errors.append("long block")
    payload = block if length is None else block[:length]
    stated = fields.get("warc-payload-digest", "")
    stated = stated.removeprefix("sha256:") if re.fullmatch("sha256:[0-9a-f]{64}", stated) else None
    if kind == "revisit":
        size, digest, payload = _number(fields.get("x-payload-length")), stated, None
        if size is None and "x-payload-length" in fields:
            errors.append("X-Payload-Length is no number")
    else:
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
        # the payload of an HTTP message is a part of its block
        if stated not in (None, digest) and not fields.get("content-type", "").startswith("application/http"):
            errors.append("digest differs")
    return page("warc-record-id"), fields.get("warc-target-uri"), kind, page("warc-refers-to"), size, digest, payload, "; ".join(errors) or None


def salvaged(packed: bytes) -> tuple:
    """The columns of RECORD from a member that cannot be read to its end: what its header says, no payload, an error."""
    inflate, out = zlib.decompressobj(31), b""
    try:
        for at in range(0, len(packed), 256):
            out += inflate.decompress(packed[at : at + 256])
            if b"\r\n\r\n" in out:
                break
    except zlib.error:
        pass
    known = parse(out)
    return (*(known[:4] if known else [None] * 4), None, None, None, "damaged or truncated member")


class _Member:
    """A gzip member whose bytes come in pieces, cut where the magic occurs."""

    def __init__(self):
        self.pieces: list[bytes] = []
        self.out = b""
        self._inflate = zlib.decompressobj(31)

    def add(self, piece: bytes) -> bool:
        """Whether all pieces so far can be the start of a member with a record, or of an empty one."""
        try:
            self.out += self._inflate.decompress(piece)
        except zlib.error:
            return False
        self.pieces.append(piece)
        return self.out[:7] == b"WARC/1." if len(self.out) >= 7 else b"WARC/1.".startswith(self.out)

    @property
    def whole(self) -> bool:
        return self._inflate.eof


    @property
    def holds_record(self) -> bool:
        return len(self.out) >= 7


def assemble(pieces: Iterator[bytes]) -> Iterator[tuple[str, bytes]]:
    """(kind, bytes) of consecutive pieces, each beginning with the magic.

    ``record``: the content of a whole member. ``lead``: a piece before the first record, perhaps of a
    member that began earlier. ``open``: a piece of a last member that is not whole. ``damaged``: the
    pieces of a member that cannot be decoded, once for a stretch of these. Every piece is a candidate for
    the start of a member until its header is decoded; a piece that follows an open record goes on
    with it, as the magic may occur inside compressed data.
    """
    current: _Member | None = None
    candidates: list[tuple[int, _Member]] = []
    loose: list[bytes] = []  # not part of a record so far
    began = broken = False
    for piece in pieces:
        if current is None or not current.add(piece):
            if current is not None and not broken:
                yield "damaged", b"".join(current.pieces)
                broken = True
            current = None
            candidates = [(at, c) for at, c in candidates if c.add(piece)]
            fresh = _Member()
            if fresh.add(piece):
                candidates.append((len(loose), fresh))
            loose.append(piece)
            found = next(((at, c) for at, c in candidates if c.holds_record or c.whole), None)
            if found is None and candidates:
                continue
            before = loose if found is None else loose[: found[0]]
            if not began:
                yield from (("lead", p) for p in before)
            elif before and not broken:
                yield "damaged", b"".join(before)
                broken = True
            loose, candidates = [], []
            if found is None:
                continue
            current, began = found[1], began or found[1].holds_record
        if current.whole:
            if current.out:
                yield "record", current.out
            current, broken = None, False
    rest = loose if current is None else current.pieces
    yield from (("open", p) for p in rest)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[bytes]]]:
    rows = (
        ((file, block), MAGIC + body.as_py())
        for batch in batches
        for file, block, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2))
    )
    for key, group in groupby(rows, key=lambda row: row[0]):
        # nothing stands before the first magic of a file, and no member goes on there
        yield key, (piece for i, (_, piece) in enumerate(group) if i or key[1] or piece != MAGIC)


def _scan(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in _FOUND.split(", "))])
        rows: list[tuple] = []
        size = 0
        for (file, block), pieces in _ranges(batches):
            for order, (kind, body) in enumerate(assemble(pieces)):
                if kind in ("lead", "open"):
                    rows.append((*[None] * 8, kind, file, block, order, body))
                    size += len(body)
                    continue
                parsed = parse(body) if kind == "record" else salvaged(body)
                if parsed is not None:
                    rows.append((*parsed[:6], parsed[6] if payloads else None, parsed[7], "record", None, None, None, None))
                    size += len(parsed[6] or b"") if payloads else 100
                if size > _BATCH_BYTES:
                    yield _to_batch(rows, schema)
                    rows, size = [], 0
        if rows:
            yield _to_batch(rows, schema)

    return run


def _to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _stitch(frame: pd.DataFrame) -> pd.DataFrame:
    """Records of one file whose pieces lie in several ranges, and one row with an error for each stretch that is none."""
    frame = frame.sort_values(["block", "part"])
    records = []
    for kind, group in groupby(assemble(iter(frame["body"])), key=lambda found: found[0]):
        bodies = [body for _, body in group]
        if kind in ("lead", "open"):
            bodies = [b"".join(bodies)] if any(body != MAGIC for body in bodies) else []
        records += [parse(body) if kind == "record" else salvaged(body) for body in bodies]
    return pd.DataFrame([r for r in records if r], columns=[c.split()[0] for c in RECORD.split(", ")]).astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"})


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records under ``path``, one row of RECORD each; ``payloads=False`` leaves payload null.

    Spark's text source with the gzip magic as record delimiter gives the byte ranges: a task finds
    the first magic inside its range, owns what begins there and reads beyond its end to finish
    it. Every candidate is decoded up to its header before it counts. Where the magic occurs inside
    compressed data the record is put together from its pieces; should such a magic lie in the
    next range, the pieces meet by file in a second step, almost always empty. Members without a
    record are skipped; empty files give no rows. The digest and length of a response
    are those of the payload read, those of a revisit are from its header. File names must not end
    in ``.gz``, or Spark would inflate whole files.

    Nothing that is wrong ends the job: ``error`` says what (see :func:`parse`), null for a sound record. A member
    that is damaged or cut off is a row with what its header still says and no payload. Bytes that
    belong to no record, as in files of another kind, give one row for each byte range they fill, with
    nothing but an error; only files in which a member was left open send pieces to the second step.
    """
    lines = spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    body = F.col("value").cast("binary").alias("body")
    blocks = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), body)
    found = blocks.mapInArrow(_scan(payloads), _FOUND)
    columns = [c.split()[0] for c in RECORD.split(", ")]
    whole = found.filter("kind = 'record'").select(*columns)
    parts = written(found.filter("kind <> 'record'").select("kind", "file", "block", "part", "body"), "parts")
    files = small(written(parts.filter("kind = 'open'").select("file").distinct(), "open-files"))
    stitched = parts.join(files, "file", "left_semi").select("file", "block", "part", "body").groupBy("file").applyInPandas(_stitch, RECORD)
    strange = parts.join(files, "file", "left_anti").filter(F.col("body") != F.lit(MAGIC)).select("file", "block").distinct()
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (c.split() for c in RECORD.split(", ")[:-1])]
    return whole.union(stitched).union(strange.select(*nothing, F.lit("no record").alias("error")))


def archived(pages: DataFrame, payloads: bool = False) -> DataFrame:
    """Writes ``pages`` as archives to the shared folder and reads them back."""
    path = new_path(pages.sparkSession, "warc")
    write(pages, path)
    return read(pages.sparkSession, path, payloads)
