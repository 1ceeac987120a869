"""Token ids as length-delimited binary records, with a separate offset index for shuffled reads.

A data file is a run of frames, in document order:

    length of the payload   8 bytes, little-endian
    masked crc32 of those   4 bytes
    payload                 key length (2 bytes, 65535 for a null key), key in UTF-8, bytes per id (1 byte), ids
    masked crc32 of it      4 bytes
    0x0A

Masking rotates a checksum by 15 bits and adds a constant, so that a checksum over data that itself holds
checksums is no fixed point. Ids take 2 bytes where the vocabulary allows, else 4. Files are written by Spark's
own committed writer, so a lost executor leaves no half file behind, and every file is as large as a shuffle
partition. The index is a Parquet table: file, offset, bytes, key, n_tokens, start (ids in all earlier
documents).

Edge cases: a null or empty text is a record with the end id alone; null keys come first and stay null; equal
keys are ordered by their text and each keeps its record; an empty table writes no record.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from . import pieces
from .text import held

MASK_DELTA = 0xA282EAD8
VOCABULARY_BYTES = 64 << 20
CACHED = 1 << 20  # units that a Python worker remembers
TOGETHER = 1 << 18  # characters looked up at a time
NULL_KEY = 0xFFFF
_HEAD = struct.Struct("<QI")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(key: str | None, ids: bytes, width: int) -> bytes:
    name = b"" if key is None else key.encode()
    if len(name) >= NULL_KEY:
        raise ValueError("a key has at most 65534 bytes")
    payload = struct.pack("<H", NULL_KEY if key is None else len(name)) + name + bytes([width]) + ids
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload)), b"\n"))


def unframe(data: bytes, offset: int) -> tuple[str | None, np.ndarray, int]:
    """(key, ids, offset of the next frame); a wrong checksum raises."""
    length, check = _HEAD.unpack_from(data, offset)
    if masked(data[offset : offset + 8]) != check:
        raise ValueError(f"damaged length at {offset}")
    start = offset + _HEAD.size
    payload = data[start : start + length]
    end = start + length
    if len(payload) != length or masked(payload) != struct.unpack_from("<I", data, end)[0] or data[end + 4 : end + 5] != b"\n":
        raise ValueError(f"damaged record at {offset}")
    (size,) = struct.unpack_from("<H", payload)
    name = 0 if size == NULL_KEY else size
    key = None if size == NULL_KEY else payload[2 : 2 + name].decode()
    ids = np.frombuffer(payload, "<u2" if payload[2 + name] == 2 else "<u4", offset=3 + name)
    return key, ids, end + 5


def _kinds() -> np.ndarray:
    """0 blank, 1 letter, 2 digit, 3 other sign, 4 odd, of the code points below 256.

    Odd are signs that begin a contraction, digits beyond 0-9 and the separators 28 to 31, which libraries see
    differently; code points from 256 on count as odd too.
    """
    kinds = np.full(257, 3, np.uint8)
    for c in range(256):
        if c in (9, 10, 11, 12, 13, 32, 0x85, 0xA0):
            kinds[c] = 0
        elif c in b"'\x1c\x1d\x1e\x1f\xb2\xb3\xb9\xbc\xbd\xbe":
            kinds[c] = 4
        elif chr(c).isalpha():
            kinds[c] = 1
        elif 48 <= c <= 57:
            kinds[c] = 2
    kinds[256] = 4
    return kinds


_KINDS = _kinds()
_LOWER = np.array([ord(chr(c).lower()) if c < 256 and len(chr(c).lower()) == 1 else c for c in range(257)], np.uint32)


class WordEncoder:
    """Ids of texts by the tokenizers library, unit by unit.

    The vocabulary drops white space and ends tokens at it, so what stands between blanks is encoded alone.
    There, a run of Latin-1 letters (lower-cased one by one), a single digit and a run of other signs are units to
    the library; a stretch between blanks with anything odd is one unit as a whole. Units are looked up in a
    table of bounded size; only those not seen of late go to the library, words of letters in one call.
    """

    def __init__(self, json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(json)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = 2 if size <= 1 << 16 else 4
        self.kind = "<u2" if self.width == 2 else "<u4"
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.table = pieces.PieceTable(self.kind, CACHED)

    def _library(self, words: list[str]) -> list[bytes]:
        made: dict[str, bytes] = {}
        plain = [w for w in words if w.isalpha() and (w.isascii() or max(w) < "\u0100")]
        if plain:
            (joined,) = self.tokenizer.encode_batch_fast([" ".join(plain)], add_special_tokens=False)
            ids = np.array(joined.ids, self.kind)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(plain):
                data, at = ids.tobytes(), 0
                for word, end in zip(plain, (cuts * self.width).tolist()):
                    made[word] = data[at:end]
                    at = end
        other = [w for w in words if w not in made]
        for word, found in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            made[word] = np.array(found.ids, self.kind).tobytes()
        return [made[w] for w in words]

    def _some(self, texts: list[str]) -> list[bytes]:
        codes = pieces.code_points("\n".join(texts) + "\n")
        low = np.minimum(codes, 256)
        codes = np.where(codes < 256, _LOWER[low], codes)
        kinds = _KINDS[low]
        inside = kinds != 0
        before = np.concatenate([[False], inside[:-1]])
        opened = inside & ~before
        # A stretch between blanks with anything odd in it stays whole.
        stretch = np.cumsum(opened)
        odd = np.zeros(int(stretch[-1]) + 1 if len(stretch) else 1, bool)
        odd[stretch[kinds == 4]] = True
        turned = (kinds[1:] != kinds[:-1]) | (kinds[1:] == 2)
        starts = opened.copy()
        starts[1:] |= inside[1:] & turned & ~odd[stretch[1:]]
        start = np.flatnonzero(starts)
        # A unit ends where the next one starts or a blank follows.
        stops = np.flatnonzero(~inside)
        after = stops[np.searchsorted(stops, start)]
        end = np.minimum(after, np.concatenate([start[1:], [len(codes)]])) if len(start) else start
        ids, lengths = pieces.encode(self.table, codes, start, end, self._library)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        bounds = np.concatenate([[0], np.cumsum(sizes + 1)])
        done = np.concatenate([[0], np.cumsum(lengths)])
        cuts = (done[np.searchsorted(start, bounds)] * self.width).tolist()
        data = ids.tobytes()
        return [data[x:y] for x, y in zip(cuts, cuts[1:])]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        out: list[bytes | None] = [None] * len(texts)
        some: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            if any(s in text for s in self.special):  # their strings are tokens wherever they stand
                (made,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
                out[i] = np.array(made.ids, self.kind).tobytes()
                continue
            some.append(i)
            size += len(text)
            if size >= TOGETHER:
                for k, ids in zip(some, self._some([texts[k] for k in some])):
                    out[k] = ids
                some, size = [], 0
        if some:
            for k, ids in zip(some, self._some([texts[k] for k in some])):
                out[k] = ids
        return out


# A file is read as one value, which may have 2 GB: texts of about so many bytes, and at most so many records, go to one.
FILE_BYTES = 64 << 20
FILE_RECORDS = 1 << 16


def _encoder(shared) -> WordEncoder:
    json = shared.value
    key = hashlib.sha256(json.encode()).hexdigest()
    return held(("records", key), lambda: WordEncoder(json))


def write_records(docs: DataFrame, tokenizer: str, path: str, *, key: str = "doc_id", text: str = "text", end_id: int | None = None) -> None:
    """Write the ids of every text, in ascending key order over all files, below ``path``/data and index them."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        json = file.read(VOCABULARY_BYTES + 1)
    if len(json) > VOCABULARY_BYTES:
        raise ValueError(f"{tokenizer} is larger than {VOCABULARY_BYTES} characters")
    shared = spark.sparkContext.broadcast(json)
    order = [F.col("k").asc_nulls_first(), F.col("t").asc_nulls_first()]
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    # As many stretches as make files of about FILE_BYTES, rows of one key dealt by the beginnings of their texts.
    size = rows.agg(F.sum(F.octet_length("t").cast("long"))).first()[0] or 0
    stretches = max(size // FILE_BYTES + 1, 4 * spark.sparkContext.defaultParallelism)
    start = F.substring("t", 1, 64).asc_nulls_first()
    rows = rows.repartitionByRange(stretches, F.col("k").asc_nulls_first(), start).sortWithinPartitions(*order)
    rows = rows.select(F.col("k").cast("string").alias("k"), "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        end = b"" if end_id is None else np.array([end_id], encoder.kind).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = encoder.encode_all(part.column("t").to_pylist())
                # The writer ends every value with the line feed that ends a frame.
                frames = [frame(k, ids + end, encoder.width)[:-1] for k, ids in zip(part.column("k").to_pylist(), made)]
                yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])

    framed = rows.mapInArrow(run, "frame binary")
    framed.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", "\n").option("maxRecordsPerFile", FILE_RECORDS).text(
        f"{path}/data"
    )
    _index(spark, path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(f"{path}/data")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """file, offset, bytes, key, ids of every record; checksums are verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content")):
                data, at = content.as_py(), 0
                while at < len(data):
                    rows, size = [], 0
                    while at < len(data) and size < 4 << 20:
                        key, ids, then = unframe(data, at)
                        rows.append((file, at, then - at, key, ids.astype(np.int32)))
                        size, at = size + (then - at), then
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32())))],
                        names=["file", "offset", "bytes", "key", "ids"],
                    )

    return _files(spark, path).mapInArrow(run, "file string, offset long, bytes long, key string, ids array<int>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """file, offset, bytes, key, n_tokens and the crc32 of the ids as unsigned 32-bit integers, per record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content")):
                data, at, rows = content.as_py(), 0, []
                while at < len(data):
                    key, ids, then = unframe(data, at)
                    rows.append((file, at, then - at, key, len(ids), zlib.crc32(ids.astype("<u4"))))
                    at = then
                if rows:
                    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                        names=["file", "offset", "bytes", "key", "n_tokens", "ids_crc32"],
                    )

    return _files(spark, path).mapInArrow(run, "file string, offset long, bytes long, key string, n_tokens long, ids_crc32 long")


def _index(spark: SparkSession, path: str) -> None:
    """The offset index, made from the files themselves.

    Files are in key order, and so are records in a file. A running sum inside each file, plus the total of the
    files before it, is a record's start; only one total per file meets in one place.
    """
    records = read_digests(spark, path).drop("ids_crc32")
    records.write.parquet(f"{path}/records")
    records = spark.read.parquet(f"{path}/records")
    totals = records.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    earlier = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select("file", F.coalesce(earlier, F.lit(0)).alias("base"))
    inside = F.sum("n_tokens").over(Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1))
    index = records.withColumn("inside", F.coalesce(inside, F.lit(0))).join(totals, "file")
    index.select("file", "offset", "bytes", "key", "n_tokens", (F.col("base") + F.col("inside")).alias("start")).write.parquet(
        f"{path}/index"
    )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


def read_at(spark: SparkSession, path: str, entries: DataFrame) -> DataFrame:
    """Ids of the index entries asked for, in any order: each file is opened once and read at their offsets.

    ``entries`` has file and offset, for example a shuffled slice of the index.
    """
    wanted = entries.groupBy("file").agg(F.collect_list("offset").alias("offsets"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c) for c in ("file", "offsets", "content"))
            for file, offsets, content in zip(*columns):
                data = content.as_py()
                rows = [(file.as_py(), at, *unframe(data, at)[:2]) for at in offsets.as_py()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.string(), pa.list_(pa.int32())))],
                    names=["file", "offset", "key", "ids"],
                )

    return _files(spark, path).join(wanted, "file").select("file", "offsets", "content").mapInArrow(
        run, "file string, offset long, key string, ids array<int>"
    )
