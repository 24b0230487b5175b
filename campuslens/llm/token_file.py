"""Token-ID output: blocks of concatenated ids with Elias-Fano coded document boundaries.

File format (Parquet rows, so that any store Spark writes to will do; one row per block, rows of a
part in ascending order):

  part, block        place of the block; parts are ranges of ascending doc_id
  first_token        ids of earlier blocks of the same part
  n_tokens           ids in the block
  doc_ids            ids of its documents, ascending
  bounds             Elias-Fano code of the document ends (offsets into the block)
  ids                the ids, little-endian; 2 bytes each while all are below 65536, else 4

``bounds``, little-endian: u32 count, u64 universe, u8 width of the low parts, u8 bytes per id,
u32 bytes of the low parts, u32 bytes of the high parts, u32 number of select samples; then the low
parts (bit packed), the high parts (unary, bit i of byte j is bit 8 j + i) and the samples (u32
position of every 64th one). That is about 2 + log2(ids per document) bits a document."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


TOKENIZER = "word_bpe_49k.json"
END_ID = 2
BLOCK_TOKENS = 1 << 18
SAMPLE = 64
#: Distinct pre-tokens that one worker remembers; later ones are encoded again.
CACHE_ENTRIES = 300_000
_HEAD = struct.Struct("<IQBBIII")

BLOCK_SCHEMA = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()),
    T.StructField("first_token", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("bounds", T.BinaryType()),
    T.StructField("ids", T.BinaryType())])
_BLOCK_ARROW = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("first_token", pa.int64()),
    ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("bounds", pa.binary()),
    ("ids", pa.binary())])
READ_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])


def ef_encode(ends: np.ndarray, id_bytes: int = 2) -> bytes:
    """Code of a non-decreasing sequence of offsets."""
    count, universe = len(ends), int(ends[-1]) if len(ends) else 0
    width = max(0, (universe // count).bit_length() - 1) if count else 0
    ends = ends.astype(np.uint64)
    shifts = np.arange(width, dtype=np.uint64)
    low = ((ends[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
    ones = (ends >> np.uint64(width)).astype(np.int64) + np.arange(count)
    high = np.zeros(int(ones[-1]) + 1 if count else 0, np.uint8)
    high[ones] = 1
    low_bytes = np.packbits(low, bitorder="little").tobytes()
    high_bytes = np.packbits(high, bitorder="little").tobytes()
    samples = ones[::SAMPLE].astype("<u4")
    return _HEAD.pack(count, universe, width, id_bytes, len(low_bytes), len(high_bytes),
                      len(samples)) + low_bytes + high_bytes + samples.tobytes()


class Bounds:
    """Reader of one block's boundaries. ``select(i)`` is the end of document i, found from the
    sample before it; ``all()`` decodes every end."""

    def __init__(self, code: bytes):
        (self.count, self.universe, self.width, self.id_bytes, n_low, n_high,
         n_samples) = _HEAD.unpack_from(code)
        at = _HEAD.size
        self.low = np.frombuffer(code, np.uint8, n_low, at)
        self.high = np.frombuffer(code, np.uint8, n_high, at + n_low)
        self.samples = np.frombuffer(code, "<u4", n_samples, at + n_low + n_high)

    def select(self, i: int) -> int:
        position, missing = int(self.samples[i // SAMPLE]), i % SAMPLE
        while missing:
            byte, bit = divmod(position + 1, 8)
            rest = int(self.high[byte]) >> bit
            ones = rest.bit_count()
            if ones < missing:
                missing -= ones
                position = 8 * byte + 7
                continue
            while missing:
                position += 1
                missing -= int(self.high[position >> 3]) >> (position & 7) & 1
        low = 0
        for k in range(self.width):
            bit = i * self.width + k
            low |= (int(self.low[bit >> 3]) >> (bit & 7) & 1) << k
        return (position - i) << self.width | low

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.count]
        ends = (ones - np.arange(self.count)) << self.width
        if self.width:
            bits = np.unpackbits(self.low, count=self.count * self.width, bitorder="little")
            ends += bits.reshape(self.count, self.width) @ (1 << np.arange(self.width))
        return ends


class Encoder(dict):
    """Ids of whole texts as the library's ``encode(text, add_special_tokens=False)`` gives them.

    Texts over printable ASCII, blanks and Latin-1 letters are cut into the pre-tokens of the
    tokenizer's own pattern, and the library's BPE model runs once per distinct pre-token; its
    normalisation leaves such texts alone but for lower case. All other texts, and texts that hold
    a special token's string, go through the library whole."""

    LETTER = "a-zà-öø-ÿß"
    PLAIN = re.compile(r"[\x09-\x0D\x20-~À-ÖØ-öø-ÿ]*").fullmatch
    PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[0-9]|[^\x09-\x0D\x200-9{LETTER}]+")

    def __init__(self, spec: bytes):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_buffer(spec)
        self.model = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.alphabet = {b: chr(b) for b in shown} | {b: chr(256 + i)
                                                      for i, b in enumerate(hidden)}

    def packed(self, ids: list[int]) -> bytes:
        return np.array(ids, "<u2" if self.width == 2 else "<u4").tobytes()

    def __missing__(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else "".join(
            map(self.alphabet.__getitem__, piece.encode()))
        out = self.packed([t.id for t in self.model.tokenize(shown)])
        if len(self) < CACHE_ENTRIES:
            self[piece] = out
        return out

    def encode(self, text: str) -> bytes:
        if self.PLAIN(text) and not any(s in text for s in self.special):
            return b"".join(map(self.__getitem__, self.PIECE.findall(text.lower())))
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)


_ENCODERS: dict[int, Encoder] = {}


def encoder(spec: bytes) -> Encoder:
    """One encoder per Python worker and tokenizer; workers are reused by later tasks."""
    key = zlib.crc32(spec)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(spec)
    return _ENCODERS[key]


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
                 block_tokens: int = BLOCK_TOKENS) -> None:
    """Encodes ``docs`` (doc_id, text) and writes the token file in ascending doc_id order.

    Null text is empty; a null doc_id comes first; equal ids are ordered by a hash of the text;
    other columns are ignored; an empty table writes a file without blocks. The range partitioning
    also deals by row, so one id on very many rows is spread over parts."""
    with open(tokenizer or public_tokenizers.path(TOKENIZER), "rb") as f:
        spec = f.read()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(spec), TaskContext.get().partitionId()
        end = enc.packed([end_id])
        names, chunks, sizes = [], [], []
        first = block = 0

        def flush():
            nonlocal first, block, names, chunks, sizes
            ends = np.cumsum(sizes)
            row = {"part": [part], "block": [block], "first_token": [first],
                   "n_tokens": [int(ends[-1])], "doc_ids": [names],
                   "bounds": [ef_encode(ends, enc.width)], "ids": [b"".join(chunks)]}
            first, block = first + int(ends[-1]), block + 1
            names, chunks, sizes = [], [], []
            return pa.RecordBatch.from_pydict(row, schema=_BLOCK_ARROW)

        held = 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                ids_bytes = enc.encode(texts[i].as_py() or "") + end
                names.append(ids[i].as_py())
                chunks.append(ids_bytes)
                sizes.append(len(ids_bytes) // enc.width)
                held += sizes[-1]
                if held >= block_tokens:
                    yield flush()
                    held = 0
        if names:
            yield flush()

    tie, row = "_tie", "_row"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"),
                       F.xxhash64("text").alias(tie), F.monotonically_increasing_id().alias(row))
    rows = rows.repartitionByRange("doc_id", tie, row).sortWithinPartitions("doc_id", tie)
    rows.select("doc_id", "text").mapInArrow(blocks, BLOCK_SCHEMA).write.parquet(path)


def read_tokens(spark, path: str) -> DataFrame:
    """Per document of a token file: doc_id, start, n_tokens and the crc32 of its ids as
    unsigned 32-bit words. Only one row per part (not per document) is summed on one task."""
    rows = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                bounds = Bounds(row["bounds"])
                ends = np.array([bounds.select(i) for i in range(bounds.count)], np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                ids = np.frombuffer(row["ids"], "<u2" if bounds.id_bytes == 2 else "<u4")
                view = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(view[4 * a:4 * b])
                       for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "start": pa.array(starts + row["base"] + row["first_token"], pa.int64()),
                    "n_tokens": pa.array(ends - starts, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64())})

    # One row per part of the write, 16 bytes each: bounded by the number of shuffle partitions.
    return rows.join(F.broadcast(totals), "part").mapInArrow(documents, READ_SCHEMA)


def tokens_round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Writes the token file to the shared folder and reads it back."""
    from uuid import uuid4

    from campuslens.session import scratch_dir
    path = f"{scratch_dir(docs.sparkSession).rstrip('/')}/tokens-{uuid4().hex}"
    write_tokens(docs, path, tokenizer)
    return read_tokens(docs.sparkSession, path)
