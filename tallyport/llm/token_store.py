"""Token ids as Parquet lists: written in document order, read by range or without the ids.

File format: one row a document with `doc_id`, `n_tokens`, `part`, `local_start` and
`tokens`. Parts are ranges of doc_id, one file each, sorted inside, so document order is
part order. Token ids are dictionary-encoded (a vocabulary fits a dictionary page), the
ascending columns delta-encoded; row groups and pages are kept small and carry page
indexes, so a range of documents is found from statistics, and the narrow columns are
read without touching the ids. `start`, the ids before a document in the whole corpus, is
the part's offset plus `local_start`; offsets come from one total a part.

Defined results: a NULL text is the empty text, whose only id is the end id; documents that
repeat an id stand one after another, ordered by their text's hash, then by the text; a
NULL doc_id comes first; an empty table gives an empty store; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyport.llm.bpe_stream import WORD, byte_alphabet, normal
from tallyport.llm.common import Memo, map_arrow
from tallyport.session import new_folder

END_ID = 2
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000
MEMO = 400_000
STOPS = b".,"
LONG_PIECE = 256

WRITE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.size": str(PAGE_BYTES),
    "parquet.page.row.count.limit": str(PAGE_ROWS),
    "parquet.enable.dictionary": "true",
    **{f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "n_tokens", "local_start")},
}
SCHEMA = "doc_id long, n_tokens long, part int, local_start long, tokens array<int>"


class LibraryEncoder:
    """The tokenizers library's ids of a text, as int32 bytes, asked once for each known word.

    A text that may hold a special token goes to the library whole. Others are normalised
    and cut at ASCII spaces, which no pattern of the file reaches over: normalising and cutting
    are done here, and the library sees words. A piece is looked up without a full stop or comma behind its last letter or digit, where the pattern cuts
    anyway, and unknown words go to the library's BPE model.
    """

    def __init__(self, data: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(data.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.alphabet = byte_alphabet()
        self.memo = Memo(MEMO)
        self.stops = {c: self.word(chr(c)) for c in STOPS}

    def ids(self, shown: str) -> bytes:
        return array("i", [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()

    def word(self, word: str) -> bytes:
        key = word.encode()
        known = self.memo.get(key)
        if known is None:
            plain = word.isascii() and word.isprintable()
            shown = word if plain else "".join(map(self.alphabet.__getitem__, key))
            known = self.ids(shown)
            if len(key) <= LONG_PIECE:
                self.memo.put(key, known)
        return known

    def piece(self, piece: bytes) -> bytes:
        """Ids of a normalised piece that the young generation of the memo does not have."""
        tail = b""
        if piece[-1] in STOPS and piece[-2:-1].isalnum():
            piece, tail = piece[:-1], self.stops[piece[-1]]
            if (known := self.memo.young.get(piece)) is not None:
                return known + tail
        known = self.memo.old.get(piece)
        if known is None and piece.isalpha():  # ASCII letters alone: one word, shown as it is
            known = self.ids(piece.decode())
        if known is None:
            words = WORD.findall(piece.decode())
            known = self.word(words[0]) if len(words) == 1 else b"".join([self.word(w) for w in words])
        if len(piece) > LONG_PIECE:
            return known + tail
        self.memo.put(piece, known)
        return known + tail

    def text(self, text: str) -> bytes:
        if "<|" in text:
            return array("i", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        known, piece = self.memo.young.get, self.piece
        return b"".join([known(raw) or piece(raw) for raw in normal(text).encode().split()])


_encoders: dict[str, LibraryEncoder] = {}


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID) -> None:
    """Encode `docs` (doc_id, text) and write them below `path` in ascending doc_id order.

    One shuffle, of the texts by ranges of doc_id; encoding happens behind it, so the
    sampling that finds the ranges encodes nothing.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    spark = docs.sparkSession
    with open(tokenizer_path, "rb") as f:
        data = f.read()
    key, shipped = hashlib.sha256(data).hexdigest(), spark.sparkContext.broadcast(data)
    end = np.array([end_id], "<i4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if key not in _encoders:
            _encoders[key] = LibraryEncoder(shipped.value)
        encoder = _encoders[key]
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            coded = [encoder.text(v.as_py() or "") + end for v in batch.column(1)]
            counts = np.array([len(c) // 4 for c in coded], np.int64)
            ends = np.cumsum(counts)
            ids = pa.array(np.frombuffer(b"".join(coded), "<i4"))
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(counts), pa.array(np.full(len(counts), part, np.int32)),
                    pa.array(start + ends - counts), pa.ListArray.from_arrays(offsets, ids),
                ],
                names=["doc_id", "n_tokens", "part", "local_start", "tokens"],
            )
            start += int(counts.sum())

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = slim.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    map_arrow(ordered, work, SCHEMA).write.options(**WRITE_OPTIONS).parquet(path)


def read(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """The stored rows; a range of doc_id becomes a filter on row groups and pages."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    if first is not None:
        rows = rows.filter(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.filter(F.col("doc_id") <= last)
    return rows


def offsets(rows: DataFrame) -> DataFrame:
    """part and the ids before it. One row a file, which is what bounds the window and its broadcast."""
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))


def metadata(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens: reads none of the ids."""
    return rows.join(F.broadcast(offsets(rows)), "part").select(
        "doc_id", (F.col("_offset") + F.col("local_start")).alias("start"), "n_tokens"
    )


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(3)
        at = lists.offsets.to_numpy()
        ids = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
        crcs = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(at, at[1:])]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array([b - a for a, b in zip(at, at[1:])], pa.int64()), pa.array(crcs, pa.int64())],
            names=["doc_id", "part", "local_start", "n_tokens", "ids_crc32"],
        )


def digest(docs: DataFrame, tokenizer_path: str, path: str | None = None) -> DataFrame:
    """Write the store, read it back, and give start, length and checksum of each document's ids."""
    spark = docs.sparkSession
    path = path or new_folder(spark, "tokens")
    write(docs, path, tokenizer_path)
    rows = read(spark, path)
    coded = map_arrow(
        rows.select("doc_id", "part", "local_start", "tokens"), _checksums,
        "doc_id long, part int, local_start long, n_tokens long, ids_crc32 long",
    )
    return coded.join(F.broadcast(offsets(rows)), "part").select(
        "doc_id", (F.col("_offset") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )
