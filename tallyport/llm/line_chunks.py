"""Line dedup by content-defined chunks of lines.

A chunk reaches from one line with a word to the next such line, both included, with the
blank lines between them; a line of LONG_WORDS words or more is a chunk as well. Chunks
overlap, and where one begins and ends depends on its own lines only, so no neighbour can
hide a repeat. Chunks that occur more than once in the whole corpus are compared byte by
byte with their first occurrence (smallest doc_id, then place), and a document loses the
lines of each chunk that repeats an earlier one.

Every run of lines that stands earlier in the corpus with the same lines together, and
has two lines with a word or LONG_WORDS words, is made of such chunks, and every such chunk
is such a run: so these runs go whole, and nothing else goes. A single short line stays,
however often it occurs, also beside another that occurs elsewhere. Blank lines go inside
a run and stay at its ends.

Occurrences are narrow rows, counted with partial sums; texts are shuffled to fetch the
repeated chunks and once more to apply what was decided. A chunk that a third of all
documents share meets only aggregates and joins that Spark splits.

Defined results: a NULL text stays NULL and an empty one empty; a document without doc_id
is left as it is and is nobody's first occurrence; rows that repeat a doc_id are one
document, so a copy of the row itself removes nothing, and where their texts differ a
decision holds for the chunk it was made for; an empty table gives an empty table; other
columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyport.llm.common import free_name, map_arrow, slices, stored
from tallyport.llm.hashing import BASE, GOLDEN, SPACE, mix, segment_hashes

LONG_WORDS = 50


class Lines:
    """The lines of several texts, each hashed on its own."""

    def __init__(self, texts: list[str]):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
        self.ends = np.flatnonzero(self.data == 10)
        self.starts = np.concatenate([[0], self.ends[:-1] + 1]) if len(self.ends) else self.ends
        self.hashes = segment_hashes_with_gaps(self.data, self.starts, self.ends)
        space = SPACE[self.data]
        word_starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]])) if len(space) else self.ends
        self.words = np.searchsorted(word_starts, self.ends) - np.searchsorted(word_starts, self.starts)
        text_ends = np.cumsum([len(r) + 1 for r in raw]) - 1
        # Number of each text's first line, and one more at the end.
        self.first = np.concatenate([[0], np.searchsorted(self.ends, text_ends) + 1]).astype(np.int64)
        self.text_of = np.repeat(np.arange(len(raw)), np.diff(self.first))

    def each(self) -> list[list[tuple[int, int, int, int]]]:
        """For each text its lines in order: (key, 1, words, bytes)."""
        keys, sizes = self.hashes.astype(np.int64).tolist(), (self.ends - self.starts).tolist()
        rows = [(k, 1, w, n) for k, w, n in zip(keys, self.words.tolist(), sizes)]
        return [rows[a:b] for a, b in zip(self.first, self.first[1:])]

    def chunks(self) -> list[list[tuple[int, int, int, int, int]]]:
        """For each text its chunks in order: (key, first line, last line, first byte, byte after the last)."""
        worded = np.flatnonzero(self.words)
        a, b = worded[:-1], worded[1:]
        together = self.text_of[a] == self.text_of[b]
        a, b = a[together], b[together]
        gap, blank = np.zeros(len(a), np.uint64), b > a + 1
        gap[blank] = segment_hashes(self.data, self.ends[a[blank]], self.starts[b[blank]])
        pairs = mix(mix(self.hashes[a] * GOLDEN + gap) * BASE + self.hashes[b])
        alone = np.flatnonzero(self.words >= LONG_WORDS)
        keys = np.concatenate([pairs, mix(self.hashes[alone] + GOLDEN)]).astype(np.int64)
        a, b = np.concatenate([a, alone]), np.concatenate([b, alone])
        order = np.lexsort((b, a))
        keys, a, b = keys[order], a[order], b[order]
        base, zero = self.first[self.text_of[a]], self.starts[self.first[self.text_of[a]]]
        rows = list(zip(
            keys.tolist(), (a - base).tolist(), (b - base).tolist(), (self.starts[a] - zero).tolist(), (self.ends[b] - zero).tolist()
        ))
        bounds = np.searchsorted(a, self.first)
        return [rows[x:y] for x, y in zip(bounds, bounds[1:])]


def chunk_texts(texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
    """For each text its lines, of which chunks are made: (key, 1, words, bytes)."""
    return Lines(texts).each()


def segment_hashes_with_gaps(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """`segment_hashes` where ranges may be empty (they hash to a constant)."""
    out = np.zeros(len(starts), np.uint64)
    full = ends > starts
    out[full] = segment_hashes(data, starts[full], ends[full])
    return out


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        texts = [t or "" for t in whole.column(1).to_pylist()]
        for a, b in slices(texts):
            chunks = Lines(texts[a:b]).chunks()
            per_text = np.array([len(c) for c in chunks])
            ids = whole.column(0).slice(a, b - a).take(pa.array(np.repeat(np.arange(b - a), per_text)))
            yield pa.RecordBatch.from_arrays(
                [
                    ids, pa.array([x[1] for c in chunks for x in c], pa.int32()),
                    pa.array([x[0] for c in chunks for x in c], pa.int64()),
                ],
                names=["doc_id", "place", "key"],
            )


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the chunks named in column 2 (place, key)."""
    for whole in batches:
        texts, wanted = whole.column(1).to_pylist(), whole.column(2).to_pylist()
        for a, b in slices(texts):
            rows = []
            for i, chunks in enumerate(Lines(texts[a:b]).chunks(), a):
                raw, want = texts[i].encode("utf-8", "surrogatepass"), {(w["place"], w["key"]) for w in wanted[i]}
                doc_id = whole.column(0)[i].as_py()
                rows += [(doc_id, place, key, raw[x:y]) for key, place, _, x, y in chunks if (place, key) in want]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[j] for r in rows], kind) for j, kind in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.binary()))],
                names=["doc_id", "place", "key", "bytes"],
            )


def cut(
    text: str, lines: list[tuple[int, int, int, int]], chunks: list[tuple[int, int, int, int, int]], repeated: set[tuple[int, int]]
) -> tuple[str, int, int]:
    """Text without the lines of its repeated chunks; lines and words that were removed."""
    gone = {i for key, place, last, _, _ in chunks if (place, key) in repeated for i in range(place, last + 1)}
    kept = [line for i, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")) if i not in gone]
    return b"\n".join(kept).decode("utf-8", "surrogatepass"), len(gone), sum(lines[i][2] for i in gone)


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns: text, repeated chunks, anything; text is replaced, removed lines and words are added."""
    for whole in batches:
        texts, repeated = whole.column(0).to_pylist(), whole.column(1).to_pylist()
        out, lines, words = list(texts), [0] * len(texts), [0] * len(texts)
        touched = [i for i, r in enumerate(repeated) if r and texts[i]]
        for a, b in slices([texts[i] for i in touched]):
            scanned = Lines([texts[i] for i in touched[a:b]])
            for i, each, chunks in zip(touched[a:b], scanned.each(), scanned.chunks()):
                out[i], lines[i], words[i] = cut(texts[i], each, chunks, {(r["place"], r["key"]) for r in repeated[i]})
        yield pa.RecordBatch.from_arrays(
            [pa.array(out, pa.string()), pa.array(lines, pa.int64()), pa.array(words, pa.int64()), *whole.columns[2:]],
            names=["text", "removed_lines", "removed_words", *whole.schema.names[2:]],
        )


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """doc_id and its list of (place, key) of chunks that equal an earlier one byte by byte."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).filter(
        "doc_id IS NOT NULL AND text IS NOT NULL"
    )
    found = stored(map_arrow(slim, _occurrences, "doc_id long, place int, key long").distinct(), "chunks")
    often = found.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    per_doc = (
        found.join(often, "key").groupBy(F.col("doc_id").alias("_id"))
        .agg(F.collect_list(F.struct("place", "key")).alias("wanted"))
    )
    bytes_of = stored(
        map_arrow(
            slim.join(per_doc, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "wanted"), _fetch,
            "doc_id long, place int, key long, bytes binary",
        ),
        "chunk-bytes",
    )
    # Places of first occurrences are found on narrow rows; only their bytes travel with the key.
    first = bytes_of.groupBy("key").agg(F.min(F.struct("doc_id", "place")).alias("f")).select("key", "f.*")
    canonical = bytes_of.join(first, ["key", "doc_id", "place"]).select(
        "key", F.col("bytes").alias("first_bytes"), F.col("doc_id").alias("first_id"), F.col("place").alias("first_place")
    ).dropDuplicates(["key"])
    return (
        bytes_of.join(canonical, "key")
        .filter("bytes = first_bytes AND NOT (doc_id = first_id AND place = first_place)")
        .groupBy("doc_id").agg(F.collect_set(F.struct("place", "key")).alias("repeated"))
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All rows and columns of `docs`, text without repeated runs, and what was removed."""
    decided = stored(repeated_chunks(docs), "repeated").select(F.col("doc_id").alias("_id"), "repeated")
    lines, words = free_name(docs.columns, "removed_lines"), free_name(docs.columns, "removed_words")
    others = [c for c in docs.columns if c != "text"]
    joined = docs.join(decided, docs["doc_id"] == decided["_id"], "left")
    packed = joined.select(docs["text"], decided["repeated"], F.struct(*(docs[c] for c in others)).alias("row"))
    schema = T.StructType(
        [T.StructField("text", T.StringType()), T.StructField("removed_lines", T.LongType()),
         T.StructField("removed_words", T.LongType()), packed.schema["row"]]
    )
    out = map_arrow(packed, _cut_batches, schema)
    return out.select(
        *(F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns),
        F.col("removed_lines").alias(lines), F.col("removed_words").alias(words),
    )


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, removed lines and words, and length and checksum of what is left, for each document."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "removed_lines", "removed_words", F.length("text").cast("long").alias("left_chars"),
        F.sha2("text", 256).alias("left_sha256"),
    )
