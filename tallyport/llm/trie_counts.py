"""Token counts by unigram segmentation, with forward scores shared over common prefixes.

A pre-token is a word with the word mark before it. Its best segmentation is found by the
forward recurrence over its prefixes. Prefixes are shared: the distinct pre-tokens of a
batch are sorted, which is the depth-first order of their trie, and the scores of the
current path stand on a stack, so the score of a shared prefix is computed once. What ends
at a terminal, the token count, is kept in a bounded memo for later batches. Nothing is
shuffled: counts of a document need only its own words.

A piece scores log of its Zipf probability by its place in the model file, whose own
scores are merge ranks and no log probabilities. A character that is no piece costs the
worst score minus 10 and counts as its UTF-8 bytes.

Defined results: a NULL or empty text has no tokens; rows that repeat are counted each; an
empty table gives no rows; a word without bound, in length, is scored with a sliding
window instead of a stack; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.llm.common import Memo, map_arrow

MARK = "▁"
UNKNOWN_PENALTY = 10.0
MEMO = 400_000
LONG_WORD = 256
BYTE_STEP = 1 << 32  # a packed count: tokens, and above them the byte tokens among them


def read_pieces(model_path: str) -> list[tuple[str, float]]:
    """The model's ordinary pieces in file order with their Zipf scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    usual = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    norm = math.log(sum(1 / (i + 1) for i in range(len(usual)))) if usual else 0.0
    return [(piece, -math.log(i + 1) - norm) for i, piece in enumerate(usual)]


class TrieCounter:
    def __init__(self, pieces: list[tuple[str, float]]):
        self.score = dict(pieces)
        self.longest = max(map(len, self.score), default=1)
        self.unknown = min(self.score.values(), default=0.0) - UNKNOWN_PENALTY
        self.counts = Memo(MEMO)

    def step(self, word: str, end: int, scores: list[float], counts: list[int], base: int = 0) -> tuple[float, int]:
        """Best score and packed count of word[:end]; scores[i - base] and counts hold those of word[:i].

        Longer last pieces are tried first and only a better score replaces them.
        """
        best, count = -math.inf, 0
        look = self.score.get
        for start in range(max(0, end - self.longest), end):
            score = look(word[start:end])
            if score is not None and scores[start - base] + score > best:
                best, count = scores[start - base] + score, counts[start - base] + 1
        if word[end - 1] not in self.score and scores[end - 1 - base] + self.unknown > best:
            n = len(word[end - 1].encode("utf-8", "surrogatepass"))
            best, count = scores[end - 1 - base] + self.unknown, counts[end - 1 - base] + n + n * BYTE_STEP
        return best, count

    def walk(self, words: Iterable[str]) -> Iterator[tuple[str, int]]:
        """Words in sorted order with their packed counts: a depth-first walk of their trie."""
        scores, counts, path = [0.0], [0], ""
        for word in words:
            if len(word) > LONG_WORD:
                yield word, self.long(word)
                continue
            same = 0
            for a, b in zip(path, word):
                if a != b:
                    break
                same += 1
            del scores[same + 1 :], counts[same + 1 :]
            for end in range(same + 1, len(word) + 1):
                score, count = self.step(word, end, scores, counts)
                scores.append(score)
                counts.append(count)
            path = word
            yield word, counts[-1]

    def long(self, word: str) -> int:
        """The same for one word, keeping only as many prefixes as the longest piece needs."""
        scores, counts, base = [0.0], [0], 0
        for end in range(1, len(word) + 1):
            score, count = self.step(word, end, scores, counts, base)
            scores.append(score)
            counts.append(count)
            if len(scores) > 4 * self.longest:
                drop = len(scores) - self.longest
                del scores[:drop], counts[:drop]
                base += drop
        return counts[-1]

    def batch(self, texts: list[str]) -> list[tuple[int, int, int]]:
        """(pre-tokens, tokens, byte tokens) of each text."""
        split = [t.encode("utf-8", "surrogatepass").split() for t in texts]
        young, old = self.counts.young, self.counts.old
        missing = {w for words in split for w in words if w not in young and w not in old}
        fresh = {}
        for word, count in self.walk(sorted(MARK + w.decode("utf-8", "surrogatepass") for w in missing)):
            fresh[word[1:].encode("utf-8", "surrogatepass")] = count
        out = []
        for words in split:
            total = 0
            for w in words:
                count = young.get(w) or fresh.get(w)
                total += old[w] if count is None else count
            out.append((len(words), total % BYTE_STEP, total // BYTE_STEP))
        for word, count in fresh.items():
            if len(word) <= LONG_WORD:
                self.counts.put(word, count)
        return out


_counters: dict[tuple, TrieCounter] = {}


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pretokens, n_tokens, n_byte_tokens of each whole text; one pass, no shuffle.

    The pieces are broadcast; their number is fixed by the model file.
    """
    pieces = read_pieces(model_path)
    key, shipped = (len(pieces), hash(tuple(pieces))), docs.sparkSession.sparkContext.broadcast(pieces)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _counters:
            _counters[key] = TrieCounter(shipped.value)
        counter = _counters[key]
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                rows = counter.batch([t or "" for t in batch.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(3))],
                    names=["doc_id", "n_pretokens", "n_tokens", "n_byte_tokens"],
                )

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(slim, work, "doc_id long, n_pretokens long, n_tokens long, n_byte_tokens long")
