"""BPE as a bounded-lookahead streaming transducer, and its incremental decoder.

A merge list has a sufficient lookahead: a number of symbols after a token's end beyond
which nothing can change that token any more. `sufficient_lookahead` computes it from the
list. `WordTransducer` therefore holds at most lookahead + longest token + one block of
symbols, emits a token once that many symbols follow it, and never sees a word whole.
`StreamEncoder` puts normalisation and pre-tokenization in front, again holding only what
the next characters may still change. `ByteDecoder` turns token bytes into text as they
arrive, `SurfaceDecoder` does it as the library does for a file that names no decoder.

`PieceEncoder` takes a text window by window, cut at ASCII spaces, which no pattern reaches
over. What the transducer makes of a word or piece, and what the decoder makes of its ids,
is remembered for the frequent ones. `digest` hashes ids and decoded text as they come, so
beside the text itself and the bounded memories nothing grows with it.

Why dropping emitted tokens is sound: no merge of the full run crosses a boundary of its
result, so what follows a settled boundary is merged as if it stood alone.

Defined results: a NULL or empty text has no tokens and decodes to the empty text; the
strings of special tokens inside a text become those tokens, as in the library; rows that
repeat are encoded each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.llm.common import Memo, map_arrow

END = "</w>"
# The kinds of words that the tokenizer file's own pattern names.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
LETTER_RUN = regex.compile(r"[\p{L}]+")
OTHER_RUN = regex.compile(r"[^\s\p{L}\p{N}]+")
OPEN_CONTRACTION = regex.compile(r"'(?:[rvl])?\Z")

BLOCK = 256  # symbols merged at once in a long word
LONG_PIECE = 256  # characters; longer pieces are streamed and not remembered
CHUNK = 1 << 16  # characters handed to the stream encoder at once, and of a window at least
ASCII_SPACE = regex.compile(r"[\x20\x09-\x0D]")
MEMO_WORDS = 250_000
MEMO_PIECES = 250_000
RANK_SHIFT = 24
NONE = 1 << 60


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


def sufficient_lookahead(merges: list[tuple[str, str]]) -> tuple[int, int]:
    """(lookahead, longest token), both in symbols.

    A merge (left, right) needs `right` complete: its length, and whatever may still take
    its last part away. `reach[left]` is the most that a merge of `left` with something
    earlier in the list needs; `inner[token]` the same for the parts at the token's right
    edge, each against the merges that come before the part is used up. Both only look at
    earlier merges, so one pass in list order fills them.
    """
    length = lambda token: len(token.removesuffix(END))
    reach: dict[str, int] = {}
    inner: dict[str, int] = {}
    longest = 1
    for left, right in merges:
        held = max(reach.get(right, 0), inner.get(right, 0))
        inner.setdefault(left + right, held)
        reach[left] = max(reach.get(left, 0), length(right) + held)
        longest = max(longest, length(left + right))
    return max([0, *reach.values(), *inner.values()]), longest


class BpeModel:
    """Vocabulary, merges and specials of a tokenizer file with word ends."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.lookahead, self.longest = sufficient_lookahead(merges)
        ids = self.vocab
        self.rank = {
            (ids[a] << RANK_SHIFT) | ids[b]: (i << RANK_SHIFT) | ids[a + b] for i, (a, b) in enumerate(merges)
        }
        alphabet = byte_alphabet()
        self.inside = [ids[c] for c in alphabet]
        self.final = [ids[c + END] for c in alphabet]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t.get("special")}
        self.special_split = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
            if self.special
            else None
        )
        self.surface = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        back = {c: bytes([b]) for b, c in enumerate(alphabet)}
        self.bytes_of = {
            i: t.encode() if t in self.special else b"".join(back[c] for c in t.removesuffix(END)) + b" " * t.endswith(END)
            for i, t in self.surface.items()
        }

    def merge(self, symbols: list[int]) -> list[int]:
        """All merges of `symbols`, lowest rank first and leftmost among equals."""
        rank = self.rank
        tokens = list(symbols)
        pairs = [rank.get((a << RANK_SHIFT) | b, NONE) for a, b in zip(tokens, tokens[1:])]
        while pairs and (best := min(pairs)) != NONE:
            i = pairs.index(best)
            tokens[i : i + 2] = [best & ((1 << RANK_SHIFT) - 1)]
            del pairs[i]
            if i:
                pairs[i - 1] = rank.get((tokens[i - 1] << RANK_SHIFT) | tokens[i], NONE)
            if i < len(pairs):
                pairs[i] = rank.get((tokens[i] << RANK_SHIFT) | tokens[i + 1], NONE)
        return tokens

    def size(self, token: int) -> int:
        """Symbols of a token."""
        return len(self.surface[token].removesuffix(END))


class WordTransducer:
    """Feeds one word's bytes in any portions; gives tokens as soon as they are settled."""

    def __init__(self, model: BpeModel):
        self.model = model
        self.symbols: list[int] = []
        self.last: int | None = None
        self.full = model.lookahead + model.longest + BLOCK

    def feed(self, data: bytes) -> list[int]:
        out: list[int] = []
        inside = self.model.inside
        for start in range(0, len(data), BLOCK):
            part = data[start : start + BLOCK]
            if self.last is not None:
                self.symbols.append(inside[self.last])
            self.symbols.extend(inside[b] for b in part[:-1])
            self.last = part[-1]
            if len(self.symbols) >= self.full:
                out += self._settled()
        return out

    def _settled(self) -> list[int]:
        out, end = [], 0
        limit = len(self.symbols) - self.model.lookahead
        for token in self.model.merge(self.symbols):
            size = self.model.size(token)
            if end + size > limit:
                break
            out.append(token)
            end += size
        del self.symbols[:end]
        return out

    def finish(self) -> list[int]:
        if self.last is None:
            return []
        symbols = [*self.symbols, self.model.final[self.last]]
        self.symbols, self.last = [], None
        return self.model.merge(symbols)


def normal(text: str) -> str:
    """NFC, then lower case character by character (so no final sigma)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def joins_left(char: str) -> bool:
    """Whether NFC may compose `char` with what stands before it."""
    return unicodedata.category(char)[0] == "M" or 0x1160 <= ord(char) <= 0x11FF


class StreamEncoder:
    """Encodes a text that arrives in chunks; state is bounded however long text or words are."""

    def __init__(self, model: BpeModel):
        self.model = model
        self.raw = ""  # characters whose normal form or special token is not settled
        self.tail = ""  # normalised characters that may begin a longer pattern
        self.open: tuple[regex.Pattern, WordTransducer] | None = None
        self.widest = max(map(len, model.special), default=1)

    def feed(self, chunk: str) -> list[int]:
        self.raw += chunk
        cut = len(self.raw) - 1
        at = self.raw.rfind("<", max(0, len(self.raw) - self.widest)) if self.model.special else -1
        if at >= 0:
            cut = min(cut, at)
        while cut > 0 and joins_left(self.raw[cut]):
            cut -= 1
        at = self.raw.rfind("<", max(0, cut - self.widest), max(cut, 0)) if self.model.special else -1
        if at >= 0 and any(self.raw.startswith(s, at) and at + len(s) > cut for s in self.model.special):
            cut = at
        if cut <= 0:
            return []
        ready, self.raw = self.raw[:cut], self.raw[cut:]
        return self._parts(ready, last=False)

    def finish(self) -> list[int]:
        ready, self.raw = self.raw, ""
        return self._parts(ready, last=True)

    def _parts(self, text: str, last: bool) -> list[int]:
        out: list[int] = []
        parts = self.model.special_split.split(text) if self.model.special_split else [text]
        for i, part in enumerate(parts):
            if i % 2:
                out += self._words("", True)
                out.append(self.model.special[part])
            else:
                out += self._words(normal(part), last and i == len(parts) - 1)
        return out

    def _words(self, text: str, last: bool) -> list[int]:
        out: list[int] = []
        text, self.tail = self.tail + text, ""
        at = 0
        if self.open:
            run, word = self.open
            if found := run.match(text):
                out += word.feed(found.group().encode())
                at = found.end()
            if at == len(text) and not last:
                return out
            out += word.finish()
            self.open = None
        for found in WORD.finditer(text, at):
            start, end = found.span()
            if not last and text[start] == "'" and OPEN_CONTRACTION.match(text, start):
                self.tail = text[start:]
                break
            word = WordTransducer(self.model)
            out += word.feed(found.group().encode())
            if end == len(text) and not last:
                run = next((r for r in (LETTER_RUN, OTHER_RUN) if r.fullmatch(found.group())), None)
                if run:
                    self.open = (run, word)
                    break
            out += word.finish()
        return out


class ByteDecoder:
    """Token by token to text: bytes that do not yet end a character wait for the next token."""

    def __init__(self, model: BpeModel):
        self.model = model
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        return self.state.decode(b"".join(map(self.model.bytes_of.__getitem__, ids)))

    def finish(self) -> str:
        return self.state.decode(b"", True)


class SurfaceDecoder:
    """As the library decodes a file that names no decoder: token strings with a space between."""

    def __init__(self, model: BpeModel):
        self.model = model
        self.begun = False

    def feed(self, ids: list[int]) -> str:
        return self.resume(" ".join(map(self.model.surface.__getitem__, ids)))

    def resume(self, known: str) -> str:
        """What comes next if the ids that follow are known to decode to `known` alone."""
        if not known:
            return ""
        known, self.begun = " " * self.begun + known, True
        return known


class PieceEncoder:
    """Ids of whole texts: pieces between ASCII spaces go through the transducer once each.

    No pattern, special token or normal form reaches over an ASCII space, so a text is the
    sequence of its pieces. `render` says what is remembered of a word's ids, `combine`
    what that makes of several words; nothing is remembered of a piece without tokens.
    """

    def __init__(self, model: BpeModel, render, combine):
        self.model = model
        self.render = render
        self.combine = combine
        self.words = Memo(MEMO_WORDS)
        self.pieces = Memo(MEMO_PIECES)

    def word(self, word: str):
        known = self.words.get(word)
        if known is None:
            run = WordTransducer(self.model)
            known = self.render(run.feed(word.encode()) + run.finish())
            self.words.put(word, known)
        return known

    def piece(self, piece: bytes):
        known = self.pieces.get(piece)
        if known is not None:
            return known
        text = piece.decode()
        if len(text) > LONG_PIECE or "<|" in text:
            ids = list(self.stream(text))
            return self.render(ids) if ids else None
        words = [self.word(w) for w in WORD.findall(normal(text))]
        if not words:
            return None
        known = words[0] if len(words) == 1 else self.combine(words)
        self.pieces.put(piece, known)
        return known

    def blocks(self, text: str) -> Iterator[list[int]]:
        """Ids as they settle, a chunk of the text after the other."""
        encoder = StreamEncoder(self.model)
        for start in range(0, len(text), CHUNK):
            yield encoder.feed(text[start : start + CHUNK])
        yield encoder.finish()

    def stream(self, text: str) -> Iterator[int]:
        for ids in self.blocks(text):
            yield from ids

    def windows(self, text: str) -> Iterator[list]:
        """`text` of one window after the other; a window that has no space for long is streamed."""
        at = 0
        while at < len(text):
            space = ASCII_SPACE.search(text, at + CHUNK)
            end = space.start() if space else len(text)
            if end - at <= 2 * CHUNK:
                yield self.text(text[at:end])
            else:
                yield from ([self.render(ids)] for ids in self.blocks(text[at:end]) if ids)
            at = end

    def text(self, text: str) -> list:
        """What is remembered of each piece of `text`, in order."""
        known, piece = self.pieces.young.get, self.piece
        found = [known(raw) or piece(raw) for raw in text.encode().split()]
        return found if all(found) else [f for f in found if f]


_encoders: dict[str, PieceEncoder] = {}


def _summary(model: BpeModel):
    def render(ids: list[int]) -> tuple[str, str]:
        return " ".join(map(str, ids)), SurfaceDecoder(model).feed(ids)

    def combine(words: list[tuple[str, str]]) -> tuple[str, str]:
        return " ".join([w[0] for w in words]), " ".join([w[1] for w in words])

    return render, combine


def digest(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each whole text; one pass, no shuffle.

    The tokenizer file is read by the driver and broadcast (its size is fixed by the file);
    each worker keeps one encoder with bounded memos.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, "rb") as f:
        data = f.read()
    key, shipped = hashlib.sha256(data).hexdigest(), spark.sparkContext.broadcast(data)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _encoders:
            model = BpeModel(shipped.value)
            _encoders[key] = PieceEncoder(model, *_summary(model))
        encoder = _encoders[key]
        for batch in batches:
            counts, ids, decoded = [], [], []
            for value in batch.column(1):
                n, of_ids, of_text, decoder = 0, hashlib.sha256(), hashlib.sha256(), SurfaceDecoder(encoder.model)
                for found in filter(None, encoder.windows(value.as_py() or "")):
                    joined = " " * (n > 0) + " ".join([x[0] for x in found])
                    n += joined.count(" ") + (n == 0)
                    of_ids.update(joined.encode())
                    of_text.update(decoder.resume(" ".join([x[1] for x in found])).encode())
                counts.append(n)
                ids.append(of_ids.hexdigest())
                decoded.append(of_text.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(slim, work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode(rows: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids", surface: bool = False) -> DataFrame:
    """doc_id and text of each list of ids, a block of ids after the other.

    Token bytes are put together to characters, with a space for a word's end; with
    `surface` as the library's `decode` has it.
    """
    with open(tokenizer_path, "rb") as f:
        shipped = rows.sparkSession.sparkContext.broadcast(f.read())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = BpeModel(shipped.value)
        for batch in batches:
            texts = []
            for ids in batch.column(1).to_pylist():
                decoder, ids = SurfaceDecoder(model) if surface else ByteDecoder(model), ids or []
                parts = [decoder.feed(ids[at : at + CHUNK]) for at in range(0, len(ids), CHUNK)]
                texts.append("".join(parts if surface else [*parts, decoder.finish()]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    slim = rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return map_arrow(slim, work, "doc_id long, text string")


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the list of ids of each whole text."""
    spark = docs.sparkSession
    with open(tokenizer_path, "rb") as f:
        shipped = spark.sparkContext.broadcast(f.read())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(BpeModel(shipped.value), tuple, lambda words: sum(words, ()))
        for batch in batches:
            ids = [[i for piece in encoder.text(v.as_py() or "") for i in piece] for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"]
            )

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(slim, work, "doc_id long, ids array<int>")
