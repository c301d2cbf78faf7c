import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer, models

from tallyport.llm import bpe_stream as B
from tallyport.llm import token_store as T
from tallyport.llm import trie_counts as C

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PARTS = list("abcdefghiITHEn'sstredvml    .,!?-\n\t09ÉéßΣσςİıÅ") + [
    "́", "̊", "é", "ᄀ", "ᅡ", "ᆨ", "\x1c", "\x85", "\xa0", "<|endoftext|>", "<|start",
    "<|startoftext|>", "日本", "🙂", "'re", "'ll", "'v", "½", "Ⅷ", "ﬁ", "　", "\x00", "\x7f",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as f:
        return B.BpeModel(f.read())


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.choice([0, 1, 3, 8, 30, 200]))) for _ in range(n)]


def test_pieces_and_library_lookup(library, model):
    whole = B.PieceEncoder(model, tuple, lambda words: sum(words, ()))
    with open(PATH, "rb") as f:
        looked_up = T.LibraryEncoder(f.read())
    for text in texts(1, 1500):
        want = library.encode(text, add_special_tokens=False).ids
        assert [i for piece in whole.text(text) for i in piece] == want, repr(text)
        assert looked_up.text(text) == np.array(want, "<i4").tobytes(), repr(text)


def test_stream_in_any_chunks(library, model):
    rng = random.Random(3)
    for text in texts(2, 800):
        encoder, out, at = B.StreamEncoder(model), [], 0
        while at < len(text):
            n = rng.choice([1, 2, 5, 50])
            out += encoder.feed(text[at : at + n])
            at += n
        assert out + encoder.finish() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_long_word_in_constant_memory(library, model):
    rng = random.Random(4)
    word = "".join(rng.choice("abcdehinorstu") for _ in range(20_000))
    run, out, most = B.WordTransducer(model), [], 0
    for at in range(0, len(word), 97):
        out += run.feed(word[at : at + 97].encode())
        most = max(most, len(run.symbols))
    assert out + run.finish() == library.encode(word, add_special_tokens=False).ids
    assert most <= run.full + B.BLOCK


def test_lookahead_of_known_lists():
    assert B.sufficient_lookahead([]) == (0, 1)
    assert B.sufficient_lookahead([("a", "b")]) == (1, 2)
    # a+b waits for what takes b away, which waits for what takes c away.
    assert B.sufficient_lookahead([("c", "d"), ("b", "c"), ("a", "b")])[0] == 3
    assert B.sufficient_lookahead([("a", "b"), ("b", "c"), ("c", "d")])[0] == 1


@pytest.mark.parametrize("seed", range(6))
def test_lookahead_suffices_for_random_lists(seed):
    """Tokens that end the lookahead before the end of a prefix are those of every continuation."""
    rng = random.Random(seed)
    known, merges = list("abc"), []
    while len(merges) < 14:
        pair = (rng.choice(known), rng.choice(known))
        if pair not in merges and len("".join(pair)) <= 6:
            merges.append(pair)
            known.append("".join(pair))
    ids = {t: i for i, t in enumerate(dict.fromkeys(known))}
    model = B.BpeModel.__new__(B.BpeModel)
    model.rank = {}
    for i, (a, b) in enumerate(merges):
        model.rank.setdefault((ids[a] << B.RANK_SHIFT) | ids[b], (i << B.RANK_SHIFT) | ids[a + b])
    names = {i: t for t, i in ids.items()}
    spelled = lambda text: [names[i] for i in model.merge([ids[c] for c in text])]
    lookahead, _ = B.sufficient_lookahead(merges)
    for _ in range(300):
        text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 40)))
        longer = spelled(text + "".join(rng.choice("abc") for _ in range(20)))
        end = 0
        for i, token in enumerate(spelled(text)):
            end += len(token)
            if end + lookahead > len(text):
                break
            assert longer[i] == token


def test_byte_decoder_round_trip(library, model):
    text = "the quick café 日本 🙂 fox"
    ids = library.encode(text, add_special_tokens=False).ids
    decoder = B.ByteDecoder(model)
    assert ("".join(decoder.feed([i]) for i in ids) + decoder.finish()).split() == text.split()


def test_windows_hold_no_whole_text(library, model, monkeypatch):
    """Ids are the same however small the windows, with spaces and without any."""
    texts = ["", " ", "a b  c", "the quick café 日本 🙂 fox <|endoftext|> it's we'll 123 ", "nospace" * 40, "x " * 50 + "y" * 200 + " é" * 9, "日本語" * 60]
    for chunk in (1, 7, 64, 1 << 16):
        monkeypatch.setattr(B, "CHUNK", chunk)
        encoder = B.PieceEncoder(model, tuple, lambda words: sum(words, ()))
        for text in texts:
            found = [[i for piece in window for i in piece] for window in encoder.windows(text)]
            assert sum(found, []) == library.encode(text, add_special_tokens=False).ids
            assert chunk > 100 or all(len(ids) <= 4 * chunk + B.LONG_PIECE for ids in found)


def test_decode(spark, library):
    texts = ["the quick café 日本 🙂 fox", "", "a" * 500 + " b"]
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    rows = spark.createDataFrame([*enumerate(ids), (7, None)], "doc_id long, ids array<int>")
    shown = {r.doc_id: r.text for r in B.decode(rows, PATH, surface=True).collect()}
    assert shown == {**{i: library.decode(x, skip_special_tokens=False) for i, x in enumerate(ids)}, 7: ""}
    plain = {r.doc_id: r.text for r in B.decode(rows, PATH).collect()}
    assert {i: t.split() for i, t in plain.items()} == {**{i: t.split() for i, t in enumerate(texts)}, 7: []}


def test_digest(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(1001, None), (1002, ""), (1003, "a " * 60_000), (None, "x"), (1003, "b")], "doc_id long, text string")
    rows = docs.select("doc_id", "text").unionByName(odd)
    got = sorted(map(tuple, B.digest(rows, PATH).collect()), key=str)
    want = []
    for r in rows.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        shown = library.decode(ids, skip_special_tokens=False)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(shown)))
    assert got == sorted(want, key=str)
    assert B.digest(rows.limit(0), PATH).count() == 0
    assert B.encode(odd, PATH).filter("doc_id = 1003").selectExpr("size(ids) n").agg({"n": "max"}).first()[0] == 60_000


def test_store(spark, sf_dir, folder, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-5, None), (5000, ""), (5000, "")], "doc_id long, text string"))
    path = f"{folder}/store"
    got = T.digest(docs, PATH, path).collect()
    start, want = 0, []
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got)) == sorted(want)
    assert sorted(map(tuple, T.metadata(T.read(spark, path)).collect())) == sorted(w[:3] for w in want)
    some = T.read(spark, path, 10, 12)
    assert "tokens:array" not in T.metadata(T.read(spark, path))._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert sorted(r.doc_id for r in some.collect()) == [10, 11, 12]
    files = [f for f in __import__("pathlib").Path(path.removeprefix("file:")).glob("*.parquet")]
    meta = pq.ParquetFile(files[0]).metadata.row_group(0)
    by_name = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    tokens = next(c for n, c in by_name.items() if n.startswith("tokens"))
    assert "RLE_DICTIONARY" in tokens.encodings and tokens.has_offset_index
    assert "DELTA_BINARY_PACKED" in by_name["doc_id"].encodings and by_name["doc_id"].has_column_index
    assert T.digest(docs.limit(0), PATH).count() == 0


def test_counts_equal_the_librarys_unigram():
    pieces = C.read_pieces(PIECES)
    library, counter = models.Unigram([("<unk>", 0.0), *pieces], 0, False), C.TrieCounter(pieces)
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghinorstuéß,.-") for _ in range(rng.randint(1, 14))) for _ in range(2000)]
    for word in words:
        ((n_words, n_tokens, n_bytes),) = counter.batch([word])
        if not n_bytes:
            assert (n_words, n_tokens) == (1, len(library.tokenize(C.MARK + word))), word


def test_trie_shares_and_long_words():
    counter = C.TrieCounter([("▁", -3.0), ("a", -2.0), ("b", -2.0), ("ab", -2.5), ("▁ab", -4.0)])
    steps = []
    plain = counter.step
    counter.step = lambda *a: steps.append(a[1]) or plain(*a)
    assert counter.batch(["abab aba ab", "ab"]) == [(3, 2 + 2 + 1, 0), (1, 1, 0)]
    assert len(steps) == 5  # ▁abab once; the others are its prefixes
    assert counter.batch(["é"]) == [(1, 3, 2)]
    word = "ab" * 5000
    assert counter.long(C.MARK + word) == counter.batch([word])[0][1] == 5000


def test_counts_table(spark, sf_dir):
    docs = spark.createDataFrame(
        [(1, "the cat", 7), (1, "the cat", 7), (2, None, 7), (3, "", 7), (None, "x", 7), (4, "word " * 30_000, 7)],
        "doc_id long, text string, n_tokens int",
    )
    got = {r.doc_id: tuple(r)[1:] for r in C.token_counts(docs, PIECES).collect()}
    assert got[2] == got[3] == (0, 0, 0) and got[4][0] == 30_000 and got[4][1] % 30_000 == 0 and None in got
    assert C.token_counts(docs.limit(0), PIECES).count() == 0
