import random
from collections import defaultdict

from tallyport.llm import line_chunks as L


def lines(rng, n, words=9):
    return [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(words)) for _ in range(n)]


def brute(rows):
    """The operator's rule in plain Python: first occurrences in order of (doc_id, place)."""
    chunked = {}
    for doc_id, text in rows:
        at, out = 0, []
        raw = (text or "").encode()
        for key, n_lines, n_words, size in L.chunk_texts([text or ""])[0]:
            out.append((raw[at : at + size], n_lines, n_words))
            at += size + 1
        chunked[doc_id] = out
    first = {}
    for doc_id in sorted(chunked):
        for place, (piece, *_) in enumerate(chunked[doc_id]):
            first.setdefault(piece, (doc_id, place))
    result = {}
    for doc_id, chunks in chunked.items():
        kept, run = [], []
        for place, chunk in [*enumerate(chunks), (None, None)]:
            if chunk and first[chunk[0]] != (doc_id, place):
                run.append(chunk)
                continue
            if not (sum(c[1] for c in run) >= 2 or sum(c[2] for c in run) >= L.LONG_WORDS):
                kept += [c[0] for c in run]
            run = []
            if chunk:
                kept.append(chunk[0])
        result[doc_id] = b"\n".join(kept).decode()
    return result


def test_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: r.text for r in L.dedup_lines(docs).collect()}
    assert got == want


def test_boundaries_resist_shifts():
    rng = random.Random(1)
    passage = lines(rng, 40)
    keys = lambda text: [c[0] for c in L.chunk_texts([text])[0]]
    alone = keys("\n".join(passage))
    moved = keys("\n".join(lines(rng, 7) + passage + lines(rng, 5)))
    assert len(set(alone) - set(moved)) <= 2
    assert L.chunk_texts([]) == []


def test_chunks_cover_the_text():
    rng = random.Random(2)
    texts = ["", "\n", "one", "a\n\nb\n", "\n".join(lines(rng, 50)), "é\nü " * 30]
    for text, chunks in zip(texts, L.chunk_texts(texts)):
        assert sum(c[3] + 1 for c in chunks) == len(text.encode()) + 1
        assert sum(c[1] for c in chunks) == text.count("\n") + 1
        assert sum(c[2] for c in chunks) == len(text.split())


def test_shared_passages_go_once(spark):
    rng = random.Random(4)
    passage, long_line, licence = lines(rng, 12), lines(rng, 1, 60)[0], "some licence line"
    rows = []
    for i in range(8):
        own = lines(rng, 6)
        rows.append((i, "\n".join([licence, *own[:3], *passage, *own[3:], long_line]), i))
    docs = spark.createDataFrame(rows, "doc_id long, text string, repeated long")
    got = {r.doc_id: r for r in L.dedup_lines(docs).collect()}
    assert got[0].text == rows[0][1] and got[0].removed_lines == 0
    for i in range(1, 8):
        left = got[i].text.split("\n")
        assert licence in left and long_line not in left
        assert len(set(left) & set(passage)) <= 2
        assert len(set(rows[i][1].split("\n")) - set(passage) - {long_line} - set(left)) == 0
        assert got[i].repeated == i


def test_odd_rows(spark):
    rng = random.Random(6)
    text = "\n".join(lines(rng, 8))
    docs = spark.createDataFrame(
        [(1, text, 0), (1, text, 0), (None, text, 1), (2, None, 2), (3, "", 3), (4, text, 4), (5, "x\n" * 60_000, 5)],
        "doc_id long, text string, removed_lines int",
    )
    out = L.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "removed_lines", "removed_lines_", "removed_words"]
    got = defaultdict(list)
    for r in out.collect():
        got[r.doc_id].append(r.text)
    assert got[1] == [text, text] and got[None] == [text] and got[2] == [None] and got[3] == [""] and got[4] == [""]
    assert L.dedup_lines(docs.limit(0)).count() == 0


def test_short_passages_go_whole(spark):
    """Passages of 50 to 60 words in 2 to 6 lines, between lines of each document's own."""
    rng = random.Random(8)
    passages = [lines(rng, n, words) for n, words in ((2, 30), (3, 20), (4, 14), (5, 11), (6, 10)) for _ in range(6)]
    rows, own = [], {}
    for k, passage in enumerate(passages):
        for copy in range(3):
            own[3 * k + copy] = before, after = lines(rng, rng.randint(0, 3)), lines(rng, rng.randint(0, 3))
            rows.append((3 * k + copy, "\n".join([*before, *passage, *after])))
    got = {r.doc_id: r.text for r in L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        assert got[i] == (text if i % 3 == 0 else "\n".join(own[i][0] + own[i][1]))


def test_lines_that_never_stand_together_stay(spark):
    """Lines that each occur elsewhere, blank ones too, are no repeated run unless they stand there together."""
    rows = [
        (1, "Les.\nfirst text"), (2, "second text\nReleased under the MIT License."), (3, "Les.\nReleased under the MIT License."),
        (4, "\n\nLes.\n\n"), (5, "Les.\n\nfirst text"), (6, "own\n\nLes.\n\nfirst text\n\nother"), (7, "Les.\n \nfirst text"),
    ]
    got = {r.doc_id: (r.text, r.removed_lines, r.removed_words) for r in
           L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got.pop(6) == ("own\n\n\nother", 3, 3)
    assert got == {i: (t, 0, 0) for i, t in rows if i != 6}


def test_runs_by_their_definition(spark):
    """A line goes if a run around it stands earlier, with two lines with a word or LONG_WORDS words."""
    rng = random.Random(9)
    pool = ["", " ", "a", "b", "c d", "e", "long " * 60]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 9)))) for i in range(60)]
    seen, want = set(), {}
    for i, text in rows:
        parts, gone = text.split("\n"), set()
        for start in range(len(parts)):
            runs = [(end, tuple(parts[start:end])) for end in range(start + 1, len(parts) + 1)]
            for end, run in runs:
                enough = sum(bool(p.split()) for p in run) >= 2 or len(" ".join(run).split()) >= L.LONG_WORDS
                if run in seen and enough and run[0].split() and run[-1].split():
                    gone.update(range(start, end))
            seen.update(run for _, run in runs)
        want[i] = "\n".join(p for k, p in enumerate(parts) if k not in gone)
    got = {r.doc_id: r.text for r in L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want
