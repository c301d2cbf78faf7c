"""Rule bitmask ledger: every rule once, failure bits and measurements kept, policies on top.

`ledger` measures a text once and stores one bit for each rule it fails. A policy is a
mask over those bits with a version; applying another version, or asking what a rule
alone would change, only reads the stored bits.

Defined results: a NULL text has no words and is measured as the empty text; rows that
repeat are measured one by one; an empty table gives an empty ledger; other columns of
the input are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyport.llm.common import ASCII_SPACE, map_arrow

SYMBOLS = "#*$%&|<>"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = UPPER + UPPER.lower()

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters",
)

# Rule: name and SQL condition on the measurements under which a text fails. The place in
# this list is the bit; rules are only ever appended.
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 10 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("shouting", "100 * n_upper > 40 * n_letters"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
)
BIT = {name: i for i, (name, _) in enumerate(RULES)}
BASE = ("few_words", "repeated_windows")

# Policies by version; each names the rules that reject.
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "symbols", "repeated_lines"),
    "v2": (*BASE, "symbols", "repeated_lines", "shouting", "short_words", "long_words"),
}
CURRENT = "v2"


def mask(rules: tuple[str, ...]) -> int:
    return sum(1 << BIT[r] for r in rules)


def measure(text: str) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [line for line in text.split("\n") if line.strip(ASCII_SPACE)]
    windows = list(zip(words, words[1:], words[2:]))
    return (
        len(words),
        len(text) - sum(map(text.count, ASCII_SPACE)),
        sum(map(text.count, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated(windows),
        len(raw) - len(raw.translate(None, UPPER)),
        len(raw) - len(raw.translate(None, LETTERS)),
    )


def repeated(windows: list[tuple]) -> int:
    """Words that lie in a window found twice or more."""
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    covered, reach = 0, -1
    for i, window in enumerate(windows):
        if found[window] > 1:
            covered += i + 2 - max(reach, i - 1)
            reach = i + 2
    return covered


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [measure(t.as_py() or "") for t in batch.column(1)]
        columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(MEASURES))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *MEASURES])


def failure_bits() -> Column:
    """One long with a bit for each rule that the row's measurements fail."""
    bits = F.lit(0).cast("long")
    for i, (_, condition) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the measurements and `bits`: no shuffle, one pass over the texts."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)
    return map_arrow(slim, _measure_batches, schema).withColumn("bits", failure_bits())


def apply_policy(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """Adds `kept`: no bit of the policy's mask is set."""
    return rows.withColumn("kept", F.col("bits").bitwiseAND(F.lit(mask(POLICIES[version]))) == 0)


def ablation(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """For each rule of a policy: rows that fail it, and rows that it alone rejects.

    Rows are first counted by their bits, so what is compared afterwards has at most one
    row for each combination of failures.
    """
    chosen = mask(POLICIES[version])
    by_bits = rows.groupBy(F.col("bits").bitwiseAND(F.lit(chosen)).alias("bits")).agg(F.count("*").alias("n"))
    rules = [F.struct(F.lit(r).alias("rule"), F.lit(1 << BIT[r]).cast("long").alias("bit")) for r in POLICIES[version]]
    return (
        by_bits.select("bits", "n", F.explode(F.array(*rules)).alias("r"))
        .groupBy(F.lit(version).alias("version"), F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only_by_this"),
            F.sum(F.when(F.col("bits") != 0, F.col("n")).otherwise(0)).alias("n_rejected"),
        )
    )


def digest(docs: DataFrame) -> DataFrame:
    """The query's columns: counts, the base verdict and the current policy's."""
    return apply_policy(ledger(docs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("bits").bitwiseAND(F.lit(mask(BASE))) != 0).alias("base_failed"),
        "kept", "n_lines", "n_upper", "n_letters", "bits",
    )


WORD = r"[^\x20\x09-\x0D]+"
ORACLE = f"""
WITH t AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, r, text, regexp_extract_all(text, '{WORD}') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM t),
p AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
      FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM w)),
d AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM p) WHERE n > 1),
c AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM d) GROUP BY r),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
             len(regexp_extract_all(text, '[A-Z]'))::BIGINT AS n_upper,
             len(regexp_extract_all(text, '[A-Za-z]'))::BIGINT AS n_letters
      FROM w LEFT JOIN c USING (r)),
b AS (SELECT *, ({' + '.join(f'CASE WHEN {c} THEN {1 << i} ELSE 0 END' for i, (_, c) in enumerate(RULES))})::BIGINT
             AS bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (bits & {mask(BASE)}) <> 0 AS base_failed,
       (bits & {mask(POLICIES[CURRENT])}) = 0 AS kept, n_lines, n_upper, n_letters, bits
FROM b
"""
