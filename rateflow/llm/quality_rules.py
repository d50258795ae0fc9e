"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements and
one bit per failed rule; policies are versioned bit masks over it, so a policy
change or an ablation never reads the texts again.

Edge cases: a null or empty text has no words and measures 0 everywhere (it fails
``few_words``); repeated rows are judged alike, each on its own; an empty table
gives an empty ledger; further columns pass through untouched.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rateflow.llm.common import append_columns, find_words

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

# (name, SQL condition over the measurements that holds where the rule fails), in
# bit order.  New rules are appended: a bit never changes its meaning.  All ratios
# are integer comparisons, so every engine agrees on them.
RULES = [
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}

# Versioned policies: the mask of the rules that reject a document.
POLICIES = {
    1: BIT["few_words"] | BIT["repeated_words"],
    2: BIT["few_words"] | BIT["repeated_words"] | BIT["word_length"] | BIT["symbols"],
    3: sum(BIT.values()),  # strict: repeated lines too, which also costs good documents
}
BASE_POLICY, CURRENT_POLICY = 1, 2


def repeated_words(words: list[str]) -> int:
    """Words that lie in a 3-word window found twice or more, first one included."""
    if len(words) < 4:
        return 0
    seen: dict[str, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    pair = ids[:-1] * len(seen) + ids[1:]
    _, pair = np.unique(pair, return_inverse=True)
    _, window, count = np.unique(pair[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)
    twice = np.flatnonzero(count[window] > 1)
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[twice + k] = True
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of MEASURES."""
    if not text:
        return (0,) * len(MEASURES)
    words = find_words(text)
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    n_lines, distinct = len(lines), len(set(lines))
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)),
            n_lines - distinct, repeated_words(words), n_lines)


def ledger(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with a column per measurement and the ``failures`` bits.

    ``prefix`` is put before the new columns' names, for inputs that have columns
    of the same names.
    """
    at = docs.columns.index(text)

    def start():
        def step(batch):
            rows = [measure(t) for t in batch.column(at).to_pylist()]
            return [list(x) for x in zip(*rows)] if rows else [[] for _ in MEASURES]
        return step

    measured = append_columns(docs, [T.StructField(prefix + m, T.LongType()) for m in MEASURES], start)
    bits = F.lit(0).cast("long")
    for name, condition in RULES:
        for m in MEASURES:
            condition = re.sub(rf"\b{m}\b", f"`{prefix}{m}`", condition)
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn(prefix + "failures", bits)


def passes(policy: int = CURRENT_POLICY, failures: str = "failures") -> Column:
    """Whether a ledger row passes a policy version."""
    return F.col(failures).bitwiseAND(F.lit(POLICIES[policy]).cast("long")) == 0


def ablations(rows: DataFrame, policy: int = CURRENT_POLICY) -> DataFrame:
    """Per rule of a policy: documents that fail it, and those that it alone rejects.

    The ledger is first counted per distinct failure mask (at most 2 to the number
    of rules), so a new policy costs one small aggregate.
    """
    mask = POLICIES[policy]
    per_mask = rows.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))
    rule = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(BIT[n]).cast("long").alias("bit"))
                               for n, _ in RULES if BIT[n] & mask]))
    fails = F.col("failures").bitwiseAND(F.col("r.bit")) != 0
    alone = F.col("failures").bitwiseAND(F.lit(mask).cast("long")) == F.col("r.bit")
    kept = F.col("failures").bitwiseAND(F.lit(mask).cast("long")) == 0
    return (per_mask.select("failures", "n", rule.alias("r"))
            .groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum("n").alias("documents"),
                 F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("failed"),
                 F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("rejected_by_it_alone"),
                 F.sum(F.when(kept | alone, F.col("n")).otherwise(0)).alias("kept_without_it"),
                 F.bit_or("failures").alias("masks_seen")))


def verdicts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: measurements, failure bits, the base verdict and the current one."""
    rows = ledger(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text")
    return rows.select("doc_id", *MEASURES, "failures", (~passes(BASE_POLICY)).alias("base_failed"),
                       passes(CURRENT_POLICY).alias("kept"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
tri AS (SELECT r, i, words[i : i + 2] AS t FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS n FROM tri) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS o(k) GROUP BY r),
m AS (SELECT doc_id, len(words) AS n_words,
             coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             coalesce(rep.n, 0) AS n_repeat_words, len(lines) AS n_lines FROM w LEFT JOIN rep USING (r)),
f AS (SELECT *, CAST(""" + " + ".join(
    f"(CASE WHEN {c} THEN {BIT[n]} ELSE 0 END)" for n, c in RULES) + f""" AS BIGINT) AS failures FROM m)
SELECT doc_id, {', '.join(MEASURES)}, failures, (failures & {POLICIES[BASE_POLICY]}) <> 0 AS base_failed,
       (failures & {POLICIES[CURRENT_POLICY]}) = 0 AS kept FROM f
"""
