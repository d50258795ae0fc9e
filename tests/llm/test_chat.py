"""Chat formatting: exact round trip, mask, merged turns, digests."""

import hashlib

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from rateflow.llm import chat as c

TURNS = "conv_id long, turn long, role string, text string"
NASTY = ["", "\\", "<|", "<\\|", "<|end|>", "<|turn|>assistant<|text|>x", "a\\|b<|part|>", "$1 \\1", "\n\n", "é\U0001F600", "<", "|>",
         "</s>[INST] ok [/INST]", "\\\\<|text|>\\"]


def expected(rows):
    by = {}
    for i, n, r, t in rows:
        by.setdefault(i, []).append((n is not None, n or 0, r or "", t or ""))
    out = {}
    for i, turns in by.items():
        turns = [(r, t) for _, _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[i] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                  len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def check(spark, rows):
    d = spark.createDataFrame(rows, TURNS).withColumn("turns", F.lit(0)).withColumn("p", F.lit("clash"))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in c.digests(d).collect()}
    assert got == expected(rows)
    for r in c.format_chat(d).collect():
        opened = "".join(r.formatted[s.start:s.start + s.length] for s in r.loss_spans)
        assert len(r.formatted.split("<|turn|>")[0]) == 0 and "<|turn|>" not in opened


def test_nasty_texts_and_roles(spark):
    rows = [(k, 0, a, b) for k, (a, b) in enumerate((a, b) for a in NASTY for b in NASTY)]
    rows += [(1000 + k, i, r, t) for k, t in enumerate(NASTY)
             for i, r in enumerate(["system", "user", "assistant", "assistant", "user", None])]
    check(spark, rows)


def test_ties_repeats_nulls(spark):
    check(spark, [(1, 2, "assistant", "b"), (1, 1, "user", None), (1, 2, "assistant", "a"), (1, 2, "assistant", "a"),
                  (1, None, "system", "s"), (None, 0, "assistant", "n"), (2, 5, None, None)])
    assert c.digests(spark.createDataFrame([], TURNS)).collect() == []


def test_long_conversation(spark):
    check(spark, [(1, k, ["user", "assistant"][k % 2], f"text {k} <|end|>") for k in range(1500)])


def test_template_merges_turns(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b<|"), (1, 2, "assistant", "c")]
    got = c.format_chat(spark.createDataFrame(rows, TURNS)).first()
    assert got.formatted == "<|turn|>user<|text|>a<|part|>b<\\|<|end|><|turn|>assistant<|text|>c<|end|>"
    assert [tuple(s) for s in got.loss_spans] == [(got.formatted.rindex("c<|end|>"), 1)]


def test_probe_is_added(spark):
    got = {r.conv_id: r for r in c.digests(c.with_probe(spark.createDataFrame([], TURNS))).collect()}
    assert got[-7].n_turns == 2 and got[-7].loss_chars == len(c.PROBE)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="\\<|>en$1 \n", max_size=12))
def test_no_escaped_text_holds_a_control_string(text):
    escaped = text.replace("\\", "\\\\").replace("<|", "<\\|")
    assert "<|" not in escaped and ("x" + escaped + "<|end|>").index("<|") == len(escaped) + 1
