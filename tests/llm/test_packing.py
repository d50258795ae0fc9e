"""Packing: ids of the given tokenizer, exact cover, windows, little padding."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from llm.helpers import AWKWARD, docs
from rateflow.llm import packing as p
from tokenizers import Tokenizer

reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
encoder = p.Encoder(p.vocabulary_path())


def slow(text):
    return reference.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab'sé .,\n\t\r\x0b\x0c 1  　\x1c\x85​!<|>", max_size=30))
def test_ids_equal_the_tokenizer(text):
    assert np.frombuffer(encoder(text), "<u4").tolist() == slow(text)


def test_the_added_token_is_cut_out_as_the_json_says():
    assert np.frombuffer(encoder("a <|endoftext|> b"), "<u4").tolist() == slow("a <|endoftext|> b") == [64, 220, 50256, 275]
    for text in ("<|endoftext|>", "a<|endoftext|><|endoftext|>  b", " <|endoftext|>\n", "<|endoftext|", "x<|endoftext|>\x85é"):
        assert np.frombuffer(encoder(text), "<u4").tolist() == slow(text)


def test_large_ids_beside_nulls(spark):
    rows = [(2 ** 53 + 1, "one two"), (None, "three"), (-2 ** 62 - 1, "four five six")]
    got = p.pack(docs(spark, rows)).collect()
    assert {r.doc_id for r in got} == {r[0] for r in rows}
    check(rows, got)


def check(rows, got):
    texts = {d: t for d, t in rows}
    seen, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        seen[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    padding = total = 0
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    for d, parts in seen.items():
        ids = slow(texts[d]) + [1]
        times = sum(x[0] == d for x in rows)
        assert sum(r.length for r in parts) == times * len(ids)
        for r in parts:
            assert r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
    return padding, total


def test_pieces_cover_documents(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "be", "Gamma,", "x9"]) for _ in range(int(rng.lognormvariate(5, 1.2)))))
            for i in range(600)]
    got = p.pack(docs(spark, rows, ["start", "length", "bucket", "offset"])).collect()
    padding, total = check(rows, got)
    assert padding < 0.01 * total + 4096


def test_groups_are_balanced_and_gapless(spark):
    rows = [(i, "word " * (i % 300)) for i in range(500)]
    got = p.pack(docs(spark, rows), group=100).collect()
    check(rows, got)
    load = defaultdict(dict)
    for r in got:
        load[r.step_group][r.sequence_id] = r.window
    assert all(len(v) for v in load.values())


def test_awkward_rows(spark):
    got = p.pack(docs(spark, AWKWARD)).collect()
    check(AWKWARD, got)
    assert {r.doc_id: r.doc_tokens for r in got}[1] == 1
    assert p.pack(docs(spark, [])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 2048), max_size=120))
def test_windows_hold_what_they_are_given(lengths):
    used = defaultdict(int)
    for (w, o), n in sorted(zip(p.pack_lengths(lengths), lengths)):
        assert o == used[w]
        used[w] += n
    assert all(n <= 2048 for n in used.values())
