"""License scan: brute force, edited notices, anchors, awkward rows, plan."""

import contextlib
import io
import random

from llm.helpers import AWKWARD, docs
from rateflow.llm import license_scan as s


def brute(rows):
    out = {}
    for d, text in rows:
        w = s.words_of(text or "")
        sh = [" ".join(w[i:i + 5]) for i in range(len(w) - 4)]
        for name, t in s.TEMPLATES.items():
            own = set(s.shingles_of(t))
            size = s.size_class(len(own))
            for start in range(0, max(1, len(sh)), s.stride(size)):
                share = len(own & set(sh[start:start + s.window(size)])) / len(own)
                if share >= 0.8 and share > out.get((d, name), (0, 0))[0]:
                    out[d, name] = (share, start)
    return out


def corpus():
    rng = random.Random(7)
    filler = lambda n: " ".join(rng.choice(["lorem", "under", "the", "software", "ipsum", "of"]) for _ in range(n))
    rows = []
    for k, (name, text) in enumerate(s.TEMPLATES.items()):
        words = text.split()
        drop = set(rng.sample(range(len(words)), len(words) // 40))
        rows += [(10 * k, f"{filler(rng.randrange(300))}\n{text.upper()}\n{filler(50)}"),
                 (10 * k + 1, filler(37) + " " + " ".join(w for i, w in enumerate(words) if i not in drop)),
                 (10 * k + 2, " ".join(words[:len(words) // 2]) + " " + filler(20)), (10 * k + 3, filler(200))]
    return rows


def test_equals_brute_force(spark):
    rows = corpus()
    got = {(r.doc_id, r.license): (r.containment, r.window_start)
           for r in s.scan(docs(spark, rows, ["w", "size", "start", "license"])).collect()}
    assert got == brute(rows)
    assert all((10 * k, name) in got for k, name in enumerate(s.TEMPLATES))


def test_every_match_holds_an_anchor():
    anchors = set(s.anchors(s.TEMPLATES))
    assert 5 <= len(anchors) <= 40
    for t in s.TEMPLATES.values():
        own = s.shingles_of(t)
        assert sum(not set(x.split()) & anchors for x in own) < s.needed(len(own))


def test_awkward_rows(spark):
    rows = [*AWKWARD, (None, "x Released under the MIT License. y"), (20, "license " * 3000)]
    got = [(r.doc_id, r.license) for r in s.scan(docs(spark, rows)).collect()]
    assert got == [(None, "MIT-line")]
    assert s.scan(docs(spark, [])).collect() == []


def test_plan_is_native(spark):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        s.scan(docs(spark, corpus())).explain()
    assert not any(x in out.getvalue() for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
