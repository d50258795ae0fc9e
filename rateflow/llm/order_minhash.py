"""Near-duplicate documents by order MinHash and banded alignment.

A document is a list of words, its k-mers are five words long and carry the number
of their occurrence.  A sketch takes the smallest ``PICK`` of them under one hash
function and keeps them in text order, so that two documents share a sketch the
likelier the smaller their edit distance is; ``SKETCHES`` hash functions give as
many.  Documents that share a sketch form a bucket.  Each is compared with the
bucket's head, the document that shares most sketches with others; a bucket whose
other documents are of one class is then done.  What is
left meets pair by pair: all pairs of a bucket and of different classes are compared,
but for those that their lengths or bags of words show to be unlike, and a few pairs per
two classes first, as one link joins them.  So no pair with a common sketch is left out
unless its classes are one already; a large group of copies costs a few pairs per
member, and a passage shared by many unlike documents costs bags of words only.

A pair is linked if the edit similarity of its words, 1 - distance / longer length,
is at least 0.8, found exactly by alignment within the band that this allows.
Classes are the connected components of equal texts and links.

Exact copies are one node (a 64-bit hash of the text) from the start and are never
paired.

Edge cases: a null text counts as an empty one; texts without words are alike;
repeated rows are exact copies; a class's id is its smallest doc_id, null if it has
none; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F, types as T

from rateflow.llm.common import bucket_of, code_points, find_words, small_batches, word_codes, written
from rateflow.llm.components import components

KMER = 5
SKETCHES = 32
PICK = 2
MOST_EDITS = 5      # similarity 0.8: five times the distance is at most the longer length
NO_ID = (1 << 63) - 1
CELLS = 1 << 15      # cells of one row of a batch of alignments
BLOCK = 512          # members of a bucket that meet as one block
BAG_CELLS = 4096     # words are told apart by so many hashes, long texts' too
FEW_CELLS = 128      # divides BAG_CELLS: a quick first look
FIRST_PAIRS = 4      # so many candidate pairs of two classes and blocks are compared before all are

_rng = np.random.default_rng(20)
_XOR = _rng.integers(0, 1 << 63, SKETCHES, dtype=np.uint64)[:, None]
_MUL = (_rng.integers(0, 1 << 63, SKETCHES, dtype=np.uint64) | np.uint64(1))[:, None]
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _P2
    return h ^ (h >> np.uint64(32))


def labelled_kmers(codes: np.ndarray) -> np.ndarray:
    """A hash per k-mer and occurrence number; a shorter text is one k-mer."""
    n, k = len(codes), min(KMER, max(1, len(codes)))
    if n == 0:
        return np.zeros(1, np.uint64)
    h = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        h = h * _P1 + codes[j:n - k + 1 + j]
    h = _mixed(h)
    distinct, at = np.unique(h, return_inverse=True)
    if len(distinct) < len(h):
        order = np.argsort(at, kind="stable")
        first = np.searchsorted(at[order], np.arange(len(distinct)))
        nth = np.empty(len(h), np.uint64)
        nth[order] = np.arange(len(h)) - first[at[order]]
        h = np.where(nth > 0, _mixed(h + nth * _P1), h)
    return h


def sketch(codes: np.ndarray) -> np.ndarray:
    """The SKETCHES order-MinHash values of a document, as signed 64-bit numbers."""
    h = labelled_kmers(codes)
    v = (h[None, :] ^ _XOR) * _MUL
    v ^= v >> np.uint64(31)
    v *= _P2
    rows = np.arange(SKETCHES)
    picked = []
    for _ in range(min(PICK, len(h))):
        at = v.argmin(axis=1)
        picked.append(at)
        v[rows, at] = np.uint64(0xFFFFFFFFFFFFFFFF)
    places = np.sort(np.stack(picked), axis=0)  # text order
    out = _mixed(rows.astype(np.uint64) + np.uint64(1))
    for at in places:
        out = _mixed(out * _P1 + h[at])
    return out.view(np.int64)


def bag(codes: np.ndarray) -> bytes:
    """Words by their hash, as 16-bit numbers: each word's, or from BAG_CELLS words on how many have each."""
    cells = codes % np.uint64(BAG_CELLS)
    if len(cells) >= BAG_CELLS:
        cells = np.minimum(np.bincount(cells.astype(np.int64), minlength=BAG_CELLS), 65535)
    return cells.astype(np.uint16).tobytes()


def histograms(bags: list[bytes], n: int = BAG_CELLS) -> np.ndarray:
    """A row per bag: numbers of words by their hash modulo ``n``."""
    out = np.zeros((len(bags), n), np.uint32)
    for row, b in zip(out, bags):
        cells = np.frombuffer(b, np.uint16)
        row[:] = (cells.reshape(-1, n).sum(0, dtype=np.uint32) if len(cells) == BAG_CELLS
                  else np.bincount(cells % n, minlength=n))
    return out


def _common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.minimum(x, y).sum(1, dtype=np.int64)


def _sketches(docs: DataFrame) -> DataFrame:
    """(node, keys, length, bag) of every document, in one scan."""
    small_batches(docs.sparkSession)

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            codes = [word_codes(code_points(t)) for t in batch.column(1).to_pylist()]
            rows = [sketch(c) for c in codes]
            flat = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))
            keys = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), keys, pa.array([len(c) for c in codes], pa.int64()), pa.array([bag(c) for c in codes], pa.binary())],
                names=["node", "keys", "length", "bag"])

    # Copies of a text are one node.
    return docs.select("node", "text").mapInArrow(run, "node long, keys array<long>, length long, bag binary").dropDuplicates(["node"])


def _distances(pairs: list[tuple[np.ndarray, np.ndarray]], radius: list[int]) -> list[int]:
    """Edit distance of each pair along paths at most ``radius`` off the diagonal.

    All pairs advance together, one row of the alignment at a time.
    """
    count, r = len(pairs), max(radius)
    rows = max(len(a) for a, _ in pairs)
    width = 2 * r + 1
    a = np.full((count, rows), -1, np.int32)
    b = np.full((count, rows + width + r + 1), -2, np.int32)
    for i, (x, y) in enumerate(pairs):
        a[i, :len(x)] = x
        b[i, r:r + len(y)] = y
    # Short numbers where they suffice: half the memory to go through.
    kind = np.int16 if 2 * (rows + width) < 1 << 14 else np.int32
    big = kind(1 << 14 if kind is np.int16 else 1 << 28)
    off = np.arange(width, dtype=kind)
    d = np.where(off >= r, off - kind(r), big)[None, :].repeat(count, 0)
    ends = np.array([len(x) for x, _ in pairs])
    column = np.array([len(y) - len(x) + r for x, y in pairs])
    result = np.full(count, big, kind)
    for i in range(rows + 1):
        if i:
            step = d + (a[:, i - 1, None] != b[:, i - 1:i - 1 + width])
            d += 1
            np.minimum(step[:, :-1], d[:, 1:], out=step[:, :-1])
            if i <= r:
                step[:, :r - i] = big      # left of the text's start
                step[:, r - i] = i         # everything deleted so far
            step -= off
            np.minimum.accumulate(step, axis=1, out=step)
            step += off
            d = step
        done = np.flatnonzero(ends == i)
        inside = done[(column[done] >= 0) & (column[done] < width)]
        result[inside] = d[inside, column[inside]]
    return result.tolist()


def _batches(todo: list[int], pairs, radius: list[int]):
    """Pairs of similar length together, so many that a row has at most CELLS cells."""
    todo = sorted(todo, key=lambda k: max(len(pairs[k][0]), len(pairs[k][1])))
    at = 0
    while at < len(todo):
        end = at + 1
        while end < len(todo) and (end + 1 - at) * (2 * radius[todo[end]] + 1) <= CELLS:
            end += 1
        yield todo[at:end]
        at = end


def alike(texts: list[tuple[str | None, str | None]]) -> list[bool]:
    """Whether the words of each pair have an edit similarity of 0.8 or more; exact."""
    pairs, limits, answer, todo = [], [], [False] * len(texts), []
    for k, (s, t) in enumerate(texts):
        x, y = find_words(s or ""), find_words(t or "")
        most = max(len(x), len(y)) // MOST_EDITS
        limits.append(most)
        pairs.append((x, y))
        if x == y:
            answer[k] = True
            continue
        if abs(len(x) - len(y)) > most:
            continue
        ids: dict[str, int] = {}
        a = np.array([ids.setdefault(w, len(ids)) for w in x], np.int32)
        b = np.array([ids.setdefault(w, len(ids)) for w in y], np.int32)
        common = int(np.minimum(np.bincount(a, minlength=len(ids)), np.bincount(b, minlength=len(ids))).sum())
        if max(len(x), len(y)) - common > most:
            continue  # the distance is at least that
        same = a[:min(len(a), len(b))] != b[:min(len(a), len(b))]
        head = int(same.argmax()) if same.any() else len(same)
        a, b = a[head:], b[head:]
        n = min(len(a), len(b))
        same = a[len(a) - n:][::-1] != b[len(b) - n:][::-1]
        tail = int(same.argmax()) if same.any() else n
        pairs[k] = (a[:len(a) - tail], b[:len(b) - tail])
        if max(map(len, pairs[k])) <= most:
            answer[k] = True
        else:
            todo.append(k)
    # A narrow band first: its distance is an upper bound, mostly good enough.
    for share in (8, 1):
        radius = [max(1, abs(len(x) - len(y)), min(m, m // share + 2))
                  for (x, y), m in zip(pairs, limits)]
        rest = []
        for group in _batches(todo, pairs, radius):
            for k, d in zip(group, _distances([pairs[k] for k in group], [radius[k] for k in group])):
                if d <= limits[k]:
                    answer[k] = True
                else:
                    rest.append(k)
        todo = rest
    return answer


def _verified(pairs: DataFrame) -> DataFrame:
    """(a, b, alike) of pairs with their texts."""
    small_batches(pairs.sparkSession)

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            texts = list(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(alike(texts), pa.bool_())],
                                             names=["a", "b", "alike"])

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, alike boolean")


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (node, root) after further ``links`` (a, b): only the components that these join are gone through."""
    ends = (links.join(roots.select(F.col("node").alias("a"), F.col("root").alias("x")), "a", "left")
            .join(roots.select(F.col("node").alias("b"), F.col("root").alias("y")), "b", "left"))
    more = components(ends.select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")))
    moved = roots.join(more.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
    return written(moved.select("node", F.coalesce("to", "root").alias("root")).union(more))


def linked_roots(docs: DataFrame) -> DataFrame:
    """(node, root) as ``components`` has them, over all links among rows (node, id, text)."""
    sketches = written(_sketches(docs))
    first = docs.groupBy("node").agg(F.min("id").alias("id"))
    rows = sketches.select("node", F.explode(F.array_distinct("keys")).alias("key")).distinct()
    # Buckets of one node are dropped before anything is compared.
    size = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    rows = written(rows.join(size, "key"))
    weight = rows.groupBy("node").agg(F.sum("n").alias("weight"))
    rows = written(rows.select("node", "key").join(weight, "node"))
    head = written(rows.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("h")).select("key", F.col("h.node").alias("b")))
    members = written(rows.join(head, "key").where("node <> b").select("node", "key", "b"))
    pairs = members.select(F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")).distinct()
    alike_1, unlike = _compare(pairs, docs, first)
    tested, roots = alike_1.union(unlike), components(alike_1)
    for most in (FIRST_PAIRS, None):
        # A bucket of one class has nothing left to link.
        rest = written(members.select("node", "key").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
        open_keys = written(rest.groupBy("key").agg(F.min("root").alias("y"), F.max("root").alias("z"), F.count(F.lit(1)).alias("n"))
                            .where("y < z").select("key", "n"))
        again = written(_open_pairs(written(rest.join(open_keys, "key")), sketches, most).join(tested, ["a", "b"], "left_anti"))
        if not again.isEmpty():
            alike, unlike = _compare(again, docs, first)
            tested = tested.union(alike).union(unlike)
            if not alike.isEmpty():
                roots = _merged(roots, alike)
    return roots


def _first_of(x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """The places of the first ``most`` of each pair of values, in either order."""
    low, high = np.minimum(x, y), np.maximum(x, y)
    order = np.lexsort((high, low))
    new = np.concatenate(([True], (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])))
    starts = np.flatnonzero(new)
    rank = np.arange(len(order)) - starts[np.cumsum(new) - 1]
    return np.sort(order[rank < most])


def _may_be_alike(common: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Whether as many words in common may do, by the longer length; words of very long texts are not counted in full."""
    return (longer - common <= longer // MOST_EDITS) | (longer > 65535)


def _open_pairs(rows: DataFrame, sketches: DataFrame, most: int | None) -> DataFrame:
    """Pairs of one bucket and different classes that may be alike, for rows (node, key, root, n).

    Buckets are cut into blocks that meet each other; two documents of very different
    length, or with too few words in common by their bags, are surely unlike.
    A pair comes from the least of the buckets that it shares: there it meets, or one of
    the two is the head, to which the other was compared.
    Of two classes, ``most`` pairs per two blocks come at most, or all without it: one link
    joins two classes, however many candidates lie between them.
    """
    dealt = rows.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn(
        "block", bucket_of(F.col("blocks"), F.lit(3), "node").cast("int"))
    member = F.struct("node", "root", "length", "keys", "bag")
    blocks = written(dealt.join(sketches.select("node", "length", "keys", "bag"), "node")
                     .groupBy("key", "blocks", "block").agg(F.collect_list(member).alias("m")))
    # A block meets itself where it lies; only two blocks of one bucket are sent to each other.
    others = blocks.where("blocks > 1")
    left = others.where("block < blocks - 1").select("key", F.col("block").alias("i"), F.explode(F.sequence(F.col("block") + 1, F.col("blocks") - 1)).alias("j"), F.col("m").alias("x"))
    right = others.where("block > 0").select("key", F.explode(F.sequence(F.lit(0), F.col("block") - 1)).alias("i"), F.col("block").alias("j"), F.col("m").alias("y"))
    fields = ("node", "root", "length", "keys", "bag")
    cells = left.join(right, ["key", "i", "j"]).select("key", *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "xy" for c in fields])
    itself = blocks.select("key", *[F.col(f"m.{c}").alias(f"x_{c}") for c in fields], *[F.lit(None).cast(cells.schema[f"y_{c}"].dataType).alias(f"y_{c}") for c in fields])

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for r in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):  # a row is two blocks
                sides, same = [], r["y_node"] is None
                for s in "xx" if same else "xy":
                    sides.append([np.array(r[f"{s}_{c}"], np.int64) for c in ("node", "root", "length")] + [histograms(r[f"{s}_bag"], FEW_CELLS)])
                (node, root, length, few), (nodes, roots, lengths, other_few) = sides
                x, y = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for k in range(len(node)):
                    may = roots != root[k]
                    if same:
                        may &= nodes > node[k]
                    longer = np.maximum(lengths, length[k])
                    may &= MOST_EDITS * np.abs(lengths - length[k]) <= longer
                    at = np.flatnonzero(may)
                    at = at[_may_be_alike(_common(other_few[at], few[k]), longer[at])]
                    x.append(np.full(len(at), k))
                    y.append(at)
                x, y = np.concatenate(x), np.concatenate(y)
                # All hashes of what is left, a left document at a time.
                starts = np.flatnonzero(np.concatenate((x[:1] >= 0, x[1:] != x[:-1])))
                used = np.unique(y)
                words = histograms([r["x_bag" if same else "y_bag"][j] for j in used])
                may = [np.zeros(0, bool)]
                for start, end in zip(starts, [*starts[1:], len(x)]):
                    k, at = x[start], y[start:end]
                    common = _common(words[np.searchsorted(used, at)], histograms([r["x_bag"][k]]))
                    may.append(_may_be_alike(common, np.maximum(lengths[at], length[k])))
                may = np.concatenate(may)
                x, y = x[may], y[may]
                key_sets, other_sets = [[set(r[f"{s}_keys"][k]) for k in at.tolist()] for s, at in (("x", x), ("x" if same else "y", y))]
                may = np.array([min(p & q) == r["key"] for p, q in zip(key_sets, other_sets)], bool)
                x, y = x[may], y[may]
                of_x, of_y, x, y = root[x], roots[y], node[x], nodes[y]
                if most is not None and len(x):
                    kept = _first_of(of_x, of_y, most)
                    x, y = x[kept], y[kept]
                found_a.append(np.maximum(x, y))
                found_b.append(np.minimum(x, y))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found_a)), pa.array(np.concatenate(found_b))], names=["a", "b"])

    return itself.union(cells).mapInArrow(run, "a long, b long").distinct()


def _compare(pairs: DataFrame, docs: DataFrame, first: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pairs of nodes that are alike, and those that are not."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(first, "node")
    # The first row of a text is found by text and id: a hot text's copies are dealt
    # over many tasks.
    texts = docs.join(needed, ["node", "id"]).select("node", "text")
    with_a = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    with_b = with_a.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    checked = written(_verified(with_b))
    return checked.where("alike").select("a", "b"), checked.where("NOT alike").select("a", "b")


def _nodes(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    words = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.xxhash64(words).alias("node"), F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"),
                       words.alias("text"))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, its text's ``node``, the class's ``root`` node, id and size, and
    whether the row has that id."""
    rows = _nodes(docs, doc_id, text)
    roots = linked_roots(rows)
    # A hot class must not be one task's rows: what is joined to each row is settled
    # first, and Spark splits the large partitions of such a join.
    known = rows.select("node", "id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    per_class = written(known.groupBy("root").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("class_size")))
    none = F.lit(None).cast("long")
    return (known.join(per_class, "root")
            .select(F.when(F.col("id") != NO_ID, F.col("id")).otherwise(none).alias("doc_id"), "node", "root",
                    F.when(F.col("first") != NO_ID, F.col("first")).otherwise(none).alias("class_id"),
                    "class_size", (F.col("id") == F.col("first")).alias("is_first")))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row per class: the one of the smallest doc_id."""
    # One text of a class, should several have its smallest doc_id.
    keep = (classes(docs, doc_id, text).where("is_first").groupBy("root")
            .agg(F.min("node").alias("__node"), F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("__id")).drop("root"))
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"),
                        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__node"),
                        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("__id"))
    kept = whole.join(keep, ["__node", "__id"])
    # A row that occurs twice, id and text, stays once.
    nth = F.row_number().over(Window.partitionBy("__node", "__id").orderBy(F.lit(0)))
    return kept.withColumn("__nth", nth).where("__nth = 1").select("__row.*")
