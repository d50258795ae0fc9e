"""Hierarchical multi-length packing of tokenized documents.

A document's ids are cut into full windows of the longest context; what remains is
one piece, routed to the tier (a power of two) that it fits.  Pieces are packed in
groups of bounded size, dealt by a hash:

1. the longest tier's pieces each open a long window, and its gap is filled from the
   shorter tiers, best fit first, longest piece first;
2. each shorter tier then closes windows of its own length that its pieces fill
   exactly, alone or with one shorter piece, and so need no padding;
3. all other pieces go, longest first, into the best fitting gap of any long window.

Sequences are then dealt to step groups of about equal tokens, longest first to the
lightest group.

Only (doc_id, start, length, checksum) are shuffled: texts are tokenized in the scan.

Edge cases: a null or empty text is its end id alone; a text of any length is
tokenized whole; repeated rows are packed one by one; a null doc_id stays null; an
empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rateflow.llm.common import bucket_of, settled, small_batches

WINDOW = 2048
TIERS = (2048, 1024, 512, 256)
END = 1
GROUP = 16384         # pieces packed together
STEP_TOKENS = 1 << 16  # tokens of one step group
MAX_CHUNKS = 400_000  # distinct chunks a task remembers before it starts afresh
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: the vocabulary's only added token, which the json cuts out of texts first.
ADDED_TOKEN, ADDED_ID = "<|endoftext|>", 50256
_ADDED_IDS = np.array([ADDED_ID], "<u4").tobytes()
SEQUENCE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window int, step_group long"
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

# Between a character that is no white space and a run of ASCII white space the
# vocabulary's pattern always ends a token, and it looks no further than the next
# character that is no white space: a text can be cut there.
_chunks = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+").findall
_rare_space = re.compile(r"(?![\x20\x09-\x0D])[\s\u180e\u200b\ufeff]").search


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """Texts to packed 32-bit ids, remembering the ids of chunks it has seen.

    The rank file holds the same vocabulary as ``byte_bpe_50k.json`` and gives the
    same ids; it is read several times faster.  Like there, the added token's string is one
    token wherever it stands in a text.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
        self.encode = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary
        self.seen: dict[str, bytes] = {}

    def _new(self, chunk: str) -> bytes:
        ids = np.array(self.encode(chunk), "<u4").tobytes()
        if len(chunk) <= 48:
            if len(self.seen) >= MAX_CHUNKS:
                self.seen.clear()
            self.seen[chunk] = ids
        return ids

    def __call__(self, text: str | None) -> bytes:
        text = text or ""
        if ADDED_TOKEN in text:
            return _ADDED_IDS.join([self._plain(part) for part in text.split(ADDED_TOKEN)])
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if _rare_space(text):
            return np.array(self.encode(text), "<u4").tobytes()
        get, new = self.seen.get, self._new
        return b"".join([get(c) or new(c) for c in _chunks(text)])


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
           vocabulary: str | None = None) -> DataFrame:
    """Every document's pieces: full windows and one rest, with their ids' checksums."""
    path = vocabulary or vocabulary_path()
    small_batches(docs.sparkSession)
    end = np.array([END], "<u4").tobytes()

    def run(batches):
        import pyarrow as pa
        encode = Encoder(path)
        for batch in batches:
            out: list[tuple] = []
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(t) + end
                n = len(ids) // 4
                for s in range(0, n, window):
                    part = ids[4 * s:4 * (s + window)]
                    out.append((d, s, len(part) // 4, zlib.crc32(part), n))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(5)], names=names)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, _PIECE)


class _Gaps:
    """Open windows by free room; finds the smallest room that takes a piece."""

    def __init__(self):
        self.by_room: dict[int, list[int]] = {}
        self.rooms = 0  # bit r is set where a window has r free

    def add(self, room: int, window: int) -> None:
        if room > 0:
            self.by_room.setdefault(room, []).append(window)
            self.rooms |= 1 << room

    def take(self, length: int) -> tuple[int, int] | None:
        """(room, window) of the best fit, removed; None if nothing is wide enough."""
        wide = self.rooms >> length
        if not wide:
            return None
        room = length + (wide & -wide).bit_length() - 1
        windows = self.by_room[room]
        window = windows.pop()
        if not windows:
            self.rooms &= ~(1 << room)
        return room, window


def pack_lengths(lengths: list[int], tiers=TIERS) -> list[tuple[int, int]]:
    """(window, offset) of each piece, by the three passes of the module's text."""
    longest = tiers[0]
    order = sorted(range(len(lengths)), key=lambda k: (-lengths[k], k))
    at: list[tuple[int, int] | None] = [None] * len(lengths)
    used: list[int] = []
    gaps = _Gaps()

    def open_window(k: int) -> int:
        at[k] = (len(used), 0)
        used.append(lengths[k])
        return len(used) - 1

    def put(k: int) -> bool:
        fit = gaps.take(lengths[k])
        if fit is None:
            return False
        room, w = fit
        at[k] = (w, used[w])
        used[w] += lengths[k]
        gaps.add(room - lengths[k], w)
        return True

    half = tiers[1] if len(tiers) > 1 else 0
    long_ones = [k for k in order if lengths[k] > half]
    short = [k for k in order if lengths[k] <= half]
    for k in long_ones:
        w = open_window(k)
        gaps.add(longest - lengths[k], w)
    short = [k for k in short if not put(k)]
    # Exact windows of the shorter tiers, each of one piece or of two.
    by_length: dict[int, list[int]] = {}
    for k in reversed(short):
        by_length.setdefault(lengths[k], []).append(k)
    for tier in tiers[1:]:
        for length in range(tier, tier // 2 - 1, -1):
            own, mates = by_length.get(length, []), by_length.get(tier - length, [])
            while own and (length == tier or (mates and not (mates is own and len(own) < 2))):
                w = open_window(own.pop())
                if length < tier:
                    mate = mates.pop()
                    at[mate] = (w, used[w])
                    used[w] += lengths[mate]
    for k in short:
        if at[k] is None and not put(k):
            w = open_window(k)
            gaps.add(longest - lengths[k], w)
    return at  # type: ignore[return-value]


def step_groups(windows: list[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A step group per window, longest window first to the group with fewest tokens."""
    import heapq
    n = max(1, round(sum(windows) / step_tokens))
    load = [(0, g) for g in range(n)]
    group = [0] * len(windows)
    for k in sorted(range(len(windows)), key=lambda k: (-windows[k], k)):
        tokens, g = heapq.heappop(load)
        group[k] = g
        heapq.heappush(load, (tokens + windows[k], g))
    return group


def _pack(group: pd.DataFrame) -> pd.DataFrame:
    key = int(group["bucket"].iloc[0])
    group = group.sort_values(["no_id", "doc_id", "start", "ids_crc32"], kind="stable")
    at = pack_lengths(group["length"].tolist())
    total: dict[int, int] = {}
    for (w, _), n in zip(at, group["length"].tolist()):
        total[w] = total.get(w, 0) + n
    # A window's length: the power of two that it fills exactly, else the longest.
    length = [n if n & (n - 1) == 0 else WINDOW for n in (total[w] for w in range(len(total)))]
    steps = step_groups(length)
    first = key << 24  # a group's windows and steps are far fewer
    out = group.drop(columns=["bucket"])
    out["sequence_id"] = [first + w for w, _ in at]
    out["offset"] = [o for _, o in at]
    out["window"] = [length[w] for w, _ in at]
    out["step_group"] = [first + steps[w] for w, _ in at]
    return out


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
         group: int = GROUP) -> DataFrame:
    """Per piece: its ids' place in the document and in a sequence of the packed set."""
    # The pieces are written to the shared checkpoint folder, as their number sets the
    # number of groups and no text should be tokenized twice.
    cut = settled(pieces(docs, doc_id, text, WINDOW, vocabulary))
    n = max(1, -(-cut.count() // group))
    # Rows that repeat all columns would share a bucket, so a row number takes part;
    # it is stable, as it is read from the written pieces.
    dealt = (cut.withColumn("nr", F.monotonically_increasing_id())
             .withColumn("bucket", bucket_of(n, F.lit(9), "doc_id", "start", "nr")).drop("nr"))
    # A null among longs would make pandas round them all, so it travels as a flag.
    no_id = F.col("doc_id").isNull()
    packed = (dealt.withColumn("no_id", no_id).withColumn("doc_id", F.coalesce("doc_id", F.lit(0)))
              .groupBy("bucket").applyInPandas(_pack, f"{SEQUENCE}, no_id boolean"))
    return packed.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")
