"""Repeated substrings of all texts, byte by byte, by suffix arrays.

A byte goes when it is covered by a string of ``length`` bytes that starts anywhere else
too. The array is built by linear grouping (``suffix_array``), for strings brought together
by content, so that the work is dealt over all tasks:

1. Every window of ``length`` bytes has an anchor, its 16 bytes of least hash; equal windows
   have equal anchors at equal places. Windows that follow each other share one, and the
   stretch of text that they cover is the anchor's context.
2. Anchors meet in buckets by hash. One that occurs once repeats nothing; one with the same
   context everywhere repeats all of it. Only the others send their contexts, once each.
3. In a bucket, windows around one anchor are split by their distance to it into ranges;
   the windows of a range share a core. Equal cores become one symbol, with the bytes on
   both sides as flanks: flank, core, flank are the strings of one suffix array a bucket. A
   window there is repeated if its neighbours in the array begin with the same symbols.
4. The answers go back to the documents, where covered bytes are removed.

Counts of copies stand for copies, so thousands of equal texts are one string.

Defined cases: a null text counts as empty; texts shorter than ``length`` lose nothing;
matches never cross texts; repeated rows remove each other; null ids are kept; other
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import materialize, mix64, one_of, rows_of, shuffle_width, texts_of

#: Bytes of an anchor, windows of a range, bytes of text in one packed row, and windows whose
#: anchors are found at once (less than 2**24).
ANCHOR, RANGE, CHUNK_BYTES, BLOCK = 16, 12, 4_000_000, 1 << 18


def suffix_array(text: list[int]) -> list[int]:
    """The order of all suffixes of a list of numbers; the last must be smaller than all others.

    Suffixes are grouped by their first symbol, and the groups are processed in descending
    order. A member's pointer leads to the nearest place before it in a smaller group; the
    member's group is what follows there, so the places pointed at move up within their own
    group, those with more members behind them higher. In the end a group holds the suffixes with
    one Lyndon prefix. The second pass takes the suffixes in ascending order: each one
    places, at the front of their groups, those before it along the pointers that are not
    placed yet. Nothing is renamed or sorted again.
    """
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    group, place, size = [0] * n, [0] * n, [0] * n
    start = 0
    for k, i in enumerate(order):
        if k and text[order[k - 1]] != text[i]:
            start = k
        group[i], place[i] = start, k
        size[start] += 1
    previous = [-1] * n
    end = n
    while end:
        start = group[order[end - 1]]
        members = order[start:end]
        members.sort()
        behind: dict[int, int] = {}
        for i in members:
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                behind[p] = behind.get(p, 0) + 1
        moved: dict[int, list] = {}
        for p, count in behind.items():
            moved.setdefault(group[p], []).append((count, p))
        for old, own in moved.items():
            own.sort(reverse=True)
            tail, last = old + size[old], 0
            for k, (count, p) in enumerate(own):
                tail -= 1
                # p changes places with whatever stands at the tail of what is left.
                other, at = order[tail], place[p]
                order[at], place[other] = other, at
                order[tail], place[p] = p, tail
                last += 1
                if k + 1 == len(own) or own[k + 1][0] != count:
                    for q in order[tail : tail + last]:
                        group[q] = tail
                    size[tail], last = last, 0
            if tail != old:
                size[old] = tail - old
        end = start
    free = list(range(n))
    out, placed = [0] * n, [False] * n
    out[0], placed[n - 1] = n - 1, True
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = True
            j = previous[j]
    return out


def anchored_windows(data: np.ndarray, ends: np.ndarray, length: int):
    """Runs of windows with one anchor: first window, last window and anchor of each run.

    ``data`` are the texts one after the other and ``ends`` where each ends.
    """
    n = len(data) - length + 1
    none = np.empty(0, np.int64)
    if n <= 0:
        return none, none, none
    anchors = np.concatenate(
        [b + _anchors(data[b : b + BLOCK + length - 1], length) for b in range(0, n, BLOCK)]
    )
    inside = np.ones(n + length, bool)
    for end in ends.tolist():
        inside[max(end - length + 1, 0) : end] = False
    inside = inside[:n]
    new = np.r_[True, (anchors[1:] != anchors[:-1]) | ~inside[:-1] | ~inside[1:]]
    first = np.flatnonzero(new)
    last = np.r_[first[1:] - 1, n - 1]
    keep = inside[first]
    return first[keep], last[keep], anchors[first[keep]]


def _anchors(data: np.ndarray, length: int) -> np.ndarray:
    """The anchor of every window: its least hash, of equal ones the first."""
    span, count = length - ANCHOR + 1, len(data) - ANCHOR + 1
    eight = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)).view("<u8")[:, 0]
    hashed = mix64(eight[:count] + mix64(eight[8 : 8 + count]))
    places = np.uint64((1 << 24) - 1)
    least = (hashed & ~places) | np.arange(count, dtype=np.uint64)
    have = 1
    while 2 * have <= span:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    rest = span - have
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    return (least & places).astype(np.int64)


def anchor_keys(data: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    rows = data[anchors[:, None] + np.arange(ANCHOR)[None, :]]
    pair = np.ascontiguousarray(rows).view("<u8").reshape(-1, 2)
    return mix64(pair[:, 0] + mix64(pair[:, 1]))


class Chunk:
    """The texts of one packed row and their anchors."""

    def __init__(self, packed: bytes, sizes: list[int], runs: bytes | None, length: int):
        import zstandard

        self.raw = zstandard.ZstdDecompressor().decompress(packed) if packed else b""
        self.data, self.ends = np.frombuffer(self.raw, np.uint8), np.cumsum(np.array(sizes, np.int64))
        if runs is None:
            self.first, self.last, self.anchors = anchored_windows(self.data, self.ends, length)
        else:
            self.first, self.last, self.anchors = np.frombuffer(runs, np.int32).reshape(3, -1).astype(np.int64)
        self.keys = anchor_keys(self.data, self.anchors) if len(self.anchors) else np.empty(0, np.uint64)

    def runs(self) -> bytes:
        return np.stack([self.first, self.last, self.anchors]).astype(np.int32).tobytes()

    def digests(self, length: int) -> np.ndarray:
        """Hashes of the contexts, with the anchor's place in them."""
        import xxhash

        view = memoryview(self.raw)
        found = np.fromiter(
            (
                xxhash.xxh3_64_intdigest(view[a : b + length])
                for a, b in zip(self.first.tolist(), self.last.tolist(), strict=True)
            ),
            np.uint64,
            len(self.first),
        )
        return mix64(found + (self.anchors - self.first).astype(np.uint64))

    def by_bucket(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Runs in the order of their buckets, and where each bucket begins."""
        where = (mix64(self.keys) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(where, kind="stable")
        return order, np.searchsorted(where[order], np.arange(buckets + 1))


STATE = pa.schema(
    [
        ("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
        ("packed", pa.binary()), ("runs", pa.binary()),
    ]
)
STATE_SQL = "chunk long, doc_ids array<long>, sizes array<int>, packed binary, runs binary"


def _chunk_task(length: int):
    def run(batches):
        import zstandard

        def closed(first, ids, texts):
            packed = zstandard.ZstdCompressor(3).compress(b"".join(texts))
            sizes = [len(t) for t in texts]
            return first, ids, sizes, packed, Chunk(packed, sizes, None, length).runs()

        ids, texts, size, first = [], [], 0, None
        for batch in batches:
            for row, doc, text in zip(*(one_of(c, batch) for c in ("row", "doc_id", "text")), strict=True):
                raw = text.encode()
                if texts and size + len(raw) > CHUNK_BYTES:
                    yield from rows_of(STATE, [closed(first, ids, texts)])
                    ids, texts, size, first = [], [], 0, None
                first = row if first is None else first
                ids.append(doc)
                texts.append(raw)
                size += len(raw)
        if texts:
            yield from rows_of(STATE, [closed(first, ids, texts)])

    return run


def _anchor_task(length: int, buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("pairs", pa.binary())])

    def run(batches):
        for batch in batches:
            for name, sizes, packed, runs in zip(
                *(one_of(c, batch) for c in ("chunk", "sizes", "packed", "runs")), strict=True
            ):
                chunk = Chunk(packed, sizes, runs, length)
                order, cuts = chunk.by_bucket(buckets)
                pairs = np.stack([chunk.keys, chunk.digests(length)])[:, order]
                rows = (
                    (b, name, pairs[:, cuts[b] : cuts[b + 1]].tobytes())
                    for b in range(buckets)
                    if cuts[b + 1] > cuts[b]
                )
                yield from rows_of(schema, rows, 100)

    return run


ONCE, SAME, MIXED = 0, 1, 2


def _judge_group(group: pa.Table) -> pa.Table:
    """Each anchor's case, in the order in which its chunk sent it."""
    pairs = [np.frombuffer(b, np.uint64).reshape(2, -1) for b in group["pairs"].to_pylist()]
    keys, digests = np.concatenate(pairs, axis=1)
    order = np.lexsort((digests, keys))
    k, d = keys[order], digests[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    size = np.diff(np.r_[first, len(k)])
    mixed = d[first] != d[first + size - 1]
    case = np.where(mixed, MIXED, np.where(size > 1, SAME, ONCE)).astype(np.uint8)
    back = np.empty(len(k), np.uint8)
    back[order] = np.repeat(case, size)
    ends = np.cumsum([p.shape[1] for p in pairs])
    return pa.table(
        {
            "chunk": group["chunk"].cast(pa.int64()),
            "from_bucket": group["bucket"].cast(pa.int32()),
            "cases": pa.array([c.tobytes() for c in np.split(back, ends[:-1])], pa.binary()),
        }
    )


def _cases(chunk: Chunk, answers: dict[int, bytes], buckets: int):
    """Cases by run, and the runs of the mixed ones bucket by bucket."""
    order, cuts = chunk.by_bucket(buckets)
    cases = np.zeros(len(order), np.uint8)
    for b, blob in answers.items():
        cases[order[cuts[b] : cuts[b + 1]]] = np.frombuffer(blob, np.uint8)
    mixed = {}
    for b in range(buckets):
        own = order[cuts[b] : cuts[b + 1]]
        own = own[cases[own] == MIXED]
        if len(own):
            mixed[b] = own
    return cases, mixed


def _context_groups(length: int, buckets: int):
    """The mixed contexts of a chunk, for their buckets."""

    def run(state: pa.Table, answers: pa.Table) -> pa.Table:
        import zstandard

        out = {c: [] for c in ("bucket", "chunk", "shape", "contexts")}
        found = dict(zip(answers["from_bucket"].to_pylist(), answers["cases"].to_pylist(), strict=True))
        for k in range(state.num_rows):
            chunk = Chunk(
                state["packed"][k].as_py(), state["sizes"][k].as_py(), state["runs"][k].as_py(), length
            )
            for b, own in _cases(chunk, found, buckets)[1].items():
                shape = np.stack([chunk.last[own] - chunk.first[own], chunk.anchors[own] - chunk.first[own]])
                text = b"".join(
                    chunk.raw[a : e + length]
                    for a, e in zip(chunk.first[own].tolist(), chunk.last[own].tolist(), strict=True)
                )
                out["bucket"].append(b)
                out["chunk"].append(state["chunk"][k].as_py())
                out["shape"].append(shape.astype(np.int32).tobytes())
                out["contexts"].append(zstandard.ZstdCompressor(3).compress(text))
        kinds = {"bucket": pa.int32(), "chunk": pa.int64(), "shape": pa.binary(), "contexts": pa.binary()}
        return pa.table({c: pa.array(v, kinds[c]) for c, v in out.items()})

    return run


def repeated_windows(contexts: list[tuple[bytes, int, int]], length: int) -> list[np.ndarray]:
    """For each (text, windows, anchor) which of its windows starts anywhere else as well.

    Equal windows of different contexts have the anchor at the same distance.
    """
    distinct: dict[tuple, list] = {}
    for at, context in enumerate(contexts):
        distinct.setdefault(context, []).append(at)
    flags = [np.zeros(windows, bool) for _, windows, _ in distinct]
    symbols: list[int] = []
    strings: list[tuple[int, int, list]] = []
    code = 258
    for number, copies in enumerate(distinct.values()):
        flags[number][:] = len(copies) > 1
    # A window at place p is anchor - p bytes before the anchor. One range at a time is held.
    for r in range(max((anchor for _, _, anchor in distinct), default=0) // RANGE + 1):
        cores: dict[bytes, dict] = {}
        for number, (text, windows, anchor) in enumerate(distinct):
            begin = anchor - RANGE * r
            a, b = max(begin - RANGE + 1, 0), min(begin, windows - 1)
            if begin < 0 or a > b:
                continue
            core = text[begin : begin - RANGE + 1 + length]
            flanks = text[a:begin], text[begin - RANGE + 1 + length : b + length]
            same = cores.setdefault(hashlib.blake2b(core, digest_size=16).digest(), {})
            same.setdefault(flanks, []).append((number, a, b))
        for same in cores.values():
            for uses in same.values():
                if len(uses) > 1:
                    for number, a, b in uses:
                        flags[number][a : b + 1] = True
            if len(same) == 1:
                continue
            for (left, right), uses in same.items():
                strings.append((len(symbols), uses[0][2] - uses[0][1] + 1, uses))
                symbols += [x + 2 for x in left]
                symbols.append(code)
                symbols += [x + 2 for x in right]
                symbols.append(1)
            code += 1
    if strings:
        symbols.append(0)
        array = np.array(suffix_array(symbols), np.int64)
        values = np.concatenate([np.array(symbols, np.int64), np.zeros(RANGE, np.int64)])
        equal = np.ones(len(array) - 1, bool)
        for k in range(RANGE):
            column = values[array + k]
            equal &= column[1:] == column[:-1]
        twice = np.zeros(len(array), bool)
        twice[array[1:][equal]] = True
        twice[array[:-1][equal]] = True
        for start, count, uses in strings:
            for number, a, b in uses:
                flags[number][a : b + 1] |= twice[start : start + count]
    out: list = [None] * len(contexts)
    for own, copies in zip(flags, distinct.values(), strict=True):
        for at in copies:
            out[at] = own
    return out


def _repeat_group(length: int):
    def run(group: pa.Table) -> pa.Table:
        import zstandard

        contexts, counts = [], []
        for shape, packed in zip(group["shape"].to_pylist(), group["contexts"].to_pylist(), strict=True):
            more, anchors = np.frombuffer(shape, np.int32).reshape(2, -1).tolist()
            text, at = zstandard.ZstdDecompressor().decompress(packed), 0
            for windows, anchor in zip(more, anchors, strict=True):
                contexts.append((text[at : at + windows + length], windows + 1, anchor))
                at += windows + length
            counts.append(len(more))
        flags, at, out = repeated_windows(contexts, length), 0, []
        for n in counts:
            out.append(np.packbits(np.concatenate(flags[at : at + n])).tobytes())
            at += n
        return pa.table(
            {
                "chunk": group["chunk"].cast(pa.int64()),
                "from_bucket": group["bucket"].cast(pa.int32()),
                "flags": pa.array(out, pa.binary()),
            }
        )

    return run


def spans_of(covered: np.ndarray) -> tuple[list[int], list[int]]:
    edges = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8)))
    return edges[::2].tolist(), edges[1::2].tolist()


OUT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("starts", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())), ("kept", pa.binary()),
    ]
)


def _remove_groups(length: int, buckets: int):
    def run(state: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        names, cases, flags = (answers[c].to_pylist() for c in ("from_bucket", "cases", "flags"))
        found = {b: c for b, c in zip(names, cases, strict=True) if c is not None}
        marked = {b: f for b, f in zip(names, flags, strict=True) if f is not None}
        for k in range(state.num_rows):
            chunk = Chunk(
                state["packed"][k].as_py(), state["sizes"][k].as_py(), state["runs"][k].as_py(), length
            )
            judged, mixed = _cases(chunk, found, buckets)
            starts = np.zeros(len(chunk.data) + 1, bool)
            for a, b in zip(chunk.first[judged == SAME].tolist(), chunk.last[judged == SAME].tolist(), strict=True):
                starts[a : b + 1] = True
            for bucket, own in mixed.items():
                bits, at = np.unpackbits(np.frombuffer(marked[bucket], np.uint8)).astype(bool), 0
                for a, b in zip(chunk.first[own].tolist(), chunk.last[own].tolist(), strict=True):
                    starts[a : b + 1] = bits[at : at + b - a + 1]
                    at += b - a + 1
            change = np.zeros(len(chunk.data) + 1, np.int32)
            where = np.flatnonzero(starts)
            change[where] += 1
            change[where + length] -= 1
            covered = np.cumsum(change)[:-1] > 0
            begin = 0
            for doc, end in zip(state["doc_ids"][k].as_py(), chunk.ends.tolist(), strict=True):
                own = covered[begin:end]
                a, b = spans_of(own)
                rows.append((doc, end - begin, a, b, chunk.data[begin:end][~own].tobytes()))
                begin = end
        return pa.Table.from_batches(rows_of(OUT, rows), OUT)

    return run


def remove_repeats(
    docs: DataFrame, length: int = 200, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: key, n_bytes, the removed runs as byte offsets (starts, ends) and the bytes kept."""
    buckets = shuffle_width(docs.sparkSession)
    named = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    read = texts_of(named, "doc_id", row="row")
    state = materialize(read.mapInArrow(_chunk_task(length), STATE_SQL), "byte-chunks")
    cases = materialize(
        state.select("chunk", "sizes", "packed", "runs")
        .mapInArrow(_anchor_task(length, buckets), "bucket int, chunk long, pairs binary")
        .groupBy("bucket")
        .applyInArrow(_judge_group, "chunk long, from_bucket int, cases binary"),
        "anchor-cases",
    )
    contexts = (
        state.groupBy("chunk")
        .cogroup(cases.groupBy("chunk"))
        .applyInArrow(_context_groups(length, buckets), "bucket int, chunk long, shape binary, contexts binary")
    )
    repeats = materialize(
        contexts.groupBy("bucket").applyInArrow(
            _repeat_group(length), "chunk long, from_bucket int, flags binary"
        ),
        "repeated-windows",
    )
    nothing = F.lit(None).cast("binary")
    answers = cases.withColumn("flags", nothing).unionByName(repeats.withColumn("cases", nothing))
    kept = "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary"
    return (
        state.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(_remove_groups(length, buckets), kept)
        .withColumnRenamed("doc_id", key)
    )
