"""Benchmark decontamination over a distributed positional inverted index.

``build`` stores the postings of every word of every document: a segment is a run of
documents of about two million words with its own dictionary, and for each word the ascending
positions it stands at. Segments are built where the texts are read, so nothing is shuffled;
they are written once to the shared folder and searched any number of times.

``search`` takes windows of item words to the segments. In each it starts from the window's
rarest word, moves that word's positions to where the window would begin, and intersects them
with the positions of the next rarer one, until they are used up or none is left: that is an
exact phrase. With ``slop``, a window also matches near a place if each of its words stands
within ``slop`` words of where the phrase has it, in the same document. Items come to the
segments in blocks of at most 4 MB, each a job over the stored index.

Words are the runs of letters a-z, digits and all characters beyond ASCII, with A-Z lowered.
A text of more than a million words is indexed in parts that overlap by ``reach`` words.

Defined cases: a null or empty text has no words and matches nothing; an item without words
has no windows, one of fewer words than a window is one window; an item without an id hits
words but is not listed; items that share an id are one in the lists; repeated documents are
rows of their own; empty tables give no matches, or all documents clean; other columns are
not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlight.llm.common import one_of, rows_of, texts_of
from wardlight.session import scratch_path

SEGMENT_WORDS = 1 << 21
PART_WORDS = 1 << 20
REACH = 64
BLOCK_BYTES = 1 << 22

#: Bytes of words as themselves in lower case, all others as blanks.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

PART = pa.struct(
    [("row", pa.int64()), ("id", pa.string()), ("first", pa.int64()), ("own", pa.int64()), ("lead", pa.int64()), ("at", pa.int64())]
)
INDEX = "parts array<struct<row: long, id: string, first: long, own: long, lead: long, at: long>>, terms binary, counts binary, postings binary"
MATCH = "row long, id string, item string, offset long, start long, length long, exact boolean"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class _Segment:
    """Documents on their way to one row of the index."""

    def __init__(self):
        self.numbers: dict[bytes, int] = defaultdict(count().__next__)
        self.parts: list[tuple] = []
        self.ids: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.at = 0

    def add(self, row: int, name: str | None, first: int, own: int, lead: int, words: list[bytes]) -> None:
        """``words`` are the part's own from the one numbered ``first``, ``lead`` before and some after."""
        self.parts.append((row, name, first, own, lead, self.at + lead))
        self.ids.append(np.fromiter(map(self.numbers.__getitem__, words), np.uint32, len(words)))
        self.places.append(np.arange(self.at, self.at + len(words), dtype=np.uint32))
        self.at += len(words) + 1  # one place between documents, so that no phrase crosses it

    def packed(self) -> tuple:
        ids, places = np.concatenate(self.ids), np.concatenate(self.places)
        keys = (ids.astype(np.uint64) << np.uint64(32)) | places
        keys.sort()
        counts = np.bincount(ids, minlength=len(self.numbers)).astype(np.uint32)
        ordered = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        steps = np.diff(ordered, prepend=np.uint32(0))
        starts = (np.cumsum(counts, dtype=np.int64) - counts)[: len(self.numbers)]
        steps[starts] = ordered[starts]
        planes = np.ascontiguousarray(steps.astype("<u4").view(np.uint8).reshape(-1, 4).T)
        parts = [dict(zip(("row", "id", "first", "own", "lead", "at"), p, strict=True)) for p in self.parts]
        return parts, b" ".join(self.numbers), counts.astype("<u4").tobytes(), planes.tobytes()


def _index(reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("parts", pa.list_(PART)), ("terms", pa.binary()), ("counts", pa.binary()), ("postings", pa.binary())]
        )

        def segments():
            now = _Segment()
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
                for row, name, text in zip(one_of("row", batch), one_of("id", batch), texts, strict=True):
                    words = words_of(text.as_py())
                    for first in range(0, len(words) or 1, PART_WORDS):
                        own = min(PART_WORDS, len(words) - first)
                        lead = min(first, reach)
                        now.add(row, name, first, own, lead, words[first - lead : first + own + reach])
                        if now.at >= SEGMENT_WORDS:
                            yield now.packed()
                            now = _Segment()
            if now.parts:
                yield now.packed()

        yield from rows_of(schema, segments(), 1)

    return run


def build(docs: DataFrame, key: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """The stored index of ``docs``; phrases of up to ``reach`` words (with slop) can be sought."""
    spark = docs.sparkSession
    rows = texts_of(docs, key, text=text, row="row").select("row", F.col(key).cast("string").alias("id"), "text")
    path = scratch_path(spark, "phrase-index")
    # A row is several MB: few in a row group, so that few are read at once.
    rows.mapInArrow(_index(reach), INDEX).write.option("parquet.block.row.count.limit", 4).parquet(path)
    return spark.read.schema(INDEX).parquet(path)


class _Windows:
    """The windows of a block of items, as one matrix of term numbers."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.terms: dict[bytes, int] = defaultdict(count().__next__)
        rows, self.item, self.offset, self.length = [], [], [], []
        for k, (_, words) in enumerate(items):
            numbers = [self.terms[w] for w in words]
            size = min(window, len(words))
            for at in range(len(words) - size + 1 if words else 0):
                rows.append(numbers[at : at + size] + [-1] * (window - size))
                self.item.append(k)
                self.offset.append(at)
                self.length.append(size)
        self.names = [name for name, _ in items]
        self.terms = dict(self.terms)
        self.matrix = np.array(rows, np.int64).reshape(-1, window)


class _Postings:
    """The position lists of one segment, unpacked as they are asked for."""

    def __init__(self, counts: np.ndarray, planes: bytes):
        self.counts = counts
        self.ends = np.cumsum(counts, dtype=np.int64)
        self.planes = np.frombuffer(planes, np.uint8).reshape(4, -1)
        self.known: dict[int, np.ndarray] = {}

    def of(self, term: int) -> np.ndarray:
        if term not in self.known:
            end = int(self.ends[term])
            steps = np.ascontiguousarray(self.planes[:, end - int(self.counts[term]) : end].T).view("<u4")[:, 0]
            self.known[term] = np.cumsum(steps, dtype=np.int64)
        return self.known[term]


def _begins(lists: list[np.ndarray], slop: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places where a window begins whose word at offset j stands at ``lists[j]``.

    ``starts`` and ``ends`` are the documents' places, for words out of place.
    """
    rarest_first = sorted(range(len(lists)), key=lambda j: len(lists[j]))
    offset, *others = rarest_first
    begins = lists[offset] - offset
    if slop:
        begins = np.unique((begins[:, None] + np.arange(-slop, slop + 1)).ravel())
        begins = begins[(begins >= 0) & (begins < ends[-1])]
        others = rarest_first
    for j in others:
        if not len(begins):
            break
        low, high = begins + j, begins + j
        if slop:
            at = np.searchsorted(starts, begins, "right") - 1
            low, high = np.maximum(low - slop, starts[at]), np.minimum(high + slop, ends[at] - 1)
        places = lists[j]
        found = np.searchsorted(places, low)
        begins = begins[(found < len(places)) & (places[np.minimum(found, len(places) - 1)] <= high)]
    return begins


def _search(block, window: int, slop: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sought = _Windows(block.value, window)
        item, offset, length = (np.array(x, np.int64) for x in (sought.item, sought.offset, sought.length))
        schema = pa.schema(
            [("row", pa.int64()), ("id", pa.string()), ("item", pa.string()), ("offset", pa.int64()),
             ("start", pa.int64()), ("length", pa.int64()), ("exact", pa.bool_())]
        )

        def matches():
            for batch in batches:
                for parts, terms, counts, planes in zip(
                    *(batch.column(batch.schema.get_field_index(c)) for c in ("parts", "terms", "counts", "postings")),
                    strict=True,
                ):
                    held = _Postings(np.frombuffer(counts.as_py(), "<u4").astype(np.int64), planes.as_py())
                    parts = parts.values.flatten()
                    rows, names, *numbers = parts[0].to_numpy(), parts[1], *(p.to_numpy() for p in parts[2:])
                    yield from _segment(sought, item, offset, length, held, terms.as_py(), slop, rows, names, *numbers)

        yield from rows_of(schema, matches())

    return run


def _segment(sought, item, offset, length, held, terms, slop, rows, names, first, own, lead, at):
    """Matches of all windows in one segment, windows that go on from each other as one."""
    here = np.full(len(sought.terms) + 1, -1, np.int64)  # the last is for places that a short window leaves free
    for k, term in enumerate(terms.split(b" ") if terms else ()):
        number = sought.terms.get(term)
        if number is not None:
            here[number] = k
    present = (here[sought.matrix] >= 0) | (sought.matrix < 0)
    begins = at - lead
    total = int(held.counts.sum()) + len(at)  # each part is followed by one free place
    ends = np.append(begins[1:], total) - 1
    found = []
    for w in np.flatnonzero(present.all(axis=1)).tolist():
        lists = [held.of(int(here[t])) for t in sought.matrix[w, : length[w]]]
        exact = _begins(lists, 0, begins, ends)
        if len(exact):
            found.append((w, exact, True))
        if slop:
            near = np.setdiff1d(_begins(lists, slop, begins, ends), exact)
            if len(near):
                found.append((w, near, False))
    if not found:
        return
    w = np.repeat([f[0] for f in found], [len(f[1]) for f in found])
    begin = np.concatenate([f[1] for f in found])
    exact = np.repeat([f[2] for f in found], [len(f[1]) for f in found])
    part = np.searchsorted(begins, begin, "right") - 1
    local = begin - at[part]
    mine = (local >= 0) & (local < own[part])  # a part's overlaps belong to its neighbours
    if not mine.any():
        return
    w, begin, exact, part, local = w[mine], begin[mine], exact[mine], part[mine], local[mine]
    order = np.lexsort((offset[w], begin - offset[w], item[w], part, exact))
    w, begin, exact, part, local = w[order], begin[order], exact[order], part[order], local[order]
    same = (
        (np.diff(part) == 0) & (np.diff(item[w]) == 0) & (np.diff(begin - offset[w]) == 0)
        & (np.diff(offset[w]) == 1) & (np.diff(exact.astype(np.int8)) == 0)
    )
    heads = np.flatnonzero(np.append(True, ~same))
    tails = np.append(heads[1:], len(w)) - 1
    for h, t in zip(heads.tolist(), tails.tolist(), strict=True):
        p = int(part[h])
        yield (
            int(rows[p]), names[p].as_py(), sought.names[item[w[h]]], int(offset[w[h]]), int(first[p] + local[h]),
            int(offset[w[t]] - offset[w[h]] + length[w[t]]), bool(exact[h]),
        )


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    block, size = [], 0
    for name, words in items.select(F.col(key).cast("string"), F.coalesce(F.col(text), F.lit(""))).toLocalIterator():
        if block and size + len(words) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((name, words_of(words.encode())))
        size += len(words)
    if block:
        yield block


def search(
    index: DataFrame, items: DataFrame, window: int = 10, slop: int = 0, key: str = "item_id", text: str = "text",
    reach: int = REACH,
) -> DataFrame:
    """Where windows of the items stand in the documents.

    One row for each maximal run: document row and id, item, the run's first word in the item
    (offset) and in the document (start), its words (length), and whether it is exact or, with
    slop, near only. ``reach`` is what the index was built with.
    """
    if window + slop > reach:
        raise ValueError(f"a window of {window} and slop of {slop} need an index built with that reach")
    spark = index.sparkSession
    found = [
        index.mapInArrow(_search(spark.sparkContext.broadcast(block), window, slop), MATCH)
        for block in _blocks(items, key, text)
    ]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], MATCH)


def contamination(index: DataFrame, matches: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row for each document: its words, how many lie inside a match, and which items do."""
    docs = (
        index.select(F.explode("parts").alias("part"))
        .groupBy("part.row")
        .agg(F.first("part.id").alias(key), F.sum("part.own").alias("n_words"))
    )
    before = W.partitionBy("row").orderBy("start", "length").rowsBetween(W.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    fresh = F.greatest(end - F.greatest("start", F.coalesce(F.max(end).over(before), F.lit(0))), F.lit(0))
    hit = (
        matches.withColumn("fresh", fresh)
        .groupBy("row")
        .agg(F.sum("fresh").alias("n_hit"), F.sort_array(F.collect_set("item")).alias("items"))
    )
    return docs.join(hit, "row", "left").select(
        key, "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )
