"""Removal of repeated units of text, found by their digests.

A text is cut into units that cover every character: lines, paragraphs, or the sentences of
its lines. A unit is normalised (A-Z lower-cased, white space squeezed) and hashed to 128
bits; the digests of all documents are grouped, and only the occurrence that comes first
by the ranking columns and then by place stays. Units of fewer than ``min_words`` words are
too common to say anything: they stay, except between two removed ones.

The unit ``passage`` finds what is repeated wherever it starts and ends. Its units overlap:
sentences of ``min_words`` words and more, whole lines of any length, and windows between
cuts that the words themselves set. A cut is where a hash of two neighbouring words is the
least of ``REACH`` in a row, so cuts far enough inside equal runs are the same whatever
surrounds them; a window goes from a cut to the first one ``min_words`` words on. Any run of
50 words holds such a window at the default. A word is a run without blanks, or one letter
of a script that has none. What is in any unit that came before goes, and so do fewer than
``min_words`` words left between two removed spans.

Only digests and places are shuffled for the search. The group of a digest is a minimum,
combined before it is sent, so a line that stands in a third of all documents is as cheap
as any other; the winners then go home by document, and no join has a digest as its key.

Defined cases: a null text counts as empty and has no units; equal ranks are told apart by
the row's place in the table; null ranks come first; an empty text gives empty lists;
repeated rows keep the first row's units; columns with the names used here are not touched,
since a step carries only the key, the ranks and the text.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from wardlight.llm.common import BLANKS, mix64, one_of, rows_of, texts_of

# Every character is in exactly one unit; what ends a unit belongs to it.
UNITS = {
    "sentence": r"[^.!?\n]+[.!?\n]*|[.!?\n]+",
    "line": r"[^\n]+\n*|\n+",
    "paragraph": r"(?:[^\n]+\n?)+\n*|\n+",
}
PASSAGE = "passage"
#: Letters of scripts that put no blanks between words.
ALONE = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF),
    (0xF900, 0xFAFF), (0x20000, 0x3FFFF),
)
#: Of so many neighbouring places, the one with the least hash is a cut.
REACH = 10
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def units_of(text: str, unit: str) -> list[str]:
    return re.findall(UNITS[unit], text)


def normal(text: str) -> list[bytes]:
    """The words of a unit; joined by one blank they are its normal form."""
    return text.encode().translate(LOWER).split()


def cuts_of(words: list[str]) -> np.ndarray:
    """Places between words that the words around them choose, with both ends of the text."""
    import xxhash

    n = len(words)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    before = np.r_[np.zeros(1, np.uint64), hashes[:-1]]
    hashes = mix64(hashes ^ mix64(before + np.uint64(1)))
    if n < REACH:
        return np.array([0, n])
    # The place in the lower half: of equal hashes the last is the least.
    low = np.uint64(0xFFFFFFFF)
    least = (hashes & ~low) | np.arange(n - 1, -1, -1).astype(np.uint64)
    held = 1
    while held < REACH:
        step = min(held, REACH - held)
        least, held = np.minimum(least[:-step], least[step:]), held + step
    return np.unique(np.r_[0, n, n - 1 - (least & low).astype(np.int64)])


def passages_of(text: str, min_words: int) -> tuple[np.ndarray, np.ndarray, list[slice], str]:
    """Starts and ends of the units of a text, in order; their normal forms as slices of a string.

    They overlap, and go from a word to a word, so that the same words at the same place are
    one unit.
    """
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    codes = np.where((codes >= 65) & (codes <= 90), codes + np.uint32(32), codes)
    dark = ~((codes == 32) | ((codes >= 9) & (codes <= 13)))
    inked = np.flatnonzero(dark)
    none = np.empty(0, np.int64)
    if not len(inked):
        return none, none, [], ""
    begins = dark & ~np.r_[False, dark[:-1]]
    if codes.max() >= 0x0E00:
        alone = np.zeros(len(codes), bool)
        for low, high in ALONE:
            alone |= (codes >= low) & (codes <= high)
        begins |= dark & (alone | np.r_[False, alone[:-1]])
    starts = np.flatnonzero(begins)
    word = np.cumsum(begins) - 1
    # Each letter's place in the normal form: letters before it, and a blank for each word.
    place = np.cumsum(dark) - 1 + word
    form = np.full(place[inked[-1]] + 1, 32, "<u4")
    form[place[inked]] = codes[inked]
    normal_text = form.tobytes().decode("utf-32-le")
    ends = inked[np.searchsorted(inked, np.r_[starts[1:], len(codes)]) - 1] + 1

    def between(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(inked, np.r_[0, bounds, len(codes)])
        some = at[1:] > at[:-1]
        return inked[at[:-1][some]], inked[at[1:][some] - 1] + 1

    stops = (codes == 46) | (codes == 33) | (codes == 63) | (codes == 10)
    first, last = between(np.flatnonzero(stops[:-1] & ~stops[1:]) + 1)
    long = word[last - 1] - word[first] + 1 >= min_words
    cuts = cuts_of(normal_text.split(" "))
    at = np.searchsorted(cuts, cuts + min_words)
    own = at < len(cuts)
    lines = between(np.flatnonzero(codes == 10))
    first = np.r_[first[long], starts[cuts[own]], lines[0]]
    last = np.r_[last[long], ends[cuts[at[own]] - 1], lines[1]]
    both = np.unique((first << 32) | last)
    first, last = both >> 32, both & 0xFFFFFFFF
    return first, last, list(map(slice, place[first].tolist(), (place[last - 1] + 1).tolist())), normal_text


def passages_gone(text: str, spans: list[tuple[int, int]], min_words: int) -> list[tuple[int, int]]:
    """The removed spans with the blanks behind them, joined where they meet or where too few
    words are left between them."""
    out: list[list[int]] = []
    for a, b in spans:
        if out and (a <= out[-1][1] or words_in(text[out[-1][1] : a]) < min_words):
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
        while out[-1][1] < len(text) and text[out[-1][1]] in BLANKS:
            out[-1][1] += 1
    return [(a, b) for a, b in out]


def words_in(text: str) -> int:
    alone = sum(any(low <= ord(c) <= high for low, high in ALONE) for c in text) if not text.isascii() else 0
    return max(alone, len(normal(text)))


def forms_of(text: str, unit: str, min_words: int) -> list[tuple[int, bytes]]:
    """Place and normal form of each unit that is searched for."""
    if unit == PASSAGE:
        *_, slices, normal_text = passages_of(text, min_words)
        return [(place, normal_text[own].encode()) for place, own in enumerate(slices)]
    units = enumerate(map(normal, units_of(text, unit)))
    return [(place, b" ".join(words)) for place, words in units if len(words) >= min_words]


def _digest_task(unit: str, min_words: int):
    schema = pa.schema([("row", pa.int64()), ("place", pa.int32()), ("digest", pa.binary())])

    def run(batches):
        for batch in batches:
            rows = (
                (row, place, hashlib.md5(form).digest())
                for row, text in zip(one_of("row", batch), one_of("text", batch), strict=True)
                for place, form in forms_of(text, unit, min_words)
            )
            yield from rows_of(schema, rows, 20_000)

    return run


def removals(units: list[str], kept: set[int], min_words: int) -> list[bool]:
    """Whether each unit goes. A short one goes where the long ones around it both do."""
    flags: list[bool | None] = [
        None if len(normal(u)) < min_words else place not in kept for place, u in enumerate(units)
    ]
    after, following = False, []
    for flag in reversed(flags):
        after = after if flag is None else flag
        following.append(after)
    following.reverse()
    before, out = False, []
    for flag, later in zip(flags, following, strict=True):
        before = before if flag is None else flag
        out.append(flag if flag is not None else before and later)
    return out


def without_passages(text: str, kept: set[int], min_words: int) -> tuple:
    """Text left, units, removed units, and the starts and ends of what went."""
    starts, ends, *_ = passages_of(text, min_words)
    units = list(zip(starts.tolist(), ends.tolist(), strict=True))
    again = [span for place, span in enumerate(units) if place not in kept]
    gone = passages_gone(text, again, min_words)
    rest = [text[a:b] for a, b in zip([0, *[b for _, b in gone]], [*[a for a, _ in gone], len(text)], strict=True)]
    return "".join(rest), len(units), len(again), [a for a, _ in gone], [b for _, b in gone]


def _remove_task(unit: str, min_words: int, extra: pa.Schema):
    own = [
        ("text", pa.string()), ("n_units", pa.int64()), ("n_removed", pa.int64()),
        ("removed_starts", pa.list_(pa.int64())), ("removed_ends", pa.list_(pa.int64())),
    ]

    def run(batches):
        for batch in batches:
            found = []
            for text, places in zip(one_of("text", batch), one_of("places", batch), strict=True):
                if unit == PASSAGE:
                    found.append(without_passages(text, set(places or ()), min_words))
                    continue
                units = units_of(text, unit)
                gone = removals(units, set(places or ()), min_words)
                starts, ends, rest, at = [], [], [], 0
                for piece, away in zip(units, gone, strict=True):
                    if away and ends and ends[-1] == at:
                        ends[-1] += len(piece)
                    elif away:
                        starts.append(at)
                        ends.append(at + len(piece))
                    else:
                        rest.append(piece)
                    at += len(piece)
                found.append(("".join(rest), len(units), sum(gone), starts, ends))
            kept = [batch.column(batch.schema.get_field_index(f.name)) for f in extra]
            columns = list(zip(*found, strict=True)) if found else [[]] * len(own)
            yield pa.RecordBatch.from_arrays(
                kept + [pa.array(list(c), kind) for c, (_, kind) in zip(columns, own, strict=True)],
                names=[f.name for f in extra] + [n for n, _ in own],
            )

    return run


def dedup_units(
    docs: DataFrame,
    ranks: tuple[str, ...] = ("doc_id",),
    unit: str = "sentence",
    min_words: int = 6,
    text: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: the columns of ``ranks`` and ``keep``, the text left, n_units, n_removed, and
    the removed spans as character offsets of the original text, neighbours joined."""
    named = {c: f"rank{i}" for i, c in enumerate(ranks)}
    carried = named | {c: f"kept{i}" for i, c in enumerate(keep)}
    named_docs = docs.select(*[F.col(c).alias(n) for c, n in carried.items()], F.col(text).alias("text"))
    wide = texts_of(named_docs, *carried.values(), row="row")
    digests = wide.select("row", *named.values(), "text").mapInArrow(
        _ranked(_digest_task(unit, min_words), list(named.values())),
        ", ".join(
            [f"{c} {wide.schema[c].dataType.simpleString()}" for c in named.values()]
            + ["row long, place int, digest binary"]
        ),
    )
    first = F.min(F.struct(*named.values(), "row", "place")).alias("first")
    winners = digests.groupBy("digest").agg(first).select("first.row", "first.place")
    homes = winners.groupBy("row").agg(F.collect_list("place").alias("places"))
    joined = wide.join(homes, "row", "left").select(*carried.values(), "text", "places")
    extra = to_arrow_schema(wide.select(*carried.values()).schema)
    left = joined.mapInArrow(
        _remove_task(unit, min_words, extra),
        ", ".join(
            [f"{c} {wide.schema[c].dataType.simpleString()}" for c in carried.values()]
            + ["text string, n_units long, n_removed long, removed_starts array<long>, removed_ends array<long>"]
        ),
    )
    return left.withColumnsRenamed({v: k for k, v in carried.items()})


def _ranked(task, names: list[str]):
    """Digest rows with the ranks of their document in front."""

    def run(batches):
        for batch in batches:
            place_of = {row: i for i, row in enumerate(one_of("row", batch))}
            for out in task(iter([batch])):
                at = pa.array([place_of[r] for r in out.column(0).to_pylist()], pa.int64())
                ranks = [batch.column(batch.schema.get_field_index(n)).take(at) for n in names]
                yield pa.RecordBatch.from_arrays(ranks + out.columns, names=names + out.schema.names)

    return run
