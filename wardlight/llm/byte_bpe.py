"""Byte-level BPE over chunks that overlap.

A text longer than ``chunk`` characters is cut into chunks, each with ``overlap`` further
characters of the next. The chunks are rows of their own, dealt over all tasks, and each is
pre-tokenised from its first character on, wherever that falls. The pattern looks ahead
but never back, so once two chunks agree on one boundary they agree on all that follow:
``stitch`` follows a chunk until its boundaries meet those of the next, and goes over to
that one. The pieces between boundaries are then encoded by merge ranks. Shorter texts
are one chunk and are encoded where they are read. Decoding concatenates the bytes of the
ids. Results are those of a tiktoken encoding with the same pattern and ranks and no
special tokens.

Defined cases: a null or empty text has no ids; a run without any boundary that is longer
than the overlap is tokenised again from the last sure boundary until the sides meet;
repeated rows are encoded each alone, ids may be null; no other column is read.
"""

from __future__ import annotations

import array
import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import one_of, rows_of, shuffle_width, texts_of, worker_kept

#: Pieces remembered by a worker; it starts over beyond that, so its memory is bounded.
REMEMBERED = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Known(dict):
    """Pieces met, each with its ids as packed 32-bit numbers."""

    def __init__(self, encode_piece):
        self.encode_piece = encode_piece

    def __missing__(self, piece: str) -> bytes:
        found = self[piece] = array.array("i", self.encode_piece(piece) if piece else ()).tobytes()
        return found


class Coder:
    """Ids of pieces, and the decimal text and the bytes of ids, for one vocabulary and pattern."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import tiktoken

        ranks = read_ranks(ranks_path)
        self.pieces = regex.compile(pattern)
        library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known = Known(library._encode_single_piece)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        # Every id in decimal with its comma, filled up with zero bytes to one width.
        named = np.array([f"{i}," for i in range(len(tokens))], "S")
        self.decimals = named.view(np.uint8).reshape(len(tokens), -1)

    def encode_pieces(self, pieces: list[str]) -> np.ndarray:
        """Ids of pre-tokens, each merged on its own."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        return np.frombuffer(b"".join(map(self.known.__getitem__, pieces)), np.int32)

    def decimal(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by commas."""
        wide = self.decimals[ids].ravel()
        return wide[wide != 0][:-1].tobytes()

    def decode(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ids):
            return b""
        return self.bytes[np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(ends[-1])].tobytes()


def kept_coder(ranks_path: str, pattern: str) -> Coder:
    return worker_kept(("byte coder", ranks_path, pattern), lambda: Coder(ranks_path, pattern))


def piece_ends(pieces, text: str, start: int = 0) -> list[int]:
    """Ends of the matches from ``start`` on. The pattern covers every character."""
    return [m.end() for m in pieces.finditer(text, start)]


def cut(text: str, chunk: int, overlap: int) -> Iterator[tuple[int, str]]:
    for start in range(0, max(len(text), 1), chunk):
        yield start, text[start : start + chunk + overlap]


def stitch(pieces, text: str, starts: list[int], ends: list[list[int]], sizes: list[int]) -> list[int]:
    """Ends of the whole text's pieces, out of the ends found in each chunk.

    A chunk's last piece is unsure unless the chunk ends the text, as is the one before:
    more text might have made it longer. Every other end is sure from the first one that
    the chunk before has as well.
    """
    total, whole = len(text), []
    position = 0
    for k, start in enumerate(starts):
        reach = start + sizes[k]
        own = [start + e for e in ends[k]]
        if reach < total:
            own = own[:-2]
        if not k:
            whole, position = own, own[-1] if own else 0
            continue
        # Where both sides have a boundary, the rest of this chunk holds.
        marks = set(own)
        low = bisect_left(whole, start)
        met = next((i for i in range(low, len(whole)) if whole[i] in marks), None)
        if met is None and start in marks | {start} and whole and whole[-1] == start:
            met = len(whole) - 1
        if met is None:
            # No common boundary: go on from the last sure one until there is one.
            found = None
            for m in pieces.finditer(text, position):
                whole.append(m.end())
                if m.end() in marks:
                    found = m.end()
                    break
                if m.end() >= reach:
                    break
            position = whole[-1] if whole else position
            if found is None:
                continue
            met = len(whole) - 1
        boundary = whole[met]
        del whole[met + 1 :]
        whole += own[bisect_left(own, boundary + 1) :] if own else []
        position = whole[-1] if whole else position
    if position < total:
        whole += piece_ends(pieces, text, position)
    return whole


ENCODED = "n_tokens long, ids array<int>"


def _encode_task(ranks_path: str, pattern: str, finish: str):
    def run(batches):
        coder = kept_coder(ranks_path, pattern)
        for batch in batches:
            keys = one_of("key", batch)
            rows = (
                (key, *_finished(coder, coder.encode_pieces(coder.pieces.findall(text)), finish))
                for key, text in zip(keys, one_of("text", batch), strict=True)
            )
            yield from rows_of(_arrow(finish), rows, 200)

    return run


def _finished(coder: Coder, ids: np.ndarray, finish: str) -> tuple:
    if finish == "ids":
        return (len(ids), ids)
    digests = (hashlib.sha256(part).hexdigest() for part in (coder.decimal(ids), coder.decode(ids)))
    return (len(ids), *digests)


def _arrow(finish: str) -> pa.Schema:
    tail = (
        [("ids", pa.list_(pa.int32()))]
        if finish == "ids"
        else [("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )
    return pa.schema([("key", pa.int64()), ("n_tokens", pa.int64()), *tail])


def _cut_task(chunk: int, overlap: int):
    schema = pa.schema(
        [("row", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("part", pa.string())]
    )

    def run(batches):
        for batch in batches:
            rows = (
                (row, key, start, part)
                for row, key, text in zip(*(one_of(c, batch) for c in ("row", "key", "text")), strict=True)
                for start, part in cut(text, chunk, overlap)
            )
            yield from rows_of(schema, rows, 100)

    return run


def _pretokenise_task(pattern: str, chunk: int):
    schema = pa.schema(
        [
            ("row", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("size", pa.int64()),
            ("part", pa.string()), ("ends", pa.list_(pa.int32())),
        ]
    )

    def run(batches):
        import regex

        pieces = regex.compile(pattern)
        for batch in batches:
            rows = (
                (row, key, start, len(part), part[:chunk], piece_ends(pieces, part))
                for row, key, start, part in zip(
                    *(one_of(c, batch) for c in ("row", "key", "start", "part")), strict=True
                )
            )
            yield from rows_of(schema, rows, 100)

    return run


def _stitch_group(ranks_path: str, pattern: str, finish: str):
    def run(batches):
        coder = kept_coder(ranks_path, pattern)
        for chunks in batches:
            found = sorted(chunks.to_pylist(), key=lambda c: c["start"])
            text = "".join(c["part"] for c in found)
            ends = stitch(
                coder.pieces, text, [c["start"] for c in found], [c["ends"] for c in found],
                [c["size"] for c in found],
            )
            pieces = [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            ids = coder.encode_pieces(pieces)
            yield from rows_of(_arrow(finish), [(found[0]["key"], *_finished(coder, ids, finish))])

    return run


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    chunk: int = 32_768,
    overlap: int = 1_024,
    finish: str = "ids",
) -> DataFrame:
    """One row per row of ``docs``: the key, n_tokens and the ids, or with ``finish="digest"``
    sha256 of the decimal ids joined by commas and of the bytes decoded from the ids."""
    named = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    wide = texts_of(named, "key", row="row")
    kind = "ids array<int>" if finish == "ids" else "ids_sha256 string, decoded_sha256 string"
    out = f"key long, n_tokens long, {kind}"
    short = wide.filter(F.length("text") <= chunk).select("key", "text")
    encoded = short.mapInArrow(_encode_task(ranks_path, pattern, finish), out)
    chunks = (
        wide.filter(F.length("text") > chunk)
        .mapInArrow(_cut_task(chunk, overlap), "row long, key long, start long, part string")
        .repartition(shuffle_width(docs.sparkSession), "row", "start")
        .mapInArrow(
            _pretokenise_task(pattern, chunk),
            "row long, key long, start long, size long, part string, ends array<int>",
        )
    )
    def one_group(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches(_stitch_group(ranks_path, pattern, finish)([group]), _arrow(finish))

    stitched = chunks.groupBy("row").applyInArrow(one_group, out)
    return encoded.unionByName(stitched).withColumnRenamed("key", key)


def decode_ids(ids_column: str, ranks_path: str, to: str = "bytes"):
    """A mapInArrow function: the rows with the bytes that their ids stand for."""

    def run(batches):
        bytes_of = {rank: token for token, rank in read_ranks(ranks_path).items()}
        for batch in batches:
            decoded = [
                b"".join(map(bytes_of.__getitem__, ids or [])) for ids in one_of(ids_column, batch)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.binary())], names=[*batch.schema.names, to]
            )

    return run
