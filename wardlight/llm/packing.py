"""Bounded-space online packing of token ids into windows of fixed length.

Every task keeps ``open_windows`` windows open. A document goes whole into the open window
that it fills best. Where none has room, the fullest is filled to the brim with the head
of the document and emitted, and the rest goes on; so a window leaves a task only full.
What stays open at the end of a task is merged by the same rule in groups of tasks, group
after group, until one group is left; its last window is cut at powers of two, which
need no padding.

Windows still open carry their ids with them, at most ``open_windows`` a task, so a merge
never sees more than ``fan_in`` x ``open_windows`` x ``length`` ids.

Defined cases: a null or empty text is one document of the end id alone; a document longer
than a window fills several; rows that repeat or have no id are packed each alone; an
empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import zlib
from array import array
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import BLANKS, materialize, one_of, rows_of, texts_of, worker_kept

#: Words remembered by a worker process; it starts over beyond that, so its memory is bounded.
REMEMBERED = 500_000
#: Bytes of texts encoded at once, besides one longer text. What that takes on the way is many times as much.
AT_ONCE = 1 << 21
PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
OPEN = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
        ("task", pa.int64()), ("ids", pa.binary()),
    ]
)


#: Kinds of a text's bytes. A word with a byte of the last kind is of that kind as a whole.
BLANK, LETTER, DIGIT, MARK, ODD = range(5)


def _kinds() -> np.ndarray:
    """The kind of each byte in UTF-8. Odd: quotes, controls, and what is neither ASCII nor a letter up to "ÿ"."""
    kinds = np.full(256, ODD, np.uint8)
    for code in range(0x21, 0x7F):
        kinds[code] = LETTER if chr(code).isalpha() else DIGIT if chr(code).isdigit() else MARK
    kinds[ord("'")] = ODD
    kinds[list(BLANKS.encode())] = BLANK
    # 0xC3 leads the characters from "À" to "ÿ"; all are letters but "×" and "÷". Any other lead is odd.
    kinds[[0xC3, *range(0x80, 0xC0)]] = LETTER
    kinds[["×".encode()[1], "÷".encode()[1]]] = ODD
    return kinds


def _lower() -> np.ndarray:
    """The lower case of each byte of a letter."""
    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A") : ord("Z") + 1] += 32
    lower["À".encode()[1] : "Þ".encode()[1] + 1] += 32
    return lower


KINDS, LOWER = _kinds(), _lower()
LETTERS = np.flatnonzero(KINDS == LETTER).astype(np.uint8).tobytes()


class WordEncoder:
    """Ids of a text by a tokenizer that drops white space and lets no token span it.

    The text is then the sequence of its words. A word of letters up to "ÿ", digits and ASCII
    marks without a quote is in turn the sequence of its runs of one kind, which the tokenizer's
    pattern parts, and its case is dropped there. Runs and other words are numbered by an Arrow
    dictionary for many texts at once, so that ids are looked up once for each distinct run;
    what is not known yet goes to the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # For a lower-case word of Latin letters only the merges are left to do. Many go in one
        # string; the line feed between them is a piece of its own there, and so is its id.
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split("\n", "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.between = self.merges.encode("\n", add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.starts = array("I"), array("I", [0])

    def _keep(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        first = len(self.starts) - 1
        self.known.update(zip(words, range(first, first + len(words)), strict=True))
        self.starts.frombytes((len(self.flat) + np.cumsum(sizes)).astype(np.uint32).tobytes())
        self.flat.frombytes(ids.astype(np.uint32).tobytes())

    def _keep_lists(self, words: list[bytes], tokenizer) -> None:
        texts = [word.decode() for word in words]
        found = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self._keep(words, np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes)

    def _keep_merged(self, words: list[bytes]) -> None:
        """Words without line feeds, by the merges alone."""
        if len(self.between) != 1:
            self._keep_lists(words, self.merges)
            return
        # Short strings, since the library's time for a cut grows with the string's length.
        joined = [b"\n".join(words[k : k + 20]).decode() for k in range(0, len(words), 20)]
        found = [e.ids + self.between for e in self.merges.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), np.uint32, sum(map(len, found)))
        cuts = np.flatnonzero(ids == self.between[0])
        self._keep(words, np.delete(ids, cuts), np.diff(np.concatenate([[-1], cuts])) - 1)

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words numbered ``at``, one after another, and where each begins and the last ends."""
        flat, starts = np.frombuffer(self.flat, np.uint32), np.frombuffer(self.starts, np.uint32)
        first = starts[at].astype(np.int64)
        sizes = starts[at + 1] - first
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return flat[np.repeat(first - ends[:-1], sizes) + np.arange(ends[-1])], ends

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        """Numbers of distinct words; those not known yet are learned."""
        if len(self.known) > REMEMBERED:
            self._forget()
        known = self.known
        new = [word for word in words if word not in known]
        if new:
            self._keep_merged([word for word in new if not word.translate(None, LETTERS)])
            self._keep_lists([word for word in new if word not in known], self.tokenizer)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def encode(self, texts: list[str] | pa.Array, end: int) -> list[np.ndarray]:
        """The ids of each text with the end id behind them."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        column = column.cast(pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        runs, starts = _runs(data, offsets)
        found = runs.dictionary_encode()
        words = found.dictionary.to_numpy(zero_copy_only=False).tolist()  # many times faster than to_pylist
        ids, ends = self._gather(self._numbers(words)[found.indices.to_numpy()])
        cuts = ends[np.searchsorted(starts, offsets)]
        return [np.append(ids[a:b], np.uint32(end)).astype("<u4") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The runs of one kind of byte, lower-case unless odd, of texts that lie at ``offsets``, and where each begins."""
    kinds = KINDS[data]
    first = np.zeros(len(data), bool)
    first[offsets[offsets < len(data)]] = True
    odd = np.flatnonzero(kinds == ODD)
    if len(odd):
        blank = kinds == BLANK
        words = np.flatnonzero(first | np.concatenate([[False], blank[1:] != blank[:-1]]))
        marked = np.zeros(len(words), bool)
        marked[np.searchsorted(words, odd, "right") - 1] = True
        kinds[np.repeat(marked, np.diff(np.append(words, len(data))))] = ODD
    first[1:] |= kinds[1:] != kinds[:-1]
    starts = np.flatnonzero(first)
    data = np.where(kinds == LETTER, LOWER[data], data)
    buffers = [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), buffers), starts


class Packer:
    """Open windows of one task. A window is a list of (doc, start, ids, doc_tokens)."""

    def __init__(self, length: int, open_windows: int, first_id: int):
        self.length, self.most, self.next_id = length, open_windows, first_id
        self.windows: list[list[tuple]] = []
        self.filled: list[int] = []

    def close(self, k: int):
        """Rows of a window, which leaves the task."""
        offset = 0
        for doc, start, ids, total in self.windows[k]:
            crc = zlib.crc32(ids.tobytes())
            yield (doc, start, len(ids), crc, total, self.next_id, offset, None, None)
            offset += len(ids)
        self.next_id += 1
        del self.windows[k], self.filled[k]

    def put(self, k: int, piece: tuple):
        self.windows[k].append(piece)
        self.filled[k] += len(piece[2])
        if self.filled[k] == self.length:
            yield from self.close(k)

    def add(self, doc, start: int, ids: np.ndarray, total: int):
        while len(ids):
            size = min(len(ids), self.length)
            fits = [k for k, n in enumerate(self.filled) if n + size <= self.length]
            if fits:
                best = max(fits, key=self.filled.__getitem__)
            elif len(self.windows) < self.most:
                self.windows.append([])
                self.filled.append(0)
                best = len(self.windows) - 1
            else:
                best = max(range(len(self.filled)), key=self.filled.__getitem__)
                size = self.length - self.filled[best]
            yield from self.put(best, (doc, start, ids[:size], total))
            start, ids = start + size, ids[size:]

    def leftovers(self, task: int):
        for window in self.windows:
            for doc, start, ids, total in window:
                yield (doc, start, len(ids), None, total, None, None, task, ids.tobytes())

    def finish(self):
        """The open windows as sequences of a power of two each, without padding."""
        rest = [piece for window in self.windows for piece in window]
        size, self.windows, self.filled = sum(len(p[2]) for p in rest), [], []
        while size:
            power = 1 << (size.bit_length() - 1)
            take, window = min(power, self.length), []
            size -= take
            while take:
                doc, start, ids, total = rest.pop(0)
                window.append((doc, start, ids[:take], total))
                if len(ids) > take:
                    rest.insert(0, (doc, start + take, ids[take:], total))
                take -= len(window[-1][2])
            self.windows.append(window)
            self.filled.append(0)
            yield from self.close(0)


def _pack_task(path: str, end: int, length: int, open_windows: int):
    def run(batches):
        encoder = worker_kept(("word-encoder", path), lambda: WordEncoder(path))
        packer, task = None, 0
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            tasks, docs = (one_of(c, batch) for c in ("task", "doc_id"))
            if packer is None and tasks:
                task = tasks[0]
                packer = Packer(length, open_windows, task << 32)
            share = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64) // AT_ONCE
            cuts = np.unique([0, *(np.flatnonzero(np.diff(share)) + 1), len(texts)])
            for a, b in pairwise(cuts.tolist()):
                rows = (
                    row
                    for doc, ids in zip(docs[a:b], encoder.encode(texts.slice(a, b - a), end), strict=True)
                    for row in packer.add(doc, 0, ids, len(ids))
                )
                yield from rows_of(OPEN, rows)
                # Arrow would keep what the dictionary took, and so would the worker while other steps run.
                pa.default_memory_pool().release_unused()
        if packer is not None:
            yield from rows_of(OPEN, packer.leftovers(task), 64)

    return run


def _merge_group(length: int, level: int, last: bool):
    def run(group: pa.Table) -> pa.Table:
        rows = sorted(
            group.to_pylist(),
            key=lambda r: (r["task"], -len(r["ids"]), -1 if r["doc_id"] is None else r["doc_id"], r["start"], r["ids"]),
        )
        task = min(r["task"] for r in rows)
        # The highest bits tell levels apart, so a number is never given twice.
        packer, out = Packer(length, 1, (level << 56) + (task << 32)), []
        for r in rows:
            out += packer.add(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"])
        out += packer.finish() if last else packer.leftovers(task)
        return pa.Table.from_batches(rows_of(OPEN, out), OPEN)

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    length: int = 4096,
    open_windows: int = 16,
    fan_in: int = 32,
    doc: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    open_kind = f"{PIECE}, task long, ids binary"
    named = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    read = texts_of(named, "doc_id")
    read = read.withColumn("task", F.spark_partition_id().cast("long"))
    packed = read.mapInArrow(_pack_task(tokenizer_path, end_id, length, open_windows), open_kind)
    stored = materialize(packed, "packed")
    done, rest, level = [stored.filter(F.col("ids").isNull())], stored.filter(F.col("ids").isNotNull()), 1
    tasks = rest.agg(F.max("task")).first()[0]
    tasks = 0 if tasks is None else tasks + 1
    while tasks:
        last = tasks <= fan_in
        merged = (
            rest.withColumn("group", F.floor(F.col("task") / fan_in))
            .groupBy("group")
            .applyInArrow(_merge_group(length, level, last), open_kind)
            .withColumn("task", F.floor(F.col("task") / fan_in))
        )
        merged = materialize(merged, "packed-leftovers")
        done.append(merged.filter(F.col("ids").isNull()))
        rest, level = merged.filter(F.col("ids").isNotNull()), level + 1
        tasks = 0 if last else -(-tasks // fan_in)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(*[c.split()[0] for c in PIECE.split(", ")])
