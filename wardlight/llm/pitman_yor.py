"""A nested hierarchical Pitman-Yor language model of words and their letters.

A text is its lower-cased words and one end token. A word is a customer of the restaurant of
the word before it (an end token before the first word), whose base is one restaurant of all
words, whose base is a letter model. All words never seen are one class, as they are one entry
of the unigram base: its probability is what the letter model leaves to them. The letter
model is a hierarchy of restaurants: one for each context of up to four symbols before a
letter within the word, whose parent is the context without its farthest symbol, and so up
to a root over all symbols. At every level the tables of a restaurant are the customers of
its parent. Tables are seated by the Chinese restaurant process and sampled again, sweep after
sweep, by Gibbs: given its customers and what its parent predicts, each dish's tables are drawn
anew. A restaurant's part of a prediction is averaged over the sweeps after the first few.

Sweeps come in two rounds: within a round a bucket of words sweeps alone, and the tables of each
context, all tables and customers of words, and the letters (whose customers are the words'
sampled tables) are those of the round before, as they stand in other buckets. A pair that
occurs once has one table whatever is drawn, so only the others take part.

Work is split by words, not rows: each chunk of documents sends its distinct words, and then its
distinct pairs, with their counts to the buckets of the words (a pair's is its second word's, so
the pairs of a hot context are spread), and gets their parts back; a pair that makes up a third
of all tokens is one entry per chunk. All words and pairs are counted; what is gathered grows
with them. Words have exact numbers, below 2^32, not hashes. The letter contexts are made of
symbol classes (6, 6, 6 and 4 bits), so the letter model has at most 2^22 contexts whatever the
input and is drawn in one place.

Defined cases: a null or empty text is the end token alone; repeated rows are scored alike;
null ids count as held out or not by the text "" and stay null; without any training text
every symbol has its share of the root; other columns are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import materialize, mix64, one_of, rows_of, shuffle_width, texts_of

#: A chunk is closed beyond this many tokens; a longer text is a chunk of its own.
CHUNK_TOKENS = 2_000_000
#: Bits of the symbol class that each step back in a word adds to a context.
CONTEXT_BITS = (6, 6, 6, 4)
END_WORD, END_TEXT, BEGIN = 256, 257, 258
SYMBOLS = 258
END = b"\n"  # the end token; no word contains white space


class Letters:
    """Symbols and contexts of many words at once."""

    def __init__(self, words: list[bytes]):
        # The end of the text is a word of one symbol; others end with a symbol of their own.
        sizes = np.array([1 if w == END else len(w) + 1 for w in words], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        joined = np.frombuffer(b"".join(w if w == END else w + b"\n" for w in words), np.uint8).astype(np.int64)
        joined[self.starts[1:] - 1] = END_WORD
        joined[self.starts[:-1][np.array([w == END for w in words], bool)]] = END_TEXT
        self.symbols = joined
        place = np.arange(len(joined)) - np.repeat(self.starts[:-1], sizes)
        contexts, self.contexts = np.zeros(len(joined), np.int64), []
        for back, bits in enumerate(CONTEXT_BITS, 1):
            before = np.where(
                place >= back, joined[np.maximum(np.arange(len(joined)) - back, 0)], BEGIN
            )
            contexts = (contexts << bits) | (before & ((1 << bits) - 1))
            self.contexts.append(contexts)

    def keys(self, level: int) -> np.ndarray:
        """Context and symbol of each place as one number; level 0 has no context."""
        own = self.contexts[level - 1] if level else np.zeros(len(self.symbols), np.int64)
        return own * 512 + self.symbols


def draw_tables(customers, base, strength_part, discount, random) -> np.ndarray:
    """Tables for each dish: its customers come in one after another, and each opens a table
    with the probability that the process gives a new one. Beyond 64 customers they come in
    groups that grow by a fourth, of which a binomial number opens tables.

    ``base`` is what the parent predicts for the dish, ``strength_part`` is the strength plus
    discount times the restaurant's tables.
    """
    tables = np.minimum(customers, 1).astype(np.float64)
    seated, step = 1.0, 1.0
    most = float(customers.max()) if len(customers) else 0.0
    active = np.flatnonzero(customers > 1)
    new = strength_part * base
    while seated < most and len(active):
        own = np.minimum(customers[active] - seated, step)
        p = new[active] / (new[active] + np.maximum(seated - discount * tables[active], 1e-9))
        opened = random.random(len(active)) < p if step == 1 else random.binomial(own.astype(np.int64), p)
        tables[active] += opened
        seated += step
        step = 1.0 if seated < 64 else float(math.ceil(seated / 4))
        active = active[customers[active] > seated]
    return np.minimum(tables, customers)


class Level:
    """Restaurants of one context length: dishes sorted by context and symbol."""

    def __init__(self, keys: np.ndarray, customers: np.ndarray):
        self.keys, self.customers = keys, customers.astype(np.float64)
        contexts = keys >> 9
        first = np.flatnonzero(np.r_[True, contexts[1:] != contexts[:-1]]) if len(keys) else np.empty(0, np.int64)
        self.contexts = contexts[first]
        self.own = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(keys)]))
        self.tables = np.minimum(self.customers, 1)


class LetterModel:
    """Sampled seatings of the hierarchy; ``probability`` averages what they predict."""

    def __init__(self, keys, customers, sweeps=6, burn=3, discount=0.6, strength=1.0, seed=11):
        self.discount, self.strength = discount, strength
        order = np.argsort(keys)
        keys, customers = np.asarray(keys, np.int64)[order], np.asarray(customers, np.float64)[order]
        levels = [Level(keys, customers)]
        for bits in CONTEXT_BITS[::-1]:
            child = levels[0]
            up = ((child.keys >> 9 >> bits) << 9) | (child.keys & 511)
            parent, inverse = np.unique(up, return_inverse=True)
            levels.insert(0, Level(parent, np.bincount(inverse, child.tables, len(parent))))
            child.parent = inverse
        self.levels, random = levels, np.random.default_rng(seed)
        for level in levels:
            level.mean_dish = np.zeros(len(level.keys))
            level.mean_rest = np.zeros(len(level.contexts))
            level.mean_whole = np.zeros(len(level.keys))
        self.samples = 0
        for sweep in range(sweeps):
            self._predict()
            for depth in range(len(levels) - 1, -1, -1):
                level = levels[depth]
                base = levels[depth - 1].now[level.parent] if depth else np.full(len(level.keys), 1 / SYMBOLS)
                tables = np.bincount(level.own, level.tables, len(level.contexts))
                others = strength + discount * tables
                level.tables = draw_tables(level.customers, base, others[level.own], discount, random)
                if depth:
                    above = levels[depth - 1]
                    above.customers = np.bincount(level.parent, level.tables, len(above.keys))
            self._predict()
            if sweep >= burn:
                self.samples += 1
                for level in levels:
                    level.mean_dish += level.dish
                    level.mean_rest += level.rest
                    level.mean_whole += level.now
        for level in levels:
            for name in ("mean_dish", "mean_rest", "mean_whole"):
                setattr(level, name, getattr(level, name) / max(self.samples, 1))
            for name in ("customers", "tables", "own", "parent", "dish", "rest", "now"):
                level.__dict__.pop(name, None)

    def _predict(self) -> None:
        for depth, level in enumerate(self.levels):
            total = np.bincount(level.own, level.customers, len(level.contexts)) + self.strength
            tables = np.bincount(level.own, level.tables, len(level.contexts))
            level.rest = (self.strength + self.discount * tables) / total
            level.dish = np.maximum(level.customers - self.discount * level.tables, 0) / total[level.own]
            base = self.levels[depth - 1].now[level.parent] if depth else 1 / SYMBOLS
            level.now = level.dish + level.rest[level.own] * base

    def log_words(self, words: list[bytes]) -> np.ndarray:
        """Natural logarithm of the letter model's probability of each word."""
        if not words:
            return np.empty(0)
        letters = Letters(words)
        out = np.zeros(len(letters.symbols))
        self._fill(letters, out, np.arange(len(out)), len(self.levels) - 1)
        return np.add.reduceat(np.log(out), letters.starts[:-1])

    def _fill(self, letters: Letters, out: np.ndarray, places: np.ndarray, depth: int) -> None:
        """Probabilities at the places: a dish of the longest context has its own, others fall back."""
        if not len(places):
            return
        if depth < 0:
            out[places] = 1 / SYMBOLS
            return
        level, keys = self.levels[depth], letters.keys(depth)[places]
        if not len(level.keys):
            self._fill(letters, out, places, depth - 1)
            return
        at = np.minimum(np.searchsorted(level.keys, keys), len(level.keys) - 1)
        known = level.keys[at] == keys
        out[places[known]] = level.mean_whole[at[known]]
        missing = places[~known]
        self._fill(letters, out, missing, depth - 1)
        contexts = keys[~known] >> 9
        at = np.minimum(np.searchsorted(level.contexts, contexts), len(level.contexts) - 1)
        out[missing] *= np.where(level.contexts[at] == contexts, level.mean_rest[at], 1.0)


def join_words(words: list[bytes]) -> bytes:
    """A list of words as one packed string: a blank between, which no word contains."""
    import zstandard

    return zstandard.ZstdCompressor(3).compress(b" ".join(words)) if words else b""


def split_words(blob: bytes) -> list[bytes]:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(blob).split(b" ") if blob else []


def word_buckets(words: list[bytes], buckets: int) -> np.ndarray:
    import xxhash

    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return (mix64(hashes) % np.uint64(buckets)).astype(np.int64)


class WordNumbers(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


def squeeze(values: np.ndarray) -> bytes:
    """Numbers as packed bytes: bytes of equal weight together are shorter when packed."""
    import zstandard

    values = np.ascontiguousarray(values)
    return zstandard.ZstdCompressor(3).compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def expand(blob: bytes, kind) -> np.ndarray:
    import zstandard

    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return planes.reshape(kind.itemsize, -1).T.copy().view(kind)[:, 0]


def squeeze_rising(values: np.ndarray) -> bytes:
    return squeeze(np.diff(values, prepend=0).astype(np.uint32))


def expand_rising(blob: bytes) -> np.ndarray:
    return np.cumsum(expand(blob, np.uint32).astype(np.int64))


STATE = pa.schema(
    [
        ("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
        ("sizes", pa.list_(pa.int32())), ("words", pa.binary()), ("counts", pa.binary()), ("tokens", pa.binary()),
    ]
)
STATE_SQL = (
    "chunk long, doc_ids array<long>, held array<boolean>, sizes array<int>, words binary, "
    "counts binary, tokens binary"
)


def _chunk_task(by: int, remainder: int):
    """Chunks of documents: their words once, and each document as numbers of words."""
    def closed(first: int, held: list, numbers: WordNumbers):
        tokens = np.concatenate([t for _, _, t in held])
        train = np.concatenate([t for _, out, t in held if not out] or [np.empty(0, np.int32)])
        counts = np.bincount(train, minlength=len(numbers)).astype(np.int64)
        return (
            first, [d for d, _, _ in held], [o for _, o, _ in held], [len(t) for _, _, t in held],
            join_words(list(numbers)), squeeze(counts), squeeze(tokens.astype(np.uint32)),
        )

    def run(batches):
        held, size, first, numbers = [], 0, None, WordNumbers()
        for batch in batches:
            for row, doc, text in zip(*(one_of(c, batch) for c in ("row", "doc_id", "text")), strict=True):
                words = text.encode().lower().split()
                words.append(END)
                out = zlib.crc32(b"" if doc is None else str(doc).encode()) % by == remainder
                first = row if first is None else first
                held.append((doc, out, np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))))
                size += len(words)
                if size >= CHUNK_TOKENS:
                    yield from rows_of(STATE, [closed(first, held, numbers)])
                    held, size, first, numbers = [], 0, None, WordNumbers()
        if held:
            yield from rows_of(STATE, [closed(first, held, numbers)])

    return run


def _send_task(buckets: int):
    schema = pa.schema(
        [("bucket", pa.int32()), ("chunk", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())]
    )

    def run(batches):
        for batch in batches:
            for chunk, blob, counts in zip(*(one_of(c, batch) for c in ("chunk", "words", "counts")), strict=True):
                words, times = split_words(blob), expand(counts, np.int64)
                where = word_buckets(words, buckets)
                order = np.argsort(where, kind="stable")
                cuts = np.searchsorted(where[order], np.arange(buckets + 1))
                rows = (
                    (b, chunk, join_words([words[i] for i in own]), squeeze(times[own]))
                    for b in range(buckets)
                    for own in [order[cuts[b] : cuts[b + 1]]]
                    if len(own)
                )
                yield from rows_of(schema, rows, 20)

    return run


TYPES = "bucket int, words binary, counts binary, chunks array<long>, places array<binary>, n long, v long"


def _types_group(group: pa.Table) -> pa.Table:
    """The distinct words of a bucket, frequent ones first, and where each chunk's words stand there."""
    group, numbers, found = group.sort_by("chunk"), WordNumbers(), []
    for blob, counts in zip(group["words"].to_pylist(), group["counts"].to_pylist(), strict=True):
        at = np.fromiter(map(numbers.__getitem__, split_words(blob)), np.int32)
        found.append((at, expand(counts, np.int64)))
    total = np.zeros(len(numbers), np.int64)
    for at, counts in found:
        total[at] += counts
    order, words = np.argsort(-total, kind="stable"), list(numbers)
    places = np.argsort(order).astype(np.uint32)
    return pa.table(
        {
            "bucket": pa.array([group["bucket"][0].as_py()], pa.int32()),
            "words": pa.array([join_words([words[k] for k in order.tolist()])], pa.binary()),
            "counts": pa.array([squeeze(total[order])], pa.binary()),
            "chunks": pa.array([group["chunk"].to_pylist()], pa.list_(pa.int64())),
            "places": pa.array([[squeeze(places[at]) for at, _ in found]], pa.list_(pa.binary())),
            "n": pa.array([int(total.sum())], pa.int64()),
            "v": pa.array([int((total > 0).sum())], pa.int64()),
        }
    )


def _ids_task(batches):
    """To each chunk, the places of its words in a bucket."""
    schema = pa.schema([("chunk", pa.int64()), ("from_bucket", pa.int32()), ("places", pa.binary())])
    for batch in batches:
        for bucket, chunks, places in zip(*(one_of(c, batch) for c in ("bucket", "chunks", "places")), strict=True):
            yield from rows_of(schema, ((c, bucket, p) for c, p in zip(chunks, places, strict=True)), 20)


class ChunkPairs:
    """The distinct pairs of neighbours in a chunk, by the bucket and place of the second word
    and then the number of the first. What stands before a text's first word is an end token.
    """

    def __init__(self, words: list[bytes], tokens: np.ndarray, places: dict[int, np.ndarray], buckets: int):
        where, own = word_buckets(words, buckets), np.zeros(len(words), np.int64)
        for b, p in places.items():
            own[where == b] = p
        self.bucket, self.place, self.number = where, own, own * buckets + where
        by_place, by_number = np.lexsort((own, where)), np.argsort(self.number)
        second, first = np.argsort(by_place), np.argsort(by_number)
        before = np.concatenate([tokens[-1:], tokens[:-1]])  # each text ends with an end token
        keys, self.pair = np.unique(second[tokens] * len(words) + first[before], return_inverse=True)
        self.second, self.first = by_place[keys // len(words)], by_number[keys % len(words)]
        #: The pairs of bucket b are those from cuts[b] to cuts[b + 1].
        self.cuts = np.searchsorted(where[self.second], np.arange(buckets + 1))


def _pairs_sent(buckets: int):
    """Each chunk's pairs to the bucket of their second word, with their counts in training texts."""

    def run(state: pa.Table, ids: pa.Table) -> pa.Table:
        places = {b: expand(p, np.uint32) for b, p in zip(ids["from_bucket"].to_pylist(), ids["places"].to_pylist())}
        out = {c: [] for c in ("bucket", "chunk", "places", "firsts", "times")}
        for k in range(state.num_rows):
            tokens = expand(state["tokens"][k].as_py(), np.uint32).astype(np.int64)
            pairs = ChunkPairs(split_words(state["words"][k].as_py()), tokens, places, buckets)
            train = np.repeat(~np.array(state["held"][k].as_py(), bool), state["sizes"][k].as_py())
            times = np.bincount(pairs.pair[train], minlength=len(pairs.second))
            for b in np.flatnonzero(np.diff(pairs.cuts)).tolist():
                own = slice(pairs.cuts[b], pairs.cuts[b + 1])
                out["bucket"].append(b)
                out["chunk"].append(state["chunk"][k].as_py())
                out["places"].append(squeeze_rising(pairs.place[pairs.second[own]]))
                out["firsts"].append(squeeze(pairs.number[pairs.first[own]].astype(np.uint32)))
                out["times"].append(squeeze(times[own].astype(np.uint32)))
        kinds = {"bucket": pa.int32(), "chunk": pa.int64()}
        return pa.table({c: pa.array(x, kinds.get(c, pa.binary())) for c, x in out.items()})

    return run


PAIRS = (
    "bucket int, words binary, counts binary, chunks array<long>, places array<binary>, at array<binary>, "
    "firsts binary, times binary, kinds binary, many_seconds binary, many_firsts binary, many_times binary, "
    "pairs long, once long, twice long, kinds_once long, kinds_twice long"
)


def _pairs_group(sent: pa.Table, types: pa.Table) -> pa.Table:
    """The distinct pairs of a bucket with their counts, where each chunk's pairs stand there, of
    how many kinds each word's first words are, and once more the pairs that occur more than once."""
    sent = sent.sort_by("chunk")
    keys = [
        (expand_rising(p) << 32) | expand(f, np.uint32).astype(np.int64)
        for p, f in zip(sent["places"].to_pylist(), sent["firsts"].to_pylist(), strict=True)
    ]
    whole = np.unique(np.concatenate(keys))
    at, times = [np.searchsorted(whole, k) for k in keys], np.zeros(len(whole), np.int64)
    for own, t in zip(at, sent["times"].to_pylist(), strict=True):
        times[own] += expand(t, np.uint32)
    seconds, firsts = whole >> 32, whole & 0xFFFFFFFF
    n_words = len(split_words(types["words"][0].as_py()))
    kinds, many = np.bincount(seconds[times > 0], minlength=n_words), times > 1
    longs = {
        "pairs": (times > 0).sum(), "once": (times == 1).sum(), "twice": (times == 2).sum(),
        "kinds_once": (kinds == 1).sum(), "kinds_twice": (kinds == 2).sum(),
    }
    blobs = {
        "firsts": squeeze(firsts.astype(np.uint32)), "times": squeeze(times), "kinds": squeeze(kinds),
        "many_seconds": squeeze_rising(seconds[many]), "many_firsts": squeeze(firsts[many].astype(np.uint32)),
        "many_times": squeeze(times[many]),
    }
    return pa.table(
        {c: types[c] for c in ("bucket", "words", "counts", "chunks", "places")}
        | {"at": pa.array([[squeeze_rising(a) for a in at]], pa.list_(pa.binary()))}
        | {c: pa.array([x], pa.binary()) for c, x in blobs.items()}
        | {c: pa.array([int(x)], pa.int64()) for c, x in longs.items()}
    )


#: What buckets send each other; a negative source is a bucket's word to itself.
SENT = pa.schema(
    [("bucket", pa.int32()), ("source", pa.int32())]
    + [(c, pa.binary()) for c in ("a", "b", "c", "d", "words")]
    + [(c, pa.float64()) for c in ("customers", "tables", "known")]
)
SENT_SQL = (
    "bucket int, source int, a binary, b binary, c binary, d binary, words binary, customers double, "
    "tables double, known double"
)
SEATED, OPENED = -1, -2


def sent(*rows: tuple) -> pa.Table:
    full = [(*r, *[None] * (len(SENT) - len(r))) for r in rows]
    return pa.Table.from_batches(rows_of(SENT, full), SENT)


def by_home(firsts: np.ndarray, buckets: int):
    """Sorted word numbers as (bucket, where they stand in the array, their places in the bucket)."""
    homes = firsts % buckets
    order = np.argsort(homes, kind="stable")
    cuts = np.searchsorted(homes[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        own = order[cuts[b] : cuts[b + 1]]
        yield b, own, firsts[own] // buckets


def _kinds_task(buckets: int):
    """To the bucket of each first word: how many kinds of words follow it here, and whether its
    tables are asked for here, since one of its pairs occurs more than once."""

    def run(batches):
        for batch in batches:
            for bucket, firsts, times in zip(*(one_of(c, batch) for c in ("bucket", "firsts", "times")), strict=True):
                firsts, times = expand(firsts, np.uint32).astype(np.int64), expand(times, np.int64)
                known, at = np.unique(firsts[times > 0], return_inverse=True)
                kinds, asked = np.bincount(at), np.bincount(at, times[times > 0] > 1) > 0
                rows = (
                    (b, bucket, squeeze_rising(p), squeeze(kinds[own].astype(np.uint32)), squeeze_rising(p[asked[own]]))
                    for b, own, p in by_home(known, buckets)
                )
                for row in rows:
                    yield from sent(row).to_batches()

    return run


CONTEXTS = "bucket int, kinds binary, sources array<int>, asked array<binary>"


def _contexts_group(group: pa.Table) -> pa.Table:
    """How many kinds of words follow each word of a bucket, and who asks for its tables."""
    group = group.sort_by("source")
    places = [expand_rising(a) for a in group["a"].to_pylist()]
    kinds = np.zeros(max(int(p[-1]) for p in places) + 1)
    for p, k in zip(places, group["b"].to_pylist(), strict=True):
        kinds[p] += expand(k, np.uint32)
    return pa.table(
        {
            "bucket": pa.array([group["bucket"][0].as_py()], pa.int32()),
            "kinds": pa.array([squeeze(kinds)], pa.binary()),
            "sources": pa.array([group["source"].to_pylist()], pa.list_(pa.int32())),
            "asked": pa.array([group["c"].to_pylist()], pa.list_(pa.binary())),
        }
    )


def _tables_told(last: bool):
    """The tables of each context: one for each kind of word that follows, and those opened beyond
    that. Told to all who asked, or at last to the bucket of the context alone."""

    def run(contexts: pa.Table, opened: pa.Table) -> pa.Table:
        if not contexts.num_rows:
            return sent()
        bucket, tables = contexts["bucket"][0].as_py(), expand(contexts["kinds"][0].as_py(), np.float64)
        opened = opened.sort_by("source")
        for p, more in zip(opened["a"].to_pylist(), opened["b"].to_pylist(), strict=True):
            tables[expand_rising(p)] += expand(more, np.float64)
        if last:
            return sent((bucket, OPENED, squeeze(tables)))
        asked = zip(contexts["sources"][0].as_py(), contexts["asked"][0].as_py(), strict=True)
        return sent(*[(source, bucket, squeeze(tables[expand_rising(p)])) for source, p in asked])

    return run


def _letters_task(batches):
    """Customers of the longest letter contexts: a word's tables, each of which drew it from the letters."""
    schema = pa.schema([("key", pa.int64()), ("customers", pa.int64())])
    for batch in batches:
        for blob, tables in zip(one_of("words", batch), one_of("b", batch), strict=True):
            tables = expand(tables, np.float64).astype(np.int64)
            words = [w for w, t in zip(split_words(blob), tables.tolist(), strict=True) if t]
            if not words:
                continue
            letters = Letters(words)
            keys, at = np.unique(letters.keys(len(CONTEXT_BITS)), return_inverse=True)
            times = np.bincount(at, np.repeat(tables[tables > 0], np.diff(letters.starts)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(times.astype(np.int64), pa.int64())], schema=schema
            )


def _first_seats(batches):
    """Before any sweep each word of the training texts has one table."""
    for batch in batches:
        for bucket, words, counts, kinds in zip(
            *(one_of(c, batch) for c in ("bucket", "words", "counts", "kinds")), strict=True
        ):
            tables = (expand(counts, np.int64) > 0).astype(np.float64)
            customers = expand(kinds, np.int64).astype(np.float64)
            yield from sent((bucket, SEATED, squeeze(customers), squeeze(tables), None, None, words)).to_batches()


def _seat_groups(model, buckets: int, totals: tuple, discounts: tuple, strength: float, sweeps: int, first: int, mean: bool):
    """Sweeps over a bucket's words: the tables of each of its pairs are drawn anew, given what the
    restaurant of all words predicts and the other tables of the context; they are the word's customers
    there, whose tables are drawn in turn, given the letters. Row SEATED: customers and tables of the last
    sweep with the words, or means over the sweeps with the tables of the pairs and the letters' probability
    of each word (``mean``); other rows tell the tables opened in each context beyond the first of each kind."""
    all_customers, all_tables = totals
    pair_discount, discount = discounts

    def run(pairs: pa.Table, told: pa.Table) -> pa.Table:
        bucket, words = pairs["bucket"][0].as_py(), pairs["words"][0].as_py()
        kinds = expand(pairs["kinds"][0].as_py(), np.int64)
        seconds, firsts = expand_rising(pairs["many_seconds"][0].as_py()), pairs["many_firsts"][0].as_py()
        firsts, times = expand(firsts, np.uint32).astype(np.int64), expand(pairs["many_times"][0].as_py(), np.int64)
        known, context = np.unique(firsts, return_inverse=True)
        told = {s: (a, b) for s, a, b in zip(*(told[c].to_pylist() for c in ("source", "a", "b")), strict=True)}
        customers, tables = (expand(x, np.float64) for x in told[SEATED])
        context_tables = np.zeros(len(known))
        for b, own, _ in by_home(known, buckets):
            context_tables[own] = expand(told[b][0], np.float64)
        base = np.exp(model.value.log_words(split_words(words)))
        sums = [np.zeros(len(kinds)), np.zeros(len(kinds)), np.zeros(len(times))]
        for sweep in range(first, first + sweeps):
            random = np.random.default_rng((bucket, sweep))
            rest = (strength + discount * all_tables) / (strength + all_customers)
            p = np.maximum(customers - discount * tables, 0) / (strength + all_customers) + rest * base
            part = strength + pair_discount * context_tables
            seats = draw_tables(times, p[seconds], part[context], pair_discount, random)
            customers = kinds + np.bincount(seconds, seats - 1, len(kinds))
            new = np.full(len(kinds), strength + discount * all_tables)
            tables = draw_tables(customers, base, new, discount, random)
            sums = [x + now if mean else now for x, now in zip(sums, (customers, tables, seats), strict=True)]
        customers, tables, seats = (x / (sweeps if mean else 1) for x in sums)
        more = np.bincount(context, seats - 1, len(known))
        opened = np.flatnonzero(more)
        return sent(
            (
                bucket, SEATED, squeeze(customers), squeeze(tables), squeeze(seats) if mean else None,
                squeeze(base.astype(np.float32)) if mean else None, None if mean else words,
                float(customers.sum()), float(tables.sum()), float(base[kinds > 0].sum()),
            ),
            *[(b, bucket, squeeze_rising(p), squeeze(more[opened[own]])) for b, own, p in by_home(known[opened], buckets)],
        )

    return run


def _answer_groups(totals: tuple, unseen: float, discounts: tuple, strength: float):
    """To each chunk, for its words in a bucket: their places, counts, probabilities without a context and
    tables as a context; for its pairs there, what their own tables give them, times all customers."""
    all_customers, all_tables = totals
    pair_discount, discount = discounts

    def run(pairs: pa.Table, told: pa.Table) -> pa.Table:
        out = {c: [] for c in ("chunk", "from_bucket", "places", "counts", "p", "tables", "dishes")}
        row = {c: pairs[c][0].as_py() for c in pairs.column_names}
        counts, times = expand(row["counts"], np.int64), expand(row["times"], np.int64)
        told = {r["source"]: r for r in told.to_pylist()}
        customers, tables, seats = (expand(told[SEATED][c], np.float64) for c in ("a", "b", "c"))
        base = expand(told[SEATED]["d"], np.float32).astype(np.float64)
        opened = np.zeros(len(counts))
        if OPENED in told:
            own = expand(told[OPENED]["a"], np.float64)
            opened[: len(own)] = own
        rest = (strength + discount * all_tables) / (strength + all_customers)
        p = np.maximum(customers - discount * tables, 0) / (strength + all_customers) + rest * base
        p = np.where(counts > 0, p, rest * unseen)
        dishes = times - pair_discount * (times > 0)
        dishes[times > 1] = times[times > 1] - pair_discount * seats
        for chunk, places, at in zip(row["chunks"], row["places"], row["at"], strict=True):
            own = expand(places, np.uint32)
            out["chunk"].append(chunk)
            out["from_bucket"].append(row["bucket"])
            out["places"].append(places)
            out["counts"].append(squeeze(counts[own]))
            out["p"].append(squeeze(p[own].astype(np.float32)))
            out["tables"].append(squeeze(opened[own]))
            out["dishes"].append(squeeze(dishes[expand_rising(at)].astype(np.float32)))
        kinds = {"chunk": pa.int64(), "from_bucket": pa.int32()}
        return pa.table({c: pa.array(x, kinds.get(c, pa.binary())) for c, x in out.items()})

    return run


SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
    "score double"
)


def _score_groups(buckets: int, n: int, v: int, discount: float, strength: float):
    def run(state: pa.Table, answers: pa.Table) -> pa.Table:
        out = {c.split()[0]: [] for c in SCORED.split(", ")}
        found = {r["from_bucket"]: r for r in answers.to_pylist()}
        for k in range(state.num_rows):
            words = split_words(state["words"][k].as_py())
            tokens = expand(state["tokens"][k].as_py(), np.uint32).astype(np.int64)
            places = {b: expand(r["places"], np.uint32) for b, r in found.items()}
            pairs = ChunkPairs(words, tokens, places, buckets)
            counts, p, tables = np.zeros(len(words), np.int64), np.zeros(len(words)), np.zeros(len(words))
            dishes = np.zeros(len(pairs.second))
            for b, r in found.items():
                own = pairs.bucket == b
                counts[own], p[own] = expand(r["counts"], np.int64), expand(r["p"], np.float32)
                tables[own] = expand(r["tables"], np.float64)
                dishes[pairs.cuts[b] : pairs.cuts[b + 1]] = expand(r["dishes"], np.float32)
            rest = (strength + discount * tables) / (strength + counts)
            logs = np.log10(dishes / (strength + counts[pairs.first]) + rest[pairs.first] * p[pairs.second])
            base = np.log10((counts + 1) / (n + v + 1))
            sizes = state["sizes"][k].as_py()
            starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
            out["doc_id"] += state["doc_ids"][k].as_py()
            out["held_out"] += state["held"][k].as_py()
            out["n_tokens"] += sizes
            out["n_known"] += np.add.reduceat((counts > 0)[tokens].astype(np.int64), starts).tolist()
            out["train_tokens"] += [n] * len(sizes)
            out["base_score"] += np.add.reduceat(base[tokens], starts).tolist()
            out["score"] += np.add.reduceat(logs[pairs.pair], starts).tolist()
        kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
        return pa.table({c: pa.array(out[c], kinds[t]) for c, t in (x.split() for x in SCORED.split(", "))})

    return run


def usual_discount(once: int, twice: int, otherwise: float) -> float:
    """The usual estimate of a discount, from how many kinds occur once and twice."""
    return min(max(once / (once + 2 * twice), 0.1), 0.95) if once else otherwise


def score(
    docs: DataFrame, by: int, remainder: int, discount: float = 0.6, strength: float = 1.0, sweeps: int = 6,
    burn: int = 3, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per row: key, held_out (crc32 of the key as text modulo ``by`` is ``remainder``), n_tokens,
    n_known, train_tokens, base_score (unigrams, one added) and score, both log10 of the text."""
    spark, buckets = docs.sparkSession, shuffle_width(docs.sparkSession)
    named = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    read = texts_of(named, "doc_id", row="row")
    state = materialize(read.mapInArrow(_chunk_task(by, remainder), STATE_SQL), "word-chunks")
    types = materialize(
        state.select("chunk", "words", "counts")
        .mapInArrow(_send_task(buckets), "bucket int, chunk long, words binary, counts binary")
        .groupBy("bucket")
        .applyInArrow(_types_group, TYPES),
        "word-types",
    )
    n, v = (x or 0 for x in types.agg(F.sum("n"), F.sum("v")).first())
    ids = types.select("bucket", "chunks", "places").mapInArrow(
        _ids_task, "chunk long, from_bucket int, places binary"
    )
    neighbours = (
        state.select("chunk", "held", "sizes", "words", "tokens")
        .groupBy("chunk")
        .cogroup(ids.groupBy("chunk"))
        .applyInArrow(_pairs_sent(buckets), "bucket int, chunk long, places binary, firsts binary, times binary")
    )
    pairs = materialize(
        neighbours.groupBy("bucket").cogroup(types.groupBy("bucket")).applyInArrow(_pairs_group, PAIRS), "word-pairs"
    )
    sums = pairs.agg(*[F.sum(c) for c in ("pairs", "once", "twice", "kinds_once", "kinds_twice")]).first()
    n_pairs, once, twice, kinds_once, kinds_twice = (x or 0 for x in sums)
    discounts = (usual_discount(once, twice, discount), usual_discount(kinds_once, kinds_twice, discount))
    contexts = materialize(
        pairs.select("bucket", "firsts", "times")
        .mapInArrow(_kinds_task(buckets), SENT_SQL)
        .groupBy("bucket")
        .applyInArrow(_contexts_group, CONTEXTS),
        "word-contexts",
    )
    to_seat = pairs.select("bucket", "words", "kinds", "many_seconds", "many_firsts", "many_times")
    seated = materialize(
        pairs.select("bucket", "words", "counts", "kinds").mapInArrow(_first_seats, SENT_SQL), "word-seats"
    )
    totals = (float(n_pairs), float(v))
    # Contexts, the totals and the letters meet the words' new tables between the rounds.
    for first, times, mean in ((0, burn, False), (burn, sweeps - burn, True)):
        own = seated.filter(F.col("source") == SEATED)
        table = (
            own.mapInArrow(_letters_task, "key long, customers long")
            .groupBy("key")
            .agg(F.sum("customers").alias("customers"))
            .toPandas()
        )
        letters = LetterModel(
            table["key"].to_numpy(), table["customers"].to_numpy(), sweeps, burn, discount, strength
        )
        model = spark.sparkContext.broadcast(letters)
        told = (
            contexts.groupBy("bucket")
            .cogroup(seated.filter(F.col("source") != SEATED).groupBy("bucket"))
            .applyInArrow(_tables_told(False), SENT_SQL)
        )
        told = told.unionByName(own.withColumn("words", F.lit(None).cast("binary")))
        seats = _seat_groups(model, buckets, totals, discounts, strength, times, first, mean)
        seated = materialize(
            to_seat.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(seats, SENT_SQL), "word-seats"
        )
        sums = seated.agg(F.sum("customers"), F.sum("tables"), F.sum("known")).first()
        totals = (sums[0] or 0.0, sums[1] or 0.0)
    told = (
        contexts.groupBy("bucket")
        .cogroup(seated.filter(F.col("source") != SEATED).groupBy("bucket"))
        .applyInArrow(_tables_told(True), SENT_SQL)
        .unionByName(seated.filter(F.col("source") == SEATED).withColumn("words", F.lit(None).cast("binary")))
    )
    answers = (
        pairs.select("bucket", "counts", "chunks", "places", "at", "times")
        .groupBy("bucket")
        .cogroup(told.groupBy("bucket"))
        .applyInArrow(
            _answer_groups(totals, max(1.0 - (sums[2] or 0.0), 1e-9), discounts, strength),
            "chunk long, from_bucket int, places binary, counts binary, p binary, tables binary, dishes binary",
        )
    )
    scored = (
        state.drop("counts")
        .groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(_score_groups(buckets, n, v, discounts[0], strength), SCORED)
    )
    return scored.withColumnRenamed("doc_id", key)
