"""Grouped prefix join of documents by the Jaccard similarity of their word shingles.

Linked documents share most of their shingles, so the rarest few of one must hold one of
the other's: with size n and similarity p %, at most m = n - ceil(p n / 100) shingles of a
document may be missing in its partner, so its rarest m + 1 shingles, the prefix, have one
in common with the partner's. The steps are:

1. A document becomes the set of its shingles' 64-bit hashes. Equal sets are one class.
2. How often each shingle occurs is counted over all documents. To count a part only, a
   level takes the shingles whose hash lies in the lowest quarter, half, or all of the
   range, and a prefix is taken from the lowest level that holds m + 1 shingles of the set,
   and all of the set's shingles from the levels below. Of two linked sets, one has its
   prefix in the lower of their levels and the other its prefix or all there; so no link is lost.
3. Classes of equal prefix and size are one group. Shingles that occur in one document only
   lead nowhere and are left out; the others list the groups that hold them, and equal
   lists are handled once.
4. The classes found in lists, few beside all, are joined by steps 2 and 3 once more, by
   all of their shingles.
5. Groups are expanded. Each class is first verified against the smallest class of its lists;
   links found join components, and only pairs of a list in different components that pass
   the size filter remain to be verified. So thousands of near copies cost a number of
   comparisons in proportion to their number, and no link between components is missed.

Sets are compared in full by their sorted hashes. Two of a million different shingles share
a hash with a chance of 3 in 10**8.

Defined cases: a null text counts as empty; a text without words has an empty set and no
links; one with fewer words than a shingle takes has its whole sequence as one shingle;
rows that repeat are one class; a null id is never a component's smallest unless it is alone;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import materialize, mix64, one_of, rows_of, shuffle_width, texts_of
from wardlight.llm.components import components
from wardlight.operators.spread import join_spread

#: Words remembered by a task; it starts over beyond that, so its memory is bounded.
REMEMBERED = 500_000
#: Documents of one packed row of the count exchange.
CHUNK_DOCS = 2000
LEVELS = tuple(np.uint64(x) for x in (1 << 62, 1 << 63, (1 << 64) - 1))
WHOLE = LEVELS[-1:]


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def shingles(text: str, n: int, known: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of a text's runs of ``n`` words."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(n, len(words))
    rolled = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        rolled = mix64(rolled + hashes[k : k + len(rolled)] + np.uint64(k + 1))
    return np.unique(rolled)


def missing_most(size: int, percent: int) -> int:
    """How many shingles of a set of this size its partner may lack."""
    return size - -(-percent * size // 100)


def counted_part(found: np.ndarray, percent: int, levels=LEVELS) -> np.ndarray:
    """The shingles of the lowest level that holds a prefix, or all of them."""
    need = missing_most(len(found), percent) + 1
    for top in levels:
        size = int(np.searchsorted(found, top, side="right"))
        if size >= need:
            return found[:size]
    return found


def prefix(part: np.ndarray, counts: np.ndarray, size: int, percent: int, levels=LEVELS) -> np.ndarray:
    """Of the counted part, the m + 1 rarest of its level and all of the levels below it."""
    need = missing_most(size, percent) + 1
    chosen: list[np.ndarray] = []
    for top in levels:
        n = int(np.searchsorted(part, top, side="right"))
        order = np.lexsort((part[:n], counts[:n]))
        chosen.append(order[:need])
        if n >= need or n == len(part):
            break
    return np.unique(np.concatenate(chosen)) if chosen else np.empty(0, np.int64)


def _sets_task(n: int, percent: int):
    """One row for each document: row, doc_id, size, digest of its set, counted part."""
    schema = pa.schema(
        [
            ("row", pa.int64()), ("chunk", pa.int64()), ("doc_id", pa.int64()), ("size", pa.int64()),
            ("digest", pa.binary()), ("part", pa.binary()),
        ]
    )

    def run(batches):
        import xxhash

        known = WordHashes()
        for batch in batches:

            def made(row, doc, text):
                found = shingles(text, n, known)
                digest = xxhash.xxh3_128_digest(found.tobytes())
                return row, row // CHUNK_DOCS, doc, len(found), digest, counted_part(found, percent).tobytes()

            rows = map(made, *(one_of(c, batch) for c in ("row", "doc_id", "text")))
            yield from rows_of(schema, rows, 1000)

    return run


def _pack_task(buckets: int):
    """The parts of a task's documents as rows (bucket, chunk, distinct hashes)."""
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary())])

    def run(batches):
        for batch in batches:
            chunks, parts = one_of("chunk", batch), one_of("part", batch)
            for chunk in sorted(set(chunks)):
                own = [np.frombuffer(p, np.uint64) for c, p in zip(chunks, parts, strict=True) if c == chunk]
                keys, times = np.unique(np.concatenate(own), return_counts=True)
                where = (mix64(keys) % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(where, kind="stable")
                cuts = np.searchsorted(where[order], np.arange(buckets + 1))
                keys, times = keys[order], np.minimum(times, 255).astype(np.uint8)[order]
                out = (
                    (b, chunk, keys[cuts[b] : cuts[b + 1]].tobytes() + times[cuts[b] : cuts[b + 1]].tobytes())
                    for b in range(buckets)
                    if cuts[b + 1] > cuts[b]
                )
                yield from rows_of(schema, out)

    return run


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(blob) // 9
    return np.frombuffer(blob, np.uint64, n), np.frombuffer(blob, np.uint8, n, 8 * n)


def _count_group(group: pa.Table) -> pa.Table:
    """Counts of a bucket's hashes over all chunks, sent back to each chunk: those of 1 are left out."""
    chunks = group["chunk"].to_pylist()
    packed = [unpack(blob) for blob in group["keys"].to_pylist()]
    keys = np.concatenate([k for k, _ in packed])
    times = np.concatenate([t for _, t in packed]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]])
    total = np.add.reduceat(times[order], first)
    back = np.empty(len(keys), np.int64)
    back[order] = np.repeat(total, np.diff(np.r_[first, len(keys)]))
    out, at = [], 0
    for own, _ in packed:
        counts = np.minimum(back[at : at + len(own)], 65_535).astype(np.uint16)
        often = counts > 1
        out.append(own[often].tobytes() + counts[often].tobytes())
        at += len(own)
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "counts": pa.array(out, pa.binary())})


def _prefix_groups(percent: int, levels):
    """Documents of a chunk with the shingles of their prefix that occur twice or more."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        import xxhash

        keys, counts = [np.empty(0, np.uint64)], [np.empty(0, np.uint16)]
        for blob in answers["counts"].to_pylist():
            n = len(blob) // 10
            keys.append(np.frombuffer(blob, np.uint64, n))
            counts.append(np.frombuffer(blob, np.uint16, n, 8 * n))
        known, times = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(known)
        known, times = known[order], times[order]
        out, places, same = [], [], []
        for size, blob in zip(docs["size"].to_pylist(), docs["part"].to_pylist(), strict=True):
            part = np.frombuffer(blob, np.uint64)
            own = np.ones(len(part), np.int64)
            if len(known) and len(part):
                at = np.minimum(np.searchsorted(known, part), len(known) - 1)
                own = np.where(known[at] == part, times[at], 1)
            taken = prefix(part, own, size, percent, levels)
            shared = own[taken] > 1
            # Places in the order by count are known where the whole set was counted.
            rank = np.zeros(len(taken), np.int32)
            if len(levels) == 1:
                rank[np.lexsort((part[taken], own[taken]))] = np.arange(len(taken), dtype=np.int32)
            out.append(part[taken][shared].tobytes())
            places.append(rank[shared].tobytes())
            same.append(xxhash.xxh3_128_digest(part[taken].tobytes() + size.to_bytes(8, "little")))
        return pa.table(
            {
                "row": docs["row"].cast(pa.int64()),
                "size": docs["size"].cast(pa.int64()),
                "prefix": pa.array(out, pa.binary()),
                "places": pa.array(places, pa.binary()),
                "same": pa.array(same, pa.binary()),
            }
        )

    return run


def _index_task(buckets: int):
    """Rows (bucket, shingles, groups, places) of a task's groups."""
    schema = pa.schema(
        [("bucket", pa.int32()), ("keys", pa.binary()), ("groups", pa.binary()), ("places", pa.binary())]
    )

    def run(batches):
        for batch in batches:
            parts = [np.frombuffer(p, np.uint64) for p in one_of("prefix", batch)]
            if not parts:
                continue
            keys = np.concatenate(parts)
            groups = np.repeat(np.array(one_of("group", batch), np.int64), [len(p) for p in parts])
            where = (mix64(keys) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(where, kind="stable")
            cuts = np.searchsorted(where[order], np.arange(buckets + 1))
            places = np.concatenate([np.frombuffer(p, np.int32) for p in one_of("places", batch)])
            columns = [keys[order], groups[order], places[order]]
            out = (
                (b, *[c[cuts[b] : cuts[b + 1]].tobytes() for c in columns])
                for b in range(buckets)
                if cuts[b + 1] > cuts[b]
            )
            yield from rows_of(schema, out)

    return run


def _lists_group(group: pa.Table) -> pa.Table:
    """The distinct lists of two groups or more that hold a shingle in common, each group with
    its first place of those that the list's shingles have in it."""
    import xxhash

    keys = np.concatenate([np.frombuffer(b, np.uint64) for b in group["keys"].to_pylist()])
    groups = np.concatenate([np.frombuffer(b, np.int64) for b in group["groups"].to_pylist()])
    places = np.concatenate([np.frombuffer(b, np.int32) for b in group["places"].to_pylist()])
    order = np.lexsort((groups, keys))
    keys, groups, places = keys[order], groups[order], places[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    ends = np.r_[first[1:], len(keys)]
    found: dict[bytes, list] = {}
    for a, b in zip(first[ends - first > 1], ends[ends - first > 1], strict=True):
        held = groups[a:b].tobytes()
        name = xxhash.xxh3_128_digest(held)
        if name in found:
            found[name][1] = np.minimum(found[name][1], places[a:b])
        else:
            found[name] = [held, places[a:b]]
    return pa.table(
        {
            "list": pa.array(list(found), pa.binary()),
            "groups": pa.array([held for held, _ in found.values()], pa.binary()),
            "places": pa.array([own.tobytes() for _, own in found.values()], pa.binary()),
        }
    )


def _members_task(batches):
    schema = pa.schema([("list", pa.binary()), ("group", pa.int64()), ("place", pa.int32())])
    for batch in batches:
        rows = (
            (name, group, place)
            for name, held, own in zip(*(one_of(c, batch) for c in ("list", "groups", "places")), strict=True)
            for group, place in zip(
                np.frombuffer(held, np.int64).tolist(), np.frombuffer(own, np.int32).tolist(), strict=True
            )
        )
        yield from rows_of(schema, rows, 20_000)


def _full_sets_task(n: int):
    schema = pa.schema(
        [("class", pa.int64()), ("chunk", pa.int64()), ("size", pa.int64()), ("shingles", pa.binary())]
    )

    def run(batches):
        known = WordHashes()
        for batch in batches:
            rows = (
                (row, row // CHUNK_DOCS, len(found), found.tobytes())
                for row, text in zip(one_of("class", batch), one_of("text", batch), strict=True)
                for found in [shingles(text, n, known)]
            )
            yield from rows_of(schema, rows, 500)

    return run


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _verify_groups(percent: int):
    """The pairs of one class ``a`` with others whose sets came along."""

    def run(centre: pa.Table, others: pa.Table) -> pa.Table:
        links_a, links_b = [], []
        if centre.num_rows and others.num_rows:
            own = np.frombuffer(centre["own"][0].as_py(), np.uint64)
            name = centre["centre"][0].as_py()
            for k in range(others.num_rows):
                if similar(own, np.frombuffer(others["shingles"][k].as_py(), np.uint64), percent):
                    links_a.append(name)
                    links_b.append(others["b"][k].as_py())
        return pa.table({"a": pa.array(links_a, pa.int64()), "b": pa.array(links_b, pa.int64())})

    return run


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar. The sets of the b travel to a; many b to one a are
    spread by a part of b's number."""
    width = 64
    other = sets.select(F.col("class").alias("b"), "shingles")
    salt = F.pmod(F.xxhash64("b"), F.lit(width))
    sent = pairs.join(other, "b").withColumn("salt", salt)
    centres = (
        pairs.select(F.col("a").alias("class"), salt.alias("salt"))
        .distinct()
        .join(sets, "class")
        .select(F.col("class").alias("centre"), F.col("salt").alias("part"), F.col("shingles").alias("own"))
    )
    return (
        centres.groupBy("centre", "part")
        .cogroup(sent.groupBy("a", "salt"))
        .applyInArrow(_verify_groups(percent), "a long, b long")
    )


def maybe_in(rows: DataFrame, wanted: DataFrame, key: str, most_bits: int = 1 << 26) -> DataFrame:
    """``rows`` without most of those whose key is not in ``wanted``, by a map of bits.

    Put before a join, so that a few wanted texts do not make all texts travel. The map has
    eight bits for each wanted key but 8 MB at most, in pieces of 4 KB: that is all that is
    broadcast, and beyond it more rows stay for the join to drop.
    """
    count = wanted.count()
    bits = min(max(1 << 15, 1 << (8 * count - 1).bit_length() if count else 0), most_bits)

    def bit(column):
        return F.pmod(F.xxhash64(column), F.lit(bits)) + 1

    pieces = wanted.groupBy(F.bitmap_bucket_number(bit(F.col(key))).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit(F.col(key)))).alias("bits")
    )
    place = F.bitmap_bit_position(bit(F.col(key)))
    byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    here = F.floor(byte / F.pow(F.lit(2), place % 8)) % 2 == 1
    marked = rows.withColumn("piece", F.bitmap_bucket_number(bit(F.col(key))))
    return marked.join(F.broadcast(pieces), "piece").filter(here).select(*rows.columns)


def _prefix_lists(
    state: DataFrame, heads: DataFrame, percent: int, levels, buckets: int
) -> DataFrame:
    """list, class, size, place for the rows ``heads`` of ``state``, over all of which shingles are
    counted. The choice of rows comes last, when their shingles need not travel for it."""
    answers = (
        state.select("chunk", "part")
        .mapInArrow(_pack_task(buckets), "bucket int, chunk long, keys binary")
        .groupBy("bucket")
        .applyInArrow(_count_group, "chunk long, counts binary")
    )
    prefixes = (
        state.filter("size > 0")
        .select("row", "chunk", "size", "part")
        .groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(_prefix_groups(percent, levels), "row long, size long, prefix binary, places binary, same binary")
        .filter(F.length("prefix") > 0)
    )
    chosen = prefixes.join(heads, "row", "left_semi")
    named = materialize(chosen.withColumnRenamed("row", "class"), "prefixes")
    return materialize(_list_members(named, buckets), "prefix-lists")


def _list_members(heads: DataFrame, buckets: int) -> DataFrame:
    """list, class, size: the classes that share a shingle of their prefixes, list by list.

    Classes of one group, of equal size and prefix, are a list of their own as well.
    """
    groups = materialize(
        heads.groupBy("same").agg(
            F.min("class").alias("group"),
            F.first("prefix").alias("prefix"),
            F.first("places").alias("places"),
            F.count(F.lit(1)).alias("held"),
        ),
        "groups",
    )
    expanded = heads.join(groups.select("same", "group", "held"), "same").select(
        "group", "class", "size", "held"
    )
    lists = (
        groups.select("group", "prefix", "places")
        .mapInArrow(_index_task(buckets), "bucket int, keys binary, groups binary, places binary")
        .groupBy("bucket")
        .applyInArrow(_lists_group, "list binary, groups binary, places binary")
        # One list may come from two buckets; each keeps its places, since both are true.
        .dropDuplicates(["list", "places"])
        .mapInArrow(_members_task, "list binary, group long, place int")
    )
    alone = expanded.filter("held > 1").select(
        F.to_binary(F.hex("group"), F.lit("hex")).alias("list"), "class", "size", F.lit(0).alias("place")
    )
    found = lists.join(expanded, "group").select("list", "class", "size", "place").unionByName(alone)
    return found.groupBy("list", "class", "size").agg(F.min("place").alias("place"))


def link(
    docs: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: its number ``row``, the key, n_shingles, component_id, the
    smallest key that links lead to, and ``head``, the number of one row of the component, which
    tells components apart where keys repeat or are null; rows without words have none."""
    buckets = shuffle_width(docs.sparkSession)
    named = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    read = texts_of(named, "doc_id", row="row")
    state = materialize(
        read.mapInArrow(
            _sets_task(n, percent),
            "row long, chunk long, doc_id long, size long, digest binary, part binary",
        ),
        "shingle-parts",
    )
    # One row for each distinct set, the first in the table; only these go on.
    held = materialize(
        state.groupBy("digest").agg(
            F.min("row").alias("class"), F.min("doc_id").alias("least"), F.max("size").alias("size"),
            F.count(F.lit(1)).alias("_rows"),
        ),
        "classes",
    )
    classes = held.filter("size > 0").select("digest", "class", "least")
    heads = classes.select(F.col("class").alias("row"))
    near = _prefix_lists(state, heads, percent, LEVELS, buckets)

    # The classes that stand in a list with another are all that is ever compared. They are
    # joined once more by their whole sets, where the rarest shingles are really known.
    wanted = materialize(near.select("class").distinct(), "compared")
    sets = materialize(
        maybe_in(read.select(F.col("row").alias("class"), "text"), wanted, "class")
        .join(wanted, "class", "left_semi")
        .mapInArrow(_full_sets_task(n), "class long, chunk long, size long, shingles binary"),
        "shingle-sets",
    )
    whole = sets.select(F.col("class").alias("row"), "chunk", "size", F.col("shingles").alias("part"))
    sets = sets.select("class", "shingles")
    members = _prefix_lists(whole, whole.select("row"), percent, WHOLE, buckets)
    # A list's first class is the one with the fewest rare shingles before it: the copy that
    # the others were made from, where there is one.
    # Two sets fit if their sizes do, and if enough shingles are left behind the first that
    # they share: of all their lists, the one with that shingle has its true places.
    both = F.col("size") + F.col("other_size")
    behind = F.least(F.col("size") - F.col("place"), F.col("other_size") - F.col("other_place"))
    fits = (100 * F.least("size", "other_size") >= percent * F.greatest("size", "other_size")) & (
        (100 + percent) * behind >= percent * both
    )
    first = members.groupBy("list").agg(F.min(F.struct("place", "class", "size")).alias("first"))
    pairs = materialize(
        members.join(first, "list")
        .select(
            F.col("class").alias("b"), "size", "place", F.col("first.class").alias("a"),
            F.col("first.size").alias("other_size"), F.col("first.place").alias("other_place"),
        )
        .filter((F.col("a") != F.col("b")) & fits)
        .groupBy("b")
        .agg(F.min(F.struct("other_place", "a"))["a"].alias("a")),
        "first-pairs",
    )
    links = materialize(_verify(pairs, sets, percent), "first-links")

    joined = members.join(components(links).withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class")
    )
    mixed = joined.groupBy("list").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    left = materialize(
        joined.join(mixed.filter("low <> high").select("list"), "list", "left_semi"), "open-lists"
    )
    other = left.select(
        "list", F.col("class").alias("a"), F.col("size").alias("other_size"),
        F.col("place").alias("other_place"), F.col("component").alias("other"),
    )
    rest = (
        left.withColumnRenamed("class", "b")
        .join(other, "list")
        .filter((F.col("a") < F.col("b")) & (F.col("component") != F.col("other")) & fits)
        .select("a", "b")
        .distinct()
        .join(pairs, ["a", "b"], "left_anti")
    )
    links = links.unionByName(_verify(materialize(rest, "rest-pairs"), sets, percent))
    found = components(links).withColumnsRenamed({"node": "class", "component": "head"})

    # Components are settled for distinct sets. Rows meet them once, by digest, and neither a set
    # that many rows share nor a component of many sets is gathered in one task.
    homes = materialize(
        classes.join(found, "class", "left").select("digest", "least", F.coalesce("head", "class").alias("head")),
        "class-heads",
    )
    least = homes.groupBy("head").agg(F.min("least").alias("component_id"))
    named = join_spread(homes, least, ["head"]).select("digest", "head", "component_id")
    rows = state.select("row", "doc_id", "size", "digest")
    return join_spread(rows, materialize(named, "class-components"), ["digest"], held.select("digest", "_rows")).select(
        "row",
        F.col("doc_id").alias(key),
        F.col("size").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        "head",
    )


def first_of_each(
    docs: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` without the rows that are linked to a row of a smaller key; of rows with the same
    key, to an earlier one. A null key comes after all others. Rows of one key that are not linked
    all stay, and so do rows without words, which are linked with nothing."""
    linked = link(docs, n, percent, key, text).filter("n_shingles > 0")
    order = F.struct(F.col(key).isNull().alias("unknown"), F.col(key).alias("key"), "row")
    first = linked.groupBy("head").agg(F.min(order)["row"].alias("first"))
    # The first rows are one per component and leave as they are: no join meets a large component.
    gone = materialize(
        linked.select("row").join(first.select(F.col("first").alias("row")), "row", "left_anti"), "linked-rows"
    )
    whole = docs.select(F.struct("*").alias("whole"), F.monotonically_increasing_id().alias("row"))
    return whole.join(gone, "row", "left_anti").select("whole.*")
