"""The trie of conversation prefixes, with the sums of every subtree.

Turns are numbered by a range exchange on (conversation, turn): a partition's rows are in
order already, and a table of one row per conversation and partition carries the numbers on,
so a conversation of any length is spread over many tasks. Texts go no further than that
exchange. A prefix is known by two 64-bit numbers, each the exclusive or of hashes of its
turns with their places; running ones are carried across partitions in the same way. Nodes
are the distinct prefixes, and ``tree_contraction`` sums over their subtrees.

Defined cases: rows without a conversation id take no part; a null role or text is empty; a
null turn comes first; turns with the same number follow in order of role and text; repeated
rows are turns of their own; an empty table gives no nodes; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlight.llm.common import materialize, one_of, rows_of, shuffle_width
from wardlight.llm.tree_contraction import subtree_sums
from wardlight.operators.spread import join_spread

KEY = ("depth", "ka", "kb")
PIECE_BYTES = 1 << 16


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """Stored: conv, piece (the partition it is in), at (order), pos from 0, ha, hb (hashes of
    role and text), bytes of the text."""
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    rows = (
        conversations.filter(F.col("conv_id").isNotNull())
        .select(
            F.col("conv_id").cast("long").alias("conv"),
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .repartitionByRange(shuffle_width(conversations.sparkSession), *order)
        .sortWithinPartitions(*order)
        .select(
            "conv",
            F.monotonically_increasing_id().alias("at"),
            F.xxhash64(F.lit("a"), "role", F.length("role"), "text").alias("ha"),
            F.xxhash64(F.lit("b"), "text", F.length("role"), "role").alias("hb"),
            F.octet_length("text").cast("long").alias("bytes"),
        )
    )
    rows = materialize(rows, "turns").withColumn("piece", F.shiftright("at", 33))
    earlier = W.partitionBy("conv").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    pieces = rows.groupBy("conv", "piece").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    pieces = pieces.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    return materialize(
        rows.join(pieces, ["conv", "piece"]).select(
            "conv", "piece", "at", (F.col("at") - F.col("first") + F.col("before")).alias("pos"), "ha", "hb", "bytes"
        ),
        "numbered-turns",
    )


def _hashes(place, ha, hb):
    return F.xxhash64(place.cast("long"), ha, hb), F.xxhash64(hb, place.cast("long"), ha)


def prefixes(turns: DataFrame, borrow: int = 9, share: int = 5) -> DataFrame:
    """Every prefix of every rebuilt conversation: conv, depth, ka, kb (the prefix), pa, pb (the
    one before), bytes (of its last text), is_end.

    Conversation c begins with the first h turns of conversation c - c % ``share``, with h the
    crc32 of c in decimal modulo ``borrow``, and goes on with its own turns after its first h.
    """
    donors = (
        turns.filter((F.col("conv") % share == 0) & (F.col("pos") < borrow - 1))
        .groupBy(F.col("conv").alias("donor"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "ha", "hb", "bytes"))).alias("head"))
    )
    pieces = turns.groupBy("conv", "piece").agg(F.count(F.lit(1)).alias("rows"))
    lent = (
        pieces.groupBy("conv")
        .agg(F.sum("rows").alias("own"))
        .withColumns(
            {"h": (F.crc32(F.col("conv").cast("string")) % borrow).cast("int"), "donor": F.col("conv") - F.col("conv") % share}
        )
        .join(donors, "donor", "left")
        .withColumn("head", F.coalesce(F.slice("head", 1, F.col("h")), F.array()))
        .withColumn("length", F.size("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    )
    keyed = F.transform(
        "head",
        lambda t: F.struct(
            t["pos"].alias("pos"), t["bytes"].alias("bytes"),
            *[h.alias(c) for h, c in zip(_hashes(t["pos"], t["ha"], t["hb"]), ("ga", "gb"), strict=True)],
        ),
    )

    def together(part: str, upto):
        return F.aggregate(F.slice("keyed", 1, upto), F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x[part]))

    lent = materialize(
        lent.withColumn("keyed", keyed).select(
            "conv", "h", "length", "keyed", F.size("keyed").alias("n_lent"),
            together("ga", F.size("keyed")).alias("la"), together("gb", F.size("keyed")).alias("lb"),
        ),
        "lent-turns",
    )

    # Own turns: running hashes inside a piece, and one row per piece to carry them on.
    places = pieces.select("conv", "piece").join(lent.select("conv", "h", "n_lent", "length"), "conv")
    running = W.partitionBy("conv", "piece").orderBy("at").rowsBetween(W.unboundedPreceding, W.currentRow)
    place = F.col("pos") - F.col("h") + F.col("n_lent")
    own = (
        turns.join(places, ["conv", "piece"])
        .filter(F.col("pos") >= F.col("h"))
        .withColumn("place", place)
        .withColumns(dict(zip(("ga", "gb"), _hashes(F.col("place"), F.col("ha"), F.col("hb")), strict=True)))
        .withColumns({r: F.bit_xor(g).over(running) for r, g in (("ra", "ga"), ("rb", "gb"))})
        .select("conv", "piece", "place", "bytes", "ga", "gb", "ra", "rb", (F.col("place") + 1 == F.col("length")).alias("is_end"))
    )
    own = materialize(own, "own-turns")
    earlier = W.partitionBy("conv").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        own.groupBy("conv", "piece")
        .agg(F.bit_xor("ga").alias("ta"), F.bit_xor("gb").alias("tb"))
        .withColumns({c: F.coalesce(F.bit_xor(t).over(earlier), F.lit(0)) for c, t in (("ca", "ta"), ("cb", "tb"))})
        .join(lent.select("conv", "la", "lb"), "conv")
        .select(
            "conv", "piece", F.col("ca").bitwiseXOR(F.col("la")).alias("ca"), F.col("cb").bitwiseXOR(F.col("lb")).alias("cb")
        )
    )
    ka, kb = F.col("ra").bitwiseXOR(F.col("ca")), F.col("rb").bitwiseXOR(F.col("cb"))
    own = own.join(carried, ["conv", "piece"]).select(
        "conv", (F.col("place") + 1).alias("depth"), ka.alias("ka"), kb.alias("kb"),
        ka.bitwiseXOR(F.col("ga")).alias("pa"), kb.bitwiseXOR(F.col("gb")).alias("pb"), "bytes", "is_end",
    )
    d = F.col("depth").cast("int")
    first = (
        lent.select("conv", "length", "keyed", F.explode(F.sequence(F.lit(0).cast("long"), F.size("keyed").cast("long"))).alias("depth"))
        .select(
            "conv", "depth", together("ga", d).alias("ka"), together("gb", d).alias("kb"),
            F.when(d > 0, together("ga", d - 1)).alias("pa"), F.when(d > 0, together("gb", d - 1)).alias("pb"),
            F.coalesce(F.get("keyed", d - 1)["bytes"], F.lit(0)).alias("bytes"),
            (F.col("depth") == F.col("length")).alias("is_end"),
        )
    )
    return first.unionByName(own)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one node, in decimal and joined, in pieces of a bounded size."""
    schema = pa.schema([("depth", pa.int64()), ("ka", pa.int64()), ("kb", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])

    def pieces():
        node, ids, size = None, [], 0
        for batch in batches:
            for depth, ka, kb, conv in zip(*(one_of(c, batch) for c in (*KEY, "conv")), strict=True):
                if ids and (node != (depth, ka, kb) or size > PIECE_BYTES):
                    yield (*node, ids[0], ",".join(map(str, ids)))
                    ids, size = [], 0
                node = (depth, ka, kb)
                ids.append(conv)
                size += 12
        if ids:
            yield (*node, ids[0], ",".join(map(str, ids)))

    yield from rows_of(schema, pieces(), 256)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("depth", pa.int64()), ("ka", pa.int64()), ("kb", pa.int64()), ("ends_sha256", pa.string())])

    def nodes():
        node, state = None, None
        for batch in batches:
            for depth, ka, kb, ids in zip(*(one_of(c, batch) for c in (*KEY, "ids")), strict=True):
                if node != (depth, ka, kb):
                    if node:
                        yield (*node, state.hexdigest())
                    node, state = (depth, ka, kb), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if node:
            yield (*node, state.hexdigest())

    yield from rows_of(schema, nodes())


def ends_hash(ends: DataFrame) -> DataFrame:
    """SHA-256 of each node's ids, ascending and joined by commas. Ids are packed where a range
    exchange has put them, so that the one task which must hash a hot node in order gets few
    rows and holds one of them at a time."""
    order = [*KEY, "conv"]
    packed = (
        ends.select(*order)
        .repartitionByRange(shuffle_width(ends.sparkSession), *order)
        .sortWithinPartitions(*order)
        .mapInArrow(_packed, "depth long, ka long, kb long, first long, ids string")
    )
    return (
        packed.repartition(*KEY)
        .sortWithinPartitions(*KEY, "first")
        .mapInArrow(_hashed, "depth long, ka long, kb long, ends_sha256 string")
    )


def trie(conversations: DataFrame, borrow: int = 9, share: int = 5) -> DataFrame:
    """One row for each node: conv_id (its smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256, and its key ka, kb."""
    rows = materialize(prefixes(numbered_turns(conversations), borrow, share), "prefixes")
    nodes = rows.groupBy(*KEY).agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.min("pa").alias("pa"), F.min("pb").alias("pb"), F.min("bytes").alias("bytes"),
    )
    nodes = materialize(
        nodes.select("*", F.monotonically_increasing_id().alias("id"), (F.col("depth") - 1).alias("above")), "nodes"
    )
    parent_key = ["above", "pa", "pb"]
    kids = materialize(nodes.filter("depth > 0").groupBy(*parent_key).agg(F.count(F.lit(1)).alias("_rows")), "kids")
    parents = nodes.select(
        F.col("depth").alias("above"), F.col("ka").alias("pa"), F.col("kb").alias("pb"),
        F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
    )
    linked = join_spread(nodes, parents, parent_key, counts=kids)
    n_children = kids.select(
        F.col("above").alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb"), F.col("_rows").alias("n_children")
    )
    linked = linked.drop("above", "pa", "pb").join(n_children, list(KEY), "left")
    linked = materialize(
        linked.withColumns(
            {
                "n_children": F.coalesce("n_children", F.lit(0)),
                "leaf": F.col("n_children").isNull().cast("long"),
                "saved": (F.col("n_convs") - 1) * F.col("bytes"),
            }
        ),
        "linked-nodes",
    )
    sums = subtree_sums(linked.select("id", "parent", "depth", "leaf", "saved"), ["leaf", "saved"])
    sums = sums.select("id", F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    return (
        linked.drop("leaf", "saved")
        .join(sums, "id")
        .join(ends_hash(rows.filter("is_end")), list(KEY), "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), "ka", "kb",
        )
    )
