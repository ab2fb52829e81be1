"""Phrases and near phrases of benchmark items in documents, against brute force."""

import random
import re

import pytest

from wardlight.llm import phrase_index

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def prose(rng, n):
    return " ".join(rng.choice(["the", "a", "of", "Érst", "thon,", "4", "ined.", "Was", "x-y", "文字", "ñe"]) for _ in range(n))


@pytest.fixture(scope="module")
def items():
    rng = random.Random(2)
    return [(k, prose(rng, n)) for k, n in enumerate([14, 30, 10, 9, 2, 12])] + [
        (10, ""), (11, None), (None, "no id of thon was érst"), (12, "¿!"), (3, prose(rng, 11)), (13, "unknownword of the"),
    ]


@pytest.fixture(scope="module")
def docs(items):
    rng = random.Random(3)
    text = dict(enumerate(t for _, t in items))
    out = [(0, None), (1, ""), (2, " .. "), (3, "the"), (None, text[0])]
    out += [(10 + k, f"{prose(rng, 20)} {text[k].upper() if k == 1 else text[k]} {prose(rng, 30)}") for k in range(6)]
    out += [(20, " ".join(text[k] for k in (0, 1, 0))), (20, text[1]), (21, text[8]), (22, text[10] + "\n" + text[10])]
    shaken = words(text[1])
    shaken[4], shaken[6] = shaken[6], shaken[4]
    out += [(30, prose(rng, 8) + " " + " ".join(shaken)), (31, " ".join(shaken[:12])), (32, " ".join(shaken[3:])), (33, "was")]
    out += [(40, prose(rng, 3000) + " " + text[0] + " " + prose(rng, 500))]
    return out


SCHEMA = "doc_id long, text string, row long, id string, item string, start long, parts string"


def sought(items, size):
    for name, text in items:
        w = words(text)
        for at in range(max(len(w) - size + 1, 1) if w else 0):
            yield name, at, w[at : at + size]


def brute(docs, items, size, slop=0):
    """(row, item, offset, start, exact) of every window."""
    found = set()
    for row, (_, text) in enumerate(docs):
        w = words(text)
        for name, at, window in sought(items, size):
            for s in range(len(w)):
                if w[s : s + len(window)] == window:
                    found.add((row, name, at, s, True))
                elif slop and all(x in w[max(s + j - slop, 0) : s + j + slop + 1] for j, x in enumerate(window)):
                    found.add((row, name, at, s, False))
    return found


@pytest.mark.parametrize("slop", [0, 2])
def test_matches(spark, docs, items, monkeypatch, slop):
    """Small segments, overlapping parts and several blocks change nothing."""
    for name, size in (("SEGMENT_WORDS", 300), ("PART_WORDS", 128), ("BLOCK_BYTES", 300)):
        monkeypatch.setattr(phrase_index, name, size)
    frame = spark.createDataFrame([(i, t, k, "i", "n", 1, "p") for k, (i, t) in enumerate(docs)], SCHEMA).coalesce(1)
    index = phrase_index.build(frame)
    assert index.count() > 8
    benchmark = spark.createDataFrame([(k, t, 5) for k, t in items], "item_id long, text string, row long")
    rows = phrase_index.search(index, benchmark, window=10, slop=slop).collect()
    got = set()
    for r in rows:
        size = min(10, r["length"])
        name = None if r["item"] is None else int(r["item"])
        got |= {(r["row"], name, r["offset"] + k, r["start"] + k, r["exact"]) for k in range(r["length"] - size + 1)}
    assert got == brute(docs, items, 10, slop)


def test_contamination(spark, docs, items):
    frame = spark.createDataFrame([(i, t, k, "i", "n", 1, "p") for k, (i, t) in enumerate(docs)], SCHEMA)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    index = phrase_index.build(frame)
    found = phrase_index.contamination(index, phrase_index.search(index, benchmark)).collect()
    expected = []
    for row, (name, text) in enumerate(docs):
        hits, listed = set(), set()
        for _, item, at, s, _ in (m for m in brute(docs, items, 10) if m[0] == row):
            size = len(next(w for i, a, w in sought(items, 10) if (i, a) == (item, at) and w == words(text)[s : s + len(w)]))
            hits |= set(range(s, s + size))
            listed |= {str(item)} - {"None"}
        expected.append((None if name is None else str(name), len(words(text)), len(hits), sorted(listed), bool(hits)))
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_nothing(spark, docs, items):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    index = phrase_index.build(frame)
    clean = phrase_index.contamination(index, phrase_index.search(index, none))
    assert clean.count() == len(docs) and not clean.filter("contaminated").count()
    empty = phrase_index.build(frame.limit(0))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert phrase_index.contamination(empty, phrase_index.search(empty, benchmark)).count() == 0
    with pytest.raises(ValueError, match="reach"):
        phrase_index.search(index, benchmark, window=60, slop=10)
