"""The text operators against brute force, on rows chosen to be awkward."""

import hashlib
import itertools
import os
import random
import subprocess
import sys
import types as types_module
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wardlight.llm import (
    boosted_trees,
    byte_bpe,
    jaccard_join,
    packing,
    pitman_yor,
    quality_rules,
    suffix_dedup,
    unit_dedup,
    url_filter,
    vantage,
)
from wardlight.llm.components import components

WORDS = "the of and thon erst ined was, Blend to. in a ou ré ñez | *** 12".split()
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row long, key string, score double, "
    "label int, chunk long, size long, digest string"
)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + ("\n" if rng.random() < 0.05 else "") for _ in range(n))


BASE = [prose(s, n) for s, n in ((1, 40), (2, 300), (3, 9), (4, 120), (5, 2))]
NEAR = BASE[1].split(" ")
NEAR[150] = "changed"
TEXTS = [
    *enumerate(BASE),
    (10, BASE[1]), (11, " ".join(NEAR)), (12, None), (13, ""), (14, " \n\t "), (15, "one"),
    (16, prose(9, 60) + BASE[3][:400] + prose(10, 60)), (17, "a" * 5000), (18, "b " * 3000),
    (19, prose(12, 9000)), (None, "null id " * 30), (20, BASE[0]), (20, BASE[0]), (21, "one"),
    (22, "Same line here with eight words in it.\n" * 6), (23, "é́ İ ǅ ﬁ 文字 \x0b x\x1cy"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 1, 7, "k", 0.5, 1, 3, 4, "d") for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def text_of(doc, at):
    return [t or "" for i, t in TEXTS if i == doc][at]


def same_rows(rows, expected):
    assert sorted(map(repr, rows)) == sorted(map(repr, expected))


# Quality rules


def brute_quality(text):
    words = [w for w in regex.split(r"[\x20\x09-\x0D]+", text or "") if w]
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = set()
    for i in range(len(words) - 7):
        if seen[tuple(words[i : i + 8])] > 1:
            inside |= set(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)), len(inside),
    )


def test_quality_counts(docs):
    found = quality_rules.apply_rules(docs).select(
        "doc_id", *[f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    )
    same_rows([tuple(r) for r in found.collect()], [(i, *brute_quality(t)) for i, t in TEXTS])


def brute_verdict(text):
    """base_failed and the rules broken, by division of plain counts."""
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat = brute_quality(text)
    words = [w for w in regex.split(r"[\x20\x09-\x0D]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    stop = sum(w in quality_rules.STOP_WORDS for w in words)
    broken = [
        ("mean_word", not 1.5 <= (word_chars / n_words if words else 0) <= 20),
        ("symbols", (n_symbols / word_chars if words else 0) > 0.3),
        ("stop_words", (stop + 1) / (n_words + 1) < 0.02),
        ("dup_lines", (n_dup_lines / len(lines) if lines else 0) > 0.5),
    ]
    return n_words < 20 or 100 * n_repeat > 30 * n_words, [name for name, is_broken in broken if is_broken]


def test_quality_verdicts(spark, docs):
    plain = "word and more of it all then again some words that one would write down in a line of text now"
    more = [
        (9001, plain), (9002, "x " * 25), (9003, " ".join("abcdefghijklmnopqrstuvwxyz" + str(i) for i in range(25))),
        (9004, " ".join(f"#$*{i}" for i in range(30))), (9005, (plain + "\n") * 3), (9006, " ".join(f"zq{i}" for i in range(60))),
    ]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    found = quality_rules.apply_rules(both).select("doc_id", "quality.base_failed", "quality.failed", "quality.kept")
    want = [(i, *brute_verdict(t)) for i, t in [*TEXTS, *more]]
    same_rows([tuple(r) for r in found.collect()], [(i, b, f, not b and not f) for i, b, f in want])
    assert {name for _, _, f in want for name in f} == {r.name for r in quality_rules.RULES}
    assert any(not b and not f for _, b, f in want)


def test_quality_is_one_projection(docs, none, plan):
    judged = quality_rules.apply_rules(docs)
    text = plan(judged)
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text
    assert judged.columns == [*docs.columns, "quality"]
    assert quality_rules.apply_rules(none).count() == 0


def test_passing_keeps_what_the_rules_keep(docs):
    kept = quality_rules.passing(docs, min_words=1, max_repeat_percent=90)
    judged = quality_rules.apply_rules(docs, min_words=1, max_repeat_percent=90).filter("quality.kept")
    assert kept.columns == docs.columns
    same_rows([r["doc_id"] for r in kept.collect()], [r["doc_id"] for r in judged.collect()])


def test_rules_plan_stays_small_under_a_filter(docs):
    """Window hashes are made once, whatever the caller asks of the result."""
    judged = quality_rules.apply_rules(docs).filter("quality.kept AND quality.n_repeat_words < 9")
    optimised = judged._jdf.queryExecution().optimizedPlan().toString()
    assert optimised.count("xxhash64") <= 8


# Byte-level BPE


@pytest.mark.parametrize("chunk,overlap", [(32768, 1024), (64, 16), (7, 5)])
def test_bpe_equals_the_library(docs, none, chunk, overlap):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={}
    )
    few = docs.filter("doc_id is null or doc_id <> 19") if chunk < 100 else docs
    texts = [(i, t or "") for i, t in TEXTS if chunk >= 100 or i != 19]
    rows = byte_bpe.encode(few, path, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap, finish="digest").collect()
    expected = []
    for i, t in texts:
        ids = library.encode_ordinary(t)
        expected.append(
            (i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
        )
    same_rows([tuple(r) for r in rows], expected)
    assert byte_bpe.encode(none, path, public_tokenizers.PATTERN).count() == 0


def test_bpe_of_runs_over_several_chunks(spark):
    """Runs without a boundary, longer than the default chunk and its overlap."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={}
    )
    texts = ["word " * 20_000 + "7" * 70_000 + " end", " " * 40_000 + "x", "ab c " * 6_550 + "é" * 36_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = byte_bpe.encode(frame, path, public_tokenizers.PATTERN).collect()
    assert {r["doc_id"]: list(r["ids"]) for r in rows} == {i: library.encode_ordinary(t) for i, t in enumerate(texts)}


def test_bpe_round_trip(docs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = byte_bpe.encode(docs, path, public_tokenizers.PATTERN)
    back = coded.mapInArrow(byte_bpe.decode_ids("ids", path), "doc_id long, n_tokens long, ids array<int>, bytes binary")
    same_rows([(r["doc_id"], bytes(r["bytes"]).decode()) for r in back.collect()], [(i, t or "") for i, t in TEXTS])


def test_stitching_random_texts():
    pieces, rng = regex.compile(public_tokenizers.PATTERN), random.Random(1)
    for _ in range(800):
        text = "".join(rng.choices("ab '1\n.sé", k=rng.randint(0, 300)))
        for chunk, overlap in ((64, 16), (50, 8), (7, 5)):
            cut = list(byte_bpe.cut(text, chunk, overlap))
            ends = byte_bpe.stitch(
                pieces, text, [s for s, _ in cut], [byte_bpe.piece_ends(pieces, p) for _, p in cut], [len(p) for _, p in cut]
            )
            assert ends == byte_bpe.piece_ends(pieces, text)


# Packing


@pytest.mark.parametrize("length,fan_in", [(4096, 32), (64, 2)])
def test_packing_places_every_id_once(docs, none, length, fan_in):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    rows = packing.pack(docs.repartition(5, "doc_id"), path, 2, length=length, open_windows=3, fan_in=fan_in).toPandas()
    ids = [(i, np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")) for i, t in TEXTS]
    pieces = Counter()
    for r in rows.itertuples():
        doc = None if r.doc_id != r.doc_id else int(r.doc_id)
        own = next(x for i, x in ids if i == doc)
        assert r.doc_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
        pieces[doc] += r.length
    assert pieces == Counter({i: sum(len(x) for j, x in ids if j == i) for i, _ in ids})
    for _, window in rows.groupby("sequence_id"):
        window = window.sort_values("offset")
        assert window["offset"].tolist() == [0, *window["length"].cumsum().tolist()[:-1]]
        size = window["length"].sum()
        assert size <= length and size & (size - 1) == 0  # nothing is padded
    assert packing.pack(none, path, 2).count() == 0


def test_word_encoder_on_odd_words():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), packing.WordEncoder(path)
    library.encode_special_tokens = True
    for text in [
        "Don't STOP", "ÀÉ.", "a,b.c", ".,", "x..", "<|endoftext|> a", "ΣΑΣ. ΟΣ", "İstanbul.", "éa.", "12.", "ſs.", "ŉ.",
        "ǅ,", "'s'T", "it's.", "\x1c a\x1d", "K.", "Å,", "", "  \n",
    ]:
        assert own.encode([text], 2)[0].tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]


def test_new_words_are_learned_together():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), packing.WordEncoder(path)
    library.encode_special_tokens = True
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeéñ" if k % 9 == 0 else "abcdefgh", k=6)) for k in range(3000)]
    words = [w.title() if k % 4 == 0 else w + "., "[k % 3].strip() for k, w in enumerate(words)]
    calls = Counter()
    sys.setprofile(lambda frame, event, arg: calls.update([frame.f_code.co_name] if event == "call" else []))
    try:
        found = own.encode(["", " ".join(words)], 2)
    finally:
        sys.setprofile(None)
    assert [f.tolist() for f in found] == [[2], [*library.encode(" ".join(words), add_special_tokens=False).ids, 2]]
    # A call a word notes it as unknown; all else is done for many words at once.
    assert calls.total() < 1.2 * len(words), calls
    assert [f.tolist() for f in packing.WordEncoder(path).encode(["", " \n"], 2)] == [[2], [2]]


def test_forms_of_a_word_share_its_letters():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), packing.WordEncoder(path)
    library.encode_special_tokens = True
    rng = random.Random(6)
    letters = ["".join(rng.choices("abcdeéñ", k=6)) for _ in range(200)]
    forms = [form(w) + tail for w in letters for form in (str, str.title, str.upper) for tail in ("", ".", ",", "|", "!!", "7")]
    rng.shuffle(forms)
    texts = [" ".join(forms[k : k + 900]) for k in range(0, len(forms), 900)]
    texts += ["x\tY\r\nz", "aK. \u0301a A\u0301.b", "×É ÷.Ÿ étĘ", "don't. DON'T", "É", "É.b", ""]
    calls = Counter()
    sys.setprofile(lambda frame, event, arg: calls.update([frame.f_code.co_name] if event == "call" else []))
    try:
        found = own.encode(texts, 2)
    finally:
        sys.setprofile(None)
    assert [f.tolist() for f in found] == [[*library.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    # Remembered are runs of letters, not each of their eighteen forms, and no call is made for a word.
    assert len(own.known) < len(letters) + 50, len(own.known)
    assert calls.total() < len(letters), calls


def test_packing_is_the_same_for_any_share_of_texts(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    batch = pa.RecordBatch.from_arrays(
        [pa.array([5] * len(TEXTS)), pa.array([i for i, _ in TEXTS]), pa.array([t or "" for _, t in TEXTS])],
        names=["task", "doc_id", "text"],
    )
    pieces = []
    for most in (1, 700, 1 << 22):
        monkeypatch.setattr(packing, "AT_ONCE", most)
        found = packing._pack_task(path, 2, 64, 3)(iter([batch.slice(0, 0), batch]))
        pieces.append([row for out in found for row in out.to_pylist()])
    assert pieces[0] == pieces[1] == pieces[2] and sum(p["length"] for p in pieces[0]) > len(TEXTS)


def test_texts_are_encoded_from_a_slice_of_a_column():
    own = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["", "One two.", "É don't 7", "", "three", "\n"]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(["before", *texts, "after"], kind).slice(1, len(texts))
        for a in range(len(texts)):
            found, known = own.encode(column.slice(a), 2), own.encode(texts[a:], 2)
            assert [f.tolist() for f in found] == [f.tolist() for f in known]


KEPT_BY_PACKING = """
import random, re
import pyarrow as pa
import public_tokenizers
from wardlight.llm import packing

def mb():
    with open("/proc/self/smaps_rollup") as f:
        return sum(map(int, re.findall(r"Pss_Anon: +([0-9]+)", f.read()))) / 1024

rng = random.Random(7)
words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(100_000)]
texts = [" ".join(rng.choices(words, k=1000)) + "." for _ in range(1500)]
batch = pa.record_batch({"task": [0] * len(texts), "doc_id": range(len(texts)), "text": texts})
path = public_tokenizers.path("word_bpe_49k.json")
rows = sum(b.num_rows for b in packing._pack_task(path, 2, 4096, 16)(iter([batch])))
before = mb()
pa.default_memory_pool().release_unused()
print(rows, before - mb())
"""


def test_a_worker_keeps_no_memory_of_packed_texts():
    """Workers go on to other steps, and what they keep adds to the memory of those."""
    run = [sys.executable, "-c", KEPT_BY_PACKING]
    done = subprocess.run(run, capture_output=True, text=True, check=True, env=os.environ | {"PYTHONPATH": os.pathsep.join(sys.path)})
    rows, kept = done.stdout.split()
    assert int(rows) >= 1500 and float(kept) < 8, done.stdout


# Url filter

RULES = [url_filter.Rule("allow", "org/"), url_filter.Rule("block", "example.org/en/1")]


def test_urls(spark):
    urls = [
        (1, "https://A.Example.ORG/en/12?x=/y#z"), (2, "http://notexample.org/en/1"), (3, "ftp://org"), (4, None),
        (5, "no scheme"), (6, "://"), (7, "http://casinowin.net/a"), (8, "x://y://z/p"), (9, "http://h?://q"),
        (1, "https://A.Example.ORG/en/12?x=/y#z"), (None, "http://Äorg.net/É"), (11, "http://" + "a" * 3000 + "/b"),
    ]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumn("host", F.lit("clash"))
    counts = spark.createDataFrame([("win", 50), ("the", 500)], "word string, n long")
    rows = {(r["page_id"], r["host"]): r for r in url_filter.judge(pages, RULES, counts).collect()}
    first = rows[1, "a.example.org"]
    assert (first["path"], first["rule"], first["verdict"]) == ("/en/12", "example.org/en/1", "block")
    assert rows[2, "notexample.org"]["rule"] == "org/" and rows[3, "org"]["rule"] is None
    assert rows[4, ""]["path"] == rows[5, ""]["path"] == rows[6, ""]["path"] == ""
    assert rows[7, "casinowin.net"]["words"][:2] == ["casino", "win"] and rows[7, "casinowin.net"]["verdict"] == "block"
    assert rows[8, "y:"]["path"] == "//z/p" and rows[9, "h"]["path"] == "" and rows[None, "Äorg.net"]["path"] == "/É"
    assert url_filter.judge(pages, RULES, counts).count() == len(urls)
    assert url_filter.judge(pages.limit(0), RULES, counts).count() == 0


def test_each_token_has_its_own_weight(spark):
    letters = lambda k: "".join(chr(97 + k // 26**p % 26) for p in range(4))
    paths = ["/".join(letters(400 * page + k) for k in range(400)) for page in range(220)]
    urls = [(k, f"http://{'poker' if k % 5 == 0 else 'tree'}.net/{p}/{letters(k % 7)}") for k, p in enumerate(paths)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    counts = spark.createDataFrame([("tree", 500), ("net", 500)], "word string, n long")
    rows = {r["page_id"]: r for r in url_filter.judge(pages, [], counts).collect()}
    tokens = {k: [*("h " + w for w in r["words"]), *("p " + w for w in url_filter.tokens_of(r["path"]))] for k, r in rows.items()}
    seen = {True: Counter(), False: Counter()}
    for k, own in tokens.items():
        bad = not {t[2:] for t in own}.isdisjoint(url_filter.SEEDS)
        seen[bad].update(own)
        seen[bad]["urls"] += 1
    vocabulary = {t for own in tokens.values() for t in own}
    assert len(vocabulary) > 80_000
    share = lambda t, bad: (seen[bad][t] + 0.01) / (seen[bad].total() - seen[bad]["urls"] + 0.01 * len(vocabulary))
    for k, own in tokens.items():
        odds = sum(np.log(share(t, True) / share(t, False)) for t in own)
        assert rows[k]["score"] == pytest.approx(np.log((seen[True]["urls"] + 1) / (seen[False]["urls"] + 1)) + odds)


def test_the_model_learns_what_rules_say(spark):
    rules = [url_filter.Rule("block", "example.org/dark/"), url_filter.Rule("allow", "example.org/light/")]
    urls = [(k, f"http://n{chr(97 + k % 26)}{chr(97 + k // 26)}.example.org/{'dark' if k % 3 == 0 else 'light'}/{k}") for k in range(300)]
    urls += [(1000, "http://naa.example.org/Dark"), (1001, "http://naa.example.org/Light")]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    counts = spark.createDataFrame([("example", 500), ("org", 500)], "word string, n long")
    judged = url_filter.judge(pages, rules, counts)
    rows = {r["page_id"]: r for r in judged.collect()}
    assert [rows[k]["verdict"] for k in (1000, 1001)] == ["block", "allow"]
    out = {k for k, r in rows.items() if k < 1000 and zlib.crc32(r["host"].encode()) % url_filter.HELD_OUT == 0}
    assert out == {k for k, r in rows.items() if r["held_out"]} and len(out) > 20
    error = {r["verdict"]: (r["n_held_out"], r["n_wrong"]) for r in url_filter.rule_error(judged).collect()}
    assert error == {"block": (sum(k % 3 == 0 for k in out), 0), "allow": (sum(k % 3 > 0 for k in out), 0)}
    assert url_filter.rule_error(judged.limit(0)).count() == 0


def test_long_runs_of_letters_are_words_too(spark):
    long = "abcdefghijklmnopqrstuvwxyzabcdefghij"
    texts = spark.createDataFrame([(f"{long} <b>x</b> {long}",)], "html string")
    counts = url_filter.word_counts(texts, "html")
    assert {tuple(r) for r in counts.collect()} == {(long, 2), ("x", 1)}
    hosts = spark.createDataFrame([(f"x{long}.net",)], "host string")
    assert url_filter.segment_hosts(hosts, counts).first()["words"][:2] == ["x", long]


def test_viterbi_is_the_cheapest_split():
    costs = {"ca": 3.0, "sino": 3.0, "casino": 4.0, "win": 2.0, "inow": 1.0, "cas": 2.0}
    unknown = lambda n: 5.0 + 3 * n
    cost = lambda words: sum(costs.get(w, unknown(len(w))) for w in words)
    for run in ("casinowin", "winca", "xcasino", "c"):
        cuts = (c for k in range(len(run)) for c in itertools.combinations(range(1, len(run)), k))
        every = [[run[a:b] for a, b in zip((0, *c), (*c, len(run)), strict=True)] for c in cuts]
        assert cost(url_filter.split_word(run, costs, unknown)) == pytest.approx(min(map(cost, every)))


# Vantage-point trees


@pytest.mark.parametrize("metric", vantage.METRICS)
def test_nearest_equal_brute_force(spark, metric):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist(), i % 3) for i in range(400)]
    rows += [(i, rows[7][1], 0) for i in range(400, 520)]
    odd = [(900, None, 0), (901, [0.0] * 8, 0), (902, [float("nan")] * 8, 0), (903, [1.0] * 3, 0), (904, [None] * 8, 0), (905, [], 0)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, score int")
    found = vantage.search(
        frame, frame.filter("vec_id % 20 = 0"), k=7, metric=metric, shard_rows=100, block_rows=9, leaf=8
    ).collect()
    ids, matrix = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    for query in ids[ids % 20 == 0].tolist():
        own = sorted((r for r in found if r["query_id"] == query), key=lambda r: r["rank"])
        scores = vantage.exact_scores(metric, matrix[ids == query][0], matrix)
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != query][:7]
        assert [r["vec_id"] for r in own] == ids[order].tolist()
        assert [r["score"] for r in own] == scores[order].tolist()
        assert [r["rank"] for r in own] == list(range(1, 8))


def test_few_or_no_vectors(spark):
    frame = spark.createDataFrame([(20, [1.0, 2.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in vantage.search(frame, frame.filter("vec_id = 20")).collect()] == [(20, 1, 1, 1.5)]
    assert vantage.search(frame.limit(0), frame).count() == 0


def test_a_larger_factor_prunes_more():
    rng = np.random.default_rng(3)
    points, queries = rng.normal(size=(3000, 6)), rng.normal(size=(40, 6))
    exact, loose = vantage.Tree(points, 16), vantage.Tree(points, 16)
    a, b = exact.search(queries, 10, 1.0), loose.search(queries, 10, 2.0)
    truth = [set(np.argsort(((points - q) ** 2).sum(axis=1))[:10]) for q in queries]
    assert all(t <= set(x.tolist()) for t, x in zip(truth, a, strict=True))
    assert np.mean([len(t & set(x.tolist())) / 10 for t, x in zip(truth, b, strict=True)]) >= 0.8
    assert loose.seen < exact.seen < 40 * 3000


# Repeated substrings


def test_suffix_array_by_linear_grouping():
    rng = random.Random(3)
    for _ in range(1500):
        text = [rng.randint(1, rng.choice([1, 2, 3, 10])) for _ in range(rng.randint(0, 50))] + [0]
        assert suffix_dedup.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("length", [200, 40])
def test_repeated_bytes(docs, none, length):
    texts = [(i, (t or "").encode()) for i, t in TEXTS]
    seen = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    expected = []
    for i, t in texts:
        covered = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                covered[k : k + length] = True
        a, b = suffix_dedup.spans_of(covered)
        expected.append((i, len(t), a, b, np.frombuffer(t, np.uint8)[~covered].tobytes()))
    found = suffix_dedup.remove_repeats(docs, length)
    same_rows([(*r[:4], bytes(r[4])) for r in map(tuple, found.collect())], expected)
    assert suffix_dedup.remove_repeats(none, length).count() == 0


# Quality classifier


def test_trees_learn_and_flatten():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 3))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    trees = boosted_trees.fit(x[:3000], y[:3000], trees=40)
    assert ((trees.probability(x[3000:]) > 0.5) == (y[3000:] == 1)).mean() > 0.95
    one = boosted_trees.fit(x, np.ones(len(x)))
    assert len(one.features) == 0 and np.allclose(one.probability(x), 4001 / 4002)
    assert len(trees.probability(x[:0])) == 0


def test_classifier_scores_all_rows(spark, docs, none, tiny):
    labels = spark.read.parquet(f"{tiny}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    trees = boosted_trees.train(spark.read.parquet(f"{tiny}/documents.parquet"), labels)
    rows = boosted_trees.score(docs, trees, "doc_id", "label").collect()
    assert len(rows) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert boosted_trees.score(none, trees, "doc_id").count() == 0
    untrained = boosted_trees.train(spark.read.parquet(f"{tiny}/documents.parquet"), labels.limit(0))
    assert {r["score"] for r in boosted_trees.score(docs, untrained, "doc_id").collect()} == {0.5}


def test_held_out_accuracy(spark):
    from wardlight.llm.queries import op6_quality_classifier

    found = op6_quality_classifier(spark, "/root/testdata/sf0.01").filter("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = found.join(labels, "doc_id").select("quality", "predicted").collect()
    assert np.mean([r[0] == r[1] for r in rows]) >= 0.9


# Language model


def test_language_model_counts(docs, none):
    tokens = [(i, [*(t or "").encode().lower().split(), b"\n"]) for i, t in TEXTS]
    out = {i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, _ in tokens}
    counts = Counter(w for i, words in tokens if not out[i] for w in words)
    n, v = sum(counts.values()), len(counts)
    expected = sorted(
        (str(i), out[i], len(w), sum(counts[x] > 0 for x in w), n, round(sum(np.log10((counts[x] + 1) / (n + v + 1)) for x in w), 6))
        for i, w in tokens
    )
    rows = pitman_yor.score(docs, 7, 2).collect()
    found = sorted((str(r[0]), *r[1:5], round(r["base_score"], 6)) for r in rows)
    assert found == expected
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert pitman_yor.score(none, 7, 2).count() == 0


def test_order_of_words_changes_a_score(spark):
    rng = random.Random(3)
    follow = {w: rng.sample(range(60), 3) for w in range(60)}

    def walk(n):
        at, out = 0, []
        for _ in range(n):
            at = rng.choice(follow[at])
            out.append(f"w{at}")
        return out

    held = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows, pairs = [(i, " ".join(walk(40))) for i in range(2000) if i not in set(held)], []
    for a, b in zip(held[::2], held[1::2], strict=False):
        text = walk(40)
        rows += [(a, " ".join(text)), (b, " ".join(rng.sample(text, 40)))]
        pairs.append((a, b))
    found = pitman_yor.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "doc_id"), 7, 2)
    found = {r["doc_id"]: r for r in found.collect()}
    for a, b in pairs:
        assert found[a]["base_score"] == pytest.approx(found[b]["base_score"])
        assert found[a]["score"] > found[b]["score"] + 10
    # Three equally likely words follow each: their logarithm, and little more.
    per_token = np.mean([found[a]["score"] for a, _ in pairs]) / 40
    assert np.log10(1 / 3) - 0.1 < per_token < np.log10(1 / 3)


def test_pairs_of_a_chunk():
    texts = [b"a b a c", b"b a b", b"", b"c a b x"]
    numbers, tokens, buckets = pitman_yor.WordNumbers(), [], 3
    for t in texts:
        tokens.append([numbers[w] for w in [*t.split(), b"\n"]])
    words, flat = list(numbers), np.array(sum(tokens, []))
    where = pitman_yor.word_buckets(words, buckets)
    places = {b: np.arange((where == b).sum()) for b in range(buckets)}
    pairs = pitman_yor.ChunkPairs(words, flat, places, buckets)
    found = [(words[u], words[w]) for u, w in zip(pairs.first, pairs.second, strict=True)]
    told = [found[k] for k in pairs.pair]
    assert told == [p for t in texts for p in zip([b"\n", *t.split()], [*t.split(), b"\n"], strict=True)]
    assert len(set(found)) == len(found)
    order = [(where[w], pairs.place[w], pairs.number[u]) for u, w in zip(pairs.first, pairs.second, strict=True)]
    assert order == sorted(order)
    assert (np.diff(pairs.cuts) == np.bincount(where[pairs.second], minlength=buckets)).all()


def test_probabilities_after_a_word_sum_to_one():
    rng, m = random.Random(8), pitman_yor
    texts = [" ".join(rng.choices("abcdefghij", k=12)) for _ in range(30)]
    batches = [pa.RecordBatch.from_pydict({"row": range(30), "doc_id": range(30), "text": texts})]

    def table(found):
        return pa.Table.from_batches(list(found))

    state = table(m._chunk_task(7, 2)(batches))
    types = m._types_group(table(m._send_task(1)(state.to_batches())))
    pairs = m._pairs_group(m._pairs_sent(1)(state, table(m._ids_task(types.to_batches()))), types)
    contexts = m._contexts_group(table(m._kinds_task(1)(pairs.to_batches())))
    seated, totals, discounts = table(m._first_seats(pairs.to_batches())), (float(pairs["pairs"][0].as_py()), 11.0), (0.7, 0.5)
    for first, mean in ((0, False), (3, True)):
        own = seated.filter(pc.equal(seated["source"], m.SEATED))
        opened = seated.filter(pc.not_equal(seated["source"], m.SEATED))
        entries = table(m._letters_task(own.to_batches()))
        model = types_module.SimpleNamespace(value=m.LetterModel(entries["key"].to_numpy(), entries["customers"].to_numpy()))
        told = pa.concat_tables([m._tables_told(False)(contexts, opened), own])
        seated = m._seat_groups(model, 1, totals, discounts, 1.0, 3, first, mean)(pairs, told)
        totals = (pc.sum(seated["customers"]).as_py(), pc.sum(seated["tables"]).as_py())
    assert totals[1] >= 11 and totals[0] > pairs["pairs"][0].as_py()  # some tables were opened beyond the first
    opened = seated.filter(pc.not_equal(seated["source"], m.SEATED))
    own = seated.filter(pc.equal(seated["source"], m.SEATED))
    told, unseen = pa.concat_tables([m._tables_told(True)(contexts, opened), own]), 1 - pc.sum(seated["known"]).as_py()
    answer = {c: x[0] for c, x in m._answer_groups(totals, unseen, discounts, 1.0)(pairs, told).to_pydict().items()}
    counts, p, tables = m.expand(answer["counts"], np.int64), m.expand(answer["p"], np.float32), m.expand(answer["tables"], "f8")
    dishes, words = m.expand(answer["dishes"], np.float32), m.split_words(state["words"][0].as_py())
    chunk = m.ChunkPairs(
        words, m.expand(state["tokens"][0].as_py(), np.uint32).astype(np.int64), {0: m.expand(answer["places"], np.uint32)}, 1
    )
    new = (1 + 0.5 * totals[1]) / (1 + totals[0]) * unseen
    assert p.sum() + new == pytest.approx(1, abs=1e-5)
    for u in range(len(words)):
        rest = (1 + 0.7 * tables[u]) / (1 + counts[u])
        assert dishes[chunk.first == u].sum() / (1 + counts[u]) + rest * (p.sum() + new) == pytest.approx(1, abs=1e-5)


def test_letter_model_is_a_distribution():
    words = [b"ab", b"abc", b"b", b"abab", b"\n"] * 3
    keys, times = np.unique(pitman_yor.Letters(words).keys(4), return_counts=True)
    model = pitman_yor.LetterModel(keys, times)
    for level in model.levels:
        assert (np.bincount(np.searchsorted(level.contexts, level.keys >> 9), level.mean_whole) <= 1 + 1e-9).all()
    # All words of one to three letters and the end token hold less than the whole together.
    some = [bytes(c) for k in (1, 2, 3) for c in itertools.product(b"abc", repeat=k)] + [b"\n"]
    total = np.exp(model.log_words(some)).sum()
    assert 0.3 < total < 1
    assert model.log_words([b"ab"])[0] > model.log_words([b"cc"])[0]


def test_tables_follow_the_restaurant_process():
    rng = np.random.default_rng(1)
    drawn = pitman_yor.draw_tables(np.full(4000, 3.0), np.full(4000, 0.5), np.full(4000, 2.0), 0.5, rng)
    p = 1.0 / (1.0 + 0.5)  # the second customer's
    q1, q2 = 1.0 / (1.0 + 1.5), 1.0 / (1.0 + 1.0)
    assert drawn.mean() == pytest.approx(1 + p + (1 - p) * q1 + p * q2, abs=0.05)
    big = pitman_yor.draw_tables(np.array([1e6, 1.0, 0.0]), np.full(3, 0.01), np.full(3, 5.0), 0.5, rng)
    assert 1 <= big[0] < 1e5 and big[1:].tolist() == [1.0, 0.0]


# Jaccard join


def brute_links(n, percent):
    known = jaccard_join.WordHashes()
    sets = [(i, set(jaccard_join.shingles(t or "", n, known).tolist())) for i, t in TEXTS]
    head = list(range(len(sets)))

    def top(k):
        while head[k] != k:
            k = head[k]
        return k

    for a, b in itertools.combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            head[top(a)] = top(b)
    out = []
    for k, (i, x) in enumerate(sets):
        own = [sets[j][0] for j in range(len(sets)) if top(j) == top(k) and sets[j][0] is not None]
        out.append((i, len(x), min(own) if own and x else i))
    return out


@pytest.mark.parametrize("n,percent", [(3, 90), (1, 50)])
def test_links_equal_brute_force(docs, none, n, percent):
    rows = jaccard_join.link(docs, n, percent).select("doc_id", "n_shingles", "component_id").collect()
    same_rows([tuple(r) for r in rows], brute_links(n, percent))
    assert jaccard_join.link(none, n, percent).count() == 0


def test_links_of_generated_documents(spark, tiny):
    rng = random.Random(4)
    base = [rng.choices(range(5000), k=rng.randint(5, 400)) for _ in range(30)]
    texts = []
    for words in base:
        for _ in range(8):
            own = list(words)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.randrange(5000)
            texts.append((len(texts), " ".join(map(str, own))))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    known = jaccard_join.WordHashes()
    sets = [set(jaccard_join.shingles(t, 3, known).tolist()) for _, t in texts]
    head = list(range(len(sets)))
    changed = True
    pairs = [(a, b) for a, b in itertools.combinations(range(len(sets)), 2) if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in pairs:
            low = min(head[a], head[b])
            changed |= head[a] != low or head[b] != low
            head[a] = head[b] = low
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.link(frame, 3, 90).collect()}
    assert found == dict(enumerate(head))


def test_first_of_each(docs):
    kept = [r["doc_id"] for r in jaccard_join.first_of_each(docs, 5, 80).collect()]
    assert kept.count(20) == 0 and 0 in kept and 10 not in kept and 12 in kept and 21 not in kept


def test_first_of_each_with_repeated_and_null_keys(spark):
    apart = ["alpha beta gamma delta epsilon", "one two three four five six", "uno due tre quattro cinque sei"]
    rows = [(7, apart[0]), (7, apart[1]), (None, apart[2]), (None, apart[2]), (None, apart[0]), (7, apart[1]), (9, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    kept = [tuple(r) for r in jaccard_join.first_of_each(frame, 5, 80).collect()]
    same_rows(kept, [(7, apart[0]), (7, apart[1]), (None, apart[2]), (9, "")])
    linked = jaccard_join.link(frame, 5, 80)
    assert linked.filter("n_shingles > 0").select("head").distinct().count() == 3


def test_components(spark):
    links = [(5, 4), (4, 3), (9, 8), (8, 7), (7, 6), (6, 3), (20, 21), (20, 20), (5, 4)]
    frame = spark.createDataFrame(links, "a long, b long")
    assert {tuple(r) for r in components(frame).collect()} == {(k, 3) for k in (4, 5, 6, 7, 8, 9)} | {(21, 20)}


# Repeated units


@pytest.mark.parametrize("unit,text,pieces", [
    ("line", "a\n\nb", ["a\n\n", "b"]), ("paragraph", "a\nb\n\nc", ["a\nb\n\n", "c"]),
    ("sentence", "A b. C!\nd", ["A b.", " C!\n", "d"]), ("sentence", "", []), ("line", "\n\nx", ["\n\n", "x"]),
])
def test_units_cover_the_text(unit, text, pieces):
    assert unit_dedup.units_of(text, unit) == pieces


def test_units_stay_once(docs, none):
    rows = unit_dedup.dedup_units(docs, min_words=3, keep=("row", "key")).collect()
    assert {"doc_id", "row", "key", "text", "removed_starts"} <= set(rows[0].asDict())
    seen, left = set(), {}
    order = sorted(range(len(TEXTS)), key=lambda k: (TEXTS[k][0] is not None, TEXTS[k][0] or 0, k))
    for k in order:
        units = unit_dedup.units_of(TEXTS[k][1] or "", "sentence")
        kept = set()
        for place, u in enumerate(units):
            form = b" ".join(unit_dedup.normal(u))
            if len(form.split()) >= 3 and form not in seen:
                seen.add(form)
                kept.add(place)
        gone = unit_dedup.removals(units, kept, 3)
        left[k] = "".join(u for u, g in zip(units, gone, strict=True) if not g)
    same_rows([(r["doc_id"], r["text"]) for r in rows], [(TEXTS[k][0], t) for k, t in left.items()])
    for r in rows:
        whole = [t or "" for i, t in TEXTS if i == r["doc_id"]]
        cuts = list(zip(r["removed_starts"], r["removed_ends"], strict=True))
        spliced = ["".join(t[a:b] for a, b in zip([0, *[e for _, e in cuts]], [*[s for s, _ in cuts], len(t)], strict=True)) for t in whole]
        assert r["text"] in spliced
    assert unit_dedup.dedup_units(none).count() == 0


def runs_of(text, n):
    words = text.lower().split()
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}


def test_passages_are_found_wherever_they_start(spark):
    rng = random.Random(8)
    made = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    shared = [made(50) for _ in range(40)]
    texts = [f"{made(rng.randint(0, 30))} {p} {made(rng.randint(0, 30))}" for p in shared for _ in range(2)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(unit_dedup.dedup_units(frame, unit="passage").collect())
    left = [r["text"] for r in rows]
    seen = Counter(run for t in left for run in runs_of(t, 50))
    assert max(seen.values()) == 1 and left[:80:2] == texts[:80:2]
    for r, t in zip(rows, texts, strict=True):
        cuts = list(zip(r["removed_starts"], r["removed_ends"], strict=True))
        assert r["text"] == "".join(t[a:b] for a, b in zip([0, *[e for _, e in cuts]], [*[s for s, _ in cuts], len(t)], strict=True))


def test_short_units_are_found(spark):
    rng = random.Random(9)
    made = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    short = " ".join(f"{made(2)}." for _ in range(20))
    letters = "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(80))
    texts = [f"{made(9)} {short} {made(9)}", f"{made(9)}. {short}", letters, "文" + letters[:60]]
    texts += [made(12) + "\nAll rights reserved.\n" + made(12), made(12) + "\nall rights  reserved.\n" + made(12)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = [r["text"] for r in sorted(unit_dedup.dedup_units(frame, unit="passage").collect())]
    assert left[::2] == texts[::2]
    assert sum(s in left[1] for s in short.split(". ")) < 10 and len(left[3]) < 30 and "rights" not in left[5]
