"""The parts of the operators against plain computations."""

import gzip
import os
import random
import zlib
from collections import Counter
from pathlib import Path

import brute
import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cabrank.llm import compression, phrases, sql, suffixes
from cabrank.llm.alignment import aligner, refined
from cabrank.llm.components import components
from cabrank.llm.ordering import Layout, permute, read_order, write_order
from cabrank.llm.packing import Capacity, fit
from cabrank.llm.pieces import Pieces
from cabrank.llm.repeats import SCAN_BYTES, Hashes, Sizes, _pieces, dedup
from cabrank.llm.rules import RULES, SAMPLE_BYTES, Rule, drawn, judge, ordered
from cabrank.llm.simhash import guaranteed, links, lists_of, postings, tallied
from cabrank.llm.suffixes import Buffer, common_prefixes, repeated, suffix_order
from cabrank.llm.urls import build_cascade, judge_urls, listed
from cabrank.llm.warc import parse, read_archives, write_archives

SEGMENTS = st.lists(st.binary(max_size=60).map(lambda b: bytes(97 + x % 2 if x else 0 for x in b)), min_size=1, max_size=8)


@settings(max_examples=150, deadline=None)
@given(SEGMENTS, st.integers(8, 20), st.integers(1, 3))
def test_suffix_arrays(segments, least, times):
    segments = [s * times for s in segments]
    text = Buffer.of(segments)
    suffixes = {
        int(start) + i: (s[i:], k) for k, (s, start) in enumerate(zip(segments, text.starts, strict=True)) for i in range(len(s) + 1)
    }
    order = suffix_order(text)
    assert [int(p) for p in order] == sorted(suffixes, key=lambda p: suffixes[p])
    before, shared = common_prefixes(text, order, least)
    for p in np.flatnonzero(text.left >= least):
        a, b = suffixes[p][0], suffixes[before[p]][0] if before[p] >= 0 else b""
        agree = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert shared[p] == min(agree, least)
    counts = Counter(s[i : i + least] for s in segments for i in range(len(s) - least + 1))
    found, first = repeated(text, least)
    for k, s in enumerate(segments):
        for i in range(len(s) - least + 1):
            assert found[text.starts[k] + i] == (counts[s[i : i + least]] > 1)
    assert first.sum() == len(counts)


@pytest.mark.parametrize("bits", [3, 5, 21])
def test_long_shards_have_the_same_order(monkeypatch, bits):
    """A shard too long for three ranks in a key."""
    monkeypatch.setattr(suffixes, "RANK_BITS", bits)
    made = random.Random(bits)
    parts = ["".join(made.choice("ab") for _ in range(made.randint(1, 12))) for _ in range(4)]
    segments = ["".join(made.choices(parts, k=made.randint(0, 12))).encode() for _ in range(40)] + [b"a" * 300] * 2
    text = Buffer.of(segments)
    assert len(text.words) > 1 << 5
    after = {int(start) + i: s[i:] for s, start in zip(segments, text.starts, strict=True) for i in range(len(s) + 1)}
    order = suffix_order(text)
    assert order.tolist() == sorted(after, key=lambda p: (after[p], p))
    before, shared = common_prefixes(text, order, 20)
    for p in np.flatnonzero((text.left >= 20) & (before >= 0)).tolist():
        assert shared[p] == min(20, len(os.path.commonprefix([after[p], after[int(before[p])]])))


def test_what_follows_a_compared_place_is_not_compared(monkeypatch):
    """Two copies of a text are compared from their start alone: a pass for each word of it, and none for each place."""
    passes = []
    monkeypatch.setattr(suffixes, "_equal_bytes", lambda differing, f=suffixes._equal_bytes: passes.append(len(differing)) or f(differing))
    segment = random.Random(1).randbytes(3000).translate(bytes(97 + x % 26 for x in range(256)))
    found, first = repeated(Buffer.of([segment, segment]), 200)
    assert found.sum() == 2 * first.sum() == 2 * 2801
    assert len(passes) <= 3000 // 8 + 1 and sum(passes) <= 3001


def test_shards_over_several_batches(spark):
    """Shards begin and end inside batches of rows, equal rows included."""
    made = random.Random(4)
    parts = ["".join(made.choice("abcd") for _ in range(made.randint(20, 60))) for _ in range(15)]
    rows = [(n, "".join(made.choices(parts, k=made.randint(0, 6)))) for n in range(60)]
    rows += rows[:20]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
        found = sorted(map(tuple, dedup(docs, sizes=Sizes(least=24, gram=8, shard=700)).collect()))
    finally:
        spark.conf.set(key, before)
    assert found == sorted((n, *x) for (n, _), x in zip(rows, brute.removed([t for _, t in rows], 24), strict=True))


@pytest.mark.parametrize("seed", [1, 2])
def test_popular_passage_over_shards(spark, seed):
    """One passage in every text, with other text around it, so that its anchor takes many shards."""
    made = random.Random(seed)
    line = "".join(made.choice("abcdef") for _ in range(30))
    rows = []
    for n in range(300):
        around = ["".join(made.choice("ab") for _ in range(made.randint(0, 12))) for _ in range(2)]
        rows.append((n, around[0] + line + around[1]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: tuple(r)[1:] for r in dedup(docs, sizes=Sizes(least=24, gram=10, shard=500)).collect()}
    assert [found[n] for n in range(300)] == brute.removed([t for _, t in rows], 24)


SAME_HASH = (
    "zxreedbqepkfrnadhcsyjzcyzrfwhjxkyqtkwgepyrwdvtjhvbfqhtabbptufwxdteoojcsawxllrijitvrpairxgogtyjcxeeamxwxosdireyfrtmalffealw"
    "aqnptdtrtjxlrofyrpqpgzgvovtwetglcwogglqmbomyyknfgjdabiibveajkjyvnaxkrskfilpzob",
    "zxreedbqepkfrnadhcsyjzcyzrfwhjxkyqtkwgepyrwdvtjhvbfqhtabbptufwxdteoojcsawxllrijitvrpairxgogtyjcxeeamqpmwootzxaodkripsxgbnq"
    "egqyjaybecmxsjivcvcvzncscbzfutanbmeotjicgxnzfwworyhqahvyclebewnzzguwsddwswzmtt",
)


def test_equal_hashes_are_no_equal_texts(spark):
    """Two texts of one hash, and of one start, stay as they are, alone and inside longer ones."""
    a, b = SAME_HASH
    grams = [int(Hashes(np.frombuffer(x.encode(), np.uint8)).all(200)[0]) for x in SAME_HASH]
    assert grams[0] == grams[1] and a[:100] == b[:100]
    rows = [(0, a), (1, b), (2, brute.prose(1, 60) + a[100:]), (3, brute.prose(2, 50) + b + brute.prose(3, 20)), (4, "x" + a + "y")]
    for some in (rows[:2], rows[2:4], rows):
        found = {r.doc_id: tuple(r)[1:] for r in dedup(spark.createDataFrame(some, "doc_id long, text string")).collect()}
        assert [found[n] for n, _ in some] == brute.removed([t for _, t in some])


@pytest.mark.parametrize(("bits", "shard"), [(1, 1 << 20), (3, 400), (64, 300)])
def test_hashes_decide_nothing(spark, bits, shard):
    """With anchors of a few bits, whose texts fill one shard or many, the suffix arrays still tell what recurs."""
    made = random.Random(bits)
    parts = ["".join(made.choice("ab") for _ in range(made.randint(10, 50))) for _ in range(12)]
    rows = [(n, "".join(made.choice(parts) for _ in range(made.randint(0, 6)))) for n in range(80)]
    docs = spark.createDataFrame([*rows, rows[3], rows[3]], "doc_id long, text string").repartition(3)
    expected = sorted((n, *x) for (n, _), x in zip([*rows, rows[3], rows[3]], brute.removed([t for _, t in [*rows, rows[3], rows[3]]], 24), strict=True))
    found = dedup(docs, sizes=Sizes(least=24, gram=8, shard=shard, bits=bits)).collect()
    assert sorted(map(tuple, found)) == expected
    assert 0 < sum(x[2] for x in expected) < sum(x[1] for x in expected)


def test_long_texts_are_scanned_in_pieces_that_overlap():
    text = bytes(random.Random(1).randbytes(3 * SCAN_BYTES + 50))
    pieces = list(_pieces(text, 200))
    starts = [at + i for at, piece in pieces for i in range(len(piece) - 199)]
    assert starts == list(range(len(text) - 199))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2**40))
def test_permutation(n, key):
    assert sorted(permute(np.arange(n), n, key)) == list(range(n))


def test_orders_differ_by_key():
    a, b = (permute(np.arange(1000), 1000, key) for key in (1, 2))
    assert (a != b).mean() > 0.9 and np.abs(np.corrcoef(np.arange(1000), a)[0, 1]) < 0.15


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=200), st.integers(2, 9), st.sampled_from(["norm", "dot"]))
def test_every_capacity_holds(lengths, documents, choice):
    room = Capacity(64, documents, 64 * 64, (1.0, 0.3, 0.3), choice)
    bins, offsets = fit(np.array(lengths), room)
    for b in set(bins.tolist()):
        own = sorted((offsets[i], lengths[i]) for i in range(len(lengths)) if bins[i] == b)
        assert len(own) <= documents and sum(n * n for _, n in own) <= 64 * 64
        assert [at for at, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= 64


@pytest.mark.parametrize("choice", ["norm", "dot"])
def test_cost_below_the_square_of_the_tokens(choice):
    """A cost that binds before the tokens do; pieces beyond it are alone, and the others share sequences within it."""
    lengths = np.array([60, 50, 50, 40, 30, 30, 20, 10, 10, 5, 1] * 20)
    room = Capacity(tokens=100, cost=2500, choice=choice)
    bins, offsets = fit(lengths, room)
    own = [lengths[bins == b] for b in range(bins.max() + 1)]
    assert all(len(x) == 1 or (x**2).sum() <= room.cost and x.sum() <= room.tokens for x in own)
    assert all(len(x) == 1 for x in own if x.max() >= 50)
    assert len(own) < len(lengths) and any((x**2).sum() == room.cost and len(x) > 1 for x in own)
    for b, x in enumerate(own):
        at = np.argsort(offsets[bins == b])
        assert offsets[bins == b][at].tolist() == [0, *x[at].cumsum()[:-1]]


def test_tight_packing():
    lengths = np.random.default_rng(1).integers(1, 2049, 5000)
    lengths[::2] = lengths[::2] % 300 + 1
    bins, _ = fit(lengths, Capacity())
    assert len(set(bins.tolist())) <= 1.01 * -(-lengths.sum() // 2048)


@pytest.mark.parametrize("distance", range(5))
@pytest.mark.parametrize(("bits", "most", "count"), [(64, 4, 300), (12, 4, 400), (12, 10_000, 400), (6, 2, 60)])
def test_links(spark, distance, bits, most, count):
    """Fingerprints around a few centres, in lists below and above the bound."""
    made = random.Random(bits)
    centres = [made.getrandbits(64) for _ in range(6)]
    prints = {made.choice(centres) ^ sum(1 << b for b in made.sample(range(bits), made.randint(0, 5))) for _ in range(count)}
    signed = [fp - (1 << 64) if fp >> 63 else fp for fp in prints]
    table = spark.createDataFrame([(fp,) for fp in signed], "fp long")
    pairs = links(table, distance, most).collect()
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= distance for a, b in pairs)
    roots = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long") if pairs else table.selectExpr("fp a", "fp b").limit(0)).collect()}
    assert [roots.get(fp, fp) for fp in signed] == brute_roots(signed, distance)


def brute_roots(signed, distance):
    roots = {fp: fp for fp in signed}
    changed = True
    near = {a: [b for b in signed if bin((a ^ b) & (2**64 - 1)).count("1") <= distance] for a in signed}
    while changed:
        changed = False
        for a in signed:
            low = min(roots[b] for b in near[a])
            if low < roots[a]:
                roots[a], changed = low, True
    return [roots[fp] for fp in signed]


@pytest.mark.parametrize(("distance", "least"), [(0, 14), (1, 7), (2, 3), (3, 1), (4, 4)])
def test_count_filter(spark, distance, least):
    """Pairs that meet are tallied over all lists, and those with too few shared ones fall before they are verified."""
    made = random.Random(7)
    values = [made.getrandbits(64)]
    for n in range(400):
        positions = made.sample(range(8), made.randint(1, 5))
        values.append(values[made.randrange(len(values))] ^ sum(1 << 8 * p + made.randrange(8) for p in positions))
    signed = [fp - (1 << 64) if fp >> 63 else fp for fp in set(values)]
    table = spark.createDataFrame([(fp,) for fp in signed], "fp long")
    assert guaranteed(distance) == least
    met = {(r.a, r.b): r.lists for r in tallied(postings(table, distance)).collect()}

    def shared(a, b):
        same = {p for p in range(8) if not (a ^ b) >> 8 * p & 255}
        return sum(set(own) <= same for own in lists_of(distance))

    pairs = [(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i]]
    assert met == {pair: n for pair in pairs if (n := shared(*pair))}
    near = {(a, b) for a, b in pairs if bin((a ^ b) & (2**64 - 1)).count("1") <= distance}
    assert all(met[pair] >= least for pair in near)
    if distance != 3:
        assert sum(n < least for n in met.values()) > 100
    assert {tuple(r) for r in links(table, distance, 10_000).collect()} == near


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 200)], [(5, 5), (None, 2), (7, 3), (3, 7)], []])
def test_components(spark, edges):
    parent = {}
    for a, b in [e for e in edges if None not in e and e[0] != e[1]]:
        low = min(parent.get(a, a), parent.get(b, b))
        high = max(parent.get(a, a), parent.get(b, b))
        parent |= {a: parent.get(a, a), b: parent.get(b, b)}
        parent = {n: low if r == high else r for n, r in parent.items()}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == parent and len(got) == len(parent)


def test_phrases_over_blocks(spark, sf_dir):
    """The same result whether the items are in one file or in a hundred, which go through an index that is read once."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    made = spark.createDataFrame([(-n, brute.prose(n, 30)) for n in range(1, 900)], "item_id long, text string")
    items = items.select(F.col("item_id").cast("long"), "text").unionAll(made)
    whole = phrases.contamination(docs, items).collect()
    size = sum(len((r.text or "").encode()) for r in items.select("text").distinct().collect())
    folder = phrases.store_items(items, most=size // 100)
    blocks = list(phrases.item_blocks(folder))
    assert len(blocks) > 80 and sum(map(len, blocks)) == items.distinct().count()
    found = phrases.contamination(docs, items, item_bytes=size // 100)
    assert sorted(found.collect()) == sorted(whole)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Broadcast" not in plan and "Union" not in plan
    assert sum(r.contaminated for r in whole) > 10


def test_proximity(spark):
    texts = ["a x b x x c", "c b a", "a b", "b x x x x a c", None, "a a b c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index = phrases.build_index(docs)
    items = spark.createDataFrame([("q", "a b c"), ("none", "a y"), ("empty", None)], "item_id string, text string")
    found = phrases.near(index, phrases.store_items(items), 3).collect()
    expected = set()
    for n, text in enumerate(texts):
        words = (text or "").split()
        for rare in "abc":
            for i, word in enumerate(words):
                if word == rare and all(w in words[max(0, i - 3) : i + 4] for w in "abc"):
                    expected.add((n, "q", i))
    assert found and {tuple(r) for r in found} <= expected
    assert {r.doc_id for r in found} >= {1, 5}


def test_archives_roll_and_open(spark, tmp_path, small_dir):
    pages = spark.read.parquet(f"{small_dir}/pages.parquet")
    uri = f"file://{tmp_path}/archives"
    manifest = write_archives(pages, uri, file_bytes=20_000)
    files = manifest.collect()
    assert len(files) > 3 and all(f.bytes >= 20_000 for f in files[:1])
    assert sorted(p.name for p in (tmp_path / "archives").iterdir()) == sorted(f.file for f in files)
    for f in files:
        with gzip.open(tmp_path / "archives" / f.file) as stream:
            assert stream.read().count(b"WARC/1.1\r\n") == f.records
    assert read_archives(manifest, uri).count() == pages.count() == sum(f.records for f in files)


def test_damaged_archive_ends_the_job(spark, tmp_path, small_dir):
    uri = f"file://{tmp_path}/archives"
    manifest = write_archives(spark.read.parquet(f"{small_dir}/pages.parquet"), uri)
    lost = manifest.withColumn("records", F.col("records") + 1)
    with pytest.raises(Exception, match="in the manifest"):
        read_archives(lost, uri).collect()


PARTS = st.sampled_from([*" aabtehinrs.,'", "the", " of", "ing", "\n", "\t", "\u00e9", "\u6f22", "\U0001f9a9", "\u2581", "<s>", "<0x0A>", "  ", "\0", "tion", "ABC"])
TEXTS = st.lists(PARTS, max_size=60).map("".join)
MODEL = Pieces()
BOTH = aligner()


@settings(max_examples=500, deadline=None)
@given(TEXTS)
def test_pieces_equal_the_library(text):
    expected = MODEL.library.encode(text)
    assert MODEL.encode(text) == expected
    assert list(MODEL.numbers_of(MODEL.library.normalize(text) if text else "")) == expected


def test_pieces_of_any_strings(sf_dir):
    """Pieces, cut and joined in all ways, runs of one sign, and long texts without a place to cut."""
    made = random.Random(1)
    known = list(MODEL.scores)
    texts = ["".join(made.choice(known)[: made.randint(1, 16)] for _ in range(made.randint(1, 30))) for _ in range(3000)]
    texts += [sign * n for sign in " a\n\u6f22\u00e9" for n in (1, 15, 16, 17, 33, 100_000)]
    texts += ["".join(made.choice("abcdefgh") for _ in range(100_000))]
    assert [MODEL.encode(text) for text in texts] == MODEL.library.encode(texts)


def test_places_fail_and_are_left_behind():
    """Texts on which the longest pieces lead astray, so that places are marked as failed."""
    made = random.Random(3)
    strayed = 0
    for _ in range(300):
        text = "\u2581" + "".join(made.choice("abdeinorst") for _ in range(made.randint(5, 40)))
        found = MODEL.parts(text)
        greedy, at = [], 0
        while at < len(text):
            size = max(n for n in range(1, 17) if text[at : at + n] in MODEL.scores and at + n <= len(text))
            greedy.append(text[at : at + size])
            at += size
        strayed += [MODEL.library.id_to_piece(n) for n in found] != greedy
    assert strayed > 50


def test_memories_are_bounded(monkeypatch):
    model = Pieces()
    monkeypatch.setattr("cabrank.llm.pieces.CHUNKS", 5)
    monkeypatch.setattr("cabrank.llm.pieces.PAIRS", 7)
    text = brute.prose(4, 3000)
    assert model.encode(text) == model.library.encode(text)
    assert len(model.chunks) <= 5 and len(model.earlier) <= 5 and len(model.pairs) <= 8


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_alignment_equals_plain_bytes(text):
    a, b, groups, links = brute.aligned(text)
    found = BOTH.align(text)
    assert found.a.ids.tolist() == a and found.b.ids.tolist() == b
    at_a, at_b = found.links()
    assert list(zip(found.a.ids[at_a].tolist(), found.b.ids[at_b].tolist(), strict=True)) == links
    written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
    assert BOTH.groups(found) == written
    for long in (3, 20):
        assert BOTH.align(text, long).a.ends.tolist() == found.a.ends.tolist()
    (own,) = BOTH.segments([text])
    assert ";".join(segment[2] for segment in own or ()) == written
    pairs = np.frombuffer(b"".join(segment[3] for segment in own or ()), np.int64)
    assert [(int(x) >> 32, int(x) & 0xFFFFFFFF) for x in pairs] == links
    assert [sum(segment[side] for segment in own or ()) for side in (0, 1)] == [len(a), len(b)]


def test_spans_are_refined_inside_characters():
    """Several tokens of one character, and byte pieces, end where their bytes do; the libraries' spans alone would not tell."""
    found = BOTH.align("x\U0001f9a9y \u6f22")
    assert found.a.ends.tolist() == np.cumsum(BOTH.a_sizes[found.a.ids]).tolist()
    assert found.b.ends.tolist() == np.cumsum(BOTH.b_sizes[found.b.ids]).tolist()
    assert len({b for b in found.b.ends.tolist() if 2 < b < 6}) == 3
    assert refined(np.array([3, 7, 7, 9]), np.array([True, False, True, True]), np.array([3, 1, 3, 2])).tolist() == [3, 4, 7, 9]
    assert refined(np.array([0, 4]), np.array([False, True]), np.array([1, 3])).tolist() == [1, 4]


def test_many_tiny_shards(spark):
    """Ten thousand shards are written and read with eight shuffle partitions."""
    docs = spark.createDataFrame([(n, " ".join(["word"] * 40)) for n in range(2500)], "doc_id long, text string")
    layout = Layout(length=4, records=2)
    uri = f"file://{spark.conf.get('spark.checkpoint.dir')}/tiny"
    manifest = write_order(docs, uri, layout)
    assert manifest.count() > 10_000
    rows = read_order(manifest, uri, layout)
    assert rows.rdd.getNumPartitions() <= 8
    assert rows.agg(F.count("*"), F.min("slot"), F.max("slot"), F.count_distinct("slot")).first() == (25_000, 0, 24_999, 25_000)


def test_revisits_name_their_response(spark, tmp_path):
    pages = [(3, "http://b/", "same text"), (1, "http://a/1", "same text"), (2, None, "same text"), (None, "http://n/", "same text"), (5, "http://c/", "")]
    uri = f"file://{tmp_path}/archives"
    manifest = write_archives(spark.createDataFrame(pages, "page_id long, url string, html string"), uri)
    heads = []
    for row in manifest.collect():
        with open(tmp_path / "archives" / row.file, "rb") as stream:
            heads += [headers for headers, _ in parse(stream)]
    (response,) = [h for h in heads if h.get("X-Page-ID") == "1"]
    revisits = [h for h in heads if h["WARC-Type"] == "revisit"]
    assert len(revisits) == 3
    for headers in revisits:
        assert headers["WARC-Refers-To"] == response["WARC-Record-ID"]
        assert headers["WARC-Refers-To-Target-URI"] == response["WARC-Target-URI"] == "http://a/1"


def test_cascade_is_exact(spark):
    made = random.Random(4)
    corpus = [f"host{made.randrange(10**6)}.com/" for _ in range(5000)]
    wanted = set(made.sample(corpus, 150)) | {"absent.com/"}
    universe = spark.createDataFrame([(k,) for k in corpus], "key string")
    keys = spark.createDataFrame([(k,) for k in sorted(wanted)], "key string")
    levels = build_cascade(keys, universe, 5000)
    assert len(levels) > 1 and sum(level.bits for level in levels) < 64 * len(levels) + 25 * len(wanted)
    marked = universe.select("key", listed(F.col("key"), levels).alias("in"))
    assert all(r["in"] == (r.key in wanted) for r in marked.collect())


def test_filters_are_native(spark, small_dir):
    pages = spark.read.parquet(f"{small_dir}/pages.parquet")
    rules = spark.createDataFrame([("com/", "block")], "rule string, action string")
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    for result in (judge_urls(pages, rules), judge(docs)):
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan
        assert "html" not in plan


def test_order_of_rules_does_not_matter(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    results = [sorted(judge(docs, rules).collect()) for rules in (RULES, RULES[::-1])]
    assert results[0] == results[1] == sorted(judge(docs).collect())


def test_rules_on_every_kind_of_white_space(spark):
    made = random.Random(3)
    signs = [*" \t\n\v\f\r", "f", "a b", "É", "é", "#", "!!", "\x1c", "\x85", "\\", "'", "😀", "c d e "]
    rows = [(n, "".join(made.choice(signs) for _ in range(made.randint(0, 150)))) for n in range(600)]
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    expected = con.execute(sql.QUALITY).fetchall()
    got = judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def test_long_texts_train_too(spark):
    """Every sampled text is in the sample, whatever its length, and a curve of long texts only tells them apart."""
    rows = [(i, brute.prose(i, 6000) if i % 2 else f"junk {i} click here now " * 2000) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    sample = compression.labelled(docs, compression.marked(docs, labels)).collect()
    assert min(len(r.text) for r in sample) > 30_000
    assert len(sample) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(40))
    judged = compression.classify(docs, labels).collect()
    assert [r.predicted for r in sorted(judged)] == [i % 2 for i in range(40)]


def test_scores_are_shares(spark, sf_dir):
    """In each well-filled range of scores of held-out texts the mean score is the share of good ones."""
    folder = Path(sf_dir).parent / "sf0.1"
    docs, labels = (spark.read.parquet(str(folder / f"{name}.parquet")) for name in ("documents", "labels"))
    model = compression.fit(docs, labels)
    held = docs.join(labels.filter(compression.held_out()), "doc_id").select("quality", compression.score(model).alias("score")).collect()
    scores, kinds = np.array([row.score for row in held]), np.array([row.quality for row in held])
    assert len(held) > 700 and ((scores >= compression.THRESHOLD) == kinds).mean() >= 0.98
    assert abs(scores.mean() - kinds.mean()) < 0.02
    edges = [0, 0.05, 0.3, 0.7, 0.95, 1.01]
    filled = 0
    for low, high in zip(edges, edges[1:], strict=False):
        own = (scores >= low) & (scores < high)
        if own.sum() >= 40:
            filled += 1
            assert abs(scores[own].mean() - kinds[own].mean()) <= 0.05
    assert filled >= 2


def test_documents_that_are_all_held_out_are_an_error(spark):
    out = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 0)
    docs = spark.createDataFrame([(i, brute.prose(i, 60)) for i in range(out + 5)], "doc_id long, text string")
    marks = [(i, int(i != out), 0) for i in range(out + 5)]
    with pytest.raises(ValueError, match="held out"):
        compression.fit(docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))


@pytest.mark.parametrize("most", [8, 9, 40, 1000])
def test_pieces_come_from_the_whole_of_a_text(most):
    raws = [bytes([i]) * n for i, n in enumerate((0, 1, 2048, 2049, 60_000, 200_000))]
    each = compression.allowance([len(raw) for raw in raws], most)
    parts = [compression.pieces(raw, each, i) for i, raw in enumerate(raws)]
    assert all(parts[1:]) and sum(map(len, parts)) <= most
    assert most < 1000 or [b"".join(p) for p in parts] == raws
    raw = b"".join(b"%09d " % i for i in range(50_000))
    starts = [int(part.split()[1]) for part in compression.pieces(raw, 40, 7)]
    assert starts == sorted(starts) and len(starts) == 40 and starts[0] < 10_000 and starts[-1] > 40_000


def test_sample_of_the_rules(spark, tmp_path):
    """Texts of all files and any length, and no more than asked for."""
    for n in range(4):
        rows = [(i, f"file{n} " + "é" * (90_000 if i % 10 == 0 else 9)) for i in range(1000 * n, 1000 * n + 1000)]
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/d/n={n}")
    texts = [r.text for r in drawn(spark.read.parquet(f"{tmp_path}/d").select("doc_id", "text"), rows=100).collect()]
    assert len(texts) == 100 and {t[:5] for t in texts if t[:4] == "file"} == {f"file{n}" for n in range(4)}
    assert max(map(len, texts)) == SAMPLE_BYTES // 4


def test_cheap_rules_come_first(spark):
    docs = spark.createDataFrame([(i, brute.prose(i, 900)) for i in range(60)], "doc_id long, text string")
    dear = Rule("dear", r"length(regexp_replace(regexp_replace({text}, '[a-c]+', 'x'), '(x|d)+', '')) >= 0")
    never, cheap = Rule("never", "n_words < 0"), Rule("cheap", "n_words > 0")
    assert [r.name for r in ordered(docs, (never, dear, cheap))] == ["cheap", "dear", "never"]
