"""Every operator on NULLs, empty and long texts, ties, repeated rows, clashing columns and empty tables."""

import random
import zlib

import brute
import duckdb
import numpy as np
import pytest
from brute import prose
from pyspark.sql import functions as F

import corpus_pipeline
from cabrank.llm import sql
from cabrank.llm.alignment import aligned, alignment_figures
from cabrank.llm.compression import classify
from cabrank.llm.divergence import divergences, shares
from cabrank.llm.lengths import at_limits, length_histogram, quantiles
from cabrank.llm.ordering import Layout, read_order, training_order, write_order
from cabrank.llm.packing import pack_documents
from cabrank.llm.phrases import contamination, uncontaminated
from cabrank.llm.pieces import encoding_digests
from cabrank.llm.repeats import Sizes, dedup, repeated_windows, with_key, without_repeats
from cabrank.llm.rules import judge, keep
from cabrank.llm.simhash import near_copies, one_of_each
from cabrank.llm.tokens import token_ids
from cabrank.llm.urls import judge_urls
from cabrank.llm.warc import archive_pages

LABELS = "doc_id long, quality int, toxic int"
ITEMS = "item_id long, text string"


def same(got, expected):
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_repeats(edge, edge_rows):
    expected = [(key, *found) for (key, _), found in zip(edge_rows, brute.removed([t for _, t in edge_rows]), strict=True)]
    same(map(tuple, dedup(edge).collect()), expected)


def test_texts_without_repeats(edge, edge_rows):
    rows = without_repeats(edge)
    assert rows.columns == edge.columns
    got = [(r.doc_id, r.text) for r in rows.collect()]
    assert len(got) == len(edge_rows)
    assert (3, None) in got and (0, "") in got
    for key, text in got:
        assert text is None or any(k == key and set(text) <= set(t or "") for k, t in edge_rows)


def test_packing(edge, edge_rows):
    rows = pack_documents(edge).collect()
    same([tuple(r)[:5] for r in rows], [(key, *p) for key, text in edge_rows for p in brute.pieces(text)])


def test_order(spark, edge, edge_rows, tmp_path):
    layout = Layout(length=64, records=16)
    uri = f"file://{tmp_path}/order"
    manifest = write_order(edge, uri, layout)
    rows = read_order(manifest, uri, layout).collect()
    ids = [(key, brute.token_ids(text)) for key, text in edge_rows]
    same(
        [(r.doc_id, r.piece, r.n_tokens) for r in rows],
        [(key, at // 64, min(64, len(found) - at)) for key, found in ids for at in range(0, len(found), 64)],
    )
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    some = read_order(manifest, uri, layout, 5, 40).collect()
    same(some, [r for r in rows if 5 <= r.slot < 40])


def test_long_white_space(spark, tmp_path):
    """Runs of white space beyond the stack of the quick encoder, in all operators that count tokens."""
    made = random.Random(5)
    mixed = "".join(made.choice(" \t\n\r\u00a0\u3000") for _ in range(1_100_000))
    rows = [(0, "a" + " " * 3_000_000 + "b"), (1, "\n" * 1_100_000), (2, "x" + "\t" * 1_100_000), (3, mixed), (4, "plain text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = {key: np.array(brute.token_ids(text), np.uint32) for key, text in rows}
    for key, text in rows:
        assert np.array_equal(token_ids(text), expected[key])
    lengths = sorted(len(x) for x in expected.values())
    same([r.length for r in length_histogram(docs).collect()], lengths)
    cut = pack_documents(docs).groupBy("doc_id").agg(F.sum("length"), F.count("*")).collect()
    same(map(tuple, cut), [(key, len(x) + 1, -(-(len(x) + 1) // 2048)) for key, x in expected.items()])
    order = training_order(docs, Layout(length=4096, records=64)).collect()
    parts = [(key, n, zlib.crc32(x[at : at + 4096].astype("<u2").tobytes())) for key, x in expected.items() for n, at in enumerate(range(0, len(x), 4096))]
    same([(r.doc_id, r.piece, r.ids_crc32) for r in order], parts)


def test_near_copies(edge, edge_rows):
    prints = [(key, brute.fingerprint(text)) for key, text in edge_rows]
    expected = [(k, f"{fp:016x}", root) for (k, fp), root in zip(prints, brute.linked(prints), strict=True)]
    same(map(tuple, near_copies(edge).collect()), expected)


def test_one_of_each(edge, edge_rows):
    prints = [(key, brute.fingerprint(text)) for key, text in edge_rows]
    rows = one_of_each(edge)
    assert rows.columns == edge.columns
    roots = set(brute.linked(prints))
    assert len([r for r in rows.collect() if r.doc_id is not None]) == len(roots - {None})


def test_contamination(spark, edge, edge_rows):
    long = edge_rows[[k for k, _ in edge_rows].index(10)][1].split()
    items = [
        (1, " ".join(long[100:140]).upper()),
        (1, "line one here"),
        (2, " ".join(long[5000:5009])),
        (3, None),
        (4, "!!"),
        (None, "one two"),
        (5, "word"),
        (6, "nothing of this kind is anywhere in these texts at all"),
    ]
    table = spark.createDataFrame(items, ITEMS)
    expected = [(key, *found) for (key, _), found in zip(edge_rows, brute.contamination(edge_rows, items), strict=True)]
    same(map(tuple, contamination(edge, table).collect()), expected)
    kept = uncontaminated(edge, table)
    assert kept.columns == edge.columns
    same([(r.doc_id, r.text) for r in kept.collect()], [row for row, e in zip(edge_rows, expected, strict=True) if not e[-1]])


def test_rules(edge, edge_rows):
    con = duckdb.connect()
    con.execute("create table documents(place bigint, doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?, ?)", [(i, *row) for i, row in enumerate(edge_rows) if "\0" not in (row[1] or "")])
    query = sql.QUALITY.replace("doc_id", "place")
    expected = con.execute(query).fetchall()
    ids = [key for key, _ in edge_rows]
    got = [tuple(r) for r in judge(edge).collect() if r.doc_id != 12]
    same(got, [(ids[row[0]], *row[1:]) for row in expected])
    assert keep(edge).columns == edge.columns
    assert keep(edge).count() == sum(row[-1] for row in expected)


def test_lengths(edge, edge_rows):
    lengths = [len(brute.token_ids(text)) for _, text in edge_rows]
    report = length_histogram(edge)
    same([(r.length, r.n_docs) for r in report.collect()], [(n, lengths.count(n)) for n in set(lengths)])
    for row in report.collect():
        assert row.docs_at_least == sum(n >= row.length for n in lengths)
        assert row.tokens_if_cut == sum(min(n, row.length) for n in lengths)
    limits = {r.limit: (r.tokens, r.whole_docs, r.cut_docs) for r in at_limits(report, [1, 100, 10**6]).collect()}
    for limit, found in limits.items():
        assert found == (sum(min(n, limit) for n in lengths), sum(n <= limit for n in lengths), sum(n > limit for n in lengths))
    half = quantiles(report, [0.5]).first().length
    assert half == sorted(lengths)[-(-len(lengths) // 2) - 1]


def test_classifier(spark, edge, edge_rows):
    labels = spark.createDataFrame([(0, 1, 0), (0, 1, 0), (13, 0, 0), (14, 0, 0), (10, 1, 0), (None, 1, 0), (4, None, 0)], LABELS)
    rows = classify(edge, labels).collect()
    assert len(rows) == len(edge_rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    unlabelled = classify(edge, spark.createDataFrame([], LABELS)).collect()
    assert len({r.score for r in unlabelled}) == 1


PAGES = [
    (1, "https://a.example.com/en/x", "same"),
    (0, "http://WWW.Example.com/en/?q", "same"),
    (0, "http://other.net/es/", "same"),
    (2, None, None),
    (3, "no scheme", ""),
    (None, "ftp://x.net/fr/1#a", "same"),
    (None, "http://net/es/\r\nX-Page-ID: 9", "alone"),
    (5, "http://example.com", "é" * 100_000),
    (6, "http://com", "\r\n\r\n"),
    (6, "http://com", "\r\n\r\n"),
    (7, "https://www.example.com/enx/", "b" * 10),
]


@pytest.fixture
def pages(spark):
    rows = [(*row, 1, 2, "x") for row in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, sha1 int, marker int, first string")


def test_archives(pages):
    import base64
    import hashlib

    ids = {}
    for key, _, html in PAGES:
        ids.setdefault(html or "", []).append(key)
    expected, seen = [], set()
    for key, _, html in sorted(PAGES, key=lambda p: (p[0] is not None, p[0] or 0)):
        raw = (html or "").encode()
        first = min((k for k in ids[html or ""] if k is not None), default=None)
        response = key == first and (key, raw) not in seen
        seen.add((key, raw))
        kind = ("response", None) if response else ("revisit", first)
        expected.append((key, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), *kind))
    same(map(tuple, archive_pages(pages).collect()), expected)


def test_least_payload(pages):
    rows = archive_pages(pages, least=5).collect()
    assert sum(r.record_type == "revisit" for r in rows) == 0


def test_urls(spark, pages):
    rules = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
             ("net/fr/", "block"), (None, "block"), ("com/", "other")]
    table = spark.createDataFrame(rules, "rule string, action string")
    con = duckdb.connect()
    con.execute("create table pages(page_id bigint, url varchar)")
    con.executemany("insert into pages values (?, ?)", [(i, p[1]) for i, p in enumerate(PAGES)])
    expected = [(PAGES[r[0]][0], *r[1:]) for r in con.execute(sql.URLS).fetchall()]
    same(map(tuple, judge_urls(pages, table).collect()), expected)
    same(map(tuple, judge_urls(pages, table, most_bytes=0).collect()), expected)
    assert judge_urls(pages, table.limit(0)).filter("rule is not null or verdict <> 'allow'").count() == 0


def test_pieces(edge, edge_rows):
    same(map(tuple, encoding_digests(edge).collect()), [(key, *brute.encoding(text)) for key, text in edge_rows])


def test_divergence(spark, edge):
    """Groups without terms, NULL groups, a language whose terms are all rare, and texts cut into pieces."""
    made = random.Random(9)
    words = [f"w{chr(97 + n)}" for n in range(20)] + ["É", "ÀB", "x9y", "z-z", "\u2581"]
    rows = [("de", f"s{n % 4}", " ".join(made.choices(words, range(1, 26), k=made.randint(0, 60)))) for n in range(150)]
    rows += [(None, "s1", "A a"), (None, None, None), ("", "s2", ""), ("fr", "s1", "seul"), ("fr", "s2", "seul"), ("en", "", "only")] + rows[:30]
    docs = spark.createDataFrame([(*row, 1, 2.0, "x") for row in rows], "lang string, source string, text string, n long, docs double, term string")
    expected = brute.divergence(rows)
    for sizes in ({}, {"block": 300, "piece": 40, "fold": 20}):
        same(map(tuple, divergences(docs.repartition(4), **sizes).collect()), expected)
    long = [("l", f"s{n % 3}", brute.prose(n, 20_000 if n == 4 else 50)) for n in range(40)]
    table = spark.createDataFrame(long, "lang string, source string, text string")
    same(map(tuple, divergences(table, piece=5000).collect()), brute.divergence(long))
    groups = [(r.lang, r.source, r.text) for r in edge.select("lang", "source", "text").collect()]
    same(map(tuple, divergences(edge, least=2).collect()), brute.divergence(groups, 2))


def test_large_counts_stay_exact():
    counts = np.array([0, 1, 10**12, 7 * 10**14], np.int64)
    expected = [1 + 10**9 * (int(n) + 2) // (8 * 10**15 + 2 * 5) for n in counts]
    assert shares(counts, 8 * 10**15, 5).tolist() == expected


def test_alignment(edge, edge_rows):
    expected = [(key, *found) for (key, _), found in zip(edge_rows, brute.alignment([t for _, t in edge_rows]), strict=True)]
    same(map(tuple, alignment_figures(edge).collect()), expected)
    same(map(tuple, alignment_figures(edge, most=1000).collect()), expected)


def test_tokens_and_links(edge, edge_rows):
    rows = aligned(edge).collect()
    plain = [(key, brute.aligned(text)) for key, text in edge_rows]
    same([(r.doc_id, r.a_ids, r.b_ids) for r in rows], [(key, a, b) for key, (a, b, _, _) in plain])
    pairs = [(r.doc_id, [(r.a_ids[i], r.b_ids[j]) for i, j in zip(r.a_links, r.b_links, strict=True)]) for r in rows]
    same(pairs, [(key, links) for key, (_, _, _, links) in plain])
    for r in rows:
        assert all(r.a_ends[i] == r.b_ends[j] for i, j in zip(r.a_links, r.b_links, strict=True))


def test_empty_tables(spark, no_docs, pages):
    items = spark.createDataFrame([], ITEMS)
    labels = spark.createDataFrame([], LABELS)
    for operator in (training_order, dedup, pack_documents, judge, length_histogram, near_copies, one_of_each, without_repeats,
                     encoding_digests, divergences, alignment_figures, aligned):
        assert operator(no_docs).count() == 0
    assert contamination(no_docs, items).count() == uncontaminated(no_docs, items).count() == 0
    assert classify(no_docs, labels).count() == 0
    assert archive_pages(pages.limit(0)).count() == 0
    rules = spark.createDataFrame([("com/", "allow")], "rule string, action string")
    assert judge_urls(pages.limit(0), rules).count() == 0


def test_no_items(spark, edge, edge_rows):
    rows = contamination(edge, spark.createDataFrame([], ITEMS)).collect()
    same([(r.doc_id, r.n_words, r.n_hit) for r in rows], [(k, len(brute.words(t)), 0) for k, t in edge_rows])


def test_short_strings(edge, edge_rows):
    raws = [t for _, t in edge_rows if t is None or len(t) < 5000]
    found = dedup(edge.filter(F.coalesce(F.length("text"), F.lit(0)) < 5000), sizes=Sizes(16, 8, 600)).collect()
    same([tuple(r)[1:] for r in found], brute.removed(raws, 16))


def test_stage_columns(spark, edge, tmp_path):
    spark.createDataFrame([(0, 1, 0), (13, 0, 0)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "word")], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = edge
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == edge.columns, name


def test_many_equal_rows(spark):
    """One row over and over, and another with one of its passages."""
    text, other = prose(21, 80), prose(22, 40)
    rows = [(1, text)] * 300 + [(2, other + text[100:340] + other), (3, prose(23, 50))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = [(key, *found) for (key, _), found in zip(rows, brute.removed([t for _, t in rows]), strict=True)]
    same(map(tuple, dedup(docs).collect()), expected)
    assert max(len(r.stretches) for r in repeated_windows(with_key(docs, "doc_id", "text", "s"), Sizes(), "s").collect()) <= len(text)
    assert sorted((r.doc_id, r.text) for r in one_of_each(docs).collect()) == sorted(set(rows))
    items = [(7, " ".join(text.split()[5:30]))] * 200 + [(8, "no such words")]
    found = {tuple(r) for r in contamination(docs, spark.createDataFrame(items, ITEMS)).collect()}
    assert {row[0] for row in found if row[-1]} == {1} | ({2} if brute.contamination(rows[300:301], items)[0][-1] else set())
    pages = spark.createDataFrame([(4, f"http://{n}.com/", "x" * (n % 3)) for n in range(300)], "page_id long, url string, html string")
    kinds = archive_pages(pages).groupBy("payload_bytes", "record_type").count().collect()
    assert sorted(map(tuple, kinds)) == sorted((n, kind, many) for n in range(3) for kind, many in (("response", 1), ("revisit", 99)))
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 0, 0)], LABELS)
    assert classify(docs, labels).count() == len(rows)


def test_pipeline_without_documents(spark, no_docs, tmp_path):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path))
    assert rows.count() == 0 and rows.columns[:5] == ["doc_id", "piece", "start", "length", "ids_crc32"]
