"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import brute
import pytest
from pyspark.sql import functions as F

from tracewell.llm import (
    decontaminate, embedding_dedup, license_scan, line_dedup, minhash, packing, pii, substring_dedup, toxicity,
    url_filter,
)

ROWS = [
    (None, None), (None, "a b c d e f g h i j k l"), (1, None), (2, ""), (3, " \n\t"), (4, "a"), (4, "a"),
    (5, "é🙂 é🙂"), (6, "word " * 30_000), (7, "word " * 30_000), (8, "x" * 200_000), (9, "a b c d e f g h i j k l"),
]
#: Names that operators use inside or return, next to those of the table.
CLASHES = ("score", "found", "component_id", "kept", "spans", "row_key", "key", "doc", "bucket", "label", "n_lines", "copy")


@pytest.fixture(scope="module")
def documents(spark):
    plain = spark.createDataFrame(ROWS, "doc_id long, text string").withColumns(
        {"lang": F.when(F.col("doc_id") > 3, "en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")})
    return plain.withColumns({c: F.lit("own") for c in CLASHES})


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(None, 1), (4, None), (4, 1), (5, 0), (6, 0), (9, 1), (9, 1), (77, 1), (2, 5)]
    return spark.createDataFrame(rows, "doc_id long, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, "c d e f g h i j k l"), (None, "word"), (2, None), (3, ""), (4, "A")]
    return spark.createDataFrame(rows, "item_id long, text string")


def answers(frame, *columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)


def reports(labels, benchmark):
    return {
        "minhash": minhash.near_duplicates, "substrings": substring_dedup.report, "pii": pii.report,
        "licences": license_scan.report, "lines": line_dedup.report,
        "toxicity": lambda d: toxicity.report(d, labels, 20),
        "decontaminate": lambda d: decontaminate.report(d, benchmark),
    }


@pytest.mark.parametrize("name", ["minhash", "substrings", "pii", "licences", "lines", "toxicity", "decontaminate"])
def test_every_row_comes_out_once(documents, labels, benchmark, name):
    operator = reports(labels, benchmark)[name]
    got = operator(documents)
    assert answers(got, "doc_id") == sorted(((d,) for d, _ in ROWS), key=repr)
    empty = operator(documents.limit(0))
    assert empty.count() == 0 and empty.columns == got.columns


def test_minhash(documents):
    got = answers(minhash.near_duplicates(documents), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(brute.near_duplicates(ROWS), key=repr)
    kept = minhash.without_near_duplicates(documents)
    assert kept.columns == documents.columns
    assert answers(kept, "doc_id") == sorted(((d,) for d, _ in ROWS if d != 7), key=repr)


def test_decontaminate(documents, benchmark):
    kept = decontaminate.decontaminate(documents, benchmark)
    assert kept.columns == documents.columns and kept.filter("found <> 'own'").count() == 0
    assert answers(kept, "doc_id") == sorted(((d,) for d in (None, 1, 2, 3, 5, 6, 7, 8)), key=repr)
    nothing = decontaminate.report(documents, benchmark.limit(0))
    assert nothing.filter("contaminated or n_items > 0").count() == 0


def test_lines(documents):
    kept = line_dedup.without_repeated_lines(documents)
    assert kept.columns == documents.columns
    left = {r.doc_id: (r.text, r.n_chars, r.score) for r in kept.collect() if r.doc_id is not None}
    assert left[7] == ("", 0, "own") and left[6][1] == 150_000 and left[1] == (None, None, "own")
    assert [r.text for r in kept.filter("doc_id is null").collect() if r.text is not None] == [""]


def test_toxicity(documents, labels):
    kept = toxicity.without_toxic(documents, labels, 20)
    assert kept.columns == documents.columns
    got = toxicity.report(documents, labels, 20)
    assert got.filter("score is null or score < 0 or score > 1").count() == 0
    assert got.filter("predicted <> int(score >= 0.3) or rejected <> (score >= threshold)").count() == 0
    assert toxicity.report(documents, labels.limit(0)).count() == len(ROWS)


def test_packing(documents):
    packed = packing.pack(documents)
    assert packed.agg(F.sum("length")).first()[0] == sum(len((t or "").split()) for _, t in ROWS)
    assert packing.pack(documents.limit(0)).count() == 0
    assert packing.sequences(packed.filter("doc_id = 5"), documents).first().texts == ["é🙂 é🙂"]


def test_embeddings_empty(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(empty).count() == 0
    odd = spark.createDataFrame([(1, None, 1), (1, [0.0], 1), (None, [1.0], 2)], "vec_id long, embedding array<float>, node int")
    assert answers(embedding_dedup.near_duplicates(odd), "vec_id", "n_links", "component_id", "kept") == sorted(
        [(1, 0, 1, True), (1, 0, 1, True), (None, 0, None, True)], key=repr)


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.COM/en/x?y#z", "http://www.example.com/en/1", "http://x.com",
            "ftp://net/es/", "http://sub.net/fr/é🙂", "http://exnet/fr/", "http://b.net/FR/", "a://b://c.com/", "http://org/" + "p" * 50_000,
            "http://x.com/?/en/", "http://x.com/a\nb"]
    rows = [(k, u, "own") for k, u in enumerate(urls)] + [(None, "http://x.com/", "own"), (4, urls[4], "own"), (4, urls[4], "own")]
    pages = spark.createDataFrame(rows, "page_id long, url string, score string")
    got = {r.page_id: r for r in url_filter.verdicts(pages).collect()}
    assert url_filter.verdicts(pages).count() == len(rows)
    assert (got[0].host, got[0].path, got[0].rule) == ("", "", None) and (got[2].host, got[2].path) == ("", "")
    assert (got[4].host, got[4].path, got[4].rule, got[4].verdict) == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert (got[5].rule, got[5].verdict) == ("www.example.com/en/", "allow") and got[6].rule is None
    assert [got[k].rule for k in (7, 8, 9, 10)] == ["net/es/", "net/fr/", None, None]
    assert (got[11].host, got[11].path) == ("b:", "//c.com/") and (got[13].path, got[14].path) == ("/", "/a\nb")
    assert {r.verdict for r in got.values()} <= {"allow", "block"}
    assert url_filter.verdicts(pages.limit(0)).count() == 0
    unruled = spark.createDataFrame([(1, "http://a.org/x"), (2, "http://b.org/y")], "page_id long, url string")
    assert {r.verdict for r in url_filter.verdicts(unruled).collect()} == {"allow"}
