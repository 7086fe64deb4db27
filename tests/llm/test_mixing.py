from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortloom.llm.mixing import mix, schedule, token_counts, default_vocabulary


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "big", "lorem ipsum dolor sit amet " * (1 + i % 5)) for i in range(600)] + [(1000 + i, "small", "word " * 30) for i in range(20)] + [(2000 + i, "mid", "a b c d e f " * 4) for i in range(150)]
    rows += [(3000, None, "no source"), (3001, "unlisted", "x"), (3002, "big", None), (3003, "big", ""), (3004, "big", "y " * 40_000)]
    return spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, source string, text string, tokens string, slot int")


def targets(spark, rows):
    return spark.createDataFrame(rows, "source string, target_share double, max_repeats int")


def test_shares_caps_and_ties(spark, docs):
    t = targets(spark, [("big", 0.6, 1), ("small", 0.2, 4), ("mid", 0.2, 2), ("absent", 0.0, 2)])
    mixture, report = mix(docs, "doc_id", "source", "text", t, block_tokens=64)
    rows = mixture.collect()
    used = Counter((r.source, r.doc_id) for r in rows)
    caps = {"big": 1, "small": 4, "mid": 2}
    assert all(n <= caps[s] for (s, _), n in used.items()) and {s for s, _ in used} == set(caps)
    shares = {r.source: (r.target_share, r.actual_share) for r in report.collect()}
    assert shares["absent"] == (0.0, 0.0) and all(abs(a - b) < 0.04 for k, (a, b) in shares.items())
    # copies of a document come in different passes, and the blocks of a source are met in order without gaps
    for s in caps:
        own = sorted((r.place, r.tokens) for r in rows if r.source == s)
        assert all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:])) and own[0][0] == 0
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mix(docs.repartition(5), "doc_id", "source", "text", t, block_tokens=64)[0].collect()))


def test_given_total_and_shortfall(spark, docs):
    t = targets(spark, [("small", 0.5, 1), ("mid", 0.5, 1)])
    _, report = mix(docs, "doc_id", "source", "text", t, total_tokens=6000, block_tokens=50)
    got = {r.source: r for r in report.collect()}
    assert got["small"].most_copies == 1 and got["small"].actual_share < 0.45 and abs(got["mid"].tokens - 3000) < 200


def test_empty(spark, docs):
    t = targets(spark, [("big", 1.0, 1)])
    mixture, report = mix(docs.limit(0), "doc_id", "source", "text", t)
    assert mixture.count() == 0 and report.first().actual_share == 0.0
    assert mix(docs, "doc_id", "source", "text", t.limit(0))[0].count() == 0


def test_schedule_is_even_in_every_stretch(spark):
    for points in ("golden", "vdc"):
        rows = schedule(spark, [("a", 0.5), ("b", 0.3), ("c", 0.2)], 5000, points, chunk=300).orderBy("slot").collect()
        seen = Counter()
        for n, r in enumerate(rows, 1):
            assert r.block == seen[r.source]
            seen[r.source] += 1
            if n >= 50:
                assert all(abs(seen[s] - w * n) < 8 for s, w in (("a", 0.5), ("b", 0.3), ("c", 0.2)))


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, None), (3, ""), (4, "<|endoftext|>")], "id long, text string")
    got = {r.id: r.tokens for r in token_counts(df, "id", "text", default_vocabulary()).collect()}
    assert got[1] == 2 and got[2] == 0 and got[3] == 0 and got[4] > 1
    assert df.filter(F.lit(False)).count() == 0
