import random

from compare import check
from conftest import SMALL

from cohortloom.llm.leakage import leaks, word_runs
from cohortloom.llm.leakage_queries import ORACLE_SQL, p6_found


def brute(docs, items, n):
    grams = lambda t: {tuple(w[i : i + n]) for w in [word_runs(t)] for i in range(len(w) - n + 1)}
    return sorted((d, i) for d, t in docs if t is not None for i, q in items if q is not None and grams(t) & grams(q))


def test_equals_brute_force(spark):
    rnd = random.Random(7)
    vocabulary = [f"w{i}" for i in range(12)]
    text = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    items = [(i, text(rnd.randint(2, 14))) for i in range(25)] + [(98, None), (99, "")]
    docs = [(i, text(rnd.randint(0, 60))) for i in range(150)]
    for i in range(60):
        w = items[rnd.randrange(25)][1].split()
        a = rnd.randrange(len(w))
        docs.append((200 + i, f"{text(9)}\n{'; '.join(w[a:]).upper()} {text(5)}"))
    docs += [(900, None), (901, ""), (902, items[0][1]), (902, items[0][1])]
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, doc string, item int")
    q = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, terms string")
    for n in (3, 5):
        got = leaks(d, "doc_id", "text", q, "item_id", "text", n=n)
        assert sorted((r.doc_id, r.item_id) for r in got.collect()) == brute(docs, items, n)
        blocks = leaks(d, "doc_id", "text", q, "item_id", "text", n=n, block_words=40)
        assert sorted(map(tuple, blocks.collect())) == sorted(map(tuple, got.collect()))


def test_long_text_proximity_and_empty_tables(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    near = item.replace("six seven", "seven six").replace("ten", "ten or")
    d = spark.createDataFrame([(1, "x " * 300_000 + item), (2, near), (3, "one two three")], "doc_id long, text string")
    q = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [r.doc_id for r in leaks(d, "doc_id", "text", q, "item_id", "text").collect()] == [1]
    assert sorted(r.doc_id for r in leaks(d, "doc_id", "text", q, "item_id", "text", slop=2).collect()) == [1, 2]
    assert leaks(d.limit(0), "doc_id", "text", q, "item_id", "text").count() == 0
    assert leaks(d, "doc_id", "text", q.limit(0), "item_id", "text").columns == ["doc_id", "item_id", "run_length", "near_share"]


def test_query_equals_oracle(spark):
    check(spark, p6_found, ORACLE_SQL["p6_found"], SMALL)


def brute_near(docs, items, n, slop, share):
    """{(document, item): most words of a window near their places} over every start of the item."""
    out = {}
    for d, text in docs:
        w = word_runs(text)
        for i, q in items:
            t = word_runs(q)
            for x in range(-len(t) - slop, len(w) + slop + 1):
                near = [t[k] in w[max(0, x + k - slop) : max(0, x + k + slop + 1)] for k in range(len(t))]
                c = max((sum(near[s : s + n]) for s in range(len(t) - n + 1)), default=0)
                if c / n >= share and c > out.get((d, i), 0):
                    out[d, i] = c
    return out


def test_proximity_equals_brute_force_whichever_words_are_missing(spark):
    rnd = random.Random(5)
    common = [f"c{i}" for i in range(25)]
    items = [(i, " ".join(rnd.choices(common, k=17)[:-1] + [f"rare{i}"])) for i in range(5)]
    items = [(i, " ".join(rnd.sample(q.split(), 17))) for i, q in items]
    docs = []
    for i, q in items:
        for changed in range(1, 6):
            w = q.split()
            for k in [w.index(f"rare{i}"), *rnd.sample(range(17), changed - 1)]:
                w[k] = rnd.choice(["other", "misspelt"])
            a = rnd.randrange(16)
            w[a : a + 2] = [w[a + 1], *(["inserted"] if changed % 2 else []), w[a]]
            docs.append((len(docs), " ".join(rnd.choices(common, k=rnd.randint(0, 9)) + w)))
    docs += [(100 + i, q) for i, q in items] + [(200 + i, " ".join(rnd.choices(common, k=30))) for i in range(10)]
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for share in (0.8, 0.6):
        got = leaks(d, "doc_id", "text", q, "item_id", "text", slop=2, near_share=share).collect()
        assert {(r.doc_id, r.item_id): round(r.near_share * 13) for r in got} == brute_near(docs, items, 13, 2, share)
        assert len(got) == len({(r.doc_id, r.item_id) for r in got})
