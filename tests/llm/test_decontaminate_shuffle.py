"""Decontamination against more windows than are broadcast."""

import random

from gatewatch.llm import decontaminate as D
from test_corpus_operators import ODD, brute_contamination, docs


def run(spark, rows, items, limit):
    got = D.contaminated(docs(spark, rows, extra=True), spark.createDataFrame(items, "item_id long, text string"), broadcast_rows=limit)
    return sorted((str(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in got.collect())


def test_shuffle_form_equals_brute_force(spark):
    rng = random.Random(9)
    words = ["Alpha", "beta", "é", "x9", "the", "the", "the"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.choice([3, 5, 10, 12, 30]))) for i in range(12)] + [(3, "beta-beta, BETA"), (None, "é é é é"), (20, ""), (21, None), (2, text(11))]
    rows = [(i, text(60)) for i in range(30)] + [(100 + i, "zz " + (items[i][1] or "").upper().replace(" ", "! ") + " zz") for i in range(12)]
    rows += [(200 + i, t) for i, t in enumerate(ODD)] + [(0, "the the"), (0, "the the"), (None, items[0][1])]
    want = brute_contamination(rows, items)
    assert run(spark, rows, items, 0) == want == run(spark, rows, items, 200_000)
    assert run(spark, [], items, 0) == [] and run(spark, rows, [], -1) == brute_contamination(rows, [])


def test_no_words_are_shuffled(spark):
    rng = random.Random(9)
    items = [(i, " ".join(f"w{rng.randrange(500)}" for _ in range(30))) for i in range(20)]
    rows = [(i, " ".join(f"w{rng.randrange(500)}" for _ in range(200)) + " " + items[i % 20][1]) for i in range(40)]
    found = D.contaminated(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"), broadcast_rows=0)
    plan = found._jdf.queryExecution().optimizedPlan()
    from pyspark.sql import functions as F
    assert found.where("n_hit >= 30").count() == 40
    # below the join on shingles, what is dealt by shingle has no array
    tree = plan.toString()
    joins = [x for x in tree.split("\n") if "Join Inner" in x and "shingle" in x]
    assert joins and found.select(F.size("items")).count() == 40
    low = tree[tree.index(joins[0]):]
    side = next(x for x in low.split("\n") if "Project" in x and "pos#" in x and "shingle#" in x)
    assert "__w#" not in side.split("[")[1].split("AS n_words")[0].replace("size(__w#", "")
