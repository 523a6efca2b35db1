"""Wrappers on hard pages: nothing of an article is lost, memory and time stay in proportion."""

import random
import time
from functools import lru_cache

from gatewatch.llm import html_extract as H

PAGES = "page_id long, url string, html string"


def extracted(spark, rows, partitions=1, host=lambda i: "h.example"):
    df = spark.createDataFrame([(i, f"http://{host(i)}/x", h) for i, h in enumerate(rows)], PAGES).repartition(partitions)
    return [r.text for r in H.extract(df).orderBy("page_id").collect()]


def recipe(i):
    return (f"<body><nav><a href=/>Home</a></nav><article><h1>Dish {i}</h1><p>A dish of the house, number {i}, and how to make it at home.</p><h2>Ingredients</h2><ul><li>{i} eggs</li>"
            f"<li>Salt</li></ul><h2>Method</h2><p>Beat {i} times and fry.</p><ul><li>Enjoy</li></ul></article><footer>f</footer></body>")


def test_recipes_keep_headings_and_list_items(spark):
    want = [f"Dish {i}\nA dish of the house, number {i}, and how to make it at home.\nIngredients\n{i} eggs\nSalt\nMethod\nBeat {i} times and fry.\nEnjoy" for i in range(6)]
    assert extracted(spark, [recipe(i) for i in range(6)]) == want


def test_questions_and_reference_pages_keep_their_lines(spark):
    def faq(i):
        return (f"<body><main><h1>Help {i}</h1><dl><dt>What is it?</dt><dd>Thing {i} of the list, with its own words.</dd><dt>What does it cost?</dt><dd>{i} a month</dd>"
                f"<dt>Can I stop?</dt><dd>Yes.</dd></dl><div class=related-box><ul><li><a href=/a>All of our help pages</a></li></ul></div><p class=press>Example press.</p></main></body>")
    got = extracted(spark, [faq(i) for i in range(5)])
    assert got == [f"Help {i}\nWhat is it?\nThing {i} of the list, with its own words.\nWhat does it cost?\n{i} a month\nCan I stop?\nYes." for i in range(5)]

    def api(i):
        return f"<body><article><h1>call_{i}</h1><h2>Parameters</h2><p>None</p><h2>Returns</h2><p>A value of kind {i}.</p><h2>Errors</h2><p>None</p></article></body>"
    assert extracted(spark, [api(i) for i in range(5)]) == [f"call_{i}\nParameters\nNone\nReturns\nA value of kind {i}.\nErrors\nNone" for i in range(5)]


def irregular(seed, n):
    rng = random.Random(seed)
    tags = ["p", "div class=a", "div class=b", "li", "h2", "section class=q", "blockquote"]
    out = []
    for k in range(n):
        t = rng.choice(tags)
        out.append(f"<{t}>text {seed} {k} {rng.randrange(1000)}</{t.split()[0]}>")
    return "".join(out)


def test_deep_and_long_pages_take_seconds(spark):
    began = time.time()
    page = H.Page("<div>x" * 100_000)
    assert len(page.blocks) == 100_000 and len({p for p, _, _, _ in page.blocks}) == H.MAX_DEPTH
    H.Page("<div>" * 50_000 + "</section>" * 50_000 + "</b>" * 50_000 + "z")
    a, b = (H.page_wrapper(H.Page(irregular(s, 50_000))) for s in (1, 2))
    both = H.align(a, b)
    assert len(both) >= max(len(a), len(b)) // 2 and time.time() - began < 40
    got = extracted(spark, ["<div>x" * 20_000, irregular(3, 8_000), irregular(4, 8_000), "<p>end"])
    assert got[0].count("x") == 20_000 and got[1].count("\n") == 7_999 and got[2].count("\n") == 7_999 and got[3] == "end"


def test_result_does_not_depend_on_partitions(spark):
    def post(i):
        extra = "".join(f"<div class=k{chr(97 + k)}><p>Option {k}</p></div>" for k in range(26) if (i >> (k % 6)) & 1)
        return (f"<body><div class=top><p>The example daily</p></div><div class=body><h1>Title {i}</h1><p>Words of page {i} and more of them.</p></div>{extra}"
                f"<div class=low><p>Printed by the press</p></div></body>")
    rows = [post(i) for i in range(90)]
    host = lambda i: f"h{i % 3}.example"
    one = extracted(spark, rows, 1, host)
    assert one == extracted(spark, rows, 64, host)
    assert all(t.startswith(f"Title {i}\nWords of page {i}") and "press" not in t for i, t in enumerate(one))


def lcs(a, b):
    @lru_cache(maxsize=None)
    def best(i, j):
        if i == len(a) or j == len(b):
            return 0
        return 1 + best(i + 1, j + 1) if a[i] == b[j] else max(best(i + 1, j), best(i, j + 1))
    return best(0, 0)


def test_alignment_against_the_longest_common_subsequence():
    rng = random.Random(6)
    near = total = 0
    for _ in range(300):
        tokens = [f"t{i}" for i in range(30)]
        a = [t for t in tokens if rng.random() < 0.7]
        b = [t for t in tokens if rng.random() < 0.7]
        pairs = H._common(a, b)  # no token twice: the alignment is the longest one
        assert len(pairs) == lcs(tuple(a), tuple(b))
        a = [rng.choice("abcdefgh") for _ in range(rng.randrange(25))]
        b = [rng.choice("abcdefgh") for _ in range(rng.randrange(25))]
        pairs = H._common(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        near, total = near + len(pairs), total + lcs(tuple(a), tuple(b))
    assert near > 0.6 * total


def brute_fold(keys):
    out, i = [], 0
    while i < len(keys):
        p = next((p for p in range(1, (len(keys) - i) // 2 + 1) if keys[i:i + p] == keys[i + p:i + 2 * p]), None)
        if p is None:
            out.append((keys[i], 0))
            i += 1
            continue
        unit, j = keys[i:i + p], i + p
        while keys[j:j + p] == unit:
            j += p
        out += [(k, H.REPEATED) for k in unit]
        i = j
    return out


def test_repeats_of_any_length():
    rng = random.Random(7)
    for _ in range(400):
        unit = [rng.choice("abcde") for _ in range(rng.randrange(1, 5))]
        keys = [rng.choice("abcde") for _ in range(rng.randrange(6))] + unit * rng.randrange(1, 4) + [rng.choice("abcde") for _ in range(rng.randrange(6))]
        got = [(e[0], e[5]) for e in H.fold_repeats([[k, None, 1, 0, 0, 0] for k in keys])]
        assert got == brute_fold(keys)
    long = [f"t{i}" for i in range(500)] * 3
    assert len(H.fold_repeats([[k, None, 1, 0, 0, 0] for k in long])) == 500


def test_archive_reader_tasks_follow_the_bytes(spark, monkeypatch):
    from pyspark.sql import functions as F

    from gatewatch.llm import warc
    monkeypatch.setattr(warc, "TASK", 2_000)
    rows = spark.range(300).select(F.col("id").alias("page_id"), F.lit("http://a/b").alias("url"), F.when(F.col("id") % 3 > 0, F.repeat(F.sha2(F.col("id").cast("string"), 256), 20)).alias("html"))
    index = warc.write_archives(rows.repartition(2))
    got = warc.read_records(index)
    tasks = got.select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks >= 8
    kinds = {r["record_type"]: r["n"] for r in got.groupBy("record_type").agg(F.count("*").alias("n")).collect()}
    assert kinds == {"response": 201, "revisit": 99}
    plan = warc.typed(rows)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning(payload_digest" not in plan


def _stream(s):
    return [[k, None, 1, 0, 0, 0] for k in s]


def test_lists_of_lists_fold_to_one_group():
    """u(i)+ of different lengths: the inner repetitions first, then the outer one."""
    got = H.fold_nested(_stream("uiiuiiiuix"))
    assert [e[0] for e in got] == ["u", "i", "x"]
    assert [bool(e[5] & H.REPEATED) for e in got] == [True, True, False]
    assert [e[0] for e in H.align(H.fold_nested(_stream("uiiuiiix")), H.fold_nested(_stream("uiuiix")))] == ["u", "i", "x"]


def test_a_long_wrapper_keeps_what_one_page_has():
    """An optional element of one page in 40 stays, also in a wrapper of over 20,000 elements."""
    long = [[f"<{i}", None, 40, 0, 0, 0] for i in range(21_000)]
    got = H.align(long, [[*e[:2], 1, 0, 0, 0] for e in long[:100]] + [["<rare", None, 1, 0, 0, 0]] + [[*e[:2], 1, 0, 0, 0] for e in long[100:]])
    assert "<rare" in [e[0] for e in got] and len(got) == 21_001


def test_slots_are_data_however_many_pages_share_their_text(spark):
    """Seven of ten pages share a text that the wrapper has as a slot; the fixed texts and the menu go."""
    def who(i):
        return "Ann" if i < 7 else "Bob"

    def post(i):
        menu = "".join(f"<li>{x}</li>" for x in ("Start", "World", "Sport"))
        return (f"<body><div class=top><ul>{menu}</ul></div><div class=post><h1>Title {i}</h1><p class=by>Written by {who(i)}.</p><div class=body><p>Words of page {i} and more of them.</p>"
                f"</div></div><div class=low><p>Printed by the press</p></div></body>")
    want = [f"Title {i}\nWritten by {who(i)}.\nWords of page {i} and more of them." for i in range(10)]
    assert extracted(spark, [post(i) for i in range(10)]) == want == extracted(spark, [post(i) for i in range(10)], 5)

    def article(i):
        return (f"<body><article><h1>Title {i}</h1><p>Words of page {i} and more of them.</p><p class=press>Printed by the press.</p>"
                f"<div class=author><p>Written by {who(i)}.</p></div></article></body>")
    got = extracted(spark, [article(i) for i in range(10)])
    assert got == [f"Title {i}\nWords of page {i} and more of them.\nPrinted by the press.\nWritten by {who(i)}." for i in range(10)]


def test_the_wrapper_decides_what_is_template():
    pages = [f"<div class=a><p>Same</p></div><div class=b><p>{'Most' if i < 8 else i}</p></div><ul><li>One</li><li>Two</li><li>{i}</li></ul>" for i in range(10)]
    w = None
    for x in map(H.Page, pages):
        w = H.page_wrapper(x) if w is None else H.align(w, H.page_wrapper(x))
    count = {}
    for path, text, _, _ in (b for x in pages for b in H.Page(x).blocks):
        count[path, text] = count.get((path, text), 0) + 1
    common = [{"path": p, "mark": H._mark(p, t), "pages": n} for (p, t), n in count.items() if n >= 5]
    found, sure = H.template_texts(*H.structure(w, 10), common)
    assert {t for p, t in count if H._mark(p, t) in found} == {"Same", "One", "Two"} and found == sure
    few = [{**x, "pages": 2} for x in common]
    found, sure = H.template_texts(*H.structure(w, 10), few)
    assert {t for p, t in count if H._mark(p, t) in found} == {"Same"} and sure == []


def test_a_fixed_text_in_several_places_counts_as_one():
    a = [["#/p", "T", 3, 1, 0, 0], ["#/q", None, 10, 1, 0, H.SLOT], ["#/p", "T", 4, 1, 0, H.OPTIONAL]]
    assert H.structure(a, 12)[0] == [H._mark("/p", "T")] and H.structure(a, 15)[0] == []
