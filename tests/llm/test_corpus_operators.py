"""Operators that compare or move rows, and their edge cases, against brute force."""

import base64
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gatewatch.llm import decontaminate, graph, html_extract, mixing, sharding, simhash, warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " \t\n", "a", "É ß x y", "x" * 50_000, "word " * 5_000, "🙂 a🙂b"]


def docs(spark, rows, extra=False):
    """rows: texts or (doc_id, text) or (doc_id, text, source)."""
    full = [((i, r) if not isinstance(r, tuple) else r) for i, r in enumerate(rows)]
    df = spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0) for r in full], DOCS)
    return df.withColumns({c: F.lit("x") for c in ("fp", "root", "component_id", "shard", "size", "target", "words", "key", "copies")}) if extra else df


# -- near-dedup ----------------------------------------------------------------

def brute_fingerprint(t):
    low = "".join(c.lower() if c.isascii() else c for c in t or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, radius=4):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                root[find(i)] = find(j)
    out = {}
    for i in range(len(fps)):
        out.setdefault(find(i), []).append(ids[i])
    low = {k: min((x for x in v if x is not None), default=None) for k, v in out.items()}
    return [low[find(i)] for i in range(len(fps))]


def test_bit_sliced_pairs_equal_brute_force():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**64, 30, dtype=np.uint64)
    fp = np.array([int(b) ^ sum(1 << int(x) for x in rng.choice(64, int(rng.integers(0, 8)), replace=False)) for b in base for _ in range(9)], np.uint64)
    n = len(fp)
    for radius in (0, 1, 4, 7):
        got = {(int(a), int(b)) for x, y in simhash.close_pairs(fp, np.arange(n) + 1, np.full(n, n), radius) for a, b in zip(x, y, strict=True)}
        assert got == {(i, j) for i in range(n) for j in range(i + 1, n) if bin(int(fp[i]) ^ int(fp[j])).count("1") <= radius}


@pytest.mark.parametrize("chunk", [4096, 5])
def test_links_connect_what_brute_force_connects(spark, chunk):
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = sorted({b ^ sum(1 << x for x in rng.sample(range(64), rng.randrange(6))) for b in base for _ in range(15)} | {0, 1, 2**64 - 1})
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    rows = spark.createDataFrame([(x,) for x in signed], "fp long")
    roots = {r.node: r.root for r in graph.components(simhash.fingerprint_links(rows, chunk=chunk)).collect()}
    want = brute_components(signed, fps)
    got = {}
    for s, w in zip(signed, want, strict=True):
        assert got.setdefault(roots.get(s, s), w) == w
    assert len(got) == len(set(want))


def test_near_duplicates_of_documents_and_odd_texts(spark):
    real = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = real + [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "lonely text of an unknown id here"), (1002, "A"), (7, real[7][1])]
    got = simhash.near_duplicates(docs(spark, rows, extra=True))
    fps = [brute_fingerprint(t) for _, t in rows]
    want = sorted(zip([str(r[0]) for r in rows], fps, map(str, brute_components([r[0] for r in rows], fps)), strict=True))
    have = sorted((str(r.doc_id), int(r.h, 16), str(r.component_id)) for r in got.select("doc_id", "component_id", simhash.fingerprint_hex(F.col("fp")).alias("h")).collect())
    assert have == want
    kept = [r.doc_id for r in simhash.one_of_each_group(docs(spark, rows, extra=True)).collect()]
    comps = [c for _, _, c in want]
    assert len(kept) == len(set(comps)) and {str(k) for k in kept} == {c if c != "None" else "None" for c in comps}
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1050)] + [(2000, 2000)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {i: 1000 for i in range(1001, 1050)}


@pytest.mark.parametrize("hub", [0, 3, 200])
def test_components_with_hubs_equal_brute_force(spark, monkeypatch, hub):
    monkeypatch.setattr(graph, "HUB_LINKS", hub)
    rng = random.Random(hub)
    links = [(0, i) for i in range(1, 500)] + [(9000, 5000 + i) for i in range(400)] + [(7000 + i, 5000 + i) for i in range(0, 400, 7)]
    links += [(rng.randrange(600, 900), rng.randrange(600, 900)) for _ in range(160)] + links[:50]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    odd = [(None, 3), (4, None), (None, None), (8000, 8000)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links + odd, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def test_the_links_of_a_hub_are_not_shuffled_by_node(spark):
    from gatewatch.session import materialize
    rows = materialize(spark.createDataFrame([(7, i) for i in range(5000)] + [(i, 7) for i in range(3000)], "u long, v long"), "hub")
    spread = graph._with_least(rows, F.min("v"), 8000)
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and spread.count() == 8000
    assert spread.where("u = 7 and m = 0").count() == 5001 and spread.where("u <> 7 and m = 7").count() == 2999


# -- decontamination -----------------------------------------------------------

def brute_contamination(rows, items):
    def words(t):
        low = "".join(c.lower() if c.isascii() else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    win = {}
    for item, t in items:
        w = words(t)
        k = min(10, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            win.setdefault(tuple(w[i:i + k]), set()).add(item)
    out = []
    for doc, t in rows:
        w, hit, ids = words(t), set(), set()
        for k in {len(x) for x in win}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in win:
                    hit |= set(range(i, i + k))
                    ids |= {str(x) for x in win[tuple(w[i:i + k])] if x is not None}
        out.append((str(doc), len(w), len(hit), sorted(ids)))
    return sorted(out)


def run_contamination(spark, rows, items):
    got = decontaminate.contaminated(docs(spark, rows, extra=True), spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1)))
    return sorted((str(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in got.collect())


def test_contamination_equals_brute_force(spark):
    rng = random.Random(7)
    words = ["Alpha", "beta", "é", "x9", "the", "the", "the"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.choice([3, 5, 10, 12, 30]))) for i in range(12)] + [(3, "beta-beta, BETA"), (None, "é é é é"), (20, ""), (21, None), (22, "..."), (2, text(11))]
    rows = [(i, text(60)) for i in range(30)] + [(100 + i, "zz " + (items[i][1] or "").upper().replace(" ", "! ") + " zz") for i in range(12)]
    rows += [(200 + i, t) for i, t in enumerate(ODD)] + [(0, "the the"), (0, "the the"), (None, items[0][1])]
    assert run_contamination(spark, rows, items) == brute_contamination(rows, items)


def test_long_items_only_and_empty_sides(spark):
    items = [(1, " ".join(f"w{i}" for i in range(25)))]
    rows = [(1, " ".join(f"w{i}" for i in range(5, 30))), (2, " ".join(f"w{i}" for i in range(9))), (3, "q " * 12 + " ".join(f"w{i}" for i in range(3, 14)))]
    assert run_contamination(spark, rows, items) == brute_contamination(rows, items)
    assert run_contamination(spark, rows, []) == brute_contamination(rows, [])
    assert run_contamination(spark, [], items) == []
    kept = decontaminate.clean_documents(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert [r.doc_id for r in kept] == [2]


# -- mixing --------------------------------------------------------------------

def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped = {}
    while True:
        left = sum(sizes.values()) - sum(capped.values())
        free = [s for s in names if s not in capped]
        total = sum(weight[s] for s in free)
        over = {s: 3 * sizes[s] for s in free if left * weight[s] / total > 3 * sizes[s]}
        if not over:
            return capped | {s: left * weight[s] / total for s in free}
        capped |= over


def test_targets_equal_iterated_resharing(spark):
    rng = random.Random(8)
    for n in (1, 2, 5, 9):
        sizes = {f"s{i}": rng.choice([0, 3, 50, 1000, 40_000]) for i in range(n)} | ({None: 7} if n > 2 else {})
        got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
        want = brute_targets(sizes)
        assert {r.source: pytest.approx(r.target) for r in got} == want


def test_mix_reaches_targets_repeats_and_is_stable(spark):
    rng = random.Random(9)
    rows = [(i, "w " * rng.randrange(40), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(1500)]
    rows += [(5000 + i, t, "b") for i, t in enumerate(ODD)] + [(None, "q q q", "a"), (3, rows[3][1], rows[3][2]), (3, rows[3][1], rows[3][2])]
    table = docs(spark, rows, extra=True)
    quality = spark.createDataFrame([(i, i % 2) for i in range(800)] + [(3, 0), (None, 1)], "doc_id long, quality int")
    once = mixing.mix(table, quality).select("doc_id", "source", "size", "source_size", "target", "taken", "copies").collect()
    again = mixing.mix(table.repartition(5), quality).select("doc_id", "source", "size", "source_size", "target", "taken", "copies").collect()
    assert sorted(map(str, once)) == sorted(map(str, again)) and len(once) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes)
    for s in sizes:
        own = [r for r in once if r.source == s]
        largest = max(r.size for r in own)
        assert own[0].source_size == sizes[s] and own[0].target == pytest.approx(want[s])
        assert abs(sum(r.taken for r in own) - want[s]) <= max(largest, 3 * 40) / 2 + 40
        assert all(r.taken <= 3 * r.size and r.taken == r.copies * r.size for r in own)
        assert max(r.copies for r in own if r.size) - min(r.copies for r in own if r.size) <= 1
    out = mixing.mixed_documents(table, quality)
    assert out.columns == table.columns and out.count() == sum(r.copies for r in once)
    assert mixing.mix(docs(spark, [])).count() == 0


def test_better_documents_are_drawn_more_often(spark):
    rows = [(i, "w w w w", "a") for i in range(3000)] + [(9000 + i, "w", "b") for i in range(9000)]
    quality = spark.createDataFrame([(i, int(i < 1500)) for i in range(3000)], "doc_id long, quality int")
    got = mixing.mix(docs(spark, rows), quality).where("source = 'b' or source = 'a'").collect()
    a = [r for r in got if r.source == "a"]
    low = min(r.copies for r in a)
    good, bad = (sum(r.copies - low for r in a if (r.doc_id < 1500) == g) for g in (True, False))
    assert good > bad


# -- sharding ------------------------------------------------------------------

def brute_shards(rows, limit):
    bits = [f"{int(hashlib.md5(('' if i is None else str(i)).encode() + b'|' + (t or '').encode()).hexdigest()[:15], 16):060b}" for i, t in rows]
    size = [len((t or "").encode()) for _, t in rows]
    out = []
    for b in bits:
        for k in range(61):
            own = [s for o, s in zip(bits, size, strict=True) if o[:k] == b[:k]]
            if sum(own) <= limit or len(own) == 1:
                out.append(b[:k])
                break
        else:
            out.append(None)
    return out


@pytest.mark.parametrize("limit", [1, 2000, 60_000, 1 << 40])
def test_shards_equal_brute_force(spark, limit):
    rng = random.Random(10)
    rows = [(i, "x" * rng.randrange(900)) for i in range(300)] + [(None, None), (500, "y" * 70_000)]
    got = {r.doc_id: r for r in sharding.shard(docs(spark, rows, extra=True), limit).collect()}
    for (i, t), s in zip(rows, brute_shards(rows, limit), strict=True):
        assert got[i].shard == s and got[i].shard_depth == len(s) and got[i].shard_bytes_row == len(t or "")
    assert sharding.shard(docs(spark, []), limit).count() == 0


def test_a_hot_repeated_row_is_split(spark):
    rows = [(1, "same text")] * 4000 + [(i, "other") for i in range(2, 300)]
    got = sharding.shard(docs(spark, rows), 900)
    assert got.count() == len(rows)
    size = got.groupBy("shard").agg(F.sum("shard_bytes_row").alias("b")).collect()
    assert max(r.b for r in size) <= 900


def test_shards_of_a_small_limit_shuffle_no_text(spark):
    rows = [(i, "x" * (i % 700)) for i in range(3000)] + [(5000, "copy")] * 600
    got = sharding.shard(docs(spark, rows), 300)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert got.where("shard_depth > 12").count() > 0 and got.count() == len(rows)


def test_a_directory_beyond_the_broadcast_bound_gives_the_same_shards(spark, monkeypatch):
    rows = [(i, "x" * (i % 700)) for i in range(500)]
    want = sorted(sharding.shard(docs(spark, rows), 2000).select("doc_id", "shard").collect())
    monkeypatch.setattr(sharding, "MAX_LEAVES", 0)
    assert sorted(sharding.shard(docs(spark, rows), 2000).select("doc_id", "shard").collect()) == want


def test_the_bits_of_copies_are_stored_once(spark):
    """Reading the result twice, dealt anew, gives every row of a group of copies the same shard."""
    rows = spark.createDataFrame([(1, "same text", i) for i in range(500)], "doc_id long, text string, n int")
    got = sharding.shard(rows.repartition(7), 90)
    first = {r.n: r.shard for r in got.collect()}
    assert {r.n: r.shard for r in got.repartition(3).collect()} == first and len(set(first.values())) >= 50


# -- WARC ----------------------------------------------------------------------

PAGES = "page_id long, url string, html string"


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a/1", "<p>é</p>\r\n\r\nWARC/1.1"), (2, "http://a/2", "<p>b</p>"), (5, None, "<p>b</p>"), (3, "u\r\nv", ""), (4, "http://a/4", None),
            (None, "http://n", "<p>n</p>"), (7, "http://a/7", "z" * 300_000), (7, "http://a/7", "z" * 300_000), (6, "", "z" * 300_000)]
    pages = spark.createDataFrame(rows, PAGES).withColumn("type", F.lit("x")).withColumn("offset", F.lit(1))
    index = warc.write_archives(pages, f"file://{tmp_path}/w", limit=100)
    assert index.count() == len(rows) and index.select("file").distinct().count() > 1
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_records(index).collect())
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        same = [j for j, _, g in rows if (g or "").encode() == raw]
        best = max((j for j in same if j is not None), default=None)
        want.append((str(i), len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if i == best else "revisit", None if i == best else best))
    assert got == sorted(want)
    texts = {r.page_id: bytes(r.payload) for r in warc.read_records(index.where("type = 'response'")).collect()}
    assert texts[1] == rows[0][2].encode() and texts[4] == b""
    assert [r.page_id for r in warc.read_records(index.where("page_id = 2")).collect()] == [2]
    big = warc.write_archives(pages, f"file://{tmp_path}/x", least_bytes=100)
    assert {r.page_id: r.record_type for r in warc.read_records(big.where("page_id < 6")).collect()} == dict.fromkeys([1, 2, 3, 4, 5], "response")
    assert warc.write_archives(spark.createDataFrame([], PAGES), f"file://{tmp_path}/e").count() == 0


def test_archives_are_plain_gzip_members(spark, tmp_path):
    import gzip
    import pathlib
    pages = spark.createDataFrame([(i, f"http://a/{i}", f"page {i}") for i in range(50)], PAGES)
    warc.write_archives(pages, f"file://{tmp_path}/w").count()
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in pathlib.Path(f"{tmp_path}/w").glob("*.warc.gz"))
    assert raw.count(b"WARC-Type: response") == 50 and raw.endswith(b"\r\n\r\n")


def test_ranges_are_coalesced():
    assert list(warc.ranges([(0, 10), (10, 10), (25, 5), (500, 1)], gap=10, most=100)) == [(0, 30, [0, 1, 2]), (500, 501, [3])]
    assert list(warc.ranges([(0, 60), (60, 60)], gap=10, most=100)) == [(0, 60, [0]), (60, 120, [1])]
    assert list(warc.ranges([])) == []


# -- HTML ----------------------------------------------------------------------

def page(body, nav="<nav><a href=/>Home</a></nav>"):
    return f"<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body>{nav}{body}<footer>&copy; x</footer></body></html>"


def texts(spark, rows):
    df = spark.createDataFrame([(i, "http://h.example/x", h) for i, h in enumerate(rows)], PAGES).withColumn("text", F.lit("x")).withColumn("host", F.lit("y"))
    return [r.text for r in html_extract.extract(df).orderBy("page_id").collect()]


def test_article_pages(spark):
    got = texts(spark, [
        page("<div class=ad>Buy</div><article><h1>One &amp; two</h1><p><b>A  b\n c.<br><p>D&eacute;f<p>last</article>"),
        page("<main><p>x</p><aside>no</aside><div class='comments'><p>me too</p></div><script>var t='</p>';</script><p>y&nbsp; z</p><form>f<p>g</p></form></main>"),
        page("<article><p>cut &am"), None, "", "no tags & all", "<p>&lt;b&gt;</p>"])
    assert got == ["One & two\nA b c.\nDéf\nlast", "x\ny z", "cut &am", "", "", "no tags & all", "<b>"]


def test_wrapper_finds_the_main_element_and_template_texts(spark):
    def body(i):
        links = "".join(f"<li><a href=/{k}>story {i} {k} of many words here</a></li>" for k in range(4))
        return (f"<div class=top><p>Example daily, the paper</p></div><div class=content><h2>Title {i}</h2>" + "".join(f"<p>Paragraph {i}.{k} with its own words.</p>" for k in range(i % 3 + 1))
                + f"<p class=credit>Printed by the example press.</p></div><div class=box><ul>{links}</ul></div>")
    rows = [page(body(i)) for i in range(9)]
    got = texts(spark, rows)
    for i, t in enumerate(got):
        assert t == "\n".join([f"Title {i}", *[f"Paragraph {i}.{k} with its own words." for k in range(i % 3 + 1)]])


def test_headline_and_intro_beside_the_body_stay(spark):
    def post(i):
        return (f"<div class=post><h1>Title {i}</h1><div class=intro><p>Intro {i}.</p></div><div class=body><p>{f'long {i} ' * 60}</p></div>"
                f"<div class=part><p>Part {i}.</p></div></div><div class=box><ul><li><a href=/{i}>story {i} of many</a></li></ul></div>")
    got = texts(spark, [page(post(i)) for i in range(6)])
    assert got == [f"Title {i}\nIntro {i}.\n{(f'long {i} ' * 60).strip()}\nPart {i}." for i in range(6)]


def test_template_texts_inside_article_go_and_copies_stay(spark):
    def body(i):
        return f"<article><h1>Title {i}</h1><p>Story {i} has its own words, and a few more.</p><p class=credit>Printed by the press.</p><div class=most-read><p>Most read</p></div></article>"
    got = texts(spark, [page(body(i)) for i in range(6)])
    assert got == [f"Title {i}\nStory {i} has its own words, and a few more." for i in range(6)]
    same = texts(spark, [page(body(1))] * 4)
    assert same == ["Title 1\nStory 1 has its own words, and a few more.\nPrinted by the press.\nMost read"] * 4
    near = texts(spark, [page(f"<article><h1>Title</h1><p>{'The same words. ' * 9}</p><p>Mine {i}.</p></article>") for i in range(4)])
    assert all(t.startswith("Title\nThe same words.") and t.endswith(f"Mine {i}.") for i, t in enumerate(near))


def test_counts_go_on_when_a_wrapper_is_full(spark):
    first = page("<section>" + "".join(f"<div class=k{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}><p>Long {i}</p></div>" for i in range(1100)) + "</section>")
    def later(i):
        return page(f"<div class=post><p>Body {i} with words of its own.</p></div><div class=press><p>By the example press.</p></div>")
    df = spark.createDataFrame([(i, "http://full.example/x", first if i == 0 else later(i)) for i in range(9)], PAGES).coalesce(1)
    got = [r.text for r in html_extract.extract(df).orderBy("page_id").collect()]
    assert got[0] == "\n".join(f"Long {i}" for i in range(1100))
    assert got[1:] == [f"Body {i} with words of its own." for i in range(1, 9)]


def test_main_element_of_a_boilerplate_name_is_read(spark):
    got = texts(spark, [page(f"<div class='page overlay'><p>Body {i} with words of its own.</p></div>") for i in range(5)])
    assert got == [f"Body {i} with words of its own." for i in range(5)]


def test_class_names_drop_whole_tokens_and_no_frame_of_the_main_text(spark):
    article = "<article><p>One.</p><p>Two.</p></article>"
    frames = ["layout has-sidebar", "content no-sidebar", "page-header-fixed", "post-with-comments", "ad-free", "layout sidebar"]
    got = texts(spark, [page(f"<div class='{c}'>{article}</div>") for c in frames] + [page(f"<form id=f>{article}<p class=menu>x</p></form>")])
    assert got == ["One.\nTwo."] * 7
    got = texts(spark, [
        page("<article><p>Post.</p></article><article class='comment even'><p>Me too.</p></article>"),
        page("<article><p>Post 2.</p><div class=comments><article><p>Inner.</p></article></div></article>"),
        page("<main><p>Post 3.</p></main><div class=comments><article><p>Said.</p></article></div>"),
        page("<div class='body'><p>Post 4.</p></div><article class=comment><p>Also.</p></article>")])
    assert got == ["Post.", "Post 2.", "Post 3.", "Post 4."]


def test_alignment_gives_repeats_optionals_and_slots():
    a, b = (html_extract.page_wrapper(html_extract.Page(page(x))) for x in ("<div><p>t</p><p>u</p><p>v</p></div>", "<div><p>t</p></div><section><p>w</p></section>"))
    w = {e[0]: e for e in html_extract.align(a, b)}
    text = next(e for k, e in w.items() if k.endswith("div/p") and k[0] == "#")
    assert text[5] & html_extract.REPEATED and text[5] & html_extract.SLOT
    assert next(e for k, e in w.items() if k == "</html/body/section" or k.endswith("<section") or k.startswith("<") and k.endswith("section"))[5] & html_extract.OPTIONAL


def test_broken_markup_and_long_pages_do_not_fail(spark):
    rng = random.Random(11)
    bits = ["<p>", "</p>", "<div class='a", "<a href=\"", "'>", "<!--", "-->", "<b", "text ", "&#x41;", "&#xD800;", "<script>", "</div></div>", "<li>", "<table><tr><td>", "\x00", ">"]
    rows = ["".join(rng.choice(bits) for _ in range(rng.randrange(80))) for _ in range(150)] + ["<div>" * 3000 + "deep", "<p>x " * 20_000, "<a '" * 3000]
    got = texts(spark, rows)
    assert len(got) == len(rows) and all(t is not None for t in got)
    assert got[-2] == "\n".join(["x"] * 20_000)
    assert html_extract.extract(spark.createDataFrame([], PAGES)).count() == 0
