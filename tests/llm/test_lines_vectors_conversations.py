"""Line dedup, vector codes and conversation repair against brute force, with odd inputs."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gatewatch.llm import conversation as C
from gatewatch.llm import line_dedup as L
from gatewatch.llm import vector_codes as V

# -- line dedup ----------------------------------------------------------------

BLANKS = " \t\n\x0b\x0c\r"


def line_key(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(BLANKS))


def brute_lines(rows, min_docs, min_chars=1, keep="none"):
    """(id, text) rows -> (id, n_lines, n_dropped, kept text) sorted."""
    docs, first = defaultdict(set), {}
    for doc in set(rows):
        for pos, line in enumerate((doc[1] or "").split("\n")):
            docs[line_key(line)].add(doc)
            place = ((doc[0] is None, doc[0] or 0), doc, pos)
            first[line_key(line)] = min(first.get(line_key(line), place), place, key=lambda p: (p[0], p[2] if p[1] == doc else 0))
    out = []
    for doc in rows:
        lines = (doc[1] or "").split("\n")
        kept = []
        for pos, line in enumerate(lines):
            k = line_key(line)
            common = len(k) >= min_chars and len(docs[k]) >= min_docs
            if not common or (keep == "first" and first[k][1:] == (doc, pos)):
                kept.append(line)
        out.append((str(doc[0]), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def line_rows():
    rng = random.Random(4)
    pool = ["Share this", " share THIS \t", "ÉTÉ", "été", "", "  ", "x", "\x0b pad \x0c", "🙂", "a" * 3000]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.5 else f"line {rng.randrange(60)}" for _ in range(rng.randrange(1, 12)))) for i in range(60)]
    return rows + [(100, None), (101, ""), (102, "\n"), (103, "\n\nshare this\n"), (104, "Share this\nShare this\nx\nx\nq"), (105, "one\n" * 3000),
                   (7, rows[7][1]), (7, rows[7][1]), (None, "Share this\nz\nx"), (106, " \t\r\nShare this\r")]


def lines_df(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("pos", "line", "runs", "n_lines", "h1", "first", "id", "kept_text", "a.b")})


def result(df):
    return sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_text) for r in df.collect())


@pytest.mark.parametrize("min_docs,keep", [(1, "none"), (3, "none"), (10, "none"), (3, "first")])
def test_line_dedup_equals_brute_force(spark, min_docs, keep):
    rows = line_rows()
    if keep == "first":  # one row an id: the order of equal ids is by hash
        rows = list({r[0]: r for r in rows}.values())
    df = lines_df(spark, rows).repartition(5)
    got = L.dedup_lines(df, min_docs=min_docs, keep=keep)
    assert {"pos", "runs", "a.b"} <= set(got.columns) and got.columns.count("n_lines") == 1
    assert result(got) == brute_lines(rows, min_docs, keep=keep)


def test_line_dedup_without_broadcast_is_the_same(spark):
    rows = line_rows()
    df = lines_df(spark, rows)
    bitmaps = L.keep_bitmaps(df, min_docs=3, min_chars=2, broadcast_rows=0)
    assert result(L.apply_bitmaps(df, bitmaps, broadcast_runs=-1)) == brute_lines(rows, 3, min_chars=2)


def test_line_dedup_bitmaps_are_runs_and_need_no_second_exchange(spark):
    df = spark.createDataFrame([(i, "a\na\nkeep %d\na\nb\nb" % i) for i in range(4)], "doc_id long, text string")
    runs = {tuple((r.at, r.n) for r in x.runs) for x in L.keep_bitmaps(df, min_docs=4).collect()}
    assert runs == {((0, 2), (3, 3))}
    plan = L.common_lines(L.line_hashes(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1
    # the window runs on the range partitions; the counts per hash are the only other exchange
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_line_dedup_empty_table(spark):
    assert L.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# -- vector codes --------------------------------------------------------------

def brute_codes(rows, rounds=V.ROUNDS):
    """(id, label, vector) rows -> ({(id, label, vector): (code, error)}, books)."""
    kept = [r for r in rows if r[2] is not None and all(x is not None and np.isfinite(x) for x in r[2])]
    kept = [(i, lab, tuple(int(np.floor(4096 * float(np.float32(x)))) for x in v)) for i, lab, v in kept]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    dim = len(order[0][2])
    good = [r for r in order if len(r[2]) == dim and dim % 8 == 0 and all(abs(x) <= V.largest(dim) for x in r[2])]
    d = dim // 8
    books = [[list(r[2][p * d:(p + 1) * d]) for r in good[:16]] for p in range(8)]

    def near(p, v):
        dist = [sum((a - b) ** 2 for a, b in zip(v[p * d:(p + 1) * d], c, strict=True)) for c in books[p]]
        return dist.index(min(dist)), min(dist)

    for _ in range(rounds):
        new = []
        for p in range(8):
            groups = defaultdict(list)
            for r in good:
                groups[near(p, r[2])[0]].append(r[2][p * d:(p + 1) * d])
            new.append([[sum(x) // len(x) for x in zip(*groups[e], strict=True)] if e in groups else c for e, c in enumerate(books[p])])
        books = new
    out = []
    for r in kept:
        if r in good:
            at = [near(p, r[2]) for p in range(8)]
            out.append((str(r[0]), "".join(f"{e:02x}" for e, _ in at), sum(x for _, x in at)))
        else:
            out.append((str(r[0]), None, None))
    return sorted(out, key=str), books


def vector_rows(n=300, dim=16, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, dim))
    rows = [(i, int(rng.integers(4)) if i % 9 else None, [float(x) for x in (centres[i % 7] + 0.3 * rng.normal(size=dim)).astype(np.float32)]) for i in range(n)]
    same = rows[20][2]
    rows += [(1000 + i, 1, same) for i in range(120)]  # a hot vector
    rows += [(3, 2, None), (2000, 2, [None] * dim), (2001, 2, [float("nan")] * dim), (2002, 2, [float("-inf")] + [0.0] * (dim - 1)),
             (2003, 2, [1.0]), (2004, 2, []), (2005, None, [3e38] * dim), (None, 1, rows[5][2]), (5, 0, rows[5][2]), rows[8], rows[8]]
    return rows


VECTORS = "vec_id long, label int, embedding array<float>"


def coded(codes):
    return sorted(((str(r.id), r.code, r.error) for r in codes.rows.collect()), key=str)


def test_vector_codes_equal_brute_force(spark):
    rows = vector_rows()
    df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit(1) for c in ("ref", "v", "id", "part", "error")}).repartition(4)
    codes = V.encode(df)
    want, books = brute_codes(rows)
    assert coded(codes) == want
    assert codes.books.tolist() == books


@pytest.mark.parametrize("dim", [8, 80])
def test_vector_codes_other_dimensions(spark, dim):
    rows = vector_rows(60, dim)
    codes = V.encode(spark.createDataFrame(rows, VECTORS), rounds=2)
    want, books = brute_codes(rows, 2)
    assert coded(codes) == want and codes.books.tolist() == books


def test_vector_codes_label_error(spark):
    rows = [(1, None, 5), (2, None, 6), (3, 1, 7), (4, 1, None), (5, 2, None)]
    df = spark.createDataFrame([(i, lab, "c", e) for i, lab, e in rows], "id long, label int, code string, error long")
    assert {r.id: r.label_error for r in V.with_label_error(df).collect()} == {1: 11, 2: 11, 3: 7, 4: 7, 5: None}


@pytest.mark.parametrize("rows", [[], [(1, 1, None)], [(1, 1, [1.0, 2.0])], [(1, 1, [])], [(2, 1, [0.5] * 8), (1, None, [0.25] * 8)]])
def test_vector_codes_small_tables(spark, rows):
    codes = V.encode(spark.createDataFrame(rows, VECTORS))
    got = [(r.id, r.code, r.error) for r in codes.rows.orderBy("id").collect()]
    if len(rows) == 2:
        assert got == [(1, "00" * 8, 0), (2, "01" * 8, 0)]
    elif rows and rows[0][2] == []:
        assert got == [(1, "00" * 8, 0)]
    elif rows and rows[0][2]:
        assert got == [(1, None, None)]
    else:
        assert got == []
    assert len(codes.books_sha256()) == 64


@pytest.mark.parametrize("dims,bits", [(1, 5), (2, 4), (3, 3), (8, 1)])
def test_hilbert_keys_are_a_walk_over_the_grid(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = V.hilbert_keys(grid, bits)
    walk = grid[np.argsort(keys)]
    assert sorted(keys.tolist()) == list(range(len(grid)))
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_shortlists_never_lose_the_nearest_entry_and_prune():
    rng = np.random.default_rng(0)
    left = 0
    for _ in range(300):
        book = rng.integers(-50, 50, (16, 4))
        book[5] = book[9]
        x = rng.integers(-50, 50, (1, 4)) + rng.integers(-6, 6, (40, 4))
        live = V.shortlist(x.min(0), x.max(0), book)
        at, dist = V.nearest(x, book)
        short, d2 = V.nearest(x, book[live])
        assert (live[short] == at).all() and (d2 == dist).all()
        left += len(live)
    assert left < 300 * 12


# -- conversation repair -------------------------------------------------------

def brute_repair(codes):
    """Least (cost, edits) by uniform-cost search over (edits so far)."""
    heap, done = [(0, "", 0, 0)], set()
    while heap:
        cost, edits, i, q = heapq.heappop(heap)
        if (i, q) in done:
            continue
        if i == len(codes) and q in (0, 3):
            return cost, edits
        done.add((i, q))
        nxt = {0: 2, 1: 2, 2: 3, 3: 2}[q]
        heapq.heappush(heap, (cost + 5, edits + "I", i, nxt))
        if i < len(codes):
            c = codes[i]
            heapq.heappush(heap, (cost + 2, edits + "D", i + 1, q))
            if c != "-":
                more = 5 if c.isupper() else 0
                keep = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((c.lower(), q))
                if keep is not None:
                    heapq.heappush(heap, (cost + more, edits + "K", i + 1, keep))
                heapq.heappush(heap, (cost + more + 1, edits + "R", i + 1, nxt))


def test_search_finds_the_ascii_least_cheapest_edits(monkeypatch):
    rng = random.Random(1)
    cases = ["".join(rng.choice("suaxSUAX-") for _ in range(rng.randrange(0, 10))) for _ in range(1500)]
    cases += ["".join(rng.choice("uauauauas-UA") for _ in range(rng.randrange(60, 200))) for _ in range(60)]
    for chunk in (64, 3):
        monkeypatch.setattr(C, "CHUNK", chunk)
        C.cheapest.cache_clear()
        for codes in cases:
            assert C.cheapest(codes) == brute_repair(codes), codes
    C.cheapest.cache_clear()


def test_search_of_a_very_long_conversation():
    rng = random.Random(3)
    codes = "".join("ua"[i % 2] if rng.random() < 0.85 else rng.choice("uaUAx-") for i in range(20_000))
    cost, audit = C.cheapest(codes)
    assert cost == brute_repair(codes)[0] and len(audit.replace("I", "")) == len(codes)


def brute_conversations(rows):
    """Damage and repair of (conv_id, turn, role, text) rows, one conversation at a time."""
    by, out = defaultdict(list), []
    for conv, turn, role, text in rows:
        by[conv]
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        by[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    for conv, got in by.items():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        turns = {t for t, _, _ in got if t is not None}
        seen, codes, count = set(), "", Counter()
        for _, role, text in got:
            core = text.strip(BLANKS)
            code = role[:1] if role[:1] in ("s", "u", "a") else "x"
            if not core:
                count["blank"] += 1
                code = "-"
            elif (role, text) in seen:
                count["duplicate"] += 1
                code = "-"
            elif core[-1] not in ".!?":
                count["truncated"] += 1
                code = code.upper()
            seen.add((role, text))
            codes += code
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(got, got[1:], strict=False))
        cost, audit = brute_repair(codes)
        kept, i = [], 0
        for e in audit:
            if e == "I":
                kept.append((None, ""))
            else:
                if e != "D":
                    kept.append((got[i][1] if e == "K" else None, got[i][2]))
                i += 1
        lead = bool(kept) and kept[0][0] is not None and kept[0][0][:1] == "s"
        lines = [f"{r if r is not None else ('user', 'assistant')[(j - lead) % 2]}:{t}" for j, (r, t) in enumerate(kept)]
        out.append((str(conv), max(turns) - min(turns) + 1 - len(turns) if turns else 0, count["blank"], count["duplicate"], count["truncated"],
                    illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out)


def conversation_rows():
    rng = random.Random(8)
    rows = []
    for conv in range(120):
        for turn in range(rng.choice([1, 2, 3, 5, 9, 60])):
            role = rng.choice(["system", "user", "assistant", "tool", None, ""]) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn * (2 if conv % 5 == 0 else 1), role, rng.choice(["Hi there.", "No end", "", " \t", None, "É? \n", f"t{turn}!", "…", "a. "])))
    rows += [(None, t, "user", "x.") for t in range(4)] + [(500, None, "assistant", "lost."), (500, 1, "user", "q?"), (500, 2, "assistant", "y.")]
    return rows + [(501, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(6_000)]


SPOKEN = "conv_id long, turn long, role string, text string"


def test_conversation_repair_equals_brute_force(spark):
    rows = conversation_rows()
    df = spark.createDataFrame(rows, SPOKEN).withColumns({c: F.lit("clash") for c in ("h1", "ord", "audit", "kind", "copy", "gone")}).repartition(6)
    bad = C.damaged(df)
    got = C.repaired_digests(bad, C.search_edits(bad))
    cols = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((str(r.conv_id), *[r[c] for c in cols]) for r in got.collect()) == brute_conversations(rows)


def test_repaired_rows_are_well_formed(spark):
    df = C.damaged(spark.createDataFrame(conversation_rows(), SPOKEN))
    out = defaultdict(list)
    for r in C.repaired_rows(df, C.search_edits(df)).collect():
        out[r.conv_id].append((r.position, r.role, r.text))
    assert len(out) > 40
    for rows in out.values():
        rows.sort()
        assert [p for p, _, _ in rows] == list(range(len(rows)))
        assert re.fullmatch("s?(ua)+", "".join(r[:1] for _, r, _ in rows))


def test_conversations_whose_rows_are_all_lost_and_empty_tables(spark):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = C.damaged(spark.createDataFrame([(lost, 0, "user", "a.")], SPOKEN))
    row = C.repaired_digests(df, C.search_edits(df)).first().asDict()
    assert row == {"conv_id": lost, "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "",
                   "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    none = C.damaged(spark.createDataFrame([], SPOKEN))
    assert C.repaired_digests(none, C.search_edits(none)).collect() == []
    assert C.repaired_rows(none, C.search_edits(none)).collect() == []
