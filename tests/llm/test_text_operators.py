"""Operators that read one text at a time, and their edge cases, against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from gatewatch.llm import language_id, quality, secrets, token_counts

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, extra=False):
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)
    return df.withColumns({c: F.lit("x") for c in ("n_words", "failed", "__k1", "shard")}) if extra else df


ODD = [None, "", " \t\n", "a", "É ß x y", "token token token", "x" * 50_000, "word " * 30_000, "#*$ %&|<>", "\x00a\x1cb\x85c", "🙂 a🙂b"]


# -- token counts --------------------------------------------------------------

TOKENS = [bytes([b]) for b in range(256)] + [b" a", b" ab", b"abc", b"bcd", b" abcde", b"cdx", b" b", b"aa", b"aaaa", b" aaab"]


def greedy(word, tokens):
    s, n, known, longest = b" " + word, 0, set(tokens), max(map(len, tokens))
    while s:
        k = next(k for k in range(min(longest, len(s)), 0, -1) if s[:k] in known)
        s, n = s[k:], n + 1
    return n


def test_automaton_equals_greedy_longest_match():
    rng, c = random.Random(1), token_counts.Counter(token_counts.Automaton(TOKENS))
    for _ in range(3000):
        w = bytes(rng.choice(b"abcdex ") for _ in range(rng.randrange(1, 14))).replace(b" ", b"a")
        assert c[w] == greedy(w, TOKENS), w


def test_token_counts_of_odd_texts(spark):
    got = token_counts.token_counts(docs(spark, ODD, extra=True), TOKENS).orderBy("doc_id").collect()
    for r, t in zip(got, ODD, strict=True):
        words = (t or "").encode().split()
        assert (r.n_words, r.n_tokens) == (len(words), sum(greedy(w, TOKENS) for w in words))
    assert token_counts.token_counts(docs(spark, []), TOKENS).count() == 0


def test_token_counts_with_a_public_vocabulary(spark):
    tokens = token_counts.load_vocabulary(spark)
    known = token_counts.Counter(token_counts.Automaton(tokens))
    rows = token_counts.token_counts(spark.read.parquet(f"{SF}/documents.parquet"), tokens).limit(40).collect()
    known_set, longest = set(tokens), 64
    for r in rows[:10]:
        for w in (r.text or "").encode().split()[:200]:
            s, n = b" " + w, 0
            while s:
                k = next(k for k in range(min(longest, len(s)), 0, -1) if s[:k] in known_set)
                s, n = s[k:], n + 1
            assert known[w] == n
    with pytest.raises(ValueError):
        token_counts.Automaton([b"a"])


# -- quality -------------------------------------------------------------------

def brute_quality(t):
    t = t or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i:i + 8]), []).append(i)
    hit = {p for v in at.values() if len(v) > 1 for i in v for p in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(hit)


def test_quality_measures_equal_brute_force(spark):
    rng = random.Random(2)
    texts = [*ODD, *[" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(60)],
             *["\n".join(rng.choice(["a b", " a b", "", "c"]) for _ in range(20)) for _ in range(10)]]
    got = quality.ledger(docs(spark, texts, extra=True)).orderBy("doc_id").collect()
    for r, t in zip(got, texts, strict=True):
        assert tuple(r[m] for m in quality.MEASURES) == brute_quality(t), repr(t)[:80]
        n, rep = r.n_words, r.n_repeat_words
        assert bool(r.failed & quality.mask(quality.POLICIES["base"])) == (n < 20 or 100 * rep > 30 * n)
    assert quality.ledger(docs(spark, [])).count() == 0


def test_ablation_equals_applying_every_policy(spark):
    rows = quality.ledger(spark.read.parquet(f"{SF}/documents.parquet")).select("failed")
    masks = [r[0] for r in rows.collect()]
    own = quality.mask(quality.POLICIES["v2"])
    for r in quality.ablation(rows).collect():
        bit = quality.mask([r.rule])
        assert r.failing == sum(bool(m & bit) for m in masks)
        assert r.only == sum(m & own == bit for m in masks)
        assert r.kept_without == sum(not (m & own & ~bit) for m in masks)


# -- secrets -------------------------------------------------------------------

def brute_base(t):
    t, out = t or "", []
    assign = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
    for k, (kind, pattern) in enumerate((("assign", assign), ("access", r"AKIA[A-Z0-9]+"), ("hex", r"[0-9a-f]+"))):
        for m in re.finditer(pattern, t, re.A):
            n = len(m[2]) if kind == "assign" else m.end() - m.start()
            if n >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                out.append((m.start(), k, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def test_base_spans_equal_brute_force(spark):
    key = "AKIA" + "ABCD1234" * 2
    texts = [*ODD, 'é🙂 token = "24be64439e3e49cf46b2d7c90f3602a3"', "secret: token: abcdefgh", "token=token=abcdefgh token=abc", key, "xAKIA" + key, "AKIAAB " + key + "Z",
             "a" * 23 + " " + "b" * 24 + "g" + "0" * 60, "PassWord'  :  'hunter2x' api_key=123456 APIKEY:aaaaaa apikey:aaaaa", "secret=" * 9, "tokenſ: 123456 paſſword=abcdefgh"]
    got = secrets.scan(docs(spark, texts)).select("doc_id", secrets.listing("assign", "access", "hex").alias("s")).orderBy("doc_id").collect()
    for r, t in zip(got, texts, strict=True):
        assert r.s == brute_base(t), repr(t)[:80]
    real = spark.read.parquet(f"{SF}/documents.parquet")
    got = secrets.scan(real).select("doc_id", secrets.listing("assign", "access", "hex").alias("s"))
    for r in got.join(real, "doc_id").collect():
        assert r.s == brute_base(r.text)
    assert secrets.scan(docs(spark, [])).count() == 0


def test_battery_reports_random_tokens_and_clears_structured_ones(spark):
    rng = random.Random(3)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    drawn = ["".join(rng.choice(letters) for _ in range(40)) for _ in range(100)]
    plain = [f"Section{i}and{i}Section{i}and{i}Section{i}and{i}" for i in range(100)]
    word = "Ertionblethlyoushundenlich"
    rows = secrets.scan(docs(spark, [f"see {t} there" for t in [*drawn, *plain, word]])).orderBy("doc_id").collect()
    assert not rows.pop().random
    found = [bool(r.random) for r in rows]
    assert sum(found[:100]) >= 90 and sum(found[100:]) <= 5
    one = next(r for r in rows if r.random)
    assert (one.random[0].s, one.random[0].e) == (4, 44)


def test_battery_statistics(spark):
    tok = "0a" * 20
    row = spark.createDataFrame([(tok, "0123456789abcdef")], "body string, alphabet string")
    r = secrets._log_p(row).first()
    assert r.squares == 800 and r.n_up == 20 and r.runs == 40
    assert r.serial == pytest.approx(39 * (0 - 7.5) * (10 - 7.5))
    z = spark.range(1).select(secrets._tail(F.lit(1.96)).alias("a"), secrets._tail(F.lit(-1.0)).alias("b")).first()
    assert z.a == pytest.approx(0.0249979, abs=1e-6) and z.b == pytest.approx(0.8413447, abs=1e-6)


# -- language ID ---------------------------------------------------------------

def test_held_out_accuracy_and_unknown(spark):
    data = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(data)
    rows = data.select("doc_id", "lang", "text", language_id.held_out(F.col("doc_id")).alias("h"), language_id.predict_column(model, F.col("text"), spark).alias("p")).collect()
    test = [r for r in rows if r.h]
    assert len(test) > 100
    assert sum(r.p.lang == r.lang for r in test) / len(test) >= 0.97
    assert all(0 <= r.p.score <= 1 for r in rows)
    odd = docs(spark, [None, "", "123 !!", "½ ² 3", *ODD]).select(language_id.predict_column(model, F.col("text"), spark).alias("p")).collect()
    assert [r.p.lang for r in odd[:4]] == ["und"] * 4 and all(r.p.score == 0 for r in odd[:4])


def test_texts_in_no_learned_language_are_dropped(spark):
    data = spark.read.parquet(f"{SF}/documents.parquet")
    n, rng = data.count(), random.Random(3)
    scripts = ["abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω", "".join(map(chr, range(0x4E00, 0x5200)))]
    junk = ["".join(rng.choice(letters + " " * (len(letters) // 6)) for _ in range(size)) for letters in scripts for size in (60, 300, 3000, 100_000)]
    extra = spark.createDataFrame([(-1 - i, t, None, "s", 0) for i, t in enumerate(junk)], data.schema)
    got = language_id.known_language(data.unionByName(extra))
    ids = {r.doc_id for r in got.select("doc_id").collect()}
    assert len(ids) == n and min(ids) >= 0
    model = language_id.train(data)
    assert model.predict(junk) == ([language_id.UNKNOWN] * len(junk), pytest.approx([0.0] * len(junk)))


def kernel_ridge(sample, labels, texts, marks, ridge):
    """The method from its definition, with sets of n-gram features in place of bitmaps and
    matrices of kernel values in place of the folded product."""
    import numpy as np

    def kernel(a, b):
        return len(a & b) / np.sqrt(len(a) * len(b))

    sets = [set(p.tolist()) for t in sample for p in language_id.pieces(t)]
    assert len(sets) == len(sample)  # a piece each
    names = sorted(set(labels))
    chosen = [s for k in names for s in [s for s, v in zip(sets, labels, strict=True) if v == k][:marks]]
    value, vector = np.linalg.eigh(np.array([[kernel(a, b) for b in chosen] for a in chosen]))
    good = value > 1e-8 * value[-1]
    root = vector[:, good] @ np.diag(value[good] ** -0.5) @ vector[:, good].T

    def features(own):
        return np.mean([[kernel(a, b) for b in chosen] for a in own], axis=0) @ root

    phi = np.array([features([s]) for s in sets])
    weight = np.array([len(labels) / len(names) / labels.count(v) for v in labels])
    out = []
    for name in names:  # weighted ridge regression of one language against the rest
        y = np.array([1.0 if v == name else -1.0 for v in labels])
        mean_x, mean_y = np.average(phi, axis=0, weights=weight), np.average(y, weights=weight)
        x, c = phi - mean_x, weight[:, None]
        w = np.linalg.solve((c * x).T @ x + ridge * np.eye(x.shape[1]), (c * x).T @ (y - mean_y))
        out.append([(features([set(p.tolist()) for p in language_id.pieces(t)]) - mean_x) @ w + mean_y for t in texts])
    return np.array(out).T


def test_scores_equal_the_kernel_form(spark):
    import numpy as np
    rows = [r for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect() if r.text and r.lang and len(r.text) < 3000][:60]
    sample, labels = [r.text for r in rows[:45]], [r.lang for r in rows[:45]]
    bits = []
    for t in sample:
        x = np.zeros(language_id.FEATURES, np.uint8)
        x[language_id.pieces(t)[0]] = 1
        bits.append(np.packbits(x))
    model = language_id.fit(np.array(bits), labels, landmarks=4, ridge=0.1)
    texts = [r.text for r in rows[45:]] + [" ".join(r.text for r in rows)]  # the last one has many pieces
    n, scores, shares = model.means(texts)
    assert n[-1] > 5 and np.allclose(scores, kernel_ridge(sample, labels, texts, 4, 0.1), atol=2e-3)
    for k, own in enumerate(model.vocabulary):
        mean = np.mean([own[np.unique(p)].mean() for p in language_id.pieces(texts[-1])])
        assert shares[-1, k] == pytest.approx(mean, abs=1e-5)


def brute_pieces(text, size):
    """n-grams by slicing strings; the cuts are between start positions."""
    import regex
    letters = " " + regex.sub(r"[^\p{L}]+", " ", text.lower()).strip(" ") + " "
    count = -(-len(letters) // size)
    cut = [j * len(letters) // count for j in range(count)] + [len(letters)]
    return [[letters[i:i + n] for n in language_id.GRAMS for i in range(cut[j], min(cut[j + 1], len(letters) - n + 1))] for j in range(count)]


@pytest.mark.parametrize("size", [7, 64, 4096])
def test_pieces_hold_every_gram_once(monkeypatch, size):
    monkeypatch.setattr(language_id, "PIECE", size)
    for text in ["a", "ab1", "Straße, 12 Bäume\n\nund ÉTÉ", "  \u4e00\u4e8c x" * 30, "İstanbul", "x" * 500]:
        got, want = language_id.pieces(text), brute_pieces(text, size)
        seen = {}
        assert [len(p) for p in got] == [len(p) for p in want]
        for p, q in zip(got, want, strict=True):
            assert all(seen.setdefault(g, f) == f for f, g in zip(p.tolist(), q, strict=True))
    assert language_id.pieces(None) == language_id.pieces("") == language_id.pieces("12 ½²") == []


def test_long_mixed_texts_keep_their_language(spark):
    data = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model, rng = language_id.train(data), random.Random(1)
    rows = data.where(language_id.held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).collect()
    texts = []
    for lang in model.languages:
        words = [w for r in rows if r.lang == lang for w in r.text.split()]
        noise = lambda w: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in w)
        long = [noise(w) if rng.random() < 0.2 else w for w in rng.choices(words, k=150_000)]
        texts += [" ".join(long[:400]), " ".join(long)]
    names, best = model.predict(texts)
    assert min(map(len, texts[1::2])) > 400_000
    assert names == [x for v in model.languages for x in (v, v)]
    assert all(abs(a - b) < 0.1 for a, b in zip(best[::2], best[1::2], strict=True))


def test_no_labels_and_no_rows(spark):
    none = spark.createDataFrame([(1, "abc", None, "s", 3)], DOCS)
    model = language_id.train(none)
    assert none.select(language_id.predict_column(model, F.col("text"), spark).alias("p")).first().p.lang == "und"
    assert language_id.known_language(none).count() == 0
    assert language_id.known_language(docs(spark, [])).count() == 0


def test_held_out_is_the_crc_rule(spark):
    import zlib
    rows = spark.range(50).select("id", language_id.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)
