"""Secret scans: base patterns plus a randomness test battery, as SQL functions only.

Base spans: assignments, access keys and hex runs (patterns below), leftmost and
non-overlapping per kind, code points, end exclusive. The battery looks at other tokens of
more than one kind of letters and digits (a capital initial aside, so words are not
judged). Each token's encoding is inferred (hex, base32, base36, base62, base64)
and its symbols are tested against a uniform random draw from that alphabet: chi-squared of
the counts, runs above and below the middle, serial correlation of neighbours. The three
p-values are combined by Fisher's method. Randomness is the null hypothesis, rejected by
Benjamini-Hochberg at level ``FDR`` among all tokens of one encoding and length class (powers
of two), as the tests' power grows with length; tokens shorter than ``MIN_BITS`` of their
encoding are not judged. What is not rejected is reported as kind ``random``, unless it
overlaps a base span, and base spans always stay.

What the level bounds: as randomness is the null hypothesis, it is the share of real random
tokens among those that are cleared. False alarms are not bounded by it: a token that the tests can't
tell from a random one is reported, mostly short ones near ``MIN_BITS``. Tokens of less (16
characters of base62 or base64, under 25 of hex, under 20 of base32 or base36) are never reported as random.

Thresholds come from counts of p-values in ``BINS`` logarithmic bins per class: a table of
bounded size, so nothing is sorted globally. One pass over the texts writes spans and
candidates of all rows (short) to the shared folder; thresholds and output read that. Null
and empty texts have no spans; repeated rows give repeated results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatewatch.llm.common import materialize

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}={0,2}"
KINDS = ("assign", "access", "hex", "random")
#: Encodings in the order in which they are tried: name, whole-token pattern, alphabet.
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    ("hex", r"\A[0-9a-f]+\z", DIGITS + "abcdef"),
    ("HEX", r"\A[0-9A-F]+\z", DIGITS + "ABCDEF"),
    ("base32", r"\A[A-Z2-7]+\z", UPPER + "234567"),
    ("base36", r"\A[0-9a-z]+\z", DIGITS + LOWER),
    ("BASE36", r"\A[0-9A-Z]+\z", DIGITS + UPPER),
    ("base62", r"\A[0-9A-Za-z]+\z", UPPER + LOWER + DIGITS),
    ("base64", r"\A[0-9A-Za-z+/]+\z", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", r"\A[0-9A-Za-z_-]+\z", UPPER + LOWER + DIGITS + "-_"),
)
MIN_BITS = 100.0
FDR = 0.05
BINS = 2000
LOG_FLOOR = -100.0
_SPANS = "array<struct<s:int,e:int>>"


def _positions(df: DataFrame, name: str, pattern: str, length_of: str | None = None, least: int = 0) -> DataFrame:
    """Adds ``name``, the spans of the pattern's matches: lengths of the pieces between and of
    the matches, summed up. ``length_of``: a group that must have ``least`` characters."""
    has = F.col("__t").rlike(pattern)
    gap, hit, part = f"__g_{name}", f"__h_{name}", f"__p_{name}"
    df = (df.withColumn(gap, F.when(has, F.transform(F.split("__t", pattern, -1), lambda x: F.length(x))))
          .withColumn(hit, F.when(has, F.regexp_extract_all("__t", F.lit(pattern), F.lit(0)))))
    df = df.withColumn(part, F.when(has, F.regexp_extract_all("__t", F.lit(pattern), F.lit(2))) if length_of else F.col(hit))
    zipped = F.arrays_zip(F.slice(gap, 1, F.size(hit)).alias("g"), F.col(hit).alias("h"), F.col(part).alias("p"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(a, x):
        s = a["at"] + x["g"]
        e = s + F.length(x["h"])
        one = F.when(F.length(x["p"]) >= least, F.array(F.struct(s.alias("s"), e.alias("e")))).otherwise(F.array().cast(_SPANS))
        return F.struct(e.alias("at"), F.concat(a["spans"], one).alias("spans"))

    spans = F.coalesce(F.when(F.col(hit).isNotNull(), F.aggregate(zipped, start, step)["spans"]), F.array().cast(_SPANS))
    return df.withColumn(name, spans).drop(gap, hit, part)


def _tail(z: Column) -> Column:
    """P(Z > z) of the standard normal (Abramowitz and Stegun 26.2.17)."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-a * a / 2) * 0.3989422804014327 * poly
    return F.greatest(F.when(z >= 0, upper).otherwise(1 - upper), F.lit(1e-300))


def _log_p(tokens: DataFrame) -> DataFrame:
    """Rows with ``tok``, ``alphabet`` -> ``logp`` of the combined battery."""
    n, size = F.col("n").cast("double"), F.length("alphabet").cast("double")
    t = tokens.withColumn("x", F.expr("transform(split(body, ''), c -> instr(alphabet, c) - 1)")).withColumn("n", F.size("x"))
    t = t.withColumn("squares", F.expr("aggregate(array_distinct(x), 0L, (a, v) -> a + 1L * size(filter(x, y -> y = v)) * size(filter(x, y -> y = v)))"))
    t = t.withColumn("up", F.expr("transform(x, v -> 2 * v >= length(alphabet))"))
    t = t.withColumn("n_up", F.expr("size(filter(up, v -> v))").cast("double"))
    t = t.withColumn("runs", F.expr("1 + aggregate(sequence(1, n - 1), 0, (a, i) -> a + if(up[i] != up[i - 1], 1, 0))").cast("double"))
    t = t.withColumn("serial", F.expr("aggregate(sequence(1, n - 1), 0D, (a, i) -> a + (x[i] - (length(alphabet) - 1) / 2D) * (x[i - 1] - (length(alphabet) - 1) / 2D))"))
    df = size - 1
    chi = F.col("squares") * size / n - n
    z_chi = (chi - df) / F.sqrt(2 * df * (n - 1) / n)
    # runs of fair coin flips: uniform symbols lie above or below the middle evenly
    z_runs = (F.col("runs") - (n + 1) / 2) / F.sqrt((n - 1) / 4)
    z_serial = F.col("serial") / ((size * size - 1) / 12 * F.sqrt(n - 1))
    both = lambda z: F.least(F.lit(1.0), 2 * _tail(F.abs(z)))
    half = -(F.log(_tail(z_chi)) + F.log(both(z_runs)) + F.log(both(z_serial)))
    # Fisher: chi-squared with 6 degrees of freedom, whose tail is closed
    return t.withColumn("logp", -half + F.log(1 + half + half * half / 2))


def _classes(tok: Column) -> Column:
    """Kinds of characters in a token after its first, so a capital initial is no kind."""
    rest = F.substring(tok, F.lit(2), F.length(tok))
    return sum((rest.rlike(p).cast("int") for p in ("[a-z]", "[A-Z]", "[0-9]")), F.lit(0))


def scan(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; others are not looked at): doc_id and arrays of spans
    assign, access, hex, random."""
    t = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("__t"))
    t = _positions(t, "assign", ASSIGN, "value", 6)
    t = _positions(t, "access", ACCESS)
    t = _positions(t, "hex", HEX)
    t = _positions(t, "cand", CANDIDATE)
    tok = F.transform("cand", lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), F.substring(F.col("__t"), c["s"] + 1, c["e"] - c["s"]).alias("tok")))
    t = t.withColumn("cand", F.filter(tok, lambda c: _classes(c["tok"]) >= 2))
    rows = materialize(t.select("doc_id", "assign", "access", "hex", "cand", F.monotonically_increasing_id().alias("__row")), "secret_spans")

    c = rows.select("__row", F.explode("cand").alias("c")).select("__row", "c.*").withColumn("body", F.rtrim(F.col("tok"), F.lit("=")))
    name, alphabet = F.lit(None).cast("string"), F.lit(None).cast("string")
    for n, pattern, letters in reversed(ENCODINGS):
        name = F.when(F.col("body").rlike(pattern), n).otherwise(name)
        alphabet = F.when(F.col("body").rlike(pattern), letters).otherwise(alphabet)
    c = c.withColumn("encoding", name).withColumn("alphabet", alphabet).where("encoding is not null")
    c = c.where(F.length("body") * F.log2(F.length("alphabet")) >= MIN_BITS)
    c = _log_p(c).select("__row", "s", "e", "encoding", F.floor(F.log2("n")).cast("int").alias("size_class"), "logp")
    c = materialize(c.withColumn("bin", F.floor(F.greatest(F.least(F.col("logp"), F.lit(0.0)) / LOG_FLOOR, F.lit(0.0)) * BINS).cast("int")), "secret_candidates")
    # Benjamini-Hochberg over bins: bin b holds p-values up to exp(LOG_FLOOR * b / BINS)
    bins = c.groupBy("encoding", "size_class", F.least("bin", F.lit(BINS)).alias("bin")).count()
    falling = Window.partitionBy("encoding", "size_class").orderBy(F.desc("bin"))
    whole = Window.partitionBy("encoding", "size_class")
    bins = bins.withColumn("cum", F.sum("count").over(falling)).withColumn("m", F.sum("count").over(whole))
    rejected = F.exp(F.col("bin") * LOG_FLOOR / BINS) <= fdr * F.col("cum") / F.col("m")
    edge = bins.where(rejected).groupBy("encoding", "size_class").agg(F.min("bin").alias("edge"))
    found = (c.join(F.broadcast(edge), ["encoding", "size_class"], "left")  # at most encodings x 31 rows
             .where(F.col("edge").isNull() | (F.col("bin") < F.col("edge")))
             .groupBy("__row").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("random")))
    out = rows.join(found, "__row", "left")
    taken = F.concat("assign", "access", "hex")
    free = F.filter("random", lambda r: ~F.exists(taken, lambda b: (b["s"] < r["e"]) & (r["s"] < b["e"])))
    return out.select("doc_id", "assign", "access", "hex", F.coalesce(free, F.array().cast(_SPANS)).alias("random"))


def listing(*kinds: str) -> Column:
    """Spans of the kinds as kind:start:end by start, then kind as listed, comma-joined."""
    def tagged(kind):
        at = KINDS.index(kind)
        return F.transform(kind, lambda x: F.struct(x["s"].alias("s"), F.lit(at).alias("k"), x["e"].alias("e")))

    parts = [tagged(k) for k in kinds]
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(F.concat(*parts)), lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"], x["e"])), ",")
