"""Language ID by string kernels.

A text is cut into pieces of at most ``PIECE`` letters (nearly equal ones; every n-gram is in
exactly one). A piece is the set of its letter n-grams (2 to 4 letters, word borders
included, lower case), hashed to ``FEATURES`` bits: presence, not counts. The blended-spectrum
kernel of two pieces is the size of their common set over the geometric mean of their sizes;
that of a text is the mean over its pieces, so features don't fill up, however long it is.
Nystrom: the kernel to ``landmarks`` training pieces, whitened by their own kernel matrix, is
the feature vector; one ridge regression per language (that language against the rest) is
fitted on it. As the kernel to a landmark is a matrix product of presence vectors, a batch
of pieces is scored by one product with the folded matrix landmarks' x weights, whose further
columns give the coverage below.

The classifier is fitted on a bounded sample: at most ``per_language`` labelled texts of each
language (fewer each, if there are so many languages that it would be over ``MAX_ROWS`` in
all; every language is learned), chosen by a hash of the id, with one piece of each, chosen
by another; extraction runs on the executors and the driver gets bitmaps of
``FEATURES / 8`` bytes. Predictions read whole texts.

The scores alone can't tell that a text is in no learned language: those of one text sum to
2 - languages, so the best is at least 1 / languages once scaled to 0..1, and the intercept
lifts it further. So a text must also be covered: a language's vocabulary is the features
that most of its sample pieces have (at most a ``VOCABULARY`` share of all), and the coverage
of a text is the share of its pieces' features in there, less what chance gives (0: as random
features, 1: all). Each language's floor is ``FLOOR_SHARE`` of the ``FLOOR_QUANTILE`` of the
coverage of its own sample pieces, each by the vocabulary of the others. A text that none of
its ``CANDIDATES`` best languages covers is ``und`` with score 0. Texts of a few letters have
few n-grams, so junk of that length may pass; a language of very few sample texts has a
floor near 0.

Null and empty texts and texts without a letter are ``und`` with score 0. Without labelled
texts, as in an empty table, everything is ``und``. A null id is never learned from (it counts
as held out). Of equal best scores the language that sorts first is predicted. Repeated rows
get equal predictions; in the sample each counts as a row."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cache, cached_property

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatewatch.llm.common import ship_code

FEATURES = 1 << 15
GRAMS = (2, 3, 4)
PIECE = 4096
PER_LANGUAGE = 200
LANDMARKS = 50
MAX_ROWS = 50_000
RIDGE = 1e-2
UNKNOWN = "und"
#: The pipeline drops documents without a language (see above), and those whose best score is
#: below this; with up to 5 languages no text scores lower.
MIN_SCORE = 0.2
VOCABULARY = 0.25
FLOOR_SHARE = 0.5
FLOOR_QUANTILE = 0.01
CANDIDATES = 3
BATCH = 64
_LETTERS = regex.compile(r"\p{L}+")


@cache
def _letter_table() -> np.ndarray:
    """Whether a code point is a letter."""
    out = np.zeros(0x110000, bool)
    for first, last in ((0, 0xD800), (0xE000, 0x110000)):
        for m in _LETTERS.finditer("".join(map(chr, range(first, last)))):
            out[first + m.start():first + m.end()] = True
    return out


def pieces(text: str | None) -> list[np.ndarray]:
    """The features of the n-grams of each piece, repeated as they are; none without a letter."""
    if not text:
        return []
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letter_table()[c]
    if not letter.any():
        return []
    # runs of other characters become one space, with one at either end
    c = np.concatenate(([np.uint32(32)], np.where(letter, c, np.uint32(32)), [np.uint32(32)]))
    letter = np.concatenate(([False], letter, [False]))
    first = letter.copy()
    first[0] = True
    first[1:] |= letter[:-1]
    h = c = c[first]
    count = -(-len(c) // PIECE)
    cuts = np.arange(1, count) * len(c) // count
    out = [[] for _ in range(count)]
    for n in range(2, max(GRAMS) + 1):
        if len(c) < n:
            break
        h = h[:-1] * np.uint32(0x01000193) ^ c[n - 1:]
        if n in GRAMS:
            grams = (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - FEATURES.bit_length() + 1)
            for part, own in zip(out, np.split(grams, cuts), strict=True):
                part.append(own)
    return [np.concatenate(part) for part in out]


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # FEATURES x languages
    bias: np.ndarray
    vocabulary: np.ndarray = field(default_factory=lambda: np.zeros((0, FEATURES), bool))  # languages x FEATURES
    floor: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @cached_property
    def both(self) -> np.ndarray:
        """Made where it is used; the broadcast model goes without."""
        return np.concatenate([self.weights, self.vocabulary.T.astype(np.float32)], axis=1)

    @cached_property
    def chance(self) -> np.ndarray:
        return self.vocabulary.mean(axis=1)

    def batch(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Presence vectors (rows of 0/1) -> one-versus-rest scores, about -1 to 1, and the share
        of the features in each vocabulary."""
        size = np.maximum(x.sum(axis=1, dtype=np.float32), 1)[:, None]
        got, n = x.astype(np.float32, copy=False) @ self.both, len(self.languages)
        return got[:, :n] / np.sqrt(size) + self.bias, got[:, n:] / size

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.batch(x)[0]

    def means(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of pieces of each text, and the means of their scores and shares. At most BATCH
        presence vectors are held."""
        n = np.zeros(len(texts))
        sums = np.zeros((2, len(texts), len(self.languages)))
        x, owner = np.zeros((BATCH, FEATURES), np.float32), []

        def flush():
            got = self.batch(x[:len(owner)])
            for i in (0, 1):
                np.add.at(sums[i], owner, got[i])
            x[:len(owner)] = 0
            owner.clear()

        for i, text in enumerate(texts):
            for grams in pieces(text):
                x[len(owner), grams] = 1
                owner.append(i)
                n[i] += 1
                if len(owner) == BATCH:
                    flush()
        flush()
        return n, *(sums / np.maximum(n, 1)[:, None])

    def predict(self, texts) -> tuple[list[str], np.ndarray]:
        names, best = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, best
        n, scores, shares = self.means(texts)
        covered = shares - self.chance >= self.floor * (1 - self.chance)
        order = np.argsort(-scores, axis=1, kind="stable")[:, :CANDIDATES]
        for i in np.flatnonzero((n > 0) & np.take_along_axis(covered, order, axis=1).any(axis=1)):
            k = order[i, 0]
            names[i], best[i] = self.languages[k], float(np.clip((scores[i, k] + 1) / 2, 0, 1))
        return names, best


def fit(bitmaps: np.ndarray, labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """bitmaps: one packed presence vector a row; the first ``landmarks`` of each label are the
    Nystrom landmarks."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((FEATURES, 0), np.float32), np.zeros(0, np.float32))
    bits = np.unpackbits(bitmaps, axis=1)[:, :FEATURES]
    x = bits.astype(np.float32)
    x /= np.sqrt(np.maximum(x.sum(axis=1), 1))[:, None]
    y = np.array([languages.index(v) for v in labels])
    known = [_vocabulary(bits[y == k]) for k in range(len(languages))]
    chosen = np.concatenate([np.flatnonzero(y == k)[:landmarks] for k in range(len(languages))])
    marks = x[chosen]
    value, vector = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = value > 1e-8 * value[-1]
    whiten = (vector[:, good] / np.sqrt(value[good])) @ vector[:, good].T
    phi = (x @ marks.T).astype(np.float64) @ whiten
    target = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)
    # every language weighs the same, whatever its share of the sample
    each = 1.0 / np.bincount(y, minlength=len(languages))[y]
    each *= len(y) / each.sum()
    one = np.c_[phi, np.ones(len(phi))]
    gram = (one * each[:, None]).T @ one + ridge * np.diag(np.r_[np.ones(phi.shape[1]), 0.0])
    w = np.linalg.lstsq(gram, (one * each[:, None]).T @ target, rcond=None)[0]
    return Model(languages, (marks.T @ (whiten @ w[:-1])).astype(np.float32), w[-1].astype(np.float32),
                 np.array([v for v, _ in known]), np.array([f for _, f in known]))


def _vocabulary(bits: np.ndarray) -> tuple[np.ndarray, float]:
    """A language's features and its floor, of the presence vectors of its sample."""
    texts = bits.sum(axis=0, dtype=np.int64)
    least = max(1, int(np.sort(texts)[-int(VOCABULARY * FEATURES) - 1]) + 1)
    cover = []
    for row in bits:
        others = texts - row >= least
        chance = others.mean()
        cover.append((others[row == 1].mean() - chance) / (1 - chance))
    return texts >= least, max(0.0, FLOOR_SHARE * float(np.quantile(cover, FLOOR_QUANTILE)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(lang, bits) of the sample. A per-language hash threshold cuts it out of the rows in a
    narrow pass; the exact number is taken from what is left, a few texts per language."""
    ship_code(docs.sparkSession)
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = labelled.groupBy("lang").count().orderBy("lang").collect()  # a row per language
    per_language = max(1, min(per_language, MAX_ROWS // max(1, len(counts))))
    spread = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    rate = F.lit(0.0)
    if counts:
        table = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], min(1.0, 4.0 * per_language / r["count"]))])
        rate = F.coalesce(F.try_element_at(table, F.col("lang")), F.lit(0.0))

    @F.pandas_udf("binary")
    def bits(texts: pd.Series, share: pd.Series) -> pd.Series:
        out = []
        for t, u in zip(texts, share, strict=True):
            own = pieces(t)
            x = np.zeros(FEATURES, np.uint8)
            if own:
                x[own[int(u * len(own))]] = 1
            out.append(np.packbits(x).tobytes() if own else None)
        return pd.Series(out, dtype=object)

    which = F.pmod(F.xxhash64("doc_id", F.lit("piece")), F.lit(1 << 30)) / float(1 << 30)
    cut = labelled.where(spread < rate).select("lang", "doc_id", spread.alias("h"), bits("text", which).alias("bits")).where("bits is not null")
    order = Window.partitionBy("lang").orderBy("h", "doc_id", "bits")
    return cut.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language).select("lang", "n", "bits")


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    rows = training_sample(docs, per_language).orderBy("lang", "n").collect()  # bounded, see above
    if not rows:
        return fit(np.zeros((0, FEATURES // 8), np.uint8), [])
    return fit(np.array([np.frombuffer(r["bits"], np.uint8) for r in rows]), [r["lang"] for r in rows])


def predict_column(model: Model, text: Column, spark) -> Column:
    """struct(lang, score) of a text column."""
    shared = ship_code(spark).sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        names, best = shared.value.predict(list(texts))
        return pd.DataFrame({"lang": names, "score": best})

    return predict(text)


def known_language(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without the rows that have no language or only doubtful ones."""
    model = train(docs)
    found = docs.withColumn("__lang", predict_column(model, F.col("text"), docs.sparkSession))
    return found.where((F.col("__lang.lang") != UNKNOWN) & (F.col("__lang.score") >= min_score)).select(docs.columns)
