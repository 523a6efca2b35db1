"""Token counts by a linear longest-match automaton.

The vocabulary is a trie. A node that is no token itself has a failure link: greedy
longest match, run on the node's string, pops some tokens and is left with a string that
is again a node; how many it pops is stored with the link. Reading a word follows the
trie and, where it ends, the failure links, so each byte costs constant time (amortised)
and no piece is ever built: the popped counts add up to the length in pieces.

Words are ``[^\\x20\\x09-\\x0D]+``; each is read with a space before it, as vocabularies of
byte-level tokenizers mark the start of a word (a piece with the space is word-initial,
one without continues a word). Every single byte must be a token, so all text has a
count; a vocabulary that lacks one, or has over ``MAX_TOKENS`` tokens, is refused.

Null and empty texts have 0 words and 0 tokens. Texts and words of any length are read whole,
in time linear in their bytes; a word's pieces are never held. The longest match is unique, so
there are no ties; a token listed twice counts as one. Repeated rows get equal counts, an empty
table gives no rows, other columns are kept."""

from __future__ import annotations

import base64

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch.llm.common import ship_code

#: Vocabulary of the registered query: lines "base64 rank".
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The vocabulary goes to the driver and to all tasks; larger ones are refused.
MAX_TOKENS = 2_000_000
#: Words whose counts a task remembers.
MEMO = 200_000


def load_vocabulary(spark: SparkSession, path: str = VOCABULARY) -> list[bytes]:
    lines = spark.read.text(path).limit(MAX_TOKENS + 1).collect()
    if len(lines) > MAX_TOKENS:
        raise ValueError(f"more than {MAX_TOKENS} tokens in {path}")
    return [base64.b64decode(r[0].split()[0]) for r in lines if r[0].strip()]


class Automaton:
    """Trie with failure links and popped-token counts, as flat arrays (for a broadcast)."""

    def __init__(self, tokens: list[bytes]):
        distinct = set(tokens)
        missing = [b for b in range(256) if bytes([b]) not in distinct]
        if missing:
            raise ValueError(f"bytes without a token: {missing[:5]}")
        step: dict[int, int] = {}
        depth_order: list[tuple[int, int, int]] = []  # parent, byte, node
        is_token = [False]
        for token in sorted(distinct, key=lambda t: (len(t), t)):
            node = 0
            for b in token:
                at = node << 8 | b
                nxt = step.get(at)
                if nxt is None:
                    nxt = step[at] = len(is_token)
                    is_token.append(False)
                    depth_order.append((node, b, nxt))
                node = nxt
            is_token[node] = True
        # a node's parent is numbered before it, but levels may interleave: sort by depth
        level = [0] * len(is_token)
        for parent, _, node in depth_order:
            level[node] = level[parent] + 1
        fail, pops = [-1] * len(is_token), [0] * len(is_token)
        for parent, b, node in sorted(depth_order, key=lambda x: level[x[2]]):
            if is_token[node]:
                fail[node], pops[node] = 0, 1
                continue
            n, z = pops[parent], fail[parent]
            while z >= 0 and (z << 8 | b) not in step:
                n, z = n + pops[z], fail[z]
            fail[node], pops[node] = (step[z << 8 | b] if z >= 0 else -1), n
        self.keys = np.fromiter(step.keys(), np.int64, len(step))
        self.nodes = np.fromiter(step.values(), np.int32, len(step))
        self.fail, self.pops = np.array(fail, np.int32), np.array(pops, np.int32)


class Counter(dict):
    """Word -> tokens; counts a word when it is first met and remembers MEMO of them."""

    def __init__(self, a: Automaton):
        super().__init__()
        self.step = dict(zip(a.keys.tolist(), a.nodes.tolist(), strict=True))
        self.fail, self.pops = a.fail.tolist(), a.pops.tolist()

    def __missing__(self, word: bytes) -> int:
        n = self.count(b" " + word)
        if len(self) >= MEMO:
            self.clear()
        self[word] = n
        return n

    def count(self, symbols: bytes) -> int:
        step, fail, pops = self.step, self.fail, self.pops
        node = n = 0
        for b in symbols:
            nxt = step.get(node << 8 | b)
            while nxt is None:
                n += pops[node]
                node = fail[node]
                nxt = step.get(node << 8 | b)
            node = nxt
        while node:
            n += pops[node]
            node = fail[node]
        return n


_COUNTERS: dict[int, Counter] = {}


def _counter(shared: Broadcast) -> Counter:
    """One per Python worker and automaton."""
    key = id(shared.value)
    if key not in _COUNTERS:
        _COUNTERS[key] = Counter(shared.value)
    return _COUNTERS[key]


def token_counts(docs: DataFrame, tokens: list[bytes], text: str = "text") -> DataFrame:
    """``docs`` with ``n_words`` and ``n_tokens``; columns of these names are replaced."""
    shared = ship_code(docs.sparkSession).sparkContext.broadcast(Automaton(tokens))

    @F.pandas_udf("n_words long, n_tokens long")
    def count(raw: pd.Series) -> pd.DataFrame:
        known = _counter(shared)
        words, toks = np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int64)
        for i, x in enumerate(raw):
            parts = x.split()  # bytes: ASCII white space
            words[i] = len(parts)
            toks[i] = sum(map(known.__getitem__, parts))
        return pd.DataFrame({"n_words": words, "n_tokens": toks})

    got = docs.drop("n_words", "n_tokens", "__n").withColumn("__n", count(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    return got.select("*", "__n.n_words", "__n.n_tokens").drop("__n")
