"""The corpus pipeline, stage by stage, against brute-force versions; registration."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F
from test_corpus_operators import brute_components, brute_contamination, brute_fingerprint, brute_shards, brute_targets

import __spark_entry__ as entry
import corpus_pipeline
from gatewatch.llm import language_id, mixing, sharding

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute_mix(rows, quality):
    """rows: (doc_id, text, source) -> copies by doc_id."""
    size = {d: len((t or "").encode().split()) for d, t, _ in rows}
    total = {}
    for d, _, s in rows:
        total[s] = total.get(s, 0) + size[d]
    target, out = brute_targets(total), {}
    for s in total:
        def key(d):
            u = (int(hashlib.md5(f"{d}|{mixing.SEED}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
            return -math.log(u) / mixing.QUALITY[quality.get(d)]
        epochs, upto = int(target[s] // total[s]) if total[s] else 0, 0
        rest = target[s] - epochs * total[s]
        for d in sorted((d for d, _, o in rows if o == s), key=lambda d: (key(d), d)):
            upto += size[d]
            out[d] = epochs + (size[d] > 0 and upto - size[d] / 2 <= rest and epochs < 3)
    return out


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(COLUMNS)
    rows = [tuple(r) for r in docs.collect()] + [(9001, None, None, "src1", 0), (9002, "12 34", "en", None, 5), (9003, "", "en", "src2", 0)]
    docs = spark.createDataFrame(rows, docs.schema)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "decontamination", "mixing", "sharding"]
    stages = dict(corpus_pipeline.STAGES)

    got = stages["language_id"](spark, docs, SF)
    assert got.columns == COLUMNS
    have = [tuple(r) for r in got.collect()]
    model = language_id.train(docs)
    guess, score = model.predict([r[1] for r in rows])
    assert sorted(have) == sorted(r for r, g, s in zip(rows, guess, score, strict=True) if g != "und" and s >= language_id.MIN_SCORE)
    assert len(have) == len(rows) - 3

    docs = spark.createDataFrame(have, docs.schema)
    got = stages["near_dedup"](spark, docs, SF)
    comp = brute_components([r[0] for r in have], [brute_fingerprint(r[1]) for r in have])
    assert got.columns == COLUMNS
    kept = sorted(tuple(r) for r in got.collect())
    assert kept == sorted(r for r, c in zip(have, comp, strict=True) if r[0] == c)

    docs = spark.createDataFrame(kept, docs.schema)
    got = stages["decontamination"](spark, docs, SF)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {d for d, _, hit, _ in brute_contamination([r[:2] for r in kept], items) if hit}
    clean = sorted(tuple(r) for r in got.collect())
    assert got.columns == COLUMNS and bad and clean == [r for r in kept if str(r[0]) not in bad]

    docs = spark.createDataFrame(clean, docs.schema)
    got = stages["mixing"](spark, docs, SF)
    quality = {}
    for r in spark.read.parquet(f"{SF}/labels.parquet").collect():
        quality[r.doc_id] = max(r.quality, quality.get(r.doc_id, 0))
    copies = brute_mix([(r[0], r[1], r[3]) for r in clean], quality)
    mixed = sorted(tuple(r) for r in got.collect())
    assert got.columns == COLUMNS and mixed == sorted(r for r in clean for _ in range(copies[r[0]]))

    docs = spark.createDataFrame(mixed, docs.schema)
    got = stages["sharding"](spark, docs, SF)
    where = dict(zip([r[0] for r in mixed], brute_shards([r[:2] for r in mixed], sharding.SHARD_BYTES), strict=True))
    last = got.collect()
    assert len(last) == len(mixed) and all(r.shard == where[r.doc_id] for r in last)


def test_run_is_the_stages_and_handles_empty_tables(spark, tmp_path):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns[:5] == COLUMNS and out.count() > 0
    for t in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_extra_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("root", F.lit("r")).withColumn("size", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name


def test_all_are_registered():
    names = list(entry.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("limit", [3000, 100_000])
def test_shard_sql_with_small_limits(spark, limit):
    import duckdb

    from gatewatch.llm.oracles import op2_sql
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = sorted((r[0], r[1], r[2], r[3]) for r in con.sql(op2_sql(limit)).fetchall())
    got = sharding.shard(spark.read.parquet(f"{SF}/documents.parquet"), limit)
    assert sorted((r.doc_id, r.shard_bytes_row, r.shard, r.shard_depth) for r in got.collect()) == want
