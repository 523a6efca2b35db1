"""Slices of a source's sampling keys are even whatever the quality weights."""

from pyspark.sql import functions as F

from gatewatch.llm import language_id, mixing


def test_slices_are_even_and_rise_with_the_key(spark):
    n = 60_000
    rows = spark.range(n).select(F.struct(F.lit(False).alias("n"), F.lit("s").alias("s")).alias("__src"),
                                 F.when(F.col("id") % 10 < 7, 0.25).when(F.col("id") % 10 < 9, 0.6).otherwise(1.0).alias("w"), F.rand(1).alias("u"))
    rows = mixing.sliced(rows.withColumn("key", -F.log("u") / F.col("w")), least=64).persist()
    per = [r["c"] for r in rows.groupBy("slice").agg(F.count("*").alias("c")).collect()]
    assert len(per) == 64 and max(per) < 2 * n / 64
    spans = rows.groupBy("slice").agg(F.min("key").alias("a"), F.max("key").alias("b")).orderBy("slice").collect()
    assert all(x["b"] <= y["a"] for x, y in zip(spans, spans[1:], strict=False))


def test_every_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_ROWS", 60)
    words = {f"l{i}": [f"{chr(97 + i)}{chr(98 + i)}{c}{chr(99 + i)}" for c in "aeiou"] for i in range(20)}
    rows = [(i * 40 + k, " ".join(w[(k + j) % 5] for j in range(30)), lang) for i, (lang, w) in enumerate(words.items()) for k in range(20)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted(model.languages) == sorted(words)
