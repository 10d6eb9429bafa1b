"""The pipeline's stages on small tables: what they drop, what they keep, what they return."""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from wayfare.session import BATCH_BYTES

SF = "/root/testdata/sf0.01"
STAGES = dict(corpus_pipeline.STAGES)


def documents(spark):
    """Clean prose with planted cases: no letters, toxic, near copies, a benchmark item; odd rows."""
    draw = random.Random(1)
    words = ["river", "stone", "window", "garden", "under", "light", "paper", "music", "winter", "green", "table", "quiet"]
    text = lambda n: " ".join(draw.choice(words) for _ in range(n)) + "."
    rows = [(i, text(60)) for i in range(1, 40)]
    base = text(200)
    changed = base.split()
    changed[100] = "altered"
    rows += [(50, base), (51, base), (52, " ".join(changed)), (60, "12345 !!! 999"), (61, None), (70, text(20)), (70, text(20))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en"))
    return frame.withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text")).withColumn("__id", F.lit(3)).withColumn("rep", F.lit("x"))


def test_stages_return_the_columns_of_documents(spark):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
        assert stage(spark, docs.where("false"), SF).count() == 0, name
    assert STAGES["packing"](spark, docs.where("false"), SF).count() == 0


def test_language_stage(spark):
    other = spark.createDataFrame([(900 + i, "Les rues de la ville sont calmes le soir et les gens rentrent chez eux.") for i in range(5)], "doc_id long, text string")
    docs = documents(spark)
    docs = docs.unionByName(other.withColumn("lang", F.lit("fr")), allowMissingColumns=True)
    kept = {r["doc_id"] for r in STAGES["language"](spark, docs, SF).collect()}
    assert {r["doc_id"] for r in docs.collect()} - kept == {60, 61}


def test_toxicity_stage(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r["doc_id"] for r in STAGES["toxicity"](spark, docs, sf).collect()}
    marked = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    toxic, clean = ({i for i, t in marked.items() if t == want} for want in (1, 0))
    assert len(toxic - kept) >= 0.9 * len(toxic) and len(clean & kept) >= 0.98 * len(clean)


def test_near_duplicate_stage(spark):
    docs = documents(spark)
    kept = [r["doc_id"] for r in STAGES["near_duplicates"](spark, docs, SF).collect()]
    # The two different texts under 70 are documents of their own.
    assert sorted(kept) == [*range(1, 40), 50, 60, 61, 70, 70]
    lost = docs.withColumn("doc_id", F.when(F.col("doc_id") < 50, F.col("doc_id")))
    assert STAGES["near_duplicates"](spark, lost, SF).where("doc_id IS NULL").count() == lost.where("doc_id IS NULL").count()


def test_decontamination_stage(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    docs = documents(spark)
    leak = docs.where("doc_id = 1").withColumn("doc_id", F.lit(99).cast("long")).withColumn("text", F.concat("text", F.lit(" " + item + " "), "text"))
    kept = {r["doc_id"] for r in STAGES["decontamination"](spark, docs.unionByName(leak), SF).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()}


def test_rows_are_dropped_for_their_own_text(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    docs = documents(spark).where("doc_id < 40")
    odd = [(None, "12345 !!! 999"), (1, "98765 !!! 111"), (None, f"The garden was quiet. {item} The winter was green.")]
    add = spark.createDataFrame(odd, "doc_id long, text string").withColumn("lang", F.lit("en"))
    both = docs.unionByName(add, allowMissingColumns=True)
    left = {(r["doc_id"], r["text"]) for r in STAGES["language"](spark, both, SF).collect()}
    assert not {odd[0], odd[1]} & left and (1, docs.where("doc_id = 1").first()["text"]) in left
    assert odd[2] not in {(r["doc_id"], r["text"]) for r in STAGES["decontamination"](spark, both, SF).collect()}
    other = docs.where("doc_id = 2").withColumn("doc_id", F.lit(1).cast("long")).withColumn("text", F.lit("a different clean text that shares its id with another one"))
    kept = [(r["doc_id"], r["text"]) for r in STAGES["near_duplicates"](spark, docs.unionByName(other).unionByName(other), SF).collect()]
    # Equal rows are one, different texts of one id are not.
    assert len(kept) == len(set(kept)) == 40 and (1, "a different clean text that shares its id with another one") in kept


def test_columns_without_an_order(spark):
    docs = documents(spark).where("doc_id < 5").withColumn("extra", F.create_map(F.lit("a"), F.col("doc_id")))
    for name in ("language", "toxicity", "near_duplicates", "decontamination"):
        left = STAGES[name](spark, docs.unionByName(docs), SF)
        assert left.columns == docs.columns and {r["doc_id"]: r["extra"] for r in left.collect()} == {i: {"a": i} for i in range(1, 5)}, name


def test_packing_stage(spark):
    found = STAGES["packing"](spark, documents(spark), SF).toPandas()
    assert sorted(found.sequence_id) == list(range(len(found))) and found.doc_id.nunique() == 45


def test_run(spark):
    """The stages, one after the other, are the run."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    step = docs.select("doc_id", "start", "length").toPandas()
    whole = corpus_pipeline.run(spark, SF).select("doc_id", "start", "length").toPandas()
    key = ["doc_id", "start", "length"]
    assert step.sort_values(key).to_numpy().tolist() == whole.sort_values(key).to_numpy().tolist() and len(whole)


def largest_batch(frame):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], ["n"])

    return frame.mapInArrow(run, "n long").agg(F.max("n")).first()[0]


def test_stages_bound_the_batches_of_workers(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs, none = spark.range(0, 6000, 1, 1).select(F.repeat(F.lit("x"), 1500).alias("text")), documents(spark).where("false")
    before = spark.conf.get(name, None)
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.unset(name)
            stage(spark, none, SF)
            assert largest_batch(docs) < 2 * BATCH_BYTES
            spark.conf.set(name, str(BATCH_BYTES // 4))
            stage(spark, none, SF)
            assert spark.conf.get(name) == str(BATCH_BYTES // 4)
    finally:
        spark.conf.unset(name)
        if before is not None:
            spark.conf.set(name, before)
