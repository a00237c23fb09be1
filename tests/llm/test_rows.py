"""Row keys on derived frames: operators give what they give on the same rows read from a file."""

import pytest
from pyspark.sql import functions as F

from periodlens.llm import near_dedup, passages, sharding, suffix_dedup, tokenfile
from periodlens.llm.rows import stage, with_row_key
from periodlens.llm.tokens import vocabulary
from periodlens.session import staging_path

from .helpers import sample


def frames(spark):
    docs = sample(spark)
    return {
        "filtered": docs.where("doc_id % 2 = 0"),
        "exploded": docs.withColumn("text", F.explode(F.array("text", F.concat(F.lit("again "), "text")))),
        "limited": docs.orderBy("doc_id").limit(90),
        "joined": docs.join(docs.select("doc_id").where("doc_id % 3 < 2"), "doc_id"),
        "unioned": docs.union(docs.where("doc_id < 60")),
    }


def token_digest(spark, df):
    folder = staging_path(spark, "token-file")
    tokenfile.write(spark, df, folder, vocabulary("byte_bpe_50k.json"))
    return tokenfile.digest(spark, folder)


OPERATORS = {
    "op2": lambda spark, df: passages.repeated_passages(spark, df),
    "op5": token_digest,
    "op9": lambda spark, df: suffix_dedup.digest(suffix_dedup.remove_repeats(spark, df)),
    "op10": lambda spark, df: near_dedup.near_duplicates(spark, df).drop("n_spanning_links"),
    "near-duplicates stage": lambda spark, df: near_dedup.drop_near_duplicates(spark, df).select("doc_id", "text"),
}


@pytest.mark.parametrize("kind", ["filtered", "exploded", "limited", "joined", "unioned"])
def test_keys_are_unique(spark, kind):
    keyed = with_row_key(spark, frames(spark)[kind])
    assert keyed.count() == keyed.select("_f", "_r").distinct().count()


@pytest.mark.parametrize("kind, operator", [("filtered", "op9"), ("exploded", "op9"), ("limited", "op5"), ("joined", "op10"), ("unioned", "near-duplicates stage"), ("exploded", "op2"), ("filtered", "op5")])
def test_operators_on_derived_frames(spark, kind, operator):
    df = frames(spark)[kind]
    plain = stage(spark, df, "plain")
    run = OPERATORS[operator]
    rows = [sorted(map(str, run(spark, x).collect())) for x in (df, plain)]
    if operator in ("op5", "op2"):  # ties of one id may stand in either order
        rows = [sorted({r.split("start")[0] for r in x}) for x in rows]
    assert rows[0] == rows[1]


@pytest.mark.parametrize("kind", ["filtered", "exploded", "unioned"])
def test_shards_of_derived_frames_are_even(spark, kind):
    df = frames(spark)[kind]
    got = sharding.shuffle_to_shards(spark, df)
    sizes = [r["count"] for r in got.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == df.count()
    assert sorted(map(str, got.drop("shard", "slot").collect())) == sorted(map(str, df.collect()))


def test_clashing_columns_are_kept(spark):
    df = sample(spark).withColumns({"_f": F.lit("mine"), "_r": F.col("doc_id") + 1, "_cell": F.lit(3), "c0": F.lit("x")})
    for got in (near_dedup.drop_near_duplicates(spark, df), sharding.shuffle_to_shards(spark, df).drop("shard", "slot")):
        assert got.columns == df.columns
        assert {(r["_f"], r["_cell"], r["c0"]) for r in got.collect()} == {("mine", 3, "x")}
        assert got.where("_r <> doc_id + 1").isEmpty()
