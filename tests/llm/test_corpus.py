"""Mixing and packing: totals, limits and round trips."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SF, edge, empty
from tramline.llm import mixing, packing


@pytest.mark.parametrize("count", [1, 2, 3, 64, 1000])
def test_permutation_and_its_inverse(count):
    keys = mixing._keys(1, 2, np.zeros(count, int))
    image = mixing.permuted(np.arange(count), count, keys)
    assert sorted(image) == list(range(count))
    assert (mixing.permuted(image, count, keys, inverse=True) == np.arange(count)).all()


def test_shares_stop_at_the_limit():
    got = mixing.shares(np.array([10.0, 100.0, 0.0, 300.0]), np.array([1.0, 2.0, 3.0, 1.0]), 410.0)
    assert got.tolist() == [30.0, 380 * 2 / 3, 0.0, 380 / 3]


@pytest.mark.parametrize("block, shard", [(256, 16384), (7, 50)])
def test_mix_takes_the_targets(spark, block, shard):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixture = mixing.mix(docs, block_words=block, shard_slots=shard)
    taken = mixture.taken.groupBy("doc_id").agg(F.sum("length").alias("t")).toPandas().set_index("doc_id")["t"]
    rows, sources = mixture.rows.toPandas(), mixture.sources.toPandas()
    rows["t"] = rows["doc_id"].map(taken).fillna(0)
    assert (rows["t"] <= 3 * rows["size"]).all()
    got = rows.groupby("source_no")["t"].sum().sort_index().to_numpy()
    assert np.abs(got - sources.sort_values("source_no")["target"].to_numpy()).max() <= 0.5
    again = mixing.mix(docs.repartition(5), block_words=block, shard_slots=shard).taken
    assert again.groupBy("doc_id").agg(F.sum("length").alias("t")).toPandas().set_index("doc_id")["t"].to_dict() == taken.to_dict()


def test_mix_edges(spark):
    out = mixing.mixed_docs(edge(spark), block_words=4)
    assert out.columns == edge(spark).columns
    sizes = mixing.mix(edge(spark), block_words=4).rows
    assert sizes.count() == 12
    words = out.select(F.sum(F.size(mixing.words(F.col("text"))))).first()[0]
    total = sizes.agg(F.sum("size")).first()[0]
    assert abs(words - total) <= 5
    assert mixing.mixed_docs(empty(spark)).count() == 0 and mixing.mix(empty(spark)).taken.count() == 0


def test_tokens_are_those_of_the_json_form():
    import public_tokenizers
    from tokenizers import Tokenizer

    rng = np.random.default_rng(3)
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    fast = packing._encoder(packing.default_ranks())
    signs = [chr(c) for c in [*range(0, 0x180), 0x2028, 0x3000, 0x4E2D, 0x1F600, 0x301]] + [" "] * 60 + ["<|endoftext|>", "'s"]
    for _ in range(500):
        text = "".join(rng.choice(signs, rng.integers(0, 60)))
        assert plain.encode(text, add_special_tokens=False).ids == fast.encode(text, allowed_special="all")


def test_divide_is_a_partition():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 2048, 300)
    windows = packing.assign(lengths)
    sums = np.bincount(windows, lengths)
    assert sums.max() <= 2048 and sums.sum() == lengths.sum()


def test_pack_every_id_once(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = packing.packed_docs(docs).toPandas()
    whole = pieces.sort_values(["doc_id", "start"])
    ends = whole.groupby("doc_id").agg(first=("start", "min"), total=("length", "sum"), tokens=("doc_tokens", "first"))
    assert (ends["first"] == 0).all() and (ends["total"] == ends["tokens"]).all()
    placed = pieces.sort_values(["sequence_id", "offset"])
    assert (placed.groupby("sequence_id")["length"].cumsum() - placed["length"] == placed["offset"]).all()
    filled = pieces.groupby("sequence_id")["length"].sum()
    assert filled.max() <= 2048 and 1 - filled.mean() / 2048 < 0.03
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in whole.itertuples():
        ids = np.array([*tokenizer.encode(texts[row.doc_id], add_special_tokens=False).ids, 1], "<u4")
        assert row.ids_crc32 == zlib.crc32(ids[row.start : row.start + row.length].tobytes())


def test_pack_edges(spark):
    pieces = packing.packed_docs(edge(spark), with_ids=True).toPandas()
    assert len(pieces[pieces["start"] == 0]) == 12
    assert (pieces["ids"].map(len) == pieces["length"]).all()
    assert packing.packed_docs(empty(spark)).count() == 0


@pytest.mark.parametrize("letter", [" ", "\n", "x", " \n"])
def test_a_million_of_one_sign(spark, letter):
    import public_tokenizers
    from tokenizers import Tokenizer

    text = letter * (1_000_000 // len(letter))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    pieces = packing.token_pieces(docs, with_ids=True).orderBy("start").collect()
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert [i for p in pieces for i in p["ids"]] == whole.encode(text, add_special_tokens=False).ids + [1]
