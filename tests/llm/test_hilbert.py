import itertools
import zlib

import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

from dealspark.llm import hilbert as H

from .helpers import documents, empty, hard_documents


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 3), (4, 2)])
def test_curve_visits_neighbours(spark, dims, bits):
    cells = [f"c{d}" for d in range(dims)]
    grid = spark.createDataFrame(list(itertools.product(range(1 << bits), repeat=dims)), ", ".join(f"{c} int" for c in cells))
    got = grid.withColumn("place", H.curve_index(cells, bits)).orderBy("place").collect()
    assert [r["place"] for r in got] == list(range(1 << bits * dims))
    for a, b in zip(got, got[1:]):
        assert sum(abs(a[c] - b[c]) for c in cells) == 1


def test_shards_follow_the_law(spark):
    rows = hard_documents()
    got = H.shards(documents(spark).repartition(6)).collect()
    want = sorted((len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()), repr(r[0])) for r in rows)
    assert sorted((r["size"], r["text_crc32"], repr(r["doc_id"])) for r in got) == want
    counts = {s: sum(r["shard"] == s for r in got) for s in range(8)}
    assert max(counts.values()) - min(counts.values()) <= 1
    for s in range(8):
        own = sorted((r["slot"], r["place"]) for r in got if r["shard"] == s)
        assert [slot for slot, _ in own] == list(range(len(own)))
        assert [p for _, p in own] == sorted(p for _, p in own)
    assert max(r["place"] for r in got if r["shard"] == 0) <= min(r["place"] for r in got if r["shard"] == 7)


@pytest.mark.parametrize("n", [1, 3, 8, 13])
def test_few_rows(spark, n):
    got = H.shards(documents(spark, hard_documents()[:n])).collect()
    counts = [sum(r["shard"] == s for r in got) for s in range(8)]
    assert sum(counts) == n and max(counts) - min(counts) <= 1
    assert all(r["slot"] < counts[r["shard"]] for r in got)


def test_grid_orders_text_and_numbers(spark):
    rows = [(f"https://host/{i:03}", i * i, None if i == 7 else "x") for i in range(200)]
    df = spark.createDataFrame(rows, "u string, n long, same string")
    out, cells = H.on_grid(df, ["u", "n", "same"], 3)
    got = sorted(out.collect(), key=lambda r: r["n"])
    for c in cells[:2]:
        places = [r[c] for r in got]
        assert places == sorted(places) and set(places) == set(range(8))  # order kept, cells evenly used
    assert got[7][cells[2]] == 7 and {r[cells[2]] for i, r in enumerate(got) if i != 7} == {0}


def test_files_prune_in_every_dimension(spark, tmp_out):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.expr("repeat('x', CAST(id * 7919 % 997 AS INT))").alias("text"),
        F.expr("concat('src', lpad(CAST(id * 31 % 40 AS STRING), 2, '0'))").alias("source"),
        F.expr("element_at(array('de', 'en', 'es', 'fr'), CAST(id * 17 % 4 AS INT) + 1)").alias("lang"), F.lit(1).alias("shard"))
    H.write_shards(docs, f"{tmp_out}/shards", shard_column="part", rows_per_file=500)
    files = list(ds.dataset(f"{tmp_out}/shards", format="parquet").get_fragments())
    assert sum(f.count_rows() for f in files) == 20_000
    touched = {"source": 0, "lang": 0}
    for f in files:
        t = f.to_table(columns=["source", "lang"])
        for c, v in (("source", "src05"), ("lang", "fr")):
            values = t[c].to_pylist()
            touched[c] += min(values) <= v <= max(values)
    assert touched["source"] < len(files) / 2 and touched["lang"] < len(files) / 2
    back = spark.read.parquet(f"{tmp_out}/shards")
    assert back.drop("part").exceptAll(docs).count() == 0 and set(back.columns) == {*docs.columns, "part"}


def test_empty_table(spark):
    assert H.shards(empty(spark)).count() == 0
