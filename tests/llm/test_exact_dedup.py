import hashlib
import re

import pytest

from dealspark.llm import exact_dedup as D

from .helpers import documents, empty, hard_documents


def brute(rows):
    groups = {}
    for i, r in enumerate(rows):
        norm = re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")
        groups.setdefault(norm, []).append((-len(r[1] or ""), r[0] is None, r[0] or 0, i, r[0]))
    out = []
    for norm, members in groups.items():
        members.sort()
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(m[4], members[0][4], len(members), n == 0, sha) for n, m in enumerate(members)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("hash_bits,capacity", [(64, 100_000), (3, 2), (64, 1)])
def test_classes_match_brute_force(spark, hash_bits, capacity):
    """Few hash bits make unequal texts collide in chains; a small capacity doubles the directory."""
    got = D.classes(documents(spark), capacity=capacity, max_depth=6, hash_bits=hash_bits).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(hard_documents())


@pytest.mark.parametrize("hash_bits", [64, 2])
def test_drop_copies(spark, hash_bits):
    docs = documents(spark)
    out = D.drop_copies(docs, hash_bits=hash_bits)
    assert out.schema == docs.schema
    assert sorted(repr(r["doc_id"]) for r in out.collect()) == sorted(repr(x[0]) for x in brute(hard_documents()) if x[3])


def test_directory_splits_overfull_buckets_only(spark):
    # 60 hashes under prefix 0..., 3 under 1...: only the first side doubles.
    rows = [(i << 56,) for i in range(60)] + [((-1 << 63) + (i << 40),) for i in range(3)]
    slots, depth = D.directory(spark.createDataFrame(rows, "h long"), capacity=16, max_depth=10)
    got = {r["slot"]: (r["local_depth"], r["bucket"]) for r in slots.collect()}
    top = 1 << (depth - 1)
    assert got[top] == (1, top)
    low = {d for s, (d, _) in got.items() if s < top}
    assert max(low) > 1
    sizes = {}
    for (h,) in rows:
        b = got[(h % 2**64) >> (64 - depth)][1]
        sizes[b] = sizes.get(b, 0) + 1
    assert max(sizes.values()) <= 16


def test_bitmap_passes_every_crowded_hash(spark):
    rows = spark.range(5000).selectExpr("xxhash64(id) AS h", "id")
    crowded = rows.where("id % 50 = 0").select("h")
    passed = {r["id"] for r in D._marked(rows, crowded).where("marked").collect()}
    assert passed >= set(range(0, 5000, 50)) and len(passed) < 130


def test_empty_table(spark):
    assert D.classes(empty(spark)).count() == 0 == D.drop_copies(empty(spark)).count()
