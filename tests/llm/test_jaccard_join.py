import random
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dealspark.llm import jaccard_join as J

from .helpers import doc, documents, empty, hard_documents


def brute_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2))) if words else frozenset()


def brute(rows, percent=90):
    """(id, n, smallest id within reach) of (id, text)."""
    found = [brute_set(t) for _, t in rows]
    kinds = sorted(set(found), key=lambda s: (len(s), sorted(s)))
    up = {s: s for s in kinds}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, x in enumerate(kinds):
        for y in kinds[i + 1:]:
            if 100 * len(x) < percent * len(y):
                break
            if x and 100 * len(x & y) >= percent * len(x | y):
                up[find(x)] = find(y)
    least = {}
    for (i, _), s in zip(rows, found):
        least[find(s)] = min((v for v in (least.get(find(s)), i) if v is not None), default=None)
    return [(i, len(s), least[find(s)] if s else i) for (i, _), s in zip(rows, found)]


def near_documents(seed=3, families=40):
    """Families of changed texts about the threshold, chains, shared passages, repeated ids."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 10**6)}"
    passage = [word() for _ in range(60)]
    rows = []
    for f in range(families):
        words = [word() for _ in range(rng.choice([1, 2, 3, 5, 11, 12, 13, 22, 40, 75, 150, 400, 900]))]
        if f % 3 == 0:
            words = passage + words
        for _ in range(rng.choice([1, 2, 4, 9])):
            rows.append(" ".join(words))
            words = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 45))):
                kind, at = rng.random(), rng.randrange(len(words))
                if kind < 0.5:
                    words[at] = word()
                elif kind < 0.8:
                    words.insert(at, word())
                elif len(words) > 1:
                    del words[at]
    out = [(i, t) for i, t in enumerate(rows)]
    out += [(None, rows[0]), (None, rows[-1] + " more"), (3, rows[5]), (3, rows[9]), (10**9, rows[7].upper())]
    rng.shuffle(out)
    return out


def same(got, want):
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_hard_rows(spark):
    same(J.near_duplicates(documents(spark)).collect(), brute([(r[0], r[1]) for r in hard_documents()]))


@pytest.mark.parametrize("percent,limit", [(90, 2048), (90, 3), (80, 5)])
def test_families(spark, percent, limit):
    rows = near_documents()
    docs = documents(spark, [doc(*r) for r in rows]).repartition(5)
    want = brute(rows, percent)
    assert len({c for _, _, c in want}) < len({brute_set(t) for _, t in rows})  # some different texts link
    same(J.near_duplicates(docs, percent=percent, limit=limit).collect(), want)


def test_a_large_group_of_near_copies_beside_another_one(spark):
    """Two families over one long passage, not near each other: many rows share their tiles."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(100)]
    other = base[:60] + [f"v{i}" for i in range(40)]
    rows = []
    for i in range(400):
        words = list(base if i % 3 else other)
        words[rng.randrange(100)] = f"x{i}"
        rows.append((i, " ".join(words)))
    want = brute(rows)
    docs = documents(spark, [doc(*r) for r in rows]).repartition(5)
    same(J.near_duplicates(docs, limit=50).collect(), want)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 700), st.integers(0, 10**9), st.sampled_from([70, 80, 90, 95]))
def test_linked_sets_share_a_tile_that_lets_them_pass(n, seed, percent):
    """As many differences as the threshold allows, anywhere."""
    rng = np.random.default_rng(seed)
    x = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
    y = x.copy()
    while True:
        z = y[rng.permutation(len(y))[1:]] if rng.random() < 0.5 and len(y) > 1 else np.r_[y, rng.integers(0, 2**64, 1, dtype=np.uint64)]
        z = np.unique(z)
        both = len(np.intersect1d(x, z))
        if 100 * both < percent * (len(x) + len(z) - both):
            break
        y = z
    tiles = [pd.DataFrame(dict(zip(("key", "bitmap", "macros"), J.tiles_of(s, percent, J.bands(percent))))) for s in (x, y)]
    both = tiles[0].merge(tiles[1], on=["key", "macros"])
    may = J._May(percent)(np.full(len(both), len(x)), both["bitmap_x"].to_numpy(), np.full(len(both), len(y)), both["bitmap_y"].to_numpy(), both["macros"].to_numpy())
    assert may.any()
    signs = [np.frombuffer(J.signature_of(s), "<u8") for s in (x, y)]
    assert J._May(percent).whole(len(x), signs[0], len(y), signs[1])


def test_unlike_texts_do_not_reach_the_intersection(spark):
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(i, passage + " " + " ".join(f"w{rng.randint(0, 10**9)}" for _ in range(60))) for i in range(300)]
    docs = documents(spark, [doc(*r) for r in rows])
    found = J.sets(docs).where("n > 0")
    classes = found.groupBy("digest").agg({"n": "max"}).count()
    assert classes == 300
    nodes = found.selectExpr("cast(conv(hex(substring(digest, 1, 8)), 16, -10) as bigint) as node", "n", "signature", "tiles")
    shared = J.shared_tiles(nodes)
    assert shared.count() > 0 and J.first_pairs(shared).count() < 30  # of 44,850
    none = spark.createDataFrame([], "node long, component binary")
    assert J.other_pairs(shared, none, nodes.select("node", "signature")).count() < 30


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.none(), st.text(alphabet="aBé \n\x0b\x1c,", max_size=60)))
def test_shingles(text):
    got = J.shingle_set(text)
    assert len(got) == len(brute_set(text)) and (np.diff(got.astype(object)) > 0).all()


def test_empty_table(spark):
    assert J.near_duplicates(empty(spark)).count() == 0
    assert sorted(map(tuple, J.near_duplicates(documents(spark, [doc(1, ""), doc(2, None), doc(None, " ")])).collect()), key=repr) == [
        (1, 0, 1), (2, 0, 2), (None, 0, None)]
