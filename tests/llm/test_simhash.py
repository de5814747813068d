import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from dealspark.llm import components, simhash as S

from .helpers import doc, documents, empty, hard_documents


def brute_fingerprint(text):
    import re
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64)) if hashes else 0


def brute_components(prints):
    """id -> smallest id within reach, ids may repeat; prints: (id, fp)."""
    fps = sorted({f for _, f in prints})
    up = {f: f for f in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    a = np.array(fps, np.uint64)
    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= 3):
            up[find(f)] = find(fps[i + 1 + int(j)])
    least = {}
    for i, f in prints:
        r = find(f)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return [(i, f"{f:016x}", least[find(f)]) for i, f in prints]


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.none(), st.text(alphabet="aBé \n\x0b\x1c,", max_size=80)))
def test_fingerprint(text):
    assert S.text_fingerprint(text) == brute_fingerprint(text)


def test_near_duplicates_of_hard_rows(spark):
    got = S.near_duplicates(documents(spark)).collect()
    want = brute_components([(r[0], brute_fingerprint(r[1])) for r in hard_documents()])
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def _signed(x):
    return x - 2**64 if x >> 63 else x


def test_links_reach_all_near_pairs(spark):
    """Chains, balls and random fingerprints; every pair within three bits is connected."""
    rng = random.Random(3)
    fps = {0, 2**64 - 1}
    for _ in range(40):
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(rng.choice([1, 5, 60])):
            y = x
            for b in rng.sample(range(64), rng.randint(1, 4)):
                y ^= 1 << b
            fps.add(y)
            x = rng.choice([x, y])
    prints = [(i, f) for i, f in enumerate(sorted(fps, key=lambda f: hash((f, 1))))]
    df = spark.createDataFrame([(_signed(f), i) for i, f in prints], "fp long, rep long")
    root = {r["node"]: r["component"] for r in components.connected(S.links(df)).collect()}
    want = brute_components(prints)
    assert [(i, root.get(i, i)) for i, _ in prints] == [(i, c) for i, _, c in want]
    linked = S.links(df).collect()
    by = dict(prints)
    assert all((by[r["a"]] ^ by[r["b"]]).bit_count() <= 3 for r in linked)


def test_dense_group_gives_a_forest_not_all_pairs(spark):
    rng = random.Random(4)
    base = rng.getrandbits(64)
    ball = {base} | {base ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(40)}
    df = spark.createDataFrame([(_signed(f), i) for i, f in enumerate(sorted(ball))], "fp long, rep long")
    links = S.links(df)
    assert links.count() < 40 * len(ball)  # of about 780 ** 2 / 2 pairs, for each key
    got = components.connected(links)
    assert got.select("component").distinct().count() == 1 and got.count() == len(ball)


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=3))
def test_some_chain_keeps_its_budgets(x, flips):
    y = x
    for b in flips:
        y ^= 1 << b
    limits = S.budgets(3)
    assert limits == [(20, 0), (40, 1), (60, 2), (64, 3)]
    xor = np.full(S.SEGMENTS, x ^ y, np.uint64)
    assert S._near(xor, np.arange(S.SEGMENTS), limits).any()


def test_drop_keeps_one_of_each_component(spark):
    docs = documents(spark)
    out = S.drop_near_duplicates(docs)
    assert out.schema == docs.schema
    want = brute_components([(r[0], brute_fingerprint(r[1])) for r in hard_documents()])
    assert sorted(repr(r["doc_id"]) for r in out.collect()) == sorted(repr(i) for i, _, c in want if i == c)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100, 300)] + [(5, 6), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected(edges).collect()}
    assert got == {**{i: 100 for i in range(100, 301)}, 5: 5, 6: 5}


def test_empty_table(spark):
    assert S.near_duplicates(empty(spark)).count() == 0 == S.drop_near_duplicates(empty(spark)).count()


def test_null_and_repeated_ids_link_nothing(spark):
    """Many texts without an id or with one repeated id, some of them near each other or near a text with an id."""
    rng = random.Random(8)

    def text():
        return " ".join(f"w{rng.randint(0, 10**9)}" for _ in range(300))

    def near(t):
        while True:
            words = t.split()
            words[rng.randrange(300)] = "changed"
            if 0 < (brute_fingerprint(t) ^ brute_fingerprint(" ".join(words))).bit_count() <= 3:
                return " ".join(words)

    alone, five, pair, seven, ten = [text() for _ in range(9)], text(), text(), [text() for _ in range(4)], text()
    rows = [(None, t) for t in alone] + [(5, five), (None, near(five)), (None, pair), (None, near(pair))]
    rows += [(7, t) for t in seven] + [(10, near(seven[0])), (10, ten), (6, near(seven[1])), (8, pair + " own"), (7, near(seven[2]))]
    docs = documents(spark, [doc(i, t) for i, t in rows])
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    got = S.near_duplicates(docs).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_components(prints), key=repr)
    whole = brute_components([(n, f) for n, (_, f) in enumerate(prints)])  # rows numbered: the true components
    kept = [r["text"] for r in S.drop_near_duplicates(docs).collect()]
    of = {t: c for (_, t), (_, _, c) in zip(rows, whole)}
    assert sorted(of[t] for t in kept) == sorted(set(of.values()))  # one of each
    assert set(alone) | {five} <= set(kept)
