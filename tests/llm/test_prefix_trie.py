import hashlib
import random
import zlib

import pytest
from pyspark.sql import types as T

from dealspark.llm import prefix_trie as P

ROWS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    # Names that the operator uses inside.
    T.StructField("conv", T.StringType()), T.StructField("block", T.StringType()), T.StructField("at", T.StringType()), T.StructField("c1", T.StringType()),
])


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def turns_of(rows):
    """conv -> its turns (role, text) in order."""
    out = {}
    for c, n, role, text, *_ in rows:
        if c is not None:
            out.setdefault(c, []).append((n, role or "", text or ""))
    key = lambda t: (t[0] is not None, t[0] or 0, t[1], len(t[2].encode()), digest(t[1], t[2]))
    return {c: [(r, t) for _, r, t in sorted(x, key=key)] for c, x in out.items()}


def rebuild(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = convs.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, who in members.items():
        below = [n for n in members if n[:len(node)] == node]
        children = lambda x: sum(len(n) == len(x) + 1 and n[:len(x)] == x for n in below)
        ends = ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(node))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), children(node), sum(not children(n) for n in below),
                    sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def hard_rows(seed=1, n=60, longest=14):
    rng = random.Random(seed)
    rows = []
    for c in [*range(n), -3, -7, 1001]:
        for t in range(rng.choice([0, 1, 2, 3, 5, 8, longest])):
            rows.append((c, t, rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "b", "", None, "é", "a b"])))
    rows += [(2000 + i, t, "user", f"same {t}") for i in range(30) for t in range(7)]  # copies
    rows += [(2100 + i, t, "user", f"same {t}" if t < 6 else str(i)) for i in range(10) for t in range(9)]  # one long shared beginning
    rows += [(7, None, "user", "first"), (7, None, "user", "first"), (8, 1, "user", "tie"), (8, 1, "user", "tie"), (8, 1, "system", "other"),
             (None, 0, "user", "nobody"), (4000, 0, "user", "long " * 20_000), (5000, 0, "us", "er"), (5001, 0, "u", "ser")]
    rng.shuffle(rows)
    return [(*r, "x", "y", "z", "w") for r in rows]


@pytest.mark.parametrize("block", [1, 3, 8])
def test_trie_of_rebuilt_conversations(spark, block):
    rows = hard_rows()
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    got = P.trie(P.rebuilt(df), block, chunk=4).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rebuild(turns_of(rows))), key=repr)


def test_trie_of_plain_conversations_with_a_very_long_one(spark):
    rows = [*hard_rows(2, 10), *[(900, t, "user", str(t % 3)) for t in range(150)], *[(901, t, "user", str(t % 3)) for t in range(140)]]
    rows = [(*r[:4], "x", "y", "z", "w") for r in rows]
    got = P.trie(P.plain(spark.createDataFrame(rows, ROWS)), 4).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(turns_of(rows)), key=repr)


def test_ranks_of_a_conversation_spread_over_partitions(spark):
    rows = [(5, t, "user", f"t{t}", "", "", "", "") for t in range(2000)] + [(4, 0, "a", "b", "", "", "", "")]
    convs, ranked = P.numbered(spark.createDataFrame(rows, ROWS).repartition(8))
    assert sorted(map(tuple, convs.collect())) == [(4, 1), (5, 2000)]
    want = {(5, t + 1, digest("user", f"t{t}")) for t in range(2000)} | {(4, 1, digest("a", "b"))}
    assert {(r["conv"], r["rank"], bytes(r["turn_id"])[4:]) for r in ranked.collect()} == want


def test_invalid_levels_do_not_reach_the_shuffle(spark):
    """The filter on prefixes lies below the aggregation, where the rows are expanded."""
    rows = P.blocks(P.plain(spark.createDataFrame(hard_rows(3, 10), ROWS)), 3)
    plan = P._rollup(rows, ["c1", "c2", "c3"], "count(*) AS n")._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" in plan and plan.index("Aggregate") < plan.index("Filter") < plan.index("Expand"), plan


def test_empty_table(spark):
    assert P.trie(P.rebuilt(spark.createDataFrame([], ROWS))).count() == 0
    assert P.trie(P.rebuilt(spark.createDataFrame([(None, 0, "user", "x", "", "", "", "")], ROWS))).count() == 0
