import hashlib

import pytest

from dealspark.llm import mixing as M

from .helpers import WORD, doc, documents, empty, hard_documents


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Clamp and redistribute until nothing is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        weight = sum(w[s] for s in order if s not in full)
        target = {s: cap * sizes[s] if s in full else left * w[s] / weight for s in order}
        over = {s for s in order if s not in full and target[s] > cap * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100, "d": 100, None: 40}, {"a": 1, "b": 1000, "c": 10}, {"é": 5, "z": 0, "": 7}, {"only": 9},
])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in M.targets(df).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want)


def test_targets_below_the_caps(spark):
    df = spark.createDataFrame([("a", 100), ("b", 100)], "source string, size long")
    got = {r["source"]: r["target"] for r in M.targets(df, (3, 1), 0.4).collect()}
    assert got == {"a": 60.0, "b": 20.0}


def brute_mix(rows):
    sized = [((r[0], r[1] or ""), r[3], len(WORD.findall(r[1] or ""))) for r in rows]

    def place(i, text):
        return int(hashlib.md5(f"mix-1:{'' if i is None else i}:{hashlib.md5(text.encode()).hexdigest()}".encode()).hexdigest()[:15], 16)
    sizes = {}
    for _, s, n in sized:
        sizes[s] = sizes.get(s, 0) + n
    goal = brute_targets(sizes)
    out = []
    for s in sizes:
        own = [(place(*k), k[0] is None, k[0] or 0, n, k[0]) for k, t, n in sized if t == s]
        whole = int(goal[s] // sizes[s]) if sizes[s] else 0
        left = int(goal[s] + 0.5) - whole * sizes[s]
        for *_, n, i in sorted(own):
            extra = max(0, min(n, left))
            left -= extra
            out.append((i, n, sizes[s], whole * n + extra))
    return out


def test_mix_matches_brute_force(spark):
    got = M.mix(documents(spark)).collect()
    assert sorted(((r["doc_id"], r["size"], r["source_size"], r["taken"]) for r in got), key=repr) == sorted(brute_mix(hard_documents()), key=repr)
    by = {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        t = by.setdefault((r["source_size"], r["target"]), [0])
        t[0] += r["taken"]
    assert all(abs(t[0] - target) <= 1 for (_, target), t in by.items())


def test_reruns_and_partitionings_agree(spark):
    a = M.mix(documents(spark)).collect()
    b = M.mix(documents(spark).repartition(7)).collect()
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_mixed_documents(spark):
    docs = documents(spark, [doc(i, "w " * (1 + i % 9), source=["a", "a", "a", "b", None][i % 5]) for i in range(400)])
    taken = {r["doc_id"]: (r["taken"], r["size"], r["whole"]) for r in M.mix(docs).collect()}
    out = M.mixed_documents(docs)
    assert out.schema == docs.schema
    copies = {}
    for r in out.collect():
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    for i, (t, size, whole) in taken.items():
        extra = t - whole * size
        assert copies.get(i, 0) == whole + (2 * extra >= size and extra > 0)


@pytest.mark.parametrize("rows", [
    [doc(None, f"text {i} " + "w " * (i % 20), source="ab"[i % 4 == 0]) for i in range(3000)],  # no ids
    [doc(7, f"text {i} " + "w " * (i % 20), source="ab"[i % 4 == 0]) for i in range(3000)],  # one id
    [doc(None, "the same text of seven words here", source="ab"[i % 4 == 0]) for i in range(3000)],  # one row, repeated
], ids=["null", "one", "copies"])
def test_rows_that_share_an_id_meet_their_targets(spark, rows):
    docs = documents(spark, rows)
    by = {}
    for r in M.mix(docs).collect():
        t = by.setdefault((r["source_size"], r["target"]), [0, 0])
        t[0] += r["taken"]
        t[1] = max(t[1], r["size"])
    assert len(by) == 2 and all(abs(t - target) <= 1 for (_, target), (t, _) in by.items())
    words = {}
    for r in M.mixed_documents(docs).collect():
        words[r["source"]] = words.get(r["source"], 0) + len(WORD.findall(r["text"]))
    assert sorted(words.values()) == pytest.approx(sorted(target for _, target in by), abs=max(longest for _, longest in by.values()))


def test_no_task_sorts_copies(spark):
    """Rows that are equal reach the window as one row with a count."""
    docs = documents(spark, [doc(None, "one text", source="a")] * 500 + [doc(1, "other", source="b")])
    sizes = M.sized(docs)
    chosen = M.plan(sizes, M.targets(sizes))
    assert M._edge(M._meet(sizes, chosen), ["at", "doc_id", "size"]).select("source", "at", "n").distinct().count() <= 2
    assert M.mix(docs).count() == 501


def test_empty_and_wordless_tables(spark):
    assert M.mix(empty(spark)).count() == 0 == M.mixed_documents(empty(spark)).count()
    blank = documents(spark, [doc(1, None), doc(2, " ", source=None)])
    assert [(r["taken"], r["target"]) for r in M.mix(blank).collect()] == [(0, 0.0)] * 2
    assert M.mixed_documents(blank).count() == 0
