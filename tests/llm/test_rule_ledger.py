import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from dealspark.llm import rule_ledger as R

from .helpers import WORD, documents, empty, hard_documents


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {p for i, w in enumerate(windows) if seen[w] > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)), "n_repeat_words": len(covered),
            "n_lines": len(lines), "n_adjacent_words": sum(a == b for a, b in zip(words, words[1:])),
            "n_letters": sum(c.isascii() and c.isalpha() for c in text), "n_capitals": sum(c.isascii() and c.isupper() for c in text)}


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.none(), st.lists(st.sampled_from(["a", "b", "A#", "é|", "\n", "\x0b", " ", "\x85", "\xa0", "𝒳"]), max_size=60).map(" ".join)))
def test_measurements(text):
    assert dict(zip(R.MEASURES, R.measure_text(text))) == brute(text)


def test_ledger_over_hard_rows(spark):
    rows = R.build_ledger(documents(spark)).collect()
    texts = hard_documents()
    assert len(rows) == len(texts)
    want = sorted((d[0] is None, d[0] or 0, *brute(d[1]).values()) for d in texts)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, *(r[m] for m in R.MEASURES)) for r in rows)
    assert got == want


def test_rules_set_their_bits(spark):
    bits = {r.name: 1 << r.bit for r in R.RULES}
    base = " ".join(f"word{i}" for i in range(40))
    cases = {"few_words": "only a few", "symbols": base + " ###" * 10, "adjacent_repeats": " ".join(f"w{i // 4}" for i in range(80)),
             "capitals": base.upper(), "word_length": " ".join("x" * 1 for _ in range(40)).replace("x", "é") + "",
             "duplicate_lines": "\n".join(["a b", "a b", "a b", "a b", "c d e f g h i j k l m n o p q r s t u v"])}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases.values())], "doc_id long, text string")
    got = {r["doc_id"]: r["fail_bits"] for r in R.build_ledger(df).collect()}
    for i, name in enumerate(cases):
        assert got[i] & bits[name], name
    clean = spark.createDataFrame([(1, base)], "doc_id long, text string")
    assert R.build_ledger(clean).first()["fail_bits"] == 0


def test_policies_and_ablations_read_the_ledger_only(spark):
    ledger = spark.createDataFrame([(1, 0), (2, 1), (3, 3), (4, 4), (5, 4), (6, 5)], "doc_id long, fail_bits long")
    kept = {p.name: sorted(r["doc_id"] for r in R.apply_policy(ledger, p).where("kept").collect()) for p in R.POLICIES}
    assert kept == {"base": [1, 4, 5], "clean": [1]}
    got = {(r["policy"], r["rule"]): (r["documents"], r["rejected"], r["failed_rule"], r["only_this_rule"]) for r in R.ablations(ledger).collect()}
    assert got["base", "few_words"] == (6, 3, 3, 2)
    assert got["base", "repeated_windows"] == (6, 3, 1, 0)
    assert got["clean", "symbols"] == (6, 5, 3, 2)


def test_the_query_equals_its_sql_on_other_scripts(spark, tmp_path):
    """One long Chinese text, capitals, hard rows: all bits, the verdict by version 2, what a rule costs."""
    import duckdb

    from dealspark.llm.oracle import RULE_LEDGER
    from dealspark.llm.queries import op3_rule_ledger

    base = " ".join(f"word{i}" for i in range(40))
    rows = [(1, " ".join("汉" * 59 + chr(0x4E00 + i) for i in range(25))), (2, base.upper()), (3, base), (4, "short"), (5, base + " ###" * 10), (6, " ".join("é" for _ in range(50))),
            (7, None), (8, ""), (9, "a few 词 words"), (10, base.upper().replace("W", "Ж").replace("O", "Ж"))]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = op3_rule_ledger(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    res = con.execute(RULE_LEDGER)
    columns = [c[0] for c in res.description]
    assert sorted(columns) == sorted(got.columns)
    want = res.fetchall()
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want)
    by = {r["doc_id"]: r for r in got.collect()}
    assert by[1]["kept"] and not by[1]["kept_clean_1"] and by[1]["fail_bits"] == 64
    assert not by[2]["kept"] and by[2]["only_rule"] == "ascii_capitals" and by[4]["only_rule"] == "few_words" and by[4]["given_back"] == 4


def test_filter_keeps_columns(spark):
    docs = documents(spark)
    out = R.filter_documents(docs)
    assert out.schema == docs.schema
    kept = R.apply_policy(R.build_ledger(docs), R.CLEAN).where("kept").count()
    assert 0 < out.count() == kept < docs.count()


def test_empty_table(spark):
    assert R.build_ledger(empty(spark)).count() == 0 == R.filter_documents(empty(spark)).count()


def test_clean_policy_keeps_other_scripts(spark):
    """Clean texts whose only Latin text is an acronym, and texts without spaces between words."""
    rng = random.Random(9)

    def prose(first, n, words, length, least=2):
        return " ".join("".join(chr(first + rng.randrange(n)) for _ in range(least + i % length)) for i in range(words))

    kept = [prose(0x430, 32, 300, 9) + " NATO", prose(0x3B1, 24, 300, 9) + " USA", prose(0x627, 26, 300, 7) + " OPEC",
            prose(0xAC00, 2000, 300, 5) + " KBS", prose(0x4E00, 3000, 30, 40, 50), prose(0x3042, 80, 30, 40, 50), prose(0xE01, 46, 30, 40, 50)]
    base = [f"Word{i}" for i in range(60)]
    gone = [" ".join(base).upper(), " ".join(w + "x" * 60 for w in base), " ".join("ÉTÉ" + w.upper() for w in base), " ".join("é" for _ in base)]
    df = spark.createDataFrame(list(enumerate(kept + gone)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in R.filter_documents(df).collect()) == list(range(len(kept)))
    ledger = R.build_ledger(df)
    assert sorted(r["doc_id"] for r in R.apply_policy(ledger, R.CLEAN).where("kept").collect()) == list(range(len(kept)))
    assert R.apply_policy(ledger, R.CLEAN_1).where("kept").count() == 0  # version 1 keeps its meaning
