import re

from tidemark.llm import quality_rules as q

CASES = [
    (1, "eins zwei drei vier fuenf sechs sieben acht neun zehn " * 3),
    (2, " ".join(f"w{k}" for k in range(40))),
    (3, "a b c d e f g h a b c d e f g h"),
    (4, "a a a a a a a a a"),
    (5, "x " * 7), (6, "x " * 8), (7, "x " * 9),
    (8, "line one\nline one\n\n \nline two\nline one"),
    (9, "#a$ *b* <c> | %d& é ß \U0001F600 \x0b\x0cend"),
    (10, None), (11, ""), (12, " \t\r\n"),
    (13, "GROSS UND LAUT!! " * 12),
    (14, " ".join(f"w{k}" for k in range(8)) + " mid " + " ".join(f"w{k}" for k in range(8))),
]


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    covered = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }


def test_measures_match_brute_force(spark, edges):
    rows = spark.createDataFrame(CASES, "doc_id long, text string")
    got = q.quality_rules(rows.unionByName(edges.select("doc_id", "text"))).collect()
    texts = {**dict(CASES)}
    for r in got:
        text = r["text"]
        want = brute(text) if text is None or len(text) < 10_000 else {"n_words": 30_000, "n_repeat_words": 30_000}
        assert {k: r[k] for k in want} == want, text and text[:50]
        base = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == base and r["base_failed"] == (r["failed"] & q.BASE != 0)
        assert r["kept"] == (r["failed"] == 0)
    assert len(got) == len(texts) + edges.count()


def test_clean_prose_is_kept_and_columns_survive(spark, edges):
    prose = "Plain words of a calm sentence, none of them odd. " + " ".join(f"and{k} more" for k in range(20))
    rows = spark.createDataFrame([(1, prose, "mine")], "doc_id long, text string, failed string")
    assert [tuple(r) for r in q.accepted(rows).collect()] == [(1, prose, "mine")]
    assert q.accepted(edges).columns == edges.columns


def test_versions_and_ablation(spark):
    book = spark.createDataFrame([(0,), (1,), (1,), (3,), (4,), (12,), (128,)], "failed long")
    kept = {v: q.apply_policy(book, v).where("kept").count() for v in q.POLICIES}
    assert kept == {"v1": 4, "v2": 2, "v3": 1}
    table = {r["rule"]: tuple(r)[1:] for r in q.ablation(book, "v2").collect()}
    assert table["few_words"] == (3, 2, 4) and table["repeated_passages"] == (1, 0, 2)
    assert table["symbols"] == (2, 1, 3) and table["duplicate_lines"] == (1, 0, 2)
    assert [tuple(r)[1:] for r in q.ablation(book.limit(0), "v1").collect()] == [(0, 0, 0)] * 2


def test_bits_are_unique():
    assert len({r.bit for r in q.RULES}) == len(q.RULES) == len({r.name for r in q.RULES})


def test_empty_table(spark, nothing):
    assert q.quality_rules(nothing).count() == 0 and q.accepted(nothing).count() == 0
