import random

from helpers_llm import DOCS, W
from interlens.llm import quality_rules as q


def brute(text):
    t = text or ""
    w = W.findall(t)
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {i + j for at in seen.values() if len(at) > 1 for i in at for j in range(3)}
    lines = [x for x in t.split("\n") if W.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def rows(df):
    return {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
            for r in df.collect()}


def test_equals_brute_force(frame):
    rnd = random.Random(9)
    texts = [None, "", " \n\t", "a", "a b c", "a a a a a", "x\n\n x\nx\n", "😀 é😀 z <b>", "a\u000bb\fc\rd"]
    for _ in range(80):
        texts.append("".join(rnd.choice(["a ", "b\n", "the ", "#%", "é", " \n", "\t", "Q", "c d e "])
                             for _ in range(rnd.randint(0, 200))))
    texts.append("long " * 30000)
    got = rows(q.quality_rules(frame(texts)))
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_verdicts(frame):
    rnd = random.Random(1)
    clean = " ".join(rnd.choice(["the", "of", f"word{i}", f"thing{i}"]) for i in range(120))
    bad = {"symbols": " ".join(w + "%%" for w in clean.split()), "capitals": clean.upper(),
           "stop_words": " ".join(f"qu{i}x" for i in range(120)), "too_short": "the end",
           "repeats": "the same words " * 50, "duplicate_lines": "\n".join(f"line the {i // 2}" for i in range(60))}
    out = {r.doc_id: r for r in q.quality_rules(frame([clean, *bad.values()])).collect()}
    assert out[0].kept and out[0].failed_rules == []
    for i, name in enumerate(bad, 1):
        assert not out[i].kept and name in out[i].failed_rules


def test_native_plan_builds_arrays_once(frame, capsys):
    q.quality_rules(frame(["a"])).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Exchange hash" not in plan
    assert plan.count("split(t") <= 3


def test_empty_table(spark):
    assert q.quality_rules(spark.createDataFrame([], DOCS)).collect() == []


def test_rows_without_id_and_repeated_rows(spark):
    """Rows go by themselves: those without an id and repeated ones each have a result."""
    d = spark.createDataFrame([(None, "a b c"), (1, "a a a a a"), (1, "a a a a a"), (2, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_repeat_words) for r in q.quality_rules(d).collect()), key=str)
    assert got == [(1, 5, 5), (1, 5, 5), (2, 0, 0), (None, 3, 0)]


def test_very_long_text(frame):
    texts = ["w%d " * 3 % (1, 2, 3) + " ".join(f"v{i % 70_000}" for i in range(250_000))]       # 1.7 MB
    assert rows(q.quality_rules(frame(texts))) == {0: brute(texts[0])}
