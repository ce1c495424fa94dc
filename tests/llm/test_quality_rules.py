import contextlib
import io
import math
import random
import re
from collections import Counter

from edmart.llm import quality_rules as Q
from edmart.llm.shared import words
from tests_llm_values import LONG, MIXED

SPACE = r"[^\x20\x09-\x0D]+"


def counts(text):
    text = text or ""
    tok = re.findall(SPACE, text)
    windows = Counter(tuple(tok[k : k + 5]) for k in range(len(tok) - 4))
    covered = {k + j for k in range(len(tok) - 4) if windows[tuple(tok[k : k + 5])] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(SPACE, x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(tok), sum(map(len, tok)), symbols, len(lines) - len(set(lines)), len(covered)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_counts_equal_a_plain_count(spark, texts):
    values = [*MIXED, "a b c d e " * 3, "a a a a a a a", "x\ny\nx\n \n\nx", "é | <b> ## ✓", LONG]
    docs = texts(values)
    got = Q.judge(docs.select("doc_id", "text"), docs, labels(spark, []))
    rows = {r["doc_id"]: tuple(r[c] for c in Q.COUNTS) for r in got.collect()}
    assert rows == {i: counts(t) for i, t in enumerate(values)}


def test_base_rules_and_verdict(spark, texts):
    good = "plain words stand here in one long and quite ordinary line of text"
    junk = "plain!! words!! stand!! here!! in!! one!! long!! and!! quite!! ordinary!! line!! of!! text!!"
    docs = texts([good] * 6 + [junk] * 6 + ["too short", None, "r " * 30])
    taught = labels(spark, [(i, 1, 0) for i in range(5)] + [(6, 0, 0), (5, None, None), (7, 1, 1)])
    rows = {r["doc_id"]: r for r in Q.judge(docs.select("doc_id", "text"), docs, taught).collect()}
    assert [rows[i]["kept"] for i in range(15)] == [True] * 6 + [False] * 9
    assert [rows[i]["base_failed"] for i in range(15)] == [False] * 12 + [True] * 3
    kept = Q.keep_good(docs, taught)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(6))


def test_without_trusted_texts_only_the_counts_decide(spark, texts):
    docs = texts(["some words that are enough for the least number of words here"] * 2)
    assert Q.keep_good(docs, labels(spark, [])).count() == 2
    assert Q.keep_good(docs.limit(0), labels(spark, [])).count() == 0


def test_weights_are_log_ratios_of_smoothed_counts(spark, texts):
    import math

    docs = texts(["aaa bbb", "aaa ccc"])
    weights = Q.bucket_weights(docs, labels(spark, [(0, 1, 0)]), 64).first()["weights"]
    at = docs.limit(1).select(Q.bucket(Q.endings(words(docs["text"]))[0], 64).alias("b")).first()["b"]
    ends = docs.select(Q.endings(words(docs["text"])).alias("h")).collect()
    n_raw = sum(1 for r in ends for h in r["h"] if h % 64 == at)
    n_good = sum(1 for h in ends[0]["h"] if h % 64 == at)
    assert math.isclose(weights[at], math.log((n_good + 1) / 66) - math.log((n_raw + 1) / 68))


def test_repeated_rows_are_judged_each(spark, texts):
    docs = texts(["w " * 5] * 3, ids=[1, 1, None])
    assert Q.judge(docs.select("doc_id", "text"), docs, labels(spark, [])).count() == 3


def test_every_place_of_a_word_counts(spark, texts):
    rng = random.Random(5)
    known = "river stone window garden letter morning silver market winter bridge candle forest".split()

    def prose():
        return " ".join(rng.choice(known) for _ in range(60))

    def marked(mark):
        return " ".join(mark(w) for w in prose().split())

    starts = [marked(lambda w: "##" + w) for _ in range(4)]
    middles = [marked(lambda w: w[:2] + "%%" + w[2:]) for _ in range(4)]
    docs = texts([prose() for _ in range(30)] + starts + middles)
    taught = labels(spark, [(i, 1, 0) for i in range(20)] + [(30, 0, 0), (34, 0, 0)])
    assert sorted(r["doc_id"] for r in Q.keep_good(docs, taught).collect()) == list(range(30))


def test_word_order_counts(spark, texts):
    line = "one two three four five six seven eight nine ten eleven twelve".split()
    docs = texts([" ".join(line)] * 8 + [" ".join(line[::-1])] * 4)
    taught = labels(spark, [(i, 1, 0) for i in range(5)] + [(8, 0, 0)])
    assert sorted(r["doc_id"] for r in Q.keep_good(docs, taught).collect()) == list(range(8))


def test_cut_follows_its_rule(spark, texts):
    docs = texts([f"w{i % 7} " * 2 + " ".join(f"a{i}{k}" for k in range(12)) for i in range(40)])
    taught = labels(spark, [(i, int(i % 3 > 0), 0) for i in range(30)])
    weights = Q.bucket_weights(docs, taught)
    scores = {r["doc_id"]: r["llr"] for r in Q.judge(docs.select("doc_id", "text"), docs, taught).collect()}
    marks = sorted((scores[i], i % 3 > 0) for i in range(30))
    values = sorted({s for s, _ in marks})
    best, want = 0.0, float("-inf")
    for low, high in zip(values, values[1:]):
        below = [good for s, good in marks if s <= low]
        gain = below.count(False) - below.count(True)  # labels put right less labels put wrong
        if gain > best:
            best, want = gain, (low + high) / 2
    got = Q.best_cut(docs, taught, weights).first()["cut"]
    assert got == want or abs(got - want) < 1e-9


def test_cut_reads_every_label(spark):
    # 3,000 texts of each side: the scores of all of them decide, none stands for others
    rng = random.Random(3)
    marks = [(rng.random() + 0.2 * (i % 2), i % 2 == 1) for i in range(6000)]
    best, want, gain = 0, float("-inf"), 0
    ordered = sorted(marks)
    for (low, good), (high, _) in zip(ordered, ordered[1:]):
        gain += -1 if good else 1
        if gain > best:
            best, want = gain, (low + high) / 2
    got = Q.lowest_error_cut(spark.createDataFrame(marks, "llr double, good boolean")).first()["cut"]
    assert best > 0 and got == want


def test_figures_without_text_are_the_same(spark, texts):
    line = "one two three four five six seven eight nine ten eleven twelve"
    values = [*MIXED, LONG, None, "", "a", "ab cd", "é𝄞 ✓", line, line, *[line[:k] for k in range(14, 34)]]
    docs = texts(values, ids=[None, 1, 1, *range(3, len(values))]).select("doc_id", "text")
    taught = labels(spark, [(i, i % 2, 0) for i in range(8, len(values))])

    def rows(df):
        return sorted(df.select("doc_id", *Q.COUNTS, "llr", "kept").collect(), key=str)

    whole, thin = rows(Q.judge(docs, docs, taught)), rows(Q.judge(docs, docs, taught, with_text=False))
    assert len(whole) == len(thin) == len(values) and any(r["llr"] != 0 for r in thin)
    for a, b in zip(whole, thin):
        assert [a[c] for c in ("doc_id", *Q.COUNTS, "kept")] == [b[c] for c in ("doc_id", *Q.COUNTS, "kept")]
        assert math.isclose(a["llr"], b["llr"], rel_tol=1e-9, abs_tol=1e-12)


def test_character_grams_are_weighed_in_short_generated_code(spark, texts):
    docs = texts(["some words that are enough for the least number of words here"]).select("doc_id", "text")
    weights = Q.stored(Q.bucket_weights(docs, labels(spark, [(0, 1, 0)])), "ngram-weights")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        shown = io.StringIO()
        with contextlib.redirect_stdout(shown):
            Q.figures(docs, weights).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert "hash(substring(piece" in shown.getvalue()
    # the virtual machine does not compile a method beyond 8,000 bytes
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue()))) < 8000
