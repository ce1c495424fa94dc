import re

from edmart.llm import decontaminate as C
from tests_llm_values import LONG, MIXED

ITEM = "Anna Smith has 12 apples and gives 3 apples to Tom every 2 hours, how many apples are left after 12 hours"


def bench(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "item_id long, text string")


def found(docs, benchmark, **options):
    return {(r["doc_id"], r["item_id"]): r["changed_slots"] for r in C.contaminated(docs, benchmark, **options).collect()}


def test_exact_and_reparameterised_items(spark, texts):
    values = [
        ITEM,
        ITEM.replace("12", "40"),
        ITEM.replace("12 apples", "40 apples"),  # 12 stands for 40 and for 12
        "Well, " + ITEM.replace("Tom", "Bob") + " indeed.",
        ITEM.replace("3 apples", "2 apples"),  # 3 and 2 both become 2
        ITEM[:40],
        "nothing of this kind is in this text at all, nor in the next",
        ITEM + "\n" + ITEM.replace("12", "7"),
    ]
    got = found(texts(values), bench(spark, [ITEM, "Other words make up this second item, which no text has in it."]))
    assert got == {(0, 0): 0, (1, 0): 1, (3, 0): 1, (7, 0): 1}
    kept = C.keep_clean(texts(values), bench(spark, [ITEM]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 4, 5, 6]


def test_odd_rows(spark, texts):
    docs = texts([*MIXED, LONG, ITEM, ITEM], ids=[*range(len(MIXED)), 50, None, None])
    items = bench(spark, ["", None, "one", ITEM, ITEM])
    got = C.contaminated(docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(None, 3), (None, 4), (4, 2)}
    kept = C.keep_clean(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    assert found(docs, items.limit(0)) == {} == found(docs.limit(0), items)


def test_merged_and_broadcast_sides_agree(spark, texts):
    docs, items = texts([ITEM, "pad " * 30 + ITEM]), bench(spark, [ITEM])
    windows = C.benchmark_windows(items)
    small = C.matches(docs, windows).select("doc_id", "at", "shift").collect()
    large = C.matches(docs, windows, broadcast_windows=0).select("doc_id", "at", "shift").collect()
    assert sorted(small) == sorted(large) and small


def test_windows_equal_a_plain_search(spark, texts):
    words = "red green blue grey pink gold teal navy plum lime rust sand".split()
    item = " ".join(words)
    values = [" ".join(words[a:b]) for a in range(0, 6) for b in range(a + 4, 13)]
    want = {(i, 0) for i, v in enumerate(values) if len(re.findall(r"\w+", v)) - 7 >= 0.5 * 5}
    assert set(found(texts(values), bench(spark, [item]))) == want


def test_partial_passages_and_single_changes(spark, texts):
    words = [f"{a}{b}" for a in "kal mor ten vus rip dol".split() for b in "ane ilo uste ora inde emi oth ull egg arm".split()]
    long, short = " ".join(words), " ".join(words[40:58])
    cut = [" ".join(["before", *words[20 : 20 + n], "after"]) for n in (12, 13, 25)]
    changed = [" ".join([*words[40:k], "other", *words[k + 1 : 58]]) for k in range(40, 58)]
    assert set(found(texts(cut), bench(spark, [long]))) == {(1, 0), (2, 0)}
    assert {d for d, _ in found(texts(changed), bench(spark, [short]))} == set(range(18))


def test_items_dense_in_numbers_are_found_by_their_values(spark, texts):
    dense = "Find 3 + 4 + 5 + 6 + 7 + 8"
    longer = "Add 1 2 3 4 5 6 7 8 9 10 11 12 and tell the sum"
    docs = texts([f"Now: {dense}!", "Find 3 + 4 + 5 + 6 + 7 + 9", f"so {longer} now", "Find 3 things", "7", "8"])
    assert set(found(docs, bench(spark, [dense, longer, "7"]))) >= {(0, 0), (2, 1), (4, 2)}
    got = set(found(docs, bench(spark, [dense, longer])))
    assert got == {(0, 0), (2, 1)}
