"""New-source pipeline in batch and as a stream."""

import pytest

from edmart.operators import match
from edmart.operators.normalise import normalise_sources, normalise_universities
from edmart.plans import linking
from edmart.streaming import new_sources
from tests.conftest import rows

RAW = "source_id string, source_name string, source_base_url string"


@pytest.fixture
def universities(frame):
    unis = frame([(1, "Foo", "foo.edu", None), (2, "Bar", "bar.edu", "kept"), (3, "Quux", "quux.edu", None)],
                 "unitid int, instnm string, webaddr string, university_distinct_id string")
    return normalise_universities(unis)


def sources(frame, data):
    return normalise_sources(frame(data, RAW))


def ids(spark, *names):
    df = spark.createDataFrame([(n,) for n in names], "distinct_name string")
    return dict(df.select("distinct_name", linking.name_id()).collect())


def test_pipeline(spark, frame, universities):
    old = sources(frame, [("1", "Foo src_1", "http://foo.edu")])
    known = linking.register_distinct(old)
    linked = linking.link_sources(old, known)
    new = sources(frame, [("2", "Foo graduate src_2", "http://www.foo.edu/x"), ("3", "Baz", "http://cs.bar.edu"),
                          ("4", "Nowhere", "http://nowhere.org")])
    stored = linked.unionByName(new, allowMissingColumns=True)
    out = linking.on_new_sources(new, stored, known, universities)
    name = ids(spark, "foo", "baz", "nowhere")
    assert rows(out.distinct_sources, "distinct_name") == [("baz",), ("foo",), ("nowhere",)]
    assert rows(out.sources, "source_id", "source_distinct_id") == [
        ("1", name["foo"]), ("2", name["foo"]), ("3", name["baz"]), ("4", name["nowhere"]),
    ]
    assert rows(out.universities, "unitid", "university_distinct_id") == [(1, name["foo"]), (2, name["baz"]), (3, None)]
    again = linking.on_new_sources(new, out.sources, out.distinct_sources, out.universities)
    for first, second in zip(out, again):
        assert rows(first) == rows(second)


def test_only_new_sources_are_linked(frame, universities):
    both = sources(frame, [("1", "Foo", None), ("2", "Bar", None)])
    known = linking.register_distinct(both)
    got = linking.link_sources(both, known, only=both.filter("source_id = '2'"))
    assert [r[1] is None for r in rows(got, "source_id", "source_distinct_id")] == [True, False]


def test_back_fill_takes_the_first_name(spark, frame, universities):
    data = sources(frame, [("1", "Zeta", "http://a.foo.edu"), ("2", "Alpha", "http://b.foo.edu"), ("3", "Other", None)])
    linked = linking.link_sources(data, linking.register_distinct(data))
    got = linking.back_fill_universities(linked, universities)
    assert rows(got, "unitid", "university_distinct_id") == [(1, ids(spark, "alpha")["alpha"]), (2, "kept"), (3, None)]


def test_stream_equals_batch(spark, frame, universities, tmp_path):
    inbox, base = str(tmp_path / "inbox"), str(tmp_path / "state")
    batches = [
        [("1", "Foo src_1", "http://foo.edu"), ("2", "Nowhere", "http://n.org")],
        [("3", "Nowhere graduate", "http://n.org"), ("4", "Baz", "http://cs.bar.edu")],
        [("5", "Quux College", None)],
    ]
    everything = frame([r for b in batches for r in b], RAW)
    known = linking.new_distinct_names(sources(frame, [("0", "Foo", None)])).select("distinct_id", "distinct_name")
    for batch in batches:
        frame(batch, RAW).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).parquet(inbox)
        query = new_sources.start(stream, base, str(tmp_path / "checkpoint"), lambda: universities, known)
        assert query.awaitTermination(120)
    all_sources = normalise_sources(everything)
    batch_out = linking.on_new_sources(all_sources, all_sources, known, universities)
    assert rows(new_sources.distinct_sources(spark, base, known), "distinct_id", "distinct_name") == rows(
        batch_out.distinct_sources, "distinct_id", "distinct_name")
    assert rows(new_sources.linked_sources(spark, base, all_sources), "source_id", "source_distinct_id") == rows(
        batch_out.sources, "source_id", "source_distinct_id")
    assert rows(new_sources.stamped_universities(spark, base, universities), "unitid", "university_distinct_id") == rows(
        batch_out.universities, "unitid", "university_distinct_id")


def test_replayed_batch_leaves_the_same_result(spark, frame, universities, tmp_path):
    base = str(tmp_path / "state")
    first = frame([("1", "Foo", "http://foo.edu")], RAW)
    second = frame([("2", "Foo src_2", "http://foo.edu"), ("3", "Bar", None)], RAW)
    assert rows(new_sources.distinct_sources(spark, base)) == []
    for batch_id, batch in [(0, first), (1, second), (1, second), (1, second)]:
        new_sources.process_batch(batch, batch_id, base, universities)
    assert rows(new_sources.distinct_sources(spark, base), "distinct_name") == [("bar",), ("foo",)]
    stored = spark.read.parquet(f"{base}/source_links")
    assert rows(stored, "source_id", "batch_id") == [("1", 0), ("2", 1), ("3", 1)]


def test_last_batch_stamps_a_university(spark, frame, universities, tmp_path):
    base = str(tmp_path / "state")
    new_sources.process_batch(frame([("1", "Aaa", "http://foo.edu")], RAW), 0, base, universities)
    new_sources.process_batch(frame([("2", "Zzz", "http://foo.edu")], RAW), 1, base, universities)
    got = dict(rows(new_sources.stamped_universities(spark, base, universities), "unitid", "university_distinct_id"))
    assert got == {1: ids(spark, "zzz")["zzz"], 2: "kept", 3: None}


def test_many_batches_keep_each_name_once(spark, frame, universities, tmp_path):
    inbox, base = str(tmp_path / "inbox"), str(tmp_path / "state")
    data = [[(f"{b}-{i}", f"Name {(b + i) % 9} src_{b}", f"http://h{i}.org") for i in range(4)] for b in range(12)]
    for batch in data:
        frame(batch, RAW).coalesce(1).write.mode("append").parquet(inbox)
    stream = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).parquet(inbox)
    running = new_sources.start(stream, base, str(tmp_path / "checkpoint"), lambda: universities)
    assert running.awaitTermination(300)
    assert rows(spark.read.parquet(f"{base}/first_seen"), "distinct_name") == [(f"name {i}",) for i in range(9)]
    assert not (tmp_path / "state" / "distinct_sources").exists()  # no batch looks names up
    # a batch brings all names again: none is new, and the state store needs no earlier file
    frame([("x", "Name 3", None), ("y", "Name 8", None), ("z", None, None)], RAW).coalesce(1).write.mode("append").parquet(inbox)
    assert new_sources.start(stream, base, str(tmp_path / "checkpoint"), lambda: universities).awaitTermination(300)
    assert spark.read.parquet(f"{base}/first_seen").count() == 9
    linked = dict(rows(spark.read.parquet(f"{base}/source_links"), "source_id", "source_distinct_id"))
    assert linked["x"] == ids(spark, "name 3")["name 3"] and "z" not in linked and len(linked) == 50


def test_a_source_with_a_stored_index_reads_no_university(spark, frame, universities, tmp_path):
    path = str(tmp_path / "index")
    match.UniversityIndex.build(universities.filter("unitid < 3")).save(path)
    match.UniversityIndex.load(spark, path).add(universities.filter("unitid >= 3"), path)
    index = match.UniversityIndex.load(spark, path)
    new = sources(frame, [("1", "Quux College", None), ("2", "x", "http://a.bar.edu"), ("3", "fo", None), ("4", "zzz", None)])
    want = rows(match.choices(new, match.UniversityIndex.build(universities)).select("source_name", "best.unitid"))
    assert rows(match.choices(new, index).select("source_name", "best.unitid")) == want
    assert [u for _, u in want] == [1, 3, 2, None] or sorted(u or 0 for _, u in want) == [0, 1, 2, 3]


@pytest.mark.parametrize("seed", range(2))
def test_new_universities_meet_old_sources(spark, frame, seed):
    import random

    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 6)))
    data = sources(frame, [(str(i), word(), f"http://{word()}.{word()}.edu" if i % 3 else None) for i in range(60)])
    unis = normalise_universities(frame([(i, word(), f"{word()}.edu") for i in range(30)], "unitid int, instnm string, webaddr string"))
    matched = match.choices(data, match.UniversityIndex.build(unis.filter("unitid < 10")))
    for low, high in ((10, 20), (20, 30)):
        matched = linking.on_new_universities(matched, data, unis.filter(f"unitid >= {low} AND unitid < {high}"))
    want = match.choices(data, match.UniversityIndex.build(unis))
    assert rows(matched.select("source_name", "best.*")) == rows(want.select("source_name", "best.*"))
