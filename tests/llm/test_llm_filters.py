from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from compare import connect, differences
from shiftpay.llm import line_dedup, toxicity, url_filters

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op2_url_filters", "op6_line_dedup"])
def test_query_equals_sql(spark, name):
    found = contract.queries()[name](spark, SMALL)
    assert differences(found, connect(SMALL), contract.oracle_sql()[name]) == []


def test_urls_by_date_and_longest_pattern(spark):
    entries = spark.createDataFrame(
        [
            ("b.com", "block", date(2024, 1, 10)), ("b.com", "remove", date(2024, 2, 10)),
            ("a.b.com", "allow", date(2024, 1, 20)), ("a.b.com", "BLOCK", date(2024, 1, 25)),
            ("a.b.com", "allow", date(2024, 1, 25)), ("x.org", "remove", date(2024, 1, 1)),
            (None, "block", date(2024, 1, 1)), ("c.com", None, date(2024, 1, 1)),
            ("d.com", "block", None), ("e.com", "noise", date(2024, 1, 1)), ("com", "block", date(2020, 1, 1)),
        ],
        "pattern string, action string, dated date",
    )
    cases = [
        ("http://b.com/x", date(2024, 1, 9), None), ("http://b.com/x", date(2024, 1, 10), "block"),
        ("HTTPS://u:p@W.B.com.:80/x?y#z", date(2024, 2, 9), "block"), ("http://b.com", date(2024, 2, 10), None),
        ("http://a.b.com/", date(2024, 1, 19), "block"), ("http://a.b.com/", date(2024, 1, 20), "allow"),
        ("http://z.a.b.com/", date(2024, 1, 25), "block"), ("http://a.b.com/", date(2024, 3, 1), "block"),
        ("http://x.org/", date(2024, 3, 1), None), ("http://c.com/", date(2024, 3, 1), None),
        ("http://d.com/", date(2024, 3, 1), None), ("http://e.com/", date(2024, 3, 1), None),
        (None, date(2024, 1, 10), None), ("no url", date(2024, 1, 10), None), ("http://b.com/x", None, None),
        ("http://localhost/", date(2024, 1, 10), None), ("http://b.com/x", date(2024, 1, 10), "block"),
    ]
    rows = [(k, u, d, "old", "old") for k, (u, d, _) in enumerate(cases)]
    captures = spark.createDataFrame(rows, "id long, url string, fetched date, action string, _salt string")
    found = {r.id: r for r in url_filters.filter_urls(captures, entries).collect()}
    assert len(found) == len(cases)
    for k, (_, _, action) in enumerate(cases):
        assert found[k].action == action
        assert found[k].kept == (action != "block")
        assert found[k]._salt == "old"
    assert url_filters.filter_urls(captures.limit(0), entries).count() == 0
    assert url_filters.filter_urls(captures, entries.limit(0)).where("kept").count() == len(cases)


def test_templates_are_dropped_but_for_the_first(spark):
    body = "Nobody else says {} of all these words here"
    rows = []
    for i in range(12):
        text = [body.format(w) for w in (f"word{chr(97 + i)}one", f"other{chr(97 + i)}two")]
        text.insert(i % 3, f"Page {i} of 12 was printed on 2024-01-{i:02d}")
        text.append(f"Signed in as user {'abcdefghijkl'[i]}x from the office of records")
        text += ["", "}", "All rights reserved here."]
        rows.append((i, "\n".join(text), "k"))
    rows += [(50, None, "k"), (51, "", "k"), (None, "All rights reserved here.", "k"), (3, rows[3][1], "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string")
    found = line_dedup.drop_recurring_lines(docs.repartition(3)).collect()
    assert len(found) == len(rows) and found[0].__fields__ == ["doc_id", "text", "id", "n_lines", "n_dropped"]
    before = {r[0]: r[1] for r in rows}
    for r in found:
        if r.doc_id == 50:
            assert (r.text, r.n_lines, r.n_dropped) == (None, 0, 0)
        elif r.doc_id == 51:
            assert (r.text, r.n_dropped) == ("", 0)
        elif r.doc_id is None:
            assert (r.text, r.n_dropped) == ("", 1)
        elif r.doc_id == 0:
            assert r.text == before[0]
        else:
            own = [x for x in before[r.doc_id].split("\n") if x.startswith("Nobody") or len(x) < 2]
            assert r.text.split("\n") == own and r.n_dropped == 3
    assert line_dedup.drop_recurring_lines(docs.limit(0)).count() == 0


def test_lines_equal_the_sql_on_hard_rows(spark):
    import random

    draw = random.Random(2)
    words = "a b c 1 x2 <*> é \t".split(" ")
    rows = [
        (draw.choice([None, *range(30)]), "\n".join(" ".join(draw.choices(words, k=draw.randint(0, 6))) for _ in range(8)))
        for _ in range(60)
    ]
    names = ["<*>", "ann", "bob", "eve", "mia", "zoe", "x2", "kim", "lou", "tom"]
    for i in range(200, 260):
        one, two = draw.choices(names, k=2)
        text = [
            f"Jan 3 10:22 host user {one} logged in from home",
            f"Jan 3 10:22 host disk {two} failed to mount today",
            f"Jan 3 10:22 host user {two} failed in from {one}",
            " ".join(["many words", one, "go", two] * draw.choice([3, 9, 10])),
            draw.choice(["Short head", "Long single headings", "漢字" * draw.choice([4, 9, 60])]),
        ]
        rows.append((i, "\n".join(draw.sample(text, 3))))
    rows += [(99, None), (100, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").dropDuplicates(["doc_id"])
    db = connect(SMALL)
    db.register("held", docs.toPandas().astype({"doc_id": "Int64"}))
    db.execute("DROP VIEW documents")
    db.execute("CREATE VIEW documents AS SELECT * FROM held")
    found = line_dedup.drop_recurring_lines(docs).selectExpr(
        "doc_id", "n_lines", "n_dropped", "cast(char_length(text) as bigint) n_chars_left", "md5(text) text_md5"
    )
    assert differences(found, db, contract.oracle_sql()["op6_line_dedup"]) == []


def lines_dropped(spark, texts):
    rows = list(enumerate(texts))
    found = line_dedup.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    return sum(r.n_dropped for r in found.collect())


def test_families_of_one_leaf(spark):
    names = "ann bob eve mia zoe kim lou tom sue max pia joe".split()
    users = [f"Jan 3 10:22 host user {x} logged in from home" for x in names]
    disks = [f"Jan 3 10:22 host disk {x} failed to mount today" for x in names]
    assert lines_dropped(spark, users) == 11
    assert lines_dropped(spark, users + disks) == 22
    assert lines_dropped(spark, users + disks * 3) == 11 + 35  # copies go too, but count once
    often = [f"{'abcd'[i]}\n{disks[0]}" for i in range(4)]  # a name in both families, often in one
    assert lines_dropped(spark, users + disks[1:] + often) == 11 + 14


def test_unrelated_and_numeric_lines_stay(spark):
    assert lines_dropped(spark, [f"This is a great {x}" for x in ("book", "film", "car", "city")]) == 0
    assert lines_dropped(spark, ["12 40 7", "88 2 3", "1 2 3", "9 9 9", "Temperature 3 4 5", "Temperature 5 4 4", "Temperature 1 1 1"]) == 0
    assert lines_dropped(spark, [f"{x}\n}}\n---\nPage 7" for x in range(40)]) == 0


def test_short_long_and_space_free_lines(spark):
    def held(line, n):
        return lines_dropped(spark, [f"{'abcdefghijkl'[i]}\n{line}" for i in range(n)])

    assert held("利用規約と個人情報保護方針", 3) == 2 and held("利用規約と個人情報保護方針", 2) == 0
    assert held(" ".join(f"{x}{y}" for x in "abcdefgh" for y in "stuvwxyz"), 2) == 1
    assert held("And ornd.", 12) == 11 and held("And ornd.", 9) == 0


def test_templates_among_null_ids(spark):
    rows = [(None, f"a b c d {w} f g h i") for w in ("xx", "yy", "zz", "vv", "vv")]
    found = line_dedup.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    left = [r.text for r in found if r.text]
    assert len(found) == 5 and len(set(left)) == 1 and sum(r.n_dropped for r in found) == 5 - len(left)


def toxic_rows(n):
    draw = np.random.default_rng(6)
    words = np.array(["".join(draw.choice(list("aeiounrst"), 4)) for _ in range(400)])
    rows, labels = [], []
    for i in range(n):
        text = draw.choice(words, draw.integers(5, 120)).tolist()
        toxic = i % 5 == 0
        if toxic:
            for w in ("wretched", "vermin", "loathsome"):
                text.insert(draw.integers(0, len(text)), w)
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = toxic_rows(1200)
    docs = spark.createDataFrame([*rows, (5000, None), (5001, "")], "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (None, 1), (7000, 1), (5, None), (6, 7)], "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    found = toxicity.scored(docs.withColumns({"score": docs.doc_id}), model).collect()
    assert found[0].__fields__ == ["doc_id", "text", "score", "predicted"]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    by_id, kept = {r.doc_id: r for r in found}, spark.createDataFrame(labels, "doc_id long, toxic int")
    apart = [r.doc_id for r in kept.where(toxicity.held_out(kept.doc_id)).collect()]
    assert 150 < len(apart) < 450
    right = [by_id[i].predicted == labels[i][1] for i in apart]
    assert np.mean(right) > 0.97
    assert by_id[5000].score == by_id[5001].score
    changed = marks.withColumn("toxic", (1 - marks.toxic) * toxicity.held_out(marks.doc_id).cast("int") + marks.toxic * (1 - toxicity.held_out(marks.doc_id).cast("int")))
    again = toxicity.train(docs, changed)
    assert (again.weights == model.weights).all() and again.bias == model.bias


def test_a_very_long_text_leaves_the_others_in_the_fit(spark):
    rows, labels = toxic_rows(400)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    usable = marks.where(~toxicity.held_out(marks.doc_id))
    first = usable.where("toxic = 1").orderBy(F.xxhash64("doc_id"), "doc_id").first().doc_id
    longer = F.when(docs.doc_id == first, F.expr("repeat('a long text ', 800000)")).otherwise(docs.text)
    model = toxicity.train(docs.withColumn("text", longer), marks)
    found = toxicity.scored(docs, model).collect()
    assert np.mean([r.predicted == labels[r.doc_id][1] for r in found]) > 0.95


def test_a_class_of_very_long_texts_only(spark):
    rows, labels = toxic_rows(60)
    docs = spark.createDataFrame(rows, "doc_id long, text string").where("doc_id % 5 > 0 or doc_id < 20")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    longer = F.expr("if(doc_id % 5 = 0, repeat(text, 1 + cast(9000000 / length(text) as int)), text)")
    assert toxicity.train(docs.withColumn("text", longer), marks).weights.any()


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    found = toxicity.scored(docs, toxicity.train(docs, none)).collect()
    assert [r.predicted for r in found] == [0, 0]
    assert toxicity.scored(docs.limit(0), toxicity.train(docs, none)).count() == 0
