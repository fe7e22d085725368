import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from shiftpay.llm import spelling

SCHEMA = "doc_id long, text string, word int, n string"


def plain_counts(rows, noise=97):
    found = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if n >= 3 and len(w) >= 5}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def plain_variants(n):
    near = defaultdict(list)
    words = sorted(n)
    for i, a in enumerate(words):
        for b in words[:i]:
            if is_near(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted(
        (w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else 0) for w in words
    )


def result(rows):
    return sorted(
        (r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in rows.collect()
    )


def documents():
    draw = random.Random(3)
    base = ["".join(draw.choices("abeé", k=draw.randint(4, 9))) for _ in range(60)]
    base += ["aaaaa", "aaaaaa", "aaaaaaa", "ababab", "bababa", "ababa", "Straße", "straÿe", "NAÏVE", "naÏve"]
    rows = []
    for i in range(120):
        words = draw.choices(base, weights=[1 + 40 // (k + 1) for k in range(len(base))], k=60)
        for k in range(len(words)):
            if draw.random() < 0.3:
                w, at = words[k], draw.randrange(len(words[k]))
                words[k] = w[:at] + draw.choice(["", "a", "b", "é", w[at] + "e"]) + w[at + 1 :]
        rows.append((i, draw.choice([" ", ", ", "3", "\n"]).join(words), 1, "x"))
    return rows + [
        (None, "abeabe abeabe abeabe", 1, None), (4, None, 1, ""), (4, "", 2, ""),
        (7, "twice again", 1, ""), (7, "twice again", 1, ""), (7, "twice again", 1, ""),
        (9, "z" * 3000 + " " + "z" * 3001, 1, ""),
        (9, "z" * 3000 + " " + "z" * 3001, 1, ""), (9, "z" * 3000 + "×" + "z" * 3001, 1, ""),
    ]


@pytest.mark.parametrize("noise", [97, 3])
def test_equals_brute_force(spark, noise):
    rows = documents()
    n = plain_counts(rows, noise)
    assert len(n) > 150
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert result(spelling.spelling_variants(docs, noise=noise)) == plain_variants(n)


def test_equals_brute_force_on_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    n = plain_counts(rows)
    found = result(spelling.spelling_variants(docs))
    assert {r[0]: r[3] for r in found} == n
    # all words one edit apart, by what is left when a letter goes
    by_rest = defaultdict(set)
    for w in n:
        for rest in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by_rest[rest].add(w)
    near = defaultdict(set)
    for some in by_rest.values():
        for a in some:
            near[a].update(b for b in some if b not in near[a] and is_near(a, b))
    assert [r[4] for r in found] == [len(near[r[0]]) for r in found]
    best = {w: min(near[w], key=lambda x: (-n[x], x), default=None) for w in n}
    form = {w: b if b and n[b] >= 2 * n[w] else "" for w, b in best.items()}
    assert [r[1] for r in found] == [form[r[0]] for r in found]


def test_pivots_are_the_cheapest_apart():
    draw = random.Random(2)
    for _ in range(500):
        places = sorted(draw.sample(range(12), draw.randint(3, 8)))
        weights = [draw.randint(1, 9) for _ in places]
        cost = dict(zip(places, weights))
        a, b = spelling.pivots(places, weights)
        assert b - a >= 2
        assert cost[a] + cost[b] == min(cost[x] + cost[y] for x in places for y in places if y - x >= 2)


def test_chain_of_forms(spark):
    words = [("abcdefgh", 3), ("abcdefg", 7), ("abcdef", 15), ("abcde", 31), ("bbcde", 31)]
    found = result(spelling.variants(spark.createDataFrame(words, "word string, n long")))
    assert found == plain_variants(dict(words))
    assert {r[2] for r in found} == {"abcde", "bbcde"}


def test_short_words_are_refused(spark):
    docs = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        spelling.spelling_variants(docs, min_letters=3)


def test_empty_table(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], SCHEMA)).count() == 0
