"""Spelling variants: words one edit apart, found by pivotal bigrams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shiftpay.llm import shared
from shiftpay.sources.files import stage

#: What a word is made of, and the fewest letters and occurrences of one.
LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"
MIN_LETTERS = 5
MIN_COUNT = 3
#: A form occurs at least so many times as often as a variant of it.
TIMES = 2
#: Runs whose digest this number divides lose a letter.
NOISE = 97
#: Letters from which on the other side of a bigram is looked for by halves.
HALVED = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def occurring(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, run): the maximal runs of letters of all texts, A to Z lower-cased."""
    runs = F.regexp_extract_all(F.translate(F.col(text), _UPPER, _LOWER), F.lit(f"({LETTERS})"))
    return docs.select("doc_id", F.explode(runs).alias("run"))


def noisy(runs: DataFrame, noise: int = NOISE) -> Column:
    """The run, without one letter where the digest of ``<doc_id>:<run>`` says so."""
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    h, size = F.crc32(name.cast("binary")), F.char_length("run")
    at = (h % size).cast("int")
    left = F.substring(F.col("run"), F.lit(1), at)
    right = F.substring(F.col("run"), at + 2, size)
    return F.when(h % noise == 0, F.concat(left, right)).otherwise(F.col("run"))


def counted(
    docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, noise: int = NOISE
) -> DataFrame:
    """(word, n): the words of all texts, with one letter left out of every so many runs.

    Occurrences are added up in each task before any is shuffled.
    """
    if min_letters < 4:
        raise ValueError("words need four letters for a prefix of three bigrams")
    runs = occurring(docs).where(F.char_length("run") >= min_letters)
    words = runs.select(noisy(runs, noise).alias("word")).where(F.char_length("word") >= min_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _bigram_order(words: DataFrame) -> np.ndarray:
    """Words that hold each bigram, by its two Latin-1 numbers: 256 by 256 counts at most."""
    at = F.sequence(F.lit(1), F.char_length("word") - 1)
    grams = F.array_distinct(F.transform(at, lambda i: F.substring(F.col("word"), i, F.lit(2))))
    held = words.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    counts = np.zeros(1 << 16, np.int64)
    for row in held.collect():  # 90 letters, so 8100 bigrams at most
        first, second = row.gram.encode("latin-1")
        counts[first << 8 | second] = row.n
    return counts


def pivots(places: list[int], weights: list[int]) -> tuple[int, int]:
    """The two places, at least two apart, whose weights have the least sum.

    By dynamic programming from left to right: for each place the best one that ends two
    before it. Places ascend; the first and last of any three bigrams are two apart.
    """
    best, pair = None, (0, 0)
    left = 0  # places[:left] end two before the present one
    cheapest = None
    for place, weight in zip(places, weights):
        while places[left] <= place - 2:
            if cheapest is None or weights[left] < cheapest[0]:
                cheapest = (weights[left], places[left])
            left += 1
        if cheapest is not None and (best is None or cheapest[0] + weight < best):
            best, pair = cheapest[0] + weight, (cheapest[1], place)
    return pair


def _keys(
    sums: np.ndarray, side: np.ndarray, first: np.ndarray, stop: np.ndarray, size: np.ndarray, right_of: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of bigrams with the equal side ``side``, and the bigram that each belongs to.

    The other side runs from ``first`` to ``stop``; ``size`` is how long it is in the word
    that has the prefix. If that is long, the edit leaves one of its halves alone too: ``size
    // 2`` letters beside the bigram, or the rest at the far end. So there is a key for each.
    """
    whole = shared.mixed(side + size.astype(np.uint64) * np.uint64(shared.BASE))
    short, long = np.flatnonzero(size < HALVED), np.flatnonzero(size >= HALVED)
    half = size[long] // 2
    rest = size[long] - half
    a, b = first[long], stop[long]
    begin, end = (a, b - rest) if right_of else (b - half, a)
    near = shared.mixed(shared.substring_hashes(sums, begin, begin + half))
    far = shared.mixed(~shared.substring_hashes(sums, end, end + rest))
    keys = [whole[short], shared.mixed(whole[long] ^ near), shared.mixed(whole[long] ^ far)]
    return np.concatenate(keys), np.concatenate([short, long, long])


def _grams(counts: np.ndarray):
    """Words to the keys of their prefix bigrams and, marked, of their two pivots.

    Bigrams are ranked by the words that hold them, rare first. A word's prefix are its three
    first ones and all others of the third's rank. A bigram that an edit leaves alone has one
    side of the word unchanged beside it, so a key is that side together with the bigram, and
    how long the other side is: this is what the position limit comes to for one edit. A
    pivot is looked for with the other side a letter shorter, as long, and longer. Long other
    sides are told apart further by their halves, so that frequent beginnings and ends of
    words make no large groups.
    """
    order = np.lexsort((np.arange(1 << 16), counts))
    ranks = np.empty(1 << 16, np.int64)
    ranks[order] = np.arange(1 << 16)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(sizes)
            starts = ends - sizes
            data = np.frombuffer(b"".join(words), np.uint8)
            sums = shared.prefix_hashes(data)
            row = np.repeat(np.arange(len(words)), sizes - 1)
            at = starts[row] + shared.ranges(sizes - 1)
            gram = data[at].astype(np.int64) << 8 | data[at + 1]
            rank = ranks[gram]
            by_rank = np.lexsort((rank, row))
            firsts = np.cumsum(sizes - 1) - (sizes - 1)
            last = rank[by_rank][firsts + 2]  # of the third bigram of each word
            prefix = np.flatnonzero(rank <= last[row])
            row, at, weight = row[prefix], at[prefix], counts[gram[prefix]]
            cuts = np.searchsorted(row, np.arange(len(words) + 1)).tolist()
            places, weights = at.tolist(), weight.tolist()
            chosen = np.zeros(len(at), bool)
            for low, high in zip(cuts, cuts[1:]):
                pair = pivots(places[low:high], weights[low:high])
                chosen[low + np.searchsorted(at[low:high], pair)] = True
            left = shared.mixed(shared.substring_hashes(sums, starts[row], at + 2))
            right = shared.mixed(~shared.substring_hashes(sums, at, ends[row]))
            keys, rows, pivot = [], [], []
            for side, right_of in ((left, True), (right, False)):
                for step in (None, -1, 0, 1):
                    some = np.flatnonzero(chosen) if step is not None else np.arange(len(at))
                    first = at[some] + 2 if right_of else starts[row[some]]
                    stop = ends[row[some]] if right_of else at[some]
                    found, of = _keys(sums, side[some], first, stop, stop - first + (step or 0), right_of)
                    keys.append(found)
                    rows.append(row[some[of]])
                    pivot.append(np.full(len(of), step is not None))
            rows = np.concatenate(rows)
            taken = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(keys).view(np.int64)),
                    pa.array(np.concatenate(pivot)),
                    pa.array(last[rows]),
                    batch.column("word").take(taken),
                    batch.column("n").take(taken),
                ],
                ["key", "pivot", "last", "word", "n"],
            )

    return work


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): each pair of words one edit apart once, in either order.

    ``words`` are distinct, of Latin-1 letters and at least four of them. Of two words, let
    the first be the one whose prefix ends earlier in the order of bigrams. One of its pivots
    is untouched by the edit, since they are disjoint, and ranks no later than the other's
    prefix ends; so it is among that prefix, beside an equal side. Every meeting is verified
    by edit distance inside the join.
    """
    work = _grams(_bigram_order(words))
    schema = "key long, pivot boolean, last long, word string, n long"
    grams = stage(shared.mapped(words.select("word", "n"), work, schema), "bigrams")
    a, b = grams.where("pivot").alias("a"), grams.where("not pivot").alias("b")
    meet = (
        (F.col("a.key") == F.col("b.key"))
        & (F.col("a.last") <= F.col("b.last"))
        & (F.col("a.word") != F.col("b.word"))
        & (F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1)
    )
    first = F.col("a.word") < F.col("b.word")
    pair = [
        F.when(first, F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}")).alias(name)
        for x, y, c, name in (
            ("a", "b", "word", "word"), ("a", "b", "n", "n"),
            ("b", "a", "word", "other"), ("b", "a", "n", "other_n"),
        )
    ]
    return a.join(b, meet).select(*pair).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for each word of ``forms`` (word, form), by doubling the steps taken.

    A form occurs at least twice as often as its variant, so chains are short.
    """
    at = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(
            at.join(ahead, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """Per word of ``words`` (word, n): word, form, root, n, n_near, form_n.

    n_near counts the words one edit apart. The form is the one of them with the largest n
    (ties: first in code-point order), if that is at least ``times`` the word's, else null;
    root is the end of the chain of forms, the word itself if it has none. Each near pair
    counts once for both words; counts and the best are combined in each task, so a word with
    many variants is no large group. An empty table gives none.
    """
    words = stage(words, "words")
    pairs = stage(near_words(words), "near-words")
    both = pairs.unionByName(
        pairs.select(
            F.col("other").alias("word"), F.col("other_n").alias("n"),
            F.col("word").alias("other"), F.col("n").alias("other_n"),
        )
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"),
    )
    found = words.join(best, "word", "left")
    fits = -F.col("best.less") >= times * F.col("n")
    named = stage(
        found.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, F.col("best.other")).alias("form"),
            F.when(fits, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(named.where("form is not null"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, **limits: int) -> DataFrame:
    """The spelling variants among the words of all texts; see counted() and variants().

    A null or empty text has no words. A null doc_id is an empty one where the digest of a
    run is made. Repeated rows count as often as they occur. A run of any length is one
    word; the keys of a word take time and memory in proportion to its length. An empty table
    gives none.
    """
    return variants(counted(docs, **limits))
