"""Line dedup by a log-template tree: recurring templates are dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shiftpay.llm import shared
from shiftpay.sources.files import stage

#: Leading tokens that, beside the token count, name a leaf of the tree.
DEPTH = 4
#: Share of the tokens after the leading ones that lines of a template have in common.
SIMILARITY = 0.7
#: Words after the leading ones that a template keeps, at least, if its lines have as many.
MIN_WORDS = 2
#: Different texts that a template must occur in to count as recurring.
MIN_DOCUMENTS = 3
#: For long lines two are enough: so many tokens, or so many bytes in at most DEPTH tokens.
LONG_DOCUMENTS, LONG_TOKENS, LONG_BYTES = 2, 50, 300
#: Lines under so many tokens and bytes are short, and have to recur in more texts.
SHORT_DOCUMENTS, SHORT_TOKENS, SHORT_BYTES = 10, 3, 24
#: Lines of fewer bytes, wild cards and spaces apart, are left alone: brackets, rules, numbers.
MIN_BYTES = 8
ANY = "<*>"
_SPACE = r"[ \t\x0B\f\r]+"
#: What a line with anything to clean holds; a token with a digit, from its beginning.
_UNTIDY = r"[0-9\t\x0B\f\r]|  "
_VARIABLE = r"(?<![^ \t\x0B\f\r])[^ \t\x0B\f\r0-9]*+[0-9][^ \t\x0B\f\r]*+"


def clean(line: Column) -> Column:
    """The line's tokens with one space between; a token with a digit is a wild card.

    Most lines need no regular expression beyond the one that says so.
    """
    tidied = F.regexp_replace(F.regexp_replace(line, _VARIABLE, ANY), _SPACE, " ")
    return F.trim(F.when(line.rlike(_UNTIDY), tidied).otherwise(line))


def _count(cleaned: str) -> Column:
    """Number of tokens of a cleaned line."""
    spaces = F.octet_length(cleaned) - F.octet_length(F.replace(cleaned, F.lit(" "), F.lit("")))
    return F.when(F.col(cleaned) == "", 0).otherwise(spaces + 1)


def _need(cleaned: str, min_documents: int) -> Column:
    """Different texts that make a cleaned line recurring; null if it stays in any case."""
    line, tokens = F.col(cleaned), _count(cleaned)
    words_only = F.replace(line, F.lit(ANY), F.lit(""))
    size = F.octet_length(F.replace(words_only, F.lit(" "), F.lit("")))
    wild = (F.octet_length(line) - F.octet_length(words_only)) / len(ANY)
    return (
        F.when((size < MIN_BYTES) | ((wild > 0) & (tokens - wild < 2)), None)
        .when(
            (tokens >= LONG_TOKENS) | ((tokens <= DEPTH) & (size >= LONG_BYTES)),
            min(LONG_DOCUMENTS, min_documents),
        )
        .when((tokens >= SHORT_TOKENS) | (size >= SHORT_BYTES), min_documents)
        .otherwise(max(SHORT_DOCUMENTS, min_documents))
    )


def _lines(docs: DataFrame, min_documents: int) -> DataFrame:
    """Lines: row (id and text digest), place, digests of leaf and line, need.

    A line is known by both digests, 128 bits. All lines of a leaf with a need have the same.
    """
    # cleaned lines come out of the explode as a column, so nothing cleans them again
    cut = docs.select(
        shared.id_key().alias("id"),
        shared.text_key().alias("digest"),
        F.posexplode(F.transform(F.split(shared.text_or_empty(), "\n"), clean)).alias("place", "line"),
    )
    # need is asked for once: a filter on it here would work it out a second time
    return cut.where(F.octet_length("line") >= MIN_BYTES).select(
        "id", "digest", "place",
        F.xxhash64(_count("line"), F.substring_index("line", " ", DEPTH)).alias("leaf"),
        F.xxhash64("line").alias("line"),
        _need("line", min_documents).alias("need"),
    )


def _templates(distinct: DataFrame, similarity: float) -> DataFrame:
    """(leaf, line, template): the template of each line of mixed leaves that may recur.

    ``distinct`` has a leaf's distinct lines, the texts each is in, and their tokens. A line's
    template has its leading tokens, which the leaf fixes, and those of its other words that
    most texts have at their place in the leaf: as many as the similarity asks for. The rest
    are wild cards. So lines of a template have that share in common, and a leaf has as many
    templates as families of lines, none hiding another.

    A template is known by its leaf and the digest of its words and their places, 64 bits each.
    Counts are added up before the shuffle; a word that most lines of a hot leaf share is a skewed
    join key, which is split at run time, as its counts are one row.
    """
    places = distinct.select(
        "leaf", "line", "need", "texts",
        F.posexplode(F.slice("tokens", DEPTH + 1, F.greatest(F.size("tokens") - DEPTH, F.lit(0)))).alias("at", "token"),
    )
    supported = (
        places.where(F.col("token") != ANY)
        .groupBy("leaf", "at", "token")
        .agg(F.sum("texts").alias("support"), F.first("need").alias("need"))
        .where("support >= need")
        .drop("need")
    )
    place = F.struct(-F.col("support"), "at", F.xxhash64("token").alias("word"))
    wanted = F.greatest(F.ceil(F.col("all") * F.lit(similarity)), F.lit(MIN_WORDS))
    return (
        places.join(supported, ["leaf", "at", "token"], "left")
        .groupBy("leaf", "line")
        .agg(
            F.count("*").alias("all"),
            F.count_if(F.col("token") != ANY).alias("words"),
            F.sort_array(F.collect_list(F.when(F.col("support").isNotNull(), place))).alias("found"),
        )
        .withColumn("wanted", F.least("words", wanted).cast("int"))
        .where(F.size("found") >= F.col("wanted"))
        .select(
            "leaf", "line",
            F.xxhash64(
                F.array_sort(F.transform(F.slice("found", 1, F.col("wanted")), lambda x: F.struct(x["at"], x["word"])))
            ).alias("template"),
        )
    )


def dropped_lines(
    docs: DataFrame, similarity: float = SIMILARITY, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """(id, digest, places): the lines to drop of each row, by place from 0.

    Only leaves that enough different texts reach are looked at token by token, and of
    those only distinct lines, so a line that a third of all documents share is one row
    for each map task before it is shuffled.
    """
    every = stage(_lines(docs, min_documents), "lines").where("need is not null")
    # a template's texts all reach its leaf, so leaves with too few lines end here
    often = (
        every.groupBy("leaf")
        .agg(F.count("*").alias("n"), F.first("need").alias("need"))
        .where("n >= need")
    )
    short = stage(every.join(stage(often.select("leaf"), "leaves"), "leaf", "left_semi"), "leaf-lines")
    null = F.col("id") == shared.id_key_of_null()
    first = F.struct(null.alias("null"), "id", "digest")
    # a line's occurrences in one text count once, and so do copies of a text
    texts = stage(
        short.groupBy("leaf", "line", "digest").agg(F.min(first).alias("first"), F.first("need").alias("need")),
        "line-texts",
    )
    distinct = stage(
        texts.groupBy("leaf", "line").agg(
            F.count("*").alias("texts"), F.min("first").alias("first"), F.first("need").alias("need")
        ),
        "lines-told-apart",
    )
    busy = (
        distinct.groupBy("leaf")
        .agg(F.count("*").alias("lines"), F.sum("texts").alias("texts"), F.first("need").alias("need"))
        .where("lines > 1 and texts >= need")
        .select("leaf")
    )
    mixed = stage(distinct.join(busy, "leaf", "left_semi"), "mixed-lines")
    # the tokens of each such line are read where it first occurs
    where = short.select("leaf", "line", "id", "digest", "place").join(
        mixed.select("leaf", "line", "texts", "need", "first.id", "first.digest"),
        ["leaf", "line", "id", "digest"],
    )
    wanted = where.groupBy("leaf", "line", "id", "digest", "texts", "need").agg(F.min("place").alias("place"))
    by_row = wanted.groupBy("id", "digest").agg(
        F.collect_list(F.struct("place", "leaf", "line", "texts", "need")).alias("wanted")
    )
    rows = docs.select(
        shared.id_key().alias("id"), shared.text_key().alias("digest"), shared.text_or_empty().alias("text")
    )
    read = (
        rows.dropDuplicates(["id", "digest"])
        .join(by_row, ["id", "digest"])
        .select(F.split("text", "\n").alias("all"), F.explode("wanted").alias("w"))
        .select("w.*", F.split(clean(F.element_at("all", F.col("w.place") + 1)), " ").alias("tokens"))
    )
    templates = stage(_templates(read, similarity), "line-templates")
    # a template with all texts that it is in, and the first of them
    recurring = (
        texts.join(templates, ["leaf", "line"])
        .groupBy("leaf", "template", "digest")
        .agg(F.min("first").alias("first"), F.first("need").alias("need"))
        .groupBy("leaf", "template")
        .agg(F.count("*").alias("texts"), F.min("first").alias("first"), F.first("need").alias("need"))
        .where("texts >= need")
        .select("leaf", "template", "first")
    )
    alone = distinct.join(mixed.select("leaf").distinct(), "leaf", "left_anti").where("texts >= need")
    gone = templates.join(recurring, ["leaf", "template"]).select("leaf", "line", "first").unionByName(
        alone.select("leaf", "line", "first")
    ).select("leaf", "line", F.col("first.id").alias("first_id"), F.col("first.digest").alias("first_digest"))
    stays = (F.col("id") == F.col("first_id")) & (F.col("digest") == F.col("first_digest"))
    return (
        short.join(gone, ["leaf", "line"])
        .where(~stays)
        .groupBy("id", "digest")
        .agg(F.sort_array(F.collect_set("place")).alias("places"))
    )


def drop_recurring_lines(
    docs: DataFrame, similarity: float = SIMILARITY, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """docs with recurring lines taken out of ``text``, and ``n_lines``, ``n_dropped`` added.

    Lines are cut at newlines and into tokens at white space; a token with a digit is a wild
    card. A tree of fixed depth deals them to leaves by token count and leading tokens. In
    a leaf, a line's template keeps the words that most texts have at their place, by the given
    share of the tokens after the leading ones and two at least; the others are wild cards. So
    a leaf has a template for each family of lines in it. A template that min_documents different texts hold is recurring: its lines go from every
    document but the first (least doc_id, nulls last) that has it, so what is said once stays
    said. Copies of a text count once. For long lines two texts are enough, short ones need ten.

    Lines under MIN_BYTES bytes stay, and lines with digits that have fewer than two tokens
    without. A null text stays null with no lines; repeated rows are treated alike; other columns
    are untouched; an empty table gives none. A text of any length is one row of the scan.
    """
    gone = dropped_lines(docs, similarity, min_documents)
    names = [shared.free_name(docs, n) for n in ("join_id", "join_digest", "join_places")]
    gone = gone.select(*[F.col(c).alias(n) for c, n in zip(("id", "digest", "places"), names)])
    rows = docs.drop("n_lines", "n_dropped")
    joined = rows.join(
        gone, (shared.id_key() == gone[names[0]]) & (shared.text_key() == gone[names[1]]), "left"
    )
    lines, places = F.split("text", "\n"), F.col(names[2])
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places)
    text = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    changed = {"text": F.when(places.isNull(), F.col("text")).otherwise(text)}
    return joined.select(
        *[changed.get(c, F.col(f"`{c}`")).alias(c) for c in rows.columns],
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(places.isNull(), 0).otherwise(F.size(places)).cast("long").alias("n_dropped"),
    )
