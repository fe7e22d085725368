"""URL filters by dated lists: validity intervals and an as-of join at fetch time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shiftpay.llm.shared import free_name

#: What an entry may say; of several on one day for one pattern, the first here holds.
ACTIONS = ("block", "allow", "remove")
#: Copies of each verdict that hot patterns are spread over.
SALTS = 16
_HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; null where there is none."""
    host = F.regexp_replace(F.regexp_extract(F.lower(url), _HOST, 1), r"\.+$", "")
    return F.when(host != "", host)


def intervals(entries: DataFrame) -> DataFrame:
    """(pattern, action, valid_from, valid_to) of dated list entries (pattern, action, dated).

    An entry holds from its date until the next of its pattern; ``remove`` ends without
    beginning anything; the last one has no end (null). Entries with a null or an action
    that isn't listed are void.
    """
    rank = F.array_position(F.array(*map(F.lit, ACTIONS)), F.lower("action"))
    daily = (
        entries.select("pattern", F.to_date("dated").alias("valid_from"), rank.alias("rank"))
        .where("pattern is not null and valid_from is not null and rank > 0")
        .groupBy("pattern", "valid_from")
        .agg(F.min("rank").alias("rank"))
    )
    following = Window.partitionBy("pattern").orderBy("valid_from")
    return (
        daily.withColumn("valid_to", F.lead("valid_from").over(following))
        .withColumn("action", F.element_at(F.array(*map(F.lit, ACTIONS)), F.col("rank").cast("int")))
        .where(F.col("action") != "remove")
        .select("pattern", "action", "valid_from", "valid_to")
    )


def filter_urls(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Captures (..., url, fetched) with host, pattern, action, valid_from, valid_to, kept.

    A pattern is a host or a domain above it. Of the entries active on the day of the fetch,
    that of the longest pattern decides; ``block`` drops the capture, and without any it is
    kept. A null url or date is kept, with nulls.

    The as-of join runs on distinct pairs of pattern and day, so a domain that a third of
    all captures share is as many rows as days; verdicts then go to distinct pairs of host
    and day, and from there to the captures, both through salted keys. Added names replace
    columns of the same name.
    """
    added = ["host", "pattern", "action", "valid_from", "valid_to", "kept"]
    plain = captures.drop(*added)
    day, salt = free_name(plain, "day"), free_name(plain, "salt")
    rows = plain.withColumn("host", host_of(F.col("url"))).withColumns(
        {day: F.to_date("fetched"), salt: F.pmod(F.xxhash64("url"), F.lit(SALTS)).cast("int")}
    )
    pairs = rows.where(F.col("host").isNotNull() & F.col(day).isNotNull()).select("host", day).distinct()
    labels = F.split("host", r"\.")
    above = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    wanted = pairs.select(
        "host", day, F.explode(above).alias("pattern"),
        F.pmod(F.xxhash64("host"), F.lit(SALTS)).cast("int").alias(salt),
    )
    active = (
        wanted.select("pattern", day)
        .distinct()
        .join(intervals(entries), "pattern")
        .where(
            (F.col("valid_from") <= F.col(day))
            & (F.col("valid_to").isNull() | (F.col(day) < F.col("valid_to")))
        )
    )
    spread = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    verdicts = (
        wanted.join(active.withColumn(salt, spread), ["pattern", day, salt])
        .groupBy("host", day)
        .agg(
            F.max_by(
                F.struct("pattern", "action", "valid_from", "valid_to"), F.length("pattern")
            ).alias("entry")
        )
    )
    return (
        rows.join(verdicts.withColumn(salt, spread), ["host", day, salt], "left")
        .select(
            *[F.col(f"`{c}`") for c in (*plain.columns, "host")],
            *[F.col(f"entry.{c}").alias(c) for c in added[1:5]],
        )
        .withColumn("kept", ~F.coalesce(F.col("action") == "block", F.lit(False)))
    )
