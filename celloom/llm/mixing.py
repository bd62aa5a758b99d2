"""Mixing sources to target weights by Sainte-Laguë apportionment.

All words are mixed once over: the sources' sizes are shared out anew by
weight. A target ends at MOST times its source's size; what is above is shared
by weight among the others. The mix is dealt in blocks of BLOCK words: sources
get blocks by the highest quotients target / (2 k - 1), then a source's shards
(of about SHARD_DOCS documents, by a hash of the id) get its blocks the same
way. The documents of a shard lie in a seeded order end to end on a ring; the
shard's blocks are whole rounds of it and the blocks from a seeded one on.

All of it is joins, groupings and windows. No window holds more than a shard's
documents, a source's shards or the sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from celloom.llm.common import WORD, landed

BLOCK = 16
SHARD_DOCS = 4096
MOST = 3
#: Weights of the sources in code point order, null last, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
SEED = "mix"


def _hash32(*parts: Column | str) -> Column:
    """The first 32 bits of an MD5 digest, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(SEED), *parts)), 1, 8), 16, 10).cast("long")


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def apportion(parts: DataFrame, group: str, seats: str, weight: str, most: str, order: str) -> DataFrame:
    """`parts` with the seats that each part of a group gets, by Sainte-Laguë's quotients.

    `seats` is the group's number; no part gets more than `most`. The rounded
    share is at most a few seats off, so only the seats next to it are ranked:
    as many for each part as its share of the seats that are missing or too
    many can be, which are as many rows as there are parts, times three. Equal
    quotients go by `order`.
    """
    whole = Window.partitionBy(group)
    share = F.when(F.col("_all") > 0, F.col(weight) / F.col("_all")).otherwise(0.0)
    based = (
        parts.withColumn("_all", F.sum(weight).over(whole))
        .withColumn("_base", F.least(F.floor(F.col(seats) * share + 0.5), F.col(most)).cast("long"))
        .withColumn("_lack", F.col(seats) - F.sum("_base").over(whole))
        .withColumn("_reach", (F.ceil(share * (F.abs("_lack") + F.count("*").over(whole))) + 1).cast("long"))
    )
    steps = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_reach"))).alias("_step")
    seat = F.when(F.col("_lack") > 0, F.col("_base") + F.col("_step")).otherwise(F.col("_base") - F.col("_step") + 1)
    open_seats = (
        based.where(f"_lack <> 0 AND {weight} > 0")
        .select("*", steps)
        .withColumn("_seat", seat)
        .where(f"_seat >= 1 AND _seat <= {most}")
        .withColumn("_quotient", F.signum("_lack") * F.col(weight) / (2 * F.col("_seat") - 1))
    )
    nth = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("_quotient"), order, "_step"))
    moved = (
        open_seats.withColumn("_nth", nth)
        .where(F.col("_nth") <= F.abs("_lack"))
        .groupBy(F.col(group).alias("_group"), F.col(order).alias("_order"))
        .agg(F.sum(F.signum("_lack")).cast("long").alias("_moved"))
    )
    joined = based.join(moved, (F.col(group) == F.col("_group")) & (F.col(order) == F.col("_order")), "left")
    return joined.withColumn("quota", F.col("_base") + F.coalesce("_moved", F.lit(0))).select(*parts.columns, "quota")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, n, place) with each source's place by code point and its target.

    A source is full if sharing at the rate that just fills it takes no more
    than all words; the others share what the full ones leave.
    """
    every = Window.partitionBy(F.lit(0))
    in_place = F.row_number().over(every.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") - 1) % len(weights) + 1)
    by_rate = every.orderBy("rate").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        sources.withColumn("place", in_place)
        .withColumn("weight", weight)
        .withColumn("cap", (most * F.col("source_size")).cast("double"))
        .withColumn("rate", F.col("cap") / F.col("weight"))
        .withColumn("words", F.sum("source_size").over(every).cast("double"))
        .withColumn("open", F.sum("weight").over(every) - F.sum("weight").over(by_rate))
        .withColumn("full", F.sum("cap").over(by_rate) + F.col("rate") * F.col("open") <= F.col("words"))
        .withColumn("left", F.col("words") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(every))
        .withColumn("open", F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(every))
        .withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(F.col("left") * F.col("weight") / F.col("open")))
        .select("source", "source_size", "n", "place", "cap", "words", "target")
    )


def _sized(docs: DataFrame, *carried: Column) -> DataFrame:
    doc_id = F.col("doc_id").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count().alias("size"),
        # of the text too: rows without an id, or of one id, are dealt to shards like others
        F.md5(F.concat_ws(":", F.lit(SEED), doc_id, F.xxhash64("text").cast("string")).cast("binary")).alias("key"),
        *carried,
    )


def _taken(rows: DataFrame, weights: tuple[float, ...], most: int, block: int) -> DataFrame:
    """Sized rows with what is taken: whole rounds, and a stretch of the ring from `begin`, `stretch` long."""
    shared = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), weights, most)
    shared = (
        shared.withColumn("all", F.lit(0))
        .withColumn("blocks", F.round(F.col("words") / block).cast("long"))
        .withColumn("most", F.ceil(F.col("cap") / block).cast("long"))
    )
    shared = apportion(shared, "all", "blocks", "target", "most", "place").select("source", "source_size", "n", "place", "target", "quota")
    shared = shared.withColumn("shards", F.ceil(F.col("n") / SHARD_DOCS).cast("long"))
    of_source = shared.select(F.col("source").alias("_source"), "source_size", "place", "target", "quota", "shards")
    shard = F.pmod(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), F.col("shards"))
    placed = rows.join(of_source, F.col("source").eqNullSafe(F.col("_source"))).withColumn("shard", shard)

    sums = placed.groupBy("place", "shard").agg(F.sum("size").alias("shard_size"), F.first("quota").alias("source_quota"))
    sums = sums.withColumn("most", F.ceil(most * F.col("shard_size") / block).cast("long"))
    quotas = apportion(sums, "place", "source_quota", "shard_size", "most", "shard").select(
        F.col("place").alias("_place"), F.col("shard").alias("_shard"), "shard_size", F.col("quota").alias("shard_quota")
    )
    order = Window.partitionBy("place", "shard").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ring = F.greatest("shard_size", F.lit(1))
    words = F.least(F.col("shard_quota") * block, most * F.col("shard_size"))
    first = F.pmod(_hash32("place", "shard"), F.ceil(ring / block).cast("long")) * block
    return (
        placed.withColumn("at", F.sum("size").over(order) - F.col("size"))
        .join(quotas, (F.col("place") == F.col("_place")) & (F.col("shard") == F.col("_shard")))
        .withColumn("rounds", F.floor(words / ring).cast("long"))
        .withColumn("stretch", (words - F.col("rounds") * ring).cast("long"))
        .withColumn("begin", first)
        .withColumn("until", F.least(F.col("begin") + F.col("stretch"), F.col("shard_size")))
        .withColumn("beyond", F.greatest(F.lit(0), F.col("begin") + F.col("stretch") - F.col("shard_size")))
        .withColumn("from_1", F.greatest(F.lit(0), F.col("begin") - F.col("at")))
        .withColumn("n_1", F.greatest(F.lit(0), F.least(F.col("size"), F.col("until") - F.col("at")) - F.col("from_1")))
        .withColumn("n_2", F.greatest(F.lit(0), F.least(F.col("size"), F.col("beyond") - F.col("at"))))
        .withColumn("taken", F.col("rounds") * F.col("size") + F.col("n_1") + F.col("n_2"))
    )


def mixing(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) of every row of `docs`.

    `docs` has doc_id, text and source; other columns are ignored. A null text
    has size 0 and gives nothing; a null source is a source, the last. A null
    doc_id takes part. Repeated rows are returned each, with a share of their
    own. The same rows give the same mix, however they are partitioned.
    """
    rows = landed(_sized(docs), "sizes")
    return _taken(rows, weights, most, block).select("doc_id", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """The mix itself: rows of `docs`, with their columns, as often as they are taken.

    A document that is taken in part is cut between words; n_chars, if there,
    follows. Documents that are not taken go.
    """
    rows = _taken(_sized(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")), weights, most, block)
    pieces = F.regexp_extract_all("doc.text", F.lit(r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]*)"))

    def cut(start: Column, n: Column) -> Column:
        part = F.rtrim(F.array_join(F.slice(pieces, start + 1, n), ""), F.lit(" \t\n\r\x0b\x0c"))
        whole = F.when(n == F.col("size"), F.col("doc.text")).otherwise(part)
        return F.when(n > 0, F.array(whole)).otherwise(F.array().cast("array<string>"))

    times = F.when(F.col("size") > 0, F.col("rounds")).otherwise(0).cast("int")
    texts = F.concat(
        F.array_repeat(F.col("doc.text"), times),
        cut(F.col("from_1").cast("int"), F.col("n_1").cast("int")),
        cut(F.lit(0), F.col("n_2").cast("int")),
    )
    out = rows.where("taken > 0").select("doc", F.explode(texts).alias("_text"))
    kinds = dict(docs.dtypes)

    def column(name: str) -> Column:
        if name == "text":
            return F.col("_text").alias(name)
        if name == "n_chars":
            return F.length("_text").cast(kinds[name]).alias(name)
        return F.col("doc").getField(name).alias(name)

    return out.select(*map(column, docs.columns))
