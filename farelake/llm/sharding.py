"""Sharding: balanced label propagation over shared passages, then an exact cut.

Documents of one text are one unit, which starts in a shard by its hash. Units are linked by the passages (sentences and lines) they share.
In each round every passage names the shard that most of its units are in, and every unit asks for the shard that most of its passages
name. A common passage, in more units than a shard has rows, fits in no single shard: it names as many as it needs, the fullest first,
and its units are dealt out to those or stay in them. Where other passages decide, common ones don't. Requests are granted as
far as quotas go: what flows between two shards in both directions, plus the room left in the target, where units without links or copies make room if there are common passages; requests by common passages get what
the others leave. Granting is by the hash of the passage behind a request, so neighbours go together and no shard's requests are
ranked, or by that of the unit if only common passages are behind it.

At last each shard keeps its even share of rows and hands what is beyond it to shards with room: units without links or copies first, then
those with common passages alone. Row counts differ by at most one. A text with more rows than a shard is dealt out by document to all
shards and never moves, so it uses up no quota, and its passages are in every shard wherever other units go.

A null text has no bytes and is one unit with other null texts, an empty one with empty ones. Rows without an id are placed by
their text, repeated rows are separate rows of one unit, and a very long text is one row with many passages. Without rows there are no
shards. Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelake.llm.common import block_offsets, checked, stage

SHARDS = 16
ROUNDS = 4
#: Room that a shard may use beyond its even share while units move.
SLACK = 0.02
#: Passages end at these marks and count from so many characters on.
PASSAGE_END = r"[.!?\n]+\s*"
PASSAGE_CHARS = 24
#: A passage in more units than this is joined in parts.
HOT_UNITS = 1024
#: Parts of a shard's line by unit, and again within them; they bound what one window sees. Units with more than a HEAVY-th of the rows
#: have a part of their own, which is divided by document.
UNIT_PARTS = 256
DOC_PARTS = 256
HEAVY = 4096


def share(*cols: Column | str) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def shared_passages(docs: DataFrame, large: DataFrame, most: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(unit, passage, part) of passages that from two to ``most`` units share, the same of more common ones, and (passage, parts, homes) of all.

    ``homes`` is the number of shards that a passage needs. ``large`` (unit) are left out, as they are in every shard.
    """
    text = F.col("text").cast("string")
    told = docs.select(F.xxhash64(text).alias("unit"), F.explode(F.split(text, PASSAGE_END)).alias("passage")).filter(F.length("passage") >= PASSAGE_CHARS)
    raw = told.join(F.broadcast(large.select("unit")), "unit", "left_anti").select("unit", F.xxhash64("passage").alias("passage")).distinct()
    raw = stage(raw, "shard-passages")
    counts = stage(raw.groupBy("passage").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shard-counts")
    hot = counts.filter(F.col("n") > HOT_UNITS).select("passage", F.col("n").alias("_n"))
    parts = lambda n: F.floor(F.coalesce(n, F.lit(0)) / HOT_UNITS).cast("int") + 1
    spread = raw.join(checked(hot, 16), "passage", "left").select(
        "unit", "passage", F.pmod(F.xxhash64("unit", F.lit(3)), parts(F.col("_n"))).cast("int").alias("part")
    )
    kept = counts.select(
        "passage", F.when(F.col("n") > HOT_UNITS, parts(F.col("n"))).otherwise(1).alias("parts"), F.ceil(F.col("n") / most).cast("int").alias("homes")
    )
    keys = kept.select("passage", "homes", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"))
    members = stage(spread.join(keys, ["passage", "part"]).select("unit", "passage", "part", "homes"), "shard-members")
    return members.filter("homes = 1").drop("homes"), members.filter("homes > 1").drop("homes"), stage(kept, "shard-kept")


def named_shards(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(passage, label, units): how many units of each passage are in each shard."""
    return members.join(labels.select("unit", "label"), "unit").groupBy("passage", "label").agg(F.count(F.lit(1)).alias("units"))


def cut_links(members: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: ``cut``, the sum over passages of the shards they are in beyond the first."""
    shards = named_shards(members, labels).groupBy("passage").agg((F.count(F.lit(1)) - 1).alias("n"))
    return shards.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("cut"))


def common_votes(common: DataFrame, passages: DataFrame, labels: DataFrame) -> DataFrame:
    """(unit, wish, votes): how many common passages of a unit send it to a shard, or keep it in its own."""
    # A row for each shard at most.
    told = named_shards(common, labels).groupBy("passage").agg(
        F.sort_array(F.collect_list(F.struct("units", F.xxhash64("passage", "label").alias("tie"), "label")), asc=False).alias("told")
    )
    named = told.join(passages, "passage").select(
        "passage", F.slice("told.label", F.lit(1), F.col("homes")).alias("best"), F.explode(F.expr("sequence(0, parts - 1)")).alias("part")
    )
    dealt = F.get("best", F.pmod(F.xxhash64("unit", "passage"), F.size("best")).cast("int"))
    sent = common.join(labels.select("unit", "label"), "unit").join(named, ["passage", "part"])
    sent = sent.select("unit", F.when(F.array_contains("best", F.col("label")), F.col("label")).otherwise(dealt).alias("wish"))
    return sent.groupBy("unit", "wish").agg(F.count(F.lit(1)).alias("votes"))


def propagate(
    units: DataFrame, members: DataFrame, passages: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, slack: float = SLACK,
    common: DataFrame | None = None,
) -> list[DataFrame]:
    """The labels (unit, weight, label) at the start and after each round, from units (unit, weight, label) that are distinct."""
    labels = stage(units.select("unit", "weight", "label"), "shard-labels")
    total = labels.agg(F.sum("weight")).first()[0] or 0
    history = [labels]
    for turn in range(rounds):
        told = named_shards(members, labels)
        # Ties go by a hash, so that no shard is asked for by all.
        wish = told.groupBy("passage").agg(F.max(F.struct("units", F.xxhash64("passage", "label").alias("tie"), "label")).alias("best"))
        named = wish.select("passage", F.col("best.label").alias("wish")).join(passages, "passage")
        named = named.select("passage", "wish", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"))
        votes = members.join(named, ["passage", "part"]).groupBy("unit", "wish").agg(F.count(F.lit(1)).alias("votes"), F.min("passage").alias("via"))
        votes = votes.withColumn("common", F.lit(0).cast("bigint"))
        if common is not None:
            more = common_votes(common, passages, labels).select(
                "unit", "wish", F.lit(0).cast("bigint").alias("votes"), F.lit(None).cast("bigint").alias("via"), F.col("votes").alias("common")
            )
            votes = votes.unionByName(more).groupBy("unit", "wish").agg(
                F.sum("votes").alias("votes"), F.coalesce(F.min("via"), F.col("unit")).alias("via"), F.sum("common").alias("common")
            )
        votes = stage(votes, "shard-votes")
        best = votes.groupBy("unit").agg(F.max(F.struct("votes", "common", F.xxhash64("via", "wish").alias("tie"), "wish", "via")).alias("best"))
        here = votes.select("unit", F.col("wish").alias("label"), F.struct("votes", "common").alias("here"))
        asked = labels.join(best, "unit", "left").join(here, ["unit", "label"], "left")
        more = lambda name: F.col(f"best.{name}") - F.coalesce(f"here.{name}", F.lit(0))
        asks = stage(asked.select(
            "unit", "weight", "label", F.col("best.via").alias("via"), (more("votes") > 0).alias("first"),
            (F.col("best").isNull() & (F.col("weight") == 1)).alias("lone"),
            F.when(
                (F.col("best.wish") != F.col("label")) & ((more("votes") > 0) | (more("votes") == 0) & (more("common") > 0)), F.col("best.wish")
            ).alias("wish"),
        ), "shard-asks")
        # shards x shards rows at most.
        wanted = asks.filter("wish IS NOT NULL").groupBy("label", "wish").agg(
            F.sum("weight").alias("ask"), F.sum(F.when(F.col("first"), F.col("weight")).otherwise(0)).alias("ask_first")
        )
        back = wanted.select(F.col("wish").alias("label"), F.col("label").alias("wish"), F.col("ask").alias("swap"))
        # What common passages gather needs the room of units without links or copies, which give way in the exact cut.
        sizes = (asks if common is None else asks.filter("NOT lone")).groupBy(F.col("label").alias("wish")).agg(F.sum("weight").alias("size"))
        into = Window.partitionBy("wish")
        room = F.greatest(F.lit(0.0), F.lit(total / shards * (1 + slack)) - F.coalesce("size", F.lit(0)))
        rest, firsts = F.col("ask") - F.col("ask_first"), F.sum("ask_first").over(into)
        rests = F.sum(rest).over(into)
        share_of = lambda room, ask, asks: F.when(asks > 0, room * ask / asks).otherwise(0.0)
        flow = F.least("ask", F.coalesce("swap", F.lit(0))) + share_of(F.least(room, firsts), F.col("ask_first"), firsts) + share_of(
            F.greatest(F.lit(0.0), room - firsts), rest, rests
        )
        grants = wanted.join(back, ["label", "wish"], "left").join(sizes, "wish", "left").withColumn("flow", flow).select(
            "label", "wish", F.when(F.col("ask_first") > 0, F.col("flow") / F.col("ask_first")).alias("grant"),
            F.when(rest > 0, (F.col("flow") - F.col("ask_first")) / rest).alias("grant_rest"),
        )
        moved = asks.join(checked(grants, 40), ["label", "wish"], "left")
        grant = F.when(F.col("first"), F.col("grant")).otherwise(F.col("grant_rest"))
        goes = F.col("wish").isNotNull() & (share("via", F.lit(turn)) < F.coalesce(grant, F.lit(0.0)))
        labels = stage(moved.select("unit", "weight", F.when(goes, F.col("wish")).otherwise(F.col("label")).alias("label")), "shard-labels")
        history.append(labels)
    return history


def place(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Put ``rows`` (label, unit, lone from 0 to 2, doc_id, …) into ``shards`` of equal counts, most into that of their label; adds shard and slot."""
    sizes = dict(rows.groupBy("label").count().collect())
    total = sum(sizes.values())
    quota = [(s + 1) * total // shards - s * total // shards for s in range(shards)]
    held = [sizes.get(s, 0) for s in range(shards)]
    keep = [min(n, q) for n, q in zip(held, quota)]
    # What each shard has beyond its quota is one line, which fills the room of the others in order.
    first = lambda values: [sum(values[:s]) for s in range(len(values))]
    longs = lambda values: F.array(*[F.lit(v).cast("bigint") for v in values])
    start, over, room = first(held), first([n - k for n, k in zip(held, keep)]), [q - k for q, k in zip(quota, keep)]
    # Fewer than HEAVY rows, so one window may number them.
    heavy = rows.groupBy("unit").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") * HEAVY > max(total, HEAVY)).select(
        "unit", F.row_number().over(Window.orderBy("unit")).alias("_heavy")
    )
    part = F.coalesce(F.col("_heavy") + (UNIT_PARTS - 1), F.pmod(F.xxhash64("unit"), F.lit(UNIT_PARTS)))
    inner = F.when(F.col("_heavy").isNull(), F.xxhash64("unit", F.lit(7))).otherwise(F.xxhash64("doc_id", F.lit(7)))
    line = F.col("label").cast("bigint") * 3 + F.col("lone")
    block = (line * (UNIT_PARTS + HEAVY) + part) * DOC_PARTS + F.pmod(inner, F.lit(DOC_PARTS))
    dealt = rows.join(F.broadcast(heavy), "unit", "left").withColumn("_block", block.cast("bigint")).drop("_heavy")
    offsets = block_offsets(dealt.groupBy("_block").agg(F.count(F.lit(1)).alias("_n")), "_block", "_n", "_base")
    inside = Window.partitionBy("_block").orderBy("unit", "doc_id", "text_crc32")
    ranked = dealt.withColumn("_in", F.row_number().over(inside)).join(offsets, "_block")
    at = F.col("_base") + F.col("_in") - 1 - F.get(longs(start), F.col("label"))
    ranked = ranked.withColumn("_at", at).withColumn("_over", F.col("_at") - F.get(longs(keep), F.col("label")))
    ranked = ranked.withColumn("_over", F.when(F.col("_over") >= 0, F.col("_over") + F.get(longs(over), F.col("label"))))
    ends = longs([sum(room[:s + 1]) for s in range(shards)])
    target = F.size(F.filter(ends, lambda end: end <= F.col("_over")))
    ranked = ranked.withColumn("shard", F.when(F.col("_over").isNull(), F.col("label")).otherwise(target).cast("int"))
    filled = F.col("_over") - F.get(longs(first(room)), F.col("shard")) + F.get(longs(keep), F.col("shard"))
    return ranked.withColumn("slot", F.coalesce(filled, F.col("_at")).cast("bigint"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law ('rows'), shard, slot, grown_shard (null under this law)."""
    text = F.col("text").cast("string")
    raw = text.cast("binary")
    facts = stage(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"), (F.coalesce(F.octet_length(raw), F.lit(0)) + 1).cast("bigint").alias("size"),
            F.coalesce(F.crc32(raw), F.lit(0)).cast("bigint").alias("text_crc32"), F.xxhash64(text).alias("text_unit"),
        ),
        "shard-facts",
    )
    total = facts.count()
    # Fewer than there are shards.
    large = facts.groupBy(F.col("text_unit").alias("unit")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") * shards > total)
    large = stage(large.select("unit", F.lit(True).alias("large")), "shard-large")
    slices = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(shards)).cast("int")
    named = facts.join(F.broadcast(large.withColumnRenamed("unit", "text_unit")), "text_unit", "left").select(
        "doc_id", "size", "text_crc32",
        F.when(F.col("large"), F.xxhash64("text_unit", slices)).otherwise(F.col("text_unit")).alias("unit"),
        F.when(F.col("large"), slices).otherwise(F.pmod(F.xxhash64("text_unit", F.lit(9)), F.lit(shards)).cast("int")).alias("start"),
    )
    units = named.groupBy("unit").agg(F.count(F.lit(1)).alias("weight"), F.min("start").alias("label"))
    members, common, passages = shared_passages(docs, large, max(1, total // shards))
    labels = propagate(units, members, passages, shards, rounds, SLACK, None if common.isEmpty() else common)[-1]
    linked = members.select("unit", F.lit(0).alias("lone")).union(common.select("unit", F.lit(1))).groupBy("unit").agg(F.min("lone").alias("lone"))
    final = stage(labels.join(linked, "unit", "left").select(
        "unit", "label", F.when(F.col("weight") > 1, 0).otherwise(F.coalesce("lone", F.lit(2))).alias("lone")
    ), "shard-final")
    # A unit that is large for one join task lies in few rows on the other side, and adaptive execution divides it.
    rows = stage(named.drop("start").join(final, "unit"), "shard-rows")
    return place(rows, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
