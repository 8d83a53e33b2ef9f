"""Document fingerprints of spot signatures, with DataFrame functions only.

A spot is a common word (an anchor) with the content words that follow it, two at most and up
to the next anchor. A content word out of reach of any anchor is a spot of its own, so texts with
few or no common words have fingerprints as well. The fingerprint of a text is the set of its
spots, hashed; texts without words have the empty set.
Fingerprints are compared by Jaccard similarity; two empty ones are alike.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values: common words of English, French, German and Spanish
ANCHORS = (
    "a al and are as au avec be by con das de del dem den der des die du ein eine el en er es est et for from have he "
    "ich im in is ist it la las le les los mit nicht of on or par pas pour que qui se sich sie son su sur that the "
    "they this to un una une und von was were which with y zu"
).split()

CHAIN = 2
#: Rows of one window of neighbours, and the most windows; the list of their bounds is driver-side.
ROWS_PER_BUCKET, MOST_BUCKETS = 2000, 16384
_LEAST = -(2**63)


def _anchor_pattern() -> str:
    """The anchors, by first letter, so that most words fail at their first letter."""
    by_first: dict[str, list[str]] = {}
    for word in ANCHORS:
        by_first.setdefault(word[0], []).append(word[1:])
    return "(?:" + "|".join(f"{first}(?:{'|'.join(sorted(rest, reverse=True))})" for first, rest in by_first.items()) + ")"


def spot_set(text: Column) -> Column:
    """The sorted hashes of a text's spots."""
    anchor = _anchor_pattern()
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    content = rf"(?:(?!{anchor} )[^ ]+ )"
    spots = F.regexp_extract_all(plain, F.lit(rf"(?<= )(?:{anchor} {content}{{1,{CHAIN}}}|{content})"), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(spots, lambda s: F.hash(s))))


def likeness(left: Column, right: Column) -> Column:
    shared = F.size(F.array_intersect(left, right))
    either = F.size(left) + F.size(right) - shared
    return F.when(either == 0, F.lit(1.0)).otherwise(shared / either)


def as_text(spots: Column) -> Column:
    return F.array_join(spots.cast("array<string>"), ",")


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are not above the key, by a search in two steps."""
    width = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    firsts = F.from_json(F.lit(json.dumps([g[0] for g in groups])), "array<bigint>")
    lists = F.from_json(F.lit(json.dumps(groups)), "array<array<bigint>>")
    coarse = F.size(F.filter(firsts, lambda b: b <= key))
    fine = F.size(F.filter(F.get(lists, coarse - 1), lambda b: b <= key))
    return F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * width + fine)


def with_next(docs: DataFrame, computed: dict[str, Column]) -> DataFrame:
    """The documents (doc_id, text, n_chars) with computed columns and, as ``next_...``, the text
    and computed columns of the next document in descending order of doc_id.

    After the last comes the first. NULL ids come after all others; rows that share an id are
    ordered by a hash of the text. Rows are dealt out by ranges of ids, and the first row of each
    range is added at the end of the range before it, so no task sees more than its range.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    ).select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(_LEAST)).alias("k"), F.xxhash64("text").alias("h")
    )
    count = rows.count()
    buckets = min(MOST_BUCKETS, max(1, -(-count // ROWS_PER_BUCKET)))
    bounds: list[int] = []
    if buckets > 1:
        shares = [i / buckets for i in range(1, buckets)]
        bounds = sorted(set(rows.agg(F.percentile_approx("k", shares, max(10_000, 4 * buckets))).first()[0]))
    dealt = rows.withColumn("bucket", _bucket(F.col("k"), bounds) if bounds else F.lit(0))
    heads = {b: (k, h) for b, (k, h) in dealt.groupBy("bucket").agg(F.max(F.struct("k", "h")).alias("m")).collect()}
    filled = sorted(heads)
    table = [{"k": 0, "h": 0, "to": -1}] * (len(bounds) + 1)
    for place, b in enumerate(filled):
        table[b] = {"k": heads[b][0], "h": heads[b][1], "to": filled[(place + 1) % len(filled)]}
    head = F.get(F.from_json(F.lit(json.dumps(table)), "array<struct<k:bigint,h:bigint,to:int>>"), F.col("bucket"))
    own = F.struct(F.col("bucket").cast("int").alias("to"), F.lit(False).alias("ghost"))
    copy = F.struct(head["to"].alias("to"), F.lit(True).alias("ghost"))
    places = F.when((head["k"] == F.col("k")) & (head["h"] == F.col("h")), F.array(own, copy)).otherwise(F.array(own))
    placed = dealt.select("doc_id", "text", "k", "h", F.inline(places))
    order = Window.partitionBy("to").orderBy("ghost", F.desc("k"), F.desc("h"))
    led = placed.withColumn("next_text", F.lead("text").over(order)).withColumn("n_chars", F.char_length("text").cast("bigint"))
    led = led.withColumns(computed)
    led = led.withColumns({f"next_{name}": F.lead(name).over(order) for name in computed})
    return led.filter(~F.col("ghost")).drop("k", "h", "to", "ghost")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last third is replaced by as many
    code points from the start of the next document's text. A NULL text counts as empty."""
    led = with_next(docs, {"spots": spot_set(F.col("text"))})
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - third).cast("int")), F.substring("next_text", F.lit(1), third)
    )
    shown = led.withColumn("edited", edited).withColumn("edited_spots", spot_set(F.col("edited")))
    return shown.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("spots")).alias("fingerprint"),
        as_text(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots")).alias("near_next"),
    )


def similar_pairs(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """(left_class, right_class, similarity) of different fingerprints that are alike enough.

    A class is the smallest doc_id with a fingerprint; ``fingerprint_classes`` has the members.
    Two sets can only be alike if the smaller has at least ``similarity`` times the members of
    the larger: sets are partitioned by the logarithm of their size, and a set meets its own
    partition and the one below. They must also share one of the rarest members of each, as
    many as a similar set could miss, so that only those meet.
    """
    sets = fingerprint_classes(docs).select("class", "spots").distinct().filter(F.size("spots") > 0)
    members = sets.select("class", F.size("spots").alias("size"), F.explode("spots").alias("spot"))
    rarity = members.groupBy("spot").agg(F.count(F.lit(1)).alias("held"))
    rarest = Window.partitionBy("class").orderBy("held", "spot")
    prefix = (
        members.join(rarity, "spot")
        .withColumn("rank", F.row_number().over(rarest))
        .filter(F.col("rank") <= F.col("size") - F.ceil(F.col("size") * similarity) + 1)
        .filter("held > 1")
        .withColumn("part", F.floor(F.log(F.col("size").cast("double")) / math.log(1 / similarity)))
    )
    a = prefix.select(F.col("class").alias("a"), F.col("size").alias("na"), "spot", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    b = prefix.select(F.col("class").alias("b"), F.col("size").alias("nb"), "spot", "part")
    close = (F.least("na", "nb") >= F.greatest("na", "nb") * similarity) & (F.col("a") != F.col("b"))
    met = a.join(b, ["spot", "part"]).filter(close)
    met = met.select(F.least("a", "b").alias("left_class"), F.greatest("a", "b").alias("right_class")).distinct()
    one = sets.select(F.col("class").alias("left_class"), F.col("spots").alias("ls"))
    two = sets.select(F.col("class").alias("right_class"), F.col("spots").alias("rs"))
    alike = met.join(one, "left_class").join(two, "right_class").withColumn("similarity", likeness(F.col("ls"), F.col("rs")))
    return alike.filter(F.col("similarity") >= similarity).select("left_class", "right_class", "similarity")


def fingerprint_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class, spots): documents of equal fingerprints share a class."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), spot_set(F.coalesce("text", F.lit(""))).alias("spots"))
    classes = rows.groupBy("spots").agg(F.min("doc_id").alias("class"))
    return rows.join(classes, "spots").select("doc_id", "class", "spots")
