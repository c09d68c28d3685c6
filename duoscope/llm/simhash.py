"""SimHash fingerprints, and all pairs of them within a Hamming radius."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duoscope.sources.shared import written

SHINGLE = 5
BITS = 64
RADIUS = 3
#: A fingerprint is cut into radius + 3 blocks; two within the radius agree in three of them.
AGREEING = 3
PAIR_OF_LANES = 0x0000000100000001
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def votes(texts: DataFrame, keys: list[str], text: str, shingle: int = SHINGLE) -> DataFrame:
    """``keys``, ``n_rows``, ``fingerprint`` (long) of the texts; rows with equal keys are one.

    Terms are runs of ``shingle`` words (a shorter text is one term), weighted by how
    often they come. Each adds its hash's bits to 64 counters, two to a long, so the
    tasks hold one row of 32 longs per text and shuffle that alone. A bit is set where
    more than half of the weight has it; texts without words have fingerprint 0.
    ``n_rows`` counts the rows with these keys, whose texts must be equal.
    """
    words = F.split(F.btrim(F.translate(F.col(text), CAPITALS, SMALL), F.lit(" \t\n\r\x0b\x0c")), r"\s+")
    listed = texts.select(*keys, words.alias("_w")).withColumn("_n", F.size("_w"))
    shifted = [F.slice("_w", k + 1, F.greatest("_n", F.lit(1))).alias(f"w{k}") for k in range(shingle)]
    each = listed.select(*keys, "_n", F.posexplode(F.arrays_zip(*shifted)).alias("_pos", "_s")).filter(
        F.col(f"_s.w{shingle - 1}").isNotNull() | (F.col("_pos") == 0)
    )
    hashed = each.select(
        *keys,
        F.xxhash64(*[F.col(f"_s.w{k}") for k in range(shingle)]).alias("_h"),
        (F.col("_pos") == 0).cast("long").alias("_first"),
        ((F.col("_n") > 1) | (F.col("_s.w0") != "")).cast("long").alias("_one"),
    )
    lanes = [
        F.sum(F.shiftright("_h", i).bitwiseAND(F.lit(PAIR_OF_LANES)) * F.col("_one")).alias(f"_l{i}")
        for i in range(BITS // 2)
    ]
    counted = hashed.groupBy(*keys).agg(
        F.sum("_first").alias("n_rows"), F.sum("_one").alias("_total"), *lanes
    )
    fingerprint: Column = F.lit(0).cast("long")
    for i in range(BITS // 2):
        low = F.col(f"_l{i}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(f"_l{i}", 32)
        for bit, ones in ((i, low), (i + BITS // 2, high)):
            flag = 1 << bit if bit < BITS - 1 else -(1 << bit)
            fingerprint = fingerprint.bitwiseOR(
                F.when(2 * ones > F.col("_total"), F.lit(flag).cast("long")).otherwise(F.lit(0).cast("long"))
            )
    return counted.select(*keys, "n_rows", fingerprint.alias("fingerprint"))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - distance(a, b) / F.lit(float(BITS))


def hexadecimal(fingerprint: str) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), BITS // 4, "0"))


def masks(radius: int = RADIUS) -> list[int]:
    """One per table: the bits of the blocks that its key consists of, as signed longs."""
    blocks = radius + AGREEING
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    unsigned = [sum(choice) for choice in combinations(parts, AGREEING)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in unsigned]


def near_pairs(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All pairs ``a`` < ``b`` of different fingerprints no further apart than ``radius``.

    Each table keys the fingerprints by three blocks (32 bits); a pair is taken from
    the first table in which it agrees, so none is listed twice.
    """
    distinct = fingerprints.select("fingerprint").distinct()
    every = masks(radius)
    keyed = distinct.select(
        F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(F.lit(m)) for m in every])).alias("t", "key"),
        "fingerprint",
    )
    left = keyed.withColumnRenamed("fingerprint", "a")
    right = keyed.withColumnRenamed("fingerprint", "b")
    differing = F.col("a").bitwiseXOR(F.col("b"))
    first = F.coalesce(
        *[F.when(differing.bitwiseAND(F.lit(m)) == 0, F.lit(k)) for k, m in enumerate(every)]
    )
    near = (F.col("a") < F.col("b")) & (F.bit_count(differing) <= radius) & (first == F.col("t"))
    return left.join(right, ["t", "key"]).filter(near).select("a", "b")


def successors(ids: DataFrame) -> DataFrame:
    """``doc_id``, ``h``, and ``next_id``: the following id, after the last the first; nulls come first.

    Ids are ordered inside ranges, stored with them; one row per range takes part in
    the step from each range's last id to the next range's first.
    """
    ranged = ids.repartitionByRange("doc_id").withColumn("_range", F.spark_partition_id())
    stored = written(ranged, "ids")
    inside = Window.partitionBy("_range").orderBy("doc_id")
    led = stored.select(
        "*",
        F.lead("doc_id").over(inside).alias("_lead"),
        F.row_number().over(inside).alias("_rn"),
        F.count("*").over(Window.partitionBy("_range")).alias("_rows"),
    )
    starts = stored.groupBy("_range").agg(F.min(F.struct("doc_id")).alias("start"))
    order = Window.partitionBy(F.lit(0)).orderBy("_range")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follow = starts.select(
        "_range", F.coalesce(F.lead("start").over(order), F.first("start").over(whole)).alias("_start")
    )
    return led.join(follow, "_range").select(
        "doc_id",
        "h",
        F.when(F.col("_rn") < F.col("_rows"), F.col("_lead"))
        .otherwise(F.col("_start.doc_id"))
        .alias("next_id"),
    )


def with_edits(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents with ``edited``, and ``doc_id``, ``h``, ``next_id``.

    The edited text is the text with its last half, rounded down, replaced by as many
    first characters of the next document, or all it has. The next document has the
    next larger id; of rows with that id the one with the smallest MD5 is taken. Null
    text is empty. From each document only the needed beginning moves to the one
    before it.
    """
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    half = F.floor(F.char_length("text") / 2).cast("int")
    order = written(successors(plain.groupBy("doc_id").agg(F.max(half).alias("h"))), "successors")
    wanted = order.select(F.col("next_id").alias("doc_id_"), F.col("doc_id").alias("target"), "h")
    begun = (
        plain.join(wanted, F.col("doc_id").eqNullSafe(F.col("doc_id_")))
        .select("target", F.md5("text").alias("_d"), F.expr("substring(text, 1, h)").alias("_begin"))
        .groupBy("target")
        .agg(F.min_by("_begin", "_d").alias("_begin"))
    )
    joined = plain.join(begun, F.col("doc_id").eqNullSafe(F.col("target")), "left")
    edited = F.expr(
        "concat(substring(text, 1, char_length(text) - cast(floor(char_length(text) / 2) as int)),"
        " substring(coalesce(_begin, ''), 1, cast(floor(char_length(text) / 2) as int)))"
    )
    return joined.select("doc_id", "text", edited.alias("edited")), order


def fingerprints(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Per row ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``, ``n_near``.

    ``n_near`` is the number of other fingerprints in the table within the radius. Rows
    that repeat are kept; rows with one id and equal texts are worked out once. A
    single document is its own next one. Other columns are left out.
    """
    both, order = with_edits(docs)
    keys = ["doc_id", "digest", "n_chars", "edited_sha256", "kind"]
    texts = both.select(
        "doc_id",
        # Bytes instead of hexadecimal text: half as much to shuffle.
        F.unhex(F.md5("text")).alias("digest"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.unhex(F.sha2(F.col("edited").cast("binary"), 256)).alias("edited_sha256"),
        F.posexplode(F.array("text", "edited")).alias("kind", "body"),
    )
    counted = votes(texts, keys, "body")
    own = F.max(F.when(F.col("kind") == 0, F.col("fingerprint")))
    other = F.max(F.when(F.col("kind") == 1, F.col("fingerprint")))
    stored = written(
        counted.groupBy(*keys[:-1]).agg(
            F.max("n_rows").alias("n_rows"), own.alias("fingerprint"), other.alias("edited_fingerprint")
        ),
        "fingerprints",
    )
    pairs = near_pairs(stored, radius)
    near = (
        pairs.select(F.explode(F.array("a", "b")).alias("fingerprint"))
        .groupBy("fingerprint")
        .agg(F.count("*").alias("n_near"))
    )
    following = order.select(F.col("doc_id").alias("target"), F.col("next_id").alias("id"))
    next_prints = (
        stored.join(following, F.col("doc_id").eqNullSafe(F.col("id")))
        .groupBy("target")
        .agg(F.min_by("fingerprint", "digest").alias("next_print"))
    )
    return (
        stored.join(next_prints, F.col("doc_id").eqNullSafe(F.col("target")), "left")
        .join(near, "fingerprint", "left")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))))
        .select(
            "doc_id",
            "n_chars",
            F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
            hexadecimal("fingerprint").alias("fingerprint"),
            hexadecimal("edited_fingerprint").alias("edited_fingerprint"),
            likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
            likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"),
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        )
    )
