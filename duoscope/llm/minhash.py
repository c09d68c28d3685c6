"""Near copies by DartMinHash signatures, banded joins and exact comparison.

A document is the multiset of its runs of five words. Hashed darts fall on the region
of each run, as wide as its weight, at random ranks; a signature keeps the earliest
dart of each coordinate. Two documents share a coordinate with the probability of
their weighted Jaccard similarity, and a signature costs about as many darts as it
has coordinates (times a logarithm), however long the document.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duoscope.llm.common import WORD_TABLE, ship, utf8
from duoscope.sources.shared import written

SHINGLE = 5
SIMILARITY = 0.8
#: At a similarity of 0.8 a pair shares at least one of 32 bands of 6 with probability 0.99994.
BANDS = 32
ROWS = 6
SLICE_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15
UNIT = 2.0**-53
#: Rows of links or labels that are worth a task.
TASK_ROWS = 200_000
#: Shingles that a comparing task keeps, besides those of the two texts at hand.
HELD_SHINGLES = 2_000_000
#: Shingles that leave a task at once.
BATCH_SHINGLES = 1 << 20
#: Cells of the parity of a set; a multiple of 64.
PARITY_BITS = 1024


def mixed(x):
    """A bijection of unsigned 64-bit numbers that spreads every bit."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(size: int):
    """Powers of an odd base and of its inverse, modulo 2 to the 64."""
    import numpy as np

    def of(base: int):
        row = np.full(size, base, np.uint64)
        row[0] = 1
        return np.cumprod(row, dtype=np.uint64)

    return of(BASE), of(pow(BASE, -1, 1 << 64))


def word_hashes(text: str | None, tables: list):
    """A 64-bit hash of each word, from sums over the text: no loop over words."""
    import numpy as np

    data, out, at = utf8(text).translate(WORD_TABLE), [], 0
    while at < len(data):
        end = data.find(b" ", at + SLICE_BYTES)
        end = len(data) if end < 0 else end
        a = np.frombuffer(data, np.uint8, end - at, at)
        if len(a) > len(tables[0]):
            tables[:] = powers(2 * len(a))
        edges = np.flatnonzero(np.diff(np.concatenate(([32], a, [32])) != 32))
        starts, stops = edges[::2], edges[1::2]
        sums = np.concatenate(
            (np.zeros(1, np.uint64), np.cumsum((a.astype(np.uint64) + np.uint64(1)) * tables[0][: len(a)]))
        )
        out.append((sums[stops] - sums[starts]) * tables[1][starts])
        at = end
    return mixed(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def shingles(words, size: int = SHINGLE):
    """Hashes of all runs of ``size`` words; of a shorter text, that of all its words."""
    import numpy as np

    n = min(size, len(words))
    if not n:
        return words
    total = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        factor = np.uint64(pow(BASE, 2 * k + 3, 1 << 64))
        total += mixed(words[k : len(words) - n + 1 + k] + np.uint64(k)) * factor
    return mixed(total)


def unit(x):
    """Numbers from 0 to below 1 from the upper 53 bits."""
    import numpy as np

    return (x >> np.uint64(11)) * UNIT


def gaps(x):
    """Exponentially distributed numbers, one for each hash."""
    import numpy as np

    return -np.log1p(-unit(x))


def signature(elements, weights, size: int):
    """The earliest dart of each of ``size`` coordinates, as unsigned 64-bit numbers.

    ``elements``: different hashes; ``weights``: positive numbers. An element's region
    is cut into cells of width one at most. In a cell, darts come at the ranks of a
    Poisson process that the cell's hash starts, each with a place across and a
    coordinate; those beyond the cell's width miss. Only ranks up to a bound are
    thrown, doubled while a coordinate is empty.
    """
    import numpy as np

    counts = np.ceil(weights).astype(np.int64)
    owner = np.repeat(np.arange(len(elements)), counts)
    level = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    cells = mixed(elements[owner] + level.astype(np.uint64) * np.uint64(BASE))
    width = np.minimum(1.0, weights[owner] - level)
    bound = (size * math.log(size) + 2 * size) / weights.sum()
    opening = gaps(mixed(cells + np.uint64(BASE)))
    while True:
        left = np.flatnonzero(opening <= bound)
        throws, done = int(bound + 2 * math.sqrt(bound) + 2), 0
        reached = np.zeros(len(left))
        found, at = [np.zeros(0, np.uint64)], [np.zeros(0)]
        while len(left):
            step = np.arange(done + 1, done + throws + 1, dtype=np.uint64) * np.uint64(BASE)
            darts = mixed(cells[left][:, None] + step)
            ranks = np.cumsum(gaps(darts), axis=1) + reached[:, None]
            row, column = np.nonzero(ranks <= bound)
            names = mixed(darts[row, column] ^ np.uint64(0xD6E8FEB86659FD93))
            inside = unit(mixed(names)) < width[left[row]]
            found.append(names[inside])
            at.append(ranks[row, column][inside])
            more = ranks[:, -1] <= bound
            left, reached, done = left[more], ranks[more, -1], done + throws
        names = np.concatenate(found)[np.argsort(-np.concatenate(at), kind="stable")]
        place = (names % np.uint64(size)).astype(np.int64)
        filled = np.zeros(size, bool)
        filled[place] = True
        if filled.all():
            out = np.zeros(size, np.uint64)
            out[place] = names  # the last write, the smallest rank, stays
            return out
        bound *= 2


def band_keys(names, bands: int, rows: int):
    """One signed 64-bit key per band."""
    import numpy as np

    table = names.reshape(bands, rows)
    key = np.arange(bands, dtype=np.uint64)
    for k in range(rows):
        key = mixed(key * np.uint64(BASE) + table[:, k])
    return key.view(np.int64)


def signed(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """``doc_id``, ``key`` (digest of the text), ``n`` (weight) and ``bands`` of each row."""
    import numpy as np

    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        tables = list(powers(SLICE_BYTES))
        for batch in batches:
            counts, keys = [], []
            for text in batch.column("text"):
                found = shingles(word_hashes(text.as_py(), tables))
                counts.append(len(found))
                if len(found):
                    elements, weights = np.unique(found, return_counts=True)
                    names = signature(elements, weights.astype(float), bands * rows)
                    keys.append(band_keys(names, bands, rows))
                else:
                    keys.append(np.zeros(0, np.int64))
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(counts, pa.int64()), pa.array(keys, lists)],
                ["doc_id", "key", "n", "bands"],
            )

    keyed = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("key"), "text")
    return keyed.mapInArrow(run, f"doc_id {kind}, key string, n long, bands array<long>")


def multiset(text: str | None, tables: list):
    """Different hashes of the text's shingles, how often each comes, and how many there are."""
    import numpy as np

    found = shingles(word_hashes(text, tables))
    unique, counts = np.unique(found, return_counts=True)
    return unique, counts, len(found)


def similarity(a, b) -> float:
    """Weighted Jaccard of two multisets."""
    import numpy as np

    place = np.searchsorted(a[0], b[0])
    place[place == len(a[0])] = 0
    same = a[0][place] == b[0]
    shared = int(np.minimum(a[1][place[same]], b[1][same]).sum())
    return shared / (a[2] + b[2] - shared)


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs ``a``, ``b`` whose texts are as similar as ``least``; ``texts``: ``node``, ``text``.

    A task keeps the shingles of the texts it has met, up to ``HELD_SHINGLES``: pairs
    of one group meet the same ones again and again.
    """

    def run(batches):
        tables = list(powers(SLICE_BYTES))
        held: dict[int, tuple] = {}
        size = 0

        def of(node: int, text):
            nonlocal size
            if node not in held:
                if size >= HELD_SHINGLES:
                    held.clear()
                    size = 0
                held[node] = multiset(text.as_py(), tables)
                size += len(held[node][0])
            return held[node]

        for batch in batches:
            a, b = (batch.column(c).to_pylist() for c in ("a", "b"))
            left, right = batch.column("left"), batch.column("right")
            keep = [
                similarity(of(x, left[k]), of(y, right[k])) >= least for k, (x, y) in enumerate(zip(a, b))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    whole = pairs.join(
        texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a"
    ).join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b")
    return whole.select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def elements_of(texts: DataFrame) -> DataFrame:
    """``node``, ``comp``, ``n``, ``elements``: the shingles of each text, a repeated one with its number.

    Weighted similarity is then that of plain sets. ``parity`` has for each of ``PARITY_BITS``
    cells whether an odd number of elements fall into it. Rows go out in batches of
    bounded size.
    """
    import numpy as np

    def parity(found):
        odd = np.bincount((found >> np.uint64(32)) % np.uint64(PARITY_BITS), minlength=PARITY_BITS) & 1
        return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)

    def run(batches):
        tables = list(powers(SLICE_BYTES))

        def rows(batch, begin, held):
            lists = pa.array([e.view(np.int64) for e in held], pa.list_(pa.int64()))
            sizes = pa.array([len(e) for e in held], pa.int64())
            part = batch.slice(begin, len(held))
            return pa.RecordBatch.from_arrays(
                [part.column("node"), part.column("comp"), sizes, lists,
                 pa.array([parity(e) for e in held], pa.list_(pa.int64()))],
                ["node", "comp", "n", "elements", "parity"],
            )

        for batch in batches:
            begin, held, weight = 0, [], 0
            for text in batch.column("text"):
                unique, counts, n = multiset(text.as_py(), tables)
                number = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
                held.append(mixed(np.repeat(unique, counts) + number.astype(np.uint64) * np.uint64(BASE)))
                weight += n
                if weight >= BATCH_SHINGLES:
                    yield rows(batch, begin, held)
                    begin, held, weight = begin + len(held), [], 0
            if held:
                yield rows(batch, begin, held)

    schema = "node long, comp long, n long, elements array<long>, parity array<long>"
    return texts.select("node", "comp", "text").mapInArrow(run, schema)


def between_classes(texts: DataFrame, least: float) -> DataFrame:
    """Pairs ``a`` < ``b`` of nodes of different classes that may be as similar as ``least``; none that is goes missing.

    ``texts``: ``node``, ``comp``, ``text``. Two sets of this similarity share ``least`` of
    the elements of either. With elements in one order for all, the rarest first, they
    therefore share one among the first ``n - least * n + 1`` of each. Elements that only one
    text has take places there and are no one's partner: a text with enough of them has none.
    What follows the first shared element bounds how many they can share, and the cells
    in which their parities differ bound from below how many they do not share.
    """
    elements = written(elements_of(texts), "elements")
    each = elements.select("node", "comp", "n", F.explode("elements").alias("element"))
    shared = each.groupBy("element").agg(
        F.count("*").alias("_f"), (F.min("comp") < F.max("comp")).alias("_several")
    )
    met = each.join(shared.filter("_f > 1"), "element")
    own = Window.partitionBy("node")
    alone = F.col("n") - F.count("*").over(own)
    at = alone + F.row_number().over(own.orderBy("_f", "element"))
    first = F.col("n") - F.ceil(F.col("n") * F.lit(least) - F.lit(1e-6)) + 1
    prefix = met.withColumn("at", at).filter((F.col("at") <= first) & F.col("_several"))
    prefix = prefix.select("element", "node", "comp", "n", "at").join(elements.select("node", "parity"), "node")
    prefix = written(prefix, "prefixes")
    other = prefix.select(
        "element",
        F.col("node").alias("b"),
        F.col("comp").alias("comp_b"),
        F.col("n").alias("m"),
        F.col("at").alias("at_b"),
        F.col("parity").alias("parity_b"),
    )
    both = F.col("n") + F.col("m")
    close = F.least("n", "m") >= F.lit(least) * F.greatest("n", "m")
    enough = 1 + F.least(F.col("n") - F.col("at"), F.col("m") - F.col("at_b")) >= both * (least / (1 + least)) - 1e-6
    unlike = F.lit(0)
    for k in range(PARITY_BITS // 64):
        unlike = unlike + F.bit_count(F.get("parity", F.lit(k)).bitwiseXOR(F.get("parity_b", F.lit(k))))
    alike = unlike <= both * ((1 - least) / (1 + least)) + 1e-6
    return (
        prefix.withColumnRenamed("node", "a")
        .join(other, "element")
        .filter((F.col("a") < F.col("b")) & (F.col("comp") != F.col("comp_b")) & close & enough & alike)
        .select("a", "b")
        .distinct()
    )


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in no more tasks than its number of rows calls for."""
    return df.coalesce(max(1, math.ceil(rows / TASK_ROWS)))


def components(links: DataFrame) -> DataFrame:
    """``node``, ``comp``: the smallest node that links lead to, for all nodes with links.

    Each round, every node goes to that of its neighbours and itself which has the smallest
    hash of this round, and on to where that one goes; the links between the places reached
    stay, each once. A group of copies thus loses nearly all of its links at once. Hashes
    change with the round, so that it leaves at most about three quarters of the nodes,
    in long chains too. What a round leaves is stored.
    """
    edges = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    rows = edges.count()
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    edges, rounds = edges.filter("a <> b"), []
    while not edges.isEmpty():
        turn = F.lit(len(rounds))

        def place(column: str) -> Column:
            return F.struct(F.xxhash64(turn, column).alias("hash"), F.col(column).alias("at"))

        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min(place("b")).alias("m"))
        nearest = nearest.select("a", F.least("m", place("a"))["at"].alias("x"))
        beyond = nearest.join(nearest.toDF("x", "y"), "x").select("a", F.col("y").alias("x"))
        moves = written(small(beyond, rows), "moves")
        moved = edges.join(moves, "a").join(moves.toDF("b", "y"), "b").filter("x <> y")
        moved = moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        edges = written(small(moved, rows), "links")
        rounds.append(moves)
    # Later rounds have fewer nodes, so they are put together from the last one on.
    whole = None
    for moves in reversed(rounds):
        if whole is not None:
            moves = moves.join(whole.toDF("x", "y"), "x", "left").select("a", F.coalesce("y", "x").alias("x"))
        whole = moves
    placed = nodes.withColumn("comp", F.col("node"))
    if whole is not None:
        placed = nodes.join(whole.toDF("node", "x"), "node", "left").select("node", F.coalesce("x", "node").alias("comp"))
    placed = written(small(placed, rows), "labels")
    names = placed.groupBy("comp").agg(F.min("node").alias("least"))
    return written(
        small(placed.join(names, "comp").select("node", F.col("least").alias("comp")), rows), "labels"
    )


def near_duplicates(
    docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``doc_id``, ``key``, ``comp`` of each row.

    Documents whose five-word runs have a weighted Jaccard similarity of ``least`` are
    linked, and links join them into classes; ``comp`` numbers the class and is null
    for texts without words (null and empty ones too), which are no copies of
    anything. Rows that repeat are in one class. Other columns are left out.

    Equal texts are one node. In each band's bucket all nodes are compared with one
    of them, chosen by a hash so that a node meets others in each band. Where that
    leaves a bucket in several classes, its nodes are compared with nodes of other
    classes as well, as far as :func:`between_classes` does not rule them out, which it
    does exactly; pairs within a class need not be. Lengths that rule the similarity
    out are not compared. So a bucket of near copies costs about as many pairs as it
    has members.
    """
    rowwise = written(signed(docs, bands, rows), "signatures")
    nodes = written(
        rowwise.filter("n > 0")
        .groupBy("key")
        .agg(*[F.first(c).alias(c) for c in ("n", "bands")])
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    members = nodes.select(F.explode("bands").alias("bucket"), "node", "n")
    order = F.struct(F.xxhash64("bucket", "node"), "node", "n")
    shared = members.groupBy("bucket").agg(F.min(order).alias("p"), F.count("*").alias("k"))
    shared = shared.filter("k > 1").select("bucket", F.col("p.node").alias("pivot"), F.col("p.n").alias("m"))
    inside = written(members.join(shared, "bucket"), "members")
    close = F.least("n", "m") >= F.lit(least) * F.greatest("n", "m")
    first = written(
        inside.filter((F.col("pivot") != F.col("node")) & close)
        .select(F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b"))
        .distinct(),
        "pairs",
    )
    known = nodes.select("key", "node").join(inside.select("node").distinct(), "node")
    texts = written(
        docs.select(F.md5(F.coalesce("text", F.lit(""))).alias("key"), "text")
        .join(known, "key")
        .groupBy("node")
        .agg(F.first("text").alias("text")),
        "texts",
    )
    classes = components(verified(first, texts, least))
    placed = inside.join(classes, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    several = (
        placed.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x < y")
    )
    left = written(placed.join(several.select("bucket"), "bucket").select("node", "comp").distinct(), "open")
    second = between_classes(texts.join(left, "node"), least).join(first, ["a", "b"], "left_anti")
    more = written(verified(second, texts, least), "links")
    names = nodes.select("key", "node").join(classes, "node", "left")
    names = names.select("key", F.coalesce("comp", "node").alias("comp"))
    if not more.isEmpty():
        # Links between classes: the classes are the nodes of a smaller graph.
        ends = more.join(left.toDF("a", "x"), "a").join(left.toDF("b", "y"), "b")
        joined = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        names = names.join(joined.toDF("comp", "whole"), "comp", "left").select(
            "key", F.coalesce("whole", "comp").alias("comp")
        )
    return rowwise.select("doc_id", "key").join(names, "key", "left")


def classes(docs: DataFrame, **limits) -> DataFrame:
    """``doc_id``, ``class_id`` (the smallest id in its class), ``class_size`` of each row.

    A row without near copies is a class of its own; null ids are no class's name as
    long as another id is there.
    """
    found = near_duplicates(docs, **limits)
    stored = written(found, "classes")
    named = stored.filter("comp is not null").groupBy("comp").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")
    )
    return stored.join(named, "comp", "left").select(
        "doc_id",
        F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
    )


def deduplicated(docs: DataFrame, **limits) -> DataFrame:
    """The documents, in their columns, with one row of each class: that of the smallest id.

    Of rows with one id the one with the smallest text digest stays, of equal rows one.
    Texts without words all stay.
    """
    found = near_duplicates(docs, **limits)
    stored = written(found, "classes")
    kept = (
        stored.filter("comp is not null")
        .groupBy("comp", "doc_id", "key")
        .agg(F.count("*").alias("n"))
        .groupBy("comp")
        .agg(F.min(F.struct("doc_id", "key", "n")).alias("r"))
        .select(F.col("r.doc_id").alias("_llm_id"), F.col("r.key").alias("_llm_key"), F.col("r.n").alias("_llm_n"))
    )
    wordless = stored.filter("comp is null").select(F.col("key").alias("_llm_key")).distinct()
    keyed = docs.withColumn("_llm_k", F.md5(F.coalesce("text", F.lit(""))))
    joined = keyed.join(kept, F.col("doc_id").eqNullSafe(F.col("_llm_id")) & (F.col("_llm_k") == F.col("_llm_key")))
    one = joined.filter("_llm_n = 1").select(*docs.columns)
    several = joined.filter("_llm_n > 1").dropDuplicates(["doc_id", "_llm_k"]).select(*docs.columns)
    empty = keyed.join(wordless, F.col("_llm_k") == F.col("_llm_key"), "left_semi").select(*docs.columns)
    return one.unionByName(several).unionByName(empty)


ship(__name__)
