"""Prediction by partial matching over bytes, with word frequencies as the base to compare with.

The model is a trie of byte contexts: how often each byte followed each run of up to
``order`` bytes in the training texts. A byte that did not follow the longest context
is predicted from the next shorter one at the price of an escape (method C), without
the bytes that the longer context has ruled out.

No task and no driver holds the trie. Texts are dealt into parts; each part asks for the
runs of bytes it has, and these questions meet the counts where contexts with the same
last bytes lie together, so that a group has all longer contexts of its own. The
shortest contexts, whose number the alphabet bounds, go to every task.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duoscope.llm.common import ship, utf8
from duoscope.sources.shared import written

ORDER = 5
#: Contexts with these many last bytes in common lie together; shorter ones go to every task.
SHARED = 3
#: Before and after each text; never a byte of UTF-8.
END = 255
SLICE_BYTES = 1 << 21
#: Text that asks for its runs of bytes at once.
PART_BYTES = 1 << 24
#: Words that go to every task with their counts, and their longest size.
HOT_WORDS = 200_000
HOT_BYTES = 64
NO_WORD = b""
BASE = 0.1


def slices(texts, order: int):
    """(row, bytes) pieces: ``order`` bytes of context, then the bytes to predict."""
    for row, text in enumerate(texts):
        data = bytes([END]) * order + text + bytes([END])
        for at in range(order, len(data), SLICE_BYTES):
            yield row, data[at - order : at + SLICE_BYTES]


def groups(texts, order: int):
    """Pieces put together to about one slice: rows, and their pieces."""
    rows, parts, size = [], [], 0
    for row, part in slices(texts, order):
        rows.append(row)
        parts.append(part)
        size += len(part)
        if size >= SLICE_BYTES:
            yield rows, parts
            rows, parts, size = [], [], 0
    if rows:
        yield rows, parts


def grams(parts, order: int):
    """Codes of context and byte for every byte to predict, and where each piece's codes start."""
    import numpy as np

    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64)
    code = data[order:].copy()
    for back in range(1, order + 1):
        code |= data[order - back : len(data) - back] << (8 * back)
    lengths = np.array([len(p) for p in parts])
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    wanted = np.ones(len(code), bool)
    for start in starts[1:]:
        wanted[start - order : start] = False
    return code[wanted], np.concatenate(([0], np.cumsum(lengths - order)[:-1]))


def merged(held):
    """One (codes, counts) of several."""
    import numpy as np

    codes = np.concatenate([c for c, _ in held])
    counts = np.concatenate([n for _, n in held])
    unique, at = np.unique(codes, return_inverse=True)
    return unique, np.bincount(at, counts, len(unique)).astype(np.int64)


def gram_counts(texts: DataFrame, order: int) -> DataFrame:
    """``code``, ``n`` of every run of ``order`` bytes and its next byte in column ``data``."""
    import numpy as np

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            for _, parts in groups(batch.column("data").to_pylist(), order):
                held.append(np.unique(grams(parts, order)[0], return_counts=True))
                if len(held) >= 16:
                    held = [merged(held)]
                    if len(held[0][0]) > 1 << 21:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, held.pop())), ["code", "n"])
        if held:
            codes, counts = merged(held)
            for at in range(0, len(codes), 1 << 16):
                end = at + (1 << 16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes[at:end]), pa.array(counts[at:end])], ["code", "n"]
                )

    counted = texts.select("data").mapInArrow(run, "code long, n long")
    return counted.groupBy("code").agg(F.sum("n").alias("n"))


class Index:
    """Finds places in an array of different codes."""

    def __init__(self, codes):
        import numpy as np

        self.codes = codes
        self.bits = max(4, int(4 * len(codes)).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int32)
        left = np.arange(len(codes), dtype=np.int32)
        slot = self._slot(codes)
        while len(left):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]
            lost = self.slots[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & ((1 << self.bits) - 1)

    def _slot(self, codes):
        import numpy as np

        mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, codes):
        """Place of each code, or -1."""
        import numpy as np

        found = np.full(len(codes), -1, np.int64)
        if not len(self.codes):
            return found
        left, slot = np.arange(len(codes)), self._slot(codes)
        while len(left):
            index = self.slots[slot]
            same = (index >= 0) & (self.codes[index] == codes[left])
            found[left[same]] = index[same]
            more = (index >= 0) & ~same
            left, slot = left[more], (slot[more] + 1) & ((1 << self.bits) - 1)
        return found


class Model:
    """Context tables from counts of the longest order; ``log10`` scores whole texts.

    ``low`` has the finished tables of contexts shorter than ``SHARED`` bytes where the
    codes are those of one group, which cannot tell them.
    """

    def __init__(self, codes, counts, order: int, low: tuple = ()):
        import numpy as np

        self.order = order
        at = np.argsort(codes)
        codes, counts = codes[at], counts[at]
        own = []
        for k in range(order, len(low) - 1, -1):
            if k < order:
                short = codes & ((1 << (8 * (k + 1))) - 1)
                codes, place = np.unique(short, return_inverse=True)
                counts = np.bincount(place, counts, len(codes))
            contexts, first = np.unique(codes >> 8, return_index=True)
            counts = counts.astype(float)
            total = np.add.reduceat(counts, first) if len(first) else np.zeros(0)
            kinds = np.diff(np.append(first, len(codes))).astype(float)
            own.append([codes, counts, contexts, total, kinds, None, None])
        self.levels = [*own, *low]
        for k, (upper, lower) in enumerate(zip(own, self.levels[1:])):
            # What is left of the shorter context once the longer one's bytes are ruled out.
            bits = 8 * (order - k)
            short = upper[0] & ((1 << bits) - 1)
            known = lower[1][np.searchsorted(lower[0], short)]
            owner = np.searchsorted(upper[2], upper[0] >> 8)
            ruled = np.bincount(owner, known, len(upper[2]))
            parent = np.searchsorted(lower[2], upper[2] & ((1 << (bits - 8)) - 1))
            upper[5] = lower[3][parent] - ruled
            upper[6] = lower[4][parent] - upper[4]
        top = self.levels[0]
        owner = np.searchsorted(top[2], top[0] >> 8)
        self.value = np.log10(top[1] / (top[3] + top[4])[owner]) if len(top[0]) else np.zeros(0)
        self.index = Index(top[0])

    def log10(self, codes):
        """Of the probability of each byte after its context."""
        import numpy as np

        found = self.index.find(codes)
        out = np.zeros(len(codes))
        hit = found >= 0
        out[hit] = self.value[found[hit]]
        left = np.flatnonzero(~hit)
        above = np.full(len(left), -1)
        for depth, (table, counts, contexts, total, kinds, _, _) in enumerate(self.levels):
            if not len(left):
                return out
            bits = 8 * (self.order - depth + 1)
            code = codes[left] & ((1 << bits) - 1)
            place = lookup(contexts, code >> 8)
            seen = place >= 0
            mass = np.where(seen, total[place], 0.0) if len(total) else np.zeros(len(left))
            new = np.where(seen, kinds[place], 0.0) if len(total) else np.zeros(len(left))
            if depth:
                upper = self.levels[depth - 1]
                under = above >= 0
                if under.any():
                    mass[under] = upper[5][above[under]]
                    new[under] = upper[6][above[under]]
                edge = lookup(table, code)
                hit = edge >= 0
                out[left[hit]] += np.log10(counts[edge[hit]] / (mass + new)[hit])
                left, place, mass, new = left[~hit], place[~hit], mass[~hit], new[~hit]
            escape = new > 0
            out[left[escape]] += np.log10(new[escape] / (mass + new)[escape])
            above = place
        if len(left):
            out[left] -= np.log10(256 - (self.levels[-1][4][0] if len(self.levels[-1][4]) else 0))
        return out


def lookup(table, keys):
    """Index of each key in a sorted table, or -1."""
    import numpy as np

    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def train(texts: DataFrame, order: int, max_entries: int):
    """One model of all texts in column ``data`` (lower-cased bytes, not null), to be held in
    one place: of the longest order up to ``order`` that has no more entries. ``score``
    has no such bound."""
    import numpy as np

    counts = written(gram_counts(texts, order), "grams")
    while order > 1 and counts.count() > max_entries:
        order -= 1
        short = F.col("code").bitwiseAND(F.lit((1 << (8 * (order + 1))) - 1))
        counts = written(counts.groupBy(short.alias("code")).agg(F.sum("n").alias("n")), "grams")
    table = counts.toArrow()
    codes, numbers = (table.column(c).combine_chunks().to_numpy() for c in ("code", "n"))
    return Model(codes.astype(np.int64), numbers.astype(np.int64), order)


def packed(values):
    """Numbers of eight bytes as a compressed cell: what is stored and shuffled is mostly cells."""
    raw = values.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(cell, kind):
    import numpy as np

    size = int.from_bytes(cell[:8], "little")
    return np.frombuffer(pa.decompress(cell[8:], size, codec="zstd", asbytes=True) if size else b"", kind)


def steps(codes):
    """Ascending codes as differences, which take less room."""
    import numpy as np

    return packed(np.diff(codes, prepend=np.int64(0)))


def unstepped(cell):
    import numpy as np

    return np.cumsum(unpacked(cell, np.int64))


def parted(rows: DataFrame) -> DataFrame:
    """Stored, with ``_part``: the number of about PART_BYTES of neighbouring texts in ``data``."""
    import numpy as np

    def run(batches):
        first, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            data = batch.column("data")
            ends = size + np.cumsum(pc.binary_length(data).to_numpy(zero_copy_only=False), dtype=np.int64)
            size = int(ends[-1]) if len(ends) else size
            cells = [*batch.columns, pa.array(first + ends // PART_BYTES)]
            yield pa.RecordBatch.from_arrays(cells, [*batch.schema.names, "_part"])

    cells = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return written(rows.mapInArrow(run, f"{cells}, _part long"), "texts")


def asked(rows: DataFrame, training: str, order: int, buckets: int) -> DataFrame:
    """Stored, per part and bucket of contexts: the ascending codes that the part has, and how
    often its training texts have them. Bucket -1 has the counts of the shorter contexts."""
    import numpy as np

    shared = min(order, SHARED)

    def cells(part, held):
        codes, counts = merged(held)
        bucket = bucket_of(codes, shared, buckets)
        at = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[at])) + 1
        taught = counts > 0
        low, place = np.unique(codes[taught] & ((1 << (8 * shared)) - 1), return_inverse=True)
        sums = np.bincount(place, counts[taught], len(low)).astype(np.int64)
        groups_ = [(int(bucket[i[0]]), codes[i], counts[i]) for i in np.split(at, edges)]
        for start in range(0, len(groups_) + 1, 256):
            some = groups_[start : start + 256] + ([(-1, low, sums)] if start == 0 else [])
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _, _ in some], pa.int32()), pa.array([part] * len(some), pa.int64()),
                 pa.array([steps(c) for _, c, _ in some], pa.binary()),
                 pa.array([packed(n) for _, _, n in some], pa.binary())],
                ["bucket", "_part", "codes", "counts"],
            )

    def run(batches):
        held, part = [], None
        for batch in batches:
            parts = batch.column("_part").to_numpy()
            taught = batch.column(training).fill_null(False).to_pylist()
            texts = batch.column("data").to_pylist()
            edges = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(texts)]
            for at, end in zip(edges, edges[1:]):
                if at == end:
                    continue
                if held and parts[at] != part:
                    yield from cells(part, held)
                    held = []
                part = int(parts[at])
                for kind in (True, False):
                    some = [texts[i] for i in range(at, end) if taught[i] is kind]
                    for _, pieces in groups(some, order):
                        codes, counts = np.unique(grams(pieces, order)[0], return_counts=True)
                        held.append((codes, counts if kind else np.zeros_like(counts)))
                        if len(held) >= 16:
                            held = [merged(held)]
        if held:
            yield from cells(part, held)

    wanted = rows.select("_part", training, "data").mapInArrow(
        run, "bucket int, _part long, codes binary, counts binary"
    )
    return written(wanted, "asked")


def bucket_of(codes, shared: int, buckets: int):
    """By the last ``shared`` bytes of the context."""
    import numpy as np

    context = ((codes >> 8) & ((1 << (8 * shared)) - 1)).astype(np.uint64)
    mixed = context * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def short_levels(questions: DataFrame, order: int) -> list:
    """Finished tables of the contexts shorter than ``SHARED`` bytes and than ``order``."""
    import numpy as np

    def run(batches):
        for batch in batches:
            for codes, counts in zip(batch.column("codes"), batch.column("counts")):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(unstepped(codes.as_py())), pa.array(unpacked(counts.as_py(), np.int64))],
                    ["code", "n"],
                )

    low = questions.filter("bucket = -1").select("codes", "counts").mapInArrow(run, "code long, n long")
    table = low.groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    codes, counts = (table.column(c).combine_chunks().to_numpy() for c in ("code", "n"))
    return Model(codes.astype(np.int64), counts.astype(np.int64), min(order, SHARED) - 1).levels


def answers(questions: DataFrame, order: int) -> DataFrame:
    """Per part and bucket: ``codes`` as asked, and ``logs``, log10 of the probability of each."""
    import numpy as np

    shared = questions.sparkSession.sparkContext.broadcast(short_levels(questions, order))

    def run(table):
        codes = [unstepped(c.as_py()) for c in table.column("codes")]
        counts = [unpacked(n.as_py(), np.int64) for n in table.column("counts")]
        unique, place = np.unique(np.concatenate(codes), return_inverse=True)
        sums = np.bincount(place, np.concatenate(counts), len(unique)).astype(np.int64)
        taught = sums > 0
        logs = Model(unique[taught], sums[taught], order, shared.value).log10(unique)
        ends = np.cumsum([len(c) for c in codes])
        cells = [packed(logs[p]) for p in np.split(place, ends[:-1])]
        return pa.Table.from_arrays(
            [table.column("_part"), table.column("codes"), pa.array(cells, pa.binary())],
            ["_part", "codes", "logs"],
        )

    return (
        questions.filter("bucket >= 0")
        .groupBy("bucket")
        .applyInArrow(run, "_part long, codes binary, logs binary")
    )


def word_counts(texts: DataFrame, flush: int = 300_000) -> DataFrame:
    """``word``, ``n`` of all texts in column ``data``; the end of a text is the empty word."""

    def run(batches):
        held: Counter = Counter()

        def rows():
            for at in range(0, len(words := list(held)), 1 << 16):
                part = words[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.binary()), pa.array([held[w] for w in part], pa.int64())],
                    ["word", "n"],
                )
            held.clear()

        for batch in batches:
            for data in batch.column("data").to_pylist():
                held.update(data.split())
                held[NO_WORD] += 1
                if len(held) > flush:
                    yield from rows()
        yield from rows()

    counted = texts.select("data").mapInArrow(run, "word binary, n long")
    return written(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")


def hot_words(counts: DataFrame, most: int = HOT_WORDS) -> dict[bytes, int]:
    """Words of the highest counts: all those from the least count on that ``most`` allow."""
    short = counts.filter((F.octet_length("word") <= HOT_BYTES) & (F.octet_length("word") > 0))
    level = F.floor(F.log2("n") * 8)
    total, least = 0, None
    for row in short.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        total += row["count"]
        if total > most:
            break
        least = row["level"]
    if least is None:
        return {}
    table = short.filter(level >= least).toArrow()
    return dict(zip(table.column("word").to_pylist(), table.column("n").to_pylist()))


def score(
    docs: DataFrame,
    training: str,
    order: int = ORDER,
    most_words: int = HOT_WORDS,
) -> DataFrame:
    """Per row ``doc_id``, the column ``training``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score`` (log10 probabilities of the whole text and its end), ``n_bytes``.

    Learns from the rows in which the boolean column ``training`` holds. A-Z count as
    a-z; null text is empty text, which is an end alone. Without training rows all
    bytes are as likely and all base scores 0. Rows that repeat are scored each, and
    teach as often as they come; other columns are left out.

    The order is the same at every size: the trie stays a stored table.
    Frequent words are looked up in the task; all others meet their counts in a join,
    so that the word list has no bound.
    """
    import numpy as np

    spark = docs.sparkSession
    data = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    all_rows = parted(docs.select("doc_id", training, data.cast("binary").alias("data")))
    taught = all_rows.filter(training)
    counts = word_counts(taught)
    known = counts.agg(F.sum("n"), F.count("*"), F.max(F.when(F.octet_length("word") == 0, F.col("n"))))
    n, v, ends = (x or 0 for x in known.first())
    size, parts = all_rows.agg(F.sum(F.octet_length("data")), F.count_distinct("_part")).first()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (size or 0) // PART_BYTES, parts // 4)
    logs = answers(asked(all_rows, training, order, buckets), order)
    shared = spark.sparkContext.broadcast(hot_words(counts, most_words))
    below = n + BASE * (v + 1)

    def run(texts_, logs_):
        hot = shared.value
        known = np.concatenate([unstepped(c.as_py()) for c in logs_.column("codes")])
        values = np.concatenate([unpacked(c.as_py(), np.float64) for c in logs_.column("logs")])
        known, at = np.unique(known, return_index=True)
        index, values = Index(known), values[at]
        out = []
        for batch in texts_.to_batches():
            texts = batch.column("data").to_pylist()
            scores = np.zeros(len(texts))
            for rows, pieces in groups(texts, order):
                codes, starts = grams(pieces, order)
                np.add.at(scores, rows, np.add.reduceat(values[index.find(codes)], starts))
            sums, tokens, hits, rare, ends_at = [], [], [], [], [0]
            for text in texts:
                tf = Counter(text.split())
                found = [(hot[w], k) for w, k in tf.items() if w in hot]
                seen = np.array([*found, (ends, 1)], float)
                sums.append(float(seen[:, 1] @ np.log10((seen[:, 0] + BASE) / below)))
                tokens.append(sum(tf.values()) + 1)
                hits.append(sum(k for _, k in found) + (ends > 0))
                rare += [(w, k) for w, k in tf.items() if w not in hot]
                ends_at.append(len(rare))
            cells = [pa.array([w for w, _ in rare], pa.binary()), pa.array([k for _, k in rare], pa.int64())]
            pairs = pa.StructArray.from_arrays(cells, ["word", "tf"])
            out.append(pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column(training), pa.array(tokens, pa.int64()),
                 pa.array(hits, pa.int64()), pa.array(sums, pa.float64()), pa.array(scores),
                 pa.array([len(t) for t in texts], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends_at, pa.int32()), pairs)],
                ["doc_id", training, "n_tokens", "hits", "sums", "score", "n_bytes", "rare"],
            ))
        return pa.Table.from_batches(out)

    kinds = {f.name: f.dataType.simpleString() for f in all_rows.schema}
    scored = all_rows.groupBy("_part").cogroup(logs.groupBy("_part")).applyInArrow(
        run,
        f"doc_id {kinds['doc_id']}, `{training}` boolean, n_tokens long, hits long, sums double, "
        "score double, n_bytes long, rare array<struct<word:binary,tf:long>>",
    )
    stored = written(scored.withColumn("_row", F.monotonically_increasing_id()), "scores")
    log = F.log10((F.coalesce("n", F.lit(0)) + F.lit(BASE)) / F.lit(float(below)))
    rest = (
        stored.select("_row", F.explode("rare").alias("r"))
        .select("_row", "r.word", "r.tf")
        .join(counts, "word", "left")
        .groupBy("_row")
        .agg(
            F.sum(F.col("tf") * log).alias("more"),
            F.sum(F.when(F.col("n") > 0, F.col("tf")).otherwise(F.lit(0))).alias("also"),
        )
    )
    return stored.join(rest, "_row", "left").select(
        "doc_id",
        training,
        "n_tokens",
        (F.col("hits") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("sums") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        "score",
        "n_bytes",
    )


ship(__name__)
