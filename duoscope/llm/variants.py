"""Groups of spelling variants: words that one inserted, deleted or replaced letter makes equal.

Two words are near when their common prefix and common suffix together reach the longer
length minus one. Words meet in *regions*: for words of ``c`` letters and those of ``c + 1``, a
region ``lo, hi`` is a table of blocks whose members agree on the first ``lo`` and the last
``c - hi`` letters, so that one edit lies between. The edit of a near pair lies in one half of
the word or the other; a block with too many members is divided again, down to a single
place, where the alphabet bounds its members. Inside a block rows of a padded matrix of code
points are compared with all later rows, tile by tile. A pair is taken in the region that
holds the end of its common prefix and nowhere else, so nothing is counted twice.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duoscope.llm.common import id_text, ship
from duoscope.sources.shared import listed, written

LEAST_LETTERS = 7
LEAST_OCCURRENCES = 2
#: A form is so many times as frequent as its variant.
FORM_RATIO = 10
#: One in so many (document, word) pairs loses a letter, where asked for.
MISSPELT = 31
#: Long texts are searched in slices of about this many letters.
SLICE_LETTERS = 1 << 21
#: A task sends its counts on after so many different words.
KEPT_WORDS = 300_000
BETWEEN = re.compile(rb"[^A-Za-z\xc0-\xff]")
#: Blocks with more members are divided.
BLOCK_WORDS = 192
#: Letters compared at once.
TILE_CELLS = 1 << 22


def slices(data: bytes, size: int = SLICE_LETTERS):
    """Cuts Latin-1 text where no word goes on."""
    start = 0
    while len(data) - start > size:
        cut = BETWEEN.search(data, start + size)
        if cut is None:
            break
        yield data[start : cut.start()]
        start = cut.start()
    yield data[start:]


def count_words(
    docs: DataFrame,
    least_letters: int = LEAST_LETTERS,
    least_occurrences: int = LEAST_OCCURRENCES,
    misspelt: int | None = None,
) -> DataFrame:
    """``word``, ``n``: runs of A-Z, a-z and U+00C0 to U+00FF in all texts, A-Z lower-cased.

    Runs shorter than ``least_letters`` and words met less often than
    ``least_occurrences`` are left out. With ``misspelt`` a run whose crc32 h, together with the id of
    its document, is divisible by it loses letter h % length first. All code points are
    one byte of Latin-1; others end a run. Counts are combined in tasks.
    """
    import zlib
    from collections import Counter

    letters = re.compile(rb"[A-Za-z\xc0-\xff]{%d,}" % least_letters)

    def spelt(word: bytes, start: int) -> bytes:
        whole = word if word.isascii() else word.decode("latin-1").encode()
        h = zlib.crc32(whole, start)
        if h % misspelt:
            return word
        at = h % len(word)
        return word[:at] + word[at + 1 :]

    def run(batches):
        held: Counter = Counter()

        def rows():
            words = [w.decode("latin-1") for w in held]
            out = pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
            )
            held.clear()
            return out

        for batch in batches:
            for key, text in zip(batch.column("key"), batch.column("text")):
                data = (text.as_py() or "").encode("latin-1", "replace").lower()
                start = zlib.crc32(key.as_py().encode() + b":")
                for part in slices(data):
                    found = Counter(letters.findall(part))
                    if misspelt is None:
                        held.update(found)
                        found.clear()
                    for word, n in found.items():
                        word = spelt(word, start)
                        if len(word) >= least_letters:
                            held[word] += n
                    if len(held) > KEPT_WORDS:
                        yield rows()
        yield rows()

    counted = docs.select(id_text().alias("key"), "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_occurrences)


def _key() -> Column:
    """What the members of a block share, as a hash; blocks that meet by chance are compared for nothing."""
    rest = F.col("c") - F.col("hi")
    return F.xxhash64(
        "c", "lo", "hi",
        F.substring("word", F.lit(1), F.col("lo")),
        F.when(rest > 0, F.substring("word", F.length("word") - rest + 1, rest)).otherwise(""),
    )


def _region(lo: Column, hi: Column) -> Column:
    return F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))


def _placed(rows: DataFrame, regions: Column) -> DataFrame:
    spread = rows.select("word", "n", "c", F.explode(regions).alias("_r"))
    return spread.select("word", "n", "c", "_r.lo", "_r.hi").withColumn("block", _key())


def blocks(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, n, c, lo, hi, block: every word in the blocks where its near words are.

    Each round divides the blocks with more than ``block_words`` members, as long as they
    span more than one place; there are as many rounds as the longest word's letters can be
    halved. Sizes are counted before the shuffle, and the list of large blocks
    meets the rows in a join whose plan follows its size.
    """
    half = (F.col("c") / 2).cast("int")
    length = F.length("word")
    # An empty word has no place for an edit; a word of one letter may be the longer of a pair.
    classes = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("c")).filter("c > 0")
    # A class without words of its own length has no pairs.
    lengths = listed(words.select(length.alias("c")).distinct(), "lengths")
    classes = classes.join(lengths, "c", "left_semi")
    whole = F.col("c") == 1
    halves = F.when(whole, F.array(_region(F.lit(0), F.col("c")))).otherwise(
        F.array(_region(F.lit(0), half), _region(half, F.col("c")))
    )
    rows = written(_placed(classes, halves), "blocks")
    settled = []
    while True:
        large = (
            rows.filter("hi - lo > 1").groupBy("block").agg(F.count("*").alias("_n"))
            .filter(F.col("_n") > block_words).select("block")
        )
        large = written(large, "large-blocks")
        if large.isEmpty():
            settled.append(rows)
            break
        settled.append(rows.join(large, "block", "left_anti").select(*rows.columns))
        middle = ((F.col("lo") + F.col("hi")) / 2).cast("int")
        parts = F.array(_region(F.col("lo"), middle), _region(middle, F.col("hi")))
        divided = rows.filter("hi - lo > 1").join(large, "block", "left_semi")
        rows = written(_placed(divided, parts), "blocks")
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    return out


def letters_of(words: list[bytes], width: int, right: bool):
    """Code points of the words, one row each, padded with zeros on the right or left."""
    import numpy as np

    padded = [w.rjust(width, b"\0") if right else w.ljust(width, b"\0") for w in words]
    return np.frombuffer(b"".join(padded), np.uint8).reshape(len(words), width)


def tiles(first, last, cells: int):
    """Row numbers (i, j) with first[i] <= j < last[i], about ``cells`` at a time."""
    import numpy as np

    sizes = last - first
    ends = np.cumsum(sizes)
    a = 0
    while a < len(sizes):
        done = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + cells, "right")))
        n = sizes[a:b]
        i = np.repeat(np.arange(a, b), n)
        j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[a:b], n)
        yield i, j
        a = b


def near_rows(words: list[bytes], group, c: int, lo, hi):
    """Pairs (i, j) of near words; rows are sorted by group and length, all of ``c`` or ``c + 1`` letters."""
    import numpy as np

    sizes = np.array([len(w) for w in words])
    ends = np.searchsorted(group, group, "right")
    first = np.arange(len(words)) + 1
    last = np.where(sizes == c, ends, first)  # two longer words belong to the class above
    width = c + 1
    front, back = letters_of(words, width, False), letters_of(words, width, True)
    found = []
    for i, j in tiles(first, last, max(1, TILE_CELLS // width)):
        differ = front[i] != front[j]
        prefix = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        prefix = np.minimum(prefix, c)
        # The end of the common prefix is looked for in this region alone.
        here = (prefix >= lo[i]) & ((prefix < hi[i]) | ((prefix == c) & (hi[i] == c)))
        i, j, prefix = i[here], j[here], prefix[here]
        differ = back[i][:, ::-1] != back[j][:, ::-1]
        suffix = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        longer = sizes[j]
        near = (prefix + np.minimum(suffix, c) >= longer - 1) & ~((longer == c) & (prefix == c))
        found.append(np.stack([i[near], j[near]]))
    return np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)


def summed(words: list[bytes], n, pairs):
    """Rows (word number, near words, number of the most frequent near word)."""
    import numpy as np

    own, other = np.concatenate([pairs[0], pairs[1]]), np.concatenate([pairs[1], pairs[0]])
    if not len(own):
        return own, own, own
    met = sorted({int(k) for k in other}, key=lambda k: words[k])
    rank = np.zeros(len(words), np.int64)
    rank[met] = np.arange(len(met))
    order = np.lexsort((rank[other], -n[other], own))
    own, other = own[order], other[order]
    first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    return own[first], np.diff(np.append(first, len(own))), other[first]


def near_words(members: DataFrame) -> DataFrame:
    """``word``, ``n_near``, ``best_n``, ``best``: near words of each word that has any, over all blocks.

    ``members`` are rows of :func:`blocks`. A block is one key of the shuffle and has a bounded
    number of rows; tasks read theirs in order and compare many blocks at once.
    """
    import numpy as np

    def run(batches):
        def compared(table):
            c = table.column("c").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(c)) + 1).tolist(), len(c)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part = table.slice(a, b - a)
                words = [w.encode("latin-1") for w in part.column("word").to_pylist()]
                n = part.column("n").to_numpy()
                block = part.column("block").to_numpy()
                group = np.cumsum(np.append(0, np.diff(block) != 0))
                lo, hi = part.column("lo").to_numpy(), part.column("hi").to_numpy()
                pairs = near_rows(words, group, int(c[a]), lo, hi)
                own, near, best = summed(words, n, pairs)
                texts = part.column("word")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts.take(pa.array(own)).to_pylist(), pa.string()),
                     pa.array(near, pa.int64()), pa.array(n[best] if len(own) else own, pa.int64()),
                     pa.array(texts.take(pa.array(best)).to_pylist(), pa.string())],
                    ["word", "n_near", "best_n", "best"],
                )

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            held = held.combine_chunks()
            block, c = held.column("block").to_numpy(), held.column("c").to_numpy()
            same = (block == block[-1]) & (c == c[-1])  # the last block may go on
            open_at = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            yield from compared(held.slice(0, open_at))
            held = held.slice(open_at)
        if held is not None:
            yield from compared(held)

    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = F.length("word").alias("size")
    dealt = members.select("word", "n", "c", "lo", "hi", "block", size).repartition(tasks, "c", "block")
    partial = dealt.sortWithinPartitions("c", "block", "size").mapInArrow(
        run, "word string, n_near long, best_n long, best string"
    )
    best = F.min(F.struct((-F.col("best_n")).alias("minus_n"), "best"))
    return (
        partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_b"))
        .select("word", "n_near", (-F.col("_b.minus_n")).alias("best_n"), F.col("_b.best").alias("best"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` for rows of ``word``, ``form``: forms are followed to the last by doubling.

    A form is more frequent than its word, so there is no circle, and the number of
    steps is the logarithm of the longest chain.
    """
    found = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = found.join(ahead, "root", "left")
        found = written(
            moved.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")),
            "roots",
        )
        if found.filter("_moved").isEmpty():
            return found.select("word", "root")
        found = found.select("word", "root")


def spelling_groups(words: DataFrame, ratio: int = FORM_RATIO, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for rows of different ``word`` with count ``n``.

    ``form`` is the near word of largest ``n``, ties going to the first in code-point
    order, if it is ``ratio`` times as frequent or more; ``root`` is where following forms ends.
    Words are made of code points up to U+00FF. Rows with a null or empty word are left
    out, other columns too; an empty table gives none.
    """
    words = written(words.select("word", "n").filter("word <> ''"), "words")
    near = near_words(blocks(words, block_words))
    is_form = F.col("best_n") >= ratio * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    judged = written(judged, "forms")
    followed = roots(judged.filter("form is not null"))
    return judged.join(followed, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


ship(__name__)
