"""Periodic runs of words, by string synchronising sets.

A run is a maximal stretch of words with a smallest period q that is at least four times as
long as q. At each scale t = 4, 8, 16, ... words are selected by the hashes of the t words
from them on: i is selected when the smallest hash of the places i to i + t stands at one of
both ends. The choice depends on the 2 t words from i on alone, so a run of period q, t <= q < 2 t,
selects its places with period q, and two neighbours in the list of places with equal
contexts of 2 t words that lie q apart propose it. Places whose t words have a period of t / 4
or less take no part, else long stretches of small period would be selected whole; these
stretches are the runs found at smaller scales, of which the smallest (periods 1 to 3) come
from a plain comparison. Every run is compared word by word in the end.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duoscope.llm.common import ship, utf8

#: Fixed by the definition of a run: length at least ``EXPONENT`` periods.
EXPONENT = 4
#: Documents are searched together up to about this many words; a longer one is alone.
SLICE_WORDS = 1 << 18
#: Words compared at once.
COMPARED = 1 << 20
#: First scale; smaller periods are found by comparison.
FIRST_SCALE = 4
OUTPUT = "start:long,length:long,period:long"


def hashes(codes):
    """Word numbers to 64-bit hashes."""
    import numpy as np

    x = codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def doubled(h, width: int):
    """Hashes of ``2 * width`` words from those of ``width``."""
    import numpy as np

    x = h[:-width] * np.uint64(0x9E3779B97F4A7C15) + h[width:]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def compared(codes, starts, shift, length: int, step: int):
    """How many words from each start on, in steps of 1 or -1, equal those ``shift`` further; ``length`` at most."""
    import numpy as np

    out = np.zeros(len(starts), np.int64)
    rows = max(1, COMPARED // max(1, length))
    for a in range(0, len(starts), rows):
        s, q = starts[a : a + rows, None], shift[a : a + rows, None]
        at = s + step * np.arange(length)
        inside = (at >= 0) & (at + q < len(codes))
        at = np.where(inside, at, 0)
        same = inside & (codes[at] == codes[np.where(inside, at + q, 0)])
        out[a : a + rows] = np.where(same.all(axis=1), length, same.argmin(axis=1))
    return out


def equal_stretches(codes, period: int):
    """Starts and lengths of all maximal stretches in which words ``period`` apart are equal."""
    import numpy as np

    same = np.zeros(max(0, len(codes) - period) + 2, np.int8)
    same[1:-1] = codes[:-period] == codes[period:] if len(codes) > period else 0
    edges = np.diff(same)
    starts = np.flatnonzero(edges == 1)
    return starts, np.flatnonzero(edges == -1) - starts + period


def small_periods(codes):
    """Runs with periods below the first scale."""
    import numpy as np

    found = []
    for q in range(1, FIRST_SCALE):
        starts, lengths = equal_stretches(codes, q)
        keep = lengths >= EXPONENT * q
        starts, lengths = starts[keep], lengths[keep]
        for p in range(1, q):  # a smaller period that divides q
            if q % p == 0 and len(starts):
                keep = compared(codes, starts, np.full(len(starts), p), q, 1) < q
                starts, lengths = starts[keep], lengths[keep]
        found.append(np.stack([starts, lengths, np.full(len(starts), q)]))
    return np.concatenate(found, axis=1)


def highly_periodic(n: int, scale: int, found):
    """Marks places whose ``scale`` words have a period of a quarter of that at most."""
    import numpy as np

    start, length, period = found
    keep = (EXPONENT * period <= scale) & (length >= scale) & (start < n)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start[keep], 1)
    np.add.at(edge, start[keep] + length[keep] - scale + 1, -1)
    return np.cumsum(edge[:-1]) > 0


def synchronising(h, scale: int, periodic):
    """Selected places, by the hashes ``h`` of ``scale`` words from each place on."""
    import numpy as np

    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    h = np.where(periodic[: len(h)], none, np.minimum(h, none - np.uint64(1)))
    least, width = h, 1
    while width < scale:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:-1], least[1:])
    n = len(least)
    return np.flatnonzero((least != none) & ((h[:n] == least) | (h[scale : scale + n] == least)))


def proposed(places, context, scale: int):
    """(place, period) of neighbours with equal contexts, the gap being one of this scale's periods."""
    import numpy as np

    order = np.lexsort((places, context))
    at, key = places[order], context[order]
    gap = np.diff(at)
    pair = (key[1:] == key[:-1]) & (gap >= scale) & (gap < 2 * scale)
    return at[:-1][pair], gap[pair]


def runs_of_scale(codes, scale: int, h, twice, found):
    """Runs with periods from ``scale`` up to twice that."""
    import numpy as np

    places = synchronising(h, scale, highly_periodic(len(codes), scale, found))
    places = places[places < len(twice)]
    at, period = proposed(places, twice[places], scale)
    if not len(at):
        return np.zeros((3, 0), np.int64)
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    # Equal contexts of 2 t words that touch or overlap are one stretch.
    first = np.ones(len(at), bool)
    first[1:] = (period[1:] != period[:-1]) | (at[1:] > at[:-1] + 2 * scale)
    at_first = np.flatnonzero(first)
    start, period = at[at_first], period[at_first]
    stop = at[np.append(at_first[1:], len(at)) - 1] + 2 * scale
    # A run has a selected place in any t words, so a longer step to either side is no run's.
    start = start - compared(codes, start - 1, period, scale, -1)
    stop = stop + compared(codes, stop, period, scale, 1)
    length = stop + period - start
    keep = length >= EXPONENT * period
    runs = np.unique(np.stack([start[keep], length[keep], period[keep]]), axis=1)
    return runs[:, exact(codes, *runs)]


def exact(codes, start, length, period):
    """Whether each run holds word by word; hashes proposed them."""
    import numpy as np

    out = np.ones(len(start), bool)
    for k, (s, n, q) in enumerate(zip(start.tolist(), length.tolist(), period.tolist())):
        for a in range(s, s + n - q, COMPARED):
            b = min(a + COMPARED, s + n - q)
            if not np.array_equal(codes[a:b], codes[a + q : b + q]):
                out[k] = False
    return out


def all_runs(codes, sizes):
    """Runs of documents that lie one after the other, longest first, each followed by a code of its own."""
    import numpy as np

    ends = np.cumsum(sizes + 1)
    found = small_periods(codes)
    scale, h = FIRST_SCALE, hashes(codes)
    for width in (1, 2):
        h = doubled(h, width) if len(h) > width else h[:0]
    while True:
        fit = int((sizes >= EXPONENT * scale).sum())  # others are too short for these periods
        if not fit:
            return found
        n = int(ends[fit - 1])
        codes, h = codes[:n], h[: n - scale + 1]
        twice = doubled(h, scale)
        found = np.concatenate([found, runs_of_scale(codes, scale, h, twice, found)], axis=1)
        scale, h = 2 * scale, twice


def documents_runs(texts: list[list[bytes]]):
    """For each list of words its runs as rows of (start, length, period), by start and period."""
    import numpy as np

    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    numbers: dict[bytes, int] = {}
    codes, sizes = [], []
    for k in order:
        codes.extend(numbers.setdefault(w, len(numbers)) for w in texts[k])
        codes.append(-1 - k)
        sizes.append(len(texts[k]))
    codes, sizes = np.array(codes, np.int64), np.array(sizes, np.int64)
    start, length, period = all_runs(codes, sizes) if len(codes) else np.zeros((3, 0), np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    owner = np.searchsorted(begins, start, "right") - 1
    out: list = [[] for _ in texts]
    for at in np.lexsort((period, start)).tolist():
        k = int(owner[at])
        out[order[k]].append((int(start[at] - begins[k]), int(length[at]), int(period[at])))
    return out


def collapsed(words: list[bytes], runs) -> bytes:
    """The words joined by spaces, without what runs repeat after their first period."""
    kept = bytearray(b"\1") * len(words)
    for start, length, period in runs:
        kept[start + period : start + length] = bytes(length - period)
    return b" ".join(w for w, k in zip(words, kept) if k)


def periodic_runs(docs: DataFrame, least: int = 6, slice_words: int = SLICE_WORDS) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (start, length, period) and ``collapsed`` text of every row.

    Words are what ASCII white space leaves. Runs have ``least`` words or more, are as long as
    four of their smallest periods, and are listed by start, then period; ``collapsed`` has
    the words that no run covers after its first period. Null, empty and blank texts have no
    words, no runs and an empty ``collapsed``; null ids and repeated rows stay, other columns
    are left out, an empty table gives none. A document is searched whole, in memory in
    proportion to its words; shorter ones are searched together. Nothing is shuffled.
    """
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, n_words long, runs array<struct<{OUTPUT}>>, collapsed string"
    row = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def run(batches):
        names = ("start", "length", "period")
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            begin, held, weight = 0, [], 0
            for k, text in enumerate(texts):
                held.append(utf8(text.as_py()).split())
                weight += len(held[-1]) + 1
                if weight < slice_words and k + 1 < batch.num_rows:
                    continue
                found = [[r for r in runs if r[1] >= least] for runs in documents_runs(held)]
                rows = [[dict(zip(names, r)) for r in runs] for runs in found]
                out = [collapsed(w, r).decode("utf-8", "replace") for w, r in zip(held, found)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(begin, len(held)), pa.array([len(w) for w in held], pa.int64()),
                     pa.array(rows, row), pa.array(out, pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )
                begin, held, weight = k + 1, [], 0

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def best_run(runs: str = "runs") -> Column:
    """The run with the greatest length per period; ties go to the smallest start, then period."""

    def better(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        earlier = (b["start"] < a["start"]) | (
            (b["start"] == a["start"]) & (b["period"] < a["period"])
        )
        return F.when((right > left) | ((right == left) & earlier), b).otherwise(a)

    return F.aggregate(runs, F.get(runs, F.lit(0)), better)


def runs_text(runs: str = "runs") -> Column:
    """One line ``start,length,period`` per run."""
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return F.array_join(F.transform(runs, line), "")


def with_repeated_words(text: Column, first: Column, period: Column) -> Column:
    """The text's words, from number ``first`` on replaced by repeats of the ``period`` words there.

    Words are joined by one space; a text without words becomes empty.
    """
    split = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def changed(words: Column) -> Column:
        n = F.size(words)
        first_, period_ = first(n), period(n)
        place = lambda i: F.when(i < first_, i).otherwise(first_ + F.pmod(i - first_, period_))
        every = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, place(i).cast("int")))
        return F.when(n == 0, "").otherwise(F.array_join(every, " "))

    # A lambda keeps the split words, which would else be worked out for each of them.
    return F.get(F.transform(F.array(split), changed), F.lit(0))


ship(__name__)
