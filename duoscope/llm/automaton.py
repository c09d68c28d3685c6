"""Benchmark passages in documents, found with a generalised suffix automaton over words.

The automaton holds every run of words of the test items. A document streams
through it word by word; the state and the matching length at a word say which
runs of item words end there.
"""

from __future__ import annotations

import math
import pickle
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duoscope.llm.common import ship, utf8, words_of
from duoscope.sources.shared import written

WINDOW = 10
#: Items are dealt to automata of about this much text each; one is in memory at a time.
BLOCK_BYTES = 1 << 20
#: Columns that a scan adds.
WORDS, SPANS, ITEMS = "_llm_words", "_llm_spans", "_llm_items"
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


class Automaton:
    """Generalised suffix automaton of word sequences, with the items of each window.

    ``marks[v]`` tells what ends where a document is in state ``v``: the items of the
    window that ends there, and the items shorter than a window, as (length, ids).
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        coded = []
        for key, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            if ids:
                coded.append((key, ids))
                self._add(ids)
        self.marks: list[tuple | None] = self._marked(coded)

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """The state of the runs that reach ``q`` from ``p`` and no longer ones."""
        copy = self._state(self.length[p] + 1)
        self.next[copy] = dict(self.next[q])
        self.link[copy] = self.link[q]
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _add(self, ids: list[int]) -> None:
        last = 0
        for word in ids:
            known = self.next[last].get(word)
            if known is not None:
                longer = self.length[known] != self.length[last] + 1
                last = self._split(last, word, known) if longer else known
                continue
            new, p = self._state(self.length[last] + 1), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                longer = self.length[q] != self.length[p] + 1
                self.link[new] = self._split(p, word, q) if longer else q
            last = new

    def _marked(self, coded: list[tuple[str, list[int]]]) -> list[tuple | None]:
        windows: dict[int, set[str]] = {}
        short: dict[int, tuple[int, set[str]]] = {}
        for key, ids in coded:
            state, size = 0, 0
            for word in ids:
                state, size = self.next[state][word], size + 1
                if size > self.window:
                    size = self.window
                while self.length[self.link[state]] >= size:
                    state = self.link[state]
                if size == self.window:
                    windows.setdefault(state, set()).add(key)
            if len(ids) < self.window:
                short.setdefault(state, (len(ids), set()))[1].add(key)
        marks: list[tuple | None] = [None] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            above = marks[self.link[state]] if self.link[state] > 0 else None
            whole, parts = above or (None, ())
            if state in windows:
                whole = tuple(sorted(windows[state]))
            if state in short:
                size, keys = short[state]
                parts = (*parts, (size, tuple(sorted(keys))))
            if whole or parts:
                marks[state] = (whole, parts)
        return marks

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Runs of hit words as [first, last], in order and apart, and the items found."""
        spans: list[list[int]] = []
        found: set[str] = set()
        step, link, length, marks, window = self.next, self.link, self.length, self.marks, self.window
        state = size = 0
        for at, word in enumerate(map(self.vocabulary.get, words)):
            if word is None:
                state = size = 0
                continue
            new = step[state].get(word)
            if new is None:
                while state > 0 and new is None:
                    state = link[state]
                    new = step[state].get(word)
                if new is None:
                    state = size = 0
                    continue
                size = length[state]
            state = new
            size += 1
            mark = marks[state]
            if mark is None:
                continue
            first = at + 1
            if mark[0] and size >= window:
                first = at + 1 - window
                found.update(mark[0])
            for short, keys in mark[1]:
                if size >= short:
                    first = min(first, at + 1 - short)
                    found.update(keys)
            if first <= at:
                while spans and spans[-1][1] >= first - 1:
                    first = min(first, spans.pop()[0])
                spans.append([first, at])
        return spans, found


def built(items: DataFrame, window: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One pickled automaton per block of items: ``block``, ``automaton``.

    Blocks follow from the amount of item text, so each is built in one task of
    bounded memory. An item without words is in no automaton.
    """
    named = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))

    def build(table):
        keys = zip(table["item_id"], map(words_of, table["text"]))
        automaton = Automaton(sorted(keys), window)
        return table.head(1)[["block"]].assign(automaton=pickle.dumps(automaton.__dict__))

    dealt = named.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    return dealt.groupBy("block").applyInPandas(build, "block long, automaton binary")


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES):
    """Adds ``_llm_words``, ``_llm_spans`` ([first word, last word]), ``_llm_items`` to all rows.

    All other columns stay as they are. Null and empty texts have no words. An item
    that repeats counts once; a null item id counts as an empty one. Each block of
    items is one pass over the documents; with several, rows are stored in between.
    """
    spark = docs.sparkSession
    names = docs.columns
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    schema += [f"{WORDS} long", f"{SPANS} array<struct<first:int,last:int>>", f"{ITEMS} array<string>"]
    span_type = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))

    def passed(df: DataFrame, shared, first: bool) -> DataFrame:
        def run(batches):
            automaton = Automaton([], window)
            automaton.__dict__.update(pickle.loads(shared.value))
            for batch in batches:
                size = batch.num_rows
                old = [None] * size if first else batch.column(SPANS).to_pylist()
                had = [[]] * size if first else batch.column(ITEMS).to_pylist()
                counts, spans, keys = [], [], []
                for text, before, known in zip(batch.column("text").to_pylist(), old, had):
                    words = words_of(text)
                    here, found = automaton.scan(words)
                    if before:
                        here = joined([[s["first"], s["last"]] for s in before] + here)
                    counts.append(len(words))
                    spans.append([{"first": a, "last": b} for a, b in here])
                    keys.append(sorted(found.union(known)))
                new = [pa.array(counts, pa.int64()), pa.array(spans, span_type),
                       pa.array(keys, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k) for k in range(len(names))), *new],
                    [*names, WORDS, SPANS, ITEMS],
                )

        return df.mapInArrow(run, ", ".join(schema))

    blocks = written(built(items, window, block_bytes), "automata")
    order = [row.block for row in blocks.select("block").collect()] or [None]
    for number, block in enumerate(sorted(order, key=lambda b: -1 if b is None else b)):
        if number:
            docs = written(docs, "scanned")
        row = blocks.filter(F.col("block") == F.lit(block)).first() if block is not None else None
        data = row.automaton if row else pickle.dumps(Automaton([], window).__dict__)
        docs = passed(docs, spark.sparkContext.broadcast(bytes(data)), not number)
    return docs


def hit_words() -> Column:
    """The number of words in the spans of a scanned row."""
    return F.aggregate(
        SPANS, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1
    )


def joined(spans: list[list[int]]) -> list[list[int]]:
    """Overlapping and touching spans made one."""
    out: list[list[int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def removed(text: str, spans: list[list[int]]) -> str:
    """The text without the words of the spans and what stands between those words."""
    data, out, at = utf8(text), [], 0
    places = [m.span() for m in WORD.finditer(data)]
    for first, last in spans:
        out.append(data[at : places[first][0]])
        at = places[last][1]
    out.append(data[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    max_coverage: float = 0.5,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents without benchmark passages, in the columns they came with.

    Spans of at least ``window`` item words are cut out, as are whole items shorter
    than that; a document of which a larger part than ``max_coverage`` is hit goes.
    Documents without words stay.
    """
    names = docs.columns
    place = names.index("text")

    def cut(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            spans = batch.column(SPANS).to_pylist()
            texts = [
                removed(t, [[s["first"], s["last"]] for s in found]) if found else t
                for t, found in zip(texts, spans)
            ]
            columns = [batch.column(k) for k in range(len(names))]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    internal = scan(docs, items, window, block_bytes)
    kept = internal.filter(hit_words() <= F.lit(max_coverage) * F.col(WORDS))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return kept.drop(WORDS, ITEMS).mapInArrow(cut, schema)


ship(__name__)
