"""Periodic runs, spelling variants and token counts against plain versions."""

from __future__ import annotations

import os
import random
import re
import sys
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import plain  # noqa: E402

from duoscope.llm import counts, queries, runs, variants  # noqa: E402

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, runs string, collapsed string,"
    " word string, n string, key string, n_bytes string, n_tokens string"
)


def frame(spark, rows):
    """Documents with extra columns that carry names which the operators use themselves."""
    return spark.createDataFrame([(k, t, None, None, None, *["x"] * 7) for k, t in rows], SCHEMA)


def folder_of(spark, folder, rows):
    frame(spark, rows).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder


def phrase(r: random.Random, letters: str = "abcdefg") -> str:
    return "".join(r.choices(letters, k=r.randint(1, 3)))


def texts(seed: int, count: int) -> list[str]:
    r = random.Random(seed)
    out = []
    for _ in range(count):
        words = [phrase(r) for _ in range(r.randint(0, 40))]
        for _ in range(r.randint(0, 3)):
            unit = [phrase(r, "ab") for _ in range(r.randint(1, 20))]
            words += (unit * 8)[: r.randint(1, 8 * len(unit))]
        out.append(r.choice([" ", "\n", "\t \x0b"]).join(words))
    return out


EDGES = [None, "", " \n\t ", "a", "a a a a a", "a a a a a a", "a b " * 4, "x" * 50_000, "no break \x1c x", "é \U0001f600 " * 9]


def plain_runs(words):
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        k = 0
        while k + q < n:
            e = k
            while e + q < n and words[e] == words[e + q]:
                e += 1
            length = e + q - k
            if length >= max(6, 4 * q) and not any(
                all(words[i] == words[i + p] for i in range(k, k + length - p)) for p in range(1, q)
            ):
                out.append((k, length, q))
            k = e + 1
    return sorted(out)


def plain_row(key, text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    n, h = len(words), zlib.crc32(("" if key is None else str(key)).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    milli = None if best is None else 1000 * best[1] // best[2]
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (key, len(found), *(best or (None,) * 3), milli, plain.sha(lines.encode()), plain.sha(kept.encode()))


def test_runs_query_against_plain(spark, folder):
    rows = list(enumerate(EDGES + texts(1, 150))) + [(None, "b a " * 9), (7, "c d " * 5), (7, "c d " * 5)]
    out = queries.op11_synchronised_runs(spark, folder_of(spark, folder, rows))
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    want = sorted((plain_row(k, t) for k, t in rows), key=repr)
    assert got == want
    assert sum(r[1] for r in got) > 100 and any(r[4] and r[4] > 8 for r in got)


@pytest.mark.parametrize("slice_words", [1, 50, 1 << 18])
def test_runs_of_any_slice(spark, slice_words):
    rows = list(enumerate(texts(2, 60)))
    out = runs.periodic_runs(frame(spark, rows), slice_words=slice_words)
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in out.collect()}
    assert got == {k: plain_runs(t.split()) for k, t in rows}
    assert runs.periodic_runs(frame(spark, [])).count() == 0


def test_long_periods_beside_short_ones():
    r = random.Random(5)
    unit = [b"a"] * 30 + [b"b", b"c"] * 20 + [phrase(r).encode() for _ in range(700)]
    words = [b"x"] + (unit * 5)[: 4 * len(unit) + 3] + [b"y"] + [b"u", b"v", b"w"] * 2000
    found = runs.documents_runs([words])[0]
    assert (1, 4 * len(unit) + 3, len(unit)) in found
    assert (len(words) - 6000, 6000, 3) in found
    assert sum(q == 1 for _, _, q in found) == 4 and sum(q == 2 for _, _, q in found) == 4
    assert len(found) == 10


def edits(word: str) -> set[str]:
    """Words without one letter, with a mark in the place of it or between two letters."""
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return short in edits(long)


def plain_groups(words: dict[str, int]):
    close = {w: [v for v in words if near(v, w)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(close[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 10 * n:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(close[w]), words[form[w]] if w in form else None))
    return sorted(out, key=repr)


def vocabulary(seed: int, least: int, letters: str) -> dict[str, int]:
    r = random.Random(seed)
    words = {"".join(r.choices(letters, k=r.randint(least, least + 4))): r.choice([2, 3, 40, 500, 9000]) for _ in range(120)}
    for w in list(words):
        at = r.randrange(len(w))
        changed = r.choice([w[:at] + w[at + 1 :], w[:at] + "z" + w[at + 1 :], w[:at] + "é" + w[at:], w + w[-1]])
        if changed:
            words[changed] = r.choice([2, 3, 7])
    return words


@pytest.mark.parametrize(("least", "letters", "block_words"), [(7, "abcde", 192), (3, "ab", 2), (1, "abcÿ×", 4)])
def test_spelling_groups_against_plain(spark, least, letters, block_words):
    words = vocabulary(least, least, letters)
    df = spark.createDataFrame([*words.items(), (None, 3)], "word string, n long").repartition(4)
    out = variants.spelling_groups(df.withColumn("root", F.lit("x")), block_words=block_words)
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == plain_groups(words)
    assert any(r[1] for r in got)


def test_one_block_of_many_words(spark):
    """All words share their beginning: blocks are divided, and chains of forms are followed."""
    words = {f"prefixes{a}{b}{c}": 2 for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"}
    words |= {"prefixesaa": 20, "prefixesa": 200, "prefixes": 2000, "x" * 3000: 2, "x" * 3001: 30}
    df = spark.createDataFrame([*words.items()], "word string, n long")
    got = {r.word: r for r in variants.spelling_groups(df, block_words=20).collect()}
    assert got["prefixesaab"].form == "prefixesaa" and got["prefixesaab"].root == "prefixes"
    assert got["x" * 3000].form == "x" * 3001
    assert got["prefixesbcd"].n_near == 21 and got["prefixesbcd"].form is None
    sizes = variants.blocks(df, 20).groupBy("block", "hi", "lo").count().filter("hi - lo > 1")
    assert sizes.agg(F.max("count")).first()[0] <= 20


def test_variants_query_against_plain(spark, folder):
    r = random.Random(9)
    base = ["".join(r.choices("abcdéØ", k=r.randint(6, 9))) for _ in range(25)]
    rows = [(k, r.choice([" ", "Ā", ", "]).join(r.choices(base, k=40)).swapcase()) for k in range(60)]
    rows += [(None, " ".join(base)), (3, None), (4, ""), (5, "\U0001f600".join(base)), (5, "\U0001f600".join(base))]
    seen = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    words = {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}
    out = queries.op12_prefix_suffix_variants(spark, folder_of(spark, folder, rows))
    assert sorted((tuple(x) for x in out.collect()), key=repr) == plain_groups(words)
    empty = variants.count_words(frame(spark, []))
    assert variants.spelling_groups(empty).count() == 0


def test_words_of_slices():
    data = ("longword " * 5 + "é").encode("latin-1")
    parts = list(variants.slices(data, 10))
    assert b"".join(parts) == data and all(p.count(b"longword") <= 2 for p in parts) and len(parts) > 2


@pytest.fixture(scope="module")
def vocabulary_file():
    return counts.read_vocabulary(public_tokenizers.path(queries.VOCABULARY))


STRANGE = [
    "a", "b'll", "'s", "'", " ", "  ", "\n", "7", "12", "é", "é", "́", "!", "|", "<|endoftext|>",
    "<|startoftext|>", "<", " ", "　", "don't", "İ", "中", "。", "А", "가", "ᄀ",
    "ᅡ", "\x1c", "\x00", "\x85", "​", "ß", "Σ", "Å", ".", ",", "?", "\U0001f600", "x1", "9a",
]


def test_pieces_have_the_counts_of_the_whole(vocabulary_file):
    encoder = counts.tokenizer(vocabulary_file)
    r = random.Random(1)
    for _ in range(400):
        text = "".join(r.choices(STRANGE, k=r.randint(0, 60)))
        want = len(encoder.encode(text, add_special_tokens=False))
        for size in (1, 7):
            parts = list(counts.pieces(text, size))
            assert "".join(parts) == text
            assert sum(counts.Counter(encoder, 20, 40).counts(parts)) == want


@pytest.mark.parametrize(("piece_chars", "batch_bytes"), [(1 << 16, 1 << 20), (9, 30)])
def test_token_counts(spark, vocabulary_file, piece_chars, batch_bytes):
    encoder = counts.tokenizer(vocabulary_file)
    r = random.Random(4)
    rows = list(enumerate(EDGES + ["".join(r.choices(STRANGE, k=200)) for _ in range(30)]))
    rows += [(None, "a <|endoftext|>"), (3, "twice"), (3, "twice")]
    out = counts.count_tokens(frame(spark, rows), vocabulary_file, piece_chars, batch_bytes)
    got = sorted((tuple(x) for x in out.collect()), key=repr)
    want = [(k, len((t or "").encode()), len(encoder.encode(t or "", add_special_tokens=False))) for k, t in rows]
    assert got == sorted(want, key=repr)
    assert counts.count_tokens(frame(spark, []), vocabulary_file).count() == 0


def test_token_counts_query(spark, folder):
    rows = [(1, "word " * 2048), (2, "word " * 2049), (3, None)]
    out = queries.op13_token_counts(spark, folder_of(spark, folder, rows))
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    got = sorted(tuple(r) for r in out.collect())
    assert got == [(1, 10240, 2048, False), (2, 10245, 2049, True), (3, 0, 0, False)]
