"""Edge rows: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

from __future__ import annotations

import os
import random
import sys

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import plain  # noqa: E402

from duoscope.llm import (  # noqa: E402
    automaton,
    bpe,
    language,
    licences,
    minhash,
    pii,
    ppm,
    repeats,
    simhash,
    urls,
)

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " bands string, key string, places string, base string, n string, fingerprint string,"
    " digest string, h string, hits string, shard string, kind string, items string, _row string"
)


def frame(spark, rows):
    """Documents with extra columns that carry names which the operators use themselves."""
    extra = ["x"] * 13
    return spark.createDataFrame(
        [(key, text, lang, None, None, *extra) for key, text, lang in rows], SCHEMA
    )


def prose(seed: int, count: int, letters: str = "abcdefgh") -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choices(letters, k=r.randint(2, 5))) for _ in range(count))


ROWS = [
    (1, "Call +1 (555) 010-2233 or mail a.b@mail.example.com, 10.0.0.1", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, prose(1, 80), "en"),
    (4, prose(1, 80), "en"),
    (None, prose(1, 80) + " tail", "fr"),
    (6, "\u00e9\u00c9 \U0001f600 " + prose(2, 40), "fr"),
    (7, "x" * 30_000, None),
    (8, "12 34 !!", "de"),
    (9, " \n\t ", "de"),
    (10, prose(1, 60) + " " + prose(3, 60), "en"),
    (11, "Copyright (c) 2020 Someone\nReleased  under the MIT-Licence!", "en"),
]


@pytest.fixture()
def docs(spark):
    return frame(spark, ROWS).repartition(3)


@pytest.fixture()
def empty(spark):
    return frame(spark, [])


def by_row(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_licences(spark, docs, empty):
    known = licences.known(spark)
    got = {r.doc_id: r for r in licences.scan(docs, known).collect()}
    assert licences.scan(docs, known).count() == len(ROWS)
    assert got[11].licence == "MIT" and got[11].notices == ["MIT"]
    assert got[2].text_digest is None and got[9].text_digest is None and got[2].notices == []
    assert got[4].licence is None and got[4].notices == []
    assert licences.scan(empty, known).count() == 0
    assert licences.scan(docs, known.limit(0)).filter("licence is not null").count() == 0


def test_licence_of_several_lines(spark):
    text = dict((len(t), t) for _, t in licences.NOTICES)[max(len(t) for _, t in licences.NOTICES)]
    wrapped = "Copyright 1999 by X\n\n" + text.upper().replace(", ", ",\n  ").replace("SUBLICENSE", "sub-license")
    rows = [(1, wrapped, None), (2, wrapped + " more", None)]
    got = {r.doc_id: r.licence for r in licences.scan(frame(spark, rows), licences.known(spark)).collect()}
    assert got == {1: "MIT", 2: None}


def test_personal_data(docs, empty):
    found = pii.find(docs)
    want = sorted(
        ((key, [f"{k}:{a}:{b}" for k, a, b in plain.base_spans(text)]) for key, text, _ in ROWS), key=repr
    )
    got = found.select("doc_id", F.split(pii.spans_text("base"), ",").alias("s")).collect()
    assert sorted(((r.doc_id, [x for x in r.s if x]) for r in got), key=repr) == want
    assert pii.find(empty).count() == 0


def test_base_patterns_on_random_text():
    r = random.Random(5)
    for _ in range(3000):
        text = "".join(r.choices("a1290.@+- ()_\u00e9", k=r.randint(0, 40)))
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text)] == plain.base_spans(text)
    cards = "4111 1111 1111 1111 x 4111-1111-1111-1112 " + "0" * 17
    assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(cards)] == plain.base_spans(cards)


def test_contexts_find_unseen_identifiers(spark):
    rows = [(k, f"{prose(k, 6)} reach me at user{k}@mail.example.com or so", None) for k in range(8)]
    rows.append((100, "please reach me at user77@localhost or so", None))
    rows.append((101, "room number 1234567 is free", None))
    got = {r.doc_id: r.spans for r in pii.find(frame(spark, rows)).select("doc_id", pii.spans_text("spans").alias("spans")).collect()}
    start = rows[8][1].index("user77")
    assert got[100] == f"email:{start}:{start + len('user77@localhost')}"
    assert got[101] == ""


def test_redaction(docs):
    out = pii.redact(docs)
    assert out.columns == docs.columns and out.count() == len(ROWS)
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[1] == "Call <PHONE> or mail <EMAIL>, <IP>" and got[2] is None and got[8] == "12 34 !!"


ITEMS = [(1, prose(1, 30)), (2, "one two three"), (2, "one two three"), (None, prose(9, 12)), (4, None), (5, "!?")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_automaton(spark, empty, block_bytes):
    texts = [t for _, t, _ in ROWS] + ["a One, TWO three two three", prose(9, 11), prose(9, 12) + " " + prose(1, 14)]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = frame(spark, [(k, t, None) for k, t in enumerate(texts)])
    got = {r.doc_id: r for r in automaton.scan(docs, items, block_bytes=block_bytes).collect()}
    for k, text in enumerate(texts):
        w, hit, found = plain.contamination(text, ITEMS)
        spans = {i for s in got[k][automaton.SPANS] for i in range(s["first"], s["last"] + 1)}
        assert (got[k][automaton.WORDS], spans, set(got[k][automaton.ITEMS])) == (len(w), hit, found)
    assert automaton.scan(empty, items).count() == 0
    assert automaton.scan(docs, items.limit(0)).filter(F.size(automaton.ITEMS) > 0).count() == 0


def test_automaton_on_random_words():
    r = random.Random(3)
    for _ in range(150):
        items = [(str(k), " ".join(r.choices("abc", k=r.randint(0, 9)))) for k in range(5)]
        found = automaton.Automaton([(k, automaton.words_of(t)) for k, t in items], 4)
        text = " ".join(r.choices("abcd", k=60))
        w, hit, keys = plain.contamination(text, items, 4)
        spans, got = found.scan(automaton.words_of(text))
        assert {i for a, b in spans for i in range(a, b + 1)} == hit and got == keys


def test_decontamination(spark):
    passage = prose(1, 30)
    rows = [(1, f"{prose(5, 40)}, {passage}. {prose(6, 40)}", None), (2, passage, None), (3, None, None)]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = automaton.decontaminate(frame(spark, rows), items)
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: f"{prose(5, 40)}, . {prose(6, 40)}", 3: None} and len(out.columns) == 18


def test_byte_bpe(docs, empty):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    out = bpe.decode(encoded, ranks, public_tokenizers.PATTERN)
    whole = bpe.encoding(ranks, public_tokenizers.PATTERN)
    want = [(k, len(i := whole.encode_ordinary(t or "")), np.array(i, "<u4").tobytes(), (t or "").encode()) for k, t, _ in ROWS]
    assert by_row(out, "doc_id", "n_tokens", "ids", "bytes") == sorted(want, key=repr)
    assert bpe.decode(bpe.encode(empty, ranks, public_tokenizers.PATTERN), ranks, public_tokenizers.PATTERN).count() == 0


def test_pieces_have_the_same_tokens():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    whole = bpe.encoding(ranks, public_tokenizers.PATTERN)
    r = random.Random(8)
    for _ in range(200):
        text = "".join(r.choices(["a", "b'll", " ", "  ", "\n", "7", "\u00e9", "!", "\u2003", "don't"], k=200))
        parts = list(bpe.pieces(text, 7))
        assert "".join(parts) == text
        assert [i for p in parts for i in whole.encode_ordinary(p)] == whole.encode_ordinary(text)


def test_cells_of_codes_and_counts_are_small():
    codes = np.sort(np.random.default_rng(3).choice(1 << 20, 50_000, replace=False))
    counts = np.ones(50_000, np.int64)
    assert (ppm.unstepped(ppm.steps(codes)) == codes).all()
    assert (ppm.unpacked(ppm.packed(counts), np.int64) == counts).all()
    assert len(ppm.steps(codes)) < codes.nbytes / 4 and len(ppm.packed(counts)) < counts.nbytes / 10
    assert len(ppm.unstepped(ppm.steps(codes[:0]))) == 0


@pytest.mark.parametrize("hot", [200_000, 3, 0])
def test_partial_matching(spark, docs, empty, hot):
    marked = docs.withColumn("training", F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True)))
    got = ppm.score(marked, "training", order=2, most_words=hot).collect()
    low = [(k, (t or "").encode().lower()) for k, t, _ in ROWS]
    taught = [t for k, t in low if k is None or k % 3]
    score = plain.ppm(taught, 2)
    counts = plain.Counter(w for t in taught for w in [*t.split(), None])
    n, v = sum(counts.values()), len(counts)
    want = []
    for k, t in low:
        tokens = [*t.split(), None]
        base = sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        want.append((k, len(tokens), sum(counts[w] > 0 for w in tokens), n, base, score(t)))
    key = lambda r: (repr(r[0]), r[5])
    rows = sorted([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got], key=key)
    want.sort(key=key)
    assert [r[:4] for r in rows] == [r[:4] for r in want]
    assert np.allclose([r[4:] for r in rows], [r[4:] for r in want])
    if hot == 3:
        untaught = ppm.score(marked.withColumn("training", F.lit(False)), "training").collect()
        assert {r.train_tokens for r in untaught} == {0} and all(r.score < 0 for r in untaught)
        assert ppm.score(empty.withColumn("training", F.lit(True)), "training").count() == 0


def test_partial_matching_in_slices(monkeypatch):
    monkeypatch.setattr(ppm, "SLICE_BYTES", 16)
    texts = [b"abracadabra " * 5, b"", b"abra"]
    held = [ppm.grams(parts, 3) for _, parts in ppm.groups(texts, 3)]
    codes, counts = np.unique(np.concatenate([c for c, _ in held]), return_counts=True)
    model, score = ppm.Model(codes, counts, 3), plain.ppm(texts, 3)
    total = np.zeros(3)
    for rows, parts in ppm.groups(texts, 3):
        grams, starts = ppm.grams(parts, 3)
        np.add.at(total, rows, np.add.reduceat(model.log10(grams), starts))
    assert np.allclose(total, [score(t) for t in texts])


def test_shorter_order_beyond_the_bound(spark):
    rows = spark.createDataFrame([(bytearray(t.encode()),) for t in ("abcabd", "bcd", "xyz")], "data binary")
    model = ppm.train(rows, order=4, max_entries=14)
    assert model.order == 1
    texts = [b"abcabd", b"bcd", b"xyz"]
    codes, starts = ppm.grams([p for _, p in ppm.slices(texts, 1)], 1)
    assert np.allclose(np.add.reduceat(model.log10(codes), starts), [plain.ppm(texts, 1)(t) for t in texts])


def test_order_holds_beyond_four_million_entries(spark):
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789", np.uint8)
    r = np.random.default_rng(3)
    texts = [letters[r.integers(0, 36, 100_000)].tobytes() for _ in range(46)]
    rows = [(k, t.decode(), k % 23 != 0) for k, t in enumerate(texts)]
    marked = spark.createDataFrame(rows, "doc_id long, text string, training boolean").repartition(4)
    got = {x.doc_id: x.score for x in ppm.score(marked, "training").collect()}
    taught = [t for k, t in enumerate(texts) if k % 23]
    held = [ppm.grams(parts, 5)[0] for _, parts in ppm.groups(taught, 5)]
    codes, counts = np.unique(np.concatenate(held), return_counts=True)
    assert len(codes) > 1 << 22
    model = ppm.Model(codes, counts, 5)
    for k in (0, 1, 23, 45):
        want = sum(model.log10(ppm.grams(parts, 5)[0]).sum() for _, parts in ppm.groups([texts[k]], 5))
        assert np.isclose(got[k], want)


def test_simhash(docs, empty):
    got = simhash.fingerprints(docs).collect()
    assert len(got) == len(ROWS) and simhash.fingerprints(empty).count() == 0
    order = sorted({k for k, _, _ in ROWS}, key=lambda k: (k is not None, k or 0))
    text = {k: t or "" for k, t, _ in ROWS}
    want = []
    for k, t, _ in ROWS:
        t, after = t or "", text[order[(order.index(k) + 1) % len(order)]]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        want.append((k, len(t), plain.sha(edited.encode())))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == sorted(want, key=repr)
    prints = {r.doc_id: r for r in got}
    assert prints[2].fingerprint == prints[9].fingerprint == "0" * 16
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert all(r.near_edited == 1 for r in got if r.n_chars < 2)


def plain_fingerprint(text: str) -> int:
    """64 votes of the hashes of all runs of five words, one after the other."""
    words = text.translate({k: k + 32 for k in range(65, 91)}).split()
    if not words:
        return 0
    votes = [0] * 64
    runs = [words[k : k + 5] for k in range(max(1, len(words) - 4))]
    for run in runs:
        h = 42
        for word in run:
            h = xxhash.xxh64_intdigest(word.encode(), seed=h)
        for bit in range(64):
            votes[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * votes[bit] > len(runs))


def test_fingerprints_against_plain_votes(spark):
    rows = [(k, prose(k, 3 + 4 * k, "abAB"), None) for k in range(12)] + [(20, "", None), (21, "One  two\nTHREE", None)]
    rows += [(30 + k, prose(5, 200) + f" {k}", None) for k in range(4)]
    got = {r.doc_id: r for r in simhash.fingerprints(frame(spark, rows)).collect()}
    prints = {k: plain_fingerprint(t) for k, t, _ in rows}
    assert {k: r.fingerprint for k, r in got.items()} == {k: f"{v:016x}" for k, v in prints.items()}
    order = sorted(prints)
    text = {k: t for k, t, _ in rows}
    far = lambda a, b: bin(a ^ b).count("1")
    for at, k in enumerate(order):
        after = order[(at + 1) % len(order)]
        half = len(text[k]) // 2
        edited = plain_fingerprint(text[k][: len(text[k]) - half] + text[after][:half])
        assert got[k].edited_fingerprint == f"{edited:016x}"
        assert got[k].near_edited == 1 - far(prints[k], edited) / 64
        assert got[k].near_next == 1 - far(prints[k], prints[after]) / 64
        others = {v for v in prints.values() if v != prints[k] and far(v, prints[k]) <= simhash.RADIUS}
        assert got[k].n_near == len(others)
    assert max(r.n_near for r in got.values()) > 0


def test_single_document_follows_itself(spark):
    row = simhash.fingerprints(frame(spark, [(5, "abcd efgh", None)])).first()
    assert row.edited_sha256 == plain.sha(b"abcd abcd") and row.near_next == 1


def test_all_pairs_within_the_radius(spark):
    r = random.Random(4)
    base = [r.getrandbits(64) for _ in range(20)]
    values = {b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 5))) for b in base for _ in range(8)}
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    df = spark.createDataFrame([(v,) for v in signed + signed[:5]], "fingerprint long")
    want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 3}
    got = [(p.a, p.b) for p in simhash.near_pairs(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


@pytest.mark.parametrize("size", [1 << 20, 60])
def test_repeats(spark, docs, empty, size):
    rows = [(k, t) for k, t, _ in ROWS]
    out = repeats.without_repeats(docs, shard_bytes=size, hash_bytes=size, bucket_bytes=size, block_bytes=size)
    got = by_row(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(plain.repeats(rows, 50).values(), key=repr)
    assert repeats.without_repeats(empty).count() == 0


def test_repeats_in_random_text(spark):
    r = random.Random(6)
    pieces = ["".join(r.choices("ab\u00e9 ", k=r.randint(1, 30))) for _ in range(8)]
    rows = [(r.choice([None, 1, 2, 3, 4, 5, 6]), "".join(r.choices(pieces, k=r.randint(0, 12)))) for _ in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = repeats.without_repeats(df, width=24, seed=12, shard_bytes=300, hash_bytes=400, bucket_bytes=700, block_bytes=200)
    got = by_row(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(plain.repeats(rows, 24).values(), key=repr)


def test_phrase_with_other_neighbours_leaves_its_bucket(spark, monkeypatch):
    r = random.Random(8)
    noise = lambda: "".join(r.choices("abcdefghijklmnop", k=60))
    phrase = "THIS COMES WITH A NOTICE THAT ALL SHARE"
    tail = noise()
    rows = [(k, noise() + phrase + (tail if k % 20 == 0 else noise())) for k in range(300)]
    judge = repeats.removals

    def bounded(table, *rest):
        assert sum(len(t.as_py()) for t in table.column("texts")) <= 6000
        return judge(table, *rest)

    monkeypatch.setattr(repeats, "removals", bounded)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = repeats.without_repeats(df, shard_bytes=2000, hash_bytes=4000, bucket_bytes=2000, block_bytes=1000)
    got = by_row(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(plain.repeats(rows, 50).values(), key=repr)


TEACH = {
    "en": "the quick brown fox jumps over the lazy dog and then with that other thing",
    "fr": "le vif renard brun saute par dessus le chien paresseux et puis avec cette autre chose",
    "de": "der schnelle braune fuchs springt ueber den faulen hund und dann mit jener anderen sache",
}


def test_languages(spark, docs, empty):
    rows = [(k, (text + " ") * 8, lang) for k, (lang, text) in enumerate(TEACH.items())]
    langs, model = language.train(frame(spark, [*rows, (9, None, "xx"), (10, "words", None)]))
    assert langs == ["de", "en", "fr"]
    mixed = (TEACH["en"] + " ") * 6 + (TEACH["de"] + " ") * 4
    tests = frame(spark, [*rows, (20, mixed, None), (21, None, None), (22, "12 !", "en"), (23, "", "en"), (24, "\u00bd \u00b2 \u2167", None)])
    got = {r.doc_id: r[language.ANSWER] for r in language.predict(tests, langs, model).collect()}
    assert [got[k].lang_pred for k in range(3)] == ["en", "fr", "de"] and got[0].score == 1.0
    assert got[20].langs == ["en", "de"] and 0.5 < got[20].score < 0.7
    assert all(got[k].lang_pred == "und" and got[k].score == 0.0 for k in (21, 22, 23, 24))
    assert language.predict(docs, langs, model).count() == len(ROWS)
    assert language.predict(empty, langs, model).count() == 0
    none, blank = language.train(empty)
    assert none == [] and {r[0].lang_pred for r in language.predict(docs, none, blank).select(language.ANSWER).collect()} == {"und"}
    with pytest.raises(ValueError):
        language.train(tests.unionByName(frame(spark, rows)), max_languages=2)


def test_urls(spark):
    rows = [
        (1, "HTTP://WWW.Example.com/en/x?q#f"),
        (2, "http://m.example.com/en/"),
        (3, "x://net/es/://b"),
        (4, None),
        (5, "no address"),
        (6, "ftp://bad.org/shop/1"),
        (6, "ftp://bad.org/shop/1"),
        (7, "a://examplexcom/en/"),
        (None, "http://com"),
        (9, "http://shop.com/"),
        (10, "http://x.net/fr"),
    ]
    schema = "page_id long, url string, verdict string, rule string, items string"
    pages = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], schema)
    taught = [(f"http://h{k}.org/shop/{k}", True) for k in range(20)]
    taught += [(f"http://h{k}.org/news/{k}", False) for k in range(20)] + [(None, True), ("http://a.b/", None)]
    mined = urls.mine(spark.createDataFrame(taught, "url string, blocked boolean"))
    assert {tuple(r.items) for r in mined.select("items").collect()} == {("path=shop",)}
    got = [tuple(r)[:5] for r in urls.judge(pages, mined).collect()]
    want = [
        (1, "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        (2, "m.example.com", "/en/", "example.com/en/", "block"),
        (3, "net", "/es/://b", "net/es/", "block"),
        (4, "", "", None, "allow"),
        (5, "", "", None, "allow"),
        (6, "bad.org", "/shop/1", None, "block"),
        (6, "bad.org", "/shop/1", None, "block"),
        (7, "examplexcom", "/en/", None, "allow"),
        (None, "com", "", None, "allow"),
        (9, "shop.com", "/", "com/", "allow"),
        (10, "x.net", "/fr", None, "allow"),
    ]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    nothing = urls.mine(spark.createDataFrame([], "url string, blocked boolean"))
    assert urls.judge(pages, nothing).count() == len(rows) and urls.judge(pages.limit(0), mined).count() == 0


def near_copy(text: str, seed: int, share: float) -> str:
    r = random.Random(seed)
    return " ".join("other" if r.random() < share else w for w in text.split())


def test_near_copies(spark, docs, empty):
    rows = [(k, t) for k, t, _ in ROWS]
    for family in range(6):
        text = prose(100 + family, 150)
        rows += [(1000 + 10 * family + k, near_copy(text, 7 * family + k, 0.01 * k)) for k in range(5)]
    got = minhash.classes(frame(spark, [(k, t, None) for k, t in rows]).repartition(4))
    root = plain.classes([t for _, t in rows])
    members = {}
    for number, r in enumerate(root):
        members.setdefault(r, []).append(rows[number][0])
    name = {r: min((k for k in keys if k is not None), default=None) for r, keys in members.items()}
    want = [(rows[i][0], name[r], len(members[r])) for i, r in enumerate(root)]
    assert by_row(got, "doc_id", "class_id", "class_size") == sorted(want, key=repr)
    assert minhash.classes(empty).count() == 0
    kept = minhash.deduplicated(docs)
    assert kept.columns == docs.columns and minhash.deduplicated(empty).count() == 0
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert ids == sorted([1, 2, 3, None, 6, 7, 8, 9, 10, 11], key=repr)


def test_signatures_estimate_the_similarity():
    r = np.random.default_rng(1)
    a = r.integers(0, 1 << 63, 300).astype(np.uint64)
    wa, wb = r.uniform(0.2, 4.0, 300), r.uniform(0.2, 4.0, 300)
    wb[:150] = wa[:150]
    true = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    size = 2000
    same = (minhash.signature(a, wa, size) == minhash.signature(a, wb, size)).mean()
    assert abs(same - true) < 0.05


def test_links_across_long_chains(spark):
    pairs = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (103, 100)]
    got = {r.node: r.comp for r in minhash.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 104)}}


def test_links_of_a_group_are_met_once(spark, monkeypatch):
    """A group of like texts: its links are gone after one round, and repeats of a link count once."""
    pairs = [(a, b) for b in range(60) for a in range(b) if (a + b) % 3] * 3 + [(200, 201), (202, 202)]
    left = []

    def written(df, label):
        out = stored(df, label)
        if label == "links":
            left.append(out.count())
        return out

    stored = minhash.written
    monkeypatch.setattr(minhash, "written", written)
    got = {r.node: r.comp for r in minhash.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(60)}, 200: 200, 201: 200, 202: 202}
    assert left[0] == len(set(pairs)) and len(left) > 1 and sum(left[1:]) < left[0] / 10


@pytest.mark.parametrize("least", [0.8, 0.5])
def test_no_pair_between_classes_goes_missing(spark, least):
    """Texts around one base at similarities from 0 to 1; every second one is of class 0."""
    r = random.Random(2)
    base = [prose(k, 1, "abcdefgh") for k in range(60)] * 2
    texts = []
    for k in range(120):
        words = [w if r.random() > k / 400 else prose(1000 + r.randrange(50), 1) for w in base]
        texts.append(" ".join(words[: len(words) - r.randint(0, 20)]))
    comps = [0 if k % 2 else k for k in range(len(texts))]
    df = spark.createDataFrame(list(zip(range(len(texts)), comps, texts)), "node long, comp long, text string")
    got = {(p.a, p.b) for p in minhash.between_classes(df, least).collect()}
    tables = list(minhash.powers(1 << 20))
    sets = [minhash.multiset(t, tables) for t in texts]
    near = {
        (a, b) for b in range(len(texts)) for a in range(b)
        if comps[a] != comps[b] and minhash.similarity(sets[a], sets[b]) >= least
    }
    every = sum(comps[a] != comps[b] for b in range(len(texts)) for a in range(b))
    assert near and near <= got and len(got) < every / 2
