"""The pipeline against plain versions of its stages."""

from __future__ import annotations

import os
import random
import sys

import numpy as np
import public_tokenizers

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import plain  # noqa: E402

import corpus_pipeline  # noqa: E402
from duoscope.llm import bpe, pii  # noqa: E402

ENGLISH = "the quick brown fox jumps over lazy dog and then with that other thing while some people walk home".split()
FRENCH = "le vif renard brun saute par dessus chien paresseux puis avec cette autre chose pendant que ils marchent".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, _row string"


def prose(seed: int, words: list[str], count: int = 90) -> str:
    return " ".join(random.Random(seed).choices(words, k=count))


def rows():
    out = [(k, prose(k, ENGLISH), "en") for k in range(8)]
    out += [(10 + k, prose(10 + k, FRENCH), "fr") for k in range(6)]
    out += [
        (20, prose(3, ENGLISH), "en"),  # an exact copy
        (21, prose(3, ENGLISH) + " again", None),  # a near copy
        (22, prose(3, ENGLISH).upper(), None),  # one in other letters
        (23, None, "en"),
        (24, "", "en"),
        (25, "123 456 !", "fr"),
        (26, f"{prose(40, ENGLISH)}. {prose(50, ENGLISH, 20)}! {prose(41, ENGLISH)}", "en"),
        (27, prose(50, ENGLISH, 20), "en"),
        (28, f"{prose(42, FRENCH)} a.b@mail.example.com {prose(43, FRENCH)} 10.0.0.1", None),
        (1, prose(1, ENGLISH), "en"),  # a row that repeats
        (None, prose(60, ENGLISH), "en"),
    ]
    return out


def test_pipeline(spark, folder):
    table = [(k, t, g, "s", 0, "x", "y") for k, t, g in rows()]
    spark.createDataFrame(table, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    items = [(1, prose(50, ENGLISH, 20)), (2, None), (3, "!!")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    kept = [(k, t) for k, t, _ in rows() if t and any(c.isalpha() for c in t)]
    root = plain.classes([t for _, t in kept])
    named = {}
    for (key, text), r in zip(kept, root):
        named.setdefault(r, []).append((key is not None, key or 0, key, text))
    one = [min(members, key=lambda m: m[:2])[2:] for members in named.values()]
    clean = []
    for key, text in one:
        words, hit, _ = plain.contamination(text, items)
        if len(hit) > len(words) / 2:
            continue
        clean.append((key, text.replace(prose(50, ENGLISH, 20), "")))
    want = []
    for key, text in clean:
        for kind, start, stop in sorted(plain.base_spans(text), key=lambda s: -s[1]):
            text = f"{text[:start]}<{kind.upper()}>{text[stop:]}"
        want.append((key, text))

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "tokens":
            assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    whole = bpe.encoding(bpe.read_ranks(public_tokenizers.path(corpus_pipeline.RANK_FILE)), public_tokenizers.PATTERN)
    tokens = [(k, t, np.array(whole.encode_ordinary(t), "<u4").tobytes()) for k, t in want]
    got = [(r.doc_id, r.text, bytes(r.ids)) for r in docs.collect()]
    assert sorted(got, key=repr) == sorted(tokens, key=repr)
    assert not any(pii.base_spans(t) for _, t, _ in got) and len(want) == 17
    again = corpus_pipeline.run(spark, folder)
    assert sorted(((r.doc_id, r.text) for r in again.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table(spark, folder):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_names_that_need_quotes(spark, folder):
    """Columns of any name are carried through, mixtures of languages stay, nothing is lost without languages."""
    names = ["doc_id", "a.b", "text", "_llm_digest", "_llm_language", "lang", "carried_1", "text "]
    mixed = f"{prose(70, ENGLISH, 40)} {prose(71, FRENCH, 40)}"
    table = [(k, f"p{k}", t, "x", "y", g, 1.5, "z") for k, t, g in [*rows(), (90, mixed, None)]]
    docs = spark.createDataFrame(table, "c0 long, c1 string, c2 string, c3 string, c4 string, c5 string, c6 double, c7 string")
    spark.createDataFrame([(1, prose(50, ENGLISH, 20))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = whole = docs.toDF(*names)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        assert docs.columns == names
    out = {r["doc_id"]: r for r in docs.collect()}
    assert out[90]["text"] == mixed and all(r["a.b"] == f"p{r['doc_id'] or k}" for k, r in out.items())
    untaught = whole.withColumn("lang", whole["lang"].substr(9, 1)).replace("", None, ["lang"])
    assert corpus_pipeline.identified(spark, untaught, folder).count() == len(table)
