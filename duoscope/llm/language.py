"""Language identification by mixtures of languages."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duoscope.llm.common import ship

#: n-grams of three bytes are hashed to this many cells, so a model has a fixed size.
CELLS = 1 << 16
MAX_LANGUAGES = 256
UNKNOWN = "und"
ANSWER = "_llm_language"
SMOOTHING = 0.1
SLICE_BYTES = 1 << 22
#: Lower-cased ASCII letters and bytes beyond ASCII stay, all else is space.
LETTERS = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in range(256))


def cells(text: str):
    """Counts of the text's hashed n-grams; runs of spaces count as one."""
    import numpy as np

    total = np.zeros(CELLS, np.int64)
    data = b" " + text.lower().encode("utf-8", "surrogatepass").translate(LETTERS) + b" "
    for start in range(0, max(1, len(data) - 2), SLICE_BYTES):
        a = np.frombuffer(data[start : start + SLICE_BYTES + 2], np.uint8).astype(np.uint32)
        gram = (a[:-2] << 16) | (a[1:-1] << 8) | a[2:]
        space = a == 32
        kept = gram[~((space[:-2] & space[1:-1]) | (space[1:-1] & space[2:]))]
        hashed = (kept * np.uint32(2654435761)) >> np.uint32(16)
        total += np.bincount(hashed, minlength=CELLS)
    return total


def train(labelled: DataFrame, max_languages: int = MAX_LANGUAGES):
    """Languages and their log probabilities of each cell, from all rows of ``lang``, ``text``.

    Rows without text or language teach nothing. The model is one row of fixed
    length per language; more than ``max_languages`` values of ``lang`` are an
    error, as the model goes to every task. Tasks count in arrays before the shuffle.
    """
    import numpy as np

    def count(batches):
        held: dict[str, object] = {}

        def rows():
            for lang, total in held.items():
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                     pa.array(total[at])],
                    ["lang", "cell", "n"],
                )
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                held[lang] = held.get(lang, 0) + cells(text)
                if len(held) > 64:
                    yield from rows()
        yield from rows()

    usable = labelled.select("lang", "text").filter("lang is not null and text is not null")
    counted = usable.mapInArrow(count, "lang string, cell int, n long")
    summed = counted.groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    table = (
        summed.groupBy("lang")
        .agg(F.collect_list(F.struct("cell", "n")).alias("counts"))
        .limit(max_languages + 1)
        .collect()
    )
    if len(table) > max_languages:
        raise ValueError(f"more than {max_languages} languages; the model would not be bounded")
    langs = sorted(row.lang for row in table)
    model = np.zeros((len(langs), CELLS))
    for row in table:
        pairs = np.array([(c.cell, c.n) for c in row.counts], np.int64).reshape(-1, 2)
        model[langs.index(row.lang), pairs[:, 0]] = pairs[:, 1]
    model += SMOOTHING
    return langs, np.log(model / model.sum(axis=1, keepdims=True)).astype(np.float32)


#: Expectation-maximisation ends when no share moves by more than ``SETTLED``, or after ``ROUNDS``.
ROUNDS = 30
SETTLED = 1e-3
#: Languages with a smaller share in the mixture of all do not join a text's set.
LEAST_SHARE = 0.02


def mixture(ratio, weight, rounds: int = ROUNDS):
    """Proportions by expectation-maximisation; ``ratio``: likelihoods, one row per language."""
    import numpy as np

    share = np.full(len(ratio), 1 / len(ratio))
    total = weight.sum()
    for _ in range(rounds):
        new = share * (ratio @ (weight / np.maximum(share @ ratio, 1e-300))) / total
        moved = np.abs(new - share).max()
        share = new
        if moved < SETTLED:
            break
    return share / share.sum(), float(weight @ np.log(np.maximum(share @ ratio, 1e-300)))


def identify(total, model, penalty: float = 3.0):
    """Indices and proportions of the set of languages with the best penalised likelihood.

    Languages join in the order of their shares in the mixture of all, down to
    ``LEAST_SHARE``, as long as the log likelihood gains more than ``penalty`` times the log of
    the n-gram count.
    """
    import numpy as np

    at = np.flatnonzero(total)
    weight = total[at].astype(float)
    logs = model[:, at].astype(float)
    ratio = np.exp(logs - logs.max(axis=0))
    single = logs @ weight
    best = int(single.argmax())
    chosen, shares = [best], np.ones(1)
    if len(model) == 1:
        return chosen, shares
    reached = float(weight @ np.log(ratio[best]))
    whole, _ = mixture(ratio, weight)
    price = penalty * np.log(max(weight.sum(), 2.0))
    for other in np.argsort(-whole, kind="stable"):
        if whole[other] < LEAST_SHARE:
            break
        if other in chosen:
            continue
        share, likelihood = mixture(ratio[[*chosen, other]], weight)
        if likelihood - reached <= price:
            break
        chosen, shares, reached = [*chosen, int(other)], share, likelihood
    return chosen, shares


ANSWER_FIELDS = "lang_pred:string,score:double,langs:array<string>,shares:array<double>"


def answered(texts, names: list[str], table) -> pa.Array:
    """One struct of ``ANSWER_FIELDS`` per text."""
    answer = pa.struct(
        [("lang_pred", pa.string()), ("score", pa.float64()),
         ("langs", pa.list_(pa.string())), ("shares", pa.list_(pa.float64()))]
    )
    rows = []
    for value in texts:
        text = value.as_py()
        total = cells(text) if names and text and any(map(str.isalpha, text)) else None
        if total is None or not total.any():
            rows.append({"lang_pred": UNKNOWN, "score": 0.0, "langs": [], "shares": []})
            continue
        chosen, shares = identify(total, table)
        order = sorted(range(len(chosen)), key=lambda k: (-shares[k], names[chosen[k]]))
        found = [names[chosen[k]] for k in order]
        parts = [float(min(1.0, max(0.0, shares[k]))) for k in order]
        rows.append({"lang_pred": found[0], "score": parts[0], "langs": found, "shares": parts})
    return pa.array(rows, answer)


def predict(docs: DataFrame, langs: list[str], model) -> DataFrame:
    """The columns of ``docs`` without the text, and the struct ``ANSWER``.

    Its fields are ``lang_pred``, ``score``, ``langs`` and ``shares``. Only the text is
    read. ``lang_pred`` has the largest share of the chosen set and ``score`` is that
    share; texts that are null or without a letter, and all texts if nothing was
    learned, are ``und`` with score 0 and an empty set. Equal shares go to the first
    language by name. Rows that repeat are judged each.
    """
    shared = docs.sparkSession.sparkContext.broadcast((langs, model))
    kept = [f for f in docs.schema if f.name != "text"]
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]

    def run(batches):
        for batch in batches:
            found = answered(batch.column("text"), *shared.value)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), found], [*(f.name for f in kept), ANSWER]
            )

    return docs.mapInArrow(run, ", ".join([*columns, f"`{ANSWER}` struct<{ANSWER_FIELDS}>"]))


def with_languages(docs: DataFrame, langs: list[str], model) -> DataFrame:
    """``docs`` with the struct ``ANSWER`` as in :func:`predict`; only texts go to Python, and only answers come back."""
    shared = docs.sparkSession.sparkContext.broadcast((langs, model))

    @F.arrow_udf(f"struct<{ANSWER_FIELDS}>")
    def judge(texts: pa.Array) -> pa.Array:
        return answered(texts, *shared.value)

    return docs.withColumn(ANSWER, judge("text"))


ship(__name__)
