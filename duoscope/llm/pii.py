"""Personal data: fixed base patterns, and contexts learned from what they find.

The base patterns give seed instances. The words around them are lexical patterns;
patterns and identifier-like tokens form a graph on which Spark spreads scores. A
pattern that surrounds hardly anything but identifiers of one kind marks the other
tokens it surrounds.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duoscope.llm.common import ship
from duoscope.sources.shared import written

KINDS = ("email", "ip", "card", "phone")
#: Characters before the @ of an address.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match never starts inside a run of digits that failed or was matched before.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
#: Identifier-like: a run without white space that holds a digit or @, cut at its ends.
DIGIT_OR_AT = re.compile(r"[0-9@]")
SPACE = re.compile(r"\s")
EDGE = ".,;:!?()[]{}<>\"'|"
CONTEXT_CHARS = 120
MAX_TOKEN = 80


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part and domain; linear in the text's length."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        part = text[end:at]
        start = end + len(part.rstrip(LOCAL))
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            out.append((start, found.end()))
        end = found.end() if found else at + 1
        at = text.find("@", end)
    return out


def small(part: str) -> bool:
    digits = part.lstrip("0")
    return len(digits) < 4 and int(digits or 0) <= 255


def luhn(digits: str) -> bool:
    doubled = (2 * int(d) for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start; code points, end exclusive."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if not re.search(r"[0-9]", text):
        return out
    out += [
        (1, *m.span()) for m in IP.finditer(text) if all(map(small, m.group().split(".")))
    ]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = NOT_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((3, *m.span()))
    return out


def tokens(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Identifier-like tokens of at least five digits, or one @, apart from the base spans."""
    out, at = [], 0
    busy = sorted((a, b) for _, a, b in taken)
    k = 0
    while (hit := DIGIT_OR_AT.search(text, at)) is not None:
        low = max(at, hit.start() - MAX_TOKEN)
        head = text[low : hit.start()]
        parts = SPACE.split(head)
        start = hit.start() - len(parts[-1])
        stop = SPACE.search(text, hit.start())
        end = stop.start() if stop else len(text)
        at = end
        token = text[start:end]
        if len(token) > MAX_TOKEN:
            continue
        start += len(token) - len(token.lstrip(EDGE))
        token = token.strip(EDGE)
        end = start + len(token)
        while k < len(busy) and busy[k][1] <= start:
            k += 1
        if k < len(busy) and busy[k][0] < end:
            continue
        digits = len(NOT_DIGIT.sub("", token))
        if digits >= 5 or ("@" in token and len(token) >= 5):
            out.append((start, end))
    return out


def shape(token: str) -> str:
    """Runs of digits as 9, runs of letters as a, the rest as it is."""
    return re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", token))[:24]


def contexts(text: str, start: int, end: int) -> list[str]:
    """Patterns of a place: two words before; a word before and after; a word before and the shape."""
    left = text[max(0, start - CONTEXT_CHARS) : start].lower().split()[-2:]
    right = text[end : end + CONTEXT_CHARS].lower().split()[:1]
    before, after = (left or ["^"])[-1], (right or ["$"])[0]
    found = [f"1|{before}|{shape(text[start:end])}", f"2|{before}|{after}"]
    if len(left) == 2:
        found.append(f"3|{left[0]}|{before}")
    return found


def instance(text: str) -> int:
    """A signed 64-bit key of an identifier, without spaces and punctuation at its ends."""
    data = "".join(text.lower().split()).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


PLACE = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()),
                   ("instance", pa.int64()), ("patterns", pa.list_(pa.string()))])
PLACE_SQL = "struct<kind:int,start:int,stop:int,instance:long,patterns:array<string>>"


def places(docs: DataFrame) -> DataFrame:
    """``docs`` with ``places`` instead of ``text``: base spans (kind 0-3) and other tokens (-1)."""
    kept = [f for f in docs.schema if f.name != "text"]
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                text = text or ""
                base = base_spans(text)
                spans = base + [(-1, a, b) for a, b in tokens(text, base)]
                out.append(
                    [
                        {"kind": k, "start": a, "stop": b, "instance": instance(text[a:b]),
                         "patterns": contexts(text, a, b)}
                        for k, a, b in spans
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(out, pa.list_(PLACE))],
                [*(f.name for f in kept), "places"],
            )

    return docs.mapInArrow(run, ", ".join([*schema, f"places array<{PLACE_SQL}>"]))


def pattern_scores(
    found: DataFrame, rounds: int = 3, prior: float = 1.0, least: float = 0.8, support: int = 3
) -> DataFrame:
    """``pattern``, ``kind``, ``confidence`` of the patterns to trust.

    Edges (pattern, instance) are counted before anything is joined. An instance
    found by a base pattern has score 1 for its kind; another has the mean score of
    its patterns. A pattern's score is the mean over its instances, with ``prior``
    instances of score 0 added. Trusted are patterns with a score of ``least`` and
    ``support`` different seed instances.
    """
    each = found.select(F.explode("places").alias("p")).select("p.*")
    kinds = [F.max((F.col("kind") == k).cast("double")).alias(f"s{k}") for k in range(len(KINDS))]
    edges = written(
        each.select("kind", "instance", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "instance")
        .agg(F.count("*").alias("n"), *kinds),
        "edges",
    )
    names = [f"s{k}" for k in range(len(KINDS))]
    seeds = edges.groupBy("instance").agg(*[F.max(s).alias(s) for s in names])
    seeds = seeds.withColumn("seed", F.greatest(*names) > 0)
    scores = seeds
    for number in range(rounds):
        linked = edges.select("pattern", "instance").join(scores, "instance")
        patterns = linked.groupBy("pattern").agg(
            *[(F.sum(s) / (F.count("*") + F.lit(prior))).alias(s) for s in names],
            F.count_if("seed").alias("seeds"),
        )
        if number + 1 == rounds:
            break
        spread = (
            edges.select("pattern", "instance")
            .join(patterns, "pattern")
            .groupBy("instance")
            .agg(*[F.avg(s).alias(f"n{s}") for s in names])
        )
        scores = written(
            seeds.join(spread, "instance").select(
                "instance",
                "seed",
                *[F.when(F.col("seed"), F.col(s)).otherwise(F.col(f"n{s}")).alias(s) for s in names],
            ),
            "scores",
        )
    best = F.greatest(*names)
    kind = F.coalesce(*[F.when(F.col(s) == best, F.lit(k)) for k, s in enumerate(names)])
    trusted = patterns.filter((best >= least) & (F.col("seeds") >= support))
    return trusted.select("pattern", kind.alias("kind"), best.alias("confidence"))


def find(docs: DataFrame, key: str = "doc_id", **limits) -> DataFrame:
    """Per row: the column ``key``, ``base`` and ``spans`` as arrays of (kind, start, stop).

    ``spans`` holds all base spans and those that trusted patterns add, by kind, then
    start. Null text counts as empty; a token that several patterns mark takes the
    kind of the most confident one, of equal ones the first kind. Rows that repeat
    are kept as they come; other columns are left out.
    """
    placed = places(docs.select(key, "text", F.monotonically_increasing_id().alias("_row")))
    stored = written(placed, "places")
    trusted = pattern_scores(stored, **limits)
    open_places = (
        stored.select("_row", F.explode("places").alias("p"))
        .filter("p.kind = -1")
        .select("_row", "p.start", "p.stop", F.explode("p.patterns").alias("pattern"))
    )
    added = (
        open_places.join(trusted, "pattern")
        .groupBy("_row", "start", "stop")
        .agg(F.max(F.struct("confidence", (-F.col("kind")).alias("neg"))).alias("best"))
        .select("_row", F.struct((-F.col("best.neg")).alias("kind"), "start", "stop").alias("span"))
        .groupBy("_row")
        .agg(F.collect_list("span").alias("added"))
    )
    base = F.transform(
        F.filter("places", lambda p: p["kind"] >= 0),
        lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["stop"].alias("stop")),
    )
    whole = stored.join(added, "_row", "left").withColumn("base", base)
    empty = F.filter("base", lambda p: F.lit(False))
    spans = F.array_sort(F.concat("base", F.coalesce("added", empty)))
    return whole.withColumn("spans", spans).drop("_row", "places", "added")


def spans_text(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda p: F.concat_ws(
                ":", F.element_at(names, p["kind"] + 1), p["start"].cast("string"), p["stop"].cast("string")
            ),
        ),
    )


def covered(text: str, spans: list[dict]) -> str:
    """The text with a mark for the kind in the place of each span; of overlapping ones the first."""
    out, at = [], 0
    for span in sorted(spans, key=lambda s: (s["start"], -s["stop"], s["kind"])):
        if span["stop"] <= at:
            continue
        if span["start"] >= at:
            out += [text[at : span["start"]], f"<{KINDS[span['kind']].upper()}>"]
        at = span["stop"]
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, **limits) -> DataFrame:
    """The documents, in their columns, with ``<KIND>`` in the place of personal data.

    Spans follow from the text alone, so they are found once per different text with
    a digit or an @ and joined back by its digest; all other rows, null and empty texts
    among them, pass unchanged. Rows that repeat stay.
    """
    may = F.coalesce(F.col("text").rlike("[0-9@]"), F.lit(False))
    digest = F.sha2("text", 256)
    found = find(docs.filter(may).select(digest.alias("_llm_digest"), "text"), "_llm_digest", **limits)
    one = (
        found.filter(F.size("spans") > 0)
        .groupBy("_llm_digest")
        .agg(F.first("spans").alias("_llm_spans"))
    )

    @F.arrow_udf("string")
    def cover(texts: pa.Array, spans: pa.Array) -> pa.Array:
        pairs = zip(texts, spans)
        return pa.array([covered(t.as_py(), s.as_py()) if s.is_valid else t.as_py() for t, s in pairs], pa.string())

    concerned = docs.filter(may)
    joined = concerned.join(one, digest == F.col("_llm_digest"), "left")
    changed = joined.withColumn("text", cover("text", "_llm_spans")).drop("_llm_digest", "_llm_spans")
    return docs.filter(~may).union(changed)


ship(__name__)
