"""Token counts by the tokenizers library, lengths only."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duoscope.llm.common import ship, utf8

#: Long texts are cut into pieces of about this many characters.
PIECE_CHARS = 1 << 16
#: Strings go to the library in batches of about this many bytes.
BATCH_BYTES = 1 << 20
#: A task remembers the counts of different words up to this many bytes of them.
KEPT_BYTES = 1 << 23
#: Places that no token crosses. A vocabulary that drops white space makes nothing of it, and
#: no normal form composes it with a neighbour. A digit is a token of its own. A run of
#: letters ends at punctuation; the bar is left out, as it stands inside special tokens.
SAFE = re.compile(
    r"(?=[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000])"
    r"|(?<=[0-9])(?=[\x00-\x7f])"
    r"|(?<=[A-Za-z\u0410-\u044f\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5])"
    r"(?=[!-/:-@\[-`{}~\u3001\u3002\uff01\uff0c\uff0e\uff1a\uff1b\uff1f])"
)


def pieces(text: str, size: int = PIECE_CHARS):
    """Cuts a long text at safe boundaries; the counts of the pieces add up to the text's."""
    start = 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def read_vocabulary(path: str) -> str:
    """The tokenizer's file; a vocabulary is of fixed size, whatever the corpus."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def tokenizer(vocabulary: str):
    """The library's tokenizer on one thread, without truncation and padding."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    out = Tokenizer.from_str(vocabulary)
    out.no_truncation()
    out.no_padding()
    return out


def balanced(strings, size: int = BATCH_BYTES):
    """Lists of strings (bytes) of about ``size`` bytes each; a longer string is a list of its own."""
    held, weight = [], 0
    for string in strings:
        if held and weight + len(string) > size:
            yield held
            held, weight = [], 0
        held.append(string)
        weight += len(string)
    if held:
        yield held


class Counter:
    """Counts tokens of texts; each different word of a while is encoded once."""

    def __init__(self, encoder, batch_bytes: int = BATCH_BYTES, kept_bytes: int = KEPT_BYTES):
        self.encoder, self.batch_bytes, self.kept_bytes = encoder, batch_bytes, kept_bytes
        self.known: dict[bytes, int] = {}
        self.weight = 0

    def learn(self, words: set[bytes]) -> None:
        fresh = [w for w in words if w not in self.known]
        for batch in balanced(fresh, self.batch_bytes):
            texts = [w.decode("utf-8", "replace") for w in batch]
            found = self.encoder.encode_batch_fast(texts, add_special_tokens=False)
            self.known.update(zip(batch, map(len, found)))
            self.weight += sum(map(len, batch))

    def counts(self, parts: list[str]) -> list[int]:
        """Tokens of each part. White space of ASCII separates words and has no tokens."""
        if self.weight > self.kept_bytes:
            self.known, self.weight = {}, 0
        split = [utf8(part).split() for part in parts]
        self.learn(set().union(*split))
        return [sum(map(self.known.__getitem__, words)) for words in split]


def count_tokens(
    docs: DataFrame, vocabulary: str, piece_chars: int = PIECE_CHARS, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row of ``doc_id``, ``text``.

    Counts are those of the library for the whole text, without added special tokens;
    special strings inside texts count as the library has it. The vocabulary must drop
    white space. Null and empty texts have no bytes and no tokens, null ids and repeated
    rows stay, other columns are left out, an empty table gives none. Texts are cut into
    bounded pieces, some ``batch_bytes`` of pieces are held at a time, and only a word
    without a safe boundary goes to the library whole. Nothing is shuffled: a task
    reads its share of the bytes of the table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long"
    )

    def run(batches):
        counter = Counter(tokenizer(shared.value), batch_bytes)
        for batch in batches:
            totals = [0] * batch.num_rows
            rows, parts, weight = [], [], 0

            def settle():
                for row, n in zip(rows, counter.counts(parts)):
                    totals[row] += n

            for row, text in enumerate(batch.column("text")):
                for part in pieces(text.as_py() or "", piece_chars):
                    rows.append(row)
                    parts.append(part)
                    weight += len(part)
                    if weight >= batch_bytes:
                        settle()
                        rows, parts, weight = [], [], 0
            settle()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(totals, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    sized = docs.select(
        "doc_id", F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long")).alias("n_bytes"), "text"
    )
    return sized.mapInArrow(run, schema)


ship(__name__)
