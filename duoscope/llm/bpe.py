"""Byte-level BPE encoding and decoding by a rank file, with the tiktoken library."""

from __future__ import annotations

import base64
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from duoscope.llm.common import ship

#: Texts are encoded in pieces of about this many characters.
PIECE_CHARS = 1 << 16
#: A match of the pre-splitting pattern never runs over the place between an ASCII
#: letter or digit and a space or line end, and no look-ahead crosses it backwards.
SAFE = re.compile(r"(?<=[A-Za-z0-9])(?=[ \n])")


def read_ranks(path: str) -> bytes:
    """The rank file's bytes; a vocabulary is of fixed size, whatever the corpus."""
    with open(path, "rb") as file:
        return file.read()


def encoding(ranks: bytes, pattern: str):
    import tiktoken

    lines = (line.split() for line in ranks.splitlines() if line.strip())
    merges = {base64.b64decode(token): int(rank) for token, rank in lines}
    return tiktoken.Encoding(
        "ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={}
    )


def pieces(text: str, size: int = PIECE_CHARS):
    """Cuts a long text at safe boundaries; the pieces' tokens are the whole text's tokens."""
    start = 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """``doc_id``, ``ids`` (token ids as little-endian unsigned 32-bit integers), ``n_tokens``.

    Null and empty texts have no tokens; null ids and repeated rows stay as they
    are; other columns are left out. Special tokens are never made. Pieces are
    bounded, so a long text needs memory for its own text and ids alone.
    """
    import numpy as np

    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary, n_tokens long"

    def run(batches):
        encoder = encoding(shared.value, pattern)
        for batch in batches:
            ids = []
            for text in batch.column("text").to_pylist():
                parts = [
                    np.asarray(encoder.encode_ordinary(piece), "<u4").tobytes()
                    for piece in pieces(text or "")
                ]
                ids.append(b"".join(parts))
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), counts],
                ["doc_id", "ids", "n_tokens"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """Adds ``bytes``: the raw bytes of each row's ``ids``; null ids give no bytes."""
    import numpy as np

    shared = encoded.sparkSession.sparkContext.broadcast(ranks)
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema]

    def run(batches):
        encoder = encoding(shared.value, pattern)
        for batch in batches:
            out = [
                encoder.decode_bytes(np.frombuffer(ids or b"", "<u4").tolist())
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "bytes"]
            )

    return encoded.mapInArrow(run, ", ".join([*columns, "bytes binary"]))


ship(__name__)
