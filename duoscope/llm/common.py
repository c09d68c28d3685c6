"""What several text operators share."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes that separate words: all of ASCII but digits and letters.
SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
#: Lower-cases A-Z and turns separators into spaces; bytes above 127 belong to words.
WORD_TABLE = bytes.maketrans(
    SEPARATORS + bytes(range(65, 91)), b" " * len(SEPARATORS) + bytes(range(97, 123))
)


def ship(module: str) -> None:
    """Sends the module's functions to the tasks by value: executors need no copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def words_of(text: str | None) -> list[bytes]:
    """Words as UTF-8 bytes: runs of digits, A-Z lower-cased, and everything beyond ASCII."""
    return utf8(text).translate(WORD_TABLE).split()


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def id_text(column: str = "doc_id") -> Column:
    """The id as text; a null id counts as empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def crc_mod(column: str, modulus: int) -> Column:
    return F.crc32(id_text(column).cast("binary")) % modulus


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


ship(__name__)
