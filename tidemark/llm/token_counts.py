"""Token counts: batch encoding in an Arrow function that returns lengths only.

The corpus is not shuffled: each task counts the texts of its split. A text longer than
``LONG_BYTES`` is cut at safe boundaries first, and pieces are packed into batches of about
``BATCH_BYTES``, so one call of the library never sees more than that, however long a text is.

A boundary is safe where one space stands between two characters that are no white space. The
vocabulary has no piece in which the space mark follows another character (checked when the
model is loaded), so no merge reaches over it, and the mark that the library puts before a text
stands for the space that was cut away.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts

LONG_BYTES = 64 << 10
BATCH_BYTES = 1 << 20
MARK = "▁"
_SAFE = re.compile(rb"(?<=[^\s\xe2\x81]) (?=[^\s\xe2])")


def load(path: str):
    """The sentencepiece model, if its pieces allow the cuts made here."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for i in range(model.get_piece_size()):
        if MARK in model.id_to_piece(i).lstrip(MARK):
            raise ValueError("a piece spans a word boundary; texts cannot be cut at spaces")
    return model


def safe_pieces(text: bytes, long_bytes: int = LONG_BYTES) -> Iterator[bytes]:
    """``text`` in pieces of about ``long_bytes`` whose token counts add up to the text's.

    A stretch without a safe boundary stays whole.
    """
    at = 0
    while len(text) - at > long_bytes:
        cut = _SAFE.search(text, at + long_bytes)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:]


def _counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch, raw in texts(batches):
            owner: list[int] = []
            pieces: list[bytes] = []
            total = np.zeros(len(raw), np.int64)
            held = 0

            def flush() -> None:
                lengths = [len(ids) for ids in model.encode([p.decode() for p in pieces], num_threads=1)]
                np.add.at(total, owner, lengths)
                owner.clear()
                pieces.clear()

            for i, text in enumerate(raw):
                for piece in safe_pieces(text):
                    owner.append(i)
                    pieces.append(piece)
                    held += len(piece)
                    if held >= BATCH_BYTES:
                        flush()
                        held = 0
            if pieces:
                flush()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in raw], pa.int64()), pa.array(total)],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs``.

    A null text counts as empty: no bytes, no tokens. Repeated rows and null ids each give a row.
    Other columns of ``docs`` are not looked at.
    """
    counted = docs.select("doc_id", "text").mapInArrow(
        _counter(model_path), "doc_id bigint, n_bytes bigint, n_tokens bigint"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
