"""Token counts: pre-tokens as ragged arrays, merged rank by rank, all sequences of a batch at once (:mod:`bpe`)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm import bpe, ragged
from millrace.llm.common import id_and_text


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    Counts are those of the ``tokenizers`` library for the byte-level BPE file ``tokenizer``, without added
    special tokens; special strings in a text count as one token. There is no shuffle: tasks cut their Arrow batches
    into slices of about 1 MB, and a very long text into stretches.

    NULL text: empty, 0 tokens. NULL doc_id: kept as it is. Repeated rows: a result each. Empty table: no rows. Columns other than the two are
    not read.
    """
    narrow = id_and_text(docs, id_col, text_col)
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe.load(tokenizer)
        for batch in batches:
            for part in ragged.slices(batch, "text"):
                raw, offsets = ragged.flat(part.column("text"))
                tokens = model.counts(raw, offsets)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return narrow.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
