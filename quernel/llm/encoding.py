"""Encoding of a whole corpus with a public tokenizer."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quernel.llm.bpe import ByteBpe

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteBpe:
    """One encoder per worker process and file; its tables are the same for every task."""
    return ByteBpe(path)


def encode_corpus(documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """key and ids (array<int>) of every document, without special tokens.

    Null and empty texts have an empty list; strings of special tokens are ordinary text; rows with a
    null key are kept. Repeated rows stay repeated. Needs no shuffle: every task encodes its own rows,
    in Arrow batches, and remembers the parts of texts that come again. vocabulary is a path that all
    executors can read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = encoder(vocabulary).encode_packed
        for batch in batches:
            rows = [packed(t) for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *(len(r) // 4 for r in rows)], dtype=np.int64)
            values = pa.array(np.frombuffer(b"".join(rows), dtype=np.int32))
            ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[key, "ids"])

    rows = documents.select(key, text)
    return rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, ids array<int>")
