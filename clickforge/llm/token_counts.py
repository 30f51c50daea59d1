"""Token counts of texts, by the tokenizers library inside Arrow functions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickforge.llm.library_tokens import by_bytes, library_counts


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text", batch_bytes: int = 1 << 20) -> DataFrame:
    """``id_col``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row, as the library's default
    gives them without begin, end or added special tokens.

    Only lengths leave the Arrow function. The texts of a record batch are regrouped into
    calls of about ``batch_bytes``, long texts in parts cut at safe boundaries. A null text
    counts as empty: 0 bytes, 0 tokens. Ids may be null or repeated; rows come out as they
    come in. Other columns are ignored. ``tokenizer_path`` is a file on every machine.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = library_counts(tokenizer_path)
        for b in batches:
            counts = np.zeros(b.num_rows, np.int64)
            for batch in by_bytes((t.as_py() or "" for t in b.column(1)), batch_bytes):
                for (i, _), part in zip(batch, own.parts([t for _, t in batch])):
                    counts[i] += sum(part)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(counts)],
                                             [b.schema.names[0], "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kept = docs.select(id_col, text.alias("_text"),
                       F.octet_length(text).cast("long").alias("_bytes"))
    return kept.mapInArrow(run, kept.select(
        id_col, F.col("_bytes").alias("n_bytes"), F.col("_bytes").alias("n_tokens")).schema)
