"""Token counts: Arrow functions that return lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import by_bytes
from scoreloom.llm.tokens import encoder

BATCH_BYTES = 1 << 20


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int = 512, text: str = "text", batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """Every input row with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Encoding runs in one pass over the scan, without a shuffle.  Texts of a task are decoded and encoded in batches of
    about ``batch_bytes``; a longer text is a batch of its own, cut into parts at places no token can cross, where it has
    any (a text without one is one call).
    Null and empty texts have no tokens.  Repeated rows are counted each; an empty table gives an empty result; other
    columns pass through unless they have the name of a result column, which then replaces them.  Null ids pass through.
    """
    docs = docs.drop("n_bytes", "n_tokens", "over_limit")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count_batch = encoder(tokenizer).count_batch
        for batch in batches:
            sizes = pc.binary_length(batch.column(text)).fill_null(0).cast(pa.int64())
            tokens: list[int] = []
            for a, b in by_bytes(sizes.to_pylist(), batch_bytes):
                tokens += count_batch([t or "" for t in batch.column(text).slice(a, b - a).to_pylist()])
            columns = [batch.column(c) for c in rest]
            yield pa.RecordBatch.from_arrays([*columns, sizes, pa.array(tokens, pa.int64())], names=[*rest, "n_bytes", "n_tokens"])

    rest = [c for c in docs.columns if c != text]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text)
    schema = f"{fields + ', ' if fields else ''}n_bytes long, n_tokens long"
    return docs.mapInArrow(count, schema).withColumn("over_limit", F.col("n_tokens") > limit)
