"""Token counts of whole texts without materialising their ids."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.llm.shipping import map_batches
from duskwatch.llm.tokens import counter, texts_of
from duskwatch.llm.words import text_bytes

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def count_tokens(
    docs: DataFrame, tokenizer: str, byte_level: bool = False, limit: int = 2048, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per row of ``docs``.

    The pieces of a pre-token are counted once per distinct pre-token of a worker; a chunk between
    blanks has the sum of its pre-tokens' pieces. The frequencies of the distinct chunks of each
    document are joined to these counts by place inside the task and summed: no ids are kept, nothing
    is shuffled. A null text counts as empty; empty texts have 0 tokens; a text of any length is
    counted whole; rows with a null id and repeated rows are kept; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = counter(tokenizer, byte_level)
        for batch in batches:
            n_bytes = np.diff(text_bytes(batch.column(1))[1])
            n_tokens = pieces.count(texts_of(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                 pa.array(n_tokens > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, run, SCHEMA, keeps=True)
