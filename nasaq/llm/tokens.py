"""Sizes of texts in tokens of a public tokenizer.

The vocabulary file is a parameter and must be at the same path on every executor.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the published pre-tokenisation pattern of these byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@functools.lru_cache(2)
def encoding(vocabulary: str):
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, vocabulary: str = VOCABULARY, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows (keep..., tokens long) of the whole texts; null texts have 0 tokens."""
    src = documents.select(*keep, "text")
    n = len(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(vocabulary).encode_ordinary
        for batch in batches:
            counts = [len(encode(t)) if t else 0 for t in batch.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(counts, pa.int64())], names=[*keep, "tokens"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema[:n]) + ", tokens long"
    return src.mapInArrow(run, schema)


def usable(documents: DataFrame) -> DataFrame:
    """Documents with some text."""
    return documents.where("doc_id IS NOT NULL AND length(trim(text)) > 0")
