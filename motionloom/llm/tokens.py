"""Token counts with the vocabulary file of a public tokenizer (its path is a parameter)."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

#: Fixed value: how the byte-pair vocabulary's makers cut texts before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"


@lru_cache(maxsize=4)
def encoder(path: str):  # noqa: ANN201
    """A counting function of texts for a .tiktoken, .json or .model file."""
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        e = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [len(e.encode_ordinary(t)) for t in texts]
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        return lambda texts: [len(x.ids) for x in t.encode_batch(texts, add_special_tokens=False)]
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(x) for x in p.encode(texts, num_threads=1)]


def with_token_counts(documents: DataFrame, extra: tuple[str, ...] = (), path: str = VOCABULARY) -> DataFrame:
    """``(doc_id, source, *extra, n_tokens)`` of documents with these columns and text; a null text has no tokens."""
    kept = documents.select("doc_id", "source", *extra)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = encoder(path)
        for b in batches:
            n = sizes([t or "" for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], names=[*b.schema.names[:-1], "n_tokens"])

    schema = ", ".join(f"{c} {t}" for c, t in kept.dtypes)
    return documents.select(*kept.columns, "text").mapInArrow(count, f"{schema}, n_tokens long")
