"""Token counts of whole texts under a public byte-level BPE, without token ids.

A byte-level BPE merges inside pre-tokens only, so a pre-token always gives the same number of pieces. Each block of
documents is cut into pre-tokens, the pieces of each distinct pre-token are counted once, and the counts are joined to the
pre-token frequencies of the documents and summed.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The pre-token pattern of byte-level BPE vocabularies.
PRE_TOKEN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Scripts whose letters and digits have long been the same in every Unicode version; other texts are cut by the library.
_SETTLED = regex.compile("[\u0000-ɏЀ-џ‐-‧‰-⁞€]*")
#: Distinct pre-tokens whose counts a worker keeps between blocks.
KEPT = 200_000
#: Documents of one block at most; a block's pre-tokens are joined to its documents in memory.
BLOCK_ROWS = 512

_workers: dict[str, tuple] = {}


def _library(path: str):
    """The library's tokenizer, its pre-token cutter and the special strings it takes out of texts; once per worker."""
    if path not in _workers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_padding()
        tokenizer.no_truncation()
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        cut = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        _workers[path] = (tokenizer, cut, regex.compile(PRE_TOKEN), {})
    return _workers[path]


def _counted(path: str, pieces: list[str], known: dict[str, int]) -> None:
    """Count the pieces of pre-tokens not yet known."""
    tokenizer = _library(path)[0]
    new = [p for p in pieces if p not in known]
    for at in range(0, len(new), 20_000):
        part = new[at : at + 20_000]
        known.update(zip(part, (len(e) for e in tokenizer.encode_batch(part, add_special_tokens=False))))


def block_counts(path: str, texts: list[str]) -> np.ndarray:
    """Tokens of each text of a block."""
    tokenizer, cut, pattern, known = _library(path)
    out = np.zeros(len(texts), dtype=np.int64)
    frequencies: list[tuple[int, list[str]]] = []
    distinct: set[str] = set()
    for i, text in enumerate(texts):
        if not _SETTLED.fullmatch(text):
            out[i] = len(tokenizer.encode(text, add_special_tokens=False))
            continue
        parts = [text]
        if cut is not None and cut.search(text):
            out[i] += len(cut.findall(text))
            parts = cut.split(text)
        found = [p for part in parts for p in pattern.findall(part)]
        frequencies.append((i, found))
        distinct.update(found)
    if len(known) + len(distinct) > KEPT:
        known.clear()
    _counted(path, list(distinct), known)
    for i, found in frequencies:
        out[i] += sum(map(known.__getitem__, found))
    return out


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """Per document: id, n_bytes (UTF-8), n_tokens, over_limit (more tokens than ``limit``).

    ``tokenizer_path`` names a tokenizers JSON with a byte-level pre-tokenizer, present on every machine. Counts equal the
    library's without begin, end or other added special tokens; special strings inside a text count as one token each.
    Null and empty texts have 0 bytes and 0 tokens; a Spark string
    holds no lone surrogates, so texts are valid Unicode; repeated rows are counted each; an empty table gives no rows. There is
    no shuffle: rows stay in their partition and only the counts leave it.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long"

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK_ROWS):
                block = batch.iloc[at : at + BLOCK_ROWS]
                texts = block["text"].tolist()
                sizes = np.fromiter((len(t) if t.isascii() else len(t.encode()) for t in texts), dtype=np.int64, count=len(texts))
                yield pd.DataFrame({id_col: block["id"], "n_bytes": sizes, "n_tokens": block_counts(tokenizer_path, texts)})

    return rows.mapInPandas(count, schema).withColumn("over_limit", F.col("n_tokens") > limit)
