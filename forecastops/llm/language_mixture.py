"""Languages of documents as mixtures, by expectation-maximisation over n-gram likelihoods.

A byte n-gram model is learned for each language. A document is cut into short chunks; each chunk is one draw from the
document's language mixture, with the likelihood that its n-grams have under each language. Expectation-maximisation
estimates the proportions, and the set of languages is the one whose likelihood, less a penalty per language, is largest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins of hashed n-grams; a model has this many numbers per language.
BINS = 1 << 15
#: Documents of each language, at most about, that a model learns from; the rest of the labelled rows is not needed.
LEARN_DOCS = 3000
#: Bytes of a chunk, the unit that belongs to one language.
CHUNK = 48
#: Rounds of expectation-maximisation.
ROUNDS = 12
#: Bytes of text that are worked on at a time; a longer text is a block of its own.
BLOCK_BYTES = 1 << 21
_LETTER = regex.compile(r"\p{L}")
_SMOOTHING = 0.3


def _grams(raw: np.ndarray) -> np.ndarray:
    """Bin of the three bytes that begin at each byte."""
    wide = raw.astype(np.uint32)
    mixed = wide[:-2] * np.uint32(0x9E3779B1) ^ wide[1:-1] * np.uint32(0x85EBCA77) ^ wide[2:] * np.uint32(0xC2B2AE3D)
    mixed *= np.uint32(0x27D4EB2F)
    return (mixed >> np.uint32(17)).astype(np.int64)


def _blocks(texts: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Numbers of the texts, their n-grams in a row, and where each text's n-grams begin (with the end last)."""
    numbers: list[int] = []
    parts: list[bytes] = []
    size = 0
    for i, text in enumerate(texts):
        numbers.append(i)
        # the blanks give every text n-grams that mark its begin and end, so none is without
        parts.append(b" " + text.lower().encode("utf-8", "surrogatepass") + b"  ")
        size += len(parts[-1])
        if size >= BLOCK_BYTES or i == len(texts) - 1:
            sizes = np.array([len(p) - 2 for p in parts])
            grams = _grams(np.frombuffer(b"".join(parts), dtype=np.uint8))
            # the two n-grams that straddle a text's end are left out
            ends = np.cumsum(sizes + 2)
            keep = np.ones(len(grams), dtype=bool)
            keep[ends[:-1] - 1] = keep[ends[:-1] - 2] = False
            yield numbers, grams[keep], np.concatenate([[0], np.cumsum(sizes)])
            numbers, parts, size = [], [], 0


def learning_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = LEARN_DOCS) -> DataFrame:
    """(lang, text) of about ``per_language`` labelled documents of each language, chosen by a hash of the id.

    The share taken of a language follows from its count, so no language is gathered in one place to choose from it.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.abs(F.xxhash64(F.col(id_col)) % 1_000_000).alias("place"))
    rows = rows.filter("lang is not null and text is not null")
    shares = rows.groupBy("lang").agg((F.lit(1e6 * per_language) / F.count("*")).alias("share"))
    return rows.join(F.broadcast(shares), "lang").filter("place < share").select("lang", "text")


def learn(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and, for each, the log probabilities of the bins. ``rows`` has lang and text.

    One row per language comes to the driver: a model is small, whatever the corpus.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, group in batch.groupby("lang"):
                for _, grams, _ in _blocks(group["text"].tolist()):
                    sums[lang] = sums.get(lang, 0) + np.bincount(grams, minlength=BINS)
        for lang, sums_of in sums.items():
            yield pd.DataFrame({"lang": lang, "bin": np.flatnonzero(sums_of), "n": sums_of[sums_of > 0]})

    counts = rows.mapInPandas(count, "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    models = counts.groupBy("lang").agg(F.collect_list(F.struct("bin", "n")).alias("bins")).orderBy("lang").collect()
    table = np.full((len(models), BINS), _SMOOTHING)
    for k, row in enumerate(models):
        for b in row.bins:
            table[k, b["bin"]] += b["n"]
    return [r.lang for r in models], np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def _proportions(scores: np.ndarray, doc: np.ndarray, starts: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of each document's mixture of its ``allowed`` languages.

    ``scores`` has a row of log-likelihoods per chunk, ``doc`` the chunk's document and ``starts`` each document's first chunk.
    """
    scores = np.where(allowed[doc], scores, -np.inf)
    top = scores.max(axis=1, keepdims=True)
    likely = np.exp(scores - top)
    sizes = np.diff(np.append(starts, len(doc)))[:, None]
    shares = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        joint = likely * shares[doc]
        joint /= joint.sum(axis=1, keepdims=True)
        shares = np.add.reduceat(joint, starts, axis=0) / sizes
    whole = np.log((likely * shares[doc]).sum(axis=1)) + top[:, 0]
    return shares, np.add.reduceat(whole, starts)


def mixtures(texts: list[str], model: np.ndarray) -> np.ndarray:
    """Proportions of the model's languages in each text; 0 for languages outside the chosen set."""
    out = np.zeros((len(texts), len(model)))
    for numbers, grams, begins in _blocks(texts):
        sizes = np.diff(begins)
        chunks = -(-sizes // CHUNK)
        doc = np.repeat(np.arange(len(sizes)), chunks)
        firsts = np.concatenate([[0], np.cumsum(chunks)[:-1]])
        at = begins[doc] + (np.arange(len(doc)) - firsts[doc]) * CHUNK
        scores = np.stack([np.add.reduceat(m[grams], at, dtype=np.float64) for m in model], axis=1)
        shares, _ = _proportions(scores, doc, firsts, np.ones((len(sizes), len(model)), dtype=bool))
        order = np.argsort(-shares, axis=1, kind="stable")
        best = np.full(len(sizes), -np.inf)
        chosen = shares
        for k in range(1, len(model) + 1):
            allowed = np.zeros_like(shares, dtype=bool)
            np.put_along_axis(allowed, order[:, :k], True, axis=1)
            shares_k, fit = _proportions(scores, doc, firsts, allowed)
            # one proportion more for each language after the first; a chunk's grams overlap, so a draw counts threefold
            fit = fit - 3 * (k - 1) * np.log(chunks + 1)
            better = fit > best
            best = np.where(better, fit, best)
            chosen = np.where(better[:, None], shares_k, chosen)
        out[numbers] = chosen
    return out


def identify(docs: DataFrame, languages: list[str], model: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and lang_mix appended; columns of these names are replaced.

    ``lang_pred`` is the language with the largest proportion, ``score`` that proportion and ``lang_mix`` lists the chosen
    languages with their proportions. Null texts, texts without a letter and every text where no language was learned give
    ``und``, 0 and an empty list. Whole texts are read; rows stay in their partition.
    """
    given = [c for c in docs.columns if c not in ("lang_pred", "score", "lang_mix")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "lang_pred string, score double, lang_mix array<struct<lang:string,share:double>>"

    @F.pandas_udf(schema)
    def predict(texts: pd.Series) -> pd.DataFrame:
        asked = [i for i, t in enumerate(texts) if t is not None and languages and _LETTER.search(t)]
        rows = [("und", 0.0, [])] * len(texts)
        values = texts.tolist()
        shares = mixtures([values[i] for i in asked], shared.value) if asked else []
        for i, share in zip(asked, shares):
            k = int(share.argmax())
            mix = [{"lang": languages[j], "share": float(share[j])} for j in np.argsort(-share, kind="stable") if share[j] > 0]
            rows[i] = (languages[k], min(1.0, float(share[k])), mix)
        return pd.DataFrame(rows, columns=["lang_pred", "score", "lang_mix"])

    return docs.select(*given, predict(F.col(text_col)).alias("_found")).select(*given, "_found.*")
