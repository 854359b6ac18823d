"""Text to vectors: a pluggable encoder run over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Encoder = Callable[[list[str]], np.ndarray]

# Fixed values of the default encoder: trigram multipliers and modulus.
TRIGRAM_WEIGHTS = (7919, 104729, 1299709)
TRIGRAM_MODULUS = 1_000_003
DEFAULT_DIM = 64


def hashed_trigrams(dim: int = DEFAULT_DIM) -> Encoder:
    """Character-trigram counts hashed into *dim* buckets, unit length.

    Deterministic and offline; whole texts are read. Texts under three
    characters give the zero vector.
    """
    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), dtype=np.float64)
        for row, text in enumerate(texts):
            codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
            if len(codes) < 3:
                continue
            mixed = sum(w * codes[i:len(codes) - 2 + i] for i, w in enumerate(TRIGRAM_WEIGHTS))
            counts = np.bincount(mixed % TRIGRAM_MODULUS % dim, minlength=dim)
            out[row] = counts / max(np.linalg.norm(counts), 1e-12)
        return out
    return encode


_REGISTRY: dict[str, Callable[[], Encoder]] = {"trigrams": hashed_trigrams}


def register_encoder(name: str, factory: Callable[[], Encoder]) -> None:
    """Add an encoder; the factory runs once per task."""
    _REGISTRY[name] = factory


def encoder_names() -> list[str]:
    return sorted(_REGISTRY)


def embed(text: Column | str, encoder: str | Encoder = "trigrams") -> Column:
    """Vector column for a text column; null text gives null."""
    return embed_blend([(1.0, text)], encoder)


def embed_blend(parts: list[tuple[float, Column | str]], encoder: str | Encoder = "trigrams") -> Column:
    """Weighted sum of the vectors of several texts, encoded in one pass over the batch.

    A row is null when one of its texts is. Vectors of texts are of single precision, as they are stored; a sum of several
    is of double precision, or its scores would be good to five digits only.
    """
    if isinstance(encoder, str):
        if encoder not in _REGISTRY:
            raise ValueError(f"unknown encoder {encoder!r}; known: {encoder_names()}")
        factory = _REGISTRY[encoder]
    else:
        def factory(fn=encoder):
            return fn
    weights = [w for w, _ in parts]
    single = weights == [1.0]

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        encode = factory()  # once per task, so a model loads once
        for texts in batches:
            texts = texts if isinstance(texts, tuple) else (texts,)
            known = np.logical_and.reduce([t.notna().to_numpy() for t in texts])
            out = np.empty(len(known), dtype=object)
            if known.any():
                encoded = (np.asarray(encode(t[known].tolist())).astype(np.float32) for t in texts)
                vectors = next(encoded) if single else sum(w * v.astype(np.float64) for w, v in zip(weights, encoded))
                for at, vector in zip(np.flatnonzero(known), vectors):
                    out[at] = vector
            yield pd.Series(out)
    return F.pandas_udf(run, "array<float>" if single else "array<double>")(*[text for _, text in parts])


def embed_text(df: DataFrame, text: str = "label", encoder: str | Encoder = "trigrams",
               out: str = "embedding") -> DataFrame:
    """Add a vector column. Narrow: no shuffle, ids stay attached to their rows."""
    return df.withColumn(out, embed(text, encoder))
