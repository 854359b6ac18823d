"""Language identification with hyperdimensional profiles of letter n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batch, held_out, kept_in_worker, map_batches

DIM = 1024
GRAM = 3
SEED = 20_011
#: Texts bundled at once, n-grams multiplied at once, and n-gram vectors a worker keeps.
TEXTS, BLOCK, KEPT_GRAMS = 128, 4096, 60_000
SPACE = 32


class Profiles:
    """Random letter vectors, bound into n-gram vectors, bundled into profiles of texts.

    A letter's vector of +1 and -1 is drawn from its code point; its place in the n-gram rotates it; binding
    multiplies. Everything but letters is a gap, which is a letter of its own.
    """

    def __init__(self):
        self.is_letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
        self.letters: dict[int, np.ndarray] = {}
        self.place: dict[int, int] = {}
        self.vectors = np.zeros((1024, DIM), dtype=np.int8)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            self.letters[code] = np.random.default_rng([SEED, code]).integers(0, 2, DIM, dtype=np.int8) * 2 - 1
        return self.letters[code]

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """The vectors of n-gram keys."""
        if len(self.place) + len(keys) > KEPT_GRAMS:
            self.place.clear()
        for key in keys.tolist():
            if key not in self.place:
                at = self.place[key] = len(self.place)
                if at >= len(self.vectors):
                    self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
                bound = np.ones(DIM, dtype=np.int8)
                for i in range(GRAM):
                    bound = bound * np.roll(self.letter(key >> 21 * (GRAM - 1 - i) & 0x1FFFFF), GRAM - 1 - i)
                self.vectors[at] = bound
        return self.vectors[np.fromiter(map(self.place.__getitem__, keys.tolist()), dtype=np.int64, count=len(keys))]

    def grams(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """(keys, counts) of a text's n-grams; None without a letter."""
        codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        letter = self.is_letter[codes]
        if not letter.any():
            return None
        codes = np.where(letter, codes, SPACE)
        codes = np.concatenate([[SPACE], codes, [SPACE]])
        gap = codes == SPACE
        codes = codes[~gap | np.concatenate([[True], ~gap[:-1]])]  # one gap for each run
        key = np.zeros(len(codes) - GRAM + 1, dtype=np.int64)
        for i in range(GRAM):
            key = key << 21 | codes[i:len(codes) - GRAM + 1 + i]
        return np.unique(key, return_counts=True)

    def bundles(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(profiles, which texts have a letter): the weighted sum of the n-gram vectors of each text."""
        found = [self.grams(t) for t in texts]
        has = np.array([f is not None for f in found])
        out = np.zeros((len(texts), DIM), dtype=np.float32)
        lists = [(i, f) for i, f in enumerate(found) if f is not None]
        if lists:
            keys, column = np.unique(np.concatenate([f[0] for _, f in lists]), return_inverse=True)
            row = np.repeat([i for i, _ in lists], [len(f[0]) for _, f in lists])
            times = np.concatenate([f[1] for _, f in lists]).astype(np.float32)
            for low in range(0, len(keys), BLOCK):
                part = keys[low:low + BLOCK]
                inside = (column >= low) & (column < low + len(part))
                weights = np.zeros((len(texts), len(part)), dtype=np.float32)
                weights[row[inside], column[inside] - low] = times[inside]
                out += weights @ self.rows(part).astype(np.float32)
        return out, has


def prototypes(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, their unit vectors) from docs (text, lang): the bundle of all n-grams of a language.

    Each task adds its texts up by language, so what is shuffled and brought to the driver has DIM numbers for
    each language.
    """
    def work(batches: Iterator[Batch]) -> Iterator[Batch]:
        profiles = kept_in_worker("profiles", Profiles)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for low in range(0, len(batch["text"]), TEXTS):
                vectors, _ = profiles.bundles(batch["text"][low:low + TEXTS])
                langs = np.array(batch["lang"][low:low + TEXTS])
                for lang in np.unique(langs).tolist():
                    sums[lang] = sums.get(lang, 0.0) + vectors[langs == lang].sum(axis=0, dtype=np.float64)
        for lang, total in sums.items():
            yield {"lang": [lang] * DIM, "dim": list(range(DIM)), "value": total.tolist()}

    rows = (map_batches(docs.filter("lang IS NOT NULL").select("text", "lang"), work, "lang string, dim int, value double")
            .groupBy("lang", "dim").agg(F.sum("value").alias("value"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("dim", "value"))).alias("v"))
            .orderBy("lang").collect())
    matrix = np.array([[e["value"] for e in r["v"]] for r in rows], dtype=np.float64).reshape(-1, DIM)
    return [r["lang"] for r in rows], matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)


def languages(docs: DataFrame, learn: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              lang_col: str = "lang") -> DataFrame:
    """(doc_id, lang_pred, score): the language whose prototype has the largest cosine, and that cosine.

    Ties go to the first language by name. Null texts and texts without a letter, or no learned language at all,
    give 'und' and 0; a negative cosine gives 0. Repeated rows give repeated results; other columns are ignored.
    """
    names, matrix = prototypes(learn.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")))
    model = docs.sparkSession.sparkContext.broadcast(matrix.T.astype(np.float32))

    def work(batches: Iterator[Batch]) -> Iterator[Batch]:
        profiles = kept_in_worker("profiles", Profiles)
        for batch in batches:
            out: Batch = {"doc_id": batch["doc_id"], "lang_pred": [], "score": []}
            for low in range(0, len(batch["text"]), TEXTS):
                vectors, has = profiles.bundles(batch["text"][low:low + TEXTS])
                cosine = vectors @ model.value / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
                for row, known in zip(cosine, has.tolist()):
                    best = int(row.argmax()) if known and names else -1
                    out["lang_pred"].append(names[best] if best >= 0 else "und")
                    out["score"].append(float(min(max(row[best], 0.0), 1.0)) if best >= 0 else 0.0)
            yield out

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), work,
                       "doc_id long, lang_pred string, score double")


def language_of_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          lang_col: str = "lang") -> DataFrame:
    """languages() learned from the documents that are not held out (1 of 4), with *held_out*."""
    return (languages(docs, docs.filter(~held_out(F.col(id_col), 4, 2)), id_col, text_col, lang_col)
            .withColumn("held_out", held_out(F.col("doc_id"), 4, 2)))
