"""Language identification by string kernels.

The kernel of two texts is the number of byte n-grams (n = 2, 3, 4, blended) present in both, by
hash, divided by the geometric mean of what each has. Landmark texts span a Nyström feature space,
in which one ridge regression a language (one versus the rest) is fitted. Scoring a batch is two
matrix products: presence by landmarks, and kernel values by weights. The fit uses at most
``PER_LANGUAGE`` labelled rows of each language, chosen by hash; prediction reads whole texts.

Defined results: a null text, or one without a letter, gets ``und`` and score 0; without any
labelled row every text does; null labels are not learned from, nor rows with a null id; repeated
rows count once in the fit and are each predicted; ties go to the first language in code point
order; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabflow.llm.common import lean

UNKNOWN = "und"
ORDERS = (2, 3, 4)
#: Hashed n-grams.
FEATURE_BITS = 15
#: Labelled rows that are learned from, of each language at most.
PER_LANGUAGE = 400
#: Landmarks of each language at most.
LANDMARKS = 40
RIDGE = 1e-3
_BATCH = 64
_PART = 1 << 20
_ODD = np.uint32(0x9E3779B1)
_LETTER = regex.compile(r"\p{L}")


def present(raw: bytes, out: np.ndarray) -> None:
    """Mark in ``out`` the n-grams that a text holds (long texts by overlapping parts)."""
    b = np.frombuffer(raw.lower(), np.uint8)
    for lo in range(0, max(len(b) - 1, 0), _PART):
        part = b[lo:lo + _PART + max(ORDERS) - 1].astype(np.uint32)
        code = part
        for n in range(2, max(ORDERS) + 1):
            if len(part) < n:
                break
            code = code[:-1] << np.uint32(8) | part[n - 1:]
            if n in ORDERS:
                out[((code ^ np.uint32(n * 0x01000193)) * _ODD) >> np.uint32(32 - FEATURE_BITS)] = 1


def has_letter(text: str | None) -> bool:
    return text is not None and _LETTER.search(text) is not None


def with_letter(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a letter; no model is needed for this."""
    at = docs.columns.index(text_col)

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            yield block.filter(pa.array([has_letter(t.as_py()) for t in block.column(at)], pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is left out of the fit."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


class Model:
    """Nyström features of landmarks and one-versus-rest ridge weights."""

    def __init__(self, x: np.ndarray, labels: list[str]):
        """``x``: presence of each n-gram in the labelled texts (one or eight to a byte), in the order of
        the sample. The driver unpacks a few texts at a time: all of them at once, and as the floats
        of a product, would be hundreds of MB."""
        packed = x if x.shape[1] < 1 << FEATURE_BITS else np.packbits(x, axis=1)
        self.languages = sorted(set(labels))
        y = np.array([self.languages.index(v) for v in labels])
        marks = np.concatenate([np.flatnonzero(y == c)[:LANDMARKS] for c in range(len(self.languages))])
        # other n-grams are in no landmark
        self.columns = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(packed[marks], axis=0)))
        self.landmarks = np.empty((len(self.columns), len(marks)), np.float32)
        for i, mark in enumerate(marks):
            x = np.unpackbits(packed[mark])
            self.landmarks[:, i] = x[self.columns] / np.sqrt(x.sum(dtype=np.float64))
        k = np.concatenate([self.kernel(np.unpackbits(packed[lo:lo + _BATCH], axis=1)) for lo in range(0, len(packed), _BATCH)])
        values, vectors = np.linalg.eigh((k[marks] + k[marks].T) / 2)
        kept = values > 1e-6 * values[-1]
        root = vectors[:, kept] / np.sqrt(values[kept])
        phi = np.c_[k @ root, np.ones(len(k))]
        target = np.where(y[:, None] == np.arange(len(self.languages)), 1.0, -1.0)
        weights = np.linalg.solve(phi.T @ phi + RIDGE * len(phi) * np.eye(phi.shape[1]), phi.T @ target)
        self.weights, self.bias = (root @ weights[:-1]), weights[-1]

    def kernel(self, x: np.ndarray) -> np.ndarray:
        """Normalised kernel values of texts (rows of presence) with the landmarks."""
        size = np.maximum(x.sum(1, dtype=np.float64), 1)
        return (x[:, self.columns].astype(np.float32) @ self.landmarks).astype(np.float64) / np.sqrt(size)[:, None]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """(language, score from 0 to 1: half of the winner's margin plus one, clipped)."""
        margins = self.kernel(x) @ self.weights + self.bias
        best = margins.argmax(1)
        return [self.languages[i] for i in best], np.clip((margins[np.arange(len(best)), best] + 1) / 2, 0, 1)


def fit(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Model | None:
    """Fit on the rows where ``train`` holds. Rows are chosen by ids, labels and hashes; only the
    n-gram sets of the chosen (at most ``PER_LANGUAGE`` a language, each of bounded size) reach the
    driver. A limit by rank keeps that many a task before the shuffle, so no language is hot."""
    rows = (docs.filter(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
            .select(F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).cast("string").alias("_text"),
                    F.xxhash64(F.col(id_col), F.col(text_col)).alias("_h")).filter(F.col("_text").rlike(r"\p{L}")))
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy("_h"))
    chosen = (rows.select("_lang", "_h").withColumn("_r", rank).filter(F.col("_r") <= PER_LANGUAGE)
              .select("_lang", "_h").distinct())

    def grams(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            found = []
            for text in block.column(2):
                x = np.zeros(1 << FEATURE_BITS, np.uint8)
                present(text.as_py().encode(), x)
                found.append(np.packbits(x).tobytes())
            yield pa.RecordBatch.from_arrays([block.column(0), block.column(1), pa.array(found, pa.binary())],
                                             names=["_lang", "_h", "_x"])

    # at most PER_LANGUAGE rows of 16 bytes a language, so they can be sent to every task
    sample = (rows.join(F.broadcast(chosen), ["_lang", "_h"], "left_semi").select("_lang", "_h", "_text")
              .mapInArrow(lean(grams), "_lang string, _h bigint, _x binary").collect())
    found = sorted({(r["_lang"], r["_h"]): bytes(r["_x"]) for r in sample}.items())
    if not found:
        return None
    return Model(np.stack([np.frombuffer(v, np.uint8) for _, v in found]), [k[0] for k, _ in found])


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (clashing columns are replaced), without the text
    unless ``keep_text``. Every task scores its own rows in small batches; nothing is shuffled."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("lang_pred", "score")])
    at = docs.columns.index(text_col)
    kept = [i for i, c in enumerate(docs.columns) if keep_text or i != at]
    names = [docs.columns[i] for i in kept]
    schema = StructType([docs.schema[i] for i in kept]).add("lang_pred", "string").add("score", "double")

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = np.zeros((_BATCH, 1 << FEATURE_BITS), np.uint8)
        for block in blocks:
            langs: list = []
            scores: list = []
            for lo in range(0, block.num_rows, _BATCH):
                texts = block.column(at).slice(lo, _BATCH).to_pylist()
                known = [has_letter(t) for t in texts]
                x[:len(texts)] = 0
                for i, text in enumerate(texts):
                    if known[i]:
                        present(text.encode(), x[i])
                got, sure = model.predict(x[:len(texts)]) if model else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
                langs += [g if k else UNKNOWN for g, k in zip(got, known, strict=True)]
                scores += [s if k else 0.0 for s, k in zip(sure.tolist(), known, strict=True)]
            yield pa.RecordBatch.from_arrays([*(block.column(i) for i in kept), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*names, "lang_pred", "score"])

    return docs.mapInArrow(lean(run), schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score): fitted on the rows that are not held out."""
    model = fit(docs, ~held_out(id_col), id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("_text"))
    return predict(rows, model, "_text", keep_text=False)
