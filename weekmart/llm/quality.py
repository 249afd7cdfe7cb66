"""Quality by nearest labelled neighbours in a latent semantic space.

A text's terms are its hashed words, the trigrams of its characters' classes and marks of repetition. Term weights are
logarithmic counts times the inverse document frequency over all documents. The leading singular vectors of a bounded
sample of labelled documents span the latent space; their vectors are broadcast, every document's cosine to each of
them is computed in blocks, and the nearest labels vote with weights by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekmart.llm.text import prepare, column_udf, pieces, runs, span_hashes, utf8

SAMPLE = 4096
WORD_TERMS, CLASSES, MARKS = 2048, 12, 4
TERMS = WORD_TERMS + CLASSES**3 + MARKS
FACTORS, OVERSAMPLE, ROUNDS = 32, 16, 3
NEIGHBOURS, SHARPNESS, PRIOR_WEIGHT = 15, 8.0, 0.05
SEED = 17


def _class_table() -> np.ndarray:
    """Class of each byte; bytes of characters beyond ASCII count as lower-case letters."""
    table = np.full(256, 11, np.uint8)
    for kind, signs in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".", ",", "!?", "\"'()[]{}", "|/\\<>", "#$%&*+-=@^_~`:;")):
        table[[ord(c) for c in signs]] = kind
    table[128:] = 0
    return table


CLASS = _class_table()


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Term counts of each text, one row a text."""
    count = len(offsets) - 1
    cells = []
    kind = CLASS[data].astype(np.int64)
    text_of = np.repeat(np.arange(count), np.diff(offsets))
    if len(data) > 2:
        whole = text_of[2:] == text_of[:-2]
        cells.append((text_of[2:] * TERMS + WORD_TERMS + (kind[:-2] * CLASSES + kind[1:-1]) * CLASSES + kind[2:])[whole])
    lower = np.where(kind == 1, data + 32, data)
    starts, ends = runs(kind < 3, offsets)
    hashes, owner = span_hashes(lower, starts, ends), text_of[starts]
    cells.append(owner * TERMS + (hashes >> np.uint64(53)).astype(np.int64))
    mark = owner * TERMS + WORD_TERMS + CLASSES**3
    for back in (1, 2):
        again = (hashes[back:] == hashes[:-back]) & (owner[back:] == owner[:-back])
        cells.append(mark[back:][again] + back - 1)
    starts, ends = runs(kind != 4, offsets)
    hashes, owner = span_hashes(data, starts, ends), text_of[starts]
    again = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    cells.append(owner[1:][again] * TERMS + WORD_TERMS + CLASSES**3 + 2)
    return np.bincount(np.concatenate(cells), minlength=count * TERMS).reshape(count, TERMS)


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many of all texts each term occurs, and the number of texts; tasks send one sum a term."""
    prepare(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(TERMS + 1, np.int64)
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            sums[TERMS] += len(offsets) - 1
            for a, b in pieces(offsets):
                sums[:TERMS] += (term_counts(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]) > 0).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS + 1)), pa.array(sums)], ["term", "n"])

    table = docs.select(docs[text]).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    frequencies = np.zeros(TERMS + 1, np.int64)
    frequencies[table["term"].to_numpy()] = table["n"].to_numpy()
    return frequencies[:TERMS], int(frequencies[TERMS])


class QualityModel(NamedTuple):
    """Term weights, the basis of the latent space, the labelled vectors in it and their labels."""

    weights: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def project(self, counts: np.ndarray) -> np.ndarray:
        """Unit latent vectors of term counts; a text without terms has the zero vector."""
        vectors = (np.log1p(counts).astype(np.float32) * self.weights) @ self.basis
        lengths = np.sqrt((vectors**2).sum(1, keepdims=True))
        return vectors / np.where(lengths > 0, lengths, 1)

    def vote(self, vectors: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest neighbours, weighted by similarity, with a little of the overall share."""
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        if not len(self.labels):
            return np.full(len(vectors), prior)
        similar = np.maximum(vectors @ self.vectors.T, 0)
        k = min(NEIGHBOURS, len(self.labels))
        near = np.argpartition(-similar, k - 1, axis=1)[:, :k]
        weight = np.take_along_axis(similar, near, 1).astype(float) ** SHARPNESS
        return ((weight * self.labels[near]).sum(1) + PRIOR_WEIGHT * prior) / (weight.sum(1) + PRIOR_WEIGHT)


def latent_basis(rows: np.ndarray, factors: int = FACTORS) -> np.ndarray:
    """Leading right singular vectors by randomised subspace iteration."""
    rng = np.random.default_rng(SEED)
    span = rng.standard_normal((rows.shape[1], factors + OVERSAMPLE)).astype(np.float32)
    for _ in range(ROUNDS):
        span = np.linalg.qr(rows.T @ (rows @ span))[0]
    _, _, turned = np.linalg.svd(rows @ span, full_matrices=False)
    return np.ascontiguousarray((span @ turned.T)[:, :factors])


def fit(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE,
) -> QualityModel:
    """Learn from at most ``sample`` labelled documents, chosen by a hash of their id; document frequencies cover all of ``docs``.

    Labels are 0 or 1; null labels, ids and texts are not used, repeated label rows count once, and of documents that repeat
    an id the smallest text. The labelled vectors are held in the order of their ids, so a model and its votes do not depend
    on how rows are dealt out. Without any labelled document the model scores 0.5.
    """
    frequencies, count = document_frequencies(docs, text)
    weights = np.log((1 + count) / (1 + frequencies)).astype(np.float32) + 1
    chosen = (
        labels.select(labels[id].alias("id"), labels[label].cast("double").alias("label")).where("id is not null and label in (0, 1)").distinct()
        .join(docs.select(docs[id].alias("id")).where("id is not null").distinct(), "id", "left_semi")
        .orderBy(F.xxhash64("id"), "id", "label").limit(sample))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for a, b in pieces(offsets):
                rows = np.minimum(term_counts(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]), 65535).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r.tobytes() for r in rows], pa.binary()), batch.column(1)[a:b], batch.column(2)[a:b]], ["counts", "label", "id"])

    texts = docs.select(docs[id].alias("id"), docs[text].alias("text")).where("text is not null").join(chosen, "id")
    one = texts.groupBy("id", "label").agg(F.min("text").alias("text"))  # as many rows as chosen at most
    kind = one.schema["id"].dataType.simpleString()
    table = one.select("text", "label", "id").mapInArrow(counted, f"counts binary, label double, id {kind}").orderBy("id", "label").toArrow()
    rows = np.frombuffer(b"".join(table["counts"].to_pylist()), np.uint16).reshape(-1, TERMS)
    rows = np.log1p(rows.astype(np.float32)) * weights
    rows /= np.maximum(np.sqrt((rows**2).sum(1, keepdims=True)), 1e-9)
    basis = latent_basis(rows) if len(rows) else np.zeros((TERMS, 1), np.float32)
    vectors = rows @ basis
    vectors /= np.maximum(np.sqrt((vectors**2).sum(1, keepdims=True)), 1e-9)
    return QualityModel(weights, basis, vectors, table["label"].to_numpy())


def score(docs: DataFrame, model: QualityModel, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 of the whole text, higher where label 1 is likelier.

    Null and empty texts have no neighbours and get the overall share of label 1. Repeated rows get equal scores; a
    column of that name is replaced.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def opened():
        model = shared.value

        def apply(column: pa.Array) -> pa.Array:
            data, offsets = utf8(column)
            scores = [np.zeros(0)]
            for a, b in pieces(offsets):
                for c in range(a, b, 256):
                    d = min(b, c + 256)
                    scores.append(model.vote(model.project(term_counts(data[offsets[c]: offsets[d]], offsets[c: d + 1] - offsets[c]))))
            return pa.array(np.clip(np.concatenate(scores), 0, 1))
        return apply

    return docs.withColumn(name, column_udf("double", opened)(docs[text]))
