"""Language identification by interpolated Kneser-Ney character models.

Texts are lower-cased and cut into words of letters. Each letter of a word, and the word's end, is predicted from the
ORDER - 1 symbols before it (the word's start is a symbol of its own). Four 16-bit symbols make one 64-bit key, so a
model is a set of sorted arrays of packed n-grams. The language with the lowest cross-entropy a symbol is chosen; a text
whose cross-entropy exceeds what nearly all texts of that language set aside for it have is flagged as rejected.

No n-gram is left out. All n-grams and contexts that the probability of a symbol is made of, single symbols aside, hold
the symbol before it. So the models are cut into blocks by that symbol, of about BLOCK_GRAMS n-grams each; more text
gives more blocks, each broadcast by itself. A text is cut and hashed once and meets all blocks in one pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekmart.llm.text import prepare, distinct_spans, distinct_values, pieces, spread, utf8
from weekmart.session import staged

ORDER = 4
START, END = 1, 2
SYMBOLS = 1 << 16
BLOCK_GRAMS = 1_000_000
REJECT_SHARE = 0.995
EVIDENCE = 50
UNDETERMINED = "und"
PREDICTION = "struct<lang: string, entropy: double, score: double, symbols: bigint>"
_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Which code points are letters; built once a process."""
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _letters[0]


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts in lower case, starts and ends of their words, and the text of each word."""
    texts = [data[a:b].tobytes().decode().lower() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    points = np.frombuffer("\n".join(texts).encode("utf-32-le"), np.uint32)
    inside = letter_table()[points]
    ends = np.cumsum([len(t) + 1 for t in texts])
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, stops = edge[::2], edge[1::2]
    symbols = np.where(points < 0xE000, points, 0xE000 + points % 0x1FFF).astype(np.uint64)
    return symbols, starts, stops, np.searchsorted(ends, starts, "right")


def word_grams(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed ORDER-grams of each word, one word after another, and where each word's begin."""
    sizes = ends - starts + 1
    bounds = np.cumsum(sizes + ORDER - 1) - (sizes + ORDER - 1)
    padded = np.full(int((sizes + ORDER - 1).sum()), START, np.uint64)
    inner = spread(bounds + ORDER - 1, sizes - 1)
    padded[inner] = symbols[spread(starts, sizes - 1)]
    padded[bounds + sizes + ORDER - 2] = END
    at = spread(bounds + ORDER - 1, sizes)
    keys = padded[at]
    for back in range(1, ORDER):
        keys = keys | (padded[at - back] << np.uint64(16 * back))
    return keys, np.cumsum(sizes) - sizes


class Table(NamedTuple):
    """One order of one language: sorted n-grams with discounted shares, sorted contexts with their interpolation weights."""

    grams: np.ndarray
    shares: np.ndarray
    contexts: np.ndarray
    weights: np.ndarray


class LanguageModel(NamedTuple):
    """Tables from order 1 to ORDER, and the probability of a symbol that was never seen."""

    tables: list[Table]
    unseen: float


class Block(NamedTuple):
    """The part of all models that serves symbols after one of ``low`` to ``high`` - 1."""

    low: int
    high: int
    models: dict[str, LanguageModel]


def order_table(part: pa.Table) -> Table:
    """The sorted arrays of one order from rows (gram, share, weight), in which all n-grams of a context carry its weight."""
    grams = part["gram"].to_numpy().view(np.uint64)
    order = np.argsort(grams)
    grams = grams[order]
    contexts, first = np.unique(grams >> np.uint64(16), return_index=True)
    return Table(grams, part["share"].to_numpy()[order], contexts, part["weight"].to_numpy()[order][first])


def log_probabilities(model: LanguageModel, keys: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each key's last symbol after the ones before it."""
    value = np.full(len(keys), model.unseen)
    for size, table in enumerate(model.tables, 1):
        if not len(table.grams):
            continue
        part = keys & np.uint64((1 << (16 * size)) - 1) if size < 4 else keys
        at = np.minimum(np.searchsorted(table.grams, part), len(table.grams) - 1)
        share = np.where(table.grams[at] == part, table.shares[at], 0.0)
        context = part >> np.uint64(16)
        at = np.minimum(np.searchsorted(table.contexts, context), len(table.contexts) - 1)
        known = table.contexts[at] == context
        value = np.where(known, share + table.weights[at] * value, value)
    return np.log(value)


def gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, gram, n): the ORDER-grams of every text of (text, lang), counted in tasks first, then over all."""
    prepare(rows.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def summed(lang: str) -> tuple[np.ndarray, np.ndarray]:
            keys, counts = (np.concatenate(x) for x in zip(*held[lang]))
            first, inverse = distinct_values(keys)
            return keys[first], np.bincount(inverse, counts, len(first)).astype(np.int64)

        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            data, offsets = utf8(batch.column(0))
            for a, b in pieces(offsets):
                symbols, starts, ends, text_of = words_of(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                for lang in set(langs[a:b]):
                    of = np.flatnonzero(langs[a:b][text_of] == lang)
                    if not len(of):
                        continue
                    first, inverse = distinct_spans(symbols, starts[of], ends[of])
                    keys, begins = word_grams(symbols, starts[of][first], ends[of][first])
                    times = np.repeat(np.bincount(inverse, minlength=len(first)), np.diff(np.append(begins, len(keys))))
                    first, inverse = distinct_values(keys)
                    held.setdefault(lang, []).append((keys[first], np.bincount(inverse, times, len(first)).astype(np.int64)))
                    if len(held[lang]) >= 16:
                        held[lang] = [summed(lang)]
        for lang in held:
            keys, counts = summed(lang)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(counts)], ["lang", "gram", "n"])

    return rows.select("text", "lang").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def interpolated(counts: DataFrame) -> DataFrame:
    """(lang, gram, n) of one order with ``share``, the discounted count's share of its context, and the context's ``weight``.

    The discount of a language follows from its n-grams counted once and twice. A context has at most SYMBOLS n-grams.
    """
    once, twice = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
    kept_back = F.when((once > 0) & (twice > 0), once / (once + 2 * twice)).otherwise(0.5)
    context = Window.partitionBy("lang", F.shiftrightunsigned("gram", 16))
    total, kinds = F.sum("n").over(context), F.count("*").over(context)
    discounts = counts.groupBy("lang").agg(kept_back.alias("less"))  # one row a language, of which the driver holds the letters
    return counts.join(F.broadcast(discounts), "lang").select(
        "lang", "gram", "n", (F.greatest(F.col("n") - F.col("less"), F.lit(0.0)) / total).alias("share"),
        (F.least("less", F.lit(1.0)) * kinds / total).alias("weight"))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", block_grams: int = BLOCK_GRAMS) -> Iterator[Block]:
    """The models of all languages of ``docs`` in blocks; rows with a null text or language are not used, other columns not read.

    Counts, shares and weights cover all rows and all n-grams and are computed as grouped tables. A block holds the n-grams of
    neighbouring symbols, as many as ``block_grams`` allow (one symbol at least); the driver sorts one block at a time into
    arrays to broadcast, beside at most SYMBOLS single symbols a language. No rows, or none with a letter, give one block
    without languages. Code points from U+E000 on are folded onto 8,191 symbols.
    """
    rows = docs.select(docs[text].alias("text"), docs[lang].alias("lang")).where("text is not null and lang is not null")
    before = F.shiftrightunsigned("gram", 16).bitwiseAND(F.lit(SYMBOLS - 1))
    counts, orders = staged(gram_counts(rows), "grams"), []
    for size in range(ORDER, 0, -1):
        if orders:
            ending = F.col("gram").bitwiseAND(F.lit((1 << (16 * size)) - 1))
            counts = staged(counts.select("lang", ending.alias("gram")).groupBy("lang", "gram").agg(F.count("*").alias("n")), "grams")
        orders.append(staged(interpolated(counts).withColumn("before", before), "shares"))

    def tables(order: DataFrame) -> dict[str, Table]:
        found = order.select("lang", "gram", "share", "weight").toArrow()
        return {name: order_table(found.filter(pc.equal(found["lang"], name))) for name in pc.unique(found["lang"]).to_pylist()}

    letters = tables(orders.pop())
    low, held, bounds = 0, 0, []
    for r in orders[0].groupBy("before").count().orderBy("before").collect():  # one for each symbol
        if held and held + r["count"] > block_grams:
            bounds.append((low, r["before"]))
            low, held = r["before"], 0
        held += r["count"]
    empty = Table(*(np.zeros(0, kind) for kind in (np.uint64, float, np.uint64, float)))
    for low, high in [*bounds, (low, SYMBOLS)]:
        parts = [tables(order.where(F.col("before").between(low, high - 1))) for order in reversed(orders)]
        yield Block(low, high, {
            name: LanguageModel([single, *(part.get(name, empty) for part in parts)], 1.0 / (len(single.grams) + 1))
            for name, single in letters.items()})


def _scan_udf(shared: Sequence[Broadcast]):
    """Cuts and hashes a text once, adds up the logarithms that its n-grams have in each block, and predicts."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        blocks = [block.value for block in shared]
        names = sorted(blocks[0].models) if blocks else []
        for column in batches:
            data, offsets = utf8(column)
            sums, symbols = np.zeros((len(column), len(names))), np.zeros(len(column), np.int64)
            for a, b in pieces(offsets):
                points, starts, ends, text_of = words_of(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                if not len(starts):
                    continue
                first, inverse = distinct_spans(points, starts, ends)
                keys, begins = word_grams(points, starts[first], ends[first])
                unique, places = distinct_values(keys)
                lengths = np.diff(np.append(begins, len(keys)))
                symbols[a:b] = np.bincount(text_of, lengths[inverse], b - a).astype(np.int64)
                unique = keys[unique]
                before = (unique >> np.uint64(16)) & np.uint64(SYMBOLS - 1)
                logs = np.zeros((len(names), len(unique)))
                for low, high, models in blocks:
                    own = np.flatnonzero((before >= low) & (before < high))
                    for m, name in enumerate(names if len(own) else []):
                        logs[m, own] = log_probabilities(models[name], unique[own])
                for m in range(len(names)):
                    word = np.add.reduceat(logs[m][places], begins)
                    sums[a:b, m] = np.bincount(text_of, word[inverse], b - a)
            yield predictions(names, sums, symbols)

    return F.arrow_udf(run, PREDICTION).asNondeterministic()


def predictions(names: list[str], sums: np.ndarray, symbols: np.ndarray) -> pa.StructArray:
    """The best language of each text by cross-entropy, and its share of the likelihood that EVIDENCE symbols would give."""
    entropy = -sums / np.maximum(symbols, 1)[:, None]
    told = (symbols > 0) & (len(names) > 0)
    best = entropy.argmin(1) if names else np.zeros(len(symbols), np.int64)
    lowest = entropy[np.arange(len(symbols)), best] if names else np.zeros(len(symbols))
    odds = np.exp(-(entropy - lowest[:, None]) * np.minimum(symbols, EVIDENCE)[:, None])
    score = np.where(told, 1 / np.maximum(odds.sum(1), 1), 0.0)
    lang = [names[k] if t else UNDETERMINED for k, t in zip(best.tolist(), told.tolist())]
    return pa.StructArray.from_arrays(
        [pa.array(lang, pa.string()), pa.array(lowest, mask=~told), pa.array(score), pa.array(symbols)], ["lang", "entropy", "score", "symbols"])


def identify(docs: DataFrame, blocks: Iterable[Block], text: str = "text", name: str = "prediction") -> DataFrame:
    """``docs`` with a struct: lang, entropy (nats a symbol), score (0 to 1) and symbols counted.

    A null text, one without a letter, or models without a language give ``und``, score 0 and a null entropy. Ties go to
    the language first in order. Repeated rows get equal results; a column of that name is replaced.
    """
    prepare(docs.sparkSession)
    shared = [docs.sparkSession.sparkContext.broadcast(block) for block in blocks]
    return docs.withColumn(name, _scan_udf(shared)(docs[text]))


def rejection_limits(predicted: DataFrame, share: float = REJECT_SHARE) -> DataFrame:
    """(lang, limit): the entropy that ``share`` of a language's texts, rightly told, stay within.

    ``predicted`` has one row a text that the models have not learned from: lang (the true one) and prediction. All rows
    count. A language with too few such texts for one to lie beyond that share has no limit, and nothing is rejected.
    """
    right = predicted.where(F.col("prediction.lang") == F.col("lang")).groupBy("lang").agg(
        F.percentile_approx("prediction.entropy", share, 10_000).alias("limit"), F.count("*").alias("texts"))
    return right.where(F.col("texts") * (1 - share) >= 1).drop("texts")
