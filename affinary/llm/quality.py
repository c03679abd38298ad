"""Quality of documents by a factorisation machine.

A document's features are three fields: its words (lower-cased, hashed into ``WORD_SLOTS`` places, weighted
by 1 + log of their count and scaled to length one), statistics of its structure (shares of kinds of characters,
words and lines, each as one of a few bins) and numeric metadata columns (bins of their logarithm, one
more for a null).  The score is the logistic function of

    b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

whose pairwise part is half of sum_f (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2, so that a document costs as
much as it has features.  Whole texts are read, in pieces cut at white space.

The machine is trained in numpy on at most ``training_rows`` labelled documents, drawn by a hash from all that may
be learned from; that bound is independent of the corpus.  Language, source, id and labels are never inputs.

Null and empty texts are scored from their empty structure; repeated rows are scored alike; several labels of one
id count as their mean; null labels, labels without document and null ids are not learned from; with nothing to
learn from every score is 0.5; an empty table gives no rows.  Columns named like the results are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinary.llm.slices import small_batches

WORD_SLOTS = 4096
BINS = 16
_PIECE = 1 << 20  # characters split at a time

STATISTICS = (
    "length", "words", "word length", "upper", "digits", "high bytes", "stops", "marks", "symbols", "bars",
    "symbol ends", "shouted words", "letterless words", "long words", "distinct words", "commonest word",
    "line length", "repeated lines", "pairs of equal words", "distinct bytes",
)
_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": b"0123456789",
    "stops": b".,;:'\"()-",
    "marks": b"!?",
    "symbols": b"#$%&*+/<=>@[\\]^_`{}~",
    "bars": b"|",
}
_SYMBOL_ENDS = frozenset("!#$%&*+/<=>@\\^_`|~")


def _pieces(text: str) -> Iterator[str]:
    """The text in parts that end behind white space, so that no word is cut."""
    begin = 0
    while begin < len(text):
        end = begin + _PIECE
        while end < len(text) and not text[end - 1].isspace():
            end += 1
        yield text[begin:end]
        begin = end


def _bin(value: float) -> int:
    """Bins of a share or ratio: 0 for nothing, then half powers of two from 1/128 up."""
    if value <= 0:
        return 0
    return int(min(BINS - 1, max(1.0, np.floor(2 * np.log2(value * 128)) + 1)))


def _log_bin(value: float) -> int:
    return int(min(BINS - 1, np.floor(np.log2(1 + max(0.0, value)) * 0.75)))


def text_features(text: str | None) -> tuple[Counter, dict[str, int]]:
    """Counts of the lower-cased words, and the bin of every statistic."""
    counts: Counter = Counter()
    lines: Counter = Counter()
    octets = np.zeros(256, dtype=np.int64)
    ends = shouted = letterless = long = equal = 0
    last, open_line = None, ""
    for piece in _pieces(text or ""):
        octets += np.bincount(np.frombuffer(piece.encode("utf-8", "replace"), dtype=np.uint8), minlength=256)
        found = piece.split()
        own = Counter(found)
        for word, n in own.items():
            ends += n * (word[-1] in _SYMBOL_ENDS)
            shouted += n * (len(word) > 1 and word.isupper())
            letterless += n * (word.upper() == word.lower())
            long += n * (len(word) > 24)
            counts[word.lower()] += n
        if found:
            equal += (last == found[0]) + sum(map(str.__eq__, found, found[1:]))
            last = found[-1]
        parts = (open_line + piece).split("\n")
        open_line = parts.pop()
        lines.update(crc32(part.encode("utf-8", "replace")) for part in parts if part)
    if open_line:
        lines[crc32(open_line.encode("utf-8", "replace"))] += 1
    total, words, n_lines = max(1, int(octets.sum())), max(1, counts.total()), max(1, lines.total())
    bins = {name: _bin(octets[list(kind)].sum() / total) for name, kind in _KINDS.items()}
    bins |= {
        "length": _log_bin(octets.sum()),
        "words": _log_bin(counts.total()),
        "word length": _log_bin(total / words * 8),
        "high bytes": _bin(octets[128:].sum() / total),
        "symbol ends": _bin(ends / words),
        "shouted words": _bin(shouted / words),
        "letterless words": _bin(letterless / words),
        "long words": _bin(long / words),
        "distinct words": _bin(len(counts) / words),
        "commonest word": _bin(max(counts.values(), default=0) / words),
        "line length": _log_bin(total / n_lines),
        "repeated lines": _bin((lines.total() - len(lines)) / n_lines),
        "pairs of equal words": _bin(equal / words),
        "distinct bytes": _log_bin(np.count_nonzero(octets)),
    }
    return counts, bins


def places_and_values(text: str | None, metadata: Iterable[float | None] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Ascending places of a document's features, and their values."""
    counts, bins = text_features(text)
    weights = np.zeros(WORD_SLOTS)
    for word, n in counts.items():
        weights[crc32(word.encode("utf-8", "replace")) % WORD_SLOTS] += n
    used = np.flatnonzero(weights)
    values = 1 + np.log(weights[used])
    values /= max(1e-9, np.sqrt((values**2).sum()))
    offset = WORD_SLOTS
    places = [offset + BINS * number + bins[name] for number, name in enumerate(STATISTICS)]
    offset += BINS * len(STATISTICS)
    for number, value in enumerate(metadata):
        known = value is not None and np.isfinite(value)
        places.append(offset + (BINS + 1) * number + (_log_bin(float(value)) if known else BINS))
    share = 1 / np.sqrt(len(places))
    return (
        np.concatenate([used, np.array(places, dtype=np.int64)]).astype(np.int32),
        np.concatenate([values, np.full(len(places), share)]).astype(np.float32),
    )


def feature_count(metadata: int) -> int:
    return WORD_SLOTS + BINS * len(STATISTICS) + (BINS + 1) * metadata


@dataclass(frozen=True)
class Machine:
    bias: float
    weights: np.ndarray  # (features,)
    factors: np.ndarray  # (features, rank)


def raw_scores(machine: Machine, places: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Scores before the logistic function; ``starts`` says where each document's features begin (none is empty)."""
    x = values.astype(np.float64)
    linear = np.add.reduceat(machine.weights[places] * x, starts)
    parts = machine.factors[places] * x[:, None]
    sums = np.add.reduceat(parts, starts, axis=0)
    squares = np.add.reduceat(parts * parts, starts, axis=0)
    return machine.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1)


def _logistic(raw: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(raw, -500, 500)))


def loss_and_gradients(machine: Machine, rows: np.ndarray, answers: np.ndarray, decay: float) -> tuple[float, Machine]:
    """Mean log loss plus half ``decay`` times the squared parameters, and its gradients, for dense rows."""
    sums = rows @ machine.factors
    squared = rows * rows
    raw = machine.bias + rows @ machine.weights + 0.5 * (sums * sums - squared @ (machine.factors**2)).sum(axis=1)
    given = _logistic(raw)
    loss = float(np.mean(np.logaddexp(0, raw) - answers * raw))
    loss += 0.5 * decay * float((machine.weights**2).sum() + (machine.factors**2).sum())
    error = (given - answers) / len(rows)
    factors = rows.T @ (error[:, None] * sums) - machine.factors * (squared.T @ error)[:, None]
    return loss, Machine(float(error.sum()), rows.T @ error + decay * machine.weights, factors + decay * machine.factors)


def train(
    rows: np.ndarray, answers: np.ndarray, rank: int = 8, epochs: int = 30, batch: int = 256, rate: float = 0.05, decay: float = 2e-5, seed: int = 13
) -> Machine:
    """Parameters fitted to dense feature rows by Adam."""
    random = np.random.default_rng(seed)
    features = rows.shape[1]
    share = np.clip(answers.mean(), 0.01, 0.99)
    values = [np.array(np.log(share / (1 - share))), np.zeros(features), random.normal(0, 0.05, (features, rank))]
    means, spreads = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    per_epoch = -(-len(rows) // batch)
    total, step = max(epochs * per_epoch, 60), 0
    while step < total:
        order = random.permutation(len(rows))
        for begin in range(0, len(rows), batch):
            picked = order[begin : begin + batch]
            _, found = loss_and_gradients(Machine(float(values[0]), values[1], values[2]), rows[picked], answers[picked], decay)
            step += 1
            pace = rate * (1 - 0.95 * min(1.0, step / total))
            for i, gradient in enumerate((np.array(found.bias), found.weights, found.factors)):
                means[i] += 0.1 * (gradient - means[i])
                spreads[i] += 0.001 * (gradient * gradient - spreads[i])
                values[i] = values[i] - pace * (means[i] / (1 - 0.9**step)) / (np.sqrt(spreads[i] / (1 - 0.999**step)) + 1e-8)
    return Machine(float(values[0]), values[1], values[2])


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def _document_features(docs: DataFrame, metadata: int) -> DataFrame:
    """(answer, draw, places, values) from rows of (answer, draw, text, metadata...)."""

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            made = [
                places_and_values(row[0], row[1:])
                for row in zip(batch.column(2).to_pylist(), *[batch.column(3 + i).to_pylist() for i in range(metadata)])
            ]
            columns = [pa.array([part[i].tobytes() for part in made], pa.binary()) for i in range(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["answer", "draw", "places", "values"])

    return docs.mapInArrow(features, "answer double, draw bigint, places binary, values binary")


def fit(
    docs: DataFrame, labels: DataFrame, held_out: int = 2, training_rows: int = 4096, metadata: tuple[str, ...] = ("n_chars",), text: str = "text", seed: int = 13, **options
) -> Machine | None:
    """Learn from labelled documents outside the held-out fold."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != held_out))
    known = known.groupBy(F.col("doc_id").alias("label_id")).agg(F.avg("quality").alias("answer"))
    numbers = [F.col(f"`{name}`").cast("double").alias(f"m{i}") for i, name in enumerate(metadata)]
    inputs = docs.select(F.col("doc_id").alias("label_id"), F.col(f"`{text}`").cast("string").alias("text"), *numbers)
    present = known.join(inputs.select("label_id"), "label_id", "left_semi")
    draw = F.xxhash64(F.lit(seed), "label_id")
    # at most training_rows ids, so small enough to be sent to every task
    drawn = present.select("*", draw.alias("draw")).orderBy("draw", "label_id").limit(training_rows)
    rows = inputs.join(F.broadcast(drawn), "label_id").select("answer", "draw", "text", *[f"m{i}" for i in range(len(metadata))])
    # rows that repeat an id are learned from once, those of one text alike
    features = _document_features(rows, len(metadata)).groupBy("draw").agg(F.min(F.struct("answer", "places", "values")).alias("row"))
    found = features.orderBy("draw").select("row.*").collect()
    if not found:
        return None
    dense = np.zeros((len(found), feature_count(len(metadata))), dtype=np.float32)
    for i, row in enumerate(found):
        dense[i, np.frombuffer(row["places"], dtype=np.int32)] = np.frombuffer(row["values"], dtype=np.float32)
    return train(dense, np.array([row["answer"] for row in found]), seed=seed, **options)


def score_texts(machine: Machine | None, texts: list[str | None], metadata: list[tuple[float | None, ...]]) -> np.ndarray:
    if machine is None or not texts:
        return np.full(len(texts), 0.5)
    made = [places_and_values(text, more) for text, more in zip(texts, metadata)]
    starts = np.cumsum([0, *[len(places) for places, _ in made[:-1]]])
    places, values = (np.concatenate([part[i] for part in made]) for i in range(2))
    return _logistic(raw_scores(machine, places, values, starts))


def score(
    docs: DataFrame, machine: Machine | None, metadata: tuple[str, ...] = ("n_chars",), text: str = "text", result: str = "score", predicted: str = "predicted", least: float = 0.7
) -> DataFrame:
    """The rows with a score (0 to 1) and the prediction 1 where it reaches ``least``."""
    kept = [name for name in docs.columns if name not in (result, predicted)]
    inputs = [F.col(f"`{text}`").cast("string").alias("_text"), *[F.col(f"`{name}`").cast("double") for name in metadata]]
    told = docs.select(F.struct(*[F.col(f"`{name}`") for name in kept]).alias("row"), *inputs)

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = batch.column(1).to_pylist()
            more = list(zip(*[batch.column(2 + i).to_pylist() for i in range(len(metadata))])) or [()] * len(texts)
            found = score_texts(machine, texts, more)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["row", "score"])

    schema = told.select("row", F.lit(0.0).alias("score")).schema
    made = told.mapInArrow(scored, schema)
    return made.select("row.*", F.col("score").alias(result), (F.col("score") >= least).cast("int").alias(predicted))
