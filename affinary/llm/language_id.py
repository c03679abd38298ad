"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time: at every byte, a state
that has read the bytes before and one that has read the bytes behind it give the
probabilities of the languages.  A document's probabilities are the means over all its
bytes.  Gates and candidates use softsign, x / (1 + |x|), which costs a tenth of tanh.

Texts are read whole, in windows of ``WINDOW`` bytes that each start from empty states.
Training uses ``windows_per_language`` windows per language at most, one row of text per window
at pseudo-random places of documents picked by a hash; the bound is independent of the
corpus.  Counts per language cover all rows.  Language, source and id are never inputs of a
prediction.

With ``reject`` a class of its own is trained on windows that are no language: bytes of the training windows
shuffled, and random bytes from the whole range and from the printable ones.  A document is ``und`` if the mean probability of that
class over its bytes, and over one window more that counts against it, is one half or more.  So it is judged by itself, however many
languages there are, bytes that no language used (other scripts) speak against it, and a few odd bytes are not enough.

Null text and text without letters are ``und`` with score 0, as is everything when there
is nothing to learn from; rows without a language are not learned from; a null id is never held
out and never learned from; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinary.llm.slices import small_batches

UNKNOWN = "und"
WINDOW = 64  # bytes
_PAD = 256  # symbol behind the end of a text
_ROWS = 4096  # windows computed together

Parameters = dict[str, np.ndarray]


def _softsign(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x)
    scale += 1.0
    x /= scale
    return x


def new_parameters(languages: int, hidden: int, random: np.random.Generator) -> Parameters:
    made: Parameters = {}
    for side in "fb":
        for gate in "zrn":
            made[f"W{side}{gate}"] = random.normal(0, 0.4, (257, hidden))
            made[f"U{side}{gate}"] = random.normal(0, 1 / np.sqrt(hidden), (hidden, hidden))
        made[f"Wf{'z'}"] += 0.5  # states persist at first
        made[f"V{side}"] = random.normal(0, 0.5, (hidden, languages))
    made["c"] = np.zeros(languages)
    return {name: value.astype(np.float32) for name, value in made.items()}


def _states(p: Parameters, side: str, symbols: np.ndarray, keep: bool = False):
    """States at every step; ``symbols`` is (steps, rows).  The backward side reads from the end."""
    steps, rows = symbols.shape
    hidden = p[f"U{side}z"].shape[0]
    h = np.zeros((rows, hidden), dtype=np.float32)
    states = np.empty((steps, rows, hidden), dtype=np.float32)
    tape = []
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        x = symbols[t]
        z = p[f"W{side}z"].take(x, axis=0)
        z += h @ p[f"U{side}z"]
        z = _softsign(z)
        z += 1.0
        z *= 0.5
        r = p[f"W{side}r"].take(x, axis=0)
        r += h @ p[f"U{side}r"]
        r = _softsign(r)
        r += 1.0
        r *= 0.5
        q = h @ p[f"U{side}n"]
        n = r * q
        n += p[f"W{side}n"].take(x, axis=0)
        n = _softsign(n)
        if keep:
            tape.append((t, h, z, r, q, n))
        new = h - n
        new *= z
        new += n
        h = states[t] = new
    return (states, tape) if keep else states


def position_probabilities(p: Parameters, symbols: np.ndarray) -> np.ndarray:
    """(languages, steps * rows): probabilities at every byte."""
    hidden = p["Vf"].shape[0]
    scores = p["Vf"].T @ _states(p, "f", symbols).reshape(-1, hidden).T
    scores += p["Vb"].T @ _states(p, "b", symbols).reshape(-1, hidden).T
    scores += p["c"][:, None]
    np.exp(scores, out=scores)  # states lie in (-1, 1), so scores are bounded
    total = scores[0].copy()
    for row in scores[1:]:
        total += row
    scores /= total
    return scores


def _gradients(p: Parameters, symbols: np.ndarray, labels: np.ndarray) -> tuple[float, Parameters]:
    """Mean loss over all bytes and its gradients."""
    steps, rows = symbols.shape
    hidden = p["Vf"].shape[0]
    forward, tape_f = _states(p, "f", symbols, keep=True)
    backward, tape_b = _states(p, "b", symbols, keep=True)
    scores = forward @ p["Vf"] + backward @ p["Vb"] + p["c"]
    scores -= scores.max(axis=2, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=2, keepdims=True)
    real = symbols != _PAD
    count = max(1, int(real.sum()))
    picked = scores[:, np.arange(rows), labels]
    loss = float(-(np.log(picked + 1e-9) * real).sum() / count)
    scores[:, np.arange(rows), labels] -= 1.0
    scores *= (real / count)[:, :, None].astype(np.float32)
    grads: Parameters = {"c": scores.sum(axis=(0, 1))}
    for side, states, tape in (("f", forward, tape_f), ("b", backward, tape_b)):
        grads[f"V{side}"] = np.einsum("tbh,tbl->hl", states, scores, optimize=True)
        arriving = scores @ p[f"V{side}"].T
        for gate in "zrn":
            grads[f"U{side}{gate}"] = np.zeros((hidden, hidden), dtype=np.float32)
        at = {gate: np.empty((steps, rows, hidden), dtype=np.float32) for gate in "zrn"}
        carried = np.zeros((rows, hidden), dtype=np.float32)
        for t, h, z, r, q, n in reversed(tape):
            d = carried + arriving[t]
            du = d * (1 - z) * (1 - np.abs(n)) ** 2
            dz = d * (h - n) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
            dr = du * q * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
            dq = du * r
            carried = d * z + dq @ p[f"U{side}n"].T + dz @ p[f"U{side}z"].T + dr @ p[f"U{side}r"].T
            grads[f"U{side}n"] += h.T @ dq
            grads[f"U{side}z"] += h.T @ dz
            grads[f"U{side}r"] += h.T @ dr
            at["z"][t], at["r"][t], at["n"][t] = dz, dr, du
        flat = symbols.ravel()
        for gate in "zrn":
            columns = at[gate].reshape(-1, hidden)
            grads[f"W{side}{gate}"] = np.stack(
                [np.bincount(flat, columns[:, j], minlength=257) for j in range(hidden)], axis=1
            ).astype(np.float32)
    return loss, grads


def train(
    texts: list[bytes], labels: list[int], languages: int, hidden: int = 8, epochs: int = 8, batch: int = 256, rate: float = 0.02, seed: int = 7
) -> Parameters:
    """Parameters fitted to labelled windows by Adam."""
    random = np.random.default_rng(seed)
    p = new_parameters(languages, hidden, random)
    symbols = np.full((len(texts), WINDOW), _PAD, dtype=np.int64)
    for row, text in enumerate(texts):
        symbols[row, : len(text)] = np.frombuffer(text[:WINDOW], dtype=np.uint8)
    answers = np.asarray(labels)
    mean = {name: np.zeros_like(value) for name, value in p.items()}
    square = {name: np.zeros_like(value) for name, value in p.items()}
    per_epoch = max(1, -(-len(texts) // batch))
    total, step = max(epochs * per_epoch, 40), 0
    while step < total:
        order = random.permutation(len(texts))
        for begin in range(0, len(texts), batch):
            rows = order[begin : begin + batch]
            _, grads = _gradients(p, symbols[rows].T, answers[rows])
            step += 1
            pace = rate * (1 - 0.9 * min(1.0, step / total))
            for name, grad in grads.items():
                mean[name] += 0.1 * (grad - mean[name])
                square[name] += 0.01 * (grad * grad - square[name])
                fitted = mean[name] / (1 - 0.9**step)
                spread = np.sqrt(square[name] / (1 - 0.99**step)) + 1e-8
                p[name] -= (pace * fitted / spread).astype(np.float32)
    return p


def document_probabilities(p: Parameters, texts: list[bytes]) -> np.ndarray:
    """(texts, languages): means over the bytes of each text; zeros for an empty text."""
    languages = len(p["c"])
    sizes = np.array([len(text) for text in texts], dtype=np.int64)
    counts = -(-sizes // WINDOW)
    sums = np.zeros((len(texts), languages))
    if not counts.sum():
        return sums
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(texts)), counts)
    padded = b"".join(text + b"\0" * (-len(text) % WINDOW) for text in texts)
    windows = np.frombuffer(padded, dtype=np.uint8).reshape(-1, WINDOW)
    number = np.arange(len(owner)) - np.repeat(ends - counts, counts)
    lengths = np.minimum(sizes[owner] - number * WINDOW, WINDOW)
    for begin in range(0, len(owner), _ROWS):
        rows = slice(begin, begin + _ROWS)
        symbols = windows[rows].T.astype(np.int64)
        is_pad = np.arange(WINDOW)[:, None] >= lengths[rows]
        symbols[is_pad] = _PAD
        found = position_probabilities(p, symbols).reshape(languages, WINDOW, -1)
        if is_pad.any():
            found *= ~is_pad
        per_window = found.sum(axis=1)
        for language in range(languages):
            sums[:, language] += np.bincount(owner[rows], per_window[language], minlength=len(texts))
    return sums / np.maximum(sizes, 1)[:, None]


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    parameters: Parameters | None


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def _not_language(texts: list[bytes], count: int, seed: int) -> list[bytes]:
    """Windows that are no language: shuffled ones, and random bytes, all or printable."""
    random = np.random.default_rng(seed)
    made = []
    for i in range(count):
        kind = i % 4
        if kind < 2:
            source = np.frombuffer(texts[int(random.integers(0, len(texts)))], dtype=np.uint8)
            made.append(random.permutation(source).tobytes())
        else:
            low, high = ((0, 256), (33, 127))[kind - 2]
            made.append(random.integers(low, high, WINDOW).astype(np.uint8).tobytes())
    return made


def fit(docs: DataFrame, windows_per_language: int = 1500, seed: int = 7, reject: bool = False, **options) -> LanguageModel:
    """Learn from documents that are not held out; languages are taken to be some hundreds at most."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (fold(F.col("doc_id")) != 1))
    named = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != 1))
    counts = {row["lang"]: row["n"] for row in named.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = tuple(sorted(counts))
    if not languages:
        return LanguageModel((), None)
    # a share of the documents of each language, several windows each where there are few documents
    wanted = {language: 1.15 * windows_per_language / n for language, n in counts.items()}
    share = F.create_map(*[F.lit(x) for language, w in wanted.items() for x in (language, min(1.0, w))])
    several = F.create_map(*[F.lit(x) for language, w in wanted.items() for x in (language, int(min(64, max(1, -(-w // 1)))))])
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    picked = known.filter(draw < F.element_at(share, F.col("lang"))).select(
        "doc_id", "lang", "text", F.explode(F.sequence(F.lit(1), F.element_at(several, F.col("lang")))).alias("j")
    )
    place = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "j"), F.greatest(F.char_length("text") - WINDOW, F.lit(0)) + 1)
    cut = picked.select(
        "lang", F.xxhash64("doc_id", "j").alias("h"), F.substring(F.col("text"), place.cast("int") + 1, F.lit(WINDOW)).alias("piece")
    )
    rows = sorted((row["lang"], row["h"], row["piece"]) for row in cut.collect())
    texts, labels, taken = [], [], dict.fromkeys(languages, 0)
    for language, _, piece in rows:
        if taken[language] < windows_per_language:
            taken[language] += 1
            texts.append(piece.encode()[:WINDOW])
            labels.append(languages.index(language))
    if not texts:
        return LanguageModel((), None)
    if reject:
        others = _not_language(texts, max(windows_per_language, len(texts) // 4), seed)
        texts, labels, languages = texts + others, labels + [len(languages)] * len(others), (*languages, UNKNOWN)
    return LanguageModel(languages, train(texts, labels, len(languages), seed=seed, **options))


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def label_texts(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of every text."""
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if model.parameters is None:
        return names, scores
    places = [i for i, text in enumerate(texts) if text and _has_letter(text)]
    group: list[int] = []
    size = 0
    for i in [*places, None]:
        if i is None or size > 1 << 20:  # bytes computed together, besides one text
            found = document_probabilities(model.parameters, [texts[j].encode("utf-8", "replace") for j in group])
            if model.languages[-1] == UNKNOWN:
                # one window more that speaks for a language: a few bytes are no evidence
                sizes = np.array([len(texts[j].encode("utf-8", "replace")) for j in group])
                rejected, found = found[:, -1] * sizes / (sizes + WINDOW) >= 0.5, found[:, :-1]
            else:
                rejected = np.zeros(len(group), dtype=bool)
            for j, row, is_rejected in zip(group, found, rejected):
                if is_rejected:
                    continue
                names[j], scores[j] = model.languages[int(row.argmax())], float(min(1.0, row.max()))
            group, size = [], 0
        if i is not None:
            group.append(i)
            size += len(texts[i])
    return names, scores


def label(docs: DataFrame, model: LanguageModel, text: str = "text", language: str = "lang_pred", score: str = "score") -> DataFrame:
    """The rows with a language and a score added."""
    at = docs.columns.index(text)

    def labelled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            names, scores = label_texts(model, batch.column(at).to_pylist())
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, language, score])

    schema = docs.select("*", F.lit("").alias(language), F.lit(0.0).alias(score)).schema
    return docs.mapInArrow(labelled, schema)
