"""Token ids of whole texts, and the exact histogram of encoded lengths.

A text in common scripts is merged by tiktoken, from the vocabulary of the same file, when that
is sure to give the ids that tokenizers gives; all others are encoded by tokenizers.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinary.llm.slices import small_batches
from affinary.sources.scratch import materialize

# pieces of text that are merged on their own (fixed pattern of byte-level tokenizers)
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# beyond Latin letters and general punctuation, libraries may know different versions of Unicode
_RARE = re.compile("[^\u0000-\u024f\u2010-\u2027\u2030-\u205e\u20ac]")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones are themselves, others follow from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(byte): byte for byte in printable} | {chr(256 + i): byte for i, byte in enumerate(others)}


class TextEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, special tokens in a text included.

    Only a plain byte-level vocabulary whose merges come in the order of their ids is merged by
    tiktoken, and only texts without special tokens and rare characters.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self._path = path
        self._exact = None
        self.vocabulary: dict[str, int] = dict(described["model"]["vocab"])
        self._special = [token["content"] for token in described["added_tokens"]]
        self._fast = self._merger(described)

    def _merger(self, described: dict):
        model, split = described["model"], described["pre_tokenizer"] or {}
        is_plain = (
            model.get("type") == "BPE"
            and not model.get("dropout")
            and described["normalizer"] is None
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
        )
        if not is_plain:
            return None
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        made = [self.vocabulary.get(left + right, -1) for left, right in pairs]
        byte_of = _byte_of()
        words = {word: number for word, number in self.vocabulary.items() if word not in self._special}
        if any(a >= b for a, b in zip(made, made[1:])) or not all(char in byte_of for word in words for char in word):
            return None
        import tiktoken

        ranks = {bytes(byte_of[char] for char in word): number for word, number in words.items()}
        return tiktoken.Encoding("texts", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> bytes:
        is_common = self._fast is not None and (text.isascii() or not _RARE.search(text))
        if is_common and not any(token in text for token in self._special):
            return self._fast.encode_to_numpy(text, disallowed_special=()).tobytes()
        if self._exact is None:
            from tokenizers import Tokenizer

            self._exact = Tokenizer.from_file(self._path)
        return array("I", self._exact.encode(text, add_special_tokens=False).ids).tobytes()


def encoded_lengths(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) of every row; null text has 0 tokens."""
    file = path or default_vocabulary()

    def lengths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(file)
        for batch in small_batches(batches):
            counts = [len(encoder.ids(text.as_py() or "")) // 4 for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(lengths, "doc_id bigint, n_tokens bigint")


_SPAN = 1024  # lengths whose sums are added up together


def length_histogram(lengths: DataFrame, column: str = "n_tokens") -> DataFrame:
    """One row per encoded length that occurs, with what suffix sums over the lengths answer.

    n_docs of this length; docs_at_least and tokens_at_least of this length or more;
    truncated_total: tokens left when every document is cut at this length; share_up_to:
    share of documents that fit into this length, so the q-quantile is the smallest length
    with share_up_to >= q.  Spans of lengths are summed first, so no task sees all lengths;
    an empty table gives no rows.
    """
    counts = lengths.groupBy(F.col(column).alias("length")).agg(F.count(F.lit(1)).alias("n_docs"))
    # written once: both uses below would encode all texts again
    counts = materialize(counts.withColumn("span", F.floor(F.col("length") / _SPAN)), "length-counts")
    tokens = F.col("n_docs") * F.col("length")
    spans = counts.groupBy("span").agg(F.sum("n_docs").alias("d"), F.sum(tokens).alias("t"))
    longer = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    totals = spans.select(
        "span",
        F.coalesce(F.sum("d").over(longer), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("t").over(longer), F.lit(0)).alias("tokens_above"),
        F.sum("d").over(everything).alias("all_docs"),
        F.sum("t").over(everything).alias("all_tokens"),
    )
    within = Window.partitionBy("span").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    joined = counts.join(totals, "span").withColumns(
        {
            "docs_at_least": F.col("docs_above") + F.sum("n_docs").over(within),
            "tokens_at_least": F.col("tokens_above") + F.sum(tokens).over(within),
        }
    )
    shorter = F.col("all_tokens") - F.col("tokens_at_least")
    above = F.col("docs_at_least") - F.col("n_docs")
    return joined.select(
        "length",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        (shorter + F.col("length") * F.col("docs_at_least")).alias("truncated_total"),
        ((F.col("all_docs") - above) / F.col("all_docs")).alias("share_up_to"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, fitting_docs, truncated_total) for any limits, from the histogram alone."""
    spark = histogram.sparkSession
    wanted = spark.createDataFrame([(int(limit),) for limit in limits], "context_limit bigint")
    rows = histogram.join(F.broadcast(wanted), F.lit(True))
    return rows.groupBy("context_limit").agg(
        F.sum(F.when(F.col("length") <= F.col("context_limit"), F.col("n_docs")).otherwise(0)).alias("fitting_docs"),
        F.sum(F.least("length", "context_limit") * F.col("n_docs")).alias("truncated_total"),
    )
