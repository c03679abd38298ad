"""Document fingerprints by order min-hash, in DataFrame operations only.

A text is a sequence of words: runs without white space, cut after ``LONGEST_WORD``
characters, and single characters of scripts that are written without spaces.  Its k-mers are ``k``
words in a row; the n-th occurrence of a k-mer is an element of its own.  Every element has one
rank under each of ``tuples`` independent hash functions.  Tuple j takes the elements of least rank
under functions j, j + 1, ... (``per_tuple`` of them, the last function followed by the first), puts them in the
order of the text and hashes them in that order.  So two texts share a tuple only if they share its
elements and have them in the same order: the share of equal tuples falls with the edit distance, also when
words are merely moved, and for short texts as for long ones.

A text with fewer than ``k`` words is one k-mer.  A text without words has no tuples; the
likeness of two such texts is 1, of one of them and another text 0.

Rows are dealt into blocks along their order, and all later steps stay within a block:
texts are shuffled once, k-mers never.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinary.llm.order import ordered_block

LONGEST_WORD = 24
# fixed values: Thai and Lao, Myanmar, Khmer, Chinese and Japanese
_UNSPACED = r"\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}"
_PLACE_BITS = 27  # of a packed (rank, place in the text)
_MOST_BLOCKS = 1 << 16  # so that the list of first rows, which is broadcast, stays below 2 MB
_ROWS_PER_BLOCK = 128


def kmer_hashes(words: str, k: int) -> Column:
    """One hash per k-mer, in text order; ``words`` names the column of the text's words."""
    word = F.col(words)
    grams = F.transform(word, lambda w, i: F.xxhash64(w, *[F.get(word, i + j) for j in range(1, k)]))
    return F.slice(grams, F.lit(1), F.greatest(F.size(word) - F.lit(k - 1), F.lit(1)))


def split_words(text: Column) -> Column:
    pattern = rf"[^\s{_UNSPACED}]{{1,{LONGEST_WORD}}}|[{_UNSPACED}]"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def likeness(left: Column, right: Column) -> Column:
    """Share of equal tuples among the tuples that either fingerprint has; entries hold a tuple's number in their high bits."""

    def numbers(entries: Column) -> Column:
        return F.transform(entries, lambda e: F.shiftright(e, 32))

    either = F.size(F.array_union(numbers(left), numbers(right)))
    equal = F.size(F.array_intersect(left, right))
    return F.when(either == 0, F.lit(1.0)).otherwise(equal / either)


def order_min_hash(elements: DataFrame, keys: list[str], tuples: int, per_tuple: int) -> DataFrame:
    """(keys, entries): the tuples of every text; ``elements`` has the keys, ``kmer`` and ``place``."""
    # the k-mer comes first, so that the sort compares mixed bits and rarely more
    occurrence = F.row_number().over(Window.partitionBy("kmer", *keys).orderBy("place"))
    last_place = (1 << _PLACE_BITS) - 1
    mixed = elements.withColumn("occurrence", occurrence).select(
        *keys, F.least("place", F.lit(last_place)).cast("bigint").alias("place"), F.xxhash64("kmer", "occurrence").alias("hash")
    )

    def packed(j: int) -> Column:
        """(rank under function j, place) in one number."""
        rank = F.shiftrightunsigned(F.xxhash64(F.col("hash").bitwiseXOR(F.lit(j).cast("bigint"))), _PLACE_BITS + 1)
        return F.shiftleft(rank, _PLACE_BITS).bitwiseOR(F.col("place"))

    least = mixed.groupBy(*keys).agg(*[F.min(packed(j)).alias(f"m{j}") for j in range(tuples)])
    members = [
        F.struct(F.col(f"m{j}").bitwiseAND(last_place).alias("place"), F.shiftright(f"m{j}", _PLACE_BITS).alias("rank"))
        for j in range(tuples)
    ]

    def entry(j: int) -> Column:
        in_text_order = F.array_sort(F.array(*[members[(j + i) % tuples] for i in range(per_tuple)]))
        value = F.xxhash64(F.transform(in_text_order, lambda m: m["rank"])).bitwiseAND((1 << 32) - 1)
        return F.lit(j << 32).cast("bigint").bitwiseOR(value)

    return least.select(*keys, F.array(*[entry(j) for j in range(tuples)]).alias("entries"))


def with_next(docs: DataFrame) -> DataFrame:
    """(block, row, is_copy, doc_id, text, next_text): every row and the text of the next one by doc_id, the first one's after the last.

    Null ids come first; rows with the same id are ordered by text.  Every block also holds a copy
    of the row that follows its last one (``is_copy``).
    """
    n_rows = docs.count()
    per_block = max(_ROWS_PER_BLOCK, -(-n_rows // _MOST_BLOCKS))
    block, _ = ordered_block(docs, "doc_id", per_block)
    rows = docs.select(
        block.alias("block"), F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    firsts = rows.groupBy("block").agg(F.min("doc_id").alias("first_id"))
    along = Window.orderBy("block")
    everywhere = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("block").over(along), F.max("block").over(everywhere))
    firsts = firsts.select(F.col("block").alias("of"), "first_id", before.alias("before"))
    # stated here, so that every use of the rows has the same plan and their shuffle is done once
    firsts = firsts.filter("before is not null")
    is_first = (F.col("block") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    copies = rows.join(F.broadcast(firsts), is_first).select(F.col("before").alias("block"), F.lit(True).alias("is_copy"), "doc_id", "text")
    both = rows.select("block", F.lit(False).alias("is_copy"), "doc_id", "text").unionByName(copies)
    inside = Window.partitionBy("block").orderBy("is_copy", "doc_id", "text")
    return both.select(
        "block", F.row_number().over(inside).alias("row"), "is_copy", "doc_id", "text", F.lead("text").over(inside).alias("next_text")
    )


def edited_fingerprints(docs: DataFrame, k: int = 3, tuples: int = 64, per_tuple: int = 2) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they and the next document's are.

    The edited text has its last floor(n / 2) characters replaced by the first as many of the
    next document, or all if it has fewer.
    """
    numbered = with_next(docs)
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.char_length("text") - half), F.substring(F.col("next_text"), F.lit(1), half)
    )
    texts = numbered.select("block", "row", "is_copy", "doc_id", "text", F.when(~F.col("is_copy"), edited).alias("edited"))
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("t")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("t")))
    each = texts.select("block", "row", F.explode(sides).alias("s")).filter("s.t is not null and s.t != ''")
    # exploded from an array of one: else the optimizer would put the split into every use of the words
    words = each.select(
        "block", (F.col("row") * 2 + F.col("s.side")).alias("id"), F.explode(F.array(split_words(F.col("s.t")))).alias("words")
    ).filter("size(words) > 0")
    grams = words.select("block", "id", F.explode(F.array(kmer_hashes("words", k))).alias("grams"))
    elements = grams.select("block", "id", F.posexplode("grams").alias("place", "kmer"))
    entries = order_min_hash(elements, ["block", "id"], tuples, per_tuple)
    own, other = F.col("id") % 2 == 0, F.col("id") % 2 == 1
    prints = entries.groupBy("block", F.floor(F.col("id") / 2).cast("int").alias("row")).agg(
        F.first(F.when(own, F.col("entries")), ignorenulls=True).alias("own"),
        F.first(F.when(other, F.col("entries")), ignorenulls=True).alias("other"),
    )
    about = texts.select(
        "block",
        "row",
        "is_copy",
        "doc_id",
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
    )
    none = F.array().cast("array<bigint>")
    joined = about.join(prints, ["block", "row"], "left").withColumns(
        {"own": F.coalesce("own", none), "other": F.coalesce("other", none)}
    )
    following = F.lead("own").over(Window.partitionBy("block").orderBy("row"))
    compared = joined.withColumn("following", following).filter("not is_copy")

    def text_of(entries: str) -> Column:
        return F.array_join(F.transform(entries, lambda e: F.lower(F.hex(e))), ".")

    return compared.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        text_of("own").alias("fingerprint"),
        text_of("other").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
