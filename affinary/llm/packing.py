"""Order-preserving packing of documents into sequences by dynamic programming.

Documents, each ended by the end id, form a stream in the order of their ids.  Windows
of at most ``size`` ids cover the stream without gaps.  A window may end at a document
end (free), at a sentence end (``sentence_cut``) or inside a sentence
(``inner_cut``, only where a window is full); it also costs ``size - length`` of
padding and ``per_window``.  The cheapest
cuts come from f(j) = min f(i) + size - (p(j) - p(i)) + cost(j) over the window in front
of j; a queue that stays monotone in f(i) + p(i) gives each minimum in constant time.

Cuts inside sentences: of the full windows that end within one sentence only the cheapest
is followed, so the number of cut places stays linear.

Blocks of about ``docs_per_block`` documents along the ids are packed on their own, at most
``_STREAM`` ids at once besides one document; the last window is cut into powers of two, which
need no padding.

Null text is an empty text (only the end id), null ids come first, repeated rows are
documents of their own, an empty table gives no rows.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinary.llm.order import ordered_block
from affinary.llm.slices import small_batches
from affinary.llm.tokens import TextEncoder, default_vocabulary

_STREAM = 1 << 21  # ids packed at once
_NEVER = float("inf")
_LOCAL_BITS = 32  # sequences of one block


@dataclass(frozen=True)
class PackingCosts:
    size: int = 2048
    sentence_cut: float = 1.0
    inner_cut: float = 6.0
    per_window: float = 64.0
    longest_step: int = 256  # sentences are taken to end after so many ids


def window_cuts(places: list[int], costs: list[float], rule: PackingCosts) -> list[int]:
    """Where the cheapest windows end; ``places`` ascend and the last one ends the stream."""
    size, window, inner = rule.size, rule.per_window, rule.inner_cut + rule.per_window
    # nodes: place, cost so far plus place, node before
    at, keys, before = [0], [0.0], [-1]
    queue = deque([0])  # nodes with ascending keys
    scanned, last = 0, 0  # nodes whose full window has been looked at; place of the last node
    for place, end_cost in zip(places, costs):
        # the cheapest full window that ends between the place before and this one
        reach = place - size
        best, source = _NEVER, -1
        while at[scanned] < reach:
            start = at[scanned]
            if start + size > last and keys[scanned] - start <= best:
                best, source = keys[scanned] - start, scanned
            scanned += 1
        if source >= 0:
            last = at[source] + size
            key = best + inner + last
            while queue and keys[queue[-1]] >= key:
                queue.pop()
            queue.append(len(at))
            at.append(last)
            keys.append(key)
            before.append(source)
        while at[queue[0]] < reach:
            queue.popleft()
        source = queue[0]
        key = keys[source] + size + end_cost + window
        while queue and keys[queue[-1]] >= key:
            queue.pop()
        queue.append(len(at))
        at.append(place)
        keys.append(key)
        before.append(source)
        last = place
    # the last window is cut into powers of two, so it pads nothing wherever it begins
    ending, node = at[-1], len(at) - 1
    first = node
    while first > 0 and at[first - 1] >= ending - size:
        first -= 1
    if first < node:
        before[node] = min(range(first, node), key=lambda i: keys[i] - at[i])
    cuts = []
    while node > 0:
        cuts.append(at[node])
        node = before[node]
    return cuts[::-1]


def _powers(start: int, end: int) -> list[int]:
    """Ends of windows of powers of two, largest first, that cover start to end."""
    ends = []
    while start < end:
        start += 1 << ((end - start).bit_length() - 1)
        ends.append(start)
    return ends


def pack(
    docs: DataFrame,
    path: str | None = None,
    end_id: int = 1,
    docs_per_block: int = 512,
    rule: PackingCosts = PackingCosts(),
    stream: int = _STREAM,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece of a document.

    ``sequence_id`` holds the block and the sequence's number in it.
    """
    file = path or default_vocabulary()
    block, _ = ordered_block(docs, "doc_id", docs_per_block)
    rows = docs.select(block.alias("block"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    dealt = rows.repartition("block").sortWithinPartitions("block", "doc_id", "text")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(file)
        ends = np.zeros(max(encoder.vocabulary.values()) + 1, dtype=bool)
        for word, number in encoder.vocabulary.items():
            ends[number] = word[-1] in ".!?。！？" or "Ċ" in word  # Ċ stands for a line's end
        tail = np.array([end_id], dtype="<u4").tobytes()
        waiting: list[tuple[int | None, bytes]] = []
        waiting_ids = 0
        current, sequence = None, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal waiting, waiting_ids, sequence
            if not waiting:
                return
            sizes = np.array([len(data) // 4 for _, data in waiting], dtype=np.int64)
            last = np.cumsum(sizes)
            ids = np.frombuffer(b"".join(data for _, data in waiting), dtype="<u4")
            is_place = ends[np.minimum(ids, len(ends) - 1)]
            is_place[last - 1] = True
            found = np.flatnonzero(is_place) + 1
            # long sentences: further places, dear ones
            gaps = np.diff(found, prepend=0)
            extra = [np.arange(e - g + rule.longest_step, e, rule.longest_step) for e, g in zip(found[gaps > rule.longest_step], gaps[gaps > rule.longest_step])]
            inner = np.concatenate(extra) if extra else np.array([], dtype=np.int64)
            places = np.concatenate([found, inner])
            price = np.concatenate([np.where(np.isin(found, last), 0.0, rule.sentence_cut), np.full(len(inner), rule.inner_cut)])
            order = np.argsort(places, kind="stable")
            cuts = window_cuts(places[order].tolist(), price[order].tolist(), rule)
            begin = cuts[-2] if len(cuts) > 1 else 0
            windows = np.array(cuts[:-1] + _powers(begin, cuts[-1]), dtype=np.int64)
            starts = np.concatenate([[0], windows[:-1]])
            # pieces: every stretch between a cut and the next, of a window or of a document
            edges = np.unique(np.concatenate([windows, last]))
            low = np.concatenate([[0], edges[:-1]])
            doc = np.searchsorted(last, low, side="right")
            window = np.searchsorted(windows, low, side="right")
            data = memoryview(ids).cast("B")
            checks = [crc32(data[4 * a : 4 * b]) for a, b in zip(low.tolist(), edges.tolist())]
            owners = [waiting[i][0] for i in doc.tolist()]
            columns = [
                pa.array(owners, pa.int64()),
                pa.array(low - (last - sizes)[doc]),
                pa.array(edges - low),
                pa.array(checks, pa.int64()),
                pa.array(sizes[doc]),
                pa.array((np.int64(current) << _LOCAL_BITS) + sequence + window),
                pa.array(low - starts[window]),
            ]
            sequence += len(windows)
            waiting, waiting_ids = [], 0
            yield pa.RecordBatch.from_arrays(columns, names)

        for batch in small_batches(batches):
            for number, owner, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                data = encoder.ids(text.as_py() or "")
                if number != current:
                    yield from flush()
                    current, sequence = number, 0
                waiting.append((owner, data + tail))
                waiting_ids += len(data) // 4 + 1
                if waiting_ids >= stream:
                    yield from flush()
        yield from flush()

    schema = ", ".join(f"{name} bigint" for name in names)
    return dealt.mapInArrow(packed, schema)
