import hashlib

import pytest
from pyspark.sql import functions as F

from affinary.llm import fingerprints


def plain(rows):
    """(doc_id, n_chars, edited_sha256) the slow way."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [text or "" for _, text in ordered]
    out = []
    for i, (doc_id, _) in enumerate(ordered):
        own, following = texts[i], texts[(i + 1) % len(texts)]
        half = len(own) // 2
        edited = own[: len(own) - half] + following[:half]
        out.append((doc_id, len(own), hashlib.sha256(edited.encode()).hexdigest()))
    return out


def test_edited_texts_match_plain(documents, words, rows):
    given = [(i * 3, words(i % 60, i)) for i in range(400)]
    given += [(None, "no id"), (5, None), (7, ""), (8, "   "), (10, "été 😀 ünï"), (10, "été 😀 ünï"), (10**15, "far away")]
    result = fingerprints.edited_fingerprints(documents(given)).cache()
    expected = sorted(plain(given), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    found = sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in result.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    assert found == expected


def test_equal_texts_and_order(documents, words):
    text = words(300, 1)
    parts = text.split(" ")
    moved = " ".join(parts[150:] + parts[:150])
    turned = " ".join(parts[::-1])
    edited = " ".join(parts[:100] + ["new"] * 3 + parts[103:])
    found = {r.doc_id: r for r in fingerprints.edited_fingerprints(documents([(1, text), (2, text), (3, edited), (4, text), (5, turned), (6, "")])).collect()}
    assert found[1].fingerprint == found[2].fingerprint == found[4].fingerprint
    assert found[1].near_next == 1.0
    assert 0.6 < found[2].near_next < 1.0  # a small edit
    assert found[4].near_next < 0.1  # the same words backwards
    assert found[5].near_next == 0.0 and 0 < found[1].near_edited <= 1
    assert found[6].fingerprint == ""
    shuffled = {r.doc_id: r for r in fingerprints.edited_fingerprints(documents([(1, text), (2, moved)])).collect()}
    # moved halves keep the k-mers but not the order of tuples across the halves
    assert 0.2 < shuffled[1].near_next < 0.85


def test_matches_plain_order_min_hash(words, spark):
    """Tuples against a version that sorts all elements by each function."""
    text = words(120, 3, vocabulary=15)
    elements = [(0, i, hash(tuple(text.split()[i : i + 2])) % (1 << 62)) for i in range(119)]
    frame = spark.createDataFrame(elements, "id bigint, place int, kmer bigint")
    found = fingerprints.order_min_hash(frame, ["id"], 8, 2).first().entries
    seen, numbered = {}, []
    for _, place, kmer in elements:
        seen[kmer] = seen.get(kmer, 0) + 1
        numbered.append((kmer, seen[kmer], place))
    hashes = spark.createDataFrame(numbered, "kmer bigint, occurrence int, place int").withColumn("h", F.xxhash64("kmer", "occurrence"))
    ranks = [F.xxhash64(F.col("h").bitwiseXOR(F.lit(j).cast("bigint"))).alias(f"r{j}") for j in range(8)]
    rows = hashes.select("place", *ranks).collect()
    first = [min(((r[f"r{j}"] & (2**64 - 1)) >> 28, r.place) for r in rows) for j in range(8)]
    expected = []
    for j in range(8):
        in_order = [rank for rank, _ in sorted([first[j], first[(j + 1) % 8]], key=lambda m: (m[1], m[0]))]
        value = spark.range(1).select(F.xxhash64(F.array(*[F.lit(v).cast("bigint") for v in in_order]))).first()[0] & (2**32 - 1)
        expected.append(j << 32 | value)
    assert found == expected


@pytest.mark.parametrize("n", [20, 40, 80, 160, 400])
def test_order_counts_at_every_length(documents, words, n):
    """Swapped halves change two k-mers; of the pairs of kept k-mers half change their order, but for a k-mer with itself."""
    given = []
    for i in range(20):
        parts = words(n, 100 + i, vocabulary=5000).split(" ")
        given += [(2 * i, " ".join(parts)), (2 * i + 1, " ".join(parts[n // 2 :] + parts[: n // 2]))]
    found = {r.doc_id: r.near_next for r in fingerprints.edited_fingerprints(documents(given)).collect()}
    kmers = n - 2
    kept = (kmers - 2) / (kmers + 2)
    expected = kept**2 * (0.5 + 0.5 / kmers)
    assert sum(found[2 * i] for i in range(20)) / 20 == pytest.approx(expected, abs=0.06)


def test_scripts_without_spaces(documents):
    text = "".join(chr(0x4E00 + (i * i * 31 + i * 17) % 3000) for i in range(400))
    late = text[:3] + "\u7532" + text[3:]  # one character more near the start
    found = {r.doc_id: r for r in fingerprints.edited_fingerprints(documents([(1, text), (2, late), (3, "words of another kind")])).collect()}
    assert 0.8 < found[1].near_next < 1.0 and found[2].near_next == 0.0


@pytest.mark.parametrize("given", [[], [(1, None)], [(1, "one")]])
def test_tiny_tables(documents, given):
    result = fingerprints.edited_fingerprints(documents(given)).collect()
    assert len(result) == len(given)
