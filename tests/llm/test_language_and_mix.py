import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinary.llm import language_id, mixing

LETTERS = {"aa": "abcdefgh", "bb": "mnopqrst", "cc": "éèçàùïôâ"}


def speak(language, count, seed):
    random = np.random.default_rng(seed)
    letters = LETTERS[language]
    return " ".join("".join(letters[i] for i in random.integers(0, 8, random.integers(2, 7))) for _ in range(count))


def test_gradients_match_differences():
    """Backpropagation through time against finite differences."""
    random = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in language_id.new_parameters(3, 4, random).items()}
    symbols = random.integers(97, 103, (6, 5))
    symbols[4:, 0] = language_id._PAD
    labels = np.array([0, 1, 2, 1, 0])
    _, grads = language_id._gradients(p, symbols, labels)
    for name in ("Ufz", "Ubr", "Ubn", "Vf", "c", "Wfn", "Wbz"):
        for place in [tuple(random.integers(0, s) for s in p[name].shape) for _ in range(3)]:
            if name[0] == "W":
                place = (int(symbols[1, 1]), place[1])
            step = 1e-3
            values = []
            for sign in (1, -1):
                q = {k: v.copy() for k, v in p.items()}
                q[name][place] += sign * step
                values.append(language_id._gradients(q, symbols, labels)[0])
            assert grads[name][place] == pytest.approx((values[0] - values[1]) / (2 * step), abs=2e-3)


def test_held_out_languages(documents):
    rows = [(i, speak(lang, 1 + i % 60, i), lang, None) for i, lang in enumerate(["aa", "bb", "cc"] * 120)]
    rows += [(9001, None, "aa", None), (9002, "", "bb", None), (9003, "12 -- 34", "aa", None), (None, "mnop qrst " * 9, None, None), (9005, "abc def " * 20000, None, None)]
    docs = documents(rows)
    model = language_id.fit(docs, windows_per_language=300)
    found = language_id.label(docs.select("*", (language_id.fold(F.col("doc_id")) == 1).alias("held")), model).collect()
    assert model.languages == ("aa", "bb", "cc") and len(found) == len(rows)
    for r in found:
        if r.doc_id is not None:
            assert r.held == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.lang_pred in (*model.languages, "und")
    clean = [r for r in found if r.held and r.doc_id < 9000]
    assert np.mean([r.lang == r.lang_pred for r in clean]) > 0.97
    by_id = {r.doc_id: r for r in found}
    assert [by_id[i].lang_pred for i in (9001, 9002, 9003)] == ["und"] * 3 and by_id[9001].score == 0
    assert by_id[None].lang_pred == "bb" and by_id[9005].lang_pred == "aa"


@pytest.mark.parametrize("count", [2, 4, 30])
def test_what_is_no_language_is_rejected_whatever_their_number(documents, count):
    """Languages of invented syllables; junk goes and clean documents stay with few and with many of them."""
    random = np.random.default_rng(count)
    consonants, vowels = "bcdfghjklmnprstvz", "aeiouéàöñ"
    syllables = [["".join((random.choice(list(consonants)), random.choice(list(vowels)), random.choice(["", "n", "r", "s"]))) for _ in range(24)] for _ in range(count)]

    def write(language, words):
        return " ".join("".join(random.choice(syllables[language], random.integers(1, 4))) for _ in range(words)).capitalize() + "."

    rows = [(i, write(i % count, 8 + i % 90), f"l{i % count:02}", None) for i in range(40 * count)]
    printable = [chr(c) for c in range(33, 127)]
    junk = ["".join(random.choice(printable, 400)) for _ in range(10)]
    junk += ["".join(map(chr, random.integers(0, 32, 300))) + "x" for _ in range(10)]
    junk += ["".join(map(chr, random.integers(0x410, 0x450, 200))) for _ in range(10)]
    junk += ["".join(map(chr, random.integers(0x4E00, 0x9000, 150))) for _ in range(10)]
    rows += [(10**6 + i, text, None, None) for i, text in enumerate(junk)]
    docs = documents(rows)
    model = language_id.fit(docs, windows_per_language=max(100, 600 // count), reject=True)
    found = {r.doc_id: r.lang_pred for r in language_id.label(docs, model).collect()}
    assert sum(found[i] != "und" for i in found if i < 10**6) >= 0.97 * 40 * count
    assert sum(found[i] == "und" for i in found if i >= 10**6) >= 0.95 * len(junk)


def test_nothing_to_learn(documents):
    for rows in ([], [(1, "text", None, None)], [(1, None, "aa", None)]):
        docs = documents(rows)
        assert {r.lang_pred for r in language_id.label(docs, language_id.fit(docs)).collect()} <= {"und"}


def test_label_is_never_an_input(documents):
    rows = [(i, speak(lang, 20, i), lang, None) for i, lang in enumerate(["aa", "bb"] * 60)]
    model = language_id.fit(documents(rows), windows_per_language=100)
    swapped = documents([(i + 10**6, text, {"aa": "bb", "bb": "aa"}[lang], "s") for i, text, lang, _ in rows])
    a = [r.score for r in language_id.label(documents(rows), model).orderBy("doc_id").collect()]
    b = [r.score for r in language_id.label(swapped, model).orderBy("doc_id").collect()]
    assert a == b


def plain_targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted([s for s in sizes if s is not None], key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_names, rest = {}, set(names), float(sum(sizes.values()))
    while open_names:
        level = rest / sum(weight[s] for s in open_names)
        above = {s for s in open_names if weight[s] * level >= cap * sizes[s]}
        if not above:
            target.update({s: weight[s] * level for s in open_names})
            break
        for s in above:
            target[s] = float(cap * sizes[s])
            rest -= target[s]
        open_names -= above
    return target


def mix_rows(words):
    rows = [(i, words(1 + i * 13 % 120, i), None, f"s{i % 7}") for i in range(500)]
    rows += [(600 + i, words(400, i), None, "big") for i in range(60)] + [(700, "only one", None, "tiny"), (701, None, None, "empty"), (702, "", None, "empty")]
    rows += [(703, "a b\u00a0c d", None, None), (704, words(30, 5), None, None), (705, "x y", None, "ß"), (703, "a b\u00a0c d", None, None), (None, words(20, 8), None, "s1"), (706, words(9000, 3), None, "s2")]
    return rows


def test_mix_meets_targets(documents, words):
    rows = mix_rows(words)
    docs = documents(rows)
    result = mixing.taken_words(mixing.mix(docs)).select(F.col("kept.doc_id").alias("doc_id"), "source", "size", "source_size", "target", "taken").collect()
    assert len(result) == len(rows)
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").replace("\u00a0", "x").split())
    targets = plain_targets(sizes)
    taken = {}
    for r in result:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for source, target in targets.items():
        assert abs(taken[source] - target) < 64  # one block
    again = mixing.taken_words(mixing.mix(docs.repartition(7))).select(F.col("kept.doc_id").alias("doc_id"), "source", "size", "source_size", "target", "taken").collect()
    assert sorted(map(str, again)) == sorted(map(str, result))


def lines(mixed):
    """Per source: its documents' ids word by word along its line, and its target."""
    found = {}
    for r in mixed.placed.orderBy("number", "start").collect():
        line, _ = found.setdefault(r.number, ([], r.target))
        line.extend([r.kept.doc_id] * r.size)
    return found


def plain_mix(mixed, slots, block):
    """What the slots take, walked word by word: (words, first slot) of each document."""
    taken, first, ranks = {}, {}, {}
    held = lines(mixed)
    for slot, number in slots:
        rank = ranks[number] = ranks.get(number, -1) + 1
        line, _ = held[number]
        for word in range(rank * block, (rank + 1) * block):
            if word < 3 * len(line):
                owner = line[word % len(line)]
                taken[owner] = taken.get(owner, 0) + 1
                first.setdefault(owner, slot)
    return taken, first


def test_mix_takes_what_its_slots_say(documents, words, spark):
    """Each document's share against slots and lines walked word by word."""
    rows = [(i, words(1 + i % 9, i), None, f"s{i % 3}") for i in range(60)]
    mixed = mixing.mix(documents(rows), block_words=4)
    targets = [target for _, (_, target) in sorted(lines(mixed).items())]
    bits = math.ceil(math.log2(sum(targets) / 4))
    edges = [sum(targets[: n + 1]) / (4 << bits) for n in range(3)]
    points = [int(f"{slot:0{bits}b}"[::-1], 2) / (1 << bits) for slot in range(1 << bits)]
    slots = [(slot, next(n for n, edge in enumerate(edges) if point < edge)) for slot, point in enumerate(points) if point < edges[-1]]
    taken, first = plain_mix(mixed, slots, 4)
    found = {r.kept.doc_id: (r.taken, r.slot) for r in mixing.taken_words(mixed).collect()}
    assert found == {i: (taken.get(i, 0), first.get(i)) for i in found}
    for number, target in enumerate(targets):
        assert abs(sum(taken.get(i, 0) for i in set(lines(mixed)[number][0])) - target) < 4


def test_another_schedule_takes_other_words(documents, words, spark, monkeypatch):
    rows = [(i, words(1 + i % 9, i), None, f"s{i % 3}") for i in range(60)]
    docs = documents(rows)
    for slots in ([], [(0, 2), (1, 0), (2, 2), (3, 2), (4, 1), (9, 2)]):
        ranked = [(slot, number, sum(n == number for _, n in slots[:place])) for place, (slot, number) in enumerate(slots)]
        monkeypatch.setattr(mixing, "schedule", lambda *_: spark.createDataFrame(ranked, "slot bigint, number int, rank bigint"))
        mixed = mixing.mix(docs, block_words=4)
        taken, first = plain_mix(mixed, slots, 4)
        found = {r.kept.doc_id: (r.taken, r.slot) for r in mixing.taken_words(mixed).collect()}
        assert found == {i: (taken.get(i, 0), first.get(i)) for i in found} and sum(n for n, _ in found.values()) == 4 * len(slots)


@pytest.mark.parametrize("block", [1, 64])
def test_schedule_is_even(spark, block):
    targets = [block * x for x in (500.25, 300.5, 0.4, 149.9, 50.0)]
    slots = mixing.schedule(spark, targets, block).orderBy("slot").toPandas()
    assert slots["slot"].is_unique and slots["slot"].max() < 1024
    assert (slots.groupby("number").cumcount() == slots["rank"]).all()
    total = sum(targets)
    for number, target in enumerate(targets):
        assert abs((slots["number"] == number).sum() * block - target) < block
    for stop in (50, 200, 700):
        for number, target in enumerate(targets):
            assert abs((slots["number"][:stop] == number).sum() - target / total * stop) < 6


def test_mixed_documents(documents, words):
    rows = mix_rows(words)
    docs = documents(rows)
    result = mixing.mixed_documents(docs)
    assert result.columns == docs.columns
    known = {(i, t, s) for i, t, _, s in rows}
    copies = {}
    for r in result.collect():
        assert (r.doc_id, r.text, r.source) in known
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert max(copies.values()) <= 6 and 701 not in copies
    assert mixing.mixed_documents(documents([])).count() == 0
    assert mixing.taken_words(mixing.mix(documents([(1, None, None, None)]))).first().taken == 0
