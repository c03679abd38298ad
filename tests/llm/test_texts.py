import base64
import json
import time
import zlib

import numpy as np
import pytest

from affinary.llm import packing, secret_spans, tokens
from affinary.llm.tokens import TextEncoder, default_vocabulary

ODD = ["a  b", " a", "a ", "a \n b", "\n\n x", "<|endoftext|> a<|endoftext|>b", "日本語 テキスト", "é  b  ", "don't 'll  's", "  ", "", "a  b", "😀 ok 12 3a", "cœur – “x” …"]


def exact_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_vocabulary()).encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library(words):
    encoder = TextEncoder(default_vocabulary())
    for text in [*ODD, words(200, 1)]:
        assert np.frombuffer(encoder.ids(text), dtype="<u4").tolist() == exact_ids(text)


def test_length_histogram_matches_plain(documents, words):
    texts = [None, *ODD, *[words(i % 40, i) for i in range(60)], words(4000, 9)]
    lengths = tokens.encoded_lengths(documents(list(enumerate(texts))))
    sizes = sorted(len(exact_ids(t)) for t in texts)
    found = {r.length: r for r in tokens.length_histogram(lengths).collect()}
    assert set(found) == set(sizes)
    for length, row in found.items():
        assert row.n_docs == sizes.count(length)
        assert row.docs_at_least == sum(s >= length for s in sizes)
        assert row.tokens_at_least == sum(s for s in sizes if s >= length)
        assert row.truncated_total == sum(min(s, length) for s in sizes)
        assert row.share_up_to == pytest.approx(sum(s <= length for s in sizes) / len(sizes))
    limits = {r.context_limit: r for r in tokens.at_limits(tokens.length_histogram(lengths), [0, 7, 100, 10**6]).collect()}
    for limit, row in limits.items():
        assert (row.fitting_docs, row.truncated_total) == (sum(s <= limit for s in sizes), sum(min(s, limit) for s in sizes))
    assert tokens.length_histogram(tokens.encoded_lengths(documents([]))).count() == 0


def check_pieces(pieces, given, size=2048):
    """Every id lies in one piece, sequences have no gaps; returns ids and padding."""
    by_doc, by_sequence = {}, {}
    for r in pieces:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    total = padding = 0
    for doc_id, text in given:
        ids = np.array([*exact_ids(text), 1], dtype="<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= size
        total += at
        padding += 0 if at & (at - 1) == 0 else size - at
    return total, padding


@pytest.mark.parametrize("stream", [1 << 21, 3000])
def test_packing_is_whole(documents, words, stream):
    given = [(i, words(i * 7 % 300, i) + "." * (i % 3)) for i in range(150)]
    given += [(None, "no id"), (1000, None), (1001, ""), (2000, words(9000, 77)), *[(3000 + i, t) for i, t in enumerate(ODD)]]
    pieces = packing.pack(documents(given), docs_per_block=64, stream=stream).collect()
    total, padding = check_pieces(pieces, given)
    assert padding <= 0.03 * total
    assert packing.pack(documents([])).count() == 0


def test_repeated_documents_are_packed_as_often(documents):
    pieces = packing.pack(documents([(1, "some words here"), (1, "some words here"), (2, "x")])).collect()
    assert len([p for p in pieces if p.doc_id == 1]) == 2


def best_cost(places, costs, rule):
    """The cheapest windows that end at places, by looking at all of them; the last one pads nothing."""
    best = {0: 0.0}
    for j, place in enumerate(places):
        before = [0, *places[:j]]
        is_last = j == len(places) - 1
        best[place] = min(
            (best[p] + (0 if is_last else rule.size - (place - p)) for p in before if p in best and 0 < place - p <= rule.size), default=float("inf")
        ) + costs[j] + rule.per_window
    return best[places[-1]]


@pytest.mark.parametrize("seed", range(8))
def test_windows_are_the_cheapest(seed):
    random = np.random.default_rng(seed)
    rule = packing.PackingCosts(size=64, sentence_cut=3.0, inner_cut=1e9, per_window=5.0)
    places = np.cumsum(random.integers(1, 20, 120)).tolist()
    costs = random.choice([0.0, 3.0], 120).tolist()
    cuts = packing.window_cuts(places, costs, rule)
    price = dict(zip(places, costs))
    cost = sum(rule.size - (b - a) + price[b] + rule.per_window for a, b in zip([0, *cuts[:-1]], cuts))
    cost -= rule.size - (cuts[-1] - (cuts[-2] if len(cuts) > 1 else 0))
    assert cuts[-1] == places[-1] and cost == pytest.approx(best_cost(places, costs, rule))


def der(tag, *parts):
    body = b"".join(parts)
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([0x80 | (size.bit_length() + 7) // 8]) + size.to_bytes((size.bit_length() + 7) // 8, "big")
    return bytes([tag]) + head + body


def fake_rsa():
    numbers = [der(2, b"\x01" + bytes(range(1, 90))) for _ in range(8)]
    return der(0x30, der(2, b"\0"), *numbers)


def test_structural_confirmation():
    import base64
    import json

    key = fake_rsa()
    text = base64.b64encode(key).decode()
    lines = "\n".join(text[i : i + 64] for i in range(0, len(text), 64))
    part = lambda o: base64.urlsafe_b64encode(json.dumps(o).encode()).decode().rstrip("=")
    token = f"{part({'alg': 'HS256'})}.{part({'sub': '1'})}.c2ln"
    assert secret_spans.find_spans(f"a {text} b") == [("key", 2, 2 + len(text))]
    assert ("key", 2, 2 + 2 * len(key)) in secret_spans.find_spans(f"a {key.hex()} b")
    armored = f"-----BEGIN RSA PRIVATE KEY-----\n{lines}\n-----END RSA PRIVATE KEY-----"
    assert secret_spans.find_spans(f"é {armored}") == [("key", 2, 2 + len(armored))]
    assert secret_spans.find_spans(f"x {token}.") [0][0] == "jwt"
    # broken structures are not reported
    assert secret_spans.find_spans("M" + text[1:40] + "B" * 60) == []
    assert secret_spans.find_spans(f"{part({'typ': 'x'})}.{part({'sub': '1'})}.c2ln") == []
    assert not secret_spans.is_private_key(key[:-1]) and not secret_spans.is_private_key(key + b"\0")


def key_forms():
    """Keys by name: DER of several kinds and sizes modulo 3, and the binary form of OpenSSH."""
    algorithm = der(0x30, der(6, bytes([43, 101, 112])))
    field = lambda data: len(data).to_bytes(4, "big") + data
    public = field(b"ssh-ed25519") + field(bytes(range(32)))
    ssh = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(public) + field(bytes(range(136)))
    return {
        "ed25519": der(0x30, der(2, b"\0"), algorithm, der(4, der(4, bytes(range(32))))),
        "p256": der(0x30, der(2, b"\0"), algorithm, der(4, bytes(range(119)))),
        "rsa": fake_rsa(),
        "one": der(0x30, der(2, b"\0"), algorithm, der(4, bytes(range(100)))),
        "two": der(0x30, der(2, b"\0"), algorithm, der(4, bytes(range(101)))),
        "ssh": ssh,
    }


@pytest.mark.parametrize("name", sorted(key_forms()))
def test_keys_in_every_form(name):
    import base64

    data = key_forms()[name]
    text = base64.b64encode(data).decode()
    spans = lambda t: [(a, b) for kind, a, b in secret_spans.find_spans(t) if kind == "key"]
    follow = ["", "\nNAME=value", "\nABCDEFGHIJKLMNOPQRSTUV\n", "\r\nab", "\\nNAME", " x", "\n\n" + "A" * 30, '",']
    for wrap in (len(text), 64):
        pieces = [text[i : i + wrap] for i in range(0, len(text), wrap)]
        for end in ("\n", "\r\n", "\\n", "\\r\\n", "\\\\n", "\n  "):
            body = end.join(pieces)
            for before in ("", "KEY=", "a\n", "{'k': '\\n", "QUJDREVGR0hJSktMTU5PUFFSU1RVVldYWVo\n"):
                for after in follow:
                    assert spans(before + body + after) == [(len(before), len(before) + len(body))], (end, before, after)
            bare = body.rstrip("=")
            assert spans(f"{bare}\nNAME=value") == [(0, len(bare))]
            assert spans(f"{bare}\n{bare}") == [(0, len(bare)), (len(bare) + 1, 2 * len(bare) + 1)]
            armored = f"-----BEGIN PRIVATE KEY-----{end}{body}{end}-----END PRIVATE KEY-----"
            assert spans(f'{{"key": "{armored}{end}"}}') == [(9, 9 + len(armored))]
            twice = base64.b64encode((armored + "\n").encode()).decode()
            assert spans(f"K={twice}\nNAME=value") == [(2, 2 + len(twice))]
    for hexed in (data.hex(), data.hex().upper()):
        assert spans(f"x {hexed} y") == [(2, 2 + len(hexed))]
        lines = "\n".join(hexed[i : i + 60] for i in range(0, len(hexed), 60))
        assert spans(f"{lines}\nabc") == [(0, len(lines))]
    assert spans(text[:-8]) == [] and spans("A" + text) == []


def test_encrypted_armor():
    import base64

    text = base64.b64encode(bytes(range(256)) * 2).decode()
    lines = "\n".join(text[i : i + 64] for i in range(0, len(text), 64))
    head = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123456789ABCDEF0123456789ABCDEF\n\n"
    for label in ("RSA ", "EC "):
        armored = f"-----BEGIN {label}PRIVATE KEY-----\n{head}{lines}\n-----END {label}PRIVATE KEY-----"
        for given in (armored, armored.replace("\n", "\\n")):
            assert ("key", 2, 2 + len(given)) in secret_spans.find_spans(f"a {given} b")
    assert "key" not in {k for k, _, _ in secret_spans.find_spans(f"-----BEGIN PRIVATE KEY-----\n{lines}\n-----END PRIVATE KEY-----")}
    assert secret_spans.find_spans("-----BEGIN PRIVATE KEY-----" * 5000 + "-" * 200_000) == []


def test_plain_kinds(documents):
    text = 'é password = "hunter22" AKIA' + "A" * 16 + " token: abc " + "a1" * 12 + ' SECRET="xyzxyz"'
    spans = secret_spans.find_spans(text)
    assert [(k, text[a:b]) for k, a, b in spans] == [
        ("assign", 'password = "hunter22'),
        ("access", "AKIA" + "A" * 16),
        ("hex", "a1" * 12),
        ("assign", 'SECRET="xyzxyz'),
    ]
    frame = documents([(1, text), (2, None), (3, ""), (None, text), (1, text)])
    assert [len(r.spans) for r in secret_spans.secret_spans(frame).orderBy("doc_id").collect()] == [4, 4, 4, 0, 0]
    redacted = {r.doc_id: r.text for r in secret_spans.redact(frame).collect()}
    assert redacted[1] == 'é [SECRET]" [SECRET] token: abc [SECRET] [SECRET]"' and redacted[2] is None
    assert secret_spans.secret_spans(documents([])).count() == 0
    # a match that fails uses up its text
    assert secret_spans.find_spans("password:token:abcdefgh") == []


def long_texts():
    der = base64.b64encode(bytes([0x30, 0x83, 0x07, 0, 0]) + bytes(40)).decode()[:60]
    return {
        "fronts of tokens": "eyJ" * 333_333,
        "dotted fronts": "eyJh." * 100_000,
        "lines of armor": ("LS0tLS1C" + "A" * 56 + "\n") * 15_000,
        "lines out of step": ("LS0tLS1C" + "A" * 57 + "\n") * 15_000,
        "long lengths": (der + "AAAA\n") * 15_000,
        "escapes": "-----BEGIN PRIVATE KEY-----" + "\\" * 1_000_000 + "-----END PRIVATE KEY-----",
        "armor lines": "-----BEGIN PRIVATE KEY-----\n" * 37_000,
    }


@pytest.mark.parametrize("name", long_texts())
def test_long_texts_take_linear_time(name):
    text = long_texts()[name]
    begun = time.process_time()
    assert secret_spans.find_spans(text) == []
    assert time.process_time() - begun < 10  # quadratic time takes minutes


def test_tokens_among_fronts():
    part = lambda value: base64.urlsafe_b64encode(json.dumps(value).encode()).decode().rstrip("=")
    token = f"{part({'alg': 'HS256'})}.{part({'sub': 'a'})}.c2ln"
    for before, after in (("", ""), ("a.b.c ", "."), ("x.", " eyJ.eyJ"), ("eyJ.", ""), ("\\n", "\\n"), ("www.", "/")):
        spans = secret_spans.find_spans(before + token + after)
        assert ("jwt", len(before), len(before + token)) in spans and len(spans) == 1
    twice = secret_spans.find_spans(token + "\n" + token)
    assert [(start, end) for _, start, end in twice] == [(0, len(token)), (len(token) + 1, 2 * len(token) + 1)]
