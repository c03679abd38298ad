"""Secrets in whole texts: plain patterns, and candidates confirmed by their structure.

Plain kinds: ``assign`` (a name of a secret and its value), ``access`` (access key ids)
and ``hex`` (long hex runs).  Confirmed kinds are reported only when the candidate
decodes and its parts agree:

* ``jwt``: three base64url parts, the first a JSON object that names an algorithm, the
  second a JSON object.
* ``key``: base64 or hex of a private key: DER whose nested lengths fill their parents exactly and
  whose fields are those of an RSA, EC, PKCS#8 or encrypted PKCS#8 key, or the binary form of
  OpenSSH with its length-prefixed fields; between armor lines (then the span holds the
  armor) or bare, or base64 of an armored key.  Line ends may be written as \\n and \\r; a bare key ends
  where its own lengths say, whatever follows it.

Null text has no spans; empty tables give no rows; rows are judged one by one, so
repeated rows give repeated results, and extra columns of any name are not looked at.  Texts of any length are read
whole, in time and memory that grow with their length: of a candidate only the bytes that tell its structure are
decoded, and a stretch of letters is put together once for all candidates in it.
"""

from __future__ import annotations

import json
import re
from base64 import b64decode
from binascii import Error as Base64Error
from binascii import unhexlify
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinary.llm.slices import small_batches

PLAIN_KINDS = ("assign", "access", "hex")
KINDS = (*PLAIN_KINDS, "jwt", "key")
SPANS = "array<struct<kind:string,start:int,end:int>>"

# fixed patterns
_ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
_ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
# looked for at the front of every run of letters only, so that no run is read again from its middle
_JWT = re.compile(r"(?<![A-Za-z0-9_-])(?=([A-Za-z0-9_-]++)\.([A-Za-z0-9_-]++)\.([A-Za-z0-9_-]*+))")
# the body ends at the next armor line
_ARMOR = re.compile(
    r"-----BEGIN ([A-Z0-9 ]*)PRIVATE KEY-----([^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+)*+)-----END \1PRIVATE KEY-----"
)
# a DER sequence, an OpenSSH key and an armor line begin like this in base64 and in hex; in escaped text a letter of
# the escape may stand before it
_FRONT = r"(?:(?<![A-Za-z0-9+/_-])|(?<=\\[nrt]))"
_BASE64 = re.compile(_FRONT + r"(?:M[A-P]|b3BlbnNza|LS0tLS1C)[A-Za-z0-9+/_-]{38}")
_HEX_KEY = re.compile(r"(?<![0-9A-Fa-f])(?:30[0-9A-Fa-f]{28}|6[Ff]70656[Ee]7373682[Dd]6[Bb]65792[Dd]7631)[0-9A-Fa-f]{10}")
_BASE64_RUN, _HEX_RUN = re.compile(r"[A-Za-z0-9+/_-]+"), re.compile(r"[0-9A-Fa-f]+")
_ESCAPED_END = re.compile(r"(?<!\\)\\++[nr]")
_LINE_END = re.compile(r"[ \t]*(?:\r\n|\r|\n|\\+r\\+n|\\+[rn])[ \t]*")


def _base64(text: str) -> bytes | None:
    """Bytes of standard or url-safe base64 with or without padding; None if it is neither."""
    body = re.sub(r"\s", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (Base64Error, ValueError):
        return None


# the bytes of a candidate from one place to another, fewer at its end
Bytes = Callable[[int, int], bytes]


def _number(data: Bytes, at: int) -> int | None:
    """The four-byte number at ``at``."""
    found = data(at, at + 4)
    return int.from_bytes(found, "big") if len(found) == 4 else None


def _der(data: Bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the value of the element at ``at``; None unless it lies within ``end``."""
    front = data(at, min(at + 6, end))
    if len(front) < 2:
        return None
    tag, length, start = front[0], front[1], at + 2
    if length & 0x80:
        width = length & 0x7F
        if not 1 <= width <= 4 or len(front) < 2 + width:
            return None
        length = int.from_bytes(front[2 : 2 + width], "big")
        if length < 0x80 or length < 1 << (8 * (width - 1)):
            return None  # not the shortest form
        start += width
    return (tag, start, start + length) if start + length <= end else None


def _children(data: Bytes, start: int, end: int, most: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill start to end exactly; None if there are more than ``most``."""
    found = []
    while start < end:
        element = _der(data, start, end) if len(found) < most else None
        if element is None:
            return None
        found.append(element)
        start = element[2]
    return found


_SEQUENCE, _INTEGER, _OCTETS, _OBJECT, _CONTEXT0, _CONTEXT1 = 0x30, 0x02, 0x04, 0x06, 0xA0, 0xA1
_OPENSSH = b"openssh-key-v1\0"
# how many parts the formats have at most: an RSA key with further primes, and the name of an algorithm with its parameters
_KEY_PARTS, _ALGORITHM_PARTS = 10, 2


def _openssh_keys(data: Bytes) -> tuple[int, int] | None:
    """(number of keys, where the first one's field is) of an OpenSSH key; None if a field before says there is none."""
    at = len(_OPENSSH)
    for _ in range(3):  # cipher, key derivation, its options
        length = _number(data, at)
        if length is None:
            return None
        at += 4 + length
    keys = _number(data, at)
    return None if keys is None or not 0 < keys < 16 else (keys, at + 4)


def _openssh_size(data: Bytes) -> int | None:
    """The size of an OpenSSH key by its length-prefixed fields."""
    found = _openssh_keys(data)
    if found is None:
        return None
    keys, at = found
    for _ in range(keys + 1):  # the public keys, then one part with the private ones
        length = _number(data, at)
        if length is None:
            return None
        at += 4 + length
    return at


def _is_der_key(data: Bytes, size: int) -> bool:
    """Whether ``size`` bytes are a private key in DER; only the fronts of its elements are read."""
    outer = _der(data, 0, size)
    if outer is None or outer[0] != _SEQUENCE or outer[2] != size:
        return False
    parts = _children(data, outer[1], outer[2], _KEY_PARTS)
    if not parts or len(parts) < 2:
        return False
    tags = [tag for tag, _, _ in parts]
    lengths = [end - start for _, start, end in parts]

    def is_algorithm(part: int) -> bool:
        names = _children(data, parts[part][1], parts[part][2], _ALGORITHM_PARTS)
        return bool(names) and names[0][0] == _OBJECT

    if tags[0] == _INTEGER and lengths[0] == 1:
        version = data(parts[0][1], parts[0][2])[0]
        if version in (0, 1) and len(tags) >= 9 and all(tag == _INTEGER for tag in tags[:9]):
            return lengths[1] >= 32  # RSA: modulus, exponents, primes
        if version == 1 and tags[1] == _OCTETS and lengths[1] >= 16 and set(tags[2:]) <= {_CONTEXT0, _CONTEXT1}:
            return True  # EC
        if version in (0, 1) and len(tags) >= 3 and tags[1] == _SEQUENCE and tags[2] == _OCTETS:
            return is_algorithm(1)  # PKCS#8
        return version == 0 and len(tags) == 6 and all(tag == _INTEGER for tag in tags) and lengths[1] >= 32  # DSA
    if tags == [_SEQUENCE, _OCTETS]:
        return is_algorithm(0) and lengths[1] >= 32  # encrypted PKCS#8
    return False


def is_private_key(data: bytes) -> bool:
    """Whether bytes are a private key by their structure."""

    def read(start: int, end: int) -> bytes:
        return data[start:end]

    if data.startswith(_OPENSSH):
        found = _openssh_keys(read)
        return found is not None and found[1] < len(data)
    return _is_der_key(read, len(data))


def _is_key_text(body: str) -> bool:
    # the old encrypted form has header lines in front of the body
    lines = _ESCAPED_END.sub("\n", body).splitlines()
    header = [line for line in lines if ":" in line]
    data = _base64("".join(line for line in lines if ":" not in line))
    is_encrypted = any("ENCRYPTED" in line for line in header)
    return data is not None and (is_private_key(data) or is_encrypted and len(data) >= 64 and len(data) % 8 == 0)


class _Stretch:
    """Letters of a text over line ends, from one place on, and where they stand."""

    def __init__(self, text: str, at: int, letters: re.Pattern[str]):
        parts, self.starts, self.firsts, count = [], [], [], 0
        self.end = at
        while match := letters.match(text, at):
            parts.append(match[0])
            self.starts.append(at)
            self.firsts.append(count)
            count += len(match[0])
            self.end = match.end()
            gap = _LINE_END.match(text, self.end)
            if gap is None:
                break
            at = gap.end()
        self.letters = "".join(parts)
        self.is_hex = letters is _HEX_RUN
        self._armors: dict[int, list[tuple[int, int]]] = {}

    def number(self, at: int) -> int | None:
        """The number of the letter that stands at ``at`` in the text."""
        part = bisect_right(self.starts, at) - 1
        if part < 0:
            return None
        number = self.firsts[part] + at - self.starts[part]
        end = self.firsts[part + 1] if part + 1 < len(self.firsts) else len(self.letters)
        return number if number < end else None

    def place_after(self, number: int) -> int:
        """Where in the text the first ``number`` letters end."""
        part = bisect_right(self.firsts, number - 1) - 1
        return self.starts[part] + number - self.firsts[part]

    def bytes_from(self, first: int) -> Bytes:
        """Reads of the bytes that the letters from ``first`` on hold."""

        def read(start: int, end: int) -> bytes:
            if self.is_hex:
                found = self.letters[first + 2 * start : first + 2 * end]
                return unhexlify(found[: len(found) // 2 * 2])
            found = self.letters[first + start // 3 * 4 : first + -(-end // 3) * 4]
            return (_base64(found[: -1 if len(found) % 4 == 1 else None]) or b"")[start % 3 :][: max(0, end - start)]

        return read

    def armors(self, shift: int) -> list[tuple[int, int]]:
        """(start, end) of armored keys in the bytes that the letters from ``shift``, 0 to 3, on hold."""
        if shift not in self._armors:
            decoded = self.bytes_from(shift)(0, len(self.letters)).decode("latin-1")
            self._armors[shift] = [m.span() for m in _ARMOR.finditer(decoded) if _is_key_text(m[2])]
        return self._armors[shift]


def _key_end(text: str, stretch: _Stretch, at: int) -> int | None:
    """Where the key ends that begins at ``at``: its own lengths say it, whatever follows."""
    first = stretch.number(at)
    if first is None:
        return None
    data, left = stretch.bytes_from(first), len(stretch.letters) - first
    if data(0, len(_OPENSSH)) == _OPENSSH:
        size = _openssh_size(data)
    else:
        outer = _der(data, 0, left)
        size = outer[2] if outer else None
    if size is None or size < 24:
        return None
    count = 2 * size if stretch.is_hex else (4 * size + 2) // 3
    if count > left or data(0, len(_OPENSSH)) != _OPENSSH and not _is_der_key(data, size):
        return None
    end = stretch.place_after(first + count)
    padding = 0 if stretch.is_hex else -count % 4
    while padding and text.startswith("=", end):
        end, padding = end + 1, padding - 1
    return end


def _armored_end(text: str, stretch: _Stretch, at: int) -> int | None:
    """Where the base64 ends that holds an armored key, with what stands behind the key in its line."""
    first = stretch.number(at)
    if first is None:
        return None
    armors = stretch.armors(first % 4)
    if not armors or armors[-1][0] < first // 4 * 3:
        return None
    end = stretch.place_after(first % 4 + (4 * armors[-1][1] + 2) // 3)
    rest = _BASE64_RUN.match(text, end)
    end = rest.end() if rest else end
    return end + len(text[end : end + 2]) - len(text[end : end + 2].lstrip("="))


def _keys(text: str, front: re.Pattern[str], letters: re.Pattern[str]) -> Iterator[tuple[int, int]]:
    stretch = None
    at = 0
    while match := front.search(text, at):
        start = match.start()
        if stretch is None or start >= stretch.end:
            stretch = _Stretch(text, start, letters)
        ends = _armored_end if text.startswith("LS0t", start) else _key_end
        end = ends(text, stretch, start)
        if end is None:
            at = start + 1
            continue
        while end is not None:  # another key may follow at once
            yield start, end
            start = at = end
            if start >= stretch.end:
                stretch = _Stretch(text, start, letters)
            end = _key_end(text, stretch, start)


def _tokens(text: str) -> Iterator[tuple[int, int]]:
    reached = 0
    for match in _JWT.finditer(text):
        first = match[1].find("eyJ")
        start = match.start(1) + first
        if first < 0 or len(match[1]) < first + 4 or start < reached:
            continue
        if _is_object(match[1][first:], "alg") and _is_object(match[2]):
            reached = match.end(3)
            yield start, reached


def _is_object(part: str, key: str | None = None) -> bool:
    data = _base64(part)
    try:
        value = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return False
    return isinstance(value, dict) and (key is None or isinstance(value.get(key), str))


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every secret, by start and then kind; code points, end exclusive."""
    spans = []
    lowered = text.lower()
    if any(name in lowered for name in _ASSIGN_NAMES):
        spans += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
    if "eyJ" in text:
        spans += [("jwt", *span) for span in _tokens(text)]
    keys = []
    if "PRIVATE KEY-----" in text:
        keys += [m.span() for m in _ARMOR.finditer(text) if _is_key_text(m[2])]
    keys += _keys(text, _BASE64, _BASE64_RUN)
    keys += _keys(text, _HEX_KEY, _HEX_RUN)
    reached = -1
    for start, end in sorted(keys, key=lambda span: (span[0], -span[1])):
        if start >= reached:  # what stands inside an armored key is that key
            spans.append(("key", start, end))
            reached = end
    return sorted(spans, key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


def secret_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row."""

    def scanned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in small_batches(batches):
            found = [
                [{"kind": kind, "start": start, "end": end} for kind, start, end in find_spans(text or "")]
                for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "spans"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(scanned, f"doc_id bigint, spans {SPANS}")


def spans_text(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every secret replaced by a mark; spans that overlap become one. Null text stays null."""

    def redacted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            at = batch.schema.get_field_index("text")
            texts = [None if text is None else _redacted(text) for text in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    def _redacted(text: str) -> str:
        parts, reached = [], 0
        for start, end in sorted((start, end) for _, start, end in find_spans(text)):
            if start >= reached:
                parts += [text[reached:start], mark]
            reached = max(reached, end)
        return "".join(parts) + text[reached:] if parts else text

    return docs.mapInArrow(redacted, docs.schema)
