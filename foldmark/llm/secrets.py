"""Secrets in texts: keywords by one automaton, anchored patterns at its hits, checksums that tokens carry.

1. One Aho-Corasick automaton of all keywords and token prefixes passes over each text once, in linear time.
2. Only where it hits is a pattern tried, anchored at the hit. The patterns are possessive, so none backtracks.
   Runs of hexadecimal digits have no keyword: texts without a run of 24 are told by Arrow's linear matcher.
3. Tokens with an embedded check are taken only if it holds: a CRC-32 in base 62 at the end (access tokens of code
   hosts and package registries), base58 with a double SHA-256 (wallet import format, extended private keys), bech32
   (age and nostr keys), a header that decodes to JSON with an algorithm (web tokens), a DER length that covers the
   body (private keys in PEM).

Base spans (``assign``, ``access``, ``hex``) stay as they are; a checked span is added unless spans before it, base
ones first, cover all of it.

Defined results: a null or empty text has no spans; a long text is searched whole; repeated rows each give their
row; a null doc_id gives its row; other columns, whatever their names, are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldmark.llm.common import column_or_null, map_arrow

BASE = ("assign", "access", "hex")
Span = tuple[int, int]

_VALUE = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?+\x20*+[:=]\x20*+["']?+([A-Za-z0-9+/_.=-]++)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]++")
_HEX = re.compile(r"[0-9a-f]{24,}+")
_HEX_RUN = "[0-9a-f]{24}"
LEAST_VALUE, LEAST_ACCESS = 6, 20

# fixed values: the alphabets of the formats
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
_BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
_BECH32_STEPS = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)


def crc62(token: str) -> bool:
    """The last six signs are the CRC-32, in base 62, of what lies between the last ``_`` and them."""
    body, check = token[:-6].rpartition("_")[2], token[-6:]
    value = 0
    for sign in check:
        value = value * 62 + _BASE62.index(sign)
    return zlib.crc32(body.encode()) == value


def base58(token: str) -> bool:
    """Base 58 whose last four bytes begin the double SHA-256 of the others."""
    value = 0
    for sign in token:
        value = value * 58 + _BASE58.index(sign)
    raw = value.to_bytes((value.bit_length() + 7) // 8, "big")
    body, check = raw[:-4], raw[-4:]
    return len(raw) > 4 and hashlib.sha256(hashlib.sha256(body).digest()).digest()[:4] == check


def wallet_key(token: str) -> bool:
    """A private key of 32 bytes behind the version byte 128, one more byte where it stands for a compressed point."""
    return token[0] in "5KL" and len(token) == (51 if token[0] == "5" else 52) and base58(token)


def bech32(token: str) -> bool:
    """The checksum polynomial over prefix and data is one; upper or lower case throughout."""
    if token not in (token.lower(), token.upper()):
        return False
    human, _, data = token.lower().rpartition("1")
    values = [ord(c) >> 5 for c in human] + [0] + [ord(c) & 31 for c in human] + [_BECH32.find(c) for c in data]
    if not human or min(values) < 0:
        return False
    check = 1
    for v in values:
        top = check >> 25
        check = (check & 0x1FFFFFF) << 5 ^ v
        for k, step in enumerate(_BECH32_STEPS):
            check ^= step if top >> k & 1 else 0
    return check == 1


def web_token(token: str) -> bool:
    """The first of three parts is a JSON object that names an algorithm, the second one a JSON object, too."""
    try:
        head, body = (json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))) for part in token.split(".")[:2])
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(body, dict) and isinstance(head.get("alg"), str)


def private_key(block: str) -> bool:
    """The body in base 64 is one DER sequence, as long as its own header says."""
    try:
        raw = base64.b64decode("".join(block.split("-----")[2].split()), validate=True)
    except (binascii.Error, ValueError):
        return False
    if len(raw) < 4 or raw[0] != 0x30:
        return False
    if raw[1] < 0x80:
        return len(raw) == raw[1] + 2
    size = raw[1] - 0x80
    return 0 < size <= 4 and len(raw) == int.from_bytes(raw[2 : 2 + size], "big") + 2 + size


#: Kinds with an embedded check: what the automaton looks for, the pattern from there on, the check.
CHECKED: dict[str, tuple[tuple[str, ...], re.Pattern, Callable[[str], bool]]] = {
    "code_host": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"(?<![0-9A-Za-z])gh[pousr]_[0-9A-Za-z]{36}(?![0-9A-Za-z])"), crc62),
    "package_host": (("npm_",), re.compile(r"(?<![0-9A-Za-z])npm_[0-9A-Za-z]{36}(?![0-9A-Za-z])"), crc62),
    "extended_key": (("xprv",), re.compile(rf"(?<![0-9A-Za-z])xprv[{_BASE58}]{{107}}(?![0-9A-Za-z])"), base58),
    "bech32": (("age-secret-key-1", "nsec1"), re.compile(rf"(?<![0-9A-Za-z])(?:AGE-SECRET-KEY-1[{_BECH32.upper()}]{{58}}|nsec1[{_BECH32}]{{58}})(?![0-9A-Za-z])"), bech32),
    "web_token": (("eyj",), re.compile(r"(?<![0-9A-Za-z_-])eyJ[0-9A-Za-z_-]++\.eyJ[0-9A-Za-z_-]++\.[0-9A-Za-z_-]++"), web_token),
    "private_key": (("-----begin ",), re.compile(r"-----BEGIN (?:[A-Z]++ ){0,3}PRIVATE KEY-----[0-9A-Za-z+/=\s]++-----END (?:[A-Z]++ ){0,3}PRIVATE KEY-----"), private_key),
}
KINDS = (*BASE, *CHECKED, "wallet")
#: A wallet key has no prefix to look for: Arrow's matcher tells the texts that may hold one.
_WALLET = re.compile(rf"(?<![0-9A-Za-z])[5KL][{_BASE58}]{{50,51}}(?![0-9A-Za-z])")
_WALLET_RUN = f"[5KL][{_BASE58}]{{50}}"


@lru_cache(1)
def automaton() -> ahocorasick.Automaton:
    """Of all keywords, over lower-cased text; the value is the kind and the keyword's length."""
    found = ahocorasick.Automaton()
    words = {word: "assign" for word in ("password", "passwd", "secret", "token", "apikey", "api_key")} | {"akia": "access"}
    words |= {prefix: kind for kind, (prefixes, _, _) in CHECKED.items() for prefix in prefixes}
    for word, kind in words.items():
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def lowered(text: str) -> str:
    """``text`` with A to Z in lower case and every place as it was."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def find(text: str, digits: bool = True, wallets: bool = True) -> tuple[dict[str, list[Span]], list[tuple[int, int, str]]]:
    """Base spans by kind, and all spans in order of start, then kind as listed.

    ``digits`` and ``wallets`` say whether runs of hexadecimal and base-58 signs may occur at all.
    """
    base: dict[str, list[Span]] = {k: [] for k in BASE}
    added: list[tuple[int, int, str]] = []
    hits = sorted((end - length + 1, kind) for end, (kind, length) in automaton().iter(lowered(text)))
    upto = dict.fromkeys(KINDS, 0)  # where the last match of a kind ended, taken or not
    for start, kind in hits:
        if start < upto[kind]:
            continue
        pattern = _VALUE if kind == "assign" else _ACCESS if kind == "access" else CHECKED[kind][1]
        found = pattern.match(text, start)
        if not found:
            continue
        upto[kind] = found.end()
        if kind == "assign":
            if found.end(1) - found.start(1) >= LEAST_VALUE:
                base[kind].append(found.span())
        elif kind == "access":
            if found.end() - start >= LEAST_ACCESS:
                base[kind].append(found.span())
        elif CHECKED[kind][2](found.group()):
            added.append((start, found.end(), kind))
    if digits:
        base["hex"] = [m.span() for m in _HEX.finditer(text)]
    if wallets:
        added += [(*m.span(), "wallet") for m in _WALLET.finditer(text) if wallet_key(m.group())]
    chosen = [(s, e, k) for k in BASE for s, e in base[k]]
    if added:
        taken = bytearray(len(text))
        for s, e, _ in chosen:
            taken[s:e] = b"\1" * (e - s)
        for s, e, kind in sorted(added, key=lambda c: (c[0] - c[1], c[0], KINDS.index(c[2]))):  # the longest first
            if taken.find(0, s, e) >= 0:
                taken[s:e] = b"\1" * (e - s)
                chosen.append((s, e, kind))
    chosen.sort(key=lambda c: (c[0], KINDS.index(c[2])))
    return base, chosen


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


_SCHEMA = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in BASE), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())])


def find_secrets(docs: DataFrame) -> DataFrame:
    """Spans of secrets in ``docs`` (doc_id, text): counts and digest of base spans, all spans, how many were added."""
    rows = docs.select(column_or_null(docs, "doc_id", T.LongType()).alias("doc_id"), column_or_null(docs, "text", T.StringType()).alias("text"))
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            digits, wallets = (pc.fill_null(pc.match_substring_regex(texts, p), False).to_pylist() for p in (_HEX_RUN, _WALLET_RUN))
            out = []
            for k in range(len(texts)):
                base, spans = find(texts[k].as_py() or "", digits[k], wallets[k])
                flat = [c for c in spans if c[2] in BASE]
                out.append((*(len(base[kind]) for kind in BASE), hashlib.sha256(_joined(flat).encode()).hexdigest() if flat else nothing, _joined(spans), len(spans) - len(flat)))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, f.type) for c, f in zip(columns, list(_SCHEMA)[1:], strict=True))], schema=_SCHEMA)

    return map_arrow(rows, run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long")


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
