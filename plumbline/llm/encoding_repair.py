"""Garbled text from a wrong character encoding: find it and restore it.

A best-first search runs over the texts that can be reached from the given one by three kinds of steps: encode with the
charset that was wrongly used and decode as UTF-8, encode with one charset and decode with another, or resolve escapes.
States are kept by their hash in a visited set; the frontier is ordered by a character-plausibility cost plus the price
of the steps taken, and the cheapest text that was reached is the restoration.

The search works on *pieces*: maximal runs without plain blanks that hold anything but plain ASCII. Damage is local, so a
text is the concatenation of independently searched pieces, and the same few pieces come back over and over. A piece's
result depends on nothing but the piece; a bounded memo in each worker therefore changes no result.

Defined cases: null, empty and pure-ASCII texts without escapes are never affected and are returned as they are; texts
of any length are processed whole; a replacement character marks a text as affected even though it cannot be restored.
"""

from __future__ import annotations

import heapq
import html
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The charsets that are tried, the likelier ones first.
WRONG_CHARSETS = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "iso8859_15", "koi8_r")
SINGLE_BYTE_SWAPS = (("cp437", "cp1252"), ("cp850", "cp1252"), ("mac_roman", "cp1252"), ("cp1252", "cp850"), ("cp1252", "mac_roman"))

STEP_PRICE_UTF8 = 0.5
STEP_PRICE_SWAP = 1.6
STEP_PRICE_ESCAPE = 0.5
STEP_PRICE_CASE = 0.4
MIN_GAIN = 0.1
MAX_STATES = 400
MEMO_PIECES = 200_000

_BLANK = r" \t\r\n -  　"
_TOKEN = re.compile(rf"[^{_BLANK}]+")
_ODD = re.compile(r"[^\x00-\x7f]|&#?\w{2,8};|\\u[0-9a-fA-F]{4}")
_LONG_PLAIN = re.compile(r"[^&\\\x80-\U0010ffff]{32,}")  # cuts long tokens; no damage reaches across so much plain text
LONG_TOKEN = 256
_UTF8 = re.compile("[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}")
_ESCAPE = re.compile(r"&#?\w{2,8};|\\u[0-9a-fA-F]{4}")
_OUTSIDE = "Ā"  # stands for a character that the charset lacks; not a byte, so it ends every sequence

#: JVM-side screen: whatever could be affected holds a non-ASCII character or an escape.
SCREEN = r"[^\x00-\x7F]|&#?\w{2,8};|\\u[0-9a-fA-F]{4}"
#: Pieces of nothing but ASCII, full-width and invisible characters: no step applies to them.
_PLAIN = re.compile("[\\x00-\\x7f\\uff00-\\uffef\\u200b-\\u200f\\u2060\\ufeff\\xad]*")


def _charset(name: str) -> dict[int, str]:
    """Character to byte (as a character below U+0100) for the upper half; bytes a charset leaves open stay themselves."""
    table = {}
    for b in range(0x80, 0x100):
        try:
            table[ord(bytes([b]).decode(name))] = chr(b)
        except UnicodeDecodeError:
            table[b] = chr(b)
    return table


class _ToBytes(dict):
    def __missing__(self, code: int) -> str:
        return chr(code) if code < 0x80 else _OUTSIDE


_TO_BYTES = {name: _ToBytes(_charset(name)) for name in {*WRONG_CHARSETS, *(a for a, _ in SINGLE_BYTE_SWAPS)}}
#: The marks that are written as characters of their own in decomposed Western text.
_USUAL_MARKS = "\u0300\u0301\u0302\u0303\u0304\u0306\u0307\u0308\u030a\u030b\u030c\u0327\u0328"
_DECODE_ERRORS = "replace"


@lru_cache(maxsize=4096)
def _char(c: str) -> tuple[float, str]:
    """Plausibility cost of a character and its class: a script for letters, else 'sym', 'sp', 'ctl' or 'mark'."""
    o = ord(c)
    if o < 0x80:
        return 0.0, "LATIN" if c.isalpha() else ("dig" if c.isdigit() else "sp")
    kind = unicodedata.category(c)
    if c == "�":
        return 4.0, "ctl"
    if 0x80 <= o < 0xA0 or kind in ("Co", "Cn", "Cs"):
        return 3.0, "ctl"
    if kind[0] == "L":
        if c in "ªº":
            return 0.9, "sym"
        script = unicodedata.name(c, "?").split(" ")[0]
        return (0.5 if script == "LATIN" else 0.35), script
    if kind == "Mn":
        return (0.3 if o < 0x340 and c in _USUAL_MARKS else 1.5), "mark"
    if kind in ("Cf", "Zs", "Zl", "Zp"):
        return 0.2, "sp"
    if c in "°±×½¼¾²³µ§£€®©™“”‘’–—…•":
        return 0.6, "sym"
    if 0x2500 <= o < 0x25A0 or kind in ("Sm", "Sk"):
        return 1.6, "sym"
    if 0xFF00 <= o < 0xFFF0:
        return 0.2, "sp"
    return 0.9, "sym"


def plausibility_cost(text: str) -> float:
    """Low for text as people write it; rises with odd characters and with odd neighbours."""
    cost, before, was = 1.5 * len(_ESCAPE.findall(text)), "sp", " "
    for c in text:
        own, kind = _char(c)
        cost += own
        if kind not in ("mark",):
            if before not in ("sp", "dig", "sym", "ctl", "mark") and kind == "sym" and ord(c) > 0x7F and ord(was) > 0x7F:
                cost += 0.8
            elif before == "sym" and ord(was) > 0x7F and kind not in ("sp", "dig", "sym", "ctl"):
                cost += 0.5
            elif kind not in ("sp", "dig", "sym", "ctl") and before not in ("sp", "dig", "sym", "ctl", "mark") and kind != before:
                cost += 1.2
            elif kind == before == "LATIN" and c > "\x7f" and was > "\x7f":
                cost += 0.4
            elif was.islower() and c.isupper() and (ord(c) > 0x7F or ord(was) > 0x7F):
                cost += 0.8
            before, was = kind, c
    return cost


def _steps(text: str) -> Iterator[tuple[float, str, str]]:
    """Every text one operation away, with the operation's price and name."""
    if _ESCAPE.search(text):
        yield STEP_PRICE_ESCAPE, "unescape", re.sub(r"\\u([0-9a-fA-F]{4})", lambda m: chr(int(m[1], 16)), html.unescape(text))
    if text.isascii():
        return
    for name in WRONG_CHARSETS:
        raw = text.translate(_TO_BYTES[name])
        if _UTF8.search(raw):
            out, at = [], 0
            for m in _UTF8.finditer(raw):
                out += [text[at : m.start()], m[0].encode("latin-1").decode("utf-8")]
                at = m.end()
            yield STEP_PRICE_UTF8, f"{name}>utf-8", "".join(out) + text[at:]
    for case in (str.upper, str.lower):  # garbled first, put into another case afterwards
        other = "".join(case(c) if "\x7f" < c < "\u0250" and len(case(c)) == 1 else c for c in text)
        if other != text:
            yield STEP_PRICE_CASE, case.__name__, other
    for wrong, right in SINGLE_BYTE_SWAPS:
        raw = text.translate(_TO_BYTES[wrong])
        if _OUTSIDE not in raw:
            yield STEP_PRICE_SWAP, f"{wrong}>{right}", raw.encode("latin-1").decode(right, _DECODE_ERRORS)


@lru_cache(maxsize=MEMO_PIECES)
def search(piece: str) -> tuple[str, str]:
    """The cheapest text reachable from a piece and the operations that lead there ('' if the piece itself is cheapest)."""
    start = plausibility_cost(piece)
    best, best_cost, best_path = piece, start, ""
    frontier, visited, serial = [(start, 0, 0.0, piece, "")], {hash(piece)}, 0
    while frontier and serial < MAX_STATES:
        _, _, paid, text, path = heapq.heappop(frontier)
        for price, name, after in _steps(text):
            if paid + price >= best_cost or (path and name in ("upper", "lower")):
                continue  # no text costs less than nothing
            key = hash(after)
            if key in visited:
                continue
            visited.add(key)
            serial += 1
            cost = plausibility_cost(after)
            total = cost + paid + price
            if name in ("upper", "lower"):
                total += 0.01  # only a way to a decoding, never a restoration
            elif total < best_cost - (MIN_GAIN if best_path == "" else 1e-9):
                best, best_cost, best_path = after, total, f"{path} {name}".strip()
            if total < start + 2:
                heapq.heappush(frontier, (total, serial, paid + price, after, f"{path} {name}".strip()))
    return best, best_path


def pieces(text: str) -> Iterator[tuple[int, int]]:
    """Places of the stretches that are searched on their own, in linear time whatever the text."""
    for token in _TOKEN.finditer(text):
        at, end = token.span()
        cuts = [m.span() for m in _LONG_PLAIN.finditer(text, at, end)] if end - at > LONG_TOKEN else []
        for a, b in zip([at, *(y for _, y in cuts)], [*(x for x, _ in cuts), end]):
            if a < b and _ODD.search(text, a, b):
                yield a, b


def repair(text: str | None) -> tuple[bool, str | None, str | None]:
    """(affected, restored text, operations). The restored text is null where an affected text cannot be fully restored."""
    if text is None:
        return False, None, None
    out, at, paths = [], 0, []
    for a, b in pieces(text):
        piece = text[a:b]
        if _PLAIN.fullmatch(piece) and not _ESCAPE.search(piece):
            continue
        after, path = search(piece)
        if path:
            out += [text[at:a], after]
            at = b
            paths.append(path)
    lost = "�" in text
    if not paths and not lost:
        return False, text, None
    whole = "".join(out) + text[at:]
    return True, (None if "�" in whole else whole), "; ".join(dict.fromkeys(paths)) or "lost"


_RESULT = T.StructType([T.StructField("affected", T.BooleanType()), T.StructField("restored", T.StringType()), T.StructField("operations", T.StringType())])


@F.pandas_udf(_RESULT)
def _repair_udf(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([repair(t) for t in texts], columns=["affected", "restored", "operations"])


def find_garbled(df: DataFrame, key: str, text: str) -> DataFrame:
    """Affected rows as (key, original, restored, operations); restored is null where characters were lost for good.

    One narrow scan of two columns without a shuffle. Texts that cannot be affected never leave the JVM.
    """
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("original")).where(F.col("original").rlike(SCREEN))
    return rows.withColumn("r", _repair_udf("original")).where("r.affected").select(F.col("key").alias(key), "original", "r.restored", "r.operations")
