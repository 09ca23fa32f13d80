"""Problem 10: text garbled by a wrong character encoding.

Method: round-trip repair. Stretches of a text are re-encoded under a candidate legacy encoding and decoded strictly
as the intended one; a stretch is replaced where that succeeds and its garbling cost drops, and the whole is repeated
for nested layers until nothing gets cheaper. What can't be turned back (replacement characters, bytes lost on the way) still marks a text.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .base import map_batches

#: Encodings of one byte a character under which UTF-8 is misread. Undefined bytes stay as control characters.
SINGLE = ("cp1252", "latin-1", "cp437", "cp850", "mac_roman", "cp1250", "cp1251", "koi8_r", "cp866")
#: Misread by itself a Cyrillic page gives letters, so a lone pair proves nothing there.
_NEEDS_TWO = {"cp1251", "koi8_r", "cp866", "cp1250"}


def _byte_chars(name: str) -> list[str]:
    out = []
    for i in range(256):
        try:
            out.append(bytes([i]).decode(name))
        except UnicodeDecodeError:
            out.append(chr(i))
    return out


@lru_cache(maxsize=None)
def _single(name: str) -> tuple[re.Pattern, dict[int, int]]:
    """Pattern of stretches that hold UTF-8 sequences as characters of the encoding, and its map to byte values."""
    chars = _byte_chars(name)

    def cls(a: int, b: int) -> str:
        return "[" + "".join(re.escape(chars[i]) for i in range(a, b)) + "]"

    # a non-breaking space may have become a plain one
    cont = cls(0x80, 0xC0)
    seq = f"(?:{cls(0xC2, 0xE0)}{cont}|{cls(0xE0, 0xF0)}{cont}{{2}}|{cls(0xF0, 0xF5)}{cont}{{3}})"
    low = 2 if name in _NEEDS_TWO else 1
    return re.compile(f"{seq}{{{low},}}"), {ord(c): i for i, c in reversed(list(enumerate(chars)))}


def _weight(c: str) -> float:
    o = ord(c)
    if o < 0x80:
        return 0.0
    if o < 0xA0 or o == 0xFFFD or 0xE000 <= o < 0xF900:
        return 5.0
    if 0x4E00 <= o < 0xA000:
        try:
            b = c.encode("gb2312")
        except UnicodeEncodeError:
            return 3.0
        return 1.0 if b[0] < 0xD8 else 2.5
    if 0x410 <= o < 0x450 or o in (0x401, 0x451):
        return 0.8
    if c in "ÃÂÐÑâ€™":
        return 1.6
    if 0xC0 <= o < 0x100:
        return 1.0
    if o < 0xC0 or 0x2010 <= o < 0x2027 or 0x3000 <= o < 0x3003 or 0xFF01 <= o < 0xFF5F or 0x3008 <= o < 0x3012:
        return 1.3
    if 0x3040 <= o < 0x3100 or 0x2190 <= o < 0x2800 or 0x1F000 <= o < 0x30000 or 0x20AC <= o < 0x2190 or 0x391 <= o < 0x3CA:
        return 2.0
    if 0x300 <= o < 0x370 or o in (0x152, 0x153, 0x160, 0x161, 0x178, 0x17D, 0x17E, 0xFE0F, 0x200D):
        return 2.0
    return 4.0


_weights: dict[str, float] = {}


def cost(text: str) -> float:
    """Garbling cost: high for characters that misreading yields and for rare ones."""
    total = 0.0
    for c in text:
        if c >= "\x80":
            if (w := _weights.get(c)) is None:
                w = _weights[c] = _weight(c)
            total += w
    return total


def _cheaper(old: str, new: str) -> str:
    return new if cost(new) < cost(old) - 0.25 else old


def _fix_single(text: str, name: str) -> str:
    """UTF-8 that was read as a one-byte encoding."""
    pattern, back = _single(name)

    def one(m: re.Match) -> str:
        try:
            return _cheaper(m.group(), bytes(back[ord(c)] for c in m.group()).decode("utf-8"))
        except (UnicodeDecodeError, ValueError):
            return m.group()

    return pattern.sub(one, text)


_WIDE_RUN = re.compile("[^\x00-\x7f\ufffd]+")
_UTF8_RUN = re.compile(
    rb"(?:[\xc3-\xdf][\x80-\xbf]|[\xe2-\xe9\xef][\x80-\xbf]{2}|\xf0[\x90-\xbf][\x80-\xbf]{2})+"
)


def _fix_double(text: str, name: str) -> str:
    """UTF-8 that was read as a two-byte encoding (GBK, Big5): runs whose bytes are mostly valid UTF-8."""
    lone: list[bool] = []  # whether the text hardly has ideographs, looked up once

    def one(m: re.Match) -> str:
        run = m.group()
        try:
            raw = run.encode("gb18030" if name == "gbk" else name)
        except UnicodeEncodeError:
            return run
        if len(run) <= 2:
            a, b = text[m.start() - 1 : m.start()], text[m.end() : m.end() + 1]
            if not (a.isascii() and a.isalnum() or b.isascii() and b.isalnum()):
                if not lone:
                    lone.append(_lone(text))
                if not lone[0]:
                    return run
            try:
                new = raw.decode("utf-8")
            except UnicodeDecodeError:
                return run
            return new if all("\xa0" <= c < "Ā" or "‐" <= c <= "™" for c in new) else run
        spans = [(s.start(), s.end()) for s in _UTF8_RUN.finditer(raw)]
        if sum(e - s for s, e in spans) < 0.75 * len(raw):
            return run
        out, at = [], 0
        for s, e in spans:
            out.append(raw[at:s].decode("gb18030" if name == "gbk" else name, "replace"))
            out.append(raw[s:e].decode("utf-8"))
            at = e
        out.append(raw[at:].decode("gb18030" if name == "gbk" else name, "replace"))
        return _cheaper(run, "".join(out))

    return _WIDE_RUN.sub(one, text)


def _lone(text: str) -> bool:
    """Whether the text has Latin letters but hardly any run of ideographs, so that a lone one is odd."""
    return not _CJK_RUN.search(text)


_CJK_RUN = re.compile(r"[一-龥]{4}")
_LATIN_RUN = re.compile(r"(?:[\x80-\xffŒœŠšŸŽžƒˆ˜–—‘’‚“”„†‡•…‰‹›€™][\x40-\x7e\x80-\xffŒœŠšŸŽžƒˆ˜–—‘’‚“”„†‡•…‰‹›€™]?)+")
_LATIN_PHRASE = re.compile(r"[\xa8\xb8\xc0-\xff](?:[\xa8\xb8\xc0-\xff -]*[\xa8\xb8\xc0-\xff])?")
_HIGH = re.compile(r"[\x80-\xffŒœŠšŸŽžƒˆ˜–—‘’‚“”„†‡•…‰‹›€™]{3,}")


def _fix_latin(text: str, intended: str) -> str:
    """GBK, Big5 or a Cyrillic page that was read as Windows-1252 or Latin-1."""
    back = _single("cp1252")[1]

    def one(m: re.Match) -> str:
        run = m.group()
        high = sum(c >= "\x80" for c in run)
        if high < 4 or not _HIGH.search(run):
            return run
        try:
            new = bytes(back[ord(c)] for c in run).decode(intended)
        except (UnicodeDecodeError, KeyError):
            if intended != "gbk":
                return run
            # an odd byte at the end belongs to what follows
            try:
                new = bytes(back[ord(c)] for c in run[:-1]).decode(intended) + run[-1]
            except (UnicodeDecodeError, KeyError):
                return run
        if intended != "gbk" and sum("а" <= c <= "я" or c == "ё" for c in new) < 0.6 * high:
            return run
        return _cheaper(run, new)

    return (_LATIN_RUN if intended in ("gbk", "big5") else _LATIN_PHRASE).sub(one, text)


#: Russian letters from the most to the least frequent (fixed value).
_RUSSIAN = "оеаинтсрвлкмдпуяыьгзбчйхжшюцщэфъё"
_RANK = {c: i for i, c in enumerate(_RUSSIAN)}
_PHRASE = re.compile(r"[А-яЁё](?:[А-яЁё -]*[А-яЁё])?")


def _rarity(phrase: str) -> float:
    """Mean rank of the letters by frequency, with a charge for capitals inside words."""
    letters = [c for c in phrase if c not in " -"]
    odd = sum(b.isupper() for a, b in zip(phrase, phrase[1:], strict=False) if a not in " -" and b not in " -")
    return (sum(_RANK.get(c, 33) for c in phrase.lower() if c not in " -") + 4 * odd) / len(letters)


#: Two neighbours that CP866 or ISO-8859-5 read as another Cyrillic page gives, letter beside sign.
_BESIDE = re.compile("[А-яЁё][\xa1-\xaa\xac-\xba\xbc-\xbfЂ-Џђ-џҐґ─-╬■∙√≈≤≥⌠⌡÷]")
#: Letters of a misread phrase that another page shows as letters too, at least, and its different letters.
_LETTERS, _DIFFERENT = 0.1, 4


@lru_cache(maxsize=None)
def _page(read_as: str, intended: str) -> tuple[re.Pattern, dict[int, int]]:
    """Pattern of phrases of one Cyrillic page as another shows them, and the map back to byte values."""
    chars = _byte_chars(read_as)
    letters = "".join(re.escape(chars[ord_]) for ord_ in (c.encode(intended)[0] for c in _RUSSIAN + _RUSSIAN.upper()))
    return re.compile(f"[{letters}](?:[{letters} -]*[{letters}])?"), {ord(c): i for i, c in reversed(list(enumerate(chars)))}


def _fix_page(text: str, read_as: str, intended: str) -> str:
    """CP866 or ISO-8859-5 read as another page: phrases that become running Russian text in small letters."""
    pattern, back = _page(read_as, intended)

    def one(m: re.Match) -> str:
        run = m.group()
        old = [c for c in run if c not in " -"]
        if len(old) < 5 or sum(c.isalpha() for c in old) < _LETTERS * len(old):
            return run
        new = bytes(back[ord(c)] for c in run).decode(intended)
        got = [c for c in new if c not in " -"]
        if len(set(got)) < _DIFFERENT or sum(c.islower() for c in got) < 0.6 * len(got):
            return run
        return new if _rarity(new) < _rarity(run) - 5 and _rarity(new) < 13 else run

    return pattern.sub(one, text)


def _fix_cyrillic(text: str, read_as: str, intended: str) -> str:
    """One Cyrillic page read as another: phrases whose letters become much more frequent ones of running text."""

    def one(m: re.Match) -> str:
        run = m.group()
        if len(run) < 5:
            return run
        try:
            new = run.encode(read_as).decode(intended)
        except UnicodeError:
            return run
        return new if _PHRASE.fullmatch(new) and _rarity(new) < _rarity(run) - 5 else run

    return _PHRASE.sub(one, text)


#: Upper case inside a Cyrillic phrase, as a page misread as another shows it.
_UPSIDE = re.compile("[а-яё][А-ЯЁ]|[А-ЯЁ]{4}")
#: Two neighbours of which no plain text but a misread one has many: what single-byte repair looks at.
_PAIR = re.compile("[\x80-\u024f\u0391-\u03c9\u2010-\u25ff\ufb01]{2}|[А-яЁё][^\x00-\x7fА-яЁё。，：、（）；！？“”\u4e00-\u9fa5]|[Р-Я][Ё-Џё-ў]")
#: What only a wrong decoding leaves: the replacement character, a private-use character beside an ideograph, a control
#: character beside a sign of another page or inside the four bytes of a GB18030 character.
_LEFT = re.compile("\ufffd|(?<=[一-鿿])[\ue000-\uf8ff]|[\ue000-\uf8ff](?=[一-鿿])|[\x80-\x84\x86-\x9f](?=[^\x00-\x7f])|(?<=[^\x00-\x7f])[\x80-\x84\x86-\x9f]|[\x81-\x9f][0-9][\x81-\xfe][0-9]")
_MAYBE_LEFT = re.compile("[\x80-\x9f\ufffd\ue000-\uf8ff]")
#: Control characters that are signs in Windows-1252, inside text.
_SIGNS = re.compile("(?<=[\\w .,)])[\x80\x82-\x84\x86-\x8c\x8e\x91-\x9c\x9e\x9f]|[\x80\x82-\x84\x86-\x8c\x8e\x91-\x9c\x9e\x9f](?=[\\w ])")
_GBK_SIGN = re.compile(rb"(?:[\xe2-\xe9\xef][\x80-\xbf]{2}){2}|(?:[\xd0\xd1][\x80-\xbf]){5}|\xf0[\x90-\xbf][\x80-\xbf]{2}")


def _lone_chars(name: str) -> re.Pattern:
    """Ideographs that one misread Latin letter or sign gives, next to a Latin letter or digit or alone in a line."""
    chars = []
    for lead in (0xC2, 0xC3):
        for trail in range(0x80, 0xC0):
            try:
                chars.append(bytes([lead, trail]).decode(name))
            except UnicodeDecodeError:
                pass
    one = "[" + "".join(chars) + "]"
    return re.compile(f"(?<![一-龥]){one}(?![一-龥])")


_LONE = {n: _lone_chars(n) for n in ("gbk", "big5")}


def _may_be_double(text: str, name: str) -> bool:
    raw = text.encode("gb18030") if name == "gbk" else text.encode("big5", "ignore")
    return bool(_GBK_SIGN.search(raw) or _LONE[name].search(text))


def _unreadable(text: str) -> bool:
    return bool(_MAYBE_LEFT.search(text) and _LEFT.search(text))


def _fix_signs(text: str) -> str:
    """Windows-1252 that was read as Latin-1: quotes, dashes and the like became control characters."""
    return _SIGNS.sub(lambda m: m.group().encode("latin-1").decode("cp1252"), text)


def repair(text: str | None) -> tuple[str | None, bool, list[str]]:
    """(text with all that can be restored, whether it was garbled, the layers undone from the outside in)."""
    if not text or text.isascii():
        return text, False, []
    layers: list[str] = []
    garbled = _unreadable(text)
    seen = {text}
    while True:
        found = [(n, _fix_double(text, n)) for n in ("gbk", "big5") if _may_be_double(text, n)]
        found = [(f"utf-8 as {n}", new) for n, new in found]
        if _PAIR.search(text):
            found += [(f"utf-8 as {n}", _fix_single(text, n)) for n in SINGLE]
        if _HIGH.search(text):
            found += [(f"{n} as cp1252", _fix_latin(text, n)) for n in ("gbk", "cp1251", "koi8_r", "big5")]
        found = [(cost(new), how, new) for how, new in found if new != text]
        pages = []
        if _HIGH.search(text) or _BESIDE.search(text) or _UPSIDE.search(text):
            pages = [
                (_rarity(new), f"{a} as {b}", new)
                for a in ("cp866", "iso8859_5")
                for b in ("cp1252", "cp1251", "koi8_r", "cp866", "iso8859_5")
                if a != b and (new := _fix_page(text, b, a)) != text
            ]
        if not found and _UPSIDE.search(text):
            found = [(_rarity(new), f"{a} as {b}", new) for a, b in (("koi8_r", "cp1251"), ("cp1251", "koi8_r")) if (new := _fix_cyrillic(text, b, a)) != text]
            found += pages
        elif not found:
            found = pages
        elif pages and cost(min(pages)[2]) <= min(found)[0] and min(pages)[0] < _rarity(min(found)[2]):
            found = pages
        elif min(found)[0] >= cost(text):
            break
        if not found:
            break
        _, how, new = min(found)
        if new in seen:
            break
        seen.add(new)
        text = new
        layers.append(how)
    if not layers and _MAYBE_LEFT.search(text) and (new := _fix_signs(text)) != text:
        text = new
        layers.append("cp1252 as latin-1")
    return text, garbled or bool(layers), layers


def repair_documents(documents: DataFrame) -> DataFrame:
    """doc_id, text (restored where possible), layers, whole (nothing unreadable is left) of every garbled document.

    Null, empty and plain ASCII texts are never garbled; they stay in the JVM. Other scripts and unusual symbols that
    read as intended are left as they are. Repeated rows give one row each distinct result. No shuffle but the last
    distinct, whose keys are the ids.
    """
    docs = documents.where(F.col("text").rlike(r"[^\x00-\x7f]")).select("doc_id", "text")

    def run(batches):
        for b in batches:
            o = {k: [] for k in ("doc_id", "text", "layers", "whole")}
            for doc, text in zip(b["doc_id"], b["text"], strict=True):
                new, garbled, layers = repair(text)
                if garbled:
                    for k, v in zip(o, (doc, new, layers, not _unreadable(new)), strict=True):
                        o[k].append(v)
            yield o

    return map_batches(spread(docs), run, "doc_id bigint, text string, layers array<string>, whole boolean").distinct()


def garbled_ids(documents: DataFrame) -> DataFrame:
    """doc_id of every garbled document, by the same pass."""
    return repair_documents(documents).select("doc_id").distinct()
