"""Problem 4: personal information inside free text.

Method: offset-preserving deobfuscation. A transducer rewrites a text for the detectors: full-width and look-alike
characters become plain ones, spelled digits become digits, disguised at and dot become signs, and line ends that
only wrap a line disappear or become blanks. It keeps the source place of every character it writes, so a span that
a detector finds is mapped back to the characters it was written with, and the rest of the text stays as it is.

Names are found by wordings, titles, frequent given names, their place beside other items in rows of people, and by parts
learned from those: what is mostly part of a name in the whole corpus. The detectors run once: that pass also counts parts
and hands on the places where learned parts could make a name; these meet the learned parts as tables.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, spread
from .base import has_text, join_counted, map_batches, one_row_per_id

# ------------------------------------------------------------------ transducer

_PLAIN = {0xFF01 + i: 0x21 + i for i in range(94)} | {
    0x3000: 0x20, 0xA0: 0x20, 0x2007: 0x20, 0x202F: 0x20, 0x2010: 0x2D, 0x2011: 0x2D, 0x2012: 0x2D, 0x2013: 0x2D, 0x2212: 0x2D,
    0xFE6B: 0x40, 0x201A: 0x2C,
}
#: Marks of the Chinese text that must stay what they are.
for _c in "，：；（）！？":
    _PLAIN.pop(ord(_c), None)
_WIDE = re.compile("[" + re.escape("".join(map(chr, _PLAIN))) + "]")
#: Letters of other scripts that look like Latin ones (fixed values); used inside Latin words only.
_TWINS = dict(zip("аеорсухіјѕԁɡɑοανкмтвнΑΒΕΗΙΚΜΝΟΡΤΧΥΖАВЕКМНОРСТХІЈЅ", "aeopcyxijsdgaoavkmtbhABEHIKMNOPTXYZABEKMHOPCTXIJS", strict=True))
#: Digits as they are spelled in the six languages (fixed values).
_DIGIT_WORDS = {
    w: str(i)
    for words in (
        "zero one two three four five six seven eight nine",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "ноль один два три четыре пять шесть семь восемь девять",
        "零 一 二 三 四 五 六 七 八 九",
    )
    for i, w in enumerate(words.split())
} | {"oh": "0", "zwo": "2", "нуль": "0", "〇": "0", "幺": "1"}
_ONE_DIGIT = "(?:" + "|".join(sorted((w for w in _DIGIT_WORDS if len(w) > 1), key=len, reverse=True)) + ")"
#: At least seven digits in a row, as the shortest number that is looked for has so many.
_SPELLED = re.compile(rf"(?i)\b{_ONE_DIGIT}(?:[ -]{_ONE_DIGIT}){{6,}}\b|[零〇一二三四五六七八九幺]{{7,}}")
#: What any such row holds, in small letters; quick to look for.
_INNER_DIGITS = re.compile(f"[ -]{_ONE_DIGIT}[ -]{_ONE_DIGIT}[ -]")
_ZH_DIGITS = re.compile("[零〇一二三四五六七八九幺]{7}")
_AT = re.compile(r"(?i)(?<=[\w+-])(\s*[\[({<]\s*(?:at|arroba|собака)\s*[\])}>]\s*|\s+at\s+(?=[\w-]+\s+dot\s))(?=\w)")
#: "j.doe at example.com": an initial and a name before a host.
_BARE_AT = re.compile(r"(?<![\w.])[a-z]\.[a-z]{2,}(\s+at\s+)(?=[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}\b)")
_DOT = re.compile(r"(?i)(?<=[\w-])(\s*[\[({<]\s*(?:dot|punto|point|punkt|точка)\s*[\])}>]\s*)(?=\w)")
_TWIN_WORD = re.compile("(?<=[A-Za-z])[" + "".join(_TWINS) + "]+|[" + "".join(_TWINS) + "]+(?=[A-Za-z])")
_WRAP = re.compile(r"(?<=[一-鿿])[ \t]*\n(?=[一-鿿\d])|(?<=[\d路街道弄号栋])[ \t]*\n(?=[一-鿿])")


def plain(text: str) -> tuple[str, list[int] | None]:
    """The rewritten text and, where lengths changed, the source place of each of its characters (and of its end)."""
    out = text if text.isascii() else _WIDE.sub(lambda m: chr(_PLAIN[ord(m.group())]), text)
    edits: list[tuple[int, int, str]] = []
    if "\n" in out and not out.isascii():
        edits += [(m.start(), m.end(), "") for m in _WRAP.finditer(out)]
    if "[" in out or "(" in out or "{" in out or "<" in out or " dot " in out or " at " in out:
        edits += [(m.start(), m.end(), "@") for m in _AT.finditer(out)]
        edits += [(*m.span(1), "@") for m in _BARE_AT.finditer(out)]
        edits += [(m.start(), m.end(), ".") for m in _DOT.finditer(out)]
    if not out.isascii():
        edits += [(m.start(), m.end(), "".join(_TWINS[c] for c in m.group())) for m in _TWIN_WORD.finditer(out)]
    spelled = _SPELLED.finditer(out) if _INNER_DIGITS.search(out.lower()) or _ZH_DIGITS.search(out) else ()
    for m in spelled:
        words = m.group() if m.group()[0] in "零〇一二三四五六七八九幺" else re.split("[ -]", m.group())
        edits.append((m.start(), m.end(), "".join(_DIGIT_WORDS[w.lower()] for w in words)))
    if not edits:
        return out, None
    parts, places, at = [], [], 0
    for s, e, new in sorted(edits):
        if s < at:
            continue
        parts += [out[at:s], new]
        places += range(at, s)
        places += [s + (e - s) * i // max(len(new), 1) for i in range(len(new))]
        at = e
    parts.append(out[at:])
    places += range(at, len(out) + 1)
    return "".join(parts), places


# ------------------------------------------------------------------- detectors

_EMAIL = re.compile(r"(?<![\w.+@-])[A-Za-z0-9](?:[\w.+-]*\w)?@[A-Za-z0-9](?:[\w-]*\w)?(?:-\s)?(?:[\w-]*\w)?(?:\.\s?[A-Za-z0-9](?:[\w-]*\w)?)*\.[A-Za-z]{2,}(?![\w@])", re.A)
_PHONE = re.compile(
    r"""(?<![\w.+@:/-])(?:
      \+\d{1,3}[ -]?\(?\d{1,5}\)?(?:[ .-]\d{2,8}){1,5}
    | \+\d{10,13}
    | \(\d{3}\)[ ]\d{3}-\d{4} | \d{3}[.-]\d{3}[.-]\d{4}
    | \(0\d{1,4}\)[ ]?\d{3,7}(?:[ -]\d{2,4})?
    | 1[3-9]\d(?P<s>[ -]?)\d{4}(?P=s)\d{4}
    | 0\d(?P<t>[ .])\d\d(?:(?P=t)\d\d){3}
    | 0\d{2,4}[ /-]\d{3,6}[ -]\d{2,4}
    | 8[ -]\(?\d{3}\)?[ -]\d{3}[ -]\d\d[ -]\d\d
    | [5-9]\d\d[ ]\d\d[ ]\d\d[ ]\d\d | [5-9]\d\d[ ]\d{3}[ ]\d{3}
    )(?![\w@]|[.:/-]\d|-\w)""",
    re.X | re.A,
)
_ID = re.compile(
    r"""(?<![\w.@/-])(?:
      \d{6}(?P<s>[ ]?)(?:19|20)\d\d(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])(?P=s)\d{3}[\dXx]
    | \d{3}(?P<t>[ -])\d\d(?P=t)\d{4}
    | [A-CEGHJ-PR-TW-Z][A-CEGHJ-NPR-TW-Z][ ]?\d\d[ ]?\d\d[ ]?\d\d[ ]?[A-D] | QQ[ ]?\d\d[ ]?\d\d[ ]?\d\d[ ]?[A-D]
    )(?![\w@]|-\d)""",
    re.X | re.A,
)
_SERIAL = re.compile(r"(?i)(?:serial(?: no\.?| number)?|part number|batch|order|序列号|工单编号|型号|批次|订单)\s*[:：#]?\s*$")

_H = "(?:[-\xad¬]\\s[a-zà-ÿ]+)?"  # a word divided at a line end
_CAP = f"[A-ZÀ-ÖØ-Þ][a-zà-öø-ÿ'’]+{_H}(?:-[A-Z][a-zà-ÿ]+{_H})?"
_TOWN = f"{_CAP}(?:\\s{_CAP})?"
_STREET = re.compile(
    rf"""(?<![\w.-])\d{{1,5}}[A-Z]?\s(?:{_CAP}\s){{1,3}}(?:Road|Lane|Avenue|Street|St\.?|Drive|Close|Way|Court|Place|Terrace|Boulevard|Ave\.?|Rd\.?|Square|Row|Hill)(?:,\s(?:Apt|Unit|Suite|Flat)\.?\s\d+[A-Z]?)?,\s{_CAP}(?:\s(?:[A-Z]{{1,2}}\d{{1,2}}[A-Z]?\s\d[A-Z]{{2}}|\d{{5}}))?
    | (?<![\w.-])\d{{1,5}}(?:\s(?:bis|ter|quater))?,?\s(?:rue|avenue|boulevard|place|quai|allée|chemin|impasse|route|cours)\s(?:(?:de|du|des|la|le|les)\s|d['’]|l['’])*{_TOWN},\s\d{{5}}\s{_CAP}""",
    re.X,
)
_FLAT = re.compile(r"(?:Flat|Apt\.?|Unit|Suite)\s\d+[A-Z]?,\s$")
_STREET_ES = re.compile(rf"(?:Calle|Avenida|Plaza|Paseo|Camino|Carrera|Ronda)\s(?:de\s|del\s|la\s)*{_TOWN}\s\d{{1,5}},\s(?:\d{{1,2}}\.?\s?[ºª°]\s?[A-Z]?,\s)?\d{{5}}\s{_CAP}")
_DE_SIGN = re.compile(r"(?:straße|strasse|weg|gasse|platz|allee|ring|ufer|damm|str\.|Straße|Weg|Allee|Platz|Ring|Gasse|Ufer)\s\d{1,4}\s?[a-z]?,\s\d{5}")
_STREET_DE = re.compile(
    rf"""(?:{_CAP}(?:straße|strasse|weg|gasse|platz|allee|ring|ufer|damm|str\.)|{_CAP}\s(?:Straße|Weg|Allee|Platz|Ring|Gasse|Ufer))\s\d{{1,4}}\s?[a-z]?,\s\d{{5}}\s{_CAP}""",
    re.X,
)
_RU_ADDRESS = re.compile(
    r"(?:\d{6},\s)?(?:г\.\s[А-ЯЁ][а-яё-]+,\s)?(?:ул|пр|пр-т|пер|наб|ш|б-р|пл)\.\s[А-ЯЁ][а-яё-]+(?:\s[А-ЯЁ]?[а-яё]+)?,\s(?:д|дом)\.?\s\d+[а-я]?(?:,\s(?:корп|стр)\.\s\d+)?(?:,\s(?:кв|оф)\.\s\d+)?(?:,\sг\.\s[А-ЯЁ][а-яё]+(?:-[А-ЯЁ]?[а-яё]+)*)?"
)
_ZH_ADDRESS = re.compile(
    r"(?:[一-鿿]{2,3}省)?[一-鿿]{2}市[一-鿿]{1,4}?[区县](?:[一-鿿]{1,4}?[镇乡])?[一-鿿]{1,6}?(?:路|街|大道|巷|胡同|道)\d{1,5}(?:弄\d{1,4}号|号)(?:\d{1,4}[栋幢座楼])?(?:\d{1,3}单元)?(?:\d{1,5}室)?"
)

_INITIAL = r"[A-Z]\."
_LAST = f"[A-Z][a-z]{{2,}}{_H}(?:-[A-Z][a-z]+{_H})?"
_NAME = f"(?:{_LAST}\\s(?:{_INITIAL}\\s)?{_LAST}|{_INITIAL}\\s{_LAST}|{_LAST},\\s{_LAST})"
_RU_NAME = r"(?:[А-ЯЁ][а-яё]+(?:-\s[а-яё]+)?\s[А-ЯЁ]\.(?:\s?[А-ЯЁ]\.)?|(?:[А-ЯЁ]\.\s?){1,2}[А-ЯЁ][а-яё]+|[А-ЯЁ][а-яё]+(?:-\s[а-яё]+)?\s[А-ЯЁ][а-яё]+(?:-\s[а-яё]+)?)"
_ZH_NAME = r"[一-鿿]{2,4}?"
_TITLE = r"(?:(?:Dr|Prof|Mr|Mrs|Ms|Herr|Frau|Ing|M|Mme|Sr|Sra|Dipl)\.?\s)*"
#: What comes before and after a person's name (fixed values: wordings of letters and forms).
_PERSON = re.compile(
    rf"(?:(?:Contact|Contacto|Ansprechpartner(?:in)?|Kontakt|Attn|Signed|Autor|Author|Owner name)\s?:\s{_TITLE}|(?:Prepared|Signed|Reviewed|Written)\sby\s{_TITLE}|I\sspoke\swith\s{_TITLE}|According\sto\s{_TITLE}|Erstellt\svon\s{_TITLE}|Rédigé\spar\s{_TITLE}|Redactado\spor\s{_TITLE}|联系人[:：]\s?|编写[:：]\s?|负责人[:：]\s?|请找|该项由)(?P<n>{_NAME})"
)
_SIGNED = re.compile(rf"(?P<n>{_NAME})(?=\ssigned\sthe\s)")
_PERSON_ZH = re.compile(
    rf"(?:联系人[:：]\s?|编写[:：]\s?)(?P<a>[一-鿿]{{2,4}})(?=[。，；;,\s]|$|收货|邮箱|电话)|请找(?P<b>{_ZH_NAME})(?=确认)|该项由(?P<c>{_ZH_NAME})(?=负责)|(?<![一-鿿])(?P<d>[一-鿿]{{2,4}})(?=（[一-鿿]{{2,6}}）已签收)|(?<=[。；\n])(?P<e>[一-鿿]{{2,3}})(?=先生|女士)"
)
_PERSON_RU = re.compile(rf"(?:Контакт\s?:\s|Составитель\s[—–-]\s|Исполнитель\s?[:—–-]\s|Ответственный\s?[:—–-]\s)(?P<n>{_RU_NAME})")
_CELL_NAME = re.compile(f"(?:{_NAME}|{_RU_NAME}|[一-鿿]{{2,4}})")
_CELLS = re.compile(r"[^\n|;\t]+")
KINDS = ("email", "idnum", "phone", "address", "person")
#: Titles before or after a name (fixed values).
_TITLED = re.compile(rf"\b(?:(?:Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Herrn|Frau|Sr|Sra|Srta|Señor|Señora|Mme|Mlle|Monsieur|Madame)\.?\s){{1,3}}(?P<n>{_NAME})")
_TITLED_RU = re.compile(rf"(?:[Гг]осподин|[Гг]оспожа|г-н|г-жа)\s(?P<n>{_RU_NAME})")
#: Frequent surnames of one ideograph (fixed values).
_SURNAMES = "王李张刘陈杨赵黄周吴徐孙胡朱郭何林罗郑梁谢宋唐邓冯韩曹曾彭萧蔡潘董袁余杜苏魏吕丁沈姚卢姜崔钟谭陆汪范廖贾韦夏邹孟熊秦邱尹薛闫侯陶贺顾郝龚邵钱覃戴"
_TITLED_ZH = re.compile(f"(?<![一-鿿])(?P<n>[{_SURNAMES}][一-鿿]{{1,2}})(?=先生|女士|老师|医生|博士|教授)")
#: Frequent given names in the languages of the corpus (fixed values).
_GIVEN = frozenset(
    "John James Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Steven Paul Andrew Kevin Brian George Edward "
    "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Lisa Margaret Sandra Ashley Emily Laura Rebecca Helen Jane "
    "Maria María Carmen Ana Isabel Dolores Pilar José Juan Carlos Javier Miguel Luis Pedro Pablo Jorge Fernando Alejandro Diego Sofía Lucía "
    "Jean Pierre Michel Philippe Alain Nicolas Jacques Claude Marie Nathalie Isabelle Sylvie Catherine Françoise Camille Sophie Julien Antoine "
    "Hans Peter Wolfgang Klaus Jürgen Stefan Andreas Matthias Sabine Petra Monika Ursula Heike Katharina Anna Julia Lukas Felix Jonas Greta "
    "Иван Александр Сергей Дмитрий Андрей Алексей Михаил Николай Владимир Павел Елена Ольга Наталья Татьяна Ирина Мария Анна Екатерина Светлана Юлия".split()
)
_CAPPED = re.compile("[A-ZÀ-ÖØ-Þ][a-zà-öø-ÿ]{2,}(?:-[A-Z][a-zà-öø-ÿ]+)?|[А-ЯЁ][а-яё]{2,}")
_HAN = re.compile("[一-鿿]")
_BETWEEN = re.compile(r"\s(?:[A-ZА-ЯЁ]\.\s)?")
#: What a surname isn't (fixed values): second words of the names of places and bodies.
_NO_SURNAME = frozenset("Street Road Avenue Lane Square River Island Bay Station University College School Hospital Company Group Institute Foundation Bank Airport Bridge Park Hall House Church Day Platz Straße".split())
#: Occurrences of a part of a name from which it counts, and the share of all its occurrences as a capitalised word.
NAME_COUNT, NAME_SHARE = 2, 0.6
#: Share of all its occurrences that a further ideograph of a name has in names, or share of the names that it stands in;
#: one of the two will do. What has neither is the start of a word that a wording ran into.
FURTHER_SHARE = 0.01
#: Different parts that a task counts before it hands them on.
COUNTED = 200_000


@dataclass(frozen=True)
class Names:
    """Parts of names learned from the corpus: words, first and further ideographs."""

    words: frozenset[str] = frozenset()
    first: frozenset[str] = frozenset()
    further: frozenset[str] = frozenset()


def _known(word: str, words: frozenset[str] | set[str]) -> bool:
    return word in words or "-" in word and all(w in words for w in word.split("-"))


def _is_name(a: str, b: str, words: frozenset[str] | set[str]) -> bool:
    """Whether two words that follow each other are a name by the learned `words`: a learned part or a frequent given name
    before a learned part, or a frequent given name before any other word that names no place or body."""
    given = a in _GIVEN
    return (given or _known(a, words)) and (_known(b, words) or given and b not in _NO_SURNAME)


def _adjacent(text: str):
    """(start, end, first, second) of capitalised words that follow each other, with an initial between them at most."""
    words = list(_CAPPED.finditer(text))
    for a, b in zip(words, words[1:], strict=False):
        if b.start() - a.end() in (1, 4) and _BETWEEN.fullmatch(text, a.end(), b.start()):
            yield a.start(), b.end(), a.group(), b.group()


@lru_cache(maxsize=8)
def _ideographs(names: Names) -> re.Pattern:
    return re.compile(f"[{''.join(sorted(names.first))}][{''.join(sorted(names.further))}]{{1,2}}")


def _listed_ideographs(text: str, names: Names):
    if names.first and names.further and not text.isascii():
        for m in _ideographs(names).finditer(text):
            yield m.span()


def _listed(text: str, names: Names):
    """Spans of names by their parts: two words (_is_name), or a learned first and one or two further ideographs."""
    for s, e, a, b in _adjacent(text):
        if _is_name(a, b, names.words):
            yield s, e
    yield from _listed_ideographs(text, names)


#: Weights and check digits of Chinese identity numbers (fixed values, GB 11643).
_ID_WEIGHTS, _ID_CHECK = (7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2), "10X98765432"


def _checks(number: str) -> bool:
    """Whether an identity number of 18 digits has its check digit; other numbers have none."""
    d = [c for c in number if c.isalnum()]
    return len(d) != 18 or _ID_CHECK[sum(int(a) * w for a, w in zip(d, _ID_WEIGHTS, strict=False)) % 11] == d[17].upper()


_DIGITS_BEFORE = re.compile(r"\d[ -]$")


#: Literal parts of the patterns, one of which any match holds: looking for these first is quick.
_PARTS = {
    "street": "Road Lane Avenue Street St Drive Close Way Court Place Terrace Boulevard Ave Rd Square Row Hill rue avenue boulevard place quai allée chemin impasse route cours".split(),
    "street_es": "Calle Avenida Plaza Paseo Camino Carrera Ronda".split(),
    "person": "Contact Ansprechpartner Kontakt Attn Signed Autor Author Owner Prepared Reviewed Written spoke According Erstellt Rédigé Redactado 联系人 编写 负责人 请找 该项由".split(),
    "person_zh": "联系人 编写 请找 该项由 已签收 先生 女士".split(),
    "titled": "Mr Ms Miss Dr Prof Herr Frau Sr Señor Mme Mlle Monsieur Madame".split(),
    "titled_zh": "先生 女士 老师 医生 博士 教授".split(),
    "titled_ru": "осподин оспожа г-н г-жа".split(),
}


def _may_hold(text: str, kind: str) -> bool:
    for part in _PARTS[kind]:
        if part in text:
            return True
    return False


def _spans(text: str, names: Names | None = None) -> list[tuple[int, int, str]]:
    """(start, end, kind) in rewritten text, in order and apart from each other."""
    found: list[tuple[int, int, str]] = []
    taken = bytearray(len(text) + 1)

    def add(s: int, e: int, kind: str) -> None:
        if s < e and not any(taken[s:e]):
            taken[s:e] = b"\1" * (e - s)
            found.append((s, e, kind))

    if "@" in text:
        for m in _EMAIL.finditer(text):
            add(m.start(), m.end(), "email")
    flat = text.replace("\n", " ")
    for m in _ID.finditer(flat):
        if not _SERIAL.search(text[max(0, m.start() - 24) : m.start()]) and _checks(m.group()):
            add(m.start(), m.end(), "idnum")
    phones = [*_PHONE.finditer(text), *(_PHONE.finditer(flat) if flat != text else ())]  # unbroken ones first
    for m in phones:
        if not _SERIAL.search(text[max(0, m.start() - 24) : m.start()]) and 7 <= sum(c.isdigit() for c in m.group()) <= 14 and not _DIGITS_BEFORE.search(text[max(0, m.start() - 2) : m.start()]):  # no end of a longer number
            add(m.start(), m.end(), "phone")
    for m in _STREET.finditer(text) if _may_hold(text, "street") else ():
        flat_no = _FLAT.search(text, max(0, m.start() - 20), m.start())
        add(flat_no.start() if flat_no else m.start(), m.end(), "address")
    for m in _STREET_ES.finditer(text) if _may_hold(text, "street_es") else ():
        add(m.start(), m.end(), "address")
    if _DE_SIGN.search(text):
        for m in _STREET_DE.finditer(text):
            add(m.start(), m.end(), "address")
    if not text.isascii():
        if "д. " in text or "дом " in text or "д.\n" in text:
            for m in _RU_ADDRESS.finditer(text):
                add(m.start(), m.end(), "address")
        if "市" in text:
            for m in _ZH_ADDRESS.finditer(text):
                add(m.start(), m.end(), "address")
        for m in _PERSON_ZH.finditer(text) if _may_hold(text, "person_zh") else ():
            add(*m.span(m.lastgroup), "person")
        for m in _PERSON_RU.finditer(text):
            add(*m.span("n"), "person")
    wordings = [(_PERSON, "person"), (_TITLED, "titled")]
    if not text.isascii():
        wordings += [(_TITLED_ZH, "titled_zh"), (_TITLED_RU, "titled_ru")]
    for pattern, kind in wordings:
        if _may_hold(text, kind):
            for m in pattern.finditer(text):
                add(*m.span("n"), "person")
    if "signed" in text:
        for m in _SIGNED.finditer(text):
            add(*m.span("n"), "person")
    # a cell that is a name beside a cell that is another item: rows of people in tables and lists
    if found:
        whole = {}
        cells = []
        for m in _CELLS.finditer(text):
            s, e = m.start(), m.end()
            while s < e and text[s] in " -•*":
                s += 1
            while e > s and text[e - 1] in " .":
                e -= 1
            if s < e:
                cells.append((s, e))
        item = {(s, e) for s, e, _ in found}
        for i, (s, e) in enumerate(cells):
            whole[i] = (s, e) in item or any(taken[s:e]) and all(taken[j] or text[j] in " ,.<>" for j in range(s, e))
        for i, (s, e) in enumerate(cells):
            if any(taken[s:e]):
                continue
            # initials keep their full stop
            e2 = e + 1 if text[e : e + 1] == "." and re.search(r"\s[A-ZА-ЯЁ]$", text[s:e]) else e
            if not _CELL_NAME.fullmatch(text, s, e2):
                continue
            for j in (i - 1, i + 1):
                if 0 <= j < len(cells) and whole[j]:
                    gap = text[e:cells[j][0]] if j > i else text[cells[j][1] : s]
                    if gap.count("\n") < 2:
                        add(s, e2, "person")
                        break
    if names is not None:
        for s, e in _listed(text, names):
            add(s, e, "person")
    return sorted(found)


_TRIM = " \t\r\n.,;:!?<>\"'“”‘’«»()[]（）。，；：、"


def find(text: str | None, names: Names | None = Names()) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the items in the source text, in order."""
    if not text:
        return []
    new, places = plain(text)
    out = []
    for s, e, kind in _spans(new, names):
        out.append((*_source(text, places, s, e), kind))
    return out


def _source(text: str, places: list[int] | None, s: int, e: int) -> tuple[int, int]:
    """Where a span of the rewritten text lies in `text`."""
    if places is not None:
        s, e = places[s], places[e - 1] + 1 if places[e] == places[e - 1] + 1 else places[e]
        while e > s and text[e - 1].isspace():
            e -= 1
    return s, e


def value_of(text: str, s: int, e: int, kind: str) -> str:
    """The item as written: white space runs as one blank, without surrounding punctuation."""
    v = " ".join(text[s:e].split())
    keep_dot = kind == "person" and re.search(r"\s[A-ZА-ЯЁ]\.$", v)
    v2 = v.strip(_TRIM if kind != "phone" else _TRIM.replace("(", "").replace(")", ""))
    return v2 + "." if keep_dot and not v2.endswith(".") else v2


def redact(text: str | None, names: Names | None = Names()) -> str | None:
    """The text with each item replaced by its kind in square brackets; all else is unchanged."""
    return _replaced(text, find(text, names)) if text else text


def _replaced(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for s, e, kind in spans:
        out += [text[at:s], f"[{kind.upper()}]"]
        at = e
    out.append(text[at:])
    return "".join(out)


_HAN_RUN = re.compile("[一-鿿]{2}")


def _count_parts(text: str, spans: list[tuple[int, int, str]], in_names: dict[str, Counter], anywhere: dict[str, Counter]) -> None:
    """Adds the parts of names in `text` and what is capitalised, or an ideograph, outside of items."""

    def words(counter: Counter, found: list[str]) -> None:
        counter.update(found)
        for c in found:
            if "-" in c:
                counter.update({*c.split("-")})

    at, rest = 0, []
    for s, e, kind in spans:
        if kind == "person":
            name = text[s:e]
            if name[0] >= "一":
                in_names["first"][name[0]] += 1
                in_names["further"].update(name[1:])
            else:
                words(in_names["words"], _CAPPED.findall(name))
        rest.append(text[at:s])
        at = e
    other = "\0".join([*rest, text[at:]])
    words(anywhere["words"], _CAPPED.findall(other))
    if not other.isascii():
        anywhere["first"].update(_HAN.findall(other))


def _marked(records: DataFrame) -> DataFrame:
    """One pass over all texts, stored: rows (id, at, spans, more, words), `at` the text's hash, with the items that need no
    learned part, what learned parts could make a name of, and the words that it depends on; and rows (kind, part, n,
    other), how often a part occurs in such names and elsewhere."""
    rows = records.where(F.col("id").isNotNull() & has_text()).select("id", "text", F.xxhash64("text").alias("at"))
    schema = "id string, at bigint, spans array<struct<s:int,e:int,kind:string,value:string>>, more binary, words array<string>, kind string, part string, n bigint, other bigint"
    names = [c.split()[0] for c in re.split(r", (?=\w+ )", schema)]

    def counted(in_names: dict[str, Counter], anywhere: dict[str, Counter]) -> dict[str, list]:
        o = {c: [] for c in names}
        for kind in in_names:
            mine, other = in_names[kind], anywhere["words" if kind == "words" else "first"]
            for part in mine.keys() | other.keys():
                for c, v in zip(names, (None, None, None, None, None, kind, part, mine[part], other[part]), strict=True):
                    o[c].append(v)
        return o

    def run(batches):
        in_names, anywhere = ({k: Counter() for k in ("words", "first", "further")} for _ in range(2))
        for b in batches:
            o = {c: [] for c in names}
            for i, text, at in zip(b["id"], b["text"], b["at"], strict=True):
                new, places = plain(text)
                spans = _spans(new)
                _count_parts(new, spans, in_names, anywhere)
                items = [(*(p := _source(text, places, s, e)), kind, value_of(text, *p, kind)) for s, e, kind in spans]
                pairs, words = [], set()
                for s, e, x, y in _adjacent(new):
                    if any(s < z and a < e for a, z, _ in spans):
                        continue
                    p = _source(text, places, s, e)
                    pairs.append((*p, value_of(text, *p, "person"), x, y))
                    words.update((x, y, *x.split("-"), *y.split("-")))
                han = (text, spans) if not new.isascii() and _HAN_RUN.search(new) else None
                more = zlib.compress(pickle.dumps((pairs, han)), 1) if pairs or han else None
                if items or more:
                    for c, v in zip(names, (i, at, items, more, sorted(words), None, None, 0, 0), strict=True):
                        o[c].append(v)
            yield o
            if sum(map(len, anywhere.values())) + sum(map(len, in_names.values())) > COUNTED:
                yield counted(in_names, anywhere)
                for c in (*in_names.values(), *anywhere.values()):
                    c.clear()
        yield counted(in_names, anywhere)

    return checkpointed(map_batches(spread(rows), run, schema))


def _parts(marked: DataFrame) -> DataFrame:
    """kind, part, n, other of what is mostly part of a name wherever it stands, and of further ideographs; stored."""
    counted = marked.where("kind is not null").groupBy("kind", "part").agg(F.sum("n").alias("n"), F.sum("other").alias("other"))
    # what follows a surname may be any ideograph elsewhere
    sure = (F.col("n") >= NAME_COUNT) & ((F.col("kind") == "further") | (F.col("n") >= NAME_SHARE * (F.col("n") + F.col("other"))))
    return checkpointed(counted.where(sure))


def _names(parts: DataFrame) -> Names:
    rows = parts.collect()
    found: dict[str, set[str]] = {"words": set(), "first": set(), "further": set()}
    total = sum(r.n for r in rows if r.kind == "first")
    for r in rows:
        if r.kind != "further" or r.n >= FURTHER_SHARE * min(r.n + r.other, total):
            found[r.kind].add(r.part)
    return Names(**{k: frozenset(v) for k, v in found.items()})


def learn_names(records: DataFrame) -> Names:
    """Parts of the names that stand in wordings and beside other items in all records: those that are mostly part of a
    name wherever they stand. All of them come to the driver, for use on single texts; the queries leave words in a table."""
    return _names(_parts(_marked(records)))


def _items(records: DataFrame) -> DataFrame:
    """id, at (hash of the text), s, e, kind, value of every item in the records' texts; a row that comes twice may come
    out twice."""
    marked = _marked(records)
    parts = _parts(marked)
    # ideographs are a few thousand; words are as many as there are names, so they meet the places as a table
    shared = records.sparkSession.sparkContext.broadcast(_names(parts.where("kind <> 'words'")))
    found = marked.where("id is not null")
    more = found.where("more is not null").dropDuplicates(["id", "at"])
    asked = found.select("id", "at", F.explode("words").alias("part"))
    known = join_counted(asked, parts.where("kind = 'words'").select("part"), "part", "left_semi").groupBy("id", "at").agg(F.collect_set("part").alias("known"))
    rows = more.select("id", "at", "more").join(known, ["id", "at"], "left")

    def run(batches):
        for b in batches:
            o = {c: [] for c in ("id", "at", "s", "e", "kind", "value")}
            for i, at, packed, words in zip(b["id"], b["at"], b["more"], b["known"], strict=True):
                pairs, han = pickle.loads(zlib.decompress(packed))
                words, end, out = set(words or ()), 0, []
                for s, e, value, x, y in pairs:
                    if s >= end and _is_name(x, y, words):
                        out.append((s, e, value))
                        end = e
                if han:
                    text, spans = han
                    new, places = plain(text)
                    for s, e in _listed_ideographs(new, shared.value):
                        if not any(s < z and a < e for a, z, _ in spans):
                            p = _source(text, places, s, e)
                            out.append((*p, value_of(text, *p, "person")))
                for s, e, value in out:
                    for c, v in zip(o, (i, at, s, e, "person", value), strict=True):
                        o[c].append(v)
            yield o

    listed = map_batches(rows, run, "id string, at bigint, s int, e int, kind string, value string")
    return found.select("id", "at", F.inline("spans")).unionByName(listed)


def found_items(records: DataFrame) -> DataFrame:
    """id, kind, value of every item in the records' texts; distinct rows.

    Null ids, null, blank and item-free texts give no row. Each text is read whole, in one pass without a shuffle of
    texts but for those with ideographs, which meet the names learned from all texts; else only found values and places
    where names may stand move.
    """
    return _items(records).select("id", "kind", "value").distinct()


def redacted(records: DataFrame) -> DataFrame:
    """id, text with typed placeholders, n_items; one row for each id (its row with text). Null stays null."""
    rows = one_row_per_id(records, ["text"]).withColumn("at", F.xxhash64("text"))
    marks = _items(records).groupBy("id", "at").agg(F.array_sort(F.collect_set(F.struct("s", "e", "kind"))).alias("spans"))
    marks = marks.select(F.col("id").alias("_id"), F.col("at").alias("_at"), "spans")
    # no key of the join, so that texts stay where they met by id
    joined = rows.join(marks, (F.col("id") == F.col("_id")) & (F.col("at").bitwiseXOR(F.col("_at")) == 0), "left").select("id", "text", "spans")

    def run(batches):
        for b in batches:
            spans = [[(x["s"], x["e"], x["kind"]) for x in row or ()] for row in b["spans"]]
            texts = [_replaced(t, row) if row else t for t, row in zip(b["text"], spans, strict=True)]
            yield {"id": b["id"], "text": texts, "n_items": [len(row) for row in spans]}

    return map_batches(joined, run, "id string, text string, n_items int")
