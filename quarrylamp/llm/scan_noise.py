"""Problem 1: noise in text from scanned pages.

Method: a symmetric-delete index over the corpus frequency lexicon generates correction candidates; a weighted edit
distance with confusion pairs and bigram context picks the repairs. Page furniture (headers, page numbers) and lines
are undone by layout rules for each text.

The lexicon is counted over all texts. What is a misreading depends on ratios of counts only, so it doesn't change with
the size of the corpus. Only tokens outside the TOP most frequent words without a candidate (a list of fixed size, sent
to the tasks) leave their task for the joins with the candidates; the index, the candidates and the contexts are tables
joined by key, and nothing that grows with the corpus is collected or broadcast.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Container

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed, spread
from .base import has_text, map_batches, one_row_per_id

#: A lexicon word occurs at least MIN_COUNT times, and RATIO times as often as what is taken for its misreading.
MIN_COUNT, RATIO = 8, 12.0
#: The same for an ideograph between its neighbours, whose windows are rarer than words.
CJK_RATIO = 6
#: Most frequent words that tasks know beforehand; deletions on either side of the index; greatest weighted distance.
TOP, DELETES, MAX_DISTANCE = 50_000, 2, 1.0
#: Words of up to SHORT letters get one deletion, and are met under all their misreadings instead; words of more than
#: LONG get one too, as two of them would give a key for each pair of their letters.
SHORT, LONG = 4, 40
#: What the layout rules take for furniture has at most so many characters: a header line, a page number's line.
HEADER_CHARS, NUMBER_CHARS = 160, 30
#: Cost of an edit that is a known confusion, of any other edit, and what a hundredfold frequency is worth.
CONFUSED, OTHER = 0.3, 1.4

#: Characters read as others in scanned Latin and Cyrillic print (fixed values: what was printed, what is read).
CONFUSIONS = [
    ("o", "0"), ("l", "1"), ("i", "!"), ("a", "ɑ"), ("t", "†"), ("s", "5"), ("b", "6"), ("e", "c"), ("h", "b"),
    ("g", "q"), ("d", "cl"), ("m", "rn"), ("rn", "m"), ("w", "vv"), ("li", "h"), ("i", "1"), ("z", "2"), ("g", "9"),
    ("B", "8"), ("u", "ii"), ("n", "ri"), ("c", "e"), ("n", "u"), ("f", "t"), ("o", "о"), ("a", "а"), ("e", "е"),
    ("т", "m"), ("о", "0"), ("п", "л"), ("н", "и"), ("ы", "ьі"), ("з", "3"), ("б", "6"), ("ш", "щ"), ("т", "†"),
    ("и", "й"), ("ч", "4"), ("л", "п"), ("и", "н"), ("щ", "ш"), ("е", "с"),
]
#: Ideographs read as others (fixed values, as above).
CJK_CONFUSIONS = dict(
    zip("吋纽摸末抿觌畚彔佘曰栽沅人椄囗己巳戊未土干千太夭", "时组模未报规备录会日载源入核口已已戌末士千干大天", strict=True)
)

_MARKS = "-\xad¬‐‑"
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿŒœßẞА-яЁёіІɑ†"
#: A word, with digits and marks that stand for letters inside it.
_TOKEN = re.compile(f"(?<![\\w@./:+-])[{_LETTER}0-9](?:[{_LETTER}0-9!]*[{_LETTER}0-9])?(?![\\w@]|[.:/@+]\\w|-\\d)")
_WORDLIKE = re.compile(f"[{_LETTER}]{{2}}|[{_LETTER}][!0156†ɑ][{_LETTER}]|^[{_LETTER}][!0156†ɑ3]|[!0156†ɑ3][{_LETTER}]$")
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿŒœßẞ]+|[А-яЁё]+")
_CJK_ODD = re.compile("(?=([一-鿿]?)([" + "".join(CJK_CONFUSIONS) + "".join(set(CJK_CONFUSIONS.values())) + "])([一-鿿]?))")



def _context(before: str, after: str) -> str:
    """Neighbours of an ideograph, as printed if they may be misread themselves."""
    return f"{CJK_CONFUSIONS.get(before, before)} {CJK_CONFUSIONS.get(after, after)}"


def _read_as(char: str) -> str:
    """Pattern of an ideograph and of what it is misread as; '' for no neighbour."""
    return f"[{char}{''.join(r for r, p in CJK_CONFUSIONS.items() if p == char)}]" if char else ""


# ---------------------------------------------------------------- page layout

_NUMBER = r"""(?P<n>(?:page|seite|página|pág\.|стр\.|p\.)[ ]?(?P<page>\d+)(?:[ ](?:of|von|de|sur|из)[ ]\d+)?
  | 第[ ]?(?P<zh>\d+)[ ]?页(?:[ ]?共[ ]?\d+[ ]?页)? | [-—–][ ]?(?P<dash>\d+)[ ]?[-—–]
  | \[(?P<br>\d+)\] | (?P<slash>\d+)/\d+ | (?P<rom>[ivxlc]+) | (?P<bare>\d{1,4}))"""
_ALONE = re.compile(rf"[ \t\x0c]*{_NUMBER}[ \t\x0c]*", re.X | re.I)
_IN_LINE = re.compile(rf"(?P<head>\S.*?\S)[ \t]{{2,}}{_NUMBER}[ \t\x0c]*", re.X | re.I)
_FOLD = [("rn", "m"), ("cl", "d"), ("vv", "w"), ("li", "h"), ("0", "o"), ("1", "l"), ("i", "l"), ("5", "s"), ("6", "b"), ("!", "l"), ("†", "t"), ("ɑ", "a"), ("3", "з"), ("c", "e"), ("q", "g")]
_CJK_READ = re.compile("[" + "".join(CJK_CONFUSIONS) + "]")
_ROMAN = dict(zip("ivxlc", (1, 5, 10, 50, 100), strict=True))


def _roman(s: str) -> int:
    v = [_ROMAN[c] for c in s.lower()]
    return sum(-a if a < b else a for a, b in zip(v, [*v[1:], 0], strict=True))


def _fold(text: str) -> str:
    """Lines as they look whatever was misread in them; line ends stay."""
    line = text.strip(" \t\x0c")
    if "  " in line or "\t" in line or "\x0c" in line or not line.isascii():
        line = re.sub(r"[^\S\n]{2,}|[\t\x0c]", " ", line)
        line = _CJK_READ.sub(lambda m: CJK_CONFUSIONS[m.group()], line)
    line = line.lower()
    for read, printed in _FOLD:
        line = line.replace(read, printed)
    return line


def layout(text: str) -> tuple[set[int], set[int], list[str]]:
    """(lines that are page numbers, lines that are headers, all lines). A header line that holds the page number is
    in both. Bare numbers count only as an ascending run of two or more; a header only if it comes again."""
    lines = text.split("\n")
    if len(lines) < 3:
        return set(), set(), lines
    by_kind: dict[str, list[tuple[int, int]]] = defaultdict(list)
    heads: dict[int, str] = {}
    for i, line in enumerate(lines):
        if len(line) > HEADER_CHARS or not (s := line.strip(" \t\x0c")):
            continue
        m = _ALONE.fullmatch(line) if len(s) < NUMBER_CHARS else None
        inside = None if m or "  " not in s and "\t" not in s else _IN_LINE.fullmatch(line)
        if inside and ("\t" in s or ";" in s):
            inside = None
        for got, where in ((m, ""), (inside, "+")):
            if got:
                kind = next(k for k in ("page", "zh", "dash", "br", "slash", "rom", "bare") if got[k])
                value = _roman(got[kind]) if kind == "rom" else int(got[kind])
                by_kind[kind + where].append((i, value))
        if not m:
            body = inside["head"] if inside else s
            if len(body) >= 5 and body[-1] not in ".。,，;；:：、" and "\t" not in body and ";" not in body and re.search(r"[^\W\d_]{2}", body) and not re.match(r"[-•*] ", body):
                heads[i] = body
    numbers: set[int] = set()
    same: dict[str, list[int]] = defaultdict(list)
    if len(heads) > 1:
        folded = _fold("\n".join(body for i, body in heads.items())).split("\n")
        for i, body in zip(heads, folded, strict=True):
            same[body.strip()].append(i)
    headers: set[int] = set()
    for places in same.values():
        # not rows of one table: something else lies between
        if len(places) >= 2 and any(b - a >= 2 for a, b in zip(places, places[1:], strict=False)):
            headers |= set(places)
    for kind, run in by_kind.items():
        if kind in ("bare+", "rom+"):  # a number at the end of a line is a page's only beside a header
            run = [(i, v) for i, v in run if i in headers]
        steps = [b[1] - a[1] for a, b in zip(run, run[1:], strict=False)]
        if kind in ("page", "zh", "dash", "page+", "zh+", "dash+") or len(run) >= 2 and all(0 < d <= 4 for d in steps):
            numbers |= {i for i, _ in run}
        elif kind in ("bare", "rom", "br", "slash"):
            # numbers of a table may be around: take the longest run that goes up by one or two
            best: list[int] = []
            for j in range(len(run)):
                chain = [run[j]]
                for x in run[j + 1 :]:
                    if 1 <= x[1] - chain[-1][1] <= 2 and x[0] - chain[-1][0] >= 3:
                        chain.append(x)
                if len(chain) > len(best):
                    best = [i for i, _ in chain]
            if len(best) >= 3:
                numbers |= set(best)
    return numbers, headers, lines


_MARK_END = re.compile(f"[{_MARKS}][ \\t]*\\n")
_ENDED = re.compile("[.!?。！？:：;；)）][\"'”’»]?[ \\t]*$")
_BREAK = re.compile(f"([{_LETTER}0-9!]{{1,40}})([{_MARKS}])[ \\t]*\\n[ \\t]*([{_LETTER}0-9!]{{1,40}})")


def _body(text: str) -> tuple[str, set[int], set[int]]:
    """The text without headers and page numbers (a word may be divided across a page), and what was taken out."""
    numbers, headers, lines = layout(text)
    if not numbers and not headers:
        return text, numbers, headers
    width = max((len(x) for i, x in enumerate(lines) if i not in numbers and i not in headers), default=0)
    out: list[str] = []
    gap = False
    for i, line in enumerate(lines):
        if i in numbers or i in headers:
            gap = True
            continue
        if gap and line.strip(" \t\x0c"):
            # a sentence that goes on after the page's end: the blank lines around the furniture go with it
            k = len(out)
            while k and not out[k - 1].strip(" \t\x0c"):
                k -= 1
            if k and not _ENDED.search(out[k - 1]) and len(out[k - 1]) * 2 > width:
                del out[k:]
            gap = False
        out.append(line)
    return "\n".join(out), numbers, headers


def _breaks(body: str) -> list[tuple[int, int, str, str, str]]:
    """(end of the left part, start of the right one, left, mark, right) of words divided at line ends, where the right
    part goes on in small letters. Names of things, identifiers and addresses (a digit, dot or sign beside) are not
    words."""
    out: list[tuple[int, int, str, str, str]] = []
    if not _MARK_END.search(body):
        return out
    for m in _BREAK.finditer(body):
        a, mark, b = m.groups()
        before, after = body[m.start() - 1 : m.start()], body[m.end() : m.end() + 2]
        if b[0].islower() or b[0] in "0156!†ɑ" and any(c.islower() for c in b):
            if before in ("@", ".", "/", "_", "+") or re.match(r"[.@/_]\w", after) or not any(c.isalpha() for c in a):
                continue
            out.append((m.end(1), m.start(3), a, mark, b))
    return out


def _join(body: str) -> tuple[str, list[tuple[int, str, str, str]]]:
    """The body with every divided word as one, and of each joint its place, what stood there, the mark and the whole."""
    parts, joints, at, n = [], [], 0, 0
    for end, start, a, mark, b in _breaks(body):
        parts.append(body[at:end])
        n += end - at
        joints.append((n, body[end:start], mark, a + b))
        at = start
    if not joints:
        return body, joints
    parts.append(body[at:])
    return "".join(parts), joints


def _words(body: str, divided: Counter | None = None) -> list[str]:
    """Tokens in order; a divided word is one. `divided` counts those joined at a plain hyphen, which may be compounds."""
    whole, joints = _join(body)
    plain = [at for at, _, mark, _ in joints if mark == "-"]
    if divided is None or not plain:
        return _TOKEN.findall(whole)
    out, k = [], 0
    for m in _TOKEN.finditer(whole):
        while k < len(plain) and plain[k] <= m.start():
            k += 1
        if k < len(plain) and plain[k] < m.end():
            divided[m.group()] += 1
        out.append(m.group())
    return out


_DASH = re.compile(f"-(?=([{_LETTER}0-9!]{{1,40}}))")
_DASH_LEFT = re.compile(f"[{_LETTER}0-9!]{{1,40}}$")


def _dashed(body: str) -> list[str]:
    """Words written with a hyphen inside a line, without it; of several parts each neighbouring two."""
    return [a[0] + m[1] for m in _DASH.finditer(body) if (a := _DASH_LEFT.search(body[max(0, m.start() - 40) : m.start()]))]


# ------------------------------------------------------- candidates, distance


def deletions(word: str, most: int = DELETES) -> set[str]:
    """The word and what is left of it after up to `most` deletions (one for words of SHORT letters or fewer, or of more
    than LONG)."""
    out, now = {word}, {word}
    for _ in range(most if SHORT < len(word) <= LONG else 1):
        now = {w[:i] + w[i + 1 :] for w in now for i in range(len(w)) if len(w) > 1}
        out |= now
    return out


_PAIRS: dict[tuple[str, str], float] = {}
for _p, _r in CONFUSIONS:
    _PAIRS[_p, _r] = CONFUSED
    if len(_p) == 1:
        _PAIRS[_p.upper(), _r] = CONFUSED
_PAIRS |= {(p, r): CONFUSED for r, p in CJK_CONFUSIONS.items()}
_READ = sorted({(len(p), len(r)) for p, r in _PAIRS})
_READ_AS: dict[str, set[str]] = defaultdict(set)
for _p, _r in CONFUSIONS:
    _READ_AS[_p.lower()].add(_r.lower())


def misreadings(word: str, most: int = int(MAX_DISTANCE / CONFUSED)) -> set[str]:
    """The lower-case word and what up to `most` confusions make of it."""
    if not word:
        return {""}
    out = {word[0] + rest for rest in misreadings(word[1:], most)}
    for n in (1, 2) if most else ():
        for read in _READ_AS.get(word[:n], ()) if n <= len(word) else ():
            out |= {read + rest for rest in misreadings(word[n:], most - 1)}
    return out


def keys(word: str) -> set[str]:
    """What a lexicon word is met under: its deletions and, where it or what is read is short, its misreadings."""
    word = word.lower()
    out = deletions(word)
    if len(word) <= SHORT + 2:  # lengths differ by two at most
        out |= {r for r in misreadings(word) if min(len(word), len(r)) <= SHORT}
    return out


def distance(read: str, word: str) -> float:
    """Weighted edit distance from what was read to a word: confusion pairs are cheap, case is nearly free at the
    beginning, all else is dear."""
    n, m = len(read), len(word)
    big = 99.0
    d = [[big] * (m + 1) for _ in range(n + 1)]
    d[0][0] = 0.0
    for i in range(n + 1):
        for j in range(m + 1):
            best = d[i][j]
            if i and j:
                a, b = read[i - 1], word[j - 1]
                step = 0.0 if a == b else 0.05 if a.lower() == b.lower() else OTHER
                best = min(best, d[i - 1][j - 1] + step)
            if i:
                best = min(best, d[i - 1][j] + OTHER)
            if j:
                best = min(best, d[i][j - 1] + OTHER)
            for p, r in _READ:
                if i >= r and j >= p and (c := _PAIRS.get((word[j - p : j], read[i - r : i]))) is not None:
                    best = min(best, d[i - r][j - p] + c)
            d[i][j] = best
    return d[n][m]


# ------------------------------------------------------------------ operators


def _counts(records: DataFrame) -> DataFrame:
    """kind, a, b, n, divided, dashed over all texts: words ('w'), pairs of neighbouring words ('p': a before b) and
    ideographs that can be confused, in their context ('c': a is the context with a blank for the character b). Of a
    word's n occurrences `divided` were joined at a plain hyphen; `dashed` counts it with a hyphen inside a line."""
    rows = records.where(has_text()).select("text")

    def count(batches):
        words: Counter = Counter()
        pairs: Counter = Counter()
        chars: Counter = Counter()
        divided: Counter = Counter()
        dashed: Counter = Counter()

        def flush():
            names = list(words.keys() | dashed.keys())
            single = len(names)
            out = {
                "kind": ["w"] * single + ["p"] * len(pairs) + ["c"] * len(chars),
                "a": [*names, *(a for a, _ in pairs), *(a for a, _ in chars)],
                "b": [*([""] * single), *(b for _, b in pairs), *(b for _, b in chars)],
                "n": [*(words[w] for w in names), *pairs.values(), *chars.values()],
            }
            none = [0] * (len(pairs) + len(chars))
            out |= {k: [*(c[w] for w in names), *none] for k, c in (("divided", divided), ("dashed", dashed))}
            for c in (words, pairs, chars, divided, dashed):
                c.clear()
            if out["kind"]:
                yield out

        for batch in batches:
            for text in batch["text"]:
                body, _, _ = _body(text)
                tokens = _words(body, divided)
                words.update(tokens)
                if "-" in body:
                    dashed.update(_dashed(body))
                pairs.update(zip(tokens, tokens[1:], strict=False))
                if not body.isascii():
                    chars.update((_context(a, c), b) for a, b, c in _CJK_ODD.findall(body.replace("\n", "")))
            if len(words) + len(pairs) + len(dashed) > 1_000_000:  # bounds the task's memory; partial counts are added up later
                yield from flush()
        yield from flush()

    partial = map_batches(spread(rows), count, "kind string, a string, b string, n bigint, divided bigint, dashed bigint")
    return partial.groupBy("kind", "a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "divided", "dashed")])


def _unbroken() -> Column:
    return F.col("n") - F.col("divided")


def _one_word() -> Column:
    """Whether a word is written as one more often than with a hyphen; what breaks join proves nothing."""
    return _unbroken() > F.col("dashed")


def _lexicon(counts: DataFrame) -> DataFrame:
    """word, n, one (whether a plain hyphen divides it): plain words of one script that occur often enough."""
    often = (F.col("n") >= MIN_COUNT) & ((_unbroken() >= MIN_COUNT) | _one_word())
    return counts.where((F.col("kind") == "w") & often & F.col("a").rlike("^([A-Za-zÀ-ÖØ-öø-ÿŒœßẞ]+|[А-яЁё]+)$") & (F.length("a") > 2)).select(F.col("a").alias("word"), "n", _one_word().alias("one"))


def _candidates(counts: DataFrame) -> DataFrame:
    """token, word, dist, n (of the word): lexicon words that each rarer token may be a misreading of."""
    lexicon = _lexicon(counts)
    # words of one or two letters are like too many others to be told apart; none is longer than a word it may stand for
    # by more than the deletions
    longest = lexicon.agg(F.max(F.length("word")).alias("m"), (F.max("n") / RATIO).alias("most")).collect()[0]
    tokens = counts.where((F.col("kind") == "w") & (F.col("n") > 0) & F.length("a").between(3, (longest.m or 0) + DELETES))

    def index(batches):
        for b in batches:
            o = {"key": [], "word": [], "n": []}
            for w, n in zip(b["word"], b["n"], strict=True):
                for k in keys(w):
                    o["key"].append(k)
                    o["word"].append(w)
                    o["n"].append(n)
            yield o

    def ask(batches):
        for b in batches:
            o = {"key": [], "token": [], "m": []}
            for w, n in zip(b["a"], b["n"], strict=True):
                if _WORDLIKE.search(w) and sum(c.isdigit() for c in w) * 2 <= len(w):
                    for k in deletions(w.lower()):
                        o["key"].append(k)
                        o["token"].append(w)
                        o["m"].append(n)
            yield o

    # what is frequent is a word itself: only tokens that some word could outnumber are asked for
    most = longest.most or 0
    asked = map_batches(tokens.where(F.col("n") <= most), ask, "key string, token string, m bigint")
    posted = map_batches(lexicon, index, "key string, word string, n bigint")
    met = (
        asked.join(posted, "key")
        .where((F.col("token") != F.col("word")) & (F.col("n") >= RATIO * F.col("m")) & (F.abs(F.length("token") - F.length("word")) <= 2))
        .select("token", "word", "n", "m")
        .distinct()
    )

    def weigh(batches):
        for b in batches:
            o = {k: [] for k in ("token", "word", "dist", "n", "m")}
            for t, w, n, m in zip(b["token"], b["word"], b["n"], b["m"], strict=True):
                if t.lower() != w.lower() and (d := distance(t, w)) <= MAX_DISTANCE:
                    for k, v in zip(o, (t, w, d, n, m), strict=True):
                        o[k].append(v)
            yield o

    return map_batches(met, weigh, "token string, word string, dist double, n bigint, m bigint")


def _cjk_repairs(counts: DataFrame) -> DataFrame:
    """context, read, meant: windows of three ideographs whose middle is misread. A window is met under what is left of
    it without its middle (the index's one deletion), by windows that outnumber it CJK_RATIO times, and taken for the
    most frequent one within MAX_DISTANCE, where only confusion pairs are that near."""
    c = counts.where(F.col("kind") == "c").select(F.col("a").alias("context"), F.col("b").alias("ch"), "n")
    asked = c.select("context", F.col("ch").alias("read"), F.col("n").alias("m"))
    posted = c.select("context", F.col("ch").alias("meant"), F.col("n").alias("usual"))
    met = asked.join(posted, "context").where((F.col("read") != F.col("meant")) & (F.col("usual") >= CJK_RATIO * F.col("m")))

    def weigh(batches):
        for b in batches:
            keep = [i for i, (r, w) in enumerate(zip(b["read"], b["meant"], strict=True)) if distance(r, w) <= MAX_DISTANCE]
            yield {k: [b[k][i] for i in keep] for k in ("context", "read", "meant", "usual")}

    near = map_batches(met, weigh, "context string, read string, meant string, usual bigint")
    return near.groupBy("context", "read").agg(F.max_by("meant", F.struct("usual", "meant")).alias("meant"))


def _usual(counts: DataFrame, candidates: DataFrame) -> frozenset[str]:
    """The TOP most frequent words that aren't compounds or taken for a misreading of another; a list of fixed size."""
    words = _lexicon(counts).where("one").join(candidates.select(F.col("token").alias("word")).distinct(), "word", "left_anti")
    return frozenset(r.word for r in words.orderBy(F.desc("n"), "word").limit(TOP).collect())


def analyse(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, frozenset[str]]:
    """(signs, counts, candidates, the usual words). signs: id, noise, token, prev, next: what each text shows. noise is
    'hyphen', 'header' or 'pageno' where the layout proves it; 'hyphen?' with the joined word as token, where a plain
    hyphen may belong to a compound; 'word' with a token outside the usual words and its neighbours; 'cjk' with context
    and character."""
    spark = records.sparkSession
    counts = checkpointed(_counts(records))
    candidates = checkpointed(_candidates(counts))
    words = _usual(counts, candidates)
    known = spark.sparkContext.broadcast(words)
    rows = records.where(F.col("id").isNotNull() & has_text()).select("id", "text")

    def look(batches):
        usual = known.value
        for b in batches:
            o = {k: [] for k in ("id", "noise", "token", "prev", "next")}
            for i, text in zip(b["id"], b["text"], strict=True):
                for row in _signs(text, usual):
                    for k, v in zip(o, (i, *row), strict=True):
                        o[k].append(v)
            yield o

    signs = map_batches(spread(rows), look, "id string, noise string, token string, prev string, next string")
    return signs, counts, candidates, words


def _signs(text: str, usual: frozenset[str]) -> set[tuple[str, str, str, str]]:
    body, numbers, headers = _body(text)
    out = set()
    if numbers:
        out.add(("pageno", "", "", ""))
    if headers:
        out.add(("header", "", "", ""))
    for _, _, a, mark, b in _breaks(body):
        out.add(("hyphen", "", "", "") if mark != "-" or a + b in usual else ("hyphen?", a + b, "", ""))
    tokens = _words(body)
    if headers:  # a misread header is misread text too
        lines = text.split("\n")
        tokens += ["", *(w for i in sorted(headers) for w in _TOKEN.findall(lines[i]))]
    for k, w in enumerate(tokens):
        if w not in usual and len(w) > 2 and _WORDLIKE.search(w):
            out.add(("word", w, tokens[k - 1] if k else "", tokens[k + 1] if k + 1 < len(tokens) else ""))
    if not text.isascii():
        for a, c, z in _CJK_ODD.findall(body.replace("\n", "")):
            if c in CJK_CONFUSIONS:
                out.add(("cjk", _context(a, z), c, ""))
    return out


def _divided(signs: DataFrame, counts: DataFrame, candidates: DataFrame) -> DataFrame:
    """id, token: joined words that a plain hyphen divides, since they, or what they are misreadings of, are written as
    one elsewhere, and more often so than with the hyphen."""
    asked = signs.where(F.col("noise") == "hyphen?").select("id", "token").distinct()
    words = counts.where((F.col("kind") == "w") & _one_word()).select(F.col("a").alias("token"))
    misread = candidates.join(words.select(F.col("token").alias("word")), "word", "left_semi").select("token")
    return asked.join(words.unionByName(misread).distinct(), "token", "left_semi")


def _resolved(signs: DataFrame, counts: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kinds by layout, misread words, misread ideographs)."""
    words = signs.where(F.col("noise") == "word").join(candidates, "token")
    pair = counts.where(F.col("kind") == "p").select(F.col("a").alias("x"), F.col("b").alias("y"), F.col("n").alias("np"))
    before = pair.select(F.col("x").alias("prev"), F.col("y").alias("word"), F.col("np").alias("n_before"))
    after = pair.select(F.col("x").alias("word"), F.col("y").alias("next"), F.col("np").alias("n_after"))
    scored = (
        words.join(before, ["prev", "word"], "left")
        .join(after, ["word", "next"], "left")
        .withColumn(
            "score",
            F.log10(F.col("n").cast("double")) / 2 - 4 * F.col("dist")
            + F.log10(1 + F.coalesce("n_before", F.lit(0))) + F.log10(1 + F.coalesce("n_after", F.lit(0))),
        )
    )
    w = Window.partitionBy("id", "token", "prev", "next").orderBy(F.desc("score"), "word")
    best = scored.withColumn("r", F.row_number().over(w)).where("r = 1").select("id", "token", "prev", "next", "word")
    cjk = signs.where(F.col("noise") == "cjk").select("id", F.col("token").alias("context"), F.col("prev").alias("read")).join(_cjk_repairs(counts), ["context", "read"])
    proven = _divided(signs, counts, candidates).select("id", F.lit("hyphen").alias("noise"))
    plain = signs.where(F.col("noise").isin("hyphen", "header", "pageno")).select("id", "noise").unionByName(proven)
    return plain, best, cjk


def noise_kinds(records: DataFrame) -> DataFrame:
    """id, noise: the kinds of scan noise in each text; distinct rows.

    Null ids, null and blank texts give no row; hard-wrapped lines and numbers of the content are no noise.
    """
    signs, counts, candidates, _ = analyse(records)
    plain, best, cjk = _resolved(checkpointed(signs), counts, candidates)
    glyph = best.select("id").unionByName(cjk.select("id")).withColumn("noise", F.lit("glyph"))
    return plain.unionByName(glyph).distinct()


def repair_text(
    text: str | None, words: dict[tuple[str, str, str], str], chars: dict[tuple[str, str], str], joined: Container[str]
) -> str | None:
    """Continuous paragraphs: furniture removed, divided words joined, misread ones replaced, wrapped lines joined.
    `words` gives the word meant by (word before, token, word after). Lines of tables and lists (tabs, separators,
    bullets, short fields) stay lines."""
    if not text:
        return text
    body, joints = _join(_body(text)[0])
    edits = [(at, at, gap) for at, gap, mark, whole in joints if mark == "-" and whole not in joined]
    if words:
        tokens = list(_TOKEN.finditer(body))
        for k, m in enumerate(tokens):
            before, after = tokens[k - 1].group() if k else "", tokens[k + 1].group() if k + 1 < len(tokens) else ""
            if (meant := words.get((before, m.group(), after))) is not None:
                edits.append((m.start(), m.end(), meant))
    if edits:
        parts, at = [], 0
        for s, e, new in sorted(edits):
            if s >= at:
                parts += [body[at:s], new]
                at = e
        body = "".join(parts) + body[at:]
    if chars:
        for (context, read), meant in sorted(chars.items()):
            a, z = map(_read_as, context.split(" "))
            body = re.sub(f"({a}\n?){read}(?=\n?{z})", lambda m, y=meant: m[1] + y, body)
    out = []
    for block in re.split(r"\n[ \t\x0c]*\n\s*", body.strip("\n\x0c")):
        lines = [x.rstrip() for x in block.split("\n")]
        table = sum(bool(re.search(r"\t| \| |;[^ ]|^[-•*] |^[A-Z][a-z]+: \S|^\d[\d/. A-Za-z-]{5,12} \d\d:\d\d ", x)) for x in lines) * 2 >= len(lines)
        if table or len(lines) == 1:
            out.append("\n".join(lines))
            continue
        para = lines[0]
        for x in lines[1:]:
            x = x.lstrip()
            glue = "" if re.search("[一-鿿，。；：、（]$", para) or re.match("[一-鿿，。；：、）]", x) and not para[-1:].isascii() else " "
            para += glue + x
        out.append(para)
    return "\n\n".join(out)


def repaired(records: DataFrame) -> DataFrame:
    """id, text: each record's text as continuous readable paragraphs; one row for each id, that of its row
    with text.

    Null, blank and empty texts come out as they are. The repairs of a text (its misread words, ideographs and divided
    words) meet it by its id; a text has no more of them than it has words.
    """
    signs, counts, candidates, words = analyse(records)
    signs = checkpointed(signs)
    _, best, cjk = _resolved(signs, counts, candidates)
    divided = _divided(signs, counts, candidates)
    fixes = (
        best.groupBy("id").agg(F.collect_set(F.struct("prev", "token", "next", "word")).alias("words"))
        .join(cjk.groupBy("id").agg(F.collect_set(F.struct("context", "read", "meant")).alias("chars")), "id", "full")
        .join(divided.groupBy("id").agg(F.collect_set("token").alias("joined")), "id", "full")
    )
    known = records.sparkSession.sparkContext.broadcast(words)
    rows = one_row_per_id(records, ["text"]).join(fixes, "id", "left")

    def run(batches):
        usual = known.value
        for b in batches:
            new = []
            for text, ws, cs, js in zip(b["text"], b["words"], b["chars"], b["joined"], strict=True):
                joined = usual.union(js) if js else usual
                meant = {(w["prev"], w["token"], w["next"]): w["word"] for w in ws or ()}
                new.append(repair_text(text, meant, {(c["context"], c["read"]): c["meant"] for c in cs or ()}, joined))
            yield {"id": b["id"], "text": new}

    return map_batches(rows, run, "id string, text string")
