"""Problem 6: missing or wrong language labels, and texts in several languages.

Method: multilingual mixture inference. Every segment (a sentence, or a paragraph without sentences) gets a likelihood
under each language's n-gram model; expectation-maximisation estimates the document's language proportions from them,
and the set of languages grows while the likelihood gains more than a penalty for each.

All six languages have n-gram models (character trigrams of words, pairs of ideographs) fitted on a bounded sample of
labelled texts (SAMPLE for each language), refitted once without the segments that the first fit puts elsewhere, since
labels are unreliable and texts are mixed. A text with many letters that its likeliest language doesn't have is in another language; one in
another language with the same letters gets the nearest of the six, as a narrow corpus can't tell it from an unusual
text.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import spread
from .base import has_text, label_lang, map_batches

LANGS = ("zh", "ru", "en", "fr", "es", "de")
#: What a text in none of these languages comes out as.
OTHER = "other"
#: Labelled texts on which a language's model is fitted, at most, and characters of each of them.
SAMPLE, SAMPLE_CHARS = 500, 8_000
MIN_CHARS = 60
#: Log-likelihood that a further language must gain; whole sentences of a passage in it.
PENALTY, SENTENCES = 12.0, 2
#: Log-likelihood by which a lone segment in another language must beat the main one.
MARGIN = 8.0
#: Share of a text's letters, and number of them, that its language doesn't have, from which it is in another language.
STRANGE, STRANGE_LETTERS = 0.05, 8
_ALPHA = 0.05
#: Kinds of n-grams reckoned with in each script: trigrams of Latin and Cyrillic words, pairs of ideographs.
_KINDS = (8000.0, 8000.0, 60_000.0)

_LATIN, _CYRILLIC = "A-Za-zÀ-ÖØ-öø-ÿŒœẞ", "А-яЁЂ-Џѐ-џҐґ"
#: Words that can tell a language: no parts of names with numbers, addresses or identifiers, none all in capitals; and
#: runs of ideographs.
_WORD = re.compile(
    rf"(?<![\w@.+-])(?:[{_LATIN}]*[a-zà-öø-ÿœß]|[{_CYRILLIC}]*[а-яѐ-џґ])(?![\w@+]|-\d|\.\w)|[一-鿿]+"
)
_CJK = re.compile(r"[一-鿿]")
_CYR = re.compile(rf"[{_CYRILLIC}]")
_ODD = re.compile(r"[^\W\d_\x00-\x7f一-鿿]")
_PLAIN = re.compile("[A-Za-z一-鿿]")
_END = re.compile(r"(?<=[.!?…])[\"'”’»)]*\s+(?=[\"'“‘«(¿¡-]*\s?[A-ZÀ-ÖØ-ÞА-ЯЁ\d一-鿿])|(?<=[。！？])[”’」』）]*\s*|\n[ \t]*\n\s*|\n(?=[-•*] )")


def segments(text: str) -> list[tuple[int, int]]:
    """Spans of sentences; a paragraph or list item without a full stop is one span."""
    out, at = [], 0
    for m in _END.finditer(text):
        if m.end() > at and text[at : m.start()].strip():
            out.append((at, m.start() if text[m.start() : m.end()].isspace() else m.end()))
        at = m.end()
    if text[at:].strip():
        out.append((at, len(text)))
    return out


def _units(part: str) -> list[str]:
    """Words of a text, and its ideographs in pairs of neighbours."""
    found = _WORD.findall(part)
    if part.isascii():
        return found
    out = []
    for w in found:
        if w[0] < "一":
            out.append(w)
        elif len(w) == 1:
            out.append(w)
        else:
            out += map("".join, zip(w, w[1:], strict=False))
    return out


def _script(unit: str) -> int:
    """0 Latin, 1 Cyrillic, 2 ideographs."""
    return 2 if unit[0] >= "一" else 1 if "Ѐ" <= unit[0] < "԰" else 0


def _grams(unit: str) -> list[str]:
    if unit[0] >= "一":
        return [unit]
    p = f"^{unit.lower()}$"
    return [p[i : i + 3] for i in range(len(p) - 2)]


class Model:
    """Log-probabilities of n-grams under each language: that of the n-gram's script in the language, times that of the
    n-gram among those of the script. `letters` are each language's letters beyond ASCII and ideographs."""

    def __init__(self, counts: dict[str, Counter]):
        self.grams = [counts[k] for k in LANGS]
        self.letters = []
        for c in self.grams:
            seen: Counter = Counter()
            for g, n in c.items():
                for x in g:
                    if not x.isascii() and x < "一":
                        seen[x] += n
            most = max(3, sum(c.values()) // 2000)
            self.letters.append(frozenset(x for x, n in seen.items() if n >= most))
        self.base = np.empty((3, len(LANGS)))
        for j, c in enumerate(self.grams):
            held = np.zeros(3)
            for g, n in c.items():
                held[_script(g.strip("^$") or "a")] += n
            for s in range(3):
                self.base[s, j] = math.log((held[s] + 1) / (held.sum() + 3)) - math.log(held[s] + _ALPHA * _KINDS[s])
        self._clear()

    def _clear(self) -> None:
        self.places: dict[str, int] = {}
        self.rows = np.empty((1024, len(LANGS)))

    def __getstate__(self):
        return {"grams": self.grams, "letters": self.letters, "base": self.base}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._clear()

    def units(self, units: list[str]) -> np.ndarray:
        """Log-probabilities of each unit under each language; a unit's are reckoned once."""
        if len(self.places) > 500_000:
            self._clear()
        ids = []
        for w in units:
            if (k := self.places.get(w)) is None:
                k = self.places[w] = len(self.places)
                if k == len(self.rows):
                    self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
                grams, script = _grams(w), _script(w)
                for j, c in enumerate(self.grams):
                    self.rows[k, j] = sum(math.log(c.get(g, 0) + _ALPHA) for g in grams) + len(grams) * self.base[script, j]
            ids.append(k)
        return self.rows[ids]


def fit(texts: dict[str, list[str]]) -> Model:
    """Fits the models on texts by label, then again on those segments of them only that the first fit puts under their
    label, since labels are unreliable and texts are mixed. A language without texts gets the pooled counts of all, so it
    never wins by being unknown."""
    cut = {k: [[u for s, e in segments(t) if (u := _units(t[s:e]))] for t in texts.get(k, [])] for k in LANGS}
    model = None
    for _ in range(2):
        counts: dict[str, Counter] = {}
        for j, k in enumerate(LANGS):
            units: Counter = Counter()
            for parts in cut[k]:
                keep = [True] * len(parts)
                if model and parts:
                    ends = np.cumsum([0, *map(len, parts[:-1])])
                    keep = np.add.reduceat(model.units([u for p in parts for u in p]), ends, axis=0).argmax(axis=1) == j
                for p, ok in zip(parts, keep, strict=True):
                    if ok:
                        units.update(p)
            counts[k] = Counter()
            for u, n in units.items():
                for g in _grams(u):
                    counts[k][g] += n
        pooled: Counter = Counter()
        for c in counts.values():
            pooled.update(c)
        model = Model({k: c or pooled for k, c in counts.items()})
    return model


def likelihoods(text: str, spans: list[tuple[int, int]], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log-likelihood of every segment under each of LANGS, which segments tell a language at all: those with five
    ideographs, three Cyrillic letters or two words in small letters; and their weights: the letters of words that
    aren't capitalised, as lists of names belong to any language)."""
    n = len(spans)
    out = np.zeros((n, len(LANGS)))
    found, sizes, told, weights = [], np.zeros(n, int), np.zeros(n, bool), np.ones(n)
    for i, (s, e) in enumerate(spans):
        part = text[s:e]
        units = _units(part)
        found += units
        sizes[i] = len(units)
        small = sum(w[0].islower() for w in units[:12]) if len(units) > 1 else 0
        weights[i] += sum(len(w) for w in units if not w[0].isupper())
        told[i] = small > 1 or not part.isascii() and (len(_CYR.findall(part)) > 2 or len(_CJK.findall(part)) > 4)
    if found:
        some = sizes > 0
        out[some] = np.add.reduceat(model.units(found), (np.cumsum(sizes) - sizes)[some], axis=0)
    return out, told, weights


def mixture(loglik: np.ndarray, weights: np.ndarray, penalty: float = PENALTY) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(languages, their proportions, posterior of each segment under them), by penalised likelihood."""

    def em(langs: list[int]) -> tuple[float, np.ndarray, np.ndarray]:
        x = loglik[:, langs]
        top = x.max(axis=1, keepdims=True)
        p = np.exp(x - top)
        pi = np.full(len(langs), 1 / len(langs))
        r = p
        for _ in range(30):
            r = p * pi
            total = r.sum(axis=1, keepdims=True)
            r = r / total
            new = (r * weights[:, None]).sum(axis=0) / weights.sum()
            if np.abs(new - pi).max() < 1e-4:
                pi = new
                break
            pi = np.maximum(new, 1e-6)
        return float((np.log((p * pi).sum(axis=1)) + top[:, 0]).sum()), pi, r

    best = [int((loglik.sum(axis=0)).argmax())]
    score, pi, r = em(best)
    # no mixture is likelier than each segment's best language: where that gains too little there is nothing to try
    while len(best) < loglik.shape[1] and loglik.max(axis=1).sum() - score >= penalty:
        tries = [(em([*best, k]), k) for k in range(loglik.shape[1]) if k not in best]
        (s, p, q), k = max(tries, key=lambda t: t[0][0])
        if s - score < penalty:
            break
        best, score, pi, r = [*best, k], s, p, q
    return best, pi, r


def analyse(text: str, model: Model) -> tuple[list[tuple[str, float]], list[tuple[int, int, str, float]]]:
    """(languages of the text with confidence, the main one first; passages (start, end, lang, confidence) in any
    other language). A passage has at least SENTENCES whole sentences; what is shorter belongs to the language
    around it."""
    spans = segments(text)
    loglik, tells, weights = likelihoods(text, spans, model)
    told = np.flatnonzero(tells)
    if not len(told):
        strange, letters = _strange(text, frozenset())
        return ([(OTHER, strange / letters)], []) if strange >= STRANGE_LETTERS and 2 * strange > letters else ([], [])
    x = loglik[told]
    langs, pi, r = mixture(x, weights[told])
    strange, letters = _strange(text, frozenset().union(*(model.letters[k] for k in langs)))
    if strange >= STRANGE_LETTERS and strange > STRANGE * letters:
        return [(OTHER, min(1.0, strange / (2 * STRANGE * letters)))], []
    order = np.argsort(-pi)
    main = langs[int(order[0])]
    runs: list[tuple[int, int, int, float]] = []
    if len(langs) > 1:
        pick = r.argmax(axis=1)
        i = 0
        while i < len(told):
            j = i
            while j + 1 < len(told) and pick[j + 1] == pick[i]:
                j += 1
            lang = langs[int(pick[i])]
            if lang != main:
                whole = sum(_whole(text, spans[told[q]], lang) for q in range(i, j + 1))
                if whole >= SENTENCES:
                    runs.append((spans[told[i]][0], spans[told[j]][1], lang, float(r[i : j + 1, pick[i]].mean())))
            i = j + 1
        # a passage can outweigh the text that it was put into, whose own language then shows in a title, a table or
        # single sentences
        passage = sum(_whole(text, spans[t], main) for q, t in enumerate(told) if langs[int(pick[q])] == main)
        for k in langs:
            sure = [q for q in range(len(told)) if langs[int(pick[q])] == k and x[q, k] - x[q, main] > MARGIN]
            if k != main and k not in {q for _, _, q, _ in runs} and len(sure) >= 2 and passage >= SENTENCES:
                runs += [(*spans[told[q]], k, float(r[q, pick[q]])) for q in sure]
    kept = {main} | {k for _, _, k, _ in runs}
    # confidence in the main language: posterior over all languages of its own segments together, by the mean margin
    rest = [k for k in range(len(LANGS)) if k not in kept]
    own = x[[i for i in range(len(told)) if langs[int(r[i].argmax())] == main]] if len(langs) > 1 else x
    margin = (own[:, main] - own[:, rest].max(axis=1)).sum() if len(own) and rest else 50.0
    conf = 1 / (1 + math.exp(-max(min(margin / 4, 50.0), -50.0)))
    out = [(LANGS[main], conf)]
    for k in dict.fromkeys(k for _, _, k, _ in runs):
        out.append((LANGS[k], max(c for _, _, q, c in runs if q == k)))
    return out, [(s, e, LANGS[k], c) for s, e, k, c in runs]


def _strange(text: str, known: frozenset[str]) -> tuple[int, int]:
    """(letters that are neither ASCII, ideographs nor known; all letters)."""
    if text.isascii():
        return 0, len(text)
    odd = _ODD.findall(text)
    return sum(c.lower() not in known for c in odd), len(odd) + len(_PLAIN.findall(text))


def _whole(text: str, span: tuple[int, int], lang: int) -> bool:
    """Whether the segment is a sentence with its end, long enough to be one."""
    part = text[span[0] : span[1]].rstrip(" \n\t\"'”’»)]")
    return part[-1:] in tuple(".!?…。！？") and (len(part) >= 20 or lang == 0 and len(part) >= 8)


def fit_on(records: DataFrame, sample: int = SAMPLE) -> Model:
    """The model fitted on `sample` texts for each language at most, those with the smallest hashes of their ids, and on
    SAMPLE_CHARS characters of each of them, taken from its middle. One pass over the texts."""
    labelled = records.where(F.col("id").isNotNull() & has_text()).select("id", label_lang("lang").alias("lang"), "text").where(F.col("lang").isin(*LANGS))
    at = F.greatest(F.floor((F.length("text") - SAMPLE_CHARS) / 2), F.lit(0)).cast("int") + 1
    row = F.struct(F.xxhash64("id").alias("h"), "id", F.substring("text", at, F.lit(SAMPLE_CHARS)).alias("text"))
    w = Window.partitionBy("lang").orderBy("h", "id", "text")
    # each task hands on the best rows of its own only
    first = labelled.select("lang", row.alias("r")).select("lang", "r.*").withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= sample)
    texts: dict[str, list[str]] = {k: [] for k in LANGS}
    for r in sorted(first.select("lang", "h", "id", "text").collect(), key=lambda r: (r.h, r.id, r.text)):
        texts[r.lang].append(r.text)
    return fit(texts)


def identify(records: DataFrame, model: Model | None = None, min_chars: int = 1) -> DataFrame:
    """Rows id, label, lang, confidence, passage_start, passage_end: one for the main language of each record's text
    (passage_start and passage_end are null) and one for each passage in another language.

    label is the language that the record's own label names, '' if none. Null ids, null and blank texts and texts of
    fewer than `min_chars` code points give no row; a text that tells no language (digits, names) gives one with lang
    null and confidence 0, one in none of the languages has lang 'other'. Repeated rows count once. One pass, no shuffle of texts; the model is small and fixed in
    size by the number of trigrams.
    """
    shared = records.sparkSession.sparkContext.broadcast(model or fit_on(records))
    rows = records.where(F.col("id").isNotNull() & has_text() & (F.length("text") >= min_chars)).select(
        "id", label_lang("lang").alias("label"), "text"
    )

    def run(batches):
        m = shared.value
        for b in batches:
            o = {k: [] for k in ("id", "label", "lang", "confidence", "passage_start", "passage_end")}
            for i, label, text in zip(b["id"], b["label"], b["text"], strict=True):
                langs, runs = analyse(text, m)
                rows = [(langs[0][0], langs[0][1], None, None)] if langs else [(None, 0.0, None, None)]
                rows += [(k, c, s, e) for s, e, k, c in runs]
                for lang, conf, s, e in rows:
                    for k, v in zip(o, (i, label, lang, conf, s, e), strict=True):
                        o[k].append(v)
            yield o

    return map_batches(spread(rows), run, "id string, label string, lang string, confidence double, passage_start int, passage_end int").distinct()


def mislabelled(records: DataFrame, model: Model | None = None) -> DataFrame:
    """id, lang: every language of each text of at least MIN_CHARS whose label names none of them or that has a passage
    in a second one."""
    found = identify(records, model, MIN_CHARS).where(F.col("lang").isin(*LANGS))
    per = found.groupBy("id").agg(
        F.collect_set("lang").alias("langs"),  # at most the languages there are
        F.max("label").alias("label"),
    )
    wrong = (F.size("langs") > 1) | ~F.array_contains("langs", F.col("label"))
    return per.where(wrong).select("id", F.explode("langs").alias("lang"))
