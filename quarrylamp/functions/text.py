"""Column functions: paths, identities, term counts, snippets, tokens. All are built-in expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Extension groups of the inventory (fixed values).
EXT_GROUPS = {
    "doc": [".docx", ".doc", ".pdf", ".pptx", ".ppt", ".xlsx", ".xls", ".odt", ".rtf", ".txt", ".md", ".html", ".htm", ".eml", ".msg"],
    "data": [".json", ".jsonl", ".xml", ".csv", ".tsv", ".yaml", ".yml"],
    "code": [".py", ".c", ".cpp", ".h", ".hpp", ".rs", ".go", ".js", ".ts", ".java", ".sh", ".sql", ".tf"],
    "image": [".png", ".jpg", ".jpeg", ".gif", ".svg", ".bmp", ".webp", ".tiff"],
    "binary": [".tar", ".zip", ".gz", ".zst", ".7z", ".rpm", ".deb", ".so", ".o", ".pyc", ".jar", ".war", ".class", ".rar"],
}
#: Extensions that text is extracted from (fixed values).
EXTRACTABLE = [*EXT_GROUPS["doc"], *EXT_GROUPS["data"]]


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def suffix(path: str | Column) -> Column:
    """Lower-case suffix of the last path part; '' for dotfiles, a trailing dot and names without a dot."""
    return F.lower(F.regexp_extract(_c(path), r"[^/](\.[^./]+)$", 1))


def last_dot(path: str | Column) -> Column:
    """Everything from the last dot of the whole lower-case path on, '' if there is none."""
    return F.regexp_extract(F.lower(_c(path)), r"(\.[^.]+)$", 1)


def ext_group(ext: str | Column) -> Column:
    out = F.lit("other")
    for group, exts in EXT_GROUPS.items():
        out = F.when(_c(ext).isin(exts), F.lit(group)).otherwise(out)
    return out


def sha1_id(path: str | Column) -> Column:
    """The 16-digit identity of a path."""
    return F.substring(F.sha1(_c(path)), 1, 16)


def chunk_id(doc_id: str | Column, index: str | Column) -> Column:
    return F.format_string("%s:%04d", _c(doc_id), _c(index))


def has_cjk(c: str | Column) -> Column:
    return _c(c).rlike("[\\u4e00-\\u9fff]")


def is_cjk(term: str) -> bool:
    return bool(re.search("[一-鿿]", term))


def term_pattern(term: str) -> str:
    """Java pattern of a term: ideographs match literally; other terms between Unicode word boundaries, any case."""
    quoted = re.sub(r"([\\.\[\]{}()*+?^$|#&~-])", r"\\\1", term)
    return quoted if is_cjk(term) else rf"(?iuU)\b{quoted}\b"


def term_count(text: str | Column, term: str) -> Column:
    """Occurrences of a term that don't overlap."""
    text = F.coalesce(_c(text), F.lit(""))
    if is_cjk(term):
        return F.floor((F.length(text) - F.length(F.replace(text, F.lit(term), F.lit("")))) / len(term)).cast("int")
    return F.regexp_count(text, F.lit(term_pattern(term)))


def collapse(c: str | Column) -> Column:
    return F.trim(F.regexp_replace(_c(c), r"\s+", " "))


def collapse_cut(c: str | Column, limit: int) -> Column:
    """White space collapsed, cut at `limit` characters with an ellipsis."""
    flat = collapse(c)
    return F.when(F.length(flat) > limit, F.concat(F.left(flat, F.lit(limit)), F.lit("…"))).otherwise(flat)


def snippet(text: str | Column, term: str, chars: int = 160) -> Column:
    """The first match of a term with `chars` characters to either side, on one line; an ellipsis marks a cut side.
    Null where the term doesn't occur. Places count code points, also beyond the basic plane."""
    text = _c(text)
    start = (
        F.instr(text, term) - 1
        if is_cjk(term)
        else F.when(
            text.rlike(term_pattern(term)),
            F.length(F.regexp_extract(text, rf"(?s)^(.*?){term_pattern(term)}", 1)),
        ).otherwise(-1)
    )
    a = F.greatest(start - chars, F.lit(0))
    b = F.least(start + len(term) + chars, F.length(text))
    body = collapse(F.substring(text, a + 1, b - a))
    whole = F.concat(F.when(a > 0, F.lit("…")).otherwise(F.lit("")), body, F.when(b < F.length(text), F.lit("…")).otherwise(F.lit("")))
    return F.when(start >= 0, whole)


def short_filename(path: str | Column) -> Column:
    """Stem without its numeric attachment prefix, unsafe characters as '_', at most 80 characters."""
    name = F.element_at(F.split(_c(path), "/"), -1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")
    stem = F.regexp_replace(stem, r"^\d+_attachments_", "")
    return F.left(F.regexp_replace(stem, r"(?U)[^\w一-鿿-]", "_"), F.lit(80))


def stub_tokens(text: str | Column) -> Column:
    """One token for each ideograph, else for each run without white space or ideographs."""
    return F.regexp_extract_all(F.coalesce(_c(text), F.lit("")), F.lit(r"[一-鿿]|[^\s一-鿿]+"), 0)


#: Accents that full-text search folds (fixed values).
FOLD_FROM = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
FOLD_TO = "aaaaaaceeeeiiiinooooouuuuyy"


def search_tokens(text: str | Column) -> Column:
    """Tokens of full-text search: runs of letters and digits, lower case, accents folded."""
    folded = F.translate(F.lower(F.coalesce(_c(text), F.lit(""))), FOLD_FROM, FOLD_TO)
    return F.regexp_extract_all(folded, F.lit(r"[\p{L}\p{N}]+"), 0)


def fold_query(text: str) -> list[str]:
    """Distinct tokens of a query, in order, as search_tokens makes them."""
    out = text.lower().translate(str.maketrans(FOLD_FROM, FOLD_TO))
    return list(dict.fromkeys(re.findall(r"[^\W_]+", out)))


def estimate_cost(model: str | Column, tokens_in: Column, tokens_out: Column, cache_write: Column, cache_read: Column) -> Column:
    """Cost of a call in dollars by the rates of its model family, for a million tokens (fixed values)."""
    big = _c(model).contains("opus")

    def rate(a: float, b: float) -> Column:
        return F.when(big, F.lit(a)).otherwise(F.lit(b))

    z = F.lit(0)
    return (
        F.coalesce(tokens_in, z) * rate(5.0, 3.0)
        + F.coalesce(tokens_out, z) * rate(25.0, 15.0)
        + F.coalesce(cache_write, z) * rate(6.25, 3.75)
        + F.coalesce(cache_read, z) * rate(0.5, 0.3)
    ) / 1_000_000
