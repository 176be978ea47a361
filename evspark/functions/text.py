"""Text functions over columns: normalisation, matching of whole words, snippets, n-grams."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Address forms in front of a DOI, in the order in which they are taken off.
DOI_PREFIXES = ("https://doi.org/", "http://doi.org/", "https://dx.doi.org/", "http://dx.doi.org/", "doi:")

SNIPPET = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("snippet", T.StringType())]))


def fold(text: str | None) -> str:
    """Decomposed, without combining marks, in small letters, other characters as one space."""
    if not text:
        return ""
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return re.sub("[^a-z0-9]+", " ", text.lower()).strip()


@F.pandas_udf(T.StringType())
def _fold_udf(texts: pd.Series) -> pd.Series:
    return texts.map(fold)


def norm_text(column: Column) -> Column:
    """Normal form of titles and names (FN-1). NULL gives "".

    Texts of ASCII only, which are most, stay in the JVM: the Python branch sees NULL for them.
    """
    plain = column.rlike(r"^[\x00-\x7F]*$")
    native = F.trim(F.regexp_replace(F.lower(column), "[^a-z0-9]+", " "))
    return F.when(column.isNull(), F.lit("")).when(plain, native).otherwise(_fold_udf(F.when(~plain, column)))


def norm_doi(column: Column) -> Column:
    """DOI without address, in small letters (FN-2). NULL gives ""."""
    out = F.lower(F.trim(F.coalesce(column, F.lit(""))))
    for prefix in DOI_PREFIXES:
        out = F.when(F.startswith(out, F.lit(prefix)), F.substring(out, F.lit(len(prefix) + 1), F.length(out))).otherwise(out)
    return F.trim(out)


def surname(column: Column) -> Column:
    """What stands before the first comma, else before the first space (FN-3)."""
    c = F.coalesce(column, F.lit(""))
    return F.when(F.contains(c, F.lit(",")), F.substring_index(c, ",", 1)).otherwise(F.substring_index(c, " ", 1))


def screening_text(column: Column) -> Column:
    """Straight apostrophes, single spaces, small letters (FN-4). NULL gives ""."""
    straight = F.translate(F.coalesce(column, F.lit("")), "’‘", "''")
    return F.lower(F.trim(F.regexp_replace(straight, r"(?U)\s+", " ")))


def java_pattern(pattern: str) -> str:
    """A Python pattern as Java reads it: named groups, and classes that know all of Unicode."""
    return "(?U)" + re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", pattern.replace("(?P<", "(?<"))


def term_pattern(term: str) -> str:
    """Whole-word pattern of a term (FN-5), read alike by Java and Python."""
    return r"(?<![a-z0-9])" + re.escape(term.lower()) + r"(?![a-z0-9])"


def glob_pattern(glob: str) -> str:
    """Pattern of a case-sensitive glob with *, ? and [...] (FLT-3)."""
    out, i = "", 0
    while i < len(glob):
        c = glob[i]
        end = glob.find("]", i + 2) if c == "[" else -1
        if c == "*":
            out += ".*"
        elif c == "?":
            out += "."
        elif end > 0:
            inner = glob[i + 1 : end].replace("\\", "\\\\")
            out += "[" + ("^" + inner[1:] if inner[0] == "!" else inner.replace("^", "\\^")) + "]"
            i = end
        else:
            out += re.escape(c)
        i += 1
    return "(?s)^" + out + r"\z"


def any_glob(column: Column, globs: list[str]) -> Column:
    out = F.lit(False)
    for g in globs:
        out = out | column.rlike(glob_pattern(g))
    return out


def count_words(column: Column) -> Column:
    """Words of a normalised text (FN-7)."""
    return F.size(F.filter(F.split(column, " "), lambda w: w != "")).cast("long")


def snippets(column: Column, terms: list[str], patterns: list[str] = [], most: int = 3, around: int = 60) -> Column:  # noqa: B006
    """The first ``most`` matches in the order of terms, then patterns, each with its surroundings (FN-10, SRT-4)."""
    named = [(t, re.compile(term_pattern(t))) for t in terms] + [(p, re.compile(p)) for p in patterns]

    @F.pandas_udf(SNIPPET)
    def find(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            hits = []
            for name, pattern in named:
                if len(hits) >= most or not text:
                    break
                for m in pattern.finditer(text):
                    hits.append({"term": name, "snippet": text[max(0, m.start() - around) : m.end() + around]})
                    if len(hits) >= most:
                        break
            out.append(hits)
        return pd.Series(out)

    return find(column)


def first_snippet(column: Column, term: str, around: int = 60) -> Column:
    """The first match of a term with its surroundings, without leaving the JVM; NULL if there is none."""
    at = F.regexp_instr(column, F.lit(term_pattern(term)))
    start = F.greatest(F.lit(1), at - around)
    return F.when(at > 0, F.substring(column, start, at - start + len(term) + around))


def ngrams(text: str | None, n: int = 4) -> set[tuple[str, ...]]:
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def quote_share(quote: Column, source: Column, n: int = 4) -> Column:
    """The part of the quote's distinct n-word runs that occur in the source (FN-22); 0 if it has none."""

    @F.pandas_udf(T.DoubleType())
    def share(quotes: pd.Series, sources: pd.Series) -> pd.Series:
        out = []
        for q, s in zip(quotes, sources, strict=True):
            own = ngrams(q, n)
            out.append(len(own & ngrams(s, n)) / len(own) if own else 0.0)
        return pd.Series(out, dtype="float64")

    return share(quote, source)


def sequence_ratio_bound(a: Column, b: Column) -> Column:
    """An upper bound of the Ratcliff-Obershelp ratio by lengths: prunes pairs before Python sees them."""
    la, lb = F.length(a), F.length(b)
    return F.when(la + lb > 0, 2 * F.least(la, lb) / (la + lb)).otherwise(1.0)
