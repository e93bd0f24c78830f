"""Column functions of texts: cleaning, normalising, similarity. All are native expressions unless named a UDF."""

from __future__ import annotations

from bisect import bisect_left
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What no label or identifier holds: separators, format characters, white controls, and format characters that older Unicode
#: tables don't know yet.
INVISIBLE = r"[\p{Z}\p{Cf}\x{9}-\x{D}\x{1C}-\x{1F}\x{85}\x{890}\x{891}\x{13430}-\x{1343F}]"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_invisible(x: Column | str) -> Column:
    return F.regexp_replace(_col(x), INVISIBLE, "")


def canonical_newlines(x: Column | str) -> Column:
    """CRLF and CR become LF; nothing is collapsed."""
    return F.regexp_replace(_col(x), "\r\n?", "\n")


def without_nul(x: Column | str) -> Column:
    return F.regexp_replace(_col(x), "\\x{0}", "")


def norm_title(x: Column | str) -> Column:
    """Tags out, lower case, runs of anything but letters and digits to one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(_col(x), "<[^>]*>", " ")), r"[^\p{L}\p{N}]+", " "))


def collapse_space(x: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(x), r"\s+", " "))


def tokens(x: Column | str) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.filter(F.split(norm_title(x), " "), lambda w: w != "")


def trigrams(x: Column | str) -> Column:
    """Distinct trigrams of each word padded with two blanks before and one behind."""
    padded = F.transform(tokens(x), lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    grams = F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def trigram_similarity(a: Column, b: Column) -> Column:
    """Jaccard index of two trigram sets; 0 where both are empty."""
    both = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(both.cast("double"), (F.size(a) + F.size(b) - both).cast("double")), F.lit(0.0))


def url_host(x: Column | str) -> Column:
    return F.lower(F.regexp_extract(_col(x), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def without_query(x: Column | str) -> Column:
    return F.regexp_replace(_col(x), r"[?#].*$", "")


def html_to_text(x: Column | str) -> Column:
    """Script and style bodies out, tags to blanks, white space collapsed."""
    bare = F.regexp_replace(_col(x), r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", " ")
    return collapse_space(F.regexp_replace(bare, r"(?s)<[^>]*>", " "))


def links(x: Column | str) -> Column:
    return F.regexp_extract_all(_col(x), F.lit(r"""(?i)<a\b[^>]*\bhref\s*=\s*["']([^"']+)["']"""), F.lit(1))


def first_sentence(x: Column | str, most: int = 200) -> Column:
    return F.substring(F.regexp_extract(_col(x), r"^\s*([^.!?\n]*[.!?]?)", 1), 1, most)


def safe_tag(x: Column | str) -> Column:
    return F.regexp_replace(_col(x), r"[^A-Za-z0-9._-]+", "_")


def norm_step(x: Column | str) -> Column:
    """A step's name without its phase suffix and year."""
    return F.regexp_replace(F.regexp_replace(_col(x), r"_?(19|20)\d{2}[a-z]?$", ""), r"_(start|end|begin|done)$", "")


def page_range(x: Column | str) -> Column:
    """struct(first, last) of ``a-b`` or ``a``; null if it isn't one."""
    first, last = F.try_element_at(F.regexp_extract_all(_col(x), F.lit(r"\d+"), F.lit(0)), F.lit(1)), F.try_element_at(F.regexp_extract_all(_col(x), F.lit(r"\d+"), F.lit(0)), F.lit(-1))
    return F.when(_col(x).rlike(r"^\s*(pp?\.?\s*)?\d+(\s*[-–]\s*\d+)?\s*$"), F.struct(first.cast("int").alias("first"), last.cast("int").alias("last")))


def family_name(x: Column | str) -> Column:
    """Surname of the first author of ``Family, Given``, ``Given Family`` or one name; authors are parted by ``;`` or `` and ``.

    Diacritics go, letters become lower case, anything but letters and digits goes; a full stop parts given names. Empty if
    nothing is left."""
    first = F.trim(F.split(F.split(fold(x), ";")[0], " and ")[0])
    last = F.try_element_at(F.filter(F.split(F.regexp_replace(first, r"[.]", " "), r"\s+"), lambda w: w != ""), F.lit(-1))
    name = F.when(F.instr(first, ",") > 0, F.split(first, ",")[0]).otherwise(F.coalesce(last, F.lit("")))
    return F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]", "")


def family_matches(candidate: Column | str, requested: Column | str) -> Column:
    """The surnames are equal, or the requested one ends with the candidate's, which has three letters at least; not the other way."""
    a, b = family_name(candidate), family_name(requested)
    return (a != "") & (b != "") & ((a == b) | ((F.length(a) >= 3) & b.endswith(a)))


#: Letters with marks and what they are without; of letters that have no decomposition, what they are written as.
MARKED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿĀāĂăĄąĆćČčĎďĒēĘęĚěĞğĪīİĹĺĽľŃńŇňŌōŐőŔŕŘřŚśŞşŠšŢţŤťŪūŮůŰűŲųŹźŻżŽž"
PLAIN = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyyAaAaAaCcCcDdEeEeEeGgIiILlLlNnNnOoOoRrRrSsSsSsTtTtUuUuUuUuZzZzZz"


def fold(x: Column | str) -> Column:
    """Letters with diacritics as plain ones, whether composed or not."""
    return F.regexp_replace(F.translate(_col(x), MARKED, PLAIN), r"\p{M}", "")


def sniff(head: Column | str) -> Column:
    """Kind of a file by its first bytes (binary or text)."""
    h = F.hex(F.substring(_col(head).cast("binary"), 1, 8))
    rules = {"25504446": "pdf", "504B0304": "zip", "89504E47": "png", "FFD8FF": "jpeg", "1F8B": "gzip", "3C3F786D6C": "xml", "7B": "json"}
    html = F.lower(F.ltrim(F.substring(_col(head).cast("string"), 1, 64))).rlike("^<(!doctype html|html)")
    out = F.when(html, F.lit("html"))
    for magic, kind in rules.items():
        out = out.when(h.startswith(magic), F.lit(kind))
    return out.otherwise(F.lit("unknown"))


def matching_ratio(a: str, b: str) -> float:
    """``difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()``: the same blocks, found by runs of 12 characters first.

    A common substring of k characters is a run of k - q + 1 common runs of q at the same places, so the longest one, the earliest in a
    and then in b, is found among rare runs of q; only where there is none shorter ones are looked at."""
    if a == b:
        return 1.0
    lengths, places = (12, 4, 1), {}
    matched, regions = 0, [(0, len(a), 0, len(b), 0)]
    while regions:
        alo, ahi, blo, bhi, level = regions.pop()
        q = lengths[level]
        if q not in places:
            places[q] = at = {}
            for j in range(len(b) - q + 1):
                at.setdefault(b[j : j + q], []).append(j)
        at, run, best, besti, bestj = places[q], {}, 0, alo, blo
        found = [at.get(a[i : i + q], ()) for i in range(alo, ahi - q + 1)]
        if sum(map(len, found)) > 200 * len(found):  # texts that repeat themselves: many places of a run are one step
            whole, lengths_at, last = {}, np.zeros(len(b) + 1, np.int64), np.zeros(0, np.int64)
            for i, js in enumerate(found, alo):
                if id(js) not in whole:
                    some = np.array(js, np.int64)
                    whole[id(js)] = some[(some >= blo) & (some <= bhi - q)]
                js = whole[id(js)]
                ks = lengths_at[js] + 1
                lengths_at[last + 1] = 0
                lengths_at[js + 1] = ks
                last = js
                if len(ks) and (k := int(ks.max())) > best:
                    best, besti, bestj = k, i - k + 1, int(js[ks.argmax()]) - k + 1
            found = []
        for i, js in enumerate(found, alo):
            new = {}
            for j in islice(js, bisect_left(js, blo), None) if blo else js:
                if j > bhi - q:
                    break
                k = new[j] = run.get(j - 1, 0) + 1
                if k > best:
                    best, besti, bestj = k, i - k + 1, j - k + 1
            run = new
        if best:
            best += q - 1
            matched += best
            if alo < besti and blo < bestj:
                regions.append((alo, besti, blo, bestj, level))
            if besti + best < ahi and bestj + best < bhi:
                regions.append((besti + best, ahi, bestj + best, bhi, level))
        elif q > 1:
            regions.append((alo, ahi, blo, bhi, level + 1))
    return 2.0 * matched / (len(a) + len(b))


@F.pandas_udf(T.DoubleType())
def ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-block ratio of two strings (2 * matches / lengths), not an edit distance."""
    return pd.Series([None if x is None or y is None else matching_ratio(x, y) for x, y in zip(a, b)])
