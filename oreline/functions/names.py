"""Names, keys and titles: folded tokens, surname matching, citation keys, title windows on a page, landing-page signals."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .identifiers import let
from .text import fold, norm_title

#: Words that a key's slug leaves out; what joins the parts of one word; what a text layer lost a letter to.
STOP = [
    "a", "an", "the", "of", "on", "in", "for", "and", "or", "to", "with", "by", "from", "at", "as", "into",
    "via", "using", "its", "is", "are", "be", "under", "over", "between", "towards", "toward",
]
#: Fixed value: the shape of a key.
KEY = r"^[A-Za-z]+_[0-9]{4}[ab]?_[a-z0-9]+(-[a-z0-9]+){1,4}$"
JOINERS = r"\-'‐‑’ʼ"
UNDECODABLE = r"[\x{FFFD}\x{AD}\x{FFFE}]"
#: Headings of reference lists, numbered and author-year references, citation instructions.
REF_HEADING = r"(?i)^\s*(references?( and notes)?|bibliography|literature cited|works cited|cited literature)\s*:?\s*$"
REF_NUMBERED = r"^\s*(\[\s*\d{1,3}\s*\]|\d{1,3}\.)\s+\S"
REF_AUTHOR_YEAR = r"\b[A-Z][A-Za-z'’\-]+,\s+(?:[A-Z]\.\s*-?\s*){1,3}.*\b(1[89]|20)\d{2}[a-z]?\b"
COVER = r"(?i)please\s+cite|to\s+cite\s+this|cite\s+this\s+article|citation\s+for\s+published\s+version|how\s+to\s+cite"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def fold_tokens(x: Column | str) -> Column:
    """Words without diacritics, in lower case, letters only; parted by anything but letters, digits and joiners."""
    bare = F.lower(fold(F.regexp_replace(F.regexp_replace(_col(x), "<[^>]*>", " "), UNDECODABLE, "")))
    words = F.split(bare, rf"[^\p{{L}}\p{{N}}_{JOINERS}]+")
    return F.filter(F.transform(words, lambda w: F.regexp_replace(w, r"[^\p{L}]", "")), lambda w: w != "")


def tokens_contain(tokens: Column, family: Column, marker: int = 5) -> Column:
    """The surname's tokens stand side by side in ``tokens``, or join to it; never inside a token. A surname of ``marker`` letters or
    more may have one letter behind it (a footnote mark)."""
    def of(tokens: Column, joined: Column) -> Column:
        run = lambda i, n: F.array_join(F.slice(tokens, i, n), "")
        fits = lambda s: (s == joined) | ((F.length(joined) >= marker) & (F.length(s) == F.length(joined) + 1) & s.startswith(joined))
        size = F.size(tokens)
        found = F.exists(F.sequence(F.lit(1), size), lambda i: F.exists(F.sequence(F.lit(1), F.least(size - i + 1, F.length(joined))), lambda n: let(run(i, n), fits)))
        return F.when((joined == "") | (size == 0), F.lit(False)).otherwise(found)

    # folded once a row, not once a run
    return let(F.struct(tokens.alias("t"), F.array_join(family, "").alias("j")), lambda s: of(s["t"], s["j"]))


def citation_key(author: Column | str, year: Column, title: Column | str, most: int = 58) -> Column:
    """Surname_Year_slug of up to ``most`` characters: the surname's parts joined and capitalised, four digits, two to four title words
    without stop words. Too long a surname of several parts becomes the initials of those in capitals (of all, if fewer than two are).
    Too long a key loses words, then letters of its longer word; one that still hasn't the shape of a key is refused: null."""
    parts = F.regexp_extract_all(fold(author), F.lit("[A-Za-z]+"), F.lit(0))
    # a part in capitals becomes Capitalised, any other is kept as printed
    big = F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.when((F.length(p) > 1) & (p == F.upper(p)), F.lower(p.substr(F.lit(2), F.length(p)))).otherwise(p.substr(F.lit(2), F.length(p))))), "")
    capital = F.filter(parts, lambda p: F.substring(p, 1, 1) != F.lower(F.substring(p, 1, 1)))
    leading = F.when(F.size(capital) >= 2, capital).otherwise(parts)
    initials = F.array_join(F.transform(leading, lambda p: F.upper(F.substring(p, 1, 1))), "")
    compact = F.when(F.size(leading) >= 2, initials).otherwise(F.array_join(parts, ""))
    surname = F.when(big == "", F.lit("Anon")).when(F.length(big) > most - 9, F.substring(compact, 1, most - 9)).otherwise(big)
    words = F.regexp_extract_all(F.lower(fold(title)), F.lit("[a-z0-9]+"), F.lit(0))
    kept = F.filter(words, lambda w: ~w.isin(STOP))
    kept = F.when(F.size(kept) > 0, kept).otherwise(words)
    kept = F.when(F.size(kept) >= 2, kept).otherwise(F.slice(F.concat(kept, F.filter(words, lambda w: ~F.array_contains(kept, w)), F.lit(["work", "record"])), 1, 2))
    head = F.concat(surname, F.lit("_"), F.when(year >= 10_000, year.cast("string")).otherwise(F.lpad(year.cast("string"), 4, "0")), F.lit("_"))
    fits = lambda s: F.filter(F.transform(F.lit([4, 3, 2]), lambda n: F.concat(s["h"], F.array_join(F.slice(s["k"], 1, n), "-"))), lambda k: F.length(k) <= most)
    two = lambda s: F.struct(s["k"][0].alias("a"), s["k"][1].alias("b"))
    over = lambda s: F.length(s["h"]) + F.length(s["k"][0]) + F.length(s["k"][1]) + 1 - most
    less = lambda w: w.substr(F.lit(1), F.length(w) - 1)
    cut = lambda w, _: F.when(F.length(w["a"]) >= F.length(w["b"]), F.struct(less(w["a"]).alias("a"), w["b"].alias("b"))).otherwise(F.struct(w["a"].alias("a"), less(w["b"]).alias("b")))
    short = lambda s: F.aggregate(F.sequence(F.lit(1), F.greatest(over(s), F.lit(1))), two(s), cut, lambda w: F.concat(s["h"], w["a"], F.lit("-"), w["b"]))
    key = let(F.struct(head.alias("h"), kept.alias("k")), lambda s: F.coalesce(F.try_element_at(fits(s), F.lit(1)), short(s)))
    return let(key, lambda k: F.when(k.rlike(KEY) & (F.length(k) <= most), k))


def title_containment(a: Column | str, b: Column | str, least_words: int = 5, least_share: float = 0.6) -> Column:
    """struct(words, share) where one normalised title contains the other, which has words and length enough; else null."""
    def of(x: Column, y: Column) -> Column:
        short, long = F.when(F.length(x) <= F.length(y), x).otherwise(y), F.when(F.length(x) <= F.length(y), y).otherwise(x)
        words, share = F.size(F.split(short, " ")), F.try_divide(F.length(short).cast("double"), F.length(long).cast("double"))
        return F.when((short != "") & long.contains(short) & (words >= least_words) & (share >= least_share), F.struct(words.alias("words"), share.alias("share")))

    # both are normalised once a row
    return let(F.struct(norm_title(a).alias("x"), norm_title(b).alias("y")), lambda s: of(s["x"], s["y"]))


def window_refusal(lines: Column, start: Column, n: Column, region: int = 45, around: int = 2, carry: int = 3) -> Column:
    """Why lines [start, start + n) of a page can't carry its title: region, references (under a heading, or two references near by),
    cover (a citation instruction there or just before); empty if nothing stands against it."""
    last, size = start + n - 1, F.size(lines)
    span = lambda a, b: F.slice(lines, F.greatest(a, F.lit(0)) + 1, F.greatest(F.least(b, size) - F.greatest(a, F.lit(0)), F.lit(0)))
    is_reference = lambda x: x.rlike(REF_NUMBERED) | x.rlike(REF_AUTHOR_YEAR)
    return (
        F.when(start >= region, F.lit("region")).when(F.exists(span(F.lit(0), last + 1), lambda x: x.rlike(REF_HEADING)), F.lit("references"))
        .when(F.size(F.filter(span(start - around, last + around + 1), is_reference)) >= 2, F.lit("references"))
        .when(F.exists(span(start - carry, last + 1), lambda x: x.rlike(COVER)), F.lit("cover")).otherwise(F.lit(""))
    )


def binding_verdict(ratio: Column, author_near: Column, text_layer: Column, floor: float = 0.85) -> Column:
    return F.when((ratio >= floor) & author_near, F.lit("bound")).when(~text_layer & (ratio < floor), F.lit("binding-pending")).otherwise(F.lit("binding-failed"))


@F.pandas_udf(T.StructType([T.StructField("ratio", T.DoubleType()), T.StructField("window", T.StringType())]))
def best_window(title: pd.Series, text: pd.Series) -> pd.DataFrame:
    """The one to three lines in a row of a page that are most like the title (matching-block ratio of normalised texts)."""
    import re
    from difflib import SequenceMatcher

    norm = lambda s: re.sub(r"[\W_]+", " ", re.sub("<[^>]*>", " ", s).lower()).strip()
    out = []
    for a, page in zip(title, text):
        lines, best = [" ".join(x.split()) for x in (page or "").splitlines() if norm(x)], (0.0, "")
        want = norm(a or "")
        matcher = SequenceMatcher(None, "", want)
        for i in range(len(lines)) if want else ():
            for n in (1, 2, 3):
                if i + n <= len(lines):
                    matcher.set_seq1(norm(" ".join(lines[i : i + n])))
                    if matcher.quick_ratio() > best[0] and matcher.ratio() > best[0]:
                        best = (matcher.ratio(), " ".join(lines[i : i + n]))
        out.append(best)
    return pd.DataFrame(out, columns=["ratio", "window"])


def landing_signals(html: Column | str) -> Column:
    """struct(pdf_url, alternate_pdf): the page names a document's file in a meta tag, or links it as an alternate of its kind."""
    metas = F.filter(F.regexp_extract_all(_col(html), F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0)), lambda m: m.rlike(r"(?i)content\s*=\s*[\"'][^\"']"))
    links = F.regexp_extract_all(_col(html), F.lit(r"(?is)<link\b[^>]*>"), F.lit(0))
    return F.struct(
        F.exists(metas, lambda m: m.rlike(r"(?i)(name|property)\s*=\s*[\"'][^\"']*(citation_pdf_url|eprints\.document_url)[\"']")).alias("pdf_url"),
        F.exists(links, lambda k: k.rlike(r"(?i)rel\s*=\s*[\"'][^\"']*alternate") & k.rlike(r"(?i)type\s*=\s*[\"']application/pdf[\"']")).alias("alternate_pdf"),
    )


def absolute_links(html: Column | str, base: Column | str) -> Column:
    """The href values of a page's links, made absolute by its address; fragments and other schemes than http go."""
    from .text import links

    root = F.regexp_extract(_col(base), r"^(https?://[^/?#]+)", 1)
    folder = F.regexp_replace(F.regexp_replace(_col(base), r"[?#].*$", ""), r"(^https?://[^/]+$)|[^/]*$", "$1")
    folder = F.when(folder == root, F.concat(root, F.lit("/"))).otherwise(folder)
    scheme = F.regexp_extract(_col(base), r"^(https?:)", 1)
    one = lambda h: (
        F.when(h.rlike("(?i)^https?://"), h).when(h.startswith("//"), F.concat(scheme, h)).when(h.startswith("/"), F.concat(root, h)).when(h.rlike(r"^(#|[A-Za-z][A-Za-z0-9+.\-]*:)"), F.lit(None)).otherwise(F.concat(folder, h))
    )
    return F.array_compact(F.transform(links(html), one))


def citation_tokens(text: Column | str) -> Column:
    """Citations [key p.12 #block] in order: key, page, block."""
    pattern = r"\[([A-Za-z0-9][A-Za-z0-9_.:+-]*) p\.(\d+) #([0-9a-fA-F][0-9a-fA-F-]*)\]"
    raw = F.regexp_extract_all(_col(text), F.lit(pattern), F.lit(0))
    part = lambda r, i: F.regexp_extract(r, pattern, i)
    return F.transform(raw, lambda r: F.struct(part(r, 1).alias("work_key"), part(r, 2).cast("int").alias("page"), part(r, 3).alias("block_id")))


def decoded(data: Column | str, content_type: Column | str) -> Column:
    """Text of bytes by the charset of a content type, then of a meta tag, then UTF-8; bytes that aren't in it become replacement marks."""
    head = F.decode(F.substring(_col(data), 1, 1024), "ISO-8859-1")
    named = F.lower(F.regexp_extract(F.coalesce(_col(content_type), F.lit("")), r"(?i)charset\s*=\s*[\"']?([A-Za-z0-9_\-]+)", 1))
    meta = F.lower(F.regexp_extract(head, r"(?i)<meta[^>]*charset\s*=\s*[\"']?([A-Za-z0-9_\-]+)", 1))
    charset = F.coalesce(F.nullif(named, F.lit("")), F.nullif(meta, F.lit("")))
    latin = charset.isin("iso-8859-1", "latin-1", "latin1", "windows-1252", "cp1252")
    wide = charset.isin("utf-16", "utf-16le", "utf-16be")
    return F.when(latin, F.decode(_col(data), "ISO-8859-1")).when(wide, F.decode(_col(data), "UTF-16")).otherwise(F.decode(_col(data), "UTF-8"))


def rendered(blocks: Column) -> Column:
    """Blocks (kind, text, level) as text: headings behind their marks, a blank line between blocks."""
    return F.array_join(F.transform(blocks, lambda b: F.when(b["kind"] == "heading", F.concat(F.repeat(F.lit("#"), b["level"]), F.lit(" "), b["text"])).otherwise(b["text"])), "\n\n")


def degeneracy(text: Column | str, tail: Column, n_tokens: Column, most_tokens: int) -> Column:
    """Why a generated text is no answer: cut (it ran to the most tokens), loop (its end repeats), empty; null if nothing stands against it."""
    return F.when(n_tokens >= most_tokens, F.lit("cut")).when(tail["repeats"].isNotNull(), F.lit("loop")).when(F.trim(_col(text)) == "", F.lit("empty"))
