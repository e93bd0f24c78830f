"""Identifiers of works: one canonical form a scheme, validity with check digits, conversions. Native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_invisible

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def doi(x: Column | str) -> Column:
    """Invisible characters out, ASCII lower case, from the first ``10.``, without closing punctuation; empty if there is none."""
    return F.regexp_replace(F.regexp_extract(F.translate(strip_invisible(x), UPPER, LOWER), r"10\..*$", 0), r"[/.,;:]+$", "")


def find_doi(text: Column | str) -> Column:
    """The first DOI in running text; a closing bracket without its opening one is not part of it. Null if there is none."""
    raw = F.regexp_extract(F.regexp_replace(_col(text), r"\p{Cf}", ""), r"(?i)\b10\.\d{4,9}/[^\s\"'<>]+", 0)
    balanced = F.regexp_replace(raw, r"[.,;:]+$", "")
    opened = lambda c, b: F.length(c) - F.length(F.translate(c, b, ""))
    balanced = F.when(balanced.endswith(")") & (opened(balanced, ")") > opened(balanced, "(")), F.regexp_replace(balanced, r"\)+$", "")).otherwise(balanced)
    return F.nullif(F.lower(balanced), F.lit(""))


def arxiv(x: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(_col(x))), "^arxiv:", ""), "v[0-9]+$", "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def weighted(c: Column, weights: list[int]) -> Column:
    """Sum of the weighted digits of ``c``; X is 10."""
    digit = lambda i: F.instr(F.lit("0123456789X"), F.substring(c, i, F.lit(1))) - 1
    return F.aggregate(F.zip_with(F.sequence(F.lit(1), F.lit(len(weights))), F.array(*map(F.lit, weights)), lambda i, w: w * digit(i)), F.lit(0), lambda a, x: a + x)


TENS, NINES, EAN = list(range(10, 0, -1)), list(range(10, 1, -1)), [1, 3] * 6


def isbn10_valid(c: Column) -> Column:
    """Nine digits and a check digit: weights 10 to 1 give a multiple of 11; the all-zero forms are not numbers."""
    return F.when(c.rlike("^[0-9]{9}[0-9X]$") & ~c.isin("0000000000", "000000000X"), weighted(c, TENS) % 11 == 0).otherwise(F.lit(False))


def ean13_check(first12: Column) -> Column:
    return ((10 - weighted(first12, EAN) % 10) % 10).cast("string")


def isbn10_check(first9: Column) -> Column:
    rest = (11 - weighted(first9, NINES) % 11) % 11
    return F.when(rest == 10, F.lit("X")).otherwise(rest.cast("string"))


def isbn13_valid(c: Column) -> Column:
    return F.when(c.rlike("^97[89][0-9]{10}$"), F.substring(c, 13, 1) == ean13_check(F.substring(c, 1, 12))).otherwise(F.lit(False))


def isbn_clean(x: Column | str) -> Column:
    return F.regexp_replace(F.upper(F.regexp_replace(F.trim(_col(x)), r"(?i)^\s*isbn(-1[03])?\s*:?\s*", "")), "[^0-9X]", "")


def to_isbn13(c: Column) -> Column:
    """Of a valid ISBN-10 or ISBN-13; null otherwise."""
    return F.when(isbn10_valid(c), F.concat(F.lit("978"), F.substring(c, 1, 9), ean13_check(F.concat(F.lit("978"), F.substring(c, 1, 9))))).when(isbn13_valid(c), c)


def to_isbn10(c: Column) -> Column:
    """Of a valid ISBN-13 that starts with 978; null otherwise."""
    return F.when(isbn13_valid(c) & c.startswith("978"), F.concat(F.substring(c, 4, 9), isbn10_check(F.substring(c, 4, 9))))


def isbn(x: Column | str) -> Column:
    return let(isbn_clean(x), lambda c: F.when(isbn10_valid(c), let(F.concat(F.lit("978"), F.substring(c, 1, 9)), lambda d: F.concat(d, ean13_check(d)))).otherwise(c))


def issn(x: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.upper(F.trim(_col(x))), r"[\s-]", ""), "^([0-9]{4})([0-9]{3}[0-9X])$", "$1-$2")


def issn_valid(c: Column) -> Column:
    return let(F.regexp_replace(c, "-", ""), lambda d: F.when(d.rlike("^[0-9]{7}[0-9X]$"), weighted(d, TENS[2:]) % 11 == 0).otherwise(F.lit(False)))


#: The schemes that only drop a pattern and change case. (case, patterns that go, whether the last path segment alone counts)
PLAIN = {
    "arxiv": ("lower", ["^arxiv:", "v[0-9]+$"], False), "pmid": ("", [r"(?i)^pmid:\s*"], False), "pii": ("upper", ["[^0-9A-Z]"], False),
    "handle": ("", [r"(?i)^(hdl:\s*|(https?://)?hdl\.handle\.net/)"], False), "oclc": ("lower", [r"^(\(ocolc\)|ocm|ocn|on)"], False),
    "lccn": ("lower", [r"\s"], False), "hal": ("lower", ["v[0-9]+$"], False), "md5": ("lower", [], False), "sha1": ("lower", [], False),
    "sha256": ("lower", [], False), "s2": ("lower", [], False), "olid": ("upper", [], False), "openalex": ("upper", [], True), "wikidata": ("upper", [], True),
}


def _plain(x: Column, case: str, gone: list[str], last: bool) -> Column:
    t = F.trim(x)
    t = F.regexp_replace(F.regexp_replace(t, "/+$", ""), "^.*/", "") if last else t
    t = {"lower": F.lower, "upper": F.upper, "": lambda c: c}[case](t)
    for pattern in gone:
        t = F.regexp_replace(t, pattern, "")
    return t


def canonical(scheme: Column | str, value: Column | str) -> Column:
    """The canonical form of a value in its scheme; trimmed only in schemes that have none."""
    value, t = _col(value), F.trim(_col(value))
    forms = {"doi": doi(value), "isbn": isbn(value), "issn": issn(value), "pmcid": F.when(t.rlike(r"(?i)^(pmc)?\s*[0-9]+$"), F.concat(F.lit("PMC"), F.regexp_extract(t, "[0-9]+$", 0))).otherwise(t)}
    forms |= {name: _plain(value, *rule) for name, rule in PLAIN.items()}
    out = None
    for name, form in forms.items():
        out = F.when(_col(scheme) == name, form) if out is None else out.when(_col(scheme) == name, form)
    return out.otherwise(t)


#: What a value of a scheme looks like, in the order in which schemes are tried.
SHAPES = {
    "doi": r"^10\.\d{4,9}/\S+$", "arxiv": r"^(\d{4}\.\d{4,5}|[a-z\-]+(\.[a-z]{2})?/\d{7})$", "pmcid": r"^PMC\d+$", "pmid": r"^\d{1,8}$", "issn": r"^\d{4}-\d{3}[\dX]$",
    "isbn": r"^(97[89]\d{10}|\d{9}[\dX])$", "md5": r"^[0-9a-f]{32}$", "sha1": r"^[0-9a-f]{40}$", "sha256": r"^[0-9a-f]{64}$", "wikidata": r"^Q\d+$", "openalex": r"^W\d+$",
}


def valid(scheme: Column | str, canon: Column | str) -> Column:
    """Shape and check digit of a canonical value; null in schemes without a shape."""
    c, out = _col(canon), None
    for name, shape in SHAPES.items():
        ok = c.rlike(shape)
        ok = ok & (isbn10_valid(c) | isbn13_valid(c)) if name == "isbn" else ok & issn_valid(c) if name == "issn" else ok
        out = F.when(_col(scheme) == name, ok) if out is None else out.when(_col(scheme) == name, ok)
    return out


def schemes_of(value: Column | str) -> Column:
    """All schemes whose shape a value has."""
    return F.array_compact(F.array(*(F.when(_col(value).rlike(shape), F.lit(name)) for name, shape in SHAPES.items())))


def arxiv_to_doi(c: Column | str) -> Column:
    return F.concat(F.lit("10.48550/arxiv."), _col(c))


def doi_to_arxiv(c: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(c), r"^10\.48550/arxiv\.(.+)$", 1), F.lit(""))


def isbn_to_doi(x: Column | str) -> Column:
    """ISBN-A of a hyphenated valid ISBN-13: 10.prefix.group+registrant/publication+check. Null for any other, as only the hyphens tell
    where the registrant ends."""
    t = F.trim(_col(x))
    parts = F.split(t, r"[-\s]")
    bare = F.regexp_replace(t, r"[-\s]", "")
    ok = t.rlike(r"^97[89]([-\s][0-9]+){4}$") & isbn13_valid(bare)
    return F.when(ok, F.concat(F.lit("10."), parts[0], F.lit("."), parts[1], parts[2], F.lit("/"), parts[3], parts[4]))


def reference_kind(x: Column | str) -> Column:
    """What the shape of a reference says that it is: doi, arxiv or url; null where no shape fits (a title is never inferred)."""
    t = F.trim(_col(x))
    web, canon = F.lower(t).rlike("^https?://"), doi(t)
    is_doi = canon.rlike(SHAPES["doi"])
    at_doi = F.lower(t).contains("doi.org/")
    url = F.when(at_doi & is_doi, F.lit("doi")).when(~at_doi & t.rlike(r"(?i)^https?://[^/?#]"), F.lit("url"))
    bare_doi = F.lower(t).rlike(r"^(urn:)?(doi:)?\s*10\.") & is_doi
    return F.when(web, url).when(bare_doi, F.lit("doi")).when(arxiv(t).rlike(SHAPES["arxiv"]), F.lit("arxiv"))


def short_doi_alias(answer: Column | str) -> Column:
    """The full DOI in a handle service's JSON answer for a short one; null unless it was found (response code 1) and has an alias."""
    body = F.from_json(_col(answer), "responseCode int, values array<struct<type:string,data:struct<value:string>>>")
    alias = F.transform(F.filter(body["values"], lambda v: v["type"] == "HS_ALIAS"), lambda v: doi(v["data"]["value"]))
    return F.when(body["responseCode"] == 1, F.try_element_at(F.filter(alias, lambda d: d != ""), F.lit(1)))
