"""Scalar expressions: headers, money, codes, URLs, names and labels. All are Column to Column."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_of(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def choose(cases: Sequence[tuple[Column, object]], otherwise: object = None) -> Column:
    """The value of the first case that holds."""
    out = F.when(cases[0][0], cases[0][1])
    for test, value in cases[1:]:
        out = out.when(test, value)
    return out.otherwise(otherwise)


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


# ---- headers and money ---------------------------------------------------------------------------------------------


def norm_header(c: Column) -> Column:
    """Trimmed, lower case, blanks and dashes as underscores."""
    return F.regexp_replace(F.lower(F.trim(c)), r"[ \-]", "_")


def header_fingerprint(headers: Column) -> Column:
    """Fingerprint of a header layout, given as an array of names; the order counts."""
    return F.substring(F.sha2(F.array_join(F.transform(headers, norm_header), "|"), 256), 1, 16)


def keyword_match(c: Column, hints: Sequence[str]) -> Column:
    """Whether a header's normal form has one of the hints in it."""
    name = F.regexp_replace(F.lower(c), r"[ \-]", "_")
    return any_of(name.contains(h.replace(" ", "_")) for h in hints)


def to_money(c: Column) -> Column:
    """A price written with ``$`` and ``,``; blanks, dashes, words and anything else that is no number are null."""
    text = _bare_price(c)
    return F.when(text.rlike(PRICE), text.cast("double"))


PRICE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _bare_price(c: Column) -> Column:
    # few prices have one of them: replacing looks for it, translating walks over each character
    return F.replace(F.replace(F.trim(c.cast("string")), F.lit("$"), F.lit("")), F.lit(","), F.lit(""))


def is_money(c: Column) -> Column:
    """Whether :func:`to_money` gives a price; null for null."""
    return _bare_price(c).rlike(PRICE)


# ---- codes ---------------------------------------------------------------------------------------------------------

# Code shapes, first match wins.
CODE_SHAPES = [
    (r"^[0-9]{5}$", "CPT"),
    (r"^[A-Z][0-9]{4}$", "HCPCS"),
    (r"^[0-9]{3}$", "DRG"),
    (r"^[0-9]{1,4}-[0-9]{1,4}$", "MS-DRG"),
    (r"^[0-9]{11}$", "NDC"),
    (r"^[A-Z][0-9]{2}(\.[0-9]{1,4})?$", "ICD-10"),
]
# How files label code types.
TYPE_ALIASES = {
    "HCPCS": "HCPCS", "CPT": "CPT", "DRG": "DRG", "MS-DRG": "MS-DRG", "MSDRG": "MS-DRG", "RC": "REV", "REV": "REV", "REVCODE": "REV",
    "NDC": "NDC", "ICD10": "ICD-10", "ICD-10": "ICD-10", "CDM": "CDM", "CHARGECODE": "CDM",
    "PROCEDURECODE": "", "BILLINGCODE": "", "CODE": "", "CPTHCPCS": "", "CPTHCPCSCODE": "",
}
# Types that are shown, labels that count as one, and labels that say nothing about the type.
DISPLAY_TYPES = ["CPT", "HCPCS", "DRG", "MS-DRG", "REV", "CDM"]
DISPLAY_ALIASES = {
    "CPT": "CPT", "HCPCS": "HCPCS", "DRG": "DRG", "MS-DRG": "MS-DRG", "MSDRG": "MS-DRG", "REV": "REV", "REVCODE": "REV", "RC": "REV", "CDM": "CDM", "CHARGECODE": "CDM",
}
UNTYPED = ["", "CODE", "BILLINGCODE", "PROCEDURECODE", "CPT-HCPCS", "CPTHCPCS", "CPTHCPCSCODE"]


def detect_code_type(c: Column, shapes: Sequence[tuple[str, str]] = CODE_SHAPES) -> Column:
    """Type by the code's shape; no code, no type; other shapes are chargemaster lines."""
    code = F.upper(F.trim(F.coalesce(c, F.lit(""))))
    return choose([(code == "", "")] + [(code.rlike(p), t) for p, t in shapes], "CDM")


def _label(c: Column) -> Column:
    """Upper case, underscores as dashes, no blanks."""
    return F.translate(F.upper(F.trim(F.coalesce(c, F.lit("")))), "_ ", "-")


def lookup(table: dict[str, str], key: Column) -> Column:
    """The table's value for a key, else null. One map literal; the key is worked out once."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def canon_code_type(c: Column) -> Column:
    """A type label in its usual form; unknown labels stay, in upper case."""
    label = _label(c)
    return F.coalesce(lookup(TYPE_ALIASES, label), label)


def normalize_code(code: Column, code_type: Column) -> Column:
    """struct<code, code_type>: odd blanks removed, ``CPT: 99213``-like prefixes taken for the type."""
    raw = F.trim(F.coalesce(code, F.lit("")))
    prefixed = r"(?i)^(HCPCS|CPT|DRG|MS[- ]?DRG|REV|RC|NDC|ICD[- ]?10)\s*[:#-]?\s*([A-Z0-9.\-]+)$"
    clean = F.trim(F.regexp_replace(F.regexp_replace(raw, "[� ]", " "), r"\s+", " "))
    # few codes begin like one with a prefix: the others aren't cleaned
    part = lambda i: F.when(raw.rlike(r"(?i)^[\s� ]*(HCPCS|CPT|DRG|MS|REV|RC|NDC|ICD)"), F.regexp_extract(clean, prefixed, i)).otherwise("")
    telling, none = {k: v for k, v in TYPE_ALIASES.items() if v}, ["", *[k for k, v in TYPE_ALIASES.items() if not v]]
    own = _label(part(1))
    given = _label(code_type)
    # cases stand inside the fields, so that a reader of one field works out that one alone
    shown = F.when(part(2) != "", part(2)).otherwise(raw)
    kind = F.coalesce(lookup(telling, own), F.when(~given.isin(none), F.coalesce(lookup(telling, given), given)), detect_code_type(shown))
    return F.struct(shown.alias("code"), kind.alias("code_type"))


def has_price(gross: Column, cash: Column, n_payers: Column) -> Column:
    return gross.isNotNull() | cash.isNotNull() | (n_payers > 0)


def display_code_type(code: Column, code_type: Column, description: Column, priced: Column) -> Column:
    """struct<code, type> as shown: a priced item without a code goes by its description, and a priced item of an unknown type is a chargemaster line."""
    c, d = F.trim(F.coalesce(code, F.lit(""))), F.trim(F.coalesce(description, F.lit("")))
    named = F.upper(F.trim(F.coalesce(code_type, F.lit(""))))
    named = F.when(named == "", "CDM").otherwise(named)
    label = _label(named)
    shape = F.when(c == "", "CDM").otherwise(detect_code_type(c, CODE_SHAPES[:4]))
    kind = F.coalesce(lookup(DISPLAY_ALIASES, label), F.when(label.isin(UNTYPED), shape), named)
    by_text = (c == "") & (d != "") & priced
    shown = F.when(by_text, F.substring(d, 1, 48)).otherwise(c)
    return F.struct(shown.alias("code"), F.when(by_text | ((c != "") & ~kind.isin(DISPLAY_TYPES) & priced), "CDM").otherwise(kind).alias("type"))


def priced_code_type(code: Column, code_type: Column, description: Column) -> Column:
    """What :func:`display_code_type` gives for a priced item with a code or a description, in few expressions: every other
    type is a chargemaster line there, so one chain of cases is left, and tasks run it compiled."""
    c, named = F.trim(F.coalesce(code, F.lit(""))), F.upper(F.trim(F.coalesce(code_type, F.lit(""))))
    label = F.when(named == "", "CDM").otherwise(F.translate(named, "_ ", "-"))
    kind = F.coalesce(lookup(DISPLAY_ALIASES, label), F.when(label.isin(UNTYPED), detect_code_type(c, CODE_SHAPES[:4])), F.lit("CDM"))
    shown = F.when(c == "", F.substring(F.trim(description), 1, 48)).otherwise(c)
    return F.struct(shown.alias("code"), F.when(c == "", "CDM").otherwise(kind).alias("type"))


# ---- text to slug --------------------------------------------------------------------------------------------------

_ACCENTS = ("àáâãäåèéêëìíîïòóôõöùúûüýÿñçÀÁÂÃÄÅÈÉÊËÌÍÎÏÒÓÔÕÖÙÚÛÜÝÑÇ", "aaaaaaeeeeiiiiooooouuuuyyncAAAAAAEEEEIIIIOOOOOUUUUYNC")


def slugify(c: Column) -> Column:
    """Accents dropped, words joined by dashes; ``unknown`` if nothing is left."""
    text = F.regexp_replace(F.translate(F.coalesce(c, F.lit("")), *_ACCENTS), r"[^A-Za-z0-9_\s-]", "")
    text = F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), r"[\s_]+", "-"), r"-+", "-")
    text = F.regexp_replace(text, r"^-+|-+$", "")
    return F.when(text == "", "unknown").otherwise(text)


# ---- URLs ----------------------------------------------------------------------------------------------------------

# What file names, paths and link texts of price files look like, and the points for each.
FILE_EXT = r"\.(csv|json|xlsx?|zip|xml)(\?|$)"
REGULATED_NAME = r"standard[-_]?charges?"
PATH_WORDS = r"machine[-_]?readable|standard[-_]?charges?|chargemaster|transparency"
TEXT_WORDS = r"machine[\s\-_]?readable|standard[\s\-_]?charges?|chargemaster|price[\s\-_]?transparency|negotiated[\s\-_]?rates?"
LINK_POINTS = {"extension": 3, "regulated": 5, "path": 2, "text": 2, "long name": 1}
# Files that belong to a site, not to its prices.
WEB_ASSETS = ["manifest.json", "site.webmanifest", "browserconfig.xml", "robots.txt", "sitemap.xml", "service-worker.js", "sw.js", "workbox.js"]


def norm_url(c: Column) -> Column:
    """The URL behind a mail filter's wrapper, with HTML entities resolved."""
    url = F.trim(F.coalesce(c, F.lit("")))
    inner = F.regexp_extract(url, r"(?i)urldefense\.com/v3/__(.+?)__;", 1)
    url = F.when(inner != "", inner).otherwise(url)
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&amp;", "&")):
        url = F.replace(url, F.lit(entity), F.lit(char))
    return url


def url_path(c: Column) -> Column:
    return F.regexp_extract(c, r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def url_host(c: Column) -> Column:
    """Lower-case host, with its port."""
    return F.lower(F.regexp_extract(c, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def score_link(url: Column, text: Column) -> Column:
    """0 to 13: how likely a link leads to a price file."""
    path = F.lower(url_path(url))
    name, said = file_name(path), F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"<[^>]+>", " ")))
    ext = path.rlike(FILE_EXT)
    tests = {"extension": ext, "regulated": name.rlike(REGULATED_NAME), "path": path.rlike(PATH_WORDS), "text": said.rlike(TEXT_WORDS), "long name": ext & (F.length(name) > 12) & name.contains("_")}
    return reduce(lambda a, b: a + b, [F.when(t, LINK_POINTS[k]).otherwise(0) for k, t in tests.items()])


def is_web_asset(url: Column) -> Column:
    path = F.substring_index(F.lower(url), "?", 1)
    return file_name(path).isin(WEB_ASSETS) | file_name(path).startswith("favicon") | path.contains("/icons/")


def score_page_link(url: Column) -> Column:
    """The second scale, for links on hub pages: direct files, downloads and drive links; site assets score nothing."""
    low = F.lower(norm_url(url))
    points = [
        (low.rlike(r"\.(csv|json|xlsx?|zip)(\?|$)"), 10),
        (low.rlike(r"standard[\s\-_]?charges?|chargemaster|price[\s\-_]?transparency|machine[\s\-_]?readable|download"), 4),
        (low.contains("drive.google.com/uc?") | low.contains("export=download"), 6),
        (low.contains("/download"), 2),
        (low.contains("/view") & low.contains("drive.google.com/file/d/"), -2),
    ]
    return F.when(is_web_asset(low), 0).otherwise(reduce(lambda a, b: a + b, [F.when(t, n).otherwise(0) for t, n in points]))


def is_protected_wrapper(url: Column) -> Column:
    """By host name, never by a mention elsewhere in the URL."""
    host = F.regexp_replace(F.regexp_replace(url_host(url), r":[0-9]+$", ""), r"\.$", "")
    return F.coalesce(F.lower(url).rlike(r"^https?://") & ((host == "urldefense.com") | host.endswith(".urldefense.com")), F.lit(False))


# Marks of direct files, of wrapper pages, and of content types that are files.
FILE_SUFFIXES = [".csv", ".json", ".xlsx", ".xls", ".zip"]
DIRECT_MARKS = ["drive.google.com/uc?", "export=download", "/download", "standardcharges", "standard-charges"]
WRAPPER_MARKS = ["/view", "/share", "sharepoint.com", "dropbox.com"]
FILE_TYPES = ["text/csv", "application/csv", "application/json", "text/json", "application/octet-stream", "application/x-unknown", "spreadsheetml", "ms-excel", "application/zip", "application/x-zip"]
GOOD_TYPES = ["application/json", "text/json", "text/csv", "application/csv", "spreadsheetml", "ms-excel", "application/zip", "application/x-zip"]


def _has(c: Column, marks: Sequence[str]) -> Column:
    return any_of(c.contains(m) for m in marks)


def has_file_suffix(url: Column) -> Column:
    return _has(F.lower(norm_url(url)), FILE_SUFFIXES)


def is_direct_file(url: Column) -> Column:
    return _has(F.lower(norm_url(url)), FILE_SUFFIXES + DIRECT_MARKS)


def is_html_wrapper(url: Column) -> Column:
    return _has(F.lower(norm_url(url)), WRAPPER_MARKS)


def is_file_type(content_type: Column) -> Column:
    return _has(F.lower(F.coalesce(content_type, F.lit(""))), FILE_TYPES)


# What is never a price file of a facility. Each rule: marks in the URL, marks in the content type, and marks
# in either that lift it; empty: anything.
_DIRECT, _WRAPPER = "|".join(map(re.escape, FILE_SUFFIXES + DIRECT_MARKS)), "|".join(map(re.escape, WRAPPER_MARKS))
REJECTED = [
    (r"cms\.gov/hospital-price-transparency", "", "", ""),
    (r"\.pdf", "", "", ""),
    ("", r"application/pdf", "", ""),
    (r"/innetwork/|in-network-rates", "", "", ""),
    (r"\.xml$|/feed\.xml", "", "", ""),
    (r"chargemaster-submission-guide", "", "", ""),
    (_DIRECT, r"text/html", _WRAPPER, ""),
    ("", r"xml", "", r"application/json|text/html|spreadsheetml|openxmlformats|ms-excel"),
    (r"search\.hospitalpriceindex\.com/hpi2/machinereadable/", r"text/html", "", ""),
]


def is_rejected(url: Column, content_type: Column, rules: Sequence[tuple[str, str, str, str]] = REJECTED) -> Column:
    """Candidates that are never price files of a facility, by a table of rules."""
    texts = (F.lower(norm_url(url)), F.lower(F.coalesce(content_type, F.lit(""))))

    def holds(rule: tuple[str, str, str, str]) -> Column:
        wanted = [t.rlike(p) for t, p in zip(texts, rule[:2], strict=True) if p]
        lifted = [~t.rlike(p) for t, p in zip(texts, rule[2:], strict=True) if p]
        return reduce(lambda a, b: a & b, wanted + lifted)

    return any_of(map(holds, rules))


# The place of a content type by the marks in it; without any of them, ``OTHER_PLACE``.
CONTENT_PLACES = [(GOOD_TYPES, 0), (["application/octet-stream", "application/x-unknown"], 1), (["text/html"], 3)]
OTHER_PLACE = 2


def content_rank(content_type: Column) -> Column:
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    return choose([(_has(kind, marks), place) for marks, place in CONTENT_PLACES], OTHER_PLACE)


# ---- names ---------------------------------------------------------------------------------------------------------

# Words that don't tell one facility from another.
STOP = ["the", "of", "and", "inc", "llc", "corp", "at", "for", "a", "an", "in"]
SOFT_STOP = STOP + ["hospital", "hospitals", "medical", "center", "health", "system", "systems", "campus", "care"]


def _tokens(c: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z0-9]+", " ")), " ")


def name_norm(c: Column) -> Column:
    return F.array_join(F.filter(_tokens(c), lambda t: (t != "") & ~t.isin(STOP)), " ")


def name_signature(c: Column) -> Column:
    """Distinct telling words of a name, three letters or more."""
    return F.array_distinct(F.filter(_tokens(c), lambda t: (F.length(t) >= 3) & ~t.isin(SOFT_STOP)))


# The bases of addresses. Each takes some of a name's words (all, or the telling ones), how many (0: each), and an ending.
NAME_BASES = [("all", 0, ""), ("telling", 0, ""), ("telling", 1, ""), ("telling", 2, ""), ("telling", 3, ""), *[("telling", n, x) for n in (1, 2) for x in ("hospital", "health")]]
BASE_LENGTH = (4, 60)


def name_domains(c: Column, endings: Sequence[str] = (".org", ".com"), most: int = 24) -> Column:
    """Web addresses that a facility of this name might have, from a table of bases."""
    words = F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z]+", " "), " "), lambda t: t != "")
    long = F.filter(words, lambda t: (F.length(t) >= 3) & ~t.isin(STOP))
    of = {"all": words, "telling": F.when(F.size(long) > 0, long).otherwise(F.slice(words, 1, 3))}
    made = [F.concat(F.array_join(F.slice(of[kind], 1, n) if n else of[kind], ""), F.lit(end)) for kind, n, end in NAME_BASES]
    bases = F.array_sort(F.array_distinct(F.filter(F.array(*made), lambda b: F.length(b).between(*BASE_LENGTH))))
    forms = [(start, end) for end in endings for start in ("https://www.", "https://")]
    urls = F.flatten(F.transform(bases, lambda b: F.array(*[F.concat(F.lit(start), b, F.lit(end)) for start, end in forms])))
    return F.when(F.size(words) > 0, F.slice(urls, 1, most)).otherwise(F.array().cast("array<string>"))


# ---- labels --------------------------------------------------------------------------------------------------------

# The least score of each grade, and the ranking of grades.
GRADES = [(90, "A"), (80, "B"), (70, "C"), (60, "D")]


def grade_for(score: Column) -> Column:
    return choose([(score >= least, g) for least, g in GRADES], "F")


def grade_rank(grade: Column) -> Column:
    return choose([(grade == g, i) for i, g in enumerate("ABCDF")])


def score_band(score: Column) -> Column:
    return choose([(score.isNull(), "unknown"), (score >= 80, "good"), (score >= 60, "fair")], "poor")


def status_label(ok: Column) -> Column:
    """Unknown isn't a failure."""
    return choose([(ok.isNull(), "unknown"), (ok, "pass")], "fail")


# Errors that won't go away by trying again, and what is said about an error, by the first pattern found in it.
HARD_FAILURES = [r"^no_live_mrf\z", r"^(seed|rediscovered):-:probe_(html|reject):", r"(^|:)timeout:"]
FAILURE_REASONS = [(r"^no_live_mrf\z", "no_live_mrf_after_rediscovery"), (r"probe_(html|reject)", "mrf_url_returns_html_wrapper"), (r"timeout", "mrf_fetch_timeout")]
OTHER_FAILURE = "hard_failure"


def is_hard_failure(error: Column, patterns: Sequence[str] = HARD_FAILURES) -> Column:
    return F.coalesce(error, F.lit("")).rlike("|".join(patterns))


def failure_reason(error: Column, reasons: Sequence[tuple[str, str]] = FAILURE_REASONS) -> Column:
    return choose([(F.coalesce(error, F.lit("")).rlike(p), said) for p, said in reasons], OTHER_FAILURE)


def probe_class(status: Column) -> Column:
    """What the answer of a URL means for its state."""
    return choose([(status == 304, "unchanged"), (status.isin(404, 410), "dead"), (status == 200, "content"), (status > 0, "answered error"), (status == -1, "transport")], "other")
