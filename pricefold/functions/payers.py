"""Payer names in one form: an ordered table of patterns, first match wins, else the name without its plan words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricefold.functions.expressions import choose, slugify

# Payer brands (slug, display name, category, patterns) in the order in which they are tried.
PAYER_RULES: list[tuple[str, str, str, list[str]]] = [
    ("cash", "Cash / Self-Pay", "cash", [r"\bcash\b", r"\bself[\s\-]?pay\b", r"\bdiscount(ed)?\s*cash\b", r"\buninsured\b", r"\bprompt\s*pay\b", r"\bprivate\s*pay\b"]),
    ("medicare-advantage", "Medicare Advantage", "medicare", [r"medicare\s*advantage", r"\bmed\s*adv\b", r"\bmcr\s*adv\b", r"medicare\s*part\s*c\b", r"medicare\s*replace", r"\bma\s*plan\b"]),
    ("medicare", "Medicare", "medicare", [r"\bmedicare\b", r"\bmcr\b", r"\bcms\b(?!\s*\d)", r"medicare\s*part\s*[ab]\b"]),
    ("medicaid", "Medicaid", "medicaid", [r"\bmedicaid\b", r"\bmedi[\s\-]?cal\b", r"\bmcd\b", r"\bmassh(ealth)?\b", r"\bahcccs\b", r"\bsoonercare\b", r"\bbadgercare\b", r"\btenncare\b", r"\bhealth\s*choice\b", r"\bchip\b"]),
    ("tricare", "TRICARE (Military)", "government", [r"\btricare\b", r"\bchampus\b", r"\bchampva\b"]),
    ("va", "VA / Veterans", "government", [r"\bva\s*community\s*care\b", r"\bvaccn\b", r"\bveterans\s*affairs\b", r"(?<![a-z])va(?:\s*choice|\s*ccn|\s*cc)\b"]),
    ("workers-comp", "Workers' Compensation", "government", [r"workers?[\s\-]?comp", r"\bwc\s*(insurance|board)?\b"]),
    ("bcbs", "Blue Cross Blue Shield", "commercial", [r"\bblue\s*cross\b", r"\bblue\s*shield\b", r"\bbcbs\b", r"\banthem\b", r"\belevance\b", r"\bcare\s*first\b", r"\bhighmark\b", r"\bregence\b", r"\bwellpoint\b", r"\bpremera\b", r"\bempire\s*blue\b"]),
    ("aetna", "Aetna", "commercial", [r"\baetna\b", r"\bcoventry\b"]),
    ("uhc", "UnitedHealthcare", "commercial", [r"\bunited\s*health(care)?\b", r"\buhc\b", r"\bunitedhc\b", r"\boptum\b", r"\bumr\b", r"\bgolden\s*rule\b", r"\boxford\s*health\b", r"\bnavigate\b"]),
    ("cigna", "Cigna", "commercial", [r"\bcigna\b", r"\bevernorth\b", r"\bgreat[\s\-]?west\b", r"\bloomis\b"]),
    ("humana", "Humana", "commercial", [r"\bhumana\b", r"\bchoicecare\b"]),
    ("kaiser", "Kaiser Permanente", "commercial", [r"\bkaiser\b", r"\bkp\b(?!\s*\d)"]),
    ("centene", "Centene / Ambetter", "commercial", [r"\bcentene\b", r"\bambetter\b", r"\ballwell\b", r"\bsuperior\s*health\b", r"\bpeach\s*state\b", r"\bmagellan\s*health\b", r"\bhealth\s*net\b", r"\bfidelis\b"]),
    ("molina", "Molina Healthcare", "commercial", [r"\bmolina\b"]),
    ("wellcare", "WellCare", "commercial", [r"\bwellcare\b", r"\bwell\s*care\b"]),
    ("caresource", "CareSource", "commercial", [r"\bcaresource\b", r"\bcare\s*source\b"]),
    ("oscar", "Oscar Health", "commercial", [r"\boscar\s*(health|insurance)?\b"]),
    ("bright", "Bright HealthCare", "commercial", [r"\bbright\s*health(care)?\b"]),
    ("kp-northern-ca", "Kaiser Northern California", "commercial", [r"kaiser.{0,8}northern.{0,8}ca", r"kp.{0,4}nor.?cal"]),
    ("tufts", "Tufts Health Plan", "commercial", [r"\btufts\b"]),
    ("health-partners", "HealthPartners", "commercial", [r"\bhealth\s*partners\b"]),
    ("priority", "Priority Health", "commercial", [r"\bpriority\s*health\b"]),
    ("mvp", "MVP Health Care", "commercial", [r"\bmvp\s*health\b", r"\bmvp\s*care\b"]),
    ("emblem", "EmblemHealth", "commercial", [r"\bemblem(health)?\b", r"\bgha?i\b", r"\bhip\s*health\b"]),
    ("scan", "SCAN Health Plan", "commercial", [r"\bscan\s*health\b"]),
    ("devoted", "Devoted Health", "commercial", [r"\bdevoted\s*health\b"]),
    ("clover", "Clover Health", "commercial", [r"\bclover\s*health\b"]),
    ("naphcare", "NaphCare", "specialty", [r"\bnaphcare\b"]),
]
# What files put before a payer's name, and plan words after it.
METHOD_WORDS = "standard_charge|median_amount|payer_specific_negotiated_charge|negotiated_dollar|negotiated_pct"
PLAN_WORDS = r"ppo|hmo|epo|pos|hdhp|exchange|marketplace|advantage|medicare\s*adv|medadv|medsupp|gold|silver|bronze|platinum|choice|select|premier|elite|plus|gold\s*card|preferred|network|plan|product|policy|individual|commercial|group|family"

Rules = Sequence[tuple[str, str, str, list[str]]]


def strip_method(c: Column) -> Column:
    """Without up to three leading method names."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), rf"(?i)^(?:(?:{METHOD_WORDS})\s*[|:_-]\s*){{1,3}}", ""))


def canon_payer(c: Column, rules: Rules = PAYER_RULES) -> Column:
    """struct<slug, display, category>. Word boundaries are Unicode ones. Blank names are ``unknown``."""
    return F.transform(F.array(strip_method(c)), lambda name: _named(name, rules))[0]


def _named(name: Column, rules: Rules) -> Column:
    base = F.trim(F.regexp_replace(name, rf"(?i)\s+(?:{PLAN_WORDS})\s*$", ""))
    base = F.substring(F.when(base == "", name).otherwise(base), 1, 60)
    made = lambda slug, display, category: F.struct(slug.alias("slug"), display.alias("display"), category.alias("category"))
    fixed = lambda *x: made(*map(F.lit, x))
    cases = [(name == "", fixed("unknown", "Unknown", "other"))]
    cases += [(name.rlike("(?iU)" + "|".join(patterns)), fixed(slug, display, category)) for slug, display, category, patterns in rules]
    return choose(cases, made(slugify(base), F.initcap(base), F.lit("other")))
