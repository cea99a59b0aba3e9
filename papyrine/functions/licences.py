"""Licence texts and addresses to codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Licence addresses of the preprint feed and their codes.
URL_CODES = {
    "http://creativecommons.org/licenses/by-nc-sa/4.0/": "CCBYNCSA",
    "http://creativecommons.org/publicdomain/zero/1.0/": "CC0",
    "http://creativecommons.org/licenses/by-nc-nd/4.0/": "CCBYNCND",
    "http://creativecommons.org/licenses/by/4.0/": "CCBY",
    "http://creativecommons.org/licenses/by-sa/4.0/": "CCBYSA",
    "http://creativecommons.org/licenses/by/3.0/": "CCBY",
    "http://creativecommons.org/licenses/by-nc-sa/3.0/": "CCBYNCSA",
    "http://creativecommons.org/licenses/publicdomain/": "public-domain",
    "http://arxiv.org/licenses/nonexclusive-distrib/1.0/": "ArXiv nonexclusive-distrib",
}

# Licence texts that do not say what may be done with the work.
UNUSABLE = [
    "acs-specific: authorchoice/editors choice usage agreement",
    "elsevier-specific: oa user license",
    "other-oa",
    "publisher-specific, author manuscript: http://academic.oup.com/journals/pages/about_us/legal/notices",
    "publisher-specific-oa",
    "unspecified-oa",
    "Open Government Licence - Canada",
    "publisher-specific, author manuscript",
    "implied-oa",
    "publisher-specific, author manuscript: http://rsc.li/journals-terms-of-use",
    "publisher-specific, author manuscript: http://onlinelibrary.wiley.com/termsAndConditions",
    "publisher-specific, author manuscript: http://onlinelibrary.wiley.com/termsAndConditions#am",
    "publisher-specific license",
]

# Abbreviations, codes that allow derived works, and the code for "nothing known".
ABBREVIATED = {"pd": "public-domain"}
REUSABLE = ["public-domain", "mit", "gpl", "CC0", "CCBY", "CCBYNC"]
UNKNOWN = "unknown-reusability"


def normalise_licence(
    licence: Column, codes: dict[str, str], drop: list[str] = (), other: Column | None = None
) -> Column:
    """Code of a licence: NULL stays NULL, ``drop`` becomes NULL, the rest is ``other`` (default: itself)."""
    result = F.when(licence.isin(*drop), F.lit(None).cast("string")) if drop else F.when(F.lit(False), licence)
    for text, code in codes.items():
        result = result.when(licence == text, code)
    return result.otherwise(licence if other is None else other)


def preprint_licence(url: Column) -> Column:
    return normalise_licence(url, URL_CODES, other=F.concat(F.lit("ArXiv: "), url))


def works_licence(text: Column) -> Column:
    return normalise_licence(text, ABBREVIATED, drop=UNUSABLE)


def reuse_flag(code: Column, allowed: list[str] = REUSABLE) -> Column:
    return F.when(code.isin(*allowed), 1).otherwise(0)
