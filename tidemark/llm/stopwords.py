"""Common words of the languages in use. Fixed values; pass another set where a function takes one."""

from __future__ import annotations

STOP_WORDS = {
    "en": "the of and to a in is that it was for on are as with be by this from or an at not have has but they you he she we his her their which will would there been".split(),
    "fr": "le la les de des du et en un une est que qui dans pour par sur au aux avec pas ne se ce il elle nous vous ou sont plus son sa ses".split(),
    "de": "der die das und den dem des von zu mit sich ist nicht im ein eine einen einer als auf auch es an werden aus er hat dass sie nach bei wird".split(),
    "es": "el los las del y que se por con para no una su al lo como más pero sus le ya o este sí porque esta entre cuando es son ha".split(),
}

ALL = sorted({w for words in STOP_WORDS.values() for w in words})
