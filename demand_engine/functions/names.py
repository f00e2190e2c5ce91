"""Text columns: station names, rider type, gender."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rider types, as they appear -> as they are reported. Matching is case-sensitive.
USER_TYPES = {
    "member": "member",
    "casual": "casual",
    "subscriber": "member",
    "customer": "casual",
}

# ISO 5218 sex codes -> words.
GENDERS = {"0": "unknown", "1": "male", "2": "female"}

# Characters and words replaced in a station name, in the order they apply.
LITERALS = {
    ".": "",
    "&": " and ",
    "@": " at ",
    "'": "",
    "-": " ",
    "\\": " ",
    "/": " ",
    "(former)": "",
}

# Whole words replaced in a station name.
WORDS = {
    "north": "n",
    "south": "s",
    "east": "e",
    "west": "w",
    "massachusetts": "mass",
    "university": "u",
    "street": "st",
    "avenue": "ave",
    "boulevard": "blvd",
    "place": "pl",
    "drive": "dr",
    "road": "rd",
    "park": "pk",
    "center": "ctr",
    "square": "sq",
    "station": "",
}

# Cleaned names that stand for another station.
ALIASES = {
    "lafayette sq at mass ave main st columbia st": "mass ave lafayette sq",
    "forsyth st at huntington ave": "northeastern u n parking lot",
    "prudential ctr belvidere": "prudential center belvedere st",
    "harvard u gund hall at quincy st kirkland s": "harvard u gund hall at quincy st kirkland st",
    "mass ave at boylston st": "boylston st at mass ave",
    "commonwealth ave at griggs st": "allston green district griggs st at commonwealth ave",
    "child st at brian p murphy staircase": "brian p murphy staircase at child st",
}


def replace_values(c: Column, mapping: Mapping[str, str]) -> Column:
    """Swap whole values found in `mapping`; other values and nulls stay as they are."""
    table = F.create_map(*(F.lit(v) for v in chain.from_iterable(mapping.items())))
    return F.coalesce(table[c], c)


def replace_literals(c: Column, literals: Mapping[str, str] = LITERALS) -> Column:
    """Replace each literal everywhere in the text, one after the other."""
    return reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), literals.items(), c)


def replace_words(c: Column, words: Mapping[str, str] = WORDS) -> Column:
    """Replace whole space-separated words and join the rest with single spaces.

    Words that are empty to begin with (doubled spaces) vanish. A word the dictionary turns into
    nothing still holds its place: "south station" becomes "s ".
    """
    tokens = F.filter(F.split(c, " ", -1), lambda w: w != "")
    return F.array_join(F.transform(tokens, lambda w: replace_values(w, words)), " ")


def clean_station_name(c: Column, aliases: Mapping[str, str] = ALIASES) -> Column:
    """The spelling of a station name that all station lists agree on."""
    return replace_values(replace_words(replace_literals(F.lower(c))), aliases)


def user_type(c: Column) -> Column:
    return replace_values(c, USER_TYPES)


def gender(c: Column) -> Column:
    return replace_values(c.cast("string"), GENDERS)


def title_case(c: Column) -> Column:
    """Capitalise every run of letters and digits, whatever separates the runs."""
    runs = F.regexp_extract_all(c, F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda w: F.initcap(w)), "")
