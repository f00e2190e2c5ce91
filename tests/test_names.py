import pytest
from pyspark.sql import functions as F

from demand_engine.functions import names

ALIASES = {
    "lafayette sq at mass ave main st columbia st": "mass ave lafayette sq",
    "forsyth st at huntington ave": "northeastern u n parking lot",
    "prudential center belvidere": "prudential center belvedere st",
    "harvard u gund hall at quincy st kirkland s": "harvard u gund hall at quincy st kirkland st",
    "mass ave at boylston st": "boylston st at mass ave",
    "commonwealth ave at griggs st": "allston green district griggs st at commonwealth ave",
    "child street at brian p murphy staircase": "brian p murphy staircase at child st",
}


def apply(spark, function, values, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    rows = df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()
    return [r["out"] for r in rows]


def test_literals_keep_case(spark):
    got = apply(spark, names.replace_literals, ["main@tech", "A&B C.D", None])
    assert got == ["main at tech", "A and B CD", None]


def test_all_steps(spark):
    assert apply(spark, names.clean_station_name, ["Prudential Center Belvidere"]) == [
        "prudential center belvedere st"
    ]


def test_aliases(spark):
    assert apply(spark, names.clean_station_name, list(ALIASES)) == list(ALIASES.values())


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("South Station", "s "),
        ("South Station - 700 Atlantic Ave.", "s  700 atlantic ave"),
        ("A  B", "a b"),
        ("(former) Park/Street", "pk st"),
        ("St. Mary's & Northern", "st marys and northern"),
        ("North\\East", "n e"),
        ("", ""),
        (None, None),
    ],
)
def test_word_rules(spark, raw, clean):
    assert apply(spark, names.clean_station_name, [raw]) == [clean]


def test_user_types_match_case_exactly(spark):
    given = ["subscriber", "customer", "member", "casual", "Subscriber", "x", None]
    expected = ["member", "casual", "member", "casual", "Subscriber", "x", None]
    assert apply(spark, names.user_type, given) == expected


def test_genders_from_text_and_number(spark):
    assert apply(spark, names.gender, ["0", "1", "2", "9", None]) == [
        "unknown", "male", "female", "9", None,
    ]
    assert apply(spark, names.gender, [0, 1, 2, 9, None], "bigint") == [
        "unknown", "male", "female", "9", None,
    ]


def test_title_case_starts_words_after_any_separator(spark):
    given = ["mit-stata center", "o'brien hwy", "éCOLE st", "  a", "", None]
    expected = ["Mit-Stata Center", "O'Brien Hwy", "École St", "  A", "", None]
    assert apply(spark, names.title_case, given) == expected
