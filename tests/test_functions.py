"""Scalar functions on cases whose results are known."""

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import dates, fuzzy, price, text, urls


def value(spark, column, **row):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in row.items()]) if row else spark.range(1)
    return df.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("given", "expected"), [("108.9", 108), ("199.9", 199), (" 12.5 ", 12), ("1d", None), ("", None), ("NaN", None), ("Infinity", None), ("x", None), (None, None), ("-0.5", -1)])
def test_floor_yen(spark, given, expected):
    assert value(spark, price.floor_yen(F.lit(given).cast("string"))) == expected


def test_tax(spark):
    assert value(spark, price.tax_included(F.lit(199.9), F.lit(0.08))) == 214
    assert value(spark, price.derived_in_tax(F.lit("100"), F.lit(None), F.lit("0"))) == 100
    assert value(spark, price.derived_in_tax(F.lit("100"), F.lit("105.9"), F.lit("0.1"))) == 105
    assert value(spark, price.derived_in_tax(F.lit("100"), F.lit(None), F.lit(""))) is None
    assert tuple(value(spark, price.price_pair(F.lit("100.9"), F.lit("x")))) == (100, None)
    assert value(spark, price.infer_tax_rate(F.lit(100), F.lit(110))) == 0.10
    assert value(spark, price.infer_tax_rate(F.lit(100), F.lit(120))) is None


def test_key_form(spark):
    assert value(spark, text.key_form(F.lit("　ＡＢＣ ｶﾞ１２"))) == "abcガ12"
    assert value(spark, text.key_form(F.lit(None).cast("string"))) == ""


def test_household(spark):
    assert value(spark, text.is_household_good(F.lit("洗剤"), F.lit("りんご")))
    assert value(spark, text.is_household_good(F.lit(None).cast("string"), F.lit("アリエール 詰替")))
    assert not value(spark, text.is_household_good(F.lit("食品"), F.lit("りんご")))
    assert value(spark, text.is_household_name(F.lit("フィニッシュ 食洗機用")))


@pytest.mark.parametrize(
    ("given", "expected"),
    [("298", [298]), ("2985", [2985, 298]), ("1,280", [1280]), ("12345", [123, 234, 345]), ("129801", [129, 298, 980, 801, 2980]), ("s98", [98, 298]), ("B88円", [88, 888]), ("7", []), ("9", [])],
)
def test_price_hypotheses(spark, given, expected):
    assert value(spark, text.price_hypotheses(F.lit(given))) == expected


def test_direct_price(spark):
    assert value(spark, text.direct_price(F.lit("12円 198円 298"))) == 198
    assert value(spark, text.direct_price(F.lit("15"))) is None


def test_longest_fragment(spark):
    assert value(spark, text.longest_fragment(F.lit("税込 198円 国産りんご・ 100g ★特選 みかん"))) == "国産りんご"
    assert value(spark, text.longest_fragment(F.lit(None).cast("string"))) == ""


def test_signatures(spark):
    assert value(spark, text.numeric_signatures(F.lit("ヨーグルト ３ 連 900ml 900ml"))) == ["3連", "900ml"]
    assert value(spark, text.numeric_signatures(F.lit("商品1"))) == ["1"]


def rules(spark, phrase):
    return [(r["rule_type"], r["start_date"], r["end_date"], r["time_start"], r["weekday"]) for r in value(spark, dates.temporal_rules(F.lit(phrase), 2026))]


@pytest.mark.parametrize(
    ("phrase", "expected"),
    [
        ("9/12(土)〜14(月)", [("date_range", "2026-09-12", "2026-09-14", "", "")]),
        ("9/9(水)～9/11(金)", [("date_range", "2026-09-09", "2026-09-11", "", "")]),
        ("9/12(土)・13(日) 2日間限り", [("date_pair", "2026-09-12", "2026-09-13", "", "")]),
        ("土9/12限り", [("single_date_limited", "2026-09-12", "2026-09-12", "", "")]),
        ("9/15(火)より販売", [("start_date_only", "2026-09-15", "", "", "")]),
        ("9/15", [("single_date", "2026-09-15", "2026-09-15", "", "")]),
        ("毎週水曜日", [("recurring_weekday", "", "", "", "水")]),
        ("本日限り", [("relative_today", "", "", "", "")]),
        ("夕方4時から", [("time_start", "", "", "16:00", "")]),
        ("朝9時〜 9/12限り", [("time_start", "", "", "09:00", ""), ("single_date_limited", "2026-09-12", "2026-09-12", "", "")]),
        ("13/40", []),
        ("", []),
    ],
)
def test_temporal_rules(spark, phrase, expected):
    assert rules(spark, phrase) == expected


@pytest.mark.parametrize(
    ("phrase", "today", "expected"),
    [
        ("9/15より販売", "", ("2026-09-15", "2026-09-30", "start_date_only")),
        ("本日限り", "2026-09-13", ("2026-09-13", "2026-09-13", "relative_today")),
        ("本日限り", "", ("2026-09-01", "2026-09-30", "parent")),
        ("10/2限り", "", ("2026-10-02", "2026-10-02", "single_date_limited")),
    ],
)
def test_resolved_scope(spark, phrase, today, expected):
    s = value(spark, dates.resolved_scope(F.lit("2026-09-01"), F.lit("2026-09-30"), dates.temporal_rules(F.lit(phrase), 2026), today))
    assert (s["sale_start"], s["sale_end"], s["date_source"]) == expected


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("2026年9月11日〜9月14日", ("2026-09-11", "2026-09-14")),
        ("2026年12月30日～2027年1月3日", ("2026-12-30", "2027-01-03")),
        ("2026年9月11日-14日", ("2026-09-11", "2026-09-14")),
        ("9月12日～9月15日", ("2026-09-12", "2026-09-15")),
        ("9/12(土) ~ 9/18", ("2026-09-12", "2026-09-18")),
        ("9月12日", ("", "")),
    ],
)
def test_page_range(spark, given, expected):
    assert tuple(value(spark, dates.page_range(F.lit(given), 2026))) == expected


def test_dates(spark):
    assert value(spark, dates.days(F.lit("2026-09-12"), F.lit("2026-09-14"))) == ["2026-09-12", "2026-09-13", "2026-09-14"]
    assert value(spark, dates.days(F.lit("2026-09-14"), F.lit("2026-09-12"))) == []
    assert value(spark, dates.days(F.lit("2026-13-01"), F.lit("2026-09-12"))) == []
    assert tuple(value(spark, dates.update_week(F.lit("09月12日更新"), 2026))) == ("2026-09-12", "2026-09-18")
    assert value(spark, dates.repaired(F.lit("979(水)限り"))) == "9/9(水)限り"
    assert value(spark, dates.repaired(F.lit("9/9ぐ11"))) == "9/9〜11"
    assert value(spark, dates.token_date(F.lit("9 / 31"), 2026)) is None
    assert not value(spark, dates.well_ordered(F.lit("2026-09-14"), F.lit("2026-09-12")))


def test_urls(spark):
    assert value(spark, urls.full_size(F.lit("http://a/x_0thum.jpg?v=1"))) == "http://a/x_0.jpg?v=1"
    assert value(spark, urls.is_original(F.lit("https://chirashi-guide.com/chirashi-file/2026/x_0thum.jpg")))
    assert not value(spark, urls.is_original(F.lit("https://a.example/shot.png")))
    html = '<a href="/p">チラシ</a><img alt="チラシ" src="/chirashi-file/x_0thum.jpg"><img srcset="a_0.jpg 1x, logo.png 2x"><script>"https:\\/\\/e.example\\/chirashi\\/y_0.jpg"</script>'
    assert value(spark, urls.image_urls(F.lit("https://chirashi-guide.com/s/"), F.lit(html)))[0] == "https://chirashi-guide.com/chirashi-file/x_0.jpg"
    assert value(spark, urls.escaped(F.lit("<a b='1'>&\""))) == "&lt;a b=&#39;1&#39;&gt;&amp;&quot;"
    assert value(spark, urls.mime_of(F.unhex(F.lit("FFD8FFE0")))) == "image/jpeg"
    assert value(spark, urls.content_type(F.lit("Image/PNG; x=1"))) == "image/png"


def test_partial_ratio():
    assert fuzzy.partial_ratio("abc", "xxabcxx") == 100.0
    assert fuzzy.partial_ratio("", "abc") == 0.0
    assert fuzzy.ratio("kitten", "sitting") == pytest.approx(100 * 2 * 4 / 13)

    def slow(a, b):
        def lcs(x, y):
            t = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
            for i, c in enumerate(x):
                for j, e in enumerate(y):
                    t[i + 1][j + 1] = t[i][j] + 1 if c == e else max(t[i][j + 1], t[i + 1][j])
            return t[-1][-1]

        s, g = (a, b) if len(a) <= len(b) else (b, a)
        return max(200 * lcs(s, w) / (len(s) + len(w)) for e in range(1, len(g) + len(s)) if (w := g[max(0, e - len(s)) : e]))

    import random

    r = random.Random(5)
    for _ in range(300):
        a, b = ("".join(r.choice("abcd") for _ in range(r.randint(1, 9))) for _ in range(2))
        if len(a) != len(b):
            assert fuzzy.partial_ratio(a, b) == pytest.approx(slow(a, b)), (a, b)


def test_support(spark):
    cases = [
        ("ヨーグルト3連", "ヨーグルト 連 3", 1.0), ("ヨーグルト3連", "ヨーグルト4連", 0.0), ("商品1", "商品 199円", 0.0), ("商品1", "商品 1 円", 1.0), ("水1.5l 6本", "水 1.5L", 0.5),
        ("水１．５Ｌ", "水 l1.5", 1.0), ("りんご", "何でも", 1.0), ("卵10個", None, 0.0), (None, "卵10個", 1.0), ("", "", 1.0), ("卵 10 個 10個", "１０ 個", 1.0),
    ]
    rows = spark.createDataFrame(cases, "name string, text string, want double")
    read = rows.select("*", text.numeric_signatures(F.col("name")).alias("wanted"), text.comparable(F.col("text")).alias("shown"), text.number_tokens(F.col("text")).alias("numbers"))
    seen = read.withColumn("got", text.signature_support(F.col("wanted"), F.col("shown"), F.col("numbers")))
    assert [r["got"] for r in seen.collect()] == [c[2] for c in cases]
    assert fuzzy.dictionary_score("りんご", "国産りんご") == pytest.approx(100.0)


def test_names_and_digits(spark):
    evidence = text.name_evidence(F.array(F.lit("国産 りんご"), F.lit("100g当り"), F.lit("198円"), F.lit("税込")))
    assert value(spark, evidence) == "国産りんご"
    assert value(spark, text.is_specific(F.lit("りんご"))) and not value(spark, text.is_specific(F.lit("abc")))
    assert not value(spark, text.is_name_token(F.lit("198円"), F.lit(90.0))) and value(spark, text.is_name_token(F.lit("りんご"), F.lit(5.0)))
    price_ = lambda ds, second, lead: tuple(value(spark, text.repaired_price(F.array(*map(F.lit, ds)), F.lit(second), F.lit(lead))))
    assert price_("09", "9", 0.02) == (99, 0.96, "ok")
    assert price_("09", "9", 0.05) == (None, 0.0, "invalid_leading_zero")
    assert price_("198", "8", 0.5) == (198, 0.85, "ok")
    assert price_("5", "8", 0.5) == (None, 0.0, "invalid_value")
