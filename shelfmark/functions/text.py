"""Text keys and text predicates. Built-in expressions, but for NFKC, which Spark has not."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Categories and words that mark household goods.
HOUSEHOLD_CATEGORIES = ("日用品", "日用雑貨", "生活用品", "生活雑貨", "家庭用品", "ホーム用品", "洗剤", "紙製品", "衛生用品", "掃除用品", "キッチン用品")
HOUSEHOLD_WORDS = (
    "キッチンペーパー", "トイレットペーパー", "ティッシュペーパー", "ボックスティッシュ", "洗濯洗剤", "食器用洗剤", "台所用洗剤", "衣料用洗剤", "柔軟剤", "漂白剤", "住居用洗剤",
    "ハミガキ", "歯磨き", "歯ブラシ", "シャンプー", "コンディショナー", "ボディソープ", "ハンドソープ", "アリエール", "ボールド", "トップクリアリキッド", "ジョイ除菌",
)
HOUSEHOLD_MARKERS = (
    "キッチンペーパー", "トイレットペーパー", "ティッシュ", "ティシュー", "洗濯洗剤", "食器用洗剤", "台所用洗剤", "衣料用洗剤", "柔軟剤", "漂白剤", "ハミガキ",
    "歯磨き", "歯ブラシ", "シャンプー", "コンディショナー", "ボディソープ", "ハンドソープ", "アリエール", "ボールド", "リステリン", "フィニッシュ", "ジョイ",
)
# Words that say nothing about a product, signs that spoil a fragment.
GENERIC_WORDS = ("税込", "税抜", "本体", "価格", "限り", "販売", "お買得", "お買い得", "当り", "あたり", "より", "チラシ", "ポイント", "クーポン", "店舗", "特売", "セール")
SPOILING_SIGNS = "□■●▲▼※★☆→←"
EDGE_SIGNS = "・/／()（）[]【】<>「」『』:：,，.。"
# Punctuation that comparison leaves out, and units of a numeric variant.
PUNCTUATION = r"[\s（）()\[\]【】「」『』<>〈〉《》:：;；,，。/\\\-ー_・]+"
JAPANESE_ONLY_DROPS = r"[（）()\[\]【】「」『』<>〈〉《》:：;；,，.。/\\\-ー_・0-9a-zA-Z]+"
UNITS = "連|mm|cm|ml|l|g|kg|枚|個|コ|袋|本|巻|組|カン|缶|パック|本入|袋入"


@F.pandas_udf(StringType())
def nfkc(value: pd.Series) -> pd.Series:
    """ASCII is as it is; of other texts each different one of a batch is normalised once."""
    other = {s: unicodedata.normalize("NFKC", s) for s in set(value.dropna()) if not s.isascii()}
    return value.map(lambda s: other.get(s, s), na_action="ignore") if other else value


def blank_null(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def compact(value: Column) -> Column:
    """No white space (in Unicode's sense), lower case; null is empty."""
    return F.lower(F.regexp_replace(blank_null(value), r"(?U)\s+", ""))


def key_form(value: Column) -> Column:
    """The form in which names are compared: NFKC, no white space, lower case. ASCII text never leaves the JVM's side of a plan that has no other."""
    return compact(nfkc(blank_null(value)))


def key_of(*values: Column) -> Column:
    """Several values in key_form() as one string, normalised in one go; a separator keeps them apart."""
    return key_form(F.concat_ws("\x1f", *map(blank_null, values)))


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once, however often f uses it."""
    return F.transform(F.array(value), f)[0]


def contains_any(text: Column, words: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | text.contains(w)
    return found


def is_household_name(name: Column) -> Column:
    return contains_any(compact(name), tuple(m.lower() for m in HOUSEHOLD_MARKERS))


def is_household_good(category: Column, name: Column) -> Column:
    """By category first, then by clear words in the name."""
    return key_form(category).isin(*HOUSEHOLD_CATEGORIES) | contains_any(key_form(name), HOUSEHOLD_WORDS)


def is_percent_only(price_in_tax: Column, *texts: Column) -> Column:
    """A percentage is offered, and no price."""
    return compact(F.concat_ws(" ", *map(blank_null, texts))).contains("%off") & (F.trim(blank_null(price_in_tax)) == "")


def has_all(*columns: Column) -> Column:
    """None is blank."""
    out = F.lit(True)
    for c in columns:
        out = out & (F.trim(blank_null(c)) != "")
    return out


def comparable(value: Column, normal: bool = True) -> Column:
    """NFKC, lower case, no punctuation; a dot stays next to a digit. normal=False: the text is in NFKC already."""
    base = F.lower(nfkc(blank_null(value)) if normal else blank_null(value))
    return F.regexp_replace(F.regexp_replace(base, "(?U)" + PUNCTUATION, ""), r"(?<!\d)\.(?!\d)", "")


def without_numbers(value: Column, normal: bool = True) -> Column:
    return F.regexp_replace(comparable(value, normal), r"\d+(\.\d+)?", "")


def japanese_only(value: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(blank_null(value), r"(?U)\s+", ""), JAPANESE_ONLY_DROPS, "")


def numeric_signatures(value: Column, normal: bool = True) -> Column:
    """Numbers with their units, else bare numbers, each once, in order."""
    base = F.lower(nfkc(blank_null(value)) if normal else blank_null(value))
    number = r"\d+(?:\.\d+)?"
    with_unit = F.transform(F.regexp_extract_all(base, F.lit(rf"({number}\s*(?:{UNITS}))"), F.lit(1)), lambda x: F.regexp_replace(x, r"(?U)\s+", ""))
    bare = F.regexp_extract_all(base, F.lit(rf"({number})"), F.lit(1))
    return F.array_distinct(F.when(F.size(with_unit) > 0, with_unit).otherwise(bare))


def number_tokens(value: Column) -> Column:
    """The numbers of a text in NFKC, each once."""
    return F.array_distinct(F.regexp_extract_all(F.lower(nfkc(blank_null(value))), F.lit(r"(\d+(?:\.\d+)?)"), F.lit(1)))


def signature_support(wanted: Column, shown: Column, numbers: Column) -> Column:
    """The share of a name's variants (numeric_signatures) that a text evidences; 1 where a name has none.

    A variant with a unit is evidenced by its letters in the text's comparable form, also with the unit before the number; a bare number only by an equal
    number of the text (number_tokens).
    """
    bare = lambda s: s.rlike(r"^[\d.]+$")
    written = lambda s: F.array(s, F.regexp_replace(s, r"^([\d.]+)(.+)$", "$2$1"))
    seen = F.filter(wanted, lambda s: F.when(bare(s), F.array_contains(numbers, s)).otherwise(F.exists(written(s), lambda w: shown.contains(w))))
    return F.when(F.size(wanted) == 0, 1.0).otherwise(F.size(seen) / F.size(wanted))


def price_hypotheses(text: Column, longest: int = 8) -> Column:
    """Prices that one recognised word may mean: runs of digits, pieces of merged runs, letters taken for digits; 20 to 9999, each once."""
    def pieces(run: Column) -> Column:
        n = F.length(run)
        none = F.array().cast("array<int>")
        sliding = lambda size: F.when(n >= size, F.transform(F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1))), lambda i: F.substring(run, i, F.lit(size)).cast("int")))
        whole = F.when((n >= 2) & (n <= 4), F.array(run.try_cast("int"))).otherwise(none)
        cut = F.when((n == 4) & F.substring(run, 4, 1).isin("5", "6"), F.array(F.substring(run, 1, 3).cast("int"))).otherwise(none)
        three = F.when((n >= 5) & (n <= longest), sliding(3)).otherwise(none)
        four = F.when((n >= 5) & (n <= min(6, longest)), F.filter(sliding(4), lambda v: (v >= 1000) & (v % 10 == 0))).otherwise(none)
        return F.concat(whole, cut, three, four)

    def letter(s: Column, pattern: str, digit: str) -> Column:
        found = F.regexp_extract(s, pattern, 1)
        return F.when(found != "", F.array(F.concat(F.lit(digit), found).cast("int"))).otherwise(F.array().cast("array<int>"))

    def every(s: Column) -> Column:
        runs = F.regexp_extract_all(s, F.lit(r"(\d+)"), F.lit(1))
        return F.concat(F.flatten(F.transform(runs, pieces)), letter(s, r"^[sS](\d{2})(?!\d)", "2"), letter(s, r"^[bB](\d{2})(?!\d)", "8"))

    return let(F.regexp_replace(blank_null(text), "[, ]", ""), lambda s: F.array_distinct(F.filter(every(s), lambda v: v.between(20, 9999))))


def direct_price(text: Column) -> Column:
    """The longest run of two to four digits, the first of equal length; null outside 20 to 9999."""
    runs = F.regexp_extract_all(F.regexp_replace(blank_null(text), ",", ""), F.lit(r"(\d{2,4})"), F.lit(1))
    best = F.aggregate(runs, F.lit(""), lambda a, r: F.when(F.length(r) > F.length(a), r).otherwise(a))
    value = best.try_cast("int")
    return F.when(value.between(20, 9999), value)


# What a fragment is that can name a product. No number or price alone, no quantity at its end, no general word or sign, and a letter.
NAME_FRAGMENT = (
    r"^(?![\d.,%％+\-〜~円]+$)"
    r"(?!.*(?i:\d{1,4}(?:g|kg|ml|L|個|本|枚|袋|入|パック|束|尾|切))$)"
    rf"(?!.*(?:{'|'.join(GENERIC_WORDS)}|[{SPOILING_SIGNS}]))"
    r".*[一-龥ぁ-んァ-ヶA-Za-z]"
)


def longest_fragment(text: Column, normal: bool = True) -> Column:
    """The longest fragment between blanks that can be a product's name, the last in order among equals; '' if none can."""
    base = nfkc(blank_null(text)) if normal else blank_null(text)
    parts = F.array_distinct(F.transform(F.split(base, r"(?U)\s+"), lambda p: F.trim(p, F.lit(EDGE_SIGNS))))
    able = F.filter(parts, lambda t: F.length(t).between(2, 42) & t.rlike(NAME_FRAGMENT))
    # The best of those: by length, then in order.
    best = F.array_max(F.transform(able, lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))))
    return F.coalesce(best["t"], F.lit(""))


# Words that a product's name is not made of, and quantities.
NAMELESS = (
    "販売", "特売", "商品", "定番", "水曜", "月曜", "火曜", "木曜", "金曜", "土曜", "日曜", "フェア", "限り", "より", "税込", "税抜", "本体価格", "本体", "価格", "当り", "あたり", "パック", "バック", "各", "円", "お買得", "お買い得", "コーナー",
    "100g当り", "100gあたり", "1パック", "パック当り", "当りパック",
)
QUANTITY = r"(?i)\d+(?:[.,]\d+)?(?:kg|g|ml|l|L|個|本|枚|袋|パック|入|連|束|玉|尾|切|食)?"
PRICE_LIKE = r"^[\s\d.,/%+×xX\-~〜～円税込本体価格]+$"
LETTERS = r"[一-龥ぁ-んァ-ヶA-Za-z]"


def is_name_token(text: Column, confidence: Column) -> Column:
    """A recognised word that can belong to a name: sure enough, not a price, with a letter."""
    t = F.trim(blank_null(text))
    return (confidence >= 5) & (t != "") & ~t.rlike(PRICE_LIKE) & t.rlike(LETTERS)


def name_evidence(texts: Column) -> Column:
    """What is left of some words when quantities, prices and general terms are gone: letters alone."""
    joined = F.array_join(F.transform(texts, lambda t: F.regexp_replace(t, r"(?U)[\s・/／()（）\[\]【】]+", "")), "")
    out = F.regexp_replace(joined, QUANTITY, "")
    for term in sorted(NAMELESS, key=len, reverse=True):  # a term goes before one that is part of it
        out = F.replace(out, F.lit(term), F.lit(""))
    return F.regexp_replace(F.regexp_replace(out, "[円%％税込税抜本体価格]+", ""), "[^一-龥ぁ-んァ-ヶA-Za-z]", "")


def is_specific(evidence: Column) -> Column:
    """Two Japanese letters make a name, or four Latin ones."""
    return (F.regexp_count(evidence, F.lit("[一-龥ぁ-んァ-ヶ]")) >= 2) | (F.regexp_count(evidence, F.lit("[A-Za-z]")) >= 4)


def repaired_price(digits: Column, second: Column, lead: Column) -> Column:
    """struct(value, confidence, status) of recognised digits: no price begins with 0; a close second 9 (lead within .03) takes its place."""
    first = F.when((F.size(digits) >= 2) & (digits[0] == "0") & (second == "9") & (lead <= 0.03), F.lit("9")).otherwise(digits[0])
    whole = F.concat(first, F.array_join(F.slice(digits, 2, 20), ""))
    value = whole.try_cast("int")
    status = F.when(first == "0", "invalid_leading_zero").when(value.isNull() | ~value.between(10, 9999), "invalid_value").otherwise("ok")
    good = status == "ok"
    return F.struct(F.when(good, value).alias("value"), F.when(good, F.when(F.size(digits) == 2, 0.96).otherwise(0.85)).otherwise(0.0).alias("confidence"), status.alias("status"))
