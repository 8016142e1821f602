"""Civil dates as ISO text: predicates, ranges and the grammar of sale periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import blank_null, let

ISO = r"^\d{4}-\d{2}-\d{2}$"
WEEKDAY = "[月火水木金土日]"
TO = "[〜～~-]"

RULE = "struct<rule_type:string,start_date:string,end_date:string,time_start:string,time_end:string,weekday:string,raw_text:string,confidence:double>"


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null where there is none or the group took no part."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def groups(text: Column, pattern: str, many: int) -> Column:
    """All groups of the first match, an array; '' for those that took no part, null where there is no match. The text is searched once."""
    told = "\t".join(f"${k + 1}" for k in range(many))
    return let(F.regexp_extract(text, pattern, 0), lambda m: F.when(m != "", F.split(F.regexp_replace(m, f"^(?:{pattern})$", told), "\t")))


def active_on(day: str | Column, start: Column, end: Column) -> Column:
    """Compared as text; a missing bound is ''."""
    d = F.lit(day) if isinstance(day, str) else day
    return (blank_null(start) <= d) & (d <= blank_null(end))


def exactly_on(day: str | Column, start: Column, end: Column) -> Column:
    d = F.lit(day) if isinstance(day, str) else day
    return (start == d) & (end == d)


def well_ordered(start: Column, end: Column) -> Column:
    """Both are written as ISO dates, the start not after the end."""
    return blank_null(start).rlike(ISO) & blank_null(end).rlike(ISO) & (blank_null(start) <= blank_null(end))


def days(start: Column, end: Column) -> Column:
    """Every day of a closed range as ISO text; empty where a date is no date or the range runs backwards."""
    a, b = F.try_to_date(start, "yyyy-MM-dd"), F.try_to_date(end, "yyyy-MM-dd")
    some = F.transform(F.sequence(a, F.greatest(a, b)), lambda d: d.cast("string"))
    return F.when(a.isNotNull() & b.isNotNull() & (a <= b), some).otherwise(F.array().cast("array<string>"))


def iso(year: Column, month: Column, day: Column) -> Column:
    """Padded text of a year, month and day; not checked."""
    return F.concat_ws("-", F.lpad(year.cast("int").cast("string"), 4, "0"), F.lpad(month.cast("int").cast("string"), 2, "0"), F.lpad(day.cast("int").cast("string"), 2, "0"))


def real(date: Column) -> Column:
    """The date if there is such a day, else null."""
    return F.when(F.try_to_date(date, "yyyy-MM-dd").isNotNull(), date)


def squeezed(text: Column) -> Column:
    return F.regexp_replace(blank_null(text), r"(?U)\s+", "")


def page_range(text: Column, default_year: int) -> Column:
    """struct(start, end) of the first way of writing a range that the text has, '' and '' if none. Dates are padded, not checked."""
    y = F.lit(default_year)
    # The four ways, in order.
    full = rf"(20\d{{2}})年(\d{{1,2}})月(\d{{1,2}})日{TO}(?:(20\d{{2}})年)?(\d{{1,2}})月(\d{{1,2}})日"
    short = rf"(20\d{{2}})年(\d{{1,2}})月(\d{{1,2}})日{TO}(\d{{1,2}})日"
    bare = rf"(\d{{1,2}})月(\d{{1,2}})日{TO}(\d{{1,2}})月(\d{{1,2}})日"
    slash = rf"(\d{{1,2}})/(\d{{1,2}})[^0-9]{{0,5}}{TO}[^0-9]{{0,5}}(\d{{1,2}})/(\d{{1,2}})"
    pair = lambda a, b: F.struct(a.alias("start"), b.alias("end"))
    ways = [
        (full, 6, lambda g: pair(iso(g[0], g[1], g[2]), iso(F.when(g[3] != "", g[3]).otherwise(g[0]), g[4], g[5]))),
        (short, 4, lambda g: pair(iso(g[0], g[1], g[2]), iso(g[0], g[1], g[3]))),
        (bare, 4, lambda g: pair(iso(y, g[0], g[1]), iso(y, g[2], g[3]))),
        (slash, 4, lambda g: pair(iso(y, g[0], g[1]), iso(y, g[2], g[3]))),
    ]

    def first(t: Column, left: list) -> Column:
        if not left:
            return pair(F.lit(""), F.lit(""))
        pattern, many, made = left[0]
        return let(groups(t, pattern, many), lambda g: F.when(g.isNotNull(), made(g)).otherwise(first(t, left[1:])))

    return let(squeezed(text), lambda t: first(t, ways))


def update_week(text: Column, year: int) -> Column:
    """struct(start, end): seven days from an update stamp, with its year or without; null dates if there is none."""
    stamp, short = r"(20\d{2})[-年/](\d{1,2})[-月/](\d{1,2})日?更新", r"(\d{1,2})月(\d{1,2})日更新"
    start = F.coalesce(real(iso(found(text, stamp, 1), found(text, stamp, 2), found(text, stamp, 3))), F.when(~text.rlike(stamp), real(iso(F.lit(year), found(text, short, 1), found(text, short, 2)))))
    return F.struct(start.alias("start"), F.date_add(F.try_to_date(start, "yyyy-MM-dd"), 6).cast("string").alias("end"))


def token_date(text: Column, year: int) -> Column:
    """The first month/day of a token that is a real day, else null."""
    p = r"(?<!\d)(\d{1,2})\s*/\s*(\d{1,2})(?!\d)"
    t = blank_null(text)
    return real(iso(F.lit(year), found(t, p, 1), found(t, p, 2)))


def repaired(text: Column) -> Column:
    """Slips of recognition in dates put right: a slash read as 7 before a weekday, kana read for the range sign between digits."""
    t = F.regexp_replace(F.trim(blank_null(text)), rf"(?<!\d)(\d)7(\d)(?=\({WEEKDAY}\))", "$1/$2")
    return F.regexp_replace(t, r"(?<=\d)[ぐて〜～](?=\d)", "〜")


def temporal_rules(text: Column, year: int) -> Column:
    """array of RULE: a time of day, and beside it the first kind of date rule that fits.

    Kinds in order: range, pair, single day (limited, from then on, plain), weekly day,
    today. A rule whose date is no day is left out.
    """
    raw, y = blank_null(text), F.lit(year)
    # The phrases of the grammar.
    wd = rf"(?:\({WEEKDAY}\))?"
    evening, hour = r"夕方(\d{1,2})時(?:から|〜|～)", r"(?<!\d)(\d{1,2})時(?:から|〜|～)"
    span = rf"(\d{{1,2}})/(\d{{1,2}}){wd}{TO}(?:(\d{{1,2}})/)?(\d{{1,2}}){wd}"
    two = rf"(\d{{1,2}})/(\d{{1,2}}){wd}[・･](?:(\d{{1,2}})/)?(\d{{1,2}}){wd}"
    one = rf"(?<!\d)(\d{{1,2}})/(\d{{1,2}}){wd}"
    weekly = rf"毎週({WEEKDAY})曜(?:日)?"

    def rule(kind: str | Column, confidence: float | Column, start=F.lit(""), end=F.lit(""), time=F.lit(""), weekday=F.lit("")) -> Column:
        lit = lambda v: v if isinstance(v, Column) else F.lit(v)
        return F.struct(lit(kind).alias("rule_type"), start.alias("start_date"), end.alias("end_date"), time.alias("time_start"), F.lit("").alias("time_end"), weekday.alias("weekday"), raw.alias("raw_text"), lit(confidence).cast("double").alias("confidence")).cast(RULE)

    clock = lambda h: F.concat(F.lpad(h.cast("string"), 2, "0"), F.lit(":00"))
    late = lambda h: F.when(h.between(1, 11), h + 12).otherwise(h)

    def time(t: Column) -> Column:
        plain = let(found(t, hour), lambda h: F.when(h.isNotNull(), rule("time_start", 0.95, time=clock(h.cast("int")))))
        return let(found(t, evening), lambda h: F.when(h.isNotNull(), rule("time_start", 0.96, time=clock(late(h.cast("int"))))).otherwise(plain))

    def both_ends(g: Column, kind: str, confidence: float) -> Column:
        ends = F.struct(real(iso(y, g[0], g[1])).alias("a"), real(iso(y, F.when(g[2] != "", g[2]).otherwise(g[0]), g[3])).alias("b"))
        return let(ends, lambda e: F.when(e["a"].isNotNull() & e["b"].isNotNull(), rule(kind, confidence, e["a"], e["b"])))

    def single(t: Column, g: Column) -> Column:
        limited, onward = t.rlike("限り|のみ|限定"), t.rlike("より販売|から販売|発売")
        kinds = [("single_date_limited", 0.99, True), ("start_date_only", 0.98, False), ("single_date", 0.94, True)]
        made = lambda d, k: rule(k[0], k[1], d, d if k[2] else F.lit(""))
        return let(real(iso(y, g[0], g[1])), lambda d: F.when(d.isNotNull(), F.when(limited, made(d, kinds[0])).when(onward, made(d, kinds[1])).otherwise(made(d, kinds[2]))))

    def undated(t: Column) -> Column:
        today = F.when(t.contains("本日限り") | t.contains("今日限り"), rule("relative_today", 0.90))
        return let(found(t, weekly), lambda w: F.when(w.isNotNull(), rule("recurring_weekday", 0.93, weekday=w)).otherwise(today))

    def date(t: Column) -> Column:
        third = let(groups(t, one, 2), lambda g: F.when(g.isNotNull(), single(t, g)).otherwise(undated(t)))
        second = let(groups(t, two, 4), lambda g: F.when(g.isNotNull(), both_ends(g, "date_pair", 0.98)).otherwise(third))
        return let(groups(t, span, 4), lambda g: F.when(g.isNotNull(), both_ends(g, "date_range", 0.99)).otherwise(second))

    return let(squeezed(raw), lambda t: F.array_compact(F.array(time(t), date(t))))


def resolved_scope(parent_start: Column, parent_end: Column, rules: Column, today: Column | str = "") -> Column:
    """The period that rules leave of a parent's: the surest explicit date (the first of equals), then today, then the parent."""
    now = F.lit(today) if isinstance(today, str) else blank_null(today)
    start, end = blank_null(parent_start), blank_null(parent_end)
    last = lambda kind, field: F.coalesce(F.try_element_at(F.filter(rules, lambda r: r["rule_type"] == kind), F.lit(-1))[field], F.lit(""))
    kinds = F.transform(rules, lambda r: r["rule_type"])
    dated = F.filter(rules, lambda r: ~r["rule_type"].isin("time_start", "recurring_weekday", "relative_today") & (r["start_date"] != ""))
    best = F.aggregate(dated, F.lit(None).cast(RULE), lambda a, r: F.when(a.isNull() | (r["confidence"] > a["confidence"]), r).otherwise(a))
    relative = F.array_contains(kinds, "relative_today") & (now != "")
    weekly = F.array_contains(kinds, "recurring_weekday")
    return F.struct(
        F.when(best.isNotNull(), best["start_date"]).when(relative, now).otherwise(start).alias("sale_start"),
        F.when(best["rule_type"] == "start_date_only", F.when(end != "", end).otherwise(best["start_date"])).when(best.isNotNull(), F.coalesce(F.nullif(best["end_date"], F.lit("")), best["start_date"])).when(relative, now).otherwise(end).alias("sale_end"),
        last("time_start", "time_start").alias("time_start"),
        F.lit("").alias("time_end"),
        F.when(weekly, last("recurring_weekday", "weekday")).otherwise("").alias("weekday"),
        F.when(weekly, "recurring_weekday").otherwise("").alias("availability_rule"),
        F.when(best.isNotNull(), best["rule_type"]).when(relative, "relative_today").otherwise("parent").alias("date_source"),
    )


def period_label(start: Column, end: Column) -> Column:
    return F.when(start == end, start).otherwise(F.concat(start, F.lit("〜"), end))
